"""Every registered query against its DuckDB oracle (the driver's check)."""

import pytest

import __spark_entry__ as E
from barsmith.plans import catalogue, loads
from tests.conftest import SF_ORACLE
from tools.oracle_check import canon, duck, spark_types

QUERIES = {**catalogue.QUERIES, **loads.QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_ORACLE)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql()[name]
    rel = con.sql(sql)
    assert spark_types(df) == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    cur = con.execute(sql)
    o_cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(o_cols)
    assert canon(df.columns, rows) == canon(o_cols, cur.fetchall())


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) and set(QUERIES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["symbol", "date_from", "open", "high", "low", "close", "volume",
                          "monthly_variation", "process_date"]


def test_landing_queries_keep_every_bar(spark):
    """Row counts against the bars themselves, so that a filter shared by query and oracle shows."""
    from pyspark.sql import functions as F

    from barsmith.plans.catalogue import _bars

    bars = _bars(spark, SF_ORACLE).count()
    assert bars == 8261
    for name in ("etl_monthly", "json_series_ingest", "json_folder_ingest", "normalize_types", "lenient_ingest",
                 "union_symbols", "monthly_variation", "incremental_intake"):
        assert QUERIES[name](spark, SF_ORACLE).count() == bars, name
    assert QUERIES["etl_relanded"](spark, SF_ORACLE).count() == 2 * bars
    assert QUERIES["relanded_duplicates"](spark, SF_ORACLE).first().total_rows == 2 * bars
    assert QUERIES["payload_rejects"](spark, SF_ORACLE).agg(F.sum("documents")).first()[0] > 0


def test_queries_leave_no_cache(spark):
    for name in ("process_date_reload", "clear_process_date", "append_load", "etl_relanded"):
        E.queries()[name](spark, "/root/testdata/sf0.001").count()
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()
