import datetime as dt

import pytest
from pyspark.sql import functions as F

from barsmith.operators.analytics import with_variation
from barsmith.session import work_table
from barsmith.sinks.jdbc import jdbc_write_options
from barsmith.sinks.tables import (
    append_table,
    clear_process_date,
    create_bars_table,
    reload_process_date,
    write_bucketed,
)
from barsmith.sinks.versions import partition_location
from barsmith.sources.jdbc import jdbc_read_options
from tests.conftest import plan_text

D = dt.date
SCHEMA = "symbol string, date_from date, open double, high double, low double, close double, volume double"


def sample(spark, n=3, symbol="A"):
    rows = [(symbol, D(2020, m, 1), 1.0, 2.0, 0.5, float(m), 10.0) for m in range(1, n + 1)]
    return with_variation(spark.createDataFrame(rows, SCHEMA))


def batch(spark, table, d):
    return spark.table(table).where(F.col("process_date") == d)


def test_create_is_idempotent(spark):
    t = work_table(spark, "t")
    create_bars_table(spark, t, buckets=4)
    create_bars_table(spark, t, buckets=4)
    assert spark.table(t).columns[-1] == "process_date"
    assert spark.table(t).count() == 0


def test_reload_replaces_one_batch_only(spark):
    t = work_table(spark, "t")
    create_bars_table(spark, t, buckets=4)
    reload_process_date(sample(spark, 3), t, "2023-07-11")
    reload_process_date(sample(spark, 2, "B"), t, "2023-07-12")
    reload_process_date(sample(spark, 1, "B"), t, "2023-07-12")
    assert batch(spark, t, "2023-07-11").count() == 3
    assert batch(spark, t, "2023-07-12").count() == 1
    # empty reload clears the batch, leaves the other one
    reload_process_date(sample(spark, 1).limit(0), t, "2023-07-12")
    assert batch(spark, t, "2023-07-12").count() == 0
    assert spark.table(t).count() == 3


def test_partition_filter_prunes(spark):
    t = work_table(spark, "t")
    create_bars_table(spark, t, buckets=4)
    reload_process_date(sample(spark, 3), t, "2023-07-11")
    plan = plan_text(batch(spark, t, "2023-07-11"))
    assert "PartitionFilters: [isnotnull(process_date" in plan


def test_clear_and_missing_batch(spark):
    t = work_table(spark, "t")
    create_bars_table(spark, t, buckets=4)
    reload_process_date(sample(spark, 3), t, "2023-07-11")
    reload_process_date(sample(spark, 2), t, "2023-07-12")
    clear_process_date(spark, t, "2023-07-12")
    clear_process_date(spark, t, "2023-07-12")
    assert spark.table(t).count() == 3


def test_bad_process_date_rejected(spark):
    with pytest.raises(ValueError):
        clear_process_date(spark, "x", "2023-07-11' OR '1'='1")


def test_append_twice_duplicates(spark):
    t = work_table(spark, "t")
    create_bars_table(spark, t, buckets=4)
    df = sample(spark, 3).withColumn("process_date", F.lit("2023-07-11"))
    append_table(df.select(*reversed(df.columns)), t)  # any column order
    append_table(df, t)
    assert spark.table(t).count() == 6


def test_bucketed_window_has_no_exchange(spark):
    t = work_table(spark, "b")
    write_bucketed(sample(spark, 4).drop("monthly_variation"), t, buckets=4)
    out = with_variation(spark.table(t))
    plan = plan_text(out)
    assert "Window" in plan and "Exchange" not in plan
    assert out.count() == 4


def test_loaded_table_window_has_no_exchange(spark):
    t = work_table(spark, "t")
    create_bars_table(spark, t, buckets=4)
    reload_process_date(sample(spark, 3), t, "2023-07-11")
    plan = plan_text(with_variation(batch(spark, t, "2023-07-11").drop("monthly_variation")))
    assert "Exchange" not in plan


def test_jdbc_options():
    w = jdbc_write_options("jdbc:x://h/db", "s.t", user="u", password="p", num_partitions=4)
    assert w["truncate"] == "true" and w["numPartitions"] == "4" and w["dbtable"] == "s.t"
    r = jdbc_read_options("jdbc:x://h/db", query="select * from t")
    assert r == {"url": "jdbc:x://h/db", "query": "select * from t"}
    p = jdbc_read_options("jdbc:x://h/db", table="t", partition_column="id",
                          lower_bound=0, upper_bound=100, num_partitions=8)
    assert p["partitionColumn"] == "id" and p["upperBound"] == "100"
    with pytest.raises(ValueError):
        jdbc_read_options("jdbc:x://h/db")
    with pytest.raises(ValueError):
        jdbc_read_options("jdbc:x://h/db", table="t", partition_column="id")


def test_bucket_aligned_load_writes_one_file_per_bucket(spark, landing):
    import glob
    import json

    from barsmith.plans.etl import run
    from barsmith.sinks.tables import table_buckets

    docs = [json.dumps({"symbol": f"S{i:03d}", "Monthly Time Series": {
        f"2020-{m:02d}-28": {"4. close": str(m)} for m in range(1, 13)}}) for i in range(40)]
    path = landing({})
    import os
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.json"), "w") as f:
        f.write("\n".join(docs))
    t = work_table(spark, "aligned")
    run(spark, path, t, "2023-07-11", buckets=4)
    assert table_buckets(spark, t) == 4
    loc = partition_location(spark, t, {"process_date": "2023-07-11"})
    files = glob.glob(loc.replace("file:", "") + "/*.parquet")
    assert 0 < len(files) <= 4 and spark.table(t).count() == 480


def test_bucket_count_equal_to_shuffle_partitions_stays_one_file_per_bucket(spark):
    import glob

    from barsmith.operators.transforms import cluster_by

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = [(f"S{i:03d}", D(2020, m, 1), 1.0, 2.0, 0.5, float(m), 10.0)
            for i in range(50) for m in range(1, 13)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert "REPARTITION_BY_COL" in plan_text(cluster_by(df, "symbol", n))
    assert "REPARTITION_BY_NUM" in plan_text(cluster_by(df, "symbol", n + 1))
    t = work_table(spark, "b")
    write_bucketed(df, t, buckets=n)
    loc = spark.sql(f"DESCRIBE TABLE EXTENDED {t}").where("col_name = 'Location'").first()[1]
    files = glob.glob(loc.replace("file:", "") + "/*.parquet")
    assert len(files) <= n and spark.table(t).count() == 600
    assert "Exchange" not in plan_text(with_variation(spark.table(t)))


def test_copied_rows_load_writes_few_files_per_task(spark, landing):
    import glob
    import json
    import os

    from barsmith.operators.analytics import with_variation as wv
    from barsmith.plans.etl import run

    docs = "\n".join(json.dumps({"symbol": f"S{i:03d}", "Monthly Time Series": {
        f"2020-{m:02d}-28": {"4. close": str(m)} for m in range(1, 13)}}) for i in range(40))
    roots = []
    for _ in range(2):  # the same landing twice: every row has a copy
        root = landing({})
        os.makedirs(root)
        with open(os.path.join(root, "part-0.json"), "w") as f:
            f.write(docs)
        roots.append(root)
    t = work_table(spark, "copied")
    rep = run(spark, roots, t, "2023-07-11", buckets=4)
    assert (rep.loaded_rows, rep.distinct_rows) == (960, 480)
    loc = partition_location(spark, t, {"process_date": "2023-07-11"})
    files = glob.glob(loc.replace("file:", "") + "/*.parquet")
    assert files
    k = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(files) <= k + 4  # hashing rows instead would allow k * 4
    df = spark.table(t).drop("monthly_variation", "process_date")
    assert "rangepartitioning" in plan_text(wv(df, collapse_copies=True, partitions=4)).lower()


def test_table_preview_and_cluster_for_table(spark):
    from barsmith.schema import BAR_COLUMNS
    from barsmith.sinks.tables import cluster_for_table
    from barsmith.sources.tables import table_preview

    t = work_table(spark, "t")
    create_bars_table(spark, t, buckets=3)
    assert tuple(spark.table(t).columns) == (*BAR_COLUMNS, "monthly_variation", "process_date")
    df = sample(spark, 5)
    assert "hashpartitioning(symbol" in plan_text(cluster_for_table(df, t)) and \
        ", 3)" in plan_text(cluster_for_table(df, t))
    reload_process_date(cluster_for_table(df, t), t, "2023-07-11")
    got = [r.date_from.month for r in table_preview(spark, t, 2, ["date_from"]).collect()]
    assert got == [1, 2]


def test_jdbc_calls_reach_the_jdbc_layer_without_a_database(spark):
    """No database is started: an unknown driver class must fail inside
    Spark's JDBC source/sink, showing the options were passed through."""
    from barsmith.sinks.jdbc import write_jdbc
    from barsmith.sources.jdbc import read_jdbc

    url = "jdbc:none://nowhere/db"
    with pytest.raises(Exception, match="no.such.Driver"):
        read_jdbc(spark, url, query="select 1", driver="no.such.Driver")
    with pytest.raises(Exception, match="no.such.Driver"):
        write_jdbc(sample(spark, 1), url, "t", mode="overwrite", driver="no.such.Driver")
    with pytest.raises(ValueError):
        write_jdbc(sample(spark, 1), url, "t", mode="upsert")


def test_plain_bars_table_appends_typed_bars(spark, landing):
    """Typed bars without variation or process date, appended row for row."""
    from barsmith.operators.transforms import normalize
    from barsmith.schema import BARS_DDL, BAR_COLUMNS
    from barsmith.sources.payloads import ingest_payloads

    doc = ('{"Monthly Time Series": {"2023-05-31": {"1. open": "1", "2. high": "2", '
           '"3. low": "0.5", "4. close": "1.5", "5. volume": "10"}}}')
    raw, _ = ingest_payloads(spark, landing({"IBM": [doc]}))
    t = work_table(spark, "plain")
    create_bars_table(spark, t, buckets=2, ddl=BARS_DDL, partitioned=False)
    append_table(raw.transform(normalize), t)
    append_table(raw.transform(normalize), t)  # re-running appends again
    assert tuple(spark.table(t).columns) == BAR_COLUMNS
    assert spark.table(t).count() == 2


def test_symbol_series_on_loaded_table_reads_one_bucket(spark):
    from barsmith.operators.analytics import symbol_series

    t = work_table(spark, "pruned")
    create_bars_table(spark, t, buckets=8)
    df = spark.createDataFrame(
        [(f"S{i:03d}", D(2020, m, 1), 1.0, 2.0, 0.5, float(m), 10.0) for i in range(20) for m in (1, 2)],
        SCHEMA)
    reload_process_date(with_variation(df, partitions=8), t, "2023-07-11")

    def one():
        return symbol_series(spark.table(t).where(F.col("process_date") == "2023-07-11"), "S007")

    # Default: Spark drops a bucketed scan no join/aggregate needs, and with it
    # bucket pruning; the filter still reaches the scan.
    assert "EqualTo(symbol,S007)" in plan_text(one()) and one().count() == 2
    key = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(key, "false")
    try:
        plan = plan_text(one())
        assert "SelectedBucketsCount: 1 out of 8" in plan
        assert "PartitionFilters: [isnotnull(process_date" in plan
        assert one().count() == 2
    finally:
        spark.conf.unset(key)


def test_per_symbol_aggregate_on_loaded_table_has_no_exchange(spark):
    from barsmith.operators.analytics import symbol_extremes

    t = work_table(spark, "agg")
    create_bars_table(spark, t, buckets=4)
    reload_process_date(with_variation(sample(spark, 6), partitions=4), t, "2023-07-11")
    out = symbol_extremes(spark.table(t).where(F.col("process_date") == "2023-07-11"))
    plan = plan_text(out)
    assert "Exchange" not in plan and "Bucketed: true" in plan
    r = out.first()
    assert (r.max_close, r.min_close) == (6.0, 1.0)


def test_failed_reload_keeps_the_old_batch(spark):
    from barsmith.functions.columns import as_double

    t = work_table(spark, "atomic")
    create_bars_table(spark, t, buckets=4)
    reload_process_date(sample(spark, 2), t, "2023-07-11")
    bad = sample(spark, 2).withColumn("close", as_double(F.lit("oops")))
    for clustered in (False, True):  # failing before and inside the write stage
        with pytest.raises(Exception, match="malformed number"):
            reload_process_date(bad, t, "2023-07-11", clustered=clustered)
        assert batch(spark, t, "2023-07-11").count() == 2
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    reload_process_date(sample(spark, 2).limit(0), t, "2023-07-11")
    assert spark.table(t).count() == 0


def test_unclustered_loads_write_one_file_per_bucket(spark):
    import glob

    rows = [(f"S{i:03d}", D(2020, m, 1), 1.0, 2.0, 0.5, float(m), 10.0) for i in range(50) for m in range(1, 13)]
    df = with_variation(spark.createDataFrame(rows, SCHEMA)).repartition(16)
    for load in (lambda t: append_table(df.withColumn("process_date", F.lit("2023-07-11")), t),
                 lambda t: reload_process_date(df, t, "2023-07-11")):
        t = work_table(spark, "few")
        create_bars_table(spark, t, buckets=8)
        load(t)
        loc = partition_location(spark, t, {"process_date": "2023-07-11"})
        assert 0 < len(glob.glob(loc.replace("file:", "") + "/*.parquet")) <= 8
        assert spark.table(t).count() == 600
