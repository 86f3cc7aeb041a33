import datetime as dt

import pytest

from barsmith.operators.analytics import (
    symbol_extremes,
    symbol_list,
    symbol_series,
    with_previous_close,
    with_variation,
)
from barsmith.operators.quality import drop_duplicates, duplicate_check, last_per_key
from barsmith.functions.columns import pct_change
from barsmith.operators.analytics import windowed_copies
from barsmith.operators.transforms import long_to_wide, tag, union_all, wide_to_long
from barsmith.sources.tables import preview, schema_rows
from tests.conftest import plan_text

D = dt.date


def bars(spark, rows, schema="symbol string, date_from date, close double"):
    return spark.createDataFrame(rows, schema)


def test_first_month_null_and_growth(spark):
    df = bars(spark, [("A", D(2020, 1, 31), 10.0), ("A", D(2020, 2, 29), 15.0)])
    got = [r.monthly_variation for r in with_variation(df).orderBy("date_from").collect()]
    assert got == [None, 50.0]


def test_zero_and_null_previous_close(spark):
    df = bars(spark, [("A", D(2020, 1, 31), 0.0), ("A", D(2020, 2, 29), 5.0),
                      ("B", D(2020, 1, 31), None), ("B", D(2020, 2, 29), 5.0)])
    got = {(r.symbol, r.date_from.month): r.monthly_variation for r in with_variation(df).collect()}
    assert got == {("A", 1): None, ("A", 2): None, ("B", 1): None, ("B", 2): None}


def test_interleaved_symbols(spark):
    rows = [("B", D(2020, 2, 29), 4.0), ("A", D(2020, 2, 29), 3.0),
            ("B", D(2020, 1, 31), 2.0), ("A", D(2020, 1, 31), 1.0)]
    out = with_previous_close(bars(spark, rows)).collect()
    got = {(r.symbol, r.date_from.month): r.prev_close for r in out}
    assert got == {("A", 1): None, ("A", 2): 1.0, ("B", 1): None, ("B", 2): 2.0}


def test_one_window_node(spark):
    df = bars(spark, [("A", D(2020, 1, 31), 10.0)])
    assert plan_text(with_variation(df)).count("Window (") == 1


def test_duplicates_with_null(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    r = duplicate_check(df).first()
    assert (r.total_rows, r.distinct_rows, r.has_duplicates) == (3, 2, True)
    assert drop_duplicates(df).count() == 2


def test_no_duplicates_and_empty(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x")], "a int, b string")
    assert duplicate_check(df).first().has_duplicates is False
    r = duplicate_check(df.limit(0)).first()
    assert (r.total_rows, r.distinct_rows, r.has_duplicates) == (0, 0, False)


def test_duplicate_check_is_one_job_with_partial_aggregation(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    plan = plan_text(duplicate_check(df))
    assert "partial_count" in plan and "partial_sum" in plan


def test_last_per_key(spark):
    df = spark.createDataFrame([("A", 1, "old"), ("A", 2, "new"), ("B", 1, "only")],
                               "k string, pos int, v string")
    got = {r.k: r.v for r in last_per_key(df, ["k"], ["pos"]).collect()}
    assert got == {"A": "new", "B": "only"}


def test_extremes_ties_and_nan(spark):
    rows = [("A", D(2020, 1, 31), 5.0), ("A", D(2020, 2, 29), 5.0),
            ("A", D(2020, 3, 31), 1.0), ("A", D(2020, 4, 30), 1.0),
            ("A", D(2020, 5, 31), float("nan")), ("A", D(2020, 6, 30), None),
            ("N", D(2020, 1, 31), float("nan"))]
    got = {r.symbol: r for r in symbol_extremes(bars(spark, rows)).collect()}
    a = got["A"]
    # ties go to the latest date (first in a newest-first series); NaN skipped
    assert (a.max_date, a.max_close, a.min_date, a.min_close) == (D(2020, 2, 29), 5.0, D(2020, 4, 30), 1.0)
    n = got["N"]
    assert (n.max_date, n.max_close, n.min_date, n.min_close) == (None, None, None, None)


def test_extremes_tie_smallest_pos(spark):
    rows = [("A", D(2020, 1, 31), 5.0, 3), ("A", D(2020, 2, 29), 5.0, 7),
            ("A", D(2020, 3, 31), 1.0, 9), ("A", D(2020, 4, 30), 1.0, 2)]
    df = spark.createDataFrame(rows, "symbol string, date_from date, close double, pos int")
    r = symbol_extremes(df, tie="pos").first()
    assert (r.max_date, r.min_date) == (D(2020, 1, 31), D(2020, 4, 30))


def test_symbol_list_and_series(spark):
    rows = [("B", D(2020, 1, 31), 1.0), ("A", D(2020, 1, 31), 2.0), ("A", D(2020, 2, 29), 3.0)]
    df = bars(spark, rows)
    assert sorted(r.symbol for r in symbol_list(df).collect()) == ["A", "B"]
    got = symbol_series(df, "A").orderBy("date_from").collect()
    assert [(r.date_from, r.close) for r in got] == [(D(2020, 1, 31), 2.0), (D(2020, 2, 29), 3.0)]


def test_union_by_name_reordered_and_missing(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2)], "b string, a int")
    c = spark.createDataFrame([(3,)], "a int")
    got = sorted(tuple(r) for r in union_all([a, b, c]).collect())
    assert got == [(1, "x"), (2, "y"), (3, None)]
    with pytest.raises(ValueError):
        union_all([])


def test_tag(spark):
    out = tag(spark.createDataFrame([("1",)], "close string"), "symbol", "IBM")
    assert out.columns == ["close", "symbol"] and tuple(out.first()) == ("1", "IBM")


def test_long_to_wide_needs_one_exchange(spark):
    long = spark.createDataFrame([("A", "open", 1.0)], "symbol string, field string, value double")
    assert plan_text(long_to_wide(long, ["symbol"], ["open", "close"])).count("Exchange (") <= 1


def test_union_of_ranges_keeps_undated_bars_and_scans_once(spark, tmp_path):
    import datetime as dt

    from barsmith.plans.catalogue import q_union_symbols

    rows = [(1, 1, 1, d, 2.0, 10.0, 1) for d in
            (dt.datetime(1995, 1, 3), dt.datetime(1998, 1, 3), dt.datetime(2001, 1, 3), None)]
    spark.createDataFrame(
        rows, "l_orderkey long, l_partkey long, l_suppkey long, l_shipdate timestamp_ntz, l_quantity double, "
        "l_extendedprice double, l_linenumber long").write.parquet(f"{tmp_path}/lineitem.parquet")
    out = q_union_symbols(spark, str(tmp_path))
    assert sorted((str(r.date_from), r.batch) for r in out.collect()) == [
        ("1995-01-03", "early"), ("1998-01-03", "middle"), ("2001-01-03", "late"), ("None", "early")]
    plan = plan_text(out)
    assert "FileScan" not in plan and "Scan parquet" not in plan and "Exchange" not in plan


def test_wide_long_round_trip(spark):
    df = spark.createDataFrame([("A", D(2020, 1, 31), 1.0, 2.0), ("B", D(2020, 1, 31), 3.0, None)],
                               "symbol string, date_from date, open double, close double")
    long = wide_to_long(df, ["symbol", "date_from"], ["open", "close"])
    assert long.count() == 4
    back = long_to_wide(long, ["symbol", "date_from"], ["open", "close"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_preview_needs_order(spark):
    df = spark.range(100)
    assert [r.id for r in preview(df, 3, ["id"]).collect()] == [0, 1, 2]
    assert "TakeOrderedAndProject" in plan_text(preview(df, 3, ["id"]))
    with pytest.raises(ValueError):
        preview(df, 3)


def test_schema_rows(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    got = [tuple(r) for r in schema_rows(spark, df).collect()]
    assert got == [(0, "a", "int", True), (1, "b", "string", True)]


@pytest.mark.parametrize("chunk_rows", [1, 2, 100_000])
def test_variation_over_copies_equals_plain_window(spark, chunk_rows):
    rows = ([("A", D(2020, 1, 31), 10.0)] * 3 + [("A", D(2020, 2, 29), 15.0)] * 2
            + [("A", D(2020, 3, 31), 0.0)] * 2 + [("A", D(2020, 4, 30), 5.0)]
            + [("B", D(2020, 1, 31), None)] * 2 + [("B", D(2020, 2, 29), 4.0)])
    df = bars(spark, rows)
    got = sorted(
        ((r.symbol, r.date_from, r.close, r.monthly_variation)
         for r in with_variation(df, collapse_copies=True, chunk_rows=chunk_rows).collect()),
        key=str)
    plain = sorted(((r.symbol, r.date_from, r.close, r.monthly_variation)
                    for r in with_variation(df).collect()), key=str)
    assert got == plain
    assert len(got) == len(rows)
    assert sorted(r[3] for r in got if r[0] == "A" and r[3] is not None) == [-100.0, 0.0, 0.0, 0.0, 50.0]


def test_variation_over_copies_aggregates_before_window(spark):
    df = bars(spark, [("A", D(2020, 1, 31), 10.0)])
    plan = plan_text(windowed_copies(df, "close", "symbol", "date_from", None, pct_change))
    # partial count runs before the first exchange; the window sees distinct rows
    assert plan.index("partial_count") > plan.index("Window (")
    assert "Generate" in plan_text(with_variation(df, collapse_copies=True))


@pytest.mark.parametrize("partitions", [None, 4])
def test_hot_copy_group_is_expanded_across_tasks(spark, partitions):
    """One row repeated as a third of the input is not emitted by one task."""
    from pyspark.sql import functions as F

    hot = spark.range(30_000).select(F.lit("HOT").alias("symbol"),
                                     F.lit(D(2020, 1, 31)).alias("date_from"),
                                     F.lit(1.0).alias("close"))
    rest = spark.range(60_000).select(F.concat(F.lit("S"), (F.col("id") % 500).cast("string")).alias("symbol"),
                                      F.date_add(F.lit(D(2000, 1, 31)), (F.col("id") / 500).cast("int")).alias("date_from"),
                                      F.col("id").cast("double").alias("close"))
    out = with_variation(hot.unionByName(rest), collapse_copies=True, chunk_rows=1_000,
                         partitions=partitions)
    per_task = (out.where("symbol = 'HOT'").groupBy(F.spark_partition_id().alias("p")).count()
                .collect())
    assert sum(r["count"] for r in per_task) == 30_000
    assert len(per_task) >= 4 and max(r["count"] for r in per_task) <= 15_000
    assert out.count() == 90_000


@pytest.mark.parametrize("partitions", [None, 4])
def test_symbol_with_many_copied_rows_is_expanded_across_tasks(spark, partitions):
    """Each row copied below the chunk size, but the symbol's total is hot."""
    from pyspark.sql import functions as F

    hot = spark.range(30_000).select(
        F.lit("HOT").alias("symbol"),
        F.date_add(F.lit(D(2000, 1, 31)), (F.col("id") % 100).cast("int")).alias("date_from"),
        (F.col("id") % 100).cast("double").alias("close"))
    out = with_variation(hot, collapse_copies=True, chunk_rows=1_000, partitions=partitions)
    per_task = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in per_task) == 30_000
    assert max(r["count"] for r in per_task) <= 15_000


def test_copies_are_collapsed_before_the_shuffle(spark):
    """30,000 copies of one row: the partial aggregate ships a handful of rows."""
    from pyspark.sql import functions as F

    from tests.conftest import executed_nodes

    hot = spark.range(0, 30_000, 1, 8).select(F.lit(1).alias("a"), F.lit("x").alias("b"))
    other = spark.range(0, 100, 1, 8).select(F.col("id").cast("int").alias("a"), F.lit("y").alias("b"))
    nodes = executed_nodes(duplicate_check(hot.unionByName(other)))
    partial = [rows for name, rows in nodes if name == "HashAggregate" and rows is not None]
    # every aggregate's output is far below the 30,100 input rows
    assert partial and max(partial) <= 16 * 101


def test_hot_supplier_is_reduced_before_the_shuffle(spark):
    """A supplier with a third of all lines leaves each task as one row per month."""
    from pyspark.sql import functions as F

    from barsmith.plans.fixtures import bars_from_lineitem
    from tests.conftest import SF_SMALL, executed_nodes

    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    hot = (li.where(F.col("l_orderkey") % 3 == 0).withColumn("l_suppkey", F.lit(1))
           .repartition(8))
    n_in = hot.count()
    months = hot.select(F.trunc(F.to_date("l_shipdate"), "MM")).distinct().count()
    nodes = executed_nodes(bars_from_lineitem(hot))
    aggs = [rows for name, rows in nodes if name == "SortAggregate"]
    partial_out, final_out = max(aggs), min(aggs)
    assert final_out == months
    assert partial_out <= 8 * months < n_in  # shuffled: per task one row per month


def test_both_copy_branches_read_the_windowed_checkpoint(spark):
    """With copies present, both branches read one checkpoint: the scan, the
    copy aggregate, the sort and the window run once."""
    rows = [("A", D(2020, m, 1), float(m)) for m in range(1, 7)] * 2 + [("B", D(2020, 1, 1), 1.0)]
    out = with_variation(bars(spark, rows), collapse_copies=True, partitions=4)
    assert out.count() == 13
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Window" not in final and "Aggregate" not in final and "ExistingRDD" in final


@pytest.mark.parametrize("chunk_rows", [1, 100_000])
def test_previous_close_over_copies_equals_plain_window(spark, chunk_rows):
    rows = ([("A", D(2020, 1, 31), 10.0)] * 3 + [("A", D(2020, 2, 29), 15.0)] * 2
            + [("B", D(2020, 1, 31), None)] * 2 + [("B", D(2020, 2, 29), 4.0)])
    df = bars(spark, rows)
    key = lambda r: (r.symbol, r.date_from, str(r.close), str(r.prev_close))
    got = sorted(map(key, with_previous_close(df, collapse_copies=True, chunk_rows=chunk_rows,
                                              partitions=2).collect()))
    plain = sorted(map(key, with_previous_close(df).collect()))
    assert got == plain and len(got) == len(rows)


@pytest.mark.parametrize("copies", [False, True])
def test_window_outputs_replace_existing_columns(spark, copies):
    df = bars(spark, [("A", D(2020, 1, 31), 10.0), ("A", D(2020, 2, 29), 15.0)])
    twice = with_variation(with_variation(df), collapse_copies=copies)
    assert twice.columns == ["symbol", "date_from", "close", "monthly_variation"]
    prev = with_previous_close(with_previous_close(df), collapse_copies=copies)
    assert prev.columns.count("prev_close") == 1
    assert sorted(str(r.monthly_variation) for r in twice.collect()) == ["50.0", "None"]
