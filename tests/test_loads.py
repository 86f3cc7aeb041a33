"""Repeatable and incremental loads: versions, ledger, intake, states, drift, spread lag."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from barsmith.operators.analytics import previous_over_ranges, symbol_extremes, with_previous_close, with_variation
from barsmith.operators.transforms import expand_copies
from barsmith.plans.states import drop_states, merge_states, refresh_states, symbol_states
from barsmith.session import scratch_path, work_table
from barsmith.sinks import tables
from barsmith.sinks.ledger import append_once, missing_rows
from barsmith.sinks.ranged import ranged_files, read_ranged, write_ranged
from barsmith.sinks.tables import append_table, clear_process_date, create_bars_table, reload_process_date
from barsmith.sinks.versions import (
    partition_location, partition_spec, publish_version, table_layout, vacuum_versions, versions, write_version,
)
from barsmith.sources.drift import drift_report, landed_fields, read_documents_as_variants
from barsmith.sources.payloads import explode_series, ingest_payloads, split_payloads
from barsmith.streaming.intake import intake, intake_files, read_intake
from tests.conftest import plan_text

D = dt.date
SCHEMA = "symbol string, date_from date, open double, high double, low double, close double, volume double"
D1, D2 = "2023-07-11", "2023-07-12"


def bars(spark, n=3, symbol="A", close=1.0):
    rows = [(symbol, D(2020, 1, 1) + dt.timedelta(days=31 * m), 1.0, 2.0, 0.5, close * m, 10.0) for m in range(1, n + 1)]
    return with_variation(spark.createDataFrame(rows, SCHEMA))


@pytest.fixture()
def table(spark):
    t = work_table(spark, "t")
    create_bars_table(spark, t, buckets=4)
    return t


def rows_of(df):
    return sorted((tuple(str(v) for v in r) for r in df.collect()))


# --------------------------------------------------------------------------- versions


def test_a_driver_killed_before_publishing_leaves_the_old_batch(spark, table, monkeypatch):
    reload_process_date(bars(spark, 3), table, D1)
    before, where = rows_of(spark.table(table)), partition_location(spark, table, {"process_date": D1})

    def killed(*a):
        raise KeyboardInterrupt("driver gone")

    monkeypatch.setattr(tables, "publish_version", killed)
    with pytest.raises(KeyboardInterrupt):
        reload_process_date(bars(spark, 2, "B"), table, D1)
    with pytest.raises(KeyboardInterrupt):  # a batch that was not there before stays absent
        reload_process_date(bars(spark, 2, "B"), table, D2)
    spark.catalog.refreshTable(table)
    assert rows_of(spark.table(table)) == before
    assert partition_location(spark, table, {"process_date": D1}) == where
    assert partition_location(spark, table, {"process_date": D2}) is None
    monkeypatch.undo()
    reload_process_date(bars(spark, 2, "B"), table, D1)  # the next run is not disturbed
    assert spark.table(table).count() == 2


def test_the_old_version_stays_readable_for_readers_that_hold_it(spark, table):
    reload_process_date(bars(spark, 3), table, D1)
    old = partition_location(spark, table, {"process_date": D1})
    reload_process_date(bars(spark, 1), table, D1)
    assert spark.table(table).count() == 1 and spark.read.parquet(old).count() == 3


def test_vacuum_spares_the_published_the_kept_and_the_young(spark, table):
    p = {"process_date": D1}
    for n in (1, 2, 3, 4):
        reload_process_date(bars(spark, n), table, D1)
    write_version(bars(spark, 9), table, p)  # a load still under way
    assert len(versions(spark, table, p)) == 5
    assert vacuum_versions(spark, table, p, keep=0) == []  # all are young
    gone = vacuum_versions(spark, table, p, keep=2, older_than_hours=0)
    assert len(gone) == 2 and len(versions(spark, table, p)) == 3
    vacuum_versions(spark, table, p, keep=0, older_than_hours=0)
    assert len(versions(spark, table, p)) == 1 and spark.table(table).count() == 4
    assert vacuum_versions(spark, table, {"process_date": "1999-01-01"}) == []


def test_versions_keep_the_tables_buckets_and_order(spark, table):
    many = spark.range(400).select(F.concat(F.lit("S"), F.col("id") % 50).alias("symbol"),
                                   F.expr("date_add(DATE'2020-01-01', cast(id as int))").alias("date_from"),
                                   *[F.col("id").cast("double").alias(m) for m in ("open", "high", "low", "close", "volume")])
    reload_process_date(with_variation(many), table, D1)
    layout = table_layout(spark, table)
    assert (layout.buckets, layout.bucket_columns, layout.sort_columns) == (4, ("symbol",), ("date_from",))
    folder = partition_location(spark, table, {"process_date": D1}).replace("file:", "")
    assert 0 < len([f for f in os.listdir(folder) if f.endswith(".parquet")]) <= 4
    out = with_variation(spark.table(table).drop("monthly_variation"))
    plan = plan_text(out.where(F.col("process_date") == D1))
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert not [t.name for t in spark.catalog.listTables("barsmith_work") if t.name.startswith("barsmith_stage")]


def test_appends_go_to_the_published_version(spark, table):
    reload_process_date(bars(spark, 2), table, D1)
    append_table(bars(spark, 3, "B").withColumn("process_date", F.lit(D1)), table)
    assert spark.table(table).where(F.col("process_date") == D1).count() == 5


def test_unbucketed_tables_and_odd_partition_values(spark):
    t = work_table(spark, "odd")
    spark.sql(f"CREATE TABLE {t} (x INT, kind STRING, day STRING) USING parquet PARTITIONED BY (kind, day)")
    p = {"kind": "it's / a=b", "day": D1}
    publish_version(spark, t, p, write_version(spark.range(3).select(F.col("id").cast("int").alias("x")), t, p))
    assert partition_spec(p).count("\\'") == 1
    assert {(r.kind, r.day) for r in spark.table(t).collect()} == {("it's / a=b", D1)} and spark.table(t).count() == 3


# --------------------------------------------------------------------------- append once


def test_rerunning_an_append_adds_nothing(spark, table):
    ledger = work_table(spark, "ledger")
    first = append_once(bars(spark, 5), table, D1, ledger)
    again = append_once(bars(spark, 5), table, D1, ledger)
    assert (first.added, first.compared, again.added, again.compared) == (5, True, 0, False)
    more = append_once(bars(spark, 5).union(bars(spark, 2, "B")), table, D1, ledger)
    assert (more.rows, more.added) == (7, 2)
    assert append_once(bars(spark, 5), table, D2, ledger).added == 5  # another batch is another load
    assert spark.table(table).count() == 12


def test_a_half_published_append_is_completed(spark, table):
    """As after a driver that died while its committer moved files: some rows are there, the ledger knows nothing."""
    whole, ledger = bars(spark, 6).union(bars(spark, 6)), work_table(spark, "ledger")
    append_table(whole.where("close < 3").withColumn("process_date", F.lit(D1)), table)
    assert append_once(whole, table, D1, ledger).added == 8
    assert rows_of(spark.table(table).drop("process_date")) == rows_of(whole)


def test_a_ledger_entry_does_not_hide_a_cleared_batch(spark, table):
    ledger = work_table(spark, "ledger")
    append_once(bars(spark, 4), table, D1, ledger)
    clear_process_date(spark, table, D1)
    assert append_once(bars(spark, 4), table, D1, ledger).added == 4


def test_copies_nulls_and_nans_count_as_rows(spark):
    nan = float("nan")
    df = spark.createDataFrame([(None, nan), (None, nan), ("a", None), ("a", 1.0), ("a", 1.0), ("a", 1.0)], "k string, v double")
    held = spark.createDataFrame([(None, nan), ("a", 1.0), ("b", 2.0)], "k string, v double")
    assert rows_of(missing_rows(df, held)) == sorted([("None", "nan"), ("a", "None"), ("a", "1.0"), ("a", "1.0")])
    assert missing_rows(df, df).count() == 0 and rows_of(missing_rows(df, held.limit(0))) == rows_of(df)


def test_hot_copies_expand_in_chunks(spark):
    df = spark.createDataFrame([("a", 25_000), ("b", 1), ("c", 10)], "k string, n long")
    out = expand_copies(df, "n", chunk_rows=1000)
    assert {r.k: r["count"] for r in out.groupBy("k").count().collect()} == {"a": 25_000, "b": 1, "c": 10}
    per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) > 2 and max(per_task) < 15_000


def test_an_append_to_an_unpartitioned_batch_column(spark):
    t, ledger = work_table(spark, "plain"), work_table(spark, "ledger")
    spark.sql(f"CREATE TABLE {t} (x INT, day STRING, source STRING) USING parquet")
    df = spark.range(4).select(F.col("id").cast("int").alias("x"))
    for source in ("a", "b", "a"):
        append_once(df, t, {"day": D1, "source": source}, ledger)
    assert spark.table(t).count() == 8


# --------------------------------------------------------------------------- spread lag


def test_spread_lag_equals_the_window(spark):
    rnd = random.Random(4)
    rows = [("hot" if i % 3 else rnd.choice(["a", None, "b", "c"]), D(2020, 1, 1) + dt.timedelta(days=rnd.randrange(700)),
             *[float(rnd.randrange(5)) if rnd.random() < .9 else None for _ in range(5)]) for i in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA)
    order = ["date_from", "open", "high", "low", "close", "volume"]
    from pyspark.sql import Window

    plain = df.withColumn("p", F.lag("close").over(Window.partitionBy("symbol").orderBy(*order)))
    for n in (1, 3, 40):
        assert rows_of(previous_over_ranges(df, "close", "p", "symbol", "date_from", ranges=n)) == rows_of(plain)
    distinct = df.dropDuplicates(["symbol", "date_from"])
    assert rows_of(distinct.transform(with_variation, spread=True)) == rows_of(distinct.transform(with_variation))
    assert rows_of(distinct.transform(with_previous_close, spread=True)) == rows_of(distinct.transform(with_previous_close))


def test_spread_variation_over_copies_equals_the_window(spark):
    rows = [("hot", D(2020, 1, 1) + dt.timedelta(days=i % 200), 1.0, 2.0, 0.5, float(i % 7), 10.0) for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    plain = rows_of(df.transform(with_variation, collapse_copies=True))
    assert rows_of(df.transform(with_variation, collapse_copies=True, spread=True)) == plain
    aligned = df.transform(with_variation, collapse_copies=True, spread=True, partitions=4)
    assert rows_of(aligned) == plain


def test_one_symbol_spreads_over_all_ranges(spark):
    """No task sorts or holds a whole symbol: the only exchanges by symbol alone carry border rows."""
    df = spark.range(40_000).select(
        F.lit("hot").alias("symbol"), F.expr("date_add(DATE'1900-01-01', cast(id as int))").alias("date_from"), F.col("id").cast("double").alias("close"))
    out = previous_over_ranges(df, "close", "p", ranges=16)
    assert out.where("p <> close - 1 OR (p IS NULL AND close > 0)").count() == 0
    root = [f for f in out.inputFiles()]
    sizes = sorted(spark.read.parquet(f).count() for f in set(root))
    assert len(sizes) == 16 and sizes[-1] < 3 * 40_000 / 16
    assert "hashpartitioning(symbol" not in plan_text(out).split("Window")[0]


def test_spread_lag_of_an_empty_frame(spark):
    assert previous_over_ranges(spark.createDataFrame([], SCHEMA), "close", "p").collect() == []


def test_run_with_spread_loads_the_same_batch(spark, landing):
    from barsmith.plans.etl import run

    doc = json.dumps({"Monthly Time Series": {f"2020-{m:02d}-28": {"4. close": str(m * m % 7)} for m in range(1, 13)}})
    path = landing({"A": [doc], "B": [doc, doc]})
    got = []
    for spread in (False, True):
        t = work_table(spark, "spread")
        run(spark, path, t, D1, buckets=4, spread=spread)
        got.append(rows_of(spark.table(t)))
    assert got[0] == got[1] and len(got[0]) == 36


# --------------------------------------------------------------------------- intake


def doc(symbol, *months, close="1", **more):
    series = {f"2020-{m:02d}-28": {"1. open": "1", "4. close": close} for m in months}
    return json.dumps({"symbol": symbol, "Monthly Time Series": series, **more})


def land(root, day, *lines):
    os.makedirs(f"{root}/{day}", exist_ok=True)
    with open(f"{root}/{day}/part-{len(os.listdir(f'{root}/{day}'))}.json", "w") as f:
        f.write("\n".join(lines))


def test_two_runs_over_a_growing_landing_equal_one_run(spark):
    root, target = scratch_path(spark, "growing").replace("file:", ""), scratch_path(spark, "intake")
    land(root, "day1", doc("A", 1, 2), doc("B", 1), '{"symbol": "N", "Note": "x"}')
    one = intake(spark, root, target)
    land(root, "day1", doc("C", 5))  # a late file in an old folder
    land(root, "day2", doc("A", 3), '{"symbol": "D", "Monthly Time Series": {"2020-01-28": "no"}}', "{broken")
    two = intake(spark, root, target)
    three = intake(spark, root, target)
    assert (one.documents, two.documents, three.documents) == (3, 4, 0)
    assert intake_files(spark, target).count() == 3
    accepted, rejected = split_payloads(read_intake(spark, target))
    every, bad = ingest_payloads(spark, [f"{root}/day1", f"{root}/day2"])
    assert rows_of(explode_series(accepted)) == rows_of(every) and rows_of(rejected) == rows_of(bad)
    assert {r.reason for r in rejected.collect()} == {"missing_series", "malformed_entry", "malformed_json"}


def test_a_run_that_died_before_its_commit_is_replayed_once(spark):
    root, target = scratch_path(spark, "growing").replace("file:", ""), scratch_path(spark, "intake")
    land(root, "day1", doc("A", 1, 2))
    intake(spark, root, target)
    land(root, "day2", doc("B", 1))
    intake(spark, root, target)
    commits = f"{target}_ledger/commits".replace("file:", "")
    for name in os.listdir(commits):
        if name.lstrip(".").startswith("1"):  # the second batch's commit is lost; its files are planned again
            os.remove(f"{commits}/{name}")
    intake(spark, root, target)
    assert sorted(r.symbol for r in read_intake(spark, target).collect()) == ["A", "B"]


def test_a_long_history_is_taken_in_several_batches(spark):
    root, target = scratch_path(spark, "growing").replace("file:", ""), scratch_path(spark, "intake")
    for i in range(5):
        land(root, f"day{i}", doc(f"S{i}", 1))
    got = intake(spark, root, target, max_files=2)
    assert (got.batches, got.documents) == (3, 5) and read_intake(spark, target).count() == 5


# --------------------------------------------------------------------------- states


def test_states_after_reloads_equal_a_recomputation(spark, table):
    rnd, states = random.Random(9), work_table(spark, "states")

    def some(n):
        return with_variation(spark.createDataFrame([
            (rnd.choice("ABC"), D(2020, 1, 1) + dt.timedelta(days=i * 5 + rnd.randrange(5)), 1.0, 1.0, 1.0,
             rnd.choice([None, float("nan"), 1.0, 2.0, 3.0]), 1.0) for i in range(n)], SCHEMA))

    for d in (D1, D2, "2023-07-13", D2, D1):
        reload_process_date(some(rnd.randrange(1, 40)), table, d)
        refresh_states(spark, table, states, d)
    merged = merge_states(spark.table(states))
    assert rows_of(merged) == rows_of(symbol_states(spark.table(table)))
    extremes = merged.select("symbol", "max_date", "max_close", "min_date", "min_close")
    assert rows_of(extremes) == rows_of(symbol_extremes(spark.table(table)))
    clear_process_date(spark, table, D2)
    drop_states(spark, states, D2)
    drop_states(spark, states, D2)
    assert rows_of(merge_states(spark.table(states))) == rows_of(symbol_states(spark.table(table)))


def test_a_refresh_reads_one_batch_and_an_empty_batch_clears(spark, table):
    states = work_table(spark, "states")
    reload_process_date(bars(spark, 3), table, D1)
    reload_process_date(bars(spark, 3, "B"), table, D2)
    for d in (D1, D2):
        refresh_states(spark, table, states, d)
    plan = plan_text(symbol_states(spark.table(table).where(F.col("process_date") == D1)))
    assert "PartitionFilters: [isnotnull(process_date" in plan and "Exchange" not in plan  # bucketed by symbol
    reload_process_date(bars(spark, 1).limit(0), table, D2)
    refresh_states(spark, table, states, D2)
    assert [r.symbol for r in merge_states(spark.table(states)).collect()] == ["A"]


# --------------------------------------------------------------------------- range layout


def test_a_symbol_read_opens_the_files_that_hold_it(spark):
    rows = [(f"S{i:03d}", D(2020, 1, 1) + dt.timedelta(days=k), float(k)) for i in range(40) for k in range(25)]
    rows += [("S017", D(2021, 1, 1) + dt.timedelta(days=k), float(k)) for k in range(2000)] + [(None, None, 1.0), ("S001", None, 2.0)]
    df = spark.createDataFrame(rows, "symbol string, date_from date, close double")
    path = write_ranged(df, scratch_path(spark, "ranged"), files=20)
    assert ranged_files(spark, path).count() == 20
    whole = spark.read.parquet(f"{path}/data")
    assert rows_of(whole) == rows_of(df)
    for symbol, start, end in (("S001", None, None), ("S017", "2022-01-01", "2022-01-31"), ("S017", None, "2020-01-05"),
                               ("S039", "2020-01-20", None), ("S017", None, None), ("none", None, None)):
        got = read_ranged(spark, path, symbol, start, end)
        want = df.where(F.col("symbol") == symbol)
        want = want.where(F.col("date_from") >= start) if start else want
        want = want.where(F.col("date_from") <= end) if end else want
        assert rows_of(got) == rows_of(want), (symbol, start, end)
    assert len(read_ranged(spark, path, "S001").inputFiles()) <= 2
    assert len(read_ranged(spark, path, "S017", "2022-01-01", "2022-01-31").inputFiles()) <= 2
    assert len(read_ranged(spark, path, "S017").inputFiles()) > 5  # a hot symbol is spread


def test_a_read_of_very_many_files_scans_the_folder(spark, monkeypatch):
    from barsmith.sinks import ranged

    monkeypatch.setattr(ranged, "NAMED_FILES", 2)
    df = spark.createDataFrame([("A", D(2020, 1, 1) + dt.timedelta(days=k), float(k)) for k in range(100)], "symbol string, date_from date, close double")
    path = write_ranged(df, scratch_path(spark, "ranged"), files=6)
    assert rows_of(read_ranged(spark, path, "A", "2020-01-02")) == rows_of(df.where("date_from >= '2020-01-02'"))


def test_profile_of_every_kind_of_column(spark):
    from barsmith.sources.tables import profile

    df = spark.createDataFrame([(1, None, [1], {"a": 1}, D(2020, 1, 2)), (3, "x", None, {"b": 2}, None), (2, "y", [], None, D(2019, 1, 2))],
                               "n int, `odd name` string, a array<int>, m map<string,int>, d date")
    got = [tuple(r) for r in profile(df).collect()]
    assert got == [(0, "n", "int", 3, 0, "1", "3"), (1, "odd name", "string", 2, 1, "x", "y"), (2, "a", "array<int>", 2, 1, None, None),
                   (3, "m", "map<string,int>", 2, 1, None, None), (4, "d", "date", 2, 1, "2019-01-02", "2020-01-02")]
    assert [r.non_null for r in profile(df.limit(0)).collect()] == [0] * 5
    assert plan_text(profile(df)).count("partial_count") >= 1


# --------------------------------------------------------------------------- drift


def test_drift_of_odd_documents(spark):
    root = scratch_path(spark, "drift").replace("file:", "")
    land(f"{root}/a", "x", doc("A", 1, 2), "{broken", "[1]", "", '{"Monthly Time Series": {"d": 3, "e": {"4. close": null}}}')
    land(f"{root}/b", "x", '{"symbol": 7, "Monthly Time Series": [1], "extra": {"a": 1}, "flag": true}')
    got = {(r.landing, r.level, r.field, r.status, r.type): r.occurrences
           for r in drift_report(landed_fields(read_documents_as_variants(spark, {"a": f"{root}/a", "b": f"{root}/b"}))).collect()}
    assert got[("a", "document", None, "malformed", None)] == 2
    assert got[("a", "document", "symbol", "missing", None)] == 1
    assert got[("a", "entry", None, "malformed", None)] == 1
    assert got[("a", "entry", "4. close", "retyped", "NULL")] == 1 and got[("a", "entry", "4. close", "expected", "STRING")] == 2
    assert got[("a", "entry", "5. volume", "missing", None)] == 3
    assert got[("b", "document", "symbol", "retyped", "NUMBER")] == 1
    assert got[("b", "document", "Monthly Time Series", "retyped", "ARRAY")] == 1
    assert got[("b", "document", "extra", "new", "OBJECT")] == 1 and got[("b", "document", "flag", "new", "BOOLEAN")] == 1
    with pytest.raises(ValueError):
        read_documents_as_variants(spark, {})
