import pytest
from pyspark.sql import functions as F

from barsmith.plans.etl import resolve_process_date, run
from barsmith.session import work_table
from tests.conftest import plan_text

DOC_A = ('{"Monthly Time Series": {"2023-05-31": {"1. open": "1", "2. high": "2", "3. low": "0.5", '
         '"4. close": "15", "5. volume": "100"}, "2023-04-28": {"1. open": "1", "2. high": "2", '
         '"3. low": "0.5", "4. close": "10", "5. volume": "90"}}}')


def test_resolve_process_date(spark):
    today = spark.sql("SELECT date_format(current_date(), 'yyyy-MM-dd')").first()[0]
    assert resolve_process_date(spark, None) == today
    assert resolve_process_date(spark, "2023-07-11") == "2023-07-11"


def test_process_date_follows_the_clock_of_the_session_zone(spark):
    """One instant, two sessions' zones: today is the zone's own date."""
    instant = F.timestamp_seconds(F.lit(1689118200))  # 2023-07-11 23:30 UTC
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z, day in (("UTC", "2023-07-11"), ("Europe/Berlin", "2023-07-12"), ("America/Lima", "2023-07-11")):
            spark.conf.set("spark.sql.session.timeZone", z)
            assert resolve_process_date(spark, None, instant) == day
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert resolve_process_date(spark, "2020-01-02", instant) == "2020-01-02"


def test_run_loads_batch_and_rejects(spark, landing):
    path = landing({"A": [DOC_A], "N": ['{"Note": "x"}']})
    t, r = work_table(spark, "bars"), work_table(spark, "rejects")
    rep = run(spark, path, t, "2023-07-11", buckets=2, reject_table=r)
    assert (rep.loaded_rows, rep.distinct_rows, rep.has_duplicates, rep.rejected_documents) == (2, 2, False, 1)
    got = spark.table(t).orderBy("date_from").collect()
    assert [x.monthly_variation for x in got] == [None, 50.0]
    assert {x.process_date for x in got} == {"2023-07-11"}
    # rerun for the same date replaces the batch rather than appending
    rep2 = run(spark, path, t, "2023-07-11", buckets=2, reject_table=r)
    assert rep2.loaded_rows == 2 and spark.table(t).count() == 2
    assert spark.table(r).count() == 1


def test_run_null_date_means_today(spark, landing):
    path = landing({"A": [DOC_A]})
    t = work_table(spark, "bars")
    days = {str(spark.sql("SELECT current_date()").first()[0])}  # the run may cross midnight
    rep = run(spark, path, t, None, buckets=2)
    assert rep.process_date in days | {str(spark.sql("SELECT current_date()").first()[0])}
    assert spark.table(t).where(F.col("process_date") == rep.process_date).count() == 2


def test_run_all_bad_raises_and_keeps_table(spark, landing):
    good = landing({"A": [DOC_A]})
    bad = landing({"N": ['{"Note": "x"}']})
    t = work_table(spark, "bars")
    run(spark, good, t, "2023-07-11", buckets=2)
    rejects = work_table(spark, "rejects")
    with pytest.raises(ValueError, match="no accepted payload"):
        run(spark, bad, t, "2023-07-11", buckets=2, reject_table=rejects)
    assert spark.table(t).count() == 2
    # the rejects that explain it were written first
    assert [(r.symbol, r.reason) for r in spark.table(rejects).collect()] == [("N", "missing_series")]


def test_run_parses_once_and_windows_once(spark, landing, monkeypatch):
    """Both outputs come from one checkpointed parse; one Sort + Window feeds both copy branches."""
    from barsmith.operators import analytics
    from barsmith.plans import etl

    reads, windows = [], []
    parse, window = etl.read_payloads, analytics.windowed_copies
    monkeypatch.setattr(etl, "read_payloads", lambda *a, **k: reads.append(1) or parse(*a, **k))
    monkeypatch.setattr(analytics, "windowed_copies", lambda *a: windows.append(window(*a)) or windows[-1])
    t, r = work_table(spark, "bars"), work_table(spark, "rejects")
    run(spark, landing({"A": [DOC_A], "N": ['{"Note": "x"}']}), t, "2023-07-11", buckets=2, reject_table=r)
    assert len(reads) == len(windows) == 1
    assert plan_text(windows[0]).count("Window [") <= 1
    raw = etl.explode_series(etl.split_payloads(parse(spark, landing({"A": [DOC_A]})))[0])
    plan = plan_text(etl.transform(raw))
    assert "Window" not in plan and "Scan json" not in plan  # both branches read the checkpoint


def test_run_strict_fails_on_malformed_number(spark, landing):
    doc = '{"Monthly Time Series": {"2023-05-31": {"4. close": "x"}}}'
    t = work_table(spark, "bars")
    with pytest.raises(Exception, match="malformed number"):
        run(spark, landing({"A": [doc]}), t, "2023-07-11", buckets=2)
    run(spark, landing({"A": [doc]}), t, "2023-07-11", buckets=2, strict=False)
    assert spark.table(t).first().close is None


def test_round_trip_through_landed_files(spark):
    """bars -> payload documents on disk -> ingest -> normalize == bars."""
    from barsmith.operators.transforms import normalize
    from barsmith.plans.fixtures import bars_from_lineitem, land_payloads
    from barsmith.session import scratch_path
    from barsmith.sources.payloads import ingest_payloads
    from tests.conftest import SF_SMALL

    bars = bars_from_lineitem(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet"))
    for folders in (False, True):
        path = land_payloads(bars, scratch_path(spark, "rt"), notice_every=None,
                             symbol_folders=folders)
        raw, rej = ingest_payloads(spark, path)
        back = raw.transform(normalize)
        assert rej.count() == 0
        assert back.count() == bars.count() == 826
        assert back.exceptAll(bars).count() == 0 and bars.exceptAll(back).count() == 0


def test_run_reports_copies_across_landings(spark, landing):
    """Two landings of the same document: rows kept, duplicates reported."""
    day1, day2 = landing({"A": [DOC_A]}), landing({"A": [DOC_A]})
    t = work_table(spark, "bars")
    rep = run(spark, [day1, day2], t, "2023-07-11", buckets=2)
    assert (rep.loaded_rows, rep.distinct_rows, rep.has_duplicates) == (4, 2, True)
    got = sorted(((r.date_from.month, r.monthly_variation) for r in spark.table(t).collect()),
                 key=lambda x: (x[0], x[1] is not None, x[1] or 0.0))
    # April: first month twice (NULL, then 0 vs its twin); May: +50% then 0
    assert got == [(4, None), (4, 0.0), (5, 0.0), (5, 50.0)]


def test_command_line_run(spark, landing, capsys):
    import json as _json

    from barsmith.__main__ import main

    t = work_table(spark, "cli")
    assert main(["run", "--payloads", landing({"A": [DOC_A]}), "--table", t,
                 "--process-date", "2023-07-11", "--buckets", "2"]) == 0
    out = _json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["loaded_rows"] == 2 and out["process_date"] == "2023-07-11"


def test_run_symbol_subset_and_whole_files(spark, landing):
    pretty = DOC_A.replace(", ", ",\n    ")  # one document over many lines
    path = landing({"A": [pretty], "B": [pretty]})
    t = work_table(spark, "bars")
    rep = run(spark, path, t, "2023-07-11", buckets=2, symbols=["B"], wholetext=True)
    assert rep.loaded_rows == 2
    assert {r.symbol for r in spark.table(t).collect()} == {"B"}


def test_strict_run_fails_on_landed_text_volume_lenient_keeps_rows(spark):
    from barsmith.plans.fixtures import bars_from_lineitem, land_payloads
    from barsmith.session import scratch_path
    from tests.conftest import SF_SMALL

    bars = bars_from_lineitem(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet"))
    path = land_payloads(bars, scratch_path(spark, "na"), notice_every=None,
                         malformed_volume_from=200.0)
    t = work_table(spark, "na")
    with pytest.raises(Exception, match="malformed number: 'n/a'"):
        run(spark, path, t, "2023-07-11", buckets=2)
    rep = run(spark, path, t, "2023-07-11", buckets=2, strict=False)
    assert rep.loaded_rows == 826
    n_null = spark.table(t).where("volume IS NULL").count()
    assert n_null == bars.where("volume >= 200").count() > 0
