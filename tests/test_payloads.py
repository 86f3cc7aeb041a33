import datetime as dt
import json

from barsmith.operators.transforms import normalize
from barsmith.sources.payloads import (
    explode_series,
    ingest_payloads,
    read_payloads,
    split_payloads,
)
from tests.conftest import plan_text

# The F1 sample: a pretty-printed document, newest entry first.
F1 = """{"Monthly Time Series": {
   "2023-05-31": {"1. open": "126.3500", "2. high": "130.0700", "3. low": "120.5500",
                  "4. close": "128.5900", "5. volume": "95710890"},
   "2023-04-28": {"1. open": "130.9700", "2. high": "132.6100", "3. low": "124.5600",
                  "4. close": "126.4100", "5. volume": "83664114"}}}"""


def test_wholetext_document(spark, landing):
    path = landing({"IBM": [F1]})
    raw, rej = ingest_payloads(spark, path, wholetext=True)
    rows = sorted(raw.collect(), key=lambda r: r.date_from)
    assert [(r.symbol, r.date_from, r.close, r.pos) for r in rows] == [
        ("IBM", "2023-04-28", "126.4100", 1),
        ("IBM", "2023-05-31", "128.5900", 0),
    ]
    assert rej.count() == 0
    typed = raw.transform(normalize).orderBy("date_from").collect()
    assert typed[0].date_from == dt.date(2023, 4, 28) and typed[0].volume == 83664114.0


def test_duplicate_key_keeps_last_entry(spark, landing):
    doc = ('{"Monthly Time Series": {"2023-05-31": {"4. close": "1"}, '
           '"2023-04-28": {"4. close": "2"}, "2023-05-31": {"4. close": "3"}}}')
    raw, _ = ingest_payloads(spark, landing({"A": [doc]}))
    got = {r.date_from: (r.close, r.pos) for r in raw.collect()}
    assert got == {"2023-05-31": ("3", 2), "2023-04-28": ("2", 1)}


def test_missing_field_is_null(spark, landing):
    doc = '{"Monthly Time Series": {"2023-05-31": {"1. open": "1"}}}'
    raw, _ = ingest_payloads(spark, landing({"A": [doc]}))
    r = raw.first()
    assert r.open == "1" and r.close is None


def test_rejects(spark, landing):
    path = landing({
        "OK": ['{"Monthly Time Series": {"2023-05-31": {"4. close": "1"}}}'],
        "NOTE": ['{"Note": "x"}'],
        "TRUNC": ['{"Monthly'],
        "EMPTY": ['{"Monthly Time Series": {}}'],
    })
    raw, rej = ingest_payloads(spark, path)
    assert {r.symbol for r in raw.collect()} == {"OK"}
    reasons = {r.symbol: (r.reason, r.value) for r in rej.collect()}
    assert reasons == {
        "NOTE": ("missing_series", None),
        "TRUNC": ("malformed_json", '{"Monthly'),
        "EMPTY": ("empty_series", None),
    }


def test_json_lines_rejects(spark, landing):
    import os
    lines = "\n".join([
        json.dumps({"symbol": "A", "Monthly Time Series": {"2020-01-31": {"4. close": "1"}}}),
        json.dumps({"Monthly Time Series": {"2020-01-31": {"4. close": "2"}}}),
        json.dumps({"symbol": "B", "Monthly Time Series": "oops"}),
        '{"symbol": "C", "Monthly',
    ])
    path = landing({})
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.json"), "w") as f:
        f.write(lines)
    raw, rej = ingest_payloads(spark, path)
    assert [(r.symbol, r.close) for r in raw.collect()] == [("A", "1")]
    got = sorted((str(r.symbol), r.reason) for r in rej.collect())
    assert got == [("B", "malformed_json"), ("None", "malformed_json"), ("None", "missing_symbol")]


def test_json_lines_many_documents_per_file(spark, landing):
    lines = "\n".join(
        json.dumps({"Monthly Time Series": {f"20{y}-01-31": {"4. close": str(y)}}})
        for y in (10, 11, 12)
    )
    raw, _ = ingest_payloads(spark, landing({"A": [lines], "B": [lines + "\n\n"]}))
    assert raw.count() == 6


def test_numeric_symbol_stays_text(spark, landing):
    path = landing({"0001": ['{"Monthly Time Series": {"2023-05-31": {"4. close": "1"}}}']})
    raw, _ = ingest_payloads(spark, path)
    assert raw.first().symbol == "0001"


def test_symbol_filter_prunes_folders(spark, landing):
    doc = '{"Monthly Time Series": {"2023-05-31": {"4. close": "1"}}}'
    path = landing({"A": [doc], "B": [doc], "C": [doc]})
    df = read_payloads(spark, path, symbols=["B"])
    plan = plan_text(df)
    assert "PartitionFilters: [isnotnull(symbol" in plan and " = B)]" in plan
    raw = explode_series(split_payloads(df)[0])
    assert [r.symbol for r in raw.collect()] == ["B"]


def test_explode_has_no_inlined_sort_filter(spark, landing):
    doc = '{"Monthly Time Series": {"2023-05-31": {"4. close": "1"}}}'
    raw = explode_series(read_payloads(spark, landing({"A": [doc]})))
    plan = plan_text(raw)
    # the sort runs once per document: only in the projection feeding Generate
    assert plan.count("sort_array(") == 1 and "lambda left" not in plan


def test_symbol_filter_pushed_into_json_lines_scan(spark, landing):
    lines = "\n".join(
        json.dumps({"symbol": s, "Monthly Time Series": {"2020-01-31": {"4. close": "1"}}})
        for s in ("A", "B", "C"))
    path = landing({})
    import os
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.json"), "w") as f:
        f.write(lines)
    df = read_payloads(spark, path, symbols=["B", "C"])
    assert "PushedFilters: [In(symbol, [B,C])]" in plan_text(df)
    raw = explode_series(df)
    assert sorted(r.symbol for r in raw.collect()) == ["B", "C"]


def test_raw_and_reject_schemas(spark, landing):
    from barsmith.schema import RAW_SCHEMA

    path = landing({"A": ['{"Monthly Time Series": {"2023-05-31": {"4. close": "1"}}}'],
                    "N": ['{"Note": "x"}']})
    raw, rej = ingest_payloads(spark, path)
    assert raw.schema.simpleString() == RAW_SCHEMA.simpleString()
    assert rej.columns == ["symbol", "reason", "value"]


def test_null_series_and_array_of_documents(spark, landing):
    array_doc = json.dumps([
        {"Monthly Time Series": {"2020-01-31": {"4. close": "1"}}},
        {"Monthly Time Series": {"2020-02-28": {"4. close": "2"}}},
    ], indent=2)
    path = landing({"A": [array_doc], "N": ['{"Monthly Time Series": null}']})
    raw, rej = ingest_payloads(spark, path, wholetext=True)
    assert sorted((r.date_from, r.close) for r in raw.collect()) == [("2020-01-31", "1"), ("2020-02-28", "2")]
    assert [(r.symbol, r.reason) for r in rej.collect()] == [("N", "missing_series")]


def test_symbols_needing_escapes_round_trip_through_folders(spark):
    import datetime as dt

    from barsmith.plans.fixtures import land_payloads
    from barsmith.session import scratch_path

    bars = spark.createDataFrame(
        [(s, dt.date(2020, 1, 31), 1.0, 2.0, 0.5, 1.5, 10.0) for s in ("BRK.B", "^GSPC", "A/B")],
        "symbol string, date_from date, open double, high double, low double, close double, volume double")
    path = land_payloads(bars, scratch_path(spark, "esc"), notice_every=None, symbol_folders=True)
    raw, rej = ingest_payloads(spark, path)
    assert sorted(r.symbol for r in raw.collect()) == ["A/B", "BRK.B", "^GSPC"]
    assert rej.count() == 0


def test_one_large_document_is_processed_whole(spark, landing):
    """20,000 entries in one pretty-printed document, a quarter repeated:
    every entry is read and the sort-based dedupe stays fast."""
    import datetime as dt
    import time

    base = dt.date(1000, 1, 1)
    dates = [(base + dt.timedelta(days=i)).isoformat() for i in range(15_000)]
    entries = [(d, str(i)) for i, d in enumerate(dates)] + [(dates[i], f"r{i}") for i in range(5_000)]
    body = ",\n".join(f'  "{d}": {{"4. close": "{c}"}}' for d, c in entries)
    path = landing({"BIG": ['{"Monthly Time Series": {\n' + body + "\n}}"]})
    t0 = time.time()
    raw, _ = ingest_payloads(spark, path, wholetext=True)
    rows = raw.collect()
    assert time.time() - t0 < 60
    assert len(rows) == 15_000
    last = {d: c for d, c in entries}
    assert all(r.close == last[r.date_from] for r in rows)


def test_bad_entry_is_rejected_alone(spark, landing):
    """A valid document with one bad month keeps its good one."""
    doc = ('{"Monthly Time Series": {"2023-05-31": {"4. close": "1"}, "2023-04-28": "oops", '
           '"2023-03-31": [1], "2023-02-28": {"4. close": "2"}}}')
    only_bad = '{"Monthly Time Series": {"2023-05-31": 7}}'
    raw, rej = ingest_payloads(spark, landing({"A": [doc], "B": [only_bad]}))
    assert sorted((r.symbol, r.date_from, r.close) for r in raw.collect()) == [
        ("A", "2023-02-28", "2"), ("A", "2023-05-31", "1")]
    assert sorted(tuple(r) for r in rej.collect()) == [
        ("A", "malformed_entry", "2023-03-31: [1]"), ("A", "malformed_entry", "2023-04-28: oops"),
        ("B", "malformed_entry", "2023-05-31: 7")]


def test_bad_entry_in_json_lines_with_symbol_filter(spark, landing):
    import os
    lines = [json.dumps({"symbol": s, "Monthly Time Series": {"2020-01-31": {"4. close": "1"}, "2020-02-29": "x"}})
             for s in ("A", "B")] + ['{"symbol": "A", "Monthly']
    path = landing({})
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.json"), "w") as f:
        f.write("\n".join(lines))
    for symbols, want in ((None, ["A", "B"]), (["A"], ["A"])):
        raw, rej = ingest_payloads(spark, path, symbols=symbols)
        assert sorted(r.symbol for r in raw.collect()) == want
        # rejects are the same with and without a filter
        assert sorted(r.reason for r in rej.collect()) == ["malformed_entry", "malformed_entry", "malformed_json"]


def test_hash_folders_round_trip(spark):
    import datetime as dt

    from barsmith.plans.fixtures import land_payloads
    from barsmith.session import drop_path, scratch_path

    bars = spark.createDataFrame(
        [(f"S{i:06d}", dt.date(2020, 1, 31), 1.0, 2.0, 0.5, 1.5, 10.0) for i in range(200)],
        "symbol string, date_from date, open double, high double, low double, close double, volume double")
    path = land_payloads(bars, scratch_path(spark, "hash"), hash_folders=4)
    import os
    assert sorted(d for d in os.listdir(path.replace("file:", "")) if "=" in d) == [f"part={i}" for i in range(4)]
    raw, rej = ingest_payloads(spark, path)
    assert raw.count() == 200 and raw.select("symbol").distinct().count() == 200
    assert rej.count() == 20  # the notices come on top of the series
    drop_path(spark, path)
    assert not os.path.exists(path.replace("file:", ""))
