"""Randomized checks of the operators against a pure-Python model."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from barsmith.operators.analytics import with_variation
from barsmith.operators.quality import duplicate_check

closes = st.one_of(st.none(), st.sampled_from([0.0, 1.0, 2.5, 10.0, 15.0]))
bar = st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(1, 6), closes)
bars = st.lists(st.tuples(bar, st.integers(1, 4)), min_size=1, max_size=12)

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def model_variation(rows):
    """Window semantics over the repeated rows, ordered by (date, close)."""
    out = []
    for sym in {r[0] for r in rows}:
        series = sorted((r for r in rows if r[0] == sym),
                        key=lambda r: (r[1], r[2] is not None, r[2] or 0.0))
        for i, r in enumerate(series):
            p = series[i - 1][2] if i else None
            v = None if (p is None or r[2] is None or p == 0) else (r[2] - p) / p * 100
            out.append((sym, r[1], r[2], v))
    return sorted(out, key=str)


@SETTINGS
@given(bars, st.sampled_from([1, 2, 100_000]))
def test_copies_variation_matches_model(spark, spec, chunk_rows):
    rows = [(s, m, c) for (s, m, c), k in spec for _ in range(k)]
    df = spark.createDataFrame(
        [(s, dt.date(2020, m, 1), c) for s, m, c in rows], "symbol string, date_from date, close double")
    got = with_variation(df, collapse_copies=True, chunk_rows=chunk_rows).collect()
    got = sorted(((r.symbol, r.date_from.month, r.close, r.monthly_variation) for r in got), key=str)
    assert got == model_variation(rows)


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 2)),
                          st.one_of(st.none(), st.sampled_from(["x", "y"]))), max_size=15))
def test_duplicate_check_matches_model(spark, rows):
    df = spark.createDataFrame(rows, "a int, b string")
    r = duplicate_check(df).first()
    assert (r.total_rows, r.distinct_rows, r.has_duplicates) == (
        len(rows), len(set(rows)), len(rows) != len(set(rows)))


entries = st.lists(st.tuples(st.sampled_from(["2020-01-31", "2020-02-29", "2020-03-31", "2021-01-29"]),
                             st.integers(0, 999)), min_size=1, max_size=10)


@SETTINGS
@given(st.lists(entries, min_size=1, max_size=4))
def test_repeated_dates_keep_last_entry_like_a_json_parser(spark, docs):
    import json
    import os

    from barsmith.session import scratch_path
    from barsmith.sources.payloads import ingest_payloads

    root = scratch_path(spark, "prop")
    os.makedirs(root)
    lines, expected = [], set()
    for d, doc in enumerate(docs):
        sym = f"S{d}"
        body = ", ".join(f'"{k}": {{"4. close": "{v}"}}' for k, v in doc)
        lines.append(f'{{"symbol": "{sym}", "Monthly Time Series": {{{body}}}}}')
        parsed = json.loads(lines[-1])["Monthly Time Series"]  # a dict keeps the last value
        last_pos = {k: i for i, (k, _) in enumerate(doc)}
        expected |= {(sym, k, v["4. close"], last_pos[k]) for k, v in parsed.items()}
    with open(os.path.join(root, "part-0.json"), "w") as f:
        f.write("\n".join(lines))
    raw, _ = ingest_payloads(spark, root)
    got = {(r.symbol, r.date_from, r.close, r.pos) for r in raw.collect()}
    assert got == expected


doc_entries = st.lists(st.tuples(st.sampled_from(["2020-01-31", "2020-02-29", "2020-03-31"]),
                                 st.sampled_from([0.0, 1.0, 2.0, 4.0])), min_size=1, max_size=4)
document = st.one_of(
    st.tuples(st.sampled_from(["A", "B"]), doc_entries),
    st.tuples(st.sampled_from(["A", "B"]), st.none()),  # notice only: rejected
)
landings = st.lists(st.lists(document, min_size=1, max_size=3), min_size=1, max_size=3)


def model_load(all_landings):
    """Rows kept by the ETL and their variation, in plain Python."""
    rows = []
    for landing in all_landings:
        for sym, entries in landing:
            if entries is None:
                continue
            for date, close in dict(entries).items():  # a dict keeps the last entry
                rows.append((sym, date, close))
    out = []
    for sym in sorted({r[0] for r in rows}):
        series = sorted(r for r in rows if r[0] == sym)  # by date, then value
        for i, (s, d, c) in enumerate(series):
            p = series[i - 1][2] if i else None
            out.append((s, d, c, None if p in (None, 0.0) else (c - p) / p * 100))
    return sorted(out, key=str)


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(landings)
def test_etl_run_matches_model(spark, all_landings):
    import json
    import os

    from barsmith.plans.etl import run
    from barsmith.session import scratch_path, work_table

    if not any(e is not None for landing in all_landings for _, e in landing):
        return  # nothing accepted: run() refuses, covered elsewhere
    roots = []
    for landing in all_landings:
        root = scratch_path(spark, "prop-etl")
        os.makedirs(root)
        lines = []
        for sym, entries in landing:
            if entries is None:
                lines.append(json.dumps({"symbol": sym, "Note": "x"}))
            else:
                body = ", ".join(f'"{d}": {{"4. close": "{c}", "5. volume": "1"}}' for d, c in entries)
                lines.append(f'{{"symbol": "{sym}", "Monthly Time Series": {{{body}}}}}')
        with open(os.path.join(root, "part-0.json"), "w") as f:
            f.write("\n".join(lines))
        roots.append(root)
    t = work_table(spark, "prop")
    run(spark, roots, t, "2023-07-11", buckets=2)
    got = sorted(((r.symbol, r.date_from.isoformat(), r.close, r.monthly_variation)
                  for r in spark.table(t).collect()), key=str)
    assert got == model_load(all_landings)


closes_nan = st.one_of(st.none(), st.just(float("nan")), st.sampled_from([1.0, 2.0, 3.0]))
series_rows = st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(1, 9), closes_nan),
                       min_size=1, max_size=12, unique_by=lambda r: (r[0], r[1]))


@SETTINGS
@given(series_rows)
def test_symbol_extremes_match_first_occurrence_in_newest_first_order(spark, rows):
    import math

    from barsmith.operators.analytics import symbol_extremes

    df = spark.createDataFrame([(s, dt.date(2020, m, 1), c) for s, m, c in rows],
                               "symbol string, date_from date, close double")
    got = {r.symbol: (r.max_date and r.max_date.month, r.max_close,
                      r.min_date and r.min_date.month, r.min_close)
           for r in symbol_extremes(df).collect()}
    for sym in {r[0] for r in rows}:
        # a newest-first series; idxmax/idxmin skip NaN and take the first occurrence
        series = sorted(((m, c) for s, m, c in rows if s == sym), reverse=True)
        valid = [(m, c) for m, c in series if c is not None and not math.isnan(c)]
        if valid:
            hi = max(valid, key=lambda x: x[1])  # max() keeps the first of equal keys
            lo = min(valid, key=lambda x: x[1])
            expected = (hi[0], hi[1], lo[0], lo[1])
        else:
            expected = (None, None, None, None)
        assert got[sym] == expected


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 1000)),
                min_size=1, max_size=15, unique_by=lambda r: (r[0], r[1])))
def test_last_per_key_matches_model(spark, rows):
    from barsmith.operators.quality import last_per_key

    df = spark.createDataFrame(rows, "k int, ord int, v int")
    got = sorted(tuple(r) for r in last_per_key(df, ["k"], ["ord"]).collect())
    expected = sorted(max((r for r in rows if r[0] == k), key=lambda r: r[1])
                      for k in {r[0] for r in rows})
    assert got == expected
