"""Hypothesis properties against plain-Python models of the reference's
step-by-step behaviour."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from equiframe.plans.ingest import stock_info_merge
from equiframe.sources.sinks import upsert_partial

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
D0 = dt.date(2023, 1, 2)

rows = st.lists(st.tuples(st.sampled_from(["s1", "s2", "s3"]), st.integers(0, 5),
                          st.sampled_from(["A", "B", "C"]), st.sampled_from(["P", "Q", None])),
                min_size=1, max_size=25)


def _daily_fold(existing, batch):
    """The reference: one landed day at a time, merge with what is stored,
    keep the first-seen row per attribute set, save the day's new rows."""
    stored = list(existing)
    saved = []
    for day in sorted({r[1] for r in batch}):
        merged, seen = [], set()
        for r in stored + [r for r in batch if r[1] == day]:
            attrs = (r[0], r[2], r[3])
            if attrs not in seen:
                seen.add(attrs)
                merged.append(r)
        new = [r for r in merged if r[1] == day]
        saved += new
        stored += new
    return sorted(saved, key=str)


@SETTINGS
@given(rows)
def test_one_job_merge_equals_daily_fold(spark, raw):
    days = [(s, D0 + dt.timedelta(days=d), nm, mk) for s, d, nm, mk in raw]
    first_day = min(r[1] for r in days)
    existing_raw = [r for r in days if r[1] == first_day]
    # the stored table is itself first-seen (one row per attribute set)
    existing, seen = [], set()
    for r in existing_raw:
        if (r[0], r[2], r[3]) not in seen:
            seen.add((r[0], r[2], r[3]))
            existing.append(r)
    batch = [r for r in days if r[1] != first_day]
    schema = "sym_cd string, info_update date, sym_nm string, mkt_cd string"
    got = stock_info_merge(spark.createDataFrame(existing, schema), spark.createDataFrame(batch, schema))
    assert sorted([tuple(r) for r in got.collect()], key=str) == _daily_fold(existing, batch)


kv = st.dictionaries(st.integers(0, 30), st.tuples(st.one_of(st.none(), st.integers(-5, 5)),
                                                   st.one_of(st.none(), st.integers(-5, 5))), max_size=15)
src = st.dictionaries(st.integers(0, 30), st.one_of(st.none(), st.integers(-5, 5)), max_size=15)


@SETTINGS
@given(kv, src)
def test_partial_upsert_matches_dict_model(spark, target, source):
    t = spark.createDataFrame([(k, a, b) for k, (a, b) in target.items()], "k int, a int, b int")
    s = spark.createDataFrame([(k, b) for k, b in source.items()], "k int, b int")
    model = {k: (a, b) for k, (a, b) in target.items()}
    for k, b in source.items():
        model[k] = (model.get(k, (None, None))[0], b)
    got = {r.k: (r.a, r.b) for r in upsert_partial(t, s, ["k"]).collect()}
    assert got == model


series = st.lists(st.tuples(st.integers(1, 60), st.one_of(st.none(), st.floats(0.9, 1.1))),
                  min_size=1, max_size=40, unique_by=lambda r: r[0])


@SETTINGS
@given(series, st.integers(1, 8), st.integers(1, 20))
def test_blocked_rolling_matches_dense_product(spark, rows, n, block):
    from math import isclose, prod

    from equiframe.operators.windows import rolling
    df = spark.createDataFrame([("k", t, g) for t, g in rows], "k string, t int, g double")
    got = {r.t: r.r for r in rolling(df, "g", {"r": n}, ["k"], "t", block=block).collect()}
    vals = dict(rows)
    for t in vals:
        window = [vals.get(u) for u in range(t - n + 1, t + 1)]
        want = None if any(v is None for v in window) else prod(window)
        assert (want is None) == (got[t] is None)
        if want is not None:
            assert isclose(want, got[t], rel_tol=1e-12)


dated = st.lists(st.tuples(st.integers(0, 200), st.one_of(st.none(), st.floats(0.5, 2.0))),
                 min_size=1, max_size=30, unique_by=lambda r: r[0])


@SETTINGS
@given(dated, st.integers(1, 50))
def test_blocked_suffix_product_matches_brute_force(spark, rows, block_days):
    from math import isclose, prod

    from equiframe.operators.windows import suffix_product
    df = spark.createDataFrame([("k", D0 + dt.timedelta(days=d), r, float(d)) for d, r in rows],
                               "k string, d date, r double, c double")
    got = {r.d: (r.f, r.last) for r in
           suffix_product(df, "r", ["k"], "d", "f", {"last": "c"}, block_days=block_days).collect()}
    ordered = sorted(rows)
    for i, (d, _) in enumerate(ordered):
        later = [r for _, r in ordered[i + 1:]]
        want = None if any(v is None for v in later) else prod(later)
        f, last = got[D0 + dt.timedelta(days=d)]
        assert last == float(ordered[-1][0])
        assert (want is None) == (f is None)
        if want is not None:
            assert isclose(want, f, rel_tol=1e-12)


@SETTINGS
@given(st.lists(st.integers(0, 300), min_size=1, max_size=30), st.lists(st.integers(-20, 300), max_size=8),
       st.integers(1, 60))
def test_blocked_as_of_matches_brute_force(spark, lefts, rights, block_days):
    from equiframe.operators.windows import as_of_latest
    left = spark.createDataFrame([("k", D0 + dt.timedelta(days=d)) for d in lefts], "k string, d date")
    right = spark.createDataFrame([("k", D0 + dt.timedelta(days=d)) for d in rights], "k string, v date")
    got = sorted((r.d, r.v) for r in as_of_latest(left, right, ["k"], "d", "v", "v", block_days).collect())
    want = sorted((D0 + dt.timedelta(days=d),
                   max((D0 + dt.timedelta(days=v) for v in rights if v <= d), default=None)) for d in lefts)
    assert got == want
