"""Merge operators against a brute-force model on random inputs."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tributary.operators.merge import first_per_key, insert_if_absent, latest_per_key, upsert

T0 = dt.datetime(2000, 1, 1)
T1 = dt.datetime(2030, 1, 1)
keys = st.sampled_from(["hot", "a", "b", "c", "d"])
vals = st.one_of(st.none(), st.integers(-3, 3))
versions = st.lists(st.tuples(keys, vals, st.integers(0, 3), vals), max_size=25)


def _rank(v):
    return (0,) if v is None else (1, v)


def _best(rows, newest):
    # Spark orders structs field by field with NULL lowest.
    pick = max if newest else min
    return pick(rows, key=lambda r: tuple(_rank(x) for x in r))


def model_pick(rows, newest):
    by = {}
    for k, amount, v, extra in rows:
        by.setdefault(k, []).append((v, amount, extra))
    return {k: _best(rs, newest) for k, rs in by.items()}


def _df(spark, rows):
    return spark.createDataFrame(rows, "k string, amount int, v int, extra int")


@settings(max_examples=12, deadline=None)
@given(versions)
def test_latest_and_first_match_model(spark, rows):
    df = _df(spark, rows)
    for newest, fn in ((True, latest_per_key), (False, first_per_key)):
        got = {r["k"]: (r["v"], r["amount"], r["extra"]) for r in fn(df, ["k"], ["v"]).collect()}
        assert got == model_pick(rows, newest)


@settings(max_examples=10, deadline=None)
@given(st.dictionaries(keys, vals, max_size=5), versions, st.booleans())
def test_upsert_matches_model(spark, target, changes, broadcast):
    trows = [(k, a, 0, 0, T0) for k, a in target.items()]
    tdf = spark.createDataFrame(trows, "k string, amount int, v int, extra int, stamp timestamp_ntz")
    out = upsert(tdf, _df(spark, changes), ["k"], ["v"], audit_col="stamp",
                 stamp=F.lit(T1).cast("timestamp_ntz"), broadcast_changes=broadcast)
    got = {r["k"]: (r["amount"], r["v"], r["extra"], r["stamp"]) for r in out.collect()}
    latest = model_pick(changes, True)
    want = {k: (a, 0, 0, T0) for k, a in target.items()}
    for k, (v, amount, extra) in latest.items():
        want[k] = (amount, v, extra, T0 if k in target else T1)
    assert got == want


@settings(max_examples=10, deadline=None)
@given(st.sets(keys, max_size=4), versions)
def test_insert_if_absent_matches_model(spark, existing, batch):
    edf = spark.createDataFrame([(k,) for k in existing], "k string")
    got = {r["k"]: (r["v"], r["amount"], r["extra"])
           for r in insert_if_absent(edf, _df(spark, batch), ["k"], ["v"]).collect()}
    want = {k: row for k, row in model_pick(batch, False).items() if k not in existing}
    assert got == want
