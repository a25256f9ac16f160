import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordloom.operators import rate as A

START = dt.datetime(2024, 1, 1)


def bucket(cap, per_minute, tokens, gaps):
    """Plain token bucket in the same units."""
    admitted = []
    for gap in gaps:
        tokens = min(cap, tokens + gap * per_minute)
        ok = tokens >= A.TOKEN
        tokens -= A.TOKEN if ok else 0
        admitted.append(ok)
    return tokens, admitted


@settings(max_examples=200, deadline=None)
@given(
    st.integers(1, 6), st.integers(1, 200), st.lists(st.integers(0, 4_000_000), max_size=60),
    st.lists(st.integers(0, 1000), min_size=1, max_size=10),
)
def test_transfer_is_the_bucket(burst, per_minute, gaps, starts):
    cap = burst * A.TOKEN
    transfer = A.Transfer(cap)
    for gap in gaps:
        transfer.request(gap * per_minute)
    pieces = list(zip(*transfer.pieces()))
    for s in starts:
        tokens = cap * s // 1000
        assert A.apply_pieces(*pieces, tokens) == bucket(cap, per_minute, tokens, gaps)[0]


def test_transfer_of_an_overloaded_bucket():
    """A thousand requests per token: the summary stays small and fast."""
    transfer = A.Transfer(10 * A.TOKEN)
    for _ in range(50_000):
        transfer.request(A.TOKEN // 1000)
    assert len(transfer.pieces()) <= 25


@pytest.mark.parametrize("chunks", [1, 6, 25])
def test_admission_with_a_hot_key(spark, chunks):
    rng = random.Random(5)
    rows, at = [], 0
    for i in range(500):
        at += rng.randint(0, 900_000)
        rows.append((rng.choice(["hot"] * 7 + ["a", "b", "c"]), START + dt.timedelta(microseconds=at), i, None))
    df = spark.createDataFrame(rows, "k string, ts timestamp, i int, note long").repartition(3)
    out = A.token_admission(df, "k", "ts", ["i"], per_minute=40, burst=3, chunks=chunks)
    got = {r.i: (r.admitted, r.tokens_left) for r in out.collect()}
    expected = {}
    state = {}
    for k, ts, i, _ in rows:
        tokens, last = state.get(k, (3 * A.TOKEN, ts))
        tokens, (ok,) = bucket(3 * A.TOKEN, 40, tokens, [(ts - last) // dt.timedelta(microseconds=1)])
        state[k] = (tokens, ts)
        expected[i] = (ok, tokens / A.TOKEN)
    assert got == expected
    assert {v[0] for v in got.values()} == {True, False}


@pytest.mark.parametrize("chunks", [1, 9])
def test_continued_log(spark, chunks):
    """Two logs with the buckets handed over are one log."""
    rng = random.Random(8)
    rows = [(rng.choice(["hot", "hot", "hot", "a"]), START + dt.timedelta(milliseconds=250 * i), i) for i in range(200)]
    schema = "k string, ts timestamp, i int"
    whole = A.token_admission(spark.createDataFrame(rows, schema), "k", "ts", ["i"], 50, 4)
    first = A.token_admission(spark.createDataFrame(rows[:90], schema), "k", "ts", ["i"], 50, 4)
    state = A.bucket_state(first, "k", "ts", ["i"])
    second = A.token_admission(spark.createDataFrame(rows[90:], schema), "k", "ts", ["i"], 50, 4, chunks, state)
    got = {r.i: tuple(r) for r in first.collect() + second.collect()}
    assert got == {r.i: tuple(r) for r in whole.collect()}


def test_capacity_two(spark):
    rows = [("api", START, i) for i in range(3)]
    out = A.token_admission(spark.createDataFrame(rows, "k string, ts timestamp, i int"), "k", "ts", ["i"], 60, 2)
    assert [r.admitted for r in out.orderBy("i").collect()] == [True, True, False]


def test_backoff(spark):
    events = [(0, False), (1, True), (2, True), (3, False)] + [(4 + i, True) for i in range(10)]
    df = spark.createDataFrame([("api", t, e) for t, e in events], "k string, t int, e boolean")
    rows = A.error_backoff(df, "k", ["t"], F.col("e")).orderBy("t").collect()
    assert [r.consecutive_errors for r in rows] == [0, 1, 2, 0] + list(range(1, 11))
    assert [r.backoff_seconds for r in rows] == [0, 2, 4, 0, 2, 4, 8, 16, 32, 64, 128, 256, 300, 300]


def test_limiter_stats(spark):
    df = spark.createDataFrame([("a", True, False), ("a", False, True)], "s string, admitted boolean, e boolean")
    assert tuple(A.limiter_stats(df, "s", F.col("e")).first()) == ("a", 2, 1, 1, 1)
