"""Chunked operators against plain Python, with one key holding most rows."""

import random

import pytest
from pyspark.sql import functions as F

from recordloom.operators import ordered as O


def hot_rows(n=600, seed=1):
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b", "c", "d"]
    return [(rng.choice(keys), i, rng.random() < 0.6) for i in range(n)]


@pytest.fixture(scope="module")
def log(spark):
    rows = hot_rows()
    return rows, spark.createDataFrame(rows, "k string, t int, hit boolean").repartition(5)


def test_hot_key_spreads_over_chunks(log):
    _, df = log
    chunked = O.range_chunks(df, ["k", "t"], 8)
    sizes = [r["count"] for r in chunked.groupBy(O.CHUNK).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 200
    assert chunked.filter("k = 'hot'").select(O.CHUNK).distinct().count() >= 4


@pytest.mark.parametrize("chunks", [1, 7])
def test_position(log, chunks):
    rows, df = log
    got = {(r.k, r.t): r.position for r in O.with_position(df, ["k", "t"], chunks=chunks).collect()}
    assert got == {(k, t): i for i, (k, t, _) in enumerate(sorted(rows))}


@pytest.mark.parametrize("chunks", [1, 7, 40])
def test_previous(log, chunks):
    rows, df = log
    expected, last = {}, {}
    for k, t, _ in sorted(rows):
        expected[(k, t)] = last.get(k)
        last[k] = t
    out = O.with_previous(df, "k", ["t"], ["t"], chunks=chunks)
    assert {(r.k, r.t): r.previous and r.previous.t for r in out.collect()} == expected


@pytest.mark.parametrize("chunks", [1, 7, 40])
@pytest.mark.parametrize("share", [0.0, 0.6, 1.0])
def test_run_length(spark, chunks, share):
    rng = random.Random(3)
    rows = [(k, t, rng.random() < share) for k, t, _ in hot_rows()]
    df = spark.createDataFrame(rows, "k string, t int, hit boolean")
    expected, run = {}, {}
    for k, t, hit in sorted(rows):
        run[k] = run.get(k, 0) + 1 if hit else 0
        expected[(k, t)] = run[k]
    out = O.with_run_length(df, "k", ["t"], F.col("hit"), "n", chunks)
    assert {(r.k, r.t): r.n for r in out.collect()} == expected
