import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from recordloom.operators import upsert as U

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "canonical_id string, source string, title string, external_created_at timestamp, extra_data string, checksum string, n int"


def writes(spark, n=60, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["x", "y"])
        created = rng.choice([None, T0 + dt.timedelta(days=i)])
        rows.append((rng.choice(["hot", "hot", "b", "c"]), source, rng.choice([None, f"t{i}"]), created,
                     json.dumps({"price": rng.choice([None, i]), f"only_{source}": i, "_source": source}), str(i % 3), i))
    return rows, batch(spark, rows)


def batch(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    missing = [c for c in U.LAST_WRITE if c not in df.columns and c != "updated_at"]
    df = df.withColumns({c: F.lit(None).cast("string") for c in missing})
    at = (F.lit(T0).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("n"))).alias("at")
    df = df.withColumn("written_at", at)
    return U.versioned(df.withColumn("seq", U.sequence(F.col("written_at"), F.lit(0), F.lit(0), F.col("n"))).drop("n"))


def table(df):
    return {r.canonical_id: r.asDict() for r in df.collect()}


def test_write_rules(spark):
    rows, df = writes(spark)
    got = table(U.upsert_unified(df))
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        assert got[key]["title"] == mine[-1][2]
        assert got[key]["source"] == mine[-1][1]
        assert got[key]["external_created_at"] == mine[0][3]
        assert got[key]["ingested_at"] == T0 + dt.timedelta(minutes=mine[0][-1])
        assert got[key]["updated_at"] == T0 + dt.timedelta(minutes=mine[-1][-1])


@pytest.mark.parametrize("extra", ["replace", "merge"])
def test_batches_in_any_cut_and_order(spark, extra):
    rows, df = writes(spark)
    whole = table(U.upsert_unified(df, extra=extra))
    current = None
    for part in (rows[:7], rows[7:30], rows[30:]):
        current = U.upsert_unified(batch(spark, part), current, extra)
    whole_rows = {k: {c: v for c, v in r.items() if c != U.EXTRA_SEQS} for k, r in whole.items()}

    def plain(df):
        return {k: {c: json.loads(v) if c == "extra_data" else v for c, v in r.items() if c != U.EXTRA_SEQS} for k, r in table(df).items()}

    expected = {k: {**r, "extra_data": json.loads(r["extra_data"])} for k, r in whole_rows.items()}
    assert plain(current) == expected
    # Replaying a batch changes nothing.
    assert plain(U.upsert_unified(batch(spark, rows[7:30]), current, extra)) == expected
    # A late batch takes its place, key by key, among what later ones have stored.
    stored = U.upsert_unified(batch(spark, rows[:10] + rows[40:]), None, extra)
    assert plain(U.upsert_unified(batch(spark, rows[10:40]), stored, extra)) == expected


def test_merge_like_the_fold(spark):
    rows, df = writes(spark)
    expected = {}
    for cid, source, _, _, extra, _, _ in rows:
        new = json.loads(extra)
        doc = expected.setdefault(cid, {})
        doc[f"_{source}"] = new
        doc.update({k: v for k, v in new.items() if not k.startswith("_")})
    got = {r.canonical_id: json.loads(r.extra_data) for r in U.merge_extra_data(df).collect()}
    assert got == expected


def test_merge_keeps_other_sources(spark):
    existing = spark.createDataFrame([("k9", '{"stock":4,"_depot":{"stock":4}}', 1)], f"canonical_id string, extra_data string, {U.LAST_SEQ} int")
    new = spark.createDataFrame([("k9", "shop", '{"stock":6,"shelf":"B"}', 2)], f"canonical_id string, source string, extra_data string, {U.LAST_SEQ} int")
    got = json.loads(U.merge_extra_data(new, existing).first().extra_data)
    assert got == {"stock": 6, "shelf": "B", "_depot": {"stock": 4}, "_shop": {"stock": 6, "shelf": "B"}}


def test_raw_upsert_keeps_first_checksum(spark):
    df = spark.createDataFrame([("k", "v1", "c1", 1), ("k", "v2", "c2", 2)], "external_id string, data string, checksum string, seq int")
    row = U.upsert_raw_api(U.versioned(df.withColumn("fetched_at", F.current_timestamp()))).first()
    assert (row.data, row.checksum) == ("v2", "c1")


def test_winners_are_found_without_a_sort_of_rows(spark):
    """Only keys, sequences and fixed-width columns are aggregated, by hash and before the shuffle."""
    rows = writes(spark)[1].withColumns({"ingested_at": F.col("written_at"), "updated_at": F.col("written_at")})
    reduced = U.reduce_by_key(rows, ["canonical_id"], U.LAST_WRITE, U.FIRST_WRITE, stored=True)
    plan = reduced._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "partial_max(" in plan
    assert all("content" not in line for line in plan.splitlines() if "partial_max(" in line)
    assert table(reduced) == table(U.upsert_unified(writes(spark)[1]))


def test_sequences_keep_the_order_of_their_parts(spark):
    rows = [(t, o, b, p) for t in ("1969-12-31 23:59:59", "2024-01-01 00:00:00", "2024-01-01 00:00:00.000001") for o in (0, 9)
            for b in (-1, 0, (1 << 42) - 2) for p in (0, 1 << 62)]
    df = spark.createDataFrame(rows, "t string, o int, b long, p long")
    seq = df.withColumn("s", U.sequence(F.col("t").cast("timestamp"), F.col("o"), F.col("b"), F.col("p"), F.lit("r")))
    assert [tuple(r)[:4] for r in seq.orderBy("s").collect()] == sorted(rows)
    with pytest.raises(Exception, match="batch number"):
        df.select(U.sequence(F.col("t").cast("timestamp"), F.col("o"), F.lit(1 << 42), F.col("p"))).collect()


def test_columns_of_every_width_and_shared_sequences(spark):
    """Keys may share a sequence and be null; null values count."""
    rows = [("a", 1, None, 1.0), ("a", 2, "x", None), (None, 2, "y", 2.0), (None, 1, "z", 3.0), ("b", 2, None, None)]
    df = U.versioned(spark.createDataFrame(rows, "k string, seq long, wide string, thin double"))
    got = U.reduce_by_key(df, ["k"], ["wide", "thin"], [], stored=True).collect()
    assert {r.k: (r.wide, r.thin) for r in got} == {"a": ("x", None), None: ("y", 2.0), "b": (None, None)}
    got = U.reduce_by_key(df, ["k"], [], ["wide", "thin"], stored=True).collect()
    assert {r.k: (r.wide, r.thin) for r in got} == {"a": (None, 1.0), None: ("z", 3.0), "b": (None, None)}
