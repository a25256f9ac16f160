"""Jump consistent hashing against the plain definition."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import plain
from pyspark.sql import functions as F

from recordloom.llm import sharding


def jump_plain(key, n):
    last, nxt = -1, 0
    while nxt < n:
        last = nxt
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        nxt = int((last + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return last


def key_plain(value):
    return int(hashlib.md5(("" if value is None else str(value)).encode()).hexdigest()[:15], 16)


def test_jump_is_the_plain_definition_and_moves_only_into_the_new_shard():
    keys = np.random.default_rng(5).integers(0, 1 << 60, 4000, dtype=np.int64)
    before = sharding.jump(keys, 1)
    assert set(before) == {0}
    for n in range(2, 40):
        now = sharding.jump(keys, n)
        moved = now != before
        assert set(now[moved]) <= {n - 1}
        assert abs(moved.mean() - 1 / n) < 0.03
        before = now
    assert [jump_plain(int(k), 39) for k in keys] == before.tolist()
    assert len(sharding.jump(np.zeros(0, dtype=np.int64), 3)) == 0


def expected(rows, shards):
    placed = sorted(
        (jump_plain(key_plain(i), shards), i is not None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), jump_plain(key_plain(i), shards + 1))
        for i, t in rows
    )
    slots, out = Counter(), Counter()
    for shard, known, i, size, crc, grown in placed:
        out[(i if known else None, size, crc, "key", shard, slots[shard], grown)] += 1
        slots[shard] += 1
    return out


def test_documents(spark, hard, small, empty):
    for docs, rows in ((hard, plain.HARD), small):
        got = sharding.shard_documents(docs)
        assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
        assert Counter(map(tuple, got.collect())) == expected(rows, 8)
    assert Counter(map(tuple, sharding.shard_documents(small[0], shards=3).collect())) == expected(small[1], 3)
    assert sharding.shard_documents(empty).count() == 0


def test_equal_rows_spread_over_tasks_and_keep_gapless_slots(spark):
    docs = spark.range(3000).select(F.when(F.col("id") < 2000, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.lit("same").alias("text"))
    got = sharding.shard_documents(docs.repartition(4)).collect()
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(got) == 3000 and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_written_shards_hold_all_rows(spark, hard, tmp_path):
    sharding.write_shards(hard, str(tmp_path / "out"), "doc_id", 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(plain.HARD) and set(hard.columns) < set(back.columns)
    assert back.filter("doc_id = 6").select("shard").distinct().count() == 1
