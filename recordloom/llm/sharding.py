"""Sharding by jump consistent hashing.

A row's shard is a function of its key and the number of shards alone: no ring table, no counts, no state. With one more
shard a row either stays or moves into the new shard, so only the necessary share, one of n + 1, travels.

The key is hashed by the MD5 of its decimal or literal text, which is the same in every language and on every platform, so
that a shard can be found again without this library. Rows with equal keys share a shard; a hot key is one shard's
fate by the contract, but never one task's: places are counted over range partitions that split ties.

Defined results: a row without a key goes where the empty text goes; a null text has size 1 and the checksum of the empty
text; repeated rows each get a slot of their own; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm.common import narrowed, written
from recordloom.operators.ordered import CHUNK, POS, range_chunks

#: The law of the generator of the method.
MULTIPLIER = 2862933555777941757


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key among ``shards``: the last of its jumps that stays below that number."""
    state = keys.astype(np.uint64)
    last = np.zeros(len(state), dtype=np.int64)
    nxt = np.zeros(len(state), dtype=np.int64)
    while True:
        going = np.flatnonzero(nxt < shards)
        if not len(going):
            return last
        last[going] = nxt[going]
        state[going] = state[going] * np.uint64(MULTIPLIER) + np.uint64(1)
        draw = (state[going] >> np.uint64(33)).astype(np.float64) + 1.0
        nxt[going] = ((last[going] + 1) * (float(1 << 31) / draw)).astype(np.int64)


def stable_key(column: Column) -> Column:
    """The first 60 bits of the MD5 of the value's text."""
    return F.conv(F.substring(F.md5(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def shard_of(column: Column, *counts: int) -> Column:
    """Struct with the shard of the key under each of the given numbers of shards: n8, n9, ..."""

    @F.pandas_udf(", ".join(f"n{n} int" for n in counts))
    def shards(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for keys in batches:
            state = keys.to_numpy(dtype=np.int64)
            yield pd.DataFrame({f"n{n}": jump(state, n).astype(np.int32) for n in counts})

    return shards(stable_key(column))


def with_shard(df: DataFrame, key_col: str, shards: int, out: str = "shard") -> DataFrame:
    """``df`` with the shard of every row; a column of that name is replaced."""
    return df.withColumn(out, shard_of(F.col(f"`{key_col}`"), shards)[f"n{shards}"])


def write_shards(df: DataFrame, path: str, key_col: str, shards: int) -> None:
    """Write one folder per shard; every task adds its own files, so a shard of any size needs no single writer."""
    with_shard(df, key_col, shards).write.partitionBy("shard").parquet(path)


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard (with one more shard).

    The slots of a shard follow (id, size, checksum) without a gap. One pass reads the texts; what is sorted are the narrow rows.
    """
    text = F.coalesce("text", F.lit(""))
    placed = narrowed(docs, id_col, text_col).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shard_of(F.col("doc_id"), shards, shards + 1).alias("at"),
        F.monotonically_increasing_id().alias("place"),  # tells equal rows apart, so that any number of them can be split
    )
    placed = placed.select("doc_id", "size", "text_crc32", F.col(f"at.n{shards}").alias("shard"), F.col(f"at.n{shards + 1}").alias("grown_shard"), "place")
    chunked = range_chunks(written(placed, "sharding"), ["shard", "doc_id", "size", "text_crc32", "place"])
    stretches = chunked.groupBy("shard", CHUNK).agg(F.min(POS).alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.select("shard", CHUNK, (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    # One row per chunk and shard that meet: at most shuffle partitions + shards rows, whatever the table.
    return chunked.join(F.broadcast(stretches), ["shard", CHUNK]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col(POS) + F.col("shift")).alias("slot"), "grown_shard"
    )
