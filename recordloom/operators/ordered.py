"""Ordered operators that never put one key into one task.

A plain ``Window.partitionBy(key)`` sorts all rows of a key in a single task, which fails when one
key holds a third of the table. Here rows are range-partitioned on (key, order) instead, so a hot
key spreads over as many *chunks* as its share of the data. Work inside a chunk is local; what has
to cross a chunk border is one row per chunk, a table bounded by the number of shuffle partitions
and independent of the data size. That table is the only thing broadcast.

The order must end in a column that makes it unique: ties cannot be split over chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.session import cut_lineage

CHUNK = "_chunk"
POS = "_pos_in_chunk"
_LOW_33_BITS = (1 << 33) - 1


def range_chunks(df: DataFrame, order: Sequence[str], chunks: int | None = None) -> DataFrame:
    """Range-partition and sort by ``order``; adds the chunk number and the row's place in it.

    The result is checkpointed: later steps read it more than once, and a second evaluation would
    sample new range borders.
    """
    n = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .select(
            "*",
            F.spark_partition_id().alias(CHUNK),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_33_BITS)).alias(POS),
        )
    )
    return cut_lineage(numbered)


def chunk_offsets(chunked: DataFrame) -> DataFrame:
    """(chunk, rows before it); one row per chunk."""
    sizes = chunked.groupBy(CHUNK).agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(F.lit(0)).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(CHUNK, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))


def with_position(
    df: DataFrame, order: Sequence[str], out: str = "position", chunks: int | None = None
) -> DataFrame:
    """0-based global position of every row under ``order``, without a single-task sort."""
    chunked = range_chunks(df, order, chunks)
    return (
        chunked.join(F.broadcast(chunk_offsets(chunked)), CHUNK)
        .withColumn(out, F.col("_offset") + F.col(POS))
        .drop(CHUNK, POS, "_offset")
    )


def with_previous(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    columns: Sequence[str],
    out: str = "previous",
    chunks: int | None = None,
) -> DataFrame:
    """Struct of ``columns`` of the preceding row of the same key, NULL for a key's first row."""
    chunked = range_chunks(df, [key, *order], chunks)
    payload = F.struct(*columns)
    in_chunk = Window.partitionBy(CHUNK, key).orderBy(POS)
    last = chunked.groupBy(CHUNK).agg(
        F.max_by(F.struct(F.col(key).alias("k"), payload.alias("row")), POS).alias("_last")
    )
    border = last.select(
        CHUNK, F.lag("_last").over(Window.partitionBy(F.lit(0)).orderBy(CHUNK)).alias("_carry")
    )
    continues = (F.col(POS) == 0) & (F.col("_carry.k") == F.col(key))
    return (
        chunked.withColumn("_local", F.lag(payload).over(in_chunk))
        .join(F.broadcast(border), CHUNK, "left")
        .withColumn(out, F.coalesce("_local", F.when(continues, F.col("_carry.row"))))
        .drop(CHUNK, POS, "_local", "_carry")
    )


def with_run_length(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    condition: Column,
    out: str,
    chunks: int | None = None,
) -> DataFrame:
    """Length of the unbroken run of ``condition`` rows of the key that ends at each row (0 where
    the row itself does not meet it)."""
    chunked = range_chunks(df.withColumn("_hit", F.coalesce(condition, F.lit(False))), [key, *order], chunks)
    break_pos = F.when(~F.col("_hit"), F.col(POS))

    # Per chunk: the trailing run of its last key, and whether that run is broken inside the chunk.
    per_key = chunked.groupBy(CHUNK, key).agg(
        F.max(POS).alias("_end"), F.max(break_pos).alias("_break"), F.count("*").alias("_n")
    )
    tail = per_key.groupBy(CHUNK).agg(
        F.max_by(F.struct(F.col(key).alias("k"), "_break", "_n", "_end"), "_end").alias("t")
    )
    tail = tail.select(
        CHUNK,
        F.col("t.k").alias("_k"),
        F.col("t._break").isNotNull().cast("int").alias("_broken"),
        F.coalesce(F.col("t._end") - F.col("t._break"), F.col("t._n")).alias("_run"),
    )
    so_far = Window.partitionBy("_k").orderBy(CHUNK)
    since = tail.withColumn("_island", F.sum("_broken").over(so_far))
    summed = since.withColumn("_run_out", F.sum("_run").over(Window.partitionBy("_k", "_island").orderBy(CHUNK)))
    carried = summed.select(
        CHUNK,
        F.lag(F.struct("_k", "_run_out")).over(Window.partitionBy(F.lit(0)).orderBy(CHUNK)).alias("_carry"),
    )

    to_here = Window.partitionBy(CHUNK, key).orderBy(POS)
    first = F.min(POS).over(to_here)
    last_break = F.max(break_pos).over(to_here)
    inherits = (F.col("_first") == 0) & (F.col("_carry._k") == F.col(key))
    return (
        chunked.withColumn("_first", first)
        .withColumn("_last_break", last_break)
        .join(F.broadcast(carried), CHUNK, "left")
        .withColumn(
            out,
            F.when(F.col("_last_break").isNotNull(), F.col(POS) - F.col("_last_break")).otherwise(
                F.col(POS)
                - F.col("_first")
                + 1
                + F.when(inherits, F.col("_carry._run_out")).otherwise(0)
            ),
        )
        .drop(CHUNK, POS, "_hit", "_first", "_last_break", "_carry")
    )
