"""Incremental reading: slices, pages, seen ids, high-water marks and checkpoints.

Positions come from ``ordered.with_position``; a slice is a plain range filter on them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def checkpoint_number(value: str | None, default: int) -> int:
    """Number in a stored checkpoint, the default when there is none or it is malformed."""
    try:
        return int(value) if value else default
    except ValueError:
        return default


def offset_slice(positioned: DataFrame, checkpoint: str | None, batch_size: int) -> DataFrame:
    """Rows ``[offset, offset + batch_size)`` of a frame with ``position``."""
    start = checkpoint_number(checkpoint, 0)
    pos = F.col("position")
    return positioned.filter((pos >= start) & (pos < start + batch_size))


def page_slice(positioned: DataFrame, checkpoint: str | None, batch_size: int) -> DataFrame:
    """Rows of the page (1-based) a checkpoint names."""
    page = checkpoint_number(checkpoint, 1)
    return offset_slice(positioned, str((page - 1) * batch_size), batch_size)


def offset_batches(positioned: DataFrame, batch_size: int, aggs: Sequence[Column] = ()) -> DataFrame:
    """All batches of a full drain: rows, has_more and the next checkpoint (NULL at the end)."""
    total = positioned.agg(F.count("*").alias("n")).scalar()
    start = F.col("batch_no") * batch_size
    batches = (
        positioned.withColumn("batch_no", F.floor(F.col("position") / batch_size))
        .groupBy("batch_no")
        .agg(F.count("*").alias("fetched"), *aggs)
    )
    has_more = start + batch_size < total
    return batches.withColumns(
        {
            "has_more": has_more,
            "next_checkpoint": F.when(has_more, (start + batch_size).cast("string")),
        }
    )


def page_batches(positioned: DataFrame, batch_size: int, aggs: Sequence[Column] = ()) -> DataFrame:
    """All pages of a full drain; a page is the last one when it is not full."""
    pages = (
        positioned.withColumn("page", F.floor(F.col("position") / batch_size) + 1)
        .groupBy("page")
        .agg(F.count("*").alias("fetched"), *aggs)
    )
    has_more = F.col("fetched") == batch_size
    return pages.withColumns(
        {"has_more": has_more, "next_checkpoint": F.when(has_more, (F.col("page") + 1).cast("string"))}
    )


def unseen(entries: DataFrame, seen: DataFrame, key: str = "id") -> DataFrame:
    """Entries whose id is not in the seen table; entries without an id are always new.

    A left-anti join: adaptive execution broadcasts a small seen table by its measured size and
    splits a hot id of the entry side otherwise.
    """
    return entries.join(seen.select(F.col(key)).distinct(), key, "left_anti")


def remember(seen: DataFrame, entries: DataFrame, key: str = "id") -> DataFrame:
    """The seen table after a batch, exact and without a size limit."""
    new = entries.filter(F.col(key) != "").select(key)
    return seen.select(key).unionByName(new).distinct()


def after_mark(rows: DataFrame, marks: DataFrame, source: str, number: str) -> DataFrame:
    """Rows above their source's high-water mark. A missing or malformed mark starts at the
    beginning. ``marks``: (source, last_value)."""
    value = F.trim("last_value")
    mark = F.when(value.rlike(r"^[+-]?\d+$"), value.try_cast("bigint"))
    at = marks.select(F.col("source").alias(source), mark.alias("_mark"))
    return rows.join(at, source, "left").filter(
        F.col(number) > F.coalesce("_mark", F.lit(0))
    ).drop("_mark")


def high_water_marks(rows: DataFrame, source: str, number: str) -> DataFrame:
    """New checkpoint rows: the highest number read per source."""
    return rows.groupBy(F.col(source).alias("source")).agg(
        F.max(number).cast("string").alias("last_value")
    )


def checkpoint_of(checkpoints: DataFrame, source: str) -> DataFrame:
    """The stored checkpoint of one source (no row when there is none)."""
    return checkpoints.filter(F.col("source") == source)
