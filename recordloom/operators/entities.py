"""Cross-feed views of unified entities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def source_agreement(
    rows: DataFrame, value: Column, sources: Sequence[str], seq: str = "seq", key: str = "canonical_id"
) -> DataFrame:
    """Latest value of each feed side by side per entity, and their spread.

    The feeds are given, so the pivot needs no pass to find them: one aggregation, partial before
    the shuffle.
    """
    columns = [
        F.max_by(value, F.when(F.col("source") == s, F.col(seq))).alias(s) for s in sources
    ]
    wide = rows.groupBy(key).agg(*columns)
    filled = F.array_compact(F.array(*sources))
    return wide.select(
        key,
        *sources,
        F.size(filled).alias("feeds"),
        F.when(F.size(filled) > 1, F.array_max(filled) - F.array_min(filled)).alias("spread"),
    )


def id_collisions(rows: DataFrame, key: str = "canonical_id") -> DataFrame:
    """Canonical ids under which one feed holds several distinct records.

    Duplicates go first (a hash aggregation that already shrinks in the map tasks); what is counted
    per id afterwards is distinct source ids, with partial counts.
    """
    distinct = rows.select(key, "source", "source_id").distinct()
    counted = distinct.groupBy(key, "source").agg(F.count("*").alias("source_ids"))
    return counted.filter(F.col("source_ids") > 1)
