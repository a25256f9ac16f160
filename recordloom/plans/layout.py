"""Listing tables laid out for their queries: clustered by time, with a trigram signature per block.

A block is a range of the order column: one folder, sorted inside. Range filters skip row groups by their statistics. A text search
first asks the signatures, one bitmap of hashed trigrams per block, which blocks can hold the text; the blocks' folders are
then pruned while the scan is planned (dynamic partition pruning), and ILIKE confirms on what is read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.operators.listing import filter_records

#: Bits of a signature, which is what the bitmap functions of Spark work on; bytes of a gram.
SIGNATURE_BITS, GRAM = 1 << 15, 3
TEXTS = ("title", "content")


def write_clustered(records: DataFrame, path: str, order: str = "ingested_at", blocks: int | None = None) -> None:
    """Write ``records`` in blocks of the order column. Without a number, as many blocks as a block has rows.

    Instants are written as microseconds, the form that has statistics.
    """
    n = blocks or max(1, round(records.count() ** 0.5))
    dealt = records.repartitionByRange(n, order).sortWithinPartitions(order).withColumn("block", F.spark_partition_id())
    conf, setting = records.sparkSession.conf, "spark.sql.parquet.outputTimestampType"
    before = conf.get(setting)
    conf.set(setting, "TIMESTAMP_MICROS")
    try:
        dealt.write.mode("overwrite").partitionBy("block").parquet(path)
    finally:
        conf.set(setting, before)


def _grams(data: bytes) -> np.ndarray:
    """Places of the trigrams of a text's bytes in a signature."""
    raw = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    if len(raw) < GRAM:
        return np.zeros(0, dtype=np.uint32)
    value = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
    return (value * np.uint32(0x9E3779B1)) >> np.uint32(17)


def _signature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bitmap per block and batch."""
    for batch in batches:
        found: dict[int, np.ndarray] = {}
        for block, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            bits = found.setdefault(block, np.zeros(SIGNATURE_BITS, dtype=bool))
            bits[_grams((text.as_py() or "").encode())] = True
        bitmaps = [np.packbits(b, bitorder="little").tobytes() for b in found.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(bitmaps, pa.binary())], names=["block", "bits"])


def write_signatures(spark: SparkSession, path: str, to: str) -> None:
    """Signatures of a clustered table: (block, bits), one row per block."""
    text = F.lower(F.concat_ws("\n", *TEXTS))
    rows = spark.read.parquet(path).select(F.col("block").cast("int").alias("block"), text.alias("text"))
    parts = rows.mapInArrow(_signature_rows, "block int, bits binary")
    parts.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits")).write.mode("overwrite").parquet(to)


def possible_blocks(signatures: DataFrame, search: str) -> DataFrame:
    """Blocks whose signature has every trigram of the text's stretches between wildcards."""
    held = F.lit(True)
    for part in re.split("[%_]", search.lower()):
        for place in sorted(set(_grams(part.encode()).tolist())):
            byte = F.conv(F.hex(F.substring("bits", place // 8 + 1, 1)), 16, 10).cast("int")
            held = held & (byte.bitwiseAND(F.lit(1 << place % 8)) > 0)
    return signatures.filter(held).select("block")


def search_clustered(spark: SparkSession, path: str, signatures: str, search: str) -> DataFrame:
    """Records whose title or content contains the text, read from the blocks that can hold it."""
    records = spark.read.parquet(path)
    blocks = possible_blocks(spark.read.parquet(signatures), search)
    return filter_records(records.join(blocks, "block", "left_semi"), search=search).drop("block")
