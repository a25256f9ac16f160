"""Feeds as streams: the same batch job per micro-batch, driven to the end of what has landed."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from recordloom.plans.ingest import Run, ingest_batch
from recordloom.plans.tables import Tables
from recordloom.sources import csv_feed
from recordloom.sources.news_feed import read_news_stream


def drain(
    tables: Tables, run: Run, stream: DataFrame, checkpoint: str, parse: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Read everything new and stop. The query checkpoint remembers the files already read; a
    micro-batch repeated inside a run replaces its own partition, one repeated by a later run writes
    the same keys again. ``parse`` makes records of a micro-batch that needs its files as a whole."""

    def write(batch: DataFrame, batch_no: int) -> None:
        ingest_batch(tables, run, parse(batch) if parse else batch, batch_no)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def drain_csv(
    spark: SparkSession, tables: Tables, run: Run, path: str, columns: Sequence[str], checkpoint: str, files_per_trigger: int | None = None
) -> None:
    """Drain CSV files that land whole; each is read once, under its own header."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    stream = reader.load(path).select("value", *csv_feed.file_columns())
    drain(tables, run, stream, checkpoint, lambda batch: csv_feed.parse_batch(batch, columns))


def drain_news(
    spark: SparkSession, tables: Tables, run: Run, path: str, checkpoint: str, files_per_trigger: int | None = None
) -> None:
    """Drain landed feed documents."""
    drain(tables, run, read_news_stream(spark, path, files_per_trigger), checkpoint)


def unseen_entries(stream: DataFrame, event_time: str, delay: str, keys: tuple[str, ...] = ("_feed_url", "id")) -> DataFrame:
    """Entries not seen before, with state kept only as long as repeats can arrive."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


#: The state store that keeps keys on disk instead of on the heap.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def drain_unseen(stream: DataFrame, event_time: str, delay: str, keys: tuple[str, ...], path: str, checkpoint: str) -> StreamingQuery:
    """Append the entries not seen before to the table at ``path``, and stop. A key is remembered until the watermark has passed
    its first entry by ``delay``; the keys stand in RocksDB, and what a run knew the next run on that checkpoint knows."""
    spark = stream.sparkSession
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, ROCKSDB)
    try:
        query = (
            unseen_entries(stream, event_time, delay, keys).writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
    finally:
        spark.conf.set(setting, before) if before else spark.conf.unset(setting)
    query.awaitTermination()
    return query
