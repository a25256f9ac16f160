"""Landed JSON feeds (tickers, markets, posts): one document per line, kept as VARIANT."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


FILE_TYPE = "struct<time:timestamp,path:string,block:bigint>"


def row_file() -> Column:
    """Time, path and split of the file a row comes from; what orders the rows of different files."""
    meta = F.col("_metadata")
    return F.struct(
        meta["file_modification_time"].alias("time"), meta["file_path"].alias("path"), meta["file_block_start"].alias("block")
    ).alias("_row_file")


def read_documents(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Batch scan. ``data`` is the text as landed, ``payload`` its VARIANT (NULL when malformed),
    ``_row_file`` the place it landed at."""
    return parse_documents(spark.read.text(path).select("value", row_file()), "value")


def read_document_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same scan as a stream; new files are the increments."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return parse_documents(reader.load(path).select("value", row_file()), "value")


def parse_documents(df: DataFrame, column: str) -> DataFrame:
    """Add ``payload`` for a text column and call the text ``data``."""
    kept = [c for c in df.columns if c != column]
    return df.select(*kept, F.col(column).alias("data"), F.try_parse_json(column).alias("payload"))
