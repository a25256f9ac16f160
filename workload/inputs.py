"""Frames the queries start from: derived feeds in the shape the library's operators take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.operators.upsert import sequence
from recordloom.operators.validate import POST_FIELDS, validate_json
from recordloom.sources.json_feed import parse_documents
from recordloom.sources.registry import SOURCES
from workload.feeds import feed

TICKER, MARKET = "coinpaprika", "coingecko"


def ts_text(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def documents(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """Ticker or market documents with their write sequence."""
    order = {"tickers": 0, "markets": 1}[name]
    rows = feed(spark, sf, name, heavy=True).withColumn(
        "seq", sequence(F.col("written_at"), F.lit(order), F.col("batch_no"), F.col("row_pos"))
    )
    return parse_documents(rows.drop("batch_no", "row_pos"), "doc")


def checked(spark: SparkSession, sf: str, name: str) -> DataFrame:
    source = {"tickers": TICKER, "markets": MARKET}[name]
    return SOURCES[source].validate(documents(spark, sf, name))


def unified(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """Unified rows of one feed with written_at and seq."""
    source = {"tickers": TICKER, "markets": MARKET}[name]
    rows, _ = SOURCES[source].process(documents(spark, sf, name), ("written_at", "seq"))
    return rows


def both(spark: SparkSession, sf: str) -> DataFrame:
    return unified(spark, sf, "tickers").unionByName(unified(spark, sf, "markets"))


def products(spark: SparkSession, sf: str) -> DataFrame:
    """Product rows; the key column is metadata."""
    return feed(spark, sf, "products").withColumnRenamed("k", "_k")


def news_entries(spark: SparkSession, sf: str) -> DataFrame:
    """News entries as the feed reader emits them."""
    tags = F.when(F.col("tag_list") == "", F.array().cast("array<string>")).otherwise(F.split("tag_list", ","))
    return feed(spark, sf, "news").select(
        F.coalesce(F.nullif(F.col("guid"), F.lit("")), "link").alias("id"),
        "title", "link", "summary", "content", "author", "published", "updated",
        tags.alias("tags"), F.col("feed_url").alias("_feed_url"), F.col("page_id").alias("_page_id"),
    )


def post_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Posts as JSON documents."""

    def quoted(c: str) -> Column:
        inside = F.to_json(F.array(F.col(c)))
        text = F.substring(inside, F.lit(2), F.length(inside) - 2)
        return F.coalesce(F.when(F.col(c).isNotNull(), text), F.lit("null"))

    doc = F.concat(
        F.lit('{"id":'), "id_json", F.lit(',"userId":'), F.col("user_id").cast("string"),
        F.lit(',"title":'), quoted("title"), F.lit(',"body":'), quoted("body"), F.lit("}"),
    )
    rows = feed(spark, sf, "posts").select(doc.alias("doc"), F.col("doc_id").alias("_doc_id"))
    return parse_documents(rows, "doc")


def checked_posts(spark: SparkSession, sf: str) -> DataFrame:
    return validate_json(post_documents(spark, sf), POST_FIELDS)


def runs(spark: SparkSession, sf: str) -> DataFrame:
    return feed(spark, sf, "runs").drop("event_id")


def shapes(spark: SparkSession, sf: str) -> DataFrame:
    return feed(spark, sf, "shapes").withColumn("payload", F.parse_json("doc"))


EXPECTED_SHAPE = {
    "order_key": "int",
    "order_status": "str",
    "total_price": "float",
    "cust_key": "int",
}
