"""Landed news feeds (RSS and Atom documents) through the XML reader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_MALFORMED = "_malformed"
_ITEM_SCHEMA = (
    "guid STRING, title STRING, link STRING, description STRING, "
    "`content:encoded` ARRAY<STRING>, content ARRAY<STRING>, author STRING, `dc:creator` STRING, pubDate STRING, "
    f"updated STRING, category ARRAY<STRING>, {_MALFORMED} STRING"
)
_ENTRY_SCHEMA = (
    "id STRING, title STRING, link ARRAY<STRUCT<_href: STRING, _rel: STRING>>, summary STRING, content STRING, "
    f"author STRUCT<name: STRING>, published STRING, updated STRING, category ARRAY<STRUCT<_term: STRING>>, {_MALFORMED} STRING"
)


def _scan(spark: SparkSession, path: str | Sequence[str], tag: str, schema: str) -> DataFrame:
    reader = spark.read.format("xml").option("rowTag", tag).option("columnNameOfCorruptRecord", _MALFORMED)
    return reader.schema(schema).load(path).select("*", F.col("_metadata.file_path").alias("_feed_url"))


def read_news(spark: SparkSession, path: str | Sequence[str], feed_titles: DataFrame | None = None) -> DataFrame:
    """One row per item of an RSS feed or entry of an Atom feed. The landed file is the feed: its path
    is ``_feed_url``, and what stands as title before its first item is ``_feed_title`` unless
    ``feed_titles`` (feed_url, feed_title) is given.

    Splittable by item. Items that cannot be read are in ``unreadable_items``.
    """
    items = _scan(spark, path, "item", _ITEM_SCHEMA).filter(F.col(_MALFORMED).isNull()).drop(_MALFORMED)
    atom = _scan(spark, path, "entry", _ENTRY_SCHEMA).filter(F.col(_MALFORMED).isNull())
    entries = entries_from_items(items).unionByName(entries_from_items(_as_items(atom)))
    titles = channel_titles(spark, path) if feed_titles is None else feed_titles
    titles = titles.select(F.col("feed_url").alias("_feed_url"), F.col("feed_title").alias("_feed_title"))
    return entries.join(titles, "_feed_url", "left").fillna("", ["_feed_title"])


def read_news_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The entries of landed feed documents as a stream; new files are the increments.

    A document is one row, as it was fetched: feeds are documents of some MB at most. ``_row_file`` and ``_row_pos`` give the order
    of entries. Items that cannot be read are left out, as in ``read_news``.
    """
    reader = spark.readStream.format("binaryFile").schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    text = F.decode("content", "UTF-8")
    head = F.regexp_extract(text, r"(?s)^(.*?)(<item[\s>]|<entry[\s>]|$)", 1)
    title = F.regexp_extract(head, r"(?s)<title[^>]*>(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?</title>", 1)
    files = reader.load(path).select(
        text.alias("text"), F.col("path").alias("_feed_url"), _unescaped(title).alias("_feed_title"),
        F.struct(F.col("modificationTime").alias("time"), "path", F.lit(0).cast("bigint").alias("block")).alias("_row_file"),
    )
    keep = ["_feed_title", "_row_file", "_row_pos"]

    def records(tag: str, schema: str) -> DataFrame:
        found = files.select(
            F.posexplode(F.regexp_extract_all("text", F.lit(rf"(?s)<{tag}[\s>].*?</{tag}>"), 0)).alias("_row_pos", "xml"), "_feed_url", *keep[:2]
        )
        parsed = found.withColumn("r", F.from_xml("xml", schema, {"columnNameOfCorruptRecord": _MALFORMED}))
        return parsed.filter(F.col(f"r.{_MALFORMED}").isNull()).select("r.*", "_feed_url", *keep).drop(_MALFORMED)

    items = entries_from_items(records("item", _ITEM_SCHEMA), keep)
    return items.unionByName(entries_from_items(_as_items(records("entry", _ENTRY_SCHEMA), keep), keep))


def unreadable_items(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(feed_url, record, error) of items and entries that are no well-formed XML."""
    frames = [_scan(spark, path, tag, schema) for tag, schema in (("item", _ITEM_SCHEMA), ("entry", _ENTRY_SCHEMA))]
    broken = [
        f.select(
            F.col("_feed_url").alias("feed_url"), F.col(_MALFORMED).alias("record"),
            F.concat_ws(": ", F.lit("record: not well-formed"), "title").alias("error"),
        )
        .filter(F.col("record").isNotNull())
        for f in frames
    ]
    return broken[0].unionByName(broken[1])


def channel_titles(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(feed_url, feed_title): the first title of each file, if it stands before the first item."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("feed_url"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("at"),
        F.regexp_extract("value", r"^(.*?)(<item[\s>]|<entry[\s>]|$)", 1).alias("head"),
        F.col("value").rlike(r"<(item|entry)[\s>]").alias("starts"),
    )
    title = F.regexp_extract("head", r"<title[^>]*>(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?</title>", 1)
    found = lines.select("feed_url", "at", "starts", _unescaped(title).alias("title")).groupBy("feed_url").agg(
        F.min_by(F.when(F.col("title") != "", F.col("title")), F.when(F.col("title") != "", F.col("at"))).alias("title"),
        F.min(F.when(F.col("title") != "", F.col("at"))).alias("at"),
        F.min(F.when(F.col("starts"), F.col("at"))).alias("first_item"),
    )
    stands = F.col("first_item").isNull() | (F.col("at") <= F.col("first_item"))
    return found.select("feed_url", F.coalesce(F.when(stands, F.col("title")), F.lit("")).alias("feed_title"))


def _unescaped(text: Column) -> Column:
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def _as_items(atom: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Atom entries under the names of RSS items."""
    page = F.filter("link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    return atom.select(
        F.col("id").alias("guid"),
        "title",
        F.coalesce(F.get(page, F.lit(0))["_href"], F.get("link", F.lit(0))["_href"]).alias("link"),
        F.col("summary").alias("description"),
        F.lit(None).cast("array<string>").alias("content:encoded"),
        F.when(F.col("content").isNotNull(), F.array("content")).alias("content"),
        F.col("author.name").alias("author"),
        F.lit(None).cast("string").alias("dc:creator"),
        F.col("published").alias("pubDate"),
        "updated",
        F.transform("category", lambda x: x["_term"]).alias("category"),
        "_feed_url",
        *keep,
    )


def entries_from_items(items: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Feed items to entry records: missing texts are '', the id falls back to the link, the content
    to the summary."""

    def text(name: str):
        return F.coalesce(F.col(f"`{name}`"), F.lit(""))

    contents = F.concat(*[F.coalesce(F.col(f"`{c}`"), F.array().cast("array<string>")) for c in ("content:encoded", "content")])
    tags = F.coalesce("category", F.array().cast("array<string>"))
    return items.select(
        F.coalesce(F.nullif(F.col("guid"), F.lit("")), text("link")).alias("id"),
        text("title").alias("title"),
        text("link").alias("link"),
        text("description").alias("summary"),
        F.coalesce(F.get(contents, F.lit(0)), text("description")).alias("content"),
        F.coalesce(F.nullif("author", F.lit("")), text("dc:creator")).alias("author"),
        text("pubDate").alias("published"),
        text("updated").alias("updated"),
        F.transform(tags, lambda t: F.coalesce(t, F.lit(""))).alias("tags"),
        "_feed_url",
        *keep,
    )
