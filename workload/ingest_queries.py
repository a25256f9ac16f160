"""Sources, incremental reading, validation, transforms (S, I, V, T)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.functions import cleaning as C
from recordloom.operators import paging as P
from recordloom.operators import transform as T
from recordloom.operators import validate as V
from recordloom.operators.ordered import with_position
from recordloom.operators.upsert import upsert_checkpoints, versioned
from recordloom.plans.ingest import Run, ingest_csv, run_source
from recordloom.plans.tables import Tables
from recordloom.session import remove, scratch_path, shuffles_dropped
from recordloom.sources import csv_feed, json_feed, news_feed
from recordloom.sources.registry import SourceSpec, reject_report
from recordloom.streaming.ingest import drain, drain_csv, drain_news, drain_unseen
from workload import inputs as I
from workload import sqltext as S
from workload.feeds import cte, feed, table
from workload.inputs import ts_text
from workload.registry import query

PRODUCT_COLUMNS = ["product_id", "name", "category", "price", "description", "stock_quantity", "created_at"]


# --- sources -------------------------------------------------------------------------------------


#: Folders the product files land in; within a folder rows stand in the order of their key.
_FOLDERS = 16


def _landed_products(spark: SparkSession, sf: str, path: str | None = None, where: F.Column | None = None, price: str | None = None) -> str:
    """One file per folder, all of one header, each written by a task of its own."""
    path = path or scratch_path(spark, "csv")
    rows = feed(spark, sf, "products").filter(F.lit(True) if where is None else where)
    rows = rows.withColumn("price", F.lit(price)) if price else rows
    (
        rows.select(*PRODUCT_COLUMNS, "k", (F.col("k") % _FOLDERS).cast("int").alias("folder"))
        .repartitionById(_FOLDERS, F.pmod(F.coalesce("folder", F.lit(0)), F.lit(_FOLDERS))).sortWithinPartitions("folder", "k").drop("k")
        .write.mode("append").partitionBy("folder").option("header", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def _folder(path: str) -> F.Column:
    return F.regexp_extract(path, r"/folder=(\d+)/", 1).cast("int")


_TEXTS = ", ".join(f"coalesce({c}, '') AS {c}" for c in PRODUCT_COLUMNS)


@query(
    "S1_csv_scan",
    cte("products") + f""" SELECT {_TEXTS}, CAST(k % {_FOLDERS} AS INT) AS folder,
    row_number() OVER (PARTITION BY k % {_FOLDERS} ORDER BY k) AS row_number, false AS extra_fields FROM products""",
)
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Values and row numbers of files in several folders."""
    rows = csv_feed.read_csv(spark, _landed_products(spark, sf), PRODUCT_COLUMNS)
    return rows.select(
        *PRODUCT_COLUMNS, _folder("_file_path").alias("folder"), F.col("_row_number").alias("row_number"), F.col("_extra_fields").alias("extra_fields")
    )


def _landed_documents(spark: SparkSession, docs: DataFrame) -> str:
    path = scratch_path(spark, "json")
    docs.write.text(path)
    return path


def _field(name: str) -> F.Column:
    return F.try_variant_get("payload", f"$.{name}", "string")


@query(
    "S2_ticker_documents",
    cte("tickers") + """ SELECT doc->>'$.id' AS id, doc->>'$.symbol' AS symbol,
    TRY_CAST(doc->>'$.quotes.USD.price' AS DOUBLE) AS price FROM tickers""",
)
def ticker_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = json_feed.read_documents(spark, _landed_documents(spark, feed(spark, sf, "tickers").select("doc")))
    price = F.try_variant_get("payload", "$.quotes.USD.price", "double")
    return docs.select(_field("id").alias("id"), _field("symbol").alias("symbol"), price.alias("price"))


@query(
    "S3_market_documents",
    cte("markets") + """ SELECT doc->>'$.id' AS id, doc->>'$.name' AS name,
    TRY_CAST(doc->>'$.current_price' AS DOUBLE) AS price FROM markets""",
)
def market_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = json_feed.read_documents(spark, _landed_documents(spark, feed(spark, sf, "markets").select("doc")))
    price = F.try_variant_get("payload", "$.current_price", "double")
    return docs.select(_field("id").alias("id"), _field("name").alias("name"), price.alias("price"))


@query(
    "S4_post_documents",
    cte("posts") + " SELECT replace(CASE WHEN id_json = 'null' THEN NULL ELSE id_json END, '\"', '') AS id, title, body FROM posts",
)
def post_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = json_feed.read_documents(spark, _landed_documents(spark, I.post_documents(spark, sf).select("data")))
    return docs.select(_field("id").alias("id"), _field("title").alias("title"), _field("body").alias("body"))


@query(
    "S5_news_items",
    cte("news") + """ SELECT coalesce(nullif(guid, ''), link) AS id, trim(title) AS title, link,
    summary, CASE WHEN content = '' THEN summary ELSE trim(content) END AS content, author,
    CASE WHEN tag_list = '' THEN '' ELSE tag_list END AS tags FROM news""",
)
def news_items(spark: SparkSession, sf: str) -> DataFrame:
    rows = news_feed.read_news(spark, _landed_news(spark, sf))
    return rows.select(
        "id", "title", "link", "summary", "content", "author", F.array_join("tags", ",").alias("tags")
    )


def _landed_texts(spark: SparkSession, sf: str) -> str:
    """All columns of the documents with their whole texts, a line each, in a folder per remainder of the id. A folder is one file
    in parts, ordered by id over all of them: parts are ranges of its rows, so no task holds a whole file."""
    path = scratch_path(spark, "texts")
    text = F.coalesce("text", F.lit(""))
    for sign, spelled in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(sign), F.lit(spelled))
    others = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "lang", "source", "n_chars")}
    value = F.concat_ws("|", others["doc_id"], text, others["lang"], others["source"], others["n_chars"]).alias("value")
    landed = table(spark, sf, "documents").select(value, "doc_id", (F.coalesce("doc_id", F.lit(0)) % 3).alias("file"))
    # Lines of one id are told apart by how they begin; those that begin alike stay together.
    dealt = landed.repartitionByRange("file", "doc_id", F.substring("value", 1, 64)).sortWithinPartitions("file", "doc_id", "value")
    dealt.drop("doc_id").write.partitionBy("file").text(path)
    return path


_TEXT_LINES = r"""SELECT coalesce(doc_id, 0) % 3 AS file, doc_id, concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), ''),
        replace(replace(replace(coalesce(text, ''), '\', '\\'), chr(10), '\n'), chr(13), '\r'),
        coalesce(lang, ''), coalesce(source, ''), coalesce(CAST(n_chars AS VARCHAR), '')) AS value FROM documents"""


def _powers_sql() -> str:
    """Powers of the digest's bases, one step after another."""
    steps = ", ".join(f"p{k} * {b} % {csv_feed.PRIME}" for k, b in enumerate(csv_feed.BASES))
    names, ones = ", ".join(f"p{k}" for k in range(len(csv_feed.BASES))), ", ".join(["CAST(1 AS BIGINT)"] * len(csv_feed.BASES))
    return f"w(i, {names}) AS (SELECT 0, {ones} UNION ALL SELECT i + 1, {steps} FROM w WHERE i < (SELECT count(*) FROM documents))"


def _digest_sql(k: int) -> str:
    return f"sum(CAST('0x' || h[{8 * k + 1}:{8 * k + 8}] AS BIGINT) % {csv_feed.PRIME} * p{k} % {csv_feed.PRIME}) % {csv_feed.PRIME}"


@query(
    "S6_file_fingerprints",
    f"""WITH RECURSIVE {_powers_sql()}, l AS ({_TEXT_LINES}),
    n AS (SELECT file, md5(value) AS h, row_number() OVER (PARTITION BY file ORDER BY doc_id NULLS FIRST, value) - 1 AS i FROM l)
    SELECT CAST(file AS VARCHAR) AS file, count(*) AS lines, md5(concat_ws('|', count(*), {", ".join(_digest_sql(k) for k in range(len(csv_feed.BASES)))})) AS fingerprint
    FROM n JOIN w USING (i) GROUP BY file""",
)
def file_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """Order-aware digest of every file, whole texts included, from splits digested side by side."""
    prints = csv_feed.content_fingerprints(spark, _landed_texts(spark, sf), parts=True)
    return prints.withColumn("file", F.regexp_extract("file", r"/file=(\d+)$", 1))


@query(
    "S9_text_fingerprints",
    r"""WITH h AS (SELECT coalesce(doc_id, 0) % 3 AS file, md5(concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), ''),
        replace(replace(replace(coalesce(text, ''), '\', '\\'), chr(10), '\n'), chr(13), '\r'),
        coalesce(lang, ''), coalesce(source, ''), coalesce(CAST(n_chars AS VARCHAR), ''))) AS h FROM documents),
    s AS (SELECT coalesce(CAST(file AS VARCHAR), 'whole') AS file, count(*) AS lines, sum(CAST('0x' || h[1:8] AS BIGINT)) AS w0,
        sum(CAST('0x' || h[9:16] AS BIGINT)) AS w1, sum(CAST('0x' || h[17:24] AS BIGINT)) AS w2,
        sum(CAST('0x' || h[25:32] AS BIGINT)) AS w3 FROM h GROUP BY GROUPING SETS ((file), ()))
    SELECT file, lines, md5(concat_ws('|', lines, w0, w1, w2, w3)) AS fingerprint FROM s""",
)
def text_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """The same files by a digest that ignores the order of lines: of each file, and of all lines."""
    text = spark.read.text(_landed_texts(spark, sf))
    lines = text.select(F.regexp_extract(F.col("_metadata.file_path"), r"/file=(\d+)/", 1).alias("file"), F.md5("value").alias("h"))
    whole = csv_feed.line_digest(lines).withColumn("file", F.lit("whole"))
    return csv_feed.line_digest(lines, "file").unionByName(whole)


@query(
    "S7_feed_counts",
    S.BOTH_UNIFIED + ", " + S.PRODUCTS_CHECKED[len("WITH "):] + ", " + S.POSTS_CHECKED[len("WITH "):] + """
    SELECT 'coinpaprika' AS source, count_if(error = '') AS accepted, count_if(error <> '') AS rejected FROM tv
    UNION ALL SELECT 'coingecko', count_if(error = ''), count_if(error <> '') FROM mv
    UNION ALL SELECT 'csv', count_if(error = ''), count_if(error <> '') FROM pv
    UNION ALL SELECT 'api', count_if(error = ''), count_if(error <> '') FROM pe""",
)
def feed_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reject_report(
        {
            "coinpaprika": I.documents(spark, sf, "tickers"),
            "coingecko": I.documents(spark, sf, "markets"),
            "csv": I.products(spark, sf),
            "api": I.post_documents(spark, sf),
        }
    )


SUPPLIER_FIELDS = (
    V.Field("supplier_id", "int", required=True),
    V.Field("name", "clean_str", required=True, max_len=18),
    V.Field("balance", "float", minimum=0),
)


def _supplier_record(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(
        *keep, F.lit("suppliers").alias("source"), F.col("rec.supplier_id").cast("string").alias("source_id"),
        F.concat(F.lit("supplier_"), F.col("rec.supplier_id").cast("string")).alias("canonical_id"),
        F.col("rec.name").alias("title"), F.col("rec.balance").alias("balance"),
    )


@query(
    "S8_custom_feed",
    """SELECT 'suppliers' AS source, CAST(s_suppkey AS VARCHAR) AS source_id, 'supplier_' || CAST(s_suppkey AS VARCHAR) AS canonical_id,
    trim(s_name) AS title, s_acctbal AS balance FROM supplier WHERE s_acctbal >= 0 AND length(trim(s_name)) <= 18""",
)
def custom_feed(spark: SparkSession, sf: str) -> DataFrame:
    spec = SourceSpec(
        "suppliers", lambda d: V.validate_text(d, SUPPLIER_FIELDS), _supplier_record, "raw_csv", 9
    )
    raw = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("supplier_id"), F.col("s_name").alias("name"),
        F.col("s_acctbal").cast("string").alias("balance"),
    )
    return spec.process(raw)[0]


# --- incremental reading -------------------------------------------------------------------------

_POSITIONED = """WITH p AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS position,
    count(*) OVER () AS total FROM orders)"""


def _positioned_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", (-F.col("o_totalprice")).alias("rank_key"))
    return with_position(orders, ["rank_key", "o_orderkey"])


@query(
    "I1_offset_batches",
    _POSITIONED + """ SELECT CAST(position // 100 AS BIGINT) AS batch_no, count(*) AS fetched, sum(o_orderkey) AS key_sum,
    (position // 100 + 1) * 100 < max(total) AS has_more,
    CASE WHEN (position // 100 + 1) * 100 < max(total) THEN CAST(CAST((position // 100 + 1) * 100 AS BIGINT) AS VARCHAR) END AS next_checkpoint
    FROM p GROUP BY position // 100""",
)
def offset_batches(spark: SparkSession, sf: str) -> DataFrame:
    return P.offset_batches(_positioned_orders(spark, sf), 100, [F.sum("o_orderkey").alias("key_sum")])


@query(
    "I2_page_batches",
    _POSITIONED + """ SELECT CAST(position // 250 + 1 AS BIGINT) AS page, count(*) AS fetched, sum(o_orderkey) AS key_sum,
    count(*) = 250 AS has_more,
    CASE WHEN count(*) = 250 THEN CAST(CAST(position // 250 + 2 AS BIGINT) AS VARCHAR) END AS next_checkpoint
    FROM p GROUP BY position // 250""",
)
def page_batches(spark: SparkSession, sf: str) -> DataFrame:
    return P.page_batches(_positioned_orders(spark, sf), 250, [F.sum("o_orderkey").alias("key_sum")])


@query(
    "I3_resume_points",
    """WITH rows AS (SELECT 'file-' || CAST(o_custkey AS VARCHAR) AS file, o_orderkey,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS row_number FROM orders),
    cp AS (SELECT c_custkey, 'file-' || CAST(c_custkey AS VARCHAR) AS file,
        CASE c_custkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 3 WHEN 2 THEN 0 ELSE 2 END AS start_row FROM customer)
    SELECT rows.file, o_orderkey, row_number FROM rows LEFT JOIN cp USING (file) WHERE row_number > coalesce(start_row, 0)""",
)
def resume_points(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer is a file of orders. Its checkpoint is current, stale, malformed or bare."""
    orders = table(spark, sf, "orders").select(
        F.concat(F.lit("file-"), F.col("o_custkey").cast("string")).alias("_file_path"), "o_orderkey", "o_custkey"
    )
    positioned = with_position(orders, ["o_custkey", "o_orderkey"])
    first = positioned.groupBy("_file_path").agg(F.min("position").alias("first"))
    rows = positioned.join(first, "_file_path").withColumn("_row_number", F.col("position") - F.col("first") + 1)
    customers = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("file-"), F.col("c_custkey").cast("string")).alias("file"), F.md5("c_name").alias("fingerprint")
    )
    last_value = (
        F.when(F.col("c_custkey") % 4 == 0, F.lit("7|stale"))
        .when(F.col("c_custkey") % 4 == 1, csv_feed.csv_checkpoint(F.lit(3), F.col("fingerprint")))
        .when(F.col("c_custkey") % 4 == 2, F.lit("x|"))
        .otherwise(F.lit("2"))
    )
    checkpoints = customers.select("file", last_value.alias("last_value"))
    points = csv_feed.resume_points(customers.select("file", "fingerprint"), checkpoints)
    return csv_feed.rows_after(rows, points).select(F.col("_file_path").alias("file"), "o_orderkey", F.col("_row_number").alias("row_number"))


_RUN_AT = [dt.datetime(2024, 1, 1, hour, tzinfo=dt.timezone.utc) for hour in range(3)]


@query(
    "I3_csv_folders",
    cte("products") + f""", f AS (SELECT {_TEXTS}, CAST(k % {_FOLDERS} AS INT) AS folder, k % 3 = 0 AS later,
        row_number() OVER (PARTITION BY k % {_FOLDERS}, k % 3 = 0 ORDER BY k) AS row_number FROM products)
    SELECT folder, CASE WHEN later THEN 2 ELSE 1 END AS run, row_number, product_id, name, price, created_at,
    CAST(count(*) OVER (PARTITION BY folder, later) AS VARCHAR) AS end_row, 0 AS fetched_again FROM f""",
)
def csv_folders(spark: SparkSession, sf: str) -> DataFrame:
    """Three incremental runs over folders; the second finds new files, the third nothing."""
    tables, path, fetched = Tables(scratch_path(spark, "tables")), scratch_path(spark, "csv"), 0
    for at, where in zip(_RUN_AT, (F.col("k") % 3 != 0, F.col("k") % 3 == 0, None)):
        if where is not None:
            _landed_products(spark, sf, path, where)
        run = Run("csv", at)
        run_source(spark, tables, run, lambda r: ingest_csv(spark, tables, r, path, PRODUCT_COLUMNS))
        fetched = tables.counters.current(spark, run.run_id).first().records_fetched
    marks = tables.checkpoints.current(spark).select(
        F.substring("source", len("csv:") + 1, 1 << 30).alias("file_name"), F.split_part("last_value", F.lit("|"), F.lit(1)).alias("end_row")
    )
    rows = tables.raw_csv.current(spark).join(marks, "file_name")
    values = F.from_json("data", ", ".join(f"{c} STRING" for c in PRODUCT_COLUMNS))
    return rows.withColumn("r", values).select(
        _folder("file_name").alias("folder"), (F.hour("imported_at") + 1).alias("run"), "row_number",
        "r.product_id", "r.name", "r.price", "r.created_at", "end_row", F.lit(fetched).cast("int").alias("fetched_again"),
    )


@query(
    "I4_unseen_entries",
    "SELECT o_orderkey AS id, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
)
def unseen_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with a returned line are the ids already seen."""
    seen = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("id"))
    entries = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey")
    return P.unseen(entries, seen, "id")


_PARTS, _OVERLAP = 5, 400


def replay_entries(spark: SparkSession, sf: str) -> tuple[str, list[int]]:
    """Orders as entries of five runs, one after another; every part but the first also repeats the end of the one before it,
    with a later time. Returns the table's folder and the number of keys held after each run."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey")
    landing, out, checkpoint = (scratch_path(spark, n) for n in ("entries", "unseen", "unseen-stream"))
    last = orders.agg(F.max("id")).first()[0] or 0
    held = []
    for k in range(_PARTS):
        low, high = (last + 1) * k // _PARTS, (last + 1) * (k + 1) // _PARTS
        new = orders.filter((F.col("id") >= low) & (F.col("id") < high)).withColumn("at", F.timestamp_seconds(F.col("id") + 10**9))
        again = orders.filter((F.col("id") >= low - _OVERLAP) & (F.col("id") < low)).withColumn("at", F.timestamp_seconds(F.col("id") + 10**9 + 30))
        new.unionByName(again).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(new.schema).parquet(landing)
        query = drain_unseen(stream, "at", "15 minutes", ("id",), out, checkpoint)
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    return out, held


@query("I4_stream_unseen", "SELECT o_orderkey AS id, o_custkey FROM orders")
def stream_unseen(spark: SparkSession, sf: str) -> DataFrame:
    """Each entry once, however often it is replayed."""
    return spark.read.parquet(replay_entries(spark, sf)[0]).select("id", "o_custkey")


@query(
    "I5_high_water_mark",
    """WITH mark AS (SELECT source, CASE WHEN source = 'src3' THEN NULL ELSE max(doc_id) END AS m
        FROM documents JOIN labels USING (doc_id) GROUP BY source),
    fresh AS (SELECT d.source, d.doc_id FROM documents d LEFT JOIN mark USING (source) WHERE d.doc_id > coalesce(m, 0))
    SELECT source, CAST(max(doc_id) AS VARCHAR) AS last_value, count(*) AS fetched FROM fresh GROUP BY source""",
)
def high_water_mark(spark: SparkSession, sf: str) -> DataFrame:
    """Per source, documents after the last labelled one; one source has a malformed mark."""
    documents = table(spark, sf, "documents").select("doc_id", "source")
    labelled = documents.join(table(spark, sf, "labels").select("doc_id"), "doc_id")
    marks = P.high_water_marks(labelled, "source", "doc_id")
    marks = marks.withColumn("last_value", F.when(F.col("source") == "src3", "broken").otherwise(F.col("last_value")))
    fresh = P.after_mark(documents, marks, "source", "doc_id")
    counts = fresh.groupBy("source").agg(F.count("*").alias("fetched"))
    return P.high_water_marks(fresh, "source", "doc_id").join(counts, "source")


_YEARS = range(1992, 2003)
#: Parts a year's documents are staged in.
_YEAR_PARTS = 8


@query(
    "I6_drain_stream",
    S.TICKER_UNIFIED + f""", k AS (SELECT *, row(written_at, batch_no, row_pos) AS seq FROM ut),
    w AS (SELECT canonical_id, arg_max(row(source_id, symbol, title, price, rank), seq) AS l, arg_min(row(created), seq) AS f FROM k GROUP BY canonical_id)
    SELECT canonical_id, l[1] AS source_id, l[2] AS symbol, l[3] AS title, l[4] AS price, l[5] AS rank, {S.ts_text("f[1]")} AS created,
    '2024-01-01 00:00:00' AS updated_at, (SELECT count(*) FROM tv) AS fetched, (SELECT count(*) FROM ut) AS processed FROM w""",
)
def drain_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Ticker documents land as one file a year, very unequal in size; a stream drains two at a time. The last file's writes win."""
    tables, landing = Tables(scratch_path(spark, "tables")), scratch_path(spark, "json")
    # Documents are made by all tasks in one pass over the table; what is left to the one task of a file is its own rows.
    staged = scratch_path(spark, "years")
    year = F.greatest(F.least(F.year("written_at"), F.lit(_YEARS[-1])), F.lit(_YEARS[0]))
    made = feed(spark, sf, "tickers", heavy=True).filter("written_at IS NOT NULL").withColumn("year", year)
    dealt = made.repartition("year", F.pmod(F.hash("batch_no"), F.lit(_YEAR_PARTS)))
    with shuffles_dropped(spark):
        dealt.write.option("compression", "zstd").partitionBy("year").parquet(staged)
    docs = spark.read.schema(made.schema).parquet(staged)
    for year in _YEARS:
        mine = docs.filter(F.col("year") == year)
        mine.coalesce(1).sortWithinPartitions("written_at", "batch_no", "row_pos").select("doc").write.mode("append").text(landing)
    remove(spark, staged)
    run = Run("coinpaprika", _RUN_AT[0])
    run_source(spark, tables, run, lambda r: drain(tables, r, json_feed.read_document_stream(spark, landing, 2), f"{tables.root}/stream"))
    counted = tables.counters.current(spark, run.run_id).agg(
        F.sum("records_fetched").alias("fetched"), F.sum("records_processed").alias("processed")
    ).first()
    extra = F.from_json("extra_data", "price_usd double, rank bigint")
    return tables.unified.current(spark).withColumn("x", extra).select(
        "canonical_id", "source_id", "symbol", "title", F.col("x.price_usd").alias("price"), F.col("x.rank").alias("rank"),
        ts_text("external_created_at").alias("created"), ts_text("updated_at").alias("updated_at"),
        F.lit(counted.fetched).alias("fetched"), F.lit(counted.processed).alias("processed"),
    )


@query(
    "I6_drain_csv",
    S.PRODUCTS_CHECKED + f""", e AS (SELECT *, stock_v IS NULL OR stock_v < 0 OR (created_at IS NOT NULL AND created_v IS NULL) AS bad FROM pv WHERE product_id IS NOT NULL)
    SELECT 'product_' || product_id AS canonical_id, coalesce(name, '') AS title, category, CASE WHEN k % 4 = 0 THEN 7.25 ELSE price_v END AS price,
    stock_v AS stock, {S.ts_text("created_v")} AS created FROM e
    WHERE NOT bad AND (k % 4 = 0 OR (price_v IS NOT NULL AND price_v >= 0 AND NOT isnan(price_v)))""",
)
def drain_csv_files(spark: SparkSession, sf: str) -> DataFrame:
    """Product files drain five at a time; files that land later in the same folders give a quarter of the products a new price."""
    tables, landing = Tables(scratch_path(spark, "tables")), scratch_path(spark, "csv")
    for at, where, price in ((_RUN_AT[0], None, None), (_RUN_AT[1], F.col("k") % 4 == 0, "$7.25")):
        _landed_products(spark, sf, landing, where, price)
        run = Run("csv", at)
        run_source(spark, tables, run, lambda r: drain_csv(spark, tables, r, landing, PRODUCT_COLUMNS, f"{tables.root}/stream", 5))
    rows = tables.unified.current(spark).filter("source_id != ''").withColumn("x", F.from_json("extra_data", "price double, stock_quantity bigint"))
    return rows.select(
        "canonical_id", "title", "category", F.col("x.price").alias("price"), F.col("x.stock_quantity").alias("stock"),
        ts_text("external_created_at").alias("created"),
    )


def _landed_news(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "xml")
    tags = F.when(F.col("tag_list") != "", F.split("tag_list", ","))
    content = F.when(F.col("content") != "", F.array("content"))
    rows = feed(spark, sf, "news").select(
        "guid", "title", "link", F.col("summary").alias("description"), content.alias("content"),
        "author", F.col("published").alias("pubDate"), "updated", tags.alias("category"),
    )
    rows.repartition(6).write.option("maxRecordsPerFile", 500).format("xml").option("rowTag", "item").option("rootTag", "channel").save(path)
    return path


@query(
    "I6_drain_news",
    S.NEWS_ENTRIES + f""" SELECT id AS source_id, 'rss_' || substr(md5(id), 1, 12) AS canonical_id, trim(title) AS title,
    CASE WHEN content = '' THEN summary ELSE trim(content) END AS content, author, CASE WHEN len(tags) > 0 THEN 'news' END AS category, link AS url,
    {S.ts_text("coalesce(published, updated)")} AS created FROM ne""",
)
def drain_news_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Feed documents drain two at a time."""
    tables, landing = Tables(scratch_path(spark, "tables")), _landed_news(spark, sf)
    run = Run("rss", _RUN_AT[0])
    run_source(spark, tables, run, lambda r: drain_news(spark, tables, r, landing, f"{tables.root}/stream", 2))
    return tables.unified.current(spark).select(
        "source_id", "canonical_id", "title", "content", "author", "category", "url", ts_text("external_created_at").alias("created")
    )


def _checkpoint_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = feed(spark, sf, "runs").select(
        "source", F.col("run_id").alias("last_value"), F.col("started_at").alias("last_processed_at"),
        F.col("started_at").alias("updated_at"), F.struct("started_at", "event_id").alias("seq"),
    )
    return upsert_checkpoints(versioned(rows))


@query(
    "I7_checkpoint_read",
    cte("runs") + " SELECT source, arg_max(run_id, row(started_at, event_id)) AS last_value FROM runs WHERE source = 'click' GROUP BY source",
)
def checkpoint_read(spark: SparkSession, sf: str) -> DataFrame:
    return P.checkpoint_of(_checkpoint_rows(spark, sf), "click").select("source", "last_value")


@query(
    "I8_checkpoint_upsert",
    cte("runs") + f""" SELECT source, arg_max(run_id, row(started_at, event_id)) AS last_value,
    {S.ts_text("max(started_at)")} AS updated_at FROM runs GROUP BY source""",
)
def checkpoint_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return _checkpoint_rows(spark, sf).select("source", "last_value", ts_text("updated_at").alias("updated_at"))


# --- validation ----------------------------------------------------------------------------------


@query(
    "V0_reject_split",
    S.PRODUCTS_CHECKED + " SELECT error, count(*) AS records FROM pv WHERE error <> '' GROUP BY error",
)
def reject_split(spark: SparkSession, sf: str) -> DataFrame:
    checked = V.validate_text(I.products(spark, sf), V.PRODUCT_FIELDS)
    return V.rejected(checked).groupBy("error").agg(F.count("*").alias("records"))


@query(
    "V1_ticker_rules",
    S.TICKERS_CHECKED + f""" SELECT id, name, symbol, rank, CASE WHEN error = '' THEN total_supply END AS total_supply,
    {S.ts_text("last_updated")} AS last_updated, price, error FROM tv""",
)
def ticker_rules(spark: SparkSession, sf: str) -> DataFrame:
    ok = F.size("errors") == 0
    return I.checked(spark, sf, "tickers").select(
        "rec.id", "rec.name", "rec.symbol", "rec.rank",
        F.when(ok, F.col("rec.total_supply")).alias("total_supply"),
        ts_text("rec.last_updated").alias("last_updated"),
        F.try_variant_get("rec.quotes", "$.USD.price", "double").alias("price"),
        F.array_join("errors", "; ").alias("error"),
    )


@query(
    "V2_market_rules",
    S.MARKETS_CHECKED + f""" SELECT id, name, symbol, rank, price, volume, ath, image, {S.ts_text("ath_date")} AS ath_date,
    {S.ts_text("last_updated")} AS last_updated, error FROM mv""",
)
def market_rules(spark: SparkSession, sf: str) -> DataFrame:
    return I.checked(spark, sf, "markets").select(
        "rec.id", "rec.name", "rec.symbol", F.col("rec.market_cap_rank").alias("rank"),
        F.col("rec.current_price").alias("price"), F.col("rec.total_volume").alias("volume"), "rec.ath", "rec.image",
        ts_text("rec.ath_date").alias("ath_date"), ts_text("rec.last_updated").alias("last_updated"),
        F.array_join("errors", "; ").alias("error"),
    )


@query(
    "V3_product_rules",
    S.PRODUCTS_CHECKED + f""" SELECT product_id, name, category, CASE WHEN isnan(price_v) THEN -1.0 ELSE price_v END AS price, stock_v AS stock_quantity,
    {S.ts_text("created_v")} AS created_at, error FROM pv""",
)
def product_rules(spark: SparkSession, sf: str) -> DataFrame:
    checked = V.validate_text(I.products(spark, sf), V.PRODUCT_FIELDS)
    return checked.select(
        "rec.product_id", "rec.name", "rec.category", F.nanvl("rec.price", F.lit(-1.0)).alias("price"), "rec.stock_quantity",
        ts_text("rec.created_at").alias("created_at"), F.array_join("errors", "; ").alias("error"),
    )


def _spoiled_entries(spark: SparkSession, sf: str) -> DataFrame:
    """News entries of which some break a rule, and some stand just inside it."""
    page = F.col("_page_id")
    return I.news_entries(spark, sf).withColumns(
        {
            "id": F.when(page % 29 != 0, F.col("id")),
            "title": F.when(page % 7 == 0, F.lit(None)).when(page % 11 == 0, F.repeat(F.lit("ab"), (249 + page % 3).cast("int"))).otherwise(F.col("title")),
            "link": F.when(page % 13 == 0, F.lit(None)).when(page % 17 == 0, F.rpad("link", 513, "x")).otherwise(F.col("link")),
            "tags": F.when(page % 19 != 0, F.col("tags")),
        }
    )


@query(
    "V4_news_rules",
    S.NEWS_ENTRIES + f""", sp AS (SELECT page_id, CASE WHEN page_id % 29 <> 0 THEN id END AS id,
        CASE WHEN page_id % 7 = 0 THEN NULL WHEN page_id % 11 = 0 THEN repeat('ab', CAST(249 + page_id % 3 AS INT)) ELSE title END AS title,
        CASE WHEN page_id % 13 = 0 THEN NULL WHEN page_id % 17 = 0 THEN rpad(link, 513, 'x') ELSE link END AS link,
        author, published, updated, CASE WHEN page_id % 19 <> 0 THEN tags END AS tags FROM ne)
    SELECT page_id, id, title, author, {S.ts_text("published")} AS published, {S.ts_text("updated")} AS updated, array_to_string(tags, ',') AS tags,
    concat_ws('; ', CASE WHEN id IS NULL THEN 'entry_id: required' END, CASE WHEN title IS NULL THEN 'title: required' END,
        CASE WHEN length(title) > 500 THEN 'title: longer than 500' END, CASE WHEN link IS NULL THEN 'link: required' END,
        CASE WHEN length(link) > 512 THEN 'link: longer than 512' END, CASE WHEN tags IS NULL THEN 'tags: null' END) AS error FROM sp""",
)
def news_rules(spark: SparkSession, sf: str) -> DataFrame:
    checked = V.validate_text(_spoiled_entries(spark, sf), V.NEWS_FIELDS)
    return checked.select(
        F.col("_page_id").alias("page_id"), F.col("rec.entry_id").alias("id"), "rec.title", "rec.author", ts_text("rec.published").alias("published"),
        ts_text("rec.updated").alias("updated"), F.array_join("rec.tags", ",").alias("tags"),
        F.array_join("errors", "; ").alias("error"),
    )


@query("V5_post_rules", S.POSTS_CHECKED + " SELECT doc_id, id, user_id, clean_title AS title, clean_body AS body, error FROM pe")
def post_rules(spark: SparkSession, sf: str) -> DataFrame:
    return I.checked_posts(spark, sf).select(
        F.col("_doc_id").alias("doc_id"), "rec.id", "rec.user_id", "rec.title", "rec.body",
        F.array_join("errors", "; ").alias("error"),
    )


@query(
    "V6_internal_fields",
    cte("news") + " SELECT coalesce(nullif(guid, ''), link) AS id, title, link, summary, content, author, published, updated, "
    "CASE WHEN tag_list = '' THEN '' ELSE tag_list END AS tags FROM news",
)
def internal_fields(spark: SparkSession, sf: str) -> DataFrame:
    return V.drop_internal(I.news_entries(spark, sf)).withColumn("tags", F.array_join("tags", ","))


@query(
    "V7_width_limits",
    """SELECT doc_id, concat_ws('; ', CASE WHEN length(source) > 50 THEN 'source: longer than 50' END,
    CASE WHEN length(text) > 500 THEN 'title: longer than 500' END) AS error FROM documents""",
)
def width_limits(spark: SparkSession, sf: str) -> DataFrame:
    """Document texts as titles; most are too wide."""
    docs = table(spark, sf, "documents").select("doc_id", "source", F.col("text").alias("title"))
    errors = V.width_errors({"source": 50, "title": 500})
    return docs.select("doc_id", F.array_join(errors, "; ").alias("error"))


@query("V8_parse_price", S.PRODUCTS_CHECKED + " SELECT k, CASE WHEN isnan(price_v) THEN -1.0 ELSE price_v END AS price FROM pv")
def parse_price(spark: SparkSession, sf: str) -> DataFrame:
    return feed(spark, sf, "products").select("k", F.nanvl(C.parse_price(F.col("price")), F.lit(-1.0)).alias("price"))


@query("V9_parse_quantity", S.PRODUCTS_CHECKED + " SELECT k, stock_v AS quantity FROM pv")
def parse_quantity(spark: SparkSession, sf: str) -> DataFrame:
    return feed(spark, sf, "products").select("k", C.parse_quantity(F.col("stock_quantity")).alias("quantity"))


@query("V10_iso_timestamp", cte("dates") + f" SELECT o_orderkey, {S.ts_text(S.iso('text'))} AS at FROM dates")
def iso_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    return feed(spark, sf, "dates").select("o_orderkey", ts_text(C.iso_timestamp(F.col("text"))).alias("at"))


@query("V11_mail_timestamp", cte("dates") + f" SELECT o_orderkey, {S.ts_text(S.mail_or_iso('text'))} AS at FROM dates")
def mail_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    return feed(spark, sf, "dates").select("o_orderkey", ts_text(C.mail_or_iso_timestamp(F.col("text"))).alias("at"))


@query(
    "V12_strict_timestamp",
    S.PRODUCTS_CHECKED + f" SELECT k, {S.ts_text('created_v')} AS at, created_at IS NOT NULL AND created_v IS NULL AS reject FROM pv",
)
def strict_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    at = C.strict_timestamp(F.col("created_at"))
    return feed(spark, sf, "products").select(
        "k", ts_text(at).alias("at"), (F.col("created_at").isNotNull() & at.isNull()).alias("reject")
    )


@query("V13_clean_string", cte("posts") + f" SELECT doc_id, coalesce({S.strip('title')}, '') AS title, coalesce({S.strip('body')}, '') AS body FROM posts")
def clean_string(spark: SparkSession, sf: str) -> DataFrame:
    return feed(spark, sf, "posts").select(
        "doc_id", C.clean_string(F.col("title")).alias("title"), C.clean_string(F.col("body")).alias("body")
    )


# --- transforms ----------------------------------------------------------------------------------


_EXTRA = (
    "price_usd double, rank bigint, total_supply double, volume_24h_usd double, percent_change_24h double, "
    "_source string, ath double, image string, ath_date string, price double, stock_quantity bigint, updated_at string"
)


def _with_extra(df: DataFrame) -> DataFrame:
    return df.withColumn("x", F.from_json("extra_data", _EXTRA))


def _extra(name: str) -> F.Column:
    return F.col(f"x.{name}")


@query(
    "T1_ticker_record",
    S.TICKER_UNIFIED + f""" SELECT source, source_id, canonical_id, symbol, title, content, category, url,
    {S.ts_text("created")} AS created, price, rank, total_supply, volume, change_24h, 'coinpaprika' AS extra_source, 11 AS extra_keys FROM ut""",
)
def ticker_record(spark: SparkSession, sf: str) -> DataFrame:
    return _with_extra(I.unified(spark, sf, "tickers")).select(
        "source", "source_id", "canonical_id", "symbol", "title", "content", "category", "url",
        ts_text("external_created_at").alias("created"), _extra("price_usd").alias("price"),
        _extra("rank").alias("rank"), _extra("total_supply").alias("total_supply"),
        _extra("volume_24h_usd").alias("volume"), _extra("percent_change_24h").alias("change_24h"),
        _extra("_source").alias("extra_source"), F.size(F.json_object_keys("extra_data")).alias("extra_keys"),
    )


@query(
    "T2_market_record",
    S.MARKET_UNIFIED + f""" SELECT source, source_id, canonical_id, symbol, title, content, category, url,
    {S.ts_text("created")} AS created, price, rank, volume, ath, image,
    strftime(ath_date, '%Y-%m-%dT%H:%M:%S+00:00') AS ath_date, 14 AS extra_keys FROM um""",
)
def market_record(spark: SparkSession, sf: str) -> DataFrame:
    return _with_extra(I.unified(spark, sf, "markets")).select(
        "source", "source_id", "canonical_id", "symbol", "title", "content", "category", "url",
        ts_text("external_created_at").alias("created"), _extra("price_usd").alias("price"),
        _extra("rank").alias("rank"), _extra("volume_24h_usd").alias("volume"),
        _extra("ath").alias("ath"), _extra("image").alias("image"),
        _extra("ath_date").alias("ath_date"), F.size(F.json_object_keys("extra_data")).alias("extra_keys"),
    )


@query(
    "T3_product_record",
    S.PRODUCTS_CHECKED + f""" SELECT 'csv' AS source, product_id AS source_id, 'product_' || product_id AS canonical_id,
    name AS title, description AS content, category, {S.ts_text("created_v")} AS created, price_v AS price,
    stock_v AS stock FROM pv WHERE error = ''""",
)
def product_record(spark: SparkSession, sf: str) -> DataFrame:
    rows = _with_extra(T.product(V.accepted(V.validate_text(I.products(spark, sf), V.PRODUCT_FIELDS))))
    return rows.select(
        "source", "source_id", "canonical_id", "title", "content", "category",
        ts_text("external_created_at").alias("created"), _extra("price").alias("price"),
        _extra("stock_quantity").alias("stock"),
    )


@query(
    "T4_news_record",
    S.NEWS_ENTRIES + f""" SELECT 'rss' AS source, id AS source_id, 'rss_' || substr(md5(id), 1, 12) AS canonical_id, title,
    CASE WHEN content = '' THEN summary ELSE content END AS content, author,
    CASE WHEN len(tags) > 0 THEN 'news' END AS category, link AS url,
    {S.ts_text("coalesce(published, updated)")} AS created, strftime(updated, '%Y-%m-%dT%H:%M:%S+00:00') AS updated FROM ne""",
)
def news_record(spark: SparkSession, sf: str) -> DataFrame:
    rows = _with_extra(T.news(V.accepted(V.validate_text(I.news_entries(spark, sf), V.NEWS_FIELDS))))
    return rows.select(
        "source", "source_id", "canonical_id", "title", "content", "author", "category", "url",
        ts_text("external_created_at").alias("created"), _extra("updated_at").alias("updated"),
    )


@query(
    "T5_post_record",
    S.POSTS_CHECKED + """ SELECT 'api' AS source, CAST(id AS VARCHAR) AS source_id, 'api_post_' || CAST(id AS VARCHAR) AS canonical_id,
    clean_title AS title, clean_body AS content, 'user_' || CAST(user_id AS VARCHAR) AS author, 'posts' AS category,
    'https://jsonplaceholder.typicode.com/posts/' || CAST(id AS VARCHAR) AS url FROM pe WHERE error = ''""",
)
def post_record(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.post(V.accepted(I.checked_posts(spark, sf)))
    return rows.select("source", "source_id", "canonical_id", "title", "content", "author", "category", "url")


@query(
    "T6_checksum",
    S.TICKERS_CHECKED + """ SELECT id, count(*) AS records, count(DISTINCT (name, symbol, rank, total_supply, last_updated,
    json_type(doc, '$.quotes'), doc->>'$.quotes', doc->>'$.note')) AS checksums, 64 AS width FROM tv WHERE error = '' GROUP BY id""",
)
def checksum(spark: SparkSession, sf: str) -> DataFrame:
    """Equal records have equal checksums, different ones different checksums."""
    rows = V.accepted(I.checked(spark, sf, "tickers"))
    return rows.groupBy("rec.id").agg(
        F.count("*").alias("records"), F.countDistinct("checksum").alias("checksums"),
        F.max(F.length("checksum")).alias("width"),
    )
