"""Identity, upserts and merged entities (N, W)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.functions import identity as N
from recordloom.operators import entities as E
from recordloom.operators import reports as R
from recordloom.operators import upsert as U
from recordloom.operators import validate as V
from recordloom.plans.ingest import Run, ingest_batch, run_source
from recordloom.plans.rebuild import rebuild as rebuild_store
from recordloom.plans.rebuild import rebuild_unified
from recordloom.plans.tables import Tables
from recordloom.session import scratch_path
from recordloom.sources.json_feed import parse_documents
from workload import inputs as I
from workload import sqltext as S
from workload.feeds import cte, feed, table
from workload.inputs import ts_text
from workload.registry import query



@query(
    "N1_normalize_symbol",
    cte("tickers") + f""", s AS (SELECT DISTINCT doc->>'$.symbol' AS symbol FROM tickers)
    SELECT symbol, {S.norm("symbol")} AS normalized FROM s""",
)
def normalize_symbol(spark: SparkSession, sf: str) -> DataFrame:
    symbols = I.documents(spark, sf, "tickers").select(F.try_variant_get("payload", "$.symbol", "string").alias("symbol"))
    return symbols.distinct().select("symbol", N.normalize_symbol(F.col("symbol")).alias("normalized"))


_CANON_INPUT = """WITH c AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN ' Token ' WHEN 2 THEN CAST(NULL AS VARCHAR) ELSE p_brand END AS symbol,
    CASE p_partkey % 6 WHEN 0 THEN ' Bitcoin' WHEN 1 THEN 'USD Coin' WHEN 2 THEN '' WHEN 3 THEN CAST(NULL AS VARCHAR) WHEN 4 THEN upper(p_name) ELSE 'extraordinarily ' || p_name END AS name FROM part)"""


@query(
    "N2_canonical_id",
    _CANON_INPUT + f""" SELECT p_partkey, {S.canon("'parts'", "CAST(p_partkey AS VARCHAR)", "symbol", "name")} AS canonical_id FROM c""",
)
def canonical_id(spark: SparkSession, sf: str) -> DataFrame:
    """Every fallback of the id: symbol, known name, first word of the name, source and id."""
    key = F.col("p_partkey")
    parts = table(spark, sf, "part").select(
        key,
        F.when(key % 4 == 0, "").when(key % 4 == 1, " Token ").when(key % 4 == 2, F.lit(None)).otherwise(F.col("p_brand")).alias("symbol"),
        F.when(key % 6 == 0, " Bitcoin").when(key % 6 == 1, "USD Coin").when(key % 6 == 2, "").when(key % 6 == 3, F.lit(None))
        .when(key % 6 == 4, F.upper("p_name")).otherwise(F.concat(F.lit("extraordinarily "), "p_name")).alias("name"),
    )
    resolved = N.with_canonical_id(parts, F.lit("parts"), key.cast("string"), F.col("symbol"), F.col("name"))
    return resolved.select("p_partkey", "canonical_id")


@query(
    "N3_alias_table",
    cte("tickers") + f""", a AS (SELECT 'sym' || CAST(c_custkey AS VARCHAR) AS alias, c_mktsegment AS symbol FROM customer),
    s AS (SELECT doc->>'$.id' AS id, {S.bare("(doc->>'$.symbol')")} AS b FROM tickers)
    SELECT id, coalesce(a.symbol, b) AS resolved, count(*) AS records FROM s LEFT JOIN a ON b = alias GROUP BY ALL""",
)
def alias_table(spark: SparkSession, sf: str) -> DataFrame:
    """A user's alias table as large as the customer table."""
    aliases = table(spark, sf, "customer").select(
        F.concat(F.lit("sym"), F.col("c_custkey").cast("string")).alias("alias"), F.col("c_mktsegment").alias("symbol")
    )
    docs = I.documents(spark, sf, "tickers").select(
        F.try_variant_get("payload", "$.id", "string").alias("id"), F.try_variant_get("payload", "$.symbol", "string").alias("symbol")
    )
    resolved = N.with_alias_table(docs, "symbol", aliases, "resolved")
    return resolved.groupBy("id", "resolved").agg(F.count("*").alias("records"))


@query(
    "N4_merge_extra_data",
    S.BOTH_UNIFIED + """, top AS (SELECT canonical_id, arg_max(row(price, rank), seq) AS latest,
        arg_max(row(ath_date), CASE WHEN source = 'coingecko' THEN seq END) AS g, count(DISTINCT source) AS sources,
        arg_max(row(price), CASE WHEN source = 'coinpaprika' THEN seq END) AS pp,
        arg_max(row(price), CASE WHEN source = 'coingecko' THEN seq END) AS gp FROM u GROUP BY canonical_id)
    SELECT canonical_id, latest[1] AS price, latest[2] AS rank, strftime(g[1], '%Y-%m-%dT%H:%M:%S+00:00') AS ath_date,
    pp[1] AS ticker_price, gp[1] AS market_price, sources FROM top""",
)
def merge_extra_data(spark: SparkSession, sf: str) -> DataFrame:
    rows = U.versioned(I.both(spark, sf)).select("canonical_id", "source", "extra_data", U.LAST_SEQ)
    block = "struct<price_usd:double>"
    merged = U.merge_extra_data(rows).withColumn(
        "x", F.from_json("extra_data", f"price_usd double, rank bigint, ath_date string, _coinpaprika {block}, _coingecko {block}")
    )
    here = F.col("x._coinpaprika").isNotNull().cast("int") + F.col("x._coingecko").isNotNull().cast("int")
    return merged.select(
        "canonical_id", F.col("x.price_usd").alias("price"), F.col("x.rank").alias("rank"), F.col("x.ath_date").alias("ath_date"),
        F.col("x._coinpaprika.price_usd").alias("ticker_price"), F.col("x._coingecko.price_usd").alias("market_price"),
        here.alias("sources"),
    )


_UNIFIED_STATE = S.BOTH_UNIFIED + """, w AS (SELECT canonical_id, arg_max(row(source, source_id, symbol, title, content, category, url, price, written_at), seq) AS l,
    arg_min(row(created, written_at), seq) AS f FROM u GROUP BY canonical_id)"""


def _state(spark: SparkSession, sf: str) -> DataFrame:
    return U.upsert_unified(U.versioned(I.both(spark, sf)))


@query("N5_entity_unification", _UNIFIED_STATE + " SELECT l[1] AS source, count(*) AS total_records FROM w GROUP BY l[1]")
def entity_unification(spark: SparkSession, sf: str) -> DataFrame:
    """Both feeds through validation, identity and upsert; entities per last-writing source."""
    state = U.upsert_unified(U.versioned(I.both(spark, sf)), columns=["source"])
    return R.records_per_source(state)


@query(
    "N5_id_collisions",
    S.BOTH_UNIFIED + " SELECT canonical_id, source, count(DISTINCT source_id) AS source_ids FROM u GROUP BY ALL HAVING count(DISTINCT source_id) > 1",
)
def id_collisions(spark: SparkSession, sf: str) -> DataFrame:
    return E.id_collisions(I.both(spark, sf))


@query(
    "N6_source_agreement",
    S.BOTH_UNIFIED + """, a AS (SELECT canonical_id, arg_max(row(price), CASE WHEN source = 'coinpaprika' THEN seq END)[1] AS coinpaprika,
    arg_max(row(price), CASE WHEN source = 'coingecko' THEN seq END)[1] AS coingecko FROM u GROUP BY canonical_id)
    SELECT canonical_id, coinpaprika, coingecko, CAST(coinpaprika IS NOT NULL AS INT) + CAST(coingecko IS NOT NULL AS INT) AS feeds,
    round(abs(coinpaprika - coingecko), 4) AS spread FROM a""",
)
def source_agreement(spark: SparkSession, sf: str) -> DataFrame:
    price = F.get_json_object("extra_data", "$.price_usd").cast("double")
    wide = E.source_agreement(I.both(spark, sf), price, ["coinpaprika", "coingecko"])
    return wide.withColumn("spread", F.round("spread", 4))


# --- upserts -------------------------------------------------------------------------------------


def _raw_documents(spark: SparkSession, sf: str, name: str) -> DataFrame:
    source = {"tickers": "coinpaprika", "markets": "coingecko"}[name]
    docs = I.documents(spark, sf, name)
    return docs.select(
        F.concat(F.lit(f"{source}_"), F.try_variant_get("payload", "$.id", "string")).alias("external_id"),
        "data", F.col("written_at").alias("fetched_at"), F.sha2("data", 256).alias("checksum"), "seq",
    )


def _raw_state(spark: SparkSession, sf: str) -> DataFrame:
    rows = _raw_documents(spark, sf, "tickers").unionByName(_raw_documents(spark, sf, "markets"))
    return U.upsert_raw_api(U.versioned(rows))


_RAW_STATE = cte("tickers", "markets") + """, r AS (
    SELECT 'coinpaprika_' || (doc->>'$.id') AS external_id, doc, written_at, row(written_at, 0, batch_no, row_pos) AS seq FROM tickers
    UNION ALL SELECT 'coingecko_' || (doc->>'$.id'), doc, written_at, row(written_at, 1, batch_no, row_pos) FROM markets)"""


@query(
    "W1_raw_documents",
    _RAW_STATE + f""" SELECT external_id, arg_max(doc, seq) AS data, {S.ts_text("arg_max(written_at, seq)")} AS fetched_at,
    sha256(arg_min(doc, seq)) AS checksum FROM r GROUP BY external_id""",
)
def raw_documents(spark: SparkSession, sf: str) -> DataFrame:
    return _raw_state(spark, sf).select("external_id", "data", ts_text("fetched_at").alias("fetched_at"), "checksum")


@query(
    "W2_raw_csv_rows",
    f"""SELECT coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus || '.csv' END, 'unknown') AS file_name, o_custkey AS row_number,
    arg_max(o_orderpriority, o_orderkey) AS data, {S.ts_text("arg_max(o_orderdate, o_orderkey)")} AS imported_at,
    arg_min(md5(o_orderpriority), o_orderkey) AS checksum FROM orders GROUP BY ALL""",
)
def raw_csv_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as rows of one file per status; a customer's orders rewrite the same row."""
    rows = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.concat("o_orderstatus", F.lit(".csv"))).alias("file_name"),
        F.col("o_custkey").alias("row_number"), F.col("o_orderpriority").alias("data"),
        F.col("o_orderdate").alias("imported_at"), F.md5("o_orderpriority").alias("checksum"), F.col("o_orderkey").alias("seq"),
    )
    return U.upsert_raw_csv(U.versioned(rows)).select(
        "file_name", "row_number", "data", ts_text("imported_at").alias("imported_at"), "checksum"
    )


@query(
    "W3_raw_news_entries",
    cte("news") + """ SELECT feed_url, guid AS entry_id, arg_max(title, page_id) AS data, md5(arg_min(title, page_id)) AS checksum
    FROM news GROUP BY ALL""",
)
def raw_news_entries(spark: SparkSession, sf: str) -> DataFrame:
    rows = feed(spark, sf, "news").select(
        "feed_url", F.col("guid").alias("entry_id"), F.col("title").alias("data"),
        F.lit("2024-01-01").cast("timestamp").alias("fetched_at"), F.md5("title").alias("checksum"), F.col("page_id").alias("seq"),
    )
    return U.upsert_raw_news(U.versioned(rows)).select("feed_url", "entry_id", "data", "checksum")


@query(
    "W4_unified_upsert",
    _UNIFIED_STATE + f""" SELECT canonical_id, l[1] AS source, l[2] AS source_id, l[3] AS symbol, l[4] AS title, l[5] AS content,
    l[6] AS category, l[7] AS url, l[8] AS price, {S.ts_text("f[1]")} AS created, {S.ts_text("f[2]")} AS ingested_at,
    {S.ts_text("l[9]")} AS updated_at FROM w""",
)
def unified_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return _state(spark, sf).select(
        "canonical_id", "source", "source_id", "symbol", "title", "content", "category", "url",
        F.get_json_object("extra_data", "$.price_usd").cast("double").alias("price"),
        ts_text("external_created_at").alias("created"), ts_text("ingested_at").alias("ingested_at"),
        ts_text("updated_at").alias("updated_at"),
    )


@query(
    "W4_change_kinds",
    """WITH cur AS (SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS c FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1),
    b AS (SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS c FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1)
    SELECT o_custkey, CASE WHEN cur.c IS NULL THEN 'inserted' WHEN cur.c = b.c THEN 'unchanged' ELSE 'updated' END AS change
    FROM b LEFT JOIN cur USING (o_custkey)""",
)
def change_kinds(spark: SparkSession, sf: str) -> DataFrame:
    """Orders from 1998 on as a batch against the state of the years before."""
    rows = table(spark, sf, "orders").select(
        "o_custkey", F.col("o_orderpriority").alias("checksum"), F.col("o_orderkey").alias("seq"), "o_orderdate"
    )
    cut = F.lit("1998-01-01").cast("timestamp_ntz")

    def state(part: DataFrame) -> DataFrame:
        return U.reduce_by_key(U.versioned(part.drop("o_orderdate")), ["o_custkey"], ["checksum"])

    old, new = state(rows.filter(F.col("o_orderdate") < cut)), state(rows.filter(F.col("o_orderdate") >= cut))
    return U.changes(old, new, ["o_custkey"]).select("o_custkey", "change")


@query(
    "W5_run_ledger",
    cte("runs") + f""" SELECT run_id, source, status, {S.ts_text("started_at")} AS started_at,
    {S.ts_text("finished_at")} AS finished_at, duration_seconds,
    CASE WHEN status = 'running' THEN 0 ELSE records_processed END AS records_processed,
    CASE WHEN status = 'failed' THEN 'boom' END AS error_message FROM runs""",
)
def run_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Open and close events of every run, reduced to its current state."""
    runs = feed(spark, sf, "runs")
    opened = runs.select(*U.open_run(F.col("run_id"), F.col("source"), F.col("started_at")), F.lit(0).alias("seq"))
    closed = runs.filter(F.col("status") != "running").select(
        "run_id", "source", "started_at", *[c for c in U.LEDGER_LAST if c != "error_message"],
        F.when(F.col("status") == "failed", "boom").alias("error_message"), F.lit(1).alias("seq"),
    )
    state = U.ledger_state(U.versioned(opened.unionByName(closed)))
    return state.select(
        "run_id", "source", "status", ts_text("started_at").alias("started_at"), ts_text("finished_at").alias("finished_at"),
        "duration_seconds", "records_processed", "error_message",
    )


@query(
    "W6_run_counters",
    S.PRODUCTS_CHECKED + """ SELECT category, count(*) AS records_fetched, count_if(error = '') AS records_processed,
    count_if(error <> '') AS records_failed, 0 AS records_skipped FROM pv GROUP BY category""",
)
def run_counters(spark: SparkSession, sf: str) -> DataFrame:
    checked = V.validate_text(I.products(spark, sf), V.PRODUCT_FIELDS)
    return U.run_counters(checked, ["category"])


def _placed(docs: DataFrame) -> DataFrame:
    """Documents with the order of their writes as one number."""
    place = F.unix_date(F.to_date("written_at")).cast("decimal(38,0)") * F.lit(str(10**24)).cast("decimal(25,0)")
    place = place.cast("decimal(38,0)") + F.col("batch_no").cast("decimal(38,0)") * F.lit(str(10**13)).cast("decimal(14,0)") + F.col("row_pos")
    return docs.withColumn("_row_pos", place.cast("decimal(38,0)")).select("data", "payload", "_row_pos")


@query(
    "W7_all_feeds",
    S.BOTH_UNIFIED + ", " + S.PRODUCTS_CHECKED[len("WITH "):] + ", " + S.POSTS_CHECKED[len("WITH "):] + ", " + S.NEWS_ENTRIES[len("WITH "):] + """,
    kept AS (SELECT * FROM u WHERE (source, source_id, seq) IN (
        SELECT 'coinpaprika', id, max(row(written_at, 0, batch_no, row_pos)) FROM tv GROUP BY id
        UNION ALL SELECT 'coingecko', id, max(row(written_at, 1, batch_no, row_pos)) FROM mv GROUP BY id)),
    coins AS (SELECT canonical_id, arg_max(row(source, source_id, title), row(source_order, seq)) AS l FROM kept GROUP BY canonical_id)
    SELECT canonical_id, l[1] AS source, l[2] AS source_id, l[3] AS title FROM coins
    UNION ALL SELECT 'product_' || product_id, 'csv', product_id, name FROM pv WHERE error = ''
    UNION ALL SELECT 'rss_' || substr(md5(id), 1, 12), 'rss', id, title FROM ne
    UNION ALL SELECT 'api_post_' || CAST(id AS VARCHAR), 'api', CAST(id AS VARCHAR), clean_title FROM pe WHERE error = ''""",
)
def rebuild_all(spark: SparkSession, sf: str) -> DataFrame:
    """Five feeds written to a store, one run after another, and the unified table rebuilt from its raw tables."""
    tables = Tables(scratch_path(spark, "tables"))
    documents = {
        name: _placed(parse_documents(feed(spark, sf, kind, heavy=True), "doc")) for name, kind in (("coinpaprika", "tickers"), ("coingecko", "markets"))
    }
    frames = {
        **documents,
        "csv": I.products(spark, sf).withColumns({"_file_name": F.lit("products.csv"), "_row_number": F.col("_k")}),
        "rss": I.news_entries(spark, sf),
        "api": I.post_documents(spark, sf),
    }
    for hour, (name, raw) in enumerate(frames.items()):
        run = Run(name, dt.datetime(2024, 1, 1, hour, tzinfo=dt.timezone.utc))
        run_source(spark, tables, run, lambda r, raw=raw: ingest_batch(tables, r, raw, 1))
    return rebuild_store(spark, tables).select("canonical_id", "source", "source_id", "title")


@query(
    "W7_rebuild",
    S.BOTH_UNIFIED + f""", kept AS (SELECT * FROM u WHERE (source, source_id, seq) IN (
        SELECT 'coinpaprika', id, max(row(written_at, 0, batch_no, row_pos)) FROM tv GROUP BY id
        UNION ALL SELECT 'coingecko', id, max(row(written_at, 1, batch_no, row_pos)) FROM mv GROUP BY id)),
    w AS (SELECT canonical_id, arg_max(row(source, source_id, title, price, written_at), seq) AS l, arg_min(row(written_at), seq) AS f
        FROM kept GROUP BY canonical_id)
    SELECT canonical_id, l[1] AS source, l[2] AS source_id, l[3] AS title, l[4] AS price, {S.ts_text("l[5]")} AS updated_at,
    {S.ts_text("f[1]")} AS ingested_at FROM w""",
)
def rebuild(spark: SparkSession, sf: str) -> DataFrame:
    """Unified table from the stored raw documents alone."""
    return rebuild_unified(_raw_state(spark, sf)).select(
        "canonical_id", "source", "source_id", "title", F.get_json_object("extra_data", "$.price_usd").cast("double").alias("price"),
        ts_text("updated_at").alias("updated_at"), ts_text("ingested_at").alias("ingested_at"),
    )
