"""Feeds derived from the given tables.

Each derivation is one SELECT both Spark and DuckDB accept, over a whole table. The variants a rule
has to handle are spread over the rows by key arithmetic; no row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# One ticker document per line item.
TICKERS = """
SELECT l_orderkey AS batch_no,
       (CAST(l_linenumber AS BIGINT) * 1000000 + l_partkey) * 1000000 + l_suppkey AS row_pos,
       l_shipdate AS written_at,
       '{"id":"c-' || CAST(l_partkey AS STRING) || '","name":"Coin ' || CAST(l_partkey AS STRING) || '","symbol":"'
       || CASE l_partkey % 6
            WHEN 0 THEN 'SYM' || CAST(l_partkey AS STRING)
            WHEN 1 THEN 'wrapped-sym' || CAST(l_partkey AS STRING)
            WHEN 2 THEN 'Sym' || CAST(l_partkey AS STRING) || '-token'
            WHEN 3 THEN '  sym' || CAST(l_partkey AS STRING) || ' '
            WHEN 4 THEN ''
            ELSE 'tether' END
       || '","rank":'
       || CASE (l_orderkey * 7 + l_linenumber) % 50
            WHEN 0 THEN '-1' WHEN 1 THEN '1.5' WHEN 2 THEN '"3"' WHEN 3 THEN 'null' WHEN 4 THEN '4.0'
            ELSE CAST(l_linenumber AS STRING) END
       || ',"total_supply":'
       || CASE (l_orderkey * 7 + l_linenumber) % 60
            WHEN 0 THEN '"abc"' WHEN 1 THEN '"12.5"' WHEN 2 THEN 'null'
            ELSE CAST(l_quantity AS STRING) END
       || ',"last_updated":'
       || CASE (l_orderkey * 7 + l_linenumber) % 40
            WHEN 0 THEN '"soon"' WHEN 1 THEN 'null'
            ELSE '"' || substr(CAST(l_shipdate AS STRING), 1, 10) || 'T10:30:00Z"' END
       || ',"note":"' || l_returnflag
       || '","quotes":'
       || CASE (l_orderkey * 7 + l_linenumber) % 30
            WHEN 0 THEN 'null' WHEN 1 THEN '{}'
            ELSE '{"USD":{"price":' || CAST(l_extendedprice AS STRING) || ',"volume_24h":' || CAST(l_quantity AS STRING)
                 || ',"percent_change_24h":' || CAST(l_discount AS STRING) || '}}' END
       || '}' AS doc
FROM lineitem
"""

# One market document per order.
MARKETS = """
SELECT o_orderkey AS batch_no,
       CAST(0 AS BIGINT) AS row_pos,
       o_orderdate AS written_at,
       '{"id":"coin-' || CAST(o_custkey AS STRING) || '","symbol":"'
       || CASE WHEN o_orderkey % 90 = 1 THEN 'a-symbol-that-is-far-too-long'
               WHEN o_custkey % 5 = 0 THEN 'wrapped_SYM' || CAST(o_custkey AS STRING)
               ELSE 'sym' || CAST(o_custkey AS STRING) END
       || '",' || CASE WHEN o_orderkey % 70 = 0 THEN '' ELSE '"name":"Coin ' || CAST(o_custkey AS STRING) || '",' END
       || '"current_price":' || CAST(o_totalprice AS STRING)
       || ',"market_cap_rank":' || CASE WHEN o_orderkey % 13 = 0 THEN 'null' ELSE CAST(o_orderkey % 11 AS STRING) END
       || ',"total_volume":' || CASE WHEN o_orderkey % 31 = 0 THEN '"many"' ELSE CAST(o_custkey AS STRING) END
       || ',"ath":' || CASE WHEN o_orderkey % 17 = 0 THEN 'true' ELSE '9.5' END
       || ',"ath_date":"' || substr(CAST(o_orderdate AS STRING), 1, 10) || 'T00:00:00.000Z"'
       || ',"image":' || CASE WHEN o_orderkey % 19 = 0 THEN '5' ELSE '"img/' || o_orderstatus || '.png"' END
       || ',"last_updated":"' || substr(CAST(o_orderdate AS STRING), 1, 10) || 'T08:00:00+02:00"'
       || '}' AS doc
FROM orders
"""

# One product row per order, all values text.
PRODUCTS = """
SELECT CASE WHEN o_orderkey % 101 = 0 THEN CAST(NULL AS STRING) ELSE 'P' || CAST(o_orderkey AS STRING) END AS product_id,
       CASE WHEN o_orderkey % 97 = 0 THEN CAST(NULL AS STRING)
            WHEN o_orderkey % 7 = 0 THEN 'Item, "' || o_orderstatus || '" ' || CAST(o_custkey AS STRING)
            ELSE 'Item ' || CAST(o_orderkey AS STRING) END AS name,
       CASE WHEN o_orderkey % 89 = 0 THEN '' ELSE o_orderpriority END AS category,
       CASE WHEN o_orderkey % 41 = 0 THEN 'abc'
            WHEN o_orderkey % 43 = 0 THEN '-' || CAST(o_totalprice AS STRING)
            WHEN o_orderkey % 37 = 0 THEN ''
            WHEN o_orderkey % 47 = 0 THEN '12d'
            WHEN o_orderkey % 53 = 0 THEN 'nan'
            WHEN o_orderkey % 3 = 0 THEN '$' || CAST(o_totalprice AS STRING)
            WHEN o_orderkey % 3 = 1 AND o_totalprice >= 1000 THEN
                 CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS STRING) || ','
                 || substr(CAST(o_totalprice AS STRING), length(CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS STRING)) + 1)
            ELSE ' ' || CAST(o_totalprice AS STRING) || ' ' END AS price,
       'Ordered by ' || CAST(o_custkey AS STRING) AS description,
       CASE o_orderkey % 23
            WHEN 0 THEN '' WHEN 1 THEN '12.7' WHEN 2 THEN '-3' WHEN 3 THEN 'x' WHEN 4 THEN '-0.5' WHEN 5 THEN '1e2'
            ELSE CAST(o_custkey % 500 AS STRING) END AS stock_quantity,
       CASE o_orderkey % 29
            WHEN 0 THEN '' WHEN 1 THEN 'yesterday' WHEN 2 THEN CAST(1600000000 + o_orderkey AS STRING)
            WHEN 3 THEN substr(CAST(o_orderdate AS STRING), 1, 10) || 'T10:30:00Z'
            WHEN 4 THEN substr(CAST(o_orderdate AS STRING), 1, 10) || ' 10:30:00+02:00'
            ELSE substr(CAST(o_orderdate AS STRING), 1, 10) END AS created_at,
       o_orderkey AS k
FROM orders
"""

# One date text per order: ISO, mail and broken forms.
DATES = """
SELECT o_orderkey,
       CASE o_orderkey % 9
            WHEN 0 THEN substr(CAST(o_orderdate AS STRING), 1, 10)
            WHEN 1 THEN substr(CAST(o_orderdate AS STRING), 1, 10) || 'T10:30:00Z'
            WHEN 2 THEN substr(CAST(o_orderdate AS STRING), 1, 10) || 'T10:30:00+02:00'
            WHEN 3 THEN 'Mon, ' || lpad(CAST(1 + o_orderkey % 28 AS STRING), 2, '0') || ' Jan 2024 12:00:00 GMT'
            WHEN 4 THEN 'Tue, ' || CAST(1 + o_orderkey % 28 AS STRING) || ' Mar 2023 23:05:10 +0200'
            WHEN 5 THEN lpad(CAST(1 + o_orderkey % 28 AS STRING), 2, '0') || ' Dec 2022 01:02:03 -0500'
            WHEN 6 THEN 'not a date'
            WHEN 7 THEN ''
            ELSE CAST(NULL AS STRING) END AS text
FROM orders
"""

# One news entry per page. Tags are a comma list here.
NEWS = """
SELECT CASE WHEN page_id % 6 = 0 THEN '' ELSE 'tag:' || url END AS guid,
       regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
       url AS link,
       CASE WHEN page_id % 4 = 0 THEN '' ELSE 'Summary of page ' || CAST(page_id AS STRING) END AS summary,
       CASE WHEN page_id % 3 = 0 THEN '' ELSE html END AS content,
       CASE WHEN page_id % 5 = 0 THEN '' ELSE 'author ' || CAST(page_id % 11 AS STRING) END AS author,
       CASE page_id % 4
            WHEN 0 THEN 'Mon, ' || lpad(CAST(1 + page_id % 28 AS STRING), 2, '0') || ' Jan 2024 12:00:00 GMT'
            WHEN 1 THEN '2024-01-' || lpad(CAST(1 + page_id % 28 AS STRING), 2, '0') || 'T10:30:00Z'
            WHEN 2 THEN ''
            ELSE 'n/a' END AS published,
       '2024-02-' || lpad(CAST(1 + page_id % 28 AS STRING), 2, '0') || 'T00:00:00Z' AS updated,
       CASE page_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'tech' ELSE 'tech,web' END AS tag_list,
       'https://feeds.example/' || CAST(page_id % 5 AS STRING) AS feed_url,
       page_id
FROM pages
"""

# One post per document. ``id_json`` is the id as JSON.
POSTS = """
SELECT CASE doc_id % 53 WHEN 0 THEN '"not_an_int"' WHEN 1 THEN '"' || CAST(doc_id AS STRING) || '"'
            WHEN 2 THEN CAST(doc_id AS STRING) || '.5' WHEN 3 THEN 'null' ELSE CAST(doc_id AS STRING) END AS id_json,
       n_chars % 100 AS user_id,
       CASE WHEN doc_id % 59 = 0 THEN CAST(NULL AS STRING) ELSE '  ' || source || ' in ' || lang || ' ' END AS title,
       text AS body,
       doc_id, source, lang
FROM documents
"""

# One unified record per document, for listings.
RECORDS = """
SELECT 'd' || CAST(doc_id AS STRING) AS canonical_id,
       source,
       CAST(doc_id AS STRING) AS source_id,
       ' ' || source || ' ' || lang || ' ' AS title,
       text AS content,
       CASE WHEN doc_id % 7 = 0 THEN CAST(NULL AS STRING) ELSE 'User_' || CAST(n_chars % 50 AS STRING) END AS author,
       lang AS category,
       'https://docs.example/' || CAST(doc_id AS STRING) AS url,
       CAST(NULL AS TIMESTAMP) AS external_created_at,
       TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' MINUTE * doc_id AS ingested_at,
       TIMESTAMP '2024-01-02 00:00:00' + INTERVAL '1' MINUTE * doc_id AS updated_at,
       CAST(NULL AS STRING) AS extra_data
FROM documents
"""

# One ETL run per event.
RUNS = """
SELECT 'run-' || CAST(event_id AS STRING) AS run_id,
       event_type AS source,
       CASE event_id % 10 WHEN 0 THEN 'failed' WHEN 1 THEN 'running' ELSE 'success' END AS status,
       ts AS started_at,
       CASE WHEN event_id % 10 = 1 THEN NULL ELSE ts + INTERVAL '1' SECOND * CAST(floor(value) AS INT) END AS finished_at,
       CASE WHEN event_id % 10 = 1 THEN NULL WHEN event_id % 33 = 0 THEN 0.0 ELSE value END AS duration_seconds,
       CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) + event_id % 3 AS records_fetched,
       CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS records_processed,
       event_id % 12 AS records_failed,
       CAST(0 AS BIGINT) AS records_skipped,
       event_id
FROM events
"""

# One request per event, one every 200 ms, so buckets run dry.
REQUESTS = """
SELECT event_id,
       event_type AS source,
       user_id,
       TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '0.2' SECOND * event_id AS requested_at,
       event_type = 'error' AS is_error
FROM events
"""

# One JSON document per order whose shape drifts by key.
SHAPES = """
SELECT o_orderpriority AS source, o_orderkey AS seq,
       '{"order_key":' || CAST(o_orderkey AS STRING)
       || CASE WHEN o_orderkey % 5 = 0 THEN ',"orderstatus":"' ELSE ',"order_status":"' END || o_orderstatus || '"'
       || ',"total_price":' || CASE o_orderkey % 11
              WHEN 0 THEN '"' || CAST(o_totalprice AS STRING) || '"' WHEN 1 THEN 'null' WHEN 2 THEN '12' WHEN 3 THEN '[1,2]'
              WHEN 4 THEN '{"usd":1}' WHEN 5 THEN 'true' ELSE CAST(o_totalprice + 0.001 AS STRING) END
       || CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE ',"cust_key":' || CAST(o_custkey AS STRING) END
       || CASE WHEN o_orderkey % 17 = 0 THEN ',"channel":"web"' ELSE '' END
       || '}' AS doc
FROM orders
"""

DERIVED = {
    "tickers": (TICKERS, "lineitem"),
    "markets": (MARKETS, "orders"),
    "products": (PRODUCTS, "orders"),
    "dates": (DATES, "orders"),
    "news": (NEWS, "pages"),
    "posts": (POSTS, "documents"),
    "records": (RECORDS, "documents"),
    "runs": (RUNS, "events"),
    "requests": (REQUESTS, "events"),
    "shapes": (SHAPES, "orders"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feed(spark: SparkSession, sf_dir: str, name: str, heavy: bool = False) -> DataFrame:
    """A derived feed. Files of the given tables hold zone-less times; they are UTC instants here.

    ``heavy`` announces CPU-bound work per row: a file of one row group is one task however long that takes, so its rows are
    dealt out over ``spark.sql.shuffle.partitions`` first. Moving a row costs little of what parsing its document does.
    """
    text, base = DERIVED[name]
    # Braces of JSON texts are doubled, the one of the table is a parameter.
    template = text.replace("{", "{{").replace("}", "}}").replace(f"FROM {base}", f"FROM {{{base}}}")
    rows = table(spark, sf_dir, base)
    if heavy:
        rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    df = spark.sql(template, **{base: rows})
    zoneless = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else df


def cte(*names: str) -> str:
    """The derivations as DuckDB common table expressions."""
    return "WITH " + ", ".join(f"{n} AS ({DERIVED[n][0]})" for n in names)
