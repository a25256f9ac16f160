"""Shared pieces of the SQL counterparts (DuckDB dialect)."""

from __future__ import annotations

from recordloom.functions.identity import NAME_TO_SYMBOL, SYMBOL_ALIASES
from workload.feeds import cte


def _case(expr: str, pairs: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items())
    return f"CASE {expr} {whens} ELSE {default} END"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def bare(symbol: str) -> str:
    text = strip(f"lower(coalesce({symbol}, ''))")
    return rf"regexp_replace(regexp_replace({text}, '^wrapped[-_\s]?', ''), '[-_\s]?token$', '')"


def norm(symbol: str) -> str:
    b = bare(symbol)
    return _case(b, SYMBOL_ALIASES, b)


def canon(source: str, source_id: str, symbol: str, name: str) -> str:
    plain = strip(f"lower({name})")
    word = rf"nullif(substr(regexp_extract({plain}, '^(\S+)', 1), 1, 10), '')"
    return (
        f"coalesce(nullif({norm(symbol)}, ''), {_case(plain, NAME_TO_SYMBOL, 'NULL')}, {word}, "
        f"{source} || '_' || {source_id})"
    )


def ts_text(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def iso(x: str) -> str:
    """ISO text to a UTC timestamp."""
    zoned = f"TRY_CAST({x} AS TIMESTAMPTZ) AT TIME ZONE 'UTC'"
    return (
        f"CASE WHEN regexp_matches({x}, '(Z|[+-][0-9]{{2}}:[0-9]{{2}})$') THEN {zoned} "
        f"WHEN regexp_matches({x}, '^[0-9]{{4}}-') THEN TRY_CAST({x} AS TIMESTAMP) END"
    )


# Checked ticker documents: tv has the typed values and the joined error text.
TICKERS_CHECKED = cte("tickers") + rf""", tj AS (
  SELECT batch_no, row_pos, written_at, doc,
         doc->>'$.id' AS id, doc->>'$.name' AS name, doc->>'$.symbol' AS symbol,
         json_type(doc, '$.rank') AS rank_t, doc->>'$.rank' AS rank_s,
         json_type(doc, '$.total_supply') AS ts_t, doc->>'$.total_supply' AS ts_s,
         {iso("(doc->>'$.last_updated')")} AS last_updated,
         TRY_CAST(doc->>'$.quotes.USD.price' AS DOUBLE) AS price,
         TRY_CAST(doc->>'$.quotes.USD.volume_24h' AS DOUBLE) AS volume,
         TRY_CAST(doc->>'$.quotes.USD.percent_change_24h' AS DOUBLE) AS change_24h
  FROM tickers),
tw AS (
  SELECT *,
         CASE WHEN rank_t IN ('UBIGINT', 'BIGINT') THEN TRY_CAST(rank_s AS BIGINT)
              WHEN rank_t = 'DOUBLE' AND TRY_CAST(rank_s AS DOUBLE) = floor(TRY_CAST(rank_s AS DOUBLE)) THEN CAST(TRY_CAST(rank_s AS DOUBLE) AS BIGINT)
              WHEN rank_t = 'VARCHAR' AND regexp_full_match(rank_s, '[+-]?[0-9]+(\.0*)?') THEN CAST(TRY_CAST(rank_s AS DOUBLE) AS BIGINT) END AS rank,
         TRY_CAST(ts_s AS DOUBLE) AS total_supply
  FROM tj),
tv AS (
  SELECT *, concat_ws('; ',
         CASE WHEN rank_t = 'NULL' THEN 'rank: required' END,
         CASE WHEN rank_t <> 'NULL' AND rank IS NULL THEN 'rank: not a valid int' END,
         CASE WHEN rank < 0 THEN 'rank: below 0' END,
         CASE WHEN ts_t <> 'NULL' AND total_supply IS NULL THEN 'total_supply: not a valid float' END) AS error
  FROM tw)"""

# Checked market documents, continuing a WITH clause that has ``markets``.
_MARKETS = rf"""mj AS (
  SELECT batch_no, row_pos, written_at, doc,
         doc->>'$.id' AS id, doc->>'$.name' AS name, doc->>'$.symbol' AS symbol,
         TRY_CAST(doc->>'$.current_price' AS DOUBLE) AS price,
         TRY_CAST(doc->>'$.market_cap_rank' AS BIGINT) AS rank,
         json_type(doc, '$.total_volume') AS vol_t, TRY_CAST(doc->>'$.total_volume' AS DOUBLE) AS volume,
         CASE WHEN json_type(doc, '$.ath') = 'BOOLEAN' THEN 1.0 ELSE TRY_CAST(doc->>'$.ath' AS DOUBLE) END AS ath,
         {iso("(doc->>'$.ath_date')")} AS ath_date,
         json_type(doc, '$.image') AS image_t,
         CASE WHEN json_type(doc, '$.image') = 'VARCHAR' THEN doc->>'$.image' END AS image,
         {iso("(doc->>'$.last_updated')")} AS last_updated
  FROM markets),
mv AS (
  SELECT *, concat_ws('; ',
         CASE WHEN length(symbol) > 20 THEN 'symbol: longer than 20' END,
         CASE WHEN name IS NULL THEN 'name: required' END,
         CASE WHEN image_t <> 'VARCHAR' THEN 'image: not a valid str' END,
         CASE WHEN volume IS NULL THEN 'total_volume: not a valid float' END) AS error
  FROM mj)"""

MARKETS_CHECKED = cte("markets") + ", " + _MARKETS

_TICKER_UNIFIED = f"""ut AS (
  SELECT 'coinpaprika' AS source, id AS source_id, {canon("'coinpaprika'", "id", "symbol", "name")} AS canonical_id,
         lower(symbol) AS symbol, name AS title, symbol || ' - Rank #' || CAST(rank AS VARCHAR) AS content,
         'cryptocurrency' AS category, 'https://coinpaprika.com/coin/' || id || '/' AS url,
         last_updated AS created, price, rank, total_supply, volume, change_24h,
         CAST(NULL AS DOUBLE) AS ath, CAST(NULL AS TIMESTAMP) AS ath_date, CAST(NULL AS VARCHAR) AS image,
         written_at, 0 AS source_order, batch_no, row_pos
  FROM tv WHERE error = '')"""

_MARKET_UNIFIED = f"""um AS (
  SELECT 'coingecko' AS source, id AS source_id, {canon("'coingecko'", "id", "symbol", "name")} AS canonical_id,
         lower(symbol) AS symbol, name AS title,
         upper(symbol) || ' - Rank #' || coalesce(CAST(nullif(rank, 0) AS VARCHAR), 'N/A') AS content,
         'cryptocurrency' AS category, 'https://www.coingecko.com/en/coins/' || id AS url,
         last_updated AS created, price, rank, CAST(NULL AS DOUBLE) AS total_supply, volume,
         CAST(NULL AS DOUBLE) AS change_24h, ath, ath_date, image,
         written_at, 1 AS source_order, batch_no, row_pos
  FROM mv WHERE error = '')"""

TICKER_UNIFIED = TICKERS_CHECKED + ", " + _TICKER_UNIFIED
MARKET_UNIFIED = MARKETS_CHECKED + ", " + _MARKET_UNIFIED

# Both feeds' unified rows with their write sequence.
BOTH_UNIFIED = (
    TICKERS_CHECKED + ", " + cte("markets")[len("WITH ") :] + ", " + _MARKETS + ", " + _TICKER_UNIFIED + ", "
    + _MARKET_UNIFIED
    + """, u AS (SELECT *, row(written_at, source_order, batch_no, row_pos) AS seq
         FROM (SELECT * FROM ut UNION ALL SELECT * FROM um))"""
)

# Typed product rows with their error text.
PRODUCTS_CHECKED = cte("products") + rf""", pj AS (
  SELECT *, {strip("replace(replace(price, '$', ''), ',', '')")} AS price_s FROM products),
pw AS (
  SELECT *,
         CASE WHEN price IS NULL OR price_s = '' THEN 0.0
              WHEN regexp_full_match(price_s, '[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?') OR lower(price_s) = 'nan'
              THEN TRY_CAST(price_s AS DOUBLE) END AS price_v,
         CASE WHEN stock_quantity IS NULL OR stock_quantity = '' THEN 0
              ELSE CAST(trunc(TRY_CAST(stock_quantity AS DOUBLE)) AS BIGINT) END AS stock_v,
         CASE WHEN regexp_full_match(created_at, '[0-9]+') THEN make_timestamp(CAST(created_at AS BIGINT) * 1000000)
              WHEN created_at LIKE '% %+02:00' THEN TRY_CAST(created_at AS TIMESTAMPTZ) AT TIME ZONE 'UTC'
              ELSE {iso("created_at")} END AS created_v
  FROM pj),
pv AS (
  SELECT *, concat_ws('; ',
         CASE WHEN product_id IS NULL THEN 'product_id: required' END,
         CASE WHEN name IS NULL THEN 'name: required' END,
         CASE WHEN category IS NULL THEN 'category: required' END,
         CASE WHEN price_v IS NULL THEN 'price: not a valid price' END,
         CASE WHEN price_v < 0 OR isnan(price_v) THEN 'price: below 0' END,
         CASE WHEN stock_v IS NULL THEN 'stock_quantity: not a valid quantity' END,
         CASE WHEN stock_v < 0 THEN 'stock_quantity: below 0' END,
         CASE WHEN created_at IS NOT NULL AND created_v IS NULL THEN 'created_at: not a valid strict_time' END) AS error
  FROM pw)"""


def mail_or_iso(x: str) -> str:
    """Mail date or ISO text to a UTC timestamp."""
    day = rf"regexp_replace(trim({x}), '^[A-Za-z]{{3}},?\s*', '')"
    bare_day = f"TRY_STRPTIME(regexp_extract({day}, '^([0-9]+ [A-Za-z]+ [0-9]+ [0-9:]+)', 1), '%d %b %Y %H:%M:%S')"
    zone = f"regexp_extract({day}, '([+-][0-9]{{4}})$', 1)"
    hours = f"CAST(coalesce(nullif(substr({zone}, 1, 3), ''), '0') AS INT)"
    return f"coalesce({bare_day} - INTERVAL 1 HOUR * {hours}, {iso(x)})"


# News entries: the feed step (id and content fallbacks, tags) and the unified projection.
NEWS_ENTRIES = cte("news") + f""", ne AS (
  SELECT coalesce(nullif(guid, ''), link) AS id, title, link, summary,
         content, author,
         {mail_or_iso("published")} AS published, {mail_or_iso("updated")} AS updated,
         CASE WHEN tag_list = '' THEN [] ELSE string_split(tag_list, ',') END AS tags, feed_url, page_id
  FROM news)"""

# Posts with their JSON-typed ids resolved.
POSTS_CHECKED = cte("posts") + rf""", po AS (
  SELECT *, CASE WHEN regexp_full_match(id_json, '"?[0-9]+"?') THEN CAST(replace(id_json, '"', '') AS BIGINT) END AS id,
         coalesce({strip("title")}, '') AS clean_title, {strip("body")} AS clean_body
  FROM posts),
pe AS (
  SELECT *, concat_ws('; ', CASE WHEN id_json = 'null' THEN 'id: required' WHEN id IS NULL THEN 'id: not a valid int' END) AS error
  FROM po)"""
