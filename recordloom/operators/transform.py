"""Projection of each validated feed (``rec`` struct) to the unified record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions.identity import with_canonical_id

UNIFIED_INPUT = (
    "source",
    "source_id",
    "canonical_id",
    "symbol",
    "title",
    "content",
    "author",
    "category",
    "url",
    "external_created_at",
    "extra_data",
    "checksum",
)

# Link prefixes of the feeds.
TICKER_URL = "https://coinpaprika.com/coin/"
MARKET_URL = "https://www.coingecko.com/en/coins/"
POST_URL = "https://jsonplaceholder.typicode.com"


# The categories, content forms and extra_data keys of the mappings below.


def _r(name: str) -> Column:
    return F.col(f"rec.{name}")


def _json(**fields: Column) -> Column:
    return F.to_json(
        F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"}
    )


def iso_text(ts: Column) -> Column:
    """ISO text with a UTC offset; the fraction appears only when there is one."""
    micros = F.date_format(ts, "SSSSSS")
    return F.when(
        ts.isNotNull(),
        F.concat(
            F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
            F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros)),
            F.lit("+00:00"),
        ),
    )


def _emit(df: DataFrame, keep: tuple[str, ...], **columns: Column) -> DataFrame:
    missing = {n: F.lit(None).cast("string") for n in UNIFIED_INPUT if n not in columns and n != "checksum"}
    columns = {**missing, **columns, "checksum": F.col("checksum")}
    return df.select(*keep, *[columns[n].alias(n) for n in UNIFIED_INPUT])


_USD = ("price", "volume_24h", "market_cap", "percent_change_24h", "percent_change_7d")


def ticker(df: DataFrame, keep: tuple[str, ...] = (), source: str = "coinpaprika") -> DataFrame:
    def usd(name: str) -> Column:
        return F.col(f"_quotes.USD.{name}")

    resolved = with_canonical_id(df, F.lit(source), _r("id"), _r("symbol"), _r("name"), "_cid")
    # One cast for all quotes: a path that leads nowhere costs more than one that does, and most documents lack some.
    resolved = resolved.withColumn("_quotes", _r("quotes").try_cast("struct<USD:struct<" + ",".join(f"{n}:double" for n in _USD) + ">>"))
    return _emit(
        resolved,
        keep,
        source=F.lit(source),
        source_id=_r("id"),
        canonical_id=F.col("_cid"),
        symbol=F.lower(_r("symbol")),
        title=_r("name"),
        content=F.concat(_r("symbol"), F.lit(" - Rank #"), _r("rank").cast("string")),
        category=F.lit("cryptocurrency"),
        url=F.concat(F.lit(TICKER_URL), _r("id"), F.lit("/")),
        external_created_at=_r("last_updated"),
        extra_data=_json(
            symbol=_r("symbol"),
            rank=_r("rank"),
            price_usd=usd("price"),
            volume_24h_usd=usd("volume_24h"),
            market_cap_usd=usd("market_cap"),
            percent_change_24h=usd("percent_change_24h"),
            percent_change_7d=usd("percent_change_7d"),
            circulating_supply=_r("circulating_supply"),
            total_supply=_r("total_supply"),
            max_supply=_r("max_supply"),
            _source=F.lit(source),
        ),
    )


def market(df: DataFrame, keep: tuple[str, ...] = (), source: str = "coingecko") -> DataFrame:
    rank_text = F.coalesce(F.nullif(_r("market_cap_rank"), F.lit(0)).cast("string"), F.lit("N/A"))
    resolved = with_canonical_id(df, F.lit(source), _r("id"), _r("symbol"), _r("name"), "_cid")
    return _emit(
        resolved,
        keep,
        source=F.lit(source),
        source_id=_r("id"),
        canonical_id=F.col("_cid"),
        symbol=F.lower(_r("symbol")),
        title=_r("name"),
        content=F.concat(F.upper(_r("symbol")), F.lit(" - Rank #"), rank_text),
        category=F.lit("cryptocurrency"),
        url=F.concat(F.lit(MARKET_URL), _r("id")),
        external_created_at=_r("last_updated"),
        extra_data=_json(
            symbol=_r("symbol"),
            rank=_r("market_cap_rank"),
            price_usd=_r("current_price"),
            volume_24h_usd=_r("total_volume"),
            market_cap_usd=_r("market_cap"),
            percent_change_24h=_r("price_change_percentage_24h"),
            percent_change_7d=_r("price_change_percentage_7d_in_currency"),
            circulating_supply=_r("circulating_supply"),
            total_supply=_r("total_supply"),
            max_supply=_r("max_supply"),
            ath=_r("ath"),
            ath_date=iso_text(_r("ath_date")),
            image=_r("image"),
            _source=F.lit(source),
        ),
    )


def product(df: DataFrame, keep: tuple[str, ...] = (), source: str = "csv") -> DataFrame:
    return _emit(
        df,
        keep,
        source=F.lit(source),
        source_id=_r("product_id"),
        canonical_id=F.concat(F.lit("product_"), _r("product_id")),
        title=_r("name"),
        content=_r("description"),
        category=_r("category"),
        external_created_at=_r("created_at"),
        extra_data=_json(
            price=_r("price"), stock_quantity=_r("stock_quantity"), product_id=_r("product_id")
        ),
    )


def news(df: DataFrame, keep: tuple[str, ...] = (), source: str = "rss") -> DataFrame:
    tags = F.coalesce(_r("tags"), F.array().cast("array<string>"))
    return _emit(
        df,
        keep,
        source=F.lit(source),
        source_id=_r("entry_id"),
        canonical_id=F.concat(F.lit("rss_"), F.substring(F.md5(_r("entry_id")), 1, 12)),
        title=_r("title"),
        content=F.coalesce(F.nullif(_r("content"), F.lit("")), _r("summary")),
        author=_r("author"),
        category=F.when(F.size(tags) > 0, F.lit("news")),
        url=_r("link"),
        external_created_at=F.coalesce(_r("published"), _r("updated")),
        extra_data=_json(tags=tags, updated_at=iso_text(_r("updated"))),
    )


def post(
    df: DataFrame, keep: tuple[str, ...] = (), source: str = "api", base_url: str = POST_URL
) -> DataFrame:
    post_id = _r("id").cast("string")
    return _emit(
        df,
        keep,
        source=F.lit(source),
        source_id=post_id,
        canonical_id=F.concat(F.lit("api_post_"), post_id),
        title=_r("title"),
        content=_r("body"),
        author=F.concat(F.lit("user_"), _r("user_id").cast("string")),
        category=F.lit("posts"),
        url=F.concat(F.lit(base_url), F.lit("/posts/"), post_id),
        extra_data=_json(user_id=_r("user_id"), original_id=_r("id")),
    ).withColumn("external_created_at", F.col("external_created_at").cast("timestamp"))
