"""Feeds as data: what to validate and how to map it. Adding a feed is adding a ``SourceSpec``."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.operators import transform as T
from recordloom.operators import validate as V
from recordloom.sources.csv_feed import extra_fields_rule


@dataclass(frozen=True)
class SourceSpec:
    """``validate`` adds rec/errors/checksum, ``transform`` projects to the unified record,
    ``raw_table`` names the table of its raw rows, ``order`` ranks feeds that start together."""

    name: str
    validate: Callable[[DataFrame], DataFrame]
    transform: Callable[..., DataFrame]
    raw_table: str
    order: int
    enabled: bool = True

    def process(self, raw: DataFrame, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
        """(unified rows, rejects) of a raw frame."""
        checked = self.validate(raw)
        return self.transform(V.accepted(checked), keep), V.rejected(checked)


def _products(df: DataFrame) -> DataFrame:
    rules = [extra_fields_rule()] if "_extra_fields" in df.columns else []
    declared = {f.raw_key for f in V.PRODUCT_FIELDS}
    extras = [c for c in df.columns if not c.startswith("_") and c not in declared]
    return V.validate_text(df, V.PRODUCT_FIELDS, extras, rules)


# Source names. Only the first three are enabled by default.
SOURCES: dict[str, SourceSpec] = {
    s.name: s
    for s in (
        SourceSpec("coinpaprika", lambda d: V.validate_json(d, V.TICKER_FIELDS), T.ticker, "raw_api", 0),
        SourceSpec("coingecko", lambda d: V.validate_json(d, V.MARKET_FIELDS), T.market, "raw_api", 1),
        SourceSpec("csv", _products, T.product, "raw_csv", 2),
        SourceSpec("rss", lambda d: V.validate_text(d, V.NEWS_FIELDS), T.news, "raw_news", 3, enabled=False),
        SourceSpec("api", lambda d: V.validate_json(d, V.POST_FIELDS), T.post, "raw_api", 4, enabled=False),
    )
}


def enabled_sources(specs: Iterable[SourceSpec] | None = None) -> list[SourceSpec]:
    chosen = SOURCES.values() if specs is None else specs
    return sorted((s for s in chosen if s.enabled), key=lambda s: s.order)


def unify_feeds(feeds: dict[str, DataFrame], keep: tuple[str, ...] = ()) -> DataFrame:
    """All feeds' accepted rows in one unified frame."""
    frames = [SOURCES[name].process(raw, keep)[0] for name, raw in feeds.items()]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def reject_report(feeds: dict[str, DataFrame]) -> DataFrame:
    """Accepted and rejected counts per feed, one scan of each."""
    counts = [
        SOURCES[name]
        .validate(raw)
        .agg(
            F.lit(name).alias("source"),
            F.count_if(F.size("errors") == 0).alias("accepted"),
            F.count_if(F.size("errors") > 0).alias("rejected"),
        )
        for name, raw in feeds.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
