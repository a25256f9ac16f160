"""Identity resolution: one canonical id for the same entity in different feeds.

Everything is a literal-map lookup plus string functions, so resolving ids adds no join and no
shuffle. User-supplied alias tables of any size go through ``with_alias_table`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions.cleaning import strip_space

# Symbol aliases.
SYMBOL_ALIASES = {
    "usdt": "usdt",
    "tether": "usdt",
    "usdc": "usdc",
    "usd-coin": "usdc",
    "wbtc": "wbtc",
    "wrapped-bitcoin": "wbtc",
    "weth": "weth",
    "wrapped-ether": "weth",
}

# Entity name to symbol.
NAME_TO_SYMBOL = {
    "bitcoin": "btc",
    "ethereum": "eth",
    "tether": "usdt",
    "usd coin": "usdc",
    "binance coin": "bnb",
    "ripple": "xrp",
    "cardano": "ada",
    "solana": "sol",
    "dogecoin": "doge",
    "polkadot": "dot",
    "polygon": "matic",
    "litecoin": "ltc",
    "chainlink": "link",
    "avalanche": "avax",
    "uniswap": "uni",
}

# Affixes removed from a symbol, and the length kept of a name's first word.
WRAPPED_PREFIX = r"^wrapped[-_\s]?"
TOKEN_SUFFIX = r"[-_\s]?token$"
NAME_WORD_LENGTH = 10


def _literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def bare_symbol(symbol: Column) -> Column:
    """Lower-case, stripped symbol without its affixes; '' for NULL."""
    text = strip_space(F.lower(F.coalesce(symbol, F.lit(""))))
    # Few symbols have an affix; the pattern runs on those alone.
    text = F.when(F.startswith(text, F.lit("wrapped")), F.regexp_replace(text, WRAPPED_PREFIX, "")).otherwise(text)
    return F.when(F.contains(text, F.lit("token")), F.regexp_replace(text, TOKEN_SUFFIX, "")).otherwise(text)


def normalize_symbol(symbol: Column, aliases: dict[str, str] = SYMBOL_ALIASES) -> Column:
    """Bare symbol after the alias lookup."""
    bare = bare_symbol(symbol)
    return F.coalesce(F.try_element_at(_literal_map(aliases), bare), bare)


def _resolve(source: Column, source_id: Column, bare: Column, plain_name: Column, aliases, names) -> Column:
    first_word = F.substring(F.regexp_extract(plain_name, r"(?U)^(\S+)", 1), 1, NAME_WORD_LENGTH)
    return F.coalesce(
        F.try_element_at(_literal_map(aliases), bare),
        F.when(bare != "", bare),
        F.try_element_at(_literal_map(names), plain_name),
        F.when(plain_name != "", first_word),
        F.concat_ws("_", source, source_id),
    )


def _plain(name: Column) -> Column:
    return strip_space(F.lower(name))


def canonical_id(
    source: Column,
    source_id: Column,
    symbol: Column,
    name: Column,
    aliases: dict[str, str] = SYMBOL_ALIASES,
    names: dict[str, str] = NAME_TO_SYMBOL,
) -> Column:
    """Normalised symbol, else the name's known symbol, else its first word, else source + id."""
    return _resolve(source, source_id, bare_symbol(symbol), _plain(name), aliases, names)


def with_canonical_id(
    df: DataFrame,
    source: Column,
    source_id: Column,
    symbol: Column,
    name: Column,
    out: str = "canonical_id",
    aliases: dict[str, str] = SYMBOL_ALIASES,
    names: dict[str, str] = NAME_TO_SYMBOL,
) -> DataFrame:
    """``canonical_id`` as a column, its regular expressions evaluated once per row: the two
    normalised texts are projected first and used several times after."""
    staged = df.withColumns({"_bare": bare_symbol(symbol), "_plain": _plain(name)})
    resolved = _resolve(source, source_id, F.col("_bare"), F.col("_plain"), aliases, names)
    return staged.withColumn(out, resolved).drop("_bare", "_plain")


def with_alias_table(df: DataFrame, symbol: str, aliases: DataFrame, out: str) -> DataFrame:
    """Alias lookup against a table ``(alias, symbol)`` with one row per alias.

    No broadcast hint: adaptive execution broadcasts the table when its measured size allows it and
    splits skewed symbols of the record side otherwise.
    """
    lookup = aliases.select(F.col("alias").alias("_alias"), F.col("symbol").alias("_alias_symbol"))
    bare = bare_symbol(F.col(symbol))
    return (
        df.withColumn("_bare", bare)
        .join(lookup, F.col("_bare") == F.col("_alias"), "left")
        .withColumn(out, F.coalesce("_alias_symbol", "_bare"))
        .drop("_bare", "_alias", "_alias_symbol")
    )
