import pytest
from pyspark.sql import functions as F

from recordloom.functions import identity as N

#: Rules of the normal form, each with inputs of its own.
SYMBOLS = [
    ("QRX", "qrx"), (" \n QrX\t", "qrx"), (None, ""), ("", ""), (" ", ""),
    # aliases that must hold
    *((a, b) for a, b in N.SYMBOL_ALIASES.items() if not a.startswith("wrapped")),
    # affixes go before the alias lookup
    ("wrapped-bitcoin", "bitcoin"), ("Wrapped_qrx", "qrx"), ("wrappedqrx", "qrx"), ("qrx-token", "qrx"), ("QRX Token", "qrx"), ("token", ""),
    ("tokenqrx", "tokenqrx"), ("wqrx", "wqrx"),
]


def test_normalize_symbol(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(SYMBOLS)], "i int, s string").orderBy("i")
    assert [r[0] for r in df.select(N.normalize_symbol(F.col("s"))).collect()] == [e for _, e in SYMBOLS]


CASES = [
    ("BTC", "Bitcoin", "btc"),
    ("", "Bitcoin", "btc"),
    ("", "  USD Coin ", "usdc"),
    ("", "Extraordinarily Long", "extraordin"),
    ("", "", "src_id1"),
    (None, None, "src_id1"),
    ("", "   ", "src_id1"),
]


def test_canonical_id_both_forms(spark):
    df = spark.createDataFrame([(i, s, n) for i, (s, n, _) in enumerate(CASES)], "i int, s string, n string")
    args = (F.lit("src"), F.lit("id1"), F.col("s"), F.col("n"))
    rows = N.with_canonical_id(df, *args, "staged").withColumn("inline", N.canonical_id(*args)).orderBy("i").collect()
    expected = [e for *_, e in CASES]
    assert [r.staged for r in rows] == expected
    assert [r.inline for r in rows] == expected


def test_every_spelling_of_an_entity_meets(spark):
    """Feeds disagree on case, blanks and affixes of symbols; names only count without a symbol."""
    spellings = ["{0}", " {0} ", "{0}-token", "wrapped {0}", "WRAPPED_{0}"]
    rows = [
        (f"k{n}", str(feed), spelling.format(f"k{n}" if feed % 2 else f"K{n}"), f"name {feed}")
        for n in range(8) for feed, spelling in enumerate(spellings)
    ]
    df = spark.createDataFrame(rows, "expected string, id string, s string, n string")
    out = N.with_canonical_id(df, F.lit("x"), F.col("id"), F.col("s"), F.col("n"))
    assert out.filter("canonical_id != expected").count() == 0 and out.select("canonical_id").distinct().count() == 8


def test_alias_table(spark):
    df = spark.createDataFrame([("WRAPPED-abc",), ("zzz",)], "s string")
    aliases = spark.createDataFrame([("abc", "alpha")], "alias string, symbol string")
    got = {r.s: r.out for r in N.with_alias_table(df, "s", aliases, "out").collect()}
    assert got == {"WRAPPED-abc": "alpha", "zzz": "zzz"}


@pytest.mark.parametrize("symbol", ["BTC"])
def test_resolving_needs_no_shuffle(spark, symbol):
    df = spark.range(10).select(F.lit(symbol).alias("s"), F.col("id").cast("string").alias("i"))
    out = N.with_canonical_id(df, F.lit("x"), F.col("i"), F.col("s"), F.lit(None).cast("string"))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
