import json

from pyspark.sql import functions as F

from recordloom.operators import transform as T
from recordloom.operators import validate as V
from recordloom.sources.json_feed import parse_documents
from recordloom.sources.registry import SOURCES


def docs(spark, records):
    rows = [(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)]
    return parse_documents(spark.createDataFrame(rows, "i int, d string"), "d")


def errors(checked):
    return [list(r.errors) for r in checked.orderBy("i").collect()]


TICKER = {"id": "dgr-digger", "name": "Digger", "symbol": "DGR", "rank": 4, "last_updated": "2023-08-02T06:15:00Z",
          "quotes": {"USD": {"price": 17.25, "volume_24h": 10}}}


def test_ticker_types(spark):
    variants = [
        {}, {"rank": "1"}, {"rank": 1.0}, {"rank": "1.0"}, {"rank": True},
        {"rank": 1.5}, {"rank": "x"}, {"rank": None}, {"rank": -1}, {"name": 5}, {"symbol": "x" * 21},
        {"total_supply": "12.5"}, {"total_supply": "abc"}, {"quotes": None}, {"quotes": [1]}, {"last_updated": "soon"},
    ]
    got = errors(V.validate_json(docs(spark, [{**TICKER, **v} for v in variants]), V.TICKER_FIELDS))
    assert got[:5] == [[]] * 5
    assert got[5:] == [
        ["rank: not a valid int"], ["rank: not a valid int"], ["rank: required"], ["rank: below 0"],
        ["name: not a valid str"], ["symbol: longer than 20"], [], ["total_supply: not a valid float"], [],
        ["quotes: not a valid object"], [],
    ]


def test_broken_documents(spark):
    got = errors(V.validate_json(docs(spark, ["{oops", "[1]", "{}"]), V.POST_FIELDS))
    assert all("record: not an object" in e for e in got[:2])
    assert got[2] == ["id: required", "user_id: required", "title: required", "body: required"]


def test_posts(spark):
    posts = [
        {"id": 1, "userId": 1, "title": "\t Notes on wear ", "body": "Body"},
        {"id": "7a", "userId": 1, "title": "T", "body": "B"},
        {"userId": 1, "title": "T", "body": "B"},
        {"id": 2, "userId": 1, "title": None, "body": 5},
        {"id": 3, "userId": 1, "title": " " * 600, "body": ""},
    ]
    checked = V.validate_json(docs(spark, posts), V.POST_FIELDS)
    assert errors(checked) == [[], ["id: not a valid int"], ["id: required"], [], []]
    rows = V.accepted(checked).orderBy("i").collect()
    assert [(r.rec.title, r.rec.body) for r in rows] == [("Notes on wear", "Body"), ("", "5"), ("", "")]
    assert V.rejected(checked).count() == 2


def test_checksum_ignores_key_order_and_sees_extras(spark):
    a = {"id": 1, "userId": 1, "title": "T", "body": "B", "x": 1}
    b = dict(reversed(list(a.items())))
    got = V.validate_json(docs(spark, [a, b, {**a, "x": 2}, {**a, "title": "U"}]), V.POST_FIELDS)
    sums = [r.checksum for r in got.orderBy("i").collect()]
    assert len(sums[0]) == 64 and sums[0] == sums[1]
    assert len(set(sums)) == 3


PRODUCT_SCHEMA = "i int, product_id string, name string, category string, price string, stock_quantity string, created_at string, _file_name string"


def test_products(spark):
    rows = [
        (0, "P1", "N", "C", "$29.99", "", "2024-01-15", "f"),
        (1, "P1", "N", "C", "-1", "5", None, "f"),
        (2, None, "N", "C", "abc", "x", "", "f"),
        (3, "P1", "", "", "nan", "-2", None, "f"),
        (4, "P1", "N" * 501, "C" * 101, None, None, "yesterday", "f"),
    ]
    checked = V.validate_text(spark.createDataFrame(rows, PRODUCT_SCHEMA), V.PRODUCT_FIELDS, ["i"])
    assert errors(checked) == [
        [],
        ["price: below 0"],
        ["product_id: required", "price: not a valid price", "stock_quantity: not a valid quantity",
         "created_at: not a valid strict_time"],
        ["price: below 0", "stock_quantity: below 0"],
        ["name: longer than 500", "category: longer than 100", "created_at: not a valid strict_time"],
    ]
    unified = T.product(V.accepted(checked)).first()
    assert (unified.canonical_id, unified.source, unified.category) == ("product_P1", "csv", "C")
    assert json.loads(unified.extra_data) == {"price": 29.99, "stock_quantity": 0, "product_id": "P1"}


def test_news(spark):
    schema = "id string, title string, link string, summary string, content string, author string, published string, updated string, tags array<string>, _feed_url string"
    rows = [
        ("entry1", "T", "http://x/1", "sum", "full", "me", "Mon, 01 Jan 2024 12:00:00 GMT", "", ["a"], "f"),
        ("entry2", "T", "http://x/2", "sum", "", None, "", "2024-01-15T10:30:00Z", [], "f"),
    ]
    out = T.news(V.accepted(V.validate_text(spark.createDataFrame(rows, schema), V.NEWS_FIELDS)))
    one, two = out.orderBy("source_id").collect()
    assert (one.content, one.category, one.canonical_id) == ("full", "news", "rss_" + __import__("hashlib").md5(b"entry1").hexdigest()[:12])
    assert (two.content, two.category) == ("sum", None)
    assert two.external_created_at.isoformat() == "2024-01-15T10:30:00"


def test_ticker_and_market_records(spark):
    one = SOURCES["coinpaprika"].process(docs(spark, [TICKER]))[0].first()
    assert (one.canonical_id, one.symbol, one.content) == ("dgr", "dgr", "DGR - Rank #4")
    extra = json.loads(one.extra_data)
    assert len(extra) == 11 and extra["price_usd"] == 17.25 and extra["max_supply"] is None
    market = {"id": "digger", "symbol": "dgr", "name": "Digger", "market_cap_rank": 0, "ath_date": "2024-01-15T10:30:00.5Z"}
    two = SOURCES["coingecko"].process(docs(spark, [market]))[0].first()
    assert (two.canonical_id, two.content) == ("dgr", "DGR - Rank #N/A")
    extra = json.loads(two.extra_data)
    assert len(extra) == 14 and extra["ath_date"] == "2024-01-15T10:30:00.500000+00:00"


def test_rules_run_once_per_row(spark):
    """The split on errors must not copy the rules into a filter at the scan."""
    good = V.accepted(V.validate_json(docs(spark, [TICKER]), V.TICKER_FIELDS))
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("rank: not a valid int") == 1


def test_what_nobody_reads_is_not_computed(spark):
    checked = V.validate_json(docs(spark, [TICKER, {**TICKER, "note": 1}]), V.TICKER_FIELDS)
    unused = checked.agg(F.count_if(F.size("errors") == 0))._jdf.queryExecution().optimizedPlan().toString()
    assert "map_filter" not in unused.lower() and "mapfilter" not in unused.lower() and "beta_value" in unused
    # A filter on a mapped column stays above the rules: it would take a copy of them along.
    kept = T.ticker(V.accepted(checked)).filter(F.col("extra_data").isNotNull())._jdf.queryExecution().optimizedPlan().toString()
    assert kept.count("rank: not a valid int") == 1
    assert checked.select("checksum").distinct().count() == 2


def test_quotes_are_cast_at_once(spark):
    """Each value by itself: one that is no number, or a level that is no object, takes no other with it."""
    quotes = [{"USD": {"price": "x", "volume_24h": "2.5", "market_cap": True}}, {"USD": 7}, {}, {"EUR": {"price": 1}}, {"USD": {"price": [1], "percent_change_7d": 1e3}}]
    rows = T.ticker(V.accepted(V.validate_json(docs(spark, [{**TICKER, "quotes": q} for q in [*quotes, None]]), V.TICKER_FIELDS)), ("i",)).orderBy("i")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "$.USD" not in plan
    names = ("price_usd", "volume_24h_usd", "market_cap_usd", "percent_change_24h", "percent_change_7d")
    got = [[json.loads(r.extra_data)[n] for n in names] for r in rows.collect()]
    none = [None] * 5
    assert got == [[None, 2.5, 1.0, None, None], none, none, none, [None, None, None, None, 1000.0], none]


def test_width_limits(spark):
    df = spark.range(1).select(*[F.lit("x" * 101).alias(c) for c in V.UNIFIED_WIDTHS])
    assert df.select(V.width_errors()).first()[0] == [
        "canonical_id: longer than 100", "symbol: longer than 50", "source: longer than 50", "category: longer than 100",
    ]
