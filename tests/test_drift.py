import json

import pytest
from pyspark.sql import functions as F

from recordloom.functions.similarity import name_ratio
from recordloom.operators import drift as D


def detect(spark, expected, record, threshold=80.0):
    df = spark.createDataFrame([(json.dumps(record),)], "d string").select(
        D.schema_literal(expected).alias("expected"), D.record_schema(F.parse_json("d")).alias("actual")
    )
    return D.detect_drift(df, threshold=threshold).first()


def test_no_drift(spark):
    shape = {"flag": "bool", "parts": "list", "weight": "float"}
    r = detect(spark, shape, {"weight": 3, "flag": False, "parts": [1, "a"]})
    assert (r.has_drift, r.confidence_score) == (False, 1.0)
    assert [list(x) for x in (r.new_fields, r.removed_fields, r.renames, r.type_changes, r.warnings)] == [[]] * 5


def test_new_and_removed(spark):
    r = detect(spark, {"id": "int", "old_thing": "str"}, {"id": 1, "brand_new": 1, "another": 2})
    assert r.new_fields == ["another", "brand_new"] and r.removed_fields == ["old_thing"] and r.has_drift
    assert r.warnings == ["New fields detected: another, brand_new", "Missing fields: old_thing"]
    assert r.confidence_score == 0.5


def test_type_change_and_compatible_types(spark):
    expected = {"count": "int", "label": "str", "share": "float", "note": "str", "when": "date"}
    r = detect(spark, expected, {"count": 2.5, "label": {"de": "x"}, "share": 7, "note": None, "when": True})
    assert [(c.field, c.expected_type, c.actual_type) for c in r.type_changes] == [("label", "str", "dict"), ("when", "date", "bool")]
    assert r.warnings[0] == "Type change in 'label': str -> dict"


def test_rename_alone_is_no_drift(spark):
    r = detect(spark, {"unit_price": "float", "sku": "str"}, {"unitprice": 2.5, "sku": "a"})
    assert not r.has_drift and r.confidence_score == 1.0
    assert r.warnings == ["Possible field rename: unit_price -> unitprice (95% similar)"]
    assert not detect(spark, {"unit_price": "float"}, {"unitprice": 2.5}, 96.0).renames


def test_records_are_judged_once_per_schema(spark):
    docs = [(i, json.dumps({"sku": "a"} if i % 3 else {"sku": i})) for i in range(30)] + [(30, None)]
    df = spark.createDataFrame(docs, "seq int, d string").withColumn("payload", F.try_parse_json("d"))
    out = D.record_drift(df, D.schema_literal({"sku": "str"}), "payload", ["seq"])
    got = {r.seq: r.has_drift for r in out.collect()}
    assert len(got) == 31 and all(got[i] == (i % 3 == 0) for i in range(30))


def test_each_name_is_paired_once(spark):
    r = detect(spark, {"price_usd": "int", "price_eur": "int"}, {"price_usdt": 1, "price_usd_": 2, "price_eu": 3})
    assert len({p.old_field for p in r.renames}) == len(r.renames) == 2
    assert [(p.old_field, p.new_field) for p in r.renames] == [("price_usd", "price_usd_"), ("price_eur", "price_eu")]
    assert r.new_fields == ["price_usdt"] and r.removed_fields == []


def test_confidence_falls(spark):
    expected = {"a": "int", "b": "str", "c": "float", "d": "bool"}
    full = detect(spark, expected, {"a": 1, "b": "t", "c": 1.0, "d": True})
    some = detect(spark, expected, {"a": 1, "b": "t", "new": "field"})
    assert full.confidence_score == 1.0 and some.confidence_score == 0.5
    assert detect(spark, {}, {"a": 1}).confidence_score == 1.0


def test_type_names(spark):
    record = '{"i":1,"s":"x","f":10.5,"one":1.0,"e":1e5,"big":12345678901234567890,"b":true,"l":["a"],"d":{"k":1},"n":null}'
    df = spark.createDataFrame([(record,)], "d string").select(F.parse_json("d").alias("p"))
    got = {r.field: r.type for r in D.infer_fields(df, "p").collect()}
    assert got == {"i": "int", "s": "str", "f": "float", "one": "float", "e": "float", "big": "int", "b": "bool",
                   "l": "list", "d": "dict", "n": "NoneType"}


def lcs(a, b):
    prev = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b, 1):
            row.append(prev[j - 1] + 1 if x == y else max(prev[j], row[-1]))
        prev = row
    return prev[-1]


@pytest.mark.parametrize("a, b", [("ship_to_city", "shiptocity"), ("created_at", "updated_at"), ("a", "b"), ("x", "xxxx"), ("abcbdab", "bdcaba")])
def test_ratio(spark, a, b):
    got = spark.range(1).select(name_ratio(F.lit(a), F.lit(b))).first()[0]
    assert got == pytest.approx(200 * lcs(a, b) / (len(a) + len(b)))


def test_registry(spark):
    rows = [("s", 1, '{"a":1}'), ("s", 2, '{"a":1}'), ("s", 3, '{"a":1,"b":2}'), ("s", 4, '{"a":2}'), ("t", 9, '{"z":1}')]
    df = spark.createDataFrame(rows, "source string, seq int, d string").withColumn("payload", F.parse_json("d"))
    got = [tuple(r) for r in D.schema_registry(df).orderBy("source", "schema_version").collect()]
    assert got == [("s", 1, '{"a":"int"}', 1, False, 1.0, 3), ("s", 2, '{"a":"int","b":"int"}', 3, True, 1.0, 1), ("t", 1, '{"z":"int"}', 9, True, 1.0, 1)]
