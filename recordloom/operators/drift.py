"""Schema inference and drift detection.

A record's schema is an array of (field, type) sorted by field, computed inside the row. Drift rules
run on schemas, not on records: ``batch_drift`` groups records by schema first, so the array work is
done once per distinct schema however many records share it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.functions.similarity import name_ratio, ratio_bound

SCHEMA_TYPE = "array<struct<field:string,type:string>>"
_RENAME_TYPE = "array<struct<old_field:string,new_field:string,similarity:double>>"

# Default similarity threshold, and the types a declared type accepts besides a null.
FUZZY_THRESHOLD = 80.0
COMPATIBLE_TYPES = {
    "str": ("str",),
    "int": ("int", "float"),
    "float": ("float", "int"),
    "bool": ("bool",),
    "list": ("list",),
    "dict": ("dict",),
}
NULL_TYPE = "NoneType"


def type_name(variant: Column) -> Column:
    """Type name of a JSON value. Integers beyond 18 digits are decimals of scale 0 in a variant."""
    t = F.schema_of_variant(variant)
    return (
        F.when((t == "BIGINT") | t.rlike(r"^DECIMAL\((19|[23]\d),0\)$"), "int")
        .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), "float")
        .when(t == "STRING", "str")
        .when(t == "BOOLEAN", "bool")
        .when(t.startswith("ARRAY"), "list")
        .when(t.startswith("OBJECT"), "dict")
        .otherwise(NULL_TYPE)
    )


def record_schema(payload: Column) -> Column:
    """Schema of a JSON object (VARIANT): sorted (field, type) pairs."""
    entries = F.map_entries(payload.try_cast("map<string,variant>"))
    pairs = F.transform(entries, lambda e: F.struct(e["key"].alias("field"), type_name(e["value"]).alias("type")))
    return F.array_sort(pairs)


def schema_literal(fields: dict[str, str]) -> Column:
    """A declared schema as a Column."""
    if not fields:
        return F.array().cast(SCHEMA_TYPE)
    pairs = [F.struct(F.lit(f).alias("field"), F.lit(t).alias("type")) for f, t in sorted(fields.items())]
    return F.array(*pairs)


def infer_fields(df: DataFrame, payload: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per (record, field) with the field's type."""
    return df.select(*keep, F.inline(record_schema(F.col(payload))))


def _names(schema: Column) -> Column:
    return F.transform(schema, lambda s: s["field"])


def _greedy_pairs(new: Column, removed: Column, threshold: float) -> Column:
    """Rename pairs, best similarity first, each name used once."""
    pairs = F.flatten(
        F.transform(new, lambda n: F.transform(removed, lambda o: F.struct(o.alias("old"), n.alias("new"))))
    )
    likely = F.filter(pairs, lambda p: ratio_bound(p["new"], p["old"]) >= threshold)
    scored = F.transform(
        likely,
        lambda p: F.struct(
            (-name_ratio(p["new"], p["old"])).alias("rank"), p["new"].alias("new"), p["old"].alias("old")
        ),
    )
    ranked = F.array_sort(F.filter(scored, lambda p: -p["rank"] >= threshold))

    def take(chosen: Column, p: Column) -> Column:
        used = F.exists(chosen, lambda c: (c["old_field"] == p["old"]) | (c["new_field"] == p["new"]))
        pair = F.struct(p["old"].alias("old_field"), p["new"].alias("new_field"), (-p["rank"]).alias("similarity"))
        return F.when(used, chosen).otherwise(F.concat(chosen, F.array(pair)).cast(_RENAME_TYPE))

    return F.aggregate(ranked, F.array().cast(_RENAME_TYPE), take)


def _compatible(expected: Column, actual: Column) -> Column:
    accepted = (actual == expected) | (actual == NULL_TYPE)
    for declared, types in COMPATIBLE_TYPES.items():
        accepted = accepted | ((expected == declared) & actual.isin(*types))
    return accepted


def detect_drift(
    df: DataFrame, expected: str = "expected", actual: str = "actual", threshold: float = FUZZY_THRESHOLD
) -> DataFrame:
    """Compare two schema columns row by row.

    Adds new_fields, removed_fields, renames, type_changes, has_drift, confidence_score, warnings.
    Rename pairs leave both field lists and are, alone, no drift.
    """
    exp, act = F.col(expected), F.col(actual)
    step1 = df.withColumns(
        {
            "_new": F.array_except(_names(act), _names(exp)),
            "_removed": F.array_except(_names(exp), _names(act)),
            "_actual_types": F.map_from_entries(act),
        }
    )
    types = F.col("_actual_types")
    common = F.filter(exp, lambda e: F.map_contains_key(types, e["field"]))
    step2 = step1.withColumns(
        {
            "renames": _greedy_pairs(F.col("_new"), F.col("_removed"), threshold),
            "_common": F.size(common),
            "type_changes": F.transform(
                F.filter(common, lambda e: ~_compatible(e["type"], F.try_element_at(types, e["field"]))),
                lambda e: F.struct(
                    e["field"].alias("field"),
                    e["type"].alias("expected_type"),
                    F.try_element_at(types, e["field"]).alias("actual_type"),
                ),
            ),
        }
    )
    renames, changes = F.col("renames"), F.col("type_changes")
    step3 = step2.withColumns(
        {
            "new_fields": F.array_sort(F.array_except("_new", F.transform(renames, lambda r: r["new_field"]))),
            "removed_fields": F.array_sort(
                F.array_except("_removed", F.transform(renames, lambda r: r["old_field"]))
            ),
        }
    )
    new, removed = F.col("new_fields"), F.col("removed_fields")
    matches = F.col("_common") - F.size(changes) + F.size(renames)
    ratio = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.try_divide(matches, F.size(exp))))
    return step3.withColumns(
        {
            "has_drift": (F.size(new) > 0) | (F.size(removed) > 0) | (F.size(changes) > 0),
            "confidence_score": F.when(F.size(exp) == 0, F.lit(1.0)).otherwise(F.bround(ratio, 2)),
            "warnings": _warnings(new, removed, renames, changes),
        }
    ).drop("_new", "_removed", "_common", "_actual_types")


def _warnings(new: Column, removed: Column, renames: Column, changes: Column) -> Column:
    def listed(label: str, names: Column) -> Column:
        text = F.concat(F.lit(f"{label}: "), F.array_join(names, ", "))
        return F.when(F.size(names) > 0, F.array(text)).otherwise(F.array().cast("array<string>"))

    rename_texts = F.transform(
        renames,
        lambda r: F.concat(
            F.lit("Possible field rename: "), r["old_field"], F.lit(" -> "), r["new_field"],
            F.format_string(" (%.0f%% similar)", F.bround(r["similarity"], 0)),
        ),
    )
    change_texts = F.transform(
        changes,
        lambda c: F.concat(
            F.lit("Type change in '"), c["field"], F.lit("': "), c["expected_type"], F.lit(" -> "), c["actual_type"]
        ),
    )
    return F.concat(
        listed("New fields detected", new), listed("Missing fields", removed), rename_texts, change_texts
    )


def distinct_schemas(df: DataFrame, source: str, payload: str, seen: str) -> DataFrame:
    """Distinct record schemas per source: record count, first and last time seen. Partial counts
    leave each map task as one row per schema."""
    return (
        df.select(F.col(source).alias("source"), record_schema(F.col(payload)).alias("actual"), F.col(seen).alias("_at"))
        .groupBy("source", "actual")
        .agg(F.count("*").alias("records"), F.min("_at").alias("first_seen"), F.max("_at").alias("last_seen"))
    )


def record_drift(
    df: DataFrame, expected: Column, payload: str = "payload", keep: Sequence[str] = (), threshold: float = FUZZY_THRESHOLD
) -> DataFrame:
    """Drift of every record against one declared schema, judged once per distinct schema."""
    shaped = df.select(*keep, record_schema(F.col(payload)).alias("_shape"))
    schemas = shaped.select(F.col("_shape").alias("actual")).distinct().withColumn("expected", expected)
    verdicts = detect_drift(schemas, threshold=threshold)
    return shaped.join(verdicts, F.col("_shape").eqNullSafe(F.col("actual"))).drop("_shape")


def batch_drift(
    df: DataFrame,
    expected: Column,
    source: str = "source",
    payload: str = "payload",
    seen: str = "seq",
    threshold: float = FUZZY_THRESHOLD,
) -> DataFrame:
    """Drift of a whole batch against one declared schema: a row per distinct record schema."""
    return detect_drift(
        distinct_schemas(df, source, payload, seen).withColumn("expected", expected), threshold=threshold
    )


def schema_registry(df: DataFrame, source: str = "source", payload: str = "payload", seen: str = "seq") -> DataFrame:
    """Schema versions per source in order of first appearance. The newest version is active; the
    confidence compares a version with the one before it.

    The windows run over distinct schemas, a handful of rows per source.
    """
    by_age = Window.partitionBy("source").orderBy("first_seen", F.to_json("actual"))
    newest = Window.partitionBy("source")
    versions = distinct_schemas(df, source, payload, seen).withColumns(
        {"schema_version": F.row_number().over(by_age), "_before": F.lag("actual").over(by_age)}
    )
    scored = detect_drift(
        versions.withColumn("expected", F.coalesce("_before", "actual")), "expected", "actual"
    )
    return scored.select(
        "source",
        "schema_version",
        F.to_json(F.map_from_entries("actual")).alias("schema_definition"),
        F.col("first_seen").alias("detected_at"),
        (F.max("schema_version").over(newest) == F.col("schema_version")).alias("is_active"),
        "confidence_score",
        "records",
    )
