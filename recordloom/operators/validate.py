"""Record validation as one projection: typed fields plus an array of rule violations.

A record is checked in a single pass; ``validate`` adds ``rec`` (typed struct), ``errors``
(array of messages, empty when valid) and ``checksum``. ``accepted``/``rejected`` split on it.

The work is laid out in stages (raw value, JSON type, typed value, rules), each a projection of its
own: a stage's columns are used several times by the next one, so the optimizer keeps them apart and
every conversion runs once per row. The last stage goes through a one-element ``inline``: without it
the filter on ``errors`` would be pushed down to the scan together with a copy of all the rules.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions import cleaning as C
from recordloom.functions.checksum import record_checksum
from recordloom.schemas import UNIFIED_WIDTHS


@dataclass(frozen=True)
class Field:
    """One field rule. ``kind`` names an entry of the reader tables below."""

    name: str
    kind: str
    required: bool = False
    max_len: int | None = None
    minimum: int | None = None
    key: str | None = None  # name in the raw record when it differs
    nullable: bool = True  # may a field that is not required be an explicit null

    @property
    def raw_key(self) -> str:
        return self.key or self.name


@dataclass(frozen=True)
class Cell:
    """A raw value: is it there, is it an explicit null, its typed value, is it convertible."""

    missing: Column
    null: Column
    value: Column
    convertible: Column


# --- JSON payloads (VARIANT column) -------------------------------------------------------------

_NUMERIC = ("BIGINT", "DOUBLE", "FLOAT")


def _json_value(kind: str, raw: Column, json_type: Column) -> tuple[Column, Column]:
    """(typed value, convertible). The JSON type decides before any cast: a cast alone is laxer than
    the rules (1.5 would become the integer 1)."""
    is_text = json_type == "STRING"
    is_bool = json_type == "BOOLEAN"
    is_number = json_type.isin(*_NUMERIC) | json_type.startswith("DECIMAL")
    text = F.try_variant_get(raw, "$", "string")
    if kind == "str":
        return F.when(is_text, text), is_text
    if kind == "clean_str":
        return C.clean_string(F.when(is_text, text).when(json_type != "VOID", F.to_json(raw))), F.lit(True)
    if kind == "int":
        number = F.try_variant_get(raw, "$", "double")
        value = (
            F.when((json_type == "BIGINT") | is_bool, F.try_variant_get(raw, "$", "bigint"))
            .when(is_text, C.to_bigint(text))
            .when(is_number & (number == F.floor(number)), number.try_cast("bigint"))
        )
        return value, value.isNotNull()
    if kind == "float":
        value = F.when(is_number | is_bool, F.try_variant_get(raw, "$", "double")).when(is_text, C.to_double(text))
        return value, value.isNotNull()
    if kind == "iso_time":
        return C.iso_timestamp(text), F.lit(True)
    if kind == "mail_time":
        return C.mail_or_iso_timestamp(text), F.lit(True)
    if kind == "str_list":
        value = F.try_variant_get(raw, "$", "array<string>")
        only_text = json_type.isin("ARRAY<STRING>", "ARRAY<VOID>")
        return value, only_text & ~F.exists(value, lambda x: x.isNull())
    if kind == "object":
        is_object = json_type.startswith("OBJECT")
        return F.when(is_object, raw), is_object
    raise ValueError(kind)


def _json_cells(df: DataFrame, fields: Sequence[Field], payload: Column) -> tuple[DataFrame, dict[str, Cell]]:
    """The document is unfolded once, into a struct of the declared fields; types and values are read from there."""
    keys = dict.fromkeys(f.raw_key for f in fields)
    df = df.withColumn("_cells", payload.try_cast(T.StructType([T.StructField(k, T.VariantType()) for k in keys])))
    df = df.withColumns({f"_raw_{f.name}": F.col("_cells").getField(f.raw_key) for f in fields})
    df = df.withColumns({f"_type_{f.name}": F.schema_of_variant(f"_raw_{f.name}") for f in fields})
    cells = {}
    for f in fields:
        json_type = F.col(f"_type_{f.name}")
        value, convertible = _json_value(f.kind, F.col(f"_raw_{f.name}"), json_type)
        cells[f.name] = Cell(json_type.isNull(), json_type == "VOID", value, convertible)
    return df, cells


# --- text records (CSV rows, feed entries: columns already split) --------------------------------


def _text_value(kind: str, raw: Column) -> tuple[Column, Column]:
    if kind in ("str", "str_list"):
        return raw, F.lit(True)
    if kind == "clean_str":
        return C.clean_string(raw), F.lit(True)
    if kind == "iso_time":
        return C.iso_timestamp(raw), F.lit(True)
    if kind == "mail_time":
        return C.mail_or_iso_timestamp(raw), F.lit(True)
    converter = {
        "int": C.to_bigint,
        "float": C.to_double,
        "price": C.parse_price,
        "quantity": C.parse_quantity,
        "strict_time": C.strict_timestamp,
    }[kind]
    value = converter(raw)
    return value, value.isNotNull()


# Kinds that are convertible exactly when their typed value is there.
_CONVERTIBLE_IF_VALUE = ("int", "float", "price", "quantity", "strict_time")

# Kinds whose cleaner gives NULL input a value of its own, so an explicit null is no violation.
_NULL_HAS_VALUE = ("price", "quantity", "clean_str")


def _text_cells(columns: Sequence[str], fields: Sequence[Field]) -> dict[str, Cell]:
    cells = {}
    for f in fields:
        if f.raw_key in columns:
            raw = F.col(f.raw_key)
            value, convertible = _text_value(f.kind, raw)
            cells[f.name] = Cell(F.lit(False), raw.isNull(), value, convertible)
        else:
            value, _ = _text_value(f.kind, F.lit(None).cast("string"))
            cells[f.name] = Cell(F.lit(True), F.lit(False), value, F.lit(True))
    return cells


# --- rules ---------------------------------------------------------------------------------------


_SEPARATOR = "\x01"


def joined(rules: Sequence[Column]) -> Column:
    """The messages of the rules that fired in one text; project it before splitting it."""
    return F.concat_ws(_SEPARATOR, *rules)


def message_list(text: Column) -> Column:
    """Array form of a joined text. (A lambda filter over the rules would evaluate all of them outside
    of generated code.)"""
    none = F.array().cast("array<string>")
    return F.when(text == "", none).otherwise(F.split(text, _SEPARATOR))


def messages(rules: Sequence[Column]) -> Column:
    """Array of the messages that fired, for a handful of cheap rules."""
    return F.array_except(F.array(*rules), F.array(F.lit(None).cast("string")))


def _violations(field: Field, cell: Cell) -> list[Column]:
    name = field.name
    blank = cell.missing | cell.null
    if field.kind in _NULL_HAS_VALUE:
        blank = cell.missing
    rules = []
    if field.required:
        rules.append(F.when(blank, F.lit(f"{name}: required")))
    elif not field.nullable:
        rules.append(F.when(cell.null, F.lit(f"{name}: null")))
    rules.append(F.when(~blank & ~F.coalesce(cell.convertible, F.lit(False)), F.lit(f"{name}: not a valid {field.kind}")))
    if field.max_len is not None:
        rules.append(F.when(F.length(cell.value) > field.max_len, F.lit(f"{name}: longer than {field.max_len}")))
    if field.minimum is not None:
        # NaN orders above every number, so it has to be named.
        low = (cell.value < field.minimum) | F.isnan(cell.value.cast("double"))
        rules.append(F.when(low, F.lit(f"{name}: below {field.minimum}")))
    return rules


def _apply(
    df: DataFrame,
    keep: Sequence[str],
    fields: Sequence[Field],
    cells: dict[str, Cell],
    extras: Column | None,
    extra_rules: Sequence[Column],
) -> DataFrame:
    df = df.withColumns({f"_val_{n}": c.value for n, c in cells.items()})
    typed = {n: Cell(c.missing, c.null, F.col(f"_val_{n}"), c.convertible) for n, c in cells.items()}
    for f in fields:
        if f.kind in _CONVERTIBLE_IF_VALUE:
            cell = typed[f.name]
            typed[f.name] = Cell(cell.missing, cell.null, cell.value, cell.value.isNotNull())
    rules = [r for f in fields for r in _violations(f, typed[f.name])] + list(extra_rules)
    df = df.withColumn("_joined", joined(rules))
    rec = F.struct(*[c.value.alias(n) for n, c in typed.items()])
    checked = F.struct(message_list(F.col("_joined")).alias("errors"), rec.alias("rec"))
    out = df.select(*keep, F.inline(F.array(checked)))
    # Undeclared fields are taken from the record itself, beside ``inline``: without a reader of the checksum they are not computed.
    return out.withColumn("checksum", record_checksum({f.name: F.col(f"rec.{f.name}") for f in fields}, extras))


def validate_json(df: DataFrame, fields: Sequence[Field], payload: str = "payload") -> DataFrame:
    """Validate a document given as VARIANT; undeclared keys are kept and enter the checksum."""
    declared = [f.raw_key for f in fields]
    staged, cells = _json_cells(df, fields, F.col(payload))
    extras = F.map_filter(F.col(payload).try_cast("map<string,variant>"), lambda k, v: ~k.isin(*declared))
    malformed = F.when(F.col("_cells").isNull(), F.lit("record: not an object"))
    return _apply(staged, df.columns, fields, cells, extras, [malformed])


def validate_text(
    df: DataFrame,
    fields: Sequence[Field],
    extra_columns: Sequence[str] = (),
    extra_rules: Sequence[Column] = (),
) -> DataFrame:
    """Validate already split string columns. Columns whose name starts with ``_`` are metadata and
    never part of the record; ``extra_columns`` are undeclared fields that enter the checksum."""
    extras = None
    if extra_columns:
        extras = F.map_from_arrays(
            F.array(*[F.lit(c) for c in sorted(extra_columns)]),
            F.array(*[F.col(c).cast("string") for c in sorted(extra_columns)]),
        )
    columns = [c for c in df.columns if not c.startswith("_")]
    return _apply(df, df.columns, fields, _text_cells(columns, fields), extras, extra_rules)


def accepted(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size("errors") == 0)


def rejected(validated: DataFrame) -> DataFrame:
    """Dead-letter rows: everything of the record plus the joined messages."""
    return validated.filter(F.size("errors") > 0).withColumn("error", F.array_join("errors", "; "))


def width_errors(limits: dict[str, int] = UNIFIED_WIDTHS) -> Column:
    """Violations of the unified table's storage widths."""
    rules = [
        F.when(F.length(name) > limit, F.lit(f"{name}: longer than {limit}"))
        for name, limit in limits.items()
    ]
    return messages(rules)


def drop_internal(df: DataFrame) -> DataFrame:
    """The record without its ``_``-prefixed metadata columns."""
    return df.select(*[c for c in df.columns if not c.startswith("_")])


# --- the five feeds ------------------------------------------------------------------------------

# The fields of each feed, their types and limits.

TICKER_FIELDS = (
    Field("id", "str", required=True),
    Field("name", "str", required=True, max_len=255),
    Field("symbol", "str", required=True, max_len=20),
    Field("rank", "int", required=True, minimum=0),
    *[Field(n, "float") for n in ("circulating_supply", "total_supply", "max_supply", "beta_value")],
    *[Field(n, "iso_time") for n in ("first_data_at", "last_updated")],
    Field("quotes", "object"),
)

MARKET_FIELDS = (
    Field("id", "str", required=True),
    Field("symbol", "str", required=True, max_len=20),
    Field("name", "str", required=True, max_len=255),
    Field("image", "str"),
    Field("market_cap_rank", "int"),
    *[
        Field(n, "float")
        for n in (
            "current_price",
            "market_cap",
            "fully_diluted_valuation",
            "total_volume",
            "high_24h",
            "low_24h",
            "price_change_24h",
            "price_change_percentage_24h",
            "price_change_percentage_7d_in_currency",
            "market_cap_change_24h",
            "market_cap_change_percentage_24h",
            "circulating_supply",
            "total_supply",
            "max_supply",
            "ath",
            "ath_change_percentage",
            "atl",
            "atl_change_percentage",
        )
    ],
    *[Field(n, "iso_time") for n in ("ath_date", "atl_date", "last_updated")],
)

PRODUCT_FIELDS = (
    Field("product_id", "str", required=True),
    Field("name", "str", required=True, max_len=500),
    Field("category", "str", required=True, max_len=100),
    Field("price", "price", required=True, minimum=0),
    Field("description", "str"),
    Field("stock_quantity", "quantity", minimum=0),
    Field("created_at", "strict_time"),
)

NEWS_FIELDS = (
    Field("entry_id", "str", required=True, key="id"),
    Field("title", "str", required=True, max_len=500),
    Field("link", "str", required=True, max_len=512),
    Field("summary", "str"),
    Field("content", "str"),
    Field("author", "str"),
    Field("published", "mail_time"),
    Field("updated", "mail_time"),
    Field("tags", "str_list", nullable=False),
)

POST_FIELDS = (
    Field("id", "int", required=True),
    Field("user_id", "int", required=True, key="userId"),
    Field("title", "clean_str", required=True, max_len=500),
    Field("body", "clean_str", required=True),
)
