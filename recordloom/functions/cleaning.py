"""Scalar cleaners as Column expressions (no Python workers, all inside whole-stage codegen).

ANSI mode is on by default, so every conversion is a ``try_*`` one and returns NULL on bad input;
callers decide whether NULL means "missing" or "reject".
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python-style whitespace, which is the Unicode White_Space class plus the four ASCII separators.
_SPACE_CODES = (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
_SPACE = "".join(map(chr, _SPACE_CODES))
_DIGITS = r"\d(_?\d)*"
_NUMBER_TEXT = (
    rf"^\s*[+-]?(({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?{_DIGITS})?|(?i:inf|infinity|nan))\s*$"
)
_INTEGER_TEXT = r"^\s*[+-]?\d+(\.0*)?\s*$"
_ISO_TEXT = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}(:\d{2}(:\d{2}(\.\d{1,9})?)?)?\s?(Z|[+-]\d{2}(:?\d{2}(:\d{2})?)?)?)?$"
)
_ISO_UNUSUAL = r"^\d{8}([T ]|$)|,"


def strip_space(c: Column) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` removes blanks only)."""
    return F.btrim(c, F.lit(_SPACE))


def clean_string(c: Column) -> Column:
    """NULL becomes the empty string, everything else is stripped."""
    return F.coalesce(strip_space(c), F.lit(""))


def to_double(c: Column) -> Column:
    """Text to DOUBLE; NULL where the text is not a number ('12d', which CAST accepts, is not)."""
    return F.when(c.rlike(_NUMBER_TEXT), F.replace(c, F.lit("_"), F.lit("")).try_cast("double"))


def to_bigint(c: Column) -> Column:
    """Text to BIGINT; an all-zero fraction is allowed ('1.0'), any other fraction gives NULL."""
    return F.when(c.rlike(_INTEGER_TEXT), F.split_part(c, F.lit("."), F.lit(1)).try_cast("bigint"))


def parse_price(c: Column) -> Column:
    """Money text to DOUBLE: '$' and ',' dropped, missing or blank is 0.0, NULL when unparsable."""
    text = F.translate(c, "$,", "")
    return F.when(c.isNull() | text.rlike(r"^\s*$"), F.lit(0.0)).otherwise(to_double(text))


def parse_quantity(c: Column) -> Column:
    """Count text to BIGINT, truncated toward zero; missing or empty is 0, NULL when unparsable."""
    return F.when(c.isNull() | (c == ""), F.lit(0).cast("bigint")).otherwise(
        to_double(c).try_cast("bigint")
    )


def iso_timestamp(c: Column) -> Column:
    """ISO-8601 text to TIMESTAMP, NULL when it is not one. A text without zone is UTC."""
    usual = F.when(c.rlike(_ISO_TEXT), c.try_cast("timestamp"))
    # Compact dates and times, decimal commas: rewritten to the usual form first.
    dashed = F.regexp_replace(c, r"^(\d{4})(\d{2})(\d{2})(?=$|[T ])", "$1-$2-$3")
    full = F.regexp_replace(dashed, r"(?<=[T ]\d{2})(\d{2})(\d{2})(?=$|[.,Z+-])", ":$1:$2")
    dotted = F.replace(full, F.lit(","), F.lit("."))
    unusual = F.when(c.rlike(_ISO_UNUSUAL) & dotted.rlike(_ISO_TEXT), dotted.try_cast("timestamp"))
    return F.coalesce(usual, unusual)


def mail_or_iso_timestamp(c: Column) -> Column:
    """Mail-style date ('Mon, 01 Jan 2024 12:00:00 GMT') or ISO text to TIMESTAMP, else NULL.

    Seconds may be missing; two-digit years up to 68 are of this century.
    """
    # The parser has no pattern letter for the weekday name, so it is removed first.
    text = F.regexp_replace(strip_space(c), r"^[A-Za-z]{3},?\s*", "")
    text = F.regexp_replace(text, r"^(\d{1,2} [A-Za-z]{3}) ([0-5]\d|6[0-8]) ", "$1 20$2 ")
    text = F.regexp_replace(text, r"^(\d{1,2} [A-Za-z]{3}) (69|[7-9]\d) ", "$1 19$2 ")
    text = F.regexp_replace(text, r"( \d{2}:\d{2})(?= |$)", "$1:00")
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("d MMM yyyy HH:mm:ss z")),
        F.try_to_timestamp(text, F.lit("d MMM yyyy HH:mm:ss xx")),
        F.try_to_timestamp(text, F.lit("d MMM yyyy HH:mm:ss")),
        iso_timestamp(c),
    )


def strict_timestamp(c: Column) -> Column:
    """ISO text or a bare epoch number to TIMESTAMP; NULL marks a value the caller must reject.

    Epoch numbers above 2e10 in magnitude count milliseconds, smaller ones seconds.
    """
    number = F.when(c.rlike(r"^[+-]?\d+(\.\d+)?$"), c.try_cast("double"))
    seconds = F.when(F.abs(number) > 2e10, number / 1000).otherwise(number)
    # 3e11 seconds is past the year 9999, the last one a timestamp may have.
    epoch = F.when(F.abs(seconds) < 2.5e11, F.timestamp_seconds(seconds))
    return F.when(number.isNotNull(), epoch).otherwise(iso_timestamp(c))
