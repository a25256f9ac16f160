"""Filtered, paged listings of unified records and runs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions.cleaning import strip_space

# Page bounds.
MAX_LIMIT = 100
DEFAULT_LIMIT = 20

PUBLIC_TEXT = ("source", "source_id", "title", "content", "author", "category", "url")
PUBLIC_OTHER = ("external_created_at", "ingested_at", "updated_at", "extra_data")


def filter_records(
    df: DataFrame,
    source: str | None = None,
    category: str | None = None,
    author: str | None = None,
    search: str | None = None,
    start: Column | str | None = None,
    end: Column | str | None = None,
) -> DataFrame:
    """Filters of a listing; None and '' mean no filter. Equality and range conditions reach the
    Parquet scan, the pattern conditions run on what is left. ``%`` and ``_`` act as wildcards."""
    conditions = []
    if source:
        conditions.append(F.col("source") == source)
    if category:
        conditions.append(F.col("category") == category)
    if start is not None:
        conditions.append(F.col("ingested_at") >= _instant(start))
    if end is not None:
        conditions.append(F.col("ingested_at") <= _instant(end))
    if author:
        conditions.append(F.col("author").ilike(f"%{author}%"))
    if search:
        pattern = f"%{search}%"
        conditions.append(F.col("title").ilike(pattern) | F.col("content").ilike(pattern))
    return df.filter(reduce(lambda a, b: a & b, conditions)) if conditions else df


def _instant(value: Column | str) -> Column:
    return F.lit(value).cast("timestamp") if isinstance(value, str) else value


def check_page(limit: int, offset: int) -> None:
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}: {limit}")
    if offset < 0:
        raise ValueError(f"offset must not be negative: {offset}")


#: Stretches of a histogram, and rows that are sorted instead of divided further.
STRETCHES, SORTED = 1024, 4096
#: Bytes of a text that are compared as one number.
_BYTES = 7


def page(
    df: DataFrame,
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
    order: str = "ingested_at",
    tiebreak: str = "canonical_id",
) -> DataFrame:
    """Newest first, with one plan for every depth and no sort of the table.

    A histogram of the order column says which stretches of time the page falls into; a stretch that holds many rows is divided
    again, down to one instant, whose rows are then divided by the tiebreak. The page is read through range filters that reach
    the files, so row groups outside are skipped, and only the rows of its stretches are sorted. The driver sees at most
    ``STRETCHES`` counts at a time. NULL order values come last. ``tiebreak`` must be unique for the page to be well defined.
    """
    check_page(limit, offset)
    known, unknown = df.filter(F.col(order).isNotNull()), df.filter(F.col(order).isNull())
    age, tie = _age_axis(df, order), _tie_axes(df, tiebreak)
    whole = known.agg(F.count("*").alias("n"), F.min(age.value).alias("low"), F.max(age.value).alias("high")).first()
    found = []
    if offset < whole.n:
        span = (whole.low, whole.high)
        found += _segments(known, lambda k: tie(k - 1) if k else age, 0, offset, min(limit, whole.n - offset), whole.n, span)
    behind = offset + limit - whole.n
    if behind > 0:
        found += _segments(unknown, tie, 0, max(0, offset - whole.n), min(limit, behind), unknown.count())
    newest = [F.desc_nulls_last(order), F.asc(tiebreak)]
    parts = [rows.orderBy(*newest).offset(skip).limit(n) for rows, skip, n in found]
    return parts[0] if len(parts) == 1 else reduce(DataFrame.unionByName, parts).orderBy(*newest)


@dataclass(frozen=True)
class Axis:
    """A whole number that rises along the listing, and the filter for a stretch of it."""

    value: Column
    between: Callable[[DataFrame, int, int], DataFrame]


def _age_axis(df: DataFrame, order: str) -> Axis:
    kind = df.schema[order].dataType

    def between(rows: DataFrame, low: int, high: int) -> DataFrame:
        # Constants of the column's own type, so that the condition reaches the files.
        new, old = (F.timestamp_micros(F.lit(-x)).cast(kind) for x in (low, high))
        return rows.filter((F.col(order) >= old) & (F.col(order) <= new))

    return Axis(-F.unix_micros(F.col(order).cast("timestamp")), between)


def _tie_axes(rows: DataFrame, tiebreak: str) -> Callable[[int], Axis | None]:
    """The k-th axis of the tiebreak: the number itself, or the k-th stretch of bytes of a text."""
    kind = rows.schema[tiebreak].dataType

    def axis(k: int) -> Axis | None:
        if isinstance(kind, T.StringType):
            digits = F.hex(F.substring(F.coalesce(tiebreak, F.lit("")).cast("binary"), k * _BYTES + 1, _BYTES))
            value = F.conv(F.rpad(digits, 2 * _BYTES, "0"), 16, 10).cast("bigint")
        elif isinstance(kind, T.IntegralType) and not k:
            value = F.coalesce(F.col(tiebreak).cast("bigint"), F.lit(-(1 << 63)))
        else:
            return None
        return Axis(value, lambda df, low, high: df.filter((value >= low) & (value <= high)))

    return axis


def _segments(
    rows: DataFrame, axes: Callable[[int], Axis | None], k: int, skip: int, limit: int, held: int, span: tuple[int, int] | None = None
) -> list[tuple[DataFrame, int, int]]:
    """Parts of the page in order: rows of which few have to be sorted, how many to skip and how many to take."""
    axis = axes(k) if held > SORTED else None
    if axis is None:
        return [(rows, skip, limit)]
    low, high = span or tuple(rows.agg(F.min(axis.value), F.max(axis.value)).first())
    if low is None or low == high:
        ended = low is None or (low == 0 and k > 0)  # no byte left that differs
        return [(rows, skip, limit)] if ended else _segments(rows, axes, k + 1, skip, limit, held)
    width = -(-(high - low + 1) // STRETCHES)
    distance = axis.value.cast("decimal(20,0)") - low if high - low >= 1 << 63 else axis.value - low
    stretch = F.call_function("div", distance, F.lit(width))
    reached, before = [], 0
    for at, n in sorted(map(tuple, rows.groupBy(stretch.alias("stretch")).count().collect())):
        first, last = max(skip - before, 0), min(skip + limit - before, n)
        if first < last:
            reached.append((at, n, first, last - first))
        before += n
    # Stretches between the first and the last are in the page whole; only those two may hold many rows.
    apart = len(reached) > 1 and sum(r[1] for r in reached) > SORTED
    parts = []
    for group in [reached[:1], reached[1:-1], reached[-1:]] if apart else [reached]:
        if group:
            edges = low + group[0][0] * width, min(high, low + (group[-1][0] + 1) * width - 1)
            inside = axis.between(rows, *edges)
            parts += _segments(inside, axes, k, group[0][2], sum(r[3] for r in group), sum(r[1] for r in group), edges)
    return parts or [(rows.limit(0), 0, limit)]


def total(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"))


def page_info(df: DataFrame, limit: int = DEFAULT_LIMIT, offset: int = 0) -> DataFrame:
    """total, limit, offset and has_more of a page, from one count."""
    check_page(limit, offset)
    in_page = F.least(F.lit(limit), F.greatest(F.col("total") - offset, F.lit(0)))
    return total(df).select(
        "total",
        F.lit(limit).alias("limit"),
        F.lit(offset).alias("offset"),
        (F.lit(offset) + in_page < F.col("total")).alias("has_more"),
    )


def public_view(df: DataFrame) -> DataFrame:
    """What a listing shows: no internal ids, texts stripped."""
    return df.select(*[strip_space(F.col(c)).alias(c) for c in PUBLIC_TEXT], *PUBLIC_OTHER)


def run_history(runs: DataFrame, limit: int = DEFAULT_LIMIT, source: str | None = None) -> DataFrame:
    """Latest runs, optionally of one source."""
    check_page(limit, 0)
    chosen = runs.filter(F.col("source") == source) if source else runs
    return chosen.orderBy(F.desc_nulls_last("started_at"), F.asc("run_id")).limit(limit)


def latest_run(runs: DataFrame) -> DataFrame:
    """Status of the most recent run of any source: a single-row aggregate, not a sort."""
    newest = F.max_by(
        F.struct("started_at", "status", "duration_seconds", "records_processed"),
        F.struct("started_at", "run_id"),
    )
    return runs.agg(newest.alias("r")).select(
        F.col("r.started_at").alias("last_run_at"),
        F.col("r.status").alias("last_run_status"),
        F.col("r.duration_seconds").alias("last_run_duration_seconds"),
        F.col("r.records_processed").alias("records_processed"),
    )
