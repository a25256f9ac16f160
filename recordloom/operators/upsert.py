"""Keyed upserts.

Each row carries the sequence at which it was written, twice: ``_first_seq`` decides the
first-write-wins columns, ``_last_seq`` the last-write-wins ones. ``reduce_by_key`` keeps both, so
its output can be reduced again with more rows; the result depends neither on arrival order nor on
how the input was cut into batches, and replaying a batch changes nothing.

A sequence is one or two numbers of fixed width. In a stored table the winning writes come out of hash aggregations over keys
and sequences alone: no sort, no wide column read or shuffled for the losers; columns of fixed width travel along and all others
are then fetched by (key, sequence). Computed rows are aggregated whole, by ``max_by``/``min_by``. Both ways aggregate partially
before the shuffle: a key that holds a third of the table leaves each map task as a single row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIRST_SEQ = "_first_seq"
LAST_SEQ = "_last_seq"
#: Sequence of each key of a merged extra_data.
EXTRA_SEQS = "_extra_seqs"

# Columns of the unified table by write rule.
LAST_WRITE = (
    "source",
    "source_id",
    "symbol",
    "title",
    "content",
    "author",
    "category",
    "url",
    "extra_data",
    "checksum",
    "updated_at",
)
FIRST_WRITE = ("external_created_at", "ingested_at")


#: Bits of the parts of a write's major number; together they fit a DECIMAL(38, 0).
TIME_BITS, ORDER_BITS, RUN_BITS, BATCH_BITS = 54, 8, 21, 42


def sequence(
    run_started_at: Column, source_order: Column, batch_no: Column, row_pos: Column, run_id: Column | None = None
) -> Column:
    """The total order of writes as two numbers: (run start, feed, run, batch) packed into the major one, the place in the batch
    as the minor one. Rows of equal sequence must not exist within a key. Runs of one feed that start in the same microsecond
    follow a 21-bit hash of ``run_id``. Batch numbers go from -1 to 2^42 - 2, feed orders to 255."""
    time = F.unix_micros(run_started_at.cast("timestamp")) + (1 << (TIME_BITS - 1))
    head = time * (1 << ORDER_BITS) + source_order.cast("bigint")
    run = F.lit(0).cast("bigint") if run_id is None else F.pmod(F.xxhash64(run_id.cast("string")), F.lit(1 << RUN_BITS))
    batch = batch_no.cast("bigint") + 1
    inside = (batch >= 0) & (batch < 1 << BATCH_BITS)
    tail = F.when(inside, run * (1 << BATCH_BITS) + batch).otherwise(F.raise_error(F.lit("batch number out of range")).cast("bigint"))
    room = F.lit(str(1 << (RUN_BITS + BATCH_BITS))).cast("decimal(20,0)")
    major = (head.cast("decimal(20,0)") * room + tail.cast("decimal(20,0)")).cast("decimal(38,0)")
    return F.struct(major.alias("major"), row_pos.cast("decimal(38,0)").alias("minor"))


def versioned(df: DataFrame, seq: str = "seq") -> DataFrame:
    """A batch of writes in the form ``reduce_by_key`` takes."""
    return df.withColumns({FIRST_SEQ: F.col(seq), LAST_SEQ: F.col(seq)}).drop(seq)


def _fixed(kind: T.DataType) -> bool:
    """Whether values of the type have one width, so that an aggregation can update them in place."""
    return isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))


def _parts(kind: T.DataType) -> list[str] | None:
    """Fields of a sequence of one number (none) or of two; None for any other type."""
    if isinstance(kind, T.StructType) and len(kind) == 2 and all(_fixed(f.dataType) for f in kind):
        return kind.names
    return [] if _fixed(kind) else None


def _numbers(kind: T.DataType, seq: str) -> list[Column]:
    """The one or two numbers of a sequence column."""
    return [F.col(f"{seq}.{p}") for p in _parts(kind) or []] or [F.col(seq)]


def _fetched(rows: DataFrame, winners: DataFrame, keys: Sequence[str], seq: str, wide: Sequence[str]) -> DataFrame:
    """``winners`` with the wide columns of the rows that have their keys and their ``seq``."""
    if not wide:
        return winners
    numbers = _numbers(rows.schema[seq].dataType, seq)
    rows = rows.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *wide, *[c.alias(f"_at{n}") for n, c in enumerate(numbers)])
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys] + [c == F.col(f"_at{n}") for n, c in enumerate(numbers)]
    return winners.join(rows, same).select(*winners.columns, *wide)


def reduce_by_key(
    rows: DataFrame,
    keys: Sequence[str],
    last: Sequence[str],
    first: Sequence[str] = (),
    stored: bool = False,
) -> DataFrame:
    """One row per key. NULLs are values: a later NULL replaces, an earlier NULL stays.

    ``stored``: the rows are read from a table of writes, so both sequences of a row are equal and reading twice is cheap:
    first keys and sequences alone, then the columns of the winners. Rows that a costly plan computes, or earlier
    reductions, are aggregated whole in one pass; a plan that read them twice would double with every step it stands on.
    """
    keys, last, first = list(keys), list(last), list(first)
    names = [*keys, *last, *first, FIRST_SEQ, LAST_SEQ]
    parts = _parts(rows.schema[LAST_SEQ].dataType)
    if parts is None or not stored:
        return _reduced_whole(rows, keys, last, first)
    thin = {c: _fixed(rows.schema[c].dataType) for c in [*last, *first]}
    thin_last, thin_first = [c for c in last if thin[c]], [c for c in first if thin[c]]
    if parts:
        won = _both_ends(rows, keys, parts, thin_last, thin_first)
    else:
        won = rows.groupBy(*keys).agg(
            F.max(LAST_SEQ).alias(LAST_SEQ), F.min(LAST_SEQ).alias(FIRST_SEQ),
            *[F.max_by(c, LAST_SEQ).alias(c) for c in thin_last], *[F.min_by(c, LAST_SEQ).alias(c) for c in thin_first],
        )
    out = _fetched(rows, won, keys, LAST_SEQ, [c for c in last if not thin[c]])
    out = _fetched(rows, out, keys, FIRST_SEQ, [c for c in first if not thin[c]])
    return out.select(*names)


def _both_ends(rows: DataFrame, keys: list[str], parts: list[str], last: list[str], first: list[str]) -> DataFrame:
    """Both sequences of rows written once, in one pass."""
    major, minor = parts
    split = rows.select(*keys, *dict.fromkeys([*last, *first]), *[F.col(f"{LAST_SEQ}.{p}").alias(n) for p, n in ((major, "_major"), (minor, "_minor"))])
    inner = split.groupBy(*keys, "_major").agg(
        F.max("_minor").alias("_late"), F.min("_minor").alias("_early"),
        *[F.max_by(c, "_minor").alias(c) for c in last], *[F.min_by(c, "_minor").alias(c) for c in first],
    )
    outer = inner.groupBy(*keys).agg(
        F.max("_major").alias("_lm"), F.max_by("_late", "_major").alias("_ln"), F.min("_major").alias("_fm"), F.min_by("_early", "_major").alias("_fn"),
        *[F.max_by(c, "_major").alias(c) for c in last], *[F.min_by(c, "_major").alias(c) for c in first],
    )
    return outer.select(
        *keys, *last, *first,
        *[F.struct(F.col(m).alias(major), F.col(n).alias(minor)).alias(s) for m, n, s in (("_fm", "_fn", FIRST_SEQ), ("_lm", "_ln", LAST_SEQ))],
    )


def _reduced_whole(rows: DataFrame, keys: list[str], last: list[str], first: list[str]) -> DataFrame:
    """For sequences of any other type: one aggregation over whole rows, which sorts."""
    aggs = [F.max(LAST_SEQ).alias(LAST_SEQ), F.min(FIRST_SEQ).alias(FIRST_SEQ)]
    if last:
        aggs.append(F.max_by(F.struct(*last), LAST_SEQ).alias("_l"))
    if first:
        aggs.append(F.min_by(F.struct(*first), FIRST_SEQ).alias("_f"))
    reduced = rows.groupBy(*keys).agg(*aggs)
    return reduced.select(
        *keys, *[F.col(f"_l.{c}").alias(c) for c in last], *[F.col(f"_f.{c}").alias(c) for c in first], FIRST_SEQ, LAST_SEQ
    )


def _stacked(current: DataFrame | None, batch: DataFrame) -> DataFrame:
    return batch if current is None else current.unionByName(batch)


def _upserted(
    batch: DataFrame, current: DataFrame | None, keys: Sequence[str], last: Sequence[str], first: Sequence[str]
) -> DataFrame:
    """A computed batch, alone or on top of an earlier reduction."""
    return reduce_by_key(_stacked(current, batch), keys, last, first)


def upsert_raw_api(batch: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """Key ``external_id``; a rewrite keeps the first checksum."""
    return _upserted(batch, current, ["external_id"], ["data", "fetched_at"], ["checksum"])


def upsert_raw_csv(batch: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """Key (file_name, row_number), defaulting to 'unknown' and 0."""
    keyed = batch.withColumns(
        {
            "file_name": F.coalesce("file_name", F.lit("unknown")),
            "row_number": F.coalesce("row_number", F.lit(0)).cast("bigint"),
        }
    )
    return _upserted(keyed, current, ["file_name", "row_number"], ["data", "imported_at"], ["checksum"])


def upsert_raw_news(batch: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """Key (feed_url, entry_id), defaulting to ''."""
    keyed = batch.withColumns(
        {
            "feed_url": F.coalesce("feed_url", F.lit("")),
            "entry_id": F.coalesce("entry_id", F.lit("")),
        }
    )
    return _upserted(keyed, current, ["feed_url", "entry_id"], ["data", "fetched_at"], ["checksum"])


def upsert_unified(
    batch: DataFrame,
    current: DataFrame | None = None,
    extra: str = "replace",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Unified table by ``canonical_id``. ``batch`` needs ``written_at`` next to the record columns.

    ``extra="replace"`` keeps the last writer's extra_data; ``"merge"`` folds all of them and keeps
    the sequence of every key in ``_extra_seqs``, so a late batch finds its place among stored keys.
    ``columns`` names the ones a report needs: a column inside the aggregated struct cannot be pruned
    by the optimizer, so leaving it out here is what keeps it, and the work to compute it, away.
    """
    wanted = LAST_WRITE + FIRST_WRITE if columns is None else tuple(columns)
    last = [c for c in LAST_WRITE if c in wanted]
    first = [c for c in FIRST_WRITE if c in wanted]
    stamped = batch.withColumns({"ingested_at": F.col("written_at"), "updated_at": F.col("written_at")})
    stored = None if current is None else current.drop(EXTRA_SEQS)
    reduced = _upserted(stamped.drop("written_at"), stored, ["canonical_id"], last, first)
    if extra == "replace" or "extra_data" not in wanted:
        return reduced
    if extra != "merge":
        raise ValueError(f"unknown extra mode: {extra}")
    kept = ["canonical_id", "extra_data", LAST_SEQ, EXTRA_SEQS]
    existing = None if current is None else current.select(*[c for c in kept if c in current.columns])
    new = stamped.select("canonical_id", "source", "extra_data", LAST_SEQ)
    merged = merge_extra_data(new, existing, with_seqs=True)
    return reduced.drop("extra_data").join(merged, "canonical_id", "left")


def merge_extra_data(new: DataFrame, existing: DataFrame | None = None, with_seqs: bool = False) -> DataFrame:
    """Merged extra_data per canonical id: every source's latest payload under ``_<source>``, and the
    latest value of every key that does not start with ``_`` (an explicit null counts).

    ``new``: (canonical_id, source, extra_data, _last_seq); ``existing``: (canonical_id, extra_data,
    _last_seq[, _extra_seqs]), whose keys are all kept, each with its own sequence where it has one.

    Of the payloads of one source that have the same keys only the latest can matter, so the rows are
    reduced to those before any key is unfolded. The final per-id collection holds one entry per
    distinct key whatever the row count.
    """
    new = (
        new.filter(F.col("extra_data").isNotNull())
        .groupBy("canonical_id", "source", F.array_sort(F.json_object_keys("extra_data")).alias("_keys"))
        .agg(F.max_by("extra_data", LAST_SEQ).alias("extra_data"), F.max(LAST_SEQ).alias(LAST_SEQ))
        .drop("_keys")
    )
    from_keys = _entries(new).filter(~F.col("key").startswith("_")).select("canonical_id", "key", "value", LAST_SEQ)
    from_source = new.select(
        "canonical_id",
        F.concat(F.lit("_"), F.col("source")).alias("key"),
        F.col("extra_data").alias("value"),
        LAST_SEQ,
    )
    entries = from_keys.unionByName(from_source)
    if existing is not None:
        entries = entries.unionByName(_entries(existing).select("canonical_id", "key", "value", LAST_SEQ))
    latest = entries.groupBy("canonical_id", "key").agg(
        F.max_by("value", LAST_SEQ).alias("value"), F.max(LAST_SEQ).alias("seq")
    )
    document = F.to_variant_object(
        F.map_from_entries(
            F.transform(
                F.collect_list(F.struct("key", "value")),
                lambda e: F.struct(e["key"].alias("key"), F.parse_json(e["value"]).alias("value")),
            )
        )
    )
    seqs = F.map_from_entries(F.collect_list(F.struct("key", "seq"))).alias(EXTRA_SEQS)
    return latest.groupBy("canonical_id").agg(F.to_json(document).alias("extra_data"), *([seqs] if with_seqs else []))


def _entries(df: DataFrame) -> DataFrame:
    """One row per (row, key) of extra_data, the value as JSON text."""
    as_map = F.try_parse_json("extra_data").try_cast("map<string,variant>")
    own = [EXTRA_SEQS] if EXTRA_SEQS in df.columns else []
    pairs = df.select("canonical_id", LAST_SEQ, *own, F.explode(as_map).alias("key", "v"))
    if own:
        pairs = pairs.withColumn(LAST_SEQ, F.coalesce(F.try_element_at(EXTRA_SEQS, F.col("key")), LAST_SEQ)).drop(EXTRA_SEQS)
    return pairs.withColumn("value", F.to_json("v")).drop("v")


def changes(current: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How a (reduced) batch relates to the stored rows: inserted, updated or unchanged."""
    stored = current.select(*keys, F.col("checksum").alias("_stored"))
    kind = (
        F.when(F.col("_stored").isNull(), "inserted")
        .when(F.col("_stored") == F.col("checksum"), "unchanged")
        .otherwise("updated")
    )
    return batch.join(stored, list(keys), "left").withColumn("change", kind).drop("_stored")


def upsert_checkpoints(batch: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """Key ``source``; the last value wins."""
    return _upserted(batch, current, ["source"], ["last_value", "last_processed_at", "updated_at"], [])


LEDGER_LAST = (
    "status",
    "finished_at",
    "duration_seconds",
    "records_fetched",
    "records_processed",
    "records_failed",
    "records_skipped",
    "error_message",
)


def ledger_state(events: DataFrame) -> DataFrame:
    """Current state of every run from its appended open/close events."""
    reduced = reduce_by_key(events, ["run_id"], LEDGER_LAST, ["source", "started_at"], stored=True)
    return reduced.drop(FIRST_SEQ, LAST_SEQ)


def open_run(run_id: Column, source: Column, started_at: Column) -> list[Column]:
    """Columns of the event written when a run starts."""
    empty = {c: "timestamp" if c == "finished_at" else "bigint" for c in LEDGER_LAST}
    empty.update(duration_seconds="double", error_message="string")
    columns = {
        "run_id": run_id,
        "source": source,
        "started_at": started_at,
        **{c: F.lit(None).cast(t) for c, t in empty.items()},
        "status": F.lit("running"),
        **{c: F.lit(0).cast("bigint") for c in LEDGER_LAST if c.startswith("records_")},
    }
    return [c.alias(n) for n, c in columns.items()]


def run_counters(validated: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """fetched / processed / failed / skipped of a validated frame in one pass. An unconditional
    upsert skips nothing."""
    return validated.groupBy(*by).agg(
        F.count("*").alias("records_fetched"),
        F.count_if(F.size("errors") == 0).alias("records_processed"),
        F.count_if(F.size("errors") > 0).alias("records_failed"),
        F.lit(0).cast("bigint").alias("records_skipped"),
    )
