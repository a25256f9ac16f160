"""Rate control replayed over an event log.

Token bucket: a bucket per key holds at most ``burst`` tokens, refills continuously and admits a
request when it holds a whole token. That is a sequential fold per key, yet one key may hold a third
of the log, so it is split over range chunks:

1. for a key that crosses chunk borders, each chunk is summarised as a *transfer function* from the
   tokens at its start to the tokens at its end. It is piecewise linear with a few pieces, because
   two different fillings can differ by at most ``burst`` admissions;
2. the functions (one row per border) are composed in order, giving each chunk its starting tokens;
3. every chunk is replayed independently from there.

All arithmetic is in integer micro-units, so the split result equals the unsplit one exactly.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence
from heapq import heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.operators.ordered import CHUNK, POS, range_chunks, with_run_length

# Default requests per minute, burst, and the longest backoff in seconds.
PER_MINUTE = 60
BURST = 10
MAX_BACKOFF = 300

# One token in units: elapsed microseconds times requests per minute is then a whole number of them.
TOKEN = 60_000_000

_MICROS = "_micros"
_HELD = "_held"  # tokens of a state row, NULL for a request
_REQUEST = "_request"


class Transfer:
    """Tokens after some requests as a function of the tokens before them, on 0..cap.

    Starting values that were never capped keep their differences: they form ``linear`` segments
    (low, high, shift), about one per possible number of admissions. Values that met the cap in the
    same request are equal from then on: each such group has one value, kept in a heap with a common
    offset, so that a request only touches the groups that hold a whole token. Groups are few, except
    for a burst of one under overload, where up to one token time's requests can each leave a group.
    """

    def __init__(self, cap: int, start: int | None = None):
        self.cap = cap
        self.linear = [(0, cap, 0)] if start is None else []
        self._offset = 0
        self._heap: list[tuple[int, int]] = []  # (-(value - offset), group)
        self._parent: list[int] = []
        self._ranges: list[tuple[int, int, int]] = []  # (low, high, group) of starting values
        if start is not None:
            self._ranges.append((0, cap, self._new_group(start)))

    def _new_group(self, value: int) -> int:
        group = len(self._parent)
        self._parent.append(group)
        heappush(self._heap, (self._offset - value, group))
        return group

    def _root(self, group: int) -> int:
        while self._parent[group] != group:
            self._parent[group] = group = self._parent[self._parent[group]]
        return group

    def request(self, refill: int) -> None:
        self._offset += refill
        full, holding = [], []
        while self._heap and self._offset - self._heap[0][0] >= TOKEN:
            key, group = heappop(self._heap)
            (full if self._offset - key >= self.cap else holding).append((key, group))
        for key, group in holding:
            heappush(self._heap, (key + TOKEN, group))
        capped = self._request_linear(refill)
        if full:
            group = full[0][1]
            heappush(self._heap, (self._offset - self.cap + TOKEN, group))
            for _, other in full[1:]:
                self._parent[other] = group
        elif capped:
            group = self._new_group(self.cap - TOKEN)
        self._ranges += [(low, high, group) for low, high in capped]

    def _request_linear(self, refill: int) -> list[tuple[int, int]]:
        """Move the linear segments on; returns the ranges of starting values that met the cap."""
        capped, out = [], []
        for low, high, shift in self.linear:
            shift += refill
            full_from = max(low, self.cap - shift)
            if full_from <= high:
                capped.append((full_from, high))
            high = min(high, full_from - 1)
            admit_from = max(low, TOKEN - shift)
            for part in ((low, min(high, admit_from - 1), shift), (admit_from, high, shift - TOKEN)):
                if part[0] > part[1]:
                    continue
                if out and out[-1][1] + 1 == part[0] and out[-1][2] == part[2]:
                    part = (out.pop()[0], *part[1:])
                out.append(part)
        self.linear = out
        return capped

    def pieces(self) -> list[tuple[int, bool, int]]:
        """(low, fixed, value): from ``low`` on the result is ``value``, or the start plus it."""
        values = {group: self._offset - key for key, group in self._heap}
        fixed = [(low, True, values[self._root(group)]) for low, _, group in self._ranges]
        out: list[tuple[int, bool, int]] = []
        for piece in sorted(fixed + [(low, False, shift) for low, _, shift in self.linear]):
            if not out or out[-1][1:] != piece[1:]:
                out.append(piece)
        return out


def apply_pieces(lows: Sequence[int], fixed: Sequence[bool], values: Sequence[int], tokens: int) -> int:
    at = bisect_right(lows, tokens) - 1
    return values[at] if fixed[at] else tokens + values[at]


def _summarise(per_minute: int, cap: int):
    """Per chunk: the transfer function of its last key's requests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, chunk, last = None, None, None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in (_MICROS, _HELD, CHUNK, "_prev"))
            for at, held, start, prev in zip(*columns):
                if state is None or held is not None:
                    chunk = start
                    # A key that begins here begins with the bucket it was left with, or a full one.
                    state = Transfer(cap, None if prev is not None else cap if held is None else held)
                    last = at if prev is None else prev
                if held is None:
                    state.request(max(0, at - last) * per_minute)
                    last = max(last, at)
        if state is not None:
            lows, fixed, values = zip(*state.pieces())
            columns = {CHUNK: pa.array([chunk], pa.int32()), "lows": pa.array([lows], pa.list_(pa.int64())),
                       "fixed": pa.array([fixed], pa.list_(pa.bool_())), "vals": pa.array([values], pa.list_(pa.int64()))}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _compose(cap: int):
    """Tokens with which each chunk ends, from the chunk functions of each key in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, tokens = None, cap
        for batch in batches:
            ends = []
            for key, *pieces in zip(*(batch.column(c).to_pylist() for c in ("_key", "lows", "fixed", "vals"))):
                if key != current:
                    current, tokens = key, cap
                tokens = apply_pieces(*pieces, tokens)
                ends.append(tokens)
            yield pa.RecordBatch.from_arrays([batch.column(CHUNK), pa.array(ends, pa.int64())], names=[CHUNK, "_tokens"])

    return run


def _replay(key: str, per_minute: int, cap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, tokens, last, started = None, cap, 0, False
        for batch in batches:
            admitted, left = [], []
            helpers = (_MICROS, _HELD, "_carry_tokens", "_carry_at")
            for k, at, held, carry, carry_at in zip(*(batch.column(c).to_pylist() for c in (key, *helpers))):
                if not started or k != current:
                    inherits = not started and carry is not None
                    tokens, last = (carry, carry_at) if inherits else (cap, at)
                    current, started = k, True
                if held is not None:
                    tokens = held
                    continue
                tokens = min(cap, tokens + max(0, at - last) * per_minute)
                last = max(last, at)
                ok = tokens >= TOKEN
                if ok:
                    tokens -= TOKEN
                admitted.append(ok)
                left.append(tokens / TOKEN)
            if batch.column(_HELD).null_count < len(batch):
                batch = batch.filter(pc.is_null(batch.column(_HELD)))
            kept = [c for c in batch.schema.names if c not in helpers]
            columns = [batch.column(c) for c in kept] + [pa.array(admitted, pa.bool_()), pa.array(left, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "admitted", "tokens_left"])

    return run


def token_admission(
    events: DataFrame,
    key: str,
    ts: str,
    tiebreak: Sequence[str],
    per_minute: int = PER_MINUTE,
    burst: int = BURST,
    chunks: int | None = None,
    state: DataFrame | None = None,
) -> DataFrame:
    """Add ``admitted`` and ``tokens_left`` (after the request) to an event log.

    ``state`` (key, tokens, last_at), as ``bucket_state`` returns it, continues the buckets of an
    earlier log: its rows are put before the requests of their key. Requests older than that are
    taken in order but refill nothing.
    """
    cap = burst * TOKEN
    log = events.withColumns(
        {_MICROS: F.unix_micros(F.col(ts).cast("timestamp")), _HELD: F.lit(None).cast("bigint")}
    )
    if state is not None:
        held = state.join(events.select(key).distinct(), key, "left_semi").select(
            key, F.unix_micros("last_at").alias(_MICROS), F.col("tokens").alias(_HELD)
        )
        log = log.unionByName(held, allowMissingColumns=True)
    log = log.withColumn(_REQUEST, F.col(_HELD).isNull())
    log = range_chunks(log, [key, _REQUEST, _MICROS, *tiebreak], chunks).drop(_REQUEST)

    # One row per chunk: first and last key, last time, and what the neighbours hold.
    per_key = log.groupBy(CHUNK, key).agg(
        F.min(POS).alias("_from"), F.max(POS).alias("_to"), F.max(_MICROS).alias("_at")
    )
    ends = per_key.groupBy(CHUNK).agg(
        F.min_by(key, "_from").alias("_first_key"),
        F.max_by(key, "_to").alias("_last_key"),
        F.max_by("_at", "_to").alias("_at"),
    )
    row = Window.partitionBy(F.lit(0)).orderBy(CHUNK)
    clocked = ends.withColumn("_last_at", F.max("_at").over(Window.partitionBy("_last_key").orderBy(CHUNK)))
    borders = clocked.select(
        "*",
        F.lag("_last_key").over(row).alias("_prev_key"),
        F.lag("_last_at").over(row).alias("_prev_at"),
        F.lag(CHUNK).over(row).alias("_prev_chunk"),
        F.lead("_first_key").over(row).alias("_next_key"),
    )
    open_ended = borders.filter(F.col("_last_key") == F.col("_next_key")).select(
        CHUNK,
        "_last_key",
        # The whole chunk continues the previous one's key only if that key also ends it.
        F.when(
            (F.col("_prev_key") == F.col("_first_key")) & (F.col("_first_key") == F.col("_last_key")),
            F.col("_prev_at"),
        ).alias("_prev"),
    )
    crossing = log.join(F.broadcast(open_ended), CHUNK).filter(F.col(key) == F.col("_last_key"))
    functions = crossing.select(CHUNK, _MICROS, _HELD, "_prev").mapInArrow(
        _summarise(per_minute, cap), f"{CHUNK} int, lows array<long>, fixed array<boolean>, vals array<long>"
    )
    # One row per border; composed per key, streamed: the only sequential step.
    tokens = (
        functions.join(F.broadcast(open_ended.select(CHUNK, F.col("_last_key").alias("_key"))), CHUNK)
        .repartition("_key")
        .sortWithinPartitions("_key", CHUNK)
        .mapInArrow(_compose(cap), f"{CHUNK} int, _tokens long")
    )
    carried = borders.filter(F.col("_prev_key") == F.col("_first_key")).select(
        CHUNK, F.col("_prev_chunk"), F.col("_prev_at").alias("_carry_at")
    )
    starts = carried.join(
        tokens.select(F.col(CHUNK).alias("_prev_chunk"), F.col("_tokens").alias("_carry_tokens")), "_prev_chunk"
    ).drop("_prev_chunk")

    with_starts = log.join(F.broadcast(starts), CHUNK, "left").drop(CHUNK, POS)
    kept = [f for f in events.schema.fields]
    out_schema = T.StructType(
        [*kept, T.StructField("admitted", T.BooleanType()), T.StructField("tokens_left", T.DoubleType())]
    )
    return with_starts.mapInArrow(_replay(key, per_minute, cap), out_schema)


def bucket_state(admitted: DataFrame, key: str, ts: str, tiebreak: Sequence[str]) -> DataFrame:
    """(key, tokens, last_at) per key after a log, partially aggregated before the shuffle. ``tokens``
    are whole micro-units."""
    tokens = F.round(F.col("tokens_left") * TOKEN).cast("bigint")
    at = F.col(ts).cast("timestamp")
    return admitted.groupBy(key).agg(
        F.max_by(tokens, F.struct(at.alias("at"), *tiebreak)).alias("tokens"), F.max(at).alias("last_at")
    )


def backoff_seconds(errors: Column) -> Column:
    """0 without errors, else 2^errors seconds, at most five minutes."""
    return F.when(errors == 0, F.lit(0.0)).otherwise(
        F.least(F.pow(F.lit(2.0), F.least(errors, F.lit(30))), F.lit(float(MAX_BACKOFF)))
    )


def error_backoff(
    events: DataFrame,
    key: str,
    order: Sequence[str],
    is_error: Column,
    chunks: int | None = None,
) -> DataFrame:
    """Add ``consecutive_errors`` after each event (a success resets it) and ``backoff_seconds``."""
    counted = with_run_length(events, key, order, is_error, "consecutive_errors", chunks)
    return counted.withColumn("backoff_seconds", backoff_seconds(F.col("consecutive_errors")))


def limiter_stats(admitted: DataFrame, source: str, is_error: Column) -> DataFrame:
    """Requests, admissions, denials and errors per source."""
    return admitted.groupBy(source).agg(
        F.count("*").alias("requests"),
        F.count_if("admitted").alias("admitted"),
        F.count_if(~F.col("admitted")).alias("denied"),
        F.count_if(is_error).alias("errors"),
    )
