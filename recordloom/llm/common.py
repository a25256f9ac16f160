"""Shared helpers of the corpus operators: table access, Arrow text buffers, word spans and hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.session import scratch_path, shared_dir

#: The blanks between words: space and the control characters from tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"
#: Bytes of text that are turned into numpy arrays at once.
BLOCK = 1 << 21

_IS_BLANK = np.zeros(256, dtype=bool)
_IS_BLANK[[ord(c) for c in BLANKS]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it again: computed once, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, name: str, **more: str) -> DataFrame:
    """``written`` under more settings; the shuffle files behind the table go as soon as it is there, not when the driver collects garbage."""
    conf = df.sparkSession.conf
    settings = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", **more}
    before = {key: conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            conf.set(key, value)
        return written(df, name)
    finally:
        for key, value in before.items():
            conf.set(key, value)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a small table of an iterative computation."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(lower: bool) -> np.ndarray:
    codes = np.arange(256, dtype=np.uint64)
    if lower:
        codes[65:91] += np.uint64(32)
    return mix(codes + np.uint64(0x51ED270B))


_VALUES = {lower: _byte_values(lower) for lower in (False, True)}
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, BLOCK)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values, one after another, and where each value starts and the last ends; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


class Words:
    """The blank-separated words of a block of texts: byte spans, row numbers and 64-bit hashes."""

    def __init__(self, data: np.ndarray, at: np.ndarray, lower: bool = False):
        blank = _IS_BLANK[data]
        cut_at = np.zeros(len(data) + 1, dtype=bool)
        cut_at[at] = True
        before = np.ones(len(data), dtype=bool)
        before[1:] = blank[:-1]
        after = np.ones(len(data), dtype=bool)
        after[:-1] = blank[1:]
        self.start = np.flatnonzero(~blank & (before | cut_at[:-1]))
        self.end = np.flatnonzero(~blank & (after | cut_at[1:])) + 1
        self.first = np.searchsorted(self.start, at)  # of each text; one more for the end
        self.counts = np.diff(self.first)
        self.row = np.repeat(np.arange(len(at) - 1), self.counts)
        self.hash = self._hashes(data, lower)

    def _hashes(self, data: np.ndarray, lower: bool) -> np.ndarray:
        out = np.empty(len(self.start), dtype=np.uint64)
        i = 0
        while i < len(out):
            base = self.start[i]
            j = max(i + 1, int(np.searchsorted(self.end, base + BLOCK, side="right")))
            size = int(self.end[j - 1] - base)
            up, down = _powers(size)
            sums = np.zeros(size + 1, dtype=np.uint64)
            np.cumsum(_VALUES[lower][data[base : base + size]] * up[:size], out=sums[1:])
            a, b = self.start[i:j] - base, self.end[i:j] - base
            out[i:j] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
            i = j
        return out

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Start word and order-aware hash of every window of ``size`` words of one text."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        total = np.zeros(n, dtype=np.uint64)
        for k in range(size):
            total = total * _BASE + self.hash[k : k + n]
        inside = np.flatnonzero(self.row[:n] == self.row[size - 1 :])
        return inside, mix(total[inside])


def blocks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Row slices of the batches with about BLOCK bytes of text each; a longer text gets a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column(batch.schema.get_field_index(column))
        _, at = text_buffer(text)
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(at, at[i] + BLOCK, side="right")) - 1)
            yield batch.slice(i, j - i)
            i = j
    # Workers are kept for later tasks; what this one needed goes back to the system.
    pa.default_memory_pool().release_unused()


def narrowed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id and text alone, under fixed names: other columns, whatever their names, do not travel."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
