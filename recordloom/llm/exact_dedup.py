"""Exact dedup by an extendible-hash index on shared files.

A directory of ``2**depth`` slots maps the upper bits of a key to a bucket. It starts with one
bucket; a bucket with more than ``capacity`` rows is split on its next bit, and the directory
doubles when a bucket as deep as the directory has to split. The owner task of a bucket gets the
entries of its key range, chains those of one key, compares their bytes and writes what it found to
the index, a table in the shared folder in which each bucket lies in one file.

Hot texts are combined before the shuffle: a map task sends one entry per distinct text, with the
smallest id and the number of rows, so a text that a third of all rows share is a few entries.

Defined results: a null text is the empty text; of equal texts the row with the smallest id stays;
rows of equal id and text share one decision; a row without an id loses against rows with one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import BLANKS, BLOCK, narrowed, written

#: A directory has at most this many buckets; beyond it buckets hold more rows instead.
MOST_BUCKETS = 1 << 16
_BLANK_BYTES = tuple(c.encode() for c in BLANKS)


def normal_bytes(text: str | None) -> bytes:
    """UTF-8 of the text with every run of blanks as one space; null is empty."""
    raw = (text or "").encode()
    words = b" ".join(raw.split())
    if not words:
        return b" " if raw else b""
    return (b" " if raw.startswith(_BLANK_BYTES) else b"") + words + (b" " if raw.endswith(_BLANK_BYTES) else b"")


class Directory:
    """Slots of an extendible hash: ``slots[prefix]`` is the bucket of all keys with that prefix."""

    def __init__(self):
        self.depth = 0
        self.slots = [0]
        self.local = [0]

    def split(self, bucket: int, slot: int) -> int:
        """Split the bucket that starts at ``slot`` on its next bit; the upper half becomes a new bucket."""
        if self.local[bucket] == self.depth:
            self.slots = [b for b in self.slots for _ in range(2)]
            self.depth += 1
            slot *= 2
        self.local[bucket] += 1
        self.local.append(self.local[bucket])
        half = 1 << (self.depth - self.local[bucket])
        self.slots[slot + half : slot + 2 * half] = [len(self.local) - 1] * half
        return len(self.local) - 1


def build_directory(histogram: dict[int, int], bits: int, capacity: int) -> Directory:
    """Split buckets until each holds at most ``capacity`` rows or one prefix of ``bits`` bits, which no split divides."""
    sums = np.zeros((1 << bits) + 1, dtype=np.int64)
    for prefix, n in histogram.items():
        sums[prefix + 1] = n
    sums = np.cumsum(sums)
    directory = Directory()
    todo = [(0, 0)]  # a bucket and the first of its prefixes
    while todo:
        bucket, low = todo.pop()
        width = 1 << (bits - directory.local[bucket])
        if width > 1 and sums[low + width] - sums[low] > capacity:
            new = directory.split(bucket, low >> (bits - directory.depth))
            todo += [(bucket, low), (new, low + width // 2)]
    return directory


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shas = [hashlib.sha256(normal_bytes(t.as_py())).digest() for t in batch.column(1)]
        keys = [int.from_bytes(s[:8], "big", signed=True) for s in shas]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(keys, pa.int64()), pa.array(shas, pa.binary())], names=["doc_id", "key", "sha"]
        )


def _entry_maker(directory: Directory):
    slots, shift = np.array(directory.slots), 64 - directory.depth

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One entry per distinct text of a stretch of rows; a stretch ends when its texts take eight blocks."""
        held: dict[bytes, list] = {}
        size = 0

        def flush():
            bucket = [int(slots[int.from_bytes(sha[:8], "big") >> shift]) for _, sha, *_ in held.values()]
            key = [int.from_bytes(sha[:8], "big", signed=True) for _, sha, *_ in held.values()]
            arrays = [pa.array(bucket, pa.int32()), pa.array(key, pa.int64())]
            for i, kind in ((1, pa.binary()), (0, pa.binary()), (2, pa.int64()), (3, pa.int64())):
                arrays.append(pa.array([v[i] for v in held.values()], kind))
            return pa.RecordBatch.from_arrays(arrays, names=["bucket", "key", "sha", "body", "first_id", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                body = normal_bytes(text.as_py())
                old = held.get(body)
                if old is None:
                    held[body] = [body, hashlib.sha256(body).digest(), doc_id, 1]
                    size += len(body)
                else:
                    old[2] = _smaller(old[2], doc_id)
                    old[3] += 1
                if size > 8 * BLOCK:
                    yield flush()
                    held.clear()
                    size = 0
        if held:
            yield flush()

    return entries


def _smaller(a: int | None, b: int | None) -> int | None:
    return b if a is None or (b is not None and b < a) else a


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries in key order: those of one key form a chain, in which equal bytes are one link."""
    bucket = key = None
    chain: list[list] = []  # sha, body, smallest id, rows
    done: list[tuple] = []

    def flush():
        out = pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*done, strict=True), _INDEX_TYPES, strict=True)], names=_INDEX_NAMES
        )
        done.clear()
        return out

    for batch in batches:
        for i in range(batch.num_rows):
            b, k, sha, body, first, n = (batch.column(c)[i].as_py() for c in range(6))
            if k != key:
                done += [(bucket, key, s, f, m) for s, _, f, m in chain]
                bucket, key, chain = b, k, []
                if len(done) >= 10_000:
                    yield flush()
            for link in chain:
                if link[1] == body:
                    link[2], link[3] = _smaller(link[2], first), link[3] + n
                    break
                if link[0] == sha:
                    raise ValueError("two different texts have the same SHA-256")
            else:
                chain.append([sha, body, first, n])
    done += [(bucket, key, s, f, m) for s, _, f, m in chain]
    if done:
        yield flush()


_INDEX_NAMES = ["bucket", "key", "sha", "keep_id", "group_size"]
_INDEX_TYPES = [pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key, sha) per row; the key is the first eight bytes of the SHA-256 of the normalised text."""
    return narrowed(docs, id_col, text_col).mapInArrow(_signatures, "doc_id long, key long, sha binary")


def build_index(
    docs: DataFrame, signed: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2_000
) -> DataFrame:
    """Write the index and read it: bucket, key, sha, keep_id, group_size per distinct normalised text."""
    rows = signed.count()
    capacity = max(capacity, rows // MOST_BUCKETS)
    bits = max(4, (rows // capacity).bit_length() + 2)
    prefixes = signed.groupBy(F.shiftrightunsigned("key", 64 - bits).cast("int").alias("p")).count().collect()
    directory = build_directory({r["p"]: r["count"] for r in prefixes}, bits, capacity)
    entries = narrowed(docs, id_col, text_col).mapInArrow(
        _entry_maker(directory), "bucket int, key long, sha binary, body binary, first_id long, n long"
    )
    owned = entries.repartition("bucket").sortWithinPartitions("bucket", "key")
    return written(
        owned.mapInArrow(_chains, "bucket int, key long, sha binary, keep_id long, group_size long"), "exact-index"
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    signed = written(signatures(docs, id_col, text_col), "signatures")
    index = build_index(docs, signed, id_col, text_col, **options).select("key", "sha", "keep_id", "group_size")
    return signed.join(index, ["key", "sha"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; one row of each text.

    Of several rows with the id that stays and an equal text, that whose columns come first as JSON stays. A row travels as one
    struct, so no name of a column of ``docs`` can clash with one used here.
    """
    decisions = exact_duplicates(docs, id_col, text_col, **options).filter("kept")
    stay = decisions.select(F.col("text_sha256").alias("sha"), _id_key("doc_id").alias("id")).distinct()
    columns = [F.col(f"`{c}`") for c in docs.columns]
    boxed = docs.select(F.struct(*columns).alias("row"), F.sha2(_normal_column(text_col), 256).alias("sha"), _id_key(id_col).alias("id"))
    first = F.min_by("row", F.to_json("row")).alias("row")
    return boxed.join(stay, ["sha", "id"], "left_semi").groupBy("sha", "id").agg(first).select("row.*")


def _id_key(id_col: str):
    return F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))


def _normal_column(text_col: str):
    return F.regexp_replace(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")
