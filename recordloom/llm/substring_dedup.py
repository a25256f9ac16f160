"""Removal of repeated passages by super-k-mer partitioning.

A window is 20 consecutive words of a document; a word goes if a window that covers it also starts
earlier in the corpus. The minimiser of a window is the smallest hash of its five-word runs, and
consecutive windows that share it are one super-k-mer.

1. Minimisers are counted over the corpus, one row per document and minimiser. A window can only
   repeat if its minimiser does, so the words of all others stay where they are.
2. Super-k-mers of repeated minimisers travel as one packed string to the bucket of their minimiser.
   A map task sends each distinct string once, with its first place; the later places in the task
   are repeats for certain. Where a minimiser is shared by more than ``heavy`` documents (a passage
   that much of the corpus holds, in ever new contexts), the string is cut into its windows and each
   goes to a bucket of its own, so no bucket grows with the corpus.
3. A bucket is sorted. Equal strings are whole repeats of the first; the windows of the different
   strings are sorted and compared word by word.

Defined results: a null text has no words; texts under 20 words stay whole; of rows that repeat with
the same id and text none is earlier than the other; rows without an id are left as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import BLOCK, Words, blocks, mix, narrowed, text_buffer, written

WINDOW = 20
MINIMISER = 5
#: Longest super-k-mer in windows; a longer run travels in several strings to the same bucket.
LONGEST = 256


class SuperKmers:
    """Super-k-mers of a block of texts: row, first word, number of windows and minimiser of each."""

    def __init__(self, words: Words):
        self.words = words
        starts, _ = words.windows(WINDOW)
        if not len(starts):
            self.row = self.start = self.count = np.zeros(0, dtype=np.int64)
            self.mini, self.places = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
            return
        n = len(words.hash) - MINIMISER + 1
        runs = np.zeros(n, dtype=np.uint64)
        for k in range(MINIMISER):
            runs = runs * np.uint64(0x9E3779B97F4A7C15) + words.hash[k : k + n]
        runs = mix(runs)
        least = runs
        width = 1
        while width < WINDOW - MINIMISER + 1:  # a power of two
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        mini = least[starts]
        fresh = np.ones(len(starts), dtype=bool)
        fresh[1:] = (mini[1:] != mini[:-1]) | (np.diff(starts) != 1)
        first = np.flatnonzero(fresh)
        length = np.diff(np.append(first, len(starts)))
        parts = -(-length // LONGEST)
        offset = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        at = np.repeat(first, parts) + offset * LONGEST
        self.start = starts[at]
        self.count = np.minimum(np.repeat(length, parts) - offset * LONGEST, LONGEST)
        self.mini = mini[at]
        self.row = words.row[self.start]
        # Whether the minimiser's words stand at two places of the text; only then can it repeat in itself.
        inside = words.row[:n] == words.row[MINIMISER - 1 :]
        tagged = np.sort(mix(runs[inside] + words.row[:n][inside].astype(np.uint64)))
        twice = tagged[1:][tagged[1:] == tagged[:-1]]
        self.places = 1 + np.isin(mix(self.mini + self.row.astype(np.uint64)), twice)


def _minimiser_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text"):
        found = SuperKmers(Words(*text_buffer(block.column(1))))
        pairs = mix(found.mini + found.row.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        _, one = np.unique(pairs, return_index=True)
        ids = block.column(0).take(pa.array(found.row[one]))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(found.mini[one].view(np.int64)), pa.array(found.places[one])], names=["doc_id", "mini", "n"]
        )


_PIECE = "key long, packed binary, doc_id long, start int, n int"
_PIECE_TYPES = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * 5
    names = [part.split()[0] for part in _PIECE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PIECE_TYPES, strict=True)], names=names)


def _packed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strings for the buckets, and certain repeats as rows without a string."""
    held: dict[tuple[int, bytes], tuple[int, int, int]] = {}
    rows: list[tuple] = []
    size = 0

    def note(key: int, packed: bytes, doc_id: int, start: int, n: int) -> int:
        old = held.get((key, packed))
        if old is None:
            held[key, packed] = (doc_id, start, n)
            return len(packed)
        if (doc_id, start) < old[:2]:
            held[key, packed] = (doc_id, start, n)
            doc_id, start = old[:2]
        elif (doc_id, start) == old[:2]:
            return 0
        rows.append((_spread(doc_id, start), None, doc_id, start, n))
        return 0

    for block in blocks(batches, "text"):
        wanted = [dict(x) if x else {} for x in block.column(2).to_pylist()]
        some = [i for i, x in enumerate(wanted) if x]
        block = block.take(pa.array(some, pa.int64()))
        wanted = [wanted[i] for i in some]
        data, at = text_buffer(block.column(1))
        words = Words(data, at)
        found = SuperKmers(words)
        raw = data.tobytes()
        ids = block.column(0).to_pylist()
        for row, start, count, mini in zip(
            found.row.tolist(), found.start.tolist(), found.count.tolist(), found.mini.view(np.int64).tolist(), strict=True
        ):
            heavy = wanted[row].get(mini)
            if heavy is None:
                continue
            span = [raw[a:b] for a, b in zip(words.start[start : start + count + WINDOW - 1], words.end[start : start + count + WINDOW - 1], strict=True)]
            begin = start - int(words.first[row])
            if not heavy:
                size += note(mini, b" ".join(span), ids[row], begin, count)
                continue
            for k in range(count):
                packed = b" ".join(span[k : k + WINDOW])
                size += note(int.from_bytes(hashlib.blake2b(packed, digest_size=8).digest(), "big", signed=True), packed, ids[row], begin + k, 1)
        if size > 8 * BLOCK or len(rows) > 200_000:
            yield _batch([(k, p, *v) for (k, p), v in held.items()])
            yield _batch(rows)
            held.clear()
            rows.clear()
            size = 0
    yield _batch([(k, p, *v) for (k, p), v in held.items()])
    yield _batch(rows)


def _spread(doc_id: int, start: int) -> int:
    """Key of a row that needs no bucket."""
    return hash((doc_id, start))


def _bucket_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats of sorted buckets: (doc_id, start, n) of windows that start earlier elsewhere."""
    key = None
    strings: list[tuple[bytes, int, int, int]] = []  # different strings of the bucket at their first places
    out: list[tuple] = []

    def close():
        if len(strings) == 1 and strings[0][3] == 1:
            return
        windows = []
        for packed, doc_id, start, n in strings:
            span = packed.split(b" ")
            windows += [(b" ".join(span[k : k + WINDOW]), doc_id, start + k) for k in range(n)]
        windows.sort()
        out.extend(
            (0, None, b[1], b[2], 1) for a, b in zip(windows, windows[1:], strict=False) if a[0] == b[0] and a[1:] != b[1:]
        )

    for batch in batches:
        for k, packed, doc_id, start, n in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if packed is None:
                out.append((0, None, doc_id, start, n))
                continue
            if k != key:
                close()
                key = k
                strings.clear()
            if strings and strings[-1][0] == packed:
                if strings[-1][1:3] != (doc_id, start):
                    out.append((0, None, doc_id, start, n))
                continue
            strings.append((packed, doc_id, start, n))
        if len(out) > 50_000:
            yield _batch(out).select([2, 3, 4])
            out.clear()
    close()
    yield _batch(out).select([2, 3, 4])


def _kept_words(with_text: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            counts, removed, shas, texts = [], [], [], []
            for text, spans in zip(block.column(1), block.column(2), strict=True):
                words = (text.as_py() or "").encode().split()
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                if spans.is_valid:
                    pairs = np.array([list(s.values()) for s in spans.as_py()], dtype=np.int64)
                    np.add.at(gone, pairs[:, 0], 1)
                    np.add.at(gone, pairs[:, 0] + pairs[:, 1] + WINDOW - 1, -1)
                gone = np.cumsum(gone)[:-1] > 0
                kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g) if gone.any() else b" ".join(words)
                counts.append(len(words))
                removed.append(int(gone.sum()))
                shas.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept.decode() if with_text else None)
            arrays = [block.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(shas)]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                arrays.append(pa.array(texts, pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return rows


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True, heavy: int = 200
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256[, kept_text].

    ``heavy`` is the number of documents of a minimiser from which its windows get buckets of their own.
    """
    texts = narrowed(docs, id_col, text_col)
    minis = texts.filter("doc_id IS NOT NULL").mapInArrow(_minimiser_rows, "doc_id long, mini long, n long")
    repeated = minis.groupBy("mini").agg(F.sum("n").alias("times")).filter("times > 1")
    per_doc = minis.join(repeated, "mini").select("doc_id", F.struct("mini", F.col("times") > heavy).alias("m"))
    # Grouped by document: as many entries as the document itself has minimisers.
    wanted = written(per_doc.groupBy("doc_id").agg(F.map_from_entries(F.collect_set("m")).alias("wanted")), "minimisers")

    # Both joins read the texts through the same exchange on doc_id.
    packed = texts.join(wanted, "doc_id", "left").select("doc_id", "text", "wanted").mapInArrow(_packed_rows, _PIECE)
    sorted_buckets = packed.repartition("key").sortWithinPartitions("key", "packed", "doc_id", "start")
    repeats = sorted_buckets.mapInArrow(_bucket_rows, "doc_id long, start int, n int")
    spans = repeats.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    joined = texts.join(spans, "doc_id", "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")
    return joined.mapInArrow(_kept_words(with_text), schema)
