"""Best-fit packing of tokenised documents into sequences by linear grouping.

Documents longer than a sequence are cut into whole sequences and at most one shorter first piece.
The shorter pieces are packed by their lengths alone, so the plan is made on the driver from the
histogram of lengths, at most one entry per length below the sequence size whatever the input:

1. linear grouping: large lengths are put into groups of equal cardinality and rounded up to the
   longest of the group,
2. few-size configurations: column generation solves the cutting-stock relaxation over the rounded
   sizes; its multiplicities are rounded down and the rest is filled greedily,
3. substitution: actual lengths take the places of their rounded sizes,
4. best fit: small pieces go into the tightest gap that holds them.

The plan is made for a few thresholds and group counts, and the one with fewest sequences is used.
It is a table of runs of equal sequences; a document finds its place by its rank among the pieces
of its length. Ranks come from hashed chunks of about sqrt(rows) rows, so that a length that a third
of all documents share does not meet in one task.

Defined results: a null or empty text is the separator alone; repeated rows are packed once each;
an empty table gives no rows. Token ids are those of the given ``tokenizers`` file.
"""

from __future__ import annotations

import heapq
import json
import math
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm.common import narrowed, written

SEQUENCE = 2048
#: Encoded stretches that a worker remembers; only a cache, cleared when full.
REMEMBERED = 300_000
_ENCODERS: dict[int, ChunkEncoder] = {}


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies spell a byte as itself where it prints, and as a character from 256 on elsewhere."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ChunkEncoder:
    """Byte-level BPE ids of texts as little-endian 32-bit bytes, equal to those of the ``tokenizers`` file.

    The pre-tokeniser never joins text across a blank that a visible character follows: the blank
    starts a new word there. Stretches between such places are encoded apart and remembered. New ones
    are merged by tiktoken over the vocabulary of the file, which is several times as fast; the first
    texts of every task are encoded by ``tokenizers`` too and must agree. Texts with a special token
    in them, and files of another kind, are encoded by ``tokenizers`` alone.
    """

    _CUT = re.compile(r"(?= \S)")
    _ODD_BLANK = re.compile(r" \s")
    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(file)
        spec = json.loads(file)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.known: dict[str, bytes] = {}
        pre = spec["pre_tokenizer"] or {}
        plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and spec["normalizer"] is None
        self.merge = self._merger(spec) if plain and spec["model"]["type"] == "BPE" else None

    def _merger(self, spec):
        import tiktoken

        byte = _byte_of_char()
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        return tiktoken.Encoding("file", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    @classmethod
    def of(cls, file: str) -> ChunkEncoder:
        key = hash(file)
        if key not in _ENCODERS:
            _ENCODERS[key] = cls(file)
        return _ENCODERS[key]

    def by_tokenizers(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _stretches(self, text: str) -> list[str]:
        if self._ODD_BLANK.search(text):
            return [x for x in self._CUT.split(text) if x]
        first, *rest = text.split(" ")
        return ([first] if first else []) + [" " + x for x in rest]

    def encode(self, text: str) -> bytes:
        if self.merge is None or any(s in text for s in self.special):
            return self.by_tokenizers([text])[0]
        known, out = self.known, []
        if len(known) > REMEMBERED:
            known.clear()
        for x in self._stretches(text):
            ids = known.get(x)
            if ids is None:
                ids = np.array(self.merge(x), dtype="<u4").tobytes()
                if len(x) <= 32:
                    known[x] = ids
            out.append(ids)
        return b"".join(out)


def _token_rows(file: str, sequence: int, with_ids: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder.of(file)
        fresh = True
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = [encoder.encode(t) for t in texts]
                if fresh and encoder.by_tokenizers(texts[:8]) != ids[:8]:
                    raise ValueError("the merged ids differ from those of tokenizers")
                fresh = False
                ids = [x + b"\0\0\0\0" for x in ids]
                lengths = [len(x) // 4 for x in ids]
                crcs = []
                for x, n in zip(ids, lengths, strict=True):
                    view = memoryview(x)
                    starts = _piece_starts(n, sequence)
                    crcs.append([zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(starts, starts[1:] + [n], strict=True)])
                arrays = [part.column(0), pa.array(lengths, pa.int64()), pa.array(crcs, pa.list_(pa.int64()))]
                names = ["doc_id", "n_tokens", "crcs"]
                if with_ids:
                    arrays.append(pa.array([np.frombuffer(x, dtype="<u4").astype(np.int32) for x in ids], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return rows


def _piece_starts(n: int, sequence: int) -> list[int]:
    """Starts of the pieces of ``n`` tokens; only the first may be shorter than a sequence."""
    first = n % sequence or sequence
    return [0, *range(first, n, sequence)]


def tokenise(docs: DataFrame, file: str, id_col="doc_id", text_col="text", sequence=SEQUENCE, with_ids=False) -> DataFrame:
    """(doc_id, n_tokens with the separator, crcs of the pieces[, ids]); ``file`` is the content of a tokenizers file."""
    schema = "doc_id long, n_tokens long, crcs array<long>" + (", ids array<int>" if with_ids else "")
    return narrowed(docs, id_col, text_col).mapInArrow(_token_rows(file, sequence, with_ids), schema)


# ---- the plan: runs of equal sequences, from the histogram of lengths ----


def _groups(large: list[tuple[int, int]], groups: int) -> list[list[tuple[int, int]]]:
    """Lengths in descending order cut into groups of about equal cardinality."""
    total, out, seen = sum(n for _, n in large), [], 0
    for length, n in large:
        if not out or seen >= len(out) * total / groups:
            out.append([])
        out[-1].append((length, n))
        seen += n
    return out


def _best_column(sizes: np.ndarray, worth: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable configuration of one sequence."""
    value = np.zeros(room + 1)
    choice = np.full(room + 1, -1)
    smallest = int(sizes.min())
    for space in range(smallest, room + 1):
        gains = np.where(sizes <= space, worth + value[np.maximum(space - sizes, 0)], -1.0)
        best = int(gains.argmax())
        if gains[best] > value[space - 1]:
            value[space], choice[space] = gains[best], best
        else:
            value[space] = value[space - 1]
    column = np.zeros(len(sizes))
    space = room
    while space >= smallest:
        if choice[space] < 0 or value[space] == value[space - 1]:
            space -= 1
            continue
        column[choice[space]] += 1
        space -= int(sizes[choice[space]])
    return float(value[room]), column


def _configurations(sizes: np.ndarray, demand: np.ndarray, room: int, rounds: int = 250) -> list[tuple[np.ndarray, float]]:
    """Column generation for the cutting-stock relaxation, by the revised simplex method."""
    basis = np.diag((room // sizes).astype(float))
    amount = demand / np.diag(basis)
    for _ in range(rounds):
        inverse = np.linalg.inv(basis)
        worth = np.ones(len(sizes)) @ inverse
        value, column = _best_column(sizes, worth, room)
        if value <= 1 + 1e-6:
            break
        step = inverse @ column
        ratios = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratios.argmin())
        basis[:, out] = column
        amount = np.linalg.solve(basis, demand)
        amount[np.abs(amount) < 1e-9] = 0
    return [(basis[:, j], float(amount[j])) for j in range(len(sizes))]


def _substitute(groups: list[list[tuple[int, int]]], room: int) -> list[tuple[list[int], int]]:
    """Runs of equal sequences that hold all large pieces: configurations with actual lengths in their places."""
    sizes = np.array([g[0][0] for g in groups])
    demand = np.array([float(sum(n for _, n in g)) for g in groups])
    queues = [[list(x) for x in g] for g in groups]
    runs: list[tuple[list[int], int]] = []

    def take(i: int, n: int) -> list[tuple[int, int]]:
        out = []
        while n and queues[i]:
            head = queues[i][0]
            k = min(n, head[1])
            out.append((head[0], k))
            head[1] -= k
            n -= k
            if not head[1]:
                queues[i].pop(0)
        return out

    def place(column: np.ndarray, times: int) -> None:
        slots = [take(int(i), times) for i in np.flatnonzero(column) for _ in range(int(column[i]))]
        at = 0
        while slots and at < times:
            n, lengths = times - at, []
            for s in slots:
                if s:
                    n = min(n, s[0][1])
            for s in slots:
                if s:
                    length, left = s[0]
                    lengths.append(length)
                    s[0] = (length, left - n)
                    if left == n:
                        s.pop(0)
            if not lengths:
                break
            runs.append((lengths, n))
            at += n

    for column, amount in sorted(_configurations(sizes, demand, room), key=lambda x: -x[1]):
        if int(amount) > 0:
            place(column, int(amount))
    # What rounding down left over is few: at most one sequence per size, packed as best fit would.
    rest = sorted(((length, n) for q in queues for length, n in q), reverse=True)
    return _best_fit(runs, rest, room)


def _best_fit(runs: list[tuple[list[int], int]], items: list[tuple[int, int]], room: int) -> list[tuple[list[int], int]]:
    """Put (length, count) items, longest first, into the tightest gaps; whole runs at a time."""
    gaps: dict[int, list[tuple[list[int], int]]] = {}
    for lengths, n in runs:
        gaps.setdefault(room - sum(lengths), []).append((lengths, n))

    def fill(lengths, n, length, count):
        """Fill ``n`` equal sequences with ``count`` pieces; gives back the count that did not fit."""
        each = (room - sum(lengths)) // length
        full = min(n, count // each)
        if full:
            put(lengths + [length] * each, full)
        rest = count - full * each if full < n else count - full * each
        n -= full
        if n and rest:
            part = min(rest, each)
            put(lengths + [length] * part, 1)
            rest -= part
            n -= 1
        if n:
            put(lengths, n)
        return rest

    def put(lengths, n):
        gaps.setdefault(room - sum(lengths), []).append((lengths, n))

    for length, count in items:
        ready = [g for g in gaps if g >= length]
        heapq.heapify(ready)
        while count and ready:
            gap = heapq.heappop(ready)
            for lengths, n in gaps.pop(gap):
                if count:
                    count = fill(lengths, n, length, count)
                else:
                    put(lengths, n)
        if count:
            each = room // length
            fill([], math.ceil(count / each), length, count)
    return [run for found in gaps.values() for run in found]


def plan_sequences(histogram: dict[int, int], room: int = SEQUENCE, thresholds=(2, 3), group_counts=(24, 60)):
    """Runs (lengths, number of equal sequences) that hold every piece of the histogram, as few as found."""
    items = sorted(((length, n) for length, n in histogram.items() if n), reverse=True)
    bound = -(-sum(length * n for length, n in items) // room)
    best = None
    for part in thresholds:
        large = [x for x in items if x[0] * part > room]
        small = [x for x in items if x[0] * part <= room]
        for count in group_counts:
            if large:
                runs = _substitute(_groups(large, count), room)
            else:
                runs = []
            runs = _best_fit(runs, small, room)
            total = sum(n for _, n in runs)
            if best is None or total < best[0]:
                best = (total, runs)
            if total == bound:
                return runs
    return best[1] if best else []


def _places(runs: list[tuple[list[int], int]]) -> tuple[dict[int, tuple[np.ndarray, ...]], int]:
    """Per length: first ranks of its stretches, the sequence of each, the offset in it. And the number of sequences."""
    table: dict[int, list[list[int]]] = {}
    used: dict[int, int] = {}
    base = 0
    for lengths, n in runs:
        offset = 0
        for length in lengths:
            rank = used.get(length, 0)
            table.setdefault(length, []).append([rank, base, offset])
            used[length] = rank + n
            offset += length
        base += n
    return {k: tuple(np.array(c) for c in zip(*v, strict=True)) for k, v in table.items()}, base


def _place_rows(places, packed: int, sequence: int, with_ids: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for row in batch.to_pylist():
                n = row["n_tokens"]
                starts = _piece_starts(n, sequence)
                full = row["full_before"]
                for piece, (start, end) in enumerate(zip(starts, starts[1:] + [n], strict=True)):
                    if end - start < sequence:
                        first, base, offsets = places[end - start]
                        k = int(np.searchsorted(first, row["rank"], side="right")) - 1
                        where, offset = int(base[k] + row["rank"] - first[k]), int(offsets[k])
                    else:
                        where, offset = packed + full, 0
                        full += 1
                    ids = row["ids"][start:end] if with_ids else None
                    values = (row["doc_id"], piece, start, end - start, row["crcs"][piece], where, offset, ids)
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"]
            keep = range(8 if with_ids else 7)
            yield pa.RecordBatch.from_arrays([pa.array(out[i], kinds[i]) for i in keep], names=[names[i] for i in keep])

    return rows


def pack_documents(
    docs: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE, with_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]."""
    tokens = written(tokenise(docs, file, id_col, text_col, sequence, with_ids), "tokens")
    tokens = tokens.withColumn("short", (F.col("n_tokens") % sequence).cast("int"))
    histogram = {r["short"]: r["count"] for r in tokens.groupBy("short").count().collect()}
    rows = sum(histogram.values())
    histogram.pop(0, None)
    places, packed = _places(plan_sequences(histogram, sequence))

    chunks = max(1, math.isqrt(rows))
    full = F.floor(F.col("n_tokens") / sequence).cast("long")
    dealt = tokens.select(
        "*", full.alias("full"), F.pmod(F.xxhash64("doc_id", "n_tokens", "crcs"), F.lit(chunks)).cast("int").alias("chunk")
    )
    counts = dealt.groupBy("chunk", "short").agg(F.count("*").alias("n"), F.sum("full").alias("full"))
    totals = counts.groupBy("chunk").agg(F.sum("full").alias("full"))
    # One row per chunk, the square root of the input's rows.
    totals = totals.select("chunk", (F.sum("full").over(Window.orderBy("chunk")) - F.col("full")).alias("full_base"))
    counts = counts.select(
        "chunk", "short", (F.sum("n").over(Window.partitionBy("short").orderBy("chunk")) - F.col("n")).alias("rank_base")
    ).join(totals, "chunk")
    order = ["doc_id", "n_tokens", "crcs"]
    in_chunk = Window.partitionBy("chunk").orderBy("short", *order).rowsBetween(Window.unboundedPreceding, 0)
    ranked = dealt.select(
        *tokens.columns,
        "chunk",
        (F.row_number().over(Window.partitionBy("chunk", "short").orderBy(*order)) - 1).alias("rank_here"),
        (F.sum("full").over(in_chunk) - F.col("full")).alias("full_here"),
    )
    located = ranked.join(counts, ["chunk", "short"]).select(
        *[c for c in tokens.columns if c != "short"],
        (F.col("rank_base") + F.col("rank_here")).alias("rank"),
        (F.col("full_base") + F.col("full_here")).alias("full_before"),
    )
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return located.mapInArrow(_place_rows(places, packed, sequence, with_ids), schema + (", ids array<int>" if with_ids else ""))
