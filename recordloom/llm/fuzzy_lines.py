"""Line dedup across a corpus, for lines that are equal or nearly so.

A line's normal form is its words without case and punctuation, digits as zeros. Each distinct form gets a SimHash of BITS bits
over all its windows of WINDOW bytes, and the hash is cut into BLOCKS pigeonhole blocks, each a
join key. Two forms whose SimHashes differ in fewer than BLOCKS bits share a block and always meet; others meet with
the chance that some block has no differing bit. Nothing of this depends on the number of lines. The README states from which edit
similarity on recall is 0.9.

Two forms that meet are linked if their SimHashes differ in at most RADIUS bits and the normal forms have the edit similarity. The
members of a block's bucket are compared with its smallest member; buckets that still hold several components are compared in the
blocks of a grid, by SimHash first, and by text where that leaves a partner. Of each connected group the first occurrence (smallest
doc_id, then line) stays.

Defined results: a null text has no lines; lines without a letter or digit stay; rows that repeat
with the same id and text are one document; rows without an id keep all their lines.
"""

from __future__ import annotations

import os.path
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import BLOCK, Words, blocks, mix, narrowed, settled, text_buffer, written
from recordloom.llm.components import block_grid, connected

#: SimHash: bytes of a window, blocks of 32 bits, and all bits.
WINDOW, BLOCKS = 4, 16
BITS = 32 * BLOCKS
#: Differing bits of two forms that are compared as texts, at most.
RADIUS = 64
_WORDS = BITS // 64
_COLUMNS = [f"w{k}" for k in range(_WORDS)]
#: Windows that are added up as bits side by side, and windows handled at once.
_GROUP, _AT_ONCE = 32, 1 << 16
#: Scans that large are worth a filter at run time.
_FILTERED = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "16m"}
#: Edit similarity: 1 - distance / longer length.
PERCENT = 85
#: Members of a block of the grid: SimHashes alone, and with texts.
SIDE, TEXT_SIDE = 1024, 256

_NORMAL = np.arange(256, dtype=np.uint8)
for _code in range(128):
    _char = chr(_code)
    _NORMAL[_code] = ord(_char.lower()) if _char.isalpha() else 48 if _char.isdigit() else 10 if _char == "\n" else 32


class Lines:
    """Lines of a block of texts: text, number in the text, words and 64-bit hash of the normal form."""

    def __init__(self, column: pa.Array):
        data, at = text_buffer(column)
        self.data = _NORMAL[data]
        breaks = np.flatnonzero(self.data == 10) + 1
        starts = np.union1d(at[:-1], breaks)
        starts = starts[starts < len(data)]  # empty texts have no line
        self.bounds = np.append(starts, len(data))
        self.row = np.searchsorted(at, starts, side="right") - 1
        first = np.searchsorted(starts, at[:-1])
        self.number = np.arange(len(starts)) - first[self.row]
        self.words = Words(self.data, self.bounds)
        counts = self.words.counts
        self.some = np.flatnonzero(counts)
        place = np.arange(len(self.words.hash)) - np.repeat(self.words.first[:-1], counts)
        powers = np.full(int(counts.max()) if len(counts) and counts.max() else 1, 0x9E3779B97F4A7C15, dtype=np.uint64)
        powers[0] = 1
        spread = self.words.hash * np.multiply.accumulate(powers)[place]
        sums = np.add.reduceat(spread, self.words.first[self.some]) if len(self.some) else np.zeros(0, dtype=np.uint64)
        self.hash = mix(sums + counts[self.some].astype(np.uint64)).view(np.int64)

    def normal_bytes(self) -> tuple[np.ndarray, np.ndarray]:
        """Normal forms with a blank before every word, and where each line with a word starts (and the last ends)."""
        lengths = self.words.end - self.words.start
        at = np.append(0, np.cumsum(lengths + 1))
        out = np.full(at[-1], 32, dtype=np.uint8)
        inside = np.ones(len(out), dtype=bool)
        inside[at[:-1]] = False
        out[inside] = self.data[(self.data != 32) & (self.data != 10)]
        return out, at[np.append(self.words.first[self.some], len(lengths))]

    def simhashes(self, mine: np.ndarray, every: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """SimHash, as words, of those lines with a word that ``mine`` marks and that have a window; and which lines these are.

        ``every`` counts all windows, as line dedup does; else about one in four, chosen by its own hash.
        """
        data, at = self.normal_bytes()
        owners, found = [np.zeros(0, dtype=np.int64)], [np.zeros((0, _WORDS), dtype=np.uint64)]
        i = 0
        while i < len(mine):  # about BLOCK bytes at once, also of a longer text
            j = max(i + 1, int(np.searchsorted(at, at[i] + BLOCK, side="right")) - 1)
            row, value = _windows(data[at[i] : at[j]], at[i : j + 1] - at[i], mine[i:j], every)
            if len(row):
                starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
                owners.append(row[starts] + i)
                found.append(_votes(value, starts))
            i = j
        return np.concatenate(owners), np.concatenate(found)

    def normal_text(self, k: int) -> str:
        """Normal form of the k-th line with a word."""
        line = self.some[k]
        return b" ".join(self.data[self.bounds[line] : self.bounds[line + 1]].tobytes().split()).decode(errors="replace")


def _windows(data: np.ndarray, at: np.ndarray, lines: np.ndarray, every: bool) -> tuple[np.ndarray, np.ndarray]:
    """(line, bytes as a number) of every window of the marked lines, or of those that their own hash chooses, in order."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint32)
    value = np.zeros(n, dtype=np.uint32)
    for k in range(WINDOW):
        value = value << np.uint32(8) | data[k : k + n]
    inside = np.repeat(lines, np.diff(at))[:n]
    for k in range(1, WINDOW):  # no window reaches beyond its line
        last = at[1:] - k
        inside[last[(last >= 0) & (last < n)]] = False
    if not every:
        inside &= value * np.uint32(0x9E3779B1) < np.uint32(1 << 30)
    start = np.flatnonzero(inside)
    return np.repeat(np.arange(len(lines)), np.diff(at))[start], value[start]


def _numbered(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, and the place of each value among them."""
    if len(value) < 1 << 16:
        return np.unique(value, return_inverse=True)
    slot = value * np.uint32(0x9E3779B1) >> np.uint32(12)
    owner = np.full(1 << 20, -1, dtype=np.int32)
    owner[slot] = np.arange(len(value), dtype=np.int32)
    used = np.flatnonzero(owner >= 0)
    known = value[owner[used]]
    owner[used] = np.arange(len(used), dtype=np.int32)
    place = owner[slot]
    others = np.flatnonzero(known[place] != value)  # another value has the slot
    more, at = np.unique(value[others], return_inverse=True)
    place[others] = len(known) + at
    return np.append(known, more), place


_SEEDS = mix(np.arange(1, _WORDS + 1, dtype=np.uint64))


def _votes(value: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Majority of every bit over the windows of each line; ``starts`` are the lines' first windows."""
    distinct, place = _numbered(value)  # most windows of a text are those of other lines, too
    feature = mix(distinct.astype(np.uint64) + np.uint64(0x632BE5AB))
    bits = np.append(mix(feature[:, None] + _SEEDS[None, :]), np.zeros((1, _WORDS), dtype=np.uint64), axis=0)
    bounds = np.append(starts, len(value))
    out = np.empty((len(starts), _WORDS), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + _AT_ONCE, side="right")) - 1)
        size = np.diff(bounds[i : j + 1])
        if size[0] > _AT_ONCE:  # alone, in parts
            counts = np.zeros(BITS, dtype=np.int64)
            for k in range(0, int(size[0]), _AT_ONCE):
                part = place[bounds[i] + k : min(bounds[i] + k + _AT_ONCE, bounds[j])]
                for power, plane in enumerate(_bit_counts(bits, part, np.array([len(part)]))):
                    counts += np.unpackbits(plane.view(np.uint8)).astype(np.int64) << power
            out[i] = np.packbits(counts * 2 > size[0]).view(np.uint64)
        else:
            out[i:j] = _above(_bit_counts(bits, place[bounds[i] : bounds[j]], size), size // 2)
        i = j
    return out


def _bit_counts(bits: np.ndarray, window: np.ndarray, size: np.ndarray) -> np.ndarray:
    """How many of each line's windows have each bit, as columns of bits (power, line, word).

    ``window`` has the row of ``bits`` of each window; the last row has no bit. The windows of a line form groups; members of groups,
    then groups, are added side by side.
    """
    groups = -(-size // _GROUP)
    first = np.cumsum(groups) - groups
    n = int(groups.sum())
    number = np.arange(len(window)) - np.repeat(np.cumsum(size) - size, size)
    row = np.full(_GROUP * n, len(bits) - 1, dtype=np.int64)
    row[number % _GROUP * n + np.repeat(first, size) + number // _GROUP] = window
    planes = [np.take(bits, row, axis=0, mode="clip").reshape(_GROUP, n, _WORDS)]
    while len(planes[0]) > 1:
        half = len(planes[0]) // 2
        planes = _added([p[:half] for p in planes], [p[half:] for p in planes])
    found = np.stack([p[0] for p in planes])
    while groups.max() > 1:
        half = (groups + 1) // 2
        begin = np.cumsum(half) - half
        place = 2 * (np.arange(int(half.sum())) - np.repeat(begin, half))
        left = np.repeat(first, half) + place
        alone = np.flatnonzero(place + 1 == np.repeat(groups, half))
        right = left + 1
        right[alone] = 0
        a, b = found[:, left], found[:, right]
        b[:, alone] = 0
        found = np.stack(_added(a, b))
        groups, first = half, begin
    return found


def _added(a: Sequence[np.ndarray], b: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Sums of numbers that are held as columns of bits, lowest first."""
    carry, out = None, []
    for x, y in zip(a, b, strict=True):
        both = x ^ y
        out.append(both if carry is None else both ^ carry)
        carry = x & y if carry is None else (x & y) | (both & carry)
    return [*out, carry]


def _above(planes: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Which of the numbers of a line, held as columns of bits, are larger than the line's bound."""
    above, equal = np.zeros_like(planes[0]), np.full_like(planes[0], ~np.uint64(0))
    for k in range(len(planes) - 1, -1, -1):
        bit = np.where(bound >> k & 1, ~np.uint64(0), np.uint64(0))[:, None]
        above |= equal & planes[k] & ~bit
        equal &= ~(planes[k] ^ bit)
    return above


def edit_distance(a: str, b: str, most: int) -> int:
    """Levenshtein distance by bit vectors over the parts that differ; ``most + 1`` where it is larger."""
    head = len(os.path.commonprefix((a, b)))
    a, b = a[head:], b[head:]
    tail = len(os.path.commonprefix((a[::-1], b[::-1])))
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not a or not b:
        return min(max(len(a), len(b)), most + 1)
    seen: dict[str, int] = {}
    for i, c in enumerate(a):
        seen[c] = seen.get(c, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    plus, minus, score = full, 0, len(a)
    for k, c in enumerate(b):
        eq = seen.get(c, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (full & ~(horizontal | plus))
        down = plus & horizontal
        if up & last:
            score += 1
        elif down & last:
            score -= 1
        if score - (len(b) - k - 1) > most:
            return most + 1
        up = (up << 1 | 1) & full
        down = (down << 1) & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
    return min(score, most + 1)


def similar(a: str, b: str) -> bool:
    most = (100 - PERCENT) * max(len(a), len(b)) // 100
    return abs(len(a) - len(b)) <= most and edit_distance(a, b, most) <= most


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All lines with a word; the first of each form in a block brings the form's SimHash."""
    for block in blocks(batches, "text"):
        lines = Lines(block.column(1))
        _, one = np.unique(lines.hash, return_index=True)
        mine = np.zeros(len(lines.some), dtype=bool)
        mine[one] = True
        owner, words = lines.simhashes(mine, every=True)
        without = np.ones(len(lines.some), dtype=bool)
        without[owner] = False
        spread = np.zeros((len(lines.some), _WORDS), dtype=np.int64)
        spread[owner] = words.view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                block.column(0).take(pa.array(lines.row[lines.some])),
                pa.array(lines.number[lines.some].astype(np.int32)),
                pa.array(lines.hash),
                *[pa.array(np.ascontiguousarray(spread[:, k]), mask=without) for k in range(_WORDS)],
            ],
            names=["doc_id", "line", "h", *_COLUMNS],
        )


def _bucket_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, h, pivot) of the members of buckets, from rows (key, h) in order: all but the smallest, with the smallest."""
    last = pivot = None
    for batch in batches:
        keys, h = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(keys):
            continue
        new = np.append(keys[0] != last, keys[1:] != keys[:-1])
        at = np.maximum.accumulate(np.where(new, np.arange(len(keys)), -1))
        pivots = np.where(at < 0, 0 if pivot is None else pivot, h[np.maximum(at, 0)])
        last, pivot = int(keys[-1]), int(pivots[-1])
        yield pa.RecordBatch.from_arrays([pa.array(x[~new]) for x in (keys, h, pivots)], names=["key", "h", "pivot"])


def _text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) of wanted lines; the normal form of each."""
    for block in blocks(batches, "text"):
        lines = Lines(block.column(1))
        wanted = [set(x or ()) for x in block.column(2).to_pylist()]
        row, number = lines.row[lines.some].tolist(), lines.number[lines.some].tolist()
        mine = [k for k, (r, n) in enumerate(zip(row, number, strict=True)) if n in wanted[r]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(lines.hash[mine], pa.int64()), pa.array([lines.normal_text(k) for k in mine], pa.string())], names=["id", "text"]
        )


def _similar_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = [similar(a, b) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, list]]:
    """(cluster, outside members, all members) of each cell of a grid; a member is (id, component, SimHash[, text])."""
    cell, held = None, ([], [])
    for batch in batches:
        words = np.stack([batch.column(i).to_numpy() for i in range(6, 6 + _WORDS)], axis=1).view(np.uint64)
        texts = batch.column(6 + _WORDS).to_pylist() if batch.num_columns > 6 + _WORDS else [None] * batch.num_rows
        for k, (cluster, row, col, side, node, component) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True)):
            if (cluster, row, col) != cell:
                if cell is not None:
                    yield cell[0], *held
                cell, held = (cluster, row, col), ([], [])
            held[side].append((node, component, words[k], texts[k]))
    if cell is not None:
        yield cell[0], *held


def _near(cluster: int, pivots: list[tuple], members: list[tuple]) -> Iterator[tuple[tuple, np.ndarray]]:
    """Each outside member with the places of the members of other components within the radius.

    Two forms that share several blocks are compared in the bucket of the first of them alone.
    """
    if not members:
        return
    words = np.stack([m[2] for m in members])
    parts = np.array([m[1] for m in members])
    block, low = cluster >> 32, np.uint64((1 << 32) - 1)
    for pivot in pivots:
        differs = words ^ pivot[2]
        near = np.flatnonzero((np.bitwise_count(differs).sum(axis=1) <= RADIUS) & (parts != pivot[1]))
        equal = np.stack([differs[near] >> np.uint64(32) == 0, differs[near] & low == 0], axis=2).reshape(len(near), BLOCKS)
        yield pivot, near[~equal[:, :block].any(axis=1)]


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a grid again, cut between cells; a cell has two blocks at most."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if rest is not None:
            batch = pa.concat_batches([rest, batch])
        keys = [batch.column(i).to_numpy() for i in range(3)]
        last = np.flatnonzero(np.any([k[:-1] != k[1:] for k in keys], axis=0))
        n = int(last[-1]) + 1 if len(last) else 0
        if n:
            yield batch.slice(0, n)
        rest = batch.slice(n)
    if rest is not None:
        yield rest


def _partner_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cluster, id) of the members of cells that have a partner in another component within the radius."""
    for batch in _whole_cells(batches):
        cluster, row, col, side, node, component = (batch.column(i).to_numpy() for i in range(6))
        words = np.stack([batch.column(i).to_numpy() for i in range(6, 6 + _WORDS)], axis=1).view(np.uint64)
        starts = np.flatnonzero(np.append(True, (cluster[1:] != cluster[:-1]) | (row[1:] != row[:-1]) | (col[1:] != col[:-1])))
        ends = np.append(starts[1:], len(side))
        first = starts + np.add.reduceat(side == 0, starts, dtype=np.int64)  # the outside members come first
        pivots = np.flatnonzero(side == 0)
        cell = np.searchsorted(starts, pivots, side="right") - 1
        number = (ends - first)[cell]
        upto = np.append(0, np.cumsum(number))
        found = np.zeros(len(side), dtype=bool)
        i = 0
        while i < len(pivots):  # about _AT_ONCE comparisons at once
            j = max(i + 1, int(np.searchsorted(upto, upto[i] + _AT_ONCE, side="right")) - 1)
            a = np.repeat(pivots[i:j], number[i:j])
            b = np.arange(len(a)) + np.repeat(first[cell[i:j]] - (upto[i:j] - upto[i]), number[i:j])
            for k in range(0, _WORDS, _WORDS // 2):  # half of the words rules out nearly all
                if not k:
                    keep = component[a] != component[b]
                    a, b, apart = a[keep], b[keep], 0
                half = words[a, k : k + _WORDS // 2] ^ words[b, k : k + _WORDS // 2]
                apart = apart + np.bitwise_count(half).sum(axis=1, dtype=np.int64)
                a, b, apart = a[apart <= RADIUS], b[apart <= RADIUS], apart[apart <= RADIUS]
            differs, low = words[a] ^ words[b], np.uint64((1 << 32) - 1)
            equal = np.stack([differs >> np.uint64(32) == 0, differs & low == 0], axis=2).reshape(len(a), BLOCKS)
            # Two forms that share several blocks are compared in the bucket of the first of them alone.
            earlier = (equal & (np.arange(BLOCKS) < (cluster[a] >> 32)[:, None])).any(axis=1)
            found[a[~earlier]] = found[b[~earlier]] = True
            i = j
        yield pa.RecordBatch.from_arrays([pa.array(cluster[found]), pa.array(node[found])], names=["cluster", "id"])


def _grid_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of cells that join components, each new joint of a cell once."""
    for cluster, pivots, members in _cells(batches):
        root: dict[int, int] = {}

        def find(x: int, root=root) -> int:
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        out = []
        for (node, component, _, text), near in _near(cluster, pivots, members):
            for other, part, _, known in (members[k] for k in near.tolist()):
                if find(component) != find(part) and similar(text, known):
                    root[find(component)] = find(part)
                    out.append((node, other))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """All lines (doc_id, line, h), and those that are to go (doc_id, line)."""
    texts = narrowed(docs, id_col, text_col).filter("doc_id IS NOT NULL")
    shape = "doc_id long, line int, h long, " + ", ".join(f"{w} long" for w in _COLUMNS)
    found = written(texts.mapInArrow(_line_rows, shape), "lines")
    lines = found.select("doc_id", "line", "h")

    equal = [F.max(w).alias(w) for w in _COLUMNS]  # equal forms have equal words
    sketches = settled(found.filter("w0 IS NOT NULL").groupBy("h").agg(*equal), "simhashes")
    halves = [x for w in _COLUMNS for x in (F.shiftrightunsigned(w, 32), F.col(w).bitwiseAND(F.lit((1 << 32) - 1)))]
    keys = sketches.select("h", F.posexplode(F.array(*halves)).alias("block", "value"))
    keys = keys.select((F.col("block").cast("long") * (1 << 32) + F.col("value")).alias("key"), "h")
    # One pass over the keys in order: a bucket of any size is a stream of its members, of which only the first is held.
    dealt = keys.repartition("key").sortWithinPartitions("key", "h")
    buckets = settled(dealt.mapInArrow(_bucket_rows, "key long, h long, pivot long"), "buckets")
    met = buckets.select(F.col("h").alias("a"), F.col("pivot").alias("b")).distinct()
    pairs = settled(_within_radius(met, sketches), "line-pairs")

    forms = _forms(texts, lines, pairs.select("a").union(pairs.select("b")))
    both = pairs.join(forms.toDF("a", "ta"), "a").join(forms.toDF("b", "tb"), "b").select("a", "b", "ta", "tb")
    links = settled(both.mapInArrow(_similar_rows, "a long, b long"), "line-links")
    labels = connected(links)
    more = _with_partners(_open_buckets(buckets, labels), sketches)
    if not more.isEmpty():
        forms = _forms(texts, lines, more.select("id"))
        payload = forms.join(sketches.withColumnRenamed("h", "id"), "id").select("id", *_COLUMNS, "text")
        joints = settled(block_grid(more, payload, TEXT_SIDE).mapInArrow(_grid_rows, "a long, b long"), "line-joints")
        labels = connected(links.unionByName(joints))

    grouped = lines.join(labels.withColumnRenamed("id", "h"), "h", "left")
    grouped = settled(grouped.select("doc_id", "line", F.coalesce("component", "h").alias("g")), "line-groups")
    firsts = grouped.groupBy("g").agg(F.min(F.struct("doc_id", "line")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    gone = grouped.join(firsts, "g").filter("doc_id != first.doc_id OR line != first.line").select("doc_id", "line")
    return lines, gone


def _forms(texts: DataFrame, lines: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of the normal forms of ``ids``, each made again from its first line."""
    places = lines.join(ids.toDF("h").distinct(), "h", "left_semi").groupBy("h").agg(F.min(F.struct("doc_id", "line")).alias("p"))
    # Written first: where few documents are wanted, their table is small enough to be sent to the texts.
    wanted = settled(places.groupBy("p.doc_id").agg(F.collect_set("p.line").alias("wanted")), "wanted-lines")
    # Else Spark's Bloom filter of their ids keeps most other texts from travelling; it asks for a condition on the smaller side.
    chosen = texts.join(wanted.filter(F.size("wanted") > 0), "doc_id").select("doc_id", "text", "wanted")
    return settled(chosen.mapInArrow(_text_rows, "id long, text string").dropDuplicates(["id"]), "line-forms", **_FILTERED)


def _within_radius(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs (a, b) whose SimHashes differ in at most RADIUS bits."""
    found = pairs.withColumn("apart", F.lit(0))
    # Half of the words rules out nearly all chance meetings, so those travel with half of their width.
    for half in (_COLUMNS[: _WORDS // 2], _COLUMNS[_WORDS // 2 :]):
        for side in "ab":
            found = found.join(sketches.select(F.col("h").alias(side), *[F.col(w).alias(f"{side}{w}") for w in half]), side)
        apart = reduce(lambda x, y: x + y, [F.bit_count(F.col(f"a{w}").bitwiseXOR(F.col(f"b{w}"))) for w in half], F.col("apart"))
        found = found.select("a", "b", apart.alias("apart")).filter(F.col("apart") <= RADIUS)
    return found.select("a", "b")


def _with_partners(members: DataFrame, sketches: DataFrame) -> DataFrame:
    """Of the members of open buckets those that have a partner in another component within the radius."""
    grid = block_grid(members, sketches.withColumnRenamed("h", "id"), SIDE)
    partners = grid.mapInArrow(_partner_rows, "cluster long, id long").distinct()
    return settled(members.join(partners, ["cluster", "id"]), "line-partners")


def _open_buckets(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets that still hold several components, as ``components.open_clusters`` gives them.

    A bucket of two is settled by its one comparison. Chance meetings of unlike forms stay in their bucket and join no others.
    """
    large = buckets.groupBy("key").agg(F.count("*").alias("n"), F.min("pivot").alias("pivot")).filter("n > 1")
    members = buckets.join(large.select("key"), "key").select("key", "h").unionByName(large.select("key", F.col("pivot").alias("h")))
    placed = members.select(F.col("key").alias("cluster"), F.col("h").alias("id")).join(labels, "id", "left")
    placed = placed.select("cluster", "id", F.coalesce("component", "id").alias("component"))
    parts = placed.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    most = parts.groupBy("cluster").agg(F.sum("n").alias("members"), F.count("*").alias("parts"), F.max(F.struct("n", "component")).alias("top"))
    most = most.filter("parts > 1").select("cluster", "members", F.col("top.component").alias("top"))
    return settled(placed.join(most, "cluster").withColumn("outside", F.col("component") != F.col("top")).drop("top"), "open-buckets")


def _removals(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    lines, gone = repeated_lines(docs, id_col, text_col)
    return lines, gone.groupBy("doc_id").agg(F.sort_array(F.collect_set("line")).alias("gone"))


def line_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines (with a letter or digit), n_removed, removed (line numbers from 0)."""
    lines, gone = _removals(docs, id_col, text_col)
    counts = lines.groupBy("doc_id").agg(F.countDistinct("line").alias("n_lines"))
    found = counts.join(gone, "doc_id", "left")
    return narrowed(docs, id_col, text_col).select("doc_id").join(found, "doc_id", "left").select(
        "doc_id",
        F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join("gone", ","), F.lit("")).alias("removed"),
    )


def remove_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, clean_text) per row of ``docs``: the text without the lines that go."""
    _, gone = _removals(docs, id_col, text_col)
    texts = narrowed(docs, id_col, text_col).join(gone, "doc_id", "left")
    stay = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.coalesce("gone", F.array().cast("array<int>")), i))
    return texts.select("doc_id", F.array_join(stay, "\n").alias("clean_text"))
