"""Near-duplicate documents by HyperMinHash.

A document is the set of its distinct five-word shingles. The upper bits of a shingle's hash choose
one of 256 buckets; a bucket stores its smallest hash as a leading-zero count and ten mantissa bits,
16 bits in all. Empty buckets borrow from others in a fixed order, so that short documents band like
long ones. Bands of five compressed registers are join keys. Candidates pass an estimate of the
similarity, corrected for register collisions, and are then confirmed on full shingle sets.

Copies (equal sets) collapse to one representative before banding. Members of a band bucket are not
paired with each other: each is compared with the bucket's smallest member, and confirmed links form
components. What bands join, confirmed or not, is a cluster. Where a cluster still holds several
components, the members outside its largest one are compared with all its members, in blocks of a
grid that give back only links that join components. So a bucket of near copies costs one comparison
per member and no pair that shares a band is left out.

Defined results: a null, empty or blank text has no shingle and is linked with nothing; fewer than
five words are one shingle; rows of equal sets are one class; the component is the smallest id
reachable; a row without an id gets its class's id, or none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import Words, blocks, cut, mix, narrowed, text_buffer, written
from recordloom.llm.components import block_grid, connected, open_clusters
from recordloom.operators.ordered import with_position

SHINGLE = 5
BUCKETS = 256
MANTISSA = 10
BAND_ROWS = 5
#: At a similarity of 0.75 a pair shares no band with probability (1 - 0.75 ** 5) ** 51, about 1e-6.
BANDS = BUCKETS // BAND_ROWS
PERCENT = 75
#: An estimate this many standard deviations below the threshold is dropped without verification.
DEVIATIONS = 5.0
#: Documents in a block of the grid that compares the members of an open cluster.
SIDE = 512


def _probe_order() -> np.ndarray:
    rng = np.random.default_rng(20240229)
    return np.stack([rng.permutation(BUCKETS) for _ in range(BUCKETS)])


_PROBES = _probe_order()


def shingle_sets(data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; A-Z count as a-z."""
    words = Words(data, at, lower=True)
    start, keys = words.windows(SHINGLE)
    row = words.row[start]
    bounds = np.searchsorted(row, np.arange(len(at)))
    out = []
    for i in range(len(at) - 1):
        n = int(words.counts[i])
        if n >= SHINGLE:
            out.append(np.unique(keys[bounds[i] : bounds[i + 1]]))
        elif n:
            whole = words.hash[words.first[i] : words.first[i] + n]
            total = np.uint64(n)
            with np.errstate(over="ignore"):
                for h in whole:
                    total = total * np.uint64(0xD6E8FEB86659FD93) + h
            out.append(mix(np.array([total], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def registers(shingles: np.ndarray) -> np.ndarray:
    """HyperMinHash of a sorted set: per bucket 1 + leading zeros and the mantissa of its smallest hash; 0 if empty."""
    out = np.zeros(BUCKETS, dtype=np.uint16)
    bucket = (shingles >> np.uint64(56)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    rest = ((shingles[first] << np.uint64(8)) >> np.uint64(11)).astype(np.int64)  # 53 bits, exact as float
    length = np.frexp(rest.astype(np.float64))[1].astype(np.int64)
    aligned = np.where(length > MANTISSA, rest >> np.maximum(length - MANTISSA - 1, 0), rest << np.maximum(MANTISSA + 1 - length, 0))
    out[bucket[first]] = ((54 - length) << MANTISSA) | (aligned & ((1 << MANTISSA) - 1))
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """Keys of the bands of each row of registers; empty buckets borrow from the next filled one of their order."""
    dense = regs.copy()
    row, col = np.nonzero(dense == 0)
    step = 0
    while len(row):
        value = regs[row, _PROBES[col, step]]
        dense[row, col] = value
        left = value == 0
        row, col, step = row[left], col[left], step + 1
    parts = dense[:, : BANDS * BAND_ROWS].reshape(len(dense), BANDS, BAND_ROWS).astype(np.uint64)
    key = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), parts.shape[:2]).copy()
    for k in range(BAND_ROWS):
        key = mix(key + parts[:, :, k])
    return key.view(np.int64)


def _collision_table() -> tuple[np.ndarray, np.ndarray]:
    """Expected number of equal registers of two disjoint sets, over a grid of set sizes."""
    sizes = np.round(2.0 ** np.arange(0, 24.5, 0.5))
    zeros = np.arange(53)[:, None]
    step = 2.0 ** -(zeros + 1.0) / (1 << MANTISSA)
    low = (2.0 ** -(zeros + 1.0) + np.arange(1 << MANTISSA)[None, :] * step).ravel()
    high = low + np.broadcast_to(step, (53, 1 << MANTISSA)).ravel()
    n = sizes[:, None]
    share = np.exp(n * np.log1p(-low / BUCKETS)) - np.exp(n * np.log1p(-high / BUCKETS))
    return sizes, BUCKETS * share @ share.T


_COLLISIONS: list = []


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Similarity of rows of registers, corrected for chance collisions, and its standard deviation at the threshold."""
    if not _COLLISIONS:
        _COLLISIONS.extend(_collision_table())
    sizes, table = _COLLISIONS
    at = [np.clip(np.round(2 * np.log2(np.maximum(x, 1))).astype(int), 0, len(sizes) - 1) for x in (n, m)]
    equal = ((a == b) & (a > 0)).sum(axis=1)
    filled = np.maximum(((a > 0) | (b > 0)).sum(axis=1), 1)
    share = PERCENT / 100
    return (equal - table[at[0], at[1]]) / filled, np.sqrt(share * (1 - share) / filled)


def _sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text"):
        sets = shingle_sets(*text_buffer(block.column(1)))
        with np.errstate(over="ignore"):
            sums = [[int(mix(s ^ np.uint64(c)).sum(dtype=np.uint64).view(np.int64)) for s in sets] for c in (0x5BD1E995, 0x27D4EB2F)]
        yield pa.RecordBatch.from_arrays(
            [
                block.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(sums[0], pa.int64()),
                pa.array(sums[1], pa.int64()),
                pa.array([registers(s).tobytes() for s in sets], pa.binary()),
            ],
            names=["doc_id", "n_shingles", "s1", "s2", "regs"],
        )


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(len(column), BUCKETS)


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = band_keys(_matrix(batch.column(1)))
            ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], names=["key", "rep"])


def _estimated_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            n, m = (batch.column(i).to_numpy() for i in (2, 3))
            guess, deviation = estimate(_matrix(batch.column(4)), _matrix(batch.column(5)), n, m)
            good = guess >= PERCENT / 100 - DEVIATIONS * deviation
            yield batch.select([0, 1]).filter(pa.array(good))


def _confirmed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            good = []
            for x, y in zip(*(shingle_sets(*text_buffer(part.column(c))) for c in (2, 3)), strict=True):
                same = len(np.intersect1d(x, y, assume_unique=True))
                good.append(len(x) > 0 and len(y) > 0 and 100 * same >= PERCENT * (len(x) + len(y) - same))
            yield part.select([0, 1]).filter(pa.array(good, pa.bool_()))


def _verified(pairs: DataFrame, candidates: DataFrame) -> DataFrame:
    """Pairs (a, b) of candidate ids that pass the estimate and the full sets."""
    sketch = candidates.select("rep", "n_shingles", "regs")
    near = (
        pairs.join(sketch.toDF("a", "n", "ra"), "a")
        .join(sketch.toDF("b", "m", "rb"), "b")
        .select("a", "b", "n", "m", "ra", "rb")
        .mapInArrow(_estimated_rows, "a long, b long")
    )
    texts = candidates.select("rep", "text")
    full = near.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b").select("a", "b", "ta", "tb")
    return cut(full.mapInArrow(_confirmed_rows, "a long, b long").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    texts = narrowed(docs, id_col, text_col)
    sketches = written(
        texts.mapInArrow(_sketch_rows, "doc_id long, n_shingles long, s1 long, s2 long, regs binary"), "sketches"
    )
    one_set = ["n_shingles", "s1", "s2"]
    filled = sketches.filter("n_shingles > 0")
    classes = filled.groupBy(*one_set).agg(F.min("doc_id").alias("rep"))
    heads = filled.join(classes.filter("rep IS NOT NULL").select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    bands = heads.select("doc_id", "regs").mapInArrow(_band_rows, "key long, rep long")
    pivots = bands.groupBy("key").agg(F.min("rep").alias("pivot"), F.max("rep").alias("most"), F.count("*").alias("members"))
    buckets = written(bands.join(pivots.filter("pivot < most"), "key").select("key", "rep", "pivot", "members"), "buckets")

    ids = buckets.select("rep").distinct()
    found = texts.join(ids.withColumnRenamed("rep", "doc_id"), "doc_id", "left_semi")
    candidates = written(found.mapInArrow(_candidate_rows, "rep long, n_shingles long, regs binary, text string"), "candidates")

    star = cut(buckets.filter("rep != pivot").select(F.col("rep").alias("a"), F.col("pivot").alias("b")).distinct())
    links = _verified(star, candidates)
    labels = connected(links)
    members = open_clusters(connected(star), labels)
    if not members.isEmpty():
        grid = block_grid(members, candidates.withColumnRenamed("rep", "id"), SIDE)
        joints = cut(grid.mapInArrow(_grid_rows, "a long, b long"))
        labels = connected(labels.select(F.col("component").alias("a"), F.col("id").alias("b")).unionByName(joints))

    labels = labels.select(F.col("id").alias("rep"), "component")
    placed = classes.join(labels, "rep", "left").select(*one_set, F.coalesce("component", "rep").alias("component"))
    return sketches.join(placed, one_set, "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _digest(text_col: str):
    return F.unhex(F.sha2(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary"), 256))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each group the document with the smallest id.

    A document is an id and a text. Different texts under one id are different documents, the one of the smaller SHA-256 first:
    for the search the others get numbers behind the largest id. Rows that repeat an id and a text have one fate. Rows without
    an id stay and decide nothing.
    """
    known = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).filter("id IS NOT NULL")
    known = known.withColumn("digest", _digest("text"))
    largest = known.agg(F.max("id")).first()[0]
    if largest is None:
        return docs
    several = known.groupBy("id").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).filter("low < high")
    others = known.select("id", "digest").join(several.select("id", "low"), "id").filter("digest > low").select("id", "digest").distinct()
    others = written(with_position(others, ["id", "digest"]), "other-texts")
    nodes = known.join(others, ["id", "digest"], "left").withColumn("node", F.coalesce(F.col("position") + largest + 1, F.col("id")))
    found = near_duplicates(nodes, "node", "text").select(F.col("doc_id").alias("node"), "component_id").distinct()
    placed = written(nodes.select("node", "id", "digest").distinct().join(found, "node"), "near-groups")
    one = F.struct("id", "digest")
    firsts = placed.groupBy("component_id").agg(F.min(one).alias("first"), F.count("*").alias("n")).filter("n > 1")
    gone = placed.join(firsts, "component_id").filter(one != F.col("first"))
    names = {c: f"{c} of what goes" for c in ("id", "digest")}
    while set(names.values()) & set(docs.columns):
        names = {c: f"{n}'" for c, n in names.items()}
    gone = gone.select(*[F.col(c).alias(n) for c, n in names.items()])
    same = [F.col(f"`{id_col}`") == F.col(f"`{names['id']}`"), _digest(text_col) == F.col(f"`{names['digest']}`")]
    return docs.join(gone, same, "left_anti")


def _grid_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cell = None
    held: tuple[list, list] = ([], [])
    for batch in batches:
        for block in blocks(iter([batch]), "text"):
            sets = shingle_sets(*text_buffer(block.column(8)))
            regs = _matrix(block.column(7))
            for i, (cluster, row, col, side, rep, component) in enumerate(
                zip(*(block.column(c).to_pylist() for c in range(6)), strict=True)
            ):
                if (cluster, row, col) != cell:
                    if held[0]:
                        yield _joined(*held)
                    cell, held = (cluster, row, col), ([], [])
                held[side].append((rep, component, sets[i], regs[i]))
    if held[0]:
        yield _joined(*held)


def _joined(pivots: list[tuple], members: list[tuple]) -> pa.RecordBatch:
    """Links of a block that join components, each new joint once."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    out: list[tuple[int, int]] = []
    if members:
        reps = np.array([m[0] for m in members])
        parts = np.array([m[1] for m in members])
        sizes = np.array([len(m[2]) for m in members])
        regs = np.stack([m[3] for m in members])
        words, place = np.unique(np.concatenate([m[2] for m in members]), return_inverse=True)
        starts = np.cumsum(sizes) - sizes
        for rep, component, shingles, own in pivots:
            guess, deviation = estimate(np.broadcast_to(own, regs.shape), regs, np.full(len(sizes), len(shingles)), sizes)
            near = (guess >= PERCENT / 100 - DEVIATIONS * deviation) & (parts != component)
            if not near.any():
                continue
            hit = np.zeros(len(words) + 1, dtype=np.int64)
            at = np.searchsorted(words, shingles)
            at = at[at < len(words)]
            hit[at[np.isin(words[at], shingles, assume_unique=True)]] = 1
            same = np.add.reduceat(hit[place], starts)
            linked = near & (100 * same >= PERCENT * (sizes + len(shingles) - same))
            for other, part in zip(reps[linked].tolist(), parts[linked].tolist(), strict=True):
                a, b = find(component), find(part)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    out.append((rep, other))
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])


def _candidate_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text"):
        sets = shingle_sets(*text_buffer(block.column(1)))
        yield pa.RecordBatch.from_arrays(
            [
                block.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([registers(s).tobytes() for s in sets], pa.binary()),
                block.column(1),
            ],
            names=["rep", "n_shingles", "regs", "text"],
        )
