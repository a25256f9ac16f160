"""Compression of vectors to a short code: one codebook index per part of a vector, trained by Lloyd rounds over cover trees.

Vectors are scaled to integers and cut into equal parts. Blocks of rows build one cover tree per part, once: a node is a
centre, a radius and a stretch of the block's points in tree order; its children are centres more than half the radius apart
that cover its points. In a round every block walks its trees with the codebook. By the triangle inequality an entry farther from
the centre than the nearest one by more than twice the radius is nearest to no point below. A node with one entry left goes to it
whole, its sum being a difference of two cumulative sums; only the others are opened, down to exact comparisons in the leaves.
Distances are integers, so a round does not depend on the cut into blocks. Per round and task, count and sums of each entry travel.

Defined results: rows whose vector is null, holds null or a non-finite component are left out; so are vectors of no length that
the parts divide, or of another length than the one with the smallest id. Fewer rows than entries make smaller codebooks. Repeated
ids are rows of their own, ties among the first ids are ordered by vector, rows without an id come last. Null labels are one label.
An empty table gives an empty result. Components are exact up to 2^28 / sqrt(length); a larger one ends the job with a message
rather than with a wrapped distance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from recordloom.llm.common import written

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Vectors of a block, which is what a task holds at once; points of a node that is not divided further.
BLOCK, LEAF = 4096, 32

NODE = np.dtype([("centre", "<i4"), ("lo", "<i4"), ("hi", "<i4"), ("first", "<i4"), ("last", "<i4"), ("radius", "<f8")])


def _squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances, points x entries."""
    out = np.zeros((len(points), len(entries)), dtype=np.int64)
    for k in range(points.shape[1]):
        step = points[:, k, None] - entries[None, :, k]
        out += step * step
    return out


def _far(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    step = points - centre
    return np.sqrt((step * step).sum(axis=1).astype(np.float64))


@dataclass
class CoverTree:
    """Cover tree over the rows of ``points``: ``order`` lists them so that every node is a stretch of it."""

    points: np.ndarray
    order: np.ndarray
    nodes: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray, leaf: int = LEAF) -> CoverTree:
        order = np.arange(len(points), dtype=np.int32)
        far = _far(points, points[0]) if len(points) else np.zeros(0)
        nodes = [(0, 0, len(points), 0, 0, far.max(initial=0.0))]
        i = 0
        while i < len(nodes):  # nodes are appended level by level, so children stand together
            centre, lo, hi, _, _, radius = nodes[i]
            if hi - lo > leaf and radius > 0:
                members, cover = order[lo:hi].copy(), radius / 2
                first, at = len(nodes), lo
                while len(members):
                    away = _far(points[members], points[centre])
                    near = away <= cover
                    mine = members[near]
                    order[at : at + len(mine)] = mine
                    nodes.append((centre, at, at + len(mine), 0, 0, away[near].max()))
                    at, members = at + len(mine), members[~near]
                    centre = members[0] if len(members) else centre
                nodes[i] = (nodes[i][0], lo, hi, first, len(nodes), radius)
            i += 1
        return cls(points, order, np.array(nodes, dtype=NODE))

    def stretches(self, entries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(lo, hi, entry) of stretches of ``order`` whose points are all nearest to that entry; ties go to the lower one."""
        if not len(self.points):
            return
        at, open_to = np.zeros(1, dtype=np.int64), np.ones((1, len(entries)), dtype=bool)
        while len(at):
            nodes = self.nodes[at]
            squares = _squares(self.points[nodes["centre"]], entries)
            best = np.where(open_to, squares, np.iinfo(np.int64).max).argmin(axis=1)
            away, radius = np.sqrt(squares.astype(np.float64)), nodes["radius"]
            nearest = away[np.arange(len(at)), best]
            # The margin keeps entries that rounding alone would rule out; they only cost a look further down.
            open_to = open_to & (away <= ((nearest + 2 * radius) * (1 + 1e-9) + 1e-9)[:, None])
            whole = (open_to.sum(axis=1) == 1) | (radius == 0)
            yield nodes["lo"][whole], nodes["hi"][whole], best[whole]
            leaves = ~whole & (nodes["last"] == 0)
            if leaves.any():
                size = (nodes["hi"] - nodes["lo"])[leaves]
                lo = np.repeat(nodes["lo"][leaves], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                squares = _squares(self.points[self.order[lo]], entries)
                squares[~np.repeat(open_to[leaves], size, axis=0)] = np.iinfo(np.int64).max
                yield lo, lo + 1, squares.argmin(axis=1)
            inner = ~whole & ~leaves
            size = (nodes["last"] - nodes["first"])[inner]
            at = np.repeat(nodes["first"][inner], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            open_to = np.repeat(open_to[inner], size, axis=0)

    def gather(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and componentwise sum of the points nearest to each entry."""
        sums = np.zeros((len(self.points) + 1, self.points.shape[1]), dtype=np.int64)
        np.cumsum(self.points[self.order], axis=0, out=sums[1:])
        count, total = np.zeros(len(entries), dtype=np.int64), np.zeros((len(entries), sums.shape[1]), dtype=np.int64)
        for lo, hi, entry in self.stretches(entries):
            np.add.at(count, entry, hi - lo)
            np.add.at(total, entry, sums[hi] - sums[lo])
        return count, total

    def nearest(self, entries: np.ndarray) -> np.ndarray:
        """Entry of every point, in the order of ``points``."""
        out = np.zeros(len(self.points), dtype=np.int64)
        for lo, hi, entry in self.stretches(entries):
            size = hi - lo
            place = np.repeat(lo, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            out[self.order[place]] = np.repeat(entry, size)
        return out


def _scaled(flat: np.ndarray, length: int) -> np.ndarray:
    values = np.floor(flat.astype(np.float64) * SCALE).reshape(-1, length)
    if len(values) and np.abs(values).max() > (1 << 28) / np.sqrt(length):
        raise ValueError(f"a component beyond 2^28 / sqrt({length}) after scaling has no exact distance in 64 bits")
    return values.astype(np.int64)


def _block_rows(length: int, parts: int, schema: pa.Schema):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                block = batch.slice(i, BLOCK)
                values = _scaled(block.column("vector").flatten().to_numpy(zero_copy_only=False), length)
                fits = np.int16 if np.abs(values).max() < 1 << 15 else np.int32
                width = length // parts
                trees = [CoverTree.of(values[:, p * width : (p + 1) * width]) for p in range(parts)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "ids": [block.column("id")],
                        "labels": [block.column("label")],
                        "bytes": [np.dtype(fits).itemsize],
                        "points": [values.astype(fits).tobytes()],
                        "orders": [[t.order.tobytes() for t in trees]],
                        "nodes": [[t.nodes.tobytes() for t in trees]],
                    },
                    schema=schema,
                )

    return rows


def _trees(row: dict, length: int) -> tuple[np.ndarray, list[CoverTree]]:
    points = np.frombuffer(row["points"], dtype=f"<i{row['bytes']}").reshape(-1, length).astype(np.int64)
    width = length // len(row["orders"])
    return points, [
        CoverTree(points[:, p * width : (p + 1) * width], np.frombuffer(order, dtype="<i4"), np.frombuffer(nodes, dtype=NODE))
        for p, (order, nodes) in enumerate(zip(row["orders"], row["nodes"]))
    ]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One block at a time, whatever the batch holds."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _sum_rows(codebooks: list[np.ndarray], length: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = length // len(codebooks)
        count = np.zeros((len(codebooks), len(codebooks[0])), dtype=np.int64)
        total = np.zeros((*count.shape, width), dtype=np.int64)
        for row in _rows(batches):
            for p, tree in enumerate(_trees(row, length)[1]):
                n, sums = tree.gather(codebooks[p])
                count[p] += n
                total[p] += sums
        part, entry, place = np.indices(total.shape).reshape(3, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (part, entry, place, np.repeat(count.ravel(), width), total.ravel())],
            names=["part", "entry", "place", "n", "total"],
        )

    return rows


def _code_rows(codebooks: list[np.ndarray], length: int, schema: pa.Schema):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                points, trees = _trees(row.select(["bytes", "points", "orders", "nodes"]).to_pylist()[0], length)
                codes = np.zeros((len(points), len(trees)), dtype=np.uint8)
                error = np.zeros(len(points), dtype=np.int64)
                for p, tree in enumerate(trees):
                    which = tree.nearest(codebooks[p])
                    codes[:, p] = which
                    error += ((tree.points - codebooks[p][which]) ** 2).sum(axis=1)
                digits, width = codes.tobytes().hex(), 2 * codes.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        row.column("ids").flatten(),
                        row.column("labels").flatten(),
                        pa.array([digits[k : k + width] for k in range(0, len(digits), width)]),
                        pa.array(error),
                    ],
                    schema=schema,
                )

    return rows


def usable(vectors: DataFrame, parts: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """id, vector and label of the rows whose vector is whole, finite and divided by the parts."""
    value = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = vectors.select(*[F.col(f"`{c}`").alias(n) for c, n in ((id_col, "id"), (vector_col, "vector"), (label_col, "label"))])
    return rows.filter(F.forall("vector", value) & (F.size("vector") > 0) & (F.size("vector") % parts == 0))


def compress_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """Rows (id, label, code, error), and the codebooks: one array of entries x components per part."""
    if not 0 < entries <= 256:
        raise ValueError("an index has two hexadecimal digits: 1 to 256 entries")
    spark = vectors.sparkSession
    kept = usable(vectors, parts, id_col, vector_col, label_col)
    fields = [T.StructField("id", kept.schema["id"].dataType), T.StructField("label", kept.schema["label"].dataType)]
    out = T.StructType([*fields, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    by_id = [F.col("id").asc_nulls_last(), F.col("vector")]
    first = kept.orderBy(*by_id).limit(1).collect()
    if not first:
        return spark.createDataFrame([], out), []
    length = len(first[0].vector)
    kept = kept.filter(F.size("vector") == length)
    seeds = kept.select("id", "vector").orderBy(*by_id).limit(entries).collect()  # as many rows as a codebook has entries
    seeds = _scaled(np.array([r.vector for r in seeds], dtype=np.float64).ravel(), length)
    codebooks = [seeds[:, p : p + length // parts].copy() for p in range(0, length, length // parts)]

    blob = T.ArrayType(T.BinaryType())
    shape = T.StructType(
        [
            T.StructField("ids", T.ArrayType(fields[0].dataType)),
            T.StructField("labels", T.ArrayType(fields[1].dataType)),
            T.StructField("bytes", T.IntegerType()),
            T.StructField("points", T.BinaryType()),
            T.StructField("orders", blob),
            T.StructField("nodes", blob),
        ]
    )
    trees = written(kept.mapInArrow(_block_rows(length, parts, to_arrow_schema(shape)), shape), "cover-trees")
    walked = trees.select("bytes", "points", "orders", "nodes")
    for _ in range(rounds):
        sums = walked.mapInArrow(_sum_rows(codebooks, length), "part long, entry long, place long, n long, total long")
        sums = sums.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        codebooks = [c.copy() for c in codebooks]
        for r in sums.filter("n > 0").collect():  # entries x length rows, whatever the table
            codebooks[r.part][r.entry, r.place] = r.total // r.n
    return trees.mapInArrow(_code_rows(codebooks, length, to_arrow_schema(out)), out), codebooks


def digest(codebooks: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for book in codebooks for x in book.ravel().tolist()).encode()).hexdigest()


def vector_codes(vectors: DataFrame, **options) -> DataFrame:
    """Per kept row: vec_id, code, error, label_error (summed over the rows of its label) and the digest of the codebooks."""
    codes, codebooks = compress_vectors(vectors, **options)
    codes = written(codes, "vector-codes")
    totals = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    # A label may hold any share of the rows: its one total is joined back, and adaptive execution may split the label's rows.
    return codes.join(totals, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256")
    )
