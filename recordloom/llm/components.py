"""Connected components of an edge table by repeated contraction; nothing is gathered on the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import cut

#: Edges a task holds at once. A table of no more of them is finished by one task, larger ones are contracted by joins.
TASK_EDGES = 1 << 20


def connected(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(id, component): smallest id reachable from each node with a smaller one; other nodes have no row.

    Tasks first reduce the edges they hold to trees. Rows are dealt by their smaller node, and a hot node is split over tasks.
    As long as more than ``TASK_EDGES`` are left, every node hooks to its smallest neighbour below it, chains of hooks are
    flattened and the edges are contracted to the roots. A star contracts in one round, any graph in a logarithmic number.
    Hooks are aggregated before the shuffle and joins may split a hot root. Every round costs the driver a dozen jobs however
    small its tables are, so the last edges, of a bounded number, take one task instead.
    """
    a, b = F.col(left), F.col(right)
    edges = edges.filter(a != b).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    edges = cut(_trees(edges.hint("rebalance", "a")))
    found: DataFrame | None = None
    while edges.count() > TASK_EDGES:
        hooks = _flattened(edges.groupBy("b").agg(F.min("a").alias("root")).withColumnRenamed("b", "id"))
        edges = edges.join(hooks.select(F.col("id").alias("a"), F.col("root").alias("ra")), "a", "left")
        edges = edges.join(hooks.select(F.col("id").alias("b"), F.col("root").alias("rb")), "b", "left")
        ra, rb = F.coalesce("ra", "a"), F.coalesce("rb", "b")
        edges = edges.filter(ra != rb).select(F.least(ra, rb).alias("a"), F.greatest(ra, rb).alias("b"))
        edges = cut(_trees(edges.hint("rebalance", "a")))
        found = hooks if found is None else _through(found, hooks).unionByName(hooks)
    last = cut(_trees(edges.coalesce(1)).select(F.col("b").alias("id"), F.col("a").alias("root")))
    if found is None:
        return last.withColumnRenamed("root", "component")
    return cut(_through(found, last).unionByName(last).withColumnRenamed("root", "component"))


def _trees(edges: DataFrame) -> DataFrame:
    """Edges with the same components of each task's share: every node and the smallest one it reaches there."""
    return edges.mapInArrow(_tree_rows, "a long, b long")


def _tree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a = b = np.zeros(0, dtype=np.int64)
    waiting: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        waiting.append(batch)
        rows += batch.num_rows
        if rows >= TASK_EDGES:
            a, b = _joined_trees(a, b, waiting)
            waiting, rows = [], 0
            if len(a) >= TASK_EDGES:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                a = b = np.zeros(0, dtype=np.int64)
    a, b = _joined_trees(a, b, waiting)
    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _joined_trees(a: np.ndarray, b: np.ndarray, batches: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    a, b = (np.concatenate([held, *[x.column(k).to_numpy() for x in batches]]) for k, held in enumerate((a, b)))
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        rx, ry = root[x], root[y]
        apart = rx != ry
        if not apart.any():
            break
        x, y, rx, ry = x[apart], y[apart], rx[apart], ry[apart]
        np.minimum.at(root, np.maximum(rx, ry), np.minimum(rx, ry))
        while not np.array_equal(up := root[root], root):
            root = up
    below = root < np.arange(len(root))
    return nodes[root[below]], nodes[below]


def _through(first: DataFrame, then: DataFrame) -> DataFrame:
    moved = first.join(then.select(F.col("id").alias("root"), F.col("root").alias("_next")), "root", "left")
    return moved.select("id", F.coalesce("_next", "root").alias("root"))


def _flattened(hooks: DataFrame) -> DataFrame:
    """Let every hook point to the end of its chain; the length of chains halves each time."""
    hooks = cut(hooks)
    while True:
        on = hooks.select(F.col("id").alias("root"), F.col("root").alias("_next"))
        moved = hooks.join(on, "root", "left")
        moved = cut(moved.select("id", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        if moved.filter("_moved").isEmpty():
            return moved.drop("_moved")
        hooks = moved.drop("_moved")


def open_clusters(clusters: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of clusters that still hold several components: cluster, id, component, members, outside.

    ``clusters`` are the components of all candidate pairs, ``labels`` those of the confirmed ones.
    ``outside`` marks members of any but the largest component; clusters of two have been compared.
    """
    roots = clusters.select(F.col("component").alias("id"), "component").distinct()
    members = clusters.unionByName(roots).select("id", F.col("component").alias("cluster"))
    placed = members.join(labels, "id", "left").select("cluster", "id", F.coalesce("component", "id").alias("component"))
    parts = placed.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    largest = parts.groupBy("cluster").agg(
        F.sum("n").alias("members"), F.count("*").alias("parts"), F.max(F.struct("n", "component")).alias("top")
    )
    largest = largest.filter("parts > 1 AND members > 2").select("cluster", "members", F.col("top.component").alias("top"))
    return cut(placed.join(largest, "cluster").withColumn("outside", F.col("component") != F.col("top")).drop("top"))


def block_grid(members: DataFrame, payload: DataFrame, side: int) -> DataFrame:
    """Deal the outside members of open clusters, and all members, into the blocks of a grid.

    Both sides of a cluster fall into blocks of about ``side`` members, so a task holds two blocks at
    most whatever the size of the cluster. Rows: cluster, row, col, side (0 outside, 1 all), id,
    component and the columns of ``payload``, sorted by cell and side.
    """
    cols = F.ceil(F.col("members") / side).cast("int")
    outside = members.filter("outside").groupBy("cluster").agg(F.ceil(F.count("*") / side).cast("int").alias("rows"))
    sized = members.join(outside, "cluster")
    all_rows = F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("row")
    all_cols = F.explode(F.sequence(F.lit(0), cols - 1)).alias("col")
    own_row, own_col = (F.pmod(F.xxhash64("id"), n).cast("int") for n in (F.col("rows"), cols))
    whole = sized.select("cluster", all_rows, own_col.alias("col"), F.lit(1).alias("side"), "id", "component")
    pivots = sized.filter("outside").select("cluster", own_row.alias("row"), all_cols, F.lit(0).alias("side"), "id", "component")
    rest = [c for c in payload.columns if c != "id"]
    cells = whole.unionByName(pivots).join(payload, "id").select("cluster", "row", "col", "side", "id", "component", *rest)
    return cells.repartition("cluster", "row", "col").sortWithinPartitions("cluster", "row", "col", "side", "id")
