"""Trie of conversation prefixes, as balanced parentheses per shard.

A conversation is the sequence of digests of its turns (128 bits of SHA-256 over role and text). Conversations are
range-partitioned and sorted by (sequence, id), which is the trie's own order, and every stretch of a bounded number of turns is a
shard. A shard writes its trie as parentheses in preorder with blocks of least excess above them:

- ``findclose`` of a node's opening delimits its subtree: the next place where the excess falls below it, found by
  going up the tree of block minima and down again;
- leaves are the pairs "()" in that stretch, a difference of two ranks;
- members and saved tokens are differences of two cumulative arrays over the preorder.

Nodes of several shards lie on the paths of a shard's first or last conversation, its spines. All others are
final in their shard. Spine nodes leave one row per shard and are merged by key: members and saved tokens add up, and each border
between neighbouring shards takes off what both sides counted of the path they share. So a root with a third of all conversations
below it, or a conversation with as many copies, is some rows per shard. The digest over the ids that end at a node is
sequential by definition; the ids arrive sorted, as joined texts, and are hashed as a stream.

Defined results: turns are ordered by number, null first, equal numbers by role and digest; rows without a conversation id belong
to none and are left out; null roles and texts are empty; ``c % 20`` is that of SQL, with the sign of ``c``; a conversation without
turns is a member of the root; an empty table has no root; other columns do not matter. A conversation is one row of
20 bytes a turn; the longest one sets the memory of its shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import written
from recordloom.operators.ordered import with_previous

DIGEST = 16
#: Turns of a shard, places of a block of parentheses, ids of a joined text.
TURNS, PLACES, IDS = 1 << 18, 64, 256

NODE_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


class Parentheses:
    """Balanced parentheses (True opens) with a tree of least excess over blocks."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.excess = np.cumsum(np.where(bits, 1, -1))
        padded = np.full(-(-len(bits) // PLACES) * PLACES, np.iinfo(np.int64).max)
        padded[: len(bits)] = self.excess
        self.least = [padded.reshape(-1, PLACES).min(axis=1)]
        while len(self.least[-1]) > 1:
            below = self.least[-1]
            if len(below) % 2:
                below = np.append(below, np.iinfo(np.int64).max)
            self.least.append(below.reshape(-1, 2).min(axis=1))
        self.opens = np.flatnonzero(bits)
        pairs = bits[:-1] & ~bits[1:]
        self.pair_rank = np.concatenate([[0], np.cumsum(pairs), [pairs.sum()]])

    def _scan(self, start: np.ndarray, level: np.ndarray) -> np.ndarray:
        """First place from ``start`` to the end of its block where the excess is at most ``level``, or -1."""
        found = np.full(len(start), -1, dtype=np.int64)
        going = np.arange(len(start))
        at = start.copy()
        end = np.minimum((start // PLACES + 1) * PLACES, len(self.bits))
        while True:
            inside = at[going] < end[going]
            going = going[inside]
            if not len(going):
                return found
            hit = self.excess[at[going]] <= level[going]
            found[going[hit]] = at[going[hit]]
            going = going[~hit]
            at[going] += 1

    def findclose(self, opening: np.ndarray) -> np.ndarray:
        """Place of the parenthesis that closes each opening one."""
        level = self.excess[opening] - 1
        following = opening + 1
        close = np.where(following % PLACES == 0, -1, self._scan(following, np.where(following % PLACES == 0, -1, level)))
        open_still = np.flatnonzero(close < 0)
        if not len(open_still):
            return close
        level, node = level[open_still], opening[open_still] // PLACES
        height = np.full(len(node), -1)
        for h, least in enumerate(self.least):  # up, until a block to the right is low enough
            up = np.flatnonzero(height < 0)
            right = np.minimum(node[up] + 1, len(least) - 1)
            turns = (node[up] % 2 == 0) & (node[up] + 1 < len(least)) & (least[right] <= level[up])
            height[up[turns]] = h
            node[up[turns]] += 1
            node[up[~turns]] //= 2
        for h in range(len(self.least) - 1, 0, -1):  # and down to its first such block
            down = np.flatnonzero(height == h)
            left = node[down] * 2
            node[down] = np.where(self.least[h - 1][left] <= level[down], left, left + 1)
            height[down] = h - 1
        close[open_still] = self._scan(node * PLACES, level)
        return close

    def children(self, opening: np.ndarray, close: np.ndarray) -> np.ndarray:
        """Number of children: places between that close back to the excess of the opening."""
        size = len(self.bits) + 1
        closings = np.flatnonzero(~self.bits)
        keys = np.sort(self.excess[closings] * size + closings)
        base = self.excess[opening] * size
        return np.searchsorted(keys, base + close) - np.searchsorted(keys, base + opening)

    def parents(self) -> np.ndarray:
        """Preorder number of each node's parent, -1 for the root: the last opening before it that is one lower."""
        size = len(self.bits) + 1
        keys = self.excess[self.opens] * size + self.opens
        order = np.argsort(keys)
        at = np.searchsorted(keys[order], (self.excess[self.opens] - 1) * size + self.opens) - 1
        return np.where(self.excess[self.opens] > 1, order[np.maximum(at, 0)], -1)


def _shared(turns: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Turns that each sequence shares with the one before it; -1 for the first, which opens the root as well."""
    size = np.diff(offsets)
    conv = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(turns)) - offsets[conv]
    before = np.maximum(conv - 1, 0)
    valid = place < size[before]
    other = np.where(valid, offsets[before] + place, 0)
    differs = ~(valid & (turns[other] == turns).all(axis=1))
    out = size.copy()
    np.minimum.at(out, conv[differs], place[differs])
    out[0] = -1
    return out


def _keys(path: bytes) -> list[bytes]:
    """Key of every node on a path, the root first."""
    running = hashlib.blake2b(digest_size=DIGEST)
    keys = [running.digest()]
    for i in range(0, len(path), DIGEST):
        running.update(path[i : i + DIGEST])
        keys.append(running.copy().digest())
    return keys


def _ends(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


EMPTY = hashlib.sha256(b"").hexdigest()

_FIELDS = {
    "kind": pa.int32(),
    "conv_id": pa.int64(),
    "depth": pa.int64(),
    "parent_conv_id": pa.int64(),
    "n_convs": pa.int64(),
    "n_children": pa.int64(),
    "n_leaves": pa.int64(),
    "saved_tokens": pa.int64(),
    "ends": pa.string(),
    "key": pa.binary(),
    "parent_key": pa.binary(),
    "first_path": pa.binary(),
    "last_path": pa.binary(),
    "last_words": pa.binary(),
}
_DDL = (
    "kind int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends string, key binary, parent_key binary, first_path binary, last_path binary, last_words binary"
)
#: Kinds of rows: final nodes (ends: the digest), a shard's share of a spine node, joined ids that end at one, the shard's borders.
INNER, SPINE, IDS_OF, BORDER = range(4)


def _batch(kind: int, n: int, **columns) -> pa.RecordBatch:
    columns["kind"] = np.full(n, kind, dtype=np.int32)
    arrays = [pa.array(columns[c], type=t) if c in columns else pa.nulls(n, t) for c, t in _FIELDS.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(_FIELDS))


def shard_rows(paths: list[bytes], words: list[np.ndarray], ids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """All rows of one shard: conversations sorted by (path, id)."""
    size = np.array([len(p) // DIGEST for p in paths], dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(size)])
    turns = np.frombuffer(b"".join(paths), dtype=np.uint64).reshape(-1, 2)
    shared = _shared(turns, offsets)
    opened = size - shared
    closed = np.append(size[:-1] - shared[1:], size[-1] + 1)
    counts = np.empty(2 * len(size), dtype=np.int64)
    counts[::2], counts[1::2] = opened, closed
    trie = Parentheses(np.repeat(np.tile([True, False], len(size)), counts))

    opening = trie.opens
    depth = trie.excess[opening] - 1
    close = trie.findclose(opening)
    after = np.arange(len(opening)) + (close - opening + 1) // 2  # preorder number behind the subtree
    n_leaves = trie.pair_rank[close] - trie.pair_rank[opening]
    n_children = trie.children(opening, close)
    parent = trie.parents()

    first = np.repeat(np.arange(len(size)), opened)  # the conversation that opened the node is its first member
    n_ends = np.bincount(np.cumsum(opened) - 1, minlength=len(opening))
    members = np.concatenate([[0], np.cumsum(n_ends)])
    n_convs = members[after] - members[:-1]
    last_words = np.zeros(len(opening), dtype=np.int64)
    inner = depth > 0
    last_words[inner] = np.concatenate([*words, np.zeros(0, dtype=np.int64)])[offsets[first[inner]] + depth[inner] - 1]
    saved = np.concatenate([[0], np.cumsum((n_convs - 1) * last_words)])
    saved_tokens = saved[after] - saved[:-1]
    stretches = np.stack([first, first + n_convs], axis=1).ravel()
    conv_id = np.minimum.reduceat(np.append(ids, np.iinfo(np.int64).max), stretches)[::2]

    on_spine: dict[int, bytes] = {}
    for j in {0, len(paths) - 1}:
        node = int(opened[: j + 1].sum()) - 1
        for key in reversed(_keys(paths[j])):
            on_spine[node] = key
            node = int(parent[node])
    spine = np.array(sorted(on_spine), dtype=np.int64)
    is_spine = np.zeros(len(opening), dtype=bool)
    is_spine[spine] = True

    def columns(nodes: np.ndarray) -> dict:
        above = np.maximum(parent[nodes], 0)
        return {
            "conv_id": conv_id[nodes],
            "depth": depth[nodes],
            "parent_conv_id": conv_id[above],
            "n_convs": n_convs[nodes],
            "n_children": n_children[nodes],
            "n_leaves": n_leaves[nodes],
            "saved_tokens": saved_tokens[nodes],
            "parent_key": [on_spine.get(int(a)) if p >= 0 else None for a, p in zip(above, parent[nodes])],
        }

    final = np.flatnonzero(~is_spine)
    if len(final):
        ends = [hashlib.sha256(_ends(ids[j : j + n]).encode()).hexdigest() if n else EMPTY for j, n in zip(first[final], n_ends[final])]
        yield _batch(INNER, len(final), **columns(final), ends=ends)
    yield _batch(SPINE, len(spine), **columns(spine), key=[on_spine[int(v)] for v in spine])
    for v in spine[n_ends[spine] > 0]:
        mine = ids[first[v] : first[v] + n_ends[v]]
        pieces = [mine[i : i + IDS] for i in range(0, len(mine), IDS)]
        texts, starts = [_ends(p) for p in pieces], [int(p[0]) for p in pieces]
        yield _batch(IDS_OF, len(pieces), key=[on_spine[int(v)]] * len(pieces), conv_id=starts, ends=texts)
    yield _batch(
        BORDER, 1, first_path=[paths[0]], conv_id=ids[:1], last_path=[paths[-1]], last_words=[words[-1].astype("<i8").tobytes()]
    )


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    paths, words, ids, turns = [], [], [], 0
    for batch in batches:
        values = batch.column("words")
        flat, at = values.flatten().to_numpy(zero_copy_only=False).astype(np.int64), 0
        for path, conv_id in zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist()):
            n = len(path) // DIGEST
            if paths and turns + n + 1 > TURNS:
                yield from shard_rows(paths, words, np.array(ids, dtype=np.int64))
                paths, words, ids, turns = [], [], [], 0
            paths.append(path)
            words.append(flat[at : at + n])
            ids.append(conv_id)
            turns, at = turns + n + 1, at + n
    if paths:
        yield from shard_rows(paths, words, np.array(ids, dtype=np.int64))


def _border_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the shards on both sides of a border counted of the path their conversations share."""
    for batch in batches:
        for row in batch.to_pylist():
            if row["last_path"] is None:
                continue
            mine, other = row["first_path"], row["last_path"]
            a, b = (np.frombuffer(x, dtype=np.uint64).reshape(-1, 2) for x in (mine, other))
            n = min(len(a), len(b))
            differs = np.flatnonzero((a[:n] != b[:n]).any(axis=1))
            n = int(differs[0]) if len(differs) else n
            words = np.concatenate([[0], np.frombuffer(row["last_words"], dtype="<i8")[:n]])
            keys = _keys(mine[: n * DIGEST])
            yield _batch(
                SPINE,
                n + 1,
                key=keys,
                parent_key=[None, *keys[:-1]],
                depth=np.arange(n + 1),
                n_convs=np.zeros(n + 1, dtype=np.int64),
                n_children=np.where(np.arange(n + 1) < n, -1, 0),
                # If the left side ends here it counted a leaf that is the right side's too, or none.
                n_leaves=np.full(n + 1, -1 if len(b) == n else 0),
                saved_tokens=np.cumsum(words[::-1])[::-1],
            )


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 per key over joined texts that arrive in order."""
    key, running = None, hashlib.sha256()
    for batch in batches:
        done = []
        for k, text in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if k != key:
                if key is not None:
                    done.append((key, running.hexdigest()))
                key, running = k, hashlib.sha256(text.encode())
            else:
                running.update(f",{text}".encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names=["key", "digest"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([running.hexdigest()])], names=["key", "digest"])


def head_turns(conv_id: Column) -> Column:
    """How many turns a rebuilt conversation takes from its base."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 4).cast("int")


def rebuilt(conversations: DataFrame, id_col="conv_id", turn_col="turn", role_col="role", text_col="text", family: int = 20) -> DataFrame:
    """Per conversation: conv_id, path (digests of its rebuilt turns) and the words of each."""
    names = ((id_col, "conv_id"), (turn_col, "turn"), (role_col, "role"), (text_col, "text"))
    turns = conversations.select(*[F.col(f"`{c}`").alias(n) for c, n in names]).filter("conv_id IS NOT NULL")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * DIGEST)
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    turn = F.struct("turn", role.alias("role"), digest.alias("digest"), words.alias("words"))
    convs = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    convs = convs.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns"))
    bases = convs.filter(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, 3).alias("head"))
    both = convs.join(bases, F.col("conv_id") - F.col("conv_id") % family == F.col("base"), "left")
    h = head_turns(F.col("conv_id"))
    own = F.slice("turns", h + 1, F.size("turns"))
    whole = both.select("conv_id", F.when(F.col("head").isNull(), own).otherwise(F.concat(F.slice("head", F.lit(1), h), own)).alias("turns"))
    return whole.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"),
        F.transform("turns", lambda t: t["words"].cast("int")).alias("words"),
    )


def trie_nodes(sequences: DataFrame) -> DataFrame:
    """Nodes of the trie over rows (conv_id, path, words), with the columns of ``NODE_COLUMNS``."""
    sequences = written(sequences.select("conv_id", "path", "words"), "sequences")
    dealt = sequences.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    rows = written(dealt.mapInArrow(_rows, _DDL), "trie")

    borders = rows.filter(F.col("kind") == BORDER).select(F.lit(0).alias("all"), "first_path", "conv_id", "last_path", "last_words")
    borders = with_previous(borders, "all", ["first_path", "conv_id"], ["last_path", "last_words"], "before")
    borders = borders.select("first_path", F.col("before.last_path").alias("last_path"), F.col("before.last_words").alias("last_words"))
    counted = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    spine = rows.filter(F.col("kind") == SPINE).unionByName(borders.mapInArrow(_border_rows, _DDL))
    spine = spine.groupBy("key", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.min("parent_key").alias("parent_key"), *[F.sum(c).alias(c) for c in counted]
    )
    texts = rows.filter(F.col("kind") == IDS_OF).select("key", "conv_id", "ends").repartition("key").sortWithinPartitions("key", "conv_id")
    digests = texts.mapInArrow(_digest_rows, "key binary, digest string")
    spine = spine.join(digests, "key", "left").withColumn("ends", F.coalesce("digest", F.lit(EMPTY)))
    spine = written(spine.drop("digest"), "spines")

    above = spine.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent"))
    columns = ["conv_id", "depth", "parent_conv_id", "parent_key", *counted, "ends"]
    nodes = spine.withColumn("parent_conv_id", F.lit(None).cast("long")).select(*columns)
    nodes = nodes.unionByName(rows.filter(F.col("kind") == INNER).select(*columns))
    nodes = nodes.join(above, "parent_key", "left")
    return nodes.select(
        "conv_id", "depth", F.coalesce("parent", "parent_conv_id").alias("parent_conv_id"), *counted, F.col("ends").alias("ends_sha256")
    )


def conversation_trie(conversations: DataFrame, **names) -> DataFrame:
    """Nodes of the prefix trie of the rebuilt conversations."""
    return trie_nodes(rebuilt(conversations, **names))
