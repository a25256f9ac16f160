"""Prefix trie and vector codes against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordloom.llm import prefix_trie, vector_codes

# Trie


def rebuilt_plain(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def nodes_plain(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    below = defaultdict(set)
    for node in members:
        if node:
            below[node[:-1]].add(node)
    leaves, saved = Counter(), Counter()
    for node, ids in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not below[node]
            saved[node[:d]] += (len(ids) - 1) * words
    out = Counter()
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in ids if len(convs[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        row = (min(ids), len(node), parent, len(ids), len(below[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest())
        out[row] += 1
    return out


ROWS = [
    (0, 0, "user", "a b  c"),
    (0, 1, "bot", "d"),
    (0, None, None, "first of all"),
    (1, 0, "user", None),
    (1, 0, "user", None),
    (2, 5, "user", "x"),
    (21, 0, "user", "its base is missing"),
    (22, 0, "user", "its base is missing"),
    (None, 0, "user", "no conversation"),
    (40, 1, "user", " ".join(f"w{k}" for k in range(30_000))),
    *[(60 + k, t, "user", f"turn {t}") for k in range(19) for t in range(5)],
    *[(80 + k, t, "user", f"turn {t if t < 4 else k % 3}") for k in range(19) for t in range(6)],
    *[(100, t, "user", "again and again") for t in range(900)],
    *[(101, t, "user", "again and again") for t in range(850)],
]
CONV = "conv_id long, turn long, role string, text string"


def test_trie(spark):
    docs = spark.createDataFrame(ROWS, CONV).repartition(3)
    clash = ["key", "depth", "kind", "path", "words", "ends", "n_convs", "all", "head", "base", "turns", "digest", "parent"]
    got = prefix_trie.conversation_trie(docs.withColumns({c: F.lit(1) for c in clash}))
    assert got.columns == prefix_trie.NODE_COLUMNS
    assert Counter(map(tuple, got.collect())) == nodes_plain(rebuilt_plain(ROWS))
    assert prefix_trie.conversation_trie(docs.limit(0)).count() == 0


@settings(max_examples=12, deadline=None)
@given(st.integers(0, 10**6))
def test_trie_of_many_small_shards_is_that_of_one(spark, seed):
    """Borders through deep, shared and equal conversations, cut after every few turns."""
    draw = random.Random(seed)
    convs, pool = {}, []
    for c in range(60):
        base = draw.choice(pool) if pool and draw.random() < 0.8 else []
        convs[c] = base[: draw.randrange(len(base) + 1)] + [("u", "w " * draw.randrange(3)) for _ in range(draw.choice([0, 0, 1, 2, 7]))]
        pool.append(convs[c])
    digest = lambda t: hashlib.sha256(repr(t).encode()).digest()[: prefix_trie.DIGEST]
    rows = sorted((b"".join(map(digest, turns)), c, [len(t[1].split()) for t in turns]) for c, turns in convs.items())
    shards, at = [], 0
    while at < len(rows):
        n = draw.randrange(1, 9)
        shards.append(rows[at : at + n])
        at += n
    inner, spine, ends = Counter(), {}, defaultdict(list)
    add = lambda r: tuple(r[c] for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"))
    found, borders = [], []
    for shard in shards:
        for batch in prefix_trie.shard_rows([r[0] for r in shard], [np.array(r[2], dtype=np.int64) for r in shard], np.array([r[1] for r in shard])):
            found += batch.to_pylist()
    border = [r for r in found if r["kind"] == prefix_trie.BORDER]
    for a, b in zip(border, border[1:]):
        borders.append(prefix_trie._batch(prefix_trie.BORDER, 1, first_path=[b["first_path"]], last_path=[a["last_path"]], last_words=[a["last_words"]]))
    for batch in prefix_trie._border_rows(iter(borders)):
        found += batch.to_pylist()
    for r in found:
        if r["kind"] == prefix_trie.SPINE:
            old = spine.setdefault(r["key"], [r["depth"], [], (0, 0, 0, 0), None])
            old[1] += [r["conv_id"]] if r["conv_id"] is not None else []
            old[2] = tuple(map(sum, zip(old[2], add(r))))
            old[3] = r["parent_key"]
        elif r["kind"] == prefix_trie.IDS_OF:
            ends[r["key"]].append((r["conv_id"], r["ends"]))
    sha = {k: hashlib.sha256(",".join(t for _, t in sorted(v)).encode()).hexdigest() for k, v in ends.items()}
    for r in found:
        if r["kind"] == prefix_trie.INNER:
            parent = min(spine[r["parent_key"]][1]) if r["parent_key"] is not None else r["parent_conv_id"]
            inner[(r["conv_id"], r["depth"], parent, *add(r), r["ends"])] += 1
    for key, (depth, ids, sums, above) in spine.items():
        inner[(min(ids), depth, min(spine[above][1]) if above else None, *sums, sha.get(key, prefix_trie.EMPTY))] += 1
    assert inner == nodes_plain(convs)


def test_findclose_over_several_levels_of_blocks():
    rng = random.Random(3)
    bits, depth = [], 0
    for _ in range(60_000):
        up = depth == 0 or rng.random() < 0.5 + 0.2 * math.sin(len(bits) / 3000)
        bits.append(up)
        depth += 1 if up else -1
    bits = np.array([True, *bits, *[False] * depth, False])
    stack, close, parent, children = [], {}, {}, Counter()
    for i, b in enumerate(bits.tolist()):
        if b:
            parent[i] = stack[-1] if stack else -1
            children[parent[i]] += 1
            stack.append(i)
        else:
            close[stack.pop()] = i
    trie = prefix_trie.Parentheses(bits)
    got = trie.findclose(trie.opens)
    assert len(trie.least) > 5
    assert got.tolist() == [close[i] for i in trie.opens.tolist()]
    assert trie.children(trie.opens, got).tolist() == [children[i] for i in trie.opens.tolist()]
    number = {i: k for k, i in enumerate(trie.opens.tolist())} | {-1: -1}
    assert trie.parents().tolist() == [number[parent[i]] for i in trie.opens.tolist()]


# Vector codes


def codes_plain(rows, parts=8, entries=16, rounds=6):
    kept = [r for r in rows if r[1] and len(r[1]) % parts == 0 and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], None
    length = len(kept[0][1])
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in kept if len(v) == length]
    width = length // parts
    part = lambda v, p: v[p * width : (p + 1) * width]
    books = [[part(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [[min((apart(part(v, p), e), k) for k, e in enumerate(books[p])) for p in range(parts)] for _, v, _ in kept]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [part(v, p) for (_, v, _), a in zip(kept, found) if a[p][1] == k]
                if mine:
                    books[p][k] = [sum(x) // len(mine) for x in zip(*mine)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, errors = [], Counter()
    for (i, _, label), a in zip(kept, assign()):
        errors[label] += sum(d for d, _ in a)
        out.append((i, label, "".join(f"{k:02x}" for _, k in a), sum(d for d, _ in a)))
    return Counter((i, code, error, errors[label], digest) for i, label, code, error in out), digest


def vectors(n, length, seed, common=0.3):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 0.3) for _ in range(length)] for _ in range(5)]
    rows = []
    for i in range(n):
        if draw.random() < common:
            rows.append((i, [0.125] * length, 1))
        else:
            rows.append((i, [float(np.float32(x + draw.gauss(0, 0.05))) for x in draw.choice(centres)], draw.choice([None, 1, 2])))
    return rows


VEC = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("n,length", [(700, 16), (9, 8), (150, 64)])
def test_codes(spark, n, length):
    odd = [
        (None, [0.5] * length, 3),
        (3, [0.25] * length, None),
        (3, [0.25] * length, None),
        (4, None, 1),
        (5, [None] + [0.0] * (length - 1), 1),
        (6, [float("nan")] * length, 1),
        (7, [float("inf")] + [0.0] * (length - 1), 1),
        (8, [], 1),
        (9, [0.5] * (length + 8), 1),
        (10, [0.5] * (length + 1), 1),
    ]
    rows = [(i + 1, v, label) for i, v, label in vectors(n, length, n)] + odd
    docs = spark.createDataFrame(rows, VEC).repartition(3)
    clash = ["id", "vector", "code", "error", "label_error", "of", "points", "nodes", "part", "entry"]
    got = vector_codes.vector_codes(docs.withColumns({c: F.lit("x") for c in clash}))
    assert Counter(map(tuple, got.collect())) == codes_plain(rows)[0]


def test_codes_of_nothing(spark):
    got = vector_codes.vector_codes(spark.createDataFrame([(1, None, 1)], VEC))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and got.count() == 0
    with pytest.raises(ValueError):
        vector_codes.compress_vectors(got, entries=300)


def test_a_component_without_exact_distance_stops_the_job(spark):
    with pytest.raises(Exception, match="exact distance"):
        vector_codes.vector_codes(spark.createDataFrame([(1, [0.5] * 8, 1), (2, [1e30] * 8, 1)], VEC)).collect()


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 400), st.integers(1, 6))
def test_tree_covers_and_decides_like_brute_force(seed, n, width):
    rng = np.random.default_rng(seed)
    points = rng.integers(-6, 7, (n, width)) * rng.integers(1, 200)
    tree = vector_codes.CoverTree.of(points, leaf=4)
    assert sorted(tree.order.tolist()) == list(range(n))
    for node in tree.nodes:
        inside = points[tree.order[node["lo"] : node["hi"]]]
        away = np.sqrt(((inside - points[node["centre"]]) ** 2).sum(axis=1))
        assert away.max() <= node["radius"] + 1e-9
        below = tree.nodes[node["first"] : node["last"]]
        if len(below):
            assert below["lo"][0] == node["lo"] and below["hi"][-1] == node["hi"] and (below["lo"][1:] == below["hi"][:-1]).all()
            centres = points[below["centre"]]
            apart = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(axis=2)) + np.eye(len(centres)) * 1e9
            assert apart.min() > node["radius"] / 2
    entries = np.concatenate([points[rng.integers(0, n, 5)], rng.integers(-600, 600, (4, width))])
    brute = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (tree.nearest(entries) == brute).all()
    count, total = tree.gather(entries)
    for k in range(len(entries)):
        assert count[k] == (brute == k).sum() and (total[k] == points[brute == k].sum(axis=0)).all()


def test_whole_subtrees_are_assigned():
    """On points in clusters most are decided above the leaves."""
    rng = np.random.default_rng(1)
    entries = rng.integers(-4000, 4000, (16, 8))
    points = entries[rng.integers(0, 16, 4000)] + rng.integers(-40, 40, (4000, 8))
    tree = vector_codes.CoverTree.of(points)
    steps = sum(len(lo) for lo, _, _ in tree.stretches(entries))
    assert steps < 200
