import hashlib
import random
import re
from collections import Counter

import numpy as np
import plain
import pyarrow as pa
import pytest
from recordloom.llm import components, exact_dedup, fuzzy_lines, near_dup, substring_dedup


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_directory_doubles_and_keeps_key_ranges():
    rng = random.Random(3)
    keys = [rng.getrandbits(10) for _ in range(5_000)] + [700] * 3_000
    directory = exact_dedup.build_directory(dict(Counter(keys)), 10, 200)
    held = Counter(directory.slots[k >> (10 - directory.depth)] for k in keys)
    hot = directory.slots[700 >> (10 - directory.depth)]
    assert all(n <= 200 for b, n in held.items() if b != hot)
    assert len(directory.slots) == 1 << directory.depth == 1 << max(directory.local)
    for bucket, depth in enumerate(directory.local):
        mine = [i for i, b in enumerate(directory.slots) if b == bucket]
        assert mine == list(range(mine[0], mine[0] + (1 << directory.depth - depth)))


def test_exact_copies(spark, hard, empty):
    rows = [r.asDict() for r in exact_dedup.exact_duplicates(hard, capacity=2).collect()]
    assert len(rows) == len(plain.HARD)
    normal = {}
    for i, t in plain.HARD:
        normal.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    want = Counter()
    for body, ids in normal.items():
        keep = min((i for i in ids if i is not None), default=None)
        want.update((i, keep, len(ids), i == keep, hashlib.sha256(body.encode()).hexdigest()) for i in ids)
    assert Counter(tuple(r.values()) for r in rows) == want
    kept = exact_dedup.drop_exact_duplicates(hard)
    assert kept.columns == hard.columns and kept.count() == len(normal)
    assert exact_dedup.exact_duplicates(empty).collect() == []


def test_components_of_paths_and_stars(spark):
    path = [(k, k + 1) for k in range(0, 60)]
    star = [(100, k) for k in range(101, 160)] + [(150, 90)]
    edges = spark.createDataFrame(path + star + [(7, 7)], "a long, b long")
    got = {r.id: r.component for r in components.connected(edges).collect()}
    want = plain.roots(sorted({x for e in path + star for x in e}), path + star)
    assert got == {k: v for k, v in want.items() if k != v}


def test_components_of_edges_that_no_task_holds_at_once(spark, monkeypatch):
    rng = random.Random(5)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(k, 1000) for k in range(500, 560)] * 2
    edges = spark.createDataFrame([*pairs, (None, 3)], "a long, b long").repartition(5)
    want = {k: v for k, v in plain.roots(sorted({x for e in pairs for x in e}), pairs).items() if k != v}
    for most in (0, 50):
        monkeypatch.setattr(components, "TASK_EDGES", most)
        got = components.connected(edges)
        assert got.count() == len(want) and {r.id: r.component for r in got.collect()} == want


def test_trees_of_a_share_that_comes_in_many_batches(monkeypatch):
    rng = random.Random(6)
    pairs = [(k, k + 1 + rng.randrange(30)) for k in range(300)] * 2
    batches = [pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*pairs[k : k + 40])], names=["a", "b"]) for k in range(0, 600, 40)]
    nodes = sorted({x for e in pairs for x in e})
    for most in (50, 1 << 20):
        monkeypatch.setattr(components, "TASK_EDGES", most)
        trees = [(r["a"], r["b"]) for x in components._tree_rows(iter(batches)) for r in x.to_pylist()]
        assert plain.roots(nodes, trees) == plain.roots(nodes, pairs)
    assert len({b for _, b in trees}) == len(trees) < len(pairs)


def test_components_of_a_small_table_take_few_jobs(spark):
    """Every job leaves threads, plans and generated classes with the driver, whatever its size."""
    edges = spark.createDataFrame([(k, 7 * k % 501) for k in range(501)], "a long, b long").repartition(4)
    spark.sparkContext.setJobGroup("components", "components of a small table")
    try:
        components.connected(edges).count()
    finally:
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("components")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 10


def test_near_duplicates(small, hard, empty):
    docs, pairs = small
    sets, links = plain.near_links(pairs)
    want = plain.roots(list(sets), links)
    got = by_id(near_dup.near_duplicates(docs))
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(s), want[i], want[i] == i) for i, s in sets.items()
    }
    rows = near_dup.near_duplicates(hard).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in plain.HARD)
    got = {r.doc_id: r for r in rows}
    assert all(got[i].kept and not got[i].n_shingles for i in (1, 2, 3))
    assert got[6].component_id == got[5].component_id == 4 and got[8].component_id == 7
    assert near_dup.near_duplicates(empty).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_that_do_not_all_resemble_each_other(spark, seed):
    """Chains of edits: components are wider than the similarity to any one member."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10_000)}" for _ in range(120)]
    docs = []
    for k in range(150):
        got = list(base)
        for _ in range(rng.randrange(0, 5)):
            got[rng.randrange(len(got))] = f"x{rng.randrange(10_000)}"
        docs.append((k, " ".join(got)))
        if k % 30 == 29:
            base = got
    sets, links = plain.near_links(docs)
    want = plain.roots(list(sets), links)
    got = by_id(near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")))
    assert {i: r.component_id for i, r in got.items()} == want


def test_estimate_is_corrected_for_collisions():
    rng = np.random.default_rng(5)
    both, mine, other = (np.sort(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (600, 200, 200))
    a, b = (near_dup.registers(np.unique(np.concatenate([both, x]))) for x in (mine, other))
    guess, deviation = near_dup.estimate(a[None], b[None], np.array([800]), np.array([800]))
    assert abs(guess[0] - 0.6) < 4 * deviation[0]


def test_repeated_passages(small, hard, empty):
    docs, pairs = small
    for heavy in (200, 2):
        got = by_id(substring_dedup.remove_repeats(docs, heavy=heavy))
        for i, (n, kept) in plain.removed_words(pairs).items():
            text = " ".join(kept)
            assert (got[i].n_words, got[i].n_removed, got[i].kept_text) == (n, n - len(kept), text)
            assert got[i].kept_sha256 == hashlib.sha256(text.encode()).hexdigest()
    rows = substring_dedup.remove_repeats(hard, with_text=False).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in plain.HARD)
    got = {r.doc_id: r for r in rows}
    want = plain.removed_words([(i, t) for i, t in plain.HARD if i is not None])
    assert {i: r.n_removed for i, r in got.items() if i is not None} == {i: n - len(k) for i, (n, k) in want.items()}
    assert got[None].n_removed == 0 and got[8].n_removed == 40_000 and got[10].n_removed == 59
    assert substring_dedup.remove_repeats(empty).collect() == []


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(14))) for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        most = rng.randrange(14)
        assert fuzzy_lines.edit_distance(a, b, most) == min(row[-1], most + 1)


def test_repeated_lines(spark, hard, empty):
    long = " ".join(f"word{k}" for k in range(80))
    docs = spark.createDataFrame(
        [
            (1, f"First line of all.\n{long}\n-----"),
            (2, f"FIRST line, of all!\nsomething of its own here\n-----\n{long} indeed"),
            (3, "first line of all"),
            (4, None),
        ],
        "doc_id long, text string",
    )
    got = by_id(fuzzy_lines.line_decisions(docs))
    assert {i: (r.n_lines, r.removed) for i, r in got.items()} == {1: (2, ""), 2: (3, "0,3"), 3: (1, "0"), 4: (0, "")}
    clean = {r.doc_id: r.clean_text for r in fuzzy_lines.remove_repeated_lines(docs).collect()}
    assert clean[2] == "something of its own here\n-----" and clean[3] == ""
    rows = fuzzy_lines.line_decisions(hard).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in plain.HARD)
    removed = {r.doc_id: r.n_removed for r in rows}
    assert removed[6] == 1 and removed[4] == removed[None] == 0 and removed[8] == 1
    assert fuzzy_lines.line_decisions(empty).collect() == []


def test_no_line_goes_that_a_plain_comparison_keeps(small):
    """Equal normal forms always meet; fuzzy pairs are confirmed, so nothing else is removed."""
    docs, pairs = small
    table = {c: chr(fuzzy_lines._NORMAL[c]) for c in range(128)}
    lines = []
    for i, t in sorted(pairs):
        for k, line in enumerate((t or "").split("\n")):
            form = " ".join(w for w in re.split("[ \n]+", line.translate(table)) if w)
            if form:
                lines.append((i, k, form))
    forms = sorted({f for *_, f in lines})
    links = [(a, b) for n, a in enumerate(forms) for b in forms[n + 1 :] if fuzzy_lines.similar(a, b)]
    group = plain.roots(forms, links)
    first, equal = {}, {}
    for i, k, f in lines:
        first.setdefault(group[f], (i, k))
        equal.setdefault(f, (i, k))
    most = {(i, k) for i, k, f in lines if first[group[f]] != (i, k)}
    least = {(i, k) for i, k, f in lines if equal[f] != (i, k)}
    got = {(r.doc_id, int(k)) for r in fuzzy_lines.line_decisions(docs).collect() for k in r.removed.split(",") if k}
    assert least <= got <= most


def _lines(n, length, rng):
    """Lines of about ``length`` letters of words of three to eight."""
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9)))
    pool = [word() for _ in range(3_000)]
    out = []
    for _ in range(n):
        words = []
        while sum(map(len, words)) + len(words) < length:
            words.append(rng.choice(pool))
        out.append(" ".join(words))
    return out


def _scattered(line, share, rng):
    """``line`` with that share of its letters replaced, at places drawn one by one."""
    letters = list(line)
    for k in rng.sample([i for i, c in enumerate(letters) if c != " "], max(1, int(share * len(letters)))):
        letters[k] = rng.choice([c for c in "abcdefghijklmnopqrstuvwxyz" if c != letters[k]])
    return "".join(letters)


def test_recall_of_scattered_changes(spark):
    """From 300 letters on, lines of an edit similarity of 0.995 meet in nine of ten cases or more; nothing else is removed."""
    rng = random.Random(3)
    lines = _lines(250, 310, rng) + _lines(150, 420, rng)
    forms = [x for line in lines for x in (line, _scattered(line, 0.005, rng))]
    brute = {(a, b) for a, x in enumerate(forms) for b, y in enumerate(forms) if a < b and fuzzy_lines.similar(x, y)}
    assert brute == {(k, k + 1) for k in range(0, 800, 2)}
    docs = spark.createDataFrame(list(enumerate(forms)), "doc_id long, text string")
    gone = {r.doc_id for r in fuzzy_lines.line_decisions(docs).collect() if r.n_removed}
    assert gone <= {b for _, b in brute} and len(gone) >= 0.9 * len(brute)


def _simhashes(texts):
    import pyarrow as pa

    lines = fuzzy_lines.Lines(pa.array(texts))
    owner, words = lines.simhashes(np.ones(len(lines.some), dtype=bool))
    return {int(lines.hash[k]): words[i] for i, k in enumerate(owner)}


def test_simhash_is_the_majority_of_its_windows_wherever_a_line_stands():
    rng = random.Random(4)
    lines = _lines(40, 90, rng) + _lines(2, 150_000, rng) + ["ab", "x"]
    alone = {h: w for line in lines for h, w in _simhashes([line]).items()}
    among = _simhashes(["\n".join(lines), "something else\nentirely", *lines[:3]])
    assert set(alone) <= set(among) and all((alone[h] == among[h]).all() for h in alone)
    for line in lines[:5]:
        (word,) = _simhashes([line]).values()
        form, votes = f" {line}".encode(), []
        for k in range(len(form) - 3):
            window = int.from_bytes(form[k : k + 4], "big")
            if window * 0x9E3779B1 % (1 << 32) < 1 << 30:
                value = fuzzy_lines.mix(np.array([window + 0x632BE5AB], dtype=np.uint64))
                votes.append(np.unpackbits(fuzzy_lines.mix(value + fuzzy_lines._SEEDS).view(np.uint8)))
        assert (np.packbits(2 * np.sum(votes, axis=0) > len(votes)).view(np.uint64) == word).all()


def test_every_window_of_a_line_counts():
    """Windows that an own hash would leave out change the SimHash as well, and a line of them alone has one."""
    import pyarrow as pa

    left_out = [f"{a}{b}{c}" for a in "abcdefgh" for b in "ijklmnop" for c in "qrstuvwx"]
    left_out = [w for w in left_out if int.from_bytes(f" {w}".encode(), "big") * 0x9E3779B1 % (1 << 32) >= 1 << 30][:40]
    lines = fuzzy_lines.Lines(pa.array(left_out))
    owner, words = lines.simhashes(np.ones(len(left_out), dtype=bool), every=True)
    assert owner.tolist() == list(range(40)) and len({w.tobytes() for w in words}) == 40
    (row,) = fuzzy_lines._line_rows(iter([pa.RecordBatch.from_arrays([pa.array(range(40), pa.int64()), pa.array(left_out)], names=["doc_id", "text"])]))
    assert row.column("w0").null_count == 0
    (line,) = _lines(1, 90, random.Random(8))
    form, votes = f" {line}".encode(), []
    for k in range(len(form) - 3):
        value = fuzzy_lines.mix(np.array([int.from_bytes(form[k : k + 4], "big") + 0x632BE5AB], dtype=np.uint64))
        votes.append(np.unpackbits(fuzzy_lines.mix(value + fuzzy_lines._SEEDS).view(np.uint8)))
    _, (word,) = fuzzy_lines.Lines(pa.array([line])).simhashes(np.ones(1, dtype=bool), every=True)
    assert (np.packbits(2 * np.sum(votes, axis=0) > len(votes)).view(np.uint64) == word).all()


def test_forms_within_the_radius_always_meet(spark):
    """Fewer than BLOCKS differing bits leave a block without one."""
    rng = random.Random(6)
    lines = _lines(60, 900, rng)
    forms = [x for line in lines for x in (line, _scattered(line, 0.001, rng))]
    near = []
    for k in range(0, len(forms), 2):
        (a,), (b,) = (_simhashes([x]).values() for x in forms[k : k + 2])
        if int(np.unpackbits((a ^ b).view(np.uint8)).sum()) < fuzzy_lines.BLOCKS:
            near.append(k + 1)
    docs = spark.createDataFrame(list(enumerate(forms)), "doc_id long, text string")
    gone = {r.doc_id for r in fuzzy_lines.line_decisions(docs).collect() if r.n_removed}
    assert len(near) > 20 and set(near) <= gone


def _shuffle_bytes(spark):
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(k).length() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_"))


def test_tables_of_line_dedup_leave_no_shuffle_files(spark, monkeypatch):
    rng = random.Random(7)
    docs = spark.createDataFrame([(k, "\n".join(_lines(20, 60, rng))) for k in range(100)], "doc_id long, text string")
    known, then, left = _shuffle_bytes(spark), fuzzy_lines._within_radius, []

    def spy(pairs, sketches):  # called as soon as the buckets are written
        left.append(_shuffle_bytes(spark) - known)
        return then(pairs, sketches)

    monkeypatch.setattr(fuzzy_lines, "_within_radius", spy)
    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    lines, _ = fuzzy_lines.repeated_lines(docs)
    assert lines.count() == 2_000
    assert left[0] < 100_000  # the 16 keys of each form alone take half a megabyte
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting


def test_partners_by_arrays_are_those_of_a_plain_comparison():
    import pyarrow as pa

    rng = np.random.default_rng(9)
    rows, want = [], set()
    for cell in range(40):
        block = cell % fuzzy_lines.BLOCKS
        cluster = (block << 32) + cell
        base = rng.integers(0, 1 << 63, 8).astype(np.uint64)
        members = []
        for k in range(int(rng.integers(2, 9))):
            word = base.copy()
            if k % 3:  # the first bits of other blocks differ
                word[rng.integers(0, 8)] ^= np.uint64(1 << 40)
                word[rng.integers(0, 8)] ^= np.uint64(3)
            else:
                word ^= rng.integers(0, 1 << 63, 8).astype(np.uint64) * np.uint64(k > 0)
            members.append((k + 10 * cell, int(rng.integers(0, 4)), word))
        outside = [m for m in members if m[1]]
        rows += [(cluster, 0, 0, 0, *m) for m in outside] + [(cluster, 0, 0, 1, *m) for m in members]
        for x in outside:
            for y in members:
                halves = [int(v) for w in x[2] ^ y[2] for v in (w >> np.uint64(32), w & np.uint64((1 << 32) - 1))]
                if x[1] != y[1] and sum(v.bit_count() for v in halves) <= fuzzy_lines.RADIUS and all(halves[:block]):
                    want |= {(cluster, x[0]), (cluster, y[0])}
    names = ["cluster", "row", "col", "side", "id", "component", *fuzzy_lines._COLUMNS]
    columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(6)]
    columns += [pa.array(np.array([r[6][k] for r in rows]).view(np.int64)) for k in range(8)]
    batch = pa.RecordBatch.from_arrays(columns, names=names)
    for step in (1, 7, len(rows)):
        parts = fuzzy_lines._partner_rows(iter([batch.slice(k, step) for k in range(0, len(rows), step)]))
        got = [tuple(r.values()) for part in parts for r in part.to_pylist()]
        assert set(got) == want and want


def test_stages_keep_columns_of_any_name_and_texts_under_a_repeated_id(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(3, text), (7, text + " more"), (7, "another text that nothing else in this table resembles at all"), (9, text), (None, text), (9, text)]
    docs = spark.createDataFrame([(i, t, "a", k, "d", "r") for k, (i, t) in enumerate(rows)], "doc_id long, text string, _sha string, _id int, digest string, row string")
    kept = near_dup.drop_near_duplicates(docs).orderBy("_id").collect()
    assert [tuple(r) for r in kept] == [(*rows[k], "a", k, "d", "r") for k in (0, 2, 4)]
    exact = exact_dedup.drop_exact_duplicates(docs).orderBy("_id").collect()
    assert [tuple(r) for r in exact] == [(*rows[k], "a", k, "d", "r") for k in (0, 1, 2)]
    tied = docs.filter("doc_id = 9").withColumn("row", docs._id.cast("string"))
    assert exact_dedup.drop_exact_duplicates(tied).first().row == "3"
