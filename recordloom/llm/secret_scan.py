"""Secret scan: base patterns and a linear-chain conditional random field over tokens.

Three patterns find assignments, access keys and long hexadecimal runs. The field tags every token of
a line as begin, inside or outside of a secret, from its shape, the words around it and features of
the file, decoded by Viterbi. It is trained here, on lines of a bounded sample of documents labelled
by the patterns, on lines with tokens of usual kinds, and on lines with what only looks like one: addresses, links, paths, versions,
dates, numbers and identifiers. What it adds are secrets the patterns miss because no key word or other letters
stand around them. Spans of the field that the patterns cover are not added.

Defined results: a null text is empty and has no span; every text is scanned whole; without a
labelled line the field adds nothing; repeated rows get equal results; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import blocks, narrowed

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a maximal run; shorter runs would be dropped
KINDS = ("assign", "access", "hex", "field")
#: Documents whose lines train the field, at most about this many.
TRAIN_DOCUMENTS = 4_000
#: Labelled stretches of one of them, at most.
TRAIN_STRETCHES = 20
#: Generated lines with a secret; as many as twice that have none.
GENERATED = 1_500
REMEMBERED = 300_000

TOKEN = re.compile(r"[\w+/.\-]+|[^\w\s]")
OUT, BEGIN, INSIDE = 0, 1, 2

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns by start, then kind."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def spelled(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


# ---- features ----


def _shape_table() -> dict[int, str]:
    table = {}
    for code in range(128):
        c = chr(code)
        if c.isdigit():
            table[code] = "9"
        elif c.islower():
            table[code] = "h" if c <= "f" else "a"
        elif c.isupper():
            table[code] = "H" if c <= "F" else "A"
        else:
            table[code] = c
    return table


class _Shapes(dict):
    def __missing__(self, code: int) -> str:
        self[code] = "u" if chr(code).isalnum() else "?"
        return self[code]


_SHAPES = _Shapes(_shape_table())
_LENGTHS = (2, 4, 6, 8, 10, 12, 14, 16, 20, 24, 32, 40, 64)
_SHARES = (0.0, 0.1, 0.2, 0.35, 0.5, 0.8, 0.99)
_FILE_FEATURES = 12


def _bucket(value: float, bounds: tuple) -> int:
    return sum(value > b for b in bounds)


def shape_features(shape: str) -> tuple[int, ...]:
    """Numbers of the features of a token shape, in blocks of fixed size; see N_SHAPE."""
    n = len(shape)
    digits = shape.count("9")
    lower = shape.count("h") + shape.count("a")
    upper = shape.count("H") + shape.count("A")
    other = shape.count("u")
    mask = (lower > 0) + 2 * (upper > 0) + 4 * (digits > 0) + 8 * (other > 0) + 16 * (n > digits + lower + upper + other)
    kinds = shape.translate({104: "a", 72: "A"})
    changes = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False))
    length = _bucket(n, _LENGTHS)
    mixed = (digits > 0) + (upper > 0) + (lower > 0)
    return (
        length,
        14 + mask,
        46 + _bucket(digits / n, _SHARES),
        54 + min(changes, 15),
        70 + (2 if digits and n == digits + shape.count("h") else 1 if digits and n == digits + shape.count("H") else 0),
        73 + length * 3 + min(mixed, 3) - 1 if mixed else 115,
        116 + (min(int(10 * changes / n), 9)),
        126 + (1 if kinds[:4] == "AAAA" and digits else 0),
        128 + _harmless(shape, kinds),
    )


N_SHAPE = 136
_UUID = re.compile(r"[9h]{8}(-[9h]{4}){3}-[9h]{12}|[9H]{8}(-[9H]{4}){3}-[9H]{12}")
_DATE = re.compile(r"9999[-/.]99[-/.]99.*|99?[-/.]99?[-/.]9999")
_VERSION = re.compile(r"a?9+(\.9+)+([-.+]?a+9*)?")


def _harmless(shape: str, kinds: str) -> int:
    """What a token of such a shape usually is, if it is no secret: 0 nothing known."""
    if set(shape) <= {"9", ".", "-", "+", "/"}:
        return 1  # numbers, addresses, dates in digits
    if _UUID.fullmatch(shape):
        return 2
    if _DATE.fullmatch(shape):
        return 3
    if _VERSION.fullmatch(kinds):
        return 4
    parts = re.split(r"[/.\-_+]", kinds)
    # Parts of paths, hosts and compound words are words or numbers, seldom both in turns.
    if len(parts) > 1 and all(p.isalpha() or set(p) <= {"9"} or re.fullmatch("a+9{1,4}", p) for p in parts):
        return 5 if "/" in shape else 6
    return 7 if kinds.isalpha() else 0


class Tagger:
    """Weights of the field, and what it knows of tokens it has seen."""

    def __init__(self, near: list[str], weights: dict[str, np.ndarray]):
        self.near = {w: i for i, w in enumerate(near)}
        self.weights = weights
        self.reset()

    def reset(self) -> None:
        self.ids: dict[str, int] = {}
        self.pairs: dict[tuple[str, int], int] = {}
        self.shapes: list[tuple[int, ...]] = []
        self.classes: list[int] = []

    @property
    def n_classes(self) -> int:
        return len(self.near) + 8

    def edge(self) -> int:
        """Class of the place beyond a line."""
        return len(self.near) + 7

    def _class(self, token: str, shape: str) -> int:
        known = self.near.get(token.lower() if len(token) < 24 else token)
        if known is not None:
            return known
        digits = shape.count("9")
        kind = 0 if shape.isalpha() and shape.islower() else 1 if shape.isalpha() else 2 if digits == len(shape) else 3 if digits else 4
        return len(self.near) + (5 if len(shape) == 1 and not shape.isalnum() else kind)

    def number(self, token: str) -> int:
        """Number of the token's (shape, class) pair, remembered by token."""
        shape = token.translate(_SHAPES)
        pair = (shape, self._class(token, shape))
        found = self.pairs.get(pair)
        if found is None:
            found = self.pairs[pair] = len(self.shapes)
            self.shapes.append(shape_features(shape))
            self.classes.append(pair[1])
        self.ids[token] = found
        return found

    def numbers(self, tokens: list[str]) -> np.ndarray:
        if len(self.ids) > REMEMBERED:
            self.reset()
        known, number = self.ids.get, self.number
        return np.array([i if (i := known(t)) is not None else number(t) for t in tokens], dtype=np.int64)

    def features(self, numbers: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, ...]:
        """Shape features, and classes one and two tokens before and one after, within the line."""
        classes = np.array(self.classes, dtype=np.int64)[numbers]
        around = []
        for shift in (1, 2, -1):
            out = np.full(len(numbers), self.edge())
            if len(numbers) > abs(shift):
                a, b = (slice(shift, None), slice(None, -shift)) if shift > 0 else (slice(None, shift), slice(-shift, None))
                same = line[a] == line[b]
                out[a] = np.where(same, classes[b], self.edge())
            around.append(out)
        return (np.array(self.shapes, dtype=np.int64)[numbers], *around)

    def scores(self, numbers: np.ndarray, line: np.ndarray, files: np.ndarray) -> np.ndarray:
        """Score of each label at each token; ``files`` are the file features of each token's text."""
        w = self.weights
        own = w["shape"][np.array(self.shapes, dtype=np.int64)].sum(axis=1)
        _, before, before2, after = self.features(numbers, line)
        score = own[numbers] + w["before"][before] + w["before2"][before2] + w["after"][after]
        return score + w["file"][files].sum(axis=1)


def file_features(text: str) -> tuple[int, int]:
    """Density of code-like symbols, and length of lines."""
    n = max(len(text), 1)
    symbols = sum(map(text.count, "={};:\"'_<>[]"))
    lines = text.count("\n") + 1
    return _bucket(100 * symbols / n, (0.0, 0.5, 1.0, 2.0, 5.0)), 6 + _bucket(n / lines, (40, 80, 160, 320, 640))


def _steps(first: np.ndarray, length: np.ndarray):
    """Places of all lines at each step, longest lines first; yields (number of lines, their places)."""
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    alive = len(length)
    for t in range(int(length[0]) if len(length) else 0):
        while alive and length[alive - 1] <= t:
            alive -= 1
        yield alive, first[:alive] + t


def viterbi(score: np.ndarray, move: np.ndarray, start: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Best label of every token; lines are decoded side by side."""
    back = np.zeros(score.shape, dtype=np.int8)
    best = np.full(score.shape, -np.inf)
    steps = list(_steps(first, length))
    for t, (_, at) in enumerate(steps):
        if t == 0:
            best[at] = score[at] + start
        else:
            through = best[at - 1][:, :, None] + move[None]
            back[at] = through.argmax(axis=1)
            best[at] = through.max(axis=1) + score[at]
    labels = np.zeros(len(score), dtype=np.int8)
    if not len(first):
        return labels
    last = first + length - 1
    labels[last] = best[last].argmax(axis=1)
    for _, at in reversed(steps[1:]):
        labels[at - 1] = np.take_along_axis(back[at], labels[at][:, None].astype(np.int64), axis=1)[:, 0]
    return labels


# ---- training ----


def _lines(text: str) -> Iterator[tuple[int, list[str], list[int]]]:
    """Lines with a token: where the line begins, its tokens, where they begin in it."""
    at = 0
    for line in text.split("\n"):
        found = list(TOKEN.finditer(line))
        if found:
            yield at, [m[0] for m in found], [m.start() for m in found]
        at += len(line) + 1


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled stretches of lines: all around secrets, and of each text the plain one most like a secret."""
    for block in blocks(batches, "text"):
        rows: list[tuple] = []
        for doc_id, value in zip(block.column(0).to_pylist(), block.column(1), strict=True):
            text = value.as_py() or ""
            spans = [(m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
            spans += [(a, b) for a, kind, b in base_spans(text) if kind]
            files = list(file_features(text))
            plain, taken = None, 0
            for at, tokens, starts in _lines(text):
                labels, previous = [], None
                for token, start in zip(tokens, starts, strict=True):
                    a, b = at + start, at + start + len(token)
                    inside = next((s for s in spans if s[0] < b and a < s[1]), None) if spans else None
                    labels.append(OUT if inside is None else INSIDE if inside == previous else BEGIN)
                    previous = inside
                marked = [i for i, x in enumerate(labels) if x != OUT]
                if marked and taken < TRAIN_STRETCHES:
                    taken += 1
                    low, high = max(0, marked[0] - 12), marked[0] + 24
                    rows.append((doc_id, tokens[low:high], labels[low:high], files))
                elif not marked:
                    odd = max(range(len(tokens)), key=lambda i: (any(map(str.isdigit, tokens[i])), len(tokens[i]), -i))
                    rank = (any(map(str.isdigit, tokens[odd])), len(tokens[odd]))
                    if plain is None or rank > plain[0]:
                        low = max(0, odd - 12)
                        plain = (rank, (doc_id, tokens[low : odd + 12], labels[low : odd + 12], files))
            if plain is not None:
                rows.append(plain[1])
        columns = list(zip(*rows, strict=True)) if rows else [()] * 4
        kinds = [pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "tokens", "labels", "files"]
        )


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", documents: int = TRAIN_DOCUMENTS, rounds: int = 100) -> Tagger | None:
    """Train the field on about ``documents`` documents at most, chosen by a hash of the id; None without a secret."""
    texts = narrowed(docs, id_col, text_col)
    total = texts.count()
    share = min(1.0, documents / max(total, 1))
    sample = texts.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 60)) < math.ceil(share * (1 << 60)))
    found = sample.mapInArrow(_training_rows, "doc_id long, tokens array<string>, labels array<int>, files array<int>").collect()
    found = sorted(tuple(r) for r in found if r["doc_id"] is not None)
    if not any(BEGIN in r[2] for r in found):
        return None
    plain = [t for r in found if BEGIN not in r[2] for t in r[1]][:20_000]
    generated = _generated(plain, GENERATED)
    found += _augmented(found)
    near: Counter = Counter()
    for _, tokens, labels, _ in found:
        for i in (i for i, x in enumerate(labels) if x == BEGIN):
            near.update({t.lower() for t in tokens[max(0, i - 3) : i] + tokens[i + 1 : i + 2] if len(t) < 24})
    words = [w for w, n in sorted(near.items(), key=lambda x: (-x[1], x[0]))[:200] if n >= 5]
    return _trained(found + generated, words, rounds)


_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def _augmented(found: list[tuple]) -> list[tuple]:
    """Copies of the labelled stretches with plain words before the secret, and with its letters respelled.

    The patterns need a key word or one alphabet; the copies teach the field to do without.
    """
    plain = [r[1] for r in found if BEGIN not in r[2] and len(r[1]) >= 6]
    out = []
    for k, (doc_id, tokens, labels, files) in enumerate(found):
        if BEGIN not in labels:
            continue
        at = labels.index(BEGIN)
        digest = hashlib.sha512(tokens[at].encode()).digest()
        letters = "".join(_ALPHABET[x % 62] for x in digest)
        respelled = ["xk_", "", "ab-"][digest[1] % 3] + letters[: 16 + digest[0] % 29]
        words = plain[k % len(plain)] if plain else []
        for secret, before in ((respelled, tokens[:at]), (tokens[at], words[:6]), (letters[:20], words[6:12]), (respelled, words[:4])):
            out.append((doc_id, [*before, secret, *tokens[at + 1 :]], [OUT] * len(before) + labels[at:], files))
    return out


#: Characters of generated tokens.
_HEXADECIMAL, _BASE64 = "0123456789abcdef", _ALPHABET + "+/"


def _spell(rng: np.random.Generator, alphabet: str, n: int) -> str:
    return "".join(alphabet[i] for i in rng.integers(0, len(alphabet), n))


def generated_secret(rng: np.random.Generator) -> str:
    """A token of a usual kind: prefixed, signed in three parts, of one alphabet, or a password with signs."""
    n = int(rng.integers(20, 44))
    kind = int(rng.integers(0, 7))
    if kind == 0:
        return ["ghp_", "gho_", "sk-", "sk_live_", "glpat-", "xoxb-", "pat-", "npm_"][int(rng.integers(0, 8))] + _spell(rng, _ALPHABET, n)
    if kind == 1:
        return ".".join("eyJ" * (k < 2) + _spell(rng, _ALPHABET + "-_", n) for k in range(3))
    if kind == 2:
        return _spell(rng, _BASE64, 40)
    if kind == 3:
        return _spell(rng, _BASE64, n) + "=" * int(rng.integers(1, 3))
    if kind == 4:
        return _spell(rng, _ALPHABET[:26] + _ALPHABET[52:], n)
    if kind == 5:
        return _spell(rng, _ALPHABET, 8) + "!&@#%^*"[int(rng.integers(0, 7))] + _spell(rng, _ALPHABET, 9)
    return _spell(rng, _ALPHABET, n)


def generated_harmless(rng: np.random.Generator, words: list[str]) -> str:
    """What looks like a secret and is none."""
    word = lambda: (words[int(rng.integers(0, len(words)))].lower().strip("-./+_") or "page") if words else "page"
    number = lambda high: str(int(rng.integers(0, high)))
    kind = int(rng.integers(0, 11))
    if kind == 0:
        return ".".join(number(256) for _ in range(4)) + ["", ":" + number(60000)][int(rng.integers(0, 2))]
    if kind == 1:
        return f"https://{word()}.{word()}.com/{word()}/{number(3000)}/{word()}-{word()}-{word()}" + ["", ".html"][int(rng.integers(0, 2))]
    if kind == 2:
        return f"/usr/{word()}/{word()}{number(30)}/{word()}.{word()}"
    if kind == 3:
        return ["v", ""][int(rng.integers(0, 2))] + ".".join(number(40) for _ in range(3)) + ["", "-rc1", "-beta2"][int(rng.integers(0, 3))]
    if kind == 4:
        return "-".join(_spell(rng, _HEXADECIMAL, n) for n in (8, 4, 4, 4, 12))
    if kind == 5:
        return f"20{number(90)}-{int(rng.integers(10, 13))}-{int(rng.integers(10, 29))}T{int(rng.integers(10, 24))}:30:00Z"
    if kind == 6:
        return f"{word()}_{word()}_{word()}_{number(500)}"
    if kind == 7:
        return f"{word()}.{word()}{number(90)}@{word()}.org"
    if kind == 8:
        return "+" + number(100) + "-" + "-".join(str(int(rng.integers(100, 1000))) for _ in range(3))
    if kind == 9:
        return "".join(word().capitalize() for _ in range(4)) + number(10)
    return "".join(str(int(rng.integers(0, 10))) for _ in range(int(rng.integers(8, 20))))


def generated_line(rng: np.random.Generator, words: list[str], secret: bool) -> tuple[str, tuple[int, int] | None]:
    """A line of plain words around a secret, or around something harmless; and where the secret stands."""
    pick = lambda n: [words[int(i)] for i in rng.integers(0, len(words), n)] if words else ["word"] * n
    before, after = " ".join(pick(int(rng.integers(0, 7)))), " ".join(pick(int(rng.integers(0, 5))))
    token = generated_secret(rng) if secret else generated_harmless(rng, words)
    head = f"{before} " if before else ""
    return f"{head}{token} {after}".rstrip(), (len(head), len(head) + len(token)) if secret else None


def _generated(plain: list[str], n: int) -> list[tuple]:
    """Labelled stretches of ``n`` generated lines with a secret and twice as many without."""
    rng, out = np.random.default_rng(11), []
    words = [w for w in plain if w.isalpha()] or plain
    for k in range(3 * n):
        line, span = generated_line(rng, words, k % 3 == 0)
        labels, begun = [], False
        found = list(TOKEN.finditer(line))
        for m in found:
            inside = span is not None and m.start() < span[1] and span[0] < m.end()
            labels.append(OUT if not inside else INSIDE if begun else BEGIN)
            begun |= inside
        out.append((-1 - k, [m[0] for m in found], labels, list(file_features(line))))
    return out


def _trained(found: list[tuple], words: list[str], rounds: int, penalty: float = 3e-4) -> Tagger:
    """Maximise the conditional likelihood with Adam; expectations by forward and backward passes over all lines."""
    sizes = {"shape": N_SHAPE, "before": len(words) + 8, "before2": len(words) + 8, "after": len(words) + 8, "file": _FILE_FEATURES}
    weights = {k: np.zeros((n, 3)) for k, n in sizes.items()} | {"move": np.zeros((3, 3)), "start": np.zeros(3)}
    tagger = Tagger(words, weights)
    tokens = [t for _, ts, _, _ in found for t in ts]
    gold = np.array([x for _, _, ls, _ in found for x in ls], dtype=np.int64)
    length = np.array([len(ts) for _, ts, _, _ in found])
    first = np.cumsum(length) - length
    line = np.repeat(np.arange(len(found)), length)
    numbers = tagger.numbers(tokens)
    files = np.array([f for *_, f in found], dtype=np.int64)[line]
    shape, before, before2, after = tagger.features(numbers, line)
    parts = {"shape": shape, "before": before[:, None], "before2": before2[:, None], "after": after[:, None], "file": files}
    hot = np.eye(3)[gold]
    steps = list(_steps(first, length))
    inner = np.ones(len(gold), dtype=bool)
    inner[first] = False
    at = np.flatnonzero(inner)
    seen_moves = np.zeros((3, 3))
    np.add.at(seen_moves, (gold[at - 1], gold[at]), 1)
    state = {k: [np.zeros_like(w), np.zeros_like(w)] for k, w in weights.items()}
    for step in range(1, rounds + 1):
        score = tagger.scores(numbers, line, files)
        marginal, moves = _expectations(score, weights["move"], weights["start"], steps, first, length)
        wrong = hot - marginal
        grads = {}
        for k, index in parts.items():
            g = np.zeros_like(weights[k])
            for c in range(3):
                g[:, c] = np.bincount(index.ravel(), np.repeat(wrong[:, c], index.shape[1]), minlength=len(g))
            grads[k] = g
        grads["move"] = seen_moves - moves
        grads["start"] = wrong[first].sum(axis=0)
        for k, g in grads.items():
            g = g / len(gold) - penalty * weights[k]
            m, v = state[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            weights[k] += 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    weights["move"][OUT, INSIDE] = weights["start"][INSIDE] = -1e4  # a secret begins with its begin
    return tagger


def _expectations(score, move, start, steps, first, length):
    """Label probabilities of every token and expected moves, lines side by side."""
    forward, scale = np.zeros_like(score), np.zeros(len(score))
    local = np.exp(score - score.max(axis=1, keepdims=True))
    step_move = np.exp(move)
    for t, (_, at) in enumerate(steps):
        value = local[at] * (np.exp(start) if t == 0 else forward[at - 1] @ step_move)
        scale[at] = value.sum(axis=1)
        forward[at] = value / scale[at][:, None]
    backward = np.zeros_like(score)
    backward[first + length - 1] = 1.0
    moves = np.zeros((3, 3))
    for _, at in reversed(steps[1:]):
        ahead = local[at] * backward[at] / scale[at][:, None]
        moves += step_move * (forward[at - 1].T @ ahead)
        backward[at - 1] = ahead @ step_move.T
    return forward * backward, moves


# ---- scanning ----


def field_spans(tagger: Tagger, texts: list[str]) -> list[list[tuple[int, int]]]:
    """Secrets the field finds in each text, as (start, end)."""
    lines, owner, tokens, length = [], [], [], []
    for i, text in enumerate(texts):
        at = 0
        for line in text.split("\n"):
            found = TOKEN.findall(line)
            if found:
                lines.append((at, line))
                owner.append(i)
                tokens += found
                length.append(len(found))
            at += len(line) + 1
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    if not tokens:
        return spans
    numbers = tagger.numbers(tokens)
    lengths = np.array(length)
    first = np.cumsum(lengths) - lengths
    line_of = np.repeat(np.arange(len(lines)), lengths)
    files = np.array([file_features(t) for t in texts], dtype=np.int64)[np.array(owner)][line_of]
    move, start = tagger.weights["move"], tagger.weights["start"]
    score = tagger.scores(numbers, line_of, files)
    # A path gains at most so much by moves into and out of a secret; a line whose every token prefers
    # outside by more is outside as a whole, and needs no decoding.
    gain = 2 * max(0.0, move.max() - move[OUT, OUT]) + max(0.0, start.max() - start[OUT])
    least = np.minimum.reduceat(score[:, OUT] - score[:, 1:].max(axis=1), first)
    doubtful = np.flatnonzero(least <= gain)
    labels = viterbi(score, move, start, first[doubtful], lengths[doubtful])
    for k in np.unique(line_of[labels == BEGIN]).tolist():
        at, line = lines[k]
        mine = labels[first[k] : first[k] + lengths[k]]
        for m, label in zip(TOKEN.finditer(line), mine.tolist(), strict=True):
            if label == BEGIN:
                spans[owner[k]].append((at + m.start(), at + m.end()))
            elif label == INSIDE:
                spans[owner[k]][-1] = (spans[owner[k]][-1][0], at + m.end())
    return spans


def all_spans(base: list[Span], found: list[tuple[int, int]]) -> list[Span]:
    """Base spans, and those of the field that base spans do not cover fully."""
    return sorted(base + [(a, 3, b) for a, b in found if not _covered(sorted(base), a, b)])


def _covered(base: list[Span], start: int, end: int) -> bool:
    for s, _, e in base:
        if s <= start < e:
            start = e
    return start >= end


def redacted(text: str, spans: list[Span], mark: str = "[SECRET]") -> str:
    """The text with every stretch of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def _scan(tagger: Tagger | None, with_text: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            texts = [t or "" for t in block.column(1).to_pylist()]
            found = field_spans(tagger, texts) if tagger else [[] for _ in texts]
            bases = [base_spans(t) for t in texts]
            spans = [all_spans(b, f) for b, f in zip(bases, found, strict=True)]
            arrays = [block.column(0)]
            for kind in range(3):
                arrays.append(pa.array([sum(k == kind for _, k, _ in b) for b in bases], pa.int64()))
            arrays.append(pa.array([hashlib.sha256(spelled(b).encode()).hexdigest() for b in bases]))
            arrays.append(pa.array([spelled(s) for s in spans]))
            names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
            if with_text:
                arrays.append(pa.array([redacted(t, s) for t, s in zip(texts, spans, strict=True)]))
                names.append("clean_text")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return rows


_SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True, **training) -> DataFrame:
    """One row per row of ``docs``: counts and digest of the base spans, all spans[, the text without them]. No shuffle."""
    tagger = fit(docs, id_col, text_col, **training)
    if tagger is not None:
        tagger.reset()
    schema = _SCHEMA + (", clean_text string" if with_text else "")
    return narrowed(docs, id_col, text_col).mapInArrow(_scan(tagger, with_text), schema)


def redact_column(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", **training) -> DataFrame:
    """``docs`` with secrets redacted in ``text_col``; all columns, no shuffle."""
    tagger = fit(docs, id_col, text_col, **training)
    if tagger is not None:
        tagger.reset()

    typed = docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    return typed.mapInArrow(_redact(tagger, text_col), typed.schema)


def _redact(tagger: Tagger | None, text_col: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text_col):
            at = block.schema.get_field_index(text_col)
            values = block.column(at).to_pylist()
            texts = [v or "" for v in values]
            found = field_spans(tagger, texts) if tagger else [[] for _ in texts]
            clean = [redacted(t, all_spans(base_spans(t), f)) for t, f in zip(texts, found, strict=True)]
            clean = pa.array([None if v is None else c for v, c in zip(values, clean, strict=True)], block.column(at).type)
            yield block.set_column(at, block.schema.field(at), clean)

    return rows
