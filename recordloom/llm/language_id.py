"""Language identification by word-first backoff.

A model holds per language the log frequency of words and of character n-grams. Words the model knows
are scored by their log frequencies. Any other word, between blanks, backs off to its longest
n-grams, from five characters down to one, and takes the mean score of those the model knows, of the first length
that has any. A language that lacks a known word or n-gram gets a penalty. The text's score is the
mean over its words.

The model is fitted on a bounded sample of labelled documents: about ``per_language`` documents of
each language, chosen by a hash of the id, and of each language its ``entries`` most frequent words and n-grams, so that a
rare language keeps as many as a frequent one. It is held as sorted 64-bit hashes with the languages and scores of each.
Predictions read the whole text and nothing else.

Defined results: ``und`` with score 0 for a null text, a text without a letter, or a table without a
label to learn from; ties go to the language with more documents, then by name; repeated rows get
equal results; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm.common import blocks, narrowed

UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
LONGEST_GRAM = 5
#: Documents of each language that the model learns from, and entries it keeps of each.
PER_LANGUAGE, ENTRIES = 3_000, 150_000
#: Added to the largest score of the model where a language lacks an entry, in natural logarithms.
PENALTY = 2.0
REMEMBERED = 60_000
#: Absolute fit: quantile of the share of known words, words of a document that counts for it, and chance of a wrong rejection.
LOW = 0.01
EVIDENCE = 20
CHANCE = 0.001
#: A document whose best language is less likely than this among the learned ones is rejected.
LEAST_SCORE = 0.4


def grams(word: str, n: int) -> list[str]:
    held = f" {word} "
    return [held[i : i + n] for i in range(len(held) - n + 1)] if n > 1 else list(word)


def entry_key(size: int, entry: str) -> int:
    """Hash of an entry; size 0 is a whole word. (A size as seed would not do: short inputs of other seeds collide.)"""
    return xxhash.xxh3_64_intdigest(f"{size}{entry}".encode("utf-8", "surrogatepass"))


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, size, key, n) of a stretch of labelled texts."""
    counts: Counter = Counter()

    def flush():
        columns = list(zip(*((lang, size, entry_key(size, entry), n) for (lang, size, entry), n in counts.items()), strict=True)) if counts else [()] * 4
        out = [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(np.array(columns[2], dtype=np.uint64).view(np.int64)), pa.array(columns[3], pa.int64())]
        counts.clear()
        return pa.RecordBatch.from_arrays(out, names=["lang", "size", "key", "n"])

    for block in blocks(batches, "text"):
        words: Counter = Counter()
        for lang, value in zip(block.column(0).to_pylist(), block.column(1), strict=True):
            words.update((lang, w) for w in WORD.findall((value.as_py() or "").lower()))
        for (lang, word), n in words.items():
            counts[lang, 0, word] += n
            for size in range(1, LONGEST_GRAM + 1):
                for g in grams(word, size):
                    counts[lang, size, g] += n
        if len(counts) > 300_000:
            yield flush()
    yield flush()


class Model:
    """Scores per entry and language: those of ``keys[i]`` stand from ``start[i]`` to ``start[i + 1]`` in ``lang`` and ``score``."""

    def __init__(self, languages: list[str], rows: Sequence[tuple[str, int, str, int]] = ()):
        """From (language, size, entry, count)."""
        at = {lang: i for i, lang in enumerate(languages)}
        columns = list(zip(*((at[lang], size, entry_key(size, entry), n) for lang, size, entry, n in rows), strict=True)) or [()] * 4
        self._fill(languages, *(np.array(c, dtype=t) for c, t in zip(columns, (np.int64, np.int64, np.uint64, np.int64), strict=True)))

    @classmethod
    def of(cls, languages: list[str], lang: np.ndarray, size: np.ndarray, key: np.ndarray, n: np.ndarray) -> Model:
        model = cls.__new__(cls)
        model._fill(languages, lang, size, key, n)
        return model

    def _fill(self, languages: list[str], lang: np.ndarray, size: np.ndarray, key: np.ndarray, n: np.ndarray) -> None:
        self.languages = languages
        totals = np.zeros((LONGEST_GRAM + 1, max(len(languages), 1)))
        np.add.at(totals, (size, lang), n)
        order = np.lexsort((lang, key))
        lang, size, key, n = lang[order], size[order], key[order], n[order]
        score = np.log(n / np.maximum(totals[size, lang], 1))
        self.floor = float(score.min() - PENALTY) if len(score) else -math.log(2)
        self.keys, self.start = np.unique(key, return_index=True)
        self.start = np.append(self.start, len(key))
        self.lang, self.score = lang.astype(np.uint16), score.astype(np.float32)

    def find(self, hashes: list[int]) -> np.ndarray:
        """Place of each hash among the keys, -1 where the model does not know it."""
        wanted = np.array(hashes, dtype=np.uint64)
        if not len(self.keys):
            return np.full(len(wanted), -1)
        place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[place] == wanted, place, -1)

    def rows(self, places: np.ndarray) -> np.ndarray:
        """Score of each place in every language."""
        size = self.start[places + 1] - self.start[places]
        row = np.repeat(np.arange(len(places)), size)
        at = np.repeat(self.start[places], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        out = np.full((len(places), len(self.languages)), self.floor, dtype=np.float32)
        out[row, self.lang[at]] = self.score[at]
        return out

    def score_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per word its scores in all languages, and in which of them it is known as a word."""
        scores = np.full((len(words), len(self.languages)), self.floor, dtype=np.float32)
        whole = np.zeros(scores.shape, dtype=bool)
        found = self.find([entry_key(0, w) for w in words])
        known = np.flatnonzero(found >= 0)
        scores[known] = self.rows(found[known])
        whole[known] = scores[known] > self.floor
        rest = np.flatnonzero(found < 0)
        for size in range(LONGEST_GRAM, 0, -1):
            if not len(rest):
                break
            parts = [grams(words[i], size) for i in rest]
            owner = np.repeat(np.arange(len(rest)), [len(p) for p in parts])
            place = self.find([entry_key(size, g) for p in parts for g in p])
            owner, place = owner[place >= 0], place[place >= 0]
            n = np.bincount(owner, minlength=len(rest))
            sums = np.zeros((len(rest), len(self.languages)))
            np.add.at(sums, owner, self.rows(place))
            some = n > 0
            scores[rest[some]] = sums[some] / n[some, None]
            rest = rest[~some]
        return scores, whole


class Predictor:
    """Predicts texts with a model; remembers the scores of words."""

    def __init__(self, model: Model):
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.places: dict[str, int] = {}
        self.rows = np.zeros((1024, len(self.model.languages)), dtype=np.float32)
        self.whole = np.zeros(self.rows.shape, dtype=bool)

    def _learn(self, words: list[str]) -> None:
        new = [w for w in dict.fromkeys(words) if w not in self.places]
        if not new:
            return
        need = len(self.places) + len(new)
        if need > len(self.rows):
            grown = np.zeros((max(need, 2 * len(self.rows)), self.rows.shape[1]), dtype=np.float32)
            grown[: len(self.rows)] = self.rows
            whole = np.zeros(grown.shape, dtype=bool)
            whole[: len(self.whole)] = self.whole
            self.rows, self.whole = grown, whole
        at = slice(len(self.places), need)
        self.rows[at], self.whole[at] = self.model.score_words(new)
        self.places.update(zip(new, range(at.start, need), strict=True))

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.look([text])[0][:2]

    def look(self, texts: list[str | None]) -> list[tuple[str, float, int, int]]:
        """Per text: language, score, number of words, and of those the model knows as words of that language."""
        split = [WORD.findall(t.lower()) if t else [] for t in texts]
        if self.model.languages:
            if len(self.places) > REMEMBERED:
                self.reset()
            self._learn([w for words in split for w in words])
        return [self._judge(words) for words in split]

    def _judge(self, words: list[str]) -> tuple[str, float, int, int]:
        if not self.model.languages or not any(c.isalpha() for w in words for c in w):
            return UNKNOWN, 0.0, len(words), 0
        at = np.fromiter(map(self.places.__getitem__, words), dtype=np.int64, count=len(words))
        score = self.rows[at].mean(axis=0, dtype=np.float64)
        best = int(score.argmax())  # the first of equals
        odds = np.exp(np.clip((score - score[best]) * min(len(words), 20), -60, 0))
        return self.model.languages[best], float(1 / odds.sum()), len(words), int(self.whole[at, best].sum())


#: Steps of the draw that chooses documents; a share of a table of any size is a number of them.
_DRAW = 1 << 60


def _about(lang: Column, sizes: dict[str, int], per_language: int, key: str) -> Column:
    """Documents chosen by a hash: about ``per_language`` of each language."""
    chosen, draw = F.lit(False), F.pmod(F.xxhash64(F.col(key)), F.lit(_DRAW))
    for name, n in sizes.items():
        chosen = chosen | ((lang == name) & (draw < math.ceil(_DRAW * min(1.0, per_language / n))))
    return chosen


def fit(labelled: DataFrame, lang_col: str, id_col: str, text_col: str, per_language: int = PER_LANGUAGE, entries: int = ENTRIES) -> Model:
    """Fit on rows with a label: about ``per_language`` documents and at most ``entries`` entries of each language."""
    texts = labelled.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text")
    ).filter("lang IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in texts.groupBy("lang").count().collect()}
    languages = sorted(sizes, key=lambda x: (-sizes[x], x))
    if not languages:
        return Model([])
    chosen = texts.filter(_about(F.col("lang"), sizes, per_language, "doc_id"))
    counts = chosen.select("lang", "text").mapInArrow(_count_rows, "lang string, size int, key long, n long")
    totals = counts.groupBy("lang", "size", "key").agg(F.sum("n").alias("n")).filter("n > 1 OR size = 0")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "size", "key"))
    top = totals.withColumn("rank", rank).filter(F.col("rank") <= entries).select("lang", "size", "key", "n").toArrow()
    at = {lang: i for i, lang in enumerate(languages)}
    lang = np.array([at[x] for x in top.column("lang").to_pylist()], dtype=np.int64)
    size, key, n = (top.column(c).to_numpy().astype(np.int64) for c in ("size", "key", "n"))
    return Model.of(languages, lang, size, key.view(np.uint64), n)


def _predict_rows(model: Model):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(model)
        for block in blocks(batches, "text"):
            found = predictor.look(block.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return rows


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) per row of ``docs``. No shuffle."""
    return narrowed(docs, id_col, text_col).mapInArrow(_predict_rows(model), "doc_id long, lang_pred string, score double")


def _share_rows(model: Model):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(model)
        for block in blocks(batches, "text"):
            found = zip(block.column(0).to_pylist(), predictor.look(block.column(1).to_pylist()), strict=True)
            good = [(lang, known / words) for lang, (best, _, words, known) in found if best == lang and words >= EVIDENCE]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in good], pa.string()), pa.array([x[1] for x in good], pa.float64())], names=["lang", "share"])

    return rows


def known_shares(labelled: DataFrame, model: Model, lang_col: str, text_col: str) -> dict[str, float]:
    """Per language the share of known words that all but LOW of its documents of EVIDENCE words or more reach.

    ``labelled`` are documents the model has not learned from; all of them are read. A language without such documents
    takes the least share of the others.
    """
    texts = labelled.select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    texts = texts.filter(F.col("lang").isin(model.languages))
    found = texts.mapInArrow(_share_rows(model), "lang string, share double")
    shares = {r["lang"]: r["share"] for r in found.groupBy("lang").agg(F.percentile("share", F.lit(LOW)).alias("share")).collect()}
    return {lang: shares.get(lang, min(shares.values(), default=0.0)) for lang in model.languages}


class LeastKnown:
    """Fewest known words of a text of a language of which at least ``share`` of the words are known: fewer have a chance below CHANCE."""

    def __init__(self):
        self.log_factorials = np.zeros(1)
        self.found: dict[tuple[int, float], int] = {}

    def __call__(self, words: int, share: float) -> int:
        if share <= 0 or not words:
            return 0
        least = self.found.get((words, share))
        if least is None:
            if words >= len(self.log_factorials):
                self.log_factorials = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 2 * words + 1)))])
            f, k = self.log_factorials, np.arange(words + 1)
            log = f[words] - f[k] - f[words - k] + k * math.log(share) + (words - k) * math.log(max(1 - share, 1e-9))
            least = int(np.searchsorted(np.cumsum(np.exp(log)), CHANCE))
            if len(self.found) > 20_000:
                self.found.clear()
            self.found[words, share] = least = min(least, words)
        return least


def _kept_rows(model: Model, shares: dict[str, float], text: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor, least = Predictor(model), LeastKnown()
        for block in blocks(batches, text):
            found = predictor.look(block.column(block.schema.get_field_index(text)).to_pylist())
            fits = [lang != UNKNOWN and score >= LEAST_SCORE and known >= least(words, shares[lang]) for lang, score, words, known in found]
            yield block.filter(pa.array(fits, pa.bool_()))

    return rows


def keep_learned(docs: DataFrame, model: Model, shares: dict[str, float], text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text is in one of the model's languages: the best one is likely
    enough among them, and knows as many of the words as its own documents let expect. No shuffle and no further column."""
    typed = docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    return typed.mapInArrow(_kept_rows(model, shares, text_col), typed.schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that no model may learn from: crc32 of the id as text, modulo five, is zero."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 5 == 0, F.lit(False))
