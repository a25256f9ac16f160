"""SentencePiece encoding and decoding on the ``tokenizers`` library.

The model file is a protobuf message; it is parsed here, and normaliser, blank marker, piece scores
and byte fallback are rebuilt as a ``tokenizers`` pipeline. BPE models become merges ordered by the
score of the merged piece, unigram models keep their scores. Where no piece of the vocabulary goes on
after a blank marker, text is cut before each run of markers: no merge crosses such a cut, so the
stretches are encoded apart, as multithreaded batches, and remembered. In unigram models two segmentations of a stretch can have
the same score; then single-precision sums over the whole text decide, so a text with such a stretch is segmented as a whole.
Every text is also encoded by the ``sentencepiece`` library, and ``parity`` tells whether the ids agree; for unigram models with
user-defined pieces it is reported, not promised.

Defined results: a null or empty text has no ids; control pieces are never produced from text;
``round_trip`` tells whether decoding gives the text back, which byte fallback makes true wherever the
normaliser changes nothing; repeated rows get equal results; other columns are not read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from recordloom.llm.common import narrowed

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
REMEMBERED = 600_000
_CODECS: dict[int, Codec] = {}


def _fields(message: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of each field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(message):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            size = varint()
            yield tag >> 3, message[at : at + size]
            at += size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            yield tag >> 3, message[at : at + size]
            at += size
        else:
            raise ValueError(f"unknown wire type {kind}")


@dataclass
class Spec:
    """What a model file says; defaults are those of the message definition."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    model: int = UNIGRAM
    byte_fallback: bool = False
    suffix_marker: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim_blanks: bool = True
    escape_blanks: bool = True

    @classmethod
    def parse(cls, message: bytes) -> Spec:
        spec = cls()
        for number, value in _fields(message):
            if number == 1:
                part = dict(_fields(value))
                score = struct.unpack("<f", part[2])[0] if 2 in part else 0.0
                spec.pieces.append((part.get(1, b"").decode(), score, part.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
                spec.model = trainer.get(3, UNIGRAM)
                spec.byte_fallback = bool(trainer.get(35, 0))
                spec.suffix_marker = bool(trainer.get(24, 0))
            elif number == 3:
                norm = dict(_fields(value))
                spec.charsmap = norm.get(2, b"")
                spec.dummy_prefix = bool(norm.get(3, 1))
                spec.trim_blanks = bool(norm.get(4, 1))
                spec.escape_blanks = bool(norm.get(5, 1))
        return spec

    def merges(self) -> list[tuple[str, str]]:
        """Pairs whose join is a piece, best score first; pairs of one piece by the ids of their parts."""
        ids = {p: i for i, (p, _, kind) in enumerate(self.pieces) if kind in (NORMAL, USER)}
        found = []
        for piece, place in ids.items():
            for k in range(1, len(piece)):
                left, right = ids.get(piece[:k]), ids.get(piece[k:])
                if left is not None and right is not None:
                    found.append((-self.pieces[place][1], place, left, right))
        return [(self.pieces[left][0], self.pieces[right][0]) for _, _, left, right in sorted(found)]


class Unigrams:
    """Segmentations by unigram scores, for texts in which rounding decides between equal ones."""

    #: What an unknown character costs below the least score; differences that single precision may not tell apart.
    UNKNOWN_COST, CLOSE = 10.0, 1e-2

    def __init__(self, spec: Spec, unknown: int):
        usable = [(p, i, s, kind) for i, (p, s, kind) in enumerate(spec.pieces) if kind in (NORMAL, USER)]
        scores = [s for _, _, s, kind in usable if kind == NORMAL]
        self.least, most = min(scores, default=0.0), max(scores, default=0.0)
        # A user's own piece outbids any other segmentation of its characters.
        self.pieces = {p: (i, len(p.encode()) * most - 0.1 if kind == USER else s) for p, i, s, kind in usable}
        self.longest = max(map(len, self.pieces), default=1)
        others = [re.escape(p) for p, _, kind in spec.pieces if p and kind != NORMAL]
        self.special = re.compile("|".join(others) or "(?!)")
        self.unknown = unknown
        self.bytes = {int(p[1:-1], 16): i for i, (p, _, kind) in enumerate(spec.pieces) if kind == BYTE} if spec.byte_fallback else {}

    def _candidates(self, text: str, start: int) -> Iterator[tuple[int, int, float]]:
        """(end, id, score) of the pieces that begin at a place, the shortest first; an unknown character is one of its own."""
        get, single = self.pieces.get, False
        for end in range(start + 1, min(len(text), start + self.longest) + 1):
            found = get(text[start:end])
            if found is not None:
                single |= end == start + 1
                yield end, *found
        if not single:
            yield start + 1, self.unknown, self.least - self.UNKNOWN_COST

    def tied(self, text: str) -> bool:
        """Whether two ways of reaching some place of the text are about equally good, or it spells a special piece."""
        if self.special.search(text):
            return True
        best = [0.0] + [-np.inf] * len(text)
        for start in range(len(text)):
            for end, _, score in self._candidates(text, start):
                score += best[start]
                if abs(score - best[end]) < self.CLOSE:
                    return True
                best[end] = max(best[end], score)
        return False

    def ids(self, text: str) -> np.ndarray:
        """Ids of the best segmentation, its scores added up in single precision from the start of the text."""
        best, back = np.full(len(text) + 1, -np.inf, dtype=np.float32), [(0, 0)] * (len(text) + 1)
        best[0] = 0
        for start in range(len(text)):
            for end, piece, score in self._candidates(text, start):
                reached = best[start] + np.float32(score)
                if reached > best[end]:
                    best[end], back[end] = reached, (start, piece)
        out: list[int] = []
        at = len(text)
        while at:
            start, piece = back[at]
            if piece != self.unknown:
                out.append(piece)
            elif self.bytes:
                out.extend(self.bytes[b] for b in reversed(text[start:at].encode()))
            elif not out or out[-1] != self.unknown:
                out.append(piece)
            at = start
        return np.array(out[::-1], dtype="<u4")


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, message: bytes, threads: int = 2):
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        from tokenizers import Regex, Tokenizer, models, normalizers

        spec = self.spec = Spec.parse(message)
        self.unigrams: Unigrams | None = None
        self.tied: set[str] = set()  # stretches with two equal segmentations
        if spec.suffix_marker:
            raise ValueError("models with the blank marker as suffix are not supported")
        vocab = {p: i for i, (p, _, _) in enumerate(spec.pieces)}
        unknown = next(i for i, (_, _, kind) in enumerate(spec.pieces) if kind == UNKNOWN)
        if spec.model == BPE:
            model = models.BPE(
                vocab=vocab, merges=spec.merges(), unk_token=spec.pieces[unknown][0], fuse_unk=True, byte_fallback=spec.byte_fallback
            )
        elif spec.model == UNIGRAM:
            model = models.Unigram([(p, s) for p, s, _ in spec.pieces], unknown, spec.byte_fallback)
            self.unigrams = Unigrams(spec, unknown)
        else:
            raise ValueError("only BPE and unigram models are supported")
        self.tokenizer = Tokenizer(model)
        steps = [normalizers.Precompiled(spec.charsmap)] if spec.charsmap else []
        if spec.trim_blanks:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
        self.normalizer = normalizers.Sequence(steps) if steps else None
        crossing = re.compile(f"[^{MARK}]{MARK}")
        apart = not any(crossing.search(p) for p, _, kind in spec.pieces if kind in (NORMAL, USER))
        self.cut = re.compile(f"(?<=[^{MARK}])(?={MARK})") if apart else None
        self.spelled = [
            bytes([int(p[1:-1], 16)]) if kind == BYTE else b"" if kind == CONTROL else p.replace(MARK, " ").encode()
            for p, _, kind in spec.pieces
        ]
        self.simple = apart and self.normalizer is None and spec.dummy_prefix and spec.escape_blanks
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    @classmethod
    def of(cls, message: bytes) -> Codec:
        key = hash(message)
        if key not in _CODECS:
            _CODECS[key] = cls(message)
        return _CODECS[key]

    def normal(self, text: str) -> str:
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        if not text:
            return ""
        if self.spec.dummy_prefix:
            text = " " + text
        return text.replace(" ", MARK) if self.spec.escape_blanks else text

    def stretches(self, text: str) -> list[str]:
        """Parts of the normalised text that are encoded apart."""
        text = self.normal(text)
        return [x for x in (self.cut.split(text) if self.cut else [text]) if x]

    def plain_words(self, text: str) -> list[str] | None:
        """Words of a text whose stretches are one marker and a word each; None for other texts."""
        if not self.simple or "  " in text or MARK in text or text[:1] in ("", " ") or text[-1] == " ":
            return None
        return text.split(" ")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; new stretches of all texts are one multithreaded batch."""
        if len(self.known) + len(self.words) > REMEMBERED:
            self.known.clear()
            self.words.clear()
            self.tied.clear()
        known, words = self.known, self.words
        plain = [self.plain_words(t) for t in texts]
        cut = [None if p is not None else self.stretches(t) for p, t in zip(plain, texts, strict=True)]
        new_words = list({x for p in plain if p is not None for x in p if x not in words})
        new = list({x for c in cut if c is not None for x in c if x not in known})
        spelled = [MARK + x for x in new_words] + new
        long_words: dict[str, bytes] = {}
        long_ones: dict[str, bytes] = {}
        if spelled:
            found = [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch(spelled, add_special_tokens=False)]
            for x, ids in zip(new_words, found, strict=False):
                (words if len(x) <= 32 else long_words)[x] = ids
            for x, ids in zip(new, found[len(new_words) :], strict=True):
                (known if len(x) <= 32 else long_ones)[x] = ids
        tied: set[str] = set()
        if self.unigrams is not None:
            tied = self.tied.union(x for x in spelled if self.unigrams.tied(x))
            self.tied.update(x for x in tied if len(x) <= 33)
        out = []
        for text, p, c in zip(texts, plain, cut, strict=True):
            if tied and (any(MARK + x in tied for x in p) if p is not None else any(x in tied for x in c)):
                out.append(self.unigrams.ids(self.normal(text)))
                continue
            held, extra, parts = (words, long_words, p) if p is not None else (known, long_ones, c)
            got = [held[x] if x in held else extra[x] for x in parts] if extra else list(map(held.__getitem__, parts))
            out.append(np.frombuffer(b"".join(got), dtype="<u4"))
        return out

    def decode(self, ids: np.ndarray) -> str:
        spelled = self.spelled
        raw = b"".join([spelled[i] for i in ids.tolist()])
        if self.spec.dummy_prefix and raw.startswith(b" "):
            raw = raw[1:]
        return raw.decode(errors="replace")


def _rows(message: bytes, with_ids: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        codec = Codec.of(message)
        reference = sentencepiece.SentencePieceProcessor(model_proto=message)
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = codec.encode(texts)
                same = [list(x) == y for x, y in zip(map(np.ndarray.tolist, ids), reference.encode(texts, num_threads=1), strict=True)]
                arrays = [
                    part.column(0),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                    pa.array(same, pa.bool_()),
                    pa.array([codec.decode(x) == t for x, t in zip(ids, texts, strict=True)], pa.bool_()),
                ]
                names = ["doc_id", "n_ids", "ids_crc32", "parity", "round_trip"]
                if with_ids:
                    arrays.append(pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return rows


def encode_documents(docs: DataFrame, message: bytes, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """doc_id, n_ids, ids_crc32, parity, round_trip[, ids] per row; ``message`` is the content of a model file. No shuffle."""
    schema = "doc_id long, n_ids long, ids_crc32 long, parity boolean, round_trip boolean" + (", ids array<int>" if with_ids else "")
    return narrowed(docs, id_col, text_col).mapInArrow(_rows(message, with_ids), schema)


def decode_documents(encoded: DataFrame, message: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of rows with piece ids; null ids give a null text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(message)
        for batch in batches:
            texts = [None if x is None else codec.decode(np.array(x, dtype=np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.selectExpr(f"`{id_col}` AS doc_id", f"`{ids_col}` AS ids").mapInArrow(rows, "doc_id long, text string")
