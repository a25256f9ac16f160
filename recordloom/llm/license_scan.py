"""Licence scan: a trained paragraph classifier, confirmed by comparison with templates.

A paragraph is a run of lines with words; comment marks are no words. Each line of it is classified, and so is
every stretch of the paragraph, across its lines, that holds many word pairs of a notice: notices are mostly wrapped.
Stretches of more than STRETCH words are taken in overlapping windows. Features are hashed word one- to three-grams,
without case and punctuation; a sparse logistic regression gives each licence family and ``unknown`` a probability. It
is trained here, on the notices below with words left out and other text around them, and on
paragraphs of a bounded sample of the corpus as ``unknown``. Probabilities are calibrated on held-out
paragraphs by a temperature, and a family is only predicted above the level that the held-out unknown
ones stay under. A prediction counts if the line or stretch also holds most word pairs of a notice of that
family, where any version stands for any other, or an SPDX expression that names it. A stretch that overlaps a line that counts is the same notice; of overlapping stretches the best counts.

Defined results: a null or empty text has no paragraph; lines without a word are none; repeated rows
get equal results; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import Words, blocks, narrowed, text_buffer

#: Usual notices of each family. They are what licences say of themselves.
NOTICES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License',
        "This project is distributed under the terms of the Apache License 2.0",
    ),
    "MIT": (
        "Released under the MIT License",
        "This software is licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "Licensed under the GNU GPL version 2 or later",
        "Distributed under the GNU General Public License v3.0",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "Distributed under the GNU Lesser General Public License v3.0",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
        "Distributed under the GNU Affero General Public License v3.0",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license",
        "Released under the BSD 3-Clause License",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License 2.0",
        "Mozilla Public License Version 2.0",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "Released under the ISC License",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "CC0": (
        "To the extent possible under law, the author has waived all copyright and related rights to this work",
        "Dedicated to the public domain under CC0 1.0",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software",
        "Released under the Unlicense",
    ),
    "EPL": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0",
        "Licensed under the Eclipse Public License 2.0",
    ),
}
#: Identifiers of the SPDX list, without version suffixes, by family. Fixed values.
SPDX: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("Apache-2.0",),
    "MIT": ("MIT", "MIT-0"),
    "GPL": ("GPL-2.0", "GPL-3.0"),
    "LGPL": ("LGPL-2.1", "LGPL-3.0"),
    "AGPL": ("AGPL-3.0",),
    "BSD": ("BSD-2-Clause", "BSD-3-Clause", "0BSD"),
    "MPL-2.0": ("MPL-2.0",),
    "ISC": ("ISC",),
    "CC-BY": ("CC-BY-3.0", "CC-BY-4.0"),
    "CC-BY-SA": ("CC-BY-SA-3.0", "CC-BY-SA-4.0"),
    "CC-BY-NC": ("CC-BY-NC-3.0", "CC-BY-NC-4.0"),
    "CC0": ("CC0-1.0",),
    "Unlicense": ("Unlicense",),
    "EPL": ("EPL-1.0", "EPL-2.0"),
}


def _spdx_notices(family: str) -> list[str]:
    """Tags of the family's identifiers, with the suffixes that the GNU licences have."""
    ends = ("", "-only", "-or-later") if family in ("GPL", "LGPL", "AGPL") else ("",)
    return [f"SPDX-License-Identifier: {name}{end}" for name in SPDX[family] for end in ends]


NOTICES = {family: (*notices, *_spdx_notices(family)) for family, notices in NOTICES.items()}
UNKNOWN = "unknown"
FAMILIES = [UNKNOWN, *NOTICES]
SLOTS = 1 << 16
GRAMS = 3
#: Documents whose paragraphs are the unknown ones of the training, at most about this many.
TRAIN_DOCUMENTS = 3_000
#: Characters of such a paragraph, at most.
TRAIN_LENGTH = 10_000
#: Share of a notice's word pairs that a line or stretch has to hold.
CONFIRMED = 0.75
#: Share from which a stretch is classified; lower, as words here may have marks that are not ASCII.
SUSPECTED = 0.5
#: Most words between the word pairs of a stretch, tight and wide.
GAPS = (3, 12)
#: Words of a window of a long stretch, and from one window to the next; a notice and such a step fit into a window.
STRETCH = 48
STEP = 12

_PLAIN = np.arange(256, dtype=np.uint8)
for _code in range(128):
    if not chr(_code).isalnum() and chr(_code) != "\n":
        _PLAIN[_code] = 32


def _lines(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each line of the texts starts (and the last ends), and the text it belongs to."""
    breaks = np.flatnonzero(data == 10) + 1
    starts = np.union1d(at[:-1], breaks)
    starts = starts[starts < len(data)]  # empty texts have no line
    owner = np.searchsorted(at, starts, side="right") - 1
    return np.append(starts, len(data)), owner


def features(data: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature slots of all lines, by line, and how many each line has."""
    words = Words(_PLAIN[data], lines, lower=True)
    rows, slots = [], []
    for size in range(1, GRAMS + 1):
        start, key = words.windows(size)
        rows.append(words.row[start])
        slots.append(((key ^ np.uint64(size)) % np.uint64(SLOTS)).astype(np.int32))
    row, slot = np.concatenate(rows), np.concatenate(slots)
    order = np.argsort(row, kind="stable")
    return slot[order], np.bincount(row, minlength=len(lines) - 1)


class Classifier:
    """Weights per slot and family, calibrated; and the word pairs of the notices."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, temperature: float = 1.0, level: float = 0.5):
        self.weights, self.bias, self.temperature, self.level = weights, bias, temperature, level

    def logits(self, slots: np.ndarray, counts: np.ndarray) -> np.ndarray:
        out = np.tile(self.bias, (len(counts), 1))
        some = np.flatnonzero(counts)
        if len(some):
            starts = np.cumsum(counts) - counts
            sums = np.add.reduceat(self.weights[slots], starts[some], axis=0)
            out[some] += sums / np.sqrt(counts[some])[:, None]
        return out

    def probabilities(self, slots: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return _softmax(self.logits(slots, counts) / self.temperature)

    def predict(self, slots: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Family number of each line, 0 for unknown, and its probability."""
        p = self.probabilities(slots, counts)
        best = p.argmax(axis=1)
        score = p[np.arange(len(p)), best]
        return np.where((score > self.level) & (counts > 0), best, 0), score


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def word_pairs(text: str) -> set[tuple[str, str]]:
    """Pairs of neighbouring words; a version, however it is written, is one word that equals any other version."""
    words: list[str] = []
    for word in re.findall(r"[^\W_]+", text.lower()):
        if re.fullmatch(r"v?\d{1,2}", word):
            if words and words[-1] in ("v", "version"):
                words.pop()
            if not words or words[-1] != "#":
                words.append("#")
        else:
            words.append(word)
    return set(zip(words, words[1:], strict=False))


_SPDX_TAG = re.compile(r"SPDX-License-Identifier:[ \t]*([^\n]*)", re.IGNORECASE)
_SPDX_FAMILY = {re.sub(r"-\d[\d.]*$", "", name).lower(): family for family, names in SPDX.items() for name in names}


def spdx_families(text: str) -> set[str]:
    """Families of the identifiers in the licence expressions of SPDX tags: ids joined by AND and OR, with exceptions after WITH."""
    found = set()
    for expression in _SPDX_TAG.findall(text):
        last = ""
        for word in re.findall(r"[A-Za-z0-9.+-]+", expression):
            if word in ("AND", "OR", "WITH"):
                last = word
                continue
            name = re.sub(r"(\+|-only|-or-later)$", "", word.lower())
            family = _SPDX_FAMILY.get(name) or _SPDX_FAMILY.get(re.sub(r"-\d[\d.]*$", "", name))
            if family and last != "WITH":
                found.add(family)
            last = ""
    return found


_PAIRS = {family: [word_pairs(n) for n in notices] for family, notices in NOTICES.items()}


def confirmed(family: str, paragraph: str) -> bool:
    """Whether the paragraph holds most word pairs of a notice of the family, or an SPDX tag that names it; a tag of others is no notice."""
    tagged = spdx_families(paragraph)
    if tagged:
        return family in tagged
    pairs = word_pairs(paragraph)
    return any(len(pairs & notice) >= CONFIRMED * len(notice) for notice in _PAIRS[family])


def _of_notice(line: str) -> bool:
    """Whether the line may be one of a wrapped notice: its word pairs are mostly those of one."""
    pairs = word_pairs(line)
    return any(len(pairs & n) >= max(2, SUSPECTED * len(pairs)) for notices in _PAIRS.values() for n in notices)


def _share(family: str, text: str) -> float:
    """Largest share of the word pairs of a notice of the family that the text holds."""
    pairs = word_pairs(text)
    return max(len(pairs & notice) / len(notice) for notice in _PAIRS[family])


def _pair_keys() -> tuple[np.ndarray, dict[int, list[int]], list[int]]:
    """Sorted keys of the word pairs of all notices, the notices of each key, and the pairs of each notice."""
    held: dict[int, list[int]] = {}
    sizes = []
    for k, notice in enumerate(n for notices in NOTICES.values() for n in notices):
        data, at = text_buffer(pa.array([notice]))
        keys = set(Words(_PLAIN[data], at, lower=True).windows(2)[1].tolist())
        sizes.append(len(keys))
        for key in keys:
            held.setdefault(key, []).append(k)
    return np.array(sorted(held), dtype=np.uint64), held, sizes


_KEYS, _NOTICES_OF, _SIZES = _pair_keys()


def stretches(data: np.ndarray, lines: np.ndarray, owner: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Paragraphs of the texts (the text each belongs to), and (text, start, end) of stretches that may be a notice."""
    some = counts > 0
    opens = some.copy()
    opens[1:] &= ~some[:-1] | (owner[1:] != owner[:-1])
    first = np.flatnonzero(opens)
    if not len(first):
        return owner[first], []
    words = Words(_PLAIN[data], np.append(lines[first], len(data)), lower=True)
    start, key = words.windows(2)
    hit = np.isin(key, _KEYS)
    at, key, row = start[hit], key[hit], words.row[start[hit]]
    found = set()
    for gap in GAPS:
        ends = np.flatnonzero(np.append((np.diff(at) > gap) | (np.diff(row) != 0), True)) if len(at) else np.zeros(0, np.int64)
        begins = np.append(0, ends[:-1] + 1) if len(ends) else ends
        for i, j in zip(begins.tolist(), ends.tolist(), strict=True):
            if j - i < 2:
                continue
            for a, b in _windows(at, i, j):
                if _suspected(key[a : b + 1].tolist()):
                    found.add((int(owner[first[row[a]]]), int(words.start[at[a]]), int(words.end[at[b] + 1])))
    return owner[first], sorted(found)


def _windows(at: np.ndarray, i: int, j: int) -> Iterator[tuple[int, int]]:
    """Ranges of the hits ``i`` to ``j``: all of them, or those of each window of a long stretch."""
    if at[j] - at[i] < STRETCH:
        yield i, j
        return
    for word in range(int(at[i]), int(at[j]), STEP):
        a, b = np.searchsorted(at[i : j + 1], (word, word + STRETCH)) + i
        if b - a > 2:
            yield int(a), int(b) - 1


def _suspected(keys: list[int]) -> bool:
    held: dict[int, int] = {}
    for key in set(keys):
        for k in _NOTICES_OF[key]:
            held[k] = held.get(k, 0) + 1
    return any(n >= SUSPECTED * _SIZES[k] for k, n in held.items())


def _wrapped(model: Classifier, raw: bytes, spots: list[tuple[int, int, int]], taken: list[list[tuple[int, int]]]) -> list[tuple]:
    """(text, start, end, family, probability) of the stretches that count, in bytes; none overlaps another or a taken one."""
    spots = [(i, a, b) for i, a, b in spots if not any(s < b and a < e for s, e in taken[i])]
    if not spots:
        return []
    texts = [raw[a:b].decode() for _, a, b in spots]
    data, at = text_buffer(pa.array(texts))
    family, score = model.predict(*features(data, at))
    good = []
    for k in np.flatnonzero(family).tolist():
        name = FAMILIES[family[k]]
        if confirmed(name, texts[k]):
            i, a, b = spots[k]
            good.append((-_share(name, texts[k]), -float(score[k]), b - a, i, a, b, name))
    out: list[tuple] = []
    for _, minus, _, i, a, b, name in sorted(good):
        if not any(s < b and a < e for s, e in taken[i]):
            taken[i].append((a, b))
            out.append((i, a, b, name, -minus))
    return out


def _examples(plain: list[str]) -> tuple[list[str], list[int]]:
    """Notices with words left out and text around them, and the plain paragraphs as unknown."""
    texts, labels = [], []
    rng = np.random.default_rng(7)
    for number, family in enumerate(FAMILIES[1:], 1):
        for notice in NOTICES[family]:
            for k in range(30):
                words = [w for w in notice.split() if k < 6 or rng.random() > 0.08]
                if k % 3 == 1 and plain:
                    around = plain[int(rng.integers(len(plain)))].split()[: int(rng.integers(1, 12))]
                    words = around + words if rng.random() < 0.5 else words + around
                if k % 5 == 2:
                    words = [f"Copyright {1990 + k} The Authors."] + words
                texts.append(" ".join(words))
                labels.append(number)
    fresh = [p for p in plain if not any(confirmed(f, p) for f in NOTICES) and not _of_notice(p)]
    return texts + fresh, labels + [0] * len(fresh)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", documents: int = TRAIN_DOCUMENTS, rounds: int = 60) -> Classifier:
    """Train on the notices and on one paragraph of about ``documents`` documents at most, chosen by a hash of the id."""
    texts = narrowed(docs, id_col, text_col)
    share = min(1.0, documents / max(texts.count(), 1))
    sample = texts.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 60)) < math.ceil(share * (1 << 60)))
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.length(F.trim(x)).between(1, TRAIN_LENGTH))
    line = F.element_at(lines, F.pmod(F.xxhash64("text"), F.size(lines)).cast("int") + 1)
    rows = sample.select("doc_id", F.when(F.size(lines) > 0, line).alias("line")).dropna().collect()
    plain = [line for _, line in sorted(tuple(r) for r in rows)]
    return _trained(*_examples(plain), rounds)


def _trained(texts: list[str], labels: list[int], rounds: int) -> Classifier:
    data, at = text_buffer(pa.array([t.replace("\n", " ") for t in texts]))
    slots, counts = features(data, at)
    held = np.array([hashlib.md5(t.encode()).digest()[0] < 51 for t in texts])
    label = np.array(labels)
    row = np.repeat(np.arange(len(texts)), counts)
    use = ~held[row]
    weight = 1 / np.sqrt(np.maximum(counts, 1))
    model = Classifier(np.zeros((SLOTS, len(FAMILIES)), dtype=np.float32), np.zeros(len(FAMILIES)))
    hot = np.eye(len(FAMILIES))[label]
    memory = [np.zeros(model.weights.shape) for _ in range(2)]
    for step in range(1, rounds + 1):
        wrong = (hot - _softmax(model.logits(slots, counts))) * ~held[:, None]
        grad = np.zeros(model.weights.shape)
        for c in range(len(FAMILIES)):
            grad[:, c] = np.bincount(slots[use], (wrong[row, c] * weight[row])[use], minlength=SLOTS)
        grad = grad / len(texts) - 1e-6 * model.weights
        m, v = memory
        m += 0.1 * (grad - m)
        v += 0.01 * (grad * grad - v)
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        model.weights += move.astype(np.float32)
        model.bias += 0.5 * wrong.mean(axis=0)
    check = np.flatnonzero(held)
    logits = model.logits(slots, counts)[check]

    def loss(temperature: float) -> float:
        return -np.log(np.maximum(_softmax(logits / temperature)[np.arange(len(check)), label[check]], 1e-12)).mean()

    if len(check):
        model.temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0), key=loss)
        p = _softmax(logits / model.temperature)
        strange = p[label[check] == 0][:, 1:].max(axis=1) if (label[check] == 0).any() else np.zeros(1)
        model.level = float(max(0.5, np.quantile(strange, 0.999)))
    return model


def _scan(model: Classifier):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            data, at = text_buffer(block.column(1))
            lines, owner = _lines(data, at)
            slots, counts = features(data, lines)
            family, score = model.predict(slots, counts)
            of, spots = stretches(data, lines, owner, counts)
            paragraphs = np.bincount(of, minlength=block.num_rows)
            raw = data.tobytes()
            taken: list[list[tuple[int, int]]] = [[] for _ in range(block.num_rows)]
            found: list[list[tuple]] = [[] for _ in range(block.num_rows)]
            for k in np.flatnonzero(family).tolist():
                i, name = int(owner[k]), FAMILIES[family[k]]
                text = raw[lines[k] : lines[k + 1]].decode()
                if confirmed(name, text):
                    start = len(raw[at[i] : lines[k]].decode())
                    found[i].append((start, name, start + len(text.rstrip("\n")), float(score[k])))
                    taken[i].append((int(lines[k]), int(lines[k + 1])))
            for i, a, b, name, p in _wrapped(model, raw, spots, taken):
                start = len(raw[at[i] : a].decode())
                found[i].append((start, name, start + len(raw[a:b].decode()), p))
            yield pa.RecordBatch.from_arrays(
                [
                    block.column(0),
                    pa.array(paragraphs, pa.int64()),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([",".join(sorted({name for _, name, _, _ in f})) for f in found]),
                    pa.array([",".join(f"{name}:{a}:{b}" for a, name, b, _ in sorted(f)) for f in found]),
                    pa.array([max((p for *_, p in f), default=0.0) for f in found], pa.float64()),
                ],
                names=["doc_id", "n_paragraphs", "n_licences", "families", "spans", "score"],
            )

    return rows


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **training) -> DataFrame:
    """One row per row of ``docs``: paragraphs, confirmed notices, their families and spans (code points), best score. No shuffle."""
    model = fit(docs, id_col, text_col, **training)
    schema = "doc_id long, n_paragraphs long, n_licences long, families string, spans string, score double"
    return narrowed(docs, id_col, text_col).mapInArrow(_scan(model), schema)
