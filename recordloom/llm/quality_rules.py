"""Line-first quality rules: judge each line, remove the failures, then reject documents that lost too much.

A line fails for one of three reasons: ``navigation`` (menu separators, or a short line of menu
words), ``boilerplate`` (a fifth or more of its letters belong to stock phrases of web pages, however long it is) and
``punctuation`` (most of its words carry symbols, or it is all capitals without a final mark). Words and phrases are those
of English, French, German and Spanish pages, compared without case and accents.
A document is rejected if its base counts fail, or if the failed lines hold more than ``most_lost``
of its word characters.

Defined results: a null or empty text has no words and fails the base; lines without a word are
neither judged nor counted; repeated rows get equal results; other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from recordloom.llm.common import BLANKS, Words, blocks, mix, narrowed, text_buffer

SYMBOLS = "#*$%&|<>"
WINDOW = 5

SEPARATORS = ("|", ">", "»", "•", "·", "::")
# Words of menus and stock phrases of pages, without accents.
MENU_WORDS = frozenset(
    "home menu login logout register search next previous back top contact about help sitemap share print archive "
    "startseite kontakt impressum anmelden suche weiter zuruck hilfe inicio contacto buscar siguiente anterior ayuda "
    "accueil connexion recherche suivant precedent retour aide".split()
)
STOCK_PHRASES = (
    "cookie policy", "cookies policy", "cookie settings", "cookies to improve", "use cookies", "uses cookies", "accept cookies", "accept all cookies",
    "privacy policy", "terms of use", "terms of service", "terms and conditions", "all rights reserved",
    "enable javascript", "javascript is disabled", "javascript is required", "subscribe to our", "sign up for our",
    "newsletter", "click here", "read more", "powered by", "lorem ipsum", "skip to content", "skip to main content",
    "follow us on", "share this", "share on",
    "accepter les cookies", "accepter tous les cookies", "politique de confidentialite", "conditions d'utilisation", "mentions legales",
    "tous droits reserves", "utilise des cookies", "s'abonner", "abonnez-vous", "cliquez ici", "lire la suite", "suivez-nous", "partager sur",
    "cookies akzeptieren", "alle cookies", "verwendet cookies", "datenschutzerklarung", "datenschutz und impressum", "alle rechte vorbehalten",
    "nutzungsbedingungen", "hier klicken", "klicken sie hier", "weiterlesen", "folgen sie uns", "jetzt abonnieren",
    "aceptar cookies", "aceptar las cookies", "aceptar todas las cookies", "utiliza cookies", "politica de privacidad", "politica de cookies",
    "condiciones de uso", "aviso legal", "todos los derechos reservados", "haga clic aqui", "haz clic aqui", "leer mas", "siguenos en", "suscribete a",
)
_STOCK = re.compile("|".join(map(re.escape, sorted(STOCK_PHRASES, key=len, reverse=True))))
#: Share of a line's letters that belong to stock phrases, at least, in a line of boilerplate.
STOCK_SHARE = 0.2


def folded(text: str) -> str:
    """The text without case and accents."""
    low = text.lower()
    return low if low.isascii() else "".join(c for c in unicodedata.normalize("NFKD", low) if not unicodedata.combining(c))


SYMBOL_RUN = re.compile(r"""[^\w\s"'”’)\]]{2,}""")
FINAL_MARKS = (".", "!", "?", '"', "'", ":", ";", "…", "”", "»", "。", "！", "？", ")")


def line_failure(line: str) -> str | None:
    """Reason why a line is removed, or None."""
    words = line.split()
    if sum(map(words.count, SEPARATORS)) >= max(2, len(words) // 8):
        return "navigation"
    if len(words) <= 5 and sum(folded(w.strip(".,:;|>»-")) in MENU_WORDS for w in words) * 2 > len(words):
        return "navigation"
    stock = sum(len(m.replace(" ", "")) for m in _STOCK.findall(folded(line)))
    if stock and stock >= STOCK_SHARE * sum(map(len, words)):
        return "boilerplate"
    if len(SYMBOL_RUN.findall(line)) * 2 > len(words):
        return "punctuation"
    if len(words) >= 5 and line.isupper() and not line.rstrip().endswith(FINAL_MARKS):
        return "punctuation"
    return None


def clean_lines(text: str) -> tuple[list[str], dict[str, int]]:
    """Lines that stay, and word characters lost by reason."""
    stay, lost = [], {"navigation": 0, "boilerplate": 0, "punctuation": 0}
    for line in text.split("\n"):
        reason = line_failure(line) if line.strip(BLANKS) else None
        if reason is None:
            stay.append(line)
        else:
            lost[reason] += _word_chars(line)
    return stay, lost


def _word_chars(text: str) -> int:
    return len(text) - sum(map(text.count, BLANKS))


def _repeated_words(words: Words, rows: int) -> np.ndarray:
    """Words of each text inside a window of WINDOW words that its text holds twice or more."""
    at, key = words.windows(WINDOW)
    if not len(at):
        return np.zeros(rows, dtype=np.int64)
    row = words.row[at]
    key = mix(key + row.astype(np.uint64))
    order = np.argsort(key)
    same = (key[order][1:] == key[order][:-1]) & (row[order][1:] == row[order][:-1])
    twice = np.zeros(len(at), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(words.hash) + 1, dtype=np.int64)
    edges[at[twice]] += 1  # no window starts twice
    edges[at[twice] + WINDOW] -= 1
    covered = np.cumsum(edges[:-1]) > 0
    return np.bincount(words.row[covered], minlength=rows)


_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, lost_navigation long, lost_boilerplate long, lost_punctuation long"
)


def _judge(with_text: bool, most_lost: float):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            data, at = text_buffer(block.column(1))
            words = Words(data, at)
            counts = words.counts
            repeated = _repeated_words(words, block.num_rows)
            rows: list[tuple] = []
            texts = []
            for i, value in enumerate(block.column(1)):
                text = value.as_py() or ""
                lines = [x for x in text.split("\n") if x.strip(BLANKS)]
                stay, lost = clean_lines(text)
                n, chars = int(counts[i]), _word_chars(text)
                failed = n < 10 or 100 * int(repeated[i]) > 20 * n
                kept = not failed and sum(lost.values()) <= most_lost * chars
                rows.append(
                    (n, chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), int(repeated[i]), failed, kept)
                    + tuple(lost.values())
                )
                texts.append("\n".join(stay))
            arrays = [block.column(0)]
            for k, column in enumerate(zip(*rows, strict=True)):
                arrays.append(pa.array(column, pa.bool_() if k in (5, 6) else pa.int64()))
            names = [part.split()[0] for part in _SCHEMA.split(", ")]
            if with_text:
                arrays.append(pa.array(texts, pa.string()))
                names.append("clean_text")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return judge


def judge_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True, most_lost: float = 0.5
) -> DataFrame:
    """Counts, verdict and (``with_text``) the text of the lines that stay, one row per row of ``docs``. No shuffle."""
    schema = _SCHEMA + (", clean_text string" if with_text else "")
    return narrowed(docs, id_col, text_col).mapInArrow(_judge(with_text, most_lost), schema)
