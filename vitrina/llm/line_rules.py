"""Quality rules, line first.

Base counts are taken from the whole text.  Then every line is judged by itself:

* punctuation: at least 3 marked words, and they are over 30 % of the line's words (a word
  is marked if it holds one of ``# * $ % & < >`` or two exclamation marks in a row); or
  20 words and more without one of ``. , ; : ! ?``;
* navigation: 3 or more separators ``| > » · •`` and at most 3 words for each;
* boilerplate: at most 20 words with one of the phrases below.

Failing lines are removed.  A document is rejected if the removed lines held more than
``max_loss`` of its word characters, or if its base rules fail.

Words are runs of characters other than space, tab, line feed, vertical tab, form feed and
carriage return; lines end at a line feed only.  Defined results: NULL or empty text has no
words and fails the base rules; NULL keys pass through; repeated rows give repeated rows; a kept
column that is named like a result is left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitrina.llm.pieces import release_encoders

# Phrases of lines that are not part of a text.
BOILERPLATE = ("all rights reserved", "licensed under", "released under the", "terms of use", "terms of service",
               "privacy policy", "cookie policy", "use cookies", "copyright", "enable javascript", "click here",
               "sign up for our", "subscribe to our", "share this", "powered by")
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|>»·•"

_PHRASE = re.compile("|".join(map(re.escape, BOILERPLATE)), re.IGNORECASE | re.ASCII)
_MARKED = re.compile(r"[#*$%&<>]|!!")
_STOP = re.compile(r"[.,;:!?]")
RESULTS = (("clean_text", "string"), ("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"),
           ("n_dup_lines", "bigint"), ("n_repeat_words", "bigint"), ("n_removed_lines", "bigint"),
           ("removed_chars", "bigint"), ("base_failed", "boolean"), ("kept", "boolean"))


def repeat_words(words: list) -> int:
    """Words that stand in a window of 3 words found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    place: dict = {}
    ids = np.fromiter((place.setdefault(w, len(place)) for w in words), np.int64, n)
    v = len(place)
    pairs = ids[:-2] * v + ids[1:-1]
    if v >= 2_000_000:  # keep the keys of the windows within 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, which, counts = np.unique(pairs * v + ids[2:], return_inverse=True, return_counts=True)
    if len(counts) == n - 2:
        return 0
    again = np.flatnonzero(counts[which] > 1)
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[again + k] = True
    return int(covered.sum())


def _n_chars(line: str) -> int:
    return len(line) - sum(map(line.count, " \t\n\v\f\r"))


def line_fails(line: str) -> bool:
    """Whether one of the line rules rejects a line that has a word."""
    words = line.encode().split()
    n = len(words)
    marked = sum(1 for w in line.translate(_BLANKS).split(" ") if w and _MARKED.search(w)) if _MARKED.search(line) else 0
    if marked >= 3 and 100 * marked > 30 * n:
        return True
    if n >= 20 and not _STOP.search(line):
        return True
    separators = sum(map(line.count, SEPARATORS))
    if separators >= 3 and n - separators <= 3 * (separators + 1) + separators:
        return True
    return n <= 20 and bool(_PHRASE.search(line))


_BLANKS = {c: 32 for c in b"\t\n\v\f\r"}
_MAY_FAIL = re.compile(r"[#*$%&<>|»·•]|!!|" + _PHRASE.pattern, re.IGNORECASE)


def judge(text: str, max_loss: float = 0.5) -> tuple:
    """(clean text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_lines,
    removed_chars, base_failed, kept)"""
    words = text.encode().split()
    n = len(words)
    word_chars = _n_chars(text)
    n_symbols = sum(map(text.count, SYMBOLS))
    lines = text.split("\n")
    seen: set[str] = set()
    kept_lines, dup, removed, removed_chars = [], 0, 0, 0
    for line in lines:
        if not line.strip(" \t\n\v\f\r"):
            kept_lines.append(line)
            continue
        if line in seen:
            dup += 1
        seen.add(line)
        if (len(line) >= 39 or _MAY_FAIL.search(line)) and line_fails(line):
            removed += 1
            removed_chars += _n_chars(line)
        else:
            kept_lines.append(line)
    repeated = repeat_words(words)
    base_failed = n < 50 or 100 * repeated > 50 * n
    kept = not base_failed and removed_chars <= max_loss * word_chars
    return ("\n".join(kept_lines) if removed else text, n, word_chars, n_symbols, dup, repeated, removed, removed_chars,
            base_failed, kept)


def line_first_rules(df: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text",
                     max_loss: float = 0.5, with_text: bool = True) -> DataFrame:
    """``keep`` columns with clean_text, the counts, n_removed_lines, removed_chars, base_failed and kept."""
    results = RESULTS if with_text else RESULTS[1:]
    keep = tuple(c for c in keep if c not in dict(results))
    src = df.select(*(F.col(f"`{c}`") for c in keep), F.col(text_col).cast("string").alias("__text"))
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), *(f"{n} {t}" for n, t in results)])
    arrow = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}

    def rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()
        for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
            rows = [judge(t.as_py() or "", max_loss) for t in batch.column(len(keep))]
            columns = list(zip(*rows)) if rows else [()] * len(RESULTS)
            columns = columns[len(RESULTS) - len(results):]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(len(keep))), *(pa.array(c, arrow[t]) for c, (_, t) in zip(columns, results))],
                names=[*keep, *(n for n, _ in results)])

    return src.mapInArrow(rules, schema)
