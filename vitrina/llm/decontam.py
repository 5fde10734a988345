"""Benchmark decontamination: pigeonhole edit matching.

A test item of m characters may differ from a passage by up to k = m * ``rate`` edits.  Cut
into k + 1 pieces, at least one piece then stands in the passage unchanged, at about its
place.  One automaton finds all pieces of all items in a text; each hit gives a window of the
text, hits whose windows meet are joined, and Myers' bit-parallel algorithm gives the smallest
edit distance between the item and any substring of the window.  No passage within the budget
is missed, and nothing beyond it is reported.

Both sides are lower-cased and their white space is made one blank; spans are places in that
form.  Items of less than ``MIN_FUZZY`` characters must occur unchanged (k = 0); empty items
match nothing.

The items are the stated query set: they are read in blocks of at most ``BLOCK`` characters,
and each block is held against all documents in one pass, so what a task holds is bounded
whatever the size of the benchmark.  A document is worked on by itself: no shuffle, and no
group of documents meets in a task.

Defined results: NULL or empty texts and items match nothing; repeated rows are reported row by
row; several passages of one document close to one item give the best one (ties: the first).
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

RATE = 0.08
MIN_FUZZY = 32
BLOCK = 4_000_000
MATCHES = "distance bigint, span_start bigint, span_end bigint"


def normalise(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def budget(item: str, rate: float) -> int:
    return int(len(item) * rate) if len(item) >= MIN_FUZZY else 0


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece) of k + 1 pieces of about the same length."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def masks(item: str) -> dict[str, int]:
    out: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        out[c] |= 1 << i
    return dict(out)


def best_match(peq: dict[str, int], m: int, text: str, anchored: bool = False) -> tuple[int, int]:
    """(smallest distance, first end) between the item with the masks ``peq`` and a substring of
    ``text`` (with ``anchored``: a prefix of it).  Myers' bit vectors, one Python integer each."""
    ones, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = ones, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (ones & ~(xh | pv))
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph = (ph << 1) | anchored
        mh <<= 1
        pv = (mh | ~(xv | ph)) & ones
        mv = ph & xv & ones
        if score < best:
            best, end = score, j
    return best, end


class ItemMatcher:
    """All items of one block, ready to be searched for in texts."""

    def __init__(self, items: list[tuple], rate: float):
        import ahocorasick

        self.items = [(key, text, budget(text, rate)) for key, text in items]
        self.masks: dict[int, tuple[dict, dict]] = {}
        found: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, (_, text, k) in enumerate(self.items):
            for offset, piece in pieces(text, k):
                found[piece].append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        if found:
            self.automaton.make_automaton()

    def _peq(self, i: int) -> tuple[dict, dict]:
        if i not in self.masks:
            text = self.items[i][1]
            self.masks[i] = masks(text), masks(text[::-1])
        return self.masks[i]

    def search(self, text: str) -> list[tuple]:
        """(item key, distance, start, end) of the best match of each item in a normalised text."""
        starts: dict[int, list[int]] = defaultdict(list)
        if text and len(self.automaton):
            for end, (n, places) in self.automaton.iter(text):
                for i, offset in places:
                    starts[i].append(end + 1 - n - offset)
        out = []
        for i, at in starts.items():
            key, item, k = self.items[i]
            exact = text.find(item)
            if exact >= 0:
                out.append((key, 0, exact, exact + len(item)))
                continue
            m, best = len(item), None
            for low, high in _joined(sorted(at), k):
                a, b = max(0, low - k), high + m + k
                d, end = best_match(self._peq(i)[0], m, text[a:b])
                if d <= k and (best is None or d < best[0]):
                    _, back = best_match(self._peq(i)[1], m, text[max(0, a + end - m - k):a + end][::-1], anchored=True)
                    best = (d, a + end - back, a + end)
            if best:
                out.append((key, *best))
        return out


def _joined(starts: list[int], k: int) -> list[tuple[int, int]]:
    """Runs of starts that are at most 2 k apart."""
    runs = [[starts[0], starts[0]]]
    for s in starts[1:]:
        if s - runs[-1][1] <= 2 * k:
            runs[-1][1] = s
        else:
            runs.append([s, s])
    return [tuple(r) for r in runs]


_MATCHERS: dict = {}


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    block, size = [], 0
    for r in items.select(F.col(id_col).alias("k"), F.col(text_col).cast("string").alias("t")).toLocalIterator():
        text = normalise(r["t"])
        if text:
            block.append((r["k"], text))
            size += len(text)
        if size >= BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


def _passes(docs: DataFrame, items: DataFrame, item_id: str, item_text: str, rate: float):
    """For each block of items, a function that gives its matcher inside a task."""
    sc = docs.sparkSession.sparkContext
    for block in _blocks(items, item_id, item_text):
        shared, token = sc.broadcast(block), uuid.uuid4().hex  # at most BLOCK characters and one item

        def matcher(shared=shared, token=token) -> ItemMatcher:
            if _MATCHERS.get("of") != token:  # one block at a time is kept in a worker
                _MATCHERS.update(of=token, matcher=ItemMatcher(shared.value, rate))
            return _MATCHERS["matcher"]

        yield matcher


def contaminated(docs: DataFrame, items: DataFrame, rate: float = RATE, id_col: str = "doc_id", text_col: str = "text",
                 item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each document and item that match: id_col, item_id, distance, span_start, span_end.
    A key named like another column of the result is an error: rename it before."""
    id_type, item_type = docs.schema[id_col].dataType, items.schema[item_id].dataType
    names = [id_col, item_id, "distance", "span_start", "span_end"]
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"keys clash with other columns of the result: {names}")
    types = [to_arrow_type(id_type), to_arrow_type(item_type)] + [pa.int64()] * 3
    schema = f"`{id_col}` {id_type.simpleString()}, `{item_id}` {item_type.simpleString()}, {MATCHES}"
    src = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    found = []
    for matcher in _passes(docs, items, item_id, item_text, rate):
        def match(batches: Iterator[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            search = matcher().search
            for batch in batches:
                rows = [(batch.column(0)[k].as_py(), *m) for k, text in enumerate(batch.column(1))
                        for m in search(normalise(text.as_py()))]
                columns = list(zip(*rows)) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        found.append(src.mapInArrow(match, schema))
    return reduce(DataFrame.union, found) if found else docs.sparkSession.createDataFrame([], schema)


def decontaminate(docs: DataFrame, items: DataFrame, rate: float = RATE, text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents that hold no passage of a test item, all columns kept (a filter, no join)."""
    for matcher in _passes(docs, items, item_id, item_text, rate):
        def clean(batches: Iterator[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            search = matcher().search
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index(text_col))
                yield batch.filter(pa.array([not search(normalise(t.as_py())) for t in texts], pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
