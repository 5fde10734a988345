"""HTML extraction by differencing pages with their nearest URL.

A page becomes text lines: one for each block element, character references decoded, white
space made one blank.  Lines know where they stand: inside an element that is never main text
(menus, headers and footers of the page, sidebars, forms, scripts, adverts, notices, comments: by
element or by class, id or role), inside the article element, or elsewhere.

Pages of a host are put in URL path order; each page is paired with the neighbour whose path
shares the longer prefix with its own.  The line sequences of the two are aligned by longest common
subsequence, and lines that both have are deleted: they belong to the site, not to the page.
An article that opens inside furniture ends it if the page leaves elements of that name open, except in
comments and related articles.  Where no article stands outside furniture, one inside a block that only its
class, id or role marks is the article.  Teasers of other articles are furniture, labels and buttons in
running text are left out of their line.  Every page is paired and
aligned; a check by markup follows on pages with an article element: lines inside it that the difference
took are given back, since an article that a site carries twice (copies, shared passages) must stay whole, and
lines outside it that the difference left (adverts and notices that change from page to page) go.

Pages are read first, one by one, and their lines written, packed, with a 64-bit hash of each line.  The keys of
all pages (host, path, page) are put in order by range partitions, which
spreads a large host over many tasks; the first and the last page of each range get their neighbour across the
bound from a table of two rows a range.  Then the hashes of the pages and of the neighbours chosen for
them meet by row and are aligned, and the places of shared lines meet the packed lines.  So html is never shuffled, the
text once, and the bounds of the ranges do not change the result.

Defined results: NULL or empty html gives empty text.  NULL URLs count as host and path "".
Repeated rows are pages of their own; a page whose whole content equals its pair's and that has no
article element keeps its lines (a copy is not boilerplate).
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator
from hashlib import blake2b
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from vitrina.llm.url_trees import host_of, path_of
from vitrina.session import materialize

# Elements of HTML by their part in a page.
RAW = ("script", "style", "noscript", "template", "textarea", "svg", "math", "iframe", "object", "canvas", "title")
NOISE = frozenset(("nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset", "head"))
INLINE_NOISE = frozenset(("button", "select", "label"))
INLINE = frozenset(("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em",
                    "font", "i", "img", "input", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small",
                    "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track",
                  "wbr"))
# Words of class, id and role values that mark page furniture.
MARKS = frozenset(("ad", "ads", "adv", "advert", "adverts", "advertisement", "banner", "sponsor", "sponsored", "promo",
                   "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "header", "footer", "sidebar",
                   "cookie", "cookies", "consent", "gdpr", "notice", "notices", "popup", "modal", "newsletter",
                   "subscribe", "signup", "login", "share", "sharing", "social", "related", "recommended", "widget",
                   "comment", "comments", "disqus", "respond", "reply", "replies", "complementary", "contentinfo",
                   "search", "toolbar", "pagination", "pager", "skip"))
TEASERS = frozenset(("teaser", "teasers", "excerpt", "preview"))  # marks of articles that announce another
# Marks of sections that hold article elements of other texts.
LISTS = frozenset(("comment", "comments", "disqus", "respond", "reply", "replies", "related", "recommended"))

_RAW = "|".join(RAW)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)"
    rf"|<({_RAW})\b[^>]*>.*?(?:</\1\s*>|$)"
    r"|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?=/?[a-zA-Z])[^>]*(?:>|$)", re.DOTALL | re.IGNORECASE)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORD = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def is_noise(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element holds no main text.  An article may have a header of its own."""
    if tag in INLINE_NOISE or tag in NOISE and not (in_article and tag == "header"):
        return True
    if tag in ("html", "body", "main") or not attributes:
        return False
    if tag == "article":
        return is_list(attributes, TEASERS)
    for values in _NAMED.findall(attributes):
        words = _WORD.findall(_CAMEL.sub(" ", "".join(values)).lower())
        if any(w in MARKS and not (in_article and w == "header") for w in words):
            return True
    return "hidden" in attributes.lower() and bool(re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", attributes.lower()))


def is_list(attributes: str, marks: frozenset = LISTS) -> bool:
    """Whether an element holds comments or related articles (or has other marks)."""
    return any(w in marks for values in _NAMED.findall(attributes)
               for w in _WORD.findall(_CAMEL.sub(" ", "".join(values)).lower()))


def never_closed(html: str, tag: str) -> bool:
    """Whether the page opens more elements of this name than it closes."""
    opened = sum(-1 if m[2] else 1 for m in _TOKEN.finditer(html)
                 if m[3] and m[3].lower() == tag and not (m[4] or "").endswith("/"))
    return opened > 0


def page_lines(html: str) -> tuple[list[tuple[str, bool]], bool]:
    """([(line, inside the article)], page has an article element); noise is left out."""
    found = _lines(html)
    if not found[1] and "<article" in html.lower():  # perhaps inside a block that is marked as furniture
        again = _lines(html, reach=True)
        if again[1]:
            return again
    return found


def _lines(html: str, reach: bool = False) -> tuple[list[tuple[str, bool]], bool]:
    """``page_lines``; with ``reach`` an article ends a block that only its attributes mark."""
    lines: list[tuple[str, bool]] = []
    text: list[str] = []
    noise: list[str] = []  # open elements from the outermost noise element on
    listed = 0  # place (from 1) in ``noise`` of the outermost section that holds other articles
    broken: dict[str, bool] = {}
    article = 0
    has_article = False

    def flush() -> None:
        line = " ".join(entities.unescape("".join(text)).split())
        text.clear()
        if line:
            lines.append((line, article > 0))

    at = 0
    for m in _TOKEN.finditer(html):
        if not noise and m.start() > at:
            text.append(html[at:m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        closing = m[2] == "/"
        if noise:  # wait for the end of the noise element
            if closing:
                if tag in noise:
                    while noise.pop() != tag:
                        pass
                elif tag in ("article", "body", "html"):
                    noise.clear()
            elif tag not in VOID and not m[4].endswith("/") and tag not in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
                if not listed and is_list(m[4]):
                    listed = len(noise) + 1
                if tag == "article" and not listed and not is_noise(tag, m[4], False):
                    if reach and noise[0] not in NOISE and noise[0] != "article":
                        broken[noise[0]] = True
                    if noise[0] not in broken:
                        broken[noise[0]] = never_closed(html, noise[0])
                    if broken[noise[0]]:  # the article does not belong to the furniture
                        noise.clear()
                if noise:
                    noise.append(tag)
            if len(noise) < listed:
                listed = 0
            if noise:
                continue
        if tag in INLINE:
            if tag == "br":
                text.append(" ")
            continue
        if tag in INLINE_NOISE:
            if not closing and not m[4].endswith("/"):
                noise.append(tag)
                listed = 0
                text.append(" ")
            continue
        flush()
        if tag == "article" and (closing or not is_noise(tag, m[4] or "", False)):
            article = max(0, article - 1) if closing else article + 1
            has_article = True
        elif not closing and tag not in VOID and is_noise(tag, m[4] or "", article > 0):
            noise.append(tag)
            listed = int(is_list(m[4] or ""))
    if not noise:
        text.append(html[at:])
    flush()
    return lines, has_article


def _lcs_bits(mine: list[int], where: dict[int, int], width: int) -> np.ndarray:
    """Lengths of the longest common subsequence of ``mine`` with each prefix (0 to ``width``) of a
    sequence whose places of each line are the bits of ``where`` (bit-parallel dynamic programming)."""
    full = (1 << width) - 1
    v = full
    for line in mine:
        u = v & where.get(line, 0)
        if u:
            v = ((v + u) | (v - u)) & full
    bits = np.unpackbits(np.frombuffer(v.to_bytes(width // 8 + 1, "little"), np.uint8), bitorder="little")[:width]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _places(lines: list[int]) -> dict[int, int]:
    by_line: dict[int, bytearray] = {}
    for j, line in enumerate(lines):
        by_line.setdefault(line, bytearray(len(lines) // 8 + 1))[j >> 3] |= 1 << (j & 7)
    return {line: int.from_bytes(bits, "little") for line, bits in by_line.items()}


def shared_lines(mine: list, other: list) -> set[int]:
    """Places in ``mine`` (lines or their hashes) that a longest common subsequence with ``other`` matches.

    Equal beginnings and ends are matched first; between them Hirschberg's halving, with bit
    vectors for the lengths: memory is linear in the lines, whatever repeats."""
    number = {line: k for k, line in enumerate(dict.fromkeys(other))}
    a, b = [number.get(line, -1 - k) for k, line in enumerate(mine)], [number[line] for line in other]
    out: set[int] = set()
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i2, j, j2 = todo.pop()
        while i < i2 and j < j2 and a[i] == b[j]:
            out.add(i)
            i, j = i + 1, j + 1
        while i < i2 and j < j2 and a[i2 - 1] == b[j2 - 1]:
            i2, j2 = i2 - 1, j2 - 1
            out.add(i2)
        if i >= i2 or j >= j2:
            continue
        if i2 - i == 1:
            if a[i] in b[j:j2]:
                out.add(i)
            continue
        half, part = (i + i2) // 2, b[j:j2]
        before = _lcs_bits(a[i:half], _places(part), len(part))
        after = _lcs_bits(a[half:i2][::-1], _places(part[::-1]), len(part))
        cut = int(np.argmax(before + after[::-1]))
        todo += [(i, half, j, j + cut), (half, i2, j + cut, j2)]
    return out


def common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((k for k in range(n) if a[k] != b[k]), n)


LINES = "row bigint, packed binary, inside array<boolean>, marks array<bigint>, article boolean"
NEAR = ("row bigint, near bigint, part int, place int, host string, path string, before bigint, before_path string, "
        "after bigint, after_path string")
CHUNK = 64  # pages of a batch that are worked on at once


def extract_pages(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), url_col: str = "url",
                  html_col: str = "html", order_col: str = "page_id") -> DataFrame:
    """``keep`` columns, text, n_chars (its code points) and n_shared (lines that the paired page shares)."""
    keep = tuple(c for c in keep if c not in ("text", "n_chars", "n_shared"))
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    names = [*(f"__k{i}" for i in range(len(keep))), "__order", "__host", "__path"]
    src = pages.select(*(F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(keep)), F.col(order_col).alias("__order"),
                       host_of(url).alias("__host"), path_of(url).alias("__path"), F.col(html_col).cast("string").alias("__html"))
    fields = [f"{n} {src.schema[n].dataType.simpleString()}" for n in names]
    read = materialize(src.mapInArrow(_read(len(names)), ", ".join([*fields, LINES])), "page-lines")
    near = read.select(F.col("row").alias("near"), F.col("marks").alias("near_marks"))
    pairs = _neighbours(read).join(read.select("row", "marks"), "row").join(near, "near")
    shared = pairs.select("row", "marks", "near_marks").mapInArrow(_align, "row bigint, shared array<int>")
    rows = read.join(shared, "row", "left").select(*names[:len(keep)], "packed", "inside", "article", "shared")
    decided = rows.mapInArrow(_decide(len(keep)), ", ".join([*fields[:len(keep)], "text string, n_chars bigint, n_shared bigint"]))
    return decided.select(*(F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)), "text", "n_chars", "n_shared")


def _mark(line: str) -> int:
    return int.from_bytes(blake2b(line.encode(), digest_size=8).digest(), "little", signed=True)


def _read(n: int):
    """The lines of each page, which hold no line breaks, in one packed piece; ``row`` numbers the pages of the
    written table."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in (b.slice(at, CHUNK) for b in batches for at in range(0, b.num_rows, CHUNK)):
            found = [page_lines(html.as_py() or "") for html in batch.column(n)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], pa.array(range(row, row + batch.num_rows), pa.int64()),
                 pa.array([zlib.compress("\n".join(t for t, _ in lines).encode(), 6) for lines, _ in found], pa.binary()),
                 pa.array([[x for _, x in lines] for lines, _ in found], pa.list_(pa.bool_())),
                 pa.array([[_mark(t) for t, _ in lines] for lines, _ in found], pa.list_(pa.int64())),
                 pa.array([article for _, article in found], pa.bool_())],
                names=[*batch.schema.names[:n], "row", "packed", "inside", "marks", "article"])
            row += batch.num_rows

    return read


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The places of each page's lines that its neighbour shares."""
    for batch in (b.slice(at, CHUNK) for b in batches for at in range(0, b.num_rows, CHUNK)):
        places = [sorted(shared_lines(mine, near)) for mine, near in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(places, pa.list_(pa.int32()))], names=["row", "shared"])


def _neighbours(read: DataFrame) -> DataFrame:
    """(row, near): of each page the neighbour of its host whose path shares the longer prefix (ties: the one before); pages of one path are ordered by page, then row."""
    keys = read.select("__host", "__path", "__order", "row")
    order = ["__host", "__path", "__order", "row"]
    near = materialize(keys.repartitionByRange(*order).sortWithinPartitions(*order)
                       .select("__host", "__path", "row").mapInArrow(_beside, NEAR), "page-keys")
    bounds = Window.orderBy("part", "place")  # two rows a range
    edges = near.filter("place IS NOT NULL").select(
        "*", *(f(c).over(bounds).alias(f"{side}_{c}") for side, f in (("b", F.lag), ("a", F.lead)) for c in ("row", "host", "path")))
    beyond = {"before": ("b", F.col("place").isin(0, 2) & (F.col("b_host") == F.col("host"))),
              "after": ("a", F.col("place").isin(1, 2) & (F.col("a_host") == F.col("host")))}
    edges = edges.select("row", "path", *(F.coalesce(name, F.when(there, F.col(f"{side}_{c}"))).alias(name)
                                          for at, (side, there) in beyond.items() for name, c in ((at, "row"), (f"{at}_path", "path"))))
    chosen = edges.mapInArrow(_choose, "row bigint, near bigint")
    return near.filter("place IS NULL").select("row", "near").union(chosen).filter("near IS NOT NULL")


def _beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The neighbour of each page inside one range; of the range's ends (place 0: the first, 1: the last, 2: both)
    what is beside them, since they may have another beyond it."""
    part = TaskContext.get().partitionId()

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    def result(before: tuple | None, page: tuple, after: tuple | None) -> tuple:
        host, path, row = page
        place = (2 if after is None else 0) if before is None else 1 if after is None else None
        sides = [(x[2], x[1]) if x is not None and x[0] == host else (None, None) for x in (before, after)]
        if place is None:
            return row, nearest(path, *sides), part, *[None] * 7
        return row, None, part, place, host, path, *sides[0], *sides[1]

    def results() -> Iterator[tuple]:
        before = page = None
        for after in chain(rows(), [None]):
            if page is not None:
                yield result(before, page, after)
            before, page = page, after

    fields = [f.split() for f in NEAR.split(", ")]
    types = [_TYPES[t] for _, t in fields]
    out: list[tuple] = []
    for r in results():
        out.append(r)
        if len(out) == 5000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=[n for n, _ in fields])
            out.clear()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=[n for n, _ in fields])


_TYPES = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}


def nearest(path: str, *sides: tuple[int | None, str | None]) -> int | None:
    """The first of the (row, path) whose path shares the longest prefix."""
    found = [(common_prefix(other, path), row) for row, other in sides if row is not None]
    return max(found, key=lambda x: x[0])[1] if found else None


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        near = [nearest(r["path"], (r["before"], r["before_path"]), (r["after"], r["after_path"])) for r in batch.to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("row")), pa.array(near, pa.int64())],
                                         names=["row", "near"])


def _decide(n: int):
    """The text of each page: the lines that its neighbour does not share, set right by the article element."""
    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, CHUNK) for b in batches for at in range(0, b.num_rows, CHUNK)):
            texts, counts = [], []
            for packed, inside, article, shared in zip(*(c.to_pylist() for c in batch.columns[n:])):
                lines = zlib.decompress(packed).decode().split("\n") if inside else []
                gone = set(shared or ())
                counts.append(len(gone))
                if article:
                    left = [x for x, within in zip(lines, inside) if within]
                else:
                    left = lines if len(gone) == len(lines) else [x for k, x in enumerate(lines) if k not in gone]
                texts.append("\n\n".join(left))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()),
                                              pa.array(counts, pa.int64())],
                                             names=[*batch.schema.names[:n], "text", "n_chars", "n_shared"])

    return decide
