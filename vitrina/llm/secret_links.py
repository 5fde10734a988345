"""Secret scans: multipart credentials linked by interval joins.

*Base* spans are reported wherever they are: assignments of a password, secret, token or API key,
access identifiers, long hexadecimal strings.  A credential also has parts that mean nothing alone:
a user name or key id, a pass phrase or a random-looking string, an address to use them at.  Such
*weak* candidates are reported only where complementary parts co-occur: within ``WINDOW`` code
points of each other and inside one scope (a run of lines without a blank line between them).

    identifiers  access (base), id                  need a secret
    secrets      assign, hex (base), pass, mixed    need an identifier
    endpoints    url, host                          need an identifier and a secret

The join is an interval join on the sorted spans of a scope: a candidate's range, widened by the window
and cut at its scope, meets a part if the parts that start before the range's end reach beyond its
beginning (one binary search on the running maximum of their ends), so its cost does not grow
with the number of pairs.  A weak candidate that overlaps a candidate of an earlier kind is that kind's text and
falls away.  A scope lies inside one text, so the scan is a map over the rows: no shuffle.

Defined results: a NULL or empty text has no spans.  Spans count code points, end exclusive, and come
by start, then kind in the order of ``KINDS``.  Keys pass through, NULL and repeated ones too; an empty
table gives no rows.  Patterns are ASCII: only A-Z fold to a-z.  A task holds one text's spans.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

WINDOW = 200


def either_case(pattern: str) -> str:
    """The pattern with every letter outside brackets and escapes in either case."""
    return re.sub(r"\[[^\]]*\]|\\x[0-9a-f]{2}|\\.|\?:|[a-z]",
                  lambda m: f"[{m[0]}{m[0].upper()}]" if len(m[0]) == 1 else m[0], pattern)


_SET = r"""["']?\x20*[:=]\x20*["']?"""
# Kinds in report order with their patterns; the base kinds are the contract's.
PATTERNS = {
    "assign": either_case("(password|passwd|secret|token|api_?key)") + _SET + "([A-Za-z0-9+/_.=-]+)",
    "access": "AKIA[A-Z0-9]{16,}",
    "hex": "[0-9a-f]{24,}",
    "id": either_case(r"\b(?:user_?name|user|login|account|client_?id|access_?key_?id|key_?id)") + _SET + "[A-Za-z0-9+/_.@-]{3,}",
    "pass": either_case(r"\b(?:pass_?phrase|pass|pwd|access_?key|private_?key|auth|credential)") + _SET + "[A-Za-z0-9+/_.=!$%@-]{4,}",
    "mixed": "[A-Za-z0-9+/_=-]{16,}",
    "url": r"\b(?:https?|ftp|s3|jdbc:[a-z]+|postgres|postgresql|mysql|mongodb|redis|amqp)://[A-Za-z0-9][^\x20\x09-\x0D\"'<>]*",
    "host": either_case(r"\b(?:endpoint|hostname|host|server|bucket|region)") + _SET + "[A-Za-z0-9._:/-]{3,}",
}
KINDS = tuple(PATTERNS)
BASE = ("assign", "access", "hex")
IDENTIFIERS, SECRETS, ENDPOINTS = ("access", "id"), ("assign", "hex", "pass", "mixed"), ("url", "host")
MIN_VALUE = 6  # characters of an assigned value
MIN_DISTINCT = 8  # different characters of a mixed string, which has A-Z, a-z and 0-9
BREAK = r"\n[\x20\t\r]*\n"
# A text without any of these strings (in lower case) has no match of the kind.
_NEEDS = {"assign": ("passw", "secret", "token", "apikey", "api_key"), "access": ("akia",),
          "id": ("user", "login", "account", "client", "key"), "pass": ("pass", "pwd", "key", "auth", "credential"),
          "url": ("://",), "host": ("endpoint", "host", "server", "bucket", "region")}
_RULES = {kind: re.compile(pattern, re.ASCII) for kind, pattern in PATTERNS.items()}
_BREAK = re.compile(BREAK)


def raw_spans(kind: str, text: str, lowered: str) -> list[tuple[int, int]]:
    """All candidates of one kind, leftmost and not overlapping."""
    needs = _NEEDS.get(kind)
    if needs and not any(s in lowered for s in needs):
        return []
    found = _RULES[kind].finditer(text)
    if kind == "assign":
        return [m.span() for m in found if len(m[2]) >= MIN_VALUE]
    if kind == "mixed":
        return [m.span() for m in found if len(set(m[0])) >= MIN_DISTINCT and re.search("[a-z]", m[0])
                and re.search("[A-Z]", m[0]) and re.search("[0-9]", m[0])]
    return [m.span() for m in found]


class Parts:
    """Spans of some kinds, to be asked whether one of them meets a range."""

    def __init__(self, spans: list[tuple[int, int]]):
        spans = sorted(spans)
        self.starts = [s for s, _ in spans]
        self.reach = list(accumulate((e for _, e in spans), max))

    def meets(self, low: int, high: int) -> bool:
        """Whether a span has start <= high and end >= low."""
        k = bisect_right(self.starts, high)
        return k > 0 and self.reach[k - 1] >= low


def find_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all reported spans of one text."""
    lowered = text.lower()
    spans = {kind: raw_spans(kind, text, lowered) for kind in BASE}
    out = [(s, e, KINDS.index(kind)) for kind in BASE for s, e in spans[kind]]
    spans["id"] = raw_spans("id", text, lowered)
    if spans["access"] or spans["id"]:  # without an identifier no weak candidate has all it needs
        raw = [(s, e) for kind in BASE for s, e in spans[kind]]
        for kind in KINDS[3:]:
            mine = spans["id"] if kind == "id" else raw_spans(kind, text, lowered)
            earlier = Parts(raw)
            spans[kind] = [(s, e) for s, e in mine if not earlier.meets(s + 1, e - 1)]
            raw += mine
        breaks = [m.span() for m in _BREAK.finditer(text)]
        begins, ends = [0, *(e for _, e in breaks)], [*(s for s, _ in breaks), len(text)]
        identifiers, secrets = (Parts([x for k in kinds for x in spans[k]]) for kinds in (IDENTIFIERS, SECRETS))
        for kind in KINDS[3:]:
            needed = [p for p, own in ((identifiers, IDENTIFIERS), (secrets, SECRETS)) if kind not in own]
            for s, e in spans[kind]:
                scope = bisect_right(begins, s) - 1
                low, high = max(s - WINDOW, begins[scope]), min(e + WINDOW, ends[bisect_left(ends, e)])
                if all(p.meets(low, high) for p in needed):
                    out.append((s, e, KINDS.index(kind)))
    return [(s, e, KINDS[k]) for s, e, k in sorted(out, key=lambda x: (x[0], x[2]))]


def linked_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and spans: an array of (kind, start, end) of each text."""
    kind = df.schema[id_col].dataType.simpleString()
    src = df.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                some = batch.slice(k, 500)
                rows = [[{"kind": name, "start": s, "end": e} for s, e, name in find_spans(text.as_py())]
                        if text.is_valid else [] for text in some.column(1)]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(rows, span)], names=[id_col, "spans"])

    return src.mapInArrow(scan, f"`{id_col}` {kind}, spans array<struct<kind string, start bigint, end bigint>>")


def span_digest(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans as text, from ``linked_secrets``."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    base = of(*BASE)
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
