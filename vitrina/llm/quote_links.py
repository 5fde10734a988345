"""Quotation linking: conversations in reply order, without their quotes.

A line's quote level is the number of ``>`` marks before its text; lines of one level that follow
one another are a passage.  A message's own text is its lines of level 0, without the line that
introduces a quote ("... wrote:").  Text counts as its tokens in small letters (words, punctuation
marks; each CJK character is one), so line breaks and white space do not matter.  The units of a
passage are the passage as a whole, its lines and its sentences; those of a message are the same of its
own text.  A message has a unit of a passage if its own text contains the unit's tokens one after the
other, wherever it begins and ends.  A unit links to the nearest earlier message of its conversation
that has it.  A passage belongs to the message that has the whole passage (rather as a unit of its own,
like a line or a sentence, than inside one); where none has, to the message with most of its units
(ties: the later).  A message answers the message with most units of its passages of level 1.  Deeper
levels are linked in the same way.

Containment without pairs of messages: a unit's first tokens (at most ``ANCHOR``) are its anchor.  A bit
map of fixed size names the quoted anchors; a map over the own texts keeps the places where one may
stand, a join on (conversation, anchor) gives the lengths of the units that begin so, and the rolling
hash of exactly those windows is the unit's key.

The nearest earlier message is found by carrying the last original down the turns of (conversation,
key), in bounded buckets, so neither a long conversation nor a line that stands everywhere meets in
one task; only keys that some quote has take part.  Threads follow the answers upwards by pointer
doubling.

Reply order: sort by (conversation, thread, turn): a thread stands where its first message does,
and each answer follows what it answers.

Defined results: a lone part of a word is not found.  Lines and sentences without a word are no units of
their own.  NULL or empty text has no lines and an empty own text.  A message without quotes
keeps its text as it is.  NULL conversations or turns link with nothing (thread NULL for a NULL turn).
Rows that repeat (conversation, turn) are one message in links; each row is returned.  Quotes
without an original are removed like the others and link to nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitrina.operators.ordered import carry_last
from vitrina.session import materialize

_MARKS = re.compile(r"[ \t]*((?:>[ \t]?)+)")
# How mail programs introduce a quote.
_INTRO = re.compile(r"^\s*(?:on|am|le|el)\b.*\b(?:wrote|schrieb|a écrit|escribió)\b.*:\s*$", re.IGNORECASE)
_CJK = "\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af"
_TOKEN = re.compile(rf"[{_CJK}]|[^\W{_CJK}]+|[^\w\s]")
_SENTENCE = re.compile(r"(?<=[.!?…])\s+|(?<=[。！？])")
PARSED = ("body string, body_keys array<bigint>, quotes array<struct<level: int, passage: int, keys: array<bigint>, "
          "widths: array<int>, anchors: array<bigint>>>")
ANCHOR = 4  # tokens of a unit that are looked up in every place
MAP_BITS = 24  # the bit map of anchors takes 2 MB
_BASE, _PRIME = 0x1D8AF066F0D4D1B3, (1 << 61) - 1


def tokens_of(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


class Windows:
    """Hashes of any run of tokens (polynomial, modulo a prime) from the hashes of all prefixes."""

    def __init__(self, tokens: list[str]):
        import xxhash

        self.sums, self.powers, h, p = [0], [1], 0, 1
        for t in tokens:
            h = (h * _BASE + xxhash.xxh3_64_intdigest(t)) % _PRIME
            p = p * _BASE % _PRIME
            self.sums.append(h)
            self.powers.append(p)

    def key(self, at: int, width: int) -> int:
        return (self.sums[at + width] - self.sums[at] * self.powers[width]) % _PRIME


def units_of(lines: list[str]) -> list[tuple[int, int, int]]:
    """(key, tokens, key of the anchor) of the whole, which is the first, the lines and the sentences."""
    whole = tokens_of("\n".join(lines))
    if not whole:
        return []
    parts = [whole]
    for part in (*lines, *_SENTENCE.split(" ".join(lines))):
        tokens = tokens_of(part)
        if any(t[0].isalnum() for t in tokens):
            parts.append(tokens)
    out = {}
    for tokens in parts:
        w = Windows(tokens)
        out.setdefault(w.key(0, len(tokens)), (len(tokens), w.key(0, min(len(tokens), ANCHOR))))
    return [(k, *v) for k, v in out.items()]


def keys_of(lines: list[str]) -> list[int]:
    return [k for k, _, _ in units_of(lines)]


def parse(text: str | None) -> tuple[str, list[int], list[tuple[int, int, list[int], list[int], list[int]]]]:
    """(own text, its units' keys, [(level, passage, keys, tokens of each, anchors)])."""
    if not text:
        return "", [], []
    leveled = []
    for line in text.split("\n"):
        m = _MARKS.match(line)
        leveled.append((m[1].count(">"), line[m.end():]) if m else (0, line))
    if not any(level for level, _ in leveled):
        return text, keys_of([line for _, line in leveled]), []
    own, passages = [], []
    for k, (level, line) in enumerate(leveled):
        if level:
            if k and leveled[k - 1][0] == level:
                passages[-1][1].append(line)
            else:
                passages.append((level, [line]))
        elif not (_INTRO.match(line) and k + 1 < len(leveled) and leveled[k + 1][0]):
            own.append(line)
    quotes = []
    for i, (level, lines) in enumerate(passages):
        units = units_of(lines)
        quotes.append((level, i, *([u[k] for u in units] for k in range(3))))
    return "\n".join(own).strip("\n"), keys_of(own), quotes


def parse_messages(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("conv_id", "turn", "role")) -> DataFrame:
    """``keep`` columns with body, body_keys and quotes."""
    src = df.select(*(F.col(f"`{c}`") for c in keep), F.col(text_col).cast("string").alias("__text"))
    n = len(keep)
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), PARSED])
    quote = pa.list_(pa.struct([("level", pa.int32()), ("passage", pa.int32()), ("keys", pa.list_(pa.int64())),
                               ("widths", pa.list_(pa.int32())), ("anchors", pa.list_(pa.int64()))]))

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [parse(t.as_py()) for t in batch.column(n)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(n)), pa.array([r[0] for r in rows], pa.string()),
                 pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                 pa.array([[dict(zip(("level", "passage", "keys", "widths", "anchors"), q)) for q in r[2]] for r in rows], quote)],
                names=[*keep, "body", "body_keys", "quotes"])

    return src.mapInArrow(parsed, schema)


def _anchor_map(units: DataFrame, conv: str) -> bytes:
    """Bit map of the quoted anchors by conversation (at most 2 ** (MAP_BITS - 6) rows come to the driver)."""
    slot = F.xxhash64(conv).bitwiseXOR(F.col("anchor")).bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    rows = (units.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("bits")).collect())
    words = np.zeros(1 << (MAP_BITS - 6), "<i8")
    for r in rows:
        words[r["word"]] = r["bits"]
    return words.tobytes()


def _contained(known: DataFrame, units: DataFrame, conv: str, turn: str) -> DataFrame:
    """conv, turn, key of the quoted units that stand anywhere in a message's own text."""
    bits, low = _anchor_map(units, conv), (1 << MAP_BITS) - 1
    texts = known.join(units.select(conv).distinct(), conv, "left_semi").select(conv, turn, "body")
    head = ", ".join(f"`{c}` {known.schema[c].dataType.simpleString()}" for c in (conv, turn))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                tokens, salt = tokens_of(batch.column(2)[k].as_py()), batch.column(3)[k].as_py()
                windows, at, anchors = Windows(tokens), [], []
                for i in range(len(tokens)):
                    for n in range(1, min(ANCHOR, len(tokens) - i) + 1):
                        key = windows.key(i, n)
                        slot = (key ^ salt) & low
                        if bits[slot >> 3] >> (slot & 7) & 1:
                            at.append(i)
                            anchors.append(key)
                if at:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(c).take(pa.array([k] * len(at))) for c in (0, 1)] + [pa.array(at, pa.int32()), pa.array(anchors, pa.int64())],
                        names=[conv, turn, "at", "anchor"])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                tokens = tokens_of(batch.column(2)[k].as_py())
                windows = Windows(tokens)
                found = list({windows.key(x["at"], x["width"]) for x in batch.column(3)[k].as_py() if x["at"] + x["width"] <= len(tokens)})
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(c).take(pa.array([k] * len(found))) for c in (0, 1)] + [pa.array(found, pa.int64())],
                        names=[conv, turn, "key"])

    hits = texts.withColumn("salt", F.xxhash64(conv)).mapInArrow(places, f"{head}, at int, anchor bigint")
    hits = (hits.join(units.select(conv, "anchor", "width").distinct(), [conv, "anchor"])
            .groupBy(conv, turn).agg(F.collect_set(F.struct("at", "width")).alias("wanted")))
    return texts.join(hits, [conv, turn]).select(conv, turn, "body", "wanted").mapInArrow(keys, f"{head}, key bigint")


def quote_links(parsed: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """conv, turn, level, passage, source_turn, matched (its units there) of every passage with an original."""
    known = parsed.filter(F.col(conv).isNotNull() & F.col(turn).isNotNull())
    units = (known.select(conv, turn, F.explode("quotes").alias("q"))
             .select(conv, turn, "q.level", "q.passage", F.posexplode(F.arrays_zip("q.keys", "q.widths", "q.anchors")).alias("unit", "u"))
             .select(conv, turn, "level", "passage", (F.col("unit") == 0).alias("whole"), F.col("u.keys").alias("key"),
                     F.col("u.widths").alias("width"), F.col("u.anchors").alias("anchor")).distinct())
    units = materialize(units, "quote-units")
    quoted = (units.select(conv, turn, "level", "passage", "whole", "key")
              .withColumn("complete", F.explode(F.array(F.lit(True), F.lit(False)))))
    own = (known.select(conv, turn, F.explode("body_keys").alias("key")).withColumn("complete", F.lit(True))
           .unionByName(_contained(known, units, conv, turn).withColumn("complete", F.lit(False))).distinct())
    own = own.join(units.select(conv, "key").distinct(), [conv, "key"], "left_semi")
    nothing = {"level": "int", "passage": "int", "whole": "boolean"}
    rows = quoted.withColumn("source", F.lit(None).cast("long")).unionByName(
        own.select(conv, turn, *(F.lit(None).cast(t).alias(c) for c, t in nothing.items()), "key", "complete",
                   F.col(turn).cast("long").alias("source")))
    carried = carry_last(rows.withColumn(turn, F.col(turn).cast("long")), turn, F.col("source"), "source_turn",
                         by=[conv, "key", "complete"], strict=True)
    found = carried.filter("level IS NOT NULL AND source_turn IS NOT NULL")
    # One row for each unit and source first: a repeated passage or a unit found both ways counts once.
    found = found.groupBy(conv, turn, "level", "passage", "source_turn", "key").agg(
        F.max(F.when(F.col("whole"), F.when(F.col("complete"), 2).otherwise(1)).otherwise(0)).alias("full"))
    counts = found.groupBy(conv, turn, "level", "passage", "source_turn").agg(
        F.max("full").alias("full"), F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(conv, turn, "level", "passage").agg(F.max(F.struct("full", "n", "source_turn")).alias("b"))
    return best.select(conv, turn, "level", "passage", F.col("b.source_turn").alias("source_turn"), F.col("b.n").alias("matched"))


def replies(links: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """conv, turn, reply_to of every message that quotes an earlier one at level 1."""
    sums = links.filter("level = 1").groupBy(conv, turn, "source_turn").agg(F.sum("matched").alias("n"))
    best = sums.groupBy(conv, turn).agg(F.max(F.struct("n", "source_turn")).alias("b"))
    return best.select(conv, turn, F.col("b.source_turn").alias("reply_to"))


def threads(answers: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """conv, turn, reply_to, thread (first message above), depth (answers up to it)."""
    state = materialize(answers.select(conv, turn, "reply_to", F.col("reply_to").alias("thread"), F.lit(1).alias("depth")), "threads")
    while True:
        above = state.select(F.col(conv).alias("__c"), F.col(turn).alias("__t"), F.col("thread").alias("__up"), F.col("depth").alias("__d"))
        nxt = state.join(above, (F.col(conv) == F.col("__c")) & (F.col("thread") == F.col("__t")), "left")
        if nxt.filter("__up IS NOT NULL").isEmpty():
            return state
        state = materialize(nxt.select(conv, turn, "reply_to", F.coalesce("__up", "thread").alias("thread"),
                                       (F.col("depth") + F.coalesce("__d", F.lit(0))).alias("depth")), "threads")


def reply_ordered(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text_col: str = "text") -> DataFrame:
    """conv, turn, role, reply_to, thread, depth, n_quotes, text (without quotes) and chat (the
    message in chat form) of every row; sort by (conv, thread, turn) for reply order."""
    parsed = materialize(parse_messages(df, text_col, (conv, turn, role)), "messages")
    answers = threads(replies(quote_links(parsed, conv, turn), conv, turn), conv, turn)
    answers = answers.select(F.col(conv).alias("__c"), F.col(turn).alias("__t"), "reply_to", "thread", "depth")
    rows = parsed.join(answers, (F.col(conv) == F.col("__c")) & (F.col(turn) == F.col("__t")), "left")
    return rows.select(conv, turn, role, "reply_to", F.coalesce("thread", F.col(turn).cast("long")).alias("thread"),
                       F.coalesce("depth", F.lit(0)).alias("depth"), F.size("quotes").alias("n_quotes"),
                       F.col("body").alias("text"),
                       F.concat(F.lit("<|"), F.coalesce(role, F.lit("unknown")), F.lit("|>\n"), "body", F.lit("\n<|end|>")).alias("chat"))
