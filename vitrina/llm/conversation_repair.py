"""Conversation structure repair: the cheapest edits that make roles alternate.

A repaired conversation's role initials are empty or an optional ``s`` and then ``ua`` once or more.
Edits by message, in turn order: Keep (0), Rerole to user or assistant (3), Delete (4; the only one
for blank and duplicate messages); anywhere: Insert an empty user or assistant message (3).  A
truncated message that is not deleted adds 3.  Of equally cheap edits the ASCII-least sequence of
initials (D, I, K, R) wins.

Viterbi with survivor coalescence: for each of the four states of the role pattern the best path so
far survives.  Paths are leaves of a backpointer tree whose nodes count their references; a node
without any is let go, and as soon as all survivors share an ancestor everything up to it is emitted.
A state that another one beats by more than any future could win back is let go too, so that
survivors meet soon; what is kept is the unresolved suffixes, never the conversation.  Ties are
decided on the complete unresolved suffixes: of each two survivors the tree keeps where they first
differ (same cost and state never leave one a prefix of the other: an edit sequence determines
its state and cost).

Each conversation is one ordered stream (its hash is sequential by nature) read by one task in
batches; a hot conversation costs time there, not memory.  Which message repeats an earlier
one is found before, by a shuffle on the digest (salted by turn), and merged into the stream.

Defined results: NULL role or text counts as one blank, NULL turns come first, equal turns are
ordered by role and text; NULL conversation keys are one conversation; a role without characters
has no initial and cannot be kept.  An empty table gives no rows.  Further columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # Fixed values: costs
EMPTY, SYSTEM, USER, DONE = range(4)  # nothing yet; after s; after u; after a
NEXT_ROLE = {EMPTY: "user", SYSTEM: "user", USER: "assistant", DONE: "user"}
AFTER = {"user": USER, "assistant": DONE}
KEEPS = {("s", EMPTY): SYSTEM, ("u", EMPTY): USER, ("u", SYSTEM): USER, ("u", DONE): USER, ("a", USER): DONE}
LEGAL = {"su", "ua", "au"}
_INK = re.compile(r"[^\x20\x09-\x0D]")
_SPACE = " \t\n\x0b\x0c\r"
SALTS = 16


class Node:
    """A run of edits after ``parent``; ``refs`` counts children and the survivor that ends here."""

    __slots__ = ("parent", "edits", "refs", "children")

    def __init__(self, parent: Node | None):
        self.parent, self.edits, self.refs, self.children = parent, [], 0, set()
        if parent is not None:
            parent.refs += 1
            parent.children.add(self)


class Survivors:
    """The best path into each state, and what is already decided."""

    def __init__(self, emit, hashed: bool = False):
        self.emit = emit  # called with each decided edit: (initial, role, text)
        self.root = Node(None)
        self.root.refs = 1
        self.cost: dict[int, int] = {EMPTY: 0}
        self.leaf: dict[int, Node] = {EMPTY: self.root}
        self.tails: dict[tuple[int, int], tuple[str, str]] = {}  # of two states: where their paths first differ
        self.hashes = {EMPTY: (hashlib.sha256(), False)} if hashed else None

    def _before(self, a: tuple, b: tuple) -> bool:
        """Whether candidate a's edits come before b's; a candidate is (cost, state, edits after it)."""
        mine, other = self._tail(a[1], b[1])
        return mine + "".join(e[0] for e in a[2]) < other + "".join(e[0] for e in b[2])

    def _tail(self, p: int, q: int) -> tuple[str, str]:
        if p == q:
            return "", ""
        if p < q:
            return self.tails[p, q]
        return self.tails[q, p][::-1]

    def _choose(self, best: dict, state: int, candidate: tuple) -> None:
        old = best.get(state)
        if old is None or candidate[0] < old[0] or candidate[0] == old[0] and self._before(candidate, old):
            best[state] = candidate

    def _with_inserts(self) -> dict[int, tuple]:
        """Best (cost, state, inserts) into each state after at most two inserts (more never pay)."""
        best = {s: (c, s, ()) for s, c in self.cost.items()}
        for _ in range(2):
            for state, (cost, origin, edits) in list(best.items()):
                role = NEXT_ROLE[state]
                self._choose(best, AFTER[role], (cost + INSERT, origin, (*edits, ("I", role, ""))))
        return best

    def step(self, role: str, text: str, required: bool, truncated: bool) -> None:
        """One message; ``required``: it must be deleted."""
        best: dict[int, tuple] = {}
        initial, more = role[:1], TRUNCATED * truncated
        for state, (cost, origin, edits) in self._with_inserts().items():
            self._choose(best, state, (cost + DELETE, origin, (*edits, ("D", role, text))))
            if not required:
                kept = KEEPS.get((initial, state))
                if kept is not None:
                    self._choose(best, kept, (cost + KEEP + more, origin, (*edits, ("K", role, text))))
                new = NEXT_ROLE[state]
                self._choose(best, AFTER[new], (cost + REROLE + more, origin, (*edits, ("R", new, text))))
        done = best.get(DONE)
        if done:  # what these states can still gain over DONE: keeping a system message; nothing
            for state, gain in ((EMPTY, DELETE - KEEP), (SYSTEM, 0)):
                if state in best and done[0] + gain < best[state][0]:
                    del best[state]
        self._advance(best)

    def _advance(self, best: dict[int, tuple]) -> None:
        states = sorted(best)
        tails = {}
        for k, p in enumerate(states):
            for q in states[k + 1:]:
                x, y = self._tail(best[p][1], best[q][1])
                x += "".join(e[0] for e in best[p][2])
                y += "".join(e[0] for e in best[q][2])
                same = 0
                while same < len(x) and same < len(y) and x[same] == y[same]:
                    same += 1
                x, y = x[same:], y[same:]
                tails[p, q] = (x[0], y[0]) if x and y else (x, y)
        heirs: dict[int, int] = {}
        for _, origin, _ in best.values():
            heirs[origin] = heirs.get(origin, 0) + 1
        leaf, hashes = {}, {}
        for state, (_, origin, edits) in best.items():
            node = self.leaf[origin]
            if heirs[origin] > 1:
                node = Node(node)
                node.refs += 1
            node.edits.extend(edits)
            leaf[state] = node
            if self.hashes is not None:
                hashes[state] = _hash_on(self.hashes[origin], edits)
        for state, node in self.leaf.items():
            if heirs.get(state, 0) != 1:  # no longer an end: its heirs hold it now, or nobody does
                self._release(node)
        self.cost, self.leaf, self.tails = {s: b[0] for s, b in best.items()}, leaf, tails
        if self.hashes is not None:
            self.hashes = hashes
        self._emit_shared()

    def _release(self, node: Node | None) -> None:
        while node is not None:
            node.refs -= 1
            if node.refs:
                return
            parent = node.parent
            if parent is not None:
                parent.children.discard(node)
            node = parent

    def _emit_shared(self) -> None:
        """Emit what all survivors share: the root's edits, down to where paths part."""
        while True:
            root = self.root
            for edit in root.edits:
                self.emit(edit)
            if len(self.leaf) > 1 and root.refs == 1 and root.children:
                (self.root,) = root.children
                self.root.parent = None
                continue
            if len(self.leaf) == 1:
                root.edits = []
                (only,) = self.leaf.values()
                if only is not root:
                    (self.root,) = root.children
                    self.root.parent = None
                    continue
            root.edits = []
            return

    def unresolved(self) -> int:
        """How many edits the tree holds."""
        total, open_nodes = 0, [self.root]
        while open_nodes:
            node = open_nodes.pop()
            total += len(node.edits)
            open_nodes.extend(node.children)
        return total

    def finish(self) -> int:
        """Decide everything; the cost."""
        best = self._with_inserts()
        ends = [best[s] for s in (EMPTY, DONE) if s in best]
        winner = ends[0]
        for other in ends[1:]:
            if other[0] < winner[0] or other[0] == winner[0] and self._before(other, winner):
                winner = other
        self._advance({DONE if winner in (best.get(DONE),) else EMPTY: winner})
        return winner[0]

    def sha256(self) -> str:
        (state, _), = self.hashes.values()
        return state.hexdigest()


def _hash_on(before: tuple, edits: tuple) -> tuple:
    """(hash, whether it has a message) after some edits; hashes are never changed, only copied."""
    state, begun = before
    for initial, role, text in edits:
        if initial != "D":
            state = state.copy()
            state.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
            begun = True
    return state, begun


def damaged(df: DataFrame) -> DataFrame:
    """Conversations with seeded damage: by crc32 of ``conv_id:turn`` modulo 20, 0 drops a message (it
    stays as a row with ``dropped``), 1 empties its text, 2 removes its stop marks, 3 repeats it, 4 makes it the user's."""
    def or_blank(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(or_blank("conv_id"), F.lit(":"), or_blank("turn")).cast("binary")) % 20
    rows = df.select("conv_id", "turn", or_blank("role").alias("role"), or_blank("text").alias("text"), kind.alias("kind"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("dropped"),
        F.explode(F.expr("if(kind = 3, array(1, 2), array(1))")).alias("copy")).drop("copy")


def _repeats(rows: DataFrame) -> DataFrame:
    """(conv, turn, digest) of the messages whose role and text an earlier turn of the conversation has."""
    seen = rows.groupBy("conv", "digest", "turn").agg(F.lit(1).alias("one"))  # copies first: no row is hot after it
    firsts = (seen.groupBy("conv", "digest")
              .agg(F.count("*").alias("turns"), F.min("turn").alias("first"), F.max(F.col("turn").isNull()).alias("no_turn"))
              .filter("turns > 1")
              .select(F.col("conv").alias("c"), F.col("digest").alias("d"), F.expr("if(no_turn, null, first)").alias("first"),
                      F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s")))
    salted = seen.withColumn("salt", F.pmod(F.hash("turn"), F.lit(SALTS)))
    return (salted.join(firsts, F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))
                        & (F.col("salt") == F.col("s")))
            .filter(~F.col("turn").eqNullSafe(F.col("first"))).select("conv", "turn", "digest"))


def _ordered(df: DataFrame) -> DataFrame:
    """One ordered stream for each conversation: notes of repeats, then the messages, of each turn."""
    rows = df.select(F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"),
                     F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                     F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
                     (F.col("dropped") if "dropped" in df.columns else F.lit(False)).alias("dropped"))
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    notes = _repeats(rows.filter(~F.col("dropped")).select("conv", "turn", digest.alias("digest")))
    none = F.lit(None)
    stream = (rows.withColumn("note", none.cast("binary"))
              .unionByName(notes.select("conv", "turn", none.cast("string").alias("role"), none.cast("string").alias("text"),
                                        F.lit(False).alias("dropped"), F.col("digest").alias("note"))))
    return stream.repartition("conv").sortWithinPartitions("conv", "turn", F.col("note").isNull(), "dropped", "role", "text")


class _Conversation:
    """Reads one conversation's stream: counts its faults and feeds the survivors."""

    def __init__(self, emit, hashed: bool):
        self.paths = Survivors(emit, hashed)
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = None
        self.last: tuple | None = None  # (turn, role, text) of the message before
        self.note_turn, self.notes = None, set()

    def note(self, turn: int | None, digest: bytes) -> None:
        if self.note_turn != turn:
            self.note_turn, self.notes = turn, set()
        self.notes.add(digest)

    def message(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            if self.high != turn:
                self.turns += 1
            self.low, self.high = (turn if self.low is None else self.low), turn
        if self.last is not None and self.last[1][:1] + role[:1] not in LEGAL:
            self.illegal += 1
        ink = text.rstrip(_SPACE)
        blank = not ink
        repeated = not blank and (self.last == (turn, role, text) or turn is not None and turn == self.note_turn and
                                  hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest() in self.notes)
        cut = not blank and not repeated and ink[-1] not in ".!?"
        self.blank += blank
        self.duplicate += repeated
        self.truncated += cut
        self.last = (turn, role, text)
        self.paths.step(role, text, blank or repeated, cut)

    def gaps(self) -> int:
        return self.high - self.low + 1 - self.turns if self.turns else 0


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of the stream, a few at a time, so that long texts are not unpacked all at once."""
    for batch in batches:
        for k in range(0, batch.num_rows, 200):
            yield from zip(*(column.to_pylist() for column in batch.slice(k, 200).columns))


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair_summaries(df: DataFrame) -> DataFrame:
    """One row for each conversation of ``df`` (conv_id, turn, role, text and perhaps ``dropped``: such
    rows only name their conversation): gaps, blank, duplicate, truncated, illegal, cost, audit (the
    initials of the edits) and repaired_sha256 (``role:text`` of the repaired messages, one a line).

    Every survivor carries the hash of its own messages, so no text waits for its decision."""
    kind = df.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, " + ", ".join(f"{c} bigint" for c in _COUNTS) + ", audit string, repaired_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        conv = talk = audit = conv_type = None

        def typed(batches):
            nonlocal conv_type
            for batch in batches:
                conv_type = batch.schema.field(0).type
                yield batch

        def close() -> None:
            cost = talk.paths.finish()
            out.append((conv, talk.gaps(), talk.blank, talk.duplicate, talk.truncated, talk.illegal, cost,
                        "".join(audit), talk.paths.sha256()))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out))
            types = [conv_type, *[pa.int64()] * len(_COUNTS), pa.string(), pa.string()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                              names=["conv_id", *_COUNTS, "audit", "repaired_sha256"])

        for key, turn, role, text, dropped, note in _stream(typed(batches)):
            if talk is None or key != conv:
                if talk is not None:
                    close()
                    if len(out) >= 1000:
                        yield flush()
                conv, audit = key, []
                parts = audit
                talk = _Conversation(lambda edit, parts=parts: parts.append(edit[0]), hashed=True)
            if note is not None:
                talk.note(turn, note)
            elif not dropped:
                talk.message(turn, role, text)
        if talk is not None:
            close()
        if out:
            yield flush()

    return _ordered(df).mapInArrow(run, schema)


def repair_conversations(df: DataFrame) -> DataFrame:
    """The edits with their messages, as they are decided: conv_id, place (from 0, in order), edit
    (D, I, K or R), role and text.  Without the D rows they are the repaired conversations."""
    kind = df.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "place", "edit", "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        conv = talk = conv_type = None
        place = size = 0

        def typed(batches):
            nonlocal conv_type
            for batch in batches:
                conv_type = batch.schema.field(0).type
                yield batch

        def emit(edit: tuple) -> None:
            nonlocal place, size
            out.append((conv, place, *edit))
            place += 1
            size += len(edit[2]) + 50

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out))
            types = [conv_type, pa.int64(), pa.string(), pa.string(), pa.string()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for key, turn, role, text, dropped, note in _stream(typed(batches)):
            if talk is None or key != conv:
                if talk is not None:
                    talk.paths.finish()
                conv, place = key, 0
                talk = _Conversation(emit, hashed=False)
            if note is not None:
                talk.note(turn, note)
            elif not dropped:
                talk.message(turn, role, text)
            if size > 4_000_000:
                yield flush()
                size = 0
        if talk is not None:
            talk.paths.finish()
        if out:
            yield flush()

    return _ordered(df).mapInArrow(run, f"conv_id {kind}, place bigint, edit string, role string, text string")
