"""Cross-tokenizer alignment: which tokens of tokenizer A and of tokenizer B cover the same bytes.

A is byte-level BPE and reads blank + text; B is a sentencepiece BPE model that puts the blank
before the text itself, so both cover the same bytes.  Where a token of A and a token of B end at
the same byte, a *group* ends.  Every A token and B token whose byte ranges overlap are *linked*.

Identity map: ``identity_map`` gives for each A id the B id with the same bytes.  A group of one A
token and one B token that the map already names is counted in a vector as long as A's vocabulary
(one sum of vectors over the corpus).  Only the other groups' links enter the shuffle by pair.

Both tokenizers break at a blank between two characters that are not white space, so texts are cut
there, and the alignment of each distinct piece (blank + word) is computed once while it stays in
a cache of bounded size.  One pass writes, for blocks of documents, the words of each document,
the block's distinct pieces and its distinct irregular pairs; the pair counts of the corpus
come back to each block by (A id, B id), and each document sums the values of its words.  Whatever a
pair's frequency, it occurs once in a block, so no key of a shuffle is hot.

Defined results: a NULL or empty text, and one whose joined A or B bytes differ from blank + text
(B writes U+2581 as a blank), has no tokens: zeros and an empty string.  Special strings inside
texts are plain text.  Keys pass through, NULL and repeated ones too; repeated rows are counted each
time.  An empty table gives no rows.  Further columns of the input are left out.

A task holds one block (``BLOCK`` characters, or one longer text) with its pieces; the
driver gets the vector of A's vocabulary, nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from vitrina.llm.pieces import ByteLevelEncoder, Generations, byte_alphabet, cut_texts
from vitrina.session import materialize

BLOCK = 3_000_000  # characters of text
CACHED = 120_000  # pieces of one generation of the cache
_PASS = ("kind string, block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
         "groups_sha256 string, words binary, identity binary, identity_len binary, pairs binary, pairs_len binary, "
         "place int, a int, b int, n bigint")
_TYPES = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary(), "int": pa.int32()}
_FIELDS = {f.split()[0]: _TYPES[f.split()[1]] for f in _PASS.split(", ")}
RESULT = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
          "groups_sha256 string")


def a_entries(tokenizer) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary."""
    byte_of = {sign: byte for byte, sign in byte_alphabet().items()}
    out = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    added = {i for i in tokenizer.get_added_tokens_decoder()}
    for entry, i in tokenizer.get_vocab(with_added_tokens=True).items():
        out[i] = entry.encode() if i in added else bytes(byte_of[c] for c in entry)
    return out


def b_entries(model) -> list[bytes]:
    """The bytes of each id of a sentencepiece vocabulary."""
    return [bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i)
            else model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.vocab_size())]


def identity_map(a_bytes: list[bytes], b_bytes: list[bytes], b_is_byte: list[bool]) -> np.ndarray:
    """For each A id the B id of the same bytes (an ordinary piece before a byte piece), else -1."""
    ids: dict[bytes, int] = {}
    for want in (False, True):
        for i, entry in enumerate(b_bytes):
            if b_is_byte[i] == want:
                ids.setdefault(entry, i)
    return np.array([ids.get(entry, -1) if entry else -1 for entry in a_bytes], np.int64)


def load_models(a_path: str, b_path: str):
    import sentencepiece

    a = ByteLevelEncoder(a_path, CACHED)
    a.tok.encode_special_tokens = True
    a.special = []
    return a, sentencepiece.SentencePieceProcessor(model_file=b_path)


def corpus_identity(a_path: str, b_path: str) -> np.ndarray:
    a, b = load_models(a_path, b_path)
    return identity_map(a_entries(a.tok), b_entries(b), [b.is_byte(i) for i in range(b.vocab_size())])


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32 in the fewest bytes that hold the largest, after one byte that says how many."""
    width = next(w for w in (1, 2, 3, 4) if not len(numbers) or int(numbers.max()) >> 8 * w == 0)
    return bytes([width]) + np.ascontiguousarray(numbers, "<u4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8, offset=1).reshape(-1, data[0])
    out = np.zeros((len(raw), 4), np.uint8)
    out[:, :data[0]] = raw
    return out.view("<u4").ravel().astype(np.int64)


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (in A, in B) of all tokens that share a byte; both cover the same bytes without gaps."""
    starts = np.concatenate([[0], a_ends[:-1]])
    first = np.searchsorted(b_ends, starts, "right")
    n = np.searchsorted(b_ends, a_ends, "left") + 1 - first
    in_a = np.repeat(np.arange(len(a_ends)), n)
    return in_a, np.arange(len(in_a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


class PieceAligner:
    """The alignment of pieces: (tokens of A, of B, groups, links, groups as text, A ids of identity
    groups, links of the other groups as A id << 32 | B id); None where bytes differ."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = load_models(a_path, b_path)
        self.a_bytes, self.b_bytes = a_entries(self.a.tok), b_entries(self.b)
        self.a_len = np.array([len(e) for e in self.a_bytes], np.int64)
        self.b_len = np.array([len(e) for e in self.b_bytes], np.int64)
        self.identity = identity_map(self.a_bytes, self.b_bytes,
                                     [self.b.is_byte(i) for i in range(self.b.vocab_size())])
        # The text of each token in a group, with the mark before it: ";" a group's first A token, "|" its
        # first B token, "," the others.
        n_a, n_b = len(self.a_bytes), len(self.b_bytes)
        marks = [m % i for m, n in ((b";%d", n_a), (b",%d", n_a), (b"|%d", n_b), (b",%d", n_b)) for i in range(n)]
        self.marks = np.array(marks, object)
        self.mark_at = np.cumsum([0, n_a, n_a, n_b])
        self.cache = Generations(CACHED, weigh=lambda pieces, found: sum(map(len, pieces)) + sum(
            300 + len(f[4]) + len(f[5]) + len(f[6]) for f in found if f))

    def _same_bytes(self, pieces: list[str], ids: np.ndarray, n: np.ndarray, entries: list[bytes], size: np.ndarray) -> np.ndarray:
        """Whether the joined bytes of each piece's tokens are a blank and the piece."""
        want = [b" " + p.encode() for p in pieces]
        ends = np.cumsum(n)
        total = np.concatenate([[0], np.cumsum(size[ids])])
        good = total[ends] - total[ends - n] == np.fromiter(map(len, want), np.int64, len(want))
        joined = [entries[i] for i in ids.tolist()]
        if good.all() and b"".join(joined) == b"".join(want):
            return good
        return np.array([b"".join(joined[e - k:e]) == w for e, k, w in zip(ends.tolist(), n.tolist(), want)], bool)

    def align(self, pieces: list[str]) -> list:
        """Alignments of distinct pieces, each with a blank before it."""
        a_values, b_values = self.a._piece_values(pieces, " "), self.b.encode(pieces, num_threads=1)
        a = np.frombuffer(b"".join(a_values), "<u4").astype(np.int64)
        b = np.fromiter(chain.from_iterable(b_values), np.int64)
        a_n = np.fromiter(map(len, a_values), np.int64, len(pieces)) // 4
        b_n = np.fromiter(map(len, b_values), np.int64, len(pieces))
        good = (self._same_bytes(pieces, a, a_n, self.a_bytes, self.a_len)
                & self._same_bytes(pieces, b, b_n, self.b_bytes, self.b_len))
        if not good.all():
            a, b = a[np.repeat(good, a_n)], b[np.repeat(good, b_n)]
            a_n, b_n = a_n[good], b_n[good]
        found = iter(self._aligned(a, b, a_n, b_n) if len(a_n) else ())
        return [next(found) if g else None for g in good.tolist()]

    def _aligned(self, a: np.ndarray, b: np.ndarray, a_n: np.ndarray, b_n: np.ndarray) -> Iterator[tuple]:
        """The alignments of pieces whose tokens (``a_n``, ``b_n`` of each) cover the same bytes."""
        a_ends, b_ends = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        shared = np.intersect1d(a_ends, b_ends, assume_unique=True)
        a_group, b_group = np.searchsorted(shared, a_ends, "left"), np.searchsorted(shared, b_ends, "left")
        in_a, in_b = overlaps(a_ends, b_ends)
        a_first = np.concatenate([[True], a_group[1:] != a_group[:-1]])
        b_first = np.concatenate([[True], b_group[1:] != b_group[:-1]])
        lone = (np.bincount(a_group) == 1) & (np.bincount(b_group) == 1)
        same = lone[a_group] & (self.identity[a] == b[b_first][a_group])  # the fast path, by A token
        regular = np.zeros(len(shared), bool)
        regular[a_group[same]] = True
        odd = ~regular[a_group[in_a]]
        at = self.mark_at
        marks = np.concatenate([self.marks[a + np.where(a_first, at[0], at[1])], self.marks[b + np.where(b_first, at[2], at[3])]])
        marks = marks[np.argsort(np.concatenate([a_group * 2, b_group * 2 + 1]), kind="stable")].tolist()
        identity, links = a[same].astype("<u4").tobytes(), (a[in_a] << 32 | b[in_b])[odd].tobytes()
        a_at, token = np.cumsum(a_n), np.concatenate([[0], np.cumsum(a_n + b_n)])
        group = np.concatenate([[0], a_group[a_at - 1] + 1])
        link = np.concatenate([[0], np.searchsorted(in_a, a_at, "left")])
        ident_at = 4 * np.concatenate([[0], np.cumsum(same)])[np.concatenate([[0], a_at])]
        links_at = 8 * np.concatenate([[0], np.cumsum(odd)])[link]
        text = (b"".join(marks[s:e])[1:] for s, e in pairwise(token.tolist()))
        return zip(a_n.tolist(), b_n.tolist(), np.diff(group).tolist(), np.diff(link).tolist(), text,
                   [identity[s:e] for s, e in pairwise(ident_at.tolist())], [links[s:e] for s, e in pairwise(links_at.tolist())])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """(keys, texts) of about ``BLOCK`` characters."""
    keys, texts, size = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1)):
            text = text.as_py()
            if keys and size + len(text or "") > BLOCK:
                yield keys, texts
                keys, texts, size = [], [], 0
            keys.append(key.as_py())
            texts.append(text)
            size += len(text or "") + 100
    if keys:
        yield keys, texts


def _rows(count: int, **columns) -> pa.RecordBatch:
    arrays = [pa.array(columns[c], t) if c in columns else pa.nulls(count, t) for c, t in _FIELDS.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(_FIELDS))


class _Block:
    """One block of documents: their words as places in the block's list of distinct pieces."""

    def __init__(self, aligner: PieceAligner, texts: list):
        pieces, index, offsets = cut_texts([t or "" for t in texts])
        self.words = [index[s:e] if t else index[:0] for t, (s, e) in zip(texts, pairwise(offsets.tolist()))]
        found = aligner.cache.fill(pieces, aligner.align)
        self.entries = [found[p] for p in pieces]
        good = np.array([e is not None for e in self.entries], bool)
        self.valid = [len(w) > 0 and bool(good[w].all()) for w in self.words]
        none = np.zeros(0, np.int64)
        self.uses = np.bincount(np.concatenate([none, *(w for w, v in zip(self.words, self.valid) if v)]),
                                minlength=len(pieces))
        self.entries = [e or (0, 0, 0, 0, b"", b"", b"") for e in self.entries]
        self.sizes = np.array([e[:4] for e in self.entries], np.int64).reshape(-1, 4)
        self.identity = np.frombuffer(b"".join(e[5] for e in self.entries), "<u4")
        self.identity_len = np.array([len(e[5]) // 4 for e in self.entries], np.int64)
        self.links = np.frombuffer(b"".join(e[6] for e in self.entries), np.int64)
        self.links_len = np.array([len(e[6]) // 8 for e in self.entries], np.int64)

    def documents(self) -> tuple[list, list]:
        """([n_a, n_b, n_groups, n_links] of each document, hash of its groups)."""
        numbers, hashes = [], []
        for words, valid in zip(self.words, self.valid):
            numbers.append(self.sizes[words].sum(axis=0).tolist() if valid else [0] * 4)
            hashes.append(hashlib.sha256(b";".join([self.entries[w][4] for w in words.tolist()])).hexdigest()
                          if valid else "")
        return numbers, hashes


def _first_pass(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = PieceAligner(a_path, b_path)
        vector = np.zeros(len(aligner.a_bytes), np.int64)
        base = TaskContext.get().partitionId() << 32
        for seq, (keys, texts) in enumerate(_blocks(batches)):
            block = _Block(aligner, texts)
            numbers, hashes = block.documents()
            words = [packed(w if v else w[:0]) for w, v in zip(block.words, block.valid)]
            n_a, n_b, n_groups, n_links = zip(*numbers)
            yield _rows(len(keys), kind=["doc"] * len(keys), block=[base + seq] * len(keys), doc_id=keys, n_a=n_a,
                        n_b=n_b, n_groups=n_groups, n_links=n_links, groups_sha256=hashes, words=words)
            vector += np.bincount(block.identity, np.repeat(block.uses, block.identity_len),
                                  len(vector)).astype(np.int64)
            pairs, place = np.unique(block.links, return_inverse=True)
            n = np.bincount(place, np.repeat(block.uses, block.links_len), len(pairs)).astype(np.int64)
            yield _rows(1, kind=["pieces"], block=[base + seq], identity=[packed(block.identity)],
                        identity_len=[packed(block.identity_len)], pairs=[packed(place)], pairs_len=[packed(block.links_len)])
            for k in range(0, len(pairs), 100_000):
                some = pairs[k:k + 100_000]
                yield _rows(len(some), kind=["pair"] * len(some), block=[base + seq] * len(some),
                            place=np.arange(k, k + len(some), dtype=np.int32), a=(some >> 32).astype(np.int32),
                            b=(some & 0xFFFFFFFF).astype(np.int32), n=n[k:k + 100_000])
        used = np.flatnonzero(vector)
        yield _rows(len(used), kind=["vector"] * len(used), a=used.astype(np.int32), n=vector[used])

    return run


def _second_pass(counts: np.ndarray, best: np.ndarray):
    """Sums of the documents of one block; ``counts`` and ``best`` are vectors over A's vocabulary."""

    def sums(values: np.ndarray, lens: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        ends = np.cumsum(lens)
        return total[ends] - total[ends - lens]

    def run(rows: pa.Table, pairs: pa.Table) -> pa.Table:
        docs = rows.filter(pc.equal(rows["kind"], "doc"))
        pieces = rows.filter(pc.equal(rows["kind"], "pieces")).to_pylist()[0]
        at = pairs["place"].to_numpy()
        pair_count, pair_best = np.zeros((2, len(at)), np.int64)
        pair_count[at], pair_best[at] = pairs["total"].to_numpy(), pairs["best"].to_numpy()
        identity, links, identity_len, links_len = (unpacked(pieces[c]) for c in ("identity", "pairs", "identity_len", "pairs_len"))
        of_piece = [sums(vector[identity], identity_len) + sums(of_pair[links], links_len)
                    for vector, of_pair in ((best, pair_best), (counts, pair_count))]
        words = [unpacked(w.as_py()) for w in docs["words"]]
        n_best, count_sum = (pa.array([int(values[w].sum()) for w in words], pa.int64()) for values in of_piece)
        return (docs.append_column("n_best", n_best).append_column("count_sum", count_sum)
                .select([f.split()[0] for f in RESULT.split(", ")]))

    return run


class AlignedCorpus:
    """The alignment of a table: ``pair_counts`` (a, b, total, best) and ``documents`` (one row each).

    ``total`` is the number of links of the pair in the corpus, ``best`` whether no pair of the
    same B id has more.
    """

    def __init__(self, df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"):
        src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        self.passed = materialize(src.mapInArrow(_first_pass(a_path, b_path), _PASS), "alignment")
        self.identity = corpus_identity(a_path, b_path)
        spark = df.sparkSession
        known = np.flatnonzero(self.identity >= 0)
        same = spark.createDataFrame(pa.table({"a": known.astype(np.int32), "b": self.identity[known].astype(np.int32)}))
        regular = (self.passed.filter("kind = 'vector'").groupBy("a").agg(F.sum("n").alias("n"))
                   .join(F.broadcast(same), "a").select("a", "b", "n"))  # at most A's vocabulary
        irregular = self.passed.filter("kind = 'pair'").select("a", "b", "n")
        totals = irregular.union(regular).groupBy("a", "b").agg(F.sum("n").alias("total"))
        of_b = Window.partitionBy("b")  # at most A's vocabulary
        self.pair_counts = materialize(
            totals.filter("total > 0").withColumn("best", F.col("total") == F.max("total").over(of_b)), "pair_counts")
        self.same = same

    def documents(self) -> DataFrame:
        vectors = self.pair_counts.join(F.broadcast(self.same), ["a", "b"]).select("a", "total", "best").toArrow()
        counts, best = np.zeros((2, len(self.identity)), np.int64)
        counts[vectors["a"].to_numpy()] = vectors["total"].to_numpy()
        best[vectors["a"].to_numpy()] = vectors["best"].to_numpy()
        pairs = (self.passed.filter("kind = 'pair'").select("block", "place", "a", "b")
                 .join(self.pair_counts, ["a", "b"], "left")
                 .select(F.col("block").alias("of_block"), "place", F.coalesce("total", F.lit(0)).alias("total"),
                         F.coalesce(F.col("best").cast("int"), F.lit(0)).alias("best")))
        rows = self.passed.filter("kind IN ('doc', 'pieces')").drop("place", "a", "b", "n")
        return (rows.groupBy("block").cogroup(pairs.groupBy("of_block"))
                .applyInArrow(_second_pass(counts, best), RESULT))


def align_tokens(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each document."""
    return AlignedCorpus(df, a_path, b_path, id_col, text_col).documents()
