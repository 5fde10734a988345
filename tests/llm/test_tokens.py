"""Token counts, binary records and packing against the tokenizers library itself."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from vitrina.llm import pieces
from vitrina.llm.packing import best_fit_decreasing, lower_bound, pack, packed_sequences, token_pieces
from vitrina.llm.pieces import ByteLevelEncoder, Generations, WordEncoder, encode_texts
from vitrina.llm.records import (frame, masked_crc, read_at, read_index, read_records, record_digest, unframe,
                                 write_records)
from vitrina.llm.token_counts import PrefixCounter, prefix_token_counts, tokens_of_prefix
from vitrina.session import scratch_path

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = ["", "a  b", "  x", "x ", "a \n b", "foo\n\n bar", "don't <|endoftext|> a<|endoftext|> b", "é́ x\x1cy\x85z  q",
       "it's 'll 've\t\tz   \n \n a", "<|startoftext|>A b", " ", " \n", "\n\nThe", "'S 'RE a's we're x'd9're", "ABC ǅ ΑΣ Σ. ﬁ",
       "中文字符 テスト x", "x" * 300 + "internationalization" * 5, "------ ==== aaaa'''s", "end.\nThe thing, (and) more!\nSo"]
DOCS = [(k, t, "extra", k) for k, t in enumerate(ODD)] + [(5, "foo\n\n bar", "twice", 0), (None, "no key", "k", 0),
                                                          (99, None, "n", 0), (100, "word and " * 6000, "long", 0)]
SCHEMA = "doc_id bigint, text string, n_tokens string, start int"


@pytest.mark.parametrize("kind, path", [(ByteLevelEncoder, BYTE), (WordEncoder, WORD)])
def test_encoders_equal_the_library(kind, path):
    tok = Tokenizer.from_file(path)
    for limit in (8, 100_000):  # a tiny cache loses entries all the time
        encoder = kind(path, limit)
        got = [x.tolist() for x in encode_texts(encoder, ODD + [None])]
        assert got == [tok.encode(t, add_special_tokens=False).ids for t in ODD + [""]]


def test_every_prefix_count_equals_the_library():
    counter = PrefixCounter(BYTE)
    for text, changes in zip(ODD, encode_texts(counter, ODD)):
        want = [len(counter.tok.encode(text[:k], add_special_tokens=False).ids) for k in range(1, len(text) + 1)]
        assert np.cumsum(changes, dtype=int).tolist() == want, text
        assert tokens_of_prefix(changes.tobytes(), 3) == (want[:3] or [0])[-1]


def test_generations_are_bounded():
    double = lambda ks: [k * 2 for k in ks]
    g = Generations(limit=10, weigh=lambda ks, vs: 0)
    for a in range(0, 200, 5):
        assert g.fill(range(a, a + 5), double)[a] == 2 * a
        assert len(g.young) + len(g.old) <= 25
    g = Generations(max_bytes=50_000)
    for k in range(300):  # long words: bounded in bytes long before the number of entries
        g.fill([str(k) * 2000], double)
        assert sum(len(a) + len(b) for a, b in [*g.young.items(), *g.old.items()]) < 150_000


def test_released_encoders_are_freed():
    import weakref

    from vitrina.llm import pieces
    encoder = weakref.ref(pieces.worker_encoder(ByteLevelEncoder, BYTE))
    encoder().run(["some words", "more of them"])
    pieces.worker_encoder(WordEncoder, WORD)  # one encoder at a time
    assert encoder() is None and len(pieces._LOADED) == 1
    word = weakref.ref(pieces.worker_encoder(WordEncoder, WORD))
    pieces.release_encoders()
    assert word() is None and not pieces._LOADED


def test_kept_columns_that_clash_with_counts(spark):
    df = spark.createDataFrame([(1, "a b", "x", "y", "z")], "doc_id int, text string, n_bytes string, `odd name` string, chars_in_3 string")
    got = prefix_token_counts(df, BYTE, keep=("doc_id", "n_bytes", "odd name", "chars_in_3"), budgets=(3,)).collect()
    assert got[0].asDict() | {"count_changes": None} == {"doc_id": 1, "odd name": "y", "n_bytes": 3, "n_tokens": 2,
                                                         "count_changes": None, "chars_in_3": 3}


def test_prefix_counts(spark):
    df = spark.createDataFrame(DOCS, SCHEMA)
    got = prefix_token_counts(df, BYTE, budgets=(3,)).collect()
    tok = Tokenizer.from_file(BYTE)
    want = sorted((str(d[0]), len((d[1] or "").encode()), len(tok.encode(d[1] or "", add_special_tokens=False).ids)) for d in DOCS)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
    for r in got:
        text = next(d[1] or "" for d in DOCS if d[0] == r.doc_id)
        fits = [k for k in range(len(text[:60]) + 1) if len(tok.encode(text[:k], add_special_tokens=False).ids) <= 3]
        if len(text) <= 60:
            assert r.chars_in_3 == fits[-1]
    assert prefix_token_counts(df.limit(0), BYTE).count() == 0


def test_frames_round_trip_and_show_damage():
    ids = np.array([1, 70_000, 0], "<u4")
    for key, x in ((7, ids), (None, ids[:0]), (-3, ids[2:])):
        data = frame(key, x)
        assert unframe(data, 0)[0] == key and unframe(data, 0)[1].tolist() == x.tolist() and unframe(data, 0)[2] == len(data)
        for at in (0, 9, 14, len(data) - 3):
            bad = bytearray(data)
            bad[at] ^= 1
            with pytest.raises(ValueError):
                unframe(bytes(bad), 0)
    assert masked_crc(b"") == 0xA282EAD8


def test_records(spark):
    path = scratch_path(spark, "records")
    write_records(spark.createDataFrame(DOCS, SCHEMA).repartition(3), path, BYTE, end_id=0)
    tok = Tokenizer.from_file(BYTE)
    order = sorted(DOCS, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    start, want = 0, []
    for d in order:
        ids = np.array(tok.encode(d[1] or "", add_special_tokens=False).ids + [0], "<u4")
        want.append((d[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = record_digest(spark, path).collect()
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=lambda r: r[1]) == want
    index = read_index(spark, path)
    some = read_at(spark, path, index.filter("doc_id IN (3, 100, 16)")).collect()
    full = {(r.shard, r.record): r.ids for r in read_records(spark, path).collect()}
    assert sorted(r.doc_id for r in some) == [3, 16, 100]
    assert all(r.ids == full[r.shard, r.record] for r in some)


def test_records_of_an_empty_table(spark):
    path = scratch_path(spark, "records")
    write_records(spark.createDataFrame([], SCHEMA), path, BYTE)
    assert record_digest(spark, path).count() == 0


def test_bounds_and_best_fit():
    rng = np.random.default_rng(5)
    for high in (10, 60, 100):
        lengths = rng.integers(1, high + 1, 300)
        bins, offsets, n = best_fit_decreasing(lengths, 100)
        assert lower_bound(lengths, 100) <= n <= 1.25 * lower_bound(lengths, 100) + 1
        for b in range(n):
            items = sorted((offsets[k], lengths[k]) for k in np.flatnonzero(bins == b))
            assert items[0][0] == 0 and all(a + s == c for (a, s), (c, _) in zip(items, items[1:])) and sum(items[-1]) <= 100
    assert lower_bound(np.array([51] * 7), 100) == 7 and lower_bound(np.array([34] * 9), 100) == 5
    assert lower_bound(np.empty(0, int), 100) == 0


def test_pack(spark):
    df = spark.createDataFrame(DOCS, SCHEMA)
    pieces = token_pieces(df, WORD, capacity=64, with_ids=True)
    rows = pack(pieces, capacity=64, per_part=5).collect()
    tok = Tokenizer.from_file(WORD)
    want = []
    for d in DOCS:
        ids = np.array(tok.encode(d[1] or "", add_special_tokens=False).ids + [1], "<u4")
        want += [(str(d[0]), k, a, len(ids[a:a + 64]), zlib.crc32(ids[a:a + 64].tobytes())) for k, a in enumerate(range(0, len(ids), 64))]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in bins.values():
        items.sort()
        assert items[0][0] == 0 and all(a + s == b for (a, s), (b, _) in zip(items, items[1:])) and sum(items[-1]) <= 64
    assert len(bins) <= lower_bound(np.array([w[3] for w in want]), 64) + 1
    seqs = packed_sequences(spark.createDataFrame(rows), pieces).collect()
    assert len(seqs) == len(bins) and all(len(s.ids) == 4 * s.n_tokens for s in seqs)
    assert pack(token_pieces(df.limit(0), WORD)).count() == 0


def test_packing_groups_stay_bounded(spark, monkeypatch):
    """Mid-length pieces: the bound lies below best fit, so nearly all bins stay open in every round."""
    from vitrina.llm import packing
    make, rounds = packing._repack, spark.sparkContext.accumulator(0)

    def watched(capacity, first):
        repack = make(capacity, first)

        def run(pdf):
            assert len(pdf) <= 100, f"a group of {len(pdf)} pieces"
            if not first:
                rounds.add(1)
            return repack(pdf)
        return run

    monkeypatch.setattr(packing, "_repack", watched)
    rng = np.random.default_rng(3)
    lengths = rng.integers(1100, 1801, 700).tolist()
    df = spark.createDataFrame([(k, 0, 0, n, k) for k, n in enumerate(lengths)], packing.PIECES)
    rows = pack(df, 4096, per_part=32).collect()
    assert sorted((r.doc_id, r.length) for r in rows) == list(enumerate(lengths))
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in bins.values():
        items.sort()
        assert items[0][0] == 0 and all(a + s == b for (a, s), (b, _) in zip(items, items[1:])) and sum(items[-1]) <= 4096
    assert rounds.value > 0 and len(bins) <= 1.03 * best_fit_decreasing(np.array(lengths), 4096)[2]


def test_rows_alike_in_every_column_are_dealt(spark):
    """A third of all pieces without key and of one text: packed in groups of the usual size, none lost."""
    from pyspark.sql import functions as F

    from vitrina.llm.packing import PIECES
    same = spark.range(3000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("bigint").alias("start"),
                                    F.lit(1000).cast("bigint").alias("length"), F.lit(7).cast("bigint").alias("ids_crc32"))
    other = spark.range(6000).select("id", F.lit(0), F.lit(0).cast("bigint"), (F.col("id") % 900 + 1), F.lit(8).cast("bigint"))
    pieces = same.union(other)
    assert pieces.columns == [f.split()[0] for f in PIECES.split(", ")]
    rows = pack(pieces, 4096, per_part=500).collect()
    assert len(rows) == 9000 and sum(r.doc_id is None for r in rows) == 3000
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 4096 and len(ends) <= 1.03 * sum(r.length for r in rows) / 4096 + 1


def test_words_beyond_ascii_are_cut_together():
    """One call of the library for a run of pieces, with the words that a call for each piece gives."""
    encoder, calls = WordEncoder(WORD), []
    plain = ["é", "Naïve,", "ÀÉ.", "中文字", "x́", "́", "İ", "ﬁ's", "²½", "…"] * 10
    blank = ["a\tb", "é\u3000é", "", "ok", "\x85"]
    want = [encoder.cut_words(p) for p in plain + blank]

    class Counted:
        def __init__(self, tok):
            self.normalizer, self.pre_tokenizer, self.tok = self, tok.pre_tokenizer, tok

        def normalize_str(self, text):
            calls.append(text)
            return self.tok.normalizer.normalize_str(text)

    encoder.tok = Counted(encoder.tok)
    assert encoder._cut_together(plain) == want[:100] and len(calls) == 2  # runs of 64 pieces
    assert encoder._cut_together(plain + blank) == want  # blanks inside a piece: cut one by one
    assert encoder._cut_together([]) == []


def test_strings_are_made_in_one_call():
    """Distinct pieces come out of Arrow in one call, whatever they hold; none is made scalar by scalar."""
    import pyarrow as pa
    from vitrina.llm import pieces
    given = ["", "plain", "é", "\u0416\u0443\u043a", "\U0001f600", "a\nb", "nul\0", "\u3000", "x" * 70_000]
    for kind in (pa.string(), pa.large_string()):
        assert pieces.strings(pa.array(given, kind)) == given
        assert pieces.strings(pa.array(given, kind)[2:5]) == given[2:5] and pieces.strings(pa.array([], kind)) == []
    uniques, index, offsets = pieces.cut_texts([" ".join(given[1:5]), "", "plain  text é"])
    assert [" ".join(uniques[k] for k in index[a:b]) for a, b in zip(offsets, offsets[1:])] == [" ".join(given[1:5]), "", "plain  text é"]
    assert all(type(u) is str for u in uniques)


def test_plain_words_never_reach_the_normalizer():
    """Latin letters with marks after them are cut by Arrow; other pieces by the library, as it cuts whole texts."""
    plain = "Événement, señor! ÀÉß&&& Über.\nÇa ÿÿ Été ÉTÉ été, abc ABC abc.)"
    odd = "don't L'été a×b ǅ é́ <|endoftext|> x1 ٣ 中文 é's"
    for kind, path in ((ByteLevelEncoder, BYTE), (WordEncoder, WORD)):
        encoder, cut = kind(path), []
        for name in ("cut_words", "_cut_together"):
            if hasattr(encoder, name):
                inner = getattr(encoder, name)
                setattr(encoder, name, lambda x, *a, f=inner: (cut.append(x) if x else None) or f(x, *a))
        for text in (plain, f"{plain} {odd} {plain}", ""):
            (got,) = encode_texts(encoder, [text])
            assert got.tolist() == encoder.tok.encode(text, add_special_tokens=False).ids
            assert text != plain or cut == []
        assert cut


def test_row_runs_give_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(pieces, "trim_memory", lambda: calls.append(1))
    batches = [pa.record_batch({"a": list(range(n))}) for n in (5, 0, 2)]
    parts = [p.column(0).to_pylist() for p in pieces.row_runs(batches, 2)]
    assert parts == [[0, 1], [2, 3], [4], [0, 1]] and len(calls) == 4
