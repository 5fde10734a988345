"""Cross-tokenizer alignment against whole texts encoded by both libraries and a double loop over tokens."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog."), (2, None), (3, ""), (4, " "), (5, "  two  blanks  "),
    (6, "line one\nline two\n\n\ttab"), (7, "Zürich, naïve café; 東京 и Москва 🙂"), (8, "special <|endoftext|> here <s> </s> <unk>"),
    (9, "written ▁ as a sign"), (10, "The quick brown fox jumps over the lazy dog."), (10, "The quick brown fox"),
    (None, "no key at all"), (11, "unbelievableunbelievable " * 300), (12, "x" * 3000), (13, "a b 　 c ́d"),
    (14, "don't we'll 1234567 3.14 http://example.com/a?b=c"), (15, "<0x41> A <0x0A>"), (16, "token " * 50),
]


def brute_force(rows):
    """The contract, word for word: whole texts, all pairs of tokens, byte ranges."""
    import sentencepiece
    from tokenizers import Tokenizer

    from vitrina.llm.pieces import byte_alphabet
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    signs = {s: b for b, s in byte_alphabet().items()}

    def b_bytes(i):
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    aligned, counts = [], Counter()
    for key, text in rows:
        a_ids = tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b_ids = model.encode(text) if text else []
        a_tokens = [bytes(signs[c] for c in tok.id_to_token(i)) for i in a_ids]
        b_tokens = [b_bytes(i) for i in b_ids]
        if not text or not b"".join(a_tokens) == b"".join(b_tokens) == (" " + text).encode():
            aligned.append((key, [], [], [], []))
            continue
        ranges = []
        for tokens in (a_tokens, b_tokens):
            at, out = 0, []
            for t in tokens:
                out.append((at, at + len(t)))
                at += len(t)
            ranges.append(out)
        links = []
        for i, (s, e) in zip(a_ids, ranges[0]):
            links += [(i, j) for j, (s2, e2) in zip(b_ids, ranges[1]) if s < e2 and s2 < e]
        shared = sorted({e for _, e in ranges[0]} & {e for _, e in ranges[1]})
        groups, start = [], 0
        for end in shared:
            groups.append(tuple(",".join(str(i) for i, (s, e) in zip(ids, r) if start <= s and e <= end)
                                for ids, r in zip((a_ids, b_ids), ranges)))
            start = end
        counts.update(links)
        aligned.append((key, a_ids, b_ids, groups, links))
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return [(key, len(a), len(b), len(g), len(ls), sum(counts[p] == highest[p[1]] for p in ls),
             sum(counts[p] for p in ls),
             hashlib.sha256(";".join("|".join(x) for x in g).encode()).hexdigest() if a else "")
            for key, a, b, g, ls in aligned]


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_equals_brute_force(spark, monkeypatch):
    from vitrina.llm import token_alignment
    df = spark.createDataFrame(TEXTS, "doc_id long, text string").repartition(3)
    want = sorted(brute_force(TEXTS), key=str)
    assert as_rows(token_alignment.align_tokens(df, A, B)) == want


def test_small_blocks_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    from vitrina.llm import token_alignment
    df = (spark.createDataFrame(TEXTS, "doc_id long, text string").coalesce(1)
          .withColumn("kind", F.lit("pair")).withColumn("n_a", F.lit(7)).withColumn("block", F.lit("x")))
    first_pass = token_alignment._first_pass

    def tiny(a, b):
        run = first_pass(a, b)

        def inner(batches):
            from vitrina.llm import token_alignment as inside
            inside.BLOCK = 300
            yield from run(batches)
            inside.BLOCK = 3_000_000
        return inner

    token_alignment._first_pass = tiny
    try:
        assert as_rows(token_alignment.align_tokens(df, A, B)) == sorted(brute_force(TEXTS), key=str)
    finally:
        token_alignment._first_pass = first_pass


def test_query_on_documents_equals_brute_force(spark):
    from tests.conftest import SF_SMOKE
    from vitrina.llm.queries import op13_token_alignment
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMOKE}/documents.parquet").collect()]
    short = [r for r in rows if len(r[1] or "") < 3000]
    df = op13_token_alignment(spark, SF_SMOKE)
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = {r[0]: tuple(r) for r in df.collect()}
    assert len(got) == len(rows)
    for want in brute_force(short):  # without the corpus counts, which need all texts
        assert got[want[0]][:5] + got[want[0]][7:] == want[:5] + want[7:]


def test_packed_numbers_round_trip():
    import numpy as np

    from vitrina.llm.token_alignment import packed, unpacked
    for top in (0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1):
        given = np.array([0, top // 2, top], np.int64)
        assert unpacked(packed(given)).tolist() == given.tolist()
    assert unpacked(packed(np.zeros(0, np.int64))).tolist() == []


def test_pair_counts_and_identity_map(spark):
    from vitrina.llm.token_alignment import AlignedCorpus, identity_map
    assert identity_map([b"a", b"", b"b", b"c"], [b"x", b"b", b"b", b"a"], [False, True, False, False]).tolist() == [3, -1, 2, -1]
    df = spark.createDataFrame([(1, "the the the")], "doc_id long, text string")
    pairs = AlignedCorpus(df, A, B).pair_counts.collect()
    assert [(p.total, p.best) for p in pairs] == [(3, True)]


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, None), (1, None)]])
def test_empty_tables_and_texts(spark, rows):
    from vitrina.llm.token_alignment import align_tokens
    got = align_tokens(spark.createDataFrame(rows, "doc_id long, text string"), A, B).collect()
    assert [tuple(r) for r in got] == [(k, 0, 0, 0, 0, 0, 0, "") for k, _ in rows]
