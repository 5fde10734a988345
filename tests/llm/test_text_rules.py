"""Quality rules and the byte network: plain counterparts, odd texts, learning."""

import re
import zlib

import numpy as np
import pytest

from vitrina.llm.byte_cnn import ByteCnn, held_out, score_quality, train
from vitrina.llm.line_rules import judge, line_fails, line_first_rules

GOOD = "The thing was here, and it was good. Others came later to see it."
LONG = "\n".join(" ".join(f"w{k}x{j}" for j in range(9)) + f", and end{k}." for k in range(12))
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [None, "", " \t\n", "one", LONG, LONG + "\n" + LONG, "a b c " * 60, "x\x1cy\x85z  w " * 20,
         "\n".join(["Home | About | News | Shop | Help | More"] * 30), LONG + "\nAll rights reserved.",
         "bad### words$$$ all%%% over&&& the*** place### here " * 12, "LOUD!! " * 80, "é " * 70 + "\n" + "#" * 9,
         "word " * 30_000]
SCHEMA = "doc_id bigint, text string, kept string, lang string"
ROWS = [(k, t, "clash", "en") for k, t in enumerate(TEXTS)] + [(None, LONG, "clash", None), (4, LONG, "clash", "en")]


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    seen = {}
    for k in range(len(words) - 2):
        seen.setdefault(tuple(words[k:k + 3]), []).append(k)
    covered = {k + j for ks in seen.values() if len(ks) > 1 for k in ks for j in range(3)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


@pytest.mark.parametrize("k", range(len(TEXTS)))
def test_base_counts(k):
    got = judge(TEXTS[k] or "")
    assert (*got[1:6], got[8]) == plain(TEXTS[k])


def test_lines():
    assert line_fails("Home | About | News | Shop") and line_fails("© 2020 Copyright by us")
    assert line_fails("one### two$$$ three%%% four") and not line_fails("one### two three four five six seven")
    assert line_fails("word " * 20) and not line_fails("word " * 19) and not line_fails(GOOD)
    assert judge(LONG)[9] and judge(LONG + "\nAll rights reserved.")[0] == LONG
    assert not judge("\n".join([LONG, "a### b### c### d### " * 100]))[9]


def test_rules_on_a_table(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = line_first_rules(df, keep=("doc_id", "kept", "lang")).collect()
    assert len(got) == len(ROWS) and got[0].__fields__.count("kept") == 1
    for r in got:
        if r.doc_id is not None:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(TEXTS[r.doc_id])
    assert line_first_rules(df.limit(0)).count() == 0


def test_network_training_lowers_the_loss():
    """Training lowers the loss, through texts of one chunk, several chunks and none."""
    texts, labels = [b"abcabc" * 5, b"zzz", b""], np.array([1.0, 0.0, 1.0], np.float32)

    def loss(model):
        p = np.array([model.score(t) for t in texts])
        w = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
        return float((w * -np.log(np.where(labels == 1, p, 1 - p))).sum())

    before = loss(ByteCnn.start(filters=4, width=3, chunk=8))
    after = loss(ByteCnn.start(filters=4, width=3, chunk=8).fit(texts, labels, epochs=200, batch=3, steps=200))
    assert after < 0.3 * before


def test_network_covers_the_whole_text():
    model = ByteCnn.start(filters=4, width=3, chunk=16)
    data = bytes(range(256)) * 700  # longer than one block
    whole = model.maxima(data)
    raw = np.frombuffer(data + b"\0\0", np.uint8)
    out = sum(model.tables[k][raw[k:k + len(data)]] for k in range(3)) + model.bias
    want = np.maximum.reduceat(out, np.arange(0, len(data), 16), axis=0)
    assert np.allclose(whole, want, atol=1e-5)


def test_network_learns_and_keeps_held_out_rows_out(spark):
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for k in range(300):
        good = k % 2
        words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(40)]
        rows.append((k, " ".join(words) if good else " ".join(w + "###" for w in words), 1.0))
        labels.append((k, good, 0))
    rows += [(1000, None, 1.0), (1001, "", 1.0), (1002, "x" * 400_000, 1.0), (None, "abc", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score double")
    lab = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = train(docs, lab, per_class=60)
    got = {r.doc_id: r.score for r in score_quality(docs, model).collect()}
    test = [k for k in range(300) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert np.mean([(got[k] >= 0.3) == bool(k % 2) for k in test]) > 0.95
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == len(rows)
    held = {r.doc_id for r in docs.filter(held_out()).collect()}
    assert {k for k in held if k is not None and k < 300} == set(test)
    # labels of held-out rows change nothing
    flipped = spark.createDataFrame([(k, (1 - y) if k in set(test) else y, 0) for k, y, _ in labels], "doc_id bigint, quality int, toxic int")
    assert np.array_equal(train(docs, flipped, per_class=60).tables, model.tables)
    assert train(docs, lab.limit(0)) == 0.5 and train(docs, lab.filter("quality = 1")) == 1.0
    assert score_quality(docs.limit(0), model).count() == 0
