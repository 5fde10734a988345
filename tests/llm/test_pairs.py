"""Edit decontamination and near-duplicates against brute force."""

import random

import numpy as np
import pytest

from vitrina.llm import near_dups
from vitrina.llm.decontam import best_match, contaminated, decontaminate, masks, normalise, pieces
from vitrina.llm.near_dups import chunk_keys, components, near_duplicates, shingle_sets, signatures, without_near_duplicates

WORDS = [a + b for a in ("ka", "lo", "mi", "ne", "tu", "ra") for b in ("s", "n", "rt", "x", "l")]


def edit(p, t):
    """Smallest edit distance of p to a substring of t."""
    row = [0] * (len(t) + 1)
    for i, a in enumerate(p, 1):
        new = [i]
        for j, b in enumerate(t, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_bit_vectors_equal_dynamic_programming():
    rng = random.Random(3)
    for _ in range(200):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 70)))
        t = "".join(rng.choice("abc") for _ in range(rng.randint(0, 90)))
        assert best_match(masks(p), len(p), t)[0] == edit(p, t)


def test_pieces_cover_the_item():
    for m, k in ((40, 3), (33, 2), (5, 0), (100, 8)):
        item = "".join(chr(97 + i % 26) for i in range(m))
        assert "".join(p for _, p in pieces(item, k)) == item and len(pieces(item, k)) == k + 1


def test_matches_equal_brute_force(spark):
    rng = random.Random(7)
    text = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    items = [(k, text(25)) for k in range(6)] + [(6, None), (7, ""), (8, "short one"), (None, text(25))]
    docs = []
    for k in range(40):
        body = text(60)
        if k % 3 == 0:
            item = list(items[k % 6][1])
            for _ in range(k % 14):  # some within the budget, some beyond
                at = rng.randrange(len(item))
                item[at:at + 1] = rng.choice(["", "q", "zz"])
            body = body[:100] + " " + "".join(item).upper().replace(" ", "\n ") + " " + body[100:]
        docs.append((k, body, "x"))
    docs += [(100, None, "x"), (101, "", "x"), (102, "a SHORT  one here", "x"), (None, items[0][1], "x"),
             (103, text(4000) + " " + items[1][1], "x"), (3, docs[3][1], "x")]
    rate = 0.08
    want = set()
    for key, t, _ in docs:
        for i, item in items:
            p = normalise(item)
            if p:
                d = edit(p, normalise(t)) if t and len(t) < 2000 else (0 if t and p in normalise(t) else 99)
                if d <= (int(len(p) * rate) if len(p) >= 32 else 0):
                    want.add((key, i, d))
    dd = spark.createDataFrame(docs, "doc_id bigint, text string, distance string")
    ii = spark.createDataFrame(items, "item_id bigint, text string")
    rows = contaminated(dd, ii, rate).collect()
    got = {(r.doc_id, r.item_id, r.distance) for r in rows}
    assert got == want and len(want) > 8 and any(d for *_, d in want)
    texts = dict((k, t) for k, t, _ in docs)
    for r in rows:  # the span is a passage at that distance
        if r.doc_id in texts and texts[r.doc_id]:
            span = normalise(texts[r.doc_id])[r.span_start:r.span_end]
            item = normalise(dict(items)[r.item_id])
            assert edit(item, span) == r.distance
    left = {r.doc_id for r in decontaminate(dd, ii, rate).collect()}
    assert left == {k for k, *_ in docs} - {k for k, *_ in want}
    assert contaminated(dd.limit(0), ii).count() == 0 and contaminated(dd, ii.limit(0)).count() == 0


def test_clashing_keys_are_refused(spark):
    docs = spark.createDataFrame([(1, "a")], "distance int, text string")
    items = spark.createDataFrame([(1, "a")], "item_id int, text string")
    with pytest.raises(ValueError):
        contaminated(docs, items, id_col="distance")


def test_blocks_give_the_same(spark, monkeypatch):
    from vitrina.llm import decontam
    docs = spark.createDataFrame([(1, "so it is that all men are here"), (2, "no")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "all men"), (2, "so it"), (3, "no")], "item_id bigint, text string")
    one = sorted(map(tuple, contaminated(docs, items).collect()))
    monkeypatch.setattr(decontam, "BLOCK", 4)
    assert sorted(map(tuple, contaminated(docs, items).collect())) == one and len(one) == 3


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def classes(docs, n, percent=80):
    ids = sorted({k for k, _ in docs if k is not None})
    up = {k: k for k in ids}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    sets = [(k, shingles(t, n)) for k, t in docs if k is not None]
    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= percent * len(x | y) and root(i) != root(j):
                up[max(root(i), root(j))] = min(root(i), root(j))
    return {k: root(k) for k in ids}


def corpus():
    rng = random.Random(11)
    docs = []
    for g in range(12):
        base = [rng.choice(WORDS) for _ in range(rng.choice([3, 12, 60, 200]))]
        for c in range(rng.choice([1, 4, 14])):
            w = list(base)
            for _ in range(rng.randrange(0, 1 + len(w) // 20)):
                w[rng.randrange(len(w))] = rng.choice(WORDS) + "q"
            docs.append(" ".join(w).title() if c % 2 else " ".join(w))
            base = w if c % 3 == 0 else base  # chains: linked by way of others
    docs += [None, "", " \n", "one", "ONE", "one two", docs[0]]
    return [(k * 3, t) for k, t in enumerate(docs)] + [(None, docs[1]), (6, docs[2])]


def test_hashes_follow_the_words():
    texts = [t for _, t in corpus()] + ["x\x1cy z", "é É", "a\tb\nc d  e"]
    for n in (4, 5):
        got = list(shingle_sets(texts, n))
        assert [len(s) for s in got] == [len(shingles(t, n)) for t in texts]
        for i in range(0, len(texts), 7):
            for j in range(len(texts)):
                assert len(np.intersect1d(got[i], got[j])) == len(shingles(texts[i], n) & shingles(texts[j], n))


def test_every_pair_within_the_distance_shares_a_key():
    rng = np.random.default_rng(2)
    sig = rng.integers(0, 65536, (200, near_dups.PLACES)).astype(np.uint16)
    other = sig.copy()
    for k in range(200):
        at = rng.permutation(near_dups.PLACES)[:near_dups.ERRORS]
        other[k, at] ^= 1
    a, b = chunk_keys(sig), chunk_keys(other)
    assert all((a[k] == b[k]).any() for k in range(200))


def test_bitmaps_bound_what_is_shared():
    rng = np.random.default_rng(4)
    for n in (1, 30, 400, 20_000):
        x = rng.integers(0, 2**63, n).astype(np.int64)
        y = np.concatenate([x[:n // 2], rng.integers(0, 2**63, n - n // 2).astype(np.int64)])
        bx, by = (near_dups.bitmap(d) for d in (x, y))
        alone = sum((a & ~b & (2**64 - 1)).bit_count() for a, b in zip(bx.tolist(), by.tolist()))
        assert len(np.intersect1d(x, y)) <= len(x) - alone
        assert n != 30 or len(x) - alone <= n // 2 + 4


def families(seed, n, size):
    """Texts that differ from one centre, many of them by more than the threshold, some alike among themselves."""
    rng = random.Random(seed)
    centre = [rng.choice(WORDS) + str(k) for k in range(size)]
    docs, kinds = [centre], []
    for k in range(n):
        w = list(rng.choice(kinds)) if kinds and rng.random() < 0.5 else list(centre)
        for _ in range(rng.choice([0, 1, size // 40, size // 25, size // 15])):
            w[rng.randrange(len(w))] = rng.choice(WORDS) + "q" + str(rng.randrange(50))
        if rng.random() < 0.2:
            w = w[:rng.randrange(size // 2, size)]
        if rng.random() < 0.2:
            kinds.append(w)
        docs.append(w)
    return [(k, " ".join(w)) for k, w in enumerate(docs)]


@pytest.mark.parametrize("seed,percent", [(1, 80), (3, 90), (4, 60)])
def test_differences_from_a_centre_lose_no_pair(spark, seed, percent):
    docs = families(seed, 70, 120) + [(3, "another text of the key three " * 6)]
    texts = spark.createDataFrame(docs, "node bigint, text string")
    groups = texts.select("node", near_dups.F.lit(0).cast("bigint").alias("grp")).distinct()
    weighed = near_dups._weighed(near_dups._differences(groups, texts, 4), percent)
    links = weighed.filter("NOT apart AND node <> grp").select(near_dups.F.col("grp").alias("a"), near_dups.F.col("node").alias("b"))
    labels = components(links)
    want = classes(docs, 4, percent)
    rounds = {}
    for turn in (0, 1):  # all pairs alone give everything; the smallest nodes only true links
        pairs = near_dups._meeting(near_dups._prefixes(weighed, labels, percent), percent)[turn]
        found = links.union(near_dups._confirmed(pairs, texts, 4, percent))
        got = {r.node: r.component for r in components(found).collect()}
        rounds[turn] = {k: got.get(k, k) for k in want}
    assert rounds[1] == want
    assert all(want[c] == want[k] for k, c in rounds[0].items())


def test_many_copies_of_a_text_share_few_differences(spark):
    """Copies that differ from their centre each in its own way meet hardly any other copy."""
    rng = random.Random(6)
    centre = [rng.choice(WORDS) + str(k) for k in range(200)]
    counts = {}
    for n in (100, 400):
        docs = [(0, " ".join(centre))]
        for k in range(1, n):
            w = list(centre)
            for at in rng.sample(range(200), 14):
                w[at] = f"own{k}x{at}"
            docs.append((k, " ".join(w)))
        texts = spark.createDataFrame(docs, "node bigint, text string")
        groups = texts.select("node", near_dups.F.lit(0).cast("bigint").alias("grp"))
        weighed = near_dups._weighed(near_dups._differences(groups, texts, 4), 80)
        none = spark.createDataFrame([], "node bigint, component bigint")
        pairs = near_dups._meeting(near_dups._prefixes(weighed, none, 80), 80)[1]
        counts[n] = (weighed.filter("apart").count(), pairs.count())
    assert counts[400][0] > 300 and counts[400][1] <= 400


def test_signature_estimates_similarity():
    x = np.unique(np.random.default_rng(0).integers(0, 2**63, 4000).astype(np.uint64))
    s = signatures([x[:3000], x[600:3600]])
    assert abs((s[0] == s[1]).mean() - 2400 / 3600) < 0.2


@pytest.mark.parametrize("docs", [corpus(), [(k + 1, t) for k, t in families(9, 80, 90)]])
def test_near_duplicates_equal_brute_force(spark, docs):
    df = spark.createDataFrame([(k, t, 1) for k, t in docs], "doc_id bigint, text string, kept int")
    rows = near_duplicates(df, words=4).collect()
    want = classes(docs, 4)
    assert len(rows) == len(docs)
    assert {r.doc_id: r.component_id for r in rows if r.doc_id is not None} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows if r.doc_id is not None)
    assert all(r.kept for r in rows if r.doc_id is None)
    left = {r.doc_id for r in without_near_duplicates(df, words=4).collect()}
    assert left - {None} == {k for k, c in want.items() if k == c}
    assert near_duplicates(df.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    n = 300
    links = spark.createDataFrame([(k + 1, k) for k in range(n)] + [(1000, 1001), (5, 5)], "a bigint, b bigint")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {k: 0 for k in range(n + 1)} | {1000: 1000, 1001: 1000}


def test_pairs_meet_only_where_enough_follows(spark):
    """Two texts that need 20 differences in common cannot have them if they first meet with 10 to go."""
    from vitrina.llm.near_dups import BITMAP, _meeting

    words = [f"w{k}" for k in range(BITMAP)]
    rows = [(1, diff, node, node, 90, 3600, 40, True, place, 30, 0, *[0] * BITMAP)
            for diff, place, nodes in ((7, 30, (1, 2, 3)), (8, 5, (4, 5))) for node in nodes]
    kinds = ("grp long, diff long, node long, component long, n long, a long, size int, apart boolean, place int, "
             "far long, near long, " + ", ".join(f"{w} long" for w in words))
    pairs = _meeting(spark.createDataFrame(rows, kinds), 80)[1]
    assert [tuple(r) for r in pairs.collect()] == [(4, 5)]
