"""MinHash near-duplicates by a multi-index Hamming join.

1. A text's set: the distinct shingles of ``words`` words (as 64-bit hashes).  Texts with equal
   sets are one node; its name is the smallest key among them.
2. A node's signature has 64 places of 16 bits, each the low bits of one min-hash.  Two sets
   of similarity s differ in about (1 - s) * 64 places.  25 places may differ: at similarity
   0.8 itself more differ in one or two pairs of 10,000, above it in fewer.
3. Pigeonhole: with 13 chunks and at most 25 errors, some chunk has at most one error.  Each
   chunk's one-error neighbourhood is enumerated by leaving out one place at a time: two chunks with
   at most one error have a key (chunk, place left out, other places) in common.  So every pair
   within the signature distance shares a key: 64 keys for each node.
4. A key's nodes are linked to the smallest of them, its hub (stars, not all pairs), if the
   signatures are within the distance; links are confirmed on the full sets, first one for each node,
   then those between different components.
5. That is not yet every pair: nodes of one key that the hub did not bring together may still be
   alike.  Keys whose nodes lie in different components are *open*; the nodes of open keys that
   share nodes make a group, and each group has one text to compare with, its centre h.  A node is
   written as its difference from the centre, D = (x - h) and (h - x), marked apart.  Two sets
   are alike if and only if |x xor y| <= (|x| + |y|)(1 - t)/(1 + t), and |x xor y| = |Dx| + |Dy| -
   2 |Dx and Dy|: so they must have s = (ax + ay)/2 differences in common, where a = |D| - |x|(1 - t)/(1 + t).
   A node is alike to the centre if a <= |h|(1 - t)/(1 + t); those are linked with it.  Of any other pair one
   node lies beyond, and then s > 0.  Differences are put in order, rarest in the group first;
   two sets with s in common share one of the first |D| - s + 1 of each (prefix filter; s is bounded by
   what the other node has at least).  Nodes meet on (group, difference), first with the smallest
   node there, then, where components still differ, with each other.  Each brings a bitmap of its differences, from
   which the join bounds |Dx and Dy| from above (a bit that only x has is a difference that y lacks), so that
   only pairs that may have s in common come out of it; so do the places of the difference they meet on: if it is the first
   they share, no more than what follows it in either is shared (positional filter).  Pairs inside a component cannot change it and are not looked at.
6. Components by large-star and small-star steps over the links.

No group is collected: copies are aggregated before the shuffle, stars and differences are joins that
adaptive execution can split.  Nothing but counts reaches the driver.  Steps are written to the shared folder, which cuts the lineage.

Defined results: NULL or empty text (no word) has an empty set and links with nothing; a text of
fewer than ``words`` words is one shingle.  A row without key links with nothing, its component is
NULL and it is kept.  Rows that repeat a key count as one document with several texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vitrina.llm.pieces import release_encoders, small_runs
from vitrina.session import materialize

PLACES, CHUNKS, ERRORS = 64, 13, 25
BITMAP = 16  # 64-bit words of the bitmap of a node's differences
BROADCAST_IDS = 1_000_000  # keys of 8 bytes: what a broadcast of this many holds is bounded

_MIX = np.uint64(0x9E3779B97F4A7C15)
_RNG = np.random.default_rng(20240229)
_XOR = _RNG.integers(0, 2**64, PLACES, np.uint64)
_MUL = _RNG.integers(0, 2**63, PLACES, np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: list, words: int = 4) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    import xxhash

    for a, b in small_runs(texts):
        arr = pc.ascii_split_whitespace(pc.ascii_lower(pa.array([t or "" for t in texts[a:b]], pa.large_string())))
        flat = arr.flatten()
        coded = flat.dictionary_encode()
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
        h = hashes[coded.indices.to_numpy()]
        real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
        offsets = np.concatenate([[0], np.cumsum(real)])[arr.offsets.to_numpy()]
        h = h[real]
        n = len(h)
        rolled = h[:max(0, n - words + 1)].copy()
        for j in range(1, words):
            rolled *= _MIX
            rolled += h[j:n - words + 1 + j]
        rolled = _mix(rolled)
        for row in range(b - a):
            s, e = int(offsets[row]), int(offsets[row + 1])
            if e - s >= words:
                yield np.unique(rolled[s:e - words + 1])
            elif e > s:
                whole = np.array([e - s], np.uint64)
                for k in range(s, e):
                    whole = whole * _MIX + h[k:k + 1]
                yield _mix(whole)
            else:
                yield np.empty(0, np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, PLACES) 16-bit signatures of non-empty sets."""
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    flat = np.concatenate(sets)
    out = np.empty((len(sets), PLACES), np.uint16)
    for k in range(PLACES):
        least = np.minimum.reduceat((flat ^ _XOR[k]) * _MUL[k], starts)
        out[:, k] = (_mix(least) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def chunk_keys(sig: np.ndarray) -> np.ndarray:
    """(nodes, PLACES) 64-bit keys: of each place, its chunk without it."""
    out = np.empty((len(sig), PLACES), np.uint64)
    wide = sig.astype(np.uint64)
    for c, places in enumerate(np.array_split(np.arange(PLACES), CHUNKS)):
        for left_out in places:
            key = np.full(len(sig), (c << 8) | int(left_out), np.uint64)
            for p in places:
                if p != left_out:
                    key = _mix(key * _MIX + wide[:, p] + np.uint64(1))
            out[:, left_out] = key
    return out


def document_sets(df: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, set_key (NULL: empty set), sig of every row."""
    import xxhash

    src = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = to_arrow_type(src.schema["id"].dataType)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()
        for batch in (b.slice(at, 1024) for b in batches for at in range(0, b.num_rows, 1024)):
            found = list(shingle_sets(batch.column(1).to_pylist(), words))
            full = [k for k, s in enumerate(found) if len(s)]
            keys: list = [None] * len(found)
            sigs: list = [None] * len(found)
            ends = np.cumsum([len(found[k]) for k in full])
            for run in np.split(np.array(full, int), np.flatnonzero(np.diff(ends // 1_000_000)) + 1) if full else ():
                for k, sig in zip(run, signatures([found[k] for k in run])):
                    keys[k], sigs[k] = xxhash.xxh3_128_digest(found[k].tobytes()), sig.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(id_type), pa.array([len(s) for s in found], pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(sigs, pa.binary())], names=["id", "n_shingles", "set_key", "sig"])

    return src.mapInArrow(sets, f"id {src.schema['id'].dataType.simpleString()}, n_shingles bigint, set_key binary, sig binary")


def _key_rows(nodes: DataFrame) -> DataFrame:
    """key, node: the 64 keys of every node."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                sig = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16).reshape(-1, PLACES)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chunk_keys(sig).view(np.int64).ravel()), pa.array(np.repeat(part.column(0).to_numpy(), PLACES))],
                    names=["key", "node"])

    return nodes.select("node", "sig").mapInArrow(keys, "key bigint, node bigint")


def _within(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures differ in at most ERRORS places."""
    sig = nodes.select(F.col("node"), "sig")
    rows = (pairs.join(sig.toDF("a", "sig_a"), "a").join(sig.toDF("b", "sig_b"), "b").select("a", "b", "sig_a", "sig_b"))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, PLACES) for c in (2, 3))
            ok = pa.array((x != y).sum(axis=1) <= ERRORS)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], names=["a", "b"])

    return rows.mapInArrow(near, "a bigint, b bigint")


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full sets are alike: 100 |A and B| >= percent |A or B|."""
    rows = (pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
            .select("a", "b", "text_a", "text_b"))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                both = part.column(2).to_pylist() + part.column(3).to_pylist()
                place = {t: k for k, t in enumerate(dict.fromkeys(both))}  # a hub's set is made once
                sets = list(shingle_sets(list(place), words))
                ok = []
                for t, u in zip(both[:part.num_rows], both[part.num_rows:]):
                    x, y = sets[place[t]], sets[place[u]]
                    inter = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(100 * inter >= percent * (len(x) + len(y) - inter))
                mask = pa.array(ok, pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(0).filter(mask), part.column(1).filter(mask)], names=["a", "b"])

    return rows.mapInArrow(confirm, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of all nodes with a link (a, b): alternating
    large-star and small-star steps, each written before the next."""
    def written(edges: DataFrame) -> tuple[DataFrame, dict]:
        """The edges and their number and hash, observed while they are written."""
        seen = Observation()
        mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        edges = materialize(edges.distinct().observe(seen, F.count(F.lit(1)).alias("n"), mark.alias("mark")), "cc")
        return edges, seen.get

    edges, state = written(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    before = None
    while True:
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = state
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges, state = written(small.union(smallest.select("u", F.col("m").alias("v"))))


def _labelled(nodes: DataFrame, labels: DataFrame, node: str = "node", out: str = "component") -> DataFrame:
    named = labels.select(F.col("node").alias(node), F.col("component").alias(f"__{out}"))
    return nodes.join(named, node, "left").withColumn(out, F.coalesce(f"__{out}", node)).drop(f"__{out}")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) that lie in different components."""
    both = _labelled(_labelled(pairs, labels, "a", "ca"), labels, "b", "cb")
    return both.filter("ca <> cb").select("a", "b")


def signed_difference(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """The elements of x that the centre lacks (even) and those of the centre that x lacks (odd)."""
    one = np.uint64(1)
    more, less = np.setdiff1d(x, centre, assume_unique=True), np.setdiff1d(centre, x, assume_unique=True)
    return np.concatenate([more & ~one, less | one]).view(np.int64)


def bitmap(d: np.ndarray) -> np.ndarray:
    """Bits of the (well mixed) elements, as BITMAP 64-bit words."""
    bits = np.zeros(64 * BITMAP, np.uint8)
    bits[(d.view(np.uint64) >> np.uint64(1)) % np.uint64(64 * BITMAP)] = 1
    return np.packbits(bits).view(np.int64)


def _differences(groups: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """grp, node, variant, n, n_centre, d, bits of every text of the nodes (node, grp): its set as a
    difference from the set of the group's centre (of a key with several texts: the least)."""
    centres = texts.join(groups.select(F.col("grp").alias("node")).distinct(), "node", "left_semi")
    centres = centres.groupBy(F.col("node").alias("grp")).agg(F.min("text").alias("centre"))
    rows = groups.join(texts, "node").join(centres, "grp").select("grp", "node", F.xxhash64("text").alias("variant"), "text", "centre")

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
            mine, centre = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            place = {t: k for k, t in enumerate(dict.fromkeys(centre))}  # a centre's set is made once
            centres = list(shingle_sets(list(place), words))
            sets = list(shingle_sets(mine, words))
            both = [(x, centres[place[c]]) for x, c in zip(sets, centre)]
            found = [signed_difference(x, c) for x, c in both]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(3)), pa.array([len(x) for x, _ in both], pa.int64()),
                 pa.array([len(c) for _, c in both], pa.int64()), pa.array(found, pa.list_(pa.int64())),
                 pa.array([bitmap(d) for d in found], pa.list_(pa.int64()))],
                names=["grp", "node", "variant", "n", "n_centre", "d", "bits"])

    return rows.mapInArrow(differ, "grp bigint, node bigint, variant bigint, n bigint, n_centre bigint, d array<bigint>, "
                                   "bits array<bigint>")


def _weighed(differences: DataFrame, percent: int) -> DataFrame:
    """With a and h (in units of 1 / (100 + percent)) and apart: not alike to the centre, a > h."""
    more, less = 100 + percent, 100 - percent
    a = F.size("d") * F.lit(more) - F.col("n") * less
    return differences.withColumn("a", a).withColumn("h", F.col("n_centre") * less).withColumn("apart", F.col("a") > F.col("h"))


def _prefixes(weighed: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """grp, diff, node, component, n, a, size, apart, place, far, near, w0...: the differences that a node must
    share one of, by place in the order (rarest in the group first).  A partner beyond the centre shares one of the
    first ``far``; one alike to the centre (only for a node that is beyond) one of the first ``near``."""
    named = _labelled(weighed, labels)
    spread = named.groupBy("grp").agg(F.min("component").alias("x"), F.max("component").alias("y"),
                                      F.min(F.when(~F.col("apart") & (F.size("d") > 0), F.col("a"))).alias("low"))
    unit = 2 * (100 + percent)
    least = lambda c: F.size("d") + 1 - F.greatest(F.lit(1), F.ceil(c / F.lit(unit)))
    rows = named.join(spread.filter("x <> y").select("grp", "low"), "grp").withColumn("far", least(F.col("a") + F.col("h") + 1))
    rows = rows.withColumn("near", F.when(F.col("apart") & F.col("low").isNotNull(), least(F.col("a") + F.col("low"))).otherwise(0))
    words = [F.col("bits")[k].alias(f"w{k}") for k in range(BITMAP)]
    rows = rows.select("grp", "node", "variant", "component", "n", "a", F.size("d").alias("size"), "apart", "far", "near", *words,
                       F.explode("d").alias("diff"))
    common = rows.groupBy("grp", "diff").agg(F.count(F.lit(1)).alias("many")).filter("many > 1")
    order = Window.partitionBy("grp", "node", "variant").orderBy(F.coalesce("many", F.lit(1)), "diff")  # one text's differences
    rows = rows.join(common, ["grp", "diff"], "left").withColumn("place", F.row_number().over(order))
    return rows.filter("many > 1 AND place <= greatest(far, near)").drop("many", "variant")


def _meeting(prefixes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs (a, b) of different components: each node with the smallest one that has the
    difference too; all pairs that share a difference within their bounds."""
    own = [c for c in prefixes.columns if c not in ("grp", "diff")]
    x, y = (prefixes.select("grp", "diff", *(F.col(c).alias(side + c) for c in own)) for side in "xy")
    alone = [sum((F.bit_count(F.col(f"{p}w{k}").bitwiseAND(F.bitwise_not(F.col(f"{q}w{k}")))) for k in range(BITMAP)), F.lit(0))
             for p, q in ("xy", "yx")]
    most = F.least(F.col("xsize") - alone[0], F.col("ysize") - alone[1])  # differences in common, at most
    differ = (F.col("xcomponent") != F.col("ycomponent")) & (most * (2 * (100 + percent)) >= F.col("xa") + F.col("ya"))
    least = prefixes.groupBy("grp", "diff").agg(F.min(F.struct("node", *(c for c in own if c != "node"))).alias("m"))
    least = least.select("grp", "diff", *(F.col(f"m.{c}").alias("y" + c) for c in own))
    meet = (F.col("xgrp") == F.col("grp")) & (F.col("xdiff") == F.col("diff"))
    x = x.withColumnsRenamed({"grp": "xgrp", "diff": "xdiff"})
    stars = x.join(least, meet & (F.col("xnode") != F.col("ynode")) & differ)
    beyond = F.col("yapart") & (F.col("xplace") <= F.col("xfar")) & (F.col("xnode") < F.col("ynode"))
    close = ~F.col("yapart") & (F.col("xplace") <= F.col("xnear"))
    # All that two alike texts share lies at their first shared difference or after it, in both.
    after = F.least(F.col("xsize") - F.col("xplace"), F.col("ysize") - F.col("yplace")) + 1
    enough = after * (2 * (100 + percent)) >= F.col("xa") + F.col("ya")
    pairs = x.filter("xapart").join(y.filter("yplace <= yfar"), meet & (beyond | close) & enough & differ)
    return tuple(f.select(F.least("xnode", "ynode").alias("a"), F.greatest("xnode", "ynode").alias("b")).distinct()
                 for f in (stars, pairs))


def near_duplicates(df: DataFrame, words: int = 4, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """id_col, n_shingles, component_id, kept for every row of ``df``."""
    sets = materialize(document_sets(df.select(F.col(id_col).cast("long").alias(id_col), text_col), words, id_col, text_col), "sets")
    nodes = materialize(sets.filter("id IS NOT NULL AND set_key IS NOT NULL").groupBy("set_key")
                        .agg(F.min("id").alias("node"), F.min("sig").alias("sig")), "nodes")
    keys = _key_rows(nodes)
    hubs = keys.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    stars = materialize(keys.join(hubs, "key").filter("node <> hub").select("key", "node", "hub", "n"), "stars")
    pairs = materialize(_within(stars.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), nodes), "pairs")

    # The texts that any pair may need: of all nodes that share a key with another.
    wanted = stars.select("node").union(stars.select("hub")).distinct()
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    texts = df.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).cast("string").alias("text"))
    texts = materialize(texts.join(wanted, "node", "left_semi"), "texts")

    first = pairs.groupBy("b").agg(F.min("a").alias("a"))
    links = [materialize(_confirmed(first, texts, words, percent), "links")]
    labels = materialize(components(links[0]), "labels")
    links.append(materialize(_confirmed(_apart(pairs, labels), texts, words, percent), "links"))
    labels = materialize(components(reduce(DataFrame.union, links)), "labels")

    # Keys whose nodes, without the hub, are in different components, and the groups that they make.
    others = stars.filter("n > 2").select("key", "node")
    open_keys = _labelled(others, labels).groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"),
                                                             F.min("node").alias("least")).filter("x <> y")
    ties = materialize(others.join(open_keys.select("key", "least"), "key")
                       .select(F.col("node").alias("a"), F.col("least").alias("b")).filter("a <> b").distinct(), "ties")
    if not ties.isEmpty():
        def joined(labels: DataFrame, more: DataFrame) -> DataFrame:
            links.append(materialize(more, "links"))
            return labels if links[-1].isEmpty() else materialize(components(reduce(DataFrame.union, links)), "labels")

        groups = components(ties).select("node", F.col("component").alias("grp"))
        weighed = _weighed(materialize(_differences(groups, texts, words), "differences"), percent)
        close = weighed.filter("NOT apart AND node <> grp").select(F.col("grp").alias("a"), F.col("node").alias("b"))
        labels = joined(labels, _apart(close, labels))
        for turn in range(2):
            prefixes = materialize(_prefixes(weighed, labels, percent), "prefixes")
            if prefixes.isEmpty():
                break
            labels = joined(labels, _confirmed(_meeting(prefixes, percent)[turn], texts, words, percent))

    named = _labelled(nodes.select("set_key", "node"), labels).select("set_key", "component")
    rows = sets.select("id", "n_shingles", "set_key").join(named, "set_key", "left")
    component = F.coalesce("component", "id")
    return rows.select(F.col("id").alias(id_col), "n_shingles",
                       F.when(F.col("id").isNotNull(), component).alias("component_id"),
                       F.when(F.col("id").isNotNull(), F.col("id") == component).otherwise(F.lit(True)).alias("kept"))


def without_near_duplicates(df: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                            text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay: of each group of near-duplicates its smallest key."""
    gone = near_duplicates(df, words, percent, id_col, text_col).filter(~F.col("kept")).select(F.col(id_col).alias("__gone"))
    gone = materialize(gone.distinct(), "gone")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return df.join(gone, df[id_col].cast("long") == F.col("__gone"), "left_anti")
