"""Best-fit packing with certified bin counts.

Documents become pieces of at most ``capacity`` tokens; pieces are packed into
sequences of that capacity.

1. Pieces are dealt by hash into partitions of about ``per_part`` pieces, and
   each partition is packed by best-fit decreasing (an item goes into the fullest
   bin that still takes it; a bit mask over the free spaces finds that bin).
2. Dual-feasible functions give each partition a lower bound on its bins (the
   threshold family and the rounding family; the best of them counts).  A bin
   count that equals the bound is certified: no packing of those pieces is better.
3. A partition with a gap releases all its bins that are not full; a certified one
   only its emptiest bin (rounding up may have cost it one).  Released bins are
   dealt anew, whole, by a new hash into as many partitions as hold about
   ``per_part`` pieces each, and packed again.  A partition keeps its old bins
   where the new packing has no fewer.  This goes on until nothing is left, one
   such partition held all that was left, or a round neither saves one bin of
   ``GAIN`` nor leaves fewer partitions.  So the groups stay of one size however
   far best fit ends from the bound; then a gap remains.

Each round touches only released bins and is written to the shared folder, so a
lost executor repeats one round at most.  Only lengths and keys travel, no text.

Defined results: NULL or empty text is one piece with the end id alone.  Repeated
or NULL keys are packed like any others, row by row.  Empty table: no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitrina.llm.pieces import WordEncoder, encode_texts, worker_encoder
from vitrina.session import materialize

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PER_PART = 2048
GAIN = 1000  # a round must save one of so many bins, else it is the last


def token_pieces(df: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1,
                 id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Every text's ids with ``end_id``, cut into pieces of at most ``capacity`` tokens."""
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = PIECES + (", ids binary" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(WordEncoder, tokenizer_path)
        for batch in batches:
            rows: list[tuple] = []
            for key, ids in zip(batch.column(0).to_pylist(), encode_texts(encoder, batch.column(1).to_pylist())):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at:at + capacity].tobytes()
                    rows.append((key, k, at, len(part) // 4, zlib.crc32(part), *([part] if with_ids else [])))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = list(zip(*rows)) or [()] * (5 + with_ids)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             names=[f.split()[0] for f in schema.split(", ")])

    return src.mapInArrow(cut, schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin of each item, offset in it, number of bins)."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by their free space
    mask, n = 0, 0  # bit r: some bin has r free
    for k in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[k])
        fits = mask >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            b = free[space].pop()
            if not free[space]:
                mask &= ~(1 << space)
        else:
            space, b, n = capacity, n, n + 1
        bins[k], offsets[k] = b, capacity - space
        left = space - size
        if left:
            free[left].append(b)
            mask |= 1 << left
    return bins, offsets, n


def lower_bound(lengths: np.ndarray, capacity: int, families: int = 64) -> int:
    """Fewest bins any packing needs, by dual-feasible functions: f with sum f(x) <= 1 over every
    feasible bin, so the sum of f over all items bounds the bins from below.

    Thresholds e: items over capacity - e count 1, items under e count 0, others their share.
    Rounding k: x (k + 1) / capacity is rounded down and divided by k, unless it is whole."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    below, share = np.concatenate([[0], np.cumsum(count)]), np.concatenate([[0], np.cumsum(count * x)])
    e = np.arange(0, capacity // 2 + 1)
    large = below[-1] - below[capacity - e + 1]
    middle = share[capacity - e + 1] - share[e]
    best = int((large + -(-middle // capacity)).max())
    for k in range(1, families + 1):
        scaled = x * (k + 1)
        whole = scaled % capacity == 0
        # in units of 1 / (capacity k): exact integers
        value = np.where(whole, x * k, scaled // capacity * capacity)
        best = max(best, int(-(-int((count * value).sum()) // (capacity * k))))
    return best


def _repack(capacity: int, first: bool):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "start", "ids_crc32"], kind="stable").reset_index(drop=True)
        lengths = pdf["length"].to_numpy()
        bins, offsets, n = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(lengths, capacity)
        if not first and n >= pdf["sequence_id"].nunique():  # not better: the old bins stay
            offsets = pdf["offset"].to_numpy()
            bins, old = pd.factorize(pdf["sequence_id"])
            n = len(old)
        fill = np.bincount(bins, weights=lengths, minlength=n)
        released = fill < capacity
        if n == bound and released.any():
            released = np.arange(n) == int(fill.argmin())
        pdf["offset"] = offsets
        pdf["sequence_id"] = pdf["part"].to_numpy() * (1 << 24) + bins
        pdf["open"] = released[bins]
        return pdf

    return pack


def pack(pieces: DataFrame, capacity: int = 4096, per_part: int = PER_PART, rounds: int = 8) -> DataFrame:
    """PIECES rows with sequence_id and offset.  ``rounds`` bounds the exchanges, not the rows."""
    schema = f"{PIECES}, part bigint, sequence_id bigint, offset bigint, open boolean"
    names = [f.split()[0] for f in PIECES.split(", ")]
    todo = materialize(pieces.select(*names), "pack-pieces")
    n = todo.count()
    parts = max(1, -(-n // per_part))
    done: list[DataFrame] = []
    # With the row's place in the written table: rows alike in every column are dealt too.
    dealt = F.pmod(F.xxhash64(*names, F.monotonically_increasing_id()), F.lit(parts))
    used = 0  # partition numbers of earlier rounds, so sequence ids never meet
    bins = None  # bins dealt into the round
    for turn in range(rounds):
        rows = todo.withColumn("part", dealt + F.lit(used))
        if turn == 0:
            rows = rows.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long"))
        rows = rows.select(*names, "part", "sequence_id", "offset", F.lit(False).alias("open"))
        packed = materialize(rows.groupBy("part").applyInPandas(_repack(capacity, turn == 0), schema), "pack-round")
        done.append(packed.filter(~F.col("open")))
        todo = packed.filter("open")
        by_bin = packed.groupBy("sequence_id").agg(F.max("open").alias("open"), F.count(F.lit(1)).alias("n"))
        total, open_bins, left = by_bin.agg(F.count(F.lit(1)), F.count_if("open"), F.sum(F.when(F.col("open"), F.col("n")))).first()
        left = left or 0
        needed = -(-left // per_part)
        gained = bins is None or (bins - total) * GAIN >= max(bins, 1)
        if parts == 1 or not left or not (gained or needed < parts):
            done.append(todo)
            break
        used, bins = used + parts, open_bins
        parts = needed
        dealt = F.pmod(F.xxhash64("sequence_id", F.lit(turn)), F.lit(parts))
    else:
        done.append(todo)
    out = done[0]
    for d in done[1:]:
        out = out.union(d)
    return out.select(*names, "sequence_id", "offset")


def packed_sequences(layout: DataFrame, pieces_with_ids: DataFrame) -> DataFrame:
    """sequence_id, ids (little-endian 32 bits), n_tokens, doc_ids in order.  A sequence holds at
    most ``capacity`` tokens, so a group is bounded."""
    keys = ["doc_id", "piece", "start", "ids_crc32"]
    ids = pieces_with_ids.select(*keys, "ids").dropDuplicates(keys)
    same = [layout[k].eqNullSafe(ids[k]) for k in keys]
    rows = layout.join(ids, same).select("sequence_id", "offset", layout["doc_id"], "length", "ids")
    return rows.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("s"), F.sum("length").alias("n_tokens")
    ).select("sequence_id", "n_tokens", F.col("s.doc_id").alias("doc_ids"),
             F.aggregate("s.ids", F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"))
