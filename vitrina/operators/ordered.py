"""Operators over ordered rows (spreadsheet order by an integer id).

``carry_last`` gives each row the value of the last marked row at or before
it (a section header carried down to its rows, i.e. an as-of lookup).  SQL
writes it as a self join on ``id >= sep.id AND id < next_sep`` (a nested loop
join) or as one window over the whole sheet (a single task).  Here the order
is cut into buckets of at most 2^bits consecutive ids; there are three small
windows, and the data is shuffled once:

1. inside a bucket: running last marked value (window per bucket);
2. per bucket: its last marked value, carried across buckets of the same
   super-bucket (2^bits buckets) by a window over the bucket summary;
3. per super-bucket: carried across super-buckets by a window over that
   (at most 2^(64-2*bits) rows for 64-bit ids).

Ids may repeat, and may be NULL.  A row needs the marks before it, not the rows: a bucket with more
than ``MAX_ROWS`` rows is dealt by row number into parts, each with a copy of the bucket's marks
(at most one for each distinct id).  Rows without an id have no answer and are dealt alike.  So every
window partition is bounded no matter how ids are spread, how often one repeats or how
big one ``by`` group (a month) is, and the answer does not depend on the dealing: marks with
the same id count as one, with the greatest value.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_BITS = 20
MAX_ROWS = 1 << 21
UNORDERED_PARTS = 256


def carry_last(df: DataFrame, order: str, value: Column, out: str,
               by: Iterable[str] = (), strict: bool = False,
               bits: int = BUCKET_BITS, max_rows: int = MAX_ROWS) -> DataFrame:
    """Add ``out``: the non-NULL ``value`` of the last row (same ``by``) whose
    ``order`` is <= this row's (< with ``strict``); NULL before the first.  Of several
    values at that ``order`` the greatest.

    ``order`` must be an integer column; NULL orders get NULL.
    """
    by = list(by)
    o = F.col(order)
    x = (df.withColumn("_cl_v", value)
           .withColumn("_cl_m", F.when(F.col("_cl_v").isNotNull() & o.isNotNull(), F.struct(o.alias("o"), F.col("_cl_v").alias("v"))))
           .withColumn("_cl_b1", F.shiftright(o, bits)))

    # bucket summary: rows and last mark of each bucket
    s1 = x.groupBy(*by, "_cl_b1").agg(F.max("_cl_m").alias("_cl_l1"), F.count(F.lit(1)).alias("_cl_n"))
    large = s1.where((F.col("_cl_n") > max_rows) & F.col("_cl_b1").isNotNull()).select(
        *[F.col(c).alias(f"_cl_k{i}") for i, c in enumerate(by)], F.col("_cl_b1").alias("_cl_kb"),
        F.ceil(F.col("_cl_n") / max_rows).cast("int").alias("_cl_parts"))
    large = F.broadcast(large)  # at most one row for each max_rows rows
    here = [F.col(c).eqNullSafe(F.col(f"_cl_k{i}")) for i, c in enumerate(by)] + [F.col("_cl_b1") == F.col("_cl_kb")]
    names = [f"_cl_k{i}" for i in range(len(by))] + ["_cl_kb", "_cl_parts"]

    # rows dealt into the parts of their bucket, and the marks copied into each part of a large one
    deal = F.xxhash64(F.monotonically_increasing_id())
    rows = (x.join(large, here, "left")
             .withColumn("_cl_part", F.pmod(deal, F.when(o.isNull(), F.lit(UNORDERED_PARTS)).otherwise(F.coalesce("_cl_parts", F.lit(1)))))
             .drop(*names).withColumn("_cl_copy", F.lit(False)))
    marks = (x.where(F.col("_cl_m").isNotNull()).groupBy(*by, "_cl_b1", order).agg(F.max("_cl_m").alias("_cl_m"))
              .join(large, here, "inner")
              .withColumn("_cl_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_cl_parts").cast("bigint") - 1))).drop(*names))
    marks = marks.select(*[F.col(f.name) if f.name in (*by, order) else F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema],
                         F.lit(None).cast(x.schema["_cl_v"].dataType).alias("_cl_v"), "_cl_m", "_cl_b1", "_cl_part",
                         F.lit(True).alias("_cl_copy"))
    up_to = -1 if strict else Window.currentRow
    w1 = (Window.partitionBy(*by, "_cl_b1", "_cl_part").orderBy(o)
          .rangeBetween(Window.unboundedPreceding, up_to))
    rows = rows.unionByName(marks).withColumn("_cl_a", F.max("_cl_m").over(w1)).where(~F.col("_cl_copy"))

    # marks carried over earlier buckets of a super-bucket
    s1 = s1.withColumn("_cl_b2", F.shiftright(F.col("_cl_b1"), bits))
    w2 = (Window.partitionBy(*by, "_cl_b2").orderBy("_cl_b1")
          .rowsBetween(Window.unboundedPreceding, -1))
    s1 = s1.withColumn("_cl_b", F.max("_cl_l1").over(w2))

    # super-bucket summary, carried over earlier super-buckets
    s2 = s1.groupBy(*by, "_cl_b2").agg(F.max("_cl_l1").alias("_cl_l2"))
    w3 = Window.partitionBy(*by).orderBy("_cl_b2").rowsBetween(Window.unboundedPreceding, -1)
    s2 = s2.select(*by, "_cl_b2", F.max("_cl_l2").over(w3).alias("_cl_c"))

    carry = (s1.join(s2, [*by, "_cl_b2"], "left").join(large, here, "left")
               .select(*by, "_cl_b1", F.coalesce("_cl_b", "_cl_c").alias("_cl_in"),
                       F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_cl_parts", F.lit(1)).cast("bigint") - 1)).alias("_cl_part")))
    res = rows.join(carry, [*by, "_cl_b1", "_cl_part"], "left")  # partitioned as the windows are
    res = res.withColumn(out, F.when(o.isNotNull(), F.coalesce("_cl_a", "_cl_in")["v"]))
    return res.select(*df.columns, out)


def section_carry(df: DataFrame, order: str, is_header: Column, value: str, out: str,
                  by: Iterable[str] = (), bits: int = BUCKET_BITS) -> DataFrame:
    """Each row gets ``value`` of the last header row at or before it (NULL
    before the first header); header rows get their own value."""
    return carry_last(df, order, F.when(is_header, F.col(value)), out, by=by, bits=bits)


def next_marker(df: DataFrame, order: str, is_marker: Column, out: str,
                by: Iterable[str] = (), bits: int = BUCKET_BITS) -> DataFrame:
    """LEAD over the marked rows: ``order`` of the next marked row strictly
    after this one (NULL for the last).  Computed as a carry in reversed order."""
    neg = "_nm_neg"
    x = df.withColumn(neg, -F.col(order))
    x = carry_last(x, neg, F.when(is_marker, F.col(order)), out, by=by, strict=True, bits=bits)
    return x.drop(neg)
