"""Bracket (inclusive range) lookups that do not multiply rows.

A bracket sheet (keys, start, end, values...) may have overlapping or gapped
ranges; the SQL left join then repeats a row once per matching bracket.  For
roll-ups only the number of matches and the sums of the matched values
matter, so the sheet is first cut into *elementary intervals*: between
consecutive boundary points the set of covering brackets is constant, and
each interval carries ``n`` (brackets covering it) and the sum of every
value column.  A measure then falls into at most one interval, so the lookup
keeps one row per input row and can feed a single aggregation.

All steps run on the bracket sheet itself and are linear in it.  Measures are
integers (reach and counts); bounds and values may be decimals: [s, e] covers the
integers from ceil(s) to floor(e), and values keep their type, so sums are exact.

Small sheets (checked by bytes) are broadcast.  Larger ones are matched by an equi-join:
each range is cut into aligned blocks of 2^level integers (at most two of a level, so at
most 2 log2(length) of them), and a measure lies in exactly one block of each level, the one
numbered ``measure >> level``.  The blocks of a range do not overlap, so a measure and a range
that match meet under exactly one (keys, level, block): no residual condition, no duplicate, and no
range, however long, makes the others coarser.  Measures are listed once for each distinct
(keys, measure) and level in use; the rows find their matches by (keys, measure).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrina.operators.broadcast import BRACKET_MAX_BYTES, fits
from vitrina.session import materialize


def shifted(value: Column, level: Column) -> Column:
    """``value >> level`` of 64-bit integers (rounding down)."""
    return F.call_function("shiftright", value.cast("bigint"), level.cast("int"))


def dyadic_blocks(ranges: DataFrame, lo: str, hi: str, level: str = "_level", block: str = "_block") -> DataFrame:
    """``ranges`` once for each aligned block of the integers in [lo, hi].

    With l = ceil(lo / 2^k) and r = floor((hi + 1) / 2^k), as long as l < r: the block l belongs to the
    range if l is odd (its neighbour l - 1 begins before the range), and the block r - 1 if r is odd."""
    first, past = F.ceil(F.col(lo)).cast("bigint"), (F.floor(F.col(hi)) + 1).cast("bigint")
    k = F.col(level)
    left, right = -shifted(-first, k), shifted(past, k)
    odd = lambda c: F.pmod(c, F.lit(2)) == 1
    ends = F.filter(F.array(F.when(odd(left), left), F.when(odd(right), right - 1)), lambda b: b.isNotNull())
    length = F.greatest(past.cast("double") - first.cast("double"), F.lit(1.0))
    top = F.least(F.floor(F.log2(length)).cast("int") + 1, F.lit(62))
    return (ranges.where(first < past).withColumn(level, F.explode(F.sequence(F.lit(0), top)))
            .where(left < right).withColumn(block, F.explode(ends)))


def range_matches(left: DataFrame, ranges: DataFrame, measure: str, lo: str, hi: str,
                  keys: Iterable[str]) -> DataFrame:
    """(keys..., measure, columns of ``ranges`` but its keys): one row for each distinct (keys,
    measure) of ``left`` and each range of the same keys that holds it."""
    keys = list(keys)
    points = left.select(*keys, measure).where(F.col(measure).isNotNull()).distinct()
    blocks = dyadic_blocks(ranges, lo, hi)
    levels = blocks.select(F.collect_set("_level")).scalar()
    points = points.withColumn("_level", F.explode(levels)).withColumn("_block", shifted(F.col(measure), F.col("_level")))
    return points.join(blocks, [*keys, "_level", "_block"], "inner").drop("_level", "_block")


def elementary_intervals(brackets: DataFrame, start: str, end: str, values: Iterable[str],
                         keys: Iterable[str] = ("grade", "currency")) -> DataFrame:
    """(keys..., lo, hi, n, values...) with non-overlapping [lo, hi] per key.

    A sweep, linear in the sheet: each bracket adds +1 (and +value) at its
    start and -1 (and -value) just past its end; running sums over the
    sorted boundary points give, for each interval up to the next point, the
    number of covering brackets and their value sums.  Uncovered gaps are
    dropped (a lookup there finds nothing, as in the join).
    """
    keys, values = list(keys), list(values)
    first, last = F.ceil(F.col(start)).cast("bigint"), F.floor(F.col(end)).cast("bigint")
    b = brackets.where(first <= last)  # drops NULL bounds and ranges that hold no integer
    ups = b.select(*keys, first.alias("p"), F.lit(1).alias("dn"), *values)
    downs = b.select(*keys, (last + 1).alias("p"), F.lit(-1).alias("dn"),
                     *[(-F.col(v)).alias(v) for v in values])
    deltas = (ups.unionByName(downs).groupBy(*keys, "p")
                 .agg(F.sum("dn").alias("dn"), *[F.sum(F.coalesce(F.col(v), F.lit(0))).alias(v)
                                                 for v in values]))
    w = Window.partitionBy(*keys).orderBy("p")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    iv = deltas.select(*keys, F.col("p").alias("lo"), (F.lead("p").over(w) - 1).alias("hi"),
                       F.sum("dn").over(run).alias("n"),
                       *[F.sum(v).over(run).alias(v) for v in values])
    return iv.where(F.col("hi").isNotNull() & (F.col("n") > 0))


def interval_lookup(left: DataFrame, intervals: DataFrame, measure: str, take: dict[str, str],
                    count_as: str, keys: Iterable[str] = ("grade", "currency"),
                    broadcast: bool | None = None) -> DataFrame:
    """Left lookup of ``measure`` in the elementary intervals: ``count_as`` =
    number of brackets matching (0 if none), ``take`` = sums of their values
    (0 if none).  One output row per input row.  ``broadcast=None`` checks the size."""
    keys = list(keys)
    p = "_iv_"
    if broadcast is None:
        broadcast = fits(intervals, BRACKET_MAX_BYTES)
    r = intervals.select(*[F.col(k).alias(p + k) for k in keys], F.col("lo").alias(p + "lo"),
                         F.col("hi").alias(p + "hi"), F.col("n").alias(p + "n"),
                         *[F.col(c).alias(p + "v_" + c) for c in take])
    j = range_join(left, r, measure, p + "lo", p + "hi", {k: p + k for k in keys}, broadcast, known=True)
    return j.select(*[F.col(c) for c in left.columns],
                    F.coalesce(F.col(p + "n"), F.lit(0)).alias(count_as),
                    *[F.coalesce(F.col(p + "v_" + c), F.lit(0)).alias(o) for c, o in take.items()])


def range_join(left: DataFrame, ranges: DataFrame, measure: str, lo: str, hi: str, keys: dict[str, str],
               broadcast: bool, known: bool = False) -> DataFrame:
    """Left join of rows to the ranges [lo, hi] that hold ``measure``; ``keys`` pairs key columns of
    left and ranges (whose column names do not clash).  Broadcast with the range as residual
    condition, or by dyadic blocks.  ``known``: the matches are written first, so that their size is known and the
    rows need no exchange where they are few (ranges without overlap: one match for each distinct measure)."""
    if broadcast:
        cond = [F.col(k) == F.col(r) for k, r in keys.items()] + [F.col(measure).between(F.col(lo), F.col(hi))]
        return left.join(F.broadcast(ranges), cond, "left")
    m = "_rj_measure"
    points = left.select(*[F.col(k).alias(r) for k, r in keys.items()], F.col(measure).alias(m))
    found = range_matches(points, ranges, m, lo, hi, keys.values())
    if known:
        found = materialize(found, "matches")
    return left.join(found, [F.col(k) == F.col(r) for k, r in keys.items()] + [F.col(measure) == F.col(m)], "left").drop(m)
