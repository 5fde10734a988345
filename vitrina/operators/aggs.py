"""Aggregate expressions of the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_if(cond: Column) -> Column:
    """COUNT(CASE WHEN cond THEN 1 END): NULL conditions do not count."""
    return F.count(F.when(cond, F.lit(1)))


def capped_count(real: Column, extra: Column, cap: int) -> Column:
    """CASE WHEN real > cap THEN cap + extra ELSE real END, over aggregates.

    Below the cap ``extra`` is *not* added (it is already inside ``real``
    when the extra rows also match).
    """
    return F.when(real > F.lit(cap), F.lit(cap) + extra).otherwise(real)


def column_widths(df: DataFrame, group: list[str] | None = None,
                  columns: list[str] | None = None, pad: int = 2) -> DataFrame:
    """Display width per column (per group): max(len(header), max len(text)) + pad.

    One aggregation pass over the data (map-side partial max), then the wide
    result is turned into (column_name, width) rows.  NULL counts as length 0.
    """
    group = group or []
    cols = columns or [c for c in df.columns if c not in group]
    aggs = [F.greatest(F.lit(len(c)), F.coalesce(F.max(F.length(F.col(c).cast("string"))), F.lit(0)))
            .alias(f"_w{i}") for i, c in enumerate(cols)]
    wide = df.groupBy(*group).agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_w{i}").alias("w"))
                      for i, c in enumerate(cols)])
    return (wide.select(*group, F.inline(pairs))
                .select(*group, "column_name", (F.col("w") + pad).alias("width")))
