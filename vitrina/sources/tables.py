"""Parquet table reader with column pruning at the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.operators.broadcast import estimated_bytes

SPREAD_MAX_BYTES = 4 << 30
DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.parquet"


def spread(df: DataFrame) -> DataFrame:
    """Spread an under-split scan over all cores.

    A file written as one row group is one read task however large it is, so
    every per-row expression above it runs on one core.  When the scan has
    fewer input splits than the default parallelism, the rows are hash
    partitioned on all columns once (planning-time check, no job; hashing,
    unlike round-robin, needs no sort to be deterministic on retry).  A table of more than
    ``SPREAD_MAX_BYTES`` is left as is, however many cores there are: its splits are
    work enough, and it is not shuffled for this.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want and estimated_bytes(df) <= SPREAD_MAX_BYTES:
        return df.repartition(want, *[F.col(c) for c in df.columns])
    return df


def read_table(spark: SparkSession, root: str, name: str, columns=None,
               spread_small: bool = False) -> DataFrame:
    """Read ``<root>/<name>.parquet``; ``columns`` prunes the scan (ReadSchema)."""
    df = spark.read.parquet(table_path(root, name))
    df = df.select(*columns) if columns else df
    return spread(df) if spread_small else df
