"""Write semantics of the marts: full reloads, idempotent slice replace, split export.

Tables written here are versioned Parquet folders (``versions``): every reload, append and slice
replacement is one commit, which readers see whole or not at all.  Plain Parquet folders can be read
too; the first write gives them a commit log.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from pyspark.sql.types import StringType, StructField, StructType

from vitrina.operators.versions import (Files, add_rows, create_table, current, read_table, read_version,
                                        replace_parts, replace_table)
from vitrina.session import materialize, release_shuffles

# CSV text for NULL ('' stays an empty string), as in PostgreSQL's COPY.
NULL_MARK = "\\N"
# Sheets as spreadsheets read them: a quote inside a cell is doubled, a cell may hold line
# breaks, cells are written as they are (the writer trims by default).
CSV_WRITE = {"header": True, "nullValue": NULL_MARK, "quote": '"', "escape": '"',
             "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
CSV_READ = {"header": True, "quote": '"', "escape": '"', "multiLine": True, "mode": "FAILFAST"}
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table is there.  Only a missing folder, or one without files, counts as
    absent; any other failure to read it is raised."""
    if current(spark, path) is not None:
        return True
    try:
        spark.read.parquet(path).schema  # noqa: B018
        return True
    except AnalysisException as e:
        if (e.getCondition() or "").startswith(ABSENT):
            return False
        raise


def read_slices(spark: SparkSession, path: str, part_col: str) -> DataFrame:
    """A mart partitioned by ``part_col``, whose labels stay text whatever they look like
    ("0125" is not 125: partition types are declared, not inferred)."""
    version = current(spark, path)
    if version is not None:
        return read_version(spark, path, version)
    found = spark.read.parquet(path).schema
    declared = StructType([StructField(f.name, StringType()) if f.name == part_col else f for f in found])
    return spark.read.schema(declared).parquet(path)


def slice_labels(spark: SparkSession, path: str, part_col: str) -> set[str]:
    """The labels of the slices a mart holds, from its commit or its folder names: no row is read."""
    version = current(spark, path)
    if version is not None:
        return version.labels()
    files = Files(spark)
    found = [n for n in files.folders(path) if n.startswith(f"{part_col}=")]
    full = [n for n in found if any(not f.startswith(("_", ".")) for f in files.names(f"{path.rstrip('/')}/{n}"))]
    return {files.unescaped(n) for n in full} - {None}


def create_empty(spark: SparkSession, path: str, schema: StructType,
                 partition_by: Iterable[str] = ()) -> None:
    """Create an empty table with a declared schema (the DDL the marts assume)."""
    part_col, *more = [*partition_by, None]
    if len(more) > 1:
        raise ValueError("slices have one column")
    create_table(spark, path, schema, part_col)


def align_by_name(source: DataFrame, target: StructType, parse_text: bool = False) -> DataFrame:
    """INSERT INTO t (source columns) SELECT ...: columns matched by name
    (case-insensitive).  A source column the target lacks is an error;
    target columns the source lacks are NULL.  Types follow store
    assignment (``DataFrame.to``: numeric widening, no text to number);
    ``parse_text`` instead parses text cells with an ANSI cast (file loads)."""
    src = {c.lower(): c for c in source.columns}
    tgt = {f.name.lower() for f in target.fields}
    unknown = [c for c in source.columns if c.lower() not in tgt]
    if unknown:
        raise ValueError(f"columns not in target: {unknown}")
    cols = []
    for f in target.fields:
        if f.name.lower() in src:
            c = F.col(f"`{src[f.name.lower()]}`")
            cols.append((c.cast(f.dataType) if parse_text else c).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return source.select(*cols).to(target)


def align_by_position(source: DataFrame, target: StructType) -> DataFrame:
    """INSERT INTO t SELECT *: i-th source column into i-th target column;
    more source columns than target columns is an error, fewer leave NULLs."""
    if len(source.columns) > len(target.fields):
        raise ValueError(f"{len(source.columns)} columns into a {len(target.fields)}-column table")
    cols = [F.col(f"`{c}`").alias(f.name) for c, f in zip(source.columns, target.fields)]
    cols += [F.lit(None).cast(f.dataType).alias(f.name) for f in target.fields[len(source.columns):]]
    return source.select(*cols).to(target)


def full_reload(spark: SparkSession, source: DataFrame, path: str, by: str = "name",
                schema: StructType | None = None, parse_text: bool = False) -> DataFrame:
    """TRUNCATE + INSERT: replace the whole table at ``path`` with ``source``.

    The target's schema is kept when the table exists (or ``schema`` is
    given); a new table takes the source schema.  The new rows become the table
    in one commit: a failure at any point leaves the old table, and readers see the old
    rows or the new ones.
    """
    target = schema or (read_table(spark, path).schema if path_exists(spark, path) else None)
    if target is None:
        out = source
    elif by == "name":
        out = align_by_name(source, target, parse_text)
    elif by == "position":
        out = align_by_position(source, target)
    else:
        raise ValueError(by)
    replace_table(spark, out, path)
    return read_table(spark, path)


def append(spark: SparkSession, source: DataFrame, path: str, by: str = "position",
           partition_by: Iterable[str] = ()) -> None:
    """INSERT INTO t SELECT * FROM (...): add rows to an existing table, columns
    matched by position (or by name); the table keeps its schema."""
    version = current(spark, path)
    target = (version or spark.read.parquet(path)).schema
    out = align_by_position(source, target) if by == "position" else align_by_name(source, target)
    if version is not None:
        add_rows(spark, out, path)
        return
    w = out.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def replace_slices(spark: SparkSession, marts: Mapping[str, DataFrame], part_col: str,
                   months: Iterable[str] | None = None, dealt: Iterable[str] = ()) -> None:
    """Idempotent replacement of month slices in one or more partitioned marts.

    All marts change in one step, after every new result has been written: a failure at any point
    leaves all of them as they were, and readers of several marts (``versions.read_together``) never
    see two loads mixed.  Months outside ``months`` keep their folders.  A named month whose new result is
    empty is cleared.  ``months=None`` replaces every month: those the marts hold without a result now go.
    ``dealt`` names the marts whose rows come in tasks of about one month each: they are written without an exchange.
    """
    replace_parts(spark, marts, part_col, months, dealt)


SHEET_ROWS = 1_000_000  # a sheet with more rows is written as several files
BATCH_ROWS = 25_000_000  # rows dealt at a time, about: a few hundred MB to a GB of shuffle files


def export_split(df: DataFrame, path: str, split: list[str], order: list[Column],
                 n_partitions: int | None = None, sheet_rows: int = SHEET_ROWS,
                 batch_rows: int = BATCH_ROWS, compression: str | None = None) -> None:
    """One CSV folder per group (a 'sheet' per blogger), header row, rows in ``order``.

    Sheets are counted first.  Those of at most ``sheet_rows`` rows are dealt whole: many to a task, each in
    one file.  Larger ones (at most rows / ``sheet_rows`` of them) are range-partitioned on (split,
    order): several tasks and files, each sorted, their numbers in order.  So no task holds more than a
    few sheets' worth of rows, and no small sheet is cut in two.

    More than ``batch_rows`` rows are dealt in batches of whole ``split[0]`` values, and the shuffle files of
    one go while the next is written: the disk holds the sheets and one or two batches, not all rows a
    second time.  Where ``split[0]`` is the table's folder column, a batch reads only its own folders.  The
    folder has its ``_SUCCESS`` when the last batch is there.  ``compression`` (``gzip``) writes the same text
    as ``.csv.gz``."""
    spark = df.sparkSession
    keyed = df.where(reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in split]))
    keys = [F.col(f"`{c}`") for c in split]
    sheets = materialize(keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "sheet-rows")
    batches = max(1, math.ceil((sheets.agg(F.sum("n")).first()[0] or 0) / batch_rows))
    batch = F.pmod(F.xxhash64(keys[0]), F.lit(batches))
    large = sheets.where(F.col("n") > sheet_rows)
    rows_of_large = {r.batch: r.n for r in large.groupBy(batch.alias("batch")).agg(F.sum("n").alias("n")).collect()}
    names = F.broadcast(large.select(*keys))
    # an unfinished export has no mark of success, and what lay in the folder before goes whole
    unfinished = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}
    first = {"partitionOverwriteMode": "static"} if batches > 1 else {}

    def write(rows: DataFrame, mode: str, options: dict) -> None:
        if compression is not None:
            options = {**options, "compression": compression}
        (rows.sortWithinPartitions(*keys, *order).write.mode(mode).options(**CSV_WRITE, **options)
             .partitionBy(*split).csv(path))

    for k in range(batches):
        release_shuffles(spark)  # of the batches before, and of the jobs that made the table
        some = rows_of_large.get(k, 0)
        part = keyed.where(batch == k) if batches > 1 else keyed
        small = part.join(names, split, "left_anti") if some else part
        last = {} if k == batches - 1 else unfinished
        write(small.repartition(n_partitions, *keys) if n_partitions else small.repartition(*keys),
              "append" if k else "overwrite", {**({} if k else first), **(unfinished if some else last)})
        if some:
            write(part.join(names, split, "left_semi").repartitionByRange(math.ceil(some / sheet_rows), *keys, *order), "append", last)
    release_shuffles(spark)
