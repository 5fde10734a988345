"""Month export (M9): summary 'sheet', one detail 'sheet' per blogger, and the
display width of every column of every sheet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.operators.aggs import column_widths
from vitrina.operators.sinks import CSV_READ, CSV_WRITE, NULL_MARK, export_split, read_slices
from vitrina.plans.load import BLOGGER_COL, MONTH_COL, RELEASE_COL

SUMMARY_SHEET = "Итог"
SUMMARY_ORDER = [BLOGGER_COL, "account_name"]


def read_month(spark: SparkSession, path: str, month: str | None) -> DataFrame:
    """Mart slice of one month (partition pruning), or all months."""
    df = read_slices(spark, path, MONTH_COL)
    return df if month is None else df.where(F.col(f"`{MONTH_COL}`") == F.lit(month))


def export_month(spark: SparkSession, short_path: str, full_path: str, out: str,
                 month: str | None, detail_compression: str | None = None) -> dict[str, str]:
    """Write the summary and the per-blogger detail of ``month`` (every month
    when None, one folder per month, for the summary too) as header CSV; return the folders.

    Detail rows are ordered by release date, NULL dates last; rows without a
    blogger name are left out, as grouping by name drops them.  ``detail_compression``
    (``gzip``) writes the detail sheets, about ten times the mart's size as plain text, compressed.
    """
    short = read_month(spark, short_path, month)
    full = read_month(spark, full_path, month)
    split = [BLOGGER_COL] if month is not None else [MONTH_COL, BLOGGER_COL]
    paths = {"summary": f"{out}/{SUMMARY_SHEET}", "detail": f"{out}/detail",
             "widths": f"{out}/widths"}
    if month is None:
        export_split(short, paths["summary"], [MONTH_COL], [F.col(f"`{c}`") for c in SUMMARY_ORDER])
    else:
        short.write.mode("overwrite").options(**CSV_WRITE).csv(paths["summary"])
    export_split(full, paths["detail"], split, [F.col(f"`{RELEASE_COL}`").asc_nulls_last()], compression=detail_compression)
    widths = sheet_widths(full, split).unionByName(summary_widths(short, split))
    widths.write.mode("overwrite").options(**CSV_WRITE).csv(paths["widths"])
    return paths


def sheet_widths(detail: DataFrame, split: list[str]) -> DataFrame:
    """Width of each column of each blogger sheet (all columns, as written)."""
    keyed = detail.where(F.col(f"`{BLOGGER_COL}`").isNotNull())
    keys = [F.col(f"`{c}`").alias(f"_sheet_{i}") for i, c in enumerate(split)]
    g = keyed.select(*keys, *[F.col(f"`{c}`") for c in detail.columns])
    w = column_widths(g, group=[f"_sheet_{i}" for i in range(len(split))], columns=detail.columns)
    return w.select(*[F.col(f"_sheet_{i}").alias(c) for i, c in enumerate(split)],
                    "column_name", "width")


def summary_widths(summary: DataFrame, split: list[str]) -> DataFrame:
    """Width of each column of the summary sheet(s): its blogger column reads as the sheet's name."""
    months = [c for c in split if c != BLOGGER_COL]
    keys = [F.col(f"`{c}`").alias(f"_sheet_{i}") for i, c in enumerate(months)]
    g = summary.select(*keys, *[F.col(f"`{c}`") for c in summary.columns])
    w = column_widths(g, group=[f"_sheet_{i}" for i in range(len(months))], columns=summary.columns)
    return w.select(*[F.col(f"_sheet_{i}").alias(c) for i, c in enumerate(months)],
                    F.lit(SUMMARY_SHEET).alias(BLOGGER_COL), "column_name", "width")


def read_sheets(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read exported sheets back (header CSV, NULL marker, declared schema); a file that does
    not have these columns fails."""
    return spark.read.options(**CSV_READ).option("nullValue", NULL_MARK).schema(schema).csv(path)
