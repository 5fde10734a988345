"""Weekly product profit mart (Q5) from daily profit rows.

Input ``daily``: id, date_data, name, article, sellQuantity, sellPrice,
sellCost, sellSum, sellCostSum, returnQuantity, returnPrice, returnCost,
returnSum, returnCostSum, profit, margin, salesMargin (the unit-price and
margin columns may be absent; they only take part in de-duplication).

1. rows with an article; exact duplicate rows (same id, week and all
   figures) count once;
2. per ISO week number, name and article: earliest week bounds, sums;
   the year is not a key, so week 1 of every year lands in one row;
3. unit prices and margins as guarded ratios rounded to 2 places.

Plan: de-duplication and roll-up are two aggregations; each does a partial
(map-side) aggregate before its shuffle, so a product with a third of all
rows sends only one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.functions.dates import iso_week, week_end, week_start
from vitrina.functions.ratios import guarded_percent, guarded_ratio

FIGURES = ["sellQuantity", "sellPrice", "sellCost", "sellSum", "sellCostSum", "returnQuantity",
           "returnPrice", "returnCost", "returnSum", "returnCostSum", "profit", "margin",
           "salesMargin"]
SUMMED = ["sellQuantity", "sellSum", "sellCostSum", "returnQuantity", "returnSum",
          "returnCostSum", "profit"]
OUTPUT_COLUMNS = ["week_number", "week_start", "week_end", "name", "article", "sellquantity",
                  "sellprice", "sellcost", "sellsum", "sellcostsum", "returnquantity",
                  "returnprice", "returncost", "returnsum", "returncostsum", "salesmargin",
                  "margin", "profit"]


def with_week(daily: DataFrame) -> DataFrame:
    """Week start (Monday), week end (+6 days) and ISO week number of date_data."""
    return daily.select(week_start("date_data").alias("week_start"),
                        week_end("date_data").alias("week_end"),
                        iso_week("date_data").alias("week_number"),
                        *daily.columns)


def weekly_dedup(daily: DataFrame) -> DataFrame:
    """Rows with an article, de-duplicated on (week, id, name, article, figures).

    ``date_data`` is not a key (two days of one week with identical figures
    are one row), and nothing downstream reads it, so it is dropped.
    """
    keys = ["week_start", "week_end", "week_number", "id", "name", "article"]
    keys += [c for c in FIGURES if c in daily.columns]
    return with_week(daily.where(F.col("article") != "")).select(*keys).distinct()


def weekly_profit(daily: DataFrame) -> DataFrame:
    """Q5 (output names lower-case, as the source database folds them)."""
    w = (weekly_dedup(daily)
         .groupBy("week_number", "name", "article")
         .agg(F.min("week_start").alias("week_start"), F.min("week_end").alias("week_end"),
              *[F.sum(c).alias(c.lower()) for c in SUMMED]))
    c = F.col
    return w.select(
        "week_number", "week_start", "week_end", "name", "article", "sellquantity",
        guarded_ratio(c("sellsum"), c("sellquantity")).alias("sellprice"),
        guarded_ratio(c("sellcostsum"), c("sellquantity")).alias("sellcost"),
        "sellsum", "sellcostsum", "returnquantity",
        guarded_ratio(c("returnsum"), c("returnquantity")).alias("returnprice"),
        guarded_ratio(c("returncostsum"), c("returnquantity")).alias("returncost"),
        "returnsum", "returncostsum",
        guarded_percent(c("profit"), c("sellcostsum") - c("returncostsum")).alias("salesmargin"),
        guarded_percent(c("profit"), c("sellsum") - c("returnsum")).alias("margin"),
        "profit")
