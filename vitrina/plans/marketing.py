"""Advertising-integration budget mart (Q4) from spreadsheet-shaped rows.

Input ``budget``: id (sheet row order), social_network, social_link,
responsible_person, price, product_cost, actual_reach, actual_cpm, reach,
is_integration, region, format, sheets_name (month label) and free columns.

Per month:
  1. keep rows before the first cut-off row (``social_link = 'БЮДЖЕТ '``);
     a month without a cut-off row keeps nothing;
  2. drop ids listed on total rows (``reach = 'Итого Безнал'``), NOT IN semantics;
  3. drop rows whose cpm cell holds ``#DIV/0!`` (NULL cells drop too);
  4. section headers are rows whose responsible person contains '-'; each row
     takes the header at or above it (NULL above the first header);
  5. numbers: blanks and no-break spaces removed, decimal comma, '' is 0;
  6. product label from the header's code: 'tsh' Tashe, 'lmb' Limba, else Nothing;
  7. data rows (not headers, person not NULL) flagged as integrations.

``month=None`` runs every month in one pass (each month exactly as alone).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.functions.text import MONEY, decimal_from_text, strip_blanks
from vitrina.operators.broadcast import checked_broadcast
from vitrina.operators.joins import not_in
from vitrina.operators.ordered import next_marker, section_carry
from vitrina.session import materialize

# Fixed values of the budget sheet.
CUTOFF_LINK = "БЮДЖЕТ "
TOTAL_ROW = "Итого Безнал"
ERROR_CELL = "#DIV/0!"
SECTION_MARK = "-"
DEPARTMENT = "Рекламные интеграции"
INTEGRATION_FLAG = "TRUE"
LABELS = (("tsh", "Tashe"), ("lmb", "Limba"))
NO_LABEL = "Nothing"

MONTH = "sheets_name"
MARKS_MAX_BYTES = 8 << 20
OUTPUT_COLUMNS = ["department", "id", "full_price", "actual_reach", "is_integration",
                  "actual_cpm", "product_name", "articul_product", "format", "region",
                  "sheets_name"]


def month_slice(budget: DataFrame, month: str | None) -> DataFrame:
    return budget if month is None else budget.where(F.col(MONTH) == F.lit(month))


def is_header(col: str = "responsible_person"):
    """LIKE '%-%' (NULL is not a header)."""
    return F.col(col).contains(SECTION_MARK)


def cutoff_filter(rows: DataFrame) -> DataFrame:
    """Rows with id below their month's first cut-off row.

    The cut-off is one MIN per month (a partial/final aggregate); months are
    few, so adaptive execution broadcasts it at run time.
    """
    cut = (rows.where(F.col("social_link") == CUTOFF_LINK)
               .groupBy(MONTH).agg(F.min("id").alias("_cut_id")))
    return rows.join(cut, MONTH).where(F.col("id") < F.col("_cut_id")).drop("_cut_id")


def not_in_filter(rows: DataFrame, source: DataFrame) -> DataFrame:
    """Rows whose id is NOT IN the month's total-row ids (NULL-aware)."""
    totals = source.where(F.col("reach") == TOTAL_ROW).select(MONTH, "id")
    return not_in(rows, totals, "id", by=[MONTH])


def month_marks(rows: DataFrame) -> DataFrame:
    """One pass, one row per month: first cut-off id, and the number of total
    rows and of their non-NULL ids (the NOT IN flags)."""
    total = F.col("reach") == TOTAL_ROW
    return rows.groupBy(MONTH).agg(
        F.min(F.when(F.col("social_link") == CUTOFF_LINK, F.col("id"))).alias("_cut_id"),
        F.count(F.when(total, F.lit(1))).alias("_nin_rows"),
        F.count(F.when(total, F.col("id"))).alias("_nin_keys"))


def clean_budget(budget: DataFrame, month: str | None = None) -> DataFrame:
    """Steps 1-3.  The cut-off and the NOT IN flags come from one per-month
    aggregate.  It is computed first and written (one row per month), so its size is
    known when the join is planned: it is broadcast, and the sheet is not shuffled by
    month.  The total-row ids are removed with a hash anti join."""
    b = month_slice(budget, month)
    marks, _ = checked_broadcast(materialize(month_marks(b), "marks"), MARKS_MAX_BYTES)
    kept = b.join(marks, MONTH).where(F.col("id") < F.col("_cut_id"))
    totals = b.where(F.col("reach") == TOTAL_ROW).select(MONTH, "id")
    kept = not_in(kept, totals, "id", by=[MONTH], counts=("_nin_rows", "_nin_keys"))
    return (kept.where(F.col("actual_cpm") != ERROR_CELL)
                .drop("_cut_id", "_nin_rows", "_nin_keys"))


def section_bounds(clean: DataFrame) -> DataFrame:
    """Header rows with the id of the next header of the month (LEAD; NULL last).
    The headers are materialized first: the LEAD reads them in several branches."""
    h = clean.where(is_header()).select("id", F.col("responsible_person").alias("product_name"), MONTH)
    return next_marker(materialize(h, "headers"), "id", F.lit(True), "next_separator_id", by=[MONTH])


def is_data(col: str = "responsible_person"):
    """NOT LIKE '%-%' (NULL is no data row)."""
    return ~F.col(col).contains(SECTION_MARK)


def carry_sections(clean: DataFrame, wanted=None) -> DataFrame:
    """Step 4: ``product_name`` = header text in effect at each header and data row.

    ``wanted`` names the data rows a mart keeps later on, so that the others are
    never shuffled.  The rows are written first: the carry reads them in several
    branches, and without it each branch would redo the cleaning.
    """
    rows = materialize(clean.where(is_header() | (is_data() if wanted is None else is_data() & wanted)))
    return section_carry(rows, "id", is_header(), "responsible_person", "product_name",
                         by=[MONTH])


def product_label(code):
    """CASE on the code between the first two '-' of the header text."""
    expr = F.when(code.contains(LABELS[0][0]), LABELS[0][1])
    for key, label in LABELS[1:]:
        expr = expr.when(code.contains(key), label)
    return expr.otherwise(NO_LABEL)


def header_code(col: str = "product_name"):
    return F.split_part(F.col(col), F.lit(SECTION_MARK), F.lit(2))


def clean_numbers(rows: DataFrame) -> DataFrame:
    """Step 5 on the four number cells (exact decimals)."""
    return rows.select(*[c for c in rows.columns if c not in ("price", "product_cost",
                                                            "actual_reach", "actual_cpm")],
                       *[decimal_from_text(strip_blanks(c), already_stripped=True).alias(c)
                         for c in ("price", "product_cost", "actual_reach", "actual_cpm")])


def budget_integrations(budget: DataFrame, month: str | None = None) -> DataFrame:
    """Q4: advertising integrations with full price and product label."""
    flagged = F.col("is_integration") == INTEGRATION_FLAG
    rows = carry_sections(clean_budget(budget, month), flagged).where(is_data() & flagged)
    rows = clean_numbers(rows)
    code = header_code()
    return rows.select(
        F.lit(DEPARTMENT).alias("department"), "id",
        (F.col("price") + F.col("product_cost")).cast(MONEY).alias("full_price"),
        "actual_reach", "is_integration", "actual_cpm",
        product_label(code).alias("product_name"), code.alias("articul_product"),
        "format", "region", MONTH)
