"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables under ``sf_dir`` (through the fixture
views) over whole tables; the marts run over all months at once.  Decimal
results are handed out as DOUBLE so they compare across engines; the mart
functions themselves keep decimals.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructField, StructType

from vitrina.plans import marketing, payment, profit
from vitrina.sources import fixtures as fx

# The test slice of the fixtures and the lowered cap of the
# capped-count check (the reference cap, 60, is never reached by the fixtures).
TEST_MONTH = "1997-10"
TEST_CAP = 6

Query = Callable[[SparkSession, str], DataFrame]


def as_double(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


def _payment_inputs(spark, d):
    return fx.posts(spark, d), fx.roster(spark, d), fx.kpi(spark), fx.price(spark)


def _stats(spark, d):
    return payment.payment_stats(fx.posts(spark, d), fx.roster(spark, d))


# ---- payment marts -----------------------------------------------------------------------

def q_payment_summary(spark, d):
    return as_double(payment.payment_summary(*_payment_inputs(spark, d)))


def q_payment_detail(spark, d):
    return as_double(payment.payment_detail(*_payment_inputs(spark, d)))


def q_payment_summary_v2(spark, d):
    return as_double(payment.payment_summary_v2(*_payment_inputs(spark, d)))


def q_payment_summary_v2_capped(spark, d):
    """The same with a cap that the fixtures reach."""
    return as_double(payment.payment_summary_v2(*_payment_inputs(spark, d), cap=TEST_CAP))


def q_person_tokens(spark, d):
    from vitrina.operators.joins import person_keys
    p = person_keys(fx.posts(spark, d))
    return p.select("author", "first_name", "last_name",
                    F.concat("first_name", F.lit(" "), "last_name").alias("blogger_name"))


def q_name_key_join(spark, d):
    return _stats(spark, d)


def q_int_text(spark, d):
    from vitrina.functions.text import int_from_text
    p = fx.posts(spark, d)
    return p.select("author", "sheets_name", *[int_from_text(c).alias(c) for c in payment.REACHES])


def q_bracket_join_row(spark, d):
    br = payment.Brackets(fx.kpi(spark), fx.price(spark))
    t = payment.post_premiums(_stats(spark, d), br)
    return as_double(t.select("first_name", "last_name", "grade", "currency", "sheets_name", "release_date",
                              "tiktok_reach", "likee_reach", "tiktok_premium", "likee_premium"))


def q_bracket_join_agg(spark, d):
    br = payment.Brackets(fx.kpi(spark), fx.price(spark))
    return as_double(payment.account_prices(payment.account_totals(_stats(spark, d)), br))


def q_account_totals(spark, d):
    return payment.account_totals(_stats(spark, d))


def q_conditional_counts(spark, d):
    return payment.link_counts(_stats(spark, d))


def q_capped_count(spark, d):
    return payment.link_counts(_stats(spark, d), cap=TEST_CAP)


def q_detail_aggregate_join(spark, d):
    r = payment.detail_rows(*_payment_inputs(spark, d))
    return as_double(r.select("first_name", "last_name", "grade", "currency", "release_date",
                              "tiktok_video_link", "tiktok_reach", "likee_reach", "tiktok_premium",
                              "likee_premium", "sheets_name", "account_name", "video_count",
                              "instagram_count", "youtube_count", "price", "instagram_premium",
                              "youtube_premium"))


def q_label_strip(spark, d):
    from vitrina.functions.text import strip_word
    p = fx.posts(spark, d)
    return p.select("author", "release_date",
                    strip_word("account_name", payment.REPORT_WORD).alias("account_name"))


def q_nonempty_filter(spark, d):
    p = fx.posts(spark, d)
    return p.where(F.col("tiktok_video_link") != "").select("author", "release_date",
                                                            "tiktok_video_link", "sheets_name")


def q_slice_filter(spark, d):
    return payment.month_slice(fx.posts(spark, d), TEST_MONTH)


def q_slice_count(spark, d):
    return fx.posts(spark, d).groupBy("sheets_name").agg(F.count(F.lit(1)).alias("n_rows"))


def q_param_sql(spark, d):
    """A mart text over one month: the month is a bound parameter, never spliced."""
    from vitrina.plans.load import run_mart_sql
    return run_mart_sql(spark, "SELECT account_name, COUNT(1) AS n_rows FROM {posts} WHERE sheets_name = :month "
                               "GROUP BY account_name", TEST_MONTH, {"posts": fx.posts(spark, d)})


def q_slice_gate(spark, d):
    """The gate of a month load: a month with staging rows passes, one without does not."""
    from vitrina.plans.load import months_present
    return months_present(fx.posts(spark, d), [TEST_MONTH, "2099-01"])


# ---- budget mart -------------------------------------------------------------------------

def q_budget_integrations(spark, d):
    return as_double(marketing.budget_integrations(fx.budget(spark, d)))


def q_budget_clean(spark, d):
    c = marketing.clean_budget(fx.budget(spark, d))
    return c.select("id", "social_network", "social_link", "responsible_person", "price",
                    "product_cost", "actual_reach", "actual_cpm", "is_integration", "sheets_name")


def q_cutoff_filter(spark, d):
    return marketing.cutoff_filter(fx.budget(spark, d)).select("id", "social_link", "sheets_name")


def q_not_in_filter(spark, d):
    b = fx.budget(spark, d)
    return marketing.not_in_filter(b, b).select("id", "reach", "sheets_name")


def q_section_bounds(spark, d):
    return marketing.section_bounds(marketing.clean_budget(fx.budget(spark, d)))


def q_section_carry(spark, d):
    from vitrina.operators.ordered import section_carry
    from vitrina.session import materialize
    c = materialize(marketing.clean_budget(fx.budget(spark, d)))
    s = section_carry(c, "id", marketing.is_header(), "responsible_person", "product_name",
                      by=["sheets_name"])
    return s.select("id", "responsible_person", "product_name", "sheets_name")


def q_section_filter(spark, d):
    c = marketing.clean_budget(fx.budget(spark, d))
    return c.where(~marketing.is_header()).select("id", "responsible_person", "sheets_name")


def q_decimal_text(spark, d):
    c = marketing.clean_numbers(marketing.clean_budget(fx.budget(spark, d)))
    return as_double(c.select("id", "price", "product_cost", "actual_reach", "actual_cpm", "sheets_name"))


def q_product_label(spark, d):
    c = marketing.carry_sections(marketing.clean_budget(fx.budget(spark, d))).where(marketing.is_data())
    code = marketing.header_code()
    return c.select("id", "sheets_name", marketing.product_label(code).alias("product_label"),
                    code.alias("articul_product"))


# ---- weekly profit mart ------------------------------------------------------------------

def q_weekly_profit(spark, d):
    return as_double(profit.weekly_profit(fx.profit(spark, d)))


def q_week_bounds(spark, d):
    return profit.with_week(fx.profit(spark, d)).select("id", "date_data", "week_start", "week_end",
                                                         "week_number")


def q_weekly_dedup(spark, d):
    return as_double(profit.weekly_dedup(fx.profit(spark, d)))


def q_guarded_ratio(spark, d):
    from vitrina.functions.ratios import guarded_percent, guarded_ratio
    p = fx.profit(spark, d)
    c = F.col
    return as_double(p.select(
        "id", "date_data",
        guarded_ratio(c("sellSum"), c("sellQuantity")).alias("sellprice"),
        guarded_ratio(c("returnCostSum"), c("returnQuantity")).alias("returncost"),
        guarded_percent(c("profit"), c("sellSum") - c("returnSum")).alias("margin")))


QUERIES: dict[str, Query] = {
    "payment_summary": q_payment_summary,
    "payment_detail": q_payment_detail,
    "payment_summary_v2": q_payment_summary_v2,
    "payment_summary_v2_capped": q_payment_summary_v2_capped,
    "person_tokens": q_person_tokens,
    "name_key_join": q_name_key_join,
    "int_text": q_int_text,
    "bracket_join_row": q_bracket_join_row,
    "bracket_join_agg": q_bracket_join_agg,
    "account_totals": q_account_totals,
    "conditional_counts": q_conditional_counts,
    "capped_count": q_capped_count,
    "detail_aggregate_join": q_detail_aggregate_join,
    "label_strip": q_label_strip,
    "nonempty_filter": q_nonempty_filter,
    "slice_filter": q_slice_filter,
    "slice_count": q_slice_count,
    "param_sql": q_param_sql,
    "slice_gate": q_slice_gate,
    "budget_integrations": q_budget_integrations,
    "budget_clean": q_budget_clean,
    "cutoff_filter": q_cutoff_filter,
    "not_in_filter": q_not_in_filter,
    "section_bounds": q_section_bounds,
    "section_carry": q_section_carry,
    "section_filter": q_section_filter,
    "decimal_text": q_decimal_text,
    "product_label": q_product_label,
    "weekly_profit": q_weekly_profit,
    "week_bounds": q_week_bounds,
    "weekly_dedup": q_weekly_dedup,
    "guarded_ratio": q_guarded_ratio,
}


# ---- data movement -----------------------------------------------------------------------

RELOAD_TABLES = {"region": "r_regionkey", "nation": "n_nationkey", "supplier": "s_suppkey", "customer": "c_custkey",
                 "part": "p_partkey", "orders": "o_orderkey", "lineitem": "l_orderkey"}


def q_reload_plan(spark, d):
    """The control rows a reload of the schema ``tpch`` takes, with the rows of each source table."""
    from vitrina.plans.load import reload_plan_frame
    from vitrina.sources.tables import read_table
    plan = reload_plan_frame(fx.reload_config(spark, RELOAD_TABLES), "tpch")
    sizes = reduce(DataFrame.union, [read_table(spark, d, t).agg(F.lit(t).alias("table_name_source"), F.count(F.lit(1)).alias("n_rows"))
                                     for t in RELOAD_TABLES])
    return plan.join(F.broadcast(sizes), "table_name_source")


def q_full_reload_copy(spark, d):
    """Config-driven reload of the driver tables into a staging schema; the ``orders``
    target pre-exists with one more column (filled with NULL).  One row for every table
    found in any target schema: skipped control rows would show as rows too many."""
    from vitrina.operators.sinks import create_empty
    from vitrina.plans.load import ParquetTables, run_full_reload
    from vitrina.session import scratch_path
    from vitrina.sources.tables import read_table
    root = scratch_path(spark, "reload")
    sources = ParquetTables(spark, {("stage_db", "tpch"): d, ("stage_db", "other"): d}, suffix=".parquet")
    targets = ParquetTables(spark, {("stage_db", "stg_tpch"): f"{root}/stg_tpch",
                                    ("stage_db", "stg_other"): f"{root}/stg_other"})
    ddl = StructType(read_table(spark, d, "orders").schema.fields
                     + [StructField("load_note", StringType())])
    create_empty(spark, targets.path("stage_db", "stg_tpch", "orders"), ddl)
    run_full_reload(spark, fx.reload_config(spark, RELOAD_TABLES), "tpch", sources, targets)
    found = []
    for schema in ("stg_tpch", "stg_other"):
        for table in [*RELOAD_TABLES, "orders_off"]:
            if targets.schema("stage_db", schema, table) is not None:
                df = targets.read("stage_db", schema, table)
                found.append(df.agg(
                    F.lit(schema).alias("target_schema"), F.lit(table).alias("table_name"),
                    F.count(F.lit(1)).alias("n_rows"),
                    F.sum(RELOAD_TABLES.get(table, df.columns[0])).cast("bigint").alias("key_sum"),
                    F.lit("load_note" in df.columns).alias("has_note")))
    return reduce(DataFrame.union, found)


def q_append_rows(spark, d):
    """INSERT INTO by position: nation, then region with one column more."""
    from vitrina.operators import versions
    from vitrina.operators.sinks import append, create_empty
    from vitrina.session import scratch_path
    from vitrina.sources.tables import read_table
    path = scratch_path(spark, "append")
    create_empty(spark, path, StructType.fromDDL("id bigint, label string, note string"))
    append(spark, read_table(spark, d, "nation", ["n_nationkey", "n_name"]), path)
    append(spark, read_table(spark, d, "region", ["r_regionkey", "r_name"]).withColumn("n", F.lit("region")), path)
    return versions.read_table(spark, path)


def q_reload_by_position(spark, d):
    """TRUNCATE and INSERT SELECT *: two source columns into a table of three."""
    from vitrina.operators.sinks import create_empty, full_reload
    from vitrina.session import scratch_path
    from vitrina.sources.tables import read_table
    path = scratch_path(spark, "position")
    create_empty(spark, path, StructType.fromDDL("a bigint, b string, c string"))
    full_reload(spark, read_table(spark, d, "nation", ["n_nationkey", "n_name"]), path, by="position")
    return full_reload(spark, read_table(spark, d, "customer", ["c_custkey", "c_name"]), path, by="position")


def q_tabular_reload(spark, d):
    """A sheet (header CSV of ``customer``) loaded into a table with declared types; one
    column has cells with quotes, commas and line breaks."""
    from vitrina.operators.sinks import CSV_WRITE, create_empty
    from vitrina.plans.load import tabular_reload
    from vitrina.session import scratch_path
    from vitrina.sources.tables import read_table
    root = scratch_path(spark, "sheet")
    cust = read_table(spark, d, "customer")
    cust = cust.withColumn("note", F.concat(F.lit('say "'), "c_name", F.lit('",\n end')))
    cust.write.options(**{k: v for k, v in CSV_WRITE.items() if k != "nullValue"}).csv(f"{root}/config.csv")
    create_empty(spark, f"{root}/target", cust.schema)
    return tabular_reload(spark, f"{root}/config.csv", f"{root}/target")


def _load_marts(spark, d, months=None):
    from vitrina.plans.load import load_payment_months
    from vitrina.session import scratch_path
    root = scratch_path(spark, "marts")
    short, full = f"{root}/tiktok_payment_short", f"{root}/tiktok_payment_full"
    load_payment_months(spark, *_payment_inputs(spark, d), short, full, months)
    return short, full


def read_mart(spark, path):
    """A mart folder read back; the month label stays text whatever it looks like."""
    from vitrina.operators.sinks import read_slices
    from vitrina.plans.load import MONTH_COL
    return as_double(read_slices(spark, path, MONTH_COL))


def q_replace_slice(spark, d):
    """Backfill every month, then re-run one month: the mart must equal the
    all-month summary (the re-run replaced its slice, nothing doubled)."""
    from vitrina.plans.load import load_payment_months
    short, full = _load_marts(spark, d)
    load_payment_months(spark, *_payment_inputs(spark, d), short, full, [TEST_MONTH])
    return read_mart(spark, short)


def q_backfill_clears(spark, d):
    """Backfill, then another from a staging table that lost one month: that month goes."""
    from vitrina.plans.load import load_payment_months
    short, full = _load_marts(spark, d)
    posts, roster, kpi, price = _payment_inputs(spark, d)
    load_payment_months(spark, posts.where(F.col("sheets_name") != TEST_MONTH), roster, kpi, price, short, full)
    return read_mart(spark, short)


def q_export_detail(spark, d):
    """Export of the detail mart, one folder per month and blogger, read back."""
    from vitrina.operators.sinks import read_slices
    from vitrina.plans.export import export_month, read_sheets
    from vitrina.plans.load import BLOGGER_COL, MONTH_COL
    from vitrina.session import scratch_path
    short, full = _load_marts(spark, d)
    paths = export_month(spark, short, full, scratch_path(spark, "export"), None, detail_compression="gzip")
    m = read_slices(spark, full, MONTH_COL).schema
    schema = StructType([f for f in m.fields if f.name not in (MONTH_COL, BLOGGER_COL)]
                        + [StructField(MONTH_COL, StringType()), StructField(BLOGGER_COL, StringType())])
    return as_double(read_sheets(spark, paths["detail"], schema))


def q_export_summary(spark, d):
    """The summary sheet of the export, read back."""
    from vitrina.operators.sinks import read_slices
    from vitrina.plans.export import export_month, read_sheets
    from vitrina.plans.load import MONTH_COL
    from vitrina.session import scratch_path
    short, full = _load_marts(spark, d)
    paths = export_month(spark, short, full, scratch_path(spark, "export"), None, detail_compression="gzip")
    m = read_slices(spark, short, MONTH_COL).schema  # the month is the folder's name
    return as_double(read_sheets(spark, paths["summary"], m))


def q_column_widths(spark, d):
    """Display width of every column of every (month, blogger) detail sheet."""
    from vitrina.plans.export import sheet_widths
    from vitrina.plans.load import BLOGGER_COL, MONTH_COL, to_mart
    detail = to_mart(payment.payment_detail(*_payment_inputs(spark, d)))
    return sheet_widths(detail, [MONTH_COL, BLOGGER_COL])


QUERIES.update({
    "full_reload_copy": q_full_reload_copy,
    "tabular_reload": q_tabular_reload,
    "reload_plan": q_reload_plan,
    "append_rows": q_append_rows,
    "reload_by_position": q_reload_by_position,
    "replace_slice": q_replace_slice,
    "backfill_clears": q_backfill_clears,
    "export_summary": q_export_summary,
    "export_detail": q_export_detail,
    "column_widths": q_column_widths,
})


def q_month_feed(spark, d):
    """Staging rows arrive as files; the streaming feed loads their months
    into the marts (availableNow); the summary mart is read back."""
    from vitrina.session import scratch_path
    from vitrina.streaming import run_month_feed
    posts, roster, kpi, price = _payment_inputs(spark, d)
    staging, root = scratch_path(spark, "staging"), scratch_path(spark, "feed")
    posts.write.parquet(staging)
    short, full = f"{root}/tiktok_payment_short", f"{root}/tiktok_payment_full"
    q = run_month_feed(spark, staging, spark.read.parquet(staging).schema, roster, kpi, price,
                       short, full, scratch_path(spark, "feed-checkpoint"))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_mart(spark, short)


QUERIES["month_feed"] = q_month_feed


# ---- beyond the broadcast bounds, under faults, from metadata ------------------------------------

def q_name_key_join_dealt(spark, d):
    """The name join with a roster beyond the broadcast bound: hot bloggers dealt over salts."""
    from vitrina.operators.joins import name_key_join, person_keys
    keyed = person_keys(fx.posts(spark, d))
    return name_key_join(keyed, fx.roster(spark, d), max_bytes=0).select(
        "first_name", "last_name", "author", "account_name", "sheets_name", "grade", "currency", "region")


def q_bracket_join_row_blocks(spark, d):
    """The premium lookups with sheets beyond the broadcast bound: joined by aligned blocks."""
    br = payment.Brackets(fx.kpi(spark), fx.price(spark))
    br.kpi_bc = br.price_bc = False
    t = payment.post_premiums(_stats(spark, d), br)
    return as_double(t.select("first_name", "last_name", "grade", "currency", "sheets_name", "release_date",
                              "tiktok_reach", "likee_reach", "tiktok_premium", "likee_premium"))


def q_payment_summary_blocks(spark, d):
    """The summary mart with every bracket lookup joined by aligned blocks."""
    plan = payment.PaymentPlan(*_payment_inputs(spark, d))
    plan.br.kpi_bc = plan.br.price_bc = False
    return as_double(plan.summary())


def q_range_join(spark, d):
    """Many overlapping ranges (one for each part, some open-ended) against the suppliers of all line items."""
    from vitrina.operators.joins import bracket_join
    from vitrina.sources.tables import read_table
    sheet = read_table(spark, d, "part", ["p_partkey", "p_size"]).select(
        (F.col("p_size") % 3).alias("grade"), F.col("p_partkey").alias("lo"),
        F.when(F.col("p_partkey") % 500 == 0, 9999999).otherwise(F.col("p_partkey") + F.col("p_size")).alias("hi"),
        F.col("p_size").alias("v"))
    rows = read_table(spark, d, "lineitem", ["l_linenumber", "l_suppkey"]).select(
        (F.col("l_linenumber") % 3).alias("grade"), F.col("l_suppkey").alias("m"))
    found = bracket_join(rows, sheet, "m", "lo", "hi", {"v": "v"}, keys=["grade"], broadcast=False, coalesce=False)
    return found.groupBy("grade", "m").agg(F.count(F.lit(1)).alias("n_rows"), F.count("v").alias("n_ranges"), F.sum("v").alias("v"))


def q_carry_repeated_ids(spark, d):
    """Marks carried over ids that repeat hundreds of times or are missing."""
    from vitrina.operators.ordered import carry_last
    from vitrina.sources.tables import read_table
    rows = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag", "l_suppkey", "l_quantity"])
    rows = rows.withColumn("place", F.when(F.col("l_linenumber") != 3, F.col("l_suppkey")))
    mark = F.when((F.col("l_quantity") > 45) & (F.col("l_suppkey") % 7 == 0), F.col("l_orderkey"))
    got = carry_last(rows, "place", mark, "carried", by=["l_returnflag"], bits=3, max_rows=500)
    return got.select("l_orderkey", "l_linenumber", "l_returnflag", "place", "carried")


def q_reload_outcomes(spark, d):
    """Seven tables copied side by side, one of which does not exist: the others are there."""
    from vitrina.plans.load import ParquetTables, reload_plan, reload_tables
    from vitrina.session import scratch_path
    root = scratch_path(spark, "outcomes")
    sources = ParquetTables(spark, {("stage_db", "tpch"): d}, suffix=".parquet")
    targets = ParquetTables(spark, {("stage_db", "stg_tpch"): root})
    names = [t if t != "supplier" else "no_such_table" for t in RELOAD_TABLES]
    outcomes = reload_tables(spark, reload_plan(fx.reload_config(spark, names), "tpch"), sources, targets)
    rows = []
    for o in outcomes:
        name, good = o.row.table_name_target, o.error is None
        copied = targets.read("stage_db", "stg_tpch", name) if good else spark.range(0)
        rows.append(copied.agg(F.lit(name).alias("table_name"), F.lit(good).alias("replaced"), F.count(F.lit(1)).alias("n_rows")))
    return reduce(DataFrame.union, rows)


def q_marts_after_faults(spark, d):
    """Both marts, read as of one moment, after a backfill, a load that died before its decision, and a
    reload of one month: every month from one load."""
    from vitrina.operators import versions
    from vitrina.plans.load import MONTH_COL, load_payment_months
    short, full = _load_marts(spark, d)
    dead = versions.Load(spark, [short, full])
    for path in (short, full):
        now = versions.read_table(spark, path)
        dead.put(path, now.schema, MONTH_COL, dead.write(path, now.where(F.col(f"`{MONTH_COL}`") == TEST_MONTH), MONTH_COL))
    dead.files.create(versions._commit_path(short, dead.base[short].number + 1), json.dumps({
        "load": dead.id, "schema": dead.staged[short][0].jsonValue(), "part_col": MONTH_COL, "folders": dead.staged[short][2],
        "decision": f"{short}/_commits/decisions/{dead.id}"}))  # one commit of two, no decision
    load_payment_months(spark, *_payment_inputs(spark, d), short, full, [TEST_MONTH])
    both = versions.read_together(spark, [short, full])
    counts = [m.groupBy(F.col(f"`{MONTH_COL}`").alias("month")).agg(F.lit(name).alias("mart"), F.count(F.lit(1)).alias("n_rows"))
              for name, m in zip(("summary", "detail"), both)]
    return counts[0].union(counts[1])


def q_slice_labels(spark, d):
    """The months a mart holds, from its last commit: no row is read."""
    from vitrina.operators.sinks import slice_labels
    from vitrina.plans.load import MONTH_COL
    short, _ = _load_marts(spark, d)
    return spark.createDataFrame([(m,) for m in sorted(slice_labels(spark, short, MONTH_COL))], "month string")


def q_split_scans(spark, d):
    """``orders`` read in 16 scans by equi-depth splits of a key with repeats, dates and all: nothing is
    lost or read twice, and no scan holds more than twice its share."""
    from vitrina.plans.load import split_predicates
    from vitrina.sources.tables import read_table
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    out = []
    for key in ("o_custkey", "o_orderdate"):
        scans = split_predicates(orders.select(key), key, 16)
        parts = reduce(DataFrame.union, [orders.where(p).select(F.lit(k).alias("scan"), "o_orderkey") for k, p in enumerate(scans)])
        sizes = parts.groupBy("scan").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("s"))
        out.append(sizes.agg(F.lit(key).alias("key"), F.sum("n").alias("n_rows"), F.sum("s").alias("key_sum"),
                             (F.max("n") * 16 <= 2 * F.sum("n")).alias("even")))
    return out[0].union(out[1])


def q_sheet_files(spark, d):
    """Sheets of ``customer`` by segment and nation, and of one large sheet: files and rows of each."""
    from vitrina.operators.sinks import export_split
    from vitrina.plans.export import read_sheets
    from vitrina.session import scratch_path
    from vitrina.sources.tables import read_table
    customers = read_table(spark, d, "customer", ["c_custkey", "c_mktsegment", "c_nationkey"])
    sheet = F.when(F.col("c_nationkey") < 5, F.lit("large")).otherwise(F.concat_ws("-", "c_mktsegment", "c_nationkey"))
    path = scratch_path(spark, "sheet-files")
    limit = customers.where("c_nationkey < 5").count() - 1
    export_split(customers.select("c_custkey", sheet.alias("sheet")), path, ["sheet"], [F.col("c_custkey")], sheet_rows=limit)
    back = read_sheets(spark, path, StructType.fromDDL("c_custkey bigint, sheet string"))
    return (back.withColumn("file", F.col("_metadata.file_name")).groupBy("sheet")
                .agg((F.countDistinct("file") == 1).alias("one_file"), F.count(F.lit(1)).alias("n_rows"), F.sum("c_custkey").alias("key_sum"))
                .withColumn("one_file", F.col("one_file") | (F.col("sheet") == "large")))


QUERIES.update({
    "name_key_join_dealt": q_name_key_join_dealt,
    "bracket_join_row_blocks": q_bracket_join_row_blocks,
    "payment_summary_blocks": q_payment_summary_blocks,
    "range_join": q_range_join,
    "carry_repeated_ids": q_carry_repeated_ids,
    "reload_outcomes": q_reload_outcomes,
    "marts_after_faults": q_marts_after_faults,
    "slice_labels": q_slice_labels,
    "split_scans": q_split_scans,
    "sheet_files": q_sheet_files,
})
