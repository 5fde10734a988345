"""Input views of the marts, derived from the driver's test tables.

The marts read staging tables (posts, roster, bracket tables, budget sheet
rows, daily profit).  These views build them from the TPC-H-ish driver tables
with expressions every SQL engine shares, so the DuckDB oracle can rebuild
the same rows.  All work grows with the driver tables; only the two bracket
mapping tables are fixed (they are hand-kept mapping sheets by nature).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vitrina.sources.tables import read_table

# The bracket mapping sheets used by the test views.  Premiums and prices have
# fractions, bounds too; some ranges overlap, some measures fall into a gap.
# grade, currency, start_reach, end_reach, tiktok, instagram, youtube, likee
KPI_ROWS = [
    ("A", "RUB", "0", "20000.5", "0.25", "0", "0", "0"),
    ("A", "RUB", "20001", "9999999", "50.50", "70", "30.75", "10"),
    ("A", "RUB", "30000", "45000.5", "7.50", "2", "1", "0.50"),
    ("B", "RUB", "0", "40000", "5.25", "1", "2", "3"),
    ("B", "RUB", "40000.5", "9999999", "80", "40.10", "20", "9"),
    ("A", "BYN", "1000", "60000", "7.50", "8", "9", "1"),
    ("B", "BYN", "0.5", "10.5", "1.10", "0.70", "3.30", "2.50"),
    ("B", "BYN", "500", "90000", "11", "12", "13", "2"),
]
KPI_SCHEMA = ("grade string, currency string, start_reach decimal(12,1), end_reach decimal(12,1), "
              "tiktok decimal(10,2), instagram decimal(10,2), youtube decimal(10,2), likee decimal(10,2)")

# grade, currency, start_count, end_count, price
PRICE_ROWS = [
    ("A", "RUB", "1", "5", "10.50"),
    ("A", "RUB", "4", "6", "3"),
    ("A", "RUB", "7", "100", "20"),
    ("B", "RUB", "1", "100", "15.25"),
    ("A", "BYN", "1", "3", "4"),
    ("B", "BYN", "1", "100", "6"),
]
PRICE_SCHEMA = "grade string, currency string, start_count int, end_count int, price decimal(10,2)"

# Spreadsheet markers of the budget sheet.
BUDGET_CUTOFF_LINK = "БЮДЖЕТ "
BUDGET_TOTAL_ROW = "Итого Безнал"
BUDGET_ERROR = "#DIV/0!"
BUDGET_MONTHS = ("Апрель 2025", "Март 2025", "Май 2025")
SECTION_CODES = ("tsh01", "lmb02", "zzz03")
REPORT_PREFIX = "Отчет "
SPECIAL_LOCATION = "Дубай"
NBSP = "\u00a0"
GIVEN_NAME = "Анна"  # a name outside ASCII

RELOAD_SCHEMA = ("db_source_name string, schema_name_source string, table_name_source string, "
                 "db_target_name string, schema_name_target string, table_name_target string, "
                 "reload int")


def posts(spark: SparkSession, root: str) -> DataFrame:
    """Published videos, one row per lineitem (``lineitem`` joined to ``part``); the rows of
    some orders come twice, some have no date, some authors a Cyrillic name."""
    l = read_table(spark, root, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey",
                                             "l_linenumber", "l_quantity", "l_extendedprice",
                                             "l_returnflag", "l_linestatus", "l_shipdate"],
                   spread_small=True)
    # year and month are taken once a line item, not once for each place they stand in
    l = twice(l.withColumn("_y", F.year("l_shipdate")).withColumn("_m", F.month("l_shipdate")), F.col("l_orderkey") % 50 == 0)
    # a part's author is made once, not once for each of its line items
    p = read_table(spark, root, "part", ["p_partkey", "p_name"]).select(
        "p_partkey", F.concat(_given(), F.lit(" "), F.split_part("p_name", F.lit(" "), F.lit(2))).alias("author"))
    j = l.join(p, l.l_partkey == p.p_partkey)
    s = lambda c: c.cast("string")
    return j.select(
        "author",
        F.when(F.col("l_orderkey") % 89 != 0, F.to_date("l_shipdate")).alias("release_date"),
        F.when(F.col("l_linenumber") == 1, F.lit(""))
         .otherwise(s(F.floor("l_extendedprice").cast("int"))).alias("tiktok_reach"),
        F.when(F.col("l_linestatus") == "O", F.concat(F.lit("http://v/"), s(F.col("l_orderkey"))))
         .when(F.col("l_returnflag") == "A", F.lit(SPECIAL_LOCATION))
         .otherwise(F.lit("")).alias("tiktok_video_link"),
        F.when(F.col("l_linenumber") == 2, F.lit(""))
         .otherwise(s(F.col("l_quantity").cast("int"))).alias("youtube_reach"),
        s((F.col("l_quantity") * 10).cast("int")).alias("instagram_reach"),
        F.lit("").alias("likee_video_link"),
        s(F.col("l_suppkey").cast("int")).alias("likee_reach"),
        F.concat(F.lit(REPORT_PREFIX), F.col("l_returnflag")).alias("account_name"),
        _year_month("l_shipdate", F.col("_y"), F.col("_m")).alias("sheets_name"),
    )


def _year_month(c: str, y: Column, m: Column) -> Column:
    """``yyyy-MM``, put together from the numbers: a formatter for each row costs several times as much."""
    plain = F.concat(y.cast("string"), F.when(m < 10, "-0").otherwise("-"), m.cast("string"))
    return F.when(y.between(1000, 9999), plain).otherwise(F.date_format(c, "yyyy-MM"))


def twice(df: DataFrame, some) -> DataFrame:
    """The rows of ``df``, those where ``some`` holds two times."""
    copies = F.when(some, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.withColumn("_copy", F.explode(copies)).drop("_copy")


def _given():
    return (F.when(F.length("p_name") % 7 == 0, F.lit(GIVEN_NAME))
            .otherwise(F.split_part("p_name", F.lit(" "), F.lit(1))))


def roster(spark: SparkSession, root: str) -> DataFrame:
    """Blogger roster, 'Last First X' names, one row per distinct part name; some names have a
    second row with other terms."""
    p = read_table(spark, root, "part", ["p_name"])
    n = F.length("p_name")
    even = (n % 2) == 0
    again = F.col("_copy") == 2
    copies = F.when(n % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return p.withColumn("_copy", F.explode(copies)).select(
        F.concat(F.split_part("p_name", F.lit(" "), F.lit(2)), F.lit(" "), _given(), F.lit(" X")).alias("blogger"),
        F.when(again, F.lit("r2")).otherwise(F.lit("r")).alias("region"),
        F.when(again, "BYN").when(even, "RUB").otherwise("BYN").alias("currency"),
        F.when(again, "A").when((n % 3) == 0, "A").otherwise("B").alias("grade"),
        F.when(even & ~again, "TRUE").otherwise("FALSE").alias("is_state"),
        F.when(again, F.lit("second")).otherwise(F.lit("contract")).alias("contract"),
    ).distinct()


def _sql_literal(v, dtype) -> str:
    if v is None:
        return f"CAST(NULL AS {dtype.simpleString()})"
    if isinstance(v, str) and dtype.simpleString() == "string":
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"CAST({v} AS {dtype.simpleString()})"


def literal_table(spark: SparkSession, rows, ddl: str) -> DataFrame:
    """A small fixed table as a SQL VALUES list: a local relation on the
    driver's plan, no Python rows shipped and no job to build it."""
    schema = StructType.fromDDL(ddl)
    names = [f.name for f in schema.fields]
    if not rows:
        return spark.sql("SELECT " + ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`"
                                               for f in schema.fields) + " WHERE false")
    values = ", ".join("(" + ", ".join(_sql_literal(v, f.dataType) for v, f in zip(r, schema.fields)) + ")"
                       for r in rows)
    cols = ", ".join(f"CAST(`{n}` AS {f.dataType.simpleString()}) AS `{n}`" for n, f in zip(names, schema.fields))
    return spark.sql(f"SELECT {cols} FROM VALUES {values} AS t({', '.join(f'`{n}`' for n in names)})")


def kpi(spark: SparkSession) -> DataFrame:
    return literal_table(spark, KPI_ROWS, KPI_SCHEMA)


def price(spark: SparkSession) -> DataFrame:
    return literal_table(spark, PRICE_ROWS, PRICE_SCHEMA)


def budget(spark: SparkSession, root: str) -> DataFrame:
    """Advertising-budget sheet rows (one per event) with section headers, a cut-off row,
    total rows, error cells and blank-separated numbers; rows without id in two months,
    and total rows without id in a third (NOT IN then keeps nothing of that month)."""
    e = read_table(spark, root, "events", ["event_id", "user_id", "event_type", "value"],
                   spread_small=True)
    eid, uid = F.col("event_id"), F.col("user_id")
    third = uid % 10 == 7
    # cut-off rows sit in the last tenth of the sheet: id*10 >= 9*count
    n_rows = e.select(F.count(F.lit(1))).scalar()
    code = (F.when(eid % 150 == 0, SECTION_CODES[0])
             .when(eid % 150 == 50, SECTION_CODES[1])
             .otherwise(SECTION_CODES[2]))
    s = lambda c: c.cast("string")
    return e.select(
        F.when(F.when(third, eid % 97 != 0).otherwise((eid % 53 != 0) | (eid % 97 == 0)), eid).alias("id"),
        F.col("event_type").alias("social_network"),
        F.when((eid * 10 >= n_rows * 9) & (eid % 100 == 0), F.lit(BUDGET_CUTOFF_LINK))
         .otherwise(F.lit("link")).alias("social_link"),
        F.when(eid % 50 == 0, F.concat(F.lit("p-"), code, F.lit("-x")))
         .when(eid % 71 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("person "), s(uid))).alias("responsible_person"),
        F.concat(s(F.floor("value")), F.lit(NBSP), F.lit("000,5")).alias("price"),
        F.when(eid % 7 == 0, F.lit("")).otherwise(F.concat(s(uid), F.lit(" 1,25"))).alias("product_cost"),
        F.concat(F.lit("1 "), s(uid + 100)).alias("actual_reach"),
        F.when(F.col("event_type") == "error", F.lit(BUDGET_ERROR)).otherwise(F.lit("3,5")).alias("actual_cpm"),
        F.when(eid % 97 == 0, F.lit(BUDGET_TOTAL_ROW)).otherwise(F.lit("1")).alias("reach"),
        F.when(F.col("event_type").isin("click", "purchase"), "TRUE").otherwise("FALSE").alias("is_integration"),
        F.lit("r").alias("region"),
        F.lit("f").alias("format"),
        F.when(third, BUDGET_MONTHS[2]).when(uid % 2 == 0, BUDGET_MONTHS[0]).otherwise(BUDGET_MONTHS[1])
         .alias("sheets_name"),
    )


def profit(spark: SparkSession, root: str) -> DataFrame:
    """Daily product profit rows (``lineitem`` joined to ``part``), money as decimal(18,3); the
    rows of some orders come twice."""
    l = read_table(spark, root, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                                             "l_extendedprice", "l_returnflag", "l_shipdate"],
                   spread_small=True)
    l = twice(l, F.col("l_orderkey") % 50 == 0)
    p = read_table(spark, root, "part", ["p_partkey", "p_name", "p_brand", "p_size"])
    j = l.join(p, l.l_partkey == p.p_partkey)
    d3 = "decimal(18,3)"
    ext = F.col("l_extendedprice").cast("decimal(18,2)")
    half, share = F.lit(Decimal("0.5")), F.lit(Decimal("0.3"))
    sold, ret = F.col("l_returnflag") == "N", F.col("l_returnflag") == "R"
    zero = F.lit(0)
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_shipdate").alias("date_data"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_size") == 1, F.lit("")).otherwise(F.col("p_brand")).alias("article"),
        F.when(sold, F.col("l_quantity")).otherwise(zero).cast(d3).alias("sellQuantity"),
        ext.cast(d3).alias("sellSum"),
        (ext * half).cast(d3).alias("sellCostSum"),
        F.when(ret, F.col("l_quantity")).otherwise(zero).cast(d3).alias("returnQuantity"),
        F.when(ret, ext).otherwise(zero).cast(d3).alias("returnSum"),
        F.when(ret, ext * half).otherwise(zero).cast(d3).alias("returnCostSum"),
        (ext * share).cast(d3).alias("profit"),
    )


def reload_config(spark: SparkSession, tables, schema: str = "tpch") -> DataFrame:
    """Control rows of a config-driven reload: ``tables`` flagged reload = 1,
    plus one row switched off and one of another schema (both must be skipped)."""
    rows = [("stage_db", schema, t, "stage_db", "stg_" + schema, t, 1) for t in tables]
    rows += [("stage_db", schema, "orders", "stage_db", "stg_" + schema, "orders_off", 0),
             ("stage_db", "other", "lineitem", "stage_db", "stg_other", "lineitem", 1)]
    return literal_table(spark, rows, RELOAD_SCHEMA)
