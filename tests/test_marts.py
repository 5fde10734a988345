"""Marts on hand-made frames with the awkward cases (overlapping brackets,
gaps, duplicate roster names, missing price bracket, several months and
accounts), checked against the literal SQL of the marts run by DuckDB."""

import datetime as dt
from decimal import Decimal

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vitrina.plans import marketing, oracle, payment, profit
from vitrina.plans.oracle_fixtures import FX_KPI, FX_POSTS, FX_PRICE, FX_ROSTER

POSTS = pd.DataFrame([
    # author, release_date, tiktok_reach, link, youtube, instagram, likee_link, likee_reach, account, month
    ("ann lee", "2025-03-01", "100", "http://1", "5", "10", "", "7", "Отчет A", "m1"),
    ("ann lee", "2025-03-02", "", "http://2", "", "20", "", "", "Отчет A", "m1"),
    ("ann lee", "2025-03-03", "25000", "Дубай", "1", "1", "", "3", "Отчет B", "m1"),
    ("ann lee", "2025-04-01", "50", "", "2", "2", "", "1", "Отчет A", "m2"),
    ("bob ray", "2025-03-05", "45000", "http://3", "3", "3", "", "0", "Отчет A", "m1"),
    ("bob ray", "2025-03-06", "45000", None, "3", "3", "", "0", "Отчет A", "m1"),
    ("cat", "2025-03-07", "1", "http://4", "1", "1", "", "1", "Отчет A", "m1"),       # one word
    ("dan fox", "2025-03-08", "1", "http://5", "1", "1", "", "1", "Отчет A", "m1"),   # not on roster
], columns=["author", "release_date", "tiktok_reach", "tiktok_video_link", "youtube_reach",
            "instagram_reach", "likee_video_link", "likee_reach", "account_name", "sheets_name"])
POSTS["release_date"] = pd.to_datetime(POSTS["release_date"]).dt.date

ROSTER = pd.DataFrame([
    ("lee ann X", "r", "RUB", "A", "TRUE", "c1"),
    ("lee ann Y", "r", "BYN", "B", "FALSE", "c2"),      # same name twice: rows fan out
    ("ray bob", "r", "RUB", "B", "FALSE", "c3"),
], columns=["blogger", "region", "currency", "grade", "is_state", "contract"])

KPI = pd.DataFrame([
    ("A", "RUB", 0, 200, 1, 2, 3, 4),
    ("A", "RUB", 100, 30000, 10, 20, 30, 40),            # overlaps the first on 100..200
    ("B", "RUB", 40000, 50000, 5, 6, 7, 8),
    ("B", "BYN", 0, 10, 9, 9, 9, 9),                     # gap above 10
], columns=["grade", "currency", "start_reach", "end_reach", "tiktok", "instagram", "youtube", "likee"])

PRICE = pd.DataFrame([
    ("A", "RUB", 1, 2, 10), ("A", "RUB", 2, 5, 20),      # overlap at 2
    ("B", "RUB", 1, 100, 15),                            # B/BYN missing: NULL price
], columns=["grade", "currency", "start_count", "end_count", "price"])

POSTS_DDL = ("author string, release_date date, tiktok_reach string, tiktok_video_link string, "
             "youtube_reach string, instagram_reach string, likee_video_link string, "
             "likee_reach string, account_name string, sheets_name string")


def _frames(spark):
    return (spark.createDataFrame(POSTS, POSTS_DDL),
            spark.createDataFrame(ROSTER, "blogger string, region string, currency string, "
                                          "grade string, is_state string, contract string"),
            spark.createDataFrame(KPI, "grade string, currency string, start_reach int, "
                                       "end_reach int, tiktok int, instagram int, youtube int, likee int"),
            spark.createDataFrame(PRICE, "grade string, currency string, start_count int, "
                                         "end_count int, price int"))


def _duck(sql: str) -> pd.DataFrame:
    con = duckdb.connect()
    posts, kpi, price, roster = POSTS, KPI, PRICE, ROSTER  # noqa: F841 - seen by DuckDB
    con.register("t_posts", posts)
    con.register("t_roster", roster)
    con.register("t_kpi", kpi.astype({c: "int32" for c in kpi.columns[2:]}))
    con.register("t_price", price.astype({c: "int32" for c in price.columns[2:]}))
    sql = (sql.replace(FX_POSTS, "\nfx_posts AS (SELECT * FROM t_posts)")
              .replace(FX_ROSTER, "\nfx_roster AS (SELECT * FROM t_roster)")
              .replace(FX_KPI, "\nfx_kpi AS (SELECT * FROM t_kpi)")
              .replace(FX_PRICE, "\nfx_price AS (SELECT * FROM t_price)"))
    return con.execute(sql).df()


def _norm(v):
    if hasattr(v, "item"):          # numpy scalar
        v = v.item()
    if v is None or v is pd.NA or (isinstance(v, float) and pd.isna(v)):
        return None
    if isinstance(v, (int, float, Decimal)) and not isinstance(v, bool):
        return float(v)
    if isinstance(v, dt.datetime) and v.time() == dt.time(0):
        return v.date().isoformat()
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _rows(df_or_pdf, cols):
    if hasattr(df_or_pdf, "toPandas"):
        df_or_pdf = df_or_pdf.toPandas()
    return sorted((tuple(_norm(v) for v in r) for r in df_or_pdf[cols].itertuples(index=False)),
                  key=repr)


@pytest.mark.parametrize("name", ["payment_summary", "payment_detail", "payment_summary_v2"])
def test_payment_marts_against_sql(spark, name):
    posts, roster, kpi, price = _frames(spark)
    fn = getattr(payment, name)
    got = fn(posts, roster, kpi, price)
    sql = {"payment_summary": oracle.PAYMENT_SUMMARY, "payment_detail": oracle.PAYMENT_DETAIL,
           "payment_summary_v2": oracle._summary_v2(60)}[name]
    want = _duck(sql)
    cols = sorted(got.columns)
    assert sorted(want.columns) == cols
    g, w = _rows(got, cols), _rows(want, cols)
    assert len(g) > 0
    assert g == w


def test_v2_cap_branch_against_sql(spark):
    posts, roster, kpi, price = _frames(spark)
    got = payment.payment_summary_v2(posts, roster, kpi, price, cap=1)
    sql = oracle._summary_v2(1)
    want = _duck(sql)
    cols = sorted(got.columns)
    assert _rows(got, cols) == _rows(want, cols)


def test_single_month_equals_slice_of_all(spark):
    posts, roster, kpi, price = _frames(spark)
    one = payment.payment_summary(posts, roster, kpi, price, month="m1")
    every = payment.payment_summary(posts, roster, kpi, price).where(F.col("sheets_name") == "m1")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, every.collect()))


def test_missing_price_gives_null_total(spark):
    posts, roster, kpi, price = _frames(spark)
    only_byn = roster.where(F.col("blogger") != "lee ann X")   # ann lee: B/BYN only, no price bracket
    rows = payment.payment_summary(posts, only_byn, kpi, price).collect()
    ann = [r for r in rows if r.blogger_name == "ann lee"]
    assert ann and all(r.price_count_videos is None and r.sum_count is None for r in ann)
    bob = [r for r in rows if r.blogger_name == "bob ray"]
    assert bob and all(r.sum_count is not None for r in bob)


# ---- budget ---------------------------------------------------------------------------------

BUDGET_DDL = ("id long, social_network string, social_link string, responsible_person string, "
              "price string, product_cost string, actual_reach string, actual_cpm string, "
              "reach string, is_integration string, region string, format string, sheets_name string")


def _budget_row(i, person, link="link", cpm="3,5", reach="1", integ="TRUE", month="Апрель 2025"):
    return (i, "tt", link, person, "1 000,5", "", "2 000", cpm, reach, integ, "r", "f", month)


def test_budget_edges(spark):
    rows = [
        _budget_row(1, "before header"),                  # before the first header: Nothing
        _budget_row(2, "p-tsh01-x"),                      # header
        _budget_row(3, "anna"),
        _budget_row(4, "anna", cpm="#DIV/0!"),            # error cell: dropped
        _budget_row(5, None),                             # NULL person: dropped at the end
        _budget_row(6, "p-lmb02-x"),
        _budget_row(7, "boris", integ="FALSE"),           # not an integration
        _budget_row(8, "boris"),
        _budget_row(9, "total", reach="Итого Безнал"),    # its id is excluded
        _budget_row(10, "after", link="БЮДЖЕТ "),         # cut-off
        _budget_row(11, "after cut-off"),
        _budget_row(1, "other month, no cut-off", month="Март 2025"),
    ]
    df = spark.createDataFrame(rows, BUDGET_DDL)
    got = marketing.budget_integrations(df).orderBy("id").collect()
    assert [(r.id, r.product_name, r.articul_product) for r in got] == [
        (1, "Nothing", None), (3, "Tashe", "tsh01"), (8, "Limba", "lmb02")]
    assert got[0].full_price == Decimal("1000.5") and got[0].actual_reach == Decimal("2000")
    one = marketing.budget_integrations(df, month="Апрель 2025").orderBy("id").collect()
    assert [tuple(r) for r in one] == [tuple(r) for r in got]


def test_budget_null_total_id_empties_month(spark):
    rows = [_budget_row(1, "a"), _budget_row(None, "t", reach="Итого Безнал"),
            _budget_row(5, "x", link="БЮДЖЕТ ")]
    df = spark.createDataFrame(rows, BUDGET_DDL)
    assert marketing.budget_integrations(df).count() == 0


# ---- weekly profit -------------------------------------------------------------------------

def test_weekly_profit_merges_years_and_guards_zero(spark):
    d3 = Decimal
    rows = [
        (1, "2024-01-02 10:00:00", "n", "a", d3("2"), d3("10"), d3("4"), d3("0"), d3("0"), d3("0"), d3("3")),
        (1, "2024-01-03 10:00:00", "n", "a", d3("2"), d3("10"), d3("4"), d3("0"), d3("0"), d3("0"), d3("3")),  # dup
        (2, "2025-01-01 10:00:00", "n", "a", d3("0"), d3("5"), d3("5"), d3("0"), d3("0"), d3("0"), d3("1")),
        (3, "2025-01-01 10:00:00", "n", "", d3("9"), d3("9"), d3("9"), d3("0"), d3("0"), d3("0"), d3("9")),   # no article
    ]
    ddl = ("id long, date_data string, name string, article string, sellQuantity decimal(18,3), "
           "sellSum decimal(18,3), sellCostSum decimal(18,3), returnQuantity decimal(18,3), "
           "returnSum decimal(18,3), returnCostSum decimal(18,3), profit decimal(18,3)")
    df = spark.createDataFrame(rows, ddl).withColumn("date_data", F.to_timestamp_ntz("date_data"))
    got = profit.weekly_profit(df).collect()
    assert len(got) == 1                      # week 1 of 2024 and of 2025 merge
    r = got[0]
    assert r.week_number == 1 and str(r.week_start) == "2024-01-01 00:00:00"
    assert r.sellquantity == Decimal("2") and r.sellsum == Decimal("15")   # duplicate counted once
    assert r.sellprice == Decimal("7.50") and r.returnprice == 0 and r.returncost == 0
    assert r.salesmargin == Decimal("44.44") and r.margin == Decimal("26.67")
    assert profit.OUTPUT_COLUMNS == profit.weekly_profit(df).columns
