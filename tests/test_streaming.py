"""The streaming month feed gives the same marts as the batch load."""

from pyspark.sql import functions as F

from vitrina.operators.versions import read_table
from vitrina.plans.load import load_payment_months
from vitrina.session import scratch_path
from vitrina.streaming import run_month_feed

from tests.test_marts import _frames


def _mart(spark, path):
    return sorted((tuple(r) for r in read_table(spark, path).collect()), key=repr)


def test_month_feed_matches_batch_load(spark):
    posts, roster, kpi, price = _frames(spark)
    staging = scratch_path(spark, "staging")
    ckpt = scratch_path(spark, "ckpt")
    root = scratch_path(spark, "feed")
    short, full = f"{root}/short", f"{root}/full"
    # first file: month m1 only
    posts.where(F.col("sheets_name") == "m1").write.parquet(f"{staging}/f1")
    run_month_feed(spark, f"{staging}/*", posts.schema, roster, kpi, price, short, full, ckpt) \
        .awaitTermination(300)
    # second file: month m2; the next run only sees the new file
    posts.where(F.col("sheets_name") == "m2").write.parquet(f"{staging}/f2")
    run_month_feed(spark, f"{staging}/*", posts.schema, roster, kpi, price, short, full, ckpt) \
        .awaitTermination(300)
    ref = scratch_path(spark, "batch")
    load_payment_months(spark, posts, roster, kpi, price, f"{ref}/short", f"{ref}/full")
    assert _mart(spark, short) == _mart(spark, f"{ref}/short")
    assert _mart(spark, full) == _mart(spark, f"{ref}/full")
