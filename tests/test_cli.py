"""The command-line jobs on parquet folders."""

import os

from pyspark.sql import functions as F

from tests.test_marts import _frames
from vitrina import cli
from vitrina.operators.versions import read_table
from vitrina.session import scratch_path


def test_cli_load_export_reload(spark):
    posts, roster, kpi, price = _frames(spark)
    root = scratch_path(spark, "cli")
    for name, df in [("posts", posts), ("roster", roster), ("kpi", kpi), ("price", price)]:
        df.write.parquet(f"{root}/{name}")
    args = ["load-month"] + [x for n in ("posts", "roster", "kpi", "price")
                             for x in (f"--{n}", f"{root}/{n}")]
    args += ["--short", f"{root}/short", "--full", f"{root}/full", "--month", "m1"]
    assert cli.main(args) == 0
    months = {r[0] for r in read_table(spark, f"{root}/short").select("месяц отчёта").distinct().collect()}
    assert months == {"m1"}
    assert cli.main(["export-month", "--short", f"{root}/short", "--full", f"{root}/full",
                     "--out", f"{root}/out", "--month", "m1"]) == 0
    assert os.path.isdir(f"{root}/out/detail")
    os.makedirs(f"{root}/cfg", exist_ok=True)
    with open(f"{root}/cfg/config.csv", "w") as f:
        f.write("db_source_name,schema_name_source,table_name_source,db_target_name,"
                "schema_name_target,table_name_target,reload\n"
                "db,src,kpi,db,stg,kpi_copy,1\ndb,src,price,db,stg,price_copy,0\n")
    os.makedirs(f"{root}/src", exist_ok=True)
    kpi.write.parquet(f"{root}/src/kpi")
    assert cli.main(["reload", "--config", f"{root}/cfg/config.csv", "--schema", "src",
                     "--source", f"db.src={root}/src", "--target", f"db.stg={root}/stg"]) == 0
    assert read_table(spark, f"{root}/stg/kpi_copy").count() == kpi.count()
    assert not os.path.exists(f"{root}/stg/price_copy")
    assert read_table(spark, f"{root}/full").where(F.col("месяц отчёта") != "m1").count() == 0
