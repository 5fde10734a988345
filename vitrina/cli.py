"""Command-line entry points for the jobs (run under spark-submit or python -m).

    python -m vitrina.cli load-month   --posts P --roster R --kpi K --price C \
                                       --short S --full F [--month M ...]
    python -m vitrina.cli export-month --short S --full F --out O --month M
    python -m vitrina.cli reload       --config CSV --schema tpch \
                                       --source DB.SCHEMA=ROOT ... --target DB.SCHEMA=ROOT ...

Tables are parquet folders; the session is the one spark-submit provides
(``getOrCreate``), so cluster settings, including ``spark.checkpoint.dir``,
come from the submit.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _roots(pairs):
    out = {}
    for p in pairs or []:
        key, root = p.split("=", 1)
        db, schema = key.split(".", 1)
        out[(db, schema)] = root
    return out


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="vitrina")
    sub = ap.add_subparsers(dest="cmd", required=True)
    lm = sub.add_parser("load-month", help="replace month slices of both payment marts")
    for a in ("posts", "roster", "kpi", "price", "short", "full"):
        lm.add_argument(f"--{a}", required=True)
    lm.add_argument("--month", action="append", help="month label; repeat; omit for all months")
    ex = sub.add_parser("export-month", help="summary sheet + one detail sheet per blogger")
    for a in ("short", "full", "out", "month"):
        ex.add_argument(f"--{a}", required=True)
    rl = sub.add_parser("reload", help="config-driven full reload of tables")
    rl.add_argument("--config", required=True, help="config sheet (header CSV)")
    rl.add_argument("--schema", required=True, help="schema_name_source to reload")
    rl.add_argument("--source", action="append", required=True, help="DB.SCHEMA=ROOT")
    rl.add_argument("--target", action="append", required=True, help="DB.SCHEMA=ROOT")
    a = ap.parse_args(argv)

    from vitrina.session import ensure_checkpoint_dir
    spark = SparkSession.builder.appName(f"vitrina-{a.cmd}").getOrCreate()
    ensure_checkpoint_dir(spark)
    if a.cmd == "load-month":
        from vitrina.plans.load import load_payment_months
        r = spark.read.parquet
        load_payment_months(spark, r(a.posts), r(a.roster), r(a.kpi), r(a.price), a.short, a.full,
                            a.month)
    elif a.cmd == "export-month":
        from vitrina.plans.export import export_month
        for k, v in export_month(spark, a.short, a.full, a.out, a.month).items():
            print(f"{k}: {v}")
    else:
        from pyspark.sql import functions as F

        from vitrina.plans.load import ParquetTables, read_tabular, run_full_reload
        config = read_tabular(spark, a.config).withColumn("reload", F.col("reload").cast("int"))
        plan = run_full_reload(spark, config, a.schema, ParquetTables(spark, _roots(a.source)),
                               ParquetTables(spark, _roots(a.target)))
        for row in plan:
            print(f"reloaded {row.schema_name_source}.{row.table_name_source} -> "
                  f"{row.schema_name_target}.{row.table_name_target}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
