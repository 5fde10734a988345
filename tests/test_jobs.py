"""Data movement: reloads by name / position, config plan, sheet load,
idempotent month replacement, split export."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from vitrina.operators.sinks import create_empty, full_reload, replace_slices
from vitrina.operators.versions import read_table
from vitrina.plans.export import export_month, read_sheets
from vitrina.plans.load import (BLOGGER_COL, MONTH_COL, RELEASE_COL, load_payment_months,
                                reload_plan, tabular_reload)
from vitrina.session import scratch_path
from vitrina.sources import fixtures as fx

from tests.test_marts import _frames

TARGET = StructType([StructField("id", LongType()), StructField("name", StringType()),
                     StructField("extra", StringType())])


def test_reload_by_name(spark):
    path = scratch_path(spark, "t")
    create_empty(spark, path, TARGET)
    src = spark.createDataFrame([("a", 1)], "name string, id int")      # other order, narrower type
    out = full_reload(spark, src, path, by="name")
    assert out.schema == TARGET
    assert [tuple(r) for r in out.collect()] == [(1, "a", None)]
    src2 = spark.createDataFrame([(2, "b")], "id int, name string")
    assert [tuple(r) for r in full_reload(spark, src2, path).collect()] == [(2, "b", None)]  # truncated
    with pytest.raises(ValueError):
        full_reload(spark, spark.createDataFrame([(1, "x")], "id int, unknown string"), path)


def test_reload_by_position(spark):
    path = scratch_path(spark, "t")
    create_empty(spark, path, TARGET)
    out = full_reload(spark, spark.createDataFrame([(7, "z")], "a int, b string"), path, by="position")
    assert [tuple(r) for r in out.collect()] == [(7, "z", None)]
    with pytest.raises(AnalysisException):   # text into a number column is refused
        full_reload(spark, spark.createDataFrame([("7", "z")], "a string, b string"), path, by="position")
    with pytest.raises(ValueError):
        full_reload(spark, spark.createDataFrame([(1, "a", "b", "c")], "a int, b string, c string, d string"),
                    path, by="position")


def test_append_by_position(spark):
    from vitrina.operators.sinks import append
    path = scratch_path(spark, "t")
    create_empty(spark, path, TARGET)
    append(spark, spark.createDataFrame([(1, "a")], "x int, y string"), path)
    append(spark, spark.createDataFrame([(2, "b", "e")], "p long, q string, r string"), path)
    assert sorted(tuple(r) for r in read_table(spark, path).collect()) == [(1, "a", None), (2, "b", "e")]


def test_reload_plan(spark):
    plan = reload_plan(fx.reload_config(spark, ["orders", "part"]), "tpch")
    assert sorted(p.table_name_source for p in plan) == ["orders", "part"]


def test_tabular_reload(spark):
    root = scratch_path(spark, "sheet")
    os.makedirs(root, exist_ok=True)
    with open(f"{root}/config.csv", "w") as f:
        f.write("name,id\nalpha,1\nbeta,2\n")
    create_empty(spark, f"{root}/t", TARGET)
    got = tabular_reload(spark, f"{root}/config.csv", f"{root}/t")
    assert sorted(tuple(r) for r in got.collect()) == [(1, "alpha", None), (2, "beta", None)]
    with open(f"{root}/bad.csv", "w") as f:
        f.write("name,id\ngamma,x1\n")
    with pytest.raises(Exception):
        tabular_reload(spark, f"{root}/bad.csv", f"{root}/t")
    left = read_table(spark, f"{root}/t").collect()      # the old rows survive a bad cell
    assert sorted(tuple(r) for r in left) == [(1, "alpha", None), (2, "beta", None)]
    with open(f"{root}/quoted.csv", "w") as f:
        f.write('name,id\n"a ""b"" c",3\n"two\nlines, and a comma",4\n')
    got = tabular_reload(spark, f"{root}/quoted.csv", f"{root}/t")
    assert sorted((r.id, r.name) for r in got.collect()) == [(3, 'a "b" c'), (4, "two\nlines, and a comma")]


def test_unreadable_table_is_not_absent(spark):
    from vitrina.operators.sinks import path_exists
    root = scratch_path(spark, "broken")
    os.makedirs(root, exist_ok=True)
    assert not path_exists(spark, root) and not path_exists(spark, f"{root}/none")
    with open(f"{root}/part-0.parquet", "w") as f:
        f.write("this is no parquet file")
    with pytest.raises(Exception):
        path_exists(spark, root)


def test_backfill_clears_emptied_month_and_repairs(spark):
    posts, roster, kpi, price = _frames(spark)
    root = scratch_path(spark, "marts")
    short, full = f"{root}/short", f"{root}/full"
    load_payment_months(spark, posts, roster, kpi, price, short, full)
    want = _mart(spark, short), _mart(spark, full)
    create_empty(spark, full, read_table(spark, full).schema, [MONTH_COL])   # a swap that did not happen
    load_payment_months(spark, posts, roster, kpi, price, short, full)
    assert (_mart(spark, short), _mart(spark, full)) == want
    load_payment_months(spark, posts.where("sheets_name = 'm1'"), roster, kpi, price, short, full)
    assert _mart(spark, short) == [r for r in want[0] if r[-1] == "m1"]
    assert _mart(spark, full) == [r for r in want[1] if r[-1] == "m1"]


def test_month_labels_stay_text(spark):
    from vitrina.operators.sinks import read_slices
    path = scratch_path(spark, "labels")
    replace_slices(spark, {path: spark.createDataFrame([(1, "0125"), (2, "0225")], "v int, m string")}, "m")
    replace_slices(spark, {path: spark.createDataFrame([(3, "0125")], "v int, m string")}, "m")
    assert [tuple(r) for r in read_slices(spark, path, "m").collect()] == [(3, "0125")]


def test_exported_cells_round_trip(spark):
    from vitrina.operators.sinks import export_split
    rows = [("g", 'say "x"', "two\nlines"), ("g", None, ""), ("g", " padded ", "a,b")]
    df = spark.createDataFrame(rows, "k string, a string, b string")
    out = scratch_path(spark, "cells")
    export_split(df, out, ["k"], [F.col("a").asc_nulls_last()])
    schema = StructType([StructField("a", StringType()), StructField("b", StringType()), StructField("k", StringType())])
    back = read_sheets(spark, out, schema).collect()
    assert sorted(((r.k, r.a, r.b) for r in back), key=repr) == sorted(rows, key=repr)


def test_reload_between_stores(spark):
    from vitrina.plans.load import JdbcTables, ParquetTables, run_full_reload
    root = scratch_path(spark, "stores")
    src = ParquetTables(spark, {("stage_db", "tpch"): f"{root}/a"})
    dst = ParquetTables(spark, {("stage_db", "stg_tpch"): f"{root}/b"})
    spark.createDataFrame([(1, "x")], "id int, v string").write.parquet(src.path("stage_db", "tpch", "part"))
    assert dst.schema("stage_db", "stg_tpch", "part") is None
    run_full_reload(spark, fx.reload_config(spark, ["part"]), "tpch", src, dst)
    assert [tuple(r) for r in dst.read("stage_db", "stg_tpch", "part").collect()] == [(1, "x")]
    with pytest.raises(ValueError):                       # no bounds: one task would read it all
        JdbcTables(spark, {"stage_db": "jdbc:none"}).read("stage_db", "tpch", "part")


def _mart(spark, path):
    return sorted((tuple(r) for r in read_table(spark, path).collect()), key=repr)


def test_month_load_is_idempotent_and_clears_empty_month(spark):
    posts, roster, kpi, price = _frames(spark)
    root = scratch_path(spark, "marts")
    short, full = f"{root}/short", f"{root}/full"
    load_payment_months(spark, posts, roster, kpi, price, short, full)          # backfill m1, m2
    first_s, first_f = _mart(spark, short), _mart(spark, full)
    assert {r[-1] for r in first_s} == {"m1", "m2"}
    load_payment_months(spark, posts, roster, kpi, price, short, full, ["m1"])  # same month again
    assert _mart(spark, short) == first_s and _mart(spark, full) == first_f
    # m2 re-loaded with a roster that matches nobody: its slices end empty, m1 untouched
    nobody = roster.where(F.lit(False))
    load_payment_months(spark, posts, nobody, kpi, price, short, full, ["m2"])
    assert _mart(spark, short) == [r for r in first_s if r[-1] == "m1"]
    assert _mart(spark, full) == [r for r in first_f if r[-1] == "m1"]
    assert first_s != [r for r in first_s if r[-1] == "m1"]
    with pytest.raises(ValueError):                                            # gate
        load_payment_months(spark, posts, roster, kpi, price, short, full, ["m9"])


def test_replace_slices_keeps_other_months(spark):
    path = scratch_path(spark, "slices")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, m string")
    replace_slices(spark, {path: df}, "m")
    replace_slices(spark, {path: spark.createDataFrame([(3, "a")], "v int, m string")}, "m", ["a"])
    assert sorted(tuple(r) for r in read_table(spark, path).collect()) == [(2, "b"), (3, "a")]


def test_export_split(spark):
    posts, roster, kpi, price = _frames(spark)
    root = scratch_path(spark, "marts")
    short, full = f"{root}/short", f"{root}/full"
    load_payment_months(spark, posts, roster, kpi, price, short, full)
    out = scratch_path(spark, "export")
    paths = export_month(spark, short, full, out, "m1")
    sheets = sorted(p for p in os.listdir(paths["detail"]) if p.startswith(BLOGGER_COL))
    assert sheets == [f"{BLOGGER_COL}=ann  lee", f"{BLOGGER_COL}=bob  ray"]
    detail = read_table(spark, full).where(F.col(f"`{MONTH_COL}`") == "m1")
    back = read_sheets(spark, paths["detail"], StructType(
        [f for f in detail.schema.fields if f.name != BLOGGER_COL]
        + [StructField(BLOGGER_COL, StringType())]))
    assert back.count() == detail.count()
    assert back.where(F.col("likee_video_link") == "").count() == back.count()   # '' survives
    # inside a sheet file rows are in release-date order
    for sheet in sheets:
        d = f"{paths['detail']}/{sheet}"
        for fname in sorted(os.listdir(d)):
            if fname.endswith(".csv"):
                dates = [line.split(",")[2] for line in open(f"{d}/{fname}").read().splitlines()[1:]]
                assert dates == sorted(dates)
    widths = spark.read.option("header", True).csv(paths["widths"])
    assert widths.where(F.col("column_name") == RELEASE_COL).count() == len(sheets)


def _files(top):
    return [f"{d}/{f}" for d, _, names in os.walk(top) for f in names if not f.startswith((".", "_"))]


def test_detail_sheets_of_all_months_compressed(spark):
    """The same sheets, as ``.csv.gz``; the summary and the widths stay plain, and so does everything by default."""
    posts, roster, kpi, price = _frames(spark)
    root = scratch_path(spark, "marts")
    short, full = f"{root}/short", f"{root}/full"
    load_payment_months(spark, posts, roster, kpi, price, short, full)
    plain = export_month(spark, short, full, scratch_path(spark, "export"), None)
    packed = export_month(spark, short, full, scratch_path(spark, "export"), None, detail_compression="gzip")
    assert all(f.endswith(".csv") for p in plain.values() for f in _files(p))
    assert all(f.endswith(".csv") for k in ("summary", "widths") for f in _files(packed[k]))
    assert all(f.endswith(".csv.gz") for f in _files(packed["detail"]))
    folders = [sorted(os.path.dirname(f)[len(p["detail"]):] for f in _files(p["detail"])) for p in (plain, packed)]
    assert folders[0] == folders[1] and len(folders[0]) == 2
    mart = read_table(spark, full)
    rows = [sorted((tuple(r) for r in read_sheets(spark, p["detail"], mart.schema).select(*mart.columns).collect()), key=repr)
            for p in (plain, packed)]
    assert rows[0] == rows[1] == sorted((tuple(r) for r in mart.where(F.col(f"`{BLOGGER_COL}`").isNotNull()).collect()), key=repr)


def _exported(spark, monkeypatch, tmp_path, query):
    """What a registered export of a few line items gives, and the folders it wrote."""
    from vitrina.plans import export
    from vitrina.plans.registry import QUERIES
    seen, run, sf = [], export.export_month, str(tmp_path)
    spark.range(3).selectExpr("id p_partkey", "concat('red item', id) p_name").write.parquet(f"{sf}/part.parquet")
    spark.range(60).selectExpr(
        "id l_orderkey", "id % 3 l_partkey", "id % 7 l_suppkey", "int(id % 4 + 1) l_linenumber", "double(id % 50 + 1) l_quantity",
        "double(id * 100) l_extendedprice", "IF(id % 2 = 0, 'A', 'N') l_returnflag", "IF(id % 5 = 0, 'F', 'O') l_linestatus",
        "timestamp'1997-01-15' + make_interval(0, int(id % 3)) l_shipdate").write.parquet(f"{sf}/lineitem.parquet")

    def kept(*args, **named):
        seen.append(run(*args, **named))
        return seen[-1]

    monkeypatch.setattr(export, "export_month", kept)
    return QUERIES[query](spark, sf), seen[0]


def test_export_detail_keeps_its_sheets_compressed(spark, monkeypatch, tmp_path):
    back, paths = _exported(spark, monkeypatch, tmp_path, "export_detail")
    assert back.count() > 60
    assert back.inputFiles() and all(f.endswith(".csv.gz") for f in back.inputFiles())
    assert len(_files(paths["detail"])) == len(back.inputFiles()) and _files(paths["summary"]) and _files(paths["widths"])


def test_export_summary_writes_every_sheet(spark, monkeypatch, tmp_path):
    """The summary comes back from plain sheets; the detail's sheets are all written, compressed."""
    back, paths = _exported(spark, monkeypatch, tmp_path, "export_summary")
    assert back.count() > 0 and all(f.endswith(".csv") for f in back.inputFiles())
    assert len(back.inputFiles()) == len(_files(paths["summary"])) and _files(paths["widths"])
    assert len(_files(paths["detail"])) == 3 and all(f.endswith(".csv.gz") for f in _files(paths["detail"]))
