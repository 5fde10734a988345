"""Hot keys, unknown tables and many tables at once: dealt joins, equi-depth splits, parallel reloads, sheets."""

import gzip
import os
import subprocess
import sys
import textwrap
import threading
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vitrina.operators.joins import heavy_keys, name_key_join, person_keys, skew_join
from vitrina.operators.sinks import export_split
from vitrina.operators.versions import read_table
from vitrina.plans.load import (ParquetTables, PlanRow, ReloadFailed, reload_tables, run_full_reload, split_predicates,
                                tabular_reload)
from vitrina.plans.export import read_sheets
from vitrina.session import scratch_path
from vitrina.sources import fixtures as fx


def hot(spark, n=30_000):
    """A third of all rows under one key, a tenth under another, some without one."""
    return spark.range(n).select("id", F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 10 = 1 THEN 'warm' "
                                              "WHEN id % 97 = 0 THEN NULL ELSE concat('k', id % 700) END").alias("k"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_join(spark, how):
    left = hot(spark, 6000)
    right = left.select("k").distinct().withColumn("v", F.length("k")).where("k <> 'k5'")
    right = right.union(right.where("k IN ('hot', 'k7')"))           # repeated on the right
    got = skew_join(left, right, ["k"], how)
    assert got.columns == left.join(right, ["k"], how).columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, left.join(right, ["k"], how).collect()), key=repr)
    with pytest.raises(ValueError):
        skew_join(left, right, ["k"], "right")


def test_heavy_keys_are_few_and_right(spark):
    df = hot(spark)
    exact = df.groupBy("k").agg(F.count("*").alias("n"))
    for found in (heavy_keys(df, ["k"], 0.05), heavy_keys(df, ["k"], 0.05, exact)):
        assert len(found) == 2 and max(found.values()) == pytest.approx(1 / 3, abs=0.01)
    assert heavy_keys(df.limit(0), ["k"], 0.05) == {}


def test_hot_blogger_spreads_without_broadcast(spark):
    n = 24_000
    posts = spark.range(n).select(F.expr("IF(id % 3 = 0, 'Ann Lee', concat('P', id % 900, ' Q'))").alias("author"), "id")
    roster = posts.select(F.expr("concat(split(author, ' ')[1], ' ', split(author, ' ')[0])").alias("blogger")).distinct()
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = name_key_join(person_keys(posts), roster, max_bytes=0)
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        plain = person_keys(posts).join(roster.select(F.split("blogger", " ")[1].alias("first_name"), F.split("blogger", " ")[0].alias("last_name")),
                                        ["first_name", "last_name"])
        worst = max(r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(sizes) == n and sizes[-1] <= 2 * sizes[len(sizes) // 2] < worst


@pytest.mark.parametrize("key", ["i", "d", "t", "p"])
def test_splits_follow_the_data(spark, key):
    df = spark.range(20_000).select(
        F.expr("IF(id % 2 = 0, id % 50, id * 1000)").alias("i"), F.expr("date_add(date'2020-01-01', cast(sqrt(id) as int))").alias("d"),
        F.expr("IF(id % 9 = 0, NULL, timestamp_micros(id * id))").alias("t"), F.expr("cast(id / 7 as decimal(12, 2))").alias("p"), "id")
    predicates = split_predicates(df.select(key), key, 8)
    counts = [df.where(p).count() for p in predicates]
    assert sum(counts) == 20_000 and len(predicates) == 8
    assert max(counts) <= 2 * 20_000 / 8 + (20_000 // 9 if key == "t" else 0)
    assert split_predicates(df.select(key).limit(0), key, 8) == ["1 = 1"]
    with pytest.raises(ValueError):
        split_predicates(spark.createDataFrame([("x",)], "s string"), "s", 2)


def test_one_broken_table_among_seven(spark):
    root = scratch_path(spark, "many")
    names = [f"t{k}" for k in range(7)]
    src = ParquetTables(spark, {("stage_db", "tpch"): f"{root}/a"})
    dst = ParquetTables(spark, {("stage_db", "stg_tpch"): f"{root}/b"})
    for k, name in enumerate(names):
        if k != 3:
            spark.range(k + 1).write.parquet(src.path("stage_db", "tpch", name))
    with pytest.raises(ReloadFailed) as failed:
        run_full_reload(spark, fx.reload_config(spark, names), "tpch", src, dst)
    assert "t3" in str(failed.value) and str(failed.value).startswith("1 of 7 tables failed")
    assert [o.row.table_name_source for o in failed.value.outcomes if o.error is not None] == ["t3"]
    for k, name in enumerate(names):
        if k != 3:
            assert dst.read("stage_db", "stg_tpch", name).count() == k + 1
    assert reload_tables(spark, [], src, dst) == []


def test_tables_are_copied_side_by_side(spark):
    """A slow table does not hold the others back."""
    import threading
    started, seen = threading.Barrier(3, timeout=60), []

    class Store:
        def read(self, db, schema, table):
            started.wait()                       # all three copies are under way at once
            return table

        def replace(self, source, db, schema, table, by="name"):
            seen.append(source)

    plan = [PlanRow("d", "s", f"t{k}", "d", "s", f"t{k}") for k in range(3)]
    assert [o.error for o in reload_tables(spark, plan, Store(), Store(), at_once=3)] == [None] * 3
    assert sorted(seen) == ["t0", "t1", "t2"]


def test_new_table_takes_types_from_its_cells(spark):
    root = scratch_path(spark, "typed")
    os.makedirs(root)
    with open(f"{root}/s.csv", "w") as f:
        f.write("name,n,price,day\nalpha,1,2.5,2024-01-02\nbeta,22,3,2024-02-03\n")
    got = tabular_reload(spark, f"{root}/s.csv", f"{root}/t")
    assert [t for _, t in got.dtypes] == ["string", "int", "double", "date"]
    assert read_table(spark, f"{root}/t").where("n = 22").first().price == 3.0


def test_small_sheets_stay_whole_and_large_ones_are_ordered(spark):
    df = spark.range(5000).select(F.expr("IF(id % 2 = 0, 'big', concat('s', id % 90))").alias("g"), F.expr("(id * 7919) % 5000").alias("v"))
    df = df.union(spark.createDataFrame([(None, 1)], "g string, v long"))
    out = scratch_path(spark, "sheets")
    export_split(df, out, ["g"], [F.col("v")], sheet_rows=400)
    files = {s: sorted(f for f in os.listdir(f"{out}/{s}") if f.endswith(".csv")) for s in os.listdir(out) if s.startswith("g=")}
    assert len(files) == 46 and "g=__HIVE_DEFAULT_PARTITION__" not in files
    assert all(len(f) == 1 for s, f in files.items() if s != "g=big") and len(files["g=big"]) > 1
    last = -1
    for name in files["g=big"]:                  # sorted inside, and from file to file
        values = [int(x) for x in open(f"{out}/g=big/{name}").read().split()[1:]]
        assert values == sorted(values) and values[0] > last
        last = values[-1]


def _shuffle_files(spark):
    dirs = spark._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}


def _wide_sheets(spark):
    """20,000 rows: one large sheet, small ones in twelve months, rows without a month or a name."""
    return spark.range(20_000).selectExpr(
        "concat('2024-', lpad(id % 12 + 1, 2, '0')) m", "IF(id % 12 = 3, 'big', concat('s', id % 35)) g", "(id * 7919) % 20011 v",
        "sha2(string(id), 256) t").union(spark.sql("SELECT NULL, 'g', 1L, 't' UNION ALL SELECT '2024-01', NULL, 2L, 't'"))


def test_sheets_in_batches_are_those_of_one_job(spark):
    """Every sheet comes whole out of one batch, large ones in order; another export to the folder leaves no sheet of
    the one before, whatever the session's way to overwrite; the mark of success is there at the end."""
    df = _wide_sheets(spark)
    schema = StructType.fromDDL("v bigint, t string, m string, g string")
    found = {}
    for name, rows in (("one", 10**6), ("batches", 3000)):
        out = scratch_path(spark, "sheets")
        spark.createDataFrame([("old", "old", 1, "t")], "m string, g string, v long, t string").write.partitionBy("m", "g").csv(out)
        mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic" if name == "batches" else "static")
        try:
            export_split(df, out, ["m", "g"], [F.col("v")], sheet_rows=700, batch_rows=rows)
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        assert os.path.exists(f"{out}/_SUCCESS")
        sheets = {d: sorted(f for f in names if f.endswith(".csv")) for d, _, names in os.walk(out) if "/g=" in d}
        texts = {d[len(out):]: [open(f"{d}/{f}").read().split("\n")[1:-1] for f in files] for d, files in sheets.items()}
        assert all(len(t) == 1 for d, t in texts.items() if not d.endswith("g=big"))
        assert len(next(t for d, t in texts.items() if d.endswith("g=big"))) > 1
        found[name] = {d: [line for part in t for line in part] for d, t in texts.items()}
        assert sorted(tuple(r) for r in read_sheets(spark, out, schema).collect()) == sorted(
            (r.v, r.t, r.m, r.g) for r in df.where("m IS NOT NULL AND g IS NOT NULL").collect())
    assert found["one"] == found["batches"] and len(found["one"]) == 12 * 35 - 35 + 1


def test_an_unfinished_export_has_no_mark_of_success(spark):
    """A failure in a later batch or among the large sheets leaves a folder without ``_SUCCESS``."""
    df = _wide_sheets(spark)
    stop = F.expr("IF(g = 'big', raise_error('stop'), v)").cast("bigint")
    for rows in (10**6, 3000):
        out = scratch_path(spark, "sheets")
        with pytest.raises(Exception, match="stop"):
            export_split(df.withColumn("v", stop), out, ["m", "g"], [F.col("t")], sheet_rows=700, batch_rows=rows)
        assert not os.path.exists(f"{out}/_SUCCESS")


def test_shuffle_files_of_one_batch_go_while_the_next_is_written(spark):
    """The rows an export deals are not all on disk a second time: of many batches the last one or two are left."""
    df, out, seen = _wide_sheets(spark), scratch_path(spark, "sheets"), []
    before, done = _shuffle_files(spark), threading.Event()
    dealt = lambda: {f.split("_")[1] for f in _shuffle_files(spark) - before}

    def watch():
        while not done.wait(0.02):
            seen.append(dealt())

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        export_split(df, out, ["m", "g"], [F.col("v")], batch_rows=1500)
    finally:
        done.set()
        watcher.join()
    for _ in range(200):                         # files go soon after their plans
        if len(dealt()) <= 2:
            break
        time.sleep(0.1)
    assert len(set().union(*seen)) >= 8 and len(dealt()) <= 2


def test_compressed_sheets_hold_the_same_text(spark):
    df = _wide_sheets(spark)
    plain, packed = scratch_path(spark, "plain"), scratch_path(spark, "packed")
    export_split(df, plain, ["m", "g"], [F.col("v")])
    export_split(df, packed, ["m", "g"], [F.col("v")], compression="gzip")
    texts = [{d[len(top):]: [opened(f"{d}/{f}", "rt").read() for f in names if f.endswith(end)] for d, _, names in os.walk(top) if "/g=" in d}
             for top, opened, end in ((plain, open, ".csv"), (packed, gzip.open, ".csv.gz"))]
    assert texts[0] == texts[1] and all(len(t) == 1 for t in texts[0].values())
    schema = StructType.fromDDL("v bigint, t string, m string, g string")
    assert sorted(read_sheets(spark, plain, schema).collect()) == sorted(read_sheets(spark, packed, schema).collect())


def test_a_batch_reads_only_its_own_folders(spark):
    """Where the first split column is the mart's folder column, the batches prune its folders."""
    from vitrina.operators.sinks import read_slices, replace_slices
    path = scratch_path(spark, "mart")
    replace_slices(spark, {path: _wide_sheets(spark).where("m IS NOT NULL")}, "m")
    mart = read_slices(spark, path, "m")
    parts = [mart.where(F.pmod(F.xxhash64(F.col("m")), F.lit(4)) == k) for k in range(4)]
    read = [p._jdf.queryExecution().executedPlan().collectLeaves().head().selectedPartitions().totalNumberOfFiles() for p in parts]
    assert sum(read) == len(mart.inputFiles()) and max(read) < sum(read)


def test_checkpoint_folder_without_the_setting(tmp_path):
    """A local session that names no checkpoint folder gets one; off local mode that is an error."""
    code = textwrap.dedent("""
        import sys
        sys.path.insert(0, sys.argv[1])
        from vitrina.session import build_session, ensure_checkpoint_dir, materialize
        spark = build_session("local[1]", 1)
        assert spark.conf.get("spark.checkpoint.dir", None) is None
        first = ensure_checkpoint_dir(spark)
        assert first == ensure_checkpoint_dir(spark) and materialize(spark.range(3)).count() == 3
        print("fine")
    """)
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path)}
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code, root], env=env, capture_output=True, text=True, timeout=200)
    assert "fine" in done.stdout, done.stderr[-2000:]


def test_cluster_session_must_name_its_folder(monkeypatch):
    from types import SimpleNamespace

    from vitrina.session import ensure_checkpoint_dir
    context = SimpleNamespace(master="spark://host:7077", applicationId="none", getCheckpointDir=lambda: None)
    bare = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d: d))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(bare)


def _plan(df):
    df.count()
    return df._jdf.queryExecution().executedPlan().toString()


def test_detail_broadcasts_accounts_by_their_written_size(spark):
    """The accounts are written before the posts join them: the posts are not shuffled for that join."""
    from vitrina.plans.payment import payment_detail
    posts = spark.range(300).selectExpr(
        "concat('Ann B', id % 3) author", "date'2024-01-01' release_date", "'5' tiktok_reach", "concat('http://v/', id % 50) tiktok_video_link",
        "'1' youtube_reach", "'2' instagram_reach", "'' likee_video_link", "'3' likee_reach", "concat('acc', id % 4) account_name",
        "concat('2024-0', id % 5 + 1) sheets_name")
    roster = spark.range(3).selectExpr("concat('B', id, ' Ann X') blogger", "'r' region", "'RUB' currency", "'A' grade", "'TRUE' is_state", "'c' contract")
    got = payment_detail(posts, roster, fx.kpi(spark), fx.price(spark))
    assert "account-prices" in " ".join(got.inputFiles())
    accounts = {(k % 3, k % 5, k % 4) for k in range(300)}
    links = {(k % 3, k % 5, k % 50) for k in range(300)}
    assert got.count() == 2 * sum((b, m) == (c, n) for b, m, _ in links for c, n, _ in accounts)  # 5 links have two prices


def test_derived_roster_is_measured_once_written(spark):
    """A roster that the planner overrates (bytes before a distinct) is still broadcast: the posts are not shuffled."""
    from vitrina.operators.joins import name_key_join, person_keys
    roster = spark.range(400_000).selectExpr("concat('B', id % 5, ' Ann X') blogger", "repeat('r', 3) region").distinct()
    posts = person_keys(spark.range(100).selectExpr("concat('Ann B', id % 7) author", "id"))
    got = name_key_join(posts, roster, max_bytes=100_000)
    assert got.count() == sum(k % 7 < 5 for k in range(100))
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in text


def test_block_lookup_knows_its_matches(spark):
    """The lookup by blocks joins posts to written matches, without an exchange of the posts where they are few."""
    from vitrina.operators.brackets import interval_lookup
    intervals = spark.createDataFrame([("A", "RUB", 0, 9, 1, 5), ("A", "RUB", 10, 99, 2, 7)], "grade string, currency string, lo bigint, hi bigint, n int, v int")
    rows = spark.range(200).selectExpr("'A' grade", "'RUB' currency", "cast(id as int) m")
    got = interval_lookup(rows, intervals, "m", {"v": "s"}, "k", broadcast=False)
    assert {(r.m, r.k, r.s) for r in got.collect()} == {(m, 1, 5) if m < 10 else (m, 2, 7) if m < 100 else (m, 0, 0) for m in range(200)}
    assert "BroadcastHashJoin" in _plan(got)
    assert "matches" in got.inputFiles()[0]


def test_month_load_sorts_posts_not_pairs(spark, tmp_path):
    """The detail's posts are dealt and sorted by month before the accounts join them, and the table is written in that
    order: no exchange and no sort stands above that join."""
    from vitrina.operators.versions import Load
    from vitrina.plans.payment import PaymentPlan
    from vitrina.sources import fixtures as fx
    posts = spark.range(300).selectExpr(
        "concat('Ann B', id % 3) author", "date'2024-01-01' release_date", "'5' tiktok_reach", "concat('http://v/', id % 50) tiktok_video_link",
        "'1' youtube_reach", "'2' instagram_reach", "'' likee_video_link", "'3' likee_reach", "concat('acc', id % 4) account_name",
        "nullif(concat('2024-0', id % 5 + 1), '2024-05') sheets_name")
    roster = spark.range(3).selectExpr("concat('B', id, ' Ann X') blogger", "'r' region", "'RUB' currency", "'A' grade", "'TRUE' is_state", "'c' contract")
    plan = PaymentPlan(posts, roster, fx.kpi(spark), fx.price(spark))
    plain = PaymentPlan(posts, roster, fx.kpi(spark), fx.price(spark), share=False)
    dealt = plan.detail(by_month=True)
    assert plan.dealt and sorted(dealt.collect(), key=str) == sorted(plain.detail().collect(), key=str) and not plain.dealt
    text = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Join Inner") < text.index("Sort [sheets_name") < text.index("RebalancePartitions")
    folders = Load(spark, [str(tmp_path)]).write(str(tmp_path), dealt, "sheets_name", dealt=True)
    assert sorted(label for label, _ in folders) == ["2024-01", "2024-02", "2024-03", "2024-04"]


def test_named_months_are_taken_out_of_the_staging_table_once(spark, tmp_path, monkeypatch):
    """A load of named months reads the staging table once, for the gate and both marts; a table that is written
    already is not written again."""
    from vitrina.operators.sinks import read_slices
    from vitrina.plans import load, payment
    from vitrina.sources import fixtures as fx
    posts = spark.range(300).selectExpr(
        "concat('Ann B', id % 3) author", "date'2024-01-01' release_date", "'5' tiktok_reach", "concat('http://v/', id % 50) tiktok_video_link",
        "'1' youtube_reach", "'2' instagram_reach", "'' likee_video_link", "'3' likee_reach", "concat('acc', id % 4) account_name",
        "concat('2024-0', id % 4 + 1) sheets_name")
    roster = spark.range(3).selectExpr("concat('B', id, ' Ann X') blogger", "'r' region", "'RUB' currency", "'A' grade", "'TRUE' is_state", "'c' contract")
    seen = []

    class Plan(payment.PaymentPlan):
        def __init__(self, posts, *more):
            seen.append(posts.inputFiles())
            super().__init__(posts, *more)

    monkeypatch.setattr(load.payment, "PaymentPlan", Plan)
    staged = str(tmp_path / "staged")
    posts.write.parquet(staged)
    found = []
    for name, src, written in (("derived", posts, False), ("table", spark.read.parquet(staged), True)):
        short, full = str(tmp_path / name / "short"), str(tmp_path / name / "full")
        load.load_payment_months(spark, src, roster, fx.kpi(spark), fx.price(spark), short, full, ["2024-02", "2024-03"], written=written)
        found.append([sorted(read_slices(spark, p, load.MONTH_COL).collect(), key=str) for p in (short, full)])
    assert seen[0] and all("month-posts" in f for f in seen[0])
    assert seen[1] and not any("month-posts" in f for f in seen[1])
    assert found[0] == found[1] and {r[load.MONTH_COL] for r in found[0][1]} == {"2024-02", "2024-03"}
    with pytest.raises(ValueError, match="2023-01"):
        load.load_payment_months(spark, posts, roster, fx.kpi(spark), fx.price(spark), short, full, ["2024-02", "2023-01"])


def test_names_of_pairs_are_made_once_an_account(spark):
    """The detail's blogger names come with the accounts: no name is put together above the join that makes the pairs."""
    from vitrina.plans.payment import PaymentPlan
    from vitrina.sources import fixtures as fx
    posts = spark.sql("SELECT 'Ann B' author, date'2024-01-01' release_date, '5' tiktok_reach, 'http://v/1' tiktok_video_link, '1' youtube_reach, "
                      "'2' instagram_reach, '' likee_video_link, '3' likee_reach, 'acc' account_name, '2024-01' sheets_name")
    roster = spark.sql("SELECT 'B Ann X' blogger, 'r' region, 'RUB' currency, 'A' grade, 'TRUE' is_state, 'c' contract")
    detail = PaymentPlan(posts, roster, fx.kpi(spark), fx.price(spark)).detail()
    assert [r.blogger_name for r in detail.collect()] == ["Ann  B"]
    text = detail._jdf.queryExecution().optimizedPlan().toString()
    assert "concat(" not in text[:text.index("Join Inner")]


def test_missing_names_meet_nothing_and_are_parsed_once(spark):
    """Names that are missing on both sides do not meet, and no filter on names is pushed below the inputs."""
    posts = person_keys(spark.createDataFrame([("Ann B", 1), ("Ann", 2), (None, 3), ("- B", 4), ("", 5)], "author string, id int"))
    roster = spark.createDataFrame([("B Ann X", "r"), ("B", "s"), (None, "t"), ("", "u")], "blogger string, region string")
    got = name_key_join(posts, roster)
    assert got.columns == ["first_name", "last_name", "author", "id", "region"]
    assert [tuple(r) for r in got.collect()] == [("Ann", "B", "Ann B", 1, "r")]
    text = name_key_join(person_keys(spark.range(9).selectExpr("concat('Ann B', id) author")),
                         spark.range(9).selectExpr("concat('B', id, ' Ann X') blogger"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in text
