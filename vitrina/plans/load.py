"""Data-movement jobs: config-driven full reload (M6), tabular-file reload
(M7) and the idempotent monthly load of both payment marts (M8)."""

from __future__ import annotations

import threading
from dataclasses import dataclass
from typing import Protocol

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, StructType

from vitrina.operators.broadcast import CONTROL_MAX_ROWS
from vitrina.operators.sinks import (CSV_READ, align_by_name, align_by_position, full_reload,
                                     path_exists, replace_slices)
from vitrina.operators.versions import read_table
from vitrina.plans import payment
from vitrina.session import materialize

# Mart column names fixed by the mart DDL (the export reads them by name).
MONTH_COL = "месяц отчёта"
RELEASE_COL = "дата выхода ролика"
BLOGGER_COL = "имя блогера"
MART_NAMES = {"sheets_name": MONTH_COL, "release_date": RELEASE_COL, "blogger_name": BLOGGER_COL}

PLAN_COLUMNS = ["db_source_name", "schema_name_source", "table_name_source",
                "db_target_name", "schema_name_target", "table_name_target"]


@dataclass(frozen=True)
class PlanRow:
    db_source_name: str
    schema_name_source: str
    table_name_source: str
    db_target_name: str
    schema_name_target: str
    table_name_target: str


def reload_plan_frame(config: DataFrame, schema_source: str) -> DataFrame:
    """Control rows to copy: ``reload = 1 AND schema_name_source = :schema``."""
    return (config.where((F.col("reload") == 1) & (F.col("schema_name_source") == F.lit(schema_source)))
                  .select(*PLAN_COLUMNS))


def reload_plan(config: DataFrame, schema_source: str) -> list[PlanRow]:
    """The plan as a list (control data only: one row per table, bounded)."""
    rows = reload_plan_frame(config, schema_source).limit(CONTROL_MAX_ROWS + 1).collect()
    if len(rows) > CONTROL_MAX_ROWS:
        raise ValueError("reload plan larger than the control-table bound")
    return [PlanRow(*r) for r in rows]


class TableStore(Protocol):
    """Where tables are read from and reloaded into."""

    def read(self, db: str, schema: str, table: str) -> DataFrame: ...

    def schema(self, db: str, schema: str, table: str) -> StructType | None:
        """Columns of an existing table; None if there is none."""

    def replace(self, source: DataFrame, db: str, schema: str, table: str, by: str = "name") -> None:
        """TRUNCATE and INSERT; a failure while computing ``source`` leaves the table as it was."""


class ParquetTables:
    """Locates tables as parquet folders: ``roots[(db, schema)]/<table>[suffix]``."""

    def __init__(self, spark: SparkSession, roots: dict[tuple[str, str], str], suffix: str = ""):
        self.spark, self.roots, self.suffix = spark, roots, suffix

    def path(self, db: str, schema: str, table: str) -> str:
        return f"{self.roots[(db, schema)].rstrip('/')}/{table}{self.suffix}"

    def read(self, db: str, schema: str, table: str) -> DataFrame:
        return read_table(self.spark, self.path(db, schema, table))

    def schema(self, db: str, schema: str, table: str) -> StructType | None:
        path = self.path(db, schema, table)
        return read_table(self.spark, path).schema if path_exists(self.spark, path) else None

    def replace(self, source: DataFrame, db: str, schema: str, table: str, by: str = "name") -> None:
        full_reload(self.spark, source, self.path(db, schema, table), by=by)


def split_predicates(keys: DataFrame, key: str, scans: int) -> list[str]:
    """Range predicates on ``key`` that part a table into at most ``scans`` scans of about the same
    number of rows, whatever the key's distribution: the bounds are quantiles of its values
    (equi-depth, not equal width).  Each row satisfies one predicate; NULL keys go with the first.  A value
    with more rows than a scan's share cannot be parted by its key."""
    column = F.col(f"`{key}`")
    kind = keys.schema[key].dataType
    number = column if isinstance(kind, NumericType) else F.unix_micros(column.cast("timestamp"))
    if isinstance(kind, StringType):
        raise ValueError(f"{key}: splits need a number, date or timestamp")
    rows = keys.select(number.alias("k"), column.alias("v")).where("k IS NOT NULL")
    cuts = rows.agg(F.percentile_approx("k", [i / scans for i in range(1, scans)], 20 * scans).alias("c")).first()["c"] if scans > 1 else None
    bounds = sorted(set(cuts or ()))
    if not isinstance(kind, NumericType):
        text = keys.sparkSession.createDataFrame([(b,) for b in bounds], "b bigint").select(
            F.timestamp_micros("b").cast(kind).cast("string").alias("t")) if bounds else None
        bounds = [f"'{r.t}'" for r in sorted(text.collect())] if bounds else []
    name = f'"{key}"' if not key.isidentifier() else key
    if not bounds:
        return ["1 = 1"]
    inner = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(bounds, bounds[1:])]
    return [f"{name} < {bounds[0]} OR {name} IS NULL", *inner, f"{name} >= {bounds[-1]}"]


class JdbcTables:
    """Locates tables in databases reached over JDBC (one URL per database).

    ``partitioning`` names, for every table that is read, the column, its bounds and the
    number of range scans; or ``keys`` a key column and the number of scans, whose bounds are then
    taken from the key's own values (one scan of that column, see ``split_predicates``).  So no
    single task pulls a whole table."""

    def __init__(self, spark: SparkSession, urls: dict[str, str], properties: dict | None = None,
                 partitioning: dict[str, tuple[str, int, int, int]] | None = None,
                 keys: dict[str, tuple[str, int]] | None = None):
        self.spark, self.urls = spark, urls
        self.properties = properties or {}
        self.partitioning, self.keys = partitioning or {}, keys or {}

    def read(self, db: str, schema: str, table: str) -> DataFrame:
        name = f"{schema}.{table}"
        if name in self.keys:
            key, scans = self.keys[name]
            values = self.spark.read.jdbc(self.urls[db], f"(SELECT {key} FROM {name}) t", properties=self.properties)
            return self.spark.read.jdbc(self.urls[db], name, predicates=split_predicates(values, key, scans),
                                        properties=self.properties)
        if name not in self.partitioning:
            raise ValueError(f"{name}: name its key, or its partition column, bounds and number of scans")
        col, lo, hi, n = self.partitioning[name]
        return self.spark.read.jdbc(self.urls[db], name, column=col, lowerBound=lo,
                                    upperBound=hi, numPartitions=n, properties=self.properties)

    def schema(self, db: str, schema: str, table: str) -> StructType | None:
        none = f"(SELECT * FROM {schema}.{table} WHERE 1 = 0) t"
        return self.spark.read.jdbc(self.urls[db], none, properties=self.properties).schema

    def replace(self, source: DataFrame, db: str, schema: str, table: str, by: str = "name") -> None:
        target = self.schema(db, schema, table)
        out = align_by_name(source, target) if by == "name" else align_by_position(source, target)
        (materialize(out, "jdbc").write.mode("overwrite").option("truncate", True)
         .jdbc(self.urls[db], f"{schema}.{table}", properties=self.properties))


@dataclass(frozen=True)
class CopyOutcome:
    """What became of one plan row; ``error`` is None where the table was replaced."""

    row: PlanRow
    error: Exception | None = None


class ReloadFailed(RuntimeError):
    """Some tables of a reload failed (the others were replaced); ``outcomes`` has all of them."""

    def __init__(self, outcomes: list[CopyOutcome]):
        self.outcomes = outcomes
        failed = [o for o in outcomes if o.error is not None]
        super().__init__(f"{len(failed)} of {len(outcomes)} tables failed: " + "; ".join(
            f"{o.row.schema_name_source}.{o.row.table_name_source}: {type(o.error).__name__}: {str(o.error).splitlines()[0]}"
            for o in failed))


RELOAD_POOL = "reload"


def reload_tables(spark: SparkSession, plan: list[PlanRow], sources: TableStore, targets: TableStore,
                  by: str = "name", at_once: int = 4) -> list[CopyOutcome]:
    """Replace each plan row's target with its source, up to ``at_once`` tables at a time, each
    independent of the others: one outcome for every row, in the plan's order.

    The copies are jobs of one session, submitted from threads that inherit its properties; with
    ``spark.scheduler.mode=FAIR`` every table has a pool of its own, so a small table does not wait
    behind a large one's tasks."""
    outcomes: list[CopyOutcome | None] = [None] * len(plan)
    places = iter(range(len(plan)))
    turn = threading.Lock()

    def work() -> None:
        while True:
            with turn:
                k = next(places, None)
            if k is None:
                return
            r = plan[k]
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{RELOAD_POOL}-{k}")
            try:
                src = sources.read(r.db_source_name, r.schema_name_source, r.table_name_source)
                targets.replace(src, r.db_target_name, r.schema_name_target, r.table_name_target, by=by)
                outcomes[k] = CopyOutcome(r)
            except Exception as e:  # the other tables go on; all errors are raised together
                outcomes[k] = CopyOutcome(r, e)

    threads = [InheritableThread(target=work) for _ in range(min(at_once, len(plan)))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return outcomes


def run_full_reload(spark: SparkSession, config: DataFrame, schema_source: str,
                    sources: TableStore, targets: TableStore, by: str = "name", at_once: int = 4) -> list[PlanRow]:
    """M6: for each plan row, replace the target table with the source table
    (matched by name).  Each copy is a distributed read and write; a table that fails does not
    stop the others, and its error is raised when all are done."""
    plan = reload_plan(config, schema_source)
    outcomes = reload_tables(spark, plan, sources, targets, by, at_once)
    if any(o.error is not None for o in outcomes):
        raise ReloadFailed(outcomes)
    return plan


def read_tabular(spark: SparkSession, path: str, typed: bool = False) -> DataFrame:
    """A sheet saved as a CSV file (or folder): first row is the header; all
    cells are text until the target's schema parses them, or (``typed``) have the types that all
    cells of their column allow.  Cells may be quoted and may hold line breaks; a sheet file is then
    read as one piece."""
    return spark.read.options(**CSV_READ).option("inferSchema", typed).csv(path)


def tabular_reload(spark: SparkSession, path: str, target_path: str,
                   schema: StructType | None = None) -> DataFrame:
    """M7: TRUNCATE the target and load the sheet, columns by header name,
    text parsed into the target types (bad cells fail the load).  A target that does not exist yet
    takes its types from the cells."""
    typed = schema is None and not path_exists(spark, target_path)
    return full_reload(spark, read_tabular(spark, path, typed), target_path, by="name",
                       schema=schema, parse_text=True)


def to_mart(df: DataFrame) -> DataFrame:
    """Query output names -> mart column names."""
    return df.select(*[F.col(c).alias(MART_NAMES.get(c, c)) for c in df.columns])


def months_present(posts: DataFrame, months: list[str]) -> DataFrame:
    """P13: each asked month and its staging rows (0: the gate refuses it)."""
    spark = posts.sparkSession
    asked = spark.createDataFrame([(m,) for m in months], "sheets_name string")
    have = posts.where(F.col("sheets_name").isin(months)).groupBy("sheets_name").agg(F.count(F.lit(1)).alias("n"))
    return asked.join(have, "sheets_name", "left").select(
        "sheets_name", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_rows"), F.col("n").isNotNull().alias("passes"))


def run_mart_sql(spark: SparkSession, text: str, month: str, frames: dict[str, DataFrame]) -> DataFrame:
    """K8: one mart text over named frames (``{name}`` in the text) with ``:month`` bound, never
    spliced.  A text without the parameter is refused: it would run over every month."""
    if ":month" not in text:
        raise ValueError("the text has no :month parameter")
    return spark.sql(text, args={"month": month}, **frames)


def load_payment_months(spark: SparkSession, posts: DataFrame, roster: DataFrame,
                        kpi: DataFrame, price: DataFrame, short_path: str, full_path: str,
                        months: list[str] | None = None, written: bool = False) -> None:
    """M8: gate, then replace the month slices of both payment marts together.

    ``months=None`` loads every month of the staging table in one job (a
    backfill), and months the marts hold without a result now are cleared;
    otherwise each named month must have staging rows.  The named months' posts are taken out
    of the staging table once, for the gate and both marts; ``written`` tells that ``posts`` are such a table already.
    """
    if months is not None:
        if not months:
            raise ValueError("no month given")
        posts = posts.where(F.col("sheets_name").isin(months))
        if not written:
            posts = materialize(posts, "month-posts")
        missing = [r.sheets_name for r in months_present(posts, months).where("NOT passes").collect()]
        if missing:
            raise ValueError(f"no staging rows for month(s) {missing}")
    plan = payment.PaymentPlan(posts, roster, kpi, price)
    marts = {short_path: to_mart(plan.summary()), full_path: to_mart(plan.detail(by_month=True))}
    replace_slices(spark, marts, MONTH_COL, months, dealt=[full_path] if plan.dealt else [])
