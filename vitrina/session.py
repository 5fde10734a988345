"""Session helpers.

Library code never reconfigures a session it was handed; it only reads
settings.  ``build_session`` is for tests, tools and the bench.
"""

from __future__ import annotations

import gc
import os
import uuid

from pyspark.sql import SparkSession

# Settings a mart job wants from any session (cluster or local).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "vitrina", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_OWN_DIRS: dict[str, str] = {}  # by application: folders of sessions without a checkpoint setting


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    A cluster sets ``spark.checkpoint.dir`` (or the context's checkpoint folder); only where both are
    unset, in local mode (tests, a laptop), do we pick a folder of our own.  The setting cannot be
    changed in a running session, so our own folder is remembered by application.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir() or _OWN_DIRS.get(sc.applicationId)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder every executor "
                               "shares (a machine-local folder would lose staged tables)")
        d = _OWN_DIRS[sc.applicationId] = os.path.join("/tmp", f"vitrina-ckpt-{uuid.uuid4().hex[:8]}")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder (never machine-local)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, "vitrina", *parts, uuid.uuid4().hex])


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on whatever file system it is on."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of ours once a job no longer needs it."""
    if "/vitrina/" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    drop_folder(spark, path)


def release_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of ended jobs deleted.

    Spark's cleaner deletes them once the driver has collected the plans that refer to them.  A driver with
    memory to spare puts that off (for up to half an hour), so a run of several large jobs holds the
    shuffle files of all of them on disk."""
    gc.collect()  # plans are also held by Python's proxies
    spark._jvm.System.gc()


def materialize(df, name: str = "stage"):
    """Write ``df`` once as a parquet table in the shared checkpoint folder and
    read it back: lineage cut, computed once, survives lost executors.

    For an intermediate result read by several branches of one plan: Catalyst
    prunes each branch differently, so the branches would not share an
    exchange and the input would be recomputed (re-scanned) once per branch.
    Parquet keeps the re-reads columnar and pruned.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
