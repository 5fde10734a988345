import os
import sys
import tempfile

import pytest

# A test's own recursive judge takes several frames for each of 3,000 rows.
sys.setrecursionlimit(max(100_000, sys.getrecursionlimit()))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plain_cache(_):
    """``lru_cache`` in Python: the one in C stops at a depth of its own, which no setting raises."""
    def cached(f):
        known = {}

        def call(*key):
            if key not in known:
                known[key] = f(*key)
            return known[key]
        return call
    return cached


@pytest.fixture(autouse=True)
def deep_cache(request, monkeypatch):
    if hasattr(request.module, "lru_cache"):
        monkeypatch.setattr(request.module, "lru_cache", plain_cache)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from vitrina.session import RECOMMENDED_CONF, ensure_checkpoint_dir
    b = (SparkSession.builder.master("local[*]").appName("vitrina-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="vitrina-tests-"))
    ensure_checkpoint_dir(s)
    yield s


SF_SMOKE = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
