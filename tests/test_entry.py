"""Driver contract: entry smoke run and every registered query against its
DuckDB oracle on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMOKE
from tools.oracle_check import digest, duck
from vitrina.plans.registry import QUERIES


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["blogger_name", "account_name", "grade", "currency", "video_count",
                          "price_count_videos", "instagram_count", "youtube_count",
                          "tiktok_premium", "likee_premium", "instagram_premium",
                          "youtube_premium", "sheets_name", "sum_count"]


def test_every_query_has_an_oracle():
    own = {k for k in entry.queries() if k in QUERIES}
    assert own == set(QUERIES) and own <= set(entry.oracle_sql())


# Spark type name -> DuckDB type name, for the schema half of the contract
TYPE_NAMES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
              "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMOKE)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF_SMOKE)
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[key])
    d_cols = [c[0] for c in cur.description]
    d_types = {c[0]: str(c[1]) for c in cur.description}
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert {n: TYPE_NAMES.get(t, t.upper()) for n, t in df.dtypes} == d_types
    assert len(s_rows) == len(d_rows)
    assert digest(df.columns, s_rows)[0] == digest(d_cols, d_rows)[0]
