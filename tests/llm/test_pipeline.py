"""The pipeline's stages against what each operator says of its input."""

import corpus_pipeline
import __spark_entry__ as entry
from tests.conftest import SF_SMOKE
from tools.oracle_check import digest, duck
from vitrina.llm.decontam import ItemMatcher, normalise
from vitrina.llm.line_rules import judge
from vitrina.llm.oracle import ORACLE
from vitrina.llm.queries import QUERIES
from tests.llm.test_pairs import classes


def test_registered():
    have = entry.queries()
    assert set(QUERIES) | {"pipeline"} <= set(have)
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


def test_quality_rules_match_sql(spark):
    df = QUERIES["op4_quality_rules"](spark, SF_SMOKE)
    cur = duck(SF_SMOKE).execute(ORACLE["op4_quality_rules"])
    cols = [c[0] for c in cur.description]
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(cols, cur.fetchall())[0]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    columns = docs.columns
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frames[-1], SF_SMOKE)
        assert out.columns == columns, name
        frames.append(spark.createDataFrame(out.collect(), docs.schema))
    before, rules, scored, near, clean = ({r.doc_id: r.text for r in f.collect()} for f in frames)
    assert rules == {k: judge(t)[0] for k, t in before.items() if judge(t)[9]}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMOKE}/labels.parquet").collect()}
    gone = [k for k in rules if k not in scored]
    assert all(rules[k] == t for k, t in scored.items()) and not [k for k in gone if labels.get(k) == 1]
    comp = classes(list(scored.items()), 5)
    assert near == {k: t for k, t in scored.items() if comp[k] == k}
    items = [(r.item_id, normalise(r.text)) for r in spark.read.parquet(f"{SF_SMOKE}/benchmark.parquet").collect()]
    matcher = ItemMatcher(items, 0.08)
    assert clean == {k: t for k, t in near.items() if not matcher.search(normalise(t))} and len(clean) < len(near)
    packed = corpus_pipeline.STAGES[-1][1](spark, frames[-1], SF_SMOKE).collect()
    assert {r.doc_id for r in packed} == set(clean)


def test_rules_keep_columns_that_are_named_like_counts(spark):
    text = "\n".join(" ".join(f"word{k}x{i}" for i in range(9)) + "." for k in range(9))
    rows = [(1, text, "mine", 5.5, "t"), (2, "short", "mine", 1.5, "u"), (None, text + "\nclick here", "other", 2.5, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_words string, kept double, clean_text string")
    out = corpus_pipeline.quality_rules(spark, docs, SF_SMOKE)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([rows[0], (None, text, "other", 2.5, None)], key=str)
