"""Operators on literal frames: edge cases, plus randomized checks of the
rewritten forms against the literal (brute-force) forms."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitrina.operators.aggs import capped_count, column_widths, count_if
from vitrina.operators.brackets import elementary_intervals, interval_lookup
from vitrina.operators.broadcast import checked_broadcast
from vitrina.operators.joins import bracket_join, not_in
from vitrina.operators.ordered import carry_last, next_marker, section_carry

HYP = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

BR_SCHEMA = "grade string, currency string, lo int, hi int, v int"


def test_bracket_join_edges(spark):
    br = spark.createDataFrame([("A", "RUB", 0, 10, 1), ("A", "RUB", 10, 20, 2),
                                ("A", "RUB", 30, 40, 3)], BR_SCHEMA)
    rows = spark.createDataFrame([(1, "A", "RUB", 0), (2, "A", "RUB", 10), (3, "A", "RUB", 25),
                                  (4, "A", "RUB", 40), (5, None, "RUB", 5), (6, "A", "RUB", None)],
                                 "id int, grade string, currency string, m int")
    got = bracket_join(rows, br, "m", "lo", "hi", {"v": "p"}).orderBy("id", "p").collect()
    assert [(r.id, r.p) for r in got] == [
        (1, 1),            # lower end included
        (2, 1), (2, 2),    # on two overlapping brackets: the row repeats
        (3, 0),            # in a gap: default
        (4, 3),            # upper end included
        (5, 0),            # NULL grade never matches
        (6, 0),            # NULL measure never matches
    ]
    nul = bracket_join(rows.where("id = 3"), br, "m", "lo", "hi", {"v": "p"}, coalesce=False)
    assert nul.first().p is None


def test_not_in_null_semantics(spark):
    df = spark.createDataFrame([(1, "m"), (2, "m"), (None, "m"), (3, "n"), (None, "n")],
                               "id int, g string")
    sub_plain = spark.createDataFrame([(1, "m")], "id int, g string")
    got = not_in(df, sub_plain, "id", by=["g"]).collect()
    # group m: 1 removed, NULL removed (sub non-empty); group n: empty sub keeps all, NULL too
    assert sorted((r.g, r.id if r.id is not None else -1) for r in got) == \
        [("m", 2), ("n", -1), ("n", 3)]
    sub_null = spark.createDataFrame([(1, "m"), (None, "m")], "id int, g string")
    got = not_in(df, sub_null, "id", by=["g"]).collect()
    assert sorted(r.g for r in got) == ["n", "n"]          # a NULL in the list empties group m
    empty = spark.createDataFrame([], "id int, g string")
    assert not_in(df, empty, "id").count() == 5             # empty list keeps everything
    assert not_in(df, sub_null, "id").count() == 0          # global form, NULL in list


def test_not_in_matches_sql(spark):
    df = spark.createDataFrame([(i if i % 5 else None, "m") for i in range(20)], "id int, g string")
    for sub_rows in ([(3, "m"), (4, "m")], [(3, "m"), (None, "m")], []):
        sub = spark.createDataFrame(sub_rows, "id int, g string")
        df.createOrReplaceTempView("t_df")
        sub.createOrReplaceTempView("t_sub")
        want = spark.sql("SELECT * FROM t_df WHERE id NOT IN (SELECT id FROM t_sub)").count()
        assert not_in(df, sub, "id").count() == want


def test_checked_broadcast(spark):
    small = spark.range(10)
    _, hinted = checked_broadcast(small, 80)
    assert hinted
    _, hinted = checked_broadcast(small, 9)
    assert not hinted


def test_capped_count(spark):
    def counts(n_http, n_special):
        rows = [("http://x",)] * n_http + [("ДУБАЙ",)] * n_special
        df = spark.createDataFrame(rows, "link string")
        real = count_if(F.col("link").startswith("http"))
        special = count_if(F.lower("link") == "дубай")
        return df.agg(capped_count(real, special, 60)).first()[0]
    assert counts(60, 0) == 60
    assert counts(60, 3) == 60        # at the cap: special not added
    assert counts(61, 3) == 63        # above: cap + special
    assert counts(61, 0) == 60


def test_column_widths(spark):
    df = spark.createDataFrame([("g", "abcdef", 7), ("g", None, 12345), ("h", None, None)],
                               "grp string, name string, n int")
    got = {(r.grp, r.column_name): r.width for r in column_widths(df, ["grp"]).collect()}
    assert got == {("g", "name"): 8, ("g", "n"): 7, ("h", "name"): 6, ("h", "n"): 3}


# ---- ordered rows -------------------------------------------------------------------------

def _literal_carry(pdf: pd.DataFrame) -> pd.DataFrame:
    """Row by row in id order: the last header seen so far in the group."""
    last, out = {}, []
    for r in pdf.sort_values("id").itertuples():
        if r.hdr:
            last[r.g] = r.v
        out.append((r.g, r.id, last.get(r.g)))
    return pd.DataFrame(out, columns=["g", "id", "carried"])


def _check_carry(spark, ids, hdr_flags, groups, bits):
    pdf = pd.DataFrame({"g": groups, "id": ids, "hdr": hdr_flags,
                        "v": [f"h{i}" for i in ids]})
    df = spark.createDataFrame(pdf, "g string, id long, hdr boolean, v string")
    got = section_carry(df, "id", F.col("hdr"), "v", "carried", by=["g"], bits=bits)
    got = {(r.g, r.id): r.carried for r in got.collect()}
    want = {(r.g, r.id): (None if pd.isna(r.carried) else r.carried)
            for r in _literal_carry(pdf).itertuples()}
    assert got == want


def test_section_carry_edges(spark):
    # rows before the first header, a header as the last row, two months
    _check_carry(spark, [1, 2, 3, 4, 5, 6, 7], [False, True, False, False, True, False, True],
                 ["m", "m", "m", "m", "m", "n", "n"], bits=1)


@HYP
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.booleans(), st.sampled_from("ab")),
                min_size=1, max_size=60, unique_by=lambda t: t[0]),
       st.sampled_from([1, 2, 3, 40]))
def test_section_carry_random(spark, rows, bits):
    _check_carry(spark, [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], bits)


@HYP
@given(st.lists(st.tuples(st.integers(0, 200), st.booleans()), min_size=1, max_size=40,
                unique_by=lambda t: t[0]), st.sampled_from([1, 3, 20]))
def test_next_marker_random(spark, rows, bits):
    pdf = pd.DataFrame({"id": [r[0] for r in rows], "mark": [r[1] for r in rows]})
    df = spark.createDataFrame(pdf, "id long, mark boolean")
    got = next_marker(df.where("mark"), "id", F.lit(True), "nxt", bits=bits)
    got = {r.id: r.nxt for r in got.collect()}
    marks = sorted(pdf.id[pdf.mark])
    want = {m: (marks[i + 1] if i + 1 < len(marks) else None) for i, m in enumerate(marks)}
    assert got == want


def test_carry_strict_and_ties(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, None), (3, "b")], "id long, v string")
    got = carry_last(df, "id", F.col("v"), "c").collect()
    assert sorted((r.id, r.v or "", r.c) for r in got) == \
        [(1, "", "a"), (1, "a", "a"), (2, "", "a"), (3, "b", "b")]   # peers of a header see it
    got = carry_last(df, "id", F.col("v"), "c", strict=True).collect()
    assert sorted((r.id, r.v or "", r.c or "") for r in got) == \
        [(1, "", ""), (1, "a", ""), (2, "", "a"), (3, "b", "a")]


# ---- bracket intervals ----------------------------------------------------------------------

bracket = st.tuples(st.sampled_from("AB"), st.integers(0, 30), st.integers(0, 30),
                    st.integers(1, 9))


@HYP
@given(st.lists(bracket, min_size=0, max_size=8),
       st.lists(st.tuples(st.sampled_from("ABC"), st.one_of(st.none(), st.integers(-2, 33))),
                min_size=1, max_size=25))
def test_interval_lookup_equals_bracket_join(spark, brs, rows):
    br = spark.createDataFrame([(g, "X", lo, hi, v) for g, lo, hi, v in brs], BR_SCHEMA)
    left = spark.createDataFrame([(i, g, "X", m) for i, (g, m) in enumerate(rows)],
                                 "id int, grade string, currency string, m int")
    iv = elementary_intervals(br, "lo", "hi", ["v"])
    fast = interval_lookup(left, iv, "m", {"v": "s"}, "k").collect()
    slow = bracket_join(left, br, "m", "lo", "hi", {"v": "p"}, coalesce=False)
    slow = slow.groupBy("id").agg(F.count("p").alias("k"), F.coalesce(F.sum("p"), F.lit(0)).alias("s"))
    assert {r.id: (r.k, r.s) for r in fast} == {r.id: (r.k, r.s) for r in slow.collect()}


def test_brackets_keep_fractions(spark):
    """Decimal premiums are summed exactly; fractional bounds cover the integers inside."""
    from decimal import Decimal
    from vitrina.operators.brackets import elementary_intervals, interval_lookup
    from vitrina.operators.joins import bracket_join
    sheet = spark.createDataFrame(
        [("A", "R", Decimal("0.5"), Decimal("10.5"), Decimal("7.50")), ("A", "R", Decimal("8"), Decimal("12"), Decimal("0.25")),
         ("A", "R", Decimal("20.2"), Decimal("20.8"), Decimal("9"))],
        "grade string, currency string, lo decimal(10,1), hi decimal(10,1), v decimal(10,2)")
    facts = spark.createDataFrame([("A", "R", m) for m in (0, 1, 8, 10, 11, 12, 13, 20)], "grade string, currency string, m int")
    iv = elementary_intervals(sheet, "lo", "hi", ["v"])
    want = {0: (0, 0), 1: (1, "7.50"), 8: (2, "7.75"), 10: (2, "7.75"), 11: (1, "0.25"), 12: (1, "0.25"), 13: (0, 0), 20: (0, 0)}
    for hint in (True, False):                       # broadcast, and binned beyond the bound
        got = {r.m: (r.n, r.v) for r in interval_lookup(facts, iv, "m", {"v": "v"}, "n", broadcast=hint).collect()}
        assert got == {m: (n, Decimal(v)) for m, (n, v) in want.items()}
        rows = bracket_join(facts, sheet, "m", "lo", "hi", {"v": "v"}, broadcast=hint)
        sums = {r.m: r.s for r in rows.groupBy("m").agg(F.sum("v").alias("s")).collect()}
        assert sums == {m: Decimal(v) for m, (_, v) in want.items()}


# ---- ranges beyond the broadcast bound --------------------------------------------------------

def test_dyadic_blocks_cover_each_integer_once(spark):
    from vitrina.operators.brackets import dyadic_blocks
    ranges = [(0, 0), (0, 7), (1, 7), (5, 5), (-9, 13), (-8, -1), (3, 2), (2**40 - 3, 2**40 + 5), (-2**62, 2**62)]
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(ranges)], "k int, a long, b long")
    got = {}
    for r in dyadic_blocks(df, "a", "b").collect():
        got.setdefault(r.k, []).append((r._block << r._level, ((r._block + 1) << r._level) - 1))
    for k, (a, b) in enumerate(ranges):
        blocks = sorted(got.get(k, []))
        assert len(blocks) <= 2 * max(1, (b - a + 1).bit_length())
        assert not blocks if a > b else blocks[0][0] == a and blocks[-1][1] == b
        assert all(x[1] + 1 == y[0] for x, y in zip(blocks, blocks[1:]))


def test_one_open_ended_range_among_many(spark):
    """The join gives one row for each match: no coarse bins that short ranges share."""
    import numpy as np
    from vitrina.operators.brackets import range_matches
    n = 20_000
    sheet = spark.range(n).select(F.lit("A").alias("g"), (F.col("id") * 10).alias("lo"), (F.col("id") * 10 + 7).alias("hi"), F.col("id").alias("v"))
    sheet = sheet.union(spark.createDataFrame([("A", 150_001, 9_999_999, -1)], "g string, lo long, hi long, v long"))
    rows = spark.range(300_000).select(F.lit("A").alias("g"), F.pmod(F.col("id") * 7919, F.lit(400_000)).alias("m"))
    found = range_matches(rows, sheet, "m", "lo", "hi", ["g"])
    m = np.unique(np.arange(300_000) * 7919 % 400_000)
    want = ((m % 10 <= 7) & (m < 10 * n)).sum() + (m >= 150_001).sum()
    assert found.count() == want
    assert found.where("m between lo and hi").count() == want
    big = spark.createDataFrame([("A", 5)], "g string, m long")
    assert bracket_join(big, sheet, "m", "lo", "hi", {"v": "p"}, keys=["g"], broadcast=False).collect()[0].p == 0


@HYP
@given(st.lists(bracket, min_size=0, max_size=8),
       st.lists(st.tuples(st.sampled_from("ABC"), st.one_of(st.none(), st.integers(-2, 33))), min_size=1, max_size=25))
def test_bracket_join_by_blocks_equals_broadcast(spark, brs, rows):
    br = spark.createDataFrame([(g, "X", lo, hi, v) for g, lo, hi, v in brs], BR_SCHEMA)
    left = spark.createDataFrame([(i, g, "X", m) for i, (g, m) in enumerate(rows)], "id int, grade string, currency string, m int")
    both = [sorted((tuple(r) for r in bracket_join(left, br, "m", "lo", "hi", {"v": "p"}, coalesce=False, broadcast=hint).collect()), key=repr)
            for hint in (True, False)]
    assert both[0] == both[1]


# ---- carry over repeated and missing ids -------------------------------------------------------

@HYP
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 12)), st.one_of(st.none(), st.integers(0, 5)), st.sampled_from("ab")),
                min_size=1, max_size=60), st.sampled_from([1, 3, 40]), st.sampled_from([1, 4, 1000]), st.booleans())
def test_carry_over_repeated_and_null_ids(spark, rows, bits, max_rows, strict):
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, id long, v int, g string")
    got = carry_last(df, "id", F.col("v"), "c", by=["g"], strict=strict, bits=bits, max_rows=max_rows).collect()
    assert len(got) == len(rows)
    for r in got:
        marks = [(i, v) for i, v, g in rows if g == r.g and i is not None and v is not None and r.id is not None
                 and (i < r.id if strict else i <= r.id)]
        assert r.c == (max(marks)[1] if marks else None)


def test_carry_spreads_a_month_of_equal_ids(spark):
    """A month whose ids are one value or NULL in nine of ten rows is dealt over all tasks."""
    n = 40_000
    df = spark.range(n).select(
        F.lit("m").alias("g"), F.expr("CASE WHEN id % 10 < 5 THEN 7 WHEN id % 10 < 9 THEN NULL ELSE id END").alias("o"),
        F.expr("IF(id % 1000 = 9 OR id = 0, concat('h', id), NULL)").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = carry_last(df, "o", F.col("v"), "c", by=["g"], max_rows=500)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and max(sizes) <= 2 * sorted(sizes)[4]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    literal = {r.o: r.c for r in got.where("o is not null").select("o", "c").distinct().collect()}
    marks = sorted((r.o, r.v) for r in df.where("v is not null and o is not null").collect())
    for o, c in list(literal.items())[::50] + [(7, literal[7])]:
        assert c == max((m for m in marks if m[0] <= o), default=(0, None))[1]
    assert got.where("o is null and c is not null").count() == 0
