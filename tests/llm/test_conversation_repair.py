"""Structure repair against a search over all edit sequences, and the query against damage done row by row."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

INF = (10**9, "")


def cheapest(initials, required, cut):
    """(cost, ASCII-least edits), from the last message back: an independent form of the search."""
    n = len(initials)

    @lru_cache(None)
    def best(i, state, inserted):
        options = [(0, "")] if i == n and state in ("", "a") else []
        grown = "u" if state in ("", "s", "a") else "a"
        if inserted < 3:
            c, e = best(i, grown, inserted + 1)
            options.append((c + 3, "I" + e))
        if i < n:
            c, e = best(i + 1, state, 0)
            options.append((c + 4, "D" + e))
            if not required[i]:
                first = initials[i]
                if (first, state) in (("s", ""), ("u", ""), ("u", "s"), ("u", "a"), ("a", "u")):
                    c, e = best(i + 1, first, 0)
                    options.append((c + 3 * cut[i], "K" + e))
                c, e = best(i + 1, grown, 0)
                options.append((c + 3 + 3 * cut[i], "R" + e))
        return min(options, default=INF)

    return best(0, "", 0)


def replay(rows, audit):
    state, out, rows = "", [], iter(rows)
    for e in audit:
        if e == "D":
            next(rows)
            continue
        role, text = ("", "") if e == "I" else next(rows)
        if e != "K":
            role = "assistant" if state == "u" else "user"
        state = role[:1]
        out.append((role, text))
    return out


def judge(rows):
    """The contract over the (turn, role, text) rows of one conversation, after damage and in order."""
    seen, required, cut, counts = set(), [], [], [0, 0, 0]
    for _, role, text in rows:
        ink = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = 0 if not ink else 1 if (role, text) in seen else 2 if ink[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        required.append(fault in (0, 1))
        cut.append(fault == 2)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit = cheapest(tuple(initials), tuple(required), tuple(cut))
    fixed = replay([(r, t) for _, r, t in rows], audit)
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in fixed))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
    return (gaps, *counts, illegal, cost, audit, digest), fixed


def damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        as_text = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        mine = out.setdefault(conv, [])
        kind = zlib.crc32(f"{as_text[0]}:{as_text[1]}".encode()) % 20
        role, text = as_text[2:]
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        if kind:
            mine += [(turn, role, text)] * (2 if kind == 3 else 1)
    for mine in out.values():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


def random_rows(rng, convs, longest):
    rows = []
    for conv in range(convs):
        for _ in range(rng.randint(0, longest)):
            turn = rng.choice([None, *range(6)]) if rng.random() < 0.3 else rng.randint(0, 40)
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None, "unknown"])
            text = rng.choice(["Yes.", "No!", "open end", "", " \t", None, "Same line.", "é ü?  ", f"Line {rng.randint(0, 9)}."])
            rows.append((conv if rng.random() < 0.98 else None, turn, role, text))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def test_survivors_equal_search_of_all_edits():
    from vitrina.llm.conversation_repair import Survivors
    rng = random.Random(5)
    for _ in range(4000):
        n = rng.randint(0, 12)
        alphabet = rng.choice(["ua", "uas", "uuuas", "s", "u", "a", "uasx"])
        rows = [(rng.choice(alphabet), str(k)) for k in range(n)]
        required = [rng.random() < rng.choice([0.1, 0.6]) for _ in rows]
        cut = [not r and rng.random() < 0.3 for r in required]
        out = []
        paths = Survivors(out.append, hashed=True)
        for row, r, c in zip(rows, required, cut):
            paths.step(*row, r, c)
        cost = paths.finish()
        audit = "".join(e[0] for e in out)
        assert (cost, audit) == cheapest(tuple(r for r, _ in rows), tuple(required), tuple(cut)), rows
        fixed = [(r, t) for e, r, t in out if e != "D"]
        assert [(r[:1], t) for r, t in fixed] == [(r[:1], t) for r, t in replay(rows, audit)]
        assert paths.sha256() == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()


def test_memory_is_the_unresolved_suffix():
    from vitrina.llm.conversation_repair import Survivors
    out = []
    paths = Survivors(out.append)
    for k in range(20_000):
        paths.step(("user", "assistant")[k % 2], f"{k}.", k % 7 == 0, k % 5 == 0)
        assert paths.unresolved() < 200
    long_tie = Survivors(out.append)
    for k in range(20_000):  # users only: where the one insert goes is open to the end
        long_tie.step("user", f"{k}.", False, False)
    assert len(long_tie.leaf) <= 4 and long_tie.unresolved() < 3 * 20_000
    assert long_tie.finish() == 30_000


def test_query_equals_brute_force(spark, tmp_path):
    from vitrina.llm.queries import op12_conversation_repair
    rows = random_rows(random.Random(11), 150, 14)
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r[0]: tuple(r)[1:] for r in op12_conversation_repair(spark, str(tmp_path)).collect()}
    assert got == {conv: judge(mine)[0] for conv, mine in damage(rows).items()}


def test_repaired_messages(spark):
    from vitrina.llm.conversation_repair import repair_conversations
    rows = random_rows(random.Random(3), 60, 9)
    want, by_conv = {}, {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    for conv, mine in by_conv.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        want[conv] = judge(mine)[1]
    got = {}
    for r in sorted(repair_conversations(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda r: (str(r.conv_id), r.place)):
        if r.edit != "D":
            got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got == {c: f for c, f in want.items() if f}


def test_hot_conversation_and_repeated_line(spark):
    from vitrina.llm.conversation_repair import repair_summaries
    rows = [(1, k, ("user", "assistant")[k % 2], "The same line." if k % 3 else f"Line {k}.") for k in range(3000)]
    got = repair_summaries(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 1 and tuple(got[0])[1:] == judge([r[1:] for r in rows])[0]


@pytest.mark.parametrize("rows", [[], [(1, None, None, None)], [(None, 1, "user", "x" * 200_000 + ".")]])
def test_edge_cases(spark, rows):
    from pyspark.sql import functions as F

    from vitrina.llm.conversation_repair import repair_summaries
    df = spark.createDataFrame(rows, SCHEMA).withColumn("audit", F.lit(1)).withColumn("conv", F.lit("x")).withColumn("note", F.lit(2))
    got = {r[0]: tuple(r)[1:] for r in repair_summaries(df).collect()}
    assert got == {c: judge([(t, r or " ", x or " ")])[0] for c, t, r, x in rows}


def test_dropped_conversations_stay(spark):
    from vitrina.llm.conversation_repair import repair_summaries
    df = spark.createDataFrame([(1, 5, "user", "Hi.", True), (2, 1, "user", "Hi.", False)], SCHEMA + ", dropped boolean")
    got = {r.conv_id: r for r in repair_summaries(df).collect()}
    assert tuple(got[1])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert (got[2].audit, got[2].cost) == ("KI", 3)


def test_query_equals_its_sql(spark, tmp_path):
    import duckdb

    from vitrina.llm.oracle import ORACLE
    from vitrina.llm.queries import op12_conversation_repair
    rows = random_rows(random.Random(8), 120, 10)
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    got = op12_conversation_repair(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(con.execute(ORACLE["op12_conversation_repair"]).fetchall(), key=str)
