"""Joins of the marts: name keys, inclusive bracket (range) lookups, and a
NULL-aware NOT IN."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.functions.text import first_token, leading_word, second_token
from vitrina.operators.brackets import range_join
from vitrina.operators.broadcast import BRACKET_MAX_BYTES, ROSTER_MAX_BYTES, checked_broadcast, fits
from vitrina.session import materialize


def person_keys(posts: DataFrame, author: str = "author") -> DataFrame:
    """Add ``first_name`` (leading word) and ``last_name`` (second token) of a
    'First Last' author."""
    return (posts.withColumn("first_name", leading_word(author))
                 .withColumn("last_name", second_token(author)))


def roster_keys(roster: DataFrame, blogger: str = "blogger") -> DataFrame:
    """Roster names are 'Last First [Patronymic]': first = token 2, last = token 1."""
    rest = [c for c in roster.columns if c != blogger]
    return roster.select(second_token(blogger).alias("first_name"),
                         first_token(blogger).alias("last_name"), *rest)


def name_key_join(posts_keyed: DataFrame, roster: DataFrame,
                  max_bytes: int = ROSTER_MAX_BYTES) -> DataFrame:
    """Inner join of posts to the roster on (first_name, last_name).

    The roster is broadcast when the planner's estimate shows it is small, so the
    fact side is never shuffled for it (and a blogger holding a third of all
    posts causes no skew).  Duplicate roster names multiply rows, as the SQL
    join does.  Beyond the bound the join is dealt by ``skew_join``.
    """
    r, small = checked_broadcast(roster_keys(roster), max_bytes)
    if not small and max_bytes:  # the planner knows a derived roster's size only once it is written
        r, small = checked_broadcast(materialize(r, "roster"), max_bytes)
    keys = ["first_name", "last_name"]
    if not small:
        return skew_join(posts_keyed, r, keys)
    # A missing name meets nothing: '' and ' ' are no tokens.  Keys that are never NULL need no filter; the planner
    # would push one below the inputs of both sides and parse every name there several times more.
    p = "_nk_"
    named = r.select(*[F.coalesce(F.col(k), F.lit(" ")).alias(p + k) for k in keys],
                     *[c for c in r.columns if c not in keys])
    j = posts_keyed.join(F.broadcast(named), [F.coalesce(F.col(k), F.lit("")) == F.col(p + k) for k in keys], "inner")
    return j.select(*keys, *[posts_keyed[c] for c in posts_keyed.columns if c not in keys],
                    *[named[c] for c in named.columns if not c.startswith(p)])


def key_hash(keys: Iterable[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def heavy_keys(df: DataFrame, keys: Iterable[str], share: float, counts: DataFrame | None = None) -> dict[int, float]:
    """Hashes of the keys that hold more than ``share`` of the rows, with their share (at most
    1 / share of them; NULL keys, which join nothing, are left out).

    From a sketch of bounded size, merged over the tasks (``approx_top_k``): no exchange of keys.
    ``counts`` (keys and ``n``) gives exact numbers where they have been computed before."""
    keys, most = list(keys), int(1 / share) + 1
    if counts is not None:
        rows = counts.dropna(subset=keys).select(key_hash(keys).alias("h"), "n")
        total = rows.agg(F.sum("n")).first()[0] or 0
        found = [(r["h"], r["n"]) for r in rows.orderBy(F.desc("n")).limit(most).collect()]
    else:
        hashed = df.dropna(subset=keys).select(key_hash(keys).alias("h"))
        top = hashed.agg(F.expr(f"approx_top_k(h, {most}, {20 * most})").alias("top"), F.count(F.lit(1)).alias("n")).first()
        total, found = top["n"], [(t["item"], t["count"]) for t in top["top"] or []]
    return {h: n / total for h, n in found if n > share * total}


def skew_join(left: DataFrame, right: DataFrame, keys: Iterable[str], how: str = "inner",
              counts: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """Equi-join of a large left side whose keys may be hot: one key may hold a third of its rows.

    A key with more than a quarter of a task's fair share is dealt over as many salts as it has quarters; its rows
    on the right are repeated for each salt.  All other keys have one salt.  So a task holds about
    its share whatever the keys, nothing is broadcast, and both sides are read and shuffled once."""
    if how not in ("inner", "left"):
        raise ValueError("salts repeat the right side: inner and left joins only")
    keys = list(keys)
    parts = parts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    quarter = 1 / (4 * parts)
    heavy = heavy_keys(left, keys, quarter, counts)
    if not heavy:
        return left.join(right, keys, how)
    salts = F.create_map(*[F.lit(x) for h, n in heavy.items() for x in (h, math.ceil(n / quarter))])
    n_salts = F.coalesce(F.element_at(salts, key_hash(keys)), F.lit(1))
    dealt = left.withColumn("_sj_salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), n_salts.cast("bigint")))
    copied = right.withColumn("_sj_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), n_salts.cast("bigint") - 1)))
    return dealt.join(copied, [*keys, "_sj_salt"], how).drop("_sj_salt")


def bracket_join(left: DataFrame, brackets: DataFrame, measure: str, start: str, end: str,
                 take: Mapping[str, str], keys: Iterable[str] = ("grade", "currency"),
                 default=0, broadcast: bool | None = None, coalesce: bool = True) -> DataFrame:
    """Left join each row to the brackets whose keys match and whose inclusive
    range [start, end] holds ``measure``.

    ``take`` maps bracket columns to output names.  No bracket gives
    ``default`` (or NULL with ``coalesce=False``); overlapping brackets
    multiply the row, as the SQL join does.  ``broadcast=None`` checks the sheet's
    size: a small sheet is broadcast, with the range as residual condition; a
    larger one is joined by aligned blocks, see ``brackets.range_join``.
    """
    keys = list(keys)
    p = "_br_"
    if broadcast is None:
        broadcast = fits(brackets, BRACKET_MAX_BYTES)
    b = brackets.select(*[F.col(k).alias(p + k) for k in keys],
                        F.col(start).alias(p + "lo"), F.col(end).alias(p + "hi"),
                        *[F.col(c).alias(p + "v_" + c) for c in take])
    j = range_join(left, b, measure, p + "lo", p + "hi", {k: p + k for k in keys}, broadcast)
    vals = [(F.coalesce(F.col(p + "v_" + c), F.lit(default)) if coalesce else F.col(p + "v_" + c)).alias(o)
            for c, o in take.items()]
    return j.select(*[F.col(c) for c in left.columns], *vals)


def not_in(df: DataFrame, sub: DataFrame, key: str, by: Iterable[str] = (),
           counts: tuple[str, str] | None = None) -> DataFrame:
    """``df.key NOT IN (SELECT key FROM sub [WHERE sub.by = df.by])`` with SQL's
    three-valued logic, built from a hash anti join instead of a nested loop:

    * a NULL key in the subquery removes every row (of that ``by`` group);
    * a NULL key in ``df`` survives only when the subquery is empty.

    ``sub`` rows are (by..., key).  The anti join shuffles on (by, key), which
    spreads evenly; the per-group flags are one row per group.  ``counts``
    names columns already on ``df`` holding the group's subquery row count and
    non-NULL key count (when the caller computed them in a pass it needs
    anyway); otherwise they are computed from ``sub``.
    """
    by = list(by)
    keys = sub.where(F.col(key).isNotNull()).select(*by, key)
    kept = df.join(keys, [*by, key], "left_anti")
    if counts is not None:
        n_rows, n_keys = F.col(counts[0]), F.col(counts[1])
        return kept.where((n_rows == 0) | ((n_rows == n_keys) & F.col(key).isNotNull()))
    if by:
        flags = sub.groupBy(*by).agg(F.count(F.lit(1)).alias("_nin_rows"),
                                     F.count(key).alias("_nin_keys"))
        kept = kept.join(flags, by, "left")
        ok = (F.col("_nin_rows").isNull()
              | ((F.col("_nin_rows") == F.col("_nin_keys")) & F.col(key).isNotNull()))
        return kept.where(ok).drop("_nin_rows", "_nin_keys")
    n_rows = sub.select(F.count(F.lit(1))).scalar()
    n_keys = sub.select(F.count(key)).scalar()
    return kept.where((n_rows == 0) | ((n_rows == n_keys) & F.col(key).isNotNull()))
