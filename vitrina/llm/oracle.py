"""DuckDB SQL for the queries that SQL can express (the others are tested against brute force)."""

from __future__ import annotations

from vitrina.llm.line_rules import BOILERPLATE
from vitrina.llm.secret_links import BREAK, KINDS, MIN_DISTINCT, MIN_VALUE, PATTERNS, WINDOW

_SPACE = r"\x20\x09-\x0D"
_PHRASES = "|".join(BOILERPLATE)

QUALITY_RULES = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
     words AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^{_SPACE}]+') AS w,
                      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{_SPACE}]')) AS ls
               FROM docs),
     windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n
                 FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
     covered AS (SELECT r, count(DISTINCT p) AS n_repeat
                 FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE n > 1) GROUP BY r),
     lines AS (SELECT r, l, regexp_extract_all(l, '[^{_SPACE}]+') AS w FROM (SELECT r, unnest(ls) AS l FROM words)),
     counts AS (SELECT r, l, len(w) AS n, length(regexp_replace(l, '[{_SPACE}]', '', 'g')) AS chars,
                       len(list_filter(w, lambda x: regexp_matches(x, '[#*$%&<>]|!!'))) AS marked,
                       length(regexp_replace(l, '[^|>»·•]', '', 'g')) AS seps
                FROM lines),
     removed AS (SELECT r, count(*) AS n_removed, sum(chars) AS gone FROM counts
                 WHERE marked >= 3 AND 100 * marked > 30 * n
                    OR n >= 20 AND NOT regexp_matches(l, '[.,;:!?]')
                    OR seps >= 3 AND n - seps <= 3 * (seps + 1) + seps
                    OR n <= 20 AND regexp_matches(l, '{_PHRASES}', 'i')
                 GROUP BY r),
     facts AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
                      CAST(length(regexp_replace(t, '[{_SPACE}]', '', 'g')) AS BIGINT) AS word_chars,
                      CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                      CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
                      CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words,
                      CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed_lines,
                      CAST(coalesce(gone, 0) AS BIGINT) AS removed_chars
               FROM words LEFT JOIN covered USING (r) LEFT JOIN removed USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 2 * removed_chars <= word_chars AS kept
FROM facts"""



def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _hits(name: str, number: int, pattern: str) -> str:
    return (f"SELECT r, {number} AS k, '{name}' AS kind, regexp_extract_all(t, {_quoted(pattern)}) AS h, "
            f"string_split_regex(t, {_quoted(pattern)}) AS g FROM docs WHERE regexp_matches(t, {_quoted(pattern)})")


# A hit starts after all gaps and hits before it.  ``l`` and ``h`` bound a candidate's window inside its scope.
_MEETS = "EXISTS (SELECT 1 FROM parts p WHERE p.r = w.r AND p.kind IN ({}) AND p.s <= w.h AND p.e >= w.l)"
SECRET_LINKS = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
     hits AS ({" UNION ALL ".join(_hits(k, n, p) for n, (k, p) in enumerate([*PATTERNS.items(), ("break", BREAK)]))}),
     each AS (SELECT r, k, kind, unnest(h) AS hit, unnest(g[1:len(h)]) AS gap, unnest(range(len(h))) AS i FROM hits),
     placed AS (SELECT *, e - length(hit) AS s
                FROM (SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY r, k ORDER BY i) AS e FROM each)),
     raw AS (SELECT * FROM placed
             WHERE CASE kind WHEN 'assign' THEN length(regexp_extract(hit, {_quoted(PATTERNS["assign"])}, 2)) >= {MIN_VALUE}
                             WHEN 'mixed' THEN regexp_matches(hit, '[a-z]') AND regexp_matches(hit, '[A-Z]') AND
                                               regexp_matches(hit, '[0-9]') AND
                                               len(list_distinct(string_split(hit, ''))) >= {MIN_DISTINCT}
                             ELSE kind <> 'break' END),
     parts AS (SELECT r, k, kind, s, e FROM raw x
               WHERE k < 3 OR NOT EXISTS (SELECT 1 FROM raw y WHERE y.r = x.r AND y.k < x.k AND y.s < x.e AND y.e > x.s)),
     weak AS (SELECT *, greatest(s - {WINDOW}, coalesce((SELECT max(b.e) FROM placed b WHERE b.r = x.r AND b.kind = 'break'
                                                        AND b.e <= x.s), 0)) AS l,
                     least(e + {WINDOW}, coalesce((SELECT min(b.s) FROM placed b WHERE b.r = x.r AND b.kind = 'break'
                                                   AND b.s >= x.e), e + {WINDOW})) AS h
              FROM parts x WHERE k >= 3),
     found AS (SELECT r, k, kind, s, e FROM parts WHERE k < 3
               UNION ALL
               SELECT r, k, kind, s, e FROM weak w
               WHERE (kind = 'id' OR {_MEETS.format("'access', 'id'")})
                 AND (kind IN ('pass', 'mixed') OR {_MEETS.format("'assign', 'hex', 'pass', 'mixed'")})),
     texts AS (SELECT r, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS b,
                      count(*) FILTER (kind = 'hex') AS c,
                      string_agg(concat_ws(':', kind, s, e), ',' ORDER BY s, k) FILTER (k < 3) AS base,
                      string_agg(concat_ws(':', kind, s, e), ',' ORDER BY s, k) AS spans
               FROM (SELECT r, k, kind, CAST(s AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM found) GROUP BY r)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN texts USING (r)"""
assert KINDS[:3] == ("assign", "access", "hex")

# The search from the first message on, states 0 (nothing) 1 (s) 2 (u) 3 (a); crc32 bit by bit.
CONVERSATION_REPAIR = rf"""
WITH RECURSIVE
     src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
             FROM conversations),
     kinds AS (SELECT *, xor(list_reduce(list_transform(range(1, length(name) + 1), lambda i: CAST(ascii(name[i]) AS BIGINT)),
                                         lambda c, b: list_reduce(range(8), lambda d, j: xor(d >> 1, (d & 1) * 3988292384),
                                                                  xor(c, b)),
                                         CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS kind
               FROM src),
     dealt AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
                      CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                      unnest(CASE kind WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
               FROM kinds WHERE kind <> 0),
     convs AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
     numbered AS (SELECT c, turn, role, text, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS n
                  FROM dealt JOIN convs ON dealt.conv_id IS NOT DISTINCT FROM convs.conv_id),
     seen AS (SELECT *, left(role, 1) AS i, lag(left(role, 1)) OVER (PARTITION BY c ORDER BY n) AS i0,
                     NOT regexp_matches(text, '[^{_SPACE}]') AS blank,
                     row_number() OVER (PARTITION BY c, role, text ORDER BY n) > 1 AS again,
                     NOT regexp_matches(text, '[.!?][{_SPACE}]*$') AS cut
              FROM numbered),
     rows AS (SELECT c, n, turn, role, text, i, blank, NOT blank AND again AS dup, NOT blank AND NOT again AND cut AS trunc,
                     n > 1 AND i0 || i NOT IN ('su', 'ua', 'au') AS bad
              FROM seen),
     inserts(st, ins, st1, icost, added) AS (
         VALUES (0, '', 0, 0, CAST([] AS VARCHAR[])), (1, '', 1, 0, []), (2, '', 2, 0, []), (3, '', 3, 0, []),
                (0, 'I', 2, 3, ['user:']), (1, 'I', 2, 3, ['user:']), (2, 'I', 3, 3, ['assistant:']), (3, 'I', 2, 3, ['user:']),
                (0, 'II', 3, 6, ['user:', 'assistant:']), (1, 'II', 3, 6, ['user:', 'assistant:']),
                (2, 'II', 2, 6, ['assistant:', 'user:']), (3, 'II', 3, 6, ['user:', 'assistant:'])),
     edits(st1, edit, i, st2, ecost, new_role) AS (
         VALUES (0, 'D', NULL, 0, 4, NULL), (1, 'D', NULL, 1, 4, NULL), (2, 'D', NULL, 2, 4, NULL), (3, 'D', NULL, 3, 4, NULL),
                (0, 'R', NULL, 2, 3, 'user'), (1, 'R', NULL, 2, 3, 'user'), (2, 'R', NULL, 3, 3, 'assistant'), (3, 'R', NULL, 2, 3, 'user'),
                (0, 'K', 's', 1, 0, NULL), (0, 'K', 'u', 2, 0, NULL), (1, 'K', 'u', 2, 0, NULL), (2, 'K', 'a', 3, 0, NULL),
                (3, 'K', 'u', 2, 0, NULL)),
     paths AS (
         SELECT c, CAST(0 AS BIGINT) AS n, 0 AS st, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS fixed
         FROM convs
         UNION ALL
         SELECT c, n, st, cost, audit, fixed
         FROM (SELECT p.c, r.n, e.st2 AS st, CAST(p.cost + f.icost + e.ecost + CASE WHEN r.trunc AND e.edit <> 'D' THEN 3 ELSE 0 END AS BIGINT) AS cost,
                      p.audit || f.ins || e.edit AS audit,
                      list_concat(p.fixed, f.added, CASE WHEN e.edit = 'D' THEN CAST([] AS VARCHAR[])
                                                         ELSE [coalesce(e.new_role, r.role) || ':' || r.text] END) AS fixed
               FROM paths p JOIN inserts f ON f.st = p.st JOIN rows r ON r.c = p.c AND r.n = p.n + 1
                    JOIN edits e ON e.st1 = f.st1 AND (e.i IS NULL OR e.i = r.i)
               WHERE e.edit = 'D' OR NOT (r.blank OR r.dup))
         QUALIFY row_number() OVER (PARTITION BY c, st ORDER BY cost, audit) = 1),
     facts AS (SELECT c, max(n) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                      count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate, count(*) FILTER (trunc) AS truncated,
                      count(*) FILTER (bad) AS illegal
               FROM rows GROUP BY c),
     ends AS (SELECT p.c, CAST(p.cost + f.icost AS BIGINT) AS cost, p.audit || f.ins AS audit, list_concat(p.fixed, f.added) AS fixed
              FROM paths p JOIN inserts f ON f.st = p.st LEFT JOIN facts USING (c)
              WHERE p.n = coalesce(facts.n, 0) AND f.st1 IN (0, 3)
              QUALIFY row_number() OVER (PARTITION BY p.c ORDER BY p.cost + f.icost, p.audit || f.ins) = 1)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit,
       sha256(array_to_string(fixed, chr(10))) AS repaired_sha256
FROM convs JOIN ends USING (c) LEFT JOIN facts USING (c)"""

ORACLE: dict[str, str] = {"op4_quality_rules": QUALITY_RULES, "op11_secret_links": SECRET_LINKS,
                          "op12_conversation_repair": CONVERSATION_REPAIR}
