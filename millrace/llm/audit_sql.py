"""SQL of the conversation repair and of the filter audit, for comparison with DuckDB."""

from __future__ import annotations

# A state is its cost in nine digits followed by its edits, so that states compare as the rules say; 'x' is out of reach.
_OUT = "{'s': 'x', 't': ''}"


def _moved(state: str, cost: str, edit: str, text: str = "''") -> str:
    total = f"lpad(CAST(CAST(left({state}.s, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0')"
    return f"CASE WHEN {state}.s = 'x' THEN {_OUT} ELSE {{'s': {total} || substr({state}.s, 10) || '{edit}', 't': {state}.t || {text}}} END"


def _least(*states: str) -> str:
    return f"list_sort([{', '.join(states)}])[1]"


def _only(condition: str, state: str) -> str:
    return f"CASE WHEN {condition} THEN {state} ELSE {_OUT} END"


_U, _A = r"chr(10) || 'user:'", r"chr(10) || 'assistant:'"
_KEPT, _REROLED = "chr(10) || role || ':' || text", "chr(10) || '{}:' || text"


def _rerole(state: str, role: str) -> str:
    return _only("NOT gone", _moved(state, "3 + extra", "R", _REROLED.format(role)))


def _keep(state: str, initial: str) -> str:
    return _only(f"NOT gone AND left(role, 1) = '{initial}'", _moved(state, "extra", "K", _KEPT))


REPAIR_SQL = rf"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
    FROM conversations
), coded AS (
    SELECT *, xor(4294967295, list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(key, ''), lambda c: CAST(ascii(c) AS BIGINT))),
        lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 20 AS code
    FROM keyed
), hurt AS (
    SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
           CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN code = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM coded WHERE code <> 0
), marked AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS again FROM hurt
), faulty AS (
    SELECT conv_id, turn, role, text, again,
           CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
    FROM marked
), ordered AS (
    SELECT *, fault IN ('blank', 'duplicate') AS gone, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS extra,
           dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS conv,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS k,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) || left(role, 1) AS pair
    FROM faulty
), found AS (
    SELECT conv_id, conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (k > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
    FROM ordered GROUP BY conv_id, conv
), steps AS (
    SELECT conv, CAST(0 AS BIGINT) AS k, {{'s': '000000000', 't': ''}} AS e, {_OUT} AS s, {_OUT} AS u, {_OUT} AS a FROM found
    UNION ALL
    SELECT conv, k, {_moved("pe", "4", "D")},
           {_least(_moved("ps", "4", "D"), _keep("pe", "s"))},
           {_least(_moved("pu", "4", "D"), *[_keep(p, "u") for p in ("pe", "ps", "pa")], *[_rerole(p, "user") for p in ("pe", "ps", "pa")])},
           {_least(_moved("pa", "4", "D"), _keep("pu", "a"), _rerole("pu", "assistant"))}
    FROM (
        SELECT steps.conv, ordered.k, role, text, gone, extra, e AS pe, s AS ps,
               {_least("u", _moved("e", "3", "I", _U), _moved("s", "3", "I", _U), _moved("a", "3", "I", _U))} AS pu,
               {_least("a", _moved("e", "6", "II", _U + " || " + _A), _moved("s", "6", "II", _U + " || " + _A), _moved("u", "3", "I", _A))} AS pa
        FROM steps JOIN ordered ON steps.conv = ordered.conv AND ordered.k = steps.k + 1
    )
), ends AS (
    SELECT found.*, {_least("e", "a", _moved("s", "6", "II", _U + " || " + _A), _moved("u", "3", "I", _A))} AS best
    FROM found JOIN steps ON found.conv = steps.conv AND found.n = steps.k
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(CAST(left(best.s, 9) AS BIGINT), 0) AS cost,
       coalesce(substr(best.s, 10), '') AS audit, sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN ends ON c.conv_id IS NOT DISTINCT FROM ends.conv_id
"""

AUDIT_SQL = r"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), facts AS (
    SELECT doc_id, part, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
           length(regexp_replace(t, '[^A-Z]', '', 'g')) AS capitals, length(t) AS points, regexp_matches(t, '[#$%&*|]') AS symbol,
           coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), FALSE) AS again
    FROM texts
), marks AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
), classes AS (
    SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
    FROM (SELECT doc_id, part, (CASE WHEN len(w) < 200 THEN 1 ELSE 0 END)
                 + (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END)
                 + (CASE WHEN 100 * capitals > 3 * points THEN 4 ELSE 0 END)
                 + (CASE WHEN symbol THEN 8 ELSE 0 END) + (CASE WHEN again THEN 16 ELSE 0 END) AS fails FROM facts)
    LEFT JOIN marks USING (doc_id) GROUP BY part, fails
), letters AS (
    SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS l(x, bit)
), orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
    SELECT filter_order, CAST(k AS INTEGER) AS step, bits[k] AS bit, coalesce(list_sum(bits[1 : k - 1]), 0)::INTEGER AS before
    FROM orders, range(1, 6) AS r(k)
), counted AS (
    SELECT part, filter_order, step, bit,
           coalesce(sum(n) FILTER (fails & (before | bit) = 0), 0) AS kept,
           coalesce(sum(n) FILTER (fails & before = 0 AND fails & bit <> 0), 0) AS removed,
           coalesce(sum(n) FILTER (fails & before <> 0 AND fails & bit <> 0), 0) AS redundant,
           coalesce(sum(n) FILTER (fails = bit), 0) AS unique_fails,
           coalesce(sum(good) FILTER (fails & before = 0 AND fails & bit <> 0), 0) AS good_lost,
           coalesce(sum(toxic) FILTER (fails & before = 0 AND fails & bit <> 0), 0) AS toxic_lost
    FROM classes, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""
