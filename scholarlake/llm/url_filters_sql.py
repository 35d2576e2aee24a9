"""The SQL that ``url_filters.judged`` must equal, for trees of a given depth."""

from __future__ import annotations

from collections.abc import Sequence

from scholarlake.llm import url_filters as u


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _double(value: float) -> str:
    return f"{value!r}e0"  # a plain fraction would be a decimal


def _kind(s: str) -> str:
    stem = f"regexp_replace({s}, '{u.EXTENSION}', '')"
    return (
        f"CASE WHEN {s} = '' THEN '' ELSE concat("
        f"CASE WHEN {stem} = '' THEN '*any'"
        f" WHEN translate({stem}, '0123456789', '') = '' THEN '*num'"
        f" WHEN NOT regexp_matches({stem}, '[^A-Za-z_-]') THEN '*word'"
        f" WHEN NOT regexp_matches({stem}, '[^A-Za-z0-9_-]') THEN '*id' ELSE '*any' END,"
        f" CASE WHEN {stem} = {s} THEN '' ELSE '.' END) END"
    )


def _escaped(s: str) -> str:
    for plain, escape in u.ESCAPES.items():
        s = f"replace({s}, '{plain}', '{escape}')"
    return s


def _rules(rules: Sequence[u.Rule]) -> str:
    """For each (host, path) the rule that decides."""
    rows = ", ".join(
        f"({_text(verdict)}, {_text(rule.split('/')[0])}, {_text(rule[rule.index('/'):])})"
        for verdict, rule in rules
    )
    return f"""
rules(decided, of, start) AS (VALUES {rows}),
fits AS (
  SELECT host, path, of || start AS rule, decided
  FROM (SELECT DISTINCT host, path FROM urls)
  JOIN rules ON (host = of OR ends_with(host, '.' || of)) AND starts_with(path, start)
  QUALIFY row_number() OVER (
    PARTITION BY host, path ORDER BY length(of || start) DESC, length(of) DESC) = 1
)"""


def _level(d: int) -> str:
    kinds = ", ".join(f"count(*) FILTER (k = '{k}')" for k in u.NEXT)
    sums = ", ".join(f"sum(nxt[{i + 1}])" for i in range(len(u.NEXT)))
    z = _double(u.Z * u.Z)
    return f"""
live{d} AS (
  SELECT *, seg[{d + 1}] AS s,
    CASE WHEN len(seg) < {d + 2} THEN 'end' ELSE {_kind(f"seg[{d + 2}]")} END AS k
  FROM state{d} WHERE len(seg) > {d} AND size >= {u.SPLIT}
),
branches{d} AS (
  SELECT host, node, s, max(purity) AS purity, count(*) AS n,
    count(*) FILTER (label = 'allow') AS good, count(*) FILTER (label = 'block') AS bad,
    [{kinds}] AS nxt
  FROM live{d} GROUP BY host, node, s
),
tokens{d} AS (
  SELECT *, CASE WHEN n >= {u.SUPPORT} AND n >= {_double(u.SHARE)} * total
    THEN {_escaped("s")} ELSE {_kind("s")} END AS token
  FROM (SELECT *, CAST(sum(n) OVER (PARTITION BY host, node) AS DOUBLE) AS total
    FROM branches{d})
),
siblings{d} AS (
  SELECT host, node, token, max(purity) AS purity, CAST(sum(n) AS DOUBLE) AS n,
    CAST(sum(good) AS DOUBLE) AS good, CAST(sum(bad) AS DOUBLE) AS bad,
    CAST(sum(good + bad) AS DOUBLE) AS told, CAST([{sums}] AS DOUBLE[]) AS nxt
  FROM tokens{d} GROUP BY host, node, token
),
placed{d} AS (
  SELECT *, told > 0 AS any_told, list_position(nxt, list_max(nxt)) AS most,
    coalesce(good / nullif(told, 0), 0) AS share FROM siblings{d}
),
pairs{d} AS (
  SELECT *, lag(n) OVER w AS n0, lag(good) OVER w AS good0, lag(told) OVER w AS told0,
    lag(nxt) OVER w AS nxt0
  FROM placed{d}
  WINDOW w AS (PARTITION BY host, node ORDER BY any_told, most, share, token)
),
news{d} AS (
  SELECT *, CASE WHEN n0 IS NOT NULL
    AND list_sum(list_transform(list_zip(nxt, nxt0), lambda p: abs(p[1] * n0 - p[2] * n)))
      <= {_double(2 * u.DISTANCE)} * n * n0
    AND (told = 0 AND told0 = 0 OR told > 0 AND told0 > 0
      AND (good / told - good0 / told0) * (good / told - good0 / told0)
        <= {z} * ((good + good0 + 1) / (told + told0 + 2))
          * (1 - (good + good0 + 1) / (told + told0 + 2)) * (1e0 / told + 1e0 / told0))
    THEN 0 ELSE 1 END AS new
  FROM pairs{d}
),
classes{d} AS (
  SELECT *, sum(new) OVER (PARTITION BY host, node ORDER BY any_told, most, share, token) AS class
  FROM news{d}
),
below{d} AS (
  SELECT host, node, class, any_value(purity) AS purity, sum(n) AS size, sum(good) AS good,
    sum(bad) AS bad, CASE WHEN count(*) = 1 THEN any_value(token)
      ELSE '{{' || array_to_string(list_sort(list(token)), '|') || '}}' END AS name
  FROM classes{d} GROUP BY host, node, class
),
state{d + 1} AS (
  SELECT live.host, live.path, live.label, live.seg, live.node || '/' || name AS node,
    (below.good + {_double(u.WEIGHT)} * below.purity)
      / (below.good + below.bad + {_double(u.WEIGHT)}) AS purity,
    below.size
  FROM live{d} live JOIN tokens{d} USING (host, node, s)
  JOIN classes{d} USING (host, node, token) JOIN below{d} below USING (host, node, class)
)"""


def oracle(rules: Sequence[u.Rule], depth: int) -> str:
    """No path of the tables may have more than ``depth`` segments."""
    done = "\nUNION ALL ".join(
        f"SELECT host, path, purity, CASE WHEN len(seg) > {d} THEN node || '/**' ELSE node END"
        f" AS template FROM state{d} WHERE NOT (len(seg) > {d} AND size >= {u.SPLIT})"
        for d in range(depth + 1)
    )
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://')
    THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
urls AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{u.UPPER}', '{u.LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
),{_rules(rules)},
paths AS (
  SELECT DISTINCT host, path, decided AS label FROM urls LEFT JOIN fits USING (host, path)
),
roots AS (
  SELECT host, count(*) AS size, count(*) FILTER (label = 'allow') AS good,
    count(*) FILTER (label = 'block') AS bad FROM paths GROUP BY host
),
whole AS (SELECT (sum(good) + 1) / CAST(sum(good + bad) + 2 AS DOUBLE) AS base FROM roots),
state0 AS (
  SELECT host, path, label, string_split(path, '/')[2:] AS seg, '' AS node,
    (good + {_double(u.WEIGHT)} * base) / (good + bad + {_double(u.WEIGHT)}) AS purity, size
  FROM paths JOIN roots USING (host), whole
),{",".join(map(_level, range(depth)))},
done AS ({done})
SELECT page_id, host, path, rule,
  coalesce(decided, CASE WHEN purity < {_double(u.PURITY)} THEN 'block' ELSE 'allow' END)
    AS verdict, template, purity
FROM urls JOIN done USING (host, path) LEFT JOIN fits USING (host, path)
"""
