"""Small pieces of SQL that repeat in the queries' oracles."""

from __future__ import annotations

from collections.abc import Sequence


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def any_of(text: str, words: Sequence[str]) -> str:
    """Whether ``text`` holds any of ``words``, whatever the case."""
    return "(" + " OR ".join(f"contains(lower(coalesce({text}, '')), {quoted(w.lower())})" for w in words) + ")" if words else "false"


def count_of(text: str, words: Sequence[str]) -> str:
    """How many of ``words`` it holds."""
    return "(" + " + ".join(f"CASE WHEN contains(lower(coalesce({text}, '')), {quoted(w.lower())}) THEN 1 ELSE 0 END" for w in words) + ")" if words else "0"


def list_of(text: str, words: Sequence[str]) -> str:
    """Which of ``words`` it holds, in their order."""
    return "list_filter([" + ", ".join(map(quoted, words)) + f"], lambda k: contains(lower(coalesce({text}, '')), lower(k)))"


def matches(text: str, patterns: Sequence[str]) -> str:
    return "regexp_matches(" + text + ", " + quoted("|".join(f"(?:{p})" for p in patterns)) + ")" if patterns else "false"


def first_alike(facts: str, ratio: float = 0.85) -> str:
    """For each distinct text of ``facts`` (id, batch, text) the first id of its batch with that text or one whose matching
    blocks cover more than ``ratio`` of both; the recursion splits texts at their longest common block."""
    seg = "a, b, ilo, ihi, jlo, jhi"
    return f"""WITH RECURSIVE texts AS MATERIALIZED (SELECT batch, text, min(id) AS id, length(text) AS n FROM ({facts}) WHERE text <> '' GROUP BY ALL),
chars AS MATERIALIZED (SELECT id, batch, n, unnest(range(n)) AS pos, unnest(regexp_extract_all(text, '(?s).')) AS ch FROM texts),
counts AS MATERIALIZED (SELECT id, batch, n, ch, count(*) AS c FROM chars GROUP BY ALL),
grams AS MATERIALIZED (SELECT id, g, count(*) AS c FROM (SELECT id, ch || lead(ch) OVER w || lead(ch, 2) OVER w AS g FROM chars WINDOW w AS (PARTITION BY id ORDER BY pos)) WHERE g IS NOT NULL GROUP BY ALL),
close AS MATERIALIZED (SELECT x.id AS a, y.id AS b, x.n AS na, y.n AS nb FROM counts x JOIN counts y ON x.batch = y.batch AND x.ch = y.ch AND x.id < y.id AND 2 * least(x.n, y.n) > {ratio} * (x.n + y.n) GROUP BY ALL HAVING 2 * sum(least(x.c, y.c)) > {ratio} * (x.n + y.n)),
near AS MATERIALIZED (SELECT a, b, na, nb FROM close LEFT JOIN (SELECT a, b, sum(least(x.c, y.c)) AS met FROM close JOIN grams x ON x.id = a JOIN grams y ON y.id = b AND y.g = x.g GROUP BY ALL) USING (a, b) WHERE coalesce(met, 0) > {2.5 * ratio - 2} * (na + nb) - 2.001),
cells AS MATERIALIZED (SELECT a, b, y.pos AS i, x.pos AS j, y.pos - x.pos AS d, na >= 200 AND c > na // 100 + 1 AS pop FROM near JOIN chars x ON x.id = a JOIN chars y ON y.id = b AND y.ch = x.ch JOIN counts k ON k.id = a AND k.ch = x.ch),
blocks AS (SELECT a, b, CAST(0 AS BIGINT) AS ilo, nb AS ihi, CAST(0 AS BIGINT) AS jlo, na AS jhi, CAST(0 AS HUGEINT) AS m FROM near
 UNION ALL SELECT a, b, unnest([ilo, r.s + r.k]), unnest([r.s, ihi]), unnest([jlo, r.s - r.d + r.k]), unnest([r.s - r.d, jhi]), unnest([r.k, 0]) FROM (
  SELECT {seg}, min_by({{'s': s, 'd': d, 'k': k}}, {{'l': coalesce(best.l, 0), 'i': coalesce(best.i, s), 'd': -d}}) AS r FROM (
   SELECT {seg}, d, isle, min(i) AS s, CAST(sum(l) AS BIGINT) AS k, min({{'l': -l, 'i': i}}) FILTER (NOT pop) AS best FROM (
    SELECT {seg}, d, isle, pop, sub, min(i) AS i, count(*) AS l FROM (
     SELECT {seg}, i, d, pop, i - row_number() OVER (PARTITION BY {seg}, d ORDER BY i) AS isle, i - row_number() OVER (PARTITION BY {seg}, d, pop ORDER BY i) AS sub
     FROM blocks JOIN cells USING (a, b) WHERE i >= ilo AND i < ihi AND j >= jlo AND j < jhi) GROUP BY ALL) GROUP BY ALL)
  WHERE best IS NOT NULL OR s = ilo AND s - d = jlo GROUP BY ALL)),
alike AS MATERIALIZED (SELECT b, min(a) AS earlier FROM (SELECT a, b, na, nb FROM blocks JOIN near USING (a, b) GROUP BY ALL HAVING 2.0 * sum(m) / (na + nb) > {ratio}) GROUP BY b)
SELECT batch, text, least(id, coalesce(earlier, id)) AS first_alike FROM texts LEFT JOIN alike ON b = id"""
