"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from __future__ import annotations

from collections.abc import Sequence

from docloom.llm import quality_rules, secret_scan
from docloom.llm.common import LOWER, UPPER

WORDS = r"[^\x20\x09-\x0D]+"


def _components(nodes: str, links: str) -> str:
    """CTE ``root`` (id, component_id) over CTEs of ids and of links (a, b) in both directions."""
    return f"""
  reach(id, root) AS (SELECT id, id FROM {nodes}
                      UNION SELECT l.b, r.root FROM reach r JOIN {links} l ON l.a = r.id WHERE r.root < l.b),
  root AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)"""


EMBEDDINGS = f"""WITH RECURSIVE
  raw AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings),
  good AS (SELECT id, v FROM raw WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND list_max(list_transform(v, lambda x: abs(x))) > 0),
  link AS (SELECT x.id AS a, y.id AS b FROM good x JOIN good y ON x.id <> y.id AND len(x.v) = len(y.v)
           WHERE list_cosine_similarity(x.v, y.v) >= 0.9),
  {_components('raw', 'link')}
  SELECT id AS vec_id, (SELECT count(*) FROM link WHERE a = id) AS n_links, component_id, id = component_id AS kept FROM root"""


def ngram_join(n: int, num: int, den: int) -> str:
    return f"""WITH RECURSIVE
  w AS (SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORDS}') AS w FROM documents),
  s AS (SELECT DISTINCT id, unnest(list_transform(range(1, greatest(len(w) - {n - 1}, 1) + 1),
               lambda i: array_to_string(w[i : i + {n - 1}], ' '))) AS s FROM w WHERE len(w) > 0),
  size AS (SELECT id, count(*) AS n FROM s GROUP BY id),
  shared AS (SELECT a.id AS a, b.id AS b, count(*) AS o FROM s a JOIN s b ON a.s = b.s AND a.id < b.id GROUP BY ALL),
  one AS (SELECT a, b FROM shared JOIN size x ON x.id = a JOIN size y ON y.id = b WHERE {den} * o >= {num} * (x.n + y.n - o)),
  link AS (SELECT a, b FROM one UNION ALL SELECT b, a FROM one),
  {_components('w', 'link')}
  SELECT id AS doc_id, coalesce(n, 0) AS n_shingles, component_id FROM root LEFT JOIN size USING (id)"""


def _shift(value: str) -> str:
    return f"greatest(length(bin({value})) - 7, 0)"


def quality() -> str:
    pairs = ", ".join(f"{{'ratio': '{r}', 'c': {above}, 'd': greatest({below}, 1)}}" for r, (above, below, _) in quality_rules.RATIOS.items())
    sizes = " + ".join(f"(len(w) >= {n})::INT" for n in quality_rules.SIZES)
    noise = quality_rules.REACH * 1000
    inside = []
    for r, (_, _, low) in quality_rules.RATIOS.items():
        inside.append(f"(r.ratio <> '{r}' OR (c * 1000 <= (q3 + far) * d + {noise}" + (f" AND c * 1000 >= (q1 - far) * d - {noise}" if low else "") + "))")
    within = " AND ".join(inside)
    names = ("own", "c", "g")
    pick = {
        q: "CASE " + " ".join(f"WHEN {t}.n >= {quality_rules.LEAST} THEN {t}.{q}" for t in names) + " END" for q in ("q1", "q3")
    }
    spread = "CASE " + " ".join(f"WHEN {t}.n >= {quality_rules.LEAST} AND {t}.spread > 0 THEN {t}.spread" for t in names) + " ELSE 0 END"
    level = f"""SELECT * EXCLUDE (b3), b3 + (1 << {_shift('b3')}) - 1 AS q3, q3 - q1 AS spread
                FROM (SELECT {{keys}}, size, ratio, count(*) AS n, list_sort(list(bucket))[ceil(count(*) / 4.0)::INT] AS q1,
                             list_sort(list(bucket))[ceil(count(*) * 3 / 4.0)::INT] AS b3 FROM bucketed GROUP BY ALL)"""
    return f"""WITH
  w AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORDS}')) AS lines FROM documents),
  win AS (SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) > 4)),
  twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
  covered AS (SELECT doc_id, count(DISTINCT p) AS c FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id),
  m AS (SELECT doc_id, lang, source, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
               len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
               coalesce(c, 0) AS n_repeat_words, len(lines) AS n_lines, {sizes} AS size FROM w LEFT JOIN covered USING (doc_id)),
  ratios AS (SELECT doc_id, lang, source, n_words, size, unnest([{pairs}], recursive := true) FROM m),
  valued AS (SELECT *, c * 1000 // d AS v FROM ratios WHERE n_words > 0),
  bucketed AS (SELECT lang, source, size, ratio, (v >> {_shift('v')}) << {_shift('v')} AS bucket FROM valued),
  own AS ({level.format(keys='lang, source')}), coarse AS ({level.format(keys='lang')}), world AS ({level.format(keys="''")}),
  fence AS (SELECT own.lang, own.source, own.size, own.ratio, {pick['q1']} AS q1, {pick['q3']} AS q3, {quality_rules.REACH} * ({spread}) AS far
      FROM own JOIN coarse c ON c.lang IS NOT DISTINCT FROM own.lang AND c.size = own.size AND c.ratio = own.ratio
      JOIN world g ON g.size = own.size AND g.ratio = own.ratio),
  verdict AS (SELECT doc_id, bool_and(f.q1 IS NULL OR ({within})) AS good
              FROM ratios r LEFT JOIN fence f ON f.ratio = r.ratio AND f.size = r.size AND f.lang IS NOT DISTINCT FROM r.lang AND f.source IS NOT DISTINCT FROM r.source
              GROUP BY doc_id),
  failed AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND good AS kept
  FROM failed JOIN verdict USING (doc_id)"""


def secrets(rules: Sequence[secret_scan.Rule], base: int) -> str:
    parts = []
    for order, rule in enumerate(rules):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""
    SELECT doc_id, {order} AS ord, '{rule.kind}' AS kind, pos AS s, pos + length(m[i]) AS e FROM (
      SELECT doc_id, m, g, i, list_sum(list_transform(p[1 : i], lambda x: length(x)))
             + coalesce(list_sum(list_transform(m[1 : i - 1], lambda x: length(x))), 0) AS pos
      FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
        SELECT doc_id, regexp_extract_all(text, '{pattern}', 0) AS m, regexp_extract_all(text, '{pattern}', {rule.group}) AS g,
               string_split_regex(text, '{pattern}') AS p FROM documents WHERE regexp_matches(text, '{pattern}'))))
    WHERE length(g[i]) >= {rule.least}""")
    text = "kind || ':' || s || ':' || e"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in rules[:base])
    return f"""WITH found AS ({' UNION ALL '.join(parts)})
  SELECT d.doc_id, {counts},
         sha256(coalesce(string_agg({text}, ',' ORDER BY s, ord) FILTER (WHERE ord < {base}), '')) AS base_sha256,
         coalesce(string_agg({text}, ',' ORDER BY s, ord), '') AS spans
  FROM documents d LEFT JOIN found USING (doc_id) GROUP BY d.doc_id"""
