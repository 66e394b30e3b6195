"""SQL for the rows of the manifest, the vector codes and the URL filters, for small tables."""

from __future__ import annotations

ENTRIES, ROUNDS, PARTS = 16, 6, 8


def framed(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || {value} END"


def leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(framed(v) for v in ("doc_id", "source", "lang", n_chars, "text")) + ")"


# crc32, byte by byte: eight steps of its polynomial for each digit of an id.
CRC = """
crc AS (
  SELECT doc_id, 0 AS i, CAST(4294967295 AS BIGINT) AS c FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL
  SELECT doc_id, i + 1, list_reduce(list_prepend(xor(c, CAST(ascii(CAST(doc_id AS VARCHAR)[i + 1]) AS BIGINT)), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)
  FROM crc WHERE i < length(CAST(doc_id AS VARCHAR))),
tampered AS (SELECT doc_id FROM crc WHERE i = length(CAST(doc_id AS VARCHAR)) AND xor(c, 4294967295) % 7 = 0)"""


def tree(name: str, start: str) -> str:
    """All nodes (grp, level, pos, n, h) of the trees whose leaves (grp, pos, h) are ``start``."""
    return f"""{name} AS (
  SELECT grp, 0 AS level, pos, count(*) OVER (PARTITION BY grp) AS n, h FROM ({start})
  UNION ALL
  SELECT grp, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM {name} WHERE n > 1
  GROUP BY grp, level, n, pos // 2)"""


MANIFEST = f"""
WITH RECURSIVE {CRC},
leaves AS (
  SELECT doc_id, lang AS grp, {leaf("n_chars")} AS leaf, {leaf("(n_chars + 1)")} AS forged,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id, {leaf("n_chars")}) - 1 AS pos FROM documents),
{tree("lower_tree", "SELECT grp, pos, leaf AS h FROM leaves")},
subroots AS (SELECT grp, h AS subroot, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS pos FROM lower_tree WHERE n = 1),
{tree("upper_tree", "SELECT 0 AS grp, pos, subroot AS h FROM subroots")},
top AS (SELECT h AS root, level AS height FROM upper_tree WHERE n = 1),
heights AS (SELECT grp, level AS height FROM lower_tree WHERE n = 1),
steps AS (
  SELECT l.doc_id, l.grp, l.pos AS leaf_pos, t.level, (l.pos >> t.level) % 2 AS side, s.h AS sibling
  FROM leaves l JOIN lower_tree t ON t.grp IS NOT DISTINCT FROM l.grp AND t.pos = l.pos >> t.level AND t.n > 1
  LEFT JOIN lower_tree s ON s.grp IS NOT DISTINCT FROM l.grp AND s.level = t.level AND s.pos = xor(t.pos, 1)
  UNION ALL
  SELECT l.doc_id, l.grp, l.pos, h.height + t.level, (r.pos >> t.level) % 2, s.h
  FROM leaves l JOIN subroots r ON r.grp IS NOT DISTINCT FROM l.grp JOIN heights h ON h.grp IS NOT DISTINCT FROM l.grp
  JOIN upper_tree t ON t.pos = r.pos >> t.level AND t.n > 1
  LEFT JOIN upper_tree s ON s.level = t.level AND s.pos = xor(t.pos, 1)),
paths AS (
  SELECT grp, leaf_pos, string_agg(coalesce(sibling, ''), '' ORDER BY level) AS siblings,
         list({{'side': side, 'h': coalesce(sibling, '')}} ORDER BY level) AS path FROM steps GROUP BY grp, leaf_pos),
found AS (
  SELECT l.doc_id, l.leaf, r.subroot, top.root, sha256(coalesce(p.siblings, '')) AS proof_sha256, coalesce(p.path, []) AS path,
         CASE WHEN l.doc_id IN (SELECT doc_id FROM tampered) THEN coalesce(l.forged, l.leaf) ELSE l.leaf END AS at_hand, l.grp, l.pos
  FROM leaves l JOIN subroots r ON r.grp IS NOT DISTINCT FROM l.grp CROSS JOIN top
  LEFT JOIN paths p ON p.grp IS NOT DISTINCT FROM l.grp AND p.leaf_pos = l.pos),
folding AS (
  SELECT grp, pos, 0 AS level, at_hand AS h, path FROM found
  UNION ALL
  SELECT grp, pos, level + 1, sha256(CASE WHEN path[level + 1].side = 1 THEN path[level + 1].h || h ELSE h || path[level + 1].h END), path
  FROM folding WHERE level < len(path))
SELECT f.doc_id, f.grp AS lang, f.leaf, f.subroot, f.root, f.proof_sha256, g.h AS folded_root, g.h = f.root AS verified
FROM found f JOIN folding g ON g.grp IS NOT DISTINCT FROM f.grp AND g.pos = f.pos AND g.level = len(f.path)"""


def _round(step: int) -> str:
    """Entries by the mean of their parts, and the parts assigned to the new entries."""
    near = f"""a{step} AS MATERIALIZED (
  SELECT vec_id, label, p, x, arg_min(j, d * {ENTRIES} + j) AS j, min(d) AS d FROM (
    SELECT vec_id, label, b.p, v.x, j, list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM parts v JOIN book{step} b ON v.p = b.p) GROUP BY ALL)"""
    if not step:
        return near
    return f"""book{step} AS MATERIALIZED (
  SELECT b.p, b.j, coalesce(m.x, b.x) AS x FROM book{step - 1} b LEFT JOIN (
    SELECT p, j, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS x FROM (
      SELECT p, j, i, sum(v) AS s, count(*) AS n FROM (
        SELECT p, j, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM a{step - 1}) GROUP BY p, j, i)
    GROUP BY p, j) m ON m.p = b.p AND m.j = b.j),
{near}"""


VECTOR_CODES = f"""
WITH whole AS (
  SELECT vec_id, label, list_transform(embedding, lambda e: CAST(floor(CAST(e AS DOUBLE) * 4096) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, label, p, x[p * len(x) // {PARTS} + 1:(p + 1) * len(x) // {PARTS}] AS x
  FROM whole CROSS JOIN (SELECT unnest(range({PARTS})) AS p)),
book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS j, x FROM parts
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= {ENTRIES}),
{", ".join(_round(step) for step in range(ROUNDS + 1))},
codes AS (
  SELECT vec_id, label, string_agg(printf('%02x', j), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{ROUNDS} GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, j)) FROM book{ROUNDS}) AS codebooks_sha256, label
FROM codes"""

URL_FILTER = """
WITH parts AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
judged AS (
  SELECT *, CASE WHEN '.' || host LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                 WHEN '.' || host LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
                 WHEN '.' || host LIKE '%.org' AND starts_with(path, '/') THEN 'org/'
                 WHEN '.' || host LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
                 WHEN '.' || host LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/' END AS rule,
         CASE WHEN '.' || host LIKE '%.spam-farm.%' THEN '*.spam-farm.**' WHEN path LIKE '%/wp-login.php%' THEN '**/wp-login.php**'
              WHEN '.' || host LIKE '%.free-bets.%' THEN '*.free-bets.**' WHEN '.' || host LIKE '%.casino-%' THEN '*.casino-**'
              WHEN path LIKE '%/cgi-bin/%' THEN '**/cgi-bin/**' WHEN '.' || host LIKE '%.poker-%' THEN '*.poker-**'
              WHEN '.' || host LIKE '%.xxx.%' THEN '*.xxx.**' WHEN path LIKE '%.exe' THEN '**.exe' WHEN path LIKE '%.zip' THEN '**.zip'
              WHEN path LIKE '%.iso' THEN '**.iso' WHEN path LIKE '%.apk' THEN '**.apk' END AS pattern FROM parts)
SELECT page_id, host, path, rule, pattern,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict FROM judged"""
