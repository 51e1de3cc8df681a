"""DuckDB SQL that returns the rows of the registered queries, where SQL can."""

from __future__ import annotations

from . import line_dedup
from .queries import URL_LABELS, URL_RULES

_P = line_dedup._P
_MOD = (1 << 31) - 1


def _rolled(window: int) -> str:
    return " + ".join(
        f"(coalesce(lag(h, {k}) OVER w, 0) * {pow(_P, k + 1, 1 << 31)}) % {_MOD}" for k in range(window))


OP1 = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, w[i:i + 19] AS g FROM
  (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM doc)),
later AS (SELECT doc_id, i FROM
  (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM later),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS j FROM doc),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY j) AS kept, count(*) AS n
  FROM word ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256 FROM doc LEFT JOIN kept USING (doc_id)
"""

OP2 = f"""
WITH doc AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
line AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS n FROM doc WHERE text IS NOT NULL),
hashed AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM line),
ended AS (SELECT *, ({_rolled(line_dedup.WINDOW)}) % {_MOD} % {line_dedup.MODULUS} = 0 AS ends
          FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY n)),
numbered AS (SELECT *, coalesce(sum(ends::INT) OVER
  (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM ended),
chunk AS (SELECT doc_id, c, string_agg(line, chr(10) ORDER BY n) AS chunk, count(*) AS k
          FROM numbered GROUP BY doc_id, c),
gone AS (SELECT doc_id, c, k > 1 AND row_number() OVER (PARTITION BY chunk, k ORDER BY doc_id, c) > 1 AS gone FROM chunk),
kept AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
  coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '') AS kept
  FROM numbered JOIN gone USING (doc_id, c) GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(kept) AS kept_sha256 FROM documents LEFT JOIN kept USING (doc_id)
"""

_WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

OP4 = f"""
WITH item AS (SELECT item_id::VARCHAR AS item_id, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 10) AS k FROM item WHERE len(w) > 0),
gram AS (SELECT DISTINCT item_id, k, w[i:i + k - 1] AS gram
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM sized)),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, k, w[i:i + k - 1] AS gram FROM
  (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
   FROM doc, (SELECT DISTINCT k FROM gram))),
hit AS (SELECT doc_id, item_id, i, k FROM win JOIN gram USING (k, gram)),
word AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM
  (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _fits(host: str, path: str) -> str:
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}'))"


_BY_LENGTH = sorted(URL_RULES, key=lambda r: -len(r[0] + r[1]))
_RULE = " ".join(f"WHEN {_fits(h, p)} THEN '{h}{p}'" for h, p, _ in _BY_LENGTH)
_VERDICT = " ".join(f"WHEN {_fits(h, p)} THEN '{v}'" for h, p, v in _BY_LENGTH)
_LABEL = " OR ".join(f"list_contains(string_split(host, '.'), '{x}')" for x in URL_LABELS)

OP8 = f"""
WITH rest AS (SELECT page_id, CASE WHEN position('://' IN url) > 0
  THEN substr(url, position('://' IN url) + 3) ELSE '' END AS r FROM pages),
site AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest)
SELECT page_id, host, path, CASE {_RULE} END AS rule,
  CASE {_VERDICT} WHEN {_LABEL} THEN 'block' ELSE 'allow' END AS verdict FROM site
"""

OP11 = r"""
WITH doc AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
num AS (SELECT doc_id, t, u, len(u) + 1 AS places, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
  ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM doc),
cut AS (SELECT doc_id, t, u, least(h1 % places, h2 % places) AS a, greatest(h1 % places, h2 % places) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
       WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM num),
part AS (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
  coalesce(array_to_string(u[b + 1:], ''), '') AS s FROM cut)
SELECT doc_id, len(u)::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM part
"""

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

OP13 = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
item AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)),
word AS (SELECT q, unnest(w) AS x FROM item),
total AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_all FROM doc WHERE len(w) > 0),
held AS (SELECT r, x, count(*) AS tf FROM (SELECT r, unnest(w) AS x FROM doc)
         WHERE x IN (SELECT x FROM word) GROUP BY r, x),
weight AS (SELECT x, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
           FROM (SELECT x, count(*) AS df FROM held GROUP BY x), total),
size AS (SELECT r, doc_id, 100 - 25 + (25 * len(w)::BIGINT * n_docs) // n_all AS m FROM doc, total WHERE len(w) > 0),
worth AS (SELECT r, doc_id, x, w * ((1000000000 * tf) // (1000 * tf + 12 * m)) AS v
          FROM held JOIN weight USING (x) JOIN size USING (r)),
scored AS (SELECT q, r, any_value(doc_id) AS doc_id, sum(v)::BIGINT AS score FROM word JOIN worth USING (x) GROUP BY q, r),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id ASC NULLS FIRST) AS rank
           FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked JOIN item USING (q) WHERE rank <= 20
"""

ORACLE_SQL = {"op1_substring": OP1, "op2_line_dedup": OP2, "op4_decontam": OP4, "op8_url_filter": OP8,
              "op11_fim": OP11, "op13_search": OP13}
