"""DuckDB oracle SQL, one statement per registered query.

Written independently of the Spark operators: plain SQL over the same fixture
views (prefixed as CTEs by ``fixtures.with_fixtures``). Column names equal the
Spark query's output names.
"""

from __future__ import annotations

from ..functions import prompt as P
from .fixtures import with_fixtures

# Python-like strip and PMID normalisation for DuckDB (RE2).
WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def norm(x: str) -> str:
    return f"regexp_replace({strip(x)}, '^[Pp][Mm][Ii][Dd]:', '')"


VALID = "error IS NULL AND abstract IS NOT NULL AND abstract <> ''"

ORACLE: dict[str, str] = {}

ORACLE["normalize_pmid"] = f"""
WITH v AS (
  SELECT CASE WHEN line_id % 4 = 0 THEN PMID
              WHEN line_id % 4 = 1 THEN ' ' || lower(PMID) || chr(9)
              WHEN line_id % 4 = 2 THEN substr(PMID, 6)
              ELSE 'PmId: ' || substr(PMID, 6) END AS raw
  FROM fx_triples)
SELECT {norm('raw')} AS bare_pmid, count(*) AS n_rows FROM v GROUP BY 1
"""

ORACLE["triple_reader"] = f"""
SELECT {strip("CASE WHEN line_id % 7 = 0 THEN '  ' || subject_curie || ' ' ELSE subject_curie END")}
         AS subject_curie,
       predicate, object_curie, PMID,
       CASE WHEN line_id % 3 = 0 THEN 'True' ELSE 'False' END AS ground_truth,
       CAST(line_id AS VARCHAR) AS line_id
FROM fx_triples WHERE line_id % 50 <> 0
"""

ORACLE["abstract_split"] = f"""
SELECT t.subject_curie, t.predicate, t.object_curie, t.PMID, t.line_id,
       {norm('t.PMID')} AS bare_pmid,
       coalesce(a.error IS NULL AND a.abstract IS NOT NULL AND a.abstract <> '', false)
         AS has_abstract,
       CASE WHEN a.bare_pmid IS NULL THEN 'PMID not found in results'
            WHEN a.error IS NOT NULL AND a.error <> '' THEN 'Error: ' || a.error
            WHEN {strip("coalesce(a.abstract, '')")} = '' THEN 'No abstract available'
            ELSE 'valid' END AS status
FROM fx_triples t LEFT JOIN fx_store a ON a.bare_pmid = {norm('t.PMID')}
"""

ORACLE["resume_pending"] = f"""
WITH done AS (
  SELECT d.subject_curie, d.predicate, d.object_curie, d.PMID
  FROM fx_triples d JOIN fx_store a ON a.bare_pmid = {norm('d.PMID')}
  WHERE a.{VALID.replace(' AND ', ' AND a.')})
SELECT * FROM fx_triples t
WHERE NOT EXISTS (SELECT 1 FROM done d
                  WHERE d.subject_curie = t.subject_curie AND d.predicate = t.predicate
                    AND d.object_curie = t.object_curie AND d.PMID = t.PMID)
"""

ORACLE["coverage_audit"] = f"""
WITH ok AS (SELECT DISTINCT bare_pmid FROM fx_store WHERE {VALID}),
flagged AS (
  SELECT t.subject_curie, t.predicate, t.object_curie, t.PMID, ok.bare_pmid IS NOT NULL AS has
  FROM fx_triples t LEFT JOIN ok ON ok.bare_pmid = {norm('t.PMID')}),
inp AS (SELECT DISTINCT subject_curie, predicate, object_curie, PMID FROM fx_triples),
res AS (SELECT DISTINCT subject_curie, predicate, object_curie, PMID FROM flagged WHERE has),
na AS (SELECT DISTINCT subject_curie, predicate, object_curie, PMID FROM flagged WHERE NOT has),
comb AS (SELECT * FROM res UNION SELECT * FROM na),
c AS (
  SELECT (SELECT count(*) FROM fx_triples) AS input_rows,
         (SELECT count(*) FROM inp) AS input_unique,
         (SELECT count(*) FROM flagged WHERE has) AS results_rows,
         (SELECT count(*) FROM res) AS results_unique,
         (SELECT count(*) FROM flagged WHERE NOT has) AS no_abstract_rows,
         (SELECT count(*) FROM na) AS no_abstract_unique,
         (SELECT count(*) FROM (SELECT * FROM res INTERSECT SELECT * FROM na) x) AS overlap,
         (SELECT count(*) FROM comb) AS combined_unique,
         (SELECT count(*) FROM (SELECT * FROM comb EXCEPT SELECT * FROM inp) x)
           AS in_results_not_input,
         (SELECT count(*) FROM (SELECT * FROM inp EXCEPT SELECT * FROM comb) x)
           AS in_input_not_results,
         (SELECT count(*) FROM (SELECT * FROM inp INTERSECT SELECT * FROM comb) x) AS matched)
SELECT input_rows, input_unique, input_rows - input_unique AS input_duplicates,
       results_rows, results_unique, results_rows - results_unique AS results_duplicates,
       no_abstract_rows, no_abstract_unique,
       no_abstract_rows - no_abstract_unique AS no_abstract_duplicates,
       overlap, combined_unique, in_results_not_input, in_input_not_results, matched,
       coalesce(round(matched * 100.0 / nullif(input_unique, 0), 4), 0.0) AS coverage_pct,
       in_results_not_input = 0 AND in_input_not_results = 0 AND overlap = 0 AS perfect
FROM c
"""

ORACLE["store_upsert"] = """
SELECT * FROM fx_store WHERE bare_pmid NOT IN (SELECT bare_pmid FROM fx_store_batch)
UNION ALL
SELECT * FROM fx_store_batch
"""

ORACLE["store_failed"] = f"""
SELECT bare_pmid,
       CASE WHEN error IS NOT NULL AND error <> '' THEN error
            ELSE 'No abstract available' END AS error,
       title
FROM fx_store
WHERE (error IS NOT NULL OR abstract IS NULL OR abstract = '')
  AND ((error IS NOT NULL AND error <> '') OR {strip("coalesce(abstract, '')")} = '')
"""

ORACLE["store_missing"] = f"""
WITH w AS (SELECT DISTINCT {norm('PMID')} AS bare_pmid FROM fx_triples
           WHERE PMID IS NOT NULL AND {strip('PMID')} <> '')
SELECT w.bare_pmid,
       NOT EXISTS (SELECT 1 FROM fx_store s WHERE s.bare_pmid = w.bare_pmid) AS never_stored
FROM w
WHERE w.bare_pmid NOT IN (SELECT bare_pmid FROM fx_store WHERE {VALID})
"""

ORACLE["store_retry"] = f"""
WITH ids AS (SELECT bare_pmid FROM fx_store
             WHERE error LIKE 'Extraction failed:%'
                OR error LIKE 'PMID not found or could not be retrieved'),
fetched AS (SELECT * FROM fx_store_batch WHERE bare_pmid IN (SELECT bare_pmid FROM ids)),
unseen AS (SELECT bare_pmid, '' AS title, '' AS abstract, '2024-02-01T00:00:00' AS fetch_date,
                  'PMID not found or could not be retrieved' AS error
           FROM ids WHERE bare_pmid NOT IN (SELECT bare_pmid FROM fetched)),
after AS (SELECT * FROM fx_store WHERE bare_pmid NOT IN (SELECT bare_pmid FROM ids)
          UNION ALL SELECT * FROM fetched UNION ALL SELECT * FROM unseen),
c AS (SELECT (SELECT count(*) FROM ids) AS retried,
             (SELECT count(*) FROM ids WHERE bare_pmid IN
                 (SELECT bare_pmid FROM after WHERE {VALID})) AS successful)
SELECT retried, successful, retried - successful AS still_failed,
       (SELECT count(*) FROM after WHERE error IS NULL) AS cache_size,
       (SELECT count(*) FROM after) AS store_rows
FROM c
"""


def oracle_sql() -> dict[str, str]:
    return {name: with_fixtures(sql) for name, sql in ORACLE.items()}


def _bin(x: str, t=("true", "yes"), f=("false", "no")) -> str:
    tl = ", ".join(f"'{w}'" for w in t)
    fl = ", ".join(f"'{w}'" for w in f)
    v = f"lower({strip(x)})"
    return f"CASE WHEN {v} IN ({tl}) THEN 1 WHEN {v} IN ({fl}) THEN 0 END"


def _div(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0.0)"


IN_PRICE, CACHED_PRICE, OUT_PRICE = (repr(x / 1_000_000) for x in (0.05, 0.025, 0.15))

_CONFUSION = f"""
b AS (SELECT {_bin('ground_truth')} AS y, {_bin('predicted')} AS p FROM fx_labels),
c AS (SELECT count(*) AS total_samples,
             count(*) FILTER (WHERE y IS NOT NULL AND p IS NOT NULL) AS n,
             count(*) FILTER (WHERE y = 0 AND p = 0) AS tn,
             count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
             count(*) FILTER (WHERE y = 1 AND p = 0) AS fn,
             count(*) FILTER (WHERE y = 1 AND p = 1) AS tp
      FROM b)
"""

ORACLE["class_metrics"] = f"""
WITH {_CONFUSION},
d AS (SELECT *, {_div('tp', 'tp + fp')} AS pr, {_div('tp', 'tp + fn')} AS rc,
             {_div('tn', 'tn + fp')} AS sp FROM c)
SELECT {_div('tp + tn', 'n')} AS accuracy,
       {_div('2 * tp', '2 * tp + fp + fn')} AS f1_score,
       pr AS precision, rc AS recall, sp AS specificity,
       CASE WHEN tp + fn > 0 AND tn + fp > 0 THEN (rc + sp) / 2 END AS auroc,
       CASE WHEN tp + fn > 0 THEN pr * rc + (1 - rc) * {_div('tp + fn', 'n')}
            ELSE 0.0 END AS auprc,
       total_samples, n AS valid_predictions, total_samples - n AS unknown_predictions,
       tn, fp, fn, tp, tp + fn AS positives, tn + fp AS negatives
FROM d
"""

ORACLE["class_report"] = f"""
WITH {_CONFUSION},
d AS (SELECT *, {_div('tp', 'tp + fp')} AS p1, {_div('tp', 'tp + fn')} AS r1,
             {_div('tn', 'tn + fn')} AS p0, {_div('tn', 'tn + fp')} AS r0,
             {_div('2 * tp', '2 * tp + fp + fn')} AS f1, {_div('2 * tn', '2 * tn + fn + fp')} AS f0,
             tp + fn AS s1, tn + fp AS s0 FROM c)
SELECT 'Not Supported' AS label, p0 AS precision, r0 AS recall,
       f0 AS f1_score, s0 AS support, {_div('s0 * 100', 'n')} AS share_pct FROM d
UNION ALL
SELECT 'Supported', p1, r1, f1, s1, {_div('s1 * 100', 'n')} FROM d
UNION ALL
SELECT 'accuracy', NULL, NULL, {_div('tp + tn', 'n')}, n, NULL FROM d
UNION ALL
SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n, NULL
FROM d
UNION ALL
SELECT 'weighted avg', {_div('p0 * s0 + p1 * s1', 'n')},
       {_div('r0 * s0 + r1 * s1', 'n')}, {_div('f0 * s0 + f1 * s1', 'n')}, n, NULL
FROM d
"""

ORACLE["timing_summary"] = """
WITH w AS (SELECT (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS wall FROM events),
a AS (SELECT count(runtime_seconds) AS total_rows, sum(runtime_seconds) AS s,
             avg(runtime_seconds) AS m, coalesce(stddev_samp(runtime_seconds), 0.0) AS sd,
             quantile_cont(runtime_seconds, 0.5) AS q50, quantile_cont(runtime_seconds, 0.25) AS q25,
             quantile_cont(runtime_seconds, 0.75) AS q75, quantile_cont(runtime_seconds, 0.95) AS q95,
             min(runtime_seconds) AS lo, max(runtime_seconds) AS hi
      FROM fx_timings)
SELECT total_rows, 24 AS concurrency, round_even(wall, 4) AS wall_total_seconds,
       round_even(coalesce(wall / nullif(total_rows, 0), 0.0), 4) AS wall_avg_per_row_seconds,
       round_even(coalesce(total_rows / nullif(wall, 0), 0.0), 4) AS throughput_rows_per_sec,
       round_even(s, 4) AS sum_seconds, round_even(m, 4) AS mean_seconds,
       round_even(sd, 4) AS std_seconds, round_even(q50, 4) AS median_seconds,
       round_even(lo, 4) AS min_seconds, round_even(hi, 4) AS max_seconds,
       round_even(q25, 4) AS p25_seconds, round_even(q75, 4) AS p75_seconds,
       round_even(q95, 4) AS p95_seconds,
       round_even(m / 24, 4) AS approx_mean_per_row_seconds,
       round_even(sd / 24, 4) AS approx_std_per_row_seconds
FROM a, w
"""

ORACLE["token_stats"] = f"""
WITH t AS (SELECT TRY_CAST(trim(prompt) AS BIGINT) AS prompt,
                  TRY_CAST(trim(completion) AS BIGINT) AS completion,
                  TRY_CAST(trim(total) AS BIGINT) AS total,
                  TRY_CAST(trim(cached) AS BIGINT) AS cached,
                  TRY_CAST(trim(uncached) AS BIGINT) AS uncached FROM fx_tokens),
ok AS (SELECT * FROM t WHERE prompt IS NOT NULL AND completion IS NOT NULL
         AND total IS NOT NULL AND cached IS NOT NULL AND uncached IS NOT NULL),
a AS (SELECT count(*) AS num_requests, avg(prompt) AS avg_prompt, min(prompt) AS min_prompt,
             max(prompt) AS max_prompt, CAST(sum(prompt) AS BIGINT) AS total_prompt,
             avg(completion) AS avg_completion, min(completion) AS min_completion,
             max(completion) AS max_completion, CAST(sum(completion) AS BIGINT) AS total_completion,
             avg(total) AS avg_total, CAST(sum(total) AS BIGINT) AS total_all,
             avg(cached) AS avg_cached, CAST(sum(cached) AS BIGINT) AS total_cached,
             count(*) FILTER (WHERE cached > 0) AS hits,
             avg(uncached) AS avg_uncached, CAST(sum(uncached) AS BIGINT) AS total_uncached
      FROM ok),
c AS (SELECT *, total_uncached * {IN_PRICE} AS unc, total_cached * {CACHED_PRICE} AS cac,
             total_completion * {OUT_PRICE} AS outc FROM a),
d AS (SELECT *, unc + cac + outc AS tc, total_prompt * {IN_PRICE} + outc AS nc FROM c)
SELECT num_requests, avg_prompt AS avg_prompt, min_prompt, max_prompt, total_prompt,
       avg_completion AS avg_completion, min_completion, max_completion,
       total_completion, avg_total AS avg_total, total_all,
       avg_cached AS avg_cached, total_cached,
       coalesce(CAST(hits AS DOUBLE) * 100 / nullif(num_requests, 0), 0.0) AS cache_hit_rate,
       CAST(total_cached AS DOUBLE) * 100 / nullif(total_prompt, 0) AS cached_proportion,
       avg_uncached AS avg_uncached, total_uncached,
       unc AS uncached_input_cost, cac AS cached_input_cost,
       outc AS output_cost, tc AS total_cost,
       nc AS cost_without_cache, nc - tc AS savings,
       coalesce((nc - tc) * 100 / nullif(nc, 0), 0.0) AS savings_percent,
       coalesce(tc / nullif(num_requests, 0), 0.0) AS avg_cost_per_request
FROM d
"""

ORACLE["predicate_closure"] = """
WITH RECURSIVE r(name) AS (
  SELECT name FROM fx_slots WHERE name = 'related to'
  UNION
  SELECT s.name FROM fx_slots s JOIN r ON s.is_a = r.name)
SELECT 'biolink:' || replace(s.name, ' ', '_') AS predicate,
       coalesce(trim(regexp_replace(s.description, '\\s+', ' ', 'g')), '') AS description
FROM fx_slots s WHERE s.name IN (SELECT name FROM r)
"""


ORACLE["edge_extract"] = """
WITH entries AS (
  SELECT subject, predicate, object, PMID, line_id * 4 AS ord, text_a AS s
  FROM fx_edge_rows WHERE has_studies
  UNION ALL
  SELECT subject, predicate, object, PMID, line_id * 4 + 1, text_b FROM fx_edge_rows WHERE has_studies
  UNION ALL
  SELECT subject, predicate, object, PMID, line_id * 4 + 2, text_legacy
  FROM fx_edge_rows WHERE NOT has_studies AND has_legacy),
firsts AS (SELECT subject, predicate, object, PMID, s, min(ord) AS ord
           FROM entries GROUP BY subject, predicate, object, PMID, s),
agg AS (SELECT subject, predicate, object, PMID, string_agg(s, ' | ' ORDER BY ord, s) AS sentences
        FROM firsts GROUP BY subject, predicate, object, PMID),
keys AS (SELECT DISTINCT subject, predicate, object, PMID FROM fx_edge_rows)
SELECT k.subject AS subject_curie, k.predicate, k.object AS object_curie, k.PMID,
       coalesce(a.sentences, '') AS SemMedDB_sentences
FROM keys k LEFT JOIN agg a
  ON a.subject = k.subject AND a.predicate = k.predicate AND a.object = k.object AND a.PMID = k.PMID
"""

ORACLE["unique_curies"] = """
SELECT subject_curie AS curie FROM fx_triples WHERE subject_curie IS NOT NULL
UNION
SELECT object_curie FROM fx_triples WHERE object_curie IS NOT NULL
"""

# Shared CTEs: collected names (O3/F8) and matched entities (J4 with stop line).
NAMES_CTE = """
curies AS (SELECT subject_curie AS curie FROM fx_triples UNION SELECT object_curie FROM fx_triples),
labels AS (SELECT curie, pos, lower(lbl) AS lbl FROM (
    SELECT curie, 0 AS pos, l0 AS lbl FROM fx_answer_rows WHERE answered
    UNION ALL SELECT curie, 1, l1 FROM fx_answer_rows WHERE answered
    UNION ALL SELECT curie, 2, l2 FROM fx_answer_rows WHERE answered
    UNION ALL SELECT curie, 3, l3 FROM fx_answer_rows WHERE answered
    UNION ALL SELECT curie, 4, l4 FROM fx_answer_rows WHERE answered) x
  WHERE lbl IS NOT NULL AND lbl <> ''),
lfirst AS (SELECT curie, lbl, min(pos) AS pos FROM labels GROUP BY curie, lbl),
lnames AS (SELECT curie, string_agg(lbl, '|' ORDER BY pos) AS all_names FROM lfirst GROUP BY curie),
names AS (SELECT c.curie AS curie_id, coalesce(n.all_names, '') AS all_names
          FROM curies c LEFT JOIN lnames n ON n.curie = c.curie)
"""

ENT_CTE = """
targets AS (SELECT subject_curie AS curie FROM fx_triples UNION SELECT object_curie FROM fx_triples),
nodes AS (
  SELECT line, coalesce(id, '') AS id, coalesce(name, '') AS name,
         CASE WHEN starts_with(trim(category), '[')
              THEN coalesce(json_extract_string(category, '$[0]'), '')
              ELSE coalesce(category, '') END AS category,
         coalesce(description, '') AS description, eq1, eq2,
         CASE WHEN an1 IS NOT NULL THEN an1 || '|' || an2
              WHEN coalesce(name, '') <> '' THEN name ELSE '' END AS all_names
  FROM fx_node_rows),
pairs AS (SELECT DISTINCT line, curie, name, category, description, all_names FROM (
    SELECT line, id AS curie, name, category, description, all_names FROM nodes
    UNION ALL SELECT line, eq1, name, category, description, all_names FROM nodes WHERE eq1 IS NOT NULL
    UNION ALL SELECT line, eq2, name, category, description, all_names FROM nodes WHERE eq2 IS NOT NULL
  ) x),
hits AS (SELECT * FROM pairs WHERE curie IN (SELECT curie FROM targets)),
firsts AS (SELECT curie, min(line) AS first FROM hits GROUP BY curie),
stopline AS (SELECT CASE WHEN (SELECT count(*) FROM firsts) = (SELECT count(*) FROM targets)
                         THEN (SELECT max(first) FROM firsts) END AS stop),
kept AS (SELECT h.* FROM hits h, stopline s WHERE s.stop IS NULL OR h.line <= s.stop),
ents AS (SELECT curie, arg_max(name, line) AS name, arg_max(category, line) AS category,
                arg_max(description, line) AS description, arg_max(all_names, line) AS all_names
         FROM kept GROUP BY curie),
merged AS (SELECT e.curie, e.name, e.category, e.description,
                  CASE WHEN n.all_names IS NOT NULL AND n.all_names <> '' THEN n.all_names
                       ELSE e.all_names END AS all_names
           FROM ents e LEFT JOIN names n ON n.curie_id = e.curie)
"""

ORACLE["label_set"] = f"WITH {NAMES_CTE} SELECT * FROM names"

ORACLE["node_match"] = f"WITH {NAMES_CTE}, {ENT_CTE} SELECT * FROM ents"

ORACLE["names_merge"] = f"WITH {NAMES_CTE}, {ENT_CTE} SELECT * FROM merged"

ORACLE["named_triples"] = f"""
WITH {NAMES_CTE}, {ENT_CTE}
SELECT t.subject_curie, coalesce(s.name, '') AS subject_name, t.predicate,
       t.object_curie, coalesce(o.name, '') AS object_name, t.PMID, t.line_id
FROM fx_triples t LEFT JOIN merged s ON s.curie = t.subject_curie
LEFT JOIN merged o ON o.curie = t.object_curie
"""


def lit(s: str) -> str:
    """A SQL string literal holding ``s`` exactly."""
    return "'" + s.replace("'", "''") + "'"


def _section(kind: str, c: str) -> str:
    label = kind.upper()
    nl = "chr(10)"
    names = (f"CASE WHEN {c}.curie IS NOT NULL AND {c}.all_names <> '' THEN {c}.all_names "
             f"ELSE r.{kind}_curie END")
    return f"""('**{label}**: ' || r.{kind}_curie || {nl} ||
  CASE WHEN {c}.curie IS NOT NULL THEN
    (CASE WHEN {c}.name <> '' THEN '  Name: ' || {c}.name || {nl} ELSE '' END) ||
    (CASE WHEN {c}.category <> '' THEN '  Category: ' || {c}.category || {nl} ELSE '' END) ||
    (CASE WHEN {c}.description <> '' THEN '  Description: ' || {c}.description || {nl} ELSE '' END)
  ELSE '' END ||
  {nl} || {lit(f"**{label} EQUIVALENT NAMES** " + P.EQUIVALENT_NAMES_NOTE)} ||
  array_to_string(list_transform(string_split({names}, '|'),
                  lambda x, i: '  ' || CAST(i AS VARCHAR) || '. ' || x || {nl}), ''))"""


_DISP = "replace(regexp_replace(r.predicate, '^biolink:', ''), '_', ' ')"

PROMPT_CTE = f"""
okabs AS (SELECT bare_pmid, abstract FROM fx_store WHERE {VALID}),
rws AS (SELECT t.*, a.abstract FROM fx_triples t JOIN okabs a ON a.bare_pmid = {norm('t.PMID')}),
pdesc AS (
  SELECT r.*, CASE WHEN pe.predicate IS NOT NULL THEN coalesce(pe.description, '')
                   ELSE coalesce(pc.description, '') END AS pd
  FROM rws r
  LEFT JOIN fx_predicates pe ON pe.predicate = r.predicate
  LEFT JOIN fx_predicates pc ON pc.predicate = 'biolink:' || replace(r.predicate, ' ', '_')),
secs AS (
  SELECT r.subject_curie, r.predicate, r.object_curie, r.PMID, r.line_id, r.abstract,
    '''' || r.subject_curie || ''' ' || {_DISP} || ' ''' || r.object_curie || '''' AS st,
    {_section('subject', 's')} AS ss,
    {_section('object', 'o')} AS so,
    CASE WHEN r.pd <> '' THEN '**PREDICATE DEFINITION** (' || {_DISP} || '):' || chr(10)
         || r.pd || chr(10) || chr(10) ELSE '' END AS sp
  FROM pdesc r LEFT JOIN merged s ON s.curie = r.subject_curie
  LEFT JOIN merged o ON o.curie = r.object_curie),
prompts AS (
  SELECT subject_curie, predicate, object_curie, PMID, line_id, abstract,
    {lit(P.PREAMBLE + P.INTRO + "**TRIPLE**: ")} || st || chr(10) || chr(10) || ss || chr(10)
      || so || chr(10) || sp || '**ABSTRACT**:' || chr(10) || abstract || chr(10) || chr(10)
      || {lit(P.MATCHING_RULES + P.INSTRUCTIONS + P.OUTPUT_FORMAT)} AS prompt,
    sha256(st || chr(30) || ss || chr(30) || so || chr(30) || sp || chr(30) || sha256(abstract))
      AS prompt_key
  FROM secs)
"""

ORACLE["prompt_text"] = f"""
WITH {NAMES_CTE}, {ENT_CTE}, {PROMPT_CTE}
SELECT subject_curie, predicate, object_curie, PMID, line_id, prompt_key,
       sha256(prompt) AS prompt_sha, length(prompt) AS prompt_chars,
       length(prompt) AS text_chars
FROM prompts
"""

ORACLE["token_budget"] = f"""
WITH {NAMES_CTE}, {ENT_CTE}, {PROMPT_CTE},
e AS (SELECT *, CAST(floor((length(prompt) + {len(P.SYSTEM_MESSAGE)}) / 4) AS BIGINT) AS est_tokens
      FROM prompts)
SELECT subject_curie, predicate, object_curie, PMID, line_id, est_tokens,
       greatest(512, least(4096, 8192 - est_tokens - 64)) AS max_tokens
FROM e
"""


_QX_RE2 = r'[\\"{}`\[\]]'
_NOTE_ALL = " [Auto-corrected: all supporting sentences failed verification]"
_NOTE_YES = " [Auto-corrected: 'yes' without supporting sentences -> 'maybe']"
_NOTE_CLR = " [Auto-corrected: cleared sentences for non-'yes' result]"
_INVENTED = "Zorblax quintessence modulates the hyperflux"

ANSWER_CTE = f"""
pk AS (SELECT DISTINCT prompt_key, subject_curie, object_curie, abstract
       FROM prompts),
g AS (SELECT prompt_key, abstract,
        (CAST(substr(subject_curie, 6) AS BIGINT) + 3 * CAST(substr(object_curie, 6) AS BIGINT)
         + 7 * length(abstract)) % 11 AS sel,
        (CAST(substr(subject_curie, 6) AS BIGINT) + CAST(substr(object_curie, 6) AS BIGINT)
         + length(abstract)) % 4 AS sel2,
        list_filter(list_transform(string_split(abstract, '.'), lambda s: {strip('s')}),
                    lambda s: s <> '' AND NOT regexp_matches(s, {lit(_QX_RE2)})
                              AND NOT regexp_matches(s, '(?i)true|false|null'))[1] AS q
      FROM pk),
e AS (SELECT *, CASE WHEN q IS NULL AND sel IN (0, 3, 8, 9) THEN 1 ELSE sel END AS f,
             CASE WHEN regexp_matches(q, '^[ -~]+$') THEN upper(q) ELSE q END AS q9 FROM g),
parsed AS (SELECT prompt_key, abstract, sel2, q, f,
  CASE WHEN f IN (0, 3, 4, 7, 9) THEN 'yes' WHEN f = 2 THEN 'maybe' ELSE 'no' END AS support,
  CASE WHEN f IN (0, 3, 8) THEN q WHEN f = 9 THEN q9 WHEN f = 4 THEN {lit(_INVENTED)}
       ELSE '' END AS sentences,
  f IN (0, 1, 2, 3, 4, 9) AS subject_mentioned,
  f IN (0, 2, 7) AS object_mentioned,
  CASE f WHEN 0 THEN 'The abstract states it directly.' WHEN 1 THEN 'No relation is described.'
         WHEN 2 THEN 'Only indirect evidence.' WHEN 3 THEN 'Legacy answer.'
         WHEN 4 THEN 'Manual extraction fallback' WHEN 5 THEN 'Empty response from vLLM'
         WHEN 7 THEN 'Stated but not quoted.' WHEN 8 THEN 'Contradicted.'
         WHEN 9 THEN 'Direct statement.' ELSE '' END AS reasoning,
  CASE f WHEN 6 THEN 'vLLM API error: timeout'
         WHEN 10 THEN '''list'' object has no attribute ''get''' END AS failure
  FROM e),
r1 AS (SELECT prompt_key, abstract, sel2, q,
  CASE WHEN failure IS NOT NULL THEN 'no' WHEN f = 4 THEN 'maybe' ELSE support END AS s1,
  CASE WHEN f = 4 THEN '' ELSE sentences END AS t1,
  subject_mentioned AND failure IS NULL AS sm1,
  object_mentioned AND failure IS NULL AS om1,
  CASE WHEN failure IS NOT NULL THEN 'Evaluation failed: ' || failure
       WHEN f = 4 THEN reasoning || {lit(_NOTE_ALL)} ELSE reasoning END AS re1
  FROM parsed),
r2 AS (SELECT prompt_key, abstract,
  CASE WHEN s1 NOT IN ('yes', 'maybe') THEN s1 WHEN sel2 = 0 THEN 'yes' WHEN sel2 = 1 THEN 'no'
       WHEN sel2 = 2 THEN s1 ELSE 'maybe' END AS s2,
  CASE WHEN s1 NOT IN ('yes', 'maybe') THEN t1 WHEN sel2 = 0 THEN coalesce(q, '')
       WHEN sel2 = 2 THEN t1 ELSE '' END AS t2,
  CASE WHEN s1 NOT IN ('yes', 'maybe') THEN sm1 WHEN sel2 = 0 THEN true WHEN sel2 = 2 THEN sm1
       ELSE false END AS sm2,
  CASE WHEN s1 NOT IN ('yes', 'maybe') THEN om1 WHEN sel2 = 1 THEN false WHEN sel2 = 2 THEN om1
       ELSE true END AS om2,
  CASE WHEN s1 NOT IN ('yes', 'maybe') THEN re1
       WHEN sel2 = 0 THEN '[Round2] Confirmed in round two. [Round1 was: ' || s1 || ']'
       WHEN sel2 = 1 THEN '[Round2] Rejected in round two. [Round1 was: ' || s1 || ']'
       WHEN sel2 = 2 THEN re1 || ' [Round 2 failed: vLLM API error: rate limited]'
       ELSE '[Round2] Unsure. [Round1 was: ' || s1 || ']' END AS re2
  FROM r1)
"""


def _rules(src: str, s: str, t: str, sm: str, om: str, re_: str) -> str:
    return f"""SELECT prompt_key,
  CASE WHEN {s} = 'yes' AND {t} = '' THEN 'maybe' ELSE {s} END AS support,
  CASE WHEN {s} IN ('no', 'maybe') AND {t} <> '' THEN '' ELSE {t} END AS sentences,
  {sm} AS subject_mentioned, {om} AS object_mentioned,
  {re_} || CASE WHEN {s} = 'yes' AND {t} = '' THEN {lit(_NOTE_YES)}
               WHEN {s} IN ('no', 'maybe') AND {t} <> '' THEN {lit(_NOTE_CLR)} ELSE '' END
    AS reasoning
FROM {src}"""


_ANS = f"WITH {NAMES_CTE}, {ENT_CTE}, {PROMPT_CTE}, {ANSWER_CTE}"

ORACLE["parse_responses"] = f"""{_ANS}
SELECT prompt_key, CASE WHEN failure IS NOT NULL THEN 'no' ELSE support END AS support,
       CASE WHEN failure IS NOT NULL THEN '' ELSE sentences END AS sentences,
       subject_mentioned AND failure IS NULL AS subject_mentioned,
       object_mentioned AND failure IS NULL AS object_mentioned,
       reasoning, failure
FROM parsed
"""

ORACLE["judge_round1"] = f"""{_ANS}
SELECT prompt_key, s1 AS support, t1 AS sentences, sm1 AS subject_mentioned,
       om1 AS object_mentioned, re1 AS reasoning FROM r1
"""

ORACLE["rules"] = f"{_ANS}\n" + _rules("r1", "s1", "t1", "sm1", "om1", "re1")

ORACLE["second_round"] = f"{_ANS}\n" + _rules("r2", "s2", "t2", "sm2", "om2", "re2")

_RESULTS = f"""{_ANS},
fin AS ({_rules("r2", "s2", "t2", "sm2", "om2", "re2")}),
rt AS (SELECT prompt_key, CAST(length(abstract) % 97 AS DOUBLE) / 10 + 1 AS runtime_seconds
       FROM pk),
results AS (
  SELECT p.subject_curie, coalesce(sn.name, '') AS subject_name, p.predicate, p.object_curie,
         coalesce(obn.name, '') AS object_name, p.PMID, p.line_id,
         f.support = 'yes' AS predicted, f.support, f.subject_mentioned, f.object_mentioned,
         f.sentences AS supporting_sentences, f.reasoning, rt.runtime_seconds
  FROM prompts p
  JOIN fin f ON f.prompt_key = p.prompt_key
  JOIN rt ON rt.prompt_key = f.prompt_key
  LEFT JOIN merged sn ON sn.curie = p.subject_curie
  LEFT JOIN merged obn ON obn.curie = p.object_curie)
"""

ORACLE["evaluate_results"] = f"{_RESULTS} SELECT * FROM results"

ORACLE["support_counts"] = f"""{_RESULTS}
SELECT count(*) FILTER (WHERE support = 'yes') AS yes,
       count(*) FILTER (WHERE support = 'maybe') AS maybe,
       count(*) FILTER (WHERE support = 'no') AS no
FROM results
"""

ORACLE["triple_summary"] = f"""{_RESULTS},
c AS (SELECT subject_curie, predicate, object_curie, count(*) AS total_pmids,
             count(*) FILTER (WHERE support = 'yes') AS yes_count,
             count(*) FILTER (WHERE support = 'maybe') AS maybe_count,
             count(*) FILTER (WHERE support = 'no') AS no_count
      FROM results GROUP BY subject_curie, predicate, object_curie),
p AS (SELECT *, CAST(yes_count AS DOUBLE) * 100 / total_pmids AS yp,
             CAST(maybe_count AS DOUBLE) * 100 / total_pmids AS mp,
             CAST(no_count AS DOUBLE) * 100 / total_pmids AS np FROM c)
SELECT subject_curie, predicate, object_curie, total_pmids, yes_count, maybe_count, no_count,
       round(yp, 1) AS yes_percentage, round(mp, 1) AS maybe_percentage,
       round(np, 1) AS no_percentage, yes_count AS supported_pmids,
       no_count + maybe_count AS unsupported_pmids, round(yp, 1) AS supported_percentage,
       round(np + mp, 1) AS unsupported_percentage
FROM p
"""


ORACLE["verify_quotes"] = "SELECT row_id, kind, kind <> 4 AS verified FROM fx_quotes"

ORACLE["sentence_split"] = f"""
WITH s AS (SELECT doc_id, list_filter(list_transform(string_split(text, '.'),
                                                      lambda x: {strip('x')}),
                                       lambda x: x <> '') AS l FROM documents)
SELECT doc_id, len(l) AS n_sentences,
       coalesce(CAST(list_sum(list_transform(l, lambda x: length(x))) AS BIGINT), 0) AS chars
FROM s
"""

ORACLE["benchmark_passages"] = """
SELECT b.item_id, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)
WHERE b.text IS NOT NULL AND b.text <> ''
"""


ORACLE["xml_ingest"] = f"""
WITH a AS (
  SELECT bare_pmid, {strip('title')} AS title,
         CASE WHEN has_abstract THEN array_to_string(list_filter(list_transform(
              string_split(text, chr(10)),
              lambda p, i: CASE WHEN {strip('p')} = '' THEN NULL
                                WHEN labelled THEN 'P' || CAST(i AS VARCHAR) || ': ' || {strip('p')}
                                ELSE {strip('p')} END), lambda x: x IS NOT NULL), ' ')
              ELSE '' END AS abstract
  FROM fx_xml_rows)
SELECT bare_pmid, title, abstract, CASE WHEN abstract = '' THEN 'No abstract available' END AS error
FROM a
UNION ALL
SELECT DISTINCT {norm('bare_pmid')}, '', '', 'PMID not found or could not be retrieved'
FROM fx_xml_requests WHERE {norm('bare_pmid')} NOT IN (SELECT bare_pmid FROM fx_xml_rows)
"""


def _clean(x: str) -> str:
    return f"replace(replace({strip(x)}, chr(9), ' '), chr(10), ' ')"


ORACLE["legacy_log"] = f"""{_ANS},
lg AS (SELECT prompt_key, min({norm('PMID')}) AS bare_pmid, min(subject_curie) AS subject_curie,
              min(predicate) AS predicate, min(object_curie) AS object_curie
       FROM prompts GROUP BY prompt_key),
fin AS ({_rules("r1", "s1", "t1", "sm1", "om1", "re1")}),
x AS (SELECT f.*, l.bare_pmid, l.subject_curie, l.predicate, l.object_curie,
             CASE WHEN f.support = 'yes' THEN 'True' ELSE 'False' END AS sup,
             CASE f.support WHEN 'yes' THEN 'Direct support' WHEN 'maybe' THEN 'Missing qualifier'
                  ELSE 'Not supported' END AS cat
      FROM fin f JOIN lg l ON l.prompt_key = f.prompt_key)
SELECT prompt_key, sup AS is_supported, cat AS evidence_category,
       subject_mentioned, object_mentioned, {_clean('sentences')} AS supporting_sentence,
       {_clean('reasoning')} AS reasoning,
       concat_ws(chr(9), subject_curie, predicate, object_curie, '', bare_pmid, sup, cat,
                 CASE WHEN subject_mentioned THEN 'Yes' ELSE 'No' END,
                 CASE WHEN object_mentioned THEN 'Yes' ELSE 'No' END,
                 {_clean('sentences')}, {_clean('reasoning')}, subject_curie, object_curie)
         AS tsv_line,
       'PMID:' || bare_pmid || ', ' || upper(substr(support, 1, 1)) || substr(support, 2)
         || ', Subject:' || CASE WHEN subject_mentioned THEN 'Yes' ELSE 'No' END
         || ', Object:' || CASE WHEN object_mentioned THEN 'Yes' ELSE 'No' END
         || CASE WHEN sentences <> '' THEN ', [' || sentences || ']' ELSE '' END AS summary_line
FROM x
"""


def _san(x: str) -> str:
    return (f"replace(replace(replace(replace(replace({x}, chr(13) || chr(10), ' '), chr(13), ' '),"
            f" chr(10), ' '), chr(9), ' '), '\"', '''')")


ORACLE["tsv_sanitize"] = f"SELECT doc_id, {_san('text')} AS text FROM documents"


def _txt(x: str) -> str:
    return _san(f"coalesce(CAST({x} AS VARCHAR), 'None')")


def _bool_txt(x: str) -> str:
    return f"CASE WHEN {x} THEN 'True' WHEN NOT {x} THEN 'False' ELSE 'None' END"


ORACLE["convert_results"] = f"""{_RESULTS}
SELECT {_txt('subject_curie')} AS subject_curie, {_txt('subject_name')} AS subject_name,
       {_txt('predicate')} AS predicate, {_txt('object_curie')} AS object_curie,
       {_txt('object_name')} AS object_name, {_txt('PMID')} AS PMID,
       {_txt('line_id')} AS line_id, {_bool_txt('predicted')} AS predicted,
       {_txt('support')} AS support, {_bool_txt('subject_mentioned')} AS subject_mentioned,
       {_bool_txt('object_mentioned')} AS object_mentioned,
       {_txt('supporting_sentences')} AS supporting_sentences, {_txt('reasoning')} AS reasoning
FROM results
"""

ORACLE["stream_evaluate"] = ORACLE["evaluate_results"]


def _hostile() -> str:
    # the answers to each form are stated beside it; two more forms follow the list
    from .queries import HOSTILE

    n = len(HOSTILE) + 2
    rows = ", ".join(f"({i}, {lit(h[1])}, {lit(h[2])}, {lit(h[3]) if h[3] else 'NULL'})" for i, h in enumerate(HOSTILE))
    return f"""
WITH form(k, support, sentences, failure) AS (VALUES {rows},
  ({n - 2}, 'no', '', 'too large'), ({n - 1}, 'yes', '', NULL))
SELECT doc_id AS prompt_key, support, sentences, failure FROM documents JOIN form ON k = doc_id % {n}
"""


ORACLE["parse_hostile"] = _hostile()

ORACLE["live_evaluate"] = f"""
WITH {NAMES_CTE}, {ENT_CTE}, {PROMPT_CTE},
one AS (SELECT length(prompt) AS n FROM prompts),
judged AS (SELECT CASE WHEN n % 3 = 2 THEN 'no' WHEN n % 5 = 0 THEN 'maybe'
    WHEN n % 2 = 0 THEN 'maybe' ELSE 'no' END AS support,
  n % 3 < 2 AND n % 5 <> 0 AS asked_again, n % 3 < 2 AND n % 5 = 0 AS failed_again FROM one)
SELECT support, asked_again, failed_again, count(*) AS n_rows FROM judged GROUP BY ALL
"""

ORACLE["evaluate_many"] = f"""
WITH st AS (SELECT bare_pmid,
    CASE WHEN CAST(bare_pmid AS BIGINT) % 5 = 0 THEN '' WHEN CAST(bare_pmid AS BIGINT) % 5 = 1 THEN 'down' ELSE error END AS error,
    CASE WHEN CAST(bare_pmid AS BIGINT) % 7 = 0 THEN ' ' WHEN CAST(bare_pmid AS BIGINT) % 7 = 1 THEN NULL ELSE abstract END AS abstract
  FROM fx_store),
req AS (SELECT line_id, 0 AS pmid_index, PMID FROM fx_triples UNION ALL SELECT line_id, 1, 'PMID:none' FROM fx_triples
  UNION ALL SELECT line_id, 2, PMID FROM fx_triples)
SELECT line_id, pmid_index, PMID, 'no' AS support,
  CASE WHEN s.bare_pmid IS NULL THEN 'PMID not found in results' WHEN coalesce(error, '') <> '' THEN 'Error: ' || error
       WHEN {strip("coalesce(abstract, '')")} = '' THEN 'No abstract available' ELSE 'ok' END AS reasoning
FROM req LEFT JOIN st s ON s.bare_pmid = {norm('req.PMID')}
"""

ORACLE["timing_stats"] = """
SELECT count(runtime_seconds) AS count, round(sum(runtime_seconds), 6) AS total,
  round(avg(runtime_seconds), 6) AS mean, round(stddev_samp(runtime_seconds), 6) AS std,
  round(quantile_cont(runtime_seconds, 0.5), 6) AS median, round(min(runtime_seconds), 6) AS min,
  round(max(runtime_seconds), 6) AS max
FROM fx_timings
"""

ORACLE["edge_stats"] = f"""
WITH e AS ({ORACLE["edge_extract"]})
SELECT (SELECT count(*) FROM fx_edge_rows) AS records, count(*) AS unique_keys,
  count(*) FILTER (SemMedDB_sentences LIKE '% | %') AS multi_sentence,
  (SELECT count(*) FROM fx_edge_rows WHERE NOT has_studies
     AND NOT (has_legacy AND coalesce(text_legacy, '') <> '')) AS publications_without_text
FROM e
"""


# ------------------------------------------------------------ files, batches, faulty runs

ORACLE["request_batches"] = """
SELECT bare_pmid, (row_number() OVER (ORDER BY bare_pmid) - 1) // 200 AS batch FROM fx_xml_requests
"""

_AUDIT = """
inp AS (SELECT DISTINCT subject_curie, predicate, object_curie, PMID FROM fx_triples),
res AS (SELECT DISTINCT * FROM fx_audit_results),
na AS (SELECT DISTINCT * FROM fx_audit_no_abstract),
comb AS (SELECT * FROM res UNION SELECT * FROM na),
missing AS (SELECT * FROM inp EXCEPT SELECT * FROM comb),
extra AS (SELECT * FROM comb EXCEPT SELECT * FROM inp)"""

ORACLE["coverage_gaps"] = f"""
WITH {_AUDIT},
c AS (
  SELECT (SELECT count(*) FROM fx_triples) AS input_rows, (SELECT count(*) FROM inp) AS input_unique,
         (SELECT count(*) FROM fx_audit_results) AS results_rows, (SELECT count(*) FROM res) AS results_unique,
         (SELECT count(*) FROM fx_audit_no_abstract) AS no_abstract_rows, (SELECT count(*) FROM na) AS no_abstract_unique,
         (SELECT count(*) FROM (SELECT * FROM res INTERSECT SELECT * FROM na) x) AS overlap,
         (SELECT count(*) FROM comb) AS combined_unique,
         (SELECT count(*) FROM extra) AS in_results_not_input, (SELECT count(*) FROM missing) AS in_input_not_results,
         (SELECT count(*) FROM (SELECT * FROM inp INTERSECT SELECT * FROM comb) x) AS matched)
SELECT input_rows, input_unique, input_rows - input_unique AS input_duplicates,
       results_rows, results_unique, results_rows - results_unique AS results_duplicates,
       no_abstract_rows, no_abstract_unique, no_abstract_rows - no_abstract_unique AS no_abstract_duplicates,
       overlap, combined_unique, in_results_not_input, in_input_not_results, matched,
       round(matched * 100.0 / input_unique, 4) AS coverage_pct, false AS perfect
FROM c
"""

ORACLE["coverage_samples"] = f"""
WITH {_AUDIT}
SELECT *, 'missing' AS side FROM (SELECT * FROM missing ORDER BY 1, 2, 3, 4 LIMIT 10) a
UNION ALL
SELECT *, 'extra' FROM (SELECT * FROM extra ORDER BY 1, 2, 3, 4 LIMIT 10) b
"""

ORACLE["metric_modes"] = """
WITH l AS (SELECT lower(trim(ground_truth)) AS g, lower(trim(predicted)) AS p, predicted AS raw FROM fx_spoken_labels),
b AS (
  SELECT 'strict' AS mode, CASE WHEN g IN ('true', 'yes') THEN 1 WHEN g IN ('false', 'no') THEN 0 END AS y,
         CASE WHEN p IN ('true', 'yes') THEN 1 WHEN p IN ('false', 'no') THEN 0 END AS x FROM l
  UNION ALL
  SELECT 'eval_script', CASE g WHEN 'true' THEN 1 WHEN 'false' THEN 0 END,
         CASE p WHEN 'true' THEN 1 WHEN 'false' THEN 0 END FROM l WHERE raw NOT IN ('Unknown', 'Error')
  UNION ALL
  SELECT 'lenient', CASE WHEN g IN ('true', '1', 'yes') THEN 1 ELSE 0 END,
         CASE WHEN p IN ('true', '1', 'yes') THEN 1 ELSE 0 END FROM l),
c AS (SELECT mode, count(*) FILTER (y IS NOT NULL AND x IS NOT NULL) AS valid_predictions,
             count(*) FILTER (y = 0 AND x = 0) AS tn, count(*) FILTER (y = 0 AND x = 1) AS fp,
             count(*) FILTER (y = 1 AND x = 0) AS fn, count(*) FILTER (y = 1 AND x = 1) AS tp FROM b GROUP BY mode)
SELECT mode, CAST(tp + tn AS DOUBLE) / valid_predictions AS accuracy, (SELECT count(*) FROM l) AS total_samples,
       valid_predictions, tn, fp, fn, tp FROM c
"""

ORACLE["altered_quotes"] = "SELECT row_id, kind, kind IN (0, 1, 4) AS verified FROM fx_altered_quotes"

ORACLE["names_file"] = """
WITH n AS (SELECT curie_id, arg_max(names, line) AS names FROM (
    SELECT line, curie_id, array_to_string(list_filter(string_split(all_names, '|'), lambda x: x <> ''), '|') AS names
    FROM fx_name_lines) x WHERE names <> '' GROUP BY curie_id)
SELECT 'PART:' || CAST(p_partkey AS VARCHAR) AS curie, coalesce(names, p_name) AS all_names
FROM part LEFT JOIN n ON curie_id = 'PART:' || CAST(p_partkey AS VARCHAR)
"""

ORACLE["predicates_file"] = """
WITH RECURSIVE r(name) AS (
  SELECT name FROM fx_slots WHERE name = 'related to'
  UNION
  SELECT s.name FROM fx_slots s JOIN r ON s.is_a = r.name)
SELECT 'biolink:' || replace(s.name, ' ', '_') AS predicate,
       coalesce(trim(regexp_replace(s.description, '\\s+', ' ', 'g')), '') AS description,
       row_number() OVER (ORDER BY s.name) AS place
FROM fx_slots s WHERE s.name IN (SELECT name FROM r)
"""

ORACLE["edges_file"] = ORACLE["edge_extract"]

ORACLE["nodes_file"] = ORACLE["node_match"]

ORACLE["nodes_dict_file"] = """
SELECT 'DOC:' || CAST(doc_id AS VARCHAR) AS id, coalesce(source, '') AS name, coalesce(lang, '') AS category,
       sha256('"{' || coalesce(text, '') || '}\\') AS description_sha
FROM documents
"""

ORACLE["token_file"] = ORACLE["token_stats"]

ORACLE["triples_file"] = """
SELECT subject_curie, predicate, object_curie, PMID, 'say "' || predicate || '"' || chr(9) || 'and go' AS note,
       CASE WHEN line_id % 2 = 0 THEN 'True' ELSE 'False' END AS ground_truth
FROM fx_triples
"""

ORACLE["no_abstract_sink"] = f"""
SELECT t.* FROM fx_triples t
WHERE {norm('t.PMID')} NOT IN (SELECT bare_pmid FROM fx_store WHERE {VALID})
"""

ORACLE["report_file"] = ORACLE["class_metrics"]

ORACLE["store_upsert_stored"] = ORACLE["store_upsert"]
