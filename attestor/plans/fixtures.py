"""Fixture views derived from the driver's tables.

The flat views are plain SQL that both Spark SQL and DuckDB accept, so the
Spark query and its DuckDB oracle start from exactly the same rows. Each view
is registered in Spark as a temp view named ``fx_<name>``; the oracle gets the
same text as a CTE. Nested shapes (edge JSON, node JSON, answers, model
responses, quotes) are built in ``nested.py`` because array/map literals are
not portable between the two engines.

Everything reads whole driver tables, so the work grows with the scale factor.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .tables import register_tables

# T: one triple per lineitem row. A fifth of the PMIDs have no document, and
# the modulo makes a few 4-keys repeat.
TRIPLE_COLUMNS = """
       'SUPP:' || CAST(l_suppkey AS STRING) AS subject_curie,
       CASE l_returnflag
            WHEN 'A' THEN 'stimulates'
            WHEN 'R' THEN 'inhibits'
            ELSE 'biolink:increases_amount_or_activity_of' END AS predicate,
       'PART:' || CAST(l_partkey AS STRING) AS object_curie,
       'PMID:' || CAST(l_orderkey % (SELECT CAST(floor(count(*) * 5 / 4) AS BIGINT)
                                     FROM documents) AS STRING) AS PMID,
       l_orderkey * 8 + l_linenumber AS line_id"""

# line_id orders rows but is not unique: (order, line number) repeats in the
# driver's lineitem.
TRIPLES = f"SELECT {TRIPLE_COLUMNS}\nFROM lineitem\n"

# A: the abstract store, one row per document; three kinds of fault.
STORE = """
SELECT CAST(doc_id AS STRING) AS bare_pmid,
       CASE WHEN doc_id % 23 = 0 OR doc_id % 29 = 0 OR doc_id % 31 = 0 THEN ''
            ELSE split_part(text, '.', 1) END AS title,
       CASE WHEN doc_id % 23 = 0 OR doc_id % 29 = 0 OR doc_id % 31 = 0 THEN ''
            ELSE text END AS abstract,
       '2024-01-01T00:00:00' AS fetch_date,
       CASE WHEN doc_id % 23 = 0 THEN 'No abstract available'
            WHEN doc_id % 29 = 0 THEN 'Extraction failed: timeout'
            WHEN doc_id % 31 = 0 THEN 'PMID not found or could not be retrieved'
            END AS error
FROM documents
"""

# A second ingest batch: the retryable failures come back, some now valid,
# plus fresh copies of a few valid rows (later batch wins on upsert).
STORE_BATCH = """
SELECT CAST(doc_id AS STRING) AS bare_pmid,
       CASE WHEN doc_id % 2 = 0 THEN split_part(text, '.', 1) ELSE '' END AS title,
       CASE WHEN doc_id % 2 = 0 THEN text ELSE '' END AS abstract,
       '2024-02-01T00:00:00' AS fetch_date,
       CASE WHEN doc_id % 2 = 0 THEN NULL
            ELSE 'PMID not found or could not be retrieved' END AS error
FROM documents
WHERE doc_id % 23 <> 0 AND (doc_id % 29 = 0 OR doc_id % 31 = 0 OR doc_id % 97 = 0)
"""

# L: labelled predictions from the labels table.
LABELS = """
SELECT CAST(doc_id AS STRING) AS row_id,
       CASE WHEN quality = 1 THEN 'True' ELSE 'False' END AS ground_truth,
       CASE WHEN toxic = 0 THEN 'True' ELSE 'False' END AS predicted
FROM labels
"""

# M: per-request timings.
TIMINGS = """
SELECT 'PMID:' || CAST(event_id AS STRING) AS PMID, value AS runtime_seconds
FROM events
"""

# K: token-usage lines as text fields, system turns carry a non-integer.
TOKENS = """
SELECT CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING) AS id,
       CAST(p AS STRING) AS prompt,
       CAST(c AS STRING) AS completion,
       CAST(p + c AS STRING) AS total,
       CASE WHEN role = 'system' THEN 'n/a' ELSE CAST(k AS STRING) END AS cached,
       CAST(p - k AS STRING) AS uncached
FROM (SELECT conv_id, turn, role,
             CAST(floor(length(text) / 4) AS BIGINT) AS p,
             CAST(floor(length(text) / 10) AS BIGINT) AS c,
             CASE WHEN turn % 2 = 0 THEN CAST(floor(length(text) / 8) AS BIGINT)
                  ELSE 0 END AS k
      FROM conversations) s
"""

# H: ontology slots. region -> nation -> supplier under the root, plus an
# orphan branch (customer segments) that must not be reached.
SLOTS = """
SELECT 'related to' AS name, CAST(NULL AS STRING) AS is_a,
       'A relationship that is asserted between two named things' AS description
UNION ALL
SELECT lower(r_name), 'related to',
       '  Region   ' || r_name || ' groups' || chr(10) || '  several nations ' FROM region
UNION ALL
SELECT lower(n.n_name), lower(r.r_name), 'Nation ' || n.n_name
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
UNION ALL
SELECT 'supplies ' || CAST(s.s_suppkey AS STRING), lower(n.n_name), NULL
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
UNION ALL
SELECT 'orphan root', NULL, 'Detached branch'
UNION ALL
SELECT DISTINCT 'segment ' || lower(c_mktsegment), 'orphan root',
       'Segment' || chr(9) || c_mktsegment FROM customer
"""

# Predicate definitions: one exact biolink entry, one bare name that resolves
# through the ``biolink:`` fallback, one exact entry with empty text.
PREDICATES = """
SELECT DISTINCT
       CASE l_returnflag WHEN 'A' THEN 'biolink:stimulates' WHEN 'R' THEN 'inhibits'
            ELSE 'biolink:increases_amount_or_activity_of' END AS predicate,
       CASE l_returnflag
            WHEN 'A' THEN 'A causal relation in which the subject raises the activity of the object.'
            WHEN 'R' THEN ''
            ELSE 'Holds between two molecular entities where the action of one increases the amount or activity of the other.'
            END AS description
FROM lineitem
"""

# Node lines (flat): KG2-style supplier nodes, KGX-style part nodes (some under
# an alternative id), and later revisions of every seventh part.
NODE_ROWS = """
SELECT 10 * s_suppkey + 5 AS line, 'SUPP:' || CAST(s_suppkey AS STRING) AS id, s_name AS name,
       'biolink:Gene' AS category,
       'Supplier in nation ' || CAST(s_nationkey AS STRING) AS description,
       'SALT:' || CAST(s_suppkey AS STRING) AS eq1, CAST(NULL AS STRING) AS eq2, true AS kg2,
       CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS an1,
       CASE WHEN s_suppkey % 2 = 0 THEN lower(s_name) END AS an2
FROM supplier
UNION ALL
SELECT 10 * p_partkey + 1,
       CASE WHEN p_partkey % 5 = 0 THEN 'ALTP:' ELSE 'PART:' END || CAST(p_partkey AS STRING),
       p_name,
       CASE WHEN p_partkey % 2 = 0 THEN 'biolink:' || p_type
            ELSE '["biolink:' || p_type || '", "biolink:NamedThing"]' END,
       p_name || ' of size ' || CAST(p_size AS STRING),
       'PART:' || CAST(p_partkey AS STRING), 'ALTP:' || CAST(p_partkey AS STRING), false,
       CAST(NULL AS STRING), CAST(NULL AS STRING)
FROM part
UNION ALL
SELECT 10 * p_partkey + 2, 'PART:' || CAST(p_partkey AS STRING), 'revised ' || p_name,
       CASE WHEN p_partkey % 2 = 0 THEN '[]' ELSE '' END, CAST(NULL AS STRING),
       CAST(NULL AS STRING), CAST(NULL AS STRING), false, CAST(NULL AS STRING), CAST(NULL AS STRING)
FROM part WHERE p_partkey % 7 = 0
"""

# Name-service answers (flat) for every curie the triples use; a third of the
# suppliers are unresolvable (null answer).
ANSWER_ROWS = """
SELECT 'PART:' || CAST(p_partkey AS STRING) AS curie, true AS answered, p_name AS l0,
       upper(p_name) AS l1, p_brand AS l2, '' AS l3, p_name || ' protein' AS l4
FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem)
UNION ALL
SELECT 'SUPP:' || CAST(s_suppkey AS STRING), s_suppkey % 3 <> 0, s_name,
       CAST(NULL AS STRING), CAST(NULL AS STRING), CAST(NULL AS STRING), CAST(NULL AS STRING)
FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)
"""

# Edge records (flat), one per triple row: two study results (the second may
# repeat the first sentence) or a legacy sentence, or no text at all.
EDGE_ROWS = f"""
SELECT subject_curie AS subject, predicate, object_curie AS object, PMID, line_id,
       has_studies, has_legacy, text_a,
       CASE WHEN odd THEN text_a ELSE 'Quantity ' || qty || ' noted' END AS text_b,
       'Legacy note for order ' || CAST(l_orderkey AS STRING) AS text_legacy
FROM (SELECT {TRIPLE_COLUMNS}, l_orderkey,
             l_discount > 0 AS has_studies,
             l_discount = 0 AND l_tax > 0.04 AS has_legacy,
             'Supplier ' || CAST(l_suppkey AS STRING) || ' acts on part '
               || CAST(l_partkey AS STRING) AS text_a,
             l_linenumber % 2 = 1 AS odd,
             CAST(CAST(floor(l_quantity) AS BIGINT) AS STRING) AS qty
      FROM lineitem) e
"""

FLAT = {
    "triples": TRIPLES,
    "store": STORE,
    "store_batch": STORE_BATCH,
    "labels": LABELS,
    "timings": TIMINGS,
    "tokens": TOKENS,
    "slots": SLOTS,
    "predicates": PREDICATES,
    "node_rows": NODE_ROWS,
    "answer_rows": ANSWER_ROWS,
    "edge_rows": EDGE_ROWS,
}

_FX = re.compile(r"\bfx_([a-z_]+)\b")


def fixture_names(sql: str) -> list[str]:
    """Flat fixtures referenced by ``sql``, dependencies first."""
    seen: list[str] = []

    def visit(name: str) -> None:
        if name in seen or name not in FLAT:
            return
        for dep in _FX.findall(FLAT[name]):
            visit(dep)
        seen.append(name)

    for name in _FX.findall(sql):
        visit(name)
    return seen


def with_fixtures(sql: str) -> str:
    """Prefix ``sql`` with the CTEs of every flat fixture it names (oracle side)."""
    names = fixture_names(sql)
    if not names:
        return sql
    ctes = ",\n".join(f"fx_{n} AS ({FLAT[n]})" for n in names)
    body = sql.strip()
    head = body[:14].upper()
    if head.startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes},\n{body[14:].lstrip()}"
    if head.startswith("WITH"):
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


_REGISTERED: dict[int, str] = {}


def register_fixtures(spark: SparkSession, sf_dir: str) -> None:
    """Register driver tables and flat fixtures once per session and folder."""
    key = id(spark)
    if _REGISTERED.get(key) == sf_dir and spark.catalog.tableExists("fx_triples"):
        return
    register_tables(spark, sf_dir)
    for name, sql in FLAT.items():
        spark.sql(sql).createOrReplaceTempView(f"fx_{name}")
    _REGISTERED[key] = sf_dir


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    register_fixtures(spark, sf_dir)
    return spark.table(f"fx_{name}")


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table of ``sf_dir``, also where no fixture has been asked for before."""
    register_fixtures(spark, sf_dir)
    return spark.table(name)


_STORED: dict[tuple[int, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A derived input table (e.g. recorded responses) written once per session
    and folder under the shared checkpoint folder, then read back like any
    other table. ``build()`` returns the DataFrame to write."""
    from ..session import write_stage

    from .tables import spread

    key = (id(spark), sf_dir, name)
    path = _STORED.get(key)
    if path is None:
        path = _STORED[key] = write_stage(build(), f"fixture-{name}")
    return spread(spark, spark.read.parquet(path))


# V: one quote per document cut from one of its sentences (any, by doc_id) in six ways: exact,
# upper case (ASCII only), doubled spaces, prefix + '...', invented words,
# '...' + suffix. Only the invented one must fail verification.
QUOTES = """
SELECT doc_id AS row_id, doc_id % 6 AS kind, text AS abstract,
       CASE doc_id % 6
            WHEN 0 THEN s1
            WHEN 1 THEN CASE WHEN regexp_replace(s1, '[^ -~]', '') = s1 THEN upper(s1) ELSE s1 END
            WHEN 2 THEN replace(s1, ' ', '  ')
            WHEN 3 THEN substr(s1, 1, CAST(floor((length(s1) + 1) / 2) AS BIGINT)) || '...'
            WHEN 4 THEN 'Zorblax quintessence modulates the hyperflux'
            ELSE '...' || substr(s1, CAST(floor(length(s1) / 2) AS BIGINT) + 1) END AS sentence
FROM (SELECT doc_id, text,
             regexp_replace(regexp_replace(split_part(text, '.', CAST(1 + doc_id % (1 + length(text) - length(replace(text, '.', ''))) AS INT)),
                                           '^[ ' || chr(9) || chr(10) || chr(13) || ']+', ''),
                            '[ ' || chr(9) || chr(10) || chr(13) || ']+$', '') AS s1
      FROM documents) d
WHERE s1 <> ''
"""
FLAT["quotes"] = QUOTES

# Article answers (flat): title and text per document; every 13th has no
# abstract; the request list also asks for ids no answer covers.
XML_ROWS = """
SELECT CAST(doc_id AS STRING) AS bare_pmid,
       regexp_replace(regexp_replace(split_part(text, '.', 1),
                                     '^[ ' || chr(9) || chr(10) || chr(13) || ']+', ''),
                      '[ ' || chr(9) || chr(10) || chr(13) || ']+$', '') AS title,
       text, doc_id % 2 = 0 AS labelled, doc_id % 13 <> 0 AS has_abstract
FROM documents
"""
XML_REQUESTS = """
SELECT CAST(doc_id AS STRING) AS bare_pmid FROM documents
UNION ALL
SELECT 'PMID:' || CAST(doc_id + 1000000 AS STRING) FROM documents WHERE doc_id % 17 = 0
"""
FLAT["xml_rows"] = XML_ROWS
FLAT["xml_requests"] = XML_REQUESTS

# Output of a faulty run: some results are missing, some belong to no input, some keys are
# both evaluated and without an abstract.
_KEYED = """SELECT t.subject_curie, t.predicate, t.object_curie, t.PMID, t.line_id,
       a.bare_pmid IS NOT NULL AS has
FROM fx_triples t LEFT JOIN (SELECT bare_pmid FROM fx_store WHERE error IS NULL AND abstract <> '') a
  ON 'PMID:' || a.bare_pmid = t.PMID"""
FLAT["audit_results"] = f"""
SELECT subject_curie, predicate, object_curie, PMID FROM ({_KEYED}) k WHERE has AND line_id % 11 <> 0
UNION ALL
SELECT subject_curie, predicate, 'EXTRA:' || object_curie, PMID FROM ({_KEYED}) k WHERE has AND line_id % 13 = 0
"""
FLAT["audit_no_abstract"] = f"""
SELECT subject_curie, predicate, object_curie, PMID FROM ({_KEYED}) k
WHERE (NOT has AND line_id % 7 <> 0) OR (has AND line_id % 17 = 0)
"""

# Labels as people and programs write them.
FLAT["spoken_labels"] = """
SELECT CAST(doc_id AS STRING) AS row_id,
       CASE WHEN quality = 1 THEN CASE doc_id % 4 WHEN 0 THEN 'True' WHEN 1 THEN ' yes' WHEN 2 THEN '1' ELSE 'TRUE ' END
            ELSE CASE doc_id % 3 WHEN 0 THEN 'False' WHEN 1 THEN 'no' ELSE '0' END END AS ground_truth,
       CASE WHEN doc_id % 19 = 0 THEN 'Unknown' WHEN doc_id % 23 = 0 THEN 'Error' WHEN doc_id % 29 = 0 THEN ''
            WHEN toxic = 0 THEN CASE doc_id % 5 WHEN 0 THEN 'yes' WHEN 1 THEN '1' ELSE 'true' END
            ELSE CASE doc_id % 2 WHEN 0 THEN 'false' ELSE 'NO' END END AS predicted
FROM labels
"""

# Name rows in file order: curies that appear twice or have an empty list at the end.
FLAT["name_lines"] = """
SELECT 10 * p_partkey + 1 AS line, 'PART:' || CAST(p_partkey AS STRING) AS curie_id, 'old ' || p_name || '|older' AS all_names
FROM part WHERE p_partkey % 3 = 0
UNION ALL
SELECT 10 * p_partkey + 2, 'PART:' || CAST(p_partkey AS STRING), p_name || '||' || p_brand FROM part WHERE p_partkey % 2 = 0
UNION ALL
SELECT 10 * p_partkey + 3, 'PART:' || CAST(p_partkey AS STRING), '|' FROM part WHERE p_partkey % 5 = 0
"""

# Quotes that leave out inner words, or differ from a sentence in a letter or more. Sentences
# are of one line, with plain words only, and long enough for a letter to be a small part.
FLAT["altered_quotes"] = """
SELECT doc_id AS row_id, doc_id % 5 AS kind, text AS abstract,
       CASE doc_id % 5
            WHEN 0 THEN substr(s1, 1, CAST(floor(length(s1) / 3) AS BIGINT)) || ' ... '
                        || substr(s1, length(s1) - CAST(floor(length(s1) / 3) AS BIGINT))
            WHEN 1 THEN substr(s1, 1, CAST(floor(length(s1) / 2) AS BIGINT)) || '#'
                        || substr(s1, CAST(floor(length(s1) / 2) AS BIGINT) + 2)
            WHEN 2 THEN substr(s1, 1, 20) || '#######' || substr(s1, 28)
            WHEN 3 THEN substr(s1, 1, 12) || '...~~absent~~...' || substr(s1, length(s1) - 12)
            ELSE substr(s1, 1, 15) || '...' || substr(s1, 17, 8) || '...' || substr(s1, length(s1) - 9) END AS sentence
FROM (SELECT doc_id, text,
             regexp_replace(regexp_replace(split_part(text, '.', CAST(1 + doc_id % (1 + length(text) - length(replace(text, '.', ''))) AS INT)),
                                           '^[ ' || chr(10) || ']+', ''), '[ ' || chr(10) || ']+$', '') AS s1
      FROM documents) d
WHERE length(s1) BETWEEN 60 AND 130 AND regexp_replace(s1, '[^A-Za-z ]', '') = s1
"""
