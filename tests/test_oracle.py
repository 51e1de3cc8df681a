"""DuckDB oracle agreement for a subset of registered queries at sf0.001."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from attestor.plans.tables import TABLES

SF = "/root/testdata/sf0.001"
QUICK = ["normalize_pmid", "abstract_split", "coverage_audit", "store_retry", "class_metrics",
         "timing_summary", "token_stats", "unique_curies", "label_set", "node_match",
         "edge_extract", "sentence_split", "benchmark_passages", "verify_quotes",
         "tsv_sanitize", "xml_ingest", "prompt_text", "evaluate_results", "parse_hostile",
         "live_evaluate", "evaluate_many", "stream_evaluate",
         "timing_stats", "edge_stats", "resume_pending", "store_upsert_stored", "request_batches",
         "coverage_gaps", "coverage_samples", "metric_modes", "altered_quotes", "names_file",
         "predicates_file", "nodes_file", "nodes_dict_file", "token_file", "triples_file",
         "no_abstract_sink"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in recs)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", QUICK)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(ocols, res.fetchall())


def test_every_query_has_an_oracle():
    from attestor.plans.queries import QUERIES

    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())
