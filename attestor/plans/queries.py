"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads whole driver tables through the fixture views and runs the
library's operators on them. Column names equal those of the matching oracle
SQL in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import KEY_COLUMNS, key_columns, normalize_pmid as normalize, packed, unpacked
from ..operators import coverage as cov
from ..operators import edges as edges_op
from ..operators import entities as en
from ..operators import evaluate as ev
from ..operators import judge
from ..operators import score
from ..operators import passages as pas
from ..operators import predicates as preds
from ..operators import prompts as prompts_op
from ..operators import reports as rep
from ..operators import resume
from ..operators import store as st
from ..functions import legacy
from ..session import materialize, materialize_by
from ..sources import articles as articles_src
from ..sources import kg, sinks
from ..sources import triples as triples_src
from ..sources.triples import prepare_triples
from ..streaming import evaluate_stream as stream_op
from . import nested
from .fixtures import driver_table, fixture, stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ------------------------------------------------------------ keys, reader


@query
def normalize_pmid(spark, sf_dir):
    """F1 + A3 on four spellings of each PMID; the remainder is not re-stripped."""
    t = fixture(spark, sf_dir, "triples")
    bare = F.substring(F.col("PMID"), 6, 1 << 30)
    raw = (
        F.when(F.col("line_id") % 4 == 0, F.col("PMID"))
        .when(F.col("line_id") % 4 == 1, F.concat(F.lit(" "), F.lower("PMID"), F.lit("\t")))
        .when(F.col("line_id") % 4 == 2, bare)
        .otherwise(F.concat(F.lit("PmId: "), bare))
    )
    variants = t.select(raw.alias("PMID"))
    normed = variants.select(normalize("PMID").alias("bare_pmid"))
    return normed.groupBy("bare_pmid").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def triple_reader(spark, sf_dir):
    """S1 + F2: strings, Supported -> ground_truth, null keys dropped, keys stripped."""
    t = fixture(spark, sf_dir, "triples")
    raw = t.select(
        F.when(F.col("line_id") % 7 == 0, F.concat(F.lit("  "), F.col("subject_curie"), F.lit(" ")))
        .otherwise(F.col("subject_curie")).alias("subject_curie"),
        "predicate",
        "object_curie",
        F.when(F.col("line_id") % 50 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("PMID")).alias("PMID"),
        F.when(F.col("line_id") % 3 == 0, F.lit("True")).otherwise(F.lit("False")).alias("Supported"),
        "line_id",
    )
    rows = prepare_triples(raw)
    return rows.select(*key_columns(), "ground_truth", "line_id")


# ------------------------------------------------------------ availability


@query
def abstract_split(spark, sf_dir):
    """J2 + F20: per triple row, has_abstract and the availability status."""
    t = fixture(spark, sf_dir, "triples")
    a = fixture(spark, sf_dir, "store")
    return st.abstract_status(t, a)


@query
def resume_pending(spark, sf_dir):
    """A finished first run holds the rows that had an abstract; the rest remain."""
    t = fixture(spark, sf_dir, "triples")
    a = fixture(spark, sf_dir, "store")
    done, _ = st.split_by_abstract(t, a)
    return resume.pending(t, done.select(*KEY_COLUMNS))


@query
def coverage_audit(spark, sf_dir):
    """Input vs. results (rows with abstract) and no-abstract rows."""
    t = fixture(spark, sf_dir, "triples")
    a = fixture(spark, sf_dir, "store")
    return cov.coverage_of(cov.per_key_flagged(st.flag_abstract(t, a)))


# ------------------------------------------------------------ store upkeep


@query
def store_upsert(spark, sf_dir):
    """The second batch replaces its pmids, everything else stays."""
    return st.upsert(fixture(spark, sf_dir, "store"), fixture(spark, sf_dir, "store_batch"))


@query
def store_upsert_stored(spark, sf_dir):
    """S6 on a stored table: only the parts that the batch falls into are rewritten."""
    path = _folder(spark, "store")
    st.write_store(fixture(spark, sf_dir, "store"), path)
    st.upsert_stored(spark, path, fixture(spark, sf_dir, "store_batch"))
    return st.read_store(spark, path)


@query
def store_failed(spark, sf_dir):
    """Failed list: error rows and blank abstracts, with the reason."""
    return st.failed_abstracts(fixture(spark, sf_dir, "store"))


@query
def store_missing(spark, sf_dir):
    """J8 + J9: pmids still to fetch; flag those never stored at all."""
    t = fixture(spark, sf_dir, "triples")
    a = fixture(spark, sf_dir, "store")
    missing = st.missing_abstracts(t, a)
    never = st.never_stored(t, a).withColumn("never_stored", F.lit(True))
    return missing.join(never, "bare_pmid", "left").select(
        "bare_pmid", F.coalesce("never_stored", F.lit(False)).alias("never_stored")
    )


@query
def store_retry(spark, sf_dir):
    """Retry round: delete retryable rows, re-ingest them, report A13/A14 counts."""
    a = fixture(spark, sf_dir, "store")
    batch = fixture(spark, sf_dir, "store_batch")
    ids = st.retryable(a)
    fetched = batch.join(ids, "bare_pmid", "left_semi")
    unseen = ids.join(fetched.select("bare_pmid"), "bare_pmid", "left_anti").select(
        "bare_pmid",
        F.lit("").alias("title"),
        F.lit("").alias("abstract"),
        F.lit("2024-02-01T00:00:00").alias("fetch_date"),
        F.lit(st.NOT_FOUND).alias("error"),
    )
    after = st.upsert(st.drop_pmids(a, ids), fetched.unionByName(unseen))
    stats = st.ingest_stats(ids, st.drop_pmids(a, ids), after)
    counts = st.store_counts(after)
    return stats.select(
        F.col("total_pmids").alias("retried"),
        "successful",
        F.col("failed").alias("still_failed"),
        counts.select("cached").scalar().alias("cache_size"),
        counts.select("rows").scalar().alias("store_rows"),
    )


# ------------------------------------------------------------ reports


@query
def class_metrics(spark, sf_dir):
    """A6 + A9 (F31 strict): metrics from labels (ground truth = quality)."""
    return rep.class_metrics(fixture(spark, sf_dir, "labels"))


@query
def class_report(spark, sf_dir):
    """Per-class precision/recall/F1/support and averages."""
    return rep.class_report(fixture(spark, sf_dir, "labels"))


@query
def timing_summary(spark, sf_dir):
    """A10: per-request timing stats; wall clock = span of the event stamps."""
    m = fixture(spark, sf_dir, "timings")
    ev = driver_table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    wall = ev.select(
        ((F.unix_micros(F.max(ts)) - F.unix_micros(F.min(ts))) / 1e6)
    ).scalar()
    return rep.timing_summary(m, wall, concurrency=24)


@query
def timing_stats(spark, sf_dir):
    """Statistics of the recorded round-1 runtimes."""
    out = rep.timing_stats(fixture(spark, sf_dir, "timings"))
    return out.select("count", *[F.round(c, 6).alias(c) for c in out.columns if c != "count"])


@query
def token_stats(spark, sf_dir):
    """Token usage and cost; the system turns' non-integer rows are skipped."""
    return rep.token_stats(fixture(spark, sf_dir, "tokens"))


@query
def predicate_closure(spark, sf_dir):
    """O4 + F5: slots under 'related to'; the orphan branch stays out."""
    return preds.predicate_closure(fixture(spark, sf_dir, "slots"))


# ------------------------------------------------------------ edges, entities


def _entity_table(spark, sf_dir):
    """The merged entity table as the prompt jobs read it: written once by the
    entity job, then a stored input (like a names or node dictionary file)."""
    return stored(spark, sf_dir, "entities", lambda: _entities(spark, sf_dir))


def _predicate_table(spark, sf_dir):
    """Predicate definitions as the prompt jobs read them: a stored input table."""
    return stored(spark, sf_dir, "predicates", lambda: fixture(spark, sf_dir, "predicates"))


def _entities(spark, sf_dir, merged: bool = True):
    # written once: the nodes and the names are both asked for them
    curies = materialize(en.unique_curies(fixture(spark, sf_dir, "triples")), "curies")
    ents = en.load_entities(nested.nodes(spark, sf_dir), curies)
    if not merged:
        return ents
    names = en.collect_names(curies, nested.answers(spark, sf_dir))
    return en.merge_names(ents, names)


def _joined(df, col="all_names"):
    return df.withColumn(col, F.array_join(col, "|"))


@query
def edge_extract(spark, sf_dir):
    """O1 + J7: KGX edge records to one row per 4-key with ordered sentences."""
    return edges_op.extract_edges(nested.edges(spark, sf_dir))


@query
def edge_stats(spark, sf_dir):
    """A1 counts: records, keys, keys with several sentences, publications without text."""
    return edges_op.edge_stats(nested.edges(spark, sf_dir))


@query
def unique_curies(spark, sf_dir):
    """A2: distinct subject and object curies."""
    return en.unique_curies(fixture(spark, sf_dir, "triples"))


@query
def label_set(spark, sf_dir):
    """O3 + F8 + S15: names per requested curie from stored name-service answers."""
    t = fixture(spark, sf_dir, "triples")
    names = en.collect_names(en.unique_curies(t), nested.answers(spark, sf_dir))
    return _joined(names)


@query
def node_match(spark, sf_dir):
    """O2 + J4 + F6 + F7: node info per target curie, with the early-stop line."""
    return _joined(_entities(spark, sf_dir, merged=False))


@query
def names_merge(spark, sf_dir):
    """Collected names replace the loaded all_names when non-empty."""
    return _joined(_entities(spark, sf_dir))


@query
def named_triples(spark, sf_dir):
    """F32 + F33 + J6: subject_name / object_name columns next to their curies."""
    t = fixture(spark, sf_dir, "triples")
    return en.named_columns(t, _entity_table(spark, sf_dir))


# ------------------------------------------------------------ prompts

MODEL_MAX_LEN = 8192


def _prompts(spark, sf_dir, model_max_len=MODEL_MAX_LEN, with_text=False):
    t = fixture(spark, sf_dir, "triples")
    a = fixture(spark, sf_dir, "store")
    with_abs, _ = st.split_by_abstract(t, a)
    return prompts_op.build_prompts(
        with_abs, a, _entity_table(spark, sf_dir), _predicate_table(spark, sf_dir),
        model_max_len=model_max_len, with_text=with_text,
    )


@query
def prompt_text(spark, sf_dir):
    """O6 + F9 + F3 + F4: full prompt per row with an abstract: its key, the
    hash of the text, and its length (from the sections and from the text)."""
    p = _prompts(spark, sf_dir, with_text=True)
    return p.select(*KEY_COLUMNS, "line_id", "prompt_key",
                    F.sha2("prompt", 256).alias("prompt_sha"), "prompt_chars", "text_chars")


@query
def token_budget(spark, sf_dir):
    """estimated prompt tokens and the answer budget for an 8192 model."""
    p = _prompts(spark, sf_dir)
    return p.select(*KEY_COLUMNS, "line_id", "est_tokens", "max_tokens")


# ------------------------------------------------------------ answers


def _responses(spark, sf_dir, prompts=None):
    """The recorded responses (a stored input table, built once)."""
    return stored(spark, sf_dir, "responses", lambda: nested.responses(
        prompts if prompts is not None else _prompts(spark, sf_dir), fixture(spark, sf_dir, "store")))


def _per_prompt(df):
    return df.select(
        unpacked("prompt_key").alias("prompt_key"), "support",
        F.array_join(F.coalesce("sentences", F.array().cast("array<string>")), " | ")
        .alias("sentences"),
        "subject_mentioned", "object_mentioned", "reasoning",
    )


def _judged(spark, sf_dir, round2=False):
    """Judged answers per prompt; identical prompts (copied documents) report their
    smallest PMID."""
    p = _prompts(spark, sf_dir).withColumn("prompt_key", packed("prompt_key"))
    # what the recorded responses are made of is the same for all rows of a prompt
    keys = materialize_by(p.groupBy("prompt_key").agg(
        *[F.min(c).alias(c) for c in ("bare_pmid", "subject_curie", "predicate", "object_curie",
                                      "abstract_len", "est_tokens")]), "prompt_key", "keys")
    r = _responses(spark, sf_dir, keys)
    answers = ev.parsed_answers(keys.drop("abstract_len", "est_tokens"),
                                score.replay_rounds(r, (1, 2) if round2 else (1,)), round2)
    return judge.judged(answers.where(F.col("failure").isNull() | (F.col("failure") != judge.NO_RESPONSE)),
                        fixture(spark, sf_dir, "store"), round2)


@query
def parse_responses(spark, sf_dir):
    """Recorded round-1 answers parsed (before verification)."""
    said = score.replay_rounds(_responses(spark, sf_dir), (1,))
    parsed = judge.parse_responses(said.select("prompt_key", "r1.*"))
    return parsed.select(
        unpacked("prompt_key").alias("prompt_key"), "support",
        F.array_join(F.coalesce("sentences", F.array().cast("array<string>")), " | ")
        .alias("sentences"),
        "subject_mentioned", "object_mentioned", "reasoning", "failure")


@query
def judge_round1(spark, sf_dir):
    """O7 + O9: quotes verified against the abstract; unverified yes -> maybe."""
    return _per_prompt(_judged(spark, sf_dir))


@query
def rules(spark, sf_dir):
    """F18 on round-1 answers."""
    return _per_prompt(judge.apply_rules(_judged(spark, sf_dir)))


@query
def second_round(spark, sf_dir):
    """O10 + F18: yes/maybe answers re-asked; round 2 replaces or annotates."""
    return _per_prompt(judge.apply_rules(_judged(spark, sf_dir, round2=True)))


def _results(spark, sf_dir):
    t = fixture(spark, sf_dir, "triples")
    a = fixture(spark, sf_dir, "store")
    r = _responses(spark, sf_dir)
    results, _ = ev.evaluate(t, a, entities=_entity_table(spark, sf_dir),
                             predicates=_predicate_table(spark, sf_dir),
                             responses=r, round2=True, model_max_len=MODEL_MAX_LEN)
    return results


@query
def evaluate_results(spark, sf_dir):
    """The whole evaluation with replayed answers and a second round."""
    return _results(spark, sf_dir)


#: Answers that no careful model gives, by doc_id: (content, support, sentences, failure).
HOSTILE = [
    ('{"support": "yes", "sentences": 3}', "no", "", "'int' object is not iterable"),
    ('{"support": "yes", "sentences": true}', "no", "", "'bool' object is not iterable"),
    ('{"support": "yes", "sentences": ["a", 5]}', "no", "", "'int' object has no attribute 'strip'"),
    ('{"support": 1.5}', "no", "", "'float' object has no attribute 'lower'"),
    ('{"support": "maybe", "reasoning": null, "sentences": ["\\ud800 x"]}', "maybe", "? x", None),
    ("```json\n[1]\n```", "no", "", "'list' object has no attribute 'get'"),
    ("```json\n```", "no", "", "Empty JSON content extracted."),
    ('"support": "Yes", "sentences": ["one \\"two\\"", " "', "yes", "", None),
    ('"support": "Yes", "sentences": ["one \\"two\\"", " "]', "yes", 'one "two"', None),
    ("} no braces {", "no", "", None),
    ('{"support": "yes", "sentences": {"key": 1}}', "yes", "key", None),
    ('{"support": "yes", "sentences": ["The cat sat.", null, 0, false]}', "yes", "The cat sat.|||", None),
]


@query
def parse_hostile(spark, sf_dir):
    """F13-F19 on answers made from every document: odd types, odd JSON, and the document's
    own text as a reasoning string in an unclosed object."""
    fixture(spark, sf_dir, "triples")
    d = driver_table(spark, sf_dir, "documents")
    forms = F.array(*[F.lit(h[0]) for h in HOSTILE])
    n = len(HOSTILE)
    content = F.when(F.col("doc_id") % (n + 2) < n, F.get(forms, (F.col("doc_id") % (n + 2)).cast("int"))) \
        .when(F.col("doc_id") % (n + 2) == n, F.concat(F.lit('{"support": "maybe", "x": '), F.repeat(F.lit("9"), F.lit(5000)), F.lit("}"))) \
        .otherwise(F.concat(F.lit('{"is_supported": true, "reasoning": "'), F.col("text"), F.lit('"')))
    r = d.select(F.col("doc_id").alias("prompt_key"), content.alias("content"), F.lit(None).cast("string").alias("error"))
    p = judge.parse_responses(r)
    return p.select("prompt_key", "support", F.array_join("sentences", "|").alias("sentences"),
                    F.when(F.col("failure").startswith("Exceeds the limit"), "too large").otherwise(F.col("failure"))
                    .alias("failure"))


def _by_length(prompts, _max_tokens):
    """A scorer whose answer depends on the prompt's length alone."""
    return [('{"support": "%s"}' % ("yes", "maybe", "no")[len(x) % 3], len(x) // 4, 5) for x in prompts]


def _by_length_again(prompts, _max_tokens):
    if any(len(x) % 5 == 0 for x in prompts):
        raise RuntimeError("no answer")
    return [('{"support": "%s"}' % ("maybe", "no")[len(x) % 2], len(x) // 4, 5) for x in prompts]


@query
def live_evaluate(spark, sf_dir):
    """O8 + O10 + O11 live: every distinct prompt is asked once, those left at yes or maybe
    once more; a call that fails takes no other prompt with it."""
    t, a = fixture(spark, sf_dir, "triples"), fixture(spark, sf_dir, "store")
    out, _ = ev.evaluate(t, a, entities=_entity_table(spark, sf_dir), predicates=_predicate_table(spark, sf_dir),
                         scorer=_by_length, round2=True, round2_scorer=_by_length_again)
    return out.groupBy(
        "support", F.col("reasoning").startswith("[Round2]").alias("asked_again"),
        F.col("reasoning").contains("[Round 2 failed: vLLM API error: no answer]").alias("failed_again"),
    ).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def evaluate_many(spark, sf_dir):
    """O12 + F20 + W1: each triple of a document with that PMID, one unknown and the PMID
    again; one row per request and place, whatever the store holds for it."""
    t, a = fixture(spark, sf_dir, "triples"), fixture(spark, sf_dir, "store")
    n = F.col("bare_pmid").cast("long")
    a = a.withColumns({  # errors and blanks of all kinds beside good abstracts
        "error": F.when(n % 5 == 0, "").when(n % 5 == 1, "down").otherwise(F.col("error")),
        "abstract": F.when(n % 7 == 0, " \t").when(n % 7 == 1, None).otherwise(F.col("abstract"))})
    req = t.select("subject_curie", "predicate", "object_curie", "line_id",
                   F.array(F.col("PMID"), F.lit("PMID:none"), F.col("PMID")).alias("pmids"))
    out = ev.evaluate_many(req, a, scorer=lambda prompts, _: [('{"support": "no", "reasoning": "ok"}', 1, 1)] * len(prompts))
    return out.select("line_id", "pmid_index", "PMID", "support", "reasoning")


@query
def support_counts(spark, sf_dir):
    """A4: yes / maybe / no counts over the results."""
    return rep.support_counts(_results(spark, sf_dir))


@query
def triple_summary(spark, sf_dir):
    """A5: per triple, counts and percentages over its PMIDs."""
    return rep.triple_summary(_results(spark, sf_dir),
                              by=["subject_curie", "predicate", "object_curie"])


# ------------------------------------------------------------ text


@query
def verify_quotes(spark, sf_dir):
    """O7 (F21-F27): quotes cut from each document, verified against it."""
    v = fixture(spark, sf_dir, "quotes")
    return pas.verify_table(v).select("row_id", "kind", "verified")


@query
def sentence_split(spark, sf_dir):
    """sentences per document (count and total characters)."""
    return pas.sentence_stats(driver_table(spark, sf_dir, "documents"))


@query
def benchmark_passages(spark, sf_dir):
    """F25 'contained': benchmark passages found verbatim in documents."""
    return pas.passages_in_documents(driver_table(spark, sf_dir, "documents"), driver_table(spark, sf_dir, "benchmark"))


# ------------------------------------------------------------ ingest


@query
def xml_ingest(spark, sf_dir):
    """Article XML answers parsed into store rows; unanswered ids -> not found."""
    rows = articles_src.ingest_articles(nested.articles(spark, sf_dir),
                                        fixture(spark, sf_dir, "xml_requests"),
                                        fetch_date="2024-03-01T00:00:00")
    return rows.select("bare_pmid", "title", "abstract", "error")


# ------------------------------------------------------------ legacy, sinks

_CATEGORY = {"yes": "Direct support", "maybe": "Missing qualifier", "no": "Not supported"}


@query
def legacy_log(spark, sf_dir):
    """F28 + F29 + F30: judged answers written as legacy text logs (a draft line
    then the final one) and parsed back; also the 13-field TSV line."""
    fin = judge.apply_rules(_judged(spark, sf_dir))
    cat = F.when(F.col("support") == "yes", F.lit(_CATEGORY["yes"])) \
        .when(F.col("support") == "maybe", F.lit(_CATEGORY["maybe"])) \
        .otherwise(F.lit(_CATEGORY["no"]))
    yn = lambda c: F.when(c, F.lit("Yes")).otherwise(F.lit("No"))
    status = F.concat(
        F.lit("PMID:"), F.col("bare_pmid"), F.lit(", "),
        F.when(F.col("support") == "yes", F.lit("Supported")).otherwise(F.lit("Not Supported")),
        F.lit(", "), cat, F.lit(", Subject:"), yn(F.col("subject_mentioned")),
        F.lit(", Object:"), yn(F.col("object_mentioned")),
        F.when(F.size("sentences") > 0,
               F.concat(F.lit(", ["), F.array_join("sentences", " | "), F.lit("]")))
        .otherwise(F.lit("")))
    log = F.concat(
        F.lit("PMID:"), F.col("bare_pmid"), F.lit(", Not Supported, Draft, Subject:No, Object:No\n"
                                                  "Reasoning: draft\n\n"),
        status, F.lit("\nReasoning: "), F.col("reasoning"), F.lit("\n\n"))
    parsed = legacy.parse_legacy_log(log)
    return fin.select(
        unpacked("prompt_key").alias("prompt_key"),
        F.when(parsed.getField("is_supported"), F.lit("True")).otherwise(F.lit("False"))
        .alias("is_supported"),
        parsed.getField("evidence_category").alias("evidence_category"),
        parsed.getField("subject_mentioned").alias("subject_mentioned"),
        parsed.getField("object_mentioned").alias("object_mentioned"),
        parsed.getField("supporting_sentence").alias("supporting_sentence"),
        parsed.getField("reasoning").alias("reasoning"),
        legacy.tsv_line(F.col("subject_curie"), F.col("predicate"), F.col("object_curie"),
                        F.lit(""), F.col("bare_pmid"), parsed, F.col("subject_curie"),
                        F.col("object_curie")).alias("tsv_line"),
        legacy.format_output(F.col("bare_pmid"), F.col("support"), F.col("subject_mentioned"),
                             F.col("object_mentioned"), F.col("sentences")).alias("summary_line"),
    )


@query
def tsv_sanitize(spark, sf_dir):
    """Document text made safe for one TSV field."""
    d = driver_table(spark, sf_dir, "documents")
    return d.select("doc_id", sinks.sanitize_tsv(F.col("text")).alias("text"))


@query
def convert_results(spark, sf_dir):
    """S13 (+ Q1 text form): results without runtime_seconds, as text values."""
    return sinks.as_text(sinks.convert_results(_results(spark, sf_dir)))


# ------------------------------------------------------------ streaming


@query
def stream_evaluate(spark, sf_dir):
    """Section 2.7: the evaluation as a file stream (rows dealt by 4-key, so repeated
    keys share a file and a micro-batch); equals the batch result."""
    from ..session import ensure_checkpoint_dir, write_stage

    t = fixture(spark, sf_dir, "triples")
    source_dir = write_stage(t.repartition(*KEY_COLUMNS), "stream-source")
    n_files = len(spark.read.parquet(source_dir).inputFiles())
    base = ensure_checkpoint_dir(spark).rstrip("/")
    import uuid

    out = f"{base}/attestor-stream-results-{uuid.uuid4().hex}"
    r = _responses(spark, sf_dir)
    results = stream_op.stream_evaluate(
        spark, source_dir, t.schema, fixture(spark, sf_dir, "store"), out,
        files_per_batch=max(1, -(-n_files // 2)),
        entities=_entity_table(spark, sf_dir), predicates=_predicate_table(spark, sf_dir),
        responses=r, round2=True, model_max_len=MODEL_MAX_LEN)
    return results.withColumn("line_id", F.col("line_id").cast("long"))


# ------------------------------------------------------------ files and batches


def _folder(spark, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    import uuid

    from ..session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/attestor-{name}-{uuid.uuid4().hex}"


@query
def request_batches(spark, sf_dir):
    """Batches of 200 of the sorted ids to ask for."""
    return kg.request_batches(fixture(spark, sf_dir, "xml_requests"), "bare_pmid", 200)


@query
def coverage_gaps(spark, sf_dir):
    """A15 + X2 + X3 on the output of a faulty run."""
    return cov.coverage(*[fixture(spark, sf_dir, x) for x in ("triples", "audit_results", "audit_no_abstract")])


@query
def coverage_samples(spark, sf_dir):
    """X2 + X3 + W4: the first ten keys that are missing, and that are too many."""
    missing, extra = cov.coverage_samples(
        *[fixture(spark, sf_dir, x) for x in ("triples", "audit_results", "audit_no_abstract")])
    return missing.withColumn("side", F.lit("missing")).unionByName(extra.withColumn("side", F.lit("extra")))


@query
def metric_modes(spark, sf_dir):
    """F31 + A6 + A7: the three ways to read labels."""
    labels = fixture(spark, sf_dir, "spoken_labels")
    out = None
    for mode in ("strict", "eval_script", "lenient"):
        m = rep.class_metrics(labels, mode=mode).select(
            F.lit(mode).alias("mode"), "accuracy", "total_samples", "valid_predictions", "tn", "fp", "fn", "tp")
        out = m if out is None else out.unionByName(m)
    return out


@query
def altered_quotes(spark, sf_dir):
    """F24 + F26: quotes with gaps, with a letter changed, and with more than that."""
    return pas.verify_table(fixture(spark, sf_dir, "altered_quotes")).select("row_id", "kind", "verified")


@query
def names_file(spark, sf_dir):
    """S4 + S15 + J5: a names file with repeated curies, written, read back and merged."""
    path = _folder(spark, "names")
    lines = fixture(spark, sf_dir, "name_lines").orderBy("line").select("curie_id", "all_names")
    lines.write.csv(path, sep="\t", header=True)
    parts = driver_table(spark, sf_dir, "part").select(
        F.concat(F.lit("PART:"), F.col("p_partkey").cast("string")).alias("curie"), F.col("p_name").alias("name"),
        F.lit("c").alias("category"), F.lit("").alias("description"), F.array("p_name").alias("all_names"))
    return _joined(en.merge_names(parts, kg.read_names_tsv(spark, path))).select("curie", "all_names")


@query
def predicates_file(spark, sf_dir):
    """S5 + W3: the sorted predicates file, written and read back; place in the file."""
    path = _folder(spark, "predicates")
    kg.write_predicates_tsv(preds.sorted_predicates(fixture(spark, sf_dir, "slots")), path)
    place = F.row_number().over(Window.orderBy("line"))
    lines = kg.positioned(spark.read.csv(path, sep="\t", header=True, escape='"')).select("predicate", place.alias("place"))
    return kg.read_predicates_tsv(spark, path).join(lines, "predicate")


@query
def edges_file(spark, sf_dir):
    """S2 + S14 + O1: edge records as JSON lines, read, extracted, stored and read back."""
    path, out = _folder(spark, "edges"), _folder(spark, "edges-out")
    nested.edges(spark, sf_dir).orderBy("_pos").drop("_pos").write.json(path, compression="gzip")
    sinks.write_edges(edges_op.extract_edges(edges_op.read_edges(spark, path)), out)
    return spark.read.parquet(out)


@query
def nodes_file(spark, sf_dir):
    """S3 + O2: node records as JSON lines with both forms of category, matched."""
    path = _folder(spark, "nodes") + ".jsonl"
    rows = nested.nodes(spark, sf_dir).orderBy("line")

    def record(category):
        return F.to_json(F.struct("id", "name", category.alias("category"), "description", "equivalent_curies",
                                  "equivalent_identifiers", "all_names"))

    text = F.when(F.col("category").startswith("["), record(F.from_json("category", "array<string>"))) \
        .otherwise(record(F.col("category")))
    rows.select(text.alias("value")).write.text(path)
    targets = en.unique_curies(fixture(spark, sf_dir, "triples"))
    return _joined(en.load_entities(kg.read_nodes(spark, path), targets))


@query
def nodes_dict_file(spark, sf_dir):
    """S3: entities as pre-built {curie: {...}} files, their entries cut apart again."""
    path = _folder(spark, "dict") + ".json"
    d = driver_table(spark, sf_dir, "documents").select(
        F.concat(F.lit("DOC:"), F.col("doc_id").cast("string")).alias("curie"), "doc_id",
        F.struct(F.coalesce("source", F.lit("")).alias("name"), F.coalesce("lang", F.lit("")).alias("category"),
                 F.concat(F.lit('"{'), F.coalesce("text", F.lit("")), F.lit('}\\')).alias("description")).alias("info"))
    # an object of its own per row, put together without their braces: keys may come twice
    pair = F.to_json(F.map_from_arrays(F.array("curie"), F.array("info")))
    d = d.select("curie", "doc_id", pair.alias("pair"))
    pairs = F.array_sort(F.collect_list(F.struct("curie", "pair")))
    one = d.groupBy(F.floor(F.col("doc_id") / 100).alias("block")).agg(F.concat(
        F.lit("{"), F.array_join(F.transform(
            pairs, lambda x: F.substring(x["pair"], F.lit(2), F.length(x["pair"]) - 2)), ","),
        F.lit("}")).alias("value"))
    one.select("value").write.text(path)
    return kg.read_nodes(spark, path).select(
        "id", "name", "category", F.sha2("description", 256).alias("description_sha"))


@query
def token_file(spark, sf_dir):
    """A12's file reader: a token file with a header and short lines, written and read."""
    path = _folder(spark, "tokens")
    t = fixture(spark, sf_dir, "tokens")
    cols = ["id", "prompt", "completion", "total", "cached", "uncached"]
    t.select(F.array_join(F.array(*cols), "\t").alias("id\tusage")) \
        .unionByName(t.select(F.concat_ws("\t", "id", "prompt").alias("id\tusage"))) \
        .write.csv(path, sep="\x01", quote="", header=True)
    return rep.token_stats(rep.token_lines(spark, path))


@query
def triples_file(spark, sf_dir):
    """S1 + F2: triples as a quoted TSV with blanks and quotes in a further column."""
    path = _folder(spark, "triples")
    t = fixture(spark, sf_dir, "triples")
    t.select(*KEY_COLUMNS, F.concat(F.lit('say "'), F.col("predicate"), F.lit('"\tand go')).alias("note"),
             F.when(F.col("line_id") % 2 == 0, "True").otherwise("False").alias("Supported")) \
        .write.csv(path, sep="\t", header=True, escape='"')
    return triples_src.read_triples(spark, path)


@query
def no_abstract_sink(spark, sf_dir):
    """S10 + S7: rows without an abstract, replaced in their sink; a store that was cleared
    has none for any row."""
    t, a = fixture(spark, sf_dir, "triples"), fixture(spark, sf_dir, "store")
    path = _folder(spark, "no-abstract")
    _, all_of_them = st.split_by_abstract(t, st.clear(a))
    sinks.write_no_abstract(all_of_them, path)
    _, without = st.split_by_abstract(t, a)
    sinks.write_no_abstract(without, path)
    sinks.write_no_abstract(without.limit(0), path)
    return spark.read.parquet(path).drop("bare_pmid")


@query
def report_file(spark, sf_dir):
    """A report as JSON at its companion path, read back."""
    path = sinks.companion_paths(_folder(spark, "out") + "_results.parquet")["metrics"]
    sinks.write_report(rep.class_metrics(fixture(spark, sf_dir, "labels")), path)
    return spark.read.json(path)
