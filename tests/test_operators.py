"""Spark operator tests on small frames."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from attestor.functions.keys import normalize_pmid
from attestor.functions.legacy import parse_legacy_log
from attestor.operators import coverage, edges, entities, predicates, reports, resume
from attestor.operators import store as st
from attestor.sources import articles
from attestor.sources.sinks import sanitize_tsv


def test_normalize_pmid(spark):
    df = spark.createDataFrame([(" PMID:12 ",), ("pmid: 7",), ("99",), ("\tPmId:1\t",)], ["p"])
    got = [r[0] for r in df.select(normalize_pmid("p")).collect()]
    assert got == ["12", " 7", "99", "1"]


def test_upsert_later_batch_wins(spark):
    cols = list(st.STORE_COLUMNS)
    old = spark.createDataFrame([("1", "t", "a", "d1", None), ("2", "", "", "d1", "x")], cols)
    new = spark.createDataFrame([("2", "t2", "b", "d2", None, 0), ("2", "t3", "c", "d2", None, 1),
                                 ("3", "", "", "d2", "y", 0)], cols + ["pos"])
    out = {r.bare_pmid: r.abstract for r in st.upsert(old, new, "pos").collect()}
    assert out == {"1": "a", "2": "c", "3": ""}


def test_resume_is_idempotent(spark):
    t = spark.createDataFrame([("s", "p", "o", "1"), ("s", "p", "o", "1"), ("s", "p", "o", "2")],
                              ["subject_curie", "predicate", "object_curie", "PMID"])
    done = t.limit(0)
    first = resume.pending(t, done)
    assert first.count() == 3  # duplicates all evaluated on a first run
    second = resume.pending(t, first)
    assert second.count() == 0


def test_coverage_and_partition_invariance(spark):
    keys = ["subject_curie", "predicate", "object_curie", "PMID"]
    inp = spark.createDataFrame([("a", "p", "b", str(i % 7)) for i in range(50)], keys)
    res = inp.filter(F.col("PMID") < "4")
    na = inp.filter(F.col("PMID") >= "4")
    r1 = coverage.coverage(inp, res, na).collect()[0]
    r2 = coverage.coverage(inp.repartition(5), res.repartition(3), na.coalesce(1)).collect()[0]
    assert r1 == r2
    assert r1.input_rows == 50 and r1.input_unique == 7 and r1.perfect
    assert r1.coverage_pct == 100.0


def test_predicate_closure(spark):
    slots = spark.createDataFrame(
        [("related to", None, "root"), ("a", "related to", " x\n y "), ("b", "a", None),
         ("z", "orphan", "no")], "name string, is_a string, description string")
    got = {r.predicate: r.description for r in predicates.predicate_closure(slots).collect()}
    assert got == {"biolink:related_to": "root", "biolink:a": "x y", "biolink:b": ""}


def test_deep_closure_takes_few_steps(spark, monkeypatch):
    steps = []
    write = predicates.materialize
    monkeypatch.setattr(predicates, "materialize", lambda df, name: steps.append(1) or write(df, name))
    n = 10_000
    slots = spark.range(n + 1).select(
        F.when(F.col("id") == 0, "related to").otherwise(F.concat(F.lit("s"), "id")).alias("name"),
        F.when(F.col("id") == 1, "related to").when(F.col("id") > 1, F.concat(F.lit("s"), F.col("id") - 1)).alias("is_a"))
    off = spark.createDataFrame([("c1", "c2"), ("c2", "c1"), ("lost", "nowhere"), ("lone", None), (None, "related to")],
                                "name string, is_a string")
    assert predicates.descendants(slots.unionByName(off)).count() == n + 1
    assert len(steps) < 20
    branch = spark.createDataFrame([("r", None), ("r", "up"), ("a", "r"), ("b", "x"), ("b", "a"), ("c", "b")],
                                   "name string, is_a string")
    assert sorted(x.name for x in predicates.descendants(branch, "r").collect()) == ["a", "b", "c", "r"]
    try:
        predicates.descendants(slots, "none")
    except KeyError:
        return
    raise AssertionError("a root that is no slot")


def test_edge_reader_and_extract(spark, tmpdir_path):
    recs = [
        {"subject": "S", "predicate": "p", "object": "O", "publications": ["P1", "P2"],
         "has_supporting_studies": {"s": {"has_study_results": [
             {"xref": ["P1"], "supporting_text": ["t1", "ignored"]},
             {"xref": ["P1"], "supporting_text": ["t2"]},
             {"xref": [], "supporting_text": ["t3"]}]}}},
        {"subject": "S", "predicate": "p", "object": "O", "publications": ["P1"],
         "publications_info": {"P1": {"sentence": "t1"}, "P9": {"sentence": "zz"}}},
        {"subject": "S", "predicate": "p", "object": "O", "publications": ["P1"],
         "publications_info": {"P1": {"sentence": "t0"}}},
    ]
    path = os.path.join(tmpdir_path, "edges.jsonl")
    with open(path, "w") as f:
        for r in recs:
            f.write(json.dumps(r) + "\n\n")
    out = edges.extract_edges(edges.read_edges(spark, path))
    got = {r.PMID: r.SemMedDB_sentences for r in out.collect()}
    assert got == {"P1": "t1 | t2 | t0", "P2": ""}


def test_edges_equal_plain_version(spark):
    """Many publications a record, repeated and unknown ones, hot keys, no texts at all."""
    import random
    from collections import OrderedDict

    rng = random.Random(2)
    recs = []
    for i in range(120):
        pubs = [f"P{rng.randrange(6 if i % 3 else 400)}" for _ in range(rng.choice([0, 1, 3, 300]))]
        result = lambda: {"xref": rng.choice([[], ["P1"], [f"P{rng.randrange(9)}", "P2"]]),
                          "supporting_text": rng.choice([[], [f"t{rng.randrange(5)}"], ["u", "no"], [""]])}
        studies = {"a": {"has_study_results": [result() for _ in range(rng.choice([0, 2, 200]))]}, "b": {}}
        legacy = {f"P{rng.randrange(9)}": {"sentence": rng.choice(["", "l1", "l2"])} for _ in range(3)}
        recs.append({"subject": f"S{i % 2}", "predicate": "p", "object": "O", "publications": pubs,
                     **({"has_supporting_studies": studies} if i % 4 else {}), "publications_info": legacy, "_pos": i})
    want, without = OrderedDict(), 0
    for r in recs:
        texts = {}
        for study in r.get("has_supporting_studies", {}).values():
            for x in study.get("has_study_results", []):
                if x["xref"] and x["supporting_text"]:
                    texts.setdefault(x["xref"][0], []).append(x["supporting_text"][0])
        if not r.get("has_supporting_studies"):
            for p, x in r["publications_info"].items():
                if x["sentence"]:
                    texts.setdefault(p, []).append(x["sentence"])
        for p in r["publications"]:
            row = want.setdefault((r["subject"], p), [])
            row += [t for t in dict.fromkeys(texts.get(p, [])) if t not in row]
            without += p not in texts
    schema = T.StructType([*edges.EDGE_SCHEMA.fields, T.StructField("_pos", T.LongType())])
    df = spark.createDataFrame(recs, schema).repartition(5)
    got = {(r.subject_curie, r.PMID): r.SemMedDB_sentences for r in edges.extract_edges(df).collect()}
    assert got == {k: " | ".join(v) for k, v in want.items()}
    assert tuple(edges.edge_stats(df).first()) == (120, len(want), sum(len(v) > 1 for v in want.values()), without)
    assert tuple(edges.edge_stats(df.where("false")).first()) == (0, 0, 0, 0)
    first = {r.PMID for r in edges.extract_edges(df, limit=7).collect()}
    assert first == {p for r in recs[:7] for p in r["publications"]}


def test_node_match_stop_line(spark):
    nodes = spark.createDataFrame(
        [(1, "A", "a1", "c", "d", None, ["X"], None),
         (2, "B", "b1", '["k1", "k2"]', "", None, None, ["b", "bb"]),
         (3, "X", "a-late", "c", "d", None, None, None)],
        "line long, id string, name string, category string, description string, "
        "equivalent_curies array<string>, equivalent_identifiers array<string>, "
        "all_names array<string>")
    targets = spark.createDataFrame([("X",), ("B",)], ["curie"])
    got = {r.curie: (r.name, r.category, r.all_names)
           for r in entities.load_entities(nodes, targets).collect()}
    # all targets are found by line 2, so line 3 never overwrites X (Q3)
    assert got == {"X": ("a1", "c", ["a1"]), "B": ("b1", "k1", ["b", "bb"])}


def test_class_metrics_matches_published_counts(spark):
    rows = ([("True", "True")] * 33 + [("False", "False")] * 7 + [("False", "True")] * 7
            + [("True", "False")] * 3)
    df = spark.createDataFrame(rows, ["ground_truth", "predicted"])
    m = reports.class_metrics(df).collect()[0]
    assert (m.tp, m.tn, m.fp, m.fn) == (33, 7, 7, 3)
    assert m.accuracy == 0.8 and m.precision == 0.825 and m.specificity == 0.5


def test_legacy_parser_last_line_and_fallback(spark):
    text = ("PMID:1, Not Supported, Draft, Subject:No, Object:No\nReasoning: a\n\n"
            "PMID:1, Supported, Direct support, Subject:Yes, Object:No, [s\tone]\n"
            "Reasoning: final\nreason\n\n")
    df = spark.createDataFrame([(text,), ("it was Not Supported",)], ["t"])
    a, b = [r[0] for r in df.select(parse_legacy_log(F.col("t"))).collect()]
    assert a.is_supported and a.evidence_category == "Direct support"
    assert a.supporting_sentence == "s one" and a.reasoning == "final reason"
    assert b.is_supported is False
    c = df.select(parse_legacy_log(F.col("t"), legacy=True)).collect()[1][0]
    assert c.is_supported is True  # Q10 quirk kept under legacy=True


def test_sanitize_and_articles(spark):
    df = spark.createDataFrame([('a\r\nb\tc"d\re',)], ["t"])
    assert df.select(sanitize_tsv(F.col("t"))).collect()[0][0] == "a b c'd e"
    xml = ("<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>5</PMID><Article>"
           "<ArticleTitle> T <i>x</i> </ArticleTitle><Abstract>"
           "<AbstractText Label='B'>one <sup>2</sup> two</AbstractText>"
           "<AbstractText> </AbstractText><AbstractText>three</AbstractText>"
           "</Abstract></Article></MedlineCitation></PubmedArticle></PubmedArticleSet>")
    old = xml.replace("three", "two")
    docs = spark.createDataFrame([(2, "a", xml), (1, "a", old), (3, "b", "<x><PMID>7</PMID>"), (4, "c", None)],
                                 "n int, batch string, xml string")
    req = spark.createDataFrame([("5", "a"), ("PMID:6", "a"), ("7", "b")], ["bare_pmid", "batch"])
    got = {r.bare_pmid: (r.title, r.abstract, r.error)
           for r in articles.ingest_articles(docs, req, "d", request="batch", order="n").collect()}
    assert got["5"] == ("T x", "B: one 2 two three", None)  # the later answer wins
    assert got["6"][2] == "PMID not found or could not be retrieved"
    assert got["7"][2].startswith("Extraction failed: ") and len(got) == 3


def test_quantiles_are_exact(spark):
    import random

    import numpy as np

    rng = random.Random(1)
    for n in (1, 2, 7, 500):
        values = [rng.choice([1.0, 2.5, rng.random() * 9]) for _ in range(n)]
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(5)
        got = reports.quantiles(df, "x", (0.0, 0.25, 0.5, 0.95, 1.0)).first().q
        assert np.allclose(got, np.quantile(values, (0.0, 0.25, 0.5, 0.95, 1.0)))
    empty = spark.createDataFrame([], "x double")
    assert reports.quantiles(empty, "x", (0.5,)).first().q == [None]


def test_broadcasts_are_measured_in_memory(spark):
    """Texts that files store once count for every row."""
    from attestor import session

    rows = spark.range(4000).select(F.col("id").cast("string").alias("curie"), F.lit("x" * 2000).alias("name"))
    stored, fit = session.small_side(rows, max_bytes=4 << 20)
    assert session.stored_bytes(stored) * 8 < 4 << 20 and not fit
    assert session.small_side(rows, max_bytes=16 << 20)[1]
    assert not session.fits(stored, stored, max_bytes=16 << 20)  # together beyond it
    assert stored.agg(F.sum(session.row_bytes(stored))).first()[0] >= 4000 * 2000


def test_entities_are_named_with_and_without_broadcasts(spark, monkeypatch):
    from attestor import session

    t = spark.createDataFrame([("s1", "p", "o1"), ("s1", "p", "none"), (None, "p", "o1")],
                              "subject_curie string, predicate string, object_curie string")
    e = spark.createDataFrame([("s1", "S", "c", "", ["a"]), ("o1", "O", "c", "d", None)],
                              "curie string, name string, category string, description string, all_names array<string>")
    few = sorted(map(repr, entities.with_entities(t, e).collect()))
    monkeypatch.setattr(session.fits, "__kwdefaults__", {"max_bytes": 0})
    assert "Broadcast" not in entities.named_columns(t, e)._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(repr, entities.with_entities(t, e).collect())) == few


def test_one_answer_per_prompt_with_one_shuffle(spark):
    from attestor.operators import score

    r = spark.createDataFrame([("a", 1, "m", c, None, 1.0, 1, 1) for c in ("x", "z", "y")] + [("b", 1, "m", None, "e", 1.0, 1, 1)],
                              score.RESPONSE_SCHEMA)
    got = score.replay(r)
    assert sorted((x.prompt_key, x.content) for x in got.collect()) == [("a", "z"), ("b", None)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1


def test_driver_tables_of_a_new_session_and_repeated_keys(spark, tmpdir_path):
    """A query that reads a driver table is the first one to run, on rows that repeat."""
    import __spark_entry__ as entry

    rows = [(i, "en", "web", f'text {i} "}}{{ \\') for i in (1, 2, 2, 150)] + [(2, "fr", None, None)]
    spark.createDataFrame(rows, "doc_id long, lang string, source string, text string").write.parquet(
        f"{tmpdir_path}/documents.parquet")
    fresh = spark.newSession()
    import attestor.plans.fixtures as fx
    kept, fx.FLAT = fx.FLAT, {}
    try:
        got = entry.queries()["nodes_dict_file"](fresh, tmpdir_path).select("id", "name", "category").collect()
    finally:
        fx.FLAT = kept
        fx._REGISTERED.clear()
    assert sorted(map(tuple, got)) == [("DOC:1", "web", "en"), ("DOC:150", "web", "en"), ("DOC:2", "", "fr"),
                                       ("DOC:2", "web", "en"), ("DOC:2", "web", "en")]


def test_quotes_are_decomposed_row_by_row(spark):
    from attestor.functions import quotes as q

    df = spark.createDataFrame([(["ﬁne", "é"],), (None,), ([],), (["x"] * 600,)], "t array<string>").coalesce(1)
    assert [r[0] for r in df.select(q.decomposed("t")).collect()] == [["fine", "é"], None, [], ["x"] * 600]


def test_few_and_many_citations_give_the_same(spark):
    import random

    from attestor.operators import edges as e

    rng = random.Random(3)
    pmids = ["a", "b", "B", "", "é", None]
    rows = [(i, None if i % 9 == 0 else [rng.choice(pmids) for _ in range(rng.randrange(7))],
             [(rng.choice(pmids), rng.choice(["x", "y", "", None])) for _ in range(rng.randrange(6))]) for i in range(80)]
    df = spark.createDataFrame(rows, "i int, p array<string>, t array<struct<pmid:string,text:string>>")
    given = F.coalesce("p", F.array().cast("array<string>"))
    both = df.select(e._cited_few(given, F.col("t")).alias("few"), e._cited_many(F.col("p"), F.col("t")).alias("many"),
                     e._cited(F.col("p"), F.col("t")).alias("any")).collect()
    assert all(r.few == r.many == r.any for r in both) and any(r.few for r in both)
    plan = df.select(e._cited(F.col("p"), F.col("t")).alias("any"))
    assert e.FEW_PAIRS > 0 and "array_position" in plan._jdf.queryExecution().optimizedPlan().toString()


def test_prompts_meet_abstracts_unsorted_and_are_counted_in_parts(spark, monkeypatch):
    from attestor.functions import prompt as P
    from attestor.operators import prompts

    texts = {"1": "Straße → 東京 😀.", "2": "plain", "3": "é" * 500, "4": None}
    store = spark.createDataFrame([(p, "t", t, "d", None) for p, t in texts.items()],
                                  "bare_pmid string, title string, abstract string, fetch_date string, error string")
    triples = spark.createDataFrame(
        [("C:1", "inhibits", "C:2", "PMID:1"), ("C:1", "biolink:acts_on", "C:☃", "pmid:2"), ("C:2", "ß", "C:1", "3"),
         ("C:2", "ß", "C:1", "3"), ("C:9", "inhibits", None, "PMID:3"), ("C:1", "ß", "C:2", "4"), ("C:1", "ß", "C:2", None)],
        "subject_curie string, predicate string, object_curie string, PMID string")
    known = spark.createDataFrame([("C:1", "näme", "cat", "→", ["ä", "b"]), ("C:2", "", None, "", [])],
                                  "curie string, name string, category string, description string, all_names array<string>")
    defined = spark.createDataFrame([("inhibits", "wörds")], "predicate string, description string")
    monkeypatch.setattr(entities, "fits", lambda *frames, **kw: False)
    rows, _ = st.split_by_abstract(triples, store)
    built = prompts.build_prompts(rows, store, known, defined, with_text=True)
    got = built.collect()
    assert len(got) == 5 and built.columns[-4:] == ["title", "abstract", "prompt", "text_chars"]
    assert sum(r.prompt is None for r in got) == 1  # without an object there is no text, as before
    for r in got:
        assert r.text_chars == r.prompt_chars == (None if r.prompt is None else len(r.prompt))
        assert r.prompt is None or (texts[r.bare_pmid] in r.prompt and P.MATCHING_RULES in r.prompt)
    keys = prompts.build_prompts(rows, store, known, defined)
    assert sorted(r.prompt_key for r in keys.collect()) == sorted(r.prompt_key for r in got)
    plan = built._jdf.queryExecution().sparkPlan().toString().splitlines()
    last = next(i for i, line in enumerate(plan) if "Join" in line)
    assert "ShuffledHashJoin [bare_pmid" in plan[last]
    # what is made of what was looked up does not travel
    above, below = "".join(plan[:last]), "".join(plan[last:])
    assert all(c in above and c not in below for c in ("AS prompt_key", "AS _sec_triple", "AS _sec_predicate"))
