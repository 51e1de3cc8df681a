"""File readers, batching, live scoring and evaluate-many."""

import json
import os

import pytest
from pyspark.sql import functions as F

from attestor.operators import entities, evaluate, score
from attestor.sources import kg


def test_node_readers(spark, tmpdir_path):
    lines = os.path.join(tmpdir_path, "nodes.jsonl")
    with open(lines, "w") as f:
        f.write(json.dumps({"id": "A", "name": "a", "category": ["c1", "c2"],
                            "equivalent_identifiers": ["X"]}) + "\n")
        f.write(json.dumps({"id": "B", "name": "b", "category": "c"}) + "\n")
    nodes = kg.read_nodes(spark, lines)
    targets = spark.createDataFrame([("X",), ("B",)], ["curie"])
    got = {r.curie: r.category for r in entities.load_entities(nodes, targets).collect()}
    assert got == {"X": "c1", "B": "c"}
    d = os.path.join(tmpdir_path, "dict.json")
    with open(d, "w") as f:
        json.dump({"A": {"name": "a", "category": "k", "description": "d"}}, f)
    assert [r.id for r in kg.read_nodes(spark, d).collect()] == ["A"]
    with pytest.raises(ValueError):
        kg.read_nodes(spark, os.path.join(tmpdir_path, "nodes.csv"))


def test_names_and_predicates_tsv(spark, tmpdir_path):
    n = os.path.join(tmpdir_path, "names.tsv")
    with open(n, "w") as f:
        f.write("curie_id\tall_names\nA\tx||y\nB\t\n")
    got = {r.curie_id: r.all_names for r in kg.read_names_tsv(spark, n).collect()}
    assert got == {"A": ["x", "y"], "B": []}
    p = os.path.join(tmpdir_path, "preds.tsv")
    with open(p, "w") as f:
        f.write("predicate\tdescription\nbiolink:treats\tfirst\nbiolink:treats\tsecond\n")
    got = {r.predicate: r.description for r in kg.read_predicates_tsv(spark, p).collect()}
    assert got == {"biolink:treats": "second"}
    assert kg.read_predicates_tsv(spark, p + ".missing").count() == 0


def test_request_batches(spark):
    ids = spark.createDataFrame([(str(i).zfill(3),) for i in range(25)], ["pmid"]).repartition(4)
    b = {r.pmid: r.batch for r in kg.request_batches(ids, "pmid", 10).collect()}
    assert b["000"] == 0 and b["009"] == 0 and b["010"] == 1 and b["024"] == 2


def test_request_batches_with_equal_ids(spark):
    ids = spark.createDataFrame([("same",)] * 500 + [(f"k{i}",) for i in range(500)], ["pmid"]).repartition(5)
    got = sorted((r.pmid, r.batch) for r in kg.request_batches(ids, "pmid", 7).collect())
    want = sorted(r.pmid for r in ids.collect())
    assert got == [(x, i // 7) for i, x in enumerate(want)]


def test_dict_file_cut_across_blocks(spark, tmpdir_path):
    """Braces, quotes and escapes in texts, nested objects, nulls, lists, several objects in
    a file; blocks far smaller than the file."""
    import random

    rng = random.Random(6)
    odd = ['a {b} "c" \\\\', "}{", '\\"', "x,y", "", "é} 日本", "{{{", "}}", "back\\\\", 'q"}"']
    data = {f"C:{i}{rng.choice(odd)}": {"name": rng.choice(odd), "category": rng.choice(["k", ["l}", "m"], None]),
                                        "description": rng.choice(odd) * rng.randrange(4),
                                        "more": {"deep": [{"er": rng.choice(odd)}]}} for i in range(400)}
    data["nothing"] = None
    data["empty"] = {}
    text = json.dumps(data, ensure_ascii=False, indent=1) + "\n" + json.dumps({"second": {"name": "z"}, "last": None}) + "\n\n"
    path = os.path.join(tmpdir_path, "dict.json")
    with open(path, "w") as f:
        f.write(text)
    want = [(k, None if v is None else v.get("name")) for k, v in data.items()] + [("second", "z"), ("last", None)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (700, 128 << 20):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            rows = kg.read_nodes(spark, path).orderBy("line").collect()
            assert [(r.id, r.name) for r in rows] == want
        by_id = {r.id: r for r in rows}
        for k, v in data.items():
            if v:
                c = by_id[k].category
                assert v["description"] == by_id[k].description
                assert (json.loads(c) if isinstance(v["category"], list) else c) == v["category"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_token_file_headers(spark, tmpdir_path):
    """The first line of each file is its header, also one of two fields."""
    from attestor.operators.reports import token_lines

    d = os.path.join(tmpdir_path, "tokens")
    os.makedirs(d)
    for i, header in enumerate(("id\tusage", "a\tb\tc\td\te\tf\tg", "h")):
        with open(os.path.join(d, f"{i}.tsv"), "w") as f:
            f.write(f"{header}\nr{i}\t1\t2\t3\t4\t5\nshort\t1\ns{i}\t\"1\t2\t3\t4\t5\textra \n\n")
    got = sorted((r.id, r.prompt, r.uncached) for r in token_lines(spark, d).collect())
    assert got == sorted([(f"r{i}", "1", "5") for i in range(3)] + [(f"s{i}", '"1', "5") for i in range(3)])


def test_later_names_replace_earlier_ones(spark, tmpdir_path):
    n = os.path.join(tmpdir_path, "names.tsv")
    with open(n, "w") as f:
        f.write("curie_id\tall_names\nA\tz|first\nB\tb\nA\ta|second\nA\t\nQ\tq\n")
    ents = spark.createDataFrame([("A", "n", "c", "d", ["n"]), ("B", "n", "c", "d", ["n"]), ("C", "n", "c", "d", ["n"])],
                                 "curie string, name string, category string, description string, all_names array<string>")
    got = {r.curie: r.all_names for r in entities.merge_names(ents, kg.read_names_tsv(spark, n)).collect()}
    assert got == {"A": ["a", "second"], "B": ["b"], "C": ["n"]}


def _store(spark):
    return spark.createDataFrame(
        [("1", "t", "Aspirin lowers fever. Dose matters.", "d", None),
         ("2", "", "", "d", "No abstract available")],
        "bare_pmid string, title string, abstract string, fetch_date string, error string")


def test_live_scorer_and_evaluate_many(spark):
    triples = spark.createDataFrame(
        [("CHEBI:1", "biolink:treats", "MONDO:2", "PMID:1"),
         ("CHEBI:1", "biolink:treats", "MONDO:2", "PMID:9")],
        ["subject_curie", "predicate", "object_curie", "PMID"])

    def scorer(prompts, max_tokens):
        assert all("**ABSTRACT**:" in p for p in prompts)
        return [('{"support": "yes", "sentences": ["Aspirin lowers fever"], '
                 '"subject_mentioned": true, "object_mentioned": true, "reasoning": "ok"}',
                 10, 5) for _ in prompts]

    results, no_abs = evaluate.evaluate(triples, _store(spark), scorer=scorer)
    r = results.collect()
    assert len(r) == 1 and r[0].support == "yes" and r[0].predicted
    assert r[0].supporting_sentences == "Aspirin lowers fever"
    assert [x.PMID for x in no_abs.collect()] == ["PMID:9"]

    req = spark.createDataFrame([("CHEBI:1", "biolink:treats", "MONDO:2", ["PMID:9", "1", "2"])],
                                "subject_curie string, predicate string, object_curie string, "
                                "pmids array<string>")
    many = evaluate.evaluate_many(req, _store(spark), scorer=scorer)
    got = {r.pmid_index: (r.support, r.reasoning) for r in many.collect()}
    assert got[0] == ("no", "PMID not found in results")
    assert got[1][0] == "yes"
    assert got[2] == ("no", "Error: No abstract available")


def test_scorer_failure_becomes_row(spark):
    prompts = spark.createDataFrame([("k1", "p", 10)], "prompt_key string, prompt string, max_tokens int")

    def broken(prompts, max_tokens):
        raise RuntimeError("down")

    r = score.score(prompts, broken).collect()[0]
    assert r.error == "down" and r.content is None


def _files(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_upsert_rewrites_only_the_parts_it_touches(spark, tmpdir_path):
    from attestor.operators import store as st

    path = os.path.join(tmpdir_path, "store")
    rows = [(str(i), f"t{i}", f"a{i}", "d", None) for i in range(400)]
    schema = "bare_pmid string, title string, abstract string, fetch_date string, error string"
    st.write_store(spark.createDataFrame(rows, schema), path, parts=32)
    before = _files(path)
    assert 20 < len(before) <= 32
    batch = spark.createDataFrame([("7", "new", "x", "d2", None), ("9999", "", "", "d2", "down"), ("7", "newest", "y", "d3", None)], schema)
    st.upsert_stored(spark, path, batch.coalesce(1), parts=32)
    after = _files(path)
    assert len(before - after) in (1, 2) and len(after - before) in (1, 2)
    got = {r.bare_pmid: r.title for r in st.read_store(spark, path).collect()}
    assert got == {**{str(i): f"t{i}" for i in range(400)}, "7": "newest", "9999": ""}
    st.upsert_stored(spark, path, batch.limit(0), parts=32)
    assert _files(path) == after


def test_stream_reads_only_its_own_keys(spark, tmpdir_path):
    """Repeated keys in later files are evaluated once; a replayed batch doubles nothing; the
    files of finished keys do not grow in number with the batches."""
    from attestor.streaming import evaluate_stream as es

    source, out = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "out")
    keys = ["subject_curie", "predicate", "object_curie", "PMID"]
    schema = "subject_curie string, predicate string, object_curie string, PMID string"
    for i in range(4):
        rows = [(f"S{k}", "p", "o", "PMID:1") for k in range(i * 30, i * 30 + 60)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    scorer = lambda prompts, _: [('{"support": "no"}', 1, 1)] * len(prompts)
    from pyspark.sql.types import _parse_datatype_string

    got = es.stream_evaluate(spark, source, _parse_datatype_string(schema), _store(spark), out, scorer=scorer)
    assert sorted(r.subject_curie for r in got.collect()) == sorted(f"S{k}" for k in range(150))
    assert len(_files(f"{out}_keys")) <= es.KEY_PARTS
    few = spark.createDataFrame([(" S3", "p", "o", "PMID:1 ")], keys)
    found = es.finished_keys(spark, f"{out}_keys", few, batch_id=-1)
    assert found.where("subject_curie = 'S3'").count() == 1
    assert found.select("part").distinct().count() == 1
    last = spark.read.parquet(out).where("batch_id = 3")
    es.add_finished(spark, f"{out}_keys", last, 3)
    assert spark.read.parquet(f"{out}_keys").count() == 150


def test_a_batch_of_prompts_becomes_one_batch_of_answers(spark):
    prompts = spark.range(100, numPartitions=1).selectExpr("cast(id AS string) AS prompt_key", "concat('p', id) AS prompt", "id AS max_tokens")

    def scorer(texts, budgets):
        assert len(texts) <= 32 and all(type(b) is int for b in budgets)
        if len(texts) > 1 and "p70" in texts:
            texts.clear()  # a scorer may spoil its lists
        if texts == ["p70"] or not texts:
            raise RuntimeError("bad prompt")
        return [(t, b, None) for t, b in zip(texts, budgets)]

    plan = score.score(prompts, scorer)
    assert "MapInArrow" in plan._jdf.queryExecution().executedPlan().toString()
    got = {r.prompt_key: (r.content, r.error, r.prompt_tokens, r.completion_tokens, r.round) for r in plan.collect()}
    want = {str(i): (f"p{i}", None, i, 0, 1) for i in range(100)}
    assert got == {**want, "70": (None, "bad prompt", 0, 0, 1)}
