"""Fill-in-middle, quality scores and search against plain versions."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from attestor.llm import fim, quality, search
from attestor.llm.common import NULL_ID


def sha(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def plain_fim(doc_id, text):
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def fim_docs(spark, odd_docs):
    """The odd documents, some of them many times under other ids, and texts of marks."""
    from pyspark.sql import functions as F

    more = odd_docs.crossJoin(spark.range(1, 4)).withColumn("doc_id", F.col("doc_id") + F.col("id") * 1000).drop("id")
    marks = [(50_000 + i, x) + (None,) * 3 + tuple("abcdefghi") for i, x in enumerate(
        ["a <P> b", "<S>", "x<M>", "< P > <P <<P S> <S M>" * 9, "<P", "S>", "<<<<>>>>", "\n", "A" * 50])]
    return odd_docs.unionByName(more).unionByName(spark.createDataFrame(marks, odd_docs.schema))


def test_fim_equals_plain_version(fim_docs):
    want = []
    for r in fim_docs.collect():
        n, form, a, b, out = plain_fim(r.doc_id, r.text or "")
        want.append((r.doc_id, n, form, a, b, sha(out), sha(r.text or "")))
    got = list(map(tuple, fim.digests(fim_docs).collect()))
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_fim_outputs_restore_the_texts(fim_docs):
    rows = fim_docs.withColumnsRenamed({"a": "form", "w": "Output"})
    cut = fim.fill_in_middle(rows)
    assert cut.columns == ["doc_id", "lang", "source", "n_chars", "d", "t", "chunk", "score", "range", "_d", "_gone",
                           "n", "form", "prefix_chars", "middle_chars", "output"]
    assert Counter((r.doc_id, r.output) for r in cut.collect()) == Counter(
        (r.doc_id, plain_fim(r.doc_id, r.text or "")[4]) for r in fim_docs.collect())
    assert Counter((r.doc_id, r.text) for r in fim.restore(cut).collect()) == Counter(
        (r.doc_id, r.text or "") for r in fim_docs.collect())
    other = fim.fill_in_middle(rows, seed=2, cut_share=100, suffix_first=100, sentinels=("[p]", "[s]", "[m]"))
    assert {r.form for r in other.select("form").distinct().collect()} == {"plain", "spm"}
    assert Counter(r.text for r in fim.restore(other, ("[p]", "[s]", "[m]")).collect()) == Counter(
        r.text or "" for r in fim_docs.collect())


def test_fim_of_no_documents_and_bad_sentinels(no_docs):
    assert fim.digests(no_docs).count() == 0
    assert fim.restore(fim.fill_in_middle(no_docs)).count() == 0
    for bad in (("<P>", "<P>", "<M>"), ("", "b", "c"), ("xx", "b", "c"), ("|p|", "|s|", "|m|")):
        with pytest.raises(ValueError):
            fim.fill_in_middle(no_docs, sentinels=bad)


def test_pieces_are_cut_and_permuted():
    table = [fim.Piece(0, 3, 7), fim.Piece(1, 0, 2)]
    assert fim.cut(table, 0) == ([], table) and fim.cut(table, 6) == (table, [])
    assert fim.cut(table, 4) == (table[:1], table[1:])
    left, right = fim.cut(table, 5)
    assert left == [table[0], fim.Piece(1, 0, 1)] and right == [fim.Piece(1, 1, 2)]
    assert fim.joined(left + right, (b"0123456789", b"ab")) == b"3456ab"
    assert fim.digest(left + right, (b"0123456789", b"ab")) == sha("3456ab")


# ---------------------------------------------------------------- quality


def slow_measures(text):
    """Some of the measures, one text at a time."""
    ws = text.encode().split()
    low = [w.lower() for w in ws]
    n = max(len(ws), 1)
    lines = [x for x in text.split("\n") if x]
    c = Counter(low)
    return [math.log1p(len(text.encode())) / 10, math.log1p(len(ws)) / 10, len(c) / n if ws else 1,
            sum(a == b for a, b in zip(low, low[1:])) / n, max(c.values(), default=0) / n], math.log1p(len(lines)) / 10


def test_measures_equal_plain_version(odd_docs):
    texts = [r.text or "" for r in odd_docs.collect()]
    got = quality.vectors(pa.array(texts))
    alone = np.vstack([quality.vectors(pa.array([t])) for t in texts])
    assert np.allclose(got, alone)  # a text's vector does not depend on its neighbours
    for row, text in zip(got, texts):
        some, lines = slow_measures(text)
        assert np.allclose(row[97:102], some) and math.isclose(row[97 + 12], lines)


def test_bradley_terry_finds_the_minimum():
    rng = np.random.default_rng(3)
    good, bad = rng.normal(0.4, 1, (60, 3)), rng.normal(0, 1, (25, 3))
    w = quality.bradley_terry(good, bad, penalty=0.01)
    i, j = quality._drawn(60, 25, quality.PAIRS)
    assert min(np.bincount(i, minlength=60).min(), np.bincount(j, minlength=25).min()) >= quality.PAIRS - 8
    d = good[i] - bad[j]

    def loss(v):
        return np.log1p(np.exp(-(d @ v))).mean() + 0.01 * (v @ v) / 2

    for k in range(3):
        for step in (-1e-3, 1e-3):
            assert loss(w) <= loss(w + step * np.eye(3)[k])


@pytest.fixture(scope="module")
def judged(spark):
    import random

    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    rows, labels = [], []
    for i in range(600):
        good = rng.random() < 0.75
        ws = [word() for _ in range(rng.randint(5, 120))]
        rows.append((i, " ".join(ws) + "." if good else " ".join(w.upper() + "!!" for w in ws), "extra"))
        if i % 2:
            labels.append((i, int(good), 0))
    rows += [rows[0], rows[1], (1, "other text of the same id", "x"), (None, "no id", None), (9000, None, None), (9001, "", None)]
    labels += [labels[0], (None, 1, 0), (3, None, 1), (777_777, 0, 1)]
    return (spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(4),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_quality_on_held_out_documents(judged):
    import zlib

    docs, labels = judged
    got = quality.quality_report(docs, labels).collect()
    assert len(got) == docs.count()
    good = {r.doc_id: r.quality for r in labels.collect()}
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [r for r in got if r.held_out and good.get(r.doc_id) is not None and r.doc_id < 600]
    assert len(held) > 40 and sum(r.predicted == good[r.doc_id] for r in held) >= 0.97 * len(held)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r.score)
    assert by_id[0][0] == by_id[0][1] and len(set(by_id[1])) == 2
    again = quality.quality_report(docs.repartition(7), labels.repartition(3)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_quality_learns_only_from_what_is_not_held_out(judged):
    """Labels of held-out rows turned round change nothing."""
    from pyspark.sql import functions as F

    from attestor.llm.langid import held_out

    docs, labels = judged
    turned = labels.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(repr, quality.quality_report(docs, x).collect())) for x in (labels, turned))
    assert a == b


def test_quality_without_labels_and_without_documents(judged, odd_docs, no_docs):
    docs, labels = judged
    none = labels.where("quality = 1")
    assert {(r.score, r.predicted) for r in quality.quality_report(odd_docs, none).collect()} == {(quality.THRESHOLD, 1)}
    assert quality.quality_report(no_docs, labels).count() == 0
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


# ---------------------------------------------------------------- search


def terms(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def slow_search(docs, items, k):
    held = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs if terms(t)]
    n_docs, total = len(held), sum(n for _, _, n in held)
    df = Counter(x for _, c, _ in held for x in c)
    out = []
    for item, text in set(items):
        scored = []
        for d, c, n in held:
            m = 75 + 25 * n * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                        * (10 ** 9 * c[x] // (1000 * c[x] + 12 * m)) for x in terms(text) if c[x])
            if score > 0:
                scored.append((-score, NULL_ID if d is None else d))
        out += [(item, i + 1, None if d == NULL_ID else d, -s) for i, (s, d) in enumerate(sorted(scored)[:k])]
    return out


@pytest.fixture(scope="module")
def items(spark, odd_docs):
    texts = sorted({r.text for r in odd_docs.collect() if r.text}, key=len)
    rows = [(i, " ".join(t.split()[-40:])) for i, t in enumerate(texts)]
    rows += [(100, texts[-1]), (100, texts[-1]), (100, "the the THE of"), (101, None), (102, " .,;"), (None, "the of"),
             (103, "stone1 light2 the of"), (104, "stone1 light2 the of river3"), (105, "nobody has this")]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "item_id long, text string, d string, block int")


@pytest.mark.parametrize("k, per_block, plan_bytes, cells", [
    (20, 512, 32 << 20, 1 << 21), (3, 4, 32 << 20, 2000), (1000, 7, 1, 1 << 21)])
def test_search_equals_plain_version(odd_docs, items, monkeypatch, k, per_block, plan_bytes, cells):
    """One block; several of them with few documents at a time; a pass for each block."""
    monkeypatch.setattr(search, "CELLS", cells)
    want = slow_search([(r.doc_id, r.text) for r in odd_docs.collect()], [(r.item_id, r.text) for r in items.collect()], k)
    got = search.search(odd_docs, items, k, per_block, plan_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_search_of_nothing(spark, odd_docs, no_docs, items):
    assert search.search(no_docs, items).count() == 0
    assert search.search(odd_docs, items.where("false")).count() == 0
    assert search.search(odd_docs, items.where("item_id in (101, 102)")).count() == 0
    words = spark.createDataFrame([("x1", "the"), (None, "the of")], "item_id string, text string")
    found = search.search(odd_docs, words)
    assert dict(found.dtypes)["item_id"] == "string" and found.where("item_id = 'x1'").count() > 0


def test_plan_adds_shared_sets_once():
    """Sums over the graph equal sums over terms, with fewer additions than item by item."""
    rng = np.random.default_rng(8)
    common = [b"w%d" % i for i in range(12)]
    lists = [[common[i] for i in rng.permutation(12)[:9]] * (1 + k % 2) + [b"own%d" % k, b"own%d" % (k // 2)]
             for k in range(40)] + [[], [b"w1"]]
    plan = search.Plan(lists)
    plan.ready()
    assert plan.additions() < sum(max(len(set(x)) - 1, 0) for x in lists)
    used = Counter(n for r in plan.roots for n in r) + Counter(
        int(n) for level in plan.levels for n in level[:, 1:].reshape(-1))
    assert max(used.values()) > 1  # a node feeds more than one other
    n, number = 5, {w: i for i, w in enumerate(plan.vocabulary)}
    value = rng.integers(0, 1000, (len(number), n))
    term, doc = np.meshgrid(np.arange(len(number)), np.arange(n), indexing="ij")
    got = plan.scores(doc.ravel(), term.ravel(), value.ravel(), n)
    want = [[sum(value[number[w], d] for w in words) for d in range(n)] for words in lists]
    assert got.tolist() == want


def test_quality_fits_all_labels(judged, monkeypatch):
    """Labels beyond one group count too, the rarer kind meets every group, and the
    threshold is the exact quantile."""
    docs, labels = judged
    whole = quality.fit(docs, labels)
    seen = []
    kept = quality._quantile
    monkeypatch.setattr(quality, "_quantile", lambda values, *a: seen.append(values.count()) or kept(values, *a))
    monkeypatch.setattr(quality, "VALUES", 7)
    split = quality.fit(docs, labels, per_group=20)
    with_text = docs.select("doc_id").distinct().join(labels.where("quality IN (0, 1)").select("doc_id", "quality").distinct(), "doc_id").count()
    assert seen == [with_text]
    assert np.allclose(whole.middle, split.middle) and np.allclose(whole.scale, split.scale)
    assert np.corrcoef(whole.weights, split.weights)[0, 1] > 0.8


def test_quantile_is_exact(spark, monkeypatch):
    monkeypatch.setattr(quality, "VALUES", 3)
    u = [float(x) for x in (5, 1, 1, 1, 2, 3, 8, 9, 4, 7)]
    values = spark.createDataFrame([(x, i % 2) for i, x in enumerate(u)], "u double, y int")
    for k in range(1, 10):
        got = quality._quantile(values, {0: 0.1, 1: 0.1}, k / 10)
        assert got == (sorted(u)[k - 1] + sorted(u)[k]) / 2
