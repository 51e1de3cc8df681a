"""The pipeline, stage by stage, against plain Python."""

import hashlib
import re
from collections import Counter

import corpus_pipeline
import pytest
from test_dedup import components, expected_lines
from test_filters_tokens import words

from attestor.llm.common import keyed


def decontaminated(text, grams):
    """The text without hit words and what follows them; None if half of it is hit."""
    w = words(text)
    hit = set()
    for i in range(len(w) - 9):
        if tuple(w[i:i + 10]) in grams:
            hit.update(range(i, i + 10))
    if not hit:
        return text
    if len(hit) >= 0.5 * len(w):
        return None
    parts = re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", text)
    head = text[:text.index(parts[0])]
    return head + "".join(x for i, x in enumerate(parts) if i not in hit)


def sorted_keys(df):
    return sorted((r.d, r.t, r.text) for r in keyed(df).collect())


@pytest.fixture(scope="module")
def sf_dir(spark, odd_docs, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("sf"))
    odd_docs.write.parquet(f"{out}/documents.parquet")
    item = next(r.text for r in odd_docs.collect() if r.doc_id == 23).split()
    spark.createDataFrame([(1, " ".join(item[40:70])), (2, None)], "item_id long, text string").write.parquet(
        f"{out}/benchmark.parquet")
    return out


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, sf_dir)
        assert out.columns == columns, name
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        before, after = docs.collect(), out.collect()
        if name == "language":
            want = Counter(r for r in before if r.text and any(c.isalpha() for c in r.text))
            assert Counter(after) == want
        elif name == "lines":
            want = Counter("\n".join(x for i, x in enumerate(lines) if i not in gone)
                           for _, lines, gone in expected_lines(sorted_keys(docs)))
            assert Counter(r.text for r in after) == want and len(after) == len(before)
        elif name == "near_duplicates":
            keys = sorted_keys(docs)
            kept = set(components(keys).values())
            assert [x[:2] for x in sorted_keys(out)] == sorted(kept)
        else:
            items = [words(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            grams = {tuple(w[i:i + 10]) for w in items for i in range(len(w) - 9)}
            want = Counter(x for r in before if (x := decontaminated(r.text, grams)) is not None)
            assert Counter(r.text for r in after) == want
            assert want != Counter(r.text for r in before)
        docs = out
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert Counter((r.doc_id, r.decoded_sha256) for r in tokens) == Counter(
        (r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in docs.collect())
    assert Counter(tokens) == Counter(corpus_pipeline.run(spark, sf_dir).collect())


def test_empty_table(spark, sf_dir, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0
