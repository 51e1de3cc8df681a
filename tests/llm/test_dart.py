"""Every two alike documents of a bucket end in one component, whatever else is in it."""

import random

import numpy as np
import pyarrow as pa

from attestor.llm import dart

SCHEMA = "doc_id long, text string"


def edited(rng, words, n):
    out = list(words)
    for i in rng.sample(range(len(words)), n):
        out[i] = f"x{rng.randrange(10**9)}"
    return out


def roots(texts):
    """The smallest number that each text is linked to, all pairs compared."""
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    grams = [{tuple(t[i:i + 5]) for i in range(len(t) - 4)} for t in map(str.split, texts)]
    for i, a in enumerate(grams):
        for j, b in enumerate(grams[:i]):
            if len(a & b) >= 0.8 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(x) for x in range(len(texts))]


def test_one_original_with_independent_copies(spark):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(800)]
    texts = [" ".join(base)] + [" ".join(edited(rng, base, 14)) for _ in range(150)]
    want = roots(texts)
    rows = dart.near_duplicates(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()
    assert want.count(0) == 151
    assert {r.doc_id: r.cluster_id for r in rows} == dict(enumerate(want))


def test_a_round_without_links_does_not_end_a_bucket(spark, monkeypatch):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(edited(rng, base, 1)) for _ in range(40)]
    alike = []

    def verified(pairs, texts):
        """Only two documents are alike, which the first round has not brought together."""
        if not alike:
            asked = {(r.u.d, r.v.d) for r in pairs.collect()}
            alike.append(next((i, j) for j in range(40) for i in range(j) if (i, j) not in asked))
        i, j = alike[0]
        return pairs.where((pairs.u.d == i) & (pairs.v.d == j))

    monkeypatch.setattr(dart, "verified", verified)
    rows = dart.near_duplicates(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()
    i, j = alike[0]
    assert {r.doc_id: r.cluster_id for r in rows} == {d: i if d == j else d for d in range(40)}


def test_large_buckets_are_dealt_in_parts(spark):
    def sketches(i):
        """Two kinds that no dart joins but the first band; none has an odd unit."""
        kind = bytes([i % 2]) * (dart.DARTS - dart.ROWS)
        return (i, 0), bytes(2 * dart.BANDS), bytes(dart.ROWS) + kind, 100, bytes(dart.ODD_BITS // 8)

    rest = spark.createDataFrame(
        [(5, 0, (i, 0), (i, 0), 7, 3000) for i in range(3000)],
        f"b long, band int, v {dart.NODE}, root {dart.NODE}, score long, n long")
    seen = spark.createDataFrame([sketches(i) for i in range(3000)],
                                 f"v {dart.NODE}, tags binary, sketch binary, size int, odd binary")
    lead = dart._leads(rest, 3)
    leads = {r.v.d for r in lead.collect()}
    got = [(r.u.d, r.v.d) for r in dart.meetings(rest, lead, seen).collect()]
    want = {(min(i, j), max(i, j)) for i in leads for j in range(3000) if i != j and (i - j) % 2 == 0}
    assert set(got) == want


def test_odd_sketches_never_exclude_an_alike_pair():
    rng = random.Random(9)
    base = [f"w{rng.randrange(300)}" for _ in range(400)]
    texts = [" ".join(edited(rng, base, rng.randrange(12))) for _ in range(60)] + ["a b", "a a a a a a a"]
    row, shingle, *_ = dart.elements(pa.array(texts))
    bag = dart.weighted(row, shingle)
    odd = dart.odd_sketches(len(texts), *bag).view(np.uint64)
    size = np.bincount(bag[0], weights=bag[2], minlength=len(texts))
    excluded = 0
    for i in range(len(texts)):
        for j in range(i):
            differ, both = int(np.bitwise_count(odd[i] ^ odd[j]).sum()), size[i] + size[j]
            bound = (both - differ) / (both + differ)
            assert dart.similarity(texts[i], texts[j]) <= bound + 1e-9
            excluded += bound < dart.SIMILARITY
    assert excluded > 500


def test_a_template_group_of_unlike_members_costs_no_comparisons(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join(edited(rng, base, 10)) for _ in range(120)]  # alike at about 0.7
    asked = []
    true = dart.verified

    def verified(pairs, texts):
        asked.append(pairs.count())
        return true(pairs, texts)

    monkeypatch.setattr(dart, "verified", verified)
    rows = dart.near_duplicates(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()
    assert {r.doc_id: r.cluster_id for r in rows} == dict(enumerate(roots(texts)))
    assert sum(asked) < 120


def test_a_chain_is_one_component(spark):
    rng = random.Random(6)
    texts, words = [], [f"w{i}" for i in range(400)]
    for _ in range(40):
        texts.append(" ".join(words))
        words = edited(rng, words, 6)
    rows = dart.near_duplicates(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()
    assert {r.doc_id: r.cluster_id for r in rows} == dict(enumerate(roots(texts)))
