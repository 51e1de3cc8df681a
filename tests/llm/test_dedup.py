"""Dedup operators against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from attestor.llm import dart, line_dedup, substring, suffix
from attestor.llm.common import NULL_ID


def sha(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


def ident(d):
    return None if d == NULL_ID else d


def masks(units_of, documents, n):
    """Per document row the units inside a window of n that starts earlier."""
    first, out = {}, []
    for d, t, text in documents:
        units = units_of(text)
        for i in range(len(units) - n + 1):
            first.setdefault(tuple(units[i:i + n]), (d, t, i))
    for d, t, text in documents:
        units = units_of(text)
        mask = [False] * len(units)
        for i in range(len(units) - n + 1):
            if first[tuple(units[i:i + n])] < (d, t, i):
                mask[i:i + n] = [True] * n
        out.append((d, units, mask))
    return out


def test_substring(odd_docs, documents):
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256)
                  for r in substring.dedup_substrings(odd_docs, texts=False).collect())
    want = Counter((ident(d), len(u), sum(m), sha(b" ".join(x for x, g in zip(u, m) if not g)))
                   for d, u, m in masks(lambda t: t.encode().split(), documents, 20))
    assert got == want and sum(k[2] for k in want) > 500


def test_substring_texts_and_spans(odd_docs):
    for r in substring.dedup_substrings(odd_docs).collect():
        assert r.n_words - r.n_removed == len(r.kept.encode().split())
        assert sum(s.n for s in r.spans) == r.n_removed


def test_automata_are_sharded(documents):
    rows = [{"od": 0, "ot": 0, "lo": 100 * i, "words": " ".join(f"w{i}_{j}" for j in range(30))} for i in range(9)]
    doc = " ".join(x["words"] for x in rows).encode().split()
    one, many = (substring.covered([(1, 0, doc, rows)], 20, limit)[0] for limit in (10_000, 40))
    assert one.all() and many.all()
    earlier = substring.covered([(-1, 0, doc, rows)], 20, 40)[0]
    assert not earlier.any()


@pytest.mark.parametrize("hot", [suffix.HOT, 1])
def test_suffix(odd_docs, documents, hot):
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                  for r in suffix.dedup_bytes(odd_docs, texts=False, hot=hot).collect())
    want = Counter()
    for d, u, m in masks(lambda t: t.encode(), documents, 100):
        edges = np.diff(np.concatenate(([0], np.array(m, np.int8), [0])))
        want[(ident(d), len(u), sum(m), int((edges > 0).sum()), sha(bytes(x for x, g in zip(u, m) if not g)))] += 1
    assert got == want and sum(k[2] for k in want) > 5000


def test_maximal_repeats(spark):
    rng = np.random.default_rng(1)
    word = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8)).decode()
    a, b = word(150), word(220)
    docs = [word(50) + a + word(40), a + b, word(7) + b + word(9) + a[:120] + word(30)]
    rows = suffix.maximal_repeats(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")).collect()
    # fragments of equal content appear once, so groups may leave out the middle of a repeat
    covered = defaultdict(set)
    for r in rows:
        same = {docs[o.d].encode()[o.start:o.start + r.length] for o in r.occurrences}
        assert len(same) == 1 and len(r.occurrences) > 1 and r.length >= 100
        for o in r.occurrences:
            covered[o.d].update(range(o.start, o.start + r.length))
    true = {0: set(range(50, 200)), 1: set(range(370)), 2: {*range(7, 227), *range(236, 356)}}
    assert all(covered[d] <= true[d] and len(covered[d]) > 0.9 * len(true[d]) for d in true)


def test_stack_scan_keeps_the_longest_repeat_of_each_place():
    texts = [b"abcabcabd" * 3, b"xabcabcabd" * 2]
    counts = np.array([len(t) - 3 for t in texts])
    at, frag, shared, left = suffix.suffixes(texts, counts, 4)
    data = b"".join(texts)
    ends = [27, 47]
    for i in range(1, len(at)):
        x, y = (data[at[j]:ends[frag[j]]] for j in (i - 1, i))
        assert x <= y
        n = next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))
        assert shared[i] == n


def expected_lines(documents):
    """Chunks by the rule in plain Python; d, lines, removed line numbers."""
    def h(line):
        return int(hashlib.md5(line.encode()).hexdigest()[:8], 16)

    p, mod = line_dedup._P, (1 << 31) - 1
    cut = []
    for d, t, text in documents:
        lines = text.split("\n")
        hs, start, chunks = [h(x) for x in lines], 0, []
        for i in range(len(lines)):
            total = sum((hs[i - b] * pow(p, b + 1, 1 << 31)) % mod for b in range(3) if i >= b)
            if total % mod % line_dedup.MODULUS == 0 or i == len(lines) - 1:
                chunks.append((start, i + 1))
                start = i + 1
        cut.append((d, t, lines, chunks))
    first, out = {}, []
    for d, t, lines, chunks in cut:
        for c, (a, b) in enumerate(chunks):
            first.setdefault(tuple(lines[a:b]), (d, t, c))
    for d, t, lines, chunks in cut:
        gone = {i for c, (a, b) in enumerate(chunks) if b - a > 1 and first[tuple(lines[a:b])] < (d, t, c)
                for i in range(a, b)}
        out.append((d, lines, gone))
    return out


def test_line_dedup(odd_docs, documents):
    rows = line_dedup.line_report(odd_docs).collect()
    nulls = [r for r in rows if r.kept_sha256 is None]
    assert len(nulls) == 2 and all(r.n_lines == 0 and r.n_removed == 0 for r in nulls)
    got = Counter((r.doc_id, r.n_lines, r.n_removed, r.kept_sha256) for r in rows if r.kept_sha256)
    known = Counter((d, t) for d, t, _ in documents)
    assert known
    want = Counter((ident(d), len(x), len(g), sha("\n".join(y for i, y in enumerate(x) if i not in g).encode()))
                   for d, x, g in expected_lines(documents))
    for r in nulls:
        want[(r.doc_id, 1, 0, sha(b""))] -= 1
    assert got == +want and sum(k[2] for k in got) > 10


def test_line_dedup_keeps_rows_and_columns(odd_docs):
    out = line_dedup.dedup_lines(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()


def components(documents):
    grams = {}
    for d, t, text in documents:
        w = text.encode().split()
        grams[(d, t)] = Counter([tuple(w[i:i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else []))
    root = {k: k for k in grams}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(grams)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            both = sum((grams[a] | grams[b]).values())
            if both and sum((grams[a] & grams[b]).values()) / both >= 0.8:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def test_near_duplicates(odd_docs, documents):
    want = components(documents)
    rows = dart.near_duplicates(odd_docs).collect()
    assert Counter((r.doc_id, r.cluster_id, r.kept) for r in rows) == Counter(
        (ident(d), ident(want[(d, t)][0]), want[(d, t)] == (d, t)) for d, t, _ in documents)
    assert any(r.cluster_id != r.class_id for r in rows)


def test_keep_one(odd_docs, documents):
    out = dart.keep_one(odd_docs)
    want = components(documents)
    assert out.columns == odd_docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter(ident(d) for d, _ in set(want.values()))


def test_dart_signatures_estimate_similarity():
    import pyarrow as pa

    rng = np.random.default_rng(0)
    for changed in (0, 4, 12, 40):
        a = [f"w{i}" for i in range(400)]
        b = list(a)
        for i in rng.choice(400, changed, replace=False):
            b[i] = f"z{i}"
        row, shingle, *_ = dart.elements(pa.array([" ".join(a), " ".join(b)]))
        s = dart.dart_signatures(2, *dart.weighted(row, shingle), darts=1000)
        assert (s != 0).all()
        assert abs((s[0] == s[1]).mean() - dart.similarity(" ".join(a), " ".join(b))) < 0.06


def test_components_over_a_long_chain(spark):
    edges = [((i, 0), (i + 1, 0)) for i in range(40)] + [((100, 0), (101, 0))]
    out = dart.components(spark.createDataFrame(edges, f"u {dart.NODE}, v {dart.NODE}")).collect()
    assert {r.node.d: r.root.d for r in out} == {**{i: 0 for i in range(1, 41)}, 101: 100}


@pytest.mark.parametrize("run", [
    lambda x: substring.dedup_substrings(x), lambda x: suffix.dedup_bytes(x),
    lambda x: line_dedup.line_report(x), lambda x: line_dedup.dedup_lines(x),
    lambda x: dart.near_duplicates(x), lambda x: dart.keep_one(x)])
def test_empty_table(no_docs, run):
    assert run(no_docs).count() == 0
