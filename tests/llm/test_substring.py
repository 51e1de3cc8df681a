"""Windows under one anchor that only half of their hash makes equal, and a hot anchor."""

import numpy as np
import pyarrow as pa

from attestor.llm import substring
from attestor.llm.common import utf8
from attestor.llm.rolling import grams, word_hashes, words


def test_a_false_half_hash_hides_no_copy(spark):
    rng = np.random.default_rng(3)
    phrases = [" ".join(f"p{i}_{j}" for j in range(substring.K)) for i in range(4000)]
    data, off = utf8(pa.array(phrases))
    hashes = grams(word_hashes(data, *words(data, off)[:2]), substring.K)[::substring.K]
    phrase = phrases[int(hashes.argmin())]  # the anchor of almost every window it is in
    tails = rng.integers(0, 10_000, (400_000, substring.N - substring.K))
    texts = [phrase + " " + " ".join(map(str, x)) for x in tails.tolist()]
    hashes = []
    for at in range(0, len(texts), 10_000):
        part = pa.RecordBatch.from_arrays([pa.array(texts[at:at + 10_000])], names=["text"])
        a, row, _, _, w = substring.candidate_rows(part, substring.N, substring.K)
        hashes.append(np.stack([a, w, row.astype(np.uint64) + np.uint64(at)]))
    a, w, row = np.concatenate(hashes, axis=1)
    half = w & np.uint64(0xFFFFFFFF)
    order = np.lexsort((half, a))
    same = np.flatnonzero((half[order[1:]] == half[order[:-1]]) & (a[order[1:]] == a[order[:-1]]))
    assert len(same)
    docs, want = [], {}
    for i in same.tolist():
        x, y = texts[int(row[order[i]])], texts[int(row[order[i + 1]])]
        assert x != y
        for text, gone in ((x, 0), (y, 0), (y, substring.N)):
            want[len(docs)] = gone
            docs.append((len(docs), text))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    for dealt in (table.repartition(len(docs)), table.coalesce(1)):
        got = {r.doc_id: r.n_removed for r in substring.dedup_substrings(dealt).collect()}
        assert got == want


def test_windows_shared_by_different_runs(spark):
    shared = " ".join(f"s{i}" for i in range(22))
    docs = [(i, f"a{i} b{i} c{i} {shared} d{i} e{i}") for i in range(200)] + [(200, None), (201, shared)]
    docs += docs[:3]  # repeated rows
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(16)
    got = [(r.doc_id, r.n_removed) for r in substring.dedup_substrings(table).collect()]
    assert sorted(got) == sorted((d, 0 if d in (0, 200) else 22) for d, _ in docs)


def test_passages_are_cut_once_for_neighbouring_pairs():
    spans = pa.array([[{"lo": 1, "hi": 2}], [{"lo": 0, "hi": 1}, {"lo": 3, "hi": 4}]])
    part = pa.RecordBatch.from_arrays(
        [pa.array([1, 1], pa.int64()), pa.array([0, 0], pa.int32()), pa.array([5, 6], pa.int64()),
         pa.array([0, 0], pa.int32()), spans, pa.array([" a\tb\n\nc é x  e "] * 2)],
        names=["od", "ot", "d", "t", "spans", "text"])
    (got,) = substring._cut(2)([part])
    cut = [[(p["od"], p["ot"], p["lo"], p["words"]) for p in row] for row in got.column("passages").to_pylist()]
    assert cut == [[(1, 0, 1, "b c")], [(1, 0, 0, "a b"), (1, 0, 3, "é x e")]]


def test_runs_of_any_length_find_what_single_words_find():
    rng = np.random.default_rng(4)
    for n in (1, 3, 4, 7, 10, 20):
        source = [str(x).encode() for x in rng.integers(0, 4, 400)]
        doc = [str(x).encode() for x in rng.integers(0, 4, 30)] + source[37:37 + 3 * n] + [b"new"] + source[200:200 + n]
        passage = {"od": 1, "ot": 0, "lo": 0, "words": b" ".join(source).decode()}
        (mask,) = substring.covered([(2, 0, doc, [passage])], n, limit=50)
        known = {tuple(source[i:i + n]) for i in range(len(source) - n + 1)}
        want = np.zeros(len(doc), bool)
        for i in range(len(doc) - n + 1):
            if tuple(doc[i:i + n]) in known:
                want[i:i + n] = True
        assert mask.tolist() == want.tolist()


def test_automata_of_many_words_have_few_successors_a_state(monkeypatch):
    import ahocorasick

    added, automaton = [], ahocorasick.Automaton

    class Machine:
        def __init__(self, *kind):
            self.real = automaton(*kind)

        def __len__(self):
            return len(self.real)

        def add_word(self, key, value):
            added.append(key)
            return self.real.add_word(key, value)

        def __getattr__(self, name):
            return getattr(self.real, name)

    monkeypatch.setattr(ahocorasick, "Automaton", Machine)
    words = [str(i).encode() for i in range(3000)]
    passage = {"od": 1, "ot": 0, "lo": 0, "words": b" ".join(words).decode()}
    (mask,) = substring.covered([(2, 0, words[100:200], [passage])])
    assert mask.all() and len({k[0] for k in added}) <= substring.FANOUT and {len(k) for k in added} == {8}
