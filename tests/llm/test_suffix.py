"""Fragments under one anchor that only half of their content hash makes equal."""

import numpy as np
import pyarrow as pa

from attestor.llm import suffix
from attestor.llm.rolling import grams


def test_fragments_that_share_32_bits_of_their_hash_stay(spark):
    rng = np.random.default_rng(0)
    letters = rng.integers(97, 123, 1 << 21).astype(np.uint8)
    at = int(np.argmin(grams(suffix._BYTE[letters], suffix.K)))
    # texts of one window each, whose anchor is the same phrase of a very small hash
    rows = rng.integers(97, 123, (300_000, suffix.N)).astype(np.uint8)
    rows[:, 30:30 + suffix.K] = letters[at:at + suffix.K]
    texts = [x.tobytes().decode() for x in rows]
    hashes = []
    for low in range(0, len(texts), 10_000):
        part = pa.RecordBatch.from_arrays([pa.array(texts[low:low + 10_000])], names=["text"])
        a, f, row, _, _ = suffix.fragments(part, suffix.N, suffix.K)
        hashes.append(np.stack([a, f, row.astype(np.uint64) + np.uint64(low)]))
    a, f, row = np.concatenate(hashes, axis=1)
    half = f >> np.uint64(32)
    order = np.lexsort((half, a))
    same = np.flatnonzero((half[order[1:]] == half[order[:-1]]) & (a[order[1:]] == a[order[:-1]]))
    pairs = [(texts[int(row[order[i]])], texts[int(row[order[i + 1]])]) for i in same]
    assert pairs and all(x != y for x, y in pairs)
    docs = [(2 * i + j, text) for i, pair in enumerate(pairs) for j, text in enumerate(pair)]
    out = suffix.dedup_bytes(spark.createDataFrame(docs, "doc_id long, text string").repartition(len(docs)))
    assert {r.doc_id: r.n_removed for r in out.collect()} == {d: 0 for d, _ in docs}


def test_candidates_of_a_document_follow_each_other():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 123, 900).astype(np.uint8)).decode() for _ in range(4)]
    texts[2] = texts[0][:400] + texts[2][:300] + texts[0][400:]
    part = pa.RecordBatch.from_arrays(
        [pa.array([5, 6, 7, 8], pa.int64()), pa.array([0] * 4, pa.int32()), pa.array(texts)], names=["d", "t", "text"])
    (got,) = suffix._candidates(suffix.N, suffix.K)([part])
    d, sc = got.column("d").to_numpy(), got.column("sc").to_numpy()
    assert (np.diff(d) >= 0).all() and all((np.diff(sc[d == x]) > 0).all() for x in (5, 6, 7, 8))
    a, f, row, s, count = suffix.fragments(part, suffix.N, suffix.K)
    assert sc.tolist() == [x << 16 | y << 1 | z & 1 for x, y, z in zip(s.tolist(), count.tolist(), sc.tolist())]
    # a fragment that the first text has too is known to occur earlier
    first = set(zip(a[row == 0].tolist(), f[row == 0].tolist()))
    again = [(x, y) in first and r == 2 for x, y, r in zip(a.tolist(), f.tolist(), row.tolist())]
    assert any(again) and (sc % 2 == 1).tolist() == again


def test_anchors_travel_with_their_high_bits_only(spark):
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(97, 123, 700).astype(np.uint8)).decode() for _ in range(3)]
    texts.append("q" + texts[0][100:400] + "z" + texts[1][:250])
    part = pa.RecordBatch.from_arrays(
        [pa.array([1, 2, 3, 4], pa.int64()), pa.array([0] * 4, pa.int32()), pa.array(texts)], names=["d", "t", "text"])
    (got,) = suffix._candidates(suffix.N, suffix.K)([part])
    a = got.column("a").to_numpy().view(np.uint64)
    assert (a & ~suffix.ANCHOR == 0).all() and len(np.unique(a)) > 10
    docs = spark.createDataFrame(list(zip([1, 2, 3, 4], texts)), "doc_id long, text string").repartition(4)
    assert {r.doc_id: r.n_removed for r in suffix.dedup_bytes(docs).collect()} == {1: 0, 2: 0, 3: 0, 4: 550}


def test_places_of_unique_documents_are_dealt_once(spark):
    docs = suffix.keyed(spark.range(50).selectExpr("id AS doc_id", "repeat(cast(id % 7 AS string), 300) AS text"), unique=True)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        count = [suffix.recurring(docs, suffix.places(docs), unique=u)._jdf.queryExecution().executedPlan().toString()
                 .count("Exchange hashpartitioning") for u in (True, False)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert count[0] == count[1] - 1
