"""Document fingerprints by winnowing.

Code points are hashed in all runs of ``K``; of ``WINDOW`` neighbouring hashes the
smallest is kept, the rightmost of equal ones, with its position. So any two texts that
share ``K + WINDOW - 1`` code points share a fingerprint hash (the match guarantee). A
fingerprint is written as 16 hex digits per kept hash: position, then 32 bits of hash.
The likeness of two fingerprints is the Jaccard index of their sets of hashes.

``neighbours`` brings each document together with the next one in ascending order. The
rows are dealt to ranges of ``doc_id`` whose bounds are estimated quantiles; each range
also gets a copy of the first document of the next one, so texts are shuffled once and
every task reads its ranges as a stream.

Defined results: null and empty texts have an empty fingerprint; a text shorter than
``K`` has one hash, of the whole; two empty fingerprints are alike (1.0), an empty and a
filled one are not (0.0). Rows that share a ``doc_id`` follow each other by the hash of
their texts; a null ``doc_id`` comes first; a single row is its own next document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, keyed
from .rolling import U, anchors, grams, mix, powers

K = 20
WINDOW = 81
RANGES_PER_PARTITION = 4
PIECE_CHARS = 1 << 17


def fingerprints(texts: list[str], k: int = K, window: int = WINDOW) -> list[np.ndarray]:
    """For each text an array of rows (position, hash), in order of position."""
    size = np.array([len(t) for t in texts], np.int64)
    end = np.cumsum(size)
    start = end - size
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    v = mix(code.astype(np.uint64) + U(1))
    g = grams(v, k)
    # a text with fewer than `window` runs is one window over those that it has
    at = [np.zeros(0, np.int64)]
    best = anchors(g, window)
    full = np.flatnonzero(size >= k + window - 1)
    valid = np.zeros(len(best) + 1, np.int64)
    np.add.at(valid, start[full], 1)
    np.add.at(valid, end[full] - (k + window - 1) + 1, -1)
    picked = best[np.flatnonzero(np.cumsum(valid)[:len(best)])]
    if len(picked):
        at.append(picked[np.concatenate(([True], picked[1:] != picked[:-1]))])
    for i in np.flatnonzero((size >= k) & (size < k + window - 1)):
        some = g[start[i]:end[i] - k + 1]
        at.append(np.array([end[i] - k - int(np.argmin(some[::-1]))]))
    at = np.unique(np.concatenate(at))
    rows = np.stack([at, g[at] >> U(32)] if len(at) else [at, at], axis=1).astype(np.uint32)
    cut = np.searchsorted(at, start), np.searchsorted(at, end)
    out = []
    for i, t in enumerate(texts):
        own = rows[cut[0][i]:cut[1][i]] - np.array([start[i], 0], np.uint32)
        if 0 < size[i] < k:
            whole = (v[start[i]:end[i]] * powers(int(size[i]))).sum(dtype=np.uint64)
            own = np.array([[0, int(mix(np.array([whole], np.uint64))[0] >> U(32))]], np.uint32)
        out.append(own)
    return out


def written(rows: np.ndarray) -> str:
    return rows.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    x, y = set(a[:, 1].tolist()), set(b[:, 1].tolist())
    return len(x & y) / len(x | y) if x or y else 1.0


def neighbours(documents: DataFrame) -> DataFrame:
    """Rows (range, tail, d, t, text) dealt and sorted so that each row is followed by the
    next document; a row with ``tail`` 1 only closes its range."""
    spark = documents.sparkSession
    docs = keyed(documents)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = n * RANGES_PER_PARTITION
    cuts = docs.agg(F.percentile_approx("d", [i / ranges for i in range(1, ranges)], ranges * 20)).first()[0]
    cuts = np.array(sorted(set(cuts or [])), np.int64)

    @F.pandas_udf("int")
    def range_of(d):
        import pandas as pd

        return pd.Series(np.searchsorted(cuts, d.to_numpy(), side="right").astype(np.int32))

    dealt = docs.withColumn("range", range_of("d"))
    # one (range, first document) each: as many as there are ranges
    heads = sorted((r["range"], r.h.d, r.h.t) for r in docs.select("d", "t").distinct()
                   .withColumn("range", range_of("d")).groupBy("range")
                   .agg(F.min(F.struct("d", "t")).alias("h")).collect())
    if not heads:
        return dealt.select("range", F.lit(0).alias("tail"), "d", "t", "text")
    tails = spark.createDataFrame(
        [(heads[i - 1][0], d, t) for i, (_, d, t) in enumerate(heads)], "range int, d long, t int")
    tails = (docs.join(F.broadcast(tails), ["d", "t"]).groupBy("range", "d", "t")
             .agg(F.max("text").alias("text")))
    rows = dealt.select("range", F.lit(0).alias("tail"), "d", "t", "text").unionByName(
        tails.select("range", F.lit(1).alias("tail"), "d", "t", "text"))
    return rows.repartition(n, "range").sortWithinPartitions("range", "tail", "d", "t")


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


def edited_report(documents: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its text with the last quarter taken from the
    next document, and how alike they and the next document's are."""

    def chunks(batches):
        """Lists of rows; the last row of each is the first of the next list."""
        rows, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                rows.append(row)
                size += len(row[4])
                if size >= PIECE_CHARS and len(rows) > 1:
                    yield rows
                    rows, size = [row], len(row[4])
        if rows:
            yield rows

    def run(batches):
        for rows in chunks(batches):
            pairs = [(a, b) for a, b in zip(rows, rows[1:]) if a[1] == 0]
            if not pairs:
                continue
            edits = []
            for a, b in pairs:
                cut = len(a[4]) // 4
                edits.append(a[4][:len(a[4]) - cut] + b[4][:cut])
            marks = fingerprints([r[4] for r in rows] + edits)
            own = {id(r): m for r, m in zip(rows, marks)}
            edited = marks[len(rows):]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array([None if a[2] == NULL_ID else a[2] for a, _ in pairs], pa.int64()),
                "n_chars": pa.array([len(a[4]) for a, _ in pairs], pa.int64()),
                "edited_sha256": [hashlib.sha256(e.encode()).hexdigest() for e in edits],
                "fingerprint": [written(own[id(a)]) for a, _ in pairs],
                "edited_fingerprint": [written(m) for m in edited],
                "near_edited": [likeness(own[id(a)], m) for (a, _), m in zip(pairs, edited)],
                "near_next": [likeness(own[id(a)], own[id(b)]) for a, b in pairs]})

    return neighbours(documents).mapInArrow(run, RESULT)
