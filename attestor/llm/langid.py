"""Language ID in two steps: the family first, then one-versus-one linear SVMs in it.

A text becomes a vector of hashed byte 1- to 4-grams of its letters (ASCII lower-cased,
other bytes kept, runs of anything else one blank), square roots of counts, of length
one. One linear classifier per pair of families votes for the family, and one linear
support vector machine per pair of languages of the family that won votes for the
language; ties go to the larger sum of margins. A language that the table of families
lacks is a family of its own.

Only a bounded sample is fitted: ``PER_LANGUAGE`` labelled texts of each language, those
with the smallest hash of the text; their vectors (``DIMENSIONS`` floats each), not their
texts, come to the driver. Every text is then judged whole where it lies, without a
shuffle.

Defined results: ``und`` and score 0 for a null text or one without a letter, and for
every text if no labelled text was given. Equal texts get equal results; repeated rows
and extra columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, pieces, utf8

DIMENSIONS = 4096
PER_LANGUAGE = 300
PIECE, PIECE_ROWS = 1 << 18, 512

# Common language codes by family.
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb", "yi"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"],
    "baltic": ["lt", "lv"],
    "uralic": ["fi", "et", "hu"],
    "indic": ["hi", "bn", "mr", "ne", "pa", "gu", "ur"],
    "turkic": ["tr", "az", "kk", "uz"],
    "semitic": ["ar", "he", "mt"],
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}

_LETTER = np.zeros(256, np.uint8)
for _b in range(256):
    if _b >= 0x80 or chr(_b).isalpha():
        _LETTER[_b] = ord(chr(_b).lower()) if _b < 0x80 else _b
_LETTER[_LETTER == 0] = 32


def vectors(column) -> np.ndarray:
    """A row of ``DIMENSIONS`` floats per text, of length one, or zero without letters."""
    data, off = utf8(column)
    rows = len(off) - 1
    out = np.zeros((rows, DIMENSIONS), np.float32)
    if not len(data):
        return out
    x = _LETTER[data].astype(np.uint32)
    row = np.repeat(np.arange(rows, dtype=np.int64), np.diff(off))
    keep = np.ones(len(x), bool)  # one blank for a run of them, and one at a text's start
    keep[1:] = (x[1:] != 32) | (x[:-1] != 32) | (row[1:] != row[:-1])
    x, row = x[keep], row[keep]
    flat = np.zeros(rows * DIMENSIONS, np.int64)
    gram = np.zeros(len(x), np.uint32)
    for n in range(1, 5):
        if len(x) < n:
            break
        gram = (gram[:len(x) - n + 1] << np.uint32(8)) | x[n - 1:]
        inside = row[n - 1:] == row[:len(x) - n + 1]
        h = (gram * np.uint32(2654435761) + np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF))
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        slot = (h >> np.uint32(20)).astype(np.int64) % DIMENSIONS
        flat += np.bincount((row[:len(x) - n + 1] * DIMENSIONS + slot)[inside], minlength=len(flat))
    out[:] = np.sqrt(flat.reshape(rows, DIMENSIONS))
    size = np.sqrt((out * out).sum(1, keepdims=True))
    return out / np.where(size > 0, size, 1)


def linear_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Weights (the last one is the bias) of a two-class linear SVM by dual coordinate
    descent with squared hinge loss; y is +1 or -1. Same input, same result."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float64)
    share = np.where(y > 0, (y < 0).mean(), (y > 0).mean()) * 2  # classes weigh alike
    slack = 1 / (2 * cost * np.maximum(share, 1e-3))
    norm = (x * x).sum(1) + slack
    w, a, rng = np.zeros(x.shape[1]), np.zeros(len(x)), np.random.default_rng(7)
    for _ in range(rounds):
        for i in rng.permutation(len(x)):
            g = y[i] * (x[i] @ w) - 1 + slack[i] * a[i]
            new = max(a[i] - g / norm[i], 0.0)
            if new != a[i]:
                w += (new - a[i]) * y[i] * x[i]
                a[i] = new
    return w.astype(np.float32)


class Model:
    """Pairs of classes with their weights: first of families, then of languages in each."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        family = [_FAMILY.get(c, c) for c in langs]
        self.families = sorted(set(family))
        self.top = self._pairs(x, family, self.families)
        self.members, self.inner = {}, {}
        for f in self.families:
            rows = [i for i, g in enumerate(family) if g == f]
            own = [langs[i] for i in rows]
            self.members[f] = sorted(set(own))
            self.inner[f] = self._pairs(x[rows], own, self.members[f])

    @staticmethod
    def _pairs(x, labels, classes):
        labels, out = np.array(labels), []
        for i, a in enumerate(classes):
            for j in range(i + 1, len(classes)):
                some = (labels == a) | (labels == classes[j])
                out.append((i, j, linear_svm(x[some], np.where(labels[some] == a, 1.0, -1.0))))
        return out

    @staticmethod
    def _vote(x, pairs, n):
        """The winner's number and its score: its mean share in its duels."""
        votes, sums, share = (np.zeros((len(x), n)) for _ in range(3))
        for i, j, w in pairs:
            m = x @ w[:-1] + w[-1]
            p = 1 / (1 + np.exp(-4 * np.clip(m, -20, 20)))
            votes[:, i] += m >= 0
            votes[:, j] += m < 0
            sums[:, i] += m
            sums[:, j] -= m
            share[:, i] += p
            share[:, j] += 1 - p
        best = np.lexsort((np.tile(-np.arange(n), (len(x), 1)), sums, votes), axis=1)[:, -1]
        return best, np.ones(len(x)) if n == 1 else share[np.arange(len(x)), best] / (n - 1)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lang, score = np.full(len(x), "und", object), np.zeros(len(x))
        if not len(x) or not self.families:
            return lang, score
        best, top = self._vote(x, self.top, len(self.families))
        for k, f in enumerate(self.families):
            rows = np.flatnonzero(best == k)
            if len(rows):
                own, s = self._vote(x[rows], self.inner[f], len(self.members[f]))
                lang[rows] = np.array(self.members[f], object)[own]
                score[rows] = np.minimum(top[rows], s)
        return lang, score


def has_letter(text):
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """``labelled``: text and lang. Fits the texts of each language whose hash is smallest."""
    rows = labelled.select("text", "lang").where(F.col("lang").isNotNull() & has_letter("text"))
    # only hashes are ranked, so texts stay where they are
    chosen = (rows.select("lang", F.xxhash64("text").alias("h")).distinct().withColumn(
        "n", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
        .where(F.col("n") <= per_language).select("lang", "h"))
    sample = (rows.withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen), ["lang", "h"])
              .dropDuplicates(["lang", "h"]).select("lang", "h", "text"))

    def run(batches):
        for part in pieces(batches, limit=PIECE, rows=PIECE_ROWS):
            v = vectors(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("lang"), part.column("h"),
                 pa.array([r.astype(np.float16).tobytes() for r in v], pa.binary())],
                names=["lang", "h", "v"])

    got = sorted((r.lang, r.h, bytes(r.v)) for r in sample.mapInArrow(run, "lang string, h long, v binary").collect())
    x = np.array([np.frombuffer(v, np.float16) for _, _, v in got], np.float32).reshape(-1, DIMENSIONS)
    return Model(x, [lang for lang, _, _ in got])


def predict(documents: DataFrame, model: Model, name: str = "lang_pred") -> DataFrame:
    """``documents`` with the columns ``name`` and ``score``; its own of these names go."""
    score_name = "score" if name == "lang_pred" else free_name(documents, name + "_score")
    rows = documents.drop(*[c for c in documents.columns if c.lower() in (name, score_name)])
    flag = free_name(rows, "_letters")
    rows = rows.withColumn(flag, has_letter("text"))
    kept = [c for c in rows.columns if c != flag]

    def run(batches):
        for part in pieces(batches, limit=PIECE, rows=PIECE_ROWS):
            lang, score = model.predict(vectors(part.column("text")))
            none = ~part.column(flag).to_numpy(zero_copy_only=False).astype(bool)
            lang[none], score[none] = "und", 0.0
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in kept] + [pa.array(lang.tolist(), pa.string()), pa.array(score)],
                names=[*kept, name, score_name])

    schema = rows.drop(flag).schema.add(name, "string").add(score_name, "double")
    return rows.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def identify(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows that are not held out."""
    flag = F.coalesce(held_out(), F.lit(False)).alias("held_out")
    rows = documents.select("doc_id", "text", "lang", flag)
    model = fit(rows.where(~F.col("held_out")))
    return predict(rows.select("doc_id", "held_out", "text"), model).drop("text")


def keep_identified(documents: DataFrame) -> DataFrame:
    """``documents`` without those in which no language can be found (``und``)."""
    learn = documents.where(~F.coalesce(held_out(), F.lit(False))).select("text", "lang")
    found = free_name(documents, "_lang")
    return (predict(documents, fit(learn), found).where(F.col(found) != "und")
            .select(*documents.columns))
