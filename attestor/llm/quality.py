"""Quality scores learned from preference pairs (Bradley-Terry).

A text becomes a vector of measures of its form. Of two texts the one labelled 1 is
preferred to the one labelled 0, and the odds of that are exp(u(a) - u(b)), where u is
linear in the measures: logistic loss on the differences of features, over pairs that
every labelled text is part of. Scores are compared with a quantile: with a share p of
the labels 0, the utility q at that quantile of all labelled texts (weighted to the
labels' share where texts are missing) is the threshold, and

    score = 1 / (1 + exp(-(u - q) - ln(THRESHOLD / (1 - THRESHOLD))))

so a text's score reaches ``THRESHOLD`` exactly where its utility reaches q.

All labelled texts are fitted. Their vectors (``DIMENSIONS`` floats each; texts do not move)
are dealt by hash to groups of about ``PER_GROUP`` of each label, the rarer label's to several,
and written once; pairs are drawn within groups. A step of Newton's method is one pass over
the groups, whose sums are added in the groups' order: the driver holds sums only. The exact
quantile comes from counts in ever narrower ranges. Every text is judged whole where it lies.

Defined results: a null text counts as empty; an empty text has a score like any other. A
document with labels of both kinds counts for each. Without labels of both kinds every
score is ``THRESHOLD``. Equal texts get equal scores; repeated rows, other columns and
null ids or labels do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import materialize
from .common import free_name, pieces, utf8
from .langid import held_out
from .rolling import mix, word_hashes, words

PER_GROUP = 2_000  # texts of each label in a group, about
ADDED = 64  # groups whose sums are added in one place
VALUES, RANGES = 10_000, 1_000  # utilities that are looked at in one place; ranges of a pass
PAIRS = 16  # that each sampled text is part of, at least
THRESHOLD = 0.7
PENALTY = 1e-3
PIECE, PIECE_ROWS = 1 << 19, 2048

_CHARS = 97  # printable ASCII, one for control characters, one for bytes beyond ASCII
_MEASURES = 18
DIMENSIONS = _CHARS + _MEASURES

_CLASS = np.full(256, 96, np.int64)
_CLASS[:32] = 95
_CLASS[127] = 95
_CLASS[32:127] = np.arange(95)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_UPPER = (np.arange(256) >= 65) & (np.arange(256) < 91)
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) < 58)
_WORDY = _DIGIT | (np.arange(256) >= 128) | ((_LOWER >= 97) & (_LOWER < 123))


def _shares(rows: int, row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the units (words or lines) of each row: how many, the share that differ, the share
    equal to the one before, and the share of the commonest one."""
    n = np.bincount(row, minlength=rows).astype(float)
    some = np.maximum(n, 1)
    if not len(row):
        return n, some * 0 + 1, some * 0, some * 0
    again = np.zeros(len(row), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    order = np.lexsort((hashes, row))
    r, h = row[order], hashes[order]
    new = np.ones(len(r), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(r)))
    most = np.zeros(rows)
    np.maximum.at(most, r[at], size)
    distinct = np.bincount(r[at], minlength=rows)
    return n, np.where(n > 0, distinct / some, 1), np.bincount(row[again], minlength=rows) / some, most / some


def _lines(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the lines that are not empty."""
    edge = np.union1d(off, np.flatnonzero(data == 10) + 1)
    starts, ends = edge[:-1], edge[1:].copy()
    ends -= (data[ends - 1] == 10) & (ends > starts)
    some = ends > starts
    return starts[some], ends[some]


def vectors(column) -> np.ndarray:
    """A row of ``DIMENSIONS`` measures per text: square roots of the shares of characters,
    and counts and shares of words, lines and kinds of characters."""
    data, off = utf8(column)
    rows = len(off) - 1
    out = np.zeros((rows, DIMENSIONS))
    size = np.diff(off)
    row = np.repeat(np.arange(rows), size)
    chars = np.bincount(row * _CHARS + _CLASS[data], minlength=rows * _CHARS).reshape(rows, _CHARS)
    out[:, :_CHARS] = np.sqrt(chars / np.maximum(size, 1)[:, None])
    low = _LOWER[data]
    starts, ends, _ = words(data, off)
    where = np.searchsorted(off, starts, "right") - 1
    n, distinct, again, most = _shares(rows, where, word_hashes(low, starts, ends))
    some = np.maximum(n, 1)
    m = out[:, _CHARS:]
    m[:, 0], m[:, 1] = np.log1p(size) / 10, np.log1p(n) / 10
    m[:, 2], m[:, 3], m[:, 4] = distinct, again, most

    def share(flags: np.ndarray) -> np.ndarray:
        return np.bincount(where[flags], minlength=rows) / some

    if len(starts):
        before = np.concatenate([[0], np.cumsum(_UPPER[data])])
        wordy = np.concatenate([[0], np.cumsum(_WORDY[data])])
        long = ends - starts
        inner = wordy[ends] - wordy[starts]
        m[:, 5] = share((before[ends] - before[starts] > 1) & (before[ends] - before[starts] >= inner))
        m[:, 6] = share(inner == 0)
        m[:, 7] = share(long - inner > 1)
        m[:, 8] = np.bincount(where, long, rows) / some / 10
        m[:, 9] = np.sqrt(np.bincount(where, long.astype(float) ** 2, rows) / some) / 10
        m[:, 10] = share(long == 1)
        m[:, 11] = share(~_WORDY[data[ends - 1]])
    a, b = _lines(data, off) if len(data) else (np.zeros(0, np.int64),) * 2
    line_row = np.searchsorted(off, a, "right") - 1
    n_lines, *line_shares = _shares(rows, line_row, word_hashes(low, a, b))
    m[:, 12] = np.log1p(n_lines) / 10
    m[:, 13], m[:, 14], m[:, 15] = line_shares
    kinds = np.concatenate([_UPPER[data][None], _DIGIT[data][None]])
    for k in (0, 1):
        m[:, 16 + k] = np.bincount(row, kinds[k], rows) / np.maximum(size, 1)
    return out


def _drawn(count: int, other: int, pairs: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one of ``count`` and one of ``other``, each at least ``pairs`` times; chosen
    by hash, so every run takes the same."""
    total = max(count, other) * pairs
    k = np.arange(total, dtype=np.uint64)
    pick = mix(k + np.uint64(0x9E3779B97F4A7C15))
    few = np.where(count <= other, pick % np.uint64(max(count, 1)), k % np.uint64(max(count, 1)))
    many = np.where(count <= other, k % np.uint64(max(other, 1)), pick % np.uint64(max(other, 1)))
    return few.astype(np.int64), many.astype(np.int64)


def bradley_terry(good: np.ndarray, bad: np.ndarray, pairs: int = PAIRS, penalty: float = PENALTY,
                  rounds: int = 40) -> np.ndarray:
    """Weights w that maximise the mean log odds that w·good exceeds w·bad over the pairs,
    less ``penalty`` |w|²/2, by Newton's method; the loss has one minimum."""
    i, j = _drawn(len(good), len(bad), pairs)
    d = good[i] - bad[j]
    return _minimum(lambda w: _sums(d, w), len(d), d.shape[1], penalty, rounds)


def _sums(d: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Over the differences ``d``: the sums of the loss, its slope and its second derivatives
    (a row of numbers each)."""
    u = d @ w
    p = 1 / (1 + np.exp(np.clip(u, -60, 60)))  # that the other one is preferred
    return np.concatenate([[np.logaddexp(0, -u).sum()], -(d * p[:, None]).sum(0),
                           ((d * (p * (1 - p))[:, None]).T @ d).ravel()])


def _minimum(sums, pairs: int, size: int, penalty: float, rounds: int) -> np.ndarray:
    """Newton's method on the mean loss of ``pairs`` pairs, whose ``sums`` at given weights
    come from one pass."""
    def at(v: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        got = sums(v) / pairs
        return (float(got[0] + penalty * (v @ v) / 2), got[1:size + 1] + penalty * v,
                got[size + 1:].reshape(size, size) + penalty * np.eye(size))

    w = np.zeros(size)
    now, slope, bend = at(w)
    for _ in range(rounds):
        step = np.linalg.solve(bend, slope)
        far = 1.0
        then = at(w - step)
        while far > 1e-6 and then[0] > now - 1e-4 * far * (slope @ step):
            far /= 2
            then = at(w - far * step)
        w = w - far * step
        done = now - then[0] < 1e-9
        now, slope, bend = then
        if done:
            break
    return w


class Model:
    """Utilities of texts, and the utility that a text must reach."""

    def __init__(self):
        self.middle, self.scale = np.zeros(DIMENSIONS), np.ones(DIMENSIONS)
        self.weights, self.least = np.zeros(DIMENSIONS), 0.0

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return (x - self.middle) / self.scale

    def utility(self, x: np.ndarray) -> np.ndarray:
        # summed row by row, so that a text's score does not depend on its neighbours
        return (self.scaled(x) * self.weights).sum(1)

    def score(self, x: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
        u = self.utility(x) - self.least
        return 1 / (1 + np.exp(-np.clip(u, -500, 500)) * (1 - threshold) / threshold)


def _pack(table: pa.Table) -> pa.Table:
    """A group's vectors of each label as one value, in the order of ids. Vectors that came
    for the first time, not again to another group, stand in front."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("y", "again", "d", "v"))))
    made = {y: [r for r in rows if r[0] == y] for y in (0, 1)}
    return pa.table({
        "g": pa.array(table.column("g").to_pylist()[:1], pa.int64()),
        **{f"v{y}": pa.array([b"".join(r[3] for r in made[y])], pa.large_binary()).cast(pa.binary()) for y in (0, 1)},
        **{f"n{y}": pa.array([sum(not r[1] for r in made[y])], pa.int64()) for y in (0, 1)}})


def _one_by_one(batch: pa.RecordBatch):
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _added(groups: DataFrame, of) -> np.ndarray:
    """The sum over all groups of ``of(good, bad, number of good ones that came for the first
    time, of bad ones)``, an array each; added in the groups' order, so every run gets the same."""
    def run(batches):
        for batch in batches:
            for r in _one_by_one(batch):
                bad, good = (np.frombuffer(r[f"v{y}"], np.float32).reshape(-1, DIMENSIONS).astype(float) for y in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array([r["g"]]), pa.array([of(good, bad, r["n1"], r["n0"]).tobytes()])],
                                                 names=["g", "s"])

    def add(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("g").to_pylist(), table.column("s").to_pylist()))
        return pa.table({"g": pa.array([rows[0][0]]), "s": pa.array([sum(np.frombuffer(x) for _, x in rows).tobytes()])})

    each = groups.mapInArrow(run, "g long, s binary")
    few = each.groupBy(F.expr(f"g div {ADDED}").alias("part")).applyInArrow(add, "g long, s binary")
    return sum(np.frombuffer(r.s) for r in sorted(few.collect()))


def _quantile(values: DataFrame, weight: dict[int, float], share: float) -> float:
    """The value of ``values`` (u, y) below which a share ``share`` of the weights of their
    labels lies: half way between the two neighbours."""
    kinds = [F.coalesce(F.sum((F.col("y") == y).cast("long")), F.lit(0)).alias(f"n{y}") for y in (0, 1)]
    low, high = values.agg(F.min("u"), F.max("u")).first()
    before = {0: 0, 1: 0}

    def reached(n) -> float:
        return sum(weight[y] * n[y] for y in (0, 1))

    goal, inside = share - 1e-12, values
    while True:
        distinct = inside.groupBy("u").agg(*kinds)
        some = distinct.limit(VALUES + 1).collect()
        if len(some) <= VALUES:
            break
        wide = (high - low) / RANGES
        place = F.least(F.floor((F.col("u") - low) / wide), F.lit(RANGES - 1)).alias("r")
        counts = sorted(inside.groupBy(place).agg(*kinds, F.min("u").alias("low"), F.max("u").alias("high")).collect())
        for r in counts:
            then = {y: before[y] + r[f"n{y}"] for y in (0, 1)}
            if reached(then) >= goal or r is counts[-1]:
                low, high = r.low, r.high
                break
            before = then
        inside = values.where(F.col("u").between(low, high))
    for r in sorted(some):
        before = {y: before[y] + r[f"n{y}"] for y in (0, 1)}
        last = r.u
        if reached(before) >= goal:
            break
    if reached(before) - weight[0 if r.n0 else 1] >= goal:
        return last  # the next one is equal
    after = values.where(F.col("u") > last).agg(F.min("u")).first()[0]
    return (last + (last if after is None else after)) / 2


def fit(documents: DataFrame, labels: DataFrame, per_group: int = PER_GROUP) -> Model:
    """``documents``: doc_id, text. ``labels``: doc_id, quality (1 or 0). Both hold only what
    may be learned from."""
    known = (labels.select(F.col("doc_id").alias("d"), F.col("quality").cast("int").alias("y"))
             .where(F.col("y").isin(0, 1) & F.col("d").isNotNull()).distinct())
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    model = Model()
    if len(counts) < 2:
        return model
    most = max(counts.values())
    n_groups = max(1, round(most / per_group))
    times = {y: max(1, min(n_groups, round(most / counts[y]))) for y in (0, 1)}

    def run(batches):
        for part in pieces(batches, limit=PIECE, rows=PIECE_ROWS):
            v = vectors(part.column("text")).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [part.column("d"), pa.array([r.tobytes() for r in v], pa.binary())], names=["d", "v"])

    texts = documents.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("d"), F.coalesce("text", F.lit("")).alias("text"))
    one = (texts.mapInArrow(run, "d long, v binary").join(known.withColumn("d", F.col("d").cast("long")), "d")
           .groupBy("d", "y").agg(F.min("v").alias("v")))  # of texts that share an id, one
    again = F.explode(F.sequence(F.lit(0), F.when(F.col("y") == 1, times[1]).otherwise(times[0]) - 1))
    group = F.pmod(F.xxhash64("d", F.lit("quality")), F.lit(n_groups))
    dealt = one.select("d", "y", "v", group.alias("h"), again.alias("k")).select(
        "d", "y", "v", ((F.col("h") + F.col("k")) % n_groups).alias("g"), (F.col("k") > 0).alias("again"))
    groups = materialize(dealt.groupBy("g").applyInArrow(_pack, "g long, v0 binary, v1 binary, n0 long, n1 long"), "quality-groups")

    def moments(good, bad, n_good, n_bad) -> np.ndarray:
        x = np.vstack([good[:n_good], bad[:n_bad]])
        pairs = max(len(good), len(bad)) * PAIRS if len(good) and len(bad) else 0
        return np.concatenate([[n_good, n_bad, pairs], x.sum(0)])

    got = _added(groups, moments) if not groups.isEmpty() else np.zeros(3)
    n = {1: int(got[0]), 0: int(got[1])}
    if not (n[0] and n[1] and got[2]):
        return model
    model.middle = got[3:] / (n[0] + n[1])

    def squares(good, bad, n_good, n_bad) -> np.ndarray:
        return ((np.vstack([good[:n_good], bad[:n_bad]]) - model.middle) ** 2).sum(0)

    model.scale = np.maximum(np.sqrt(_added(groups, squares) / (n[0] + n[1])), 1e-3)

    def sums(w: np.ndarray) -> np.ndarray:
        def of(good, bad, *_) -> np.ndarray:
            if not (len(good) and len(bad)):
                return np.zeros(1 + DIMENSIONS + DIMENSIONS ** 2)
            i, j = _drawn(len(good), len(bad), PAIRS)
            return _sums(model.scaled(good)[i] - model.scaled(bad)[j], w)

        return _added(groups, of)

    model.weights = _minimum(sums, int(got[2]), DIMENSIONS, PENALTY, 40)

    def utilities(batches):
        for batch in batches:
            for r in _one_by_one(batch):
                for y in (0, 1):
                    x = np.frombuffer(r[f"v{y}"], np.float32).reshape(-1, DIMENSIONS)[:r[f"n{y}"]].astype(float)
                    yield pa.RecordBatch.from_arrays([pa.array(model.utility(x)), pa.array(np.full(len(x), y, np.int32))],
                                                     names=["u", "y"])

    share_bad = counts[0] / (counts[0] + counts[1])
    values = materialize(groups.mapInArrow(utilities, "u double, y int"), "quality-utilities")
    model.least = _quantile(values, {1: (1 - share_bad) / n[1], 0: share_bad / n[0]}, share_bad)
    return model


def score(documents: DataFrame, model: Model, name: str = "score", threshold: float = THRESHOLD) -> DataFrame:
    """``documents`` with ``name``, from 0 to 1; a column of its own of that name goes."""
    rows = documents.drop(*[c for c in documents.columns if c.lower() == name.lower()])
    kept = rows.columns
    schema = StructType([*rows.schema.fields, StructField(name, DoubleType())])

    def run(batches):
        for part in pieces(batches, limit=PIECE, rows=PIECE_ROWS):
            value = model.score(vectors(part.column("text")), threshold)
            yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + [pa.array(value)],
                                             names=[*kept, name])

    return rows.mapInArrow(run, schema)


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``documents`` whose score reaches ``threshold``; learned from all ``labels``."""
    found = free_name(documents, "_score")
    return (score(documents, fit(documents, labels), found, threshold)
            .where(F.col(found) >= threshold).select(*documents.columns))


def quality_report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from the labels that are not held out."""
    learn = labels.where(~F.coalesce(held_out(), F.lit(False)))
    model = fit(documents.select("doc_id", "text"), learn)
    rows = documents.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text")
    return score(rows, model).select(
        "doc_id", "held_out", "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
