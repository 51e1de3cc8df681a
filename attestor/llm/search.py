"""Ranked lexical search of many items at once by common subexpressions.

Items that share terms share work. The items are cut into blocks of about ``ITEMS``, and
of each block a plan is made once, where the block lies:

* occurrences of terms that stand in exactly the same items are one *term set*;
* in each item's term sets, ordered from the most shared to the least, the pairs of
  neighbours that several items have are replaced by a new node (its sum), round after
  round, until no pair is shared. What is left of an item is a short list of nodes.

That is a directed acyclic graph of sums. A task then scores its documents some at a time:
it fills one accumulator per term set (a row of sums, a column per document), adds the
shared nodes up level by level, each of them once, and puts every item together from its
nodes. Mining is linear in the length of the items in every round, also for very long ones.

Work on the corpus: (1) every whole text is split once; what is written to the checkpoint
folder is each document's length and its counts of the block's terms; (2) document counts
and lengths are added up from that, with partial sums per task, and give the weights;
(3) documents are scored where their counts lie, each task keeps the best ``k`` per item,
and only those are shuffled and ranked. No document meets an item in a join, and no text
is shuffled. Plans (a few bytes per term of an item) travel with the tasks in passes of at
most ``PLAN_BYTES``; more items than that make more passes, never a larger broadcast.

Score, all in 64-bit integers: a document of n terms has m = 75 + (25 n N) div L, where N
documents hold any term and L terms in all; a term in df of them weighs
w = floor(1000 ln((2 N + 2) / (2 df + 1))); the score sums w ((10^9 tf) div (1000 tf + 12 m))
over the item's terms, repeats included.

Defined results: a null or empty text has no terms, finds nothing and is found by nothing.
Items that repeat both columns are one item; items that share an id but not a text are
ranked each by itself under that id; a null ``item_id`` is an item. Every document row is
a document: rows that repeat are ranked side by side. Equal scores go by ascending
``doc_id``, null first. Other columns do not matter.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, write_stage
from .common import NULL_ID, pieces, unkeyed

BEST = 20
ITEMS = 512
PLAN_BYTES = 32 << 20
CELLS = 1 << 21  # of accumulators that a task holds at a time
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of all other code points beyond ASCII."""
    return _TERM.findall(text.lower())  # lower() of bytes changes A to Z only


class Plan:
    """Term sets, shared sums and items of one block.

    ``vocabulary``: its terms. ``cells``: (term, node) pairs that fill the term sets' rows.
    ``levels``: per level the nodes (result, left, right) to add. ``roots``: per item its
    nodes. Nodes are numbered: term sets first, then the sums in the order they are made.
    """

    def __init__(self, items: list[list[bytes]]):
        symbols: dict[tuple[bytes, int], list[int]] = defaultdict(list)
        for i, words in enumerate(items):
            for word, times in Counter(words).items():
                for k in range(times):  # the k-th occurrence of a term is a symbol of its own
                    symbols[word, k].append(i)
        sets: dict[tuple[int, ...], list[bytes]] = defaultdict(list)
        for (word, _), owners in symbols.items():
            sets[tuple(owners)].append(word)
        shared_first = sorted(sets, key=lambda owners: (-len(owners), owners))
        self.vocabulary = sorted({word for word, _ in symbols})
        number = {word: i for i, word in enumerate(self.vocabulary)}
        cells = [(number[word], node) for node, owners in enumerate(shared_first) for word in sets[owners]]
        self.cells = np.array(sorted(cells), np.int64).reshape(-1, 2)
        self.sets = len(shared_first)
        chains: list[list[int]] = [[] for _ in items]
        for node, owners in enumerate(shared_first):
            for i in owners:
                chains[i].append(node)
        self.levels = self._share(chains)
        self.roots = chains

    @classmethod
    def of(cls, state: dict) -> Plan:
        """A plan from the attributes of one."""
        plan = cls.__new__(cls)
        vars(plan).update(state)
        return plan

    def _share(self, chains: list[list[int]]) -> list[np.ndarray]:
        """Replaces shared neighbours in ``chains`` by new nodes; returns the sums by level."""
        depth = dict.fromkeys(range(self.sets), 0)
        sums: list[tuple[int, int, int]] = []
        self.nodes = self.sets
        while True:
            owners = Counter(pair for chain in chains for pair in set(zip(chain, chain[1:])))
            common = {pair: n for pair, n in owners.items() if n > 1}
            made: dict[tuple[int, int], int] = {}
            for chain in chains:
                out, j = [], 0
                while j < len(chain):
                    pair = tuple(chain[j:j + 2])
                    after = tuple(chain[j + 1:j + 3])
                    # the next pair is taken instead if more items share it
                    if pair in common and common[pair] >= common.get(after, 0):
                        if pair not in made:
                            made[pair] = self.nodes
                            depth[self.nodes] = 1 + max(depth[pair[0]], depth[pair[1]])
                            sums.append((self.nodes, *pair))
                            self.nodes += 1
                        out.append(made[pair])
                        j += 2
                    else:
                        out.append(chain[j])
                        j += 1
                chain[:] = out
            if not made:
                break
        by_level = defaultdict(list)
        for node in sums:
            by_level[depth[node[0]]].append(node)
        return [np.array(by_level[k], np.int64) for k in sorted(by_level)]

    def additions(self) -> int:
        """Rows that are added per group of documents, term sets not counted."""
        return sum(map(len, self.levels)) + sum(max(len(r) - 1, 0) for r in self.roots)

    def rows(self) -> int:
        """Rows that ``scores`` holds at a time."""
        return 1 + self.nodes + len(self.roots) + sum(map(len, self.roots))

    def ready(self) -> None:
        """Index arrays for ``scores``."""
        self.first_cell = np.searchsorted(self.cells[:, 0], np.arange(len(self.vocabulary) + 1))
        self.some = np.array([i for i, r in enumerate(self.roots) if r], np.int64)
        self.flat = np.array([n for r in self.roots for n in r], np.int64)
        self.heads = np.concatenate([[0], np.cumsum([len(r) for r in self.roots if r])])[:-1].astype(np.int64)

    def scores(self, document: np.ndarray, term: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        """Items by documents: the sums of ``value`` of (document, term), of ``n`` documents."""
        rows = np.zeros((self.nodes, n), np.int64)
        count = self.first_cell[term + 1] - self.first_cell[term]
        at = np.repeat(self.first_cell[term] - np.concatenate(([0], np.cumsum(count)[:-1])), count)
        node = self.cells[at + np.arange(len(at)), 1]
        np.add.at(rows.reshape(-1), node * n + np.repeat(document, count), np.repeat(value, count))
        for level in self.levels:
            rows[level[:, 0]] = rows[level[:, 1]] + rows[level[:, 2]]
        out = np.zeros((len(self.roots), n), np.int64)
        if len(self.some):
            out[self.some] = np.add.reduceat(rows[self.flat], self.heads, axis=0)
        return out


def plans(items: DataFrame, per_block: int = ITEMS) -> DataFrame:
    """(block, plan, size): ``items`` (item_id, text) dealt to blocks by hash, each with its
    plan and item ids (as text) as bytes. Made by tasks, written and read back."""
    rows = items.select(F.col("item_id").cast("string").alias("item_id"),
                        F.coalesce("text", F.lit("")).alias("text")).distinct()
    blocks = max(1, -(-rows.count() // per_block))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int"))

    def mine(part):
        part = part.sort_values(["item_id", "text"])
        ids = [x if isinstance(x, str) else None for x in part["item_id"]]
        found = Plan([terms(t.encode("utf-8", "replace")) for t in part["text"]])
        body = pickle.dumps((ids, vars(found)), pickle.HIGHEST_PROTOCOL)
        return part.iloc[:1].assign(plan=[body], size=len(body))[["block", "plan", "size"]]

    return materialize(rows.groupBy("block").applyInPandas(mine, "block int, plan binary, size long"), "search-plans")


def _passes(made: DataFrame, limit: int):
    """Lists of (block, item ids, plan), each of about ``limit`` bytes at most."""
    sizes = sorted((r.block, r.size) for r in made.select("block", "size").collect())
    group, total = [], 0
    for k, (block, size) in enumerate(sizes):
        group.append(block)
        total += size
        if k + 1 == len(sizes) or total + sizes[k + 1][1] > limit:
            got = made.where(F.col("block").isin(group)).collect()
            read = [(r.block, *pickle.loads(bytes(r.plan))) for r in sorted(got, key=lambda r: r.block)]
            yield [(block, ids, Plan.of(state)) for block, ids, state in read]
            group, total = [], 0


def counted(documents: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """d, n (terms in the text), t and f: the terms of ``vocabulary`` that it holds, by
    number, and how often. Documents without a term are left out."""
    number = {word: i for i, word in enumerate(vocabulary)}
    rows = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("d"),
                            F.col("text").cast("binary").alias("text")).where(F.col("text").isNotNull())

    def run(batches):
        for part in pieces(batches):
            ids, sizes, held, times, ends = [], [], [], [], [0]
            for d, text in zip(part.column("d").to_pylist(), part.column("text")):
                found = terms(text.as_py())
                if not found:
                    continue
                for word, f in Counter(found).items():
                    k = number.get(word)
                    if k is not None:
                        held.append(k)
                        times.append(f)
                ids.append(d)
                sizes.append(len(found))
                ends.append(len(held))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, kind))
                     for x, kind in ((held, pa.int32()), (times, pa.int64()))]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *lists],
                                             names=["d", "n", "t", "f"])

    return rows.mapInArrow(run, "d long, n long, t array<int>, f array<long>")


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """The elements of an Arrow list column and each row's offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    off = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]].astype(np.int64), off - off[0]


def statistics(held: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents, all their terms, and per term the documents that hold it. A task adds up
    its own rows first: one row per term and task is shuffled, one per term is collected."""
    def run(batches):
        docs = total = 0
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            docs += batch.num_rows
            total += int(batch.column("n").to_numpy(zero_copy_only=False).sum())
            flat, _ = _flat(batch.column("t"))
            df += np.bincount(flat, minlength=n_terms)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-2, -1], some]), pa.int64()), pa.array([docs, total, *df[some].tolist()], pa.int64())],
            names=["t", "c"])

    got = {r.t: r.c for r in held.select("n", "t").mapInArrow(run, "t long, c long")
           .groupBy("t").agg(F.sum("c").alias("c")).collect()}
    df = np.zeros(n_terms, np.int64)
    for t, c in got.items():
        if t >= 0:
            df[t] = c
    return got.get(-2, 0), got.get(-1, 0), df


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


class Best:
    """The best ``k`` documents of each item so far: highest score, then smallest id."""

    def __init__(self, items: int, k: int):
        self.k, self.items = k, items
        self.item = self.doc = self.score = np.zeros(0, np.int64)
        self.least = np.ones(items, np.int64)  # a score to be beaten or met

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        item, at = np.nonzero(scores >= self.least[:, None])
        if not len(item):
            return
        self.item = np.concatenate([self.item, item])
        self.doc = np.concatenate([self.doc, ids[at]])
        self.score = np.concatenate([self.score, scores[item, at]])
        order = np.lexsort((self.doc, -self.score, self.item))
        item = self.item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        order = order[rank < self.k]
        self.item, self.doc, self.score = self.item[order], self.doc[order], self.score[order]
        last = np.flatnonzero(rank == self.k - 1)
        self.least[item[last]] = self.score[np.searchsorted(self.item, item[last], "right") - 1]


def best_of_tasks(held: DataFrame, blocks, of_block, df: np.ndarray, n_docs: int, total: int, k: int) -> DataFrame:
    """block, i (item of the block), d, score: each task's best ``k`` documents per item.

    ``of_block``: per block the numbers of its terms in the pass's vocabulary."""
    weight = weights(n_docs, df)
    n_words = len(df)
    step = [max(16, CELLS // plan.rows()) for _, _, plan in blocks]

    def run(batches):
        best = [Best(len(ids), k) for _, ids, _ in blocks]
        local = []
        for (_, _, plan), mine in zip(blocks, of_block):
            plan.ready()
            to = np.full(n_words, -1, np.int64)
            to[mine] = np.arange(len(mine))
            local.append(to)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("d").to_numpy(zero_copy_only=False)
            m = np.array([75 + 25 * n * n_docs // total for n in batch.column("n").to_pylist()], np.int64)
            term, off = _flat(batch.column("t"))
            f, _ = _flat(batch.column("f"))
            row = np.repeat(np.arange(len(ids)), np.diff(off))
            value = weight[term] * ((10 ** 9 * f) // (1000 * f + 12 * m[row]))
            for b, (_, _, plan) in enumerate(blocks):
                for a in range(0, len(ids), step[b]):
                    z = min(a + step[b], len(ids))
                    part = slice(off[a], off[z])
                    t = local[b][term[part]]
                    own = t >= 0
                    best[b].add(plan.scores(row[part][own] - a, t[own], value[part][own], z - a), ids[a:z])
        for (block, _, _), found in zip(blocks, best):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found.item), block), pa.int32()), pa.array(found.item, pa.int32()),
                 pa.array(found.doc, pa.int64()), pa.array(found.score, pa.int64())], names=["block", "i", "d", "score"])

    return held.mapInArrow(run, "block int, i int, d long, score long")


def search(documents: DataFrame, items: DataFrame, k: int = BEST, per_block: int = ITEMS,
           plan_bytes: int = PLAN_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: of each item (item_id, text) the ``k`` documents
    (doc_id, text) with the highest scores above 0."""
    spark = documents.sparkSession
    kind, out = items.schema["item_id"].dataType, []
    for blocks in _passes(plans(items, per_block), plan_bytes):
        words = sorted({w for _, _, plan in blocks for w in plan.vocabulary})
        if not words:
            continue
        number = {w: i for i, w in enumerate(words)}
        of_block = [np.array([number[w] for w in plan.vocabulary], np.int64) for _, _, plan in blocks]
        held = materialize(counted(documents, words), "search-counts")
        n_docs, total, df = statistics(held, len(words))
        if not total:
            continue
        for _, _, plan in blocks:
            plan.vocabulary = range(len(plan.vocabulary))  # from here on terms are numbers
        names = spark.createDataFrame(
            [(block, i, item) for block, ids, _ in blocks for i, item in enumerate(ids)],
            "block int, i int, item_id string").withColumn("item_id", F.col("item_id").cast(kind))
        found = best_of_tasks(held, blocks, of_block, df, n_docs, total, k)
        order = Window.partitionBy("block", "i").orderBy(F.col("score").desc(), "d")
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        out.append(write_stage(ranked.join(F.broadcast(names), ["block", "i"]).select(
            "item_id", "rank", unkeyed(), "score"), "search"))
    if not out:
        return items.where(F.lit(False)).select(
            "item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    return spark.read.parquet(*out)
