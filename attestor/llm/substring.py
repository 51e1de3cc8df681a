"""Substring dedup: recurring passages, Aho-Corasick automata over them, every occurrence.

A window is ``N`` consecutive words of one document. A word is removed if a window that
covers it also starts earlier: in a document with a smaller ``doc_id``, or earlier in the
same one.

1. *Candidates.* Each task hashes its words and gives each window an anchor, the smallest
   hash of its runs of ``K`` words (``rolling.anchors``). Neighbouring windows with one
   anchor are a run; it travels as one row of its anchor, a 64-bit hash of its windows and
   its place. Where an anchor recurs, a run is linked to the first equal one. If an anchor
   has different runs, the windows of the first of each are hashed in a second pass over
   their documents, dealt by 96 bits of their content, and every later window is linked to
   the first one of its hash. Runs that are equal within a task's piece are linked there to
   their first, so a passage that a third of all documents share is shuffled once for each
   piece, not once for each document.
2. *Passages.* Links become passages of the earlier document, cut from its text. Recurring
   runs are written to the checkpoint folder when the operator is called.
3. *Automata.* Every task compiles the passages that its documents are linked to into
   Aho-Corasick automata of at most ``AUTOMATON_WINDOWS`` windows of words, one after the
   other, and streams those documents through them. They read runs of up to ``UNIT`` words,
   each as two symbols, so a window is a few steps and no state has many successors; a
   document is streamed once from each of its first ``UNIT`` words. An occurrence is
   confirmed run by run by the automaton, and counts if it starts later than the passage it
   repeats.

So hashes only propose; a false proposal is never found, and equal windows always share
anchor and hash. No task holds more than one automaton, one piece of text and one
document's links.

Defined results: null and empty texts have no words; documents of fewer than ``N`` words
lose none; rows that repeat ``doc_id`` and text are one document and get equal results;
documents that share a ``doc_id`` but no text are ordered by a hash of the text. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import keyed, pieces, unique_ids, unkeyed, utf8
from .rolling import U, anchors, grams, mix, word_hashes, words

N = 20
K = 6
AUTOMATON_WINDOWS = 20_000
#: Words of a run that the automata read as two symbols, at most; as many as divide a window
#: are taken. There are ``FANOUT`` first symbols; a state's successors are searched one by one.
UNIT = 5
FANOUT = 64
PIECE = 1 << 19
#: Passages are cut from the earlier document in stretches of this many window starts.
STRETCH = 64

#: Of a run: its anchor, the hash of its windows, its first word and its count of windows in one
#: number, its document; and the document and first word of an equal run that is known.
CANDIDATE = "a long, f long, sn long, d long, t int, od long, ot int, os int"
WINDOW = "h long, g int, d long, t int, p int"


def candidate_rows(part, n: int, k: int):
    """A slice's windows by anchor: (key, row, start, sizes, window hashes); None if none."""
    data, off = utf8(part.column("text"))
    starts, ends, first = words(data, off)
    if len(starts) < n:
        return None
    h = word_hashes(data, starts, ends)
    g, w = grams(h, k), grams(h, n)
    row = np.repeat(np.arange(len(off) - 1), np.diff(first))
    v = np.flatnonzero(row[:len(w)] == row[n - 1:])
    if not len(v):
        return None
    at = anchors(g, n - k + 1)[v]
    new = np.ones(len(v), bool)
    new[1:] = (np.diff(v) != 1) | (np.diff(at) != 0)
    runs = np.flatnonzero(new)
    return g[at[runs]], row[v[runs]], v[runs] - first[row[v[runs]]], np.diff(np.append(runs, len(v))), w[v]


def _candidates(n: int, k: int):
    schema = pa.schema([("a", pa.int64()), ("f", pa.int64()), ("sn", pa.int64()), ("d", pa.int64()),
                        ("t", pa.int32()), ("od", pa.int64()), ("ot", pa.int32()), ("os", pa.int32())])

    def run(batches):
        for part in pieces(batches, limit=PIECE):
            found = candidate_rows(part, n, k)
            if found is None:
                continue
            a, row, s, size, w = found
            d = part.column("d").to_numpy()[row]
            t = part.column("t").to_numpy()[row]
            begin = np.cumsum(size) - size
            whole = np.add.reduceat(mix(w + np.arange(len(w), dtype=np.uint64)
                                        - np.repeat(begin, size).astype(np.uint64)), begin)
            # equal runs: the first by place stands for all, the others are linked to it
            order = np.lexsort((s, t, d, whole, a))
            same = np.zeros(len(a), bool)
            same[1:] = (a[order[1:]] == a[order[:-1]]) & (whole[order[1:]] == whole[order[:-1]])
            head = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(a))))]
            known = same & ((d[order] != d[head]) | (t[order] != t[head]) | (s[order] != s[head]))
            i, owner, known = order[known | ~same], head[known | ~same], known[known | ~same]
            # a known run needs no meeting, so its key spreads it
            spread = mix(a[i] + np.arange(1, len(i) + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.where(known, spread, a[i]).view(np.int64)), pa.array(whole[i].view(np.int64)),
                 pa.array(s[i].astype(np.int64) << 16 | size[i]), pa.array(d[i]), pa.array(t[i]),
                 pa.array(d[owner], mask=~known), pa.array(t[owner], mask=~known),
                 pa.array(s[owner].astype(np.int32), mask=~known)], schema=schema)

    return run


def _windows(n: int):
    """Documents with some of their runs -> two hashes and the place of each window in them."""
    schema = pa.schema([("h", pa.int64()), ("g", pa.int32()), ("d", pa.int64()), ("t", pa.int32()), ("p", pa.int32())])

    def run(batches):
        for part in pieces(batches, limit=PIECE):
            data, off = utf8(part.column("text"))
            starts, ends, first = words(data, off)
            h = word_hashes(data, starts, ends)
            lists = part.column("runs").combine_chunks() if isinstance(
                part.column("runs"), pa.ChunkedArray) else part.column("runs")
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            runs = lists.flatten().to_numpy()
            size = runs & 0xFFFF
            inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            p, row = np.repeat(runs >> 16, size) + inside, np.repeat(row, size)
            at = first[row] + p
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams(h, n)[at].view(np.int64)),
                 pa.array((grams(mix(h), n)[at] >> U(32)).astype(np.uint32).view(np.int32)),
                 pa.array(part.column("d").to_numpy()[row]), pa.array(part.column("t").to_numpy()[row]),
                 pa.array(p.astype(np.int32))], schema=schema)

    return run


def links(docs: DataFrame, n: int = N, k: int = K) -> DataFrame:
    """od, ot, lo, hi, d, t: document (d, t) has windows that (od, ot) has earlier, at window
    starts from lo to hi - 1 there (with some that are not shared between them)."""
    rows = docs.mapInArrow(_candidates(n, k), CANDIDATE)
    by_anchor = Window.partitionBy("a").orderBy("f", "d", "t", "sn")
    all_of_it = by_anchor.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # a partition by anchor is one by anchor and hash as well: no second shuffle
    equal = Window.partitionBy("a", "f").orderBy("d", "t", "sn")
    place = F.struct("d", "t", "sn")
    rows = rows.select(
        "*", F.lag("f").over(by_anchor).alias("before"), F.lead("f").over(by_anchor).alias("after"),
        (F.first("f").over(all_of_it) != F.last("f").over(all_of_it)).alias("differ"))
    rows = rows.where(F.col("od").isNotNull() | F.col("before").isNotNull() | F.col("after").isNotNull())
    rows = rows.select("*", F.first(place).over(equal).alias("e"))
    own, start = F.col("od").isNotNull(), F.shiftright("e.sn", 16).cast("int")
    # links to equal runs; and, without a document, the first of each of several different runs
    linked = own | (place != F.col("e"))
    rows = materialize(rows.where(linked | F.col("differ")).select(
        F.when(linked, F.coalesce("od", "e.d")).alias("od"), F.when(linked, F.coalesce("ot", "e.t")).alias("ot"),
        F.when(linked, F.coalesce("os", start)).alias("lo"),
        F.col("sn").bitwiseAND(0xFFFF).cast("int").alias("n"), "d", "t",
        F.when(~linked, F.col("sn")).alias("sn")), "op1-runs")
    later = rows.where("sn IS NULL").drop("sn")
    # which windows of different runs are equal?
    mixed = rows.where("sn IS NOT NULL").groupBy("d", "t").agg(F.collect_set("sn").alias("runs"))
    windows = docs.join(mixed, ["d", "t"]).mapInArrow(_windows(n), WINDOW)
    first = F.first(F.struct("d", "t", "p")).over(Window.partitionBy("h", "g").orderBy("d", "t", "p"))
    windows = windows.select("d", "t", "p", first.alias("e")).where(F.struct("d", "t", "p") != F.col("e"))
    later = later.unionByName(windows.select(
        F.col("e.d").alias("od"), F.col("e.t").alias("ot"), F.col("e.p").alias("lo"), F.lit(1).alias("n"), "d", "t"))
    stretch = F.floor(F.col("lo") / STRETCH).alias("stretch")
    return (later.groupBy("od", "ot", "d", "t", stretch)
            .agg(F.min("lo").alias("lo"), F.max(F.col("lo") + F.col("n")).alias("hi")).drop("stretch"))


PASSAGES = "d long, t int, passages array<struct<od:bigint,ot:int,lo:int,words:string>>"


def _cut(n: int):
    """Pairs of documents with the earlier one's text -> its passages. Pairs of one earlier
    document that follow each other, as they do after a sort-merge join, split its text once."""
    passage = pa.struct([("od", pa.int64()), ("ot", pa.int32()), ("lo", pa.int32()), ("words", pa.string())])

    def run(batches):
        source, ws = None, []
        for part in pieces(batches):
            data, off = utf8(part.column("text"))
            cut = []
            for i, (od, ot, spans) in enumerate(zip(*(part.column(c).to_pylist() for c in ("od", "ot", "spans")))):
                if source != (od, ot):
                    source, ws = (od, ot), data[off[i]:off[i + 1]].tobytes().split()
                cut.append([{"od": od, "ot": ot, "lo": x["lo"], "words": b" ".join(ws[x["lo"]:x["hi"] + n - 1])}
                            for x in spans])
            yield pa.RecordBatch.from_arrays([part.column("d"), part.column("t"), pa.array(cut, pa.list_(passage))],
                                             names=["d", "t", "passages"])

    return run


def passages(docs: DataFrame, linked: DataFrame, n: int = N) -> DataFrame:
    """d, t and passages: (od, ot, lo, words of the earlier document joined by a blank)."""
    pairs = linked.groupBy("od", "ot", "d", "t").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    source = docs.withColumnRenamed("d", "od").withColumnRenamed("t", "ot")
    found = pairs.join(source, ["od", "ot"]).select("od", "ot", "d", "t", "spans", "text").mapInArrow(_cut(n), PASSAGES)
    return found.groupBy("d", "t").agg(F.flatten(F.collect_list("passages")).alias("passages"))


def joined(passages, n: int) -> list[tuple]:
    """(od, ot, lo, words) of each stretch once: stretches of one document that overlap or
    touch become one. Later places come first."""
    out: list[tuple] = []
    for od, ot, lo, ws in sorted(passages, key=lambda p: p[:3]):
        if out and out[-1][:2] == (od, ot) and lo <= out[-1][2] + len(out[-1][3]) - n + 1:
            known = out[-1][2] + len(out[-1][3]) - lo
            out[-1][3].extend(ws[known:] if known < len(ws) else [])
        else:
            out.append((od, ot, lo, list(ws)))
    return out[::-1]


def covered(docs: list[tuple], n: int = N, limit: int = AUTOMATON_WINDOWS) -> list[np.ndarray]:
    """For each (d, t, words, passages) a mask of its words inside a window that occurs
    earlier. Automata of ``limit`` windows are compiled and run one after the other."""
    import ahocorasick

    unit = max(u for u in range(1, UNIT + 1) if n % u == 0)

    def runs(ws):
        return zip(*(ws[i:] for i in range(unit)))

    def symbols(ids):
        # the second symbols are no first ones, so what is found starts with a run
        return [k % FANOUT for k in ids], [FANOUT + k // FANOUT for k in ids]

    masks = [np.zeros(len(w) + 1, np.int32) for _, _, w, _ in docs]
    todo = joined(((p["od"], p["ot"], p["lo"], p["words"].encode().split()) for x in docs for p in x[3]), n)
    at, skip = 0, 0
    while at < len(todo):
        number: dict[tuple, int] = {}
        machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        size = 0
        while at < len(todo) and size < limit:
            od, ot, lo, ws = todo[at]
            some = ws[skip:skip + limit + n - 1]
            pair = symbols([number.setdefault(x, len(number)) for x in runs(some)])
            windows = list(zip(*(s[i:] for i in range(0, n, unit) for s in pair)))
            # later places first, so of equal windows the earliest stays
            for i in range(len(windows) - 1, -1, -1):
                machine.add_word(windows[i], (od, ot, lo + skip + i))
            size += len(some)
            if skip + limit + n - 1 < len(ws):
                skip += limit
            else:
                at, skip = at + 1, 0
        if not len(machine):
            continue
        machine.make_automaton()
        get, unknown = number.get, (len(number) // FANOUT + 1) * FANOUT
        for (d, t, ws, _), mask in zip(docs, masks):
            if len(ws) < n:
                continue
            # a run that no passage has gets a symbol that none has
            one, two = symbols([get(x, unknown) for x in runs(ws)])
            for first in range(unit):
                stream = [0] * (2 * len(range(first, len(one), unit)))
                stream[::2], stream[1::2] = one[first::unit], two[first::unit]
                for end, place in machine.iter(tuple(stream)):
                    start = first + unit * (end // 2 + 1) - n
                    if place < (d, t, start):
                        mask[start] += 1
                        mask[start + n] -= 1
    return [np.cumsum(m[:-1]) > 0 for m in masks]


REPORT = "d long, t int, n_words long, n_removed long, spans array<struct<first:int,n:int>>, kept binary"


def _report(n: int, texts: bool):
    def rows_of(docs):
        masks = covered([x for x in docs if x[3]], n)
        out, k = [], 0
        for d, t, ws, found in docs:
            spans, kept = [], ws
            if found:
                mask = masks[k]
                k += 1
                edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
                spans = [{"first": int(a), "n": int(b - a)} for a, b in edge.reshape(-1, 2)]
                kept = [w for w, gone in zip(ws, mask.tolist()) if not gone]
            body = b" ".join(kept)
            out.append((d, t, len(ws), len(ws) - len(kept), spans,
                        body if texts else hashlib.sha256(body).hexdigest().encode()))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, ty) for c, ty in zip(zip(*out), (
                pa.int64(), pa.int32(), pa.int64(), pa.int64(),
                pa.list_(pa.struct([("first", pa.int32()), ("n", pa.int32())])), pa.binary()))],
            names=["d", "t", "n_words", "n_removed", "spans", "kept"])

    def run(batches):
        docs, size = [], 0
        for part in pieces(batches, limit=PIECE):
            for d, t, text, found in zip(*(part.column(c).to_pylist() for c in ("d", "t", "text", "passages"))):
                ws = text.encode().split()
                docs.append((d, t, ws, found or []))
                size += sum(len(p["words"]) for p in found or []) + len(text)
                if size >= 2 * PIECE:
                    yield rows_of(docs)
                    docs, size = [], 0
        if docs:
            yield rows_of(docs)

    return run


def dedup_substrings(documents: DataFrame, n: int = N, k: int = K, texts: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, spans (removed runs of words: first, from 0, and how many)
    and ``kept``, the words that are left joined by one space; without ``texts`` the
    SHA-256 of that instead, as ``kept_sha256``. One row per document row."""
    docs = keyed(documents, unique=unique_ids(documents))
    found = passages(docs, links(docs, n, k), n)
    rows = docs.join(found, ["d", "t"], "left").mapInArrow(_report(n, texts), REPORT)
    kept = F.col("kept").cast("string").alias("kept" if texts else "kept_sha256")
    return rows.select(unkeyed(), "n_words", "n_removed", kept, "spans")
