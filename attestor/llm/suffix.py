"""Suffix-array dedup: the interval tree of common prefixes over all places that recur.

A window is ``N`` bytes of one document's UTF-8 text. A byte is removed if a window that
covers it also starts earlier: in a document with a smaller ``doc_id``, or earlier in the
same one.

1. *Fragments.* Windows are cut by their anchor, the smallest hash of their runs of ``K``
   bytes (``rolling.anchors``): neighbouring windows with one anchor form a fragment, and
   equal windows have equal anchors. Only the anchor, a hash of the fragment and its place
   are shuffled. Anchors that occur once drop out; of equal fragments the first stands for
   all (tasks already join equal ones before the shuffle), the others are occurrences of
   the same repeat wherever it occurs.
2. *Suffix arrays.* The fragments that are left are dealt by anchor and sorted. A task takes
   them ``CHUNK`` bytes at a time (and to the end of an anchor), sorts the suffixes that
   start a window, each up to its fragment's end, and takes the common prefixes of
   neighbours and the byte to the left of each.
   An anchor with more than ``HOT`` different fragments (words that stand in very many
   contexts) would fill a task: its windows are dealt one by one instead, by two hashes of
   their bytes, and all but the first of equal ones are removed; a join finds them that
   Spark can split.
3. *Interval tree.* Runs of suffixes that share ``N`` bytes or more are scanned with a stack.
   Runs whose suffixes all have the same byte on the left hold no maximal repeat: each of
   their repeats is part of one that starts a byte earlier. In the others every interval
   of the stack is a repeat with all its occurrences; all but the first in order of place
   are removed over the full length of the repeat.

Defined results: null and empty texts have no bytes; shorter texts than ``N`` lose none;
rows that repeat ``doc_id`` and text are one document and get equal results; documents
that share a ``doc_id`` but no text are ordered by a hash of the text; removed bytes may
split a character, so what is left is bytes. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keyed, pieces, unique_ids, unkeyed, utf8
from .rolling import U, anchors, grams, mix

N = 100
K = 32
PIECE = 1 << 17
CHUNK = 1 << 18
#: Of an anchor so many bits travel: it only brings fragments together, which are compared
#: with each other (equal ones by their 64-bit hash too). The low ones are cut, as whole bytes.
ANCHOR = U(0xFFFFFFFFFF000000)
#: An anchor with more different fragments than this is not dealt to one task.
HOT = 50_000

_BYTE = mix(np.arange(1, 257, dtype=np.uint64))

#: Of a candidate: its anchor; a hash of its content and its count of windows; its document;
#: and, in one number, its first byte, its count of windows and whether it is known to occur
#: earlier. Most are shuffled only to find that they are alone, so they are small, and those of
#: one document follow each other.
CANDIDATE = "a long, f long, d long, t int, sc long"
FRAGMENT = "a long, d long, t int, sn long, body binary, spans array<struct<first:int,n:int>>"
SPANS = "d long, t int, spans array<struct<first:int,n:int>>"
_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("n", pa.int32())]))


def fragments(part, n: int, k: int):
    """A slice's windows by anchor: (key, content hash, row, start, count); None if none."""
    data, off = utf8(part.column("text"))
    if len(data) < n:
        return None
    g = grams(_BYTE[data], k)
    row = np.repeat(np.arange(len(off) - 1, dtype=np.int32), np.diff(off))
    v = np.flatnonzero(row[:len(data) - n + 1] == row[n - 1:])
    if not len(v):
        return None
    at = anchors(g, n - k + 1)[v]
    new = np.ones(len(v), bool)
    new[1:] = (np.diff(v) != 1) | (np.diff(at) != 0)
    runs = np.flatnonzero(new)
    count = np.diff(np.append(runs, len(v)))
    start = v[runs]
    # runs of k bytes that together cover the first n and the last n bytes
    whole = count.astype(np.uint64)  # so the hash tells counts apart too
    for base in (start, start + count - 1):
        for step in [*range(0, n - k, k), n - k]:
            whole = mix(whole * U(0x9E3779B97F4A7C15) + g[base + step])
    return g[at[runs]], whole, row[start], start - off[row[start]], count


def _candidates(n: int, k: int):
    schema = pa.schema([(c, pa.int32() if c == "t" else pa.int64()) for c in ("a", "f", "d", "t", "sc")])

    def run(batches):
        for part in pieces(batches, limit=PIECE):
            found = fragments(part, n, k)
            if found is None:
                continue
            a, f, row, s, count = found
            a = a & ANCHOR
            d = part.column("d").to_numpy()[row]
            t = part.column("t").to_numpy()[row]
            order = np.lexsort((s, t, d, f, a))
            same = np.zeros(len(a), bool)
            same[1:] = (a[order[1:]] == a[order[:-1]]) & (f[order[1:]] == f[order[:-1]])
            head = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(a))))]
            known = same & ~((d[order] == d[head]) & (t[order] == t[head]) & (s[order] == s[head]))
            keep = known | ~same
            i, known = order[keep], known[keep]
            by_place = np.argsort(i)
            i, known = i[by_place], known[by_place]
            # an occurrence that is known needs no meeting, so its key spreads it
            spread = mix(a[i] + np.arange(1, len(i) + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
            key = np.where(known, spread & ANCHOR, a[i]).view(np.int64)
            sc = s[i].astype(np.int64) << 16 | count[i] << 1 | known
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(f[i].view(np.int64)), pa.array(d[i]), pa.array(t[i]), pa.array(sc)],
                schema=schema)

    return run


def _cut(n: int):
    """Documents with their recurring places -> fragments, and one row of known spans each."""
    def run(batches):
        for part in pieces(batches):
            cols = {c: [] for c in ("a", "d", "t", "sn", "body", "spans")}

            def put(**row):
                for c, values in cols.items():
                    values.append(row.get(c))

            for d, t, text, keys, places in zip(
                    *(part.column(c).to_pylist() for c in ("d", "t", "text", "keys", "places"))):
                raw = text.encode()
                spans = []
                for a, p in zip(keys, places):
                    s, count = p >> 17, p >> 2 & 0x7FFF
                    if p & 1:
                        spans.append({"first": s, "n": count + n - 1})
                    else:
                        put(a=a, d=d, t=t, sn=s << 16 | count, body=raw[s:s + count + n - 1])
                if spans:  # their key only spreads them
                    put(a=hash((d, t)), d=d, t=t, sn=0, spans=merged(spans))
            if cols["a"]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols["a"], pa.int64()), pa.array(cols["d"], pa.int64()),
                     pa.array(cols["t"], pa.int32()), pa.array(cols["sn"], pa.int64()),
                     pa.array(cols["body"], pa.binary()), pa.array(cols["spans"], _SPANS)],
                    names=list(cols))

    return run


def merged(spans: list[dict]) -> list[dict]:
    out: list[dict] = []
    for x in sorted(spans, key=lambda x: x["first"]):
        if out and x["first"] <= out[-1]["first"] + out[-1]["n"]:
            out[-1]["n"] = max(out[-1]["n"], x["first"] + x["n"] - out[-1]["first"])
        else:
            out.append({"first": x["first"], "n": x["n"]})
    return out


def suffixes(bodies: list[bytes], counts: np.ndarray, n: int):
    """The enhanced suffix array of the suffixes that start a window: for each, in order of
    the text, its place among all bytes, its fragment, the length it shares with the one
    before it, and the byte on its left (-1 at a fragment's start, where it is not known to
    be shared)."""
    size = np.array([len(b) for b in bodies], np.int64)
    begin = np.cumsum(size) - size
    depth = int(size.max())
    data = np.frombuffer(b"".join(bodies) + bytes(depth), np.uint8)
    frag = np.repeat(np.arange(len(bodies)), counts)
    inside = np.arange(len(frag)) - np.repeat(np.cumsum(counts) - counts, counts)
    at, room = begin[frag] + inside, (size[frag] - inside)
    text = np.lib.stride_tricks.sliding_window_view(data, depth)[at]
    text = np.where(np.arange(depth) < room[:, None], text, 0).astype(np.uint8)
    order = np.argsort(text.view(f"S{depth}").ravel(), kind="stable")
    text, room = text[order], room[order]
    differ = text[1:] != text[:-1]
    shared = np.where(differ.any(1), differ.argmax(1), depth)
    shared = np.concatenate(([0], np.minimum(shared, np.minimum(room[1:], room[:-1]))))
    left = np.where(inside[order] > 0, data[np.maximum(at[order] - 1, 0)].astype(np.int32), -1)
    return at[order], frag[order], shared, left


def repeats(at: np.ndarray, shared: np.ndarray, left: np.ndarray, n: int, nodes: list | None = None):
    """(rank, length) of each occurrence that is not the first of a repeat, with the longest
    such repeat. Every interval goes to ``nodes``, if given, as (first rank, last rank,
    length)."""
    deep = shared >= n
    edge = np.flatnonzero(np.diff(np.concatenate(([0], deep.astype(np.int8), [0]))))
    lows, highs = edge[::2] - 1, edge[1::2]  # runs are [low, high)
    if not len(lows):
        return []
    other = np.zeros(len(at) + 1, np.int64)
    changed = deep.copy()
    changed[1:] &= (left[1:] != left[:-1]) | (left[1:] < 0)
    other[1:] = np.cumsum(changed)
    out = []
    for low, high in zip(lows.tolist(), highs.tolist()):
        if other[high] == other[low + 1]:
            continue
        stack: list[tuple[int, int, int]] = []  # first rank, rank of the first place, shared with the next
        places, common = at[low:high].tolist(), shared[low:high].tolist() + [-1]
        for i in range(high - low):
            first, best, nxt = i, i, common[i + 1]
            while stack and stack[-1][2] >= nxt:
                begun, own, length = stack.pop()
                first = begun
                if places[own] < places[best]:
                    own, best = best, own
                out.append((low + own, length))
                if nodes is not None and length > nxt and (not stack or stack[-1][2] < length):
                    nodes.append((low + begun, low + i, length))
            stack.append((first, best, nxt))
    return out


def _chunks(batches, limit: int):
    """Lists of fragment rows that end with an anchor; and the rows that are known spans."""
    rows, size = [], 0
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            if row[4] is None:
                yield None, row
                continue
            if rows and row[:4] == rows[-1][:4]:
                continue  # a repeated row's place
            if size >= limit and row[0] != rows[-1][0]:
                yield rows, None
                rows, size = [], 0
            rows.append(row)
            size += len(row[4])
    if rows:
        yield rows, None


def _scan(n: int, limit: int):
    def run(batches):
        out = []
        for rows, known in _chunks(batches, limit):
            if known is not None:
                out.append((known[1], known[2], known[5]))
            else:
                counts = np.array([r[3] & 0xFFFF for r in rows])
                at, frag, shared, left = suffixes([r[4] for r in rows], counts, n)
                begin = np.cumsum([0] + [len(r[4]) for r in rows])
                found: dict[int, list] = {}
                for rank, length in repeats(at, shared, left, n):
                    i = int(frag[rank])
                    found.setdefault(i, []).append(
                        {"first": (rows[i][3] >> 16) + int(at[rank] - begin[i]), "n": length})
                out += [(rows[i][1], rows[i][2], merged(x)) for i, x in found.items()]
            if len(out) >= 2000 or rows:
                yield from _spans_batch(out)
                out = []
        yield from _spans_batch(out)

    return run


def _spans_batch(rows):
    if rows:
        d, t, spans = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(d, pa.int64()), pa.array(t, pa.int32()), pa.array(spans, _SPANS)],
            names=["d", "t", "spans"])


def places(docs: DataFrame, n: int = N, k: int = K, hot: int = HOT) -> DataFrame:
    """d, t, a, p of each recurring place: its document, its anchor and, in one number, its
    first byte, its count of windows, whether its anchor is hot, and whether it is known to
    occur earlier."""
    rows = docs.mapInArrow(_candidates(n, k), CANDIDATE)
    w = Window.partitionBy("a").orderBy("f", "d", "t", "sc")
    before = F.lag(F.struct("f", "d", "t", "sc")).over(w)
    rows = rows.select("*", before.alias("b"), F.lead("f").over(w).isNotNull().alias("more"))

    def count(sc):
        return F.col(sc).bitwiseAND(0xFFFF)

    known = F.col("sc") % 2 == 1
    equal = F.coalesce((F.col("b.f") == F.col("f")) & (count("b.sc") == count("sc")), F.lit(False))
    place = (F.col("d") == F.col("b.d")) & (F.col("t") == F.col("b.t")) & (F.col("sc") == F.col("b.sc"))
    rows = rows.where(known | F.col("more") | F.col("b").isNotNull())
    rows = rows.where(known | ~equal | ~place)  # a repeated row is the same place
    known = known | equal
    different = F.sum(F.when(known, 0).otherwise(1)).over(Window.partitionBy("a"))
    flags = F.when(known, 1).when(different > hot, 2).otherwise(0)
    start, size = F.shiftright("sc", 16), F.shiftright(count("sc"), 1)
    return rows.select(
        "d", "t", F.when(known, 0).otherwise(F.col("a")).alias("a"),
        F.shiftleft(start, 17).bitwiseOR(F.shiftleft(size, 2)).bitwiseOR(flags.cast("long")).alias("p"))


def recurring(docs: DataFrame, found: DataFrame, n: int = N, unique: bool = False) -> DataFrame:
    """a, d, t, sn (first byte and count of windows), body, spans: the fragments to compare,
    dealt and sorted by anchor; rows without a body carry spans that are known to occur earlier."""
    # where t is the same for all, Spark joins by d alone: places dealt by both would be dealt again
    key = ["d"] if unique else ["d", "t"]
    found = found.where(F.col("p").bitwiseAND(2) == 0).repartition(*key).groupBy("d", "t").agg(
        F.collect_list("a").alias("keys"), F.collect_list("p").alias("places"))
    cut = docs.join(found, ["d", "t"]).mapInArrow(_cut(n), FRAGMENT)
    return cut.repartition("a").sortWithinPartitions("a", "d", "t", "sn")


def hot_spans(docs: DataFrame, found: DataFrame, n: int = N) -> DataFrame:
    """d, t, spans of the windows of hot anchors that are not the first of their bytes."""
    found = found.where(F.col("p").bitwiseAND(2) == 2).groupBy("d", "t").agg(F.collect_list("p").alias("places"))

    def run(batches):
        for part in pieces(batches, limit=PIECE):
            data, off = utf8(part.column("text"))
            lists = part.column("places").to_pylist()
            at = [np.arange((p >> 2) & 0x7FFF) + off[i] + (p >> 17) for i, x in enumerate(lists) for p in x]
            row = np.repeat([i for i, x in enumerate(lists) for _ in x], [len(x) for x in at])
            at = np.concatenate(at)
            h = [grams(mix(_BYTE[data] + U(salt)), n)[at].view(np.int64) for salt in (1, 2)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[0]), pa.array(h[1]), pa.array(part.column("d").to_numpy()[row]),
                 pa.array(part.column("t").to_numpy()[row]), pa.array((at - off[row]).astype(np.int32))],
                names=["h1", "h2", "d", "t", "s"])

    windows = docs.join(found, ["d", "t"]).mapInArrow(run, "h1 long, h2 long, d long, t int, s int")
    place = F.struct("d", "t", "s")
    first = windows.groupBy("h1", "h2").agg(F.min(place).alias("f"), F.max(place).alias("l")).where("f <> l")
    later = windows.join(first, ["h1", "h2"]).where(place != F.col("f"))
    return later.select("d", "t", F.array(F.struct(F.col("s").alias("first"), F.lit(n).alias("n"))).alias("spans"))


def _report(texts: bool):
    def run(batches):
        for part in pieces(batches):
            data, off = utf8(part.column("text"))
            raw = data.tobytes()
            size, gone, spans, kept = [], [], [], []
            for i, found in enumerate(part.column("spans").to_pylist()):
                body = raw[off[i]:off[i + 1]]
                found = merged(found or [])
                ends = [0] + [x["first"] + x["n"] for x in found]
                starts = [x["first"] for x in found] + [len(body)]
                rest = b"".join(body[a:b] for a, b in zip(ends, starts))
                size.append(len(body)), gone.append(len(body) - len(rest)), spans.append(found)
                kept.append(rest if texts else hashlib.sha256(rest).hexdigest().encode())
            yield pa.RecordBatch.from_arrays(
                [part.column("d"), pa.array(size, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(kept, pa.binary()), pa.array(spans, _SPANS)],
                names=["d", "n_bytes", "n_removed", "kept", "spans"])

    return run


def dedup_bytes(documents: DataFrame, n: int = N, k: int = K, texts: bool = True,
                hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, ``kept`` (the bytes that are left; without
    ``texts`` their SHA-256 as ``kept_sha256``) and spans (removed runs: first byte, from 0,
    and length). One row per document row."""
    unique = unique_ids(documents)
    docs = keyed(documents, unique=unique)
    found = places(docs, n, k, hot)
    spans = recurring(docs, found, n, unique).mapInArrow(_scan(n, CHUNK), SPANS)
    spans = spans.unionByName(hot_spans(docs, found, n))
    spans = spans.groupBy("d", "t").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    rows = docs.join(spans, ["d", "t"], "left").mapInArrow(
        _report(texts), "d long, n_bytes long, n_removed long, kept binary, "
                        "spans array<struct<first:int,n:int>>")
    kept = F.col("kept") if texts else F.col("kept").cast("string").alias("kept_sha256")
    return rows.select(unkeyed(), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                       kept, "spans")


def maximal_repeats(documents: DataFrame, n: int = N, k: int = K) -> DataFrame:
    """The repeat groups themselves: ``length`` and ``occurrences`` (doc_id, start byte) of each
    interval whose occurrences have different bytes on their left. Fragments of equal
    content appear once, as the first of them, and windows of hot anchors not at all. Groups
    nest, so their sizes can add up to more than the input."""
    def run(batches):
        for rows, _ in _chunks(batches, CHUNK):
            if not rows:
                continue
            counts, nodes = np.array([r[3] & 0xFFFF for r in rows]), []
            at, frag, shared, left = suffixes([r[4] for r in rows], counts, n)
            begin = np.cumsum([0] + [len(r[4]) for r in rows])
            repeats(at, shared, left, n, nodes)
            for low, high, length in nodes:
                around = left[low:high + 1]
                if around[0] >= 0 and (around == around[0]).all():
                    continue  # part of a repeat that starts a byte earlier
                where = [(rows[f][1], (rows[f][3] >> 16) + int(p - begin[f]))
                         for f, p in zip(frag[low:high + 1].tolist(), at[low:high + 1].tolist())]
                yield pa.RecordBatch.from_pydict({
                    "length": pa.array([length], pa.int32()),
                    "occurrences": pa.array([[{"d": d, "start": s} for d, s in sorted(where)]],
                                            pa.list_(pa.struct([("d", pa.int64()), ("start", pa.int32())])))})

    docs = keyed(documents)
    return recurring(docs, places(docs, n, k), n).mapInArrow(
        run, "length int, occurrences array<struct<d:bigint,start:int>>")
