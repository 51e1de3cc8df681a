"""Near-duplicates by DartMinHash over weighted word shingles.

A document's elements are its runs of ``SHINGLE`` words (white space between them, else
unchanged), weighted by how often they occur. Every unit of an element's weight is a
region of its own; darts fall on it at the times of a Poisson process that depend on the
element alone, each on one of ``DARTS`` coordinates. The earliest dart on each coordinate
makes the signature, and two documents agree on a coordinate with the probability of
their weighted Jaccard similarity. Only darts earlier than a bound that shrinks with the
document's weight are thrown, so a signature costs time in proportion to the elements
plus ``DARTS log DARTS``; where a coordinate stays empty the bound is doubled.

Signatures are cut into ``BANDS`` bands. A pair of similarity 0.8 shares no band with
probability 3e-6. Documents of equal words form a class at once; only one document of a class
is banded. In a round every open member of a bucket meets the bucket's leads, those that share
most buckets with others: the original of a group comes before its edited copies. Pairs of
different labels that may be alike are compared exactly, over the whole texts, each pair
once, in the first band that it shares. A lead has then met the whole bucket and is closed
there; all others stay open, linked or not. A linked document's label is the one of highest
score among itself and those it is linked to, so documents of one label are of one component.
A bucket ends when its open members have one label, so any two documents that share a band are
in one component at the end, or were compared, or were shown to be unlike. A round has
``GROWTH`` times the leads of the one before, so rounds are few in buckets of many unlike
members too; large buckets are dealt in parts of ``PART`` members. The components of all links
come last, from large-star/small-star steps, each written to the shared checkpoint folder.

Two sketches show that a pair is unlike, within a task. One is a byte of each dart. The
other is an odd sketch: each unit of an element flips one of ``ODD_BITS`` bits, so the bits in
which two documents differ are at most as many as the units in which they differ, whatever the
hashes. That number bounds their similarity from above, so no alike pair is lost by it; for
texts up to a few thousand words it leaves few pairs that are not alike, and a group whose
members are alike at 0.65 to 0.75 costs no comparisons of texts.

Defined results: documents without a word are alike to none, not even to each other; a
text of fewer than ``SHINGLE`` words is one shingle. Rows that repeat ``doc_id`` and text
are one document: ``near_duplicates`` gives each its result, ``keep_one`` keeps one.
Extra columns are ignored, or kept by ``keep_one``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import NULL_ID, keyed, pieces, unkeyed, utf8, with_key
from .rolling import U, grams, mix, word_hashes, words

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 5
DARTS = BANDS * ROWS
PIECE = 1 << 19
#: Members of a bucket meet so many of them in the first round, and in each round so many
#: times those of the round before.
LEADS, GROWTH = 1, 64
#: So many members of a bucket meet its leads in one task, and so many pairs at a time.
PART, MEETINGS = 512, 1 << 15
ODD_BITS = 2048

SIGNATURE = ("d long, t int, c1 long, c2 long, bands array<long>, tags binary, sketch binary, "
             "size int, odd binary")
#: A pair whose sketches (a byte of each dart) agree on a smaller share is not compared: at
#: a similarity of 0.8 that is five standard deviations below what is expected.
SKETCH_SHARE = 0.64


def elements(column, k: int = SHINGLE):
    """(row, shingle hash) of each shingle, in order, and two hashes of each row's words."""
    data, off = utf8(column)
    starts, ends, first = words(data, off)
    h = word_hashes(data, starts, ends)
    count = np.diff(first)
    row = np.repeat(np.arange(len(count)), count)
    g = grams(h, k)
    inside = np.flatnonzero(row[:len(g)] == row[k - 1:]) if len(g) else np.zeros(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < k))
    place = np.arange(len(h)) - first[row]
    sums = []
    for salt in (U(0x2545F4914F6CDD1D), U(0xD1342543DE82EF95)):
        x = np.append(mix(h * salt + place.astype(np.uint64)), U(0))
        total = np.add.reduceat(x, np.minimum(first[:-1], len(h))) if len(count) else x[:0]
        sums.append(np.where(count > 0, mix(total + count.astype(np.uint64)), U(0)))
    return (np.concatenate([row[inside], short]), np.concatenate([g[inside], sums[0][short]]),
            count, sums[0], sums[1])


def weighted(row: np.ndarray, shingle: np.ndarray):
    """Distinct (row, shingle) with their counts."""
    order = np.lexsort((shingle, row))
    row, shingle = row[order], shingle[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (shingle[1:] != shingle[:-1])
    at = np.flatnonzero(new)
    return row[at], shingle[at], np.diff(np.append(at, len(row)))


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> U(11)).astype(np.float64) + 0.5) / 9007199254740992.0


def _thrown(region: np.ndarray, doc: np.ndarray, bound: np.ndarray, darts: int, block: int):
    """All darts on the regions before their documents' bounds: (slot, time, name). A region
    gets ``block`` darts at a time until one is late."""
    slots, times, names = [], [], []
    at, number = np.zeros(len(region)), 0
    while len(region):
        step = mix(np.arange(number, number + block, dtype=np.uint64) * U(0x632BE59BD9B4E019) + U(1))
        name = mix(region[:, None] + step)
        time = np.cumsum(-np.log(_uniform(name)), axis=1) + at[:, None]
        row, col = np.nonzero(time < bound[doc][:, None])
        name_in = name[row, col]
        slots.append(doc[row] * darts + (mix(name_in ^ U(0xA24BAED4963EE407)) % U(darts)).astype(np.int64))
        times.append(time[row, col])
        names.append(name_in)
        on = time[:, -1] < bound[doc]
        region, doc, at, number = region[on], doc[on], time[on, -1], number + block
    return slots, times, names


def units(row: np.ndarray, shingle: np.ndarray, count: np.ndarray):
    """The document and a hash of each unit of weight."""
    unit = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    region = mix(np.repeat(shingle, count) + unit.astype(np.uint64) * U(0x9E3779B97F4A7C15))
    return np.repeat(row, count), region


def odd_sketches(rows: int, row: np.ndarray, shingle: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A row of bytes for each of ``rows`` documents: the bits that an odd number of units hit."""
    doc, region = units(row, shingle, count)
    place = doc * ODD_BITS + (mix(region ^ U(0x8CB92BA72F3D8DD7)) % U(ODD_BITS)).astype(np.int64)
    place, hits = np.unique(place, return_counts=True)
    bits = np.zeros(rows * ODD_BITS, np.uint8)
    bits[place[hits % 2 == 1]] = 1
    return np.packbits(bits.reshape(rows, ODD_BITS), axis=1)


def dart_signatures(rows: int, row: np.ndarray, shingle: np.ndarray, count: np.ndarray,
                    darts: int = DARTS) -> np.ndarray:
    """A row of ``darts`` dart names for each of ``rows`` documents; 0 where it has none."""
    out = np.zeros(rows * darts, np.uint64)
    weight = np.bincount(row, weights=count, minlength=rows)
    doc, region = units(row, shingle, count)
    bound = darts * (np.log(darts) + 3) / np.maximum(weight, 1)
    todo = weight > 0
    while todo.any():
        parts = [[], [], []]
        # the more darts a region will get, the more are made at once
        for low, high, block in ((0, 2, 1), (2, 16, 4), (16, np.inf, 64)):
            now = (todo & (bound >= low) & (bound < high))[doc]
            for whole, some in zip(parts, _thrown(region[now], doc[now], bound, darts, block)):
                whole += some
        slot, time, name = map(np.concatenate, parts)
        order = np.argsort(time)[::-1]
        out[slot[order]] = name[order]  # the earliest is written last
        # documents with an empty coordinate are thrown again with twice the bound
        todo &= (out.reshape(rows, darts) == 0).any(1)
        bound[todo] *= 2
    return out.reshape(rows, darts)


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as a binary column."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(rows), [
        None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def _signed(batches):
    for part in pieces(batches, limit=PIECE):
        row, shingle, count, c1, c2 = elements(part.column("text"))
        bag = weighted(row, shingle)
        signature = dart_signatures(part.num_rows, *bag)
        bands = signature.reshape(part.num_rows, BANDS, ROWS)
        key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bands.shape[:2])
        for i in range(ROWS):
            key = mix(key * U(0x9E3779B97F4A7C15) + bands[:, :, i])
        some = count > 0
        size = np.bincount(bag[0], weights=bag[2], minlength=part.num_rows).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [part.column("d").filter(pa.array(some)), part.column("t").filter(pa.array(some)),
             pa.array(c1[some].view(np.int64)), pa.array(c2[some].view(np.int64)),
             pa.array(list(key[some].view(np.int64)), pa.list_(pa.int64())),
             _binary((key[some] & U(0xFFFF)).astype(np.uint16).view(np.uint8)),
             _binary((signature[some] & U(0xFF)).astype(np.uint8)),
             pa.array(size[some]), _binary(odd_sketches(part.num_rows, *bag)[some])],
            names=["d", "t", "c1", "c2", "bands", "tags", "sketch", "size", "odd"])


def similarity(a: str, b: str) -> float:
    """Weighted Jaccard similarity of two texts' shingles."""
    row, shingle, _, _, _ = elements(pa.array([a, b]))
    row, shingle, count = weighted(row, shingle)
    x, y = row == 0, row == 1
    total = int(count.sum())
    _, i, j = np.intersect1d(shingle[x], shingle[y], assume_unique=True, return_indices=True)
    both = int(np.minimum(count[x][i], count[y][j]).sum())
    return both / (total - both) if total > both else 0.0


def _compared(batches):
    for batch in batches:
        u, v = batch.column("u_text").to_pylist(), batch.column("v_text").to_pylist()
        near = np.array([similarity(a, b) >= SIMILARITY for a, b in zip(u, v)], bool)
        keep = pa.array(near)
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).filter(keep) for c in LINK], names=list(LINK))


NODE = "struct<d:bigint,t:int>"
#: The columns of pairs and links: two documents and their scores.
LINK = {"u": NODE, "v": NODE, "us": "long", "vs": "long"}
_LINK = ", ".join(f"{c} {kind}" for c, kind in LINK.items())


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (u, v) whose texts are similar enough."""
    left = texts.select(F.col("node").alias("u"), F.col("text").alias("u_text"))
    right = texts.select(F.col("node").alias("v"), F.col("text").alias("v_text"))
    rows = pairs.join(left, "u").join(right, "v")
    return rows.select(*LINK, "u_text", "v_text").mapInArrow(_compared, _LINK)


def labels(links: DataFrame) -> DataFrame:
    """node and root, the one of highest score among itself and those it is linked to."""
    ends = links.select("u", "us", "v", "vs").unionByName(
        links.select(F.col("v").alias("u"), F.col("vs").alias("us"), F.col("u").alias("v"), F.col("us").alias("vs")))
    best = ends.groupBy("u").agg(F.max(F.greatest(F.struct(F.col("vs").alias("score"), F.col("v").alias("root")),
                                                  F.struct(F.col("us").alias("score"), F.col("u").alias("root")))).alias("m"))
    return best.select(F.col("u").alias("node"), "m.root")


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node it is linked to, however far), for linked nodes."""
    edges = materialize(links.select(F.greatest("u", "v").alias("x"), F.least("u", "v").alias("y"))
                        .distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(low, "x").where("y > x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        large = materialize(large.unionByName(low.where("m < x").select("x", F.col("m").alias("y")))
                            .where("x > y").distinct(), "large")
        low = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(low, "x").where("y > m").select(F.col("y").alias("x"), F.col("m").alias("y"))
        edges = materialize(small.unionByName(low.select("x", F.col("m").alias("y"))).distinct(), "small")
        # done when every node points to one root that points nowhere
        ends = edges.select(F.col("x").alias("v"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
            edges.select(F.col("y").alias("v"), F.lit(0).alias("out"), F.lit(1).alias("into")))
        ends = ends.groupBy("v").agg(F.sum("out").alias("out"), F.sum("into").alias("into"))
        if ends.where("out > 1 or (out = 1 and into > 0)").isEmpty():
            return edges.select(F.col("x").alias("node"), F.col("y").alias("root"))


def clusters(documents: DataFrame):
    """(membership, links): d, t, rep (the smallest document of equal words), root (the
    smallest document of its component) of every document with a word; and the verified
    links u, v between documents of different words."""
    spark, docs = documents.sparkSession, keyed(documents)
    signed = materialize(docs.mapInArrow(_signed, SIGNATURE), "signed")
    node = F.struct("d", "t")
    # aggregates are written before their joins, so that Spark can split a join with a class or
    # a bucket that holds a third of all rows
    reps = materialize(signed.groupBy("c1", "c2").agg(F.min(node).alias("rep")), "reps")
    member = materialize(signed.select("d", "t", "c1", "c2").distinct().join(reps, ["c1", "c2"])
                         .select("d", "t", "rep"), "member")
    heads = member.where(node == F.col("rep")).select("d", "t")
    # only keys are shuffled until it is known which documents meet another at all
    banded = materialize(
        signed.select("d", "t", "bands").join(heads, ["d", "t"], "left_semi").dropDuplicates(["d", "t"])
        .select(node.alias("v"), F.posexplode("bands").alias("band", "b")), "banded")
    shared = materialize(banded.groupBy("b").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    buckets = materialize(banded.join(shared, "b"), "buckets")
    score = materialize(buckets.groupBy("v").agg(F.sum("n").alias("score")), "score")
    met = score.select("v.*")
    sketches = materialize(
        signed.select("d", "t", "tags", "sketch", "size", "odd").join(met, ["d", "t"], "left_semi")
        .dropDuplicates(["d", "t"]).select(node.alias("v"), "tags", "sketch", "size", "odd"), "sketches")
    texts = materialize(docs.join(met, ["d", "t"], "left_semi").groupBy(node.alias("node"))
                        .agg(F.min("text").alias("text")), "texts")
    links = spark.createDataFrame([], _LINK)
    rest, count = buckets.join(score, "v").withColumn("root", F.col("v")), LEADS
    while not rest.isEmpty():
        lead = materialize(_leads(rest, count), "leads")
        pairs = materialize(meetings(rest, lead, sketches), "pairs")
        new = materialize(verified(pairs, texts), "links")
        links, count = links.unionByName(new), count * GROWTH
        label = labels(links)
        # the leads have met all that was open in this bucket; nothing else is done
        now = rest.drop("root", "n").join(lead.select("b", "v"), ["b", "v"], "left_anti")
        now = materialize(now.join(label, now.v == label.node, "left").select(
            "b", "band", "v", "score", F.coalesce("root", "v").alias("root")), "open")
        many = materialize(now.groupBy("b").agg(
            F.count(F.lit(1)).alias("n"), F.min("root").alias("m"), F.max("root").alias("k"))
            .where("m != k").select("b", "n"), "many")
        rest = materialize(now.join(many, "b"), "rest")
    roots = components(links)
    out = member.join(roots, member.rep == roots.node, "left")
    return out.select("d", "t", "rep", F.coalesce("root", "rep").alias("root")), links.select("u", "v")


def _leads(rest: DataFrame, count: int) -> DataFrame:
    """The ``count`` rows of each bucket with the highest score. Ties have one order in all
    buckets, so members of one group meet the same leads in many."""
    order = Window.partitionBy("b").orderBy(F.desc("score"), F.xxhash64("v"), "v")
    return rest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count).drop("rank")


def meetings(rest: DataFrame, lead: DataFrame, sketches: DataFrame) -> DataFrame:
    """u, v: leads and members of one bucket and different labels that may be alike, in the
    first band that they share; so each pair comes once in all rounds."""
    parts = F.ceil(F.col("n") / PART)
    columns = ["b", "band", "v", "root", "score"]
    members = rest.select(*columns, F.pmod(F.xxhash64("v"), parts).cast("int").alias("part"), F.lit(1).alias("own"))
    leads = lead.select(*columns, F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))).alias("part"),
                        F.lit(0).alias("own"))
    rows = members.unionByName(leads).join(sketches, "v").select(
        "b", "part", "own", "band", F.col("v.d").alias("d"), F.col("v.t").alias("t"), F.col("root.d").alias("rd"),
        F.col("root.t").alias("rt"), "score", "tags", "sketch", "size", "odd")
    rows = rows.repartition("b", "part").sortWithinPartitions("b", "part", "own")
    return rows.mapInArrow(_meetings, "ud long, ut int, us long, vd long, vt int, vs long").select(
        F.struct(F.col("ud").alias("d"), F.col("ut").alias("t")).alias("u"),
        F.struct(F.col("vd").alias("d"), F.col("vt").alias("t")).alias("v"), "us", "vs")


def _meetings(batches):
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        b, part = (rows.column(c).to_numpy() for c in ("b", "part"))
        # the last group may go on in the next batch
        ends = np.flatnonzero((b[1:] != b[:-1]) | (part[1:] != part[:-1])) + 1
        end = int(ends[-1]) if len(ends) else 0
        if end:
            yield from _met(rows.slice(0, end), np.append(0, ends))
        held = rows.slice(end)
    if held is not None and held.num_rows:
        yield from _met(held, np.array([0, held.num_rows]))


def _met(rows: pa.Table, edges: np.ndarray):
    """Pairs of each group's leads, which come first, with its members."""
    own, band, d, t, rd, rt, score, size_of = (
        rows.column(c).to_numpy() for c in ("own", "band", "d", "t", "rd", "rt", "score", "size"))
    size_of = size_of.astype(np.int64)
    sketch, odd, tags = (utf8(rows.column(c))[0].reshape(rows.num_rows, -1) for c in ("sketch", "odd", "tags"))
    odd, tags = odd.view(np.uint64), tags.view(np.uint16)
    first, size = edges[:-1], np.diff(edges)
    members = np.add.reduceat(own, first).astype(np.int64)
    leads = size - members
    until = np.cumsum(leads * members)
    for low in range(0, int(until[-1]), MEETINGS):
        k = np.arange(low, min(low + MEETINGS, int(until[-1])))
        g = np.searchsorted(until, k, "right")
        k -= until[g] - leads[g] * members[g]
        i, j = first[g] + k // members[g], first[g] + leads[g] + k % members[g]
        apart = (rd[i] != rd[j]) | (rt[i] != rt[j])
        i, j = i[apart], j[apart]
        # the units in which two differ are these at least
        differ = np.bitwise_count(odd[i] ^ odd[j]).sum(1, dtype=np.int64)
        both = size_of[i] + size_of[j]
        near = both - differ >= SIMILARITY * (both + differ) - 1e-6
        i, j = i[near], j[near]
        same = sketch[i] == sketch[j]
        shared = same.reshape(-1, BANDS, ROWS).all(2) & (tags[i] == tags[j])
        near = (same.sum(1) >= SKETCH_SHARE * DARTS) & (shared.argmax(1) == band[i])
        i, j = i[near], j[near]
        swap = (d[i] > d[j]) | ((d[i] == d[j]) & (t[i] > t[j]))
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        if len(i):
            yield pa.RecordBatch.from_arrays([pa.array(x[k]) for k in (i, j) for x in (d, t, score)],
                                             names=["ud", "ut", "us", "vd", "vt", "vs"])


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest doc_id of equal words), cluster_id (smallest of the
    component) and kept, for every row."""
    member, _ = clusters(documents)
    rows = keyed(documents).drop("text").join(member, ["d", "t"], "left")
    own = F.struct("d", "t")

    def id_of(column):
        return F.when(F.col(column).isNull(), unkeyed()).otherwise(unkeyed(f"{column}.d"))

    return rows.select(unkeyed(), id_of("rep").alias("class_id"), id_of("root").alias("cluster_id"),
                       F.coalesce(F.col("root") == own, F.lit(True)).alias("kept"))


def keep_one(documents: DataFrame) -> DataFrame:
    """``documents`` with one document of each component: the one with the smallest id. A
    document in no component stays; of rows that repeat one document, one stays."""
    member, _ = clusters(documents)
    rows, d, t = with_key(documents)
    gone = member.where(F.struct("d", "t") != F.col("root")).select(
        F.col("d").alias(d), F.col("t").alias(t))
    return rows.join(gone, [d, t], "left_anti").dropDuplicates([d, t]).select(*documents.columns)
