"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

A-Z are lower-cased and words are runs of a-z, 0-9 and non-ASCII characters. Every
benchmark item gives its windows of ``n`` words (an item of fewer, but not none, is
one window). Their hashes form one set; every document's token windows are looked up
in it, and each hit is verified by comparing the words themselves. A document word
inside an occurring window is hit.

The set is shipped with the plan while it has at most ``SET_LIMIT`` hashes (8 bytes
each: the bound of what is broadcast); a larger benchmark is joined by a shuffle on
the hash instead, over the same windows.

Defined results: a null or empty text has no words and no hits; a benchmark item with
null text has no window; items of equal text all count; repeated document rows are
judged each; an empty benchmark contaminates nothing. Extra columns are ignored by
``contamination`` and kept by ``decontaminate``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, keyed, replaced, unkeyed, with_key, without

N = 10
SET_LIMIT = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def item_words(text):
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NOT_WORD)
    return F.filter(parts, lambda x: x != "")


def benchmark_windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """item_id, n_words, gram (the words) and hash, one row per item and distinct window."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"),
                             item_words(F.col("text")).alias("w"))
    items = items.where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(n))
    items = items.select("item_id", "w", size.alias("n_words"))
    at = F.explode(F.sequence(F.lit(1), F.size("w") - F.col("n_words") + 1))
    grams = items.select("item_id", "w", "n_words", at.alias("i"))
    grams = grams.select("item_id", "n_words", F.slice("w", F.col("i"), F.col("n_words")).alias("gram"))
    return grams.select("*", F.xxhash64("gram").alias("hash")).distinct()


def _places(sizes: list[int], test_of):
    """Array of (i, n_words, seen): the windows of each size whose hash passes its test."""
    def of_size(k: int):
        last = F.size("w") - k + 1
        starts = F.when(last > 0, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(
            F.array().cast("array<int>"))
        test = test_of(k)
        window = lambda i: F.slice(F.col("w"), i, F.lit(k))
        found = F.filter(starts, lambda i: test(F.xxhash64(window(i))))
        return F.transform(found, lambda i: F.struct(
            i.alias("i"), F.lit(k).alias("n_words"), window(i).alias("seen")))

    return F.flatten(F.array(*[of_size(k) for k in sizes]))


def occurrences(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """``docs`` (d, t, w) -> d, t, i, n_words, item_id for each verified occurrence.

    The lengths of windows, ten at most, are read first; each is scanned by itself."""
    sizes = [r[0] for r in grams.select("n_words").distinct().collect()]
    # a bounded fetch: one row more than the limit tells whether the set fits
    found = grams.select("n_words", "hash").distinct().limit(SET_LIMIT + 1).collect()
    if not sizes:
        return docs.where(F.lit(False)).select(
            "d", "t", F.lit(0).alias("i"), F.lit(0).alias("n_words"), F.lit("").alias("item_id"))
    if len(found) > SET_LIMIT:
        places = _places(sizes, lambda k: lambda h: F.lit(True))
        windows = docs.select("d", "t", F.explode(places).alias("p")).select(
            "d", "t", "p.i", "p.n_words", F.xxhash64("p.seen").alias("hash"))
        hits = windows.join(grams.select("n_words", "hash").distinct(), ["n_words", "hash"], "left_semi")
        hits = hits.join(docs, ["d", "t"]).select(
            "d", "t", "i", "n_words", "hash", F.slice("w", F.col("i"), F.col("n_words")).alias("seen"))
        of_hash = grams
    else:
        sets = {k: [r[1] for r in found if r[0] == k] for k in sizes}
        places = _places(sizes, lambda k: lambda h: h.isin(sets[k]))
        hits = docs.select("d", "t", F.explode(places).alias("p")).select(
            "d", "t", "p.i", "p.n_words", "p.seen", F.xxhash64("p.seen").alias("hash"))
        of_hash = F.broadcast(grams)
    return (hits.join(of_hash, ["n_words", "hash"]).where(F.col("seen") == F.col("gram"))
            .select("d", "t", "i", "n_words", "item_id"))


def contamination(documents: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hit (array of hit
    places, from 1), one row per document row."""
    docs = keyed(documents).select("d", "t", item_words(F.col("text")).alias("w"))
    hits = occurrences(docs, benchmark_windows(benchmark, n))
    # repeated rows give each occurrence again: sets make that harmless
    found = hits.groupBy("d", "t").agg(
        F.collect_set(F.struct("i", "n_words")).alias("spans"),
        F.sort_array(F.collect_set("item_id")).alias("items"))
    hit = F.array_distinct(F.flatten(F.transform(
        "spans", lambda s: F.sequence(s["i"], s["i"] + s["n_words"] - 1))))
    found = found.select("d", "t", hit.alias("hit"), "items")
    sizes = docs.select("d", "t", F.size("w").cast("long").alias("n_words"))
    out = sizes.join(found, ["d", "t"], "left")
    none = F.array().cast("array<string>")
    return out.select(
        unkeyed(), "n_words",
        F.coalesce(F.size("hit"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.coalesce("items", none)), 256).alias("items_sha256"),
        F.col("hit").isNotNull().alias("contaminated"),
        F.coalesce("hit", F.array().cast("array<int>")).alias("hit"))


def decontaminate(documents: DataFrame, benchmark: DataFrame, n: int = N,
                  drop_share: float = 0.5) -> DataFrame:
    """``documents`` without what the benchmark has: a document goes if at least
    ``drop_share`` of its words are hit; else its hit words go, and with each what
    follows it up to the next word. Clean rows stay as they are."""
    rows, d, t = with_key(documents)
    keys = keyed(documents).select("d", "t", item_words(F.col("text")).alias("w"))
    hits = occurrences(keys, benchmark_windows(benchmark, n))
    h, p = free_name(rows, "_hit"), free_name(rows, "_pieces")
    hit = F.sort_array(F.array_distinct(F.flatten(F.collect_set(
        F.sequence("i", F.col("i") + F.col("n_words") - 1)))))
    found = hits.groupBy(F.col("d").alias(d), F.col("t").alias(t)).agg(hit.alias(h))
    out = rows.join(found, [d, t], "left")
    # words with what follows each; the head is what stands before any word
    out = out.withColumn(p, F.when(F.col(h).isNotNull(), F.regexp_extract_all(
        "text", F.lit(WORD_AND_REST), F.lit(0))))
    head = F.regexp_extract("text", r"\A" + BETWEEN, 0)
    new = F.when(F.col(h).isNull(), F.col("text")).otherwise(
        F.concat(head, F.array_join(without(p, h), "")))
    kept = out.where(F.col(h).isNull() | (F.size(h) < drop_share * F.size(p)))
    return replaced(kept, documents.columns, new)


BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
WORD_AND_REST = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+" + BETWEEN
