"""Text operators over documents: sentence split (F22), quote verification
tables (O7 on a quote table) and passage containment (F25 "contained").

Passage containment is an exact substring search of every passage in every
document: an equi-join on hashed anchors, then a full comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import py_strip
from ..functions.quotes import stands


def sentences(text: Column) -> Column:
    """F22 fallback tokenizer: split on '.', strip, drop empties."""
    return F.filter(F.transform(F.split(text, "\\."), py_strip), lambda s: s != "")


def sentence_stats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    s = sentences(F.col(text))
    return docs.select(
        key,
        F.size(s).alias("n_sentences"),
        F.aggregate(s, F.lit(0).cast("long"), lambda acc, x: acc + F.length(x)).alias("chars"),
    )


def verify_table(quotes: DataFrame, quote: str = "sentence", abstract: str = "abstract") -> DataFrame:
    """O7 on a table of (…, quote, abstract): adds ``verified`` (boolean)."""
    return stands(quotes, quote, abstract, "verified")


ANCHOR_WORDS = 3
SHORT_CHARS = 8
_BETWEEN = "[^\\p{L}\\p{N}]+"


def _runs(items: Column, k: int) -> Column:
    """Hashes of all runs of ``k`` elements, each once."""
    last = F.size(items) - k + 1
    starts = F.when(last > 0, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(
        F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.xxhash64(F.lit(k), F.slice(items, i, F.lit(k)))))


def _char_runs(text: Column, k: int) -> Column:
    last = F.length(text) - k + 1
    starts = F.when(last > 0, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(
        F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.xxhash64(F.lit(-k), F.substring(text, i, F.lit(k)))))


def passages_in_documents(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """(item_id, doc_id) for every passage contained verbatim in a document.

    Words inside a passage (all but its first and last, which may be cut) are whole words
    of any document that contains it. The first ``ANCHOR_WORDS`` of them, hashed, are the
    passage's anchor, and documents meet passages in an equi-join on the anchor; a passage
    with fewer inner words has a shorter anchor, one with none its first ``SHORT_CHARS``
    characters. Candidates are then compared in full. The plan is the same at any size:
    which side of a join is small is for the planner to find out."""
    p = passages.select("item_id", F.col("text").alias("ptext")).where("ptext is not null and ptext <> ''")
    words = F.split("ptext", _BETWEEN, -1)
    inner = F.slice(words, F.lit(2), F.greatest(F.size(words) - 2, F.lit(0)))
    p = p.withColumn("inner", inner).withColumn("k", F.least(F.size("inner"), F.lit(ANCHOR_WORDS)))
    p = p.withColumn("k", F.when(F.col("k") > 0, F.col("k")).otherwise(
        -F.least(F.length("ptext"), F.lit(SHORT_CHARS))))
    p = p.select("item_id", "ptext", "k", F.when(
        F.col("k") > 0, F.xxhash64("k", F.slice("inner", F.lit(1), F.greatest("k", F.lit(0))))).otherwise(
        F.xxhash64("k", F.substring("ptext", F.lit(1), -F.col("k")))).alias("h"))
    # the kinds of anchor in use: at most ANCHOR_WORDS + SHORT_CHARS numbers
    kinds = [r[0] for r in p.select("k").distinct().collect()]
    d = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    split = d.select("doc_id", "text", F.split("text", _BETWEEN, -1).alias("words"))
    none = F.array().cast("array<bigint>")
    found = F.concat(none, *[_runs(F.col("words"), k) if k > 0 else _char_runs(F.col("text"), -k) for k in kinds])
    meet = split.select("doc_id", F.explode(found).alias("h")).join(p.select("item_id", "h"), "h")
    pairs = meet.select("doc_id", "item_id").distinct()
    whole = pairs.join(p.select("item_id", "ptext"), "item_id").join(d, "doc_id")
    return whole.where(F.contains("text", "ptext")).select("item_id", "doc_id")
