"""Line dedup by content-defined chunks of lines.

Each line is hashed (the first 32 bits of its MD5). A rolling hash over ``window``
line hashes marks a boundary after a line where it is 0 modulo ``modulus``, so an
inserted or removed line moves only the boundaries near it. A chunk is the run of
lines up to a boundary. A chunk of two lines or more that also occurs earlier
(smaller ``doc_id``, or earlier in the document) is removed, once its bytes have been
compared with those of the first occurrence.

Only hashes are shuffled to find repeats; texts travel for repeated chunks alone. A
chunk that stands in a third of all documents is counted before the shuffle (partial
aggregation), and its join with the first occurrence is one that Spark can split.

Defined results: a null text has no lines and stays null; an empty text is one empty
line; a single-line chunk is never removed; a document whose lines all go keeps an
empty text, for this operator removes lines and never documents. Rows that repeat
``doc_id`` and text are one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import free_name, keyed, replaced, with_key, without

WINDOW = 3
MODULUS = 4
_P = 1_000_003


def line_hash(line):
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def chunk_ends(hashes, window: int = WINDOW, modulus: int = MODULUS):
    """Numbers (from 1) of the lines after which a chunk ends; always the last."""
    n = F.size(hashes)

    def rolled(i):
        total = F.lit(0).cast("long")
        for back in range(window):
            weight = pow(_P, back + 1, 1 << 31)
            # a line before the first counts as 0
            term = F.when(i > back, F.element_at(hashes, F.greatest(i - back, F.lit(1))))
            total = total + (F.coalesce(term, F.lit(0)) * F.lit(weight)) % F.lit((1 << 31) - 1)
        return total % F.lit((1 << 31) - 1) % F.lit(modulus)

    return F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | (rolled(i) == 0))


def chunks(docs: DataFrame, window: int = WINDOW, modulus: int = MODULUS) -> DataFrame:
    """``docs`` (d, t, text) -> d, t, c (number of the chunk), first (its first line, from
    1), n_lines and chunk (its text)."""
    lines = docs.select("d", "t", F.split("text", "\n", -1).alias("lines"))
    hashed = lines.select("d", "t", "lines", F.transform("lines", line_hash).alias("h"))
    ended = hashed.select("d", "t", "lines", chunk_ends(F.col("h"), window, modulus).alias("ends"))
    spans = F.transform("ends", lambda e, i: F.struct(
        F.when(i == 0, 1).otherwise(F.element_at("ends", F.greatest(i, F.lit(1))) + 1).alias("first"),
        e.alias("last")))
    out = ended.select("d", "t", "lines", F.posexplode(spans).alias("c", "s"))
    size = F.col("s.last") - F.col("s.first") + 1
    return out.select("d", "t", "c", F.col("s.first").alias("first"), size.alias("n_lines"),
                      F.array_join(F.slice("lines", F.col("s.first"), size), "\n").alias("chunk"))


def repeated_chunks(docs: DataFrame, window: int = WINDOW, modulus: int = MODULUS) -> DataFrame:
    """d, t, first, n_lines of each chunk to remove."""
    many = chunks(docs, window, modulus).where("n_lines > 1").select(
        F.struct("d", "t", "c").alias("at"), "first", "n_lines",
        F.xxhash64("chunk").alias("h1"), F.xxhash64(F.lit(1), "chunk").alias("h2"))
    firsts = many.groupBy("h1", "h2").agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"))
    # written, so that nothing stands between shuffle and join and Spark can split a hot chunk
    firsts = materialize(firsts.where(F.col("first_at") != F.col("last_at")).select("h1", "h2", "first_at"),
                         "firsts")
    found = materialize(many.join(firsts, ["h1", "h2"]).select(
        "at.d", "at.t", "first", "n_lines", "h1", "h2", (F.col("at") != F.col("first_at")).alias("later")),
        "chunks")
    # only now texts: of the chunks that recur, and of their first occurrences
    # (a repeated row repeats its chunks: the removed lines are a set in the end)
    model = _with_text(docs, found.where(~F.col("later"))).select("h1", "h2", F.col("chunk").alias("model"))
    same = _with_text(docs, found.where("later")).join(model, ["h1", "h2"])
    return same.where(F.col("chunk") == F.col("model")).select("d", "t", "first", "n_lines")


def _with_text(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The found chunks with their text; each document is split once for all of its own."""
    own = found.groupBy("d", "t").agg(
        F.collect_set(F.struct("first", "n_lines", "h1", "h2")).alias("own"))
    rows = docs.join(own, ["d", "t"]).select("d", "t", F.split("text", "\n", -1).alias("lines"), "own")
    cut = F.transform("own", lambda x: F.struct(
        x["first"].alias("first"), x["n_lines"].alias("n_lines"), x["h1"].alias("h1"), x["h2"].alias("h2"),
        F.array_join(F.slice("lines", x["first"], x["n_lines"]), "\n").alias("chunk")))
    return rows.select("d", "t", F.explode(cut).alias("x")).select("d", "t", "x.*")


def _cut(documents: DataFrame, window: int, modulus: int):
    """``documents`` with the sorted numbers of its removed lines, its lines, and the text
    that is left; the names of the first two."""
    texts = keyed(documents.where(F.col("text").isNotNull()))
    rows, d, t = with_key(documents)
    g, lines = free_name(rows, "_gone"), free_name(rows, "_lines")
    gone = F.sort_array(F.flatten(F.collect_set(
        F.sequence(F.col("first"), F.col("first") + F.col("n_lines") - 1))))
    removed = repeated_chunks(texts, window, modulus).groupBy(
        F.col("d").alias(d), F.col("t").alias(t)).agg(gone.alias(g))
    rows = rows.join(removed, [d, t], "left").withColumn(lines, F.split("text", "\n", -1))
    left = F.when(F.col(g).isNull(), F.col("text")).otherwise(F.array_join(without(lines, g), "\n"))
    return rows, g, lines, left


def line_report(documents: DataFrame, window: int = WINDOW, modulus: int = MODULUS) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256, one row per document row."""
    rows, gone, lines, left = _cut(documents, window, modulus)
    return rows.select(
        "doc_id",
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_removed"),
        F.sha2(left, 256).alias("kept_sha256"))


def dedup_lines(documents: DataFrame, window: int = WINDOW, modulus: int = MODULUS) -> DataFrame:
    """``documents`` with repeated chunks cut from their texts."""
    rows, _, _, left = _cut(documents, window, modulus)
    return replaced(rows, documents.columns, left)
