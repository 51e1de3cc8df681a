"""Small helpers shared by the corpus operators.

A *document* is a pair of ``doc_id`` and ``text``. Rows that repeat both are one
document: each of them gets that document's result, and none counts as a copy of
the other. A null ``doc_id`` sorts before every number; a null text counts as
empty unless an operator says otherwise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that a task works on at a time; a longer document is one piece.
PIECE_BYTES = 1 << 20
NULL_ID = -(1 << 63)


def unique_ids(docs: DataFrame, id_col: str = "doc_id") -> bool:
    """Whether no two rows share an id; counts ids, reads no texts."""
    return docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unique: bool = False) -> DataFrame:
    """``d`` long and ``t`` int name a document, never null; ``text`` is its text or ''.

    ``t`` hashes the text, so rows that share an id but not a text stay apart; where ids are
    known to be ``unique`` it is 0, which is cheaper to shuffle. Only these three columns
    are kept, so no other column can clash."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("d"),
        F.lit(0).alias("t") if unique else F.hash(F.col(text_col), F.col(id_col).isNull()).alias("t"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def with_key(df: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """``df`` with the two key columns of ``keyed`` beside its own, and their names."""
    d, t = free_name(df, "_d"), free_name(df, "_t")
    return df.withColumns({
        d: F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)),
        t: F.hash(F.col(text_col), F.col(id_col).isNull())}), d, t


def replaced(df: DataFrame, columns: list[str], text) -> DataFrame:
    """``columns`` of ``df`` in their order, with ``text`` for the column of that name."""
    return df.select(*[text.alias(c) if c == "text" else F.col(c) for c in columns])


def without(items: str, places: str):
    """The array column ``items`` less the elements at ``places``, a sorted array column of
    distinct numbers from 1. Linear: it joins the slices between them."""
    def before(k):
        return F.when(k > 0, F.element_at(F.col(places), F.greatest(k, F.lit(1)))).otherwise(0)

    slices = F.transform(F.col(places), lambda x, k: F.slice(
        F.col(items), before(k) + 1, x - before(k) - 1))
    last = F.coalesce(F.element_at(F.col(places), -1), F.lit(0))
    rest = F.slice(F.col(items), last + 1, F.greatest(F.size(items) - last, F.lit(0)))
    return F.concat(F.flatten(slices), rest)


def unkeyed(column: str = "d"):
    """The ``doc_id`` that ``keyed`` has hidden."""
    return F.when(F.col(column) != NULL_ID, F.col(column)).alias("doc_id")


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or it with underscores until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary Arrow column and each row's offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)
    off = off[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def pieces(batches, text: str = "text", limit: int = PIECE_BYTES, rows: int = 1 << 14):
    """Slices of Arrow batches with at most ``limit`` bytes of text, one row at least and
    ``rows`` at most."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        _, off = utf8(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < n:
            end = int(np.searchsorted(off, off[at] + limit, "right")) - 1
            end = min(max(end, at + 1), at + rows, n)
            yield batch.slice(at, end - at)
            at = end
