"""Fill-in-middle by a piece table.

A document is a list of descriptors (buffer, start, end) over buffers that never change:
its text, and one that holds the three sentinels. A cut splits the descriptor it falls
into, an arrangement permutes the parts and puts sentinel descriptors between them, the
inverse permutation restores the text, and hashes read descriptor after descriptor. Bytes
are joined once, for the output itself.

A text is cut between its units: runs of ASCII letters, and every other code point by
itself. Where it is cut, whether it stays plain and which form it takes comes from the
SHA-256 of ``seed:doc_id``, so a lost task gives the same rows when it runs again. Every
row is worked on alone, where it lies: nothing is shuffled, and a task holds about one
MiB of text at a time, or one longer document.

Defined results: a null text counts as empty; an empty text, or one that holds a sentinel,
is plain; a null ``doc_id`` is hashed as ``seed:``. Rows that repeat both give equal rows.
Columns of the input that are called like a result column are replaced by it.
"""

from __future__ import annotations

import hashlib
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, pieces, utf8

SENTINELS = ("<P>", "<S>", "<M>")
PREFIX, SUFFIX, MIDDLE = range(3)
#: The parts of each form in their order; each follows its sentinel.
FORMS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
#: Of 100: documents that are cut at all, and of those the share in suffix-first form.
CUT, SUFFIX_FIRST = 90, 20
SEED = 1
_RESULTS = "n long, form string, prefix_chars long, middle_chars long"


class Piece(NamedTuple):
    """A run of bytes of one of the buffers."""

    buffer: int
    start: int
    end: int


def cut(table: list[Piece], at: int) -> tuple[list[Piece], list[Piece]]:
    """The pieces before and after byte ``at``; a piece across it becomes two."""
    left, right = [], []
    for p in table:
        inside = min(max(at, 0), p.end - p.start)
        if inside:
            left.append(p._replace(end=p.start + inside))
        if inside < p.end - p.start:
            right.append(p._replace(start=p.start + inside))
        at -= p.end - p.start
    return left, right


def arrange(parts: dict[int, list[Piece]], form: str, marks: list[Piece]) -> list[Piece]:
    return [p for part in FORMS[form] for p in (marks[part], *parts[part])]


def restored(output, form: str, sentinels) -> list[Piece]:
    """Pieces over ``output``, in the order of the text it was made from. Text that is cut
    holds no sentinel, so the first of each one is the one that was put there."""
    if form not in FORMS:
        return [Piece(0, 0, len(output))]
    order = FORMS[form]
    ends, at = [], 0
    for part in order:
        found = re.compile(re.escape(sentinels[part])).search(output, at)
        if found is None:
            raise ValueError(f"no {sentinels[part]!r} in an output of form {form}")
        ends.append(found.span())
        at = found.end()
    stops = [start for start, _ in ends[1:]] + [len(output)]
    held = {part: Piece(0, end, stop) for part, (_, end), stop in zip(order, ends, stops)}
    return [held[PREFIX], held[MIDDLE], held[SUFFIX]]


def joined(table: list[Piece], buffers) -> bytes:
    return b"".join([buffers[b][s:e] for b, s, e in table])


def digest(table: list[Piece], buffers) -> str:
    h = hashlib.sha256()
    for b, s, e in table:
        h.update(buffers[b][s:e])
    return h.hexdigest()


def units(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte places where units start, the number of the first unit of each row (and of the
    end), and the number of code points before each byte."""
    low = data | 0x20
    letter = (low >= 97) & (low <= 122)
    first = (data & 0xC0) != 0x80  # not a continuation byte
    starts = first.copy()
    starts[1:] &= ~(letter[1:] & letter[:-1])
    heads = off[:-1][np.diff(off) > 0]
    starts[heads] = True
    places = np.flatnonzero(starts)
    return places, np.searchsorted(places, off), np.concatenate([[0], np.cumsum(first)])


def numbers(seed: int, doc_id) -> list[int]:
    """The first four groups of eight hex digits of the hash of a document's name."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[i:i + 8], 16) for i in (0, 8, 16, 24)]


def _documents(part, text: str, doc_id: str, seed: int, cut_share: int, suffix_first: int, sentinels):
    """Per row: units, form, code points of prefix and middle, the table and its buffers."""
    data, off = utf8(part.column(text))
    places, unit, points = units(data, off)
    raw = memoryview(data)
    marks_text = b"".join(sentinels)
    ends = np.cumsum([0, *map(len, sentinels)]).tolist()
    marks = [Piece(1, a, b) for a, b in zip(ends, ends[1:])]
    buffers = (raw, memoryview(marks_text))
    any_mark = re.compile(b"|".join(map(re.escape, sentinels)))
    ids = part.column(doc_id).to_pylist()
    for i, (start, end) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
        n = int(unit[i + 1] - unit[i])
        table = [Piece(0, start, end)] if end > start else []
        h1, h2, h3, h4 = numbers(seed, ids[i])
        if not n or h3 % 100 >= cut_share or any_mark.search(raw[start:end]):
            yield n, "plain", None, None, table, buffers
            continue
        form = "spm" if h4 % 100 < suffix_first else "psm"
        at = [end if k == n else int(places[unit[i] + k]) for k in sorted((h1 % (n + 1), h2 % (n + 1)))]
        prefix, rest = cut(table, at[0] - start)
        middle, suffix = cut(rest, at[1] - at[0])
        table = arrange({PREFIX: prefix, MIDDLE: middle, SUFFIX: suffix}, form, marks)
        yield n, form, int(points[at[0]] - points[start]), int(points[at[1]] - points[at[0]]), table, buffers


def _encoded(sentinels) -> tuple[bytes, ...]:
    """A sentinel that ends as it begins could also be found across the end of a text."""
    marks = tuple(s.encode() for s in sentinels)
    if len(set(marks)) < 3 or any(not m or any(m.startswith(m[k:]) for k in range(1, len(m))) for m in marks):
        raise ValueError("sentinels must differ, and none may be empty or end as it begins")
    return marks


def _columns(docs: DataFrame, results: list[str], text: str) -> list[str]:
    taken = {r.lower() for r in results}
    return [c for c in docs.columns if c.lower() not in taken and c != text]


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED,
                   cut_share: int = CUT, suffix_first: int = SUFFIX_FIRST,
                   sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """``docs`` without the text, with ``n`` (units), ``form``, ``prefix_chars`` and
    ``middle_chars`` (null if plain) and ``output``. ``restore`` gives the text back."""
    marks = _encoded(sentinels)
    kept = _columns(docs, ["n", "form", "prefix_chars", "middle_chars", "output"], text)
    given = free_name(docs.select(*kept), "_text")
    name = free_name(docs.select(*kept, F.lit(0).alias(given)), "_name")
    rows = docs.select(*kept, F.col(f"`{text}`").alias(given), F.col(f"`{doc_id}`").alias(name))

    def run(batches):
        for part in pieces(batches, given):
            got = [(n, form, a, b, joined(table, buffers).decode("utf-8", "replace")) for n, form, a, b, table, buffers
                   in _documents(part, given, name, seed, cut_share, suffix_first, marks)]
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in kept]
                + [pa.array(list(col), kind) for col, kind in zip(
                    zip(*got), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()))],
                names=[*kept, "n", "form", "prefix_chars", "middle_chars", "output"])

    schema = rows.select(*kept).schema
    for field in (*_RESULTS.split(", "), "output string"):
        schema = schema.add(*field.split())
    return rows.mapInArrow(run, schema)


def restore(cut_docs: DataFrame, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """``cut_docs`` with ``text``, made from ``output`` and ``form`` alone."""
    marks = _encoded(sentinels)
    kept = _columns(cut_docs, ["text"], "text")
    schema = cut_docs.select(*kept).schema.add("text", "string")

    def run(batches):
        for part in pieces(batches, "output"):
            data, off = utf8(part.column("output"))
            views = [memoryview(data)[a:b] for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            texts = [joined(restored(v, form, marks), (v,)).decode("utf-8", "replace")
                     for v, form in zip(views, part.column("form").to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + [pa.array(texts, pa.string())],
                                             names=[*kept, "text"])

    return cut_docs.select(*kept).mapInArrow(run, schema)


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the hashes of the output and of the
    text restored from it; texts never leave the task."""
    marks = _encoded(SENTINELS)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]

    def run(batches):
        for part in pieces(batches):
            got = []
            for n, form, a, b, table, buffers in _documents(part, "text", "doc_id", seed, CUT, SUFFIX_FIRST, marks):
                output = joined(table, buffers)
                got.append((n, form, a, b, digest(table, buffers), digest(restored(output, form, marks), (output,))))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id")] + [pa.array(list(col), kind) for col, kind in zip(zip(*got), kinds)],
                names=names)

    return rows.mapInArrow(run, f"doc_id long, {_RESULTS}, output_sha256 string, restored_sha256 string")
