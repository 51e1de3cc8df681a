"""Token ids packed into rows of equal length, for training.

Each task encodes its texts with a public tokenizer, splits documents longer than a row
into pieces (none is lost), sorts the pieces of a block by decreasing length and puts
each into the open row with the least room that still holds it. A segment tree over the
possible amounts of room finds that row in ``log2(row length)`` steps. A block is
``BLOCK_ROWS`` rows of tokens or what is left of the partition, so memory is bounded
and no shuffle is needed; at most the last rows of a block are partly empty.

Each result row has ``ids`` (little-endian int32, the row padded to its full length with
``PAD``), ``cu_seqlens`` (0 and the end of each segment), ``positions`` (as ids; restarts at
0 with each segment; padding counts on from 0) and, per segment, ``doc_ids``, ``offsets``
(its first token's place in its document). ``unpack`` gives the documents' ids back.

Defined results: null and empty texts have no tokens and are in no row; repeated rows and
equal ids are packed each; a null ``doc_id`` stays null; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces

LENGTH = 2048
BLOCK_ROWS = 1024
PAD = 50256
#: Texts longer than this are split by the pattern here, as the library's matcher can
#: run out of stack on very long runs.
LONG_TEXT = 200_000
SCHEMA = ("shard int, block int, row int, n_tokens int, ids binary, cu_seqlens array<int>, "
          "positions binary, doc_ids array<long>, offsets array<int>")


class Room:
    """Open rows by the room they have left; a segment tree finds the tightest fit."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(row, its room) of the open row with the least room of ``need`` or more."""
        node = need + self.leaves
        if not self.count[node]:
            # up until a right sibling has rows, then down to its leftmost
            while node > 1 and (node & 1 or not self.count[node ^ 1]):
                node >>= 1
            if node <= 1:
                return None
            node ^= 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        row = self.rows[room].pop()
        self._change(room, -1)
        return row, room


def best_fit(sizes, length: int) -> list[list[int]]:
    """Item numbers by row, best-fit decreasing; ties keep the order given."""
    room, rows = Room(length), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = room.take(sizes[i])
        if found is None:
            rows.append([])
            found = len(rows) - 1, length
        rows[found[0]].append(i)
        if found[1] > sizes[i]:
            room.add(found[1] - sizes[i], found[0])
    return rows


class Tokens:
    def __init__(self, ranks_file: bytes, pattern: str):
        import regex
        import tiktoken

        lines = (x.split() for x in ranks_file.splitlines() if x.strip())
        self.coder = tiktoken.Encoding("own", pat_str=pattern, special_tokens={}, mergeable_ranks={
            base64.b64decode(a): int(b) for a, b in lines})
        self.split = regex.compile(pattern).findall

    def __call__(self, text: str) -> np.ndarray:
        if len(text) <= LONG_TEXT:
            return np.array(self.coder.encode_ordinary(text), np.int32)
        one = self.coder._encode_single_piece
        return np.array([i for w in self.split(text) for i in one(w)], np.int32)


def packed_block(docs: list[tuple], length: int, pad: int) -> list[dict]:
    """Rows of (doc_id, ids) pairs; a document longer than a row becomes pieces."""
    parts = [(d, at, ids[at:at + length]) for d, ids in docs for at in range(0, len(ids), length)]
    out = []
    for members in best_fit([len(p[2]) for p in parts], length):
        ids, positions = np.full(length, pad, "<i4"), np.zeros(length, "<i4")
        ends = [0]
        for i in members:
            a, n = ends[-1], len(parts[i][2])
            ids[a:a + n], positions[a:a + n] = parts[i][2], np.arange(n)
            ends.append(a + n)
        positions[ends[-1]:] = np.arange(length - ends[-1])
        out.append({"n_tokens": ends[-1], "ids": ids.tobytes(), "cu_seqlens": ends,
                    "positions": positions.tobytes(), "doc_ids": [parts[i][0] for i in members],
                    "offsets": [parts[i][1] for i in members]})
    return out


def pack(documents: DataFrame, path: str, pattern: str, length: int = LENGTH, pad: int = PAD,
         block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Packed rows; (shard, block, row) names each: the task, its block and the row in it."""
    with open(path, "rb") as f:
        ranks = documents.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        from pyspark import TaskContext

        shard, block = TaskContext.get().partitionId(), 0
        tokens, docs, size = Tokens(ranks.value, pattern), [], 0

        def batch_of(rows):
            for at in range(0, len(rows), 128):
                some = rows[at:at + 128]
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([shard] * len(some), pa.int32()),
                    "block": pa.array([block] * len(some), pa.int32()),
                    "row": pa.array(range(at, at + len(some)), pa.int32()),
                    "n_tokens": pa.array([r["n_tokens"] for r in some], pa.int32()),
                    "ids": pa.array([r["ids"] for r in some], pa.binary()),
                    "cu_seqlens": pa.array([r["cu_seqlens"] for r in some], pa.list_(pa.int32())),
                    "positions": pa.array([r["positions"] for r in some], pa.binary()),
                    "doc_ids": pa.array([r["doc_ids"] for r in some], pa.list_(pa.int64())),
                    "offsets": pa.array([r["offsets"] for r in some], pa.list_(pa.int32()))})

        for part in pieces(batches):
            texts = pc.fill_null(part.column("text"), "").to_pylist()
            for d, text in zip(part.column("doc_id").to_pylist(), texts):
                ids = tokens(text)
                if len(ids):
                    docs.append((d, ids))
                    size += len(ids)
                if size >= block_rows * length:
                    yield from batch_of(packed_block(docs, length, pad))
                    docs, size, block = [], 0, block + 1
        if docs:
            yield from batch_of(packed_block(docs, length, pad))

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, SCHEMA)


def write_packed(documents: DataFrame, path: str, out: str, pattern: str, **how) -> None:
    """Write the packed rows as Parquet: id matrices by block, segment ends, positions."""
    pack(documents, path, pattern, **how).write.mode("errorifexists").parquet(out)


def unpack(packed: DataFrame) -> DataFrame:
    """doc_id, offset and ids of each segment; a document's segments by offset are its ids."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, ends = np.frombuffer(row["ids"], "<i4"), row["cu_seqlens"]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "offset": pa.array(row["offsets"], pa.int32()),
                    "ids": pa.array([ids[a:b] for a, b in zip(ends, ends[1:])], pa.list_(pa.int32()))})

    cols = packed.select("ids", "cu_seqlens", "doc_ids", "offsets")
    return cols.mapInArrow(run, "doc_id long, offset int, ids array<int>")
