"""Byte-level BPE encoding and decoding as DuckDB recursive queries inside each task.

Spark deals out the documents; each task splits its texts by the tokenizer's pattern,
gathers the distinct words it has not met yet, and encodes them with one recursive
query over token-position rows ``(w, pos, tok, nxt)``. A step joins the rows whose
neighbours changed with the merge table, takes each word's leftmost pair of minimum
rank and contracts it; words without a pair left are the fixpoint. As the tiktoken
library does, a word that is a token as a whole is that token. An ordered aggregation
turns rows into id lists, and another one, over ids joined with the vocabulary, into
bytes again.

Words of more than ``LONG_WORD`` bytes take a second recursive query: there a step
contracts, from the left, all non-overlapping pairs of the minimum rank at once
wherever no contraction of that rank can make a pair of a smaller rank (``unsafe``
lists the ranks where it can; of those only the leftmost pair is contracted). The
result is the same, in far fewer steps.

Defined results: null and empty texts have no tokens; special-token strings are
ordinary text; decoding the ids gives the text's UTF-8 bytes; repeated rows are
encoded each; extra columns are ignored. The vocabulary is read on the driver and its
few hundred KB are broadcast, so executors need no file.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces

LONG_WORD = 96
#: Words met lately that a worker keeps with their ids. When there are so many, those met
#: before them are dropped and they take their place; so twice as many are kept at most.
STORE_WORDS = 180_000
#: Bytes of text a task reads, and bytes of words a query gets, at a time.
PIECE = 2 << 20
QUERY_BYTES = 1 << 20

_SHORT = """
WITH RECURSIVE step(w, pos, tok, nxt, k, live) AS (
  SELECT s.w, s.pos, s.tok, s.nxt, m.rank::BIGINT * 65536 + s.pos, true
  FROM start s LEFT JOIN merges m ON m.l = s.tok AND m.r = s.nxt
  UNION ALL
  (WITH best AS (
     SELECT w, min(k) % 65536 AS p, (min(k) // 65536)::INT AS t FROM step WHERE live GROUP BY w),
   pair AS MATERIALIZED (
     SELECT s.w, s.pos, s.tok, s.nxt, b.p, b.t FROM step s JOIN best b ON b.w = s.w WHERE s.live),
   moved AS (
     SELECT a.w, CASE WHEN a.pos > a.p THEN a.pos - 1 ELSE a.pos END AS pos,
       CASE WHEN a.pos = a.p THEN a.t ELSE a.tok END AS tok,
       CASE WHEN a.pos = a.p THEN e.nxt WHEN a.pos + 1 = a.p THEN a.t ELSE a.nxt END AS nxt,
       a.p IS NOT NULL AS live
     FROM pair a LEFT JOIN (SELECT w, nxt FROM pair WHERE pos = p + 1) e ON e.w = a.w AND a.pos = a.p
     WHERE a.p IS NULL OR a.pos <> a.p + 1)
   SELECT v.w, v.pos, v.tok, v.nxt, m.rank::BIGINT * 65536 + v.pos, v.live
   FROM moved v LEFT JOIN merges m ON m.l = v.tok AND m.r = v.nxt))
SELECT w, pos, tok FROM step WHERE NOT live
"""

_LONG = """
WITH RECURSIVE step(w, pos, tok, live) AS (
  SELECT w, pos, tok, true FROM start
  UNION ALL
  (WITH pair AS (
     SELECT w, pos, tok, lead(tok) OVER (PARTITION BY w ORDER BY pos) AS nxt FROM step WHERE live),
   ranked AS (
     SELECT p.w, p.pos, p.tok, m.rank, min(m.rank) OVER (PARTITION BY p.w) AS best,
       row_number() OVER (PARTITION BY p.w ORDER BY p.pos) AS i
     FROM pair p LEFT JOIN merges m ON m.l = p.tok AND m.r = p.nxt),
   run AS (
     SELECT *, i - max(CASE WHEN rank = best THEN 0 ELSE i END) OVER o AS k,
       count(*) FILTER (rank = best) OVER o AS seen
     FROM ranked WINDOW o AS (PARTITION BY w ORDER BY pos ROWS UNBOUNDED PRECEDING)),
   chosen AS (
     SELECT w, pos, tok, best, coalesce(rank = best AND k % 2 = 1
       AND (seen = 1 OR best NOT IN (SELECT rank FROM unsafe)), false) AS pick FROM run),
   next AS (SELECT *, lag(pick, 1, false) OVER (PARTITION BY w ORDER BY pos) AS eaten FROM chosen)
   SELECT w, pos, CASE WHEN pick THEN best ELSE tok END, best IS NOT NULL FROM next WHERE NOT eaten))
SELECT w, pos, tok FROM step WHERE NOT live
"""

_RESULT = """
SELECT w, string_agg(tok::VARCHAR, ' ' ORDER BY pos) AS ids,
  unhex(string_agg(v.hex, '' ORDER BY pos)) AS bytes
FROM ids JOIN vocab v ON v.id = tok GROUP BY w ORDER BY w
"""


def load_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


class Coder:
    """A tokenizer in one task's DuckDB database."""

    def __init__(self, ranks_file: bytes, pattern: str, memory: str = "500MB"):
        import duckdb
        import regex

        rows = (line.split() for line in ranks_file.splitlines() if line.strip())
        self.ranks = {base64.b64decode(a): int(b) for a, b in rows}
        self.split = regex.compile(pattern).findall
        self.byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, made, unsafe = [], [], [], set()
        get = self.ranks.get
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = get(token[:i]), get(token[i:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), made.append(rank)
                    # a later-ranked part of an earlier-ranked token
                    unsafe.update(x for x in (a, b) if x > rank)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": memory, "temp_directory": ""})
        self.con.execute("SET preserve_insertion_order = false")
        self._table("merges", l=left, r=right, rank=made)
        self._table("unsafe", rank=sorted(unsafe))
        items = list(self.ranks.items())
        self.con.register("_v", pa.table({"id": pa.array([r for _, r in items], pa.int32()),
                                          "hex": [t.hex() for t, _ in items]}))
        self.con.execute("CREATE TABLE vocab AS SELECT * FROM _v")
        #: of each word met: its ids in decimal; and of those met before them
        self.ids: dict[str, str] = {}
        self.older: dict[str, str] = {}
        #: of words whose ids decode to other bytes than their own: those bytes
        self.altered: dict[str, bytes] = {}

    def _table(self, name: str, **columns) -> None:
        self.con.register("_t", pa.table({k: pa.array(v, pa.int32()) for k, v in columns.items()}))
        self.con.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM _t")

    def _start(self, words: list[bytes], numbers: list[int]) -> None:
        size = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        tok = self.byte_id[data]
        nxt = np.append(tok[1:], np.int32(-1))
        nxt[np.cumsum(size) - 1] = -1
        pos = np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size)
        self.con.register("_t", pa.table({
            "w": np.repeat(np.array(numbers, np.int32), size), "pos": pos.astype(np.int32),
            "tok": tok, "nxt": nxt}))
        self.con.execute("CREATE OR REPLACE TEMP TABLE start AS SELECT * FROM _t")

    def _query(self, words: list[str]) -> None:
        raw = [w.encode() for w in words]
        whole = [(i, self.ranks[w]) for i, w in enumerate(raw) if w in self.ranks]
        self._table("whole", w=[i for i, _ in whole], pos=[0] * len(whole), tok=[t for _, t in whole])
        rest = [i for i, w in enumerate(raw) if w not in self.ranks]
        self.con.execute("CREATE OR REPLACE TEMP TABLE ids AS SELECT * FROM whole")
        for query, some in ((_SHORT, [i for i in rest if len(raw[i]) <= LONG_WORD]),
                            (_LONG, [i for i in rest if len(raw[i]) > LONG_WORD])):
            if some:
                self._start([raw[i] for i in some], some)
                self.con.execute("INSERT INTO ids " + query)
        got = self.con.sql(_RESULT).to_arrow_table()
        self.ids.update(zip(words, got.column("ids").to_pylist()))
        data = got.column("bytes").to_pylist()
        if data != raw:
            self.altered.update((w, d) for w, r, d in zip(words, raw, data) if d != r)

    def learn(self, words) -> None:
        """Encode and decode the words that the store lacks."""
        if len(self.ids) > STORE_WORDS:
            self.ids, self.older = {}, self.ids
        new = []
        for w in words:
            if w not in self.ids:
                ids = self.older.get(w)
                if ids is None:
                    new.append(w)
                else:
                    self.ids[w] = ids
        at = 0
        while at < len(new):
            end, size = at, 0
            while end < len(new) and (end == at or size + len(new[end]) <= QUERY_BYTES):
                size += len(new[end])
                end += 1
            self._query(new[at:end])
            at = end

    def coded(self, words: list[str]) -> tuple[str, bytes]:
        """A split text's ids in decimal, joined by spaces, and the bytes they decode to."""
        if self.altered:
            data = b"".join([self.altered[w] if w in self.altered else w.encode() for w in words])
        else:
            data = "".join(words).encode()
        return " ".join(map(self.ids.__getitem__, words)), data

    def decode(self, ids: list[list[int]]) -> list[bytes]:
        """The bytes of each list of ids, by one ordered aggregation."""
        w = np.repeat(np.arange(len(ids)), [len(x) for x in ids]).astype(np.int32)
        pos = np.concatenate([np.arange(len(x)) for x in ids] or [np.zeros(0)]).astype(np.int32)
        self._table("given", w=w, pos=pos, tok=[t for x in ids for t in x])
        got = dict(self.con.execute(
            "SELECT w, unhex(string_agg(v.hex, '' ORDER BY pos)) FROM given JOIN vocab v ON v.id = tok "
            "GROUP BY w").fetchall())
        return [bytes(got.get(i, b"")) for i in range(len(ids))]


def _coder(ranks_file: bytes, pattern: str) -> Coder:
    """The worker's coder; the tasks that it runs one after the other share its store. It is
    kept in a module of its own, for each task gets its own copy of this one."""
    import sys
    import types

    kept = sys.modules.setdefault("_attestor_coders", types.ModuleType("_attestor_coders")).__dict__
    key = hashlib.sha256(ranks_file).digest(), pattern
    if kept.get("key") != key:
        kept.update(key=key, coder=Coder(ranks_file, pattern))
    return kept["coder"]


def _texts(batches, ranks, pattern):
    """Slices of Arrow batches with their split texts, all words of which the coder has met."""
    coder = _coder(ranks.value, pattern)
    for part in pieces(batches, limit=PIECE):
        texts = [coder.split(t) for t in pc.fill_null(part.column("text"), "").to_pylist()]
        met: dict[str, None] = {}
        for words in texts:
            met.update(dict.fromkeys(words))
        coder.learn(met)
        yield coder, part, texts


def token_digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and n_bytes of the decoded text."""
    ranks = documents.sparkSession.sparkContext.broadcast(load_ranks(path))

    def run(batches):
        for coder, part, texts in _texts(batches, ranks, pattern):
            n, ids_sha, dec_sha, size = [], [], [], []
            for t in texts:
                ids, data = coder.coded(t)
                n.append(ids.count(" ") + 1 if ids else 0)
                ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                dec_sha.append(hashlib.sha256(data).hexdigest())
                size.append(len(data))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(dec_sha),
                 pa.array(size, pa.int64())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, "
                                "decoded_sha256 string, n_bytes long")


def encode(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids, an array of the text's token ids."""
    ranks = documents.sparkSession.sparkContext.broadcast(load_ranks(path))

    def run(batches):
        for coder, part, texts in _texts(batches, ranks, pattern):
            ids = [np.array(coder.coded(t)[0].split(), np.int32) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and bytes of rows of ``encode``; null ids have no bytes."""
    ranks = encoded.sparkSession.sparkContext.broadcast(load_ranks(path))

    def run(batches):
        coder = Coder(ranks.value, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [x or [] for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(coder.decode(ids), pa.binary())],
                    names=["doc_id", "bytes"])

    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, bytes binary")
