"""Byte-level BPE encoding and decoding by recursive queries in DuckDB, one database a worker.

A partition's texts are split by the tokenizer's pattern; each distinct match starts as one row per
byte (as one row if it is a token itself). The recursive query joins neighbouring tokens with the
merge table (every split of every token into two tokens), contracts each word's leftmost pair of
least rank and goes on until no word has a pair. It is keyed by word and place, so it holds one row
a byte however many steps it takes. An ordered aggregation over the vocabulary decodes.

A word of n bytes takes up to n steps. For words of more than LONG bytes a second recursive query
contracts all pairs of a word's least rank in one step, left to right, where that gives the same:
unless a pair that such a contraction makes has a lower rank, in which case the leftmost alone is
contracted in that step.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LONG = 96
CHUNK = 60_000  # words a recursive query takes,
CHUNK_BYTES = 1 << 20  # and their bytes; twice as many don't fit the database's memory
CACHE = 700_000
#: A pattern, and what finds the same in texts of SAME characters alone: there [^\W\d_] is \p{L}, and \d is \p{N}. Its engine is the quicker one.
_KNOWN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_QUICK = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+").findall
_SAME = re.compile("[\\t\\n\\r\\x20-\\x7e\\xa1-\\xac\\xae-\\xb1\\xb4-\\xb8\\xba\\xbb\\xbf-\\u024f\\u2010-\\u2027\\u2030-\\u205e]*").fullmatch
_codecs: dict[str, Codec] = {}

_DECODE = """
SELECT f.w, string_agg(f.tok::VARCHAR, ',' ORDER BY f.pos) AS ids, count(*) AS n, string_agg(v.hex, '' ORDER BY f.pos) AS hex
FROM steps f JOIN vocab v ON v.tok = f.tok WHERE f.tok >= 0 GROUP BY f.w
"""
_ENCODE = f"""
WITH RECURSIVE steps(w, pos, tok) USING KEY (w, pos) AS (
  SELECT w, pos, tok FROM start
  UNION ALL
  (WITH pairs AS MATERIALIZED (
     SELECT p.w, p.pos, p.tok, p.prev, m.made
     FROM (SELECT w, pos, tok, CASE WHEN lead(w) OVER near = w THEN lead(tok) OVER near END AS next, CASE WHEN lag(w) OVER near = w THEN lag(pos) OVER near END AS prev
           FROM steps WHERE tok >= 0 WINDOW near AS (ORDER BY w, pos)) p
     LEFT JOIN merges m ON m.a = p.tok AND m.b = p.next)
   SELECT p.w, pos, CASE WHEN pos = best THEN made WHEN prev = best THEN -1 ELSE tok END
   FROM pairs p JOIN (SELECT w, min(made * 4294967296 + pos) & 4294967295 AS best FROM pairs WHERE made IS NOT NULL GROUP BY w) b ON b.w = p.w)
){_DECODE}"""
_ENCODE_LONG = f"""
WITH RECURSIVE steps(w, pos, tok) USING KEY (w, pos) AS (
  SELECT w, pos, tok FROM start
  UNION ALL
  SELECT w, pos, CASE WHEN take THEN made WHEN dead THEN -1 ELSE tok END
  FROM (SELECT *, lag(take, 1, false) OVER (PARTITION BY w ORDER BY pos) AS dead
        FROM (SELECT *, CASE WHEN careful THEN coalesce(pos = first, false) ELSE hit AND nth % 2 = 1 END AS take
              FROM (SELECT h.*, bool_or(hit AND (coalesce(x.made < h.made, false) OR coalesce(y.made < h.made, false) OR coalesce(z.made < h.made, false))) OVER (PARTITION BY w) AS careful,
                           min(CASE WHEN hit THEN pos END) OVER (PARTITION BY w) AS first, row_number() OVER (PARTITION BY w, hit, i - k ORDER BY pos) AS nth
                    FROM (SELECT *, row_number() OVER (PARTITION BY w, hit ORDER BY pos) AS k
                          FROM (SELECT *, coalesce(made = lowest, false) AS hit
                                FROM (SELECT p.*, m.made, min(m.made) OVER (PARTITION BY p.w) AS lowest
                                      FROM (SELECT w, pos, tok, row_number() OVER near AS i, lag(tok) OVER near AS prev, lead(tok) OVER near AS next, lead(tok, 2) OVER near AS after
                                            FROM steps WHERE tok >= 0 WINDOW near AS (PARTITION BY w ORDER BY pos)) p
                                      LEFT JOIN merges m ON m.a = p.tok AND m.b = p.next)
                                WHERE lowest IS NOT NULL)) h
                    LEFT JOIN merges x ON h.hit AND x.a = h.prev AND x.b = h.made
                    LEFT JOIN merges y ON h.hit AND y.a = h.made AND y.b = h.after
                    LEFT JOIN merges z ON h.hit AND z.a = h.made AND z.b = h.made)))
){_DECODE}"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}


class Codec:
    """Encodes words (bytes) to (ids joined by commas, number of ids, decoded bytes), remembered."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import duckdb
        import numpy as np

        self.ranks, self.words, self.again, self.np = ranks, {}, set(), np
        find = regex.compile(pattern).findall
        self.find = find if pattern != _KNOWN else lambda t: (_QUICK if _SAME(t) else find)(t)
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        splits = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        a, b, made = (pa.array(x, pa.int32()) for x in zip(*splits)) if splits else (pa.array([], pa.int32()),) * 3
        arrow = pa.table({"a": a, "b": b, "made": made})  # noqa: F841
        self.db.execute("CREATE TABLE merges AS SELECT * FROM arrow")
        arrow = pa.table({"tok": pa.array(list(ranks.values()), pa.int32()), "hex": [t.hex() for t in ranks]})
        self.db.execute("CREATE TABLE vocab AS SELECT * FROM arrow")

    def learn(self, words: list[str]) -> None:
        for query, long in ((_ENCODE, False), (_ENCODE_LONG, True)):
            chunk, size = [], 0
            for w in words:
                b = w.encode("utf-8", "surrogatepass")
                if (len(b) > LONG) != long:
                    continue
                chunk.append((w, b))
                size += len(b)
                if len(chunk) >= CHUNK or size >= CHUNK_BYTES:
                    self._query(query, chunk)
                    chunk, size = [], 0
            if chunk:
                self._query(query, chunk)

    def _query(self, query: str, words: list[tuple[str, bytes]]) -> None:
        np = self.np
        whole = np.fromiter((self.ranks.get(b, -1) for _, b in words), np.int32, len(words))
        lengths = np.fromiter((len(b) for _, b in words), np.int64, len(words))
        split = np.flatnonzero(whole < 0)  # the others are tokens themselves and start as one row
        lengths = lengths[split]
        of = np.repeat(split, lengths)
        first = np.repeat(np.cumsum(lengths) - lengths, lengths)
        tok = self.byte[np.frombuffer(b"".join(words[i][1] for i in split.tolist()), np.uint8)]
        single = np.flatnonzero(whole >= 0)
        w, pos = np.concatenate([of, single]), np.concatenate([np.arange(len(of)) - first, np.zeros(len(single), np.int64)])
        start = pa.table({"w": pa.array(w, pa.int32()), "pos": pa.array(pos, pa.int32()), "tok": np.concatenate([tok, whole[single]])})
        self.db.register("start", start)
        got = self.db.sql(query).to_arrow_table()
        self.db.unregister("start")
        for w, ids, n, hex_ in zip(*(c.to_pylist() for c in got.columns)):
            self.words[words[w][0]] = ids, n, bytes.fromhex(hex_)

    def encode(self, texts: list[str]) -> list[list[tuple[str, int, bytes]]]:
        if len(self.words) > CACHE:
            self.words = {w: self.words[w] for w in self.again}  # those that came again; most others are of one text
            self.again = set()
        split = [self.find(t) for t in texts]
        words = set().union(*split)
        new = words.difference(self.words)
        self.again |= words.difference(new)
        self.learn(list(new))
        get = self.words.__getitem__
        return [list(map(get, ws)) for ws in split]


def digest(ranks: dict[bytes, int], pattern: str) -> str:
    """Tells rank tables and patterns apart."""
    h = hashlib.sha256(pattern.encode())
    for t, r in sorted(ranks.items()):
        h.update(b"%d:%d:%s" % (r, len(t), t))
    return h.hexdigest()


def codec(key: str, ranks: dict[bytes, int], pattern: str) -> Codec:
    """The codec of the rank table and pattern that key, their digest, tells; one a process."""
    if key not in _codecs:
        _codecs[key] = Codec(ranks, pattern)
    return _codecs[key]


def encode_documents(documents: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of the decoded bytes).

    A null text is empty: no token, digests of nothing. Repeated rows are encoded each, a null
    doc_id stays null, an empty table gives an empty result; other columns are ignored.
    """
    ranks = read_ranks(ranks_path)
    shared = documents.sparkSession.sparkContext.broadcast((digest(ranks, pattern), ranks, pattern))

    def run(batches):
        c = codec(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                n, ids, plain = [], [], []
                for words in c.encode([t or "" for t in part.column("text").to_pylist()]):
                    joined = ",".join([w[0] for w in words])
                    n.append(joined.count(",") + 1 if words else 0)
                    ids.append(hashlib.sha256(joined.encode()).hexdigest())
                    plain.append(hashlib.sha256(b"".join([w[2] for w in words])).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids), pa.array(plain)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
