"""Exact top-k search by tiled matrix products.

Queries are packed into tiles of bounded size; a round of tiles (ROUND_BYTES at most) is broadcast
and every shard of candidates is multiplied by every tile. Each product is selected down to k
candidates a query at once, each partition keeps one running list a query, and the partitions'
lists are merged in a tree of fixed fan-in. Nothing larger than a round of queries or FAN_IN lists
of a tile is ever in one place, however many rows there are. More queries than a round holds take
several rounds, each written to the shared folder.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import write_table

TILE = 512  # queries of a tile, on average
ROUND_BYTES = 48 << 20
FAN_IN = 16
ROWS = 4096  # candidates multiplied at once
SCALE = 1024
_PART = "dim int, tile int, node int, query_id binary, vec_id binary, score binary"
_LONG = (-(1 << 63), (1 << 63) - 1)


def integers(vectors: list) -> tuple[np.ndarray, np.ndarray]:
    """(positions of usable vectors, floor(SCALE x) as rows) of vectors of one length: float64, or Python integers if some product leaves its range."""
    x = np.array(vectors, np.float64)
    fine = np.isfinite(x).all(1)
    with np.errstate(over="ignore"):
        rows = np.floor(SCALE * x[fine])
    if not np.isfinite(rows).all():  # components that large are whole numbers
        rows = np.array([[int(v) * SCALE if abs(v) > 2.0**64 else int(np.floor(SCALE * v)) for v in r] for r in x[fine].tolist()], object)
    return np.flatnonzero(fine), rows


def by_length(vectors: list):
    """For each length: positions and integer rows. Null, empty, null-holding and non-finite vectors take no part."""
    groups: dict[int, list[int]] = {}
    for i, v in enumerate(vectors):
        if v and None not in v:
            groups.setdefault(len(v), []).append(i)
    for dim, at in groups.items():
        fine, rows = integers([vectors[i] for i in at])
        if len(fine):
            yield dim, np.array(at)[fine], rows


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: float64 for rows whose partial sums stay below 2**53, else Python integers, held to the range of a long."""
    far = [np.abs(x).max(1).astype(object) for x in (a, b)]
    if int(far[0].max()) * int(far[1].max()) * a.shape[1] < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    most = int((2**52 // a.shape[1]) ** 0.5)
    small = [np.array([int(v) <= most for v in x]) for x in far]
    out = np.empty((len(a), len(b)), np.int64)
    out[np.ix_(*small)] = (a[small[0]].astype(np.float64) @ b[small[1]].astype(np.float64).T).astype(np.int64)
    for rows, columns in ((~small[0], np.ones(len(b), bool)), (small[0], ~small[1])):
        if rows.any() and columns.any():
            x, y = (np.array([[int(v) for v in r] for r in m], object) for m in (a[rows], b[columns]))
            out[np.ix_(rows, columns)] = np.clip(x @ y.T, *_LONG).astype(np.int64)
    return out


def select(scores: np.ndarray, k: int) -> np.ndarray:
    """Mask of each row's k highest, ties to the left."""
    if scores.shape[1] <= k:
        return np.ones(scores.shape, bool)
    kth = np.partition(scores, -k, axis=1)[:, -k][:, None]
    above, level = scores > kth, scores == kth
    room = k - above.sum(1, keepdims=True)
    return above | (level & (np.cumsum(level, 1, dtype=np.int32) <= room))


def best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int):
    """Of flat (query, vec, score) rows, each query's k highest in order."""
    order = np.lexsort((vec, -score.astype(np.float64), query)) if len(score) and abs(score).max() < 2**53 else np.array(sorted(range(len(score)), key=lambda i: (query[i], -int(score[i]), vec[i])), np.int64)
    query, vec, score = query[order], vec[order], score[order]
    start = np.searchsorted(query, query)
    keep = np.arange(len(query)) - start < k
    return query[keep], vec[keep], score[keep]


def _shard(tiles, k: int):
    def run(batches):
        from pyspark import TaskContext

        held: dict = {}
        for batch in batches:
            ids_all, vectors = batch.column("vec_id").to_numpy(), batch.column("embedding").to_pylist()
            for dim, at, rows in by_length(vectors):
                order = np.argsort(ids_all[at], kind="stable")
                ids, rows = ids_all[at][order], rows[order]
                for tile, (q_ids, q_rows) in tiles.value.get(dim, {}).items():
                    for s in range(0, len(ids), ROWS):
                        part, scores = ids[s : s + ROWS], products(q_rows, rows[s : s + ROWS])
                        own = q_ids[:, None] == part[None]
                        # the query's own row leaves room for one more
                        keep = select(scores, k + int(own.sum(1).max())) & ~own if own.any() else select(scores, k)
                        q, c = np.nonzero(keep)
                        old = held.get((dim, tile), (np.zeros(0, np.int64),) * 3)
                        held[dim, tile] = best(*(np.concatenate(x) for x in zip(old, (q_ids[q], part[c], scores[q, c]))), k)
        node = TaskContext.get().partitionId()
        for (dim, tile), lists in held.items():
            yield pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "tile": pa.array([tile], pa.int32()), "node": pa.array([node], pa.int32()), **{n: pa.array([x.astype(np.int64).tobytes()], pa.binary()) for n, x in zip(("query_id", "vec_id", "score"), lists)}})

    return run


def _merge(k: int):
    def run(pdf):
        import pandas as pd

        lists = best(*(np.concatenate([np.frombuffer(b, np.int64) for b in pdf[n]]) for n in ("query_id", "vec_id", "score")), k)
        return pd.DataFrame({"dim": pdf["dim"].iloc[:1], "tile": pdf["tile"].iloc[:1], "node": pdf["node"].iloc[:1], **{n: [x.tobytes()] for n, x in zip(("query_id", "vec_id", "score"), lists)}})

    return run


def _rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            q, v, s = (np.frombuffer(batch.column(n)[i].as_py(), np.int64) for n in ("query_id", "vec_id", "score"))
            yield pa.RecordBatch.from_pydict({"query_id": q, "rank": (np.arange(len(q)) - np.searchsorted(q, q) + 1).astype(np.int32), "vec_id": v, "score": s})


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest integer inner products.

    Both tables have vec_id and embedding; components become floor(1024 x). A candidate with the
    query's own vec_id is no candidate; ties go to the smaller vec_id; fewer candidates than k give
    them all. Rows with a null vec_id, and vectors that are null, empty or hold null or non-finite
    components, take no part. Vectors of different lengths don't meet. Repeated candidate rows
    count each; of repeated query rows one (the first in order of its components) is asked. Scores
    beyond a long are held to its range. Empty tables give an empty result; more columns are ignored.
    """
    spark = candidates.sparkSession
    ask = queries.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id is not null and size(embedding) > 0 and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))")
    ask = ask.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    count, dim = ask.agg(F.count("*"), F.max(F.size("embedding"))).first()
    cand = candidates.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id is not null and embedding is not null")
    tiles = max(1, -(-count // TILE))
    per_round = max(1, ROUND_BYTES // (TILE * 8 * (dim or 1)))
    tiled = ask.withColumn("tile", F.pmod(F.xxhash64("vec_id"), F.lit(tiles)).cast("int"))
    levels, nodes = 0, max(1, cand.rdd.getNumPartitions())
    while FAN_IN**levels < nodes:
        levels += 1
    done = []
    for begin in range(0, tiles, per_round):
        held: dict = {}
        for r in tiled.where(f"tile >= {begin} and tile < {begin + per_round}").collect():  # a round, bounded by ROUND_BYTES
            held.setdefault(len(r["embedding"]), {}).setdefault(r["tile"], []).append((r["vec_id"], r["embedding"]))
        held = {d: {t: (np.array([i for i, _ in rows], np.int64), integers([v for _, v in rows])[1]) for t, rows in of.items()} for d, of in held.items()}
        shared = spark.sparkContext.broadcast(held)
        part = cand.mapInArrow(_shard(shared, k), _PART)
        for _ in range(levels):
            part = part.withColumn("node", F.expr(f"cast(node div {FAN_IN} as int)")).groupBy("dim", "tile", "node").applyInPandas(_merge(k), _PART)
        out = part.mapInArrow(_rows, "query_id long, rank int, vec_id long, score long")
        if tiles > per_round:
            out = write_table(out, "topk-round")
            shared.destroy()
        done.append(out)
    while len(done) > 1:
        done = [done[i].union(done[i + 1]) if i + 1 < len(done) else done[i] for i in range(0, len(done), 2)]
    return done[0]
