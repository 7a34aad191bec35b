"""Shared pieces of the training-data operators: scratch tables, word hashing, components."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import re
import shutil
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ids up to this many (some 16 bytes each) may be broadcast; beyond it the join shuffles.
BROADCAST_IDS = 500_000
#: Rows of several columns that with_ids sends whole through the driver; some 480000 took 240 MB of it.
BROADCAST_ROWS = 100_000
#: Bits of the filter that with_ids sends for more keys: BITS_A_KEY for each, up to MOST_BITS (10 MB); in rows of 1024.
BITS_A_KEY, MOST_BITS = 8, 1 << 26


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or (unset, in local mode as in tests) one of our own.

    On a cluster without that setting there is no folder to use, which is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    set_dir = sc._jsc.sc().getCheckpointDir()
    if set_dir.isDefined():
        return set_dir.get().rstrip("/")
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder that the driver and all executors share")
    own = tempfile.mkdtemp(prefix="lexweave-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    sc.setCheckpointDir(own)
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: writes df as Parquet in the shared folder and reads it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def drop_table(df: DataFrame) -> None:
    """Removes a table of write_table that nothing will read again."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.scratch)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession):
    """Within it the shuffle files of a query are removed when it ends. Else they stay until the driver's collector runs, which on many cores is hardly ever."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if was is None else spark.conf.set(name, was)


#: What a worker process remembers from one task to the next, by name of its maker.
KEPT: dict[str, dict] = {}


def trim() -> None:
    """Gives memory that earlier tasks of this worker process have freed back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def release() -> None:
    """Drops what other operators remember in this worker process, and trims it."""
    for kept in KEPT.values():
        kept.clear()
    trim()


def with_ids(rows: DataFrame, ids: DataFrame, key: str, few: int = BROADCAST_ROWS) -> DataFrame:
    """Inner join of a wide table with a narrow table of keys (a written one, as it is counted first); broadcasts the keys only if they are few, else the rows shuffle that a bitmap of the keys lets through."""
    n = ids.count()
    if n <= few:
        return rows.join(F.broadcast(ids), key)
    size = 1 << (BITS_A_KEY * n).bit_length()
    return (rows if size > MOST_BITS else _let_through(rows, ids, key, size)).join(ids, key)


def likely_ids(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows with a key of ids (a written table) and perhaps some others, which don't shuffle unless there are too many keys for a bitmap."""
    n = ids.count()
    size = 1 << (BITS_A_KEY * n).bit_length()
    if BROADCAST_ROWS < n and size <= MOST_BITS:
        return _let_through(rows, ids, key, size)
    keys = ids.select(key)
    return rows.join(F.broadcast(keys) if n <= BROADCAST_ROWS else keys, key, "left_semi")


def _let_through(rows: DataFrame, ids: DataFrame, key: str, size: int) -> DataFrame:
    """rows whose key's slot of `size` bits one of the ids has: all rows with a key of ids, and few others."""
    slot = F.xxhash64(F.col(key).cast("long")).bitwiseAND(size - 1)
    part, word, bit = F.expr("shiftright(slot, 10)").alias("part"), F.expr("cast(shiftright(slot, 6) & 15 as int)"), F.expr("shiftleft(1L, cast(slot & 63 as int))")
    bits = ids.select(slot.alias("slot")).groupBy(part).agg(*(F.bit_or(F.when(word == k, bit).otherwise(F.lit(0).cast("long"))).alias(f"w{k}") for k in range(16)))
    bits = bits.select("part", F.array(*(f"w{k}" for k in range(16))).alias("words"))
    has = F.expr("getbit(words[cast(shiftright(slot, 6) & 15 as int)], cast(slot & 63 as int)) = 1")
    return rows.withColumn("slot", slot).join(F.broadcast(bits), F.expr("shiftright(slot, 10) = part")).where(has).drop("slot", "part", "words")


def hidden(df: DataFrame, *names: str) -> tuple[DataFrame, list]:
    """df with its columns of these names renamed out of the way, and what to select to get its columns back."""
    away = {c: f"{c}_{uuid.uuid4().hex}" for c in df.columns if c.lower() in names}
    return df.withColumnsRenamed(away), [F.col(away[c]).alias(c) if c in away else F.col(c) for c in df.columns]


class WordHash(dict):
    """64-bit hash of a word, remembered for up to `most` words."""

    most = 250_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def all(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_MULT = np.uint64(0x9E3779B97F4A7C15)
_SHIFTS = (np.uint64(30), np.uint64(27), np.uint64(31))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit integers."""
    x = (x ^ (x >> _SHIFTS[0])) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _SHIFTS[1])) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> _SHIFTS[2])


def words_of(text: str | None) -> list[bytes]:
    """A-Z lowered; split at space and \\x09-\\x0D, as bytes.split() does."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingles(hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """Hash of each run of `width` words, in order; of the whole sequence if it is shorter."""
    n = len(hashes)
    if not n:
        return hashes
    k = min(width, n)
    out = np.full(n - k + 1, np.uint64(k), np.uint64)
    for i in range(k):
        out = out * _MULT + hashes[i : n - k + 1 + i]
    return mix(out)


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Connected components of edges (a, b: long): node, root (the smallest node of its component).

    Contraction: every node points to its smallest neighbour (or itself), pointers are doubled to
    their roots, edges are carried over to roots and deduplicated; this repeats until none is left.
    Every round is written to the shared folder, so lost executors replay one round at most. Empty
    edges give an empty result; self loops and repeated edges change nothing.
    """
    pairs = edges.select("a", "b").where("a != b")
    left = write_table(pairs.distinct(), f"{name}-edges")
    nodes = write_table(
        left.select(F.col("a").alias("node")).union(left.select(F.col("b").alias("node"))).distinct().withColumn("root", F.col("node")),
        f"{name}-roots",
    )
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = write_table(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("up")), f"{name}-up")
        while True:
            far = up.select(F.col("node").alias("mid"), F.col("up").alias("far"))
            new = write_table(up.join(far, up["up"] == far["mid"]).select("node", F.col("far").alias("up"), (F.col("up") != F.col("far")).alias("moved")), f"{name}-up")
            moved = not new.where("moved").isEmpty()
            drop_table(up)
            path, up = new.scratch, new.select("node", "up")
            up.scratch = path
            if not moved:
                break
        to = up.select(F.col("node").alias("was"), "up")
        new = write_table(nodes.join(to, F.col("root") == F.col("was"), "left").select("node", F.coalesce("up", "root").alias("root")), f"{name}-roots")
        drop_table(nodes)
        nodes = new
        ends = up.select(F.col("node").alias("b"), F.col("up").alias("b_up"))
        new = write_table(
            left.join(to, F.col("a") == F.col("was")).select(F.col("up").alias("a"), "b").join(ends, "b").where("a != b_up")
            .select(F.least("a", "b_up").alias("a"), F.greatest("a", "b_up").alias("b")).distinct(),
            f"{name}-edges",
        )
        drop_table(left)
        drop_table(up)
        left = new
    drop_table(left)
    return nodes


def merged(roots: DataFrame | None, links: DataFrame, name: str = "cc") -> DataFrame:
    """The components (node, root) of roots, if there are any, after more links (a, b: long)."""
    if roots is None:
        return components(links, name)
    old = roots.select(F.col("node").alias("x"), F.col("root").alias("r"))
    at = lambda side: F.coalesce(F.col(f"{side}.r"), F.col(f"l.{side}"))
    across = links.alias("l").join(old.alias("a"), F.expr("l.a = a.x"), "left").join(old.alias("b"), F.expr("l.b = b.x"), "left").select(at("a").alias("a"), at("b").alias("b"))
    top = components(across, name).select(F.col("node").alias("was"), F.col("root").alias("top"))
    known = roots.join(top, F.col("root") == F.col("was"), "left").select("node", F.coalesce("top", "root").alias("root"))
    new = top.join(roots, F.col("was") == F.col("node"), "left_anti").select(F.col("was").alias("node"), F.col("top").alias("root"))
    return write_table(known.union(new), name)
