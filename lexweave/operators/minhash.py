"""MinHash signatures and banded near-duplicate clusters."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.functions import text as T
from lexweave.operators.graph import components

HASHES, BANDS, GRAM, AGREE = 64, 16, 8, 0.8


def signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key and sig: HASHES 32-bit minima over the hashes of word 8-grams (all words as one gram if fewer); null for no words."""
    words = docs.select(key, F.expr(T.words_sql(f"lower({text})")).alias("w"))
    grams = words.select(key, F.expr(f"case when size(w) = 0 then null when size(w) < {GRAM} then array(xxhash64(array_join(w, ' '))) else transform(sequence(1, size(w) - {GRAM - 1}), i -> xxhash64(slice(w, i, {GRAM}))) end").alias("g"))

    def run(batches):
        rng = np.random.default_rng(64)
        a, b = rng.integers(1, 1 << 62, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 62, HASHES, dtype=np.uint64)
        for batch in batches:
            out = []
            for g in batch.column("g"):
                x = None if not g.is_valid else np.asarray(g.values).view(np.uint64)
                out.append(None if x is None else np.concatenate([((x * m + c) >> np.uint64(32)).min(keepdims=True) for m, c in zip(a, b)]).astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(out, pa.binary())], names=[key, "sig"])

    return grams.mapInArrow(run, f"{key} long, sig binary")


def clusters(sigs: DataFrame, key: str) -> DataFrame:
    """node, root of rows that agree with the first row of one of their bands in AGREE of the hashes. A band's first row comes from a partial minimum, so a full band is no hot task."""
    width = 4 * HASHES // BANDS
    bands = sigs.where("sig is not null").select(key, "sig", F.explode(F.expr(f"transform(sequence(0, {BANDS - 1}), i -> struct(i as band, substring(sig, i * {width} + 1, {width}) as part))")).alias("x")).select(key, "sig", "x.band", "x.part")
    first = bands.groupBy("band", "part").agg(F.min(F.struct(F.col(key).alias("k"), "sig")).alias("f"), F.count("*").alias("n")).where("n > 1")
    pairs = bands.join(first, ["band", "part"]).where(F.col(key) != F.col("f.k")).select(F.col("f.k").alias("src"), F.col(key).alias("dst"), F.col("f.sig").alias("x"), F.col("sig").alias("y")).distinct()
    same = F.expr(f"size(filter(sequence(0, {HASHES - 1}), i -> substring(x, 4 * i + 1, 4) = substring(y, 4 * i + 1, 4)))")
    return components(pairs.where(same >= AGREE * HASHES).select("src", "dst"))
