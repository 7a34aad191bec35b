"""Chroma audio fingerprints of media columns, and their alignment.

A recording (8-bit unsigned mono samples) becomes overlapping frames, each a vector of twelve pitch
classes; filters of an integral image over these vectors, quantised to two Gray-coded bits each,
give a packed 32-bit integer per frame. Two recordings are aligned by a histogram over the offsets
at which they show the same integer, then by the share of differing bits at the fullest offset.

The catalogue that recordings are aligned with is broadcast in rounds of bounded size.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import write_table

RATE = 8000
FRAME = 256
HOP = 32
PITCHES = 12
WIDE = 8  # frames that the widest filter spans
ROUND_CODES = 400_000  # catalogue codes broadcast at once
LEAST_HITS = 2
LEAST_OVERLAP = 6
MOST_ERRORS = 0.25


def _filters() -> list[tuple[int, int, int, int]]:
    """Sixteen (kind, first pitch, pitches, frames): kinds, places, heights and widths take turns."""
    return [(i % 6, (5 * i) % PITCHES, 2 + i % 5, 2 + (3 * i) % (WIDE - 1)) for i in range(16)]


def _fold() -> np.ndarray:
    """Bins of the spectrum to pitch classes."""
    f = np.arange(FRAME // 2 + 1) * RATE / FRAME
    out = np.zeros((len(f), PITCHES), np.float32)
    for k in np.flatnonzero((f > 60) & (f < 3600)):
        out[k, int(np.round(12 * np.log2(f[k] / 440))) % 12] = 1
    return out


_WINDOW = np.hanning(FRAME).astype(np.float32)
_FOLD = _fold()
_SMOOTH = np.array([1, 3, 4, 3, 1], np.float32) / 12


def chroma(samples: np.ndarray) -> np.ndarray:
    """Unit vectors of pitch classes, one each HOP samples; silence gives zeros."""
    padded = np.concatenate([np.zeros(FRAME // 2, np.float32), samples, np.zeros(FRAME // 2, np.float32)])
    frames = np.lib.stride_tricks.sliding_window_view(padded, FRAME)[::HOP]
    out = np.empty((len(frames), PITCHES), np.float32)
    for at in range(0, len(frames), 4096):
        spectrum = np.fft.rfft(frames[at : at + 4096] * _WINDOW, axis=1)
        out[at : at + 4096] = (spectrum.real**2 + spectrum.imag**2).astype(np.float32) @ _FOLD
    wide = np.pad(out, ((2, 2), (0, 0)))
    out = sum(w * wide[i : i + len(out)] for i, w in enumerate(_SMOOTH))
    norm = np.sqrt((out**2).sum(1, keepdims=True))
    return np.divide(out, norm, out=np.zeros_like(out), where=norm > 1e-3)


def fingerprint(samples: bytes) -> np.ndarray:
    """A 32-bit integer per frame that has WIDE - 1 frames after it; none for shorter recordings."""
    x = np.frombuffer(samples, np.uint8).astype(np.float32) - 128
    image = chroma(x) if len(x) else np.zeros((0, PITCHES), np.float32)
    n = len(image) - WIDE + 1
    if n < 1:
        return np.zeros(0, np.uint32)
    twice = np.concatenate([image, image], 1)  # pitches go round
    total = np.zeros((len(image) + 1, 2 * PITCHES + 1))
    total[1:, 1:] = twice.cumsum(0).cumsum(1)

    def area(t0: int, t1: int, p0: int, p1: int) -> np.ndarray:
        return total[t1 : t1 + n, p1] - total[t0 : t0 + n, p1] - total[t1 : t1 + n, p0] + total[t0 : t0 + n, p0]

    out = np.zeros(n, np.uint32)
    for kind, p, h, w in _filters():
        whole = area(0, w, p, p + h)
        if kind == 0:
            a, b = whole, area(0, w, (p + h) % PITCHES, (p + h) % PITCHES + h)
        elif kind == 1:
            a = area(0, w, p, p + h // 2)
            b = whole - a
        elif kind == 2:
            a = area(0, w // 2, p, p + h)
            b = whole - a
        elif kind == 3:
            a = area(0, w // 2, p, p + h // 2) + area(w // 2, w, p + h // 2, p + h)
            b = whole - a
        elif kind == 4:
            a = area(0, w, p + h // 3, p + h - h // 3)
            b = whole - a
        else:
            a = area(w // 3, w - w // 3, p, p + h)
            b = whole - a
        v = np.log1p(a) - np.log1p(b)
        level = (v > -0.25).astype(np.uint32) + (v > 0.0) + (v > 0.25)
        out = (out << np.uint32(2)) | (level ^ (level >> np.uint32(1)))
    return out


class Catalogue:
    """Codes of recordings, sorted, with their recordings and places."""

    def __init__(self, items: dict[int, np.ndarray]):
        self.items = {k: v for k, v in items.items() if len(v)}
        codes = np.concatenate([np.zeros(0, np.uint32), *self.items.values()]).astype(np.uint32)
        of = np.concatenate([np.zeros(0, np.int64), *(np.full(len(v), k) for k, v in self.items.items())]).astype(np.int64)
        at = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(v)) for v in self.items.values())]).astype(np.int64)
        order = np.argsort(codes, kind="stable")
        self.codes, self.of, self.at = codes[order], of[order], at[order]

    def align(self, codes: np.ndarray) -> list[tuple[int, int, float]]:
        """(recording, offset in frames, share of differing bits) of every match, least errors first, then the smallest recording and offset."""
        lo, hi = np.searchsorted(self.codes, codes, "left"), np.searchsorted(self.codes, codes, "right")
        some = np.flatnonzero(hi > lo)
        if not len(some):
            return []
        n = (hi - lo)[some]
        hit = np.repeat(lo[some] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        pairs, counts = np.unique(np.stack([self.of[hit], np.repeat(some, n) - self.at[hit]]), axis=1, return_counts=True)
        out = []
        for item, offset in pairs[:, counts >= LEAST_HITS].T.tolist():
            other = self.items[item]
            a, b = max(0, offset), min(len(codes), offset + len(other))
            if b - a < min(LEAST_OVERLAP, len(other)):
                continue
            errors = float(np.bitwise_count(codes[a:b] ^ other[a - offset : b - offset]).sum()) / (32 * (b - a))
            if errors <= MOST_ERRORS:
                out.append((item, offset, errors))
        places: dict[int, list[int]] = {}
        kept = []
        for item, offset, errors in sorted(out, key=lambda m: (m[2], m[0], m[1])):
            known = places.setdefault(item, [])
            if all(abs(offset - o) >= FRAME // HOP for o in known):  # frames that share samples tell one place; items of two codes are longer
                known.append(offset)
                kept.append((item, offset, errors))
        return kept


def _prints(key: str):
    def run(batches):
        for b in batches:
            made = [fingerprint(x.as_py() or b"") for x in b.column("media")]
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array([len(m) for m in made], pa.int64()), pa.array([m.tobytes() for m in made], pa.binary())], names=[key, "n_codes", "codes"])

    return run


def fingerprints(media: DataFrame, key: str) -> DataFrame:
    """key, n_codes, codes (little-endian 32-bit) of every row's binary column `media`; null is an empty recording."""
    return media.select(F.col(key).cast("long").alias(key), "media").mapInArrow(_prints(key), f"{key} long, n_codes long, codes binary")


def align(media: DataFrame, key: str, catalogue: DataFrame, item: str) -> DataFrame:
    """key, n_samples, n_codes, codes_sha256, item, offset, bit_errors: a row for each place at which a recording matches an item of the catalogue.

    A recording without a match, a null or short one has one row with nulls there. Catalogue rows with a null
    item take no part, of repeated items the first in order of their codes does. Empty tables give
    recordings without matches, or none.
    """
    spark = media.sparkSession
    known = write_table(fingerprints(catalogue, item).where(f"{item} is not null and n_codes > 0").groupBy(item).agg(F.min(F.struct("codes", "n_codes")).alias("m")).select(item, "m.codes", "m.n_codes"), "media-catalogue")
    total = known.agg(F.sum("n_codes")).first()[0] or 0
    rounds = max(1, -(-total // ROUND_CODES))
    dealt = known.withColumn("round", F.pmod(F.xxhash64(item), F.lit(rounds)))
    schema = f"{key} long, n_samples long, n_codes long, codes_sha256 string, item long, offset int, bit_errors double, first boolean"
    done = []
    for k in range(rounds):
        held = {r[item]: np.frombuffer(bytes(r["codes"]), np.uint32) for r in dealt.where(f"round = {k}").collect()}  # a round, bounded by ROUND_CODES
        shared = spark.sparkContext.broadcast(Catalogue(dict(sorted(held.items()))))

        def run(batches, shared=shared):
            for b in batches:
                for at in range(0, b.num_rows, 1024):
                    part = b.slice(at, 1024)
                    rows: list[list] = [[] for _ in range(8)]
                    for k, x in zip(part.column(key).to_pylist(), part.column("media")):
                        raw = x.as_py() or b""
                        codes = fingerprint(raw)
                        told = k, len(raw), len(codes), hashlib.sha256(codes.tobytes()).hexdigest()
                        for i, found in enumerate(shared.value.align(codes) or [(None, None, None)]):
                            for column, v in zip(rows, (*told, *found, i == 0)):
                                column.append(v)
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.float64(), pa.bool_())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds)], names=[key, "n_samples", "n_codes", "codes_sha256", "item", "offset", "bit_errors", "first"])

        out = media.select(F.col(key).cast("long").alias(key), "media").mapInArrow(run, schema)
        if rounds > 1:
            out = write_table(out, "media-round")
            shared.destroy()
        done.append(out)
    if rounds == 1:
        return done[0].drop("first")
    every = done[0]
    for more in done[1:]:
        every = every.union(more)
    told = every.groupBy(key, "n_samples", "n_codes", "codes_sha256").agg(F.collect_set(F.when(F.col("item").isNotNull(), F.struct("item", "offset", "bit_errors"))).alias("all"), F.count_if("first").alias("n"))
    # repeated rows come back as often as each round had them
    each = told.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.expr(f"n div {rounds}")))).withColumn("m", F.explode_outer("all"))
    return each.select(key, "n_samples", "n_codes", "codes_sha256", "m.item", "m.offset", "m.bit_errors")
