"""Best-fit packing of tokenized documents, certified by dual-feasible lower bounds.

Documents are tokenized once into pieces of at most `capacity` tokens; full pieces are sequences of
their own. The rest is dealt by hash into partitions of about PART pieces, each packed by best-fit
decreasing. Dual-feasible functions give a lower bound of a partition's bins. A partition that
meets it keeps every bin but a slack last one; one with a gap keeps its full bins; all other pieces
are exchanged: dealt anew, among partitions of the next round. Rounds end when nothing is left to
exchange, when the bins in all meet the lower bound of the whole table, when one partition holds
all that is left, or when a round saves less than GAIN of the bins it packs anew (the better of the
two packings stays). certificate() tells bins, bound and gap of a packing.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEPT, drop_table, trim, write_table

PART = 2048
GAIN = 0.001
CACHE = 330_000
WORDS = 330_000
#: Characters for which lower-casing, NFC and the split into words work character by character, the same here and in the tokenizer.
_PLAIN = re.compile("[\\t\\n\\r\\x20-\\x7e\\xa1-\\xac\\xae-\\u012f\\u0131-\\u0148\\u014a-\\u017f\\u2010-\\u2027\\u2030-\\u205e]*")
_ASCII = bytes([9, 10, 13, *range(32, 127)])
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
_tokenizers: dict[str, tuple] = KEPT.setdefault("tokenizers", {})


def _words(run: str) -> list[str]:
    """The tokenizer's words of a run without blanks; letters alone, or before one stop, need no pattern."""
    if run.isalpha():
        return [run]
    if run[-1] in ".,;:!?" and run[:-1].isalpha():
        return [run[:-1], run[-1]]
    return _WORD.findall(run)


def _plain(text: str) -> bool:
    return not text.encode().translate(None, _ASCII) if text.isascii() else _PLAIN.fullmatch(text) is not None


class WordEncoder:
    """Ids of whatever stands between blanks, as little-endian 32-bit bytes, remembered; the tokenizer itself is asked for every new word."""

    def __init__(self, tokenizer):
        self.tokenizer, self.words, self.runs = tokenizer, {}, {}
        self.again, self.words_again = set(), set()  # runs and words that came again; most others are of one text

    def learn(self, runs: list[str]) -> None:
        """Runs of characters without blanks: their words' ids, joined."""
        split = list(map(_words, runs))
        words = set().union(*split)
        new = words.difference(self.words)
        self.words_again |= words.difference(new)
        new = list(new)
        for at in range(0, len(new), 1000):  # words parted by spaces are split as they were
            part = new[at : at + 1000]
            e = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids, of = np.array(e.ids, "<u4"), np.array(e.word_ids, np.int64)
            cuts = np.searchsorted(of, np.arange(len(part) + 1))
            raw = ids.tobytes()
            self.words.update((w, raw[4 * i : 4 * j]) for w, i, j in zip(part, cuts[:-1].tolist(), cuts[1:].tolist()))
        get = self.words.__getitem__
        self.runs.update((r, get(ws[0]) if len(ws) == 1 else b"".join(map(get, ws))) for r, ws in zip(runs, split))

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.runs) > CACHE:
            self.runs, self.again = {r: self.runs[r] for r in self.again}, set()
        if len(self.words) > WORDS:
            self.words, self.words_again = {w: self.words[w] for w in self.words_again}, set()
        split = [t.lower().split() if "<|" not in t and _plain(t) else None for t in texts]
        runs = set().union(*(s for s in split if s))
        new = runs.difference(self.runs)
        self.again |= runs.difference(new)
        self.learn(list(new))
        get = self.runs.__getitem__
        return [b"".join(map(get, s)) if s is not None else np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for s, t in zip(split, texts)]


def encoder(spec: str) -> WordEncoder:
    """The encoder of a tokenizer's JSON, one a process."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _tokenizers:
        t = Tokenizer.from_str(spec)
        t.encode_special_tokens = True  # their strings in a text are ordinary text
        _tokenizers[key] = WordEncoder(t)
    return _tokenizers[key]


def pieces(documents: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document's ids and end_id, cut after each `capacity` of them.

    A null text is empty and gives one piece, the end_id. Repeated rows give their pieces each; a
    null doc_id stays null. An empty table gives no piece.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = documents.sparkSession.sparkContext.broadcast(f.read())
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        trim()
        enc = encoder(spec.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows: list[list] = [[], [], [], [], []]
                for doc, ids in zip(part.column("doc_id").to_pylist(), enc.encode([t or "" for t in part.column("text").to_pylist()])):
                    ids += end
                    for k, s in enumerate(range(0, len(ids), 4 * capacity)):
                        cut = ids[s : s + 4 * capacity]
                        for column, v in zip(rows, (doc, k, s // 4, len(cut) // 4, zlib.crc32(cut))):
                            column.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()), *(pa.array(c, pa.int64()) for c in rows[2:])], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin of each item, its offset there, fill of each bin). Ties go to the earlier item and the bin last put back."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    fill: list[int] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set if some bin has room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        x = int(lengths[i])
        fit = rooms >> x
        if fit:
            room = x + (fit & -fit).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            b, room = len(fill), capacity
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += x
        if room > x:
            by_room.setdefault(room - x, []).append(b)
            rooms |= 1 << (room - x)
    return bins, offsets, np.array(fill, np.int64)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    return bound_of_counts(np.bincount(lengths, minlength=capacity + 1), capacity)


def bound_of_counts(n: np.ndarray, capacity: int) -> int:
    """The best bound of bins for n[x] pieces of length x, among dual-feasible functions: thresholds (large items count as whole bins, small ones as nothing) and the step functions u_k."""
    if not n.sum():
        return 0
    size = n * np.arange(capacity + 1)
    upto, total = np.cumsum(n), np.cumsum(size)
    cut = np.arange(1, capacity // 2 + 1)
    large = upto[-1] - upto[capacity - cut]
    middle = total[capacity - cut] - total[cut - 1]
    best = max(-(-int(total[-1]) // capacity), int((large - (-middle // capacity)).max()))
    x = np.arange(capacity + 1)
    for k in range(1, 21):
        whole = (k + 1) * x % capacity == 0
        steps = np.where(whole, k * x, (k + 1) * x // capacity * capacity)  # k times u_k
        best = max(best, -(-int((n * steps).sum()) // (k * capacity)))
    return best


def _pack(capacity: int):
    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values("uid")
        lengths = pdf["length"].to_numpy()
        bins, offsets, fill = best_fit_decreasing(lengths, capacity)
        gap = len(fill) - lower_bound(lengths, capacity)
        keep = fill == capacity if gap else np.ones(len(fill), bool)
        if not gap and len(fill) > 1 and fill.min() < capacity:
            keep[fill.argmin()] = False
        return pd.DataFrame({"uid": pdf["uid"], "length": lengths, "part": pdf["part"], "bin": bins, "offset": offsets, "kept": keep[bins]})

    return run


def _counts(pieces: DataFrame, capacity: int) -> np.ndarray:
    """How many pieces have each length; at most `capacity` numbers reach the driver."""
    n = np.zeros(capacity + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():
        n[r["length"]] = r["count"]
    return n


def certificate(packed: DataFrame, capacity: int = 2048) -> DataFrame:
    """bins, bound, gap: the sequences of a packing, the least that any packing of its pieces can have by dual-feasible functions, and the difference. One row."""
    spark = packed.sparkSession
    bins = packed.where("offset = 0").count()  # lengths are 1 at least, so a sequence has one piece at its start
    bound = bound_of_counts(_counts(packed, capacity), capacity)
    return spark.createDataFrame([(bins, bound, bins - bound)], "bins long, bound long, gap long")


def pack(cut: DataFrame, capacity: int = 2048) -> DataFrame:
    """The rows of pieces() with sequence_id and offset (gapless from 0), no sequence above capacity.

    Rows alike in every column are placed each. Lengths are 1 to capacity. An empty table gives an
    empty result. Full pieces get negative sequence ids.
    """
    rows = write_table(cut.withColumn("uid", F.monotonically_increasing_id()), "packing-pieces")
    full = F.col("length") >= capacity
    left = rows.where(~full).select("uid", "length")
    lengths = _counts(left, capacity)
    count, bound, n_bins = int(lengths.sum()), bound_of_counts(lengths, capacity), 0
    placed: list[DataFrame] = []
    before, open_, again, round_ = None, [], 0, 0  # how the pieces to exchange are packed so far, the tables that reads, and their bins

    def place(rows_: DataFrame) -> None:
        placed.append(write_table(rows_, "packing-placed"))

    while count:
        parts = max(1, -(-count // PART))
        dealt = left.withColumn("part", F.pmod(F.xxhash64("uid", F.lit(round_)), F.lit(parts)))
        packed = write_table(dealt.groupBy("part").applyInPandas(_pack(capacity), "uid long, length long, part long, bin long, offset long, kept boolean"), "packing-round")
        seq = F.lit(round_ << 56).bitwiseOR(F.shiftleft("part", 16)).bitwiseOR(F.col("bin")).alias("sequence_id")
        bins, kept, loose = packed.selectExpr("count_if(offset = 0)", "count_if(offset = 0 and kept)", "count_if(not kept)").first()
        done = packed.select("uid", seq, "offset")
        slow = before is not None and bins > again * (1 - GAIN)
        if slow or parts == 1 or not loose or n_bins + bins <= bound:
            place(before if before is not None and bins >= again else done)
            count = 0
        else:
            place(packed.where("kept").select("uid", seq, "offset"))
            before, n_bins, again, count = packed.where("not kept").select("uid", seq, "offset"), n_bins + kept, bins - kept, loose
            left = packed.where("not kept").select("uid", "length")
        for t in open_:
            drop_table(t)
        open_ = [packed]
        round_ += 1
    for t in open_:
        drop_table(t)
    whole = rows.where(full).select("*", (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")).drop("uid")
    if not placed:
        return whole
    table = placed[0]
    for t in placed[1:]:
        table = table.union(t)
    return rows.where(~full).join(table, "uid").drop("uid").union(whole)
