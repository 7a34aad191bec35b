"""Toxicity by subword bags: a linear softmax over averaged character n-gram embeddings.

A word's vector is the mean of its n-gram vectors ('<word>', 3 to 6 characters, hashed to buckets),
a bag's the mean of its words' vectors; every run of BAG words is a bag (all words of a shorter
text are one), and a document's logit is a smooth maximum over its bags. Embeddings and softmax are
trained together in numpy (Adam over the whole sample) by one task, over a bounded sample of the
labelled rows. Unseen misspellings share n-grams with words seen in training.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, trim

BUCKETS = 1 << 17
DIM = 8
BAG = 3
GRAMS = (3, 4, 5, 6)
PER_CLASS = 1200  # labelled rows of each class that training takes at most, by hash of doc_id
STEPS = 50
RATE = 0.1
DECAY = 1e-6
SHARP = 3.0
MIN_DOCS = 5  # n-gram buckets of fewer training documents stay zero
ROWS = 256  # texts scored at once
NAMES = 4000  # words whose n-grams are made at once in training
AT_ONCE = 1 << 17  # n-grams, or bags, that a step of training holds values of at once, if a word or text has no more


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket ids of all n-grams of all words, word after word, and how many each word has (one at least)."""
    padded = [f"<{w}>" for w in words]
    lengths = np.fromiter(map(len, padded), np.int64, len(padded))
    chars = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), lengths)
    end = np.repeat(np.cumsum(lengths), lengths)
    at = np.arange(len(chars))
    ids, owners = [], []
    h = np.zeros(len(chars), np.uint64)
    for n in range(1, min(GRAMS[-1], len(chars)) + 1):
        part = np.zeros(len(chars), np.uint64)
        part[: len(chars) - n + 1] = chars[n - 1 :]
        h = h * np.uint64(0x100000001B3) + part + np.uint64(1)
        if n in GRAMS:
            fits = at + n <= end
            x = h[fits] + np.uint64(n)
            x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            ids.append((x >> np.uint64(47)).astype(np.int64) % BUCKETS)
            owners.append(word[fits])
    ids, owners = np.concatenate(ids), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return ids[order], np.bincount(owners, minlength=len(words))


def _means(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Mean of each run of counts[i] >= 1 values."""
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    sums = np.add.reduceat(values, starts, axis=0)
    return sums / (counts[:, None] if values.ndim > 1 else counts)


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for lengths[0] >= 1 steps, then the next run."""
    out = np.ones(lengths.sum(), np.int64)
    at = np.cumsum(lengths)[:-1]
    out[0] = starts[0]
    out[at] = starts[1:] - starts[:-1] - lengths[:-1] + 1
    return np.cumsum(out)


def bags(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, end) of every bag of texts of lengths[i] >= 1 words that follow one another, and the bags of each text."""
    counts = np.maximum(lengths - BAG + 1, 1)
    begin = np.cumsum(lengths) - lengths
    first = _runs(begin, counts)
    return first, first + np.minimum(np.repeat(lengths, counts), BAG), counts


def _bag_means(values: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return (total[end] - total[first]) / (end - first)


def words_of(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def _pool(bags: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A smooth maximum of each document's bags, and each bag's part in its gradient."""
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    top = np.maximum.reduceat(bags, starts)
    e = np.exp(SHARP * (bags - np.repeat(top, counts)))
    total = np.add.reduceat(e, starts)
    return top + np.log(total) / SHARP, e / np.repeat(total, counts)


class Model:
    """What scoring needs: each bucket's share of the logit, and the bias."""

    def __init__(self, weight: np.ndarray, bias: float):
        self.weight, self.bias = weight, bias
        self.known: dict[str, float] = {}

    def __getstate__(self):
        return self.weight, self.bias

    def __setstate__(self, state):
        (self.weight, self.bias), self.known = state, {}

    def values(self, words: list[str]) -> np.ndarray:
        """Each word's share of the logit, remembered for up to 150,000 words."""
        if len(self.known) > 150_000:
            self.known.clear()
        new = list(set(words).difference(self.known))
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            ids, counts = grams(part)
            self.known.update(zip(part, _means(self.weight[ids], counts).tolist()))
        return np.fromiter(map(self.known.__getitem__, words), np.float64, len(words))

    def score(self, docs: list[list[str]]) -> np.ndarray:
        out = np.full(len(docs), float(self.bias))
        for i, words in enumerate(docs):
            if words:
                first, end, counts = bags(np.array([len(words)]))
                out[i] += _pool(_bag_means(self.values(words), first, end), counts)[0][0]
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def _parts(counts: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(i, j, at, to): owners i to j together hold the values at to `to`, AT_ONCE or so; counts[i] >= 1 values belong to i."""
    ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    cuts = np.unique(np.append(np.searchsorted(ends, np.arange(0, ends[-1], AT_ONCE)), len(counts)))
    return [(int(i), int(j), int(ends[i]), int(ends[j])) for i, j in zip(cuts, cuts[1:])]


def loss_and_gradient(params: list[np.ndarray], data: dict) -> tuple[float, list[np.ndarray]]:
    """Weighted cross entropy (and decay of the embeddings) and its gradient by embeddings, softmax and bias."""
    emb, soft, bias = params
    ids, counts, tokens, first, end, per_doc, y, share, live = (data[k] for k in ("ids", "counts", "tokens", "first", "end", "per_doc", "y", "share", "live"))
    way = soft[:, 1] - soft[:, 0]
    weight, words = emb @ way, _parts(counts)
    value = np.concatenate([_means(weight[ids[at:to]], counts[i:j]) for i, j, at, to in words])
    to_word, loss, off = np.zeros(len(counts)), 0.0, 0.0
    for i, j, at, to in _parts(per_doc):
        begin = int(first[at])
        mine, lo, hi = tokens[begin : int(end[to - 1])], first[at:to] - begin, end[at:to] - begin
        logit, part = _pool(_bag_means(value[mine], lo, hi), per_doc[i:j])
        logit = np.clip(logit + bias[1] - bias[0], -500, 500)
        err = (1 / (1 + np.exp(-logit)) - y[i:j]) * share[i:j]
        loss += float((share[i:j] * (np.logaddexp(0, logit) - y[i:j] * logit)).sum())
        off += err.sum()
        each = np.repeat(err, per_doc[i:j]) * part / (hi - lo)
        spread = np.cumsum(np.bincount(lo, each, len(mine) + 1) - np.bincount(hi, each, len(mine) + 1))[:-1]
        to_word += np.bincount(mine, spread, len(counts))
    loss += float(DECAY / 2 * (emb * emb).sum())
    to_gram = np.zeros(len(emb))
    for i, j, at, to in words:
        to_gram += np.bincount(ids[at:to], np.repeat(to_word[i:j] / counts[i:j], counts[i:j]), len(emb))
    to_gram *= live
    to_way = emb.T @ to_gram
    return loss, [to_gram[:, None] * way + DECAY * emb, np.stack([-to_way, to_way], 1), np.array([-off, off])]


def train(texts: list[str | None], labels: list[int], seed: int = 7) -> Model:
    """The model for 0/1 labels; without both classes, a constant share of toxic rows."""
    index: dict[str, int] = {}
    parts, kept = [], []
    for text, label in zip(texts, labels):
        if words := words_of(text):
            parts.append(np.fromiter((index.setdefault(w, len(index)) for w in words), np.int32, len(words)))
            kept.append(label)
    y = np.array(kept, np.int64)
    if not len(y) or y.min() == y.max():
        p = (sum(labels) + 0.5) / (len(labels) + 2)
        return Model(np.zeros(BUCKETS), float(np.log(p / (1 - p))))
    names = list(index)
    made = [[x.astype(np.int32) for x in grams(names[at : at + NAMES])] for at in range(0, len(names), NAMES)]
    ids, counts = (np.concatenate([m[i] for m in made]) for i in (0, 1))
    del made, names
    ends = np.concatenate([[0], np.cumsum(counts)])
    seen = np.zeros(BUCKETS, np.int64)  # documents that hold each bucket
    for words in parts:
        mine = np.unique(words)
        seen[np.unique(ids[_runs(ends[mine], counts[mine])])] += 1
    live = seen >= MIN_DOCS
    first, end, per_doc = bags(np.array([len(d) for d in parts]))
    first, end = (x.astype(np.int32) for x in (first, end))
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    data = {"ids": ids, "counts": counts, "tokens": np.concatenate(parts), "first": first, "end": end, "per_doc": per_doc, "y": y, "share": share, "live": live}
    del parts
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 0.3, (BUCKETS, DIM)) * live[:, None], rng.normal(0, 0.3, (DIM, 2)), np.zeros(2)]
    means, squares = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        _, grads = loss_and_gradient(params, data)
        for x, g, m, v in zip(params, grads, means, squares):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    emb, soft, bias = params
    return Model((emb @ (soft[:, 1] - soft[:, 0])) * live, float(bias[1] - bias[0]))


def held_out(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """Trains on up to PER_CLASS labelled rows of each class whose crc32(doc_id) mod 5 is not 0."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic")).where(~held_out())
    pick = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(PER_CLASS) for k in (0, 1)]
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(pick[0].union(pick[1])), "doc_id")

    def learn(batches):
        release()
        rows = {}
        for b in batches:
            for i, text, label in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "toxic"))):
                if i not in rows or (text or "") < (rows[i][0] or ""):  # of repeated rows the smallest text
                    rows[i] = (text, label)
        rows = [rows.pop(k) for k in sorted(rows)]
        m = train([t for t, _ in rows], [y for _, y in rows])
        trim()
        yield pa.RecordBatch.from_pydict({"weight": pa.array([m.weight.astype(np.float32).tobytes()], pa.binary()), "bias": [m.bias]})

    made = texts.repartition(1).mapInArrow(learn, "weight binary, bias double").first()  # one task, at most 2 PER_CLASS rows
    if made is None:
        return train([], [])
    return Model(np.frombuffer(bytes(made["weight"]), np.float32).astype(np.float64), made["bias"])


def toxicity_scores(documents: DataFrame, model: Model) -> DataFrame:
    """documents with held_out (null for a null doc_id), score and predicted added in front of its columns' end.

    Null, empty and blank texts get the bias alone. Repeated rows score alike. An empty table gives
    an empty result. Columns of documents named as an added one are replaced.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    added = ("held_out", "score", "predicted")
    docs = documents.drop(*added)
    schema = docs.select("*", F.lit(0.0).alias("score")).schema

    def run(batches):
        release()
        m = shared.value
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                scores = m.score([words_of(x.as_py()) for x in part.column("text")])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], names=[*b.schema.names, "score"])

    scored = docs.mapInArrow(run, schema)
    return scored.withColumn("held_out", held_out()).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
