"""N-gram Jaccard join by adaptive multi-match prefixes.

A document's set holds the hashes of its distinct five-word shingles. One order of all shingles
(rare first, by a count sketch of fixed size that sums over the whole corpus) sorts every set.
For a threshold t, the first n - ceil(t n) + k shingles of two linked sets share at least k of
them. Each document chooses its own k in 1..MAX_MATCH by estimated cost: scanning a longer prefix
against verifying the candidates it lets through. A pair needs min(k_a, k_b) shared prefix
shingles, then passes a parity-bitmap bound, then an exact test over both whole texts.

Copies cost nothing: documents with equal sets are one class. A large group of near copies costs
one test a member and round: each class is first tested against one leader, of those classes that
lead the lists of its prefix shingles (most of their own prefix is shared) the one it meets most;
what this links is contracted, and only pairs across different components are generated after
that, so no link between components is lost. Of two prefixes, shingles of the one that ends first in
the order are in the other set only if they are in its prefix; so those that no other prefix shows
cap the pair's overlap, and pairs that the cap rules out are never generated.

Shingles whose lists are still long then (over LIST classes) are not joined as they are. The classes
on such lists get new prefixes from their whole sets, in the exact order of how many of these
classes of other components hold each shingle; what no other component holds isn't in the prefix. The
first common shingle of a pair and what follows it in either set cap the overlap, and so the sizes of
the classes that a class can be linked with by that shingle. A class meets classes of these sizes
alone, and of those only the ones that its parity bitmap, folded to MARKS words, doesn't rule out.
Shingles that the sketch shows to be very frequent are dealt to SALTS tasks throughout.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, WordHash, drop_table, hidden, merged, shingles, trim, with_ids, words_of, write_table

SLOTS = 1 << 20  # of the count sketch
BLOCKS = 16  # it travels in pieces of SLOTS / BLOCKS counts
FAN_IN = 16  # sketches merged by one task
BITS = 2048  # of the parity bitmap
MARKS = 8  # words of 64 bits that it is folded to
MAX_MATCH = 4
MOST_END = (1 << 28) - 1
FEW = 0.5  # rounds of testing each class against one leader end at this many pairs across components a posting,
WORTH = 50  # or when less than one test in WORTH links
LIST = 64
SALTS = 16
SPREAD = 4  # tasks that meet the classes of one such shingle
SALT_FROM = 2048  # documents more than usual in a slot: its shingles are dealt to SALTS tasks
SIZE_STEP = 1.05  # ratio of the sizes that one bucket of sizes spans
REMEMBERED = 2_000_000  # shingles of texts that a testing task keeps at hand
NUM, DEN = 80, 100  # the threshold, 0.8

_SIG = "doc_id long, text_hash long, n long, digest binary, parity binary, block int, node int, counts binary"


def shingle_set(text: str | None, cache: WordHash) -> np.ndarray:
    return np.unique(shingles(cache.all(words_of(text))))


def _slots(s: np.ndarray) -> np.ndarray:
    return (s & np.uint64(SLOTS - 1)).astype(np.int64)


def _parity(s: np.ndarray) -> bytes:
    bins = np.bincount((s >> np.uint64(40)).astype(np.int64) % BITS, minlength=BITS)
    return np.packbits((bins & 1).astype(np.uint8)).tobytes()


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _signatures(batches):
    """A row per document, and at the end the partition's part of the count sketch."""
    from pyspark import TaskContext

    trim()
    cache, seen, counts, waiting, held = WordHash(), set(), np.zeros(SLOTS, np.int64), [], 0
    types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.binary())
    schema = pa.schema(list(zip((f.split()[0] for f in _SIG.split(", ")), types)))
    for batch in batches:
        ns, digests, parities = [], [], []
        for text in batch.column("text"):
            s = shingle_set(text.as_py(), cache)
            ns.append(len(s))
            digests.append(_digest(s) if len(s) else None)
            parities.append(_parity(s) if len(s) else None)
            if len(s) and digests[-1] not in seen:
                seen.add(digests[-1])
                waiting.append(_slots(s))
                held += len(s)
            if held > SLOTS:
                counts += np.bincount(np.concatenate(waiting), minlength=SLOTS)
                waiting, held = [], 0
        none = [None] * len(ns)
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((batch.column("doc_id"), batch.column("text_hash"), ns, digests, parities, none, none, none), types)], schema=schema)
    if waiting:
        counts += np.bincount(np.concatenate(waiting), minlength=SLOTS)
    node = TaskContext.get().partitionId()
    none = [None] * BLOCKS
    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((none, none, none, none, none, range(BLOCKS), [node] * BLOCKS, [_pack(x) for x in np.split(counts, BLOCKS)]), types)], schema=schema)


def _pack(x: np.ndarray) -> bytes:
    import zlib

    return zlib.compress(x.astype(np.int64).tobytes(), 1)


def _unpack(x: bytes) -> np.ndarray:
    import zlib

    return np.frombuffer(zlib.decompress(x), np.int64)


def _add_up(pdf):
    import pandas as pd

    return pd.DataFrame({"block": [pdf["block"].iloc[0]], "node": [pdf["node"].iloc[0]], "counts": [_pack(sum(map(_unpack, pdf["counts"])))]}).astype({"block": "int32", "node": "int32"})


def _sketch(sig: DataFrame) -> np.ndarray:
    """Adds the partitions' counts up in a tree; what reaches the driver has SLOTS counts, whatever the corpus."""
    part = sig.where("block is not null").select("block", "node", "counts")
    most = part.agg(F.max("node")).first()[0] or 0
    while most > 0:
        part = part.withColumn("node", F.expr(f"cast(node div {FAN_IN} as int)")).groupBy("block", "node").applyInPandas(_add_up, "block int, node int, counts binary")
        most //= FAN_IN
    rows = {r["block"]: _unpack(r["counts"]) for r in part.collect()}
    return np.concatenate([rows[b] for b in range(BLOCKS)]) if rows else np.zeros(SLOTS, np.int64)


def class_id(digest: bytes, at: int) -> int:
    return int.from_bytes(digest[at : at + 8], "big", signed=True)


def prefix(n: int, est: np.ndarray) -> tuple[int, int]:
    """(k, length) of the cheapest prefix. est: how many more documents than chance hold each shingle, rare first."""
    need = -(-NUM * n // DEN)
    best = None
    for k in range(1, min(MAX_MATCH, need) + 1):
        length = n - need + k
        shared = float(est[:length].sum())
        cost = length + shared + shared / k * (1 + n / 64)
        if best is None or cost < best[0]:
            best = cost, k, length
    return best[1], best[2]


def _salt(slots: np.ndarray, count: np.ndarray, usual: float, cls: int) -> np.ndarray:
    """0, or for shingles of very full slots one of 1..SALTS by class."""
    return np.where(count[slots] >= usual + SALT_FROM, cls % SALTS + 1, 0).astype(np.int32)


def _postings(counts, at: int):
    def run(batches):
        trim()
        cache, seen, count = WordHash(), set(), counts.value
        usual = float(np.median(count))
        for batch in batches:
            tokens, ids, metas, salts = [], [], [], []
            for text in batch.column("text"):
                s = shingle_set(text.as_py(), cache)
                if not len(s) or (d := _digest(s)) in seen:
                    continue
                seen.add(d)
                c = count[_slots(s)]
                order = np.lexsort((s, c))
                k, length = prefix(len(s), np.maximum(c[order] - usual, 0))
                first, cls = s[order[:length]], class_id(d, at)
                tokens.append(first)
                salts.append(_salt(_slots(first), count, usual, cls))
                ids.append(np.full(length, cls, np.int64))
                end = min(int(c[order[length - 1]]), MOST_END)
                metas.append(np.full(length, end << 35 | len(s) << 3 | k, np.int64))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(ids)), pa.array(np.concatenate(metas)), pa.array(np.concatenate(salts))], names=["token", "cls", "meta", "salt"])

    return run


def _whole_sets(counts):
    """All shingles of the texts of classes: token, cls, label, n, salt."""

    def run(batches):
        cache, count = WordHash(), counts.value
        usual = float(np.median(count))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows: list[list] = [[], [], [], [], []]
                for text, cls, label in zip(part.column("text"), part.column("cls").to_pylist(), part.column("label").to_pylist()):
                    s = shingle_set(text.as_py(), cache)
                    for column, v in zip(rows, (s.view(np.int64), np.full(len(s), cls, np.int64), np.full(len(s), label, np.int64), np.full(len(s), len(s), np.int64), _salt(_slots(s), count, usual, cls))):
                        column.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in rows], names=["token", "cls", "label", "n", "salt"])

    return run


def _bound(batches):
    """Of pairs, those that the parity bitmaps don't rule out: differing bits are a lower bound of the symmetric difference."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.frombuffer(b"".join(batch.column(x).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for x in ("pa", "pb"))
        differ = np.bitwise_count(a ^ b).sum(1).astype(np.int64)
        total = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
        common = -(-NUM * total // (NUM + DEN))
        yield batch.filter(pa.array(differ <= total - 2 * common)).select(["a", "b"])


def _test(batches):
    """Exact test over both whole texts."""
    cache, known, held = WordHash(), {}, 0
    for batch in batches:
        a, b = [], []
        for x, y, tx, ty in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("ta"), batch.column("tb")):
            if (s := known.get(x)) is None:  # a leader is in many pairs
                if held > REMEMBERED:
                    known.clear()
                    held = 0
                s = known[x] = shingle_set(tx.as_py(), cache)
                held += len(s)
            t = shingle_set(ty.as_py(), cache)
            both = len(np.intersect1d(s, t, assume_unique=True))
            if DEN * both >= NUM * (len(s) + len(t) - both):
                a.append(x)
                b.append(y)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _texts(want: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The rows of want (cls and more) with a text of each class."""
    ids = write_table(want.join(classes.select("cls", "rep", "rep_hash"), "cls").select(F.col("rep").alias("doc_id"), F.col("rep_hash").alias("want_hash"), *want.columns), "jaccard-ids")
    return with_ids(docs, ids, "doc_id").where("text_hash = want_hash").dropDuplicates(["cls"])


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Of pairs (a, b) of classes, the linked ones."""
    side = lambda x: classes.select(F.col("cls").alias(x), F.col("n").alias(f"n{x}"), F.col("parity").alias(f"p{x}"))
    near = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").where(f"{DEN} * least(na, nb) >= {NUM} * greatest(na, nb)")
    near = write_table(near.mapInArrow(_bound, "a long, b long"), "jaccard-near")
    want = near.select(F.col("a").alias("cls")).union(near.select("b")).distinct()
    texts = _texts(want, classes, docs)
    text = lambda x: texts.select(F.col("cls").alias(x), F.col("text").alias(f"t{x}"))
    links = write_table(near.join(text("a"), "a").join(text("b"), "b").select("a", "b", "ta", "tb").mapInArrow(_test, "a long, b long"), "jaccard-links")
    drop_table(near)
    return links


def _possible(a: str, b: str) -> str:
    """SQL: two sets can be linked, by the cap of the one whose prefix ends first (the larger cap if that can't be told)."""
    cap = f"case when {a}end < {b}end then {a}cap when {b}end < {a}end then {b}cap else greatest({a}cap, {b}cap) end"
    return f"{DEN} * least({a}n, {b}n) >= {NUM} * greatest({a}n, {b}n) and ({NUM} + {DEN}) * {cap} >= {NUM} * ({a}n + {b}n)"


def _labelled(multi: DataFrame, roots: DataFrame | None) -> DataFrame:
    """multi with the component that each class is in so far."""
    if roots is None:
        return multi.withColumn("label", F.col("cls"))
    return multi.join(roots.select(F.col("node").alias("cls"), F.col("root").alias("label")), "cls", "left").withColumn("label", F.coalesce("label", "cls"))


def _stars(told: DataFrame) -> DataFrame:
    """a, b: each class and the leader it is tested against. A list dealt to several tasks has a leader in each, and these meet the first of them."""
    part = Window.partitionBy("token", "salt")
    lead = F.struct(F.expr("cap / n").alias("share"), "cls", "label", "n", "cap", "end")
    led = told.withColumn("lead", F.max(lead).over(part)).where("lead.label != label").where(_possible("", "lead.")).groupBy("cls", F.col("lead.cls").alias("lead")).count()
    own = led.groupBy("cls").agg(F.max(F.struct("count", "lead")).alias("m")).select(F.col("m.lead").alias("a"), F.col("cls").alias("b"))
    parts = told.where("salt > 0").groupBy("token", "salt").agg(F.max(lead).alias("lead"))
    tops = parts.groupBy("token").agg(F.max("lead").alias("top"), F.collect_list("lead").alias("leads")).select("top", F.explode("leads").alias("lead")).where("top.label != lead.label").where(_possible("top.", "lead."))
    return own.union(tops.select(F.col("top.cls").alias("a"), F.col("lead.cls").alias("b"))).distinct()


def _across(hot: DataFrame, classes: DataFrame, docs: DataFrame, counts) -> DataFrame:
    """a, b: pairs across components of the classes of hot (cls, label), by prefixes in the exact order among them."""
    full = _texts(hot, classes, docs).select("text", "cls", "label").mapInArrow(_whole_sets(counts), "token long, cls long, label long, n long, salt int")
    full = write_table(full, "jaccard-whole")
    held = full.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("df"), F.max("salt").alias("salted")).where("lo < hi")
    salts = F.explode(F.expr(f"case when salted > 0 then sequence(1, {SALTS}) else array(0) end")).alias("salt")
    shared = full.join(held.select("token", "df", salts), ["token", "salt"])
    by_class = Window.partitionBy("cls")
    shared = shared.withColumn("cap", F.count("*").over(by_class)).withColumn("place", F.row_number().over(by_class.orderBy("df", "token")))
    need = F.ceil(F.col("n") * NUM / DEN)
    first = shared.where(F.col("place") <= F.col("cap") - need + 1)
    # the largest set that the class can be linked with if this is the first shingle in order that both hold, as then only it and what follows can be shared
    most = F.expr(f"floor((cap - place + 1) * {NUM + DEN} / {NUM}) - n")
    word = lambda k: f"cast(conv(hex(substring(parity, {8 * k + 1}, 8)), 16, -10) as long)"
    marks = classes.join(hot.select("cls"), "cls").select("cls", *(F.expr(" ^ ".join(word(k) for k in range(m, BITS // 64, MARKS))).alias(f"m{m}") for m in range(MARKS)))
    first = first.withColumn("most", most).select("token", "salt", "cls", "label", "n", "most").join(marks, "cls")
    first = write_table(first, "jaccard-first")
    out = write_table(_meets(first).select(F.expr("least(x.cls, y.cls)").alias("a"), F.expr("greatest(x.cls, y.cls)").alias("b")).distinct(), "jaccard-across")
    drop_table(full)
    drop_table(first)
    return out


def _meets(first: DataFrame) -> DataFrame:
    """Rows x and y of prefixes that meet: of one shingle, and of classes of different components that it can be the first common shingle of. A pair that can be linked meets at its first common shingle, and at few others."""
    bucket = lambda n: f"cast(floor(ln({n}) / {math.log(SIZE_STEP)!r}) as int)"
    differ = " + ".join(f"bit_count(x.m{m} ^ y.m{m})" for m in range(MARKS))
    least = f"greatest(1, floor(n * {NUM} / {DEN}))"
    x = first.where(f"most >= {least}").withColumn("salt", F.expr(f"salt % {SPREAD}")).withColumn("bucket", F.explode(F.expr(f"sequence({bucket(least)}, greatest({bucket(least)}, {bucket(f'least(most, ceil(n * {DEN} / {NUM}))')}))"))).alias("x")
    y = first.withColumn("salt", F.explode(F.expr(f"case when salt > 0 then sequence(0, {SPREAD - 1}) else array(0) end"))).withColumn("bucket", F.expr(bucket("n"))).alias("y")
    return x.join(y, F.expr(f"x.token = y.token and x.salt = y.salt and x.bucket = y.bucket and x.label != y.label and (x.most < y.most or x.most = y.most and x.cls < y.cls) and y.n <= x.most and x.n <= y.most and {differ} <= x.n + y.n - 2 * ceil({NUM} * (x.n + y.n) / {NUM + DEN})"))


def jaccard_components(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, n_copies (documents with the very same set, itself included), text_hash (xxhash64 of the row's text) and group (of all rows of a component the same, of others another; null without one), a row for each row.

    component_id is the smallest doc_id reachable by links of Jaccard similarity 0.8 or more over
    distinct five-word shingles. Texts without words (null, empty, blank) have an empty set and
    stand alone. Texts of fewer than five words have one shingle, the whole sequence. Rows with a
    null doc_id get a null component_id and link with nothing. Repeated rows are documents of their
    own with the same id, whether their texts are equal or not. An empty table gives an empty
    result; further columns are ignored.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    sig = write_table(docs.mapInArrow(_signatures, _SIG), "jaccard-sig")
    of_docs = sig.where("block is null").select("doc_id", "text_hash", "n", "digest", "parity")
    by_set = of_docs.where("n > 0 and doc_id is not null").groupBy("digest").agg(F.min(F.struct("doc_id", "text_hash")).alias("r"), F.first("n").alias("n"), F.first("parity").alias("parity"), F.count("*").alias("n_copies"))
    at = 0
    while True:  # class ids are 8 of the digest's 16 bytes; in the unlikely case that two digests share them, the next 8
        cls = F.conv(F.hex(F.substring("digest", at + 1, 8)), 16, -10).cast("long")
        classes = write_table(by_set.select(cls.alias("cls"), F.col("r.doc_id").alias("rep"), F.col("r.text_hash").alias("rep_hash"), "n", "parity", "n_copies"), "jaccard-classes")
        if at == 8 or classes.groupBy("cls").count().where("count > 1").isEmpty():
            break
        drop_table(classes)
        at += 1
    counts = spark.sparkContext.broadcast(np.minimum(_sketch(sig), MOST_END).astype(np.int32))
    posts = docs.where("doc_id is not null").mapInArrow(_postings(counts, at), "token long, cls long, meta long, salt int")
    part = Window.partitionBy("token", "salt")
    shared = posts.withColumn("lo", F.min("cls").over(part)).withColumn("hi", F.max("cls").over(part)).where("lo < hi or salt > 0").select("token", "salt", "cls", "meta").dropDuplicates(["token", "cls"])
    # of two prefixes, what the one that ends first in the order has and the other hasn't is in one set alone: cap
    n, k, end = F.expr(f"shiftright(meta, 3) & {(1 << 32) - 1}"), F.expr("meta & 7"), F.expr("shiftright(meta, 35)")
    bare = n - (n - F.ceil(n * NUM / DEN) + k) + F.count("*").over(Window.partitionBy("cls"))
    multi = write_table(shared.select("token", "salt", "cls", n.alias("n"), k.alias("k"), end.alias("end"), bare.cast("long").alias("cap")), "jaccard-multi")
    links, roots = [], None
    while True:
        star = write_table(_stars(_labelled(multi, roots)), "jaccard-star")
        links.append(_verified(star, classes, docs))
        roots = merged(roots, links[-1], "jaccard-cc")
        tried, made = star.count(), links[-1].count()
        drop_table(star)
        sizes = _labelled(multi, roots).groupBy("token", "label").count().groupBy("token").agg(F.sum("count").alias("s"), F.sum(F.expr("count * count")).alias("q"))
        rows, pairs = sizes.agg(F.sum("s"), F.sum((F.col("s") * F.col("s") - F.col("q")) / 2)).first()
        if not made or made * WORTH < tried or pairs <= rows * FEW:
            break
    told = _labelled(multi, roots)
    few = told.where("salt = 0").withColumn("lo", F.min("label").over(part)).withColumn("hi", F.max("label").over(part)).withColumn("size", F.count("*").over(part)).where("lo < hi").drop("lo", "hi")
    often = told.where("salt > 0").groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("token", F.explode(F.sequence(F.lit(1), F.lit(SALTS))).alias("salt"))
    many = told.where("salt > 0").join(often, ["token", "salt"], "left_semi").withColumn("size", F.lit(None).cast("long"))
    told = write_table(few.unionByName(many), "jaccard-told")
    x, y = (told.where(f"size <= {LIST}").alias(side) for side in "xy")
    met = x.join(y, F.expr(f"x.token = y.token and x.cls < y.cls and x.label != y.label and {_possible('x.', 'y.')}"))
    pairs = met.groupBy(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).agg(F.count("*").alias("shared"), F.min(F.expr("least(x.k, y.k)")).alias("k")).where("shared >= k").select("a", "b")
    hot = write_table(told.where(f"size > {LIST} or size is null").select("cls", "label").distinct(), "jaccard-hot")
    across = _across(hot, classes, docs, counts)
    roots = merged(roots, _verified(pairs.union(across).distinct(), classes, docs), "jaccard-cc")
    for t in (multi, told, hot, across, *links):
        drop_table(t)
    first = roots.select(F.col("node").alias("cls"), F.col("root").alias("top"))
    classed = classes.select("cls", "rep", "n_copies").join(first, "cls", "left").withColumn("top", F.coalesce("top", "cls"))
    least = classed.groupBy("top").agg(F.min("rep").alias("component"))
    classed = classed.join(least, "top").select("cls", "n_copies", "component", F.col("top").alias("group"))
    out = of_docs.withColumn("cls", F.when(F.col("doc_id").isNotNull(), cls)).join(classed, "cls", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", F.when(F.col("n") == 0, F.col("doc_id"))).alias("component_id"), F.coalesce("n_copies", F.lit(1).cast("long")).alias("n_copies"), "text_hash", "group")


def one_of_each(documents: DataFrame) -> DataFrame:
    """documents with one row of each component: that of smallest doc_id, of several texts with that id the one of smallest hash; of repeated rows one.

    Rows without words and rows with a null doc_id stay, all of them. Columns are kept as they are.
    """
    found = write_table(jaccard_components(documents).where("n_shingles > 0 and doc_id is not null").select("doc_id", "text_hash", "component_id", "group"), "jaccard-found")
    first = found.where("doc_id = component_id").groupBy("doc_id", "group").agg(F.min("text_hash").alias("first"))
    rows = found.groupBy("doc_id", "text_hash", "component_id", "group").agg(F.count("*").alias("rows"))
    rows = rows.join(first, ["doc_id", "group"], "left").select(F.col("doc_id").alias("of_doc"), F.col("text_hash").alias("of_text"), (F.col("doc_id").eqNullSafe(F.col("component_id")) & F.col("text_hash").eqNullSafe(F.col("first"))).alias("kept"), "rows")
    told = write_table(rows.where("not kept or rows > 1"), "jaccard-told")  # what goes, and what repeats
    docs, back = hidden(documents, "of_doc", "of_text", "kept", "rows")
    narrow = F.broadcast(told) if told.count() <= BROADCAST_IDS else told
    met = docs.join(narrow, (F.col("doc_id").cast("long") == F.col("of_doc")) & (F.xxhash64(F.col("text").cast("string")) == F.col("of_text")), "left")
    repeats = met.where("kept").dropDuplicates(["of_doc", "of_text"])
    return met.where("of_doc is null").select(*back).union(repeats.select(*back))
