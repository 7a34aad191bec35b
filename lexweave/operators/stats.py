"""Statistics, rankings and samples (the H operators) over any DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.functions import text as T


#: A set of keys up to this many may be broadcast.
MOST_BROADCAST = 100_000


def distribution(df: DataFrame, by: list[str], value: str, count: str, more: dict[str, Column] | None = None) -> DataFrame:
    """H8: mean and inclusive quantiles of a value, rounded to six places."""
    q = F.percentile(value, F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    out = df.groupBy(*by).agg(F.count("*").alias(count), *(c.alias(n) for n, c in (more or {}).items()), F.round(F.avg(value), 6).alias("mean"), q.alias("q"))
    return out.select("*", *(F.round(F.col("q")[i], 6).alias(n) for i, n in enumerate(("p10", "p50", "p90")))).drop("q")


def shares(df: DataFrame, within: list[str], by: list[str], count: str) -> DataFrame:
    """Counts by (within, by) and their share within each `within`."""
    c = df.groupBy(*within, *by).agg(F.count("*").alias(count))
    return c.withColumn("share", F.round(F.col(count) / F.sum(count).over(Window.partitionBy(*within)), 6))


def duplicate_groups(df: DataFrame, key: str, order: str) -> DataFrame:
    """Groups of equal keys; partial sums by 256-bit digest, so the keys stay where they are."""
    d = df.select(F.sha2(F.col(key).cast("binary"), 256).alias("d"), F.md5(F.col(key).cast("binary")).alias("key"), order)
    return d.groupBy("d", "key").agg(F.count("*").alias("copies"), F.min(order).alias("first_doc")).where("copies > 1").drop("d")


def over_threshold(words: DataFrame, keys: Column, name: str, bar: float, least: int, hashes: Column | None = None) -> DataFrame:
    """H5: document frequencies over rows; keys with `least` rows or more and a share above `bar`.

    With hashes (of each row's keys, in 64 bits) only they are counted first, and texts are made and
    counted for rows that hold a frequent one alone.
    """
    total = words.agg(F.count("*").alias("total"))
    if hashes is not None:
        often = words.select(F.explode(hashes).alias("h")).groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= least).join(F.broadcast(total)).where(F.col("n") / F.col("total") > bar).select("h")
        few = F.broadcast(often.agg(F.collect_set("h").alias("often"))) if often.count() <= MOST_BROADCAST else None
        if few is not None:  # the frequent ones, as a set of bounded size
            words = words.join(few).where(F.arrays_overlap(hashes, F.col("often"))).drop("often")
    df = words.select(F.explode(keys).alias(name)).groupBy(name).agg(F.count("*").alias("sentences")).where(F.col("sentences") >= least)
    share = F.col("sentences") / F.col("total")
    return df.join(F.broadcast(total)).where(share > bar).select(name, "sentences", F.round(share, 8).alias("frequency"))  # the broadcast side is one row


def offenders(words: DataFrame, keys: Column, name: str, over: DataFrame, doc: str) -> DataFrame:
    """H6: documents that show a key of `over`, counted, the first three named. Counts and the three come from partial sums and minima, so a key that every document shows is no hot task."""
    hits = words.select(doc, F.explode(keys).alias(name)).join(over.select(name), name).select(name, doc).distinct()
    parts = hits.withColumn("part", F.pmod(F.xxhash64(doc), F.lit(64))).groupBy(name, "part").agg(F.count("*").alias("n"), F.slice(F.array_sort(F.collect_list(doc)), 1, 3).alias("first"))
    all_ = parts.groupBy(name).agg(F.sum("n").alias("docs"), F.slice(F.array_sort(F.flatten(F.collect_list("first"))), 1, 3).alias("x"))
    return all_.select(name, "docs", F.expr("array_join(transform(x, y -> cast(y as string)), ',')").alias("examples"))


def calibrate(words: DataFrame, keys: Column, doc: str, points: list[tuple[float, int]], docs: int) -> DataFrame:
    """H9: the share of documents flagged at each (bar, least), from one count."""
    total = words.count()
    grams = words.select(doc, F.explode(keys).alias("g"))
    counts = grams.groupBy("g").agg(F.count("*").alias("c")).where(F.col("c") >= min(n for _, n in points))
    at = F.array(*(F.struct(F.lit(b).alias("bar"), F.lit(n).alias("least")) for b, n in points))
    over = counts.select("g", "c", F.explode(at).alias("p")).where((F.col("c") >= F.col("p.least")) & (F.col("c") / total > F.col("p.bar"))).select("g", "p.bar", "p.least")
    hit = grams.join(over, "g").groupBy("bar", "least").agg(F.count_distinct(doc).alias("docs"))
    return hit.withColumn("share", F.round(F.col("docs") / docs, 6))


def token_types(words: DataFrame, by: list[str], word: str) -> DataFrame:
    """Tokens and types; counted per word first, so a frequent word is one row before the second sum."""
    return words.groupBy(*by, word).agg(F.count("*").alias("c")).groupBy(*by).agg(F.sum("c").alias("words"), F.count("*").alias("types"))


def distinct_rates(grams: DataFrame, by: str, n: str, gram: str) -> DataFrame:
    """Grams and distinct grams of each (by, n), and pooled (by null)."""
    each = grams.groupBy(by, n, gram).agg(F.count("*").alias("c"))
    own = each.groupBy(by, n).agg(F.sum("c").alias("grams"), F.count("*").alias("distinct_grams"))
    pooled = each.groupBy(n, gram).agg(F.sum("c").alias("c")).groupBy(n).agg(F.sum("c").alias("grams"), F.count("*").alias("distinct_grams"))
    out = own.unionByName(pooled.withColumn(by, F.lit(None).cast("string")))
    return out.withColumn("rate", F.round(F.col("distinct_grams") / F.col("grams"), 6))


def entropy(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """-sum p log2 p of the values' shares."""
    c = df.groupBy(*by, value).agg(F.count("*").alias("c"))
    p = c.withColumn("p", F.col("c") / F.sum("c").over(Window.partitionBy(*by)))
    return p.groupBy(*by).agg(F.count("*").alias("values"), F.round(-F.sum(F.col("p") * F.log2("p")), 6).alias("bits"))


def mutual_information(df: DataFrame, left: str, right: str) -> DataFrame:
    """I(L;R), both entropies and I over the smaller one, in bits. The joint counts are small whatever the rows."""
    j = df.groupBy(F.col(left).alias("l"), F.col(right).alias("r")).agg(F.count("*").alias("c"))
    n = j.agg(F.sum("c").alias("n"))
    p = j.join(F.broadcast(n)).withColumns({"cl": F.sum("c").over(Window.partitionBy("l")), "cr": F.sum("c").over(Window.partitionBy("r"))})
    bits = F.sum(F.col("c") / F.col("n") * F.log2(F.col("c") * F.col("n") / (F.col("cl") * F.col("cr"))))
    side = lambda x: F.sum(-F.col("c") / F.col("n") * F.log2(F.col(x) / F.col("n")))
    m = p.agg(bits.alias("b"), side("cl").alias("hl"), side("cr").alias("hr"))
    return m.select(F.round("b", 6).alias("bits"), F.round("hl", 6).alias("left_bits"), F.round("hr", 6).alias("right_bits"), F.round(F.col("b") / F.least("hl", "hr"), 6).alias("normalized"))


def _with_ranks(counts: DataFrame, value: str) -> DataFrame:
    """Values with how many keys have them and how many keys have less: ranks without one global sort of keys."""
    v = counts.groupBy(value).agg(F.count("*").alias("k"))  # distinct counts are few
    return v.withColumn("before", F.coalesce(F.sum("k").over(Window.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def gini(counts: DataFrame, value: str) -> DataFrame:
    """Sum (2 i - n - 1) x / (n sum x) over ascending x; 0 if all are 0. Ties share a value, so ranks come from the value histogram."""
    v = _with_ranks(counts, value)
    n, x, k, b = F.sum("k").over(Window.partitionBy()), F.col(value), F.col("k"), F.col("before")
    t = v.withColumn("n", n).withColumn("part", x * (2 * (b * k + k * (k + 1) / 2) - k * (F.col("n") + 1)))
    return t.agg(F.round(F.when(F.sum(x * k) == 0, 0.0).otherwise(F.sum("part") / (F.max("n") * F.sum(x * k))), 6).alias("gini"))


def top_share(df: DataFrame, key: str, part: int) -> DataFrame:
    """Uses of the most used 1/part of keys (one at least), from the histogram of uses."""
    v = df.groupBy(key).agg(F.count("*").alias("x")).groupBy("x").agg(F.count("*").alias("k"))
    down = Window.orderBy(F.desc("x"))
    v = v.withColumns({"before": F.coalesce(F.sum("k").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "n": F.sum("k").over(Window.partitionBy())})
    top = F.greatest(F.lit(1), F.expr(f"n div {part}"))
    taken = F.greatest(F.lit(0), F.least(F.col("k"), top - F.col("before")))
    out = v.agg(F.max("n").alias("keys"), F.sum(taken * F.col("x")).cast("long").alias("top_uses"), F.sum(F.col("k") * F.col("x")).alias("all"))
    return out.select("keys", "top_uses", F.round(F.col("top_uses") / F.col("all"), 6).alias("top_share"))


def length_bands(df: DataFrame, by: list[str], n: str, bands: tuple[int, ...], context: int) -> DataFrame:
    """Shares over each band; what a context keeps; full and partial windows."""
    over = [F.round(F.avg((F.col(n) > b).cast("int")), 6).alias(f"over_{b}") for b in bands]
    return df.groupBy(*by).agg(F.count("*").alias("docs"), *over, F.sum(F.least(F.col(n), F.lit(context))).cast("long").alias(f"kept_{context}"), F.sum(F.ceil(F.col(n) / context)).cast("long").alias(f"windows_{context}"))


def bottom_k(df: DataFrame, key: str, first: str, k: int) -> DataFrame:
    """The k distinct keys of smallest value, each with its smallest row."""
    return df.groupBy(key).agg(F.min(first).alias(first)).orderBy(key, first).limit(k).select(first, key)


def drawn(key: str, seed: int) -> Column:
    """The order of a keyed draw, the same in every engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))


def sample_per_group(df: DataFrame, group: str, key: str, n: int, seed: int) -> DataFrame:
    """G5 in hash mode: n rows of each group by keyed hash."""
    pick = F.row_number().over(Window.partitionBy(group).orderBy(drawn(key, seed), key))
    return df.withColumn("pick", pick.cast("int")).where(F.col("pick") <= n)


def stratified(df: DataFrame, stratum: str, key: str, total: int, seed: int) -> DataFrame:
    """Total rows, by largest remainder with one a stratum at least; strata are few, rows are drawn by hash."""
    c = df.groupBy(stratum).agg(F.count("*").alias("n"))
    share = F.col("n") * total / F.sum("n").over(Window.partitionBy())
    q = c.select(stratum, F.greatest(F.lit(1), F.floor(share)).alias("base"), (share - F.floor(share)).alias("rest"))
    more = F.row_number().over(Window.orderBy(F.desc("rest"), stratum)) <= total - F.sum("base").over(Window.partitionBy())
    quota = q.select(F.col(stratum), (F.col("base") + more.cast("int")).alias("quota"))
    pick = F.row_number().over(Window.partitionBy(stratum).orderBy(drawn(key, seed), key))
    return df.withColumn("pick", pick).join(F.broadcast(quota), stratum).where("pick <= quota").select(key, stratum)  # a row a stratum


def verbatim_reuse(lines: DataFrame, known: DataFrame, doc: str, key: Column, least: int) -> DataFrame:
    """Lines of each document, those that `known` holds, and characters."""
    keys = known.where(F.length("line") >= least).select(F.sha2(key.cast("binary"), 256).alias("k")).distinct().withColumn("hit", F.lit(1))
    mine = lines.select(doc, F.sha2(key.cast("binary"), 256).alias("k"), F.length("line").alias("n"))
    return mine.join(keys, "k", "left").groupBy(doc).agg(F.count("*").alias("lines"), F.count("hit").alias("reused"), F.sum("n").cast("long").alias("chars"))


def query_sieve(df: DataFrame, group: str, order: str, text: str, most_words: int, most: int) -> DataFrame:
    """Empty, too long, empty key, duplicate, then surplus over `most` accepted ones of a group in order."""
    key = df.withColumn("key", T.query_key(text)).withColumn("n", T.word_count(text))
    nth = F.row_number().over(Window.partitionBy(group, "key").orderBy(order))
    s = key.withColumn("verdict", F.when(F.col("n") == 0, "empty").when(F.col("n") > most_words, "too_long").when(F.col("key") == "", "empty_key").when(nth > 1, "duplicate").otherwise("accepted"))
    taken = F.count_if(F.col("verdict") == "accepted").over(Window.partitionBy(group).orderBy(order))
    return s.withColumn("reason", F.when((F.col("verdict") == "accepted") & (taken > most), "surplus").otherwise(F.col("verdict")))


def gate(df: DataFrame, key: str, order: str, by: str, least: int) -> DataFrame:
    """Later rows of a key and short rows, counted; the first row of a key comes from a partial minimum, not a sort of the group."""
    per = df.groupBy(by, key).agg(F.count("*").alias("docs"), F.count_if(F.col("n") < least).alias("short"), F.min(order).alias("low"))
    low = per.groupBy(key).agg(F.min("low").alias("first"))
    joined = per.join(low, key)
    return joined.groupBy(by).agg(F.sum("docs").alias("docs"), F.sum(F.col("docs") - (F.col("low") == F.col("first")).cast("int")).cast("long").alias("duplicates"), F.sum("short").cast("long").alias("short"))
