"""Projections, constraint checks, rankings and supervision mining over a lexicon (operators D, E, G, H)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.functions import text as T
from lexweave.operators.stats import drawn

# Words that neither open nor close a multiword headword.
FUNCTION_WORDS = ("a", "an", "the", "of", "in", "on", "to", "for", "with", "and", "or", "by", "at")


def nested(senses: DataFrame) -> DataFrame:
    """One row per lexeme with its live senses in order, and counts."""
    live = F.col("retired") == False  # noqa: E712
    out = senses.groupBy("lexeme_id", "headword").agg(
        F.array_sort(F.collect_list(F.when(live, F.struct("sense_index", "sense_id", "domain", "gloss")))).alias("senses"),
        F.count_if(live).alias("n_live"), F.count_if(~live).alias("n_retired"),
    )
    return out


def flat(entries: DataFrame) -> DataFrame:
    """The rows of nested() back."""
    return entries.select("lexeme_id", F.explode("senses").alias("s")).select("lexeme_id", "s.*")


def inflections(words: DataFrame, word: str) -> DataFrame:
    """Form, relation and lemma rows of headwords; distinct on (form, relation), the smallest lemma of each."""
    f = T.forms(word)
    rows = words.select(F.col(word).alias("lemma"), F.explode(F.array(F.struct(F.col(word).alias("form"), F.lit("lemma").alias("relation")), *(F.struct(F.get(f, F.lit(i)).alias("form"), F.lit(r).alias("relation")) for i, r in enumerate(("plural", "past", "present_participle"))))).alias("x"))
    return rows.select("lemma", "x.form", "x.relation").where("form is not null").groupBy("form", "relation").agg(F.min("lemma").alias("lemma")).select("lemma", "form", "relation")


def edge_id(source: str, kind: str, target: str) -> Column:
    """A2: 'source-kind->target'."""
    return F.concat(F.col(source), F.lit("-"), F.col(kind), F.lit("->"), F.col(target))


def parsed_edge(edge: str, kinds: list[str]) -> list[Column]:
    """Source, type and shown target of an edge id; longer type names are tried first, so hyphens in heads survive."""
    pattern = f"^(.*)-({'|'.join(sorted(kinds, key=lambda k: (-len(k), k)))})->([^>]*)$"
    part = lambda i: F.regexp_extract(edge, pattern, i)
    return [part(1).alias("source"), part(2).alias("kind"), F.regexp_replace(part(3), "_", " ").alias("target")]


def kind_of(head: str) -> Column:
    """B31 without prose evidence: affix, abbreviation, function word, proper, undecided (multiword), compound, simplex."""
    h = F.col(head)
    return (
        F.when(h.rlike("^-|-$"), "affix").when(h.rlike("^[A-Z]{2,3}$"), "abbreviation").when(F.lower(h).isin(*FUNCTION_WORDS), "function_word")
        .when(h.rlike("^[A-Z]"), "proper").when(h.rlike(r"\s"), "undecided").when(h.contains("-"), "compound").otherwise("simplex")
    )


def fragment_reason(head: str) -> Column:
    """Why a multiword head is a fragment: it opens or closes with a function word."""
    words = F.split(F.lower(head), " ")
    return F.when(F.size(words) < 2, None).when(words[0].isin(*FUNCTION_WORDS), "opens").when(F.element_at(words, -1).isin(*FUNCTION_WORDS), "closes")


def average_ranks(df: DataFrame, value: str, name: str) -> DataFrame:
    """Average-method percentile rank of a value, largest first, null: 1. Ranks come from the value's histogram, so no task sorts all rows."""
    n = df.where(F.col(value).isNotNull()).agg(F.count("*").alias("_n"))
    h = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("_v")).agg(F.count("*").alias("_k"))
    before = F.coalesce(F.sum("_k").over(Window.orderBy(F.desc("_v")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = h.withColumn("_b", before).join(F.broadcast(n)).select("_v", ((F.col("_b") + (F.col("_k") + 1) / 2) / F.col("_n")).alias("_r"))
    return df.join(ranks, F.col(value) == F.col("_v"), "left").withColumn(name, F.coalesce("_r", F.lit(1.0))).drop("_v", "_r")


def quota_top(df: DataFrame, kind: str, order: list, quota: int, size: int) -> DataFrame:
    """`size` rows by order, no kind over its quota; if too few are left, the overflow fills up in order."""
    nth = F.row_number().over(Window.partitionBy(kind).orderBy(*order))
    ranked = df.withColumn("over", (nth > quota).cast("int"))
    return ranked.orderBy("over", *order).limit(size)


def easy_negatives(senses: DataFrame, n: int, seed: int) -> DataFrame:
    """N live senses of other lexemes for each live sense, within its domain.

    Senses of a domain stand in a ring by keyed hash; each takes the next ones on it. The ring is
    dense, so the draw is a join on ranks; the own lexeme is skipped over.
    """
    ring = senses.where("not retired").select("sense_id", "lexeme_id", "domain").withColumn("at", F.row_number().over(Window.partitionBy("domain").orderBy(drawn("sense_id", seed), "sense_id")) - 1)
    ring = ring.withColumn("size", F.count("*").over(Window.partitionBy("domain")))
    ask = ring.select("sense_id", "lexeme_id", "domain", F.explode(F.expr(f"transform(sequence(1, {2 * n}), k -> pmod(at + k, size))")).alias("at"), F.col("at").alias("own"), "size").where("at != own")
    other = ring.select("domain", "at", F.col("sense_id").alias("negative_id"), F.col("lexeme_id").alias("negative_lexeme"))
    met = ask.join(other, ["domain", "at"]).where("lexeme_id != negative_lexeme").dropDuplicates(["sense_id", "negative_id"])
    nth = F.row_number().over(Window.partitionBy("sense_id").orderBy(F.expr("pmod(at - own, size)")))
    return met.withColumn("nth", nth).where(F.col("nth") <= n).select("sense_id", "negative_id", "nth")


def within_group_pairs(df: DataFrame, group: list[str], order: str, key: str) -> DataFrame:
    """Unordered pairs of a (small) group's rows."""
    a = df.select(*group, F.col(order).alias("oa"), F.col(key).alias("a"))
    b = df.select(*group, F.col(order).alias("ob"), F.col(key).alias("b"))
    return a.join(b, group).where("oa < ob").select(*group, "a", "b")


def frontier_reason(head: str) -> Column:
    """Why a candidate headword is refused, first rule first."""
    h = F.trim(F.lower(head))
    words = F.size(F.split(h, r"\s+"))
    return F.when(h == "", "empty").when(F.length(h) < 3, "too_short").when(words > 4, "too_many_words").when(~h.rlike("[a-z]"), "no_letters").when(h.isin(*FUNCTION_WORDS), "function_word").otherwise("accepted")


def batches(df: DataFrame, by: str, order: str, size: int) -> DataFrame:
    """Consecutive batches of `size` rows within each `by`."""
    return df.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(by).orderBy(order)) - 1) / size).cast("long"))
