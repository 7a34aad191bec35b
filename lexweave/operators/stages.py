"""Stages that a model drives, with the model as a parameter: calls in batches, rotation of writers, verdict tables, budgets (operators I). Without a network a deterministic client stands in."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Client = Callable[[str, str | None], str]  # (prompt, feedback on the last answer) -> answer


def echo_client(prompt: str, feedback: str | None) -> str:
    """A client without a model: the prompt's words in reverse, as JSON."""
    return json.dumps({"text": " ".join(reversed(prompt.split()))})


def calls(df: DataFrame, key: str, prompt: str, client: Client, required: tuple[str, ...] = ("text",), attempts: int = 3) -> DataFrame:
    """Key, answer (JSON), attempts, error of a validated call a row. An answer that is no JSON object with the required fields is asked for again with what was wrong; a row whose attempts are used up, or whose client fails, is kept with its error, so no row is lost and none stops the others."""

    def ask(text: str) -> tuple[str | None, int, str | None]:
        feedback = None
        for n in range(1, attempts + 1):
            try:
                answer = client(text, feedback)
                made = json.loads(answer)
                lacks = [f for f in required if not isinstance(made, dict) or f not in made]
                if not lacks:
                    return json.dumps(made, sort_keys=True), n, None
                feedback = f"missing: {', '.join(lacks)}"
            except Exception as e:  # a client's failure is that row's result
                feedback = f"{type(e).__name__}: {e}"
        return None, attempts, feedback

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            got = [ask(p or "") for p in pdf[prompt]]
            yield pd.DataFrame({key: pdf[key], "answer": [g[0] for g in got], "attempts": [g[1] for g in got], "error": [g[2] for g in got]})

    return df.select(key, prompt).mapInPandas(run, f"{key} {dict(df.dtypes)[key]}, answer string, attempts int, error string")


def writer(key: str, writers: list[tuple[str, int]], seed: int) -> Column:
    """A writer by weight, a pure function of the key: a keyed hash on the cumulative weights."""
    total = sum(w for _, w in writers)
    at = F.pmod(F.conv(F.left(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary")), F.lit(12)), 16, 10).cast("long"), F.lit(total))
    out, upto = F.lit(writers[-1][0]), total
    for name, weight in reversed(writers):
        out = F.when(at < upto, name).otherwise(out)
        upto -= weight
    return out


def staged(due: DataFrame, key: str, prompt: str, client: Client, sieve: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What is due, asked for and sifted: the sieve gets key and text of every answer and tells reason."""
    got = calls(due, key, prompt, client).where("error is null").select(key, F.get_json_object("answer", "$.text").alias("text"))
    return sieve(got)


def in_order(df: DataFrame, steps: list[tuple[str, Callable[[DataFrame], tuple[DataFrame, DataFrame]]]], only: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows, counts by step) after the steps in their fixed order, or those of `only`; each step gets the last one's rows and returns rows and its edits."""
    counts = None
    for name, step in steps:
        if only and name not in only:
            continue
        df, edits = step(df)
        n = edits.agg(F.count("*").alias("edits")).select(F.lit(name).alias("step"), "edits")
        counts = n if counts is None else counts.union(n)
    return df, counts


def by_verdict(rows: DataFrame, verdicts: DataFrame, key: list[str]) -> DataFrame:
    """Rows with the last verdict (by n) of each; without one 'pending'."""
    last = verdicts.groupBy(*key).agg(F.max_by("verdict", "n").alias("verdict"))
    return rows.join(last, key, "left").withColumn("verdict", F.coalesce("verdict", F.lit("pending")))


def weak_tags(rows: DataFrame, tag: str, version: str, current: int, force: bool = False) -> DataFrame:
    """General tags and those of an older taxonomy are cleared (all with force); `due` tells what is to be tagged."""
    weak = F.lit(force) | F.coalesce(F.endswith(F.col(tag), F.lit(".general")) | (F.col(version) < current), F.lit(True))
    return rows.withColumn(tag, F.when(~weak, F.col(tag))).withColumn("due", weak)


def typed(rows: DataFrame, rule: Column, listed: DataFrame, key: str) -> DataFrame:
    """A type by rule first, else what a list says (key, listed_type), else left to a model; `by` tells which."""
    r = rows.join(listed.select(key, "listed_type").dropDuplicates([key]), key, "left").withColumn("rule_type", rule)
    return r.withColumn("type", F.coalesce("rule_type", "listed_type")).withColumn("by", F.when(F.col("rule_type").isNotNull(), "rule").when(F.col("listed_type").isNotNull(), "list").otherwise(F.lit("model"))).drop("rule_type", "listed_type")


def reserved(rows: DataFrame, by: str, order: list[str], estimate: str, actual: str, ceiling: float) -> DataFrame:
    """Rows in order with whether their estimate still fits under the ceiling, given the actual costs of the rows before."""
    before = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("granted", F.coalesce(F.sum(actual).over(before), F.lit(0.0)) + F.col(estimate) <= ceiling)


def paced(rows: DataFrame, by: str, order: list[str], tokens: str, per_minute: int) -> DataFrame:
    """The minute from 0 in which each call may start if no minute starts more tokens than its limit and calls keep their order."""
    before = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("minute", F.floor(F.coalesce(F.sum(tokens).over(before), F.lit(0)) / per_minute).cast("long"))


def tier_after_rejections(rows: DataFrame, by: str, order: list[str], rejected: str, limit: int) -> DataFrame:
    """The service tier of each call: the cheap one until `limit` rejections came before it."""
    before = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("service_tier", F.when(F.coalesce(F.sum(F.col(rejected).cast("int")).over(before), F.lit(0)) >= limit, "standard").otherwise(F.lit("flex")))
