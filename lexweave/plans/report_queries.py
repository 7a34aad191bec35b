"""Queries over reports, samples and model-driven stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexweave.catalog import query
from lexweave.functions import text as T
from lexweave.operators import entries as E
from lexweave.operators import reports, stages, stats
from lexweave.plans.entry_queries import FLAT, entries
from lexweave.plans.predicate_queries import TURNS, turns
from lexweave.plans.text_queries import _NGRAMS, CONTENT, WORDS, sentence_words
from lexweave.plans.views import SENSES_SQL, senses, table


@query(f"""WITH {_NGRAMS}, k AS (SELECT g, count(*) AS c FROM n GROUP BY g HAVING count(*) >= 5 AND count(*) / (SELECT count(*) FROM t) > 0.00025), h AS (SELECT DISTINCT doc_id, g, c FROM n JOIN k USING (g))
SELECT doc_id, array_to_string((list(g ORDER BY c DESC, g))[1:3], '|') AS phrases, count(*)::INT AS found FROM h GROUP BY doc_id""")
def named_phrases(spark, sf_dir):
    """The filler phrases of each document that has some, three named."""
    words = sentence_words(spark, sf_dir)
    over = stats.over_threshold(words, F.expr(T.ngrams_sql("w", 4)), "ngram", 0.00025, 5)
    hits = words.select("doc_id", F.explode(F.expr(T.ngrams_sql("w", 4))).alias("ngram")).join(over.select("ngram", "sentences"), "ngram")
    return reports.named_phrases(hits, "doc_id", "ngram", "sentences")


@query(f"""WITH d AS (SELECT lang, source, len({WORDS.format('text')}) AS n, md5(coalesce(text, '')) AS k FROM documents) SELECT lang, source, count(*) AS rows, sum(n)::BIGINT AS tokens, round(avg(n), 6) AS mean_tokens, CASE WHEN count(*) >= 10 THEN round(count(DISTINCT k) / count(*), 6) END AS distinct_share FROM d GROUP BY lang, source""")
def strata_tables(spark, sf_dir):
    """H21."""
    d = table(spark, sf_dir, "documents").select("lang", "source", T.word_count("text").alias("n"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("k"))
    return reports.strata(d, ["lang", "source"], "n", "k", 10)


@query(f"""WITH w AS (SELECT conv_id, turn % 3 AS lv, {CONTENT.format('text')} AS w FROM conversations WHERE turn < 3) SELECT a.lv AS a, b.lv AS b, count(*) AS pairs, count(*) FILTER (CASE WHEN len(a.w) = 0 AND len(b.w) = 0 THEN 1.0 ELSE len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))) END >= 0.2) AS near FROM w a JOIN w b ON a.conv_id = b.conv_id AND a.lv < b.lv GROUP BY 1, 2""")
def level_anchoring(spark, sf_dir):
    """The first three turns of a conversation as levels, and how alike they are by pairs."""
    t = table(spark, sf_dir, "conversations").where("turn < 3").withColumn("lv", F.col("turn") % 3)
    return reports.anchoring(t, "conv_id", "lv", "text", 0.2)


@query("""WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY (lang = 'en') DESC, md5('29:' || doc_id), doc_id) AS n FROM documents) SELECT doc_id, source FROM r WHERE n <= 4""")
def judge_sample(spark, sf_dir):
    """Four documents of each source, English ones first."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    return reports.judge_sample(d, "source", "doc_id", F.col("lang") == "en", 4, 29).select("doc_id", "source")


@query("""WITH v AS (SELECT event_type, CASE WHEN value / 200 < 0.25 THEN 'bad' WHEN value / 200 < 0.5 THEN 'weak' WHEN value / 200 < 0.75 THEN 'fair' ELSE 'good' END AS band, value > 20 AS fit, user_id % 3 <> 0 AS clear FROM events) SELECT event_type, band, count(*) AS judged, round(avg((NOT fit)::INT), 6) AS fit_failed, round(avg((NOT clear)::INT), 6) AS clear_failed FROM v GROUP BY 1, 2""")
def verdict_buckets(spark, sf_dir):
    """Scores in bands, and failed shares by dimension."""
    v = table(spark, sf_dir, "events").select("event_type", reports.bucket(F.col("value") / 200).alias("band"), (F.col("value") > 20).alias("fit"), (F.col("user_id") % 3 != 0).alias("clear"))
    return reports.defect_rates(v, ["event_type", "band"], ["fit", "clear"])


@query(f"""WITH {TURNS}, d AS (SELECT role, count(*) AS calls, sum(ceil(length(text) / 3))::BIGINT AS input_tokens FROM t GROUP BY role), p AS (SELECT * FROM (VALUES ('a', 1.0::DOUBLE, 5.0::DOUBLE), ('b', 0.1, 0.4)) AS p(model, i, o))
SELECT role, calls, input_tokens, calls * 200 AS output_tokens, model, round((input_tokens * i + calls * 200 * o) / 1000000, 6) AS dollars FROM d, p""")
def dry_run_costs(spark, sf_dir):
    """What asking about every turn would cost."""
    prices = spark.createDataFrame([("a", 1.0, 5.0), ("b", 0.1, 0.4)], "model string, input_usd double, output_usd double")
    return reports.dry_run(turns(spark, sf_dir), "role", F.length("text"), 200, prices)


@query("""WITH n AS (SELECT 'part' AS name, count(*) AS rows FROM part UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem) SELECT name, rows, CASE WHEN rows < 1000 THEN 'n<1K' WHEN rows < 10000 THEN '1K<n<10K' WHEN rows < 100000 THEN '10K<n<100K' WHEN rows < 1000000 THEN '100K<n<1M' WHEN rows < 10000000 THEN '1M<n<10M' ELSE 'n>10M' END AS size FROM n""")
def size_categories(spark, sf_dir):
    """H45."""
    out = None
    for name in ("part", "orders", "lineitem"):
        n = table(spark, sf_dir, name).agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows")
        out = n if out is None else out.union(n)
    return out.withColumn("size", reports.size_category(F.col("rows")))


@query("""WITH b AS (SELECT p_partkey, p_type AS v FROM part WHERE p_partkey % 10 <> 0), a AS (SELECT p_partkey, CASE WHEN p_size > 40 THEN 'RETYPED' ELSE p_type END AS v FROM part WHERE p_partkey % 11 <> 0) SELECT b.v AS before, a.v AS after, count(*) AS keys FROM b FULL JOIN a USING (p_partkey) WHERE b.v IS DISTINCT FROM a.v GROUP BY 1, 2""")
def type_changes(spark, sf_dir):
    """Before and after a cleaning."""
    p = table(spark, sf_dir, "part")
    after = p.where("p_partkey % 11 != 0").select("p_partkey", F.when(F.col("p_size") > 40, "RETYPED").otherwise(F.col("p_type")).alias("p_type"))
    return reports.changes(p.where("p_partkey % 10 != 0"), after, "p_partkey", "p_type")


@query()
def attribution(spark, sf_dir):
    """Languages told apart by words, classes balanced."""
    d = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", "lang", F.left("text", F.lit(2000)).alias("text"))
    return reports.attribution(reports.balanced(d, "lang", "doc_id", 31), "lang", "text", "doc_id", folds=3)


@query(f"""WITH {SENSES_SQL}, h AS (SELECT sense_id, ('0x' || left(md5('37:' || sense_id), 12))::BIGINT % 10 AS place FROM senses) SELECT sense_id, CASE WHEN place < 5 THEN 'one' WHEN place < 8 THEN 'two' ELSE 'three' END AS writer FROM h""")
def writer_rotation(spark, sf_dir):
    """Three writers by weights 5, 3 and 2."""
    return senses(spark, sf_dir).select("sense_id", stages.writer("sense_id", [("one", 5), ("two", 3), ("three", 2)], 37).alias("writer"))


@query(f"""WITH {TURNS}, w AS (SELECT conv_id * 1000 + turn AS id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS w FROM t) SELECT id, len(w)::BIGINT AS words, 1 AS attempts FROM w""")
def structured_calls(spark, sf_dir):
    """Every turn asked of the client that stands in for a model; the answer's words counted."""
    t = turns(spark, sf_dir).select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")
    got = stages.calls(t, "id", "text", stages.echo_client)
    return got.select("id", F.expr("cast(size(filter(split(get_json_object(answer, '$.text'), ' '), x -> x != '')) as long)").alias("words"), "attempts")


@query(f"""WITH {TURNS}, w AS (SELECT role, len({WORDS.format('text')}) AS n FROM t WHERE turn < 2) SELECT CASE WHEN n < 10 THEN 'too_short' ELSE 'accepted' END AS reason, count(*) AS drafts FROM w GROUP BY 1""")
def content_stage(spark, sf_dir):
    """Turns that are due, asked for and sifted by length."""
    due = turns(spark, sf_dir).where("turn < 2").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")
    sieve = lambda got: got.select(F.when(T.word_count("text") < 10, "too_short").otherwise("accepted").alias("reason"))
    return stages.staged(due, "id", "text", stages.echo_client, sieve).groupBy("reason").agg(F.count("*").alias("drafts"))


@query("""WITH v AS (SELECT user_id, arg_max(event_type, event_id) AS verdict FROM events WHERE event_id % 5 = 0 GROUP BY 1), u AS (SELECT DISTINCT user_id FROM events) SELECT coalesce(verdict, 'pending') AS verdict, count(*) AS users FROM u LEFT JOIN v USING (user_id) GROUP BY 1""")
def last_verdicts(spark, sf_dir):
    """The last verdict of each user, or pending."""
    e = table(spark, sf_dir, "events")
    v = e.where("event_id % 5 = 0").select("user_id", F.col("event_id").alias("n"), F.col("event_type").alias("verdict"))
    return stages.by_verdict(e.select("user_id").distinct(), v, ["user_id"]).groupBy("verdict").agg(F.count("*").alias("users"))


@query("""WITH t AS (SELECT p_partkey, CASE WHEN p_size % 6 = 0 THEN NULL ELSE lower(p_type) || CASE WHEN p_size % 4 = 0 THEN '.general' ELSE '.leaf' END END AS tag, p_size % 3 AS v FROM part), w AS (SELECT *, coalesce(tag LIKE '%.general' OR v < 1, true) AS due FROM t) SELECT p_partkey, CASE WHEN NOT due THEN tag END AS tag, due FROM w""")
def weak_tags(spark, sf_dir):
    """I9."""
    t = table(spark, sf_dir, "part").select("p_partkey", F.expr("case when p_size % 6 = 0 then null else concat(lower(p_type), case when p_size % 4 = 0 then '.general' else '.leaf' end) end").alias("tag"), (F.col("p_size") % 3).alias("v"))
    return stages.weak_tags(t, "tag", "v", 1).select("p_partkey", "tag", "due")


@query("""WITH l AS (SELECT p_name, min(p_type) AS t FROM part WHERE p_size > 30 GROUP BY 1) SELECT p_partkey, CASE WHEN p_size < 5 THEN 'small' ELSE t END AS type, CASE WHEN p_size < 5 THEN 'rule' WHEN t IS NOT NULL THEN 'list' ELSE 'model' END AS by FROM part LEFT JOIN l USING (p_name)""")
def typing_pass(spark, sf_dir):
    """Types by rule, then by list, the rest left to a model."""
    p = table(spark, sf_dir, "part")
    listed = p.where("p_size > 30").groupBy("p_name").agg(F.min("p_type").alias("listed_type"))
    return stages.typed(p, F.when(F.col("p_size") < 5, "small"), listed, "p_name").select("p_partkey", "type", "by")


@query("""WITH c AS (SELECT o_custkey, o_orderkey, o_totalprice, coalesce(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM orders) SELECT o_custkey, o_orderkey, spent + o_totalprice * 1.5 <= 400000 AS granted, floor(spent / 100000)::BIGINT AS minute FROM c""")
def reservations(spark, sf_dir):
    """Orders granted while an estimate of half as much again fits the budget, and the minute in which a paced caller may start each."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", (F.col("o_totalprice") * 1.5).alias("estimate"))
    return stages.paced(stages.reserved(o, "o_custkey", ["o_orderkey"], "estimate", "o_totalprice", 400000.0), "o_custkey", ["o_orderkey"], "o_totalprice", 100000).select("o_custkey", "o_orderkey", "granted", "minute")


@query("""WITH r AS (SELECT event_id, user_id, coalesce(sum((event_type = 'error')::INT) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n FROM events) SELECT event_id, CASE WHEN n >= 2 THEN 'standard' ELSE 'flex' END AS service_tier FROM r""")
def service_tiers(spark, sf_dir):
    """I15."""
    e = table(spark, sf_dir, "events").withColumn("rejected", F.col("event_type") == "error")
    return stages.tier_after_rejections(e, "user_id", ["event_id"], "rejected", 2).select("event_id", "service_tier")


@query(f"""WITH {FLAT}, a AS (SELECT 'example' AS part, p.model, x.text FROM x JOIN l USING (sense_id) JOIN p ON p.lexeme_id = l.lexeme_id AND p.n = x.ord) SELECT model AS writer, count(*) AS texts, count(DISTINCT md5(text)) AS kinds FROM a GROUP BY model""")
def attributed_texts(spark, sf_dir):
    """Example sentences by the writer that their provenance names."""
    live = E.live_senses(entries(spark, sf_dir).withColumn("source", F.lit("")))
    x = live.select("provenance", F.explode("examples").alias("x")).select(F.element_at("provenance", F.col("x.provenance_id"))["model"].alias("writer"), F.col("x.text").alias("text")).where("writer is not null")
    return x.groupBy("writer").agg(F.count("*").alias("texts"), F.count_distinct(F.md5(F.col("text").cast("binary"))).alias("kinds"))
