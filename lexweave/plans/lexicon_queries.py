"""Queries over the lexicon: ids, projections, rankings, quotas, costs, mined supervision."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexweave.catalog import query
from lexweave.operators import graph, lexicon
from lexweave.operators.stats import shares
from lexweave.plans.views import EDGES_SQL, SENSES_SQL, edges, senses, table


@query(f"WITH {SENSES_SQL} SELECT sense_key, lexeme_id, sense_id, lexeme_id || '#encyclopedia' AS article_id FROM senses")
def slugify_ids(spark, sf_dir):
    """A1, A2."""
    return senses(spark, sf_dir).select("sense_key", "lexeme_id", "sense_id", F.concat("lexeme_id", F.lit("#encyclopedia")).alias("article_id"))


@query(f"WITH {SENSES_SQL}, {EDGES_SQL} SELECT a.sense_id || '-' || e.type || '->' || b.lexeme_id AS edge_id, count(*) AS uses FROM edges e JOIN senses a ON a.sense_key = src JOIN senses b ON b.sense_key = dst GROUP BY 1")
def edge_ids(spark, sf_dir):
    """A2: edge ids and how often each is asserted."""
    s = senses(spark, sf_dir)
    e = edges(spark, sf_dir).join(s.select(F.col("sense_key").alias("src"), "sense_id"), "src").join(s.select(F.col("sense_key").alias("dst"), "lexeme_id"), "dst")
    return e.groupBy(lexicon.edge_id("sense_id", "type", "lexeme_id").alias("edge_id")).agg(F.count("*").alias("uses"))


@query(f"WITH {SENSES_SQL}, {EDGES_SQL} SELECT a.sense_id AS source, e.type AS kind, replace(b.lexeme_id, '_', ' ') AS target, count(*) AS uses FROM edges e JOIN senses a ON a.sense_key = src JOIN senses b ON b.sense_key = dst GROUP BY ALL")
def edge_parse(spark, sf_dir):
    """Edge ids parsed back."""
    return edge_ids(spark, sf_dir).select(*lexicon.parsed_edge("edge_id", ["synonym", "hypernym", "antonym", "confusable", "see_also"]), "uses")


@query(f"WITH {SENSES_SQL} SELECT lexeme_id, count(*) FILTER (NOT retired) AS n_live, count(*) FILTER (retired) AS n_retired, coalesce(string_agg(sense_index::VARCHAR, ',' ORDER BY sense_index) FILTER (NOT retired), '') AS live FROM senses GROUP BY lexeme_id, headword")
def rebuild_nested(spark, sf_dir):
    """Nested entries, made scalar."""
    return lexicon.nested(senses(spark, sf_dir)).select("lexeme_id", "n_live", "n_retired", F.expr("array_join(transform(senses, s -> cast(s.sense_index as string)), ',')").alias("live"))


@query(f"WITH {SENSES_SQL} SELECT lexeme_id, sense_index, sense_id, domain, gloss FROM senses WHERE NOT retired")
def fanout_nested_senses(spark, sf_dir):
    """Nested entries exploded again."""
    return lexicon.flat(lexicon.nested(senses(spark, sf_dir)))


@query("""WITH w AS (SELECT DISTINCT unnest(string_split(lower(p_name), ' ')) AS w FROM part), c AS (SELECT w FROM w WHERE regexp_matches(w, '^[a-z]+$')),
f AS (SELECT w, 'lemma' AS relation, w AS form FROM c UNION ALL SELECT w, 'plural', CASE WHEN regexp_matches(w, '[^aeiouy]y$') THEN left(w, length(w) - 1) || 'ies' WHEN regexp_matches(w, '(s|x|z|ch|sh)$') THEN w || 'es' ELSE w || 's' END FROM c
UNION ALL SELECT w, 'past', CASE WHEN regexp_matches(w, '[^aeiouy]y$') THEN left(w, length(w) - 1) || 'ied' WHEN w LIKE '%e' AND NOT w LIKE '%ee' THEN w || 'd' WHEN length(w) >= 3 AND regexp_matches(w, '^[^aeiou]*[aeiou][^aeiouwxy]$') THEN w || right(w, 1) || 'ed' ELSE w || 'ed' END FROM c
UNION ALL SELECT w, 'present_participle', CASE WHEN w LIKE '%e' AND NOT w LIKE '%ee' THEN left(w, length(w) - 1) || 'ing' WHEN length(w) >= 3 AND regexp_matches(w, '^[^aeiou]*[aeiou][^aeiouwxy]$') THEN w || right(w, 1) || 'ing' ELSE w || 'ing' END FROM c) SELECT min(w) AS lemma, form, relation FROM f GROUP BY form, relation""")
def inflection_unpivot(spark, sf_dir):
    """D11 over the distinct words of part names."""
    words = table(spark, sf_dir, "part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("w")).where("w rlike '^[a-z]+$'").distinct()
    return lexicon.inflections(words, "w")


@query("""SELECT kind, count(*) AS heads FROM (SELECT CASE WHEN regexp_matches(w, '^-|-$') THEN 'affix' WHEN regexp_matches(w, '^[A-Z]{2,3}$') THEN 'abbreviation' WHEN lower(w) IN ('a', 'an', 'the', 'of', 'in', 'on', 'to', 'for', 'with', 'and', 'or', 'by', 'at') THEN 'function_word'
WHEN regexp_matches(w, '^[A-Z]') THEN 'proper' WHEN contains(w, '-') THEN 'compound' ELSE 'simplex' END AS kind FROM (SELECT DISTINCT unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z-]+')) AS w FROM documents)) GROUP BY kind""")
def kind_classifier(spark, sf_dir):
    """B31 over the distinct tokens of documents."""
    w = table(spark, sf_dir, "documents").select(F.explode(F.expr("regexp_extract_all(coalesce(text, ''), '[A-Za-z-]+', 0)")).alias("w")).distinct()
    return w.groupBy(lexicon.kind_of("w").alias("kind")).agg(F.count("*").alias("heads"))


@query("""WITH d AS (SELECT l_partkey, count(DISTINCT l_orderkey) AS uses, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1), p AS (SELECT p_partkey, p_retailprice AS price, uses, quantity FROM part LEFT JOIN d ON l_partkey = p_partkey),
r AS (SELECT p_partkey, CASE WHEN price IS NULL THEN 1 ELSE (rank() OVER (ORDER BY price DESC NULLS LAST) + (count(*) OVER (PARTITION BY price) - 1) / 2) / count(price) OVER () END AS a,
CASE WHEN uses IS NULL THEN 1 ELSE (rank() OVER (ORDER BY uses DESC NULLS LAST) + (count(*) OVER (PARTITION BY uses) - 1) / 2) / count(uses) OVER () END AS b,
CASE WHEN quantity IS NULL THEN 1 ELSE (rank() OVER (ORDER BY quantity DESC NULLS LAST) + (count(*) OVER (PARTITION BY quantity) - 1) / 2) / count(quantity) OVER () END AS c FROM p)
SELECT p_partkey, round((a + b + c) / 3, 6) AS score FROM r""")
def composite_percentile_rank(spark, sf_dir):
    """Mean of three average-method percentile ranks."""
    d = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count_distinct("l_orderkey").alias("uses"), F.sum("l_quantity").alias("quantity"))
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").alias("price")).join(d, F.col("p_partkey") == F.col("l_partkey"), "left").drop("l_partkey")
    for value, name in (("price", "a"), ("uses", "b"), ("quantity", "c")):
        p = lexicon.average_ranks(p, value, name)
    return p.select("p_partkey", F.round((F.col("a") + F.col("b") + F.col("c")) / 3, 6).alias("score"))


@query("""WITH r AS (SELECT p_partkey, p_brand, p_retailprice, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) > 4 AS o FROM part) SELECT p_partkey, p_brand FROM r ORDER BY o, p_retailprice DESC, p_partkey LIMIT 60""")
def quota_topk(spark, sf_dir):
    """Sixty dearest parts, four a brand before overflow."""
    return lexicon.quota_top(table(spark, sf_dir, "part"), "p_brand", [F.desc("p_retailprice"), "p_partkey"], 4, 60).select("p_partkey", "p_brand")


@query("""WITH c AS (SELECT c_nationkey AS n, count(*) AS customers, max(c_acctbal) AS best_customer FROM customer GROUP BY 1), s AS (SELECT s_nationkey AS n, count(*) AS suppliers, max(s_acctbal) AS best_supplier FROM supplier GROUP BY 1)
SELECT coalesce(c.n, s.n) AS nation, coalesce(customers, 0) AS customers, coalesce(suppliers, 0) AS suppliers, greatest(best_customer, best_supplier) AS best FROM c FULL JOIN s ON c.n = s.n""")
def full_outer_merge_sources(spark, sf_dir):
    """Customers and suppliers merged by nation; one tagged union, one sum."""
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("best"), F.lit(1).alias("c"))
    s = table(spark, sf_dir, "supplier").select("s_nationkey", "s_acctbal", F.lit(0))
    return c.union(s).groupBy("nation").agg(F.sum("c").alias("customers"), F.sum(1 - F.col("c")).alias("suppliers"), F.max("best").alias("best"))


@query("""SELECT lang, count(*) AS docs, count(l.doc_id) AS labelled, round(count(l.doc_id) / count(*), 6) AS coverage, coalesce(sum(quality), 0)::BIGINT AS good, coalesce(sum(toxic), 0)::BIGINT AS toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY lang""")
def coverage_by_group(spark, sf_dir):
    """H4: how far labels cover each language."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels").withColumn("hit", F.lit(1)), "doc_id", "left")
    return d.groupBy("lang").agg(F.count("*").alias("docs"), F.count("hit").alias("labelled"), F.round(F.count("hit") / F.count("*"), 6).alias("coverage"), F.coalesce(F.sum("quality"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


@query("SELECT count(*) AS rows, count(*) FILTER (text IS NULL OR text = '') AS empty, count(*) FILTER (length(text) < 200) AS short, count(*) FILTER (n_chars <> length(text)) AS wrong_length, count(DISTINCT source) AS sources FROM documents")
def audit_counts(spark, sf_dir):
    """H2: one pass of conditional counts."""
    n = F.length("text")
    return table(spark, sf_dir, "documents").agg(F.count("*").alias("rows"), F.count_if(F.col("text").isNull() | (F.col("text") == "")).alias("empty"), F.count_if(n < 200).alias("short"), F.count_if(F.col("n_chars") != n).alias("wrong_length"), F.count_distinct("source").alias("sources"))


@query("SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O, count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1")
def status_pivot(spark, sf_dir):
    """H3: a coverage matrix."""
    p = table(spark, sf_dir, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count()
    return p.na.fill(0)


@query("SELECT l_returnflag, l_linestatus, count(*) AS lines, round(sum(l_extendedprice * (1 - l_discount)), 2) AS cost FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def cost_rollup(spark, sf_dir):
    """H42."""
    return table(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("lines"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("cost"))


@query("""WITH c AS (SELECT o_custkey, o_orderkey, sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS spent FROM orders) SELECT o_custkey, count(*) AS planned, max(o_orderkey) AS last_order FROM c WHERE spent <= 500000 GROUP BY o_custkey""")
def budget_cutoff(spark, sf_dir):
    """Each customer's orders until a ceiling is reached."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(Window.unboundedPreceding, 0)
    c = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.sum("o_totalprice").over(w).alias("spent"))
    return c.where("spent <= 500000").groupBy("o_custkey").agg(F.count("*").alias("planned"), F.max("o_orderkey").alias("last_order"))


@query("""WITH b AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1) SELECT p_brand AS domain, n AS senses, round(1.0 / (SELECT count(*) FROM b) - n / (SELECT sum(n) FROM b), 6) AS deficit FROM b""")
def domain_deficit(spark, sf_dir):
    """A uniform target less the actual share."""
    b = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("domain")).agg(F.count("*").alias("senses"))
    all_ = Window.partitionBy()  # a row a domain
    return b.withColumn("deficit", F.round(1 / F.count("*").over(all_) - F.col("senses") / F.sum("senses").over(all_), 6))


@query(f"WITH {EDGES_SQL}, d AS (SELECT src, count(DISTINCT dst) AS n FROM edges GROUP BY src) SELECT p_partkey AS seed, coalesce(n, 0) AS degree FROM part LEFT JOIN d ON src = p_partkey ORDER BY degree, seed LIMIT 25")
def least_connected_seeds(spark, sf_dir):
    """The 25 parts of fewest distinct targets."""
    d = edges(spark, sf_dir).groupBy("src").agg(F.count_distinct("dst").alias("n"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("seed"))
    return p.join(d, p["seed"] == d["src"], "left").select("seed", F.coalesce("n", F.lit(0)).alias("degree")).orderBy("degree", "seed").limit(25)


@query("""WITH c AS (SELECT lower(split_part(p_name, ' ', 1)) AS slug, count(*) AS n, min(p_partkey) AS keeper FROM part GROUP BY 1) SELECT slug, n AS parts, keeper FROM c WHERE n > 1""")
def collision_annotation(spark, sf_dir):
    """Slugs that several rows share."""
    return table(spark, sf_dir, "part").groupBy(F.lower(F.split("p_name", " ")[0]).alias("slug")).agg(F.count("*").alias("parts"), F.min("p_partkey").alias("keeper")).where("parts > 1")


@query(f"""WITH {SENSES_SQL}, l AS (SELECT * FROM senses WHERE NOT retired) SELECT a.lexeme_id, a.domain, a.sense_id AS a, b.sense_id AS b FROM l a JOIN l b ON a.lexeme_id = b.lexeme_id AND a.domain = b.domain AND a.sense_index < b.sense_index""")
def wic_hard(spark, sf_dir):
    """Pairs of live senses of a headword, within a domain."""
    return lexicon.within_group_pairs(senses(spark, sf_dir).where("not retired"), ["lexeme_id", "domain"], "sense_index", "sense_id")


@query(f"WITH {SENSES_SQL} SELECT sense_id, lower(headword) AS example, gloss, count(*) FILTER (NOT retired) OVER (PARTITION BY lexeme_id) = 1 AS monosemous FROM senses QUALIFY NOT retired")
def gloss_pairs(spark, sf_dir):
    """An example with its gloss, and whether the entry has one live sense."""
    s = senses(spark, sf_dir).withColumn("n", F.count_if(~F.col("retired")).over(Window.partitionBy("lexeme_id")))
    return s.where("not retired").select("sense_id", F.lower("headword").alias("example"), "gloss", (F.col("n") == 1).alias("monosemous"))


@query(f"""WITH {SENSES_SQL}, r AS (SELECT sense_id, lexeme_id, domain, row_number() OVER (PARTITION BY domain ORDER BY md5('11:' || sense_id), sense_id) - 1 AS pos, count(*) OVER (PARTITION BY domain) AS size FROM senses WHERE NOT retired),
a AS (SELECT a.sense_id, b.sense_id AS negative_id, min(k) AS k FROM (SELECT *, unnest(range(1, 7)) AS k FROM r) a JOIN r b ON a.domain = b.domain AND b.pos = (a.pos + k) % a.size WHERE a.lexeme_id <> b.lexeme_id AND a.pos <> b.pos GROUP BY 1, 2),
n AS (SELECT *, row_number() OVER (PARTITION BY sense_id ORDER BY k) AS nth FROM a) SELECT sense_id, negative_id, nth::INT AS nth FROM n WHERE nth <= 3""")
def wic_easy(spark, sf_dir):
    """Three negatives of the same domain and another headword."""
    return lexicon.easy_negatives(senses(spark, sf_dir), 3, seed=11)


@query(f"""WITH {EDGES_SQL}, syn AS (SELECT DISTINCT src, dst FROM (SELECT src, dst FROM edges WHERE type = 'synonym' AND src <> dst UNION ALL SELECT dst, src FROM edges WHERE type = 'synonym' AND src <> dst)),
hyp AS (SELECT DISTINCT src, dst FROM edges WHERE type = 'hypernym' AND src <> dst), g AS (SELECT src, dst, 2 AS grade FROM syn UNION ALL SELECT src, dst, 1 FROM hyp),
b AS (SELECT src, dst, max(grade) AS grade FROM g GROUP BY src, dst), r AS (SELECT *, row_number() OVER (PARTITION BY src, grade ORDER BY md5('5:' || dst), dst) AS n FROM b)
SELECT src AS query_id, dst AS candidate, grade FROM r WHERE n <= 3""")
def qrels_graded(spark, sf_dir):
    """Three synonyms (2) and three hypernyms (1) for each sense, by keyed draw."""
    return _graded(spark, sf_dir)


def _graded(spark, sf_dir):
    from lexweave.operators.stats import drawn

    e = edges(spark, sf_dir)
    g = graph.symmetrised(e, "synonym").withColumn("grade", F.lit(2)).union(e.where("type = 'hypernym' and src != dst").select("src", "dst").distinct().withColumn("grade", F.lit(1)))
    best = g.groupBy("src", "dst").agg(F.max("grade").alias("grade"))
    nth = F.row_number().over(Window.partitionBy("src", "grade").orderBy(drawn("dst", 5), "dst"))
    return best.withColumn("n", nth).where("n <= 3").select(F.col("src").alias("query_id"), F.col("dst").alias("candidate"), "grade")


@query(f"""WITH {EDGES_SQL}, syn AS (SELECT DISTINCT src, dst FROM (SELECT src, dst FROM edges WHERE type = 'synonym' AND src <> dst UNION ALL SELECT dst, src FROM edges WHERE type = 'synonym' AND src <> dst)), hyp AS (SELECT DISTINCT src, dst FROM edges WHERE type = 'hypernym' AND src <> dst),
b AS (SELECT src, dst, max(grade) AS grade FROM (SELECT src, dst, 2 AS grade FROM syn UNION ALL SELECT src, dst, 1 FROM hyp) GROUP BY src, dst), r AS (SELECT *, row_number() OVER (PARTITION BY src, grade ORDER BY md5('5:' || dst), dst) AS n FROM b)
SELECT src AS query_id, string_agg(dst || '=' || grade, ',' ORDER BY grade DESC, dst) AS candidates, count(*)::INT AS n_candidates FROM r WHERE n <= 3 GROUP BY src""")
def listwise_joined(spark, sf_dir):
    """The lists of listwise, made scalar."""
    return listwise(spark, sf_dir).select("query_id", F.expr("array_join(transform(candidates, c -> concat(c.id, '=', c.grade)), ',')").alias("candidates"), "n_candidates")


@query()
def listwise(spark, sf_dir):
    """One row per query with its graded candidates, best first."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("grade")).alias("neg"), "candidate")))
    return _graded(spark, sf_dir).groupBy("query_id").agg(ordered.alias("c")).select("query_id", F.expr("transform(c, x -> named_struct('id', x.candidate, 'grade', -x.neg))").alias("candidates"), F.size("c").alias("n_candidates"))


@query(f"""WITH {EDGES_SQL}, {SENSES_SQL}, h AS (SELECT src, min(dst) AS hard FROM edges WHERE type = 'confusable' AND src <> dst GROUP BY src)
SELECT s.sense_id AS query_id, s.gloss AS positive, n.gloss AS negative, 'confusable' AS negative_kind FROM h JOIN senses s ON s.sense_key = h.src JOIN senses n ON n.sense_key = h.hard WHERE NOT s.retired AND NOT n.retired""")
def triples(spark, sf_dir):
    """A hard negative for each sense that has a confusable one."""
    s = senses(spark, sf_dir).where("not retired")
    h = edges(spark, sf_dir).where("type = 'confusable' and src != dst").groupBy("src").agg(F.min("dst").alias("hard"))
    q = s.select(F.col("sense_key").alias("src"), F.col("sense_id").alias("query_id"), F.col("gloss").alias("positive"))
    n = s.select(F.col("sense_key").alias("hard"), F.col("gloss").alias("negative"))
    return h.join(q, "src").join(n, "hard").select("query_id", "positive", "negative", F.lit("confusable").alias("negative_kind"))


@query("""SELECT conv_id, count(*) AS turns, md5(string_agg('**' || role || '** ' || coalesce(text, ''), chr(10) ORDER BY turn)) AS doc_md5 FROM conversations GROUP BY conv_id""")
def pretrain_documents(spark, sf_dir):
    """Conversations rendered by a template."""
    line = F.concat(F.lit("**"), "role", F.lit("** "), F.coalesce("text", F.lit("")))
    c = table(spark, sf_dir, "conversations").select("conv_id", F.struct("turn", line.alias("line")).alias("x"))
    g = c.groupBy("conv_id").agg(F.count("*").alias("turns"), F.array_sort(F.collect_list("x")).alias("xs"))
    return g.select("conv_id", "turns", F.md5(F.expr("array_join(transform(xs, x -> x.line), '\n')").cast("binary")).alias("doc_md5"))


@query(r"""WITH w AS (SELECT unnest(string_split(coalesce(text, ''), ' ')) AS w FROM documents), h AS (SELECT trim(lower(w), ' ') AS h FROM w)
SELECT CASE WHEN h = '' THEN 'empty' WHEN length(h) < 3 THEN 'too_short' WHEN len(regexp_split_to_array(h, '[ \t\n\f\r\v]+')) > 4 THEN 'too_many_words' WHEN NOT regexp_matches(h, '[a-z]') THEN 'no_letters' WHEN h IN ('a', 'an', 'the', 'of', 'in', 'on', 'to', 'for', 'with', 'and', 'or', 'by', 'at') THEN 'function_word' ELSE 'accepted' END AS reason, count(*) AS candidates FROM h GROUP BY 1""")
def frontier_filter_reasons(spark, sf_dir):
    """Tokens as candidate headwords, reasons counted."""
    w = table(spark, sf_dir, "documents").select(F.explode(F.split(F.coalesce("text", F.lit("")), " ")).alias("w"))
    return w.groupBy(lexicon.frontier_reason("w").alias("reason")).agg(F.count("*").alias("candidates"))


@query("SELECT event_type, count(DISTINCT user_id) AS users, count(*) AS rows, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.99), 6) AS p99, max(value) AS max FROM events GROUP BY event_type")
def event_quantiles(spark, sf_dir):
    """Linear quantiles of a value."""
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count_distinct("user_id").alias("users"), F.count("*").alias("rows"), F.round(F.percentile("value", 0.5), 6).alias("p50"), F.round(F.percentile("value", 0.99), 6).alias("p99"), F.max("value").alias("max"))


@query("""WITH s AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS first FROM events), n AS (SELECT *, sum(first) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM s)
SELECT user_id, max(session)::BIGINT AS sessions, count(*) AS events, round(sum(value), 4) AS total FROM n GROUP BY user_id""")
def session_ledger_rollup(spark, sf_dir):
    """A work log rolled up by session of thirty minutes."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    first = F.when(F.col("ts") - F.lag("ts").over(w) <= F.expr("interval 30 minutes"), 0).otherwise(1)
    e = table(spark, sf_dir, "events").withColumn("first", first)
    return e.groupBy("user_id").agg(F.sum("first").cast("long").alias("sessions"), F.count("*").alias("events"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT quality, toxic, count(*) AS rows, round(count(*) / sum(count(*)) OVER (PARTITION BY quality), 6) AS share FROM labels GROUP BY quality, toxic")
def supervision_crosstab(spark, sf_dir):
    """A crosstab of labels."""
    return shares(table(spark, sf_dir, "labels"), ["quality"], ["toxic"], "rows")


@query("WITH b AS (SELECT conv_id, turn, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 2 AS batch FROM conversations) SELECT conv_id, batch::BIGINT AS batch, count(*) AS turns, min(turn) AS first_turn FROM b GROUP BY 1, 2")
def fixed_batches(spark, sf_dir):
    """Batches of two turns."""
    b = lexicon.batches(table(spark, sf_dir, "conversations"), "conv_id", "turn", 2)
    return b.groupBy("conv_id", "batch").agg(F.count("*").alias("turns"), F.min("turn").alias("first_turn"))


@query("""WITH k AS (SELECT p_brand, p_type, p_partkey, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) AS n, first_value(p_partkey) OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) AS survivor FROM part) SELECT p_partkey, survivor FROM k WHERE n > 1""")
def duplicate_sense_retirement(spark, sf_dir):
    """Later senses with the gloss of an earlier one, and the survivor; from partial minima."""
    p = table(spark, sf_dir, "part").select("p_brand", "p_type", "p_partkey")
    low = p.groupBy("p_brand", "p_type").agg(F.min("p_partkey").alias("survivor"))
    return p.join(low, ["p_brand", "p_type"]).where("p_partkey != survivor").select("p_partkey", "survivor")
