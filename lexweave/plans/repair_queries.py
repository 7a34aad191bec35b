"""Queries over repair plans, sieves and planners."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexweave.catalog import query
from lexweave.functions import predicates as P
from lexweave.functions import text as T
from lexweave.operators import entries as E
from lexweave.operators import graph, repair
from lexweave.plans.entry_queries import FLAT, entries
from lexweave.plans.predicate_queries import CANDIDATE, GLOSS, PARAGRAPH, TURNS, answers, turns
from lexweave.plans.text_queries import CONTENT, FOLDED, MEASURED, WORDS, measured
from lexweave.plans.views import EDGES_SQL, SENSES_SQL, edges, senses, table

_W = f"WITH {SENSES_SQL}, {EDGES_SQL}"
_HYP = "hyp AS (SELECT DISTINCT src, dst FROM edges WHERE type = 'hypernym')"


@query(f"""{_W}, {_HYP}, s AS (SELECT hyp.src, dst, 'see_also' AS to, 'self_loop' AS step FROM hyp JOIN senses a ON src = a.sense_key JOIN senses b ON dst = b.sense_key WHERE a.lexeme_id = b.lexeme_id),
m AS (SELECT a.src, a.dst, CASE WHEN EXISTS (SELECT 1 FROM edges y WHERE y.type = 'synonym' AND y.src = a.src AND y.dst = a.dst) THEN 'see_also' ELSE 'synonym' END, 'mutual' FROM hyp a JOIN hyp b ON a.src = b.dst AND a.dst = b.src WHERE a.src <> a.dst) SELECT * FROM s UNION ALL SELECT * FROM m""")
def hygiene_edits(spark, sf_dir):
    """the edits of self loops and of mutual pairs, each from the graph as it is."""
    e = edges(spark, sf_dir)
    return repair.plan_self_loops(e, senses(spark, sf_dir)).union(repair.plan_mutual(e)).drop("type")


@query(f"""{_W}, {_HYP}, d AS (SELECT hyp.src, dst FROM hyp JOIN senses a ON src = a.sense_key JOIN senses b ON dst = b.sense_key WHERE a.lexeme_id = b.lexeme_id)
SELECT CASE WHEN e.type = 'hypernym' AND EXISTS (SELECT 1 FROM d WHERE d.src = e.src AND d.dst = e.dst) THEN 'see_also' ELSE e.type END AS type, count(*) AS edges, count(DISTINCT (src, dst)) AS pairs FROM edges e GROUP BY 1""")
def hygiene_applied(spark, sf_dir):
    """the graph after the edits of self loops."""
    e = edges(spark, sf_dir)
    out = repair.applied(e, repair.plan_self_loops(e, senses(spark, sf_dir)))
    return out.groupBy("type").agg(F.count("*").alias("edges"), F.count_distinct("src", "dst").alias("pairs"))


@query()
def hygiene_sweep(spark, sf_dir):
    """edits by step of a whole sweep."""
    _, edits = repair.sweep(edges(spark, sf_dir).select("src", "dst", "type", "confidence"), senses(spark, sf_dir))
    return edits.groupBy("step", "to").agg(F.count("*").alias("edits"))


@query()
def cycle_report(spark, sf_dir):
    """components of the hypernym graph that hold cycles."""
    return repair.cycle_report(edges(spark, sf_dir).where("type = 'hypernym'"))


@query(f"""{_W}, l AS (SELECT lexeme_id, count(*) AS n, min(sense_id) AS only FROM senses WHERE NOT retired GROUP BY 1) SELECT e.src, b.lexeme_id AS target_lexeme_id, count(*) AS relations, coalesce(any_value(l.n), 0) AS candidates, CASE WHEN any_value(l.n) = 1 THEN any_value(l.only) END AS resolved_to
FROM edges e JOIN senses b ON b.sense_key = e.dst LEFT JOIN l ON l.lexeme_id = b.lexeme_id WHERE e.confidence < 0.95 GROUP BY 1, 2""")
def relation_resolutions(spark, sf_dir):
    """F20."""
    s = senses(spark, sf_dir)
    u = edges(spark, sf_dir).where("confidence < 0.95").join(s.select(F.col("sense_key").alias("dst"), F.col("lexeme_id").alias("target_lexeme_id")), "dst").groupBy("src", "target_lexeme_id").agg(F.count("*").alias("relations"))
    return repair.resolutions(u, s.where("not retired").select("sense_id", "lexeme_id"))


_SYM = "sy AS (SELECT DISTINCT src, dst, type FROM edges WHERE type IN ('synonym', 'antonym', 'confusable'))"
_BAD = "v AS (SELECT DISTINCT src, dst, type FROM edges WHERE type IN ('synonym', 'confusable') AND confidence >= 0.97 AND place % 2 = 1)"


def _verdicts(spark, sf_dir):
    c = edges(spark, sf_dir).where("type in ('synonym', 'confusable') and confidence >= 0.97")
    return c.select("src", "dst", "type", F.when(F.expr("place % 2 = 0"), "as_typed").otherwise("related_differently").alias("verdict"))


@query(f"""{_W}, {_SYM}, {_BAD} SELECT src, dst, type, 'verdict' AS step FROM v UNION ALL SELECT sy.src, sy.dst, sy.type, 'verdict_far_side' FROM sy JOIN v ON sy.src = v.dst AND sy.dst = v.src AND sy.type = v.type WHERE NOT EXISTS (SELECT 1 FROM v x WHERE x.src = sy.src AND x.dst = sy.dst AND x.type = sy.type)""")
def verdict_edits(spark, sf_dir):
    """demotions that contrasts ask for, and their far sides."""
    return repair.verdict_edits(edges(spark, sf_dir), _verdicts(spark, sf_dir)).drop("to")


@query(f"""{_W}, {_SYM} SELECT src, dst, type FROM sy a WHERE EXISTS (SELECT 1 FROM edges d WHERE d.type = 'see_also' AND d.src = a.dst AND d.dst = a.src) AND NOT EXISTS (SELECT 1 FROM sy b WHERE b.src = a.dst AND b.dst = a.src AND b.type = a.type)""")
def asymmetric_edits(spark, sf_dir):
    """F22."""
    return repair.asymmetric_edits(edges(spark, sf_dir)).select("src", "dst", "type")


@query(f"""{_W}, {_SYM}, {_BAD}, n AS (SELECT DISTINCT src, dst, type FROM v WHERE type = 'synonym') SELECT src, dst, type, 'hypernym' AS to, 'retype' AS step FROM n UNION ALL SELECT sy.src, sy.dst, sy.type, 'hyponym', 'retype_far_side' FROM sy JOIN n ON sy.src = n.dst AND sy.dst = n.src AND sy.type = n.type WHERE NOT EXISTS (SELECT 1 FROM n x WHERE x.src = sy.src AND x.dst = sy.dst AND x.type = sy.type)""")
def retype_edits(spark, sf_dir):
    """synonyms that a contrast calls related differently become hypernyms, their far sides hyponyms."""
    p = _verdicts(spark, sf_dir).where("type = 'synonym' and verdict != 'as_typed'").select("src", "dst", "type", F.lit("hypernym").alias("to")).distinct()
    return repair.retype_edits(edges(spark, sf_dir), p)


_REL = "rl AS (SELECT DISTINCT a.sense_id, a.headword, e.type, CASE e.ord % 5 WHEN 0 THEN b.headword || 's' WHEN 1 THEN a.headword || 's' WHEN 2 THEN 'big ' || a.headword WHEN 3 THEN 'informal term' ELSE b.headword END AS target_term FROM edges e JOIN senses a ON a.sense_key = src JOIN senses b ON b.sense_key = dst)"


def _relations(spark, sf_dir):
    s = senses(spark, sf_dir)
    e = edges(spark, sf_dir).join(s.select(F.col("sense_key").alias("src"), "sense_id", "headword"), "src").join(s.select(F.col("sense_key").alias("dst"), F.col("headword").alias("h")), "dst")
    return e.select("sense_id", "headword", "type", F.expr("case ord % 5 when 0 then concat(h, 's') when 1 then concat(headword, 's') when 2 then concat('big ', headword) when 3 then 'informal term' else h end").alias("target_term")).distinct()


_PL = "CASE WHEN regexp_matches({0}, '[^aeiouy]y$') THEN left({0}, length({0}) - 1) || 'ies' WHEN regexp_matches({0}, '(s|x|z|ch|sh)$') THEN {0} || 'es' ELSE {0} || 's' END"


@query(f"""{_W}, {_REL}, o AS (SELECT sense_id, type, target_term, 'headword' AS of, headword AS base FROM rl WHERE target_term = headword OR target_term = {_PL.format('headword')}),
b AS (SELECT x.sense_id, x.type, x.target_term, arg_min(y.target_term, (length(y.target_term), y.target_term)) AS base FROM rl x JOIN rl y ON x.sense_id = y.sense_id AND x.type = y.type AND x.target_term = {_PL.format('y.target_term')} GROUP BY ALL)
SELECT * FROM o UNION ALL SELECT sense_id, type, target_term, 'sibling', base FROM b WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.sense_id = b.sense_id AND o.type = b.type AND o.target_term = b.target_term)""")
def inflection_edits(spark, sf_dir):
    """the tables' targets have plurals alone."""
    return repair.inflection_edits(_relations(spark, sf_dir))


@query(f"""{_W}, {_REL} SELECT DISTINCT sense_id, type, target_term FROM rl WHERE contains(target_term, ' ') AND lower(target_term) <> lower(headword) AND contains(' ' || lower(target_term) || ' ', ' ' || lower(headword) || ' ') AND lower(target_term) NOT IN (SELECT lower(headword) FROM senses)""")
def phrase_edits(spark, sf_dir):
    """F28."""
    return repair.phrase_edits(_relations(spark, sf_dir), senses(spark, sf_dir))


@query(f"""{_W}, {_REL} SELECT DISTINCT sense_id, type, target_term FROM rl WHERE target_term = 'informal term'""")
def label_edits(spark, sf_dir):
    """F29."""
    return repair.label_edits(_relations(spark, sf_dir))


@query(f"""{_W}, c AS (SELECT DISTINCT split_part(a.headword, ' ', 2) AS alias, CASE WHEN a.sense_key % 9 = 0 THEN 'nothing' ELSE b.lexeme_id END AS target_lexeme FROM edges e JOIN senses a ON a.sense_key = src JOIN senses b ON b.sense_key = dst WHERE e.type = 'synonym'),
k AS (SELECT DISTINCT split_part(a.headword, ' ', 2) AS alias, b.lexeme_id AS target_lexeme FROM edges e JOIN senses a ON a.sense_key = src JOIN senses b ON b.sense_key = dst WHERE e.type = 'antonym'),
g AS (SELECT lexeme_id, bool_or(true) AS there, list(lower(gloss || ' ' || headword)) AS gl FROM senses WHERE NOT retired GROUP BY 1)
SELECT alias, target_lexeme, CASE WHEN g.there IS NULL THEN 'absent' WHEN k.alias IS NOT NULL THEN 'linked' WHEN len(list_filter(gl, lambda x: contains(' ' || x || ' ', ' ' || lower(alias) || ' '))) > 0 THEN 'free' ELSE 'judge' END AS verdict FROM c LEFT JOIN g ON g.lexeme_id = target_lexeme LEFT JOIN k USING (alias, target_lexeme)""")
def alias_verdicts(spark, sf_dir):
    """F33, F39."""
    s = senses(spark, sf_dir)
    side = lambda k: edges(spark, sf_dir).where(F.col("type") == k).join(s.select(F.col("sense_key").alias("src"), "headword"), "src").join(s.select(F.col("sense_key").alias("dst"), F.col("lexeme_id").alias("target_lexeme")), "dst").withColumn("alias", F.split_part("headword", F.lit(" "), F.lit(2)))
    c = side("synonym").select("alias", F.when(F.expr("src % 9 = 0"), "nothing").otherwise(F.col("target_lexeme")).alias("target_lexeme")).distinct()
    live = s.where("not retired").select("lexeme_id", F.concat_ws(" ", "gloss", "headword").alias("gloss"))
    return repair.alias_verdicts(c, live, side("antonym"))


@query(f"""{_W}, w AS (SELECT DISTINCT split_part(headword, ' ', 2) AS word, gloss AS id FROM senses), f AS (SELECT DISTINCT split_part(headword, ' ', 2) AS form, split_part(headword, ' ', 1) AS lemma FROM senses UNION SELECT DISTINCT 'none', split_part(headword, ' ', 2) FROM senses)
SELECT form, lemma, CASE WHEN EXISTS (SELECT 1 FROM w WHERE word = form) THEN EXISTS (SELECT 1 FROM w WHERE word = form AND id NOT IN (SELECT id FROM w x WHERE x.word = lemma)) END AS distinct FROM f""")
def lemma_distinctness(spark, sf_dir):
    """F35."""
    s = senses(spark, sf_dir).select(F.split_part("headword", F.lit(" "), F.lit(1)).alias("a"), F.split_part("headword", F.lit(" "), F.lit(2)).alias("b"), "gloss")
    f = s.select(F.col("b").alias("form"), F.col("a").alias("lemma")).union(s.select(F.lit("none"), "b")).distinct()
    return repair.distinct_from_lemma(f, s.select(F.col("b").alias("word"), F.col("gloss").alias("id")))


@query(f"""{_W}, k AS (SELECT *, {GLOSS.format("gloss || '.'")} AS key FROM senses WHERE NOT retired), m AS (SELECT lexeme_id, key, arg_min(sense_id, sense_index) AS survivor, count(*) AS members FROM k GROUP BY 1, 2 HAVING count(*) > 1)
SELECT survivor, members, count(DISTINCT (e.type, e.dst)) FILTER (e.type IS NOT NULL) AS relations FROM m JOIN k USING (lexeme_id, key) LEFT JOIN edges e ON e.src = k.sense_key GROUP BY 1, 2""")
def merged_senses(spark, sf_dir):
    """Senses of one lexeme with the same gloss, and the relations of the one that stays."""
    s = senses(spark, sf_dir).where("not retired").select("lexeme_id", "sense_id", "sense_index", F.concat("gloss", F.lit(".")).alias("gloss"), "sense_key")
    r = edges(spark, sf_dir).join(s.select(F.col("sense_key").alias("src"), "sense_id"), "src").select("sense_id", "type", F.col("dst").alias("target"))
    return repair.merged_senses(s.drop("sense_key"), r)


@query(f"""WITH {FLAT}, m AS (SELECT x.sense_id, ord, CASE ord % 3 WHEN 0 THEN NULL WHEN 1 THEN x.sense_id || 'x' ELSE x.sense_id END AS "to" FROM x), n AS (SELECT sense_id, count(*) AS have FROM x GROUP BY 1),
q AS (SELECT m.*, have, sum(("to" IS DISTINCT FROM sense_id)::INT) OVER (PARTITION BY sense_id ORDER BY ord) AS nth FROM m JOIN n USING (sense_id)) SELECT sense_id, ord::INT AS ord, "to", CASE WHEN "to" IS NOT DISTINCT FROM sense_id THEN 'nowhere' WHEN nth >= have THEN 'kept' WHEN "to" IS NULL THEN 'dropped' ELSE 'moved' END AS verdict FROM q""")
def example_placements(spark, sf_dir):
    """F37."""
    e = entries(spark, sf_dir)
    x = e.select(F.explode("senses").alias("s")).select("s.sense_id", F.explode("s.examples").alias("x")).select("sense_id", F.substr("x.provenance_id", F.lit(2)).cast("int").alias("ord"))
    return repair.placements(x, x.withColumn("to", F.expr("case ord % 3 when 0 then null when 1 then concat(sense_id, 'x') else sense_id end")))


_TWO = f"{MEASURED}, z AS (SELECT doc_id % 50 AS owner, doc_id, grade > 12 AS hard, words < 100 AS short, row_number() OVER (PARTITION BY doc_id % 50 ORDER BY doc_id) AS n FROM g)"


@query(f"""WITH {_TWO} SELECT owner, CASE WHEN (a.hard, a.short) <= (b.hard, b.short) THEN a.doc_id ELSE b.doc_id END AS text, CASE WHEN (a.hard, a.short) <= (b.hard, b.short) THEN 1 ELSE 2 END AS used FROM (SELECT * FROM z WHERE n = 1) a JOIN (SELECT * FROM z WHERE n = 2) b USING (owner)""")
def better_renditions(spark, sf_dir):
    """Of two documents the one that misses less: a grade of 12 first, then 100 words."""
    m = measured(spark, sf_dir).select((F.col("doc_id") % 50).alias("owner"), F.col("doc_id").alias("text"), (F.col("grade") > 12).alias("hard"), (F.col("words") < 100).alias("short"))
    n = m.withColumn("n", F.row_number().over(Window.partitionBy("owner").orderBy("text")))
    pair = lambda k: n.where(F.col("n") == k).drop("n")
    both = pair(1).join(pair(2).select("owner"), "owner", "left_semi")
    return repair.better(both, pair(2), ["owner"], ["hard", "short"])


@query(f"""WITH {FLAT}, t AS (SELECT unnest(['neutral', 'grade_1', 'grade_5', 'college']) AS reading_level) SELECT reading_level, count(*) AS missing FROM l, t WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.sense_id = l.sense_id AND g.reading_level = t.reading_level) GROUP BY 1""")
def missing_renditions(spark, sf_dir):
    """Renditions that live senses lack, by level."""
    live = E.live_senses(entries(spark, sf_dir).withColumn("source", F.lit("")))
    present = live.select(F.col("sense_id").alias("owner"), F.explode("glosses").alias("g")).select("owner", "g.reading_level", "g.register")
    work = repair.missing_work(live.select(F.col("sense_id").alias("owner")), present, [(x, "plain") for x in ("neutral", "grade_1", "grade_5", "college")])
    return work.groupBy("reading_level").agg(F.count("*").alias("missing"))


@query(f"""{_W}, e AS (SELECT DISTINCT src, dst, type, confidence >= 0.95 AS resolved FROM edges) SELECT CASE WHEN type = 'see_also' THEN 'untyped' WHEN NOT resolved THEN 'unresolved' WHEN src = dst THEN 'self' WHEN src > dst AND EXISTS (SELECT 1 FROM e b WHERE b.resolved AND b.src = e.dst AND b.dst = e.src AND b.type = e.type) THEN 'owned_by_far_side' ELSE 'eligible' END AS reason, count(*) AS edges FROM e GROUP BY 1""")
def contrast_eligibility(spark, sf_dir):
    """E8."""
    e = edges(spark, sf_dir).select("src", "dst", "type", (F.col("confidence") >= 0.95).alias("resolved"))
    return repair.contrast_owners(e).groupBy("reason").agg(F.count("*").alias("edges"))


@query(f"""WITH {FLAT}, s AS (SELECT sense_id FROM l WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.sense_id = l.sense_id AND type = 'synonym')) SELECT sense_id, (SELECT count(DISTINCT t_lexeme) FROM r WHERE r.sense_id = s.sense_id AND type = 'antonym') AS rejected FROM s""")
def regen_slots(spark, sf_dir):
    """Live senses without synonyms; their antonyms stand for rejected targets."""
    made = E.live_senses(entries(spark, sf_dir).withColumn("source", F.lit("")))
    r = made.select("sense_id", F.explode("relations").alias("r")).select("sense_id", "r.type", F.col("r.target_lexeme_id").alias("target"))
    return repair.regen_slots(made.select("sense_id"), r.where("type = 'synonym'"), r.where("type = 'antonym'"))


@query("""WITH m AS (SELECT user_id AS owner, arg_max(event_type, event_id) AS last, arg_max(event_id % 3 + 1, event_id) AS attempt FROM events WHERE event_id % 2 = 0 GROUP BY 1), c AS (SELECT user_id AS owner, max(event_type) AS digest FROM events GROUP BY 1),
n AS (SELECT owner, CASE WHEN last = digest THEN attempt + 1 ELSE 1 END AS attempt FROM c LEFT JOIN m USING (owner)) SELECT owner, attempt::INT AS attempt, attempt <= 2 AS due FROM n""")
def attempt_markers(spark, sf_dir):
    """Events as markers of finished work, and what is due."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("owner"), F.col("event_id").alias("n"), F.col("event_type").alias("digest"), (F.col("event_id") % 3 + 1).alias("attempt"))
    return repair.attempts(e.where("n % 2 = 0"), e.groupBy("owner").agg(F.max("digest").alias("digest")), 2)


@query(f"""WITH {FLAT}, o AS (SELECT sense_id, sense_key, headword, lexeme_id, sense_index FROM k WHERE NOT retired), q AS (SELECT sense_id, regexp_replace({FOLDED.format('text')}, '[.,;:!?…]+$', '') AS q FROM u WHERE role = 'user' AND NOT EXISTS (SELECT 1 FROM k WHERE k.sense_id = u.sense_id AND retired))
SELECT 'contiguous_sense_indices' AS rule, lexeme_id AS id FROM o GROUP BY 2 HAVING max(sense_index) + 1 <> count(*) UNION ALL SELECT 'canonical_gloss_required', sense_id FROM o WHERE sense_key % 7 = 0 UNION ALL SELECT DISTINCT 'queries_are_distinct', sense_id FROM q GROUP BY sense_id, q HAVING count(*) > 1""")
def schema_violations(spark, sf_dir):
    """Entries without their retired senses and some without a canonical gloss: which rules they break."""
    e = entries(spark, sf_dir).withColumn("senses", F.expr("transform(filter(senses, s -> not s.retired), s -> s)")).where("size(senses) > 0")
    keys = senses(spark, sf_dir).where("sense_key % 7 = 0").groupBy("lexeme_id").agg(F.collect_set("sense_id").alias("bare"))
    e = e.join(keys, "lexeme_id", "left").withColumn("senses", F.expr("transform(senses, s -> case when array_contains(coalesce(bare, array()), s.sense_id) then named_struct('sense_index', s.sense_index, 'sense_id', s.sense_id, 'pos', s.pos, 'domain', s.domain, 'retired', s.retired, 'glosses', filter(s.glosses, g -> g.reading_level != 'neutral'), 'examples', s.examples, 'relations', s.relations, 'queries', s.queries, 'qa', s.qa) else s end)"))
    return repair.violations(e)


@query(f"""WITH {FLAT}, t AS (SELECT sense_id, ord, trim(lower(text), ' ') AS k FROM (SELECT sense_id, 1 AS ord, headword AS text FROM l UNION ALL SELECT sense_id, 2, upper(headword) FROM l WHERE sense_key % 2 = 0 UNION ALL SELECT sense_id, 3, 'a ' || headword FROM l))
SELECT sense_id AS owner, ord, (SELECT min(ord) FROM t f WHERE f.sense_id = t.sense_id AND f.k = t.k) AS first FROM t WHERE ord > (SELECT min(ord) FROM t f WHERE f.sense_id = t.sense_id AND f.k = t.k)""")
def degenerate_renditions(spark, sf_dir):
    """Renditions that repeat an earlier one of their sense."""
    s = senses(spark, sf_dir).where("not retired")
    r = s.select(F.col("sense_id").alias("owner"), F.lit(1).alias("ord"), F.col("headword").alias("text")).union(s.where("sense_key % 2 = 0").select("sense_id", F.lit(2), F.upper("headword"))).union(s.select("sense_id", F.lit(3), F.concat(F.lit("a "), "headword")))
    return repair.degenerate(r)


@query(f"""WITH {FLAT} SELECT domain, count(*) AS glosses, count(*) FILTER (contains(' ' || lower(t) || ' ', ' ' || lower(headword) || ' ')) AS circular FROM (SELECT domain, headword, CASE WHEN sense_key % 2 = 0 THEN gloss ELSE gloss || ' ' || headword END AS t FROM l) GROUP BY domain""")
def circular_glosses(spark, sf_dir):
    """A read-only scan of glosses that name their headword."""
    s = senses(spark, sf_dir).where("not retired").select("sense_id", "domain", "headword", F.expr("case when sense_key % 2 = 0 then gloss else concat(gloss, ' ', headword) end").alias("text"))
    bad = repair.circular(s).groupBy("domain").agg(F.count("*").alias("circular"))
    return s.groupBy("domain").agg(F.count("*").alias("glosses")).join(bad, "domain", "left").withColumn("circular", F.coalesce("circular", F.lit(0)))


@query(f"""WITH {FLAT}, d AS (SELECT sense_id, headword, 'old ' || gloss || ' ' || headword AS old, CASE sense_key % 4 WHEN 0 THEN '' WHEN 1 THEN gloss || ' ' || headword WHEN 2 THEN 'something else' ELSE gloss || ' thing ' || sense_index END AS new, sense_key FROM l), o AS (SELECT DISTINCT lower(gloss || ' thing ' || 0) AS key FROM l)
SELECT sense_id, CASE WHEN trim(new) = '' THEN 'empty' WHEN contains(' ' || lower(new) || ' ', ' ' || lower(headword) || ' ') THEN 'circular' WHEN len(list_intersect({CONTENT.format('old')}, {CONTENT.format('new')})) < 1 THEN 'unrelated' WHEN lower(trim(new)) IN (SELECT key FROM o) THEN 'collision' ELSE 'accepted' END AS reason FROM d""")
def rewrite_verdicts(spark, sf_dir):
    """E16."""
    s = senses(spark, sf_dir).where("not retired")
    new = F.expr("case sense_key % 4 when 0 then '' when 1 then concat(gloss, ' ', headword) when 2 then 'something else' else concat(gloss, ' thing ', sense_index) end")
    d = s.select("sense_id", "headword", F.concat_ws(" ", F.lit("old"), "gloss", "headword").alias("old"), new.alias("new"))
    return repair.rewrites(d, s.select(F.concat("gloss", F.lit(" thing 0")).alias("g")).select(T.gloss_key("g").alias("key")))


@query(f"""{_W}, p AS (SELECT lexeme_id, gloss AS pos, min(sense_index) AS ord, bool_or(price > 905) AS c FROM senses WHERE NOT retired GROUP BY 1, 2), n AS (SELECT lexeme_id, count(*) AS have, count(*) FILTER (c) AS asked, min(ord) FILTER (c) AS first FROM p GROUP BY 1)
SELECT lexeme_id, pos, NOT (asked = have AND ord = first) AS retired FROM p JOIN n USING (lexeme_id) WHERE c""")
def last_part_of_speech(spark, sf_dir):
    """Glosses as parts of speech: the dear ones go, but no lexeme loses its last."""
    s = senses(spark, sf_dir).where("not retired").select("lexeme_id", F.col("gloss").alias("pos"), F.col("sense_index").alias("ord"), "price")
    return repair.last_kept(s.where("price > 905").select("lexeme_id", "pos"), s.drop("price"))


@query(f"""WITH {TURNS}, f AS (SELECT conv_id, turn, list_sort(list_distinct(list_concat(list_filter(CASE WHEN turn % 2 = 0 THEN ['filler', 'old'] ELSE ['kept'] END, lambda x: x <> 'old'), CASE WHEN length(text) > 200 THEN ['long'] ELSE [] END))) AS f FROM t) SELECT conv_id, turn, array_to_string(f, ',') AS flags FROM f""")
def flag_edits(spark, sf_dir):
    """Flags added and removed, twice over with the same result."""
    t = turns(spark, sf_dir).withColumn("flags", F.expr("case when turn % 2 = 0 then array('filler', 'old') else array('kept') end"))
    names, gone = F.expr("case when length(text) > 200 then array('long') else cast(array() as array<string>) end"), F.array(F.lit("old"))
    twice = repair.flagged(repair.flagged(t, "flags", names, gone), "flags", names, gone)
    return twice.select("conv_id", "turn", F.array_join("flags", ",").alias("flags"))


@query()
def word_budget_chunks(spark, sf_dir):
    """Turns of a conversation in chunks of a hundred words."""
    t = turns(spark, sf_dir).withColumn("n", T.word_count("text"))
    return repair.by_word_budget(t, "conv_id", "turn", "n", 100)


@query()
def example_sieve(spark, sf_dir):
    """The lines of each document as drafted examples, eight accepted."""
    x = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    return repair.example_sieve(x, "doc_id", "line", "text", 30, 8).groupBy("doc_id", "reason").agg(F.count("*").alias("lines"))


_DRAFT = f"{TURNS}, w AS (SELECT *, regexp_extract_all(lower(text), '[a-z]+') AS w FROM t), dr AS (SELECT conv_id, turn, text, coalesce(w[1], 'x') AS a, CASE WHEN turn % 3 = 0 THEN 'zzz' ELSE coalesce(w[2], 'y') END AS b, left(text, 60) AS ga FROM w)"


@query(f"""WITH {_DRAFT}, c AS (SELECT *, len({WORDS.format('text')}) AS n FROM dr) SELECT CASE WHEN text = '' THEN 'empty' WHEN n < 20 THEN 'too_short' WHEN n > 60 THEN 'too_long' WHEN NOT contains(' ' || lower(text) || ' ', ' ' || a || ' ') THEN 'source_absent' WHEN NOT contains(' ' || lower(text) || ' ', ' ' || b || ' ') THEN 'target_absent'
WHEN len({WORDS.format('ga')}) >= 6 AND contains({PARAGRAPH.format('text')}, {PARAGRAPH.format('ga')}) THEN 'gloss_copy' ELSE 'accepted' END AS reason, count(*) AS drafts FROM c GROUP BY 1""")
def contrast_sieve(spark, sf_dir):
    """E5: turns as drafted contrasts, reasons counted."""
    w = F.expr("regexp_extract_all(lower(text), '[a-z]+', 0)")
    d = turns(spark, sf_dir).withColumn("w", w).select("text", F.coalesce(F.get("w", F.lit(0)), F.lit("x")).alias("a"), F.when(F.expr("turn % 3 = 0"), "zzz").otherwise(F.coalesce(F.get("w", F.lit(1)), F.lit("y"))).alias("b"), F.left("text", F.lit(60)).alias("ga"), F.lit("").alias("gb"))
    return d.select(F.coalesce(P.contrast_reason("text", "a", "b", "ga", "gb", 20, 60), F.lit("accepted")).alias("reason")).groupBy("reason").agg(F.count("*").alias("drafts"))


@query(f"""WITH {TURNS}, s AS (SELECT conv_id, unnest(string_split(text, chr(10))) AS line FROM t) SELECT conv_id, count(*) FILTER (len({WORDS.format('line')}) >= 3 AND regexp_matches(line, '[A-Za-z]')) AS kept, count(*) FILTER (len({WORDS.format('line')}) < 3 OR NOT regexp_matches(line, '[A-Za-z]')) AS removed,
coalesce(string_agg(line, '|' ORDER BY line) FILTER (len({WORDS.format('line')}) < 3 OR NOT regexp_matches(line, '[A-Za-z]')), '') AS note FROM s GROUP BY conv_id""")
def garbage_removal(spark, sf_dir):
    """Lines that are no sentences go, their text stays in a note."""
    s = turns(spark, sf_dir).select("conv_id", F.explode(F.split("text", "\n")).alias("line")).withColumn("g", P.garbage("line"))
    return s.groupBy("conv_id").agg(F.count_if(~F.col("g")).alias("kept"), F.count_if("g").alias("removed"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("g"), F.col("line")))), "|").alias("note"))


@query(rf"""WITH {TURNS}, a AS (SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 'According to the sources, ' || left(text, 90) WHEN 1 THEN left(text, 40) || ' as described above' WHEN 2 THEN 'As stated in the entry, ' ELSE left(text, 90) END AS answer, left(text, 80) AS gloss FROM t)
SELECT turn % 4 AS kind, count(*) AS answers, round(avg((regexp_matches(answer, '(?i)\b(the examples?|the passage|the sources)\b|\baccording to the (?:sources?|text|example|passage|gloss|entry|definition)\b|\bas (?:described|stated|mentioned|shown) (?:in|above)\b'))::INT), 6) AS meta, round(avg((gloss <> '' AND left({FOLDED.format('answer')}, 60) = left({FOLDED.format('gloss')}, 60))::INT), 6) AS echo FROM a GROUP BY 1""")
def qa_audit(spark, sf_dir):
    """Rates of meta-references and echoes among stored answers."""
    a = answers(spark, sf_dir)
    rate = lambda c: F.round(F.avg(c.cast("int")), 6)
    return a.groupBy((F.col("turn") % 4).alias("kind")).agg(F.count("*").alias("answers"), rate(P.meta_reference("answer").isNotNull()).alias("meta"), rate(P.gloss_echo("answer", "gloss")).alias("echo"))


@query(f"""{_W}, s AS (SELECT lexeme_id, headword, list(DISTINCT lower(gloss)) AS gl, count(DISTINCT domain) AS domains FROM senses WHERE NOT retired GROUP BY 1, 2) SELECT lexeme_id, len(list_intersect(gl, ['economy', 'promo'])) > 0 AND domains >= 2 AS signalled FROM s""")
def phantom_signal(spark, sf_dir):
    """Entries that several conditions on their glosses and domains mark to be looked at first."""
    s = senses(spark, sf_dir).where("not retired").groupBy("lexeme_id").agg(F.collect_set(F.lower("gloss")).alias("gl"), F.count_distinct("domain").alias("d"))
    return s.select("lexeme_id", (F.arrays_overlap("gl", F.array(F.lit("economy"), F.lit("promo"))) & (F.col("d") >= 2)).alias("signalled"))
