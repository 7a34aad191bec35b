"""Queries over the relation graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexweave.catalog import query
from lexweave.operators import graph
from lexweave.plans.views import EDGES_SQL, SENSES_SQL, edges, senses

_SYN = "syn AS (SELECT DISTINCT src, dst FROM (SELECT src, dst FROM edges WHERE type = 'synonym' AND src <> dst UNION ALL SELECT dst, src FROM edges WHERE type = 'synonym' AND src <> dst))"
_HYP = "hyp AS (SELECT DISTINCT src, dst FROM edges WHERE type = 'hypernym' AND src <> dst)"
_CO = "co AS (SELECT DISTINCT a.src, b.src AS dst FROM hyp a JOIN hyp b ON a.dst = b.dst AND a.src <> b.src)"
_TWO = "two AS (SELECT DISTINCT a.src, b.dst FROM syn a JOIN syn b ON a.dst = b.src AND a.src <> b.dst WHERE NOT EXISTS (SELECT 1 FROM syn s WHERE s.src = a.src AND s.dst = b.dst))"


@query(f"WITH {EDGES_SQL}, {SENSES_SQL} SELECT type, count(*) AS edges FROM edges JOIN senses a ON src = a.sense_key JOIN senses b ON dst = b.sense_key WHERE NOT a.retired AND NOT b.retired GROUP BY type")
def live_edge_join(spark, sf_dir):
    """F1."""
    return graph.live(edges(spark, sf_dir), senses(spark, sf_dir)).groupBy("type").agg(F.count("*").alias("edges"))


@query(f"WITH {EDGES_SQL} SELECT src, dst, round(max(confidence), 6) AS confidence, count(*) AS assertions FROM edges WHERE type = 'hypernym' GROUP BY src, dst")
def hypernym_graph(spark, sf_dir):
    """F7, F8."""
    g = graph.asserted(edges(spark, sf_dir).where("type = 'hypernym'"))
    return g.select("src", "dst", F.round("confidence", 6).alias("confidence"), "assertions")


@query(f"WITH {EDGES_SQL}, {_HYP} SELECT dst AS hypernym, count(*) AS children, min(src) AS first_child FROM hyp GROUP BY dst")
def children_index(spark, sf_dir):
    """F2."""
    h = edges(spark, sf_dir).where("type = 'hypernym' and src != dst").select("src", "dst").distinct()
    return h.groupBy(F.col("dst").alias("hypernym")).agg(F.count("*").alias("children"), F.min("src").alias("first_child"))


@query(f"WITH {EDGES_SQL}, {_HYP}, {_CO} SELECT src, dst FROM co")
def co_hyponyms(spark, sf_dir):
    """F3."""
    return graph.co_hyponyms(edges(spark, sf_dir))


@query(f"WITH {EDGES_SQL}, {_SYN}, {_TWO} SELECT src, dst FROM two")
def two_hop(spark, sf_dir):
    """F4."""
    return graph.two_hop(edges(spark, sf_dir))


@query(f"""WITH {EDGES_SQL}, {_SYN}, {_HYP}, {_CO}, {_TWO}, con AS (SELECT DISTINCT src, dst FROM (SELECT src, dst FROM edges WHERE type = 'confusable' AND src <> dst UNION ALL SELECT dst, src FROM edges WHERE type = 'confusable' AND src <> dst)),
a AS (SELECT src, dst, 1 AS r, 'synonym' AS tier FROM syn UNION ALL SELECT src, dst, 2, 'hypernym' FROM hyp UNION ALL SELECT src, dst, 3, 'co_hyponym' FROM co UNION ALL SELECT src, dst, 5, 'confusable' FROM con UNION ALL SELECT src, dst, 6, 'synonym_of_synonym' FROM two),
b AS (SELECT src, dst, arg_min(tier, r) AS tier FROM a GROUP BY src, dst) SELECT tier, count(*) AS pairs, count(DISTINCT src) AS senses FROM b GROUP BY tier""")
def tier_classify(spark, sf_dir):
    """F5."""
    return graph.tiers(edges(spark, sf_dir)).groupBy("tier").agg(F.count("*").alias("pairs"), F.count_distinct("src").alias("senses"))


@query(f"WITH {EDGES_SQL}, {SENSES_SQL} SELECT e.type, count(*) AS loops FROM edges e JOIN senses a ON src = a.sense_key JOIN senses b ON dst = b.sense_key WHERE a.lexeme_id = b.lexeme_id GROUP BY e.type")
def self_loops(spark, sf_dir):
    """edges whose ends share a lexeme."""
    s = senses(spark, sf_dir)
    side = lambda x: s.select(F.col("sense_key").alias(x), F.col("lexeme_id").alias(f"lex_{x}"))
    return edges(spark, sf_dir).join(side("src"), "src").join(side("dst"), "dst").where("lex_src = lex_dst").groupBy("type").agg(F.count("*").alias("loops"))


@query(f"WITH {EDGES_SQL}, {_HYP} SELECT a.src AS a, a.dst AS b FROM hyp a JOIN hyp b ON a.src = b.dst AND a.dst = b.src WHERE a.src < a.dst")
def mutual_pairs(spark, sf_dir):
    """F10."""
    return graph.mutual_pairs(edges(spark, sf_dir))


@query(f"""WITH {EDGES_SQL}, e AS (SELECT DISTINCT type, src, dst FROM edges WHERE type IN ('synonym', 'antonym', 'confusable') AND src <> dst)
SELECT e.type, count(*) AS asserted, count(r.src) AS reciprocated FROM e LEFT JOIN e r ON r.type = e.type AND r.src = e.dst AND r.dst = e.src GROUP BY e.type""")
def reciprocity_audit(spark, sf_dir):
    """F16."""
    return graph.reciprocity(edges(spark, sf_dir))


@query(f"""WITH {EDGES_SQL}, e AS (SELECT type, src, dst, max(confidence) AS c FROM edges WHERE type IN ('synonym', 'antonym', 'confusable') AND src <> dst GROUP BY ALL)
SELECT e.dst AS src, e.src AS dst, e.type, round(e.c, 6) AS confidence FROM e WHERE NOT EXISTS (SELECT 1 FROM e r WHERE r.type = e.type AND r.src = e.dst AND r.dst = e.src)
AND NOT EXISTS (SELECT 1 FROM edges d WHERE d.type = 'see_also' AND d.src = e.dst AND d.dst = e.src)""")
def reciprocity_additions(spark, sf_dir):
    """F15."""
    return graph.reciprocal_additions(edges(spark, sf_dir)).withColumn("confidence", F.round("confidence", 6))


@query(f"WITH {EDGES_SQL} SELECT src, type, dst, round(confidence, 6) AS confidence, place, ord FROM (SELECT *, row_number() OVER (PARTITION BY src, type, dst ORDER BY place, ord) AS n FROM edges) WHERE n = 1")
def edge_dedup(spark, sf_dir):
    """F24."""
    return graph.dedup(edges(spark, sf_dir), ["place", "ord"]).withColumn("confidence", F.round("confidence", 6))


@query(f"""WITH {EDGES_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY src, type ORDER BY confidence DESC, place, ord) AS n FROM edges)
SELECT src, type, count(*) AS kept, max(place) AS last_place FROM r WHERE n <= CASE type WHEN 'synonym' THEN 8 WHEN 'hypernym' THEN 4 WHEN 'antonym' THEN 3 WHEN 'confusable' THEN 3 ELSE 8 END GROUP BY src, type""")
def cap_per_type(spark, sf_dir):
    """F25."""
    return graph.cap(edges(spark, sf_dir), [F.desc("confidence"), "place", "ord"]).groupBy("src", "type").agg(F.count("*").alias("kept"), F.max("place").alias("last_place"))


@query(f"""WITH {EDGES_SQL}, p AS (SELECT src, dst, list(DISTINCT type) AS t FROM edges GROUP BY src, dst)
SELECT src, dst, CASE WHEN list_contains(t, 'synonym') AND src = dst THEN 'self_synonym' WHEN list_contains(t, 'synonym') AND list_contains(t, 'antonym') THEN 'antonym_synonym' ELSE 'synonym_hypernym' END AS rule
FROM p WHERE list_contains(t, 'synonym') AND (src = dst OR list_contains(t, 'antonym') OR list_contains(t, 'hypernym'))""")
def contradiction_rules(spark, sf_dir):
    """F31."""
    return graph.contradictions(edges(spark, sf_dir))


@query(f"WITH {EDGES_SQL} SELECT type, count(*) FILTER (NOT (type = 'see_also' AND confidence < 0.95)) AS kept, count(*) FILTER (type = 'see_also' AND confidence < 0.95) AS removed FROM edges GROUP BY type")
def tombstone_split(spark, sf_dir):
    """F23."""
    kept, gone = graph.tombstones(edges(spark, sf_dir), 0.95)
    both = kept.select("type", F.lit(1).alias("k"), F.lit(0).alias("r")).union(gone.select("type", F.lit(0), F.lit(1)))
    return both.groupBy("type").agg(F.sum("k").alias("kept"), F.sum("r").alias("removed"))


@query(f"""WITH RECURSIVE {EDGES_SQL}, n AS (SELECT src, dst FROM edges WHERE type = 'antonym' AND src <> dst), u AS (SELECT src, dst FROM n UNION SELECT dst, src FROM n),
cc(id, comp) USING KEY (id) AS (SELECT DISTINCT src, src FROM u UNION (SELECT u.dst, min(cc.comp) FROM cc JOIN u ON u.src = cc.id JOIN recurring.cc AS old ON old.id = u.dst WHERE cc.comp < old.comp GROUP BY u.dst))
SELECT id AS node, comp AS root FROM cc""")
def connected_components(spark, sf_dir):
    """F19, over the antonym edges."""
    return graph.components(edges(spark, sf_dir).where("type = 'antonym'"))


@query(f"""WITH RECURSIVE {EDGES_SQL}, a AS (SELECT DISTINCT src, dst FROM edges WHERE type = 'antonym' AND src <> dst), n AS (SELECT src AS id FROM a UNION SELECT dst FROM a),
r(x, y) AS (SELECT id, id FROM n UNION SELECT r.x, a.dst FROM r JOIN a ON a.src = r.y), s AS (SELECT p.x AS node, min(p.y) AS scc FROM r p JOIN r q ON p.x = q.y AND p.y = q.x GROUP BY p.x),
c AS (SELECT scc, count(*) AS n FROM s GROUP BY scc) SELECT CASE WHEN n = 1 THEN '1' WHEN n = 2 THEN '2' WHEN n <= 10 THEN '3-10' ELSE 'over 10' END AS size, count(*) AS components, sum(n)::BIGINT AS nodes FROM c GROUP BY 1""")
def scc_sizes(spark, sf_dir):
    """strongly connected components of the antonym edges by size."""
    return _by_size(edges(spark, sf_dir).where("type = 'antonym'"))


def _by_size(e):
    """Strongly connected components of edges e by size."""
    c = graph.strong_components(e).groupBy("scc").agg(F.count("*").alias("n"))
    size = F.when(F.col("n") == 1, "1").when(F.col("n") == 2, "2").when(F.col("n") <= 10, "3-10").otherwise("over 10")
    return c.groupBy(size.alias("size")).agg(F.count("*").alias("components"), F.sum("n").cast("long").alias("nodes"))


@query()
def connected_components_all(spark, sf_dir):
    """F19, over the edges of every type."""
    return graph.components(edges(spark, sf_dir))


@query()
def scc_sizes_hypernym(spark, sf_dir):
    """strongly connected components of the hypernym edges by size."""
    return _by_size(edges(spark, sf_dir).where("type = 'hypernym'"))


@query()
def cycle_break(spark, sf_dir):
    """F13 over the hypernym edges: those to demote."""
    return graph.cycle_edges(edges(spark, sf_dir).where("type = 'hypernym'"))


@query(f"""WITH RECURSIVE {EDGES_SQL}, e AS (SELECT DISTINCT src, dst FROM edges WHERE type = 'synonym' AND src <> dst),
b(node, depth) AS (SELECT 1::BIGINT, 0 UNION SELECT e.dst, b.depth + 1 FROM b JOIN e ON e.src = b.node WHERE b.depth < 3) SELECT node, min(depth)::INT AS depth FROM b GROUP BY node""")
def bfs_depth(spark, sf_dir):
    """three steps from part 1 along synonyms."""
    seed = spark.range(1, 2).withColumnRenamed("id", "node")
    return graph.bfs(edges(spark, sf_dir).where("type = 'synonym'"), seed, 3)


@query(f"""WITH {EDGES_SQL}, d AS (SELECT src, dst, count(*) AS n FROM edges WHERE type = 'synonym' GROUP BY ALL) SELECT src, dst, n AS before, 1::BIGINT AS after FROM d WHERE n <> 1""")
def snapshot_diff(spark, sf_dir):
    """What deduplication changes, as a difference of two snapshots."""
    e = edges(spark, sf_dir).where("type = 'synonym'")
    count = lambda x: x.groupBy("src", "dst").agg(F.count("*").alias("n"))
    return graph.snapshot_diff(count(e), count(graph.dedup(e, ["place", "ord"])), ["src", "dst"], "n")


@query(f"""WITH RECURSIVE {EDGES_SQL}, e AS (SELECT DISTINCT src, dst FROM edges WHERE src <> dst),
b(node, depth) AS (SELECT sense_key, 0 FROM (SELECT p_partkey AS sense_key FROM part WHERE p_partkey % 100 = 1) UNION SELECT e.dst, b.depth + 1 FROM b JOIN e ON e.src = b.node WHERE b.depth < 2) SELECT node, min(depth)::INT AS depth FROM b GROUP BY node""")
def bfs_all_types(spark, sf_dir):
    """Two steps along relations of every type from every hundredth part."""
    seeds = senses(spark, sf_dir).where("sense_key % 100 = 1").select(F.col("sense_key").alias("node"))
    return graph.bfs(edges(spark, sf_dir), seeds, 2)


@query(f"""WITH {EDGES_SQL}, d AS (SELECT src, dst, type, count(*) AS n FROM edges GROUP BY ALL) SELECT src, dst, type, n AS before, 1::BIGINT AS after FROM d WHERE n <> 1""")
def snapshot_diff_all(spark, sf_dir):
    """What deduplication changes, over the edges of every type."""
    count = lambda x: x.groupBy("src", "dst", "type").agg(F.count("*").alias("n"))
    e = edges(spark, sf_dir)
    return graph.snapshot_diff(count(e), count(graph.dedup(e, ["place", "ord"])), ["src", "dst", "type"], "n")
