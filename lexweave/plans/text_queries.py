"""Queries over texts: metrics, duplicates, n-grams, diversity, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexweave.catalog import query
from lexweave.functions import text as T
from lexweave.operators import minhash, stats
from lexweave.plans.views import table, texts

WORDS = r"list_filter(regexp_extract_all(coalesce({0}, ''), '[\p{{L}}\p{{N}}_''’]+'), lambda w: regexp_matches(w, '[\p{{L}}\p{{N}}]'))"
HAS_WORD = r"regexp_matches({0}, '[\p{{L}}\p{{N}}]')"
SENTENCES = "list_filter(list_transform(regexp_split_to_array(coalesce({0}, ''), '[.!?…]+'), lambda s: trim(s, ' ')), lambda s: s <> '')"
LETTERS = r"regexp_replace(lower(w), '[^\p{L}]', '', 'g')"
SYLLABLES = (
    "CASE WHEN {l} = '' THEN length(regexp_replace(w, '[^\\p{{Nd}}]', '', 'g')) ELSE greatest(1, len(regexp_extract_all({l}, '[aeiouy]+')) - CASE WHEN len(regexp_extract_all({l}, '[aeiouy]+')) > 1 AND "
    "CASE WHEN {l} LIKE '%es' THEN NOT regexp_matches({l}, '(ses|xes|zes|ches|shes|ges|ces|les)$') WHEN {l} LIKE '%ed' THEN NOT regexp_matches({l}, '(ted|ded)$') "
    "ELSE {l} LIKE '%e' AND NOT regexp_matches({l}, '(le|ee|ye|oe|ie)$') END THEN 1 ELSE 0 END) END"
).format(l=LETTERS)
MEASURED = f"""m AS (
  SELECT doc_id, lang, source, text, len(ws)::BIGINT AS words,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[.!?…]+'), lambda s: {HAS_WORD.format('s')}))::BIGINT AS sentences,
         coalesce(list_sum(list_transform(ws, lambda w: {SYLLABLES})), 0)::BIGINT AS syllables
  FROM (SELECT *, {WORDS.format('text')} AS ws FROM documents)),
g AS (SELECT *, CASE WHEN words = 0 THEN 0.0 ELSE 0.39 * (words / greatest(1, sentences)) + 11.8 * (CASE WHEN syllables = 0 THEN words ELSE syllables END / words) - 15.59 END::DOUBLE AS grade FROM m)"""
CONTENT = "list_filter(list_distinct(regexp_extract_all(lower(coalesce({0}, '')), '[a-z]+')), lambda w: NOT list_contains([" + ", ".join(f"'{w}'" for w in T.STOPWORDS) + "], w))"
FOLDED = r"trim(regexp_replace(replace(lower(coalesce({0}, '')), 'ß', 'ss'), '[ \t\n\r\f]+', ' ', 'g'), ' ')"


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir, "documents", "doc_id", "lang", "source", "text").select("doc_id", "lang", "source", F.expr(T.words_sql("text")).alias("w"), T.sentence_count("text").alias("sentences"))
    m = docs.select("doc_id", "lang", "source", F.size("w").cast("long").alias("words"), "sentences", T.syllables_of("w").alias("syllables"))
    return m.withColumn("grade", T.fk_grade(F.col("words"), F.col("sentences"), F.col("syllables")))


@query(f"WITH {MEASURED} SELECT doc_id, words, sentences, syllables, round(grade, 6) AS grade FROM g")
def doc_readability(spark, sf_dir):
    """Words, sentences, syllables and grade of every document."""
    return measured(spark, sf_dir).select("doc_id", "words", "sentences", "syllables", F.round("grade", 6).alias("grade"))


@query(f"""WITH {MEASURED} SELECT lang, count(*) AS docs, sum(words)::BIGINT AS words, round(avg(grade), 6) AS mean_grade, round(quantile_cont(grade, 0.1), 6) AS p10,
round(quantile_cont(grade, 0.5), 6) AS p50, round(quantile_cont(grade, 0.9), 6) AS p90 FROM g GROUP BY lang""")
def doc_fk_grade_by_lang(spark, sf_dir):
    """The grade's distribution by language."""
    return stats.distribution(measured(spark, sf_dir), ["lang"], "grade", "docs", {"words": F.sum("words")}).withColumnRenamed("mean", "mean_grade")


@query(f"""WITH {MEASURED}, b AS (SELECT lang, CASE WHEN grade < 3 THEN 'grade_1' WHEN grade < 7 THEN 'grade_5' WHEN grade < 12 THEN 'neutral' WHEN grade < 16 THEN 'college' ELSE 'expert' END AS level FROM g)
SELECT lang, level, count(*) AS docs, round(count(*) / sum(count(*)) OVER (PARTITION BY lang), 6) AS share FROM b GROUP BY lang, level""")
def doc_grade_band_share(spark, sf_dir):
    """The share of documents in each grade band."""
    return stats.shares(measured(spark, sf_dir).withColumn("level", T.grade_level(F.col("grade"))), ["lang"], ["level"], "docs")


@query(r"""WITH s AS (SELECT conv_id, turn, coalesce(text, '') AS t FROM conversations),
a AS (SELECT conv_id, turn, regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '(?m)^[ \t]*```[^\n]*$', '', 'g'), '(?m)^[ \t]{0,3}#{1,6}[ \t]+', '', 'g'), '(?m)^[ \t]*>[ \t]?', '', 'g'), '(?m)^[ \t]*(?:[-*+]|\d+[.)])[ \t]+', '', 'g') AS t FROM s),
b AS (SELECT conv_id, turn, regexp_replace(regexp_replace(regexp_replace(t, '(\*\*|__)([^*_\n]+)(\*\*|__)', '\2', 'g'), '\*([^*\n]+)\*', '\1', 'g'), '(^|[^\p{L}\p{N}_])_([^_\n]+)_($|[^\p{L}\p{N}_])', '\1\2\3', 'g') AS t FROM a)
SELECT conv_id, turn, trim(regexp_replace(replace(t, '`', ''), '(?m)[ \t]+$', '', 'g'), chr(32) || chr(9) || chr(13) || chr(10)) AS plain FROM b""")
def conversation_markdown_strip(spark, sf_dir):
    """Turns without markdown."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.strip_markdown("text").alias("plain"))


@query(f"SELECT doc_id, len(c)::BIGINT AS n_content, md5(array_to_string(list_sort(c), ' ')) AS content_md5 FROM (SELECT doc_id, {CONTENT.format('text')} AS c FROM documents)")
def doc_content_words(spark, sf_dir):
    """The set of content words."""
    c = table(spark, sf_dir, "documents").select("doc_id", F.expr(T.content_words_sql("text")).alias("c"))
    return c.select("doc_id", F.size("c").cast("long").alias("n_content"), F.md5(F.array_join(F.array_sort("c"), " ").cast("binary")).alias("content_md5"))


@query(f"""WITH p AS (SELECT conv_id, turn, {CONTENT.format('text')} AS a, lead({CONTENT.format('text')}) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM conversations),
j AS (SELECT conv_id, turn, CASE WHEN len(a) = 0 AND len(b) = 0 THEN 1.0 ELSE len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END AS j FROM p WHERE b IS NOT NULL)
SELECT conv_id, turn, round(1 - j, 6) AS diversity, j >= 0.9 AS near_copy FROM j""")
def turn_pair_jaccard(spark, sf_dir):
    """Lexical diversity of a turn and the next one."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.expr(T.content_words_sql("text")).alias("a"))
    pairs = turns.withColumn("b", F.lead("a").over(Window.partitionBy("conv_id").orderBy("turn"))).where("b is not null")
    return pairs.select("conv_id", "turn", F.round(1 - T.jaccard("a", "b"), 6).alias("diversity"), (T.jaccard("a", "b") >= 0.9).alias("near_copy"))


@query(f"""WITH p AS (SELECT conv_id, role, {CONTENT.format('text')} AS a, lead({CONTENT.format('text')}) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM conversations),
d AS (SELECT role, 1 - CASE WHEN len(a) = 0 AND len(b) = 0 THEN 1.0 ELSE len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END AS d FROM p WHERE b IS NOT NULL)
SELECT role, least(floor(d * 10), 9)::INT AS bucket, count(*) AS n, round(avg(d), 6) AS mean FROM d GROUP BY role, bucket""")
def near_copy_histogram(spark, sf_dir):
    """Diversity of neighbouring turns in ten buckets, the last one closed."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.expr(T.content_words_sql("text")).alias("a"))
    pairs = turns.withColumn("b", F.lead("a").over(Window.partitionBy("conv_id").orderBy("turn"))).where("b is not null").withColumn("d", 1 - T.jaccard("a", "b"))
    return pairs.groupBy("role", F.least(F.floor(F.col("d") * 10), F.lit(9)).cast("int").alias("bucket")).agg(F.count("*").alias("n"), F.round(F.avg("d"), 6).alias("mean"))


@query(f"""WITH k AS (SELECT doc_id, {FOLDED.format('text')} AS k FROM documents)
SELECT md5(k) AS key, count(*) AS copies, min(doc_id) AS first_doc FROM k GROUP BY k HAVING count(*) > 1""")
def exact_duplicates(spark, sf_dir):
    """Groups of documents with the same folded text; the text itself is not shuffled, its digests are."""
    return stats.duplicate_groups(table(spark, sf_dir, "documents").select("doc_id", T.folded("text").alias("k")), "k", "doc_id")


@query(f"""WITH k AS (SELECT lang, {FOLDED.format('text')} AS k FROM documents)
SELECT lang, count(*) AS docs, count(DISTINCT k) AS distinct_docs, round(1 - count(DISTINCT k) / count(*), 6) AS duplicate_share FROM k GROUP BY lang""")
def duplicate_share_by_lang(spark, sf_dir):
    """Rows less distinct texts."""
    k = table(spark, sf_dir, "documents").select("lang", F.sha2(T.folded("text").cast("binary"), 256).alias("k"))
    out = k.groupBy("lang").agg(F.count("*").alias("docs"), F.count_distinct("k").alias("distinct_docs"))
    return out.withColumn("duplicate_share", F.round(1 - F.col("distinct_docs") / F.col("docs"), 6))


_NGRAMS = f"""s AS (SELECT doc_id, unnest({SENTENCES.format('lower(text)')}) AS s FROM documents),
w AS (SELECT doc_id, {WORDS.format('s')} AS w FROM s),
t AS (SELECT * FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, unnest(list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))) AS g FROM t WHERE len(w) >= 4)"""


def sentence_words(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id", "source", "text").select("doc_id", "source", F.explode(F.expr(T.sentences_sql("lower(text)"))).alias("s"))
    return docs.select("doc_id", "source", F.expr(T.words_sql("s")).alias("w")).where("size(w) > 0")


@query(f"WITH {_NGRAMS} SELECT g AS ngram, count(*) AS sentences, round(count(*) / (SELECT count(*) FROM t), 8) AS frequency FROM n GROUP BY g HAVING count(*) >= 5 AND count(*) / (SELECT count(*) FROM t) > 0.00025")
def ngram_df_filler(spark, sf_dir):
    """H5: 4-grams in five sentences or more and over the frequency bar."""
    return stats.over_threshold(sentence_words(spark, sf_dir), F.expr(T.ngrams_sql("w", 4)), "ngram", 0.00025, 5, F.expr(T.ngram_hashes_sql("w", 4)))


@query(f"""WITH {_NGRAMS}, o AS (SELECT array_to_string(w[1:3], ' ') AS g FROM t WHERE len(w) >= 3)
SELECT g AS opener, count(*) AS sentences, round(count(*) / (SELECT count(*) FROM t), 8) AS frequency FROM o GROUP BY g HAVING count(*) >= 5 AND count(*) / (SELECT count(*) FROM t) > 0.0025""")
def opener_df(spark, sf_dir):
    """H5: three-word openers over their bar."""
    return stats.over_threshold(sentence_words(spark, sf_dir), F.expr("case when size(w) >= 3 then array(array_join(slice(w, 1, 3), ' ')) else cast(array() as array<string>) end"), "opener", 0.0025, 5)


@query(f"""WITH {_NGRAMS}, k AS (SELECT g FROM n GROUP BY g HAVING count(*) >= 5 AND count(*) / (SELECT count(*) FROM t) > 0.00025)
SELECT g AS ngram, count(DISTINCT doc_id) AS docs, array_to_string(list_sort(list(DISTINCT doc_id))[1:3], ',') AS examples FROM n JOIN k USING (g) GROUP BY g""")
def filler_offenders(spark, sf_dir):
    """H6: documents that hold a filler 4-gram, three examples each."""
    words = sentence_words(spark, sf_dir)
    keys = stats.over_threshold(words, F.expr(T.ngrams_sql("w", 4)), "ngram", 0.00025, 5, F.expr(T.ngram_hashes_sql("w", 4)))
    return stats.offenders(words, F.expr(T.ngrams_sql("w", 4)), "ngram", keys, "doc_id")


@query(f"""WITH {_NGRAMS}, c AS (SELECT g, count(*) AS c FROM n GROUP BY g), p AS (SELECT * FROM (VALUES (0.0001::DOUBLE, 5), (0.00025, 5), (0.0005, 5), (0.001, 10)) AS p(bar, least)),
k AS (SELECT bar, least, g FROM c, p WHERE c >= least AND c / (SELECT count(*) FROM t) > bar)
SELECT k.bar, k.least::INT AS least, count(DISTINCT doc_id) AS docs, round(count(DISTINCT doc_id) / (SELECT count(*) FROM documents), 6) AS share FROM k JOIN n USING (g) GROUP BY ALL""")
def filler_calibrate(spark, sf_dir):
    """H9: flag rates at several thresholds from one count."""
    points = [(0.0001, 5), (0.00025, 5), (0.0005, 5), (0.001, 10)]
    return stats.calibrate(sentence_words(spark, sf_dir), F.expr(T.ngrams_sql("w", 4)), "doc_id", points, table(spark, sf_dir, "documents").count())


@query(f"""WITH w AS (SELECT source, unnest({WORDS.format('lower(text)')}) AS w FROM documents),
u AS (SELECT source, count(*) AS words, count(DISTINCT w) AS types FROM w GROUP BY source),
s AS (SELECT source, count(*) AS sentences FROM (SELECT source, unnest({SENTENCES.format('text')}) AS s FROM documents) WHERE {HAS_WORD.format('s')} GROUP BY source)
SELECT source, words, types, round(types / words, 6) AS uniqueness, CASE WHEN words / sentences BETWEEN 8 AND 22 THEN 0.8 WHEN words / sentences < 8 THEN 0.6 ELSE 0.4 END::DOUBLE AS density FROM u JOIN s USING (source)""")
def entry_uniqueness_density(spark, sf_dir):
    """H7: types per token, and a banded density of words per sentence, by source."""
    docs = table(spark, sf_dir, "documents")
    words = docs.select("source", F.explode(F.expr(T.words_sql("lower(text)"))).alias("w"))
    types = stats.token_types(words, ["source"], "w")
    per = docs.groupBy("source").agg(F.sum(T.sentence_count("text")).alias("sentences"))
    mean = F.col("words") / F.col("sentences")
    return types.join(per, "source").select("source", "words", "types", F.round(F.col("types") / F.col("words"), 6).alias("uniqueness"), F.when(mean.between(8, 22), 0.8).when(mean < 8, 0.6).otherwise(0.4).alias("density"))


@query(f"""WITH w AS (SELECT role, {WORDS.format('lower(text)')} AS w FROM conversations),
n AS (SELECT role, 1 AS n, unnest(w) AS g FROM w UNION ALL SELECT role, 4, unnest(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) FROM w WHERE len(w) >= 4)
SELECT role, n::INT AS n, count(*) AS grams, count(DISTINCT g) AS distinct_grams, round(count(DISTINCT g) / count(*), 6) AS rate FROM n GROUP BY GROUPING SETS ((role, n), (n))""")
def lexical_diversity_grouping_sets(spark, sf_dir):
    """Distinct-1 and distinct-4 per role and pooled."""
    w = table(spark, sf_dir, "conversations").select("role", F.expr(T.words_sql("lower(text)")).alias("w"))
    four = F.expr("case when size(w) >= 4 then transform(sequence(1, size(w) - 3), i -> array_join(slice(w, i, 4), ' ')) else cast(array() as array<string>) end")
    grams = w.select("role", F.lit(1).alias("n"), F.explode("w").alias("g")).union(w.select("role", F.lit(4).alias("n"), F.explode(four).alias("g")))
    return stats.distinct_rates(grams, "role", "n", "g")


@query(f"""WITH o AS (SELECT lang, array_to_string({WORDS.format('lower(text)')}[1:3], ' ') AS o FROM documents),
c AS (SELECT lang, o, count(*) AS c FROM o GROUP BY lang, o), p AS (SELECT lang, c / sum(c) OVER (PARTITION BY lang) AS p FROM c)
SELECT lang, count(*) AS openers, round(-sum(p * log2(p)), 6) AS bits FROM p GROUP BY lang""")
def opener_entropy(spark, sf_dir):
    """Shannon entropy of openers by language."""
    return stats.entropy(table(spark, sf_dir, "documents").select("lang", T.opener("text").alias("o")), ["lang"], "o").withColumnRenamed("values", "openers")


@query("""WITH j AS (SELECT o_orderpriority AS l, o_orderstatus AS r, count(*) AS c FROM orders GROUP BY 1, 2),
p AS (SELECT *, sum(c) OVER () AS n, sum(c) OVER (PARTITION BY l) AS cl, sum(c) OVER (PARTITION BY r) AS cr FROM j),
hl AS (SELECT -sum(q * log2(q)) AS h FROM (SELECT sum(c) / (SELECT sum(c) FROM j) AS q FROM j GROUP BY l)), hr AS (SELECT -sum(q * log2(q)) AS h FROM (SELECT sum(c) / (SELECT sum(c) FROM j) AS q FROM j GROUP BY r))
SELECT round(sum(c / n * log2(c * n / (cl * cr))), 6) AS bits, round((SELECT h FROM hl), 6) AS left_bits, round((SELECT h FROM hr), 6) AS right_bits,
round(sum(c / n * log2(c * n / (cl * cr))) / least((SELECT h FROM hl), (SELECT h FROM hr)), 6) AS normalized FROM p""")
def mutual_information(spark, sf_dir):
    """Mutual information of order priority and status."""
    return stats.mutual_information(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus")


@query("""WITH c AS (SELECT user_id, count(*) AS x FROM events GROUP BY user_id), r AS (SELECT x, row_number() OVER (ORDER BY x) AS i, count(*) OVER () AS n FROM c)
SELECT round(sum((2 * i - n - 1) * x) / (max(n) * sum(x)), 6) AS gini FROM r""")
def gini_exposure(spark, sf_dir):
    """Gini coefficient of events per user."""
    return stats.gini(table(spark, sf_dir, "events").groupBy("user_id").count(), "count")


@query("""WITH c AS (SELECT l_partkey, count(*) AS x FROM lineitem GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY x DESC, l_partkey) AS i, count(*) OVER () AS n FROM c)
SELECT max(n) AS keys, (sum(x) FILTER (i <= greatest(1, n // 100)))::BIGINT AS top_uses, round(sum(x) FILTER (i <= greatest(1, n // 100)) / sum(x), 6) AS top_share FROM r""")
def top1pct_share(spark, sf_dir):
    """The share of uses that the most used hundredth of parts has."""
    return stats.top_share(table(spark, sf_dir, "lineitem"), "l_partkey", 100)


@query(f"""WITH l AS (SELECT lang, len({WORDS.format('text')}) AS n FROM documents)
SELECT lang, count(*) AS docs, round(avg((n > 128)::INT), 6) AS over_128, round(avg((n > 512)::INT), 6) AS over_512, round(avg((n > 2048)::INT), 6) AS over_2048,
sum(least(n, 512))::BIGINT AS kept_512, sum(ceil(n / 512))::BIGINT AS windows_512 FROM l GROUP BY lang""")
def length_bands(spark, sf_dir):
    """Shares over length bands, words that a context of 512 keeps, and its windows."""
    n = table(spark, sf_dir, "documents").select("lang", T.word_count("text").alias("n"))
    return stats.length_bands(n, ["lang"], "n", (128, 512, 2048), 512)


@query(f"""WITH w AS (SELECT doc_id, {WORDS.format('lower(text)')} AS w FROM documents), x AS (SELECT doc_id, unnest(range(0, len(w), 64)) AS pos, w FROM w),
k AS (SELECT md5(array_to_string(w[pos + 1:pos + 64], ' ')) AS k FROM x) SELECT count(*) AS windows, count(DISTINCT k) AS distinct_windows, round(1 - count(DISTINCT k) / count(*), 6) AS repeated FROM k""")
def context_windows(spark, sf_dir):
    """Fixed windows of 64 words, and how many are distinct."""
    w = table(spark, sf_dir, "documents").select(F.expr(T.words_sql("lower(text)")).alias("w")).where("size(w) > 0")
    k = w.select(F.explode(F.expr("transform(sequence(1, size(w), 64), i -> md5(cast(array_join(slice(w, i, 64), ' ') as binary)))")).alias("k"))
    return k.agg(F.count("*").alias("windows"), F.count_distinct("k").alias("distinct_windows")).withColumn("repeated", F.round(1 - F.col("distinct_windows") / F.col("windows"), 6))


@query(f"""WITH k AS (SELECT md5({FOLDED.format('text')}) AS k, min(doc_id) AS doc_id FROM documents GROUP BY 1) SELECT doc_id, k AS key FROM k ORDER BY k, doc_id LIMIT 100""")
def bottom_k_sample(spark, sf_dir):
    """The hundred distinct texts of smallest hash."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5(T.folded("text").cast("binary")).alias("key"))
    return stats.bottom_k(docs, "key", "doc_id", 100)


@query("""WITH s AS (SELECT doc_id, lang, md5('7:' || doc_id) AS h FROM documents), c AS (SELECT lang, count(*) AS n, sum(count(*)) OVER () AS total FROM s GROUP BY lang),
q AS (SELECT lang, n, greatest(1, floor(40 * n / total)) AS base, 40 * n / total - floor(40 * n / total) AS rest FROM c),
a AS (SELECT lang, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, lang) <= 40 - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM q),
r AS (SELECT s.*, row_number() OVER (PARTITION BY lang ORDER BY h, doc_id) AS i FROM s) SELECT doc_id, lang FROM r JOIN a USING (lang) WHERE i <= quota""")
def stratified_sample(spark, sf_dir):
    """Forty documents by language, largest remainders, one a stratum at least, drawn by hash."""
    return stats.stratified(table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", "doc_id", 40, seed=7)


@query("""WITH r AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY md5('3:' || event_id), event_id) AS i FROM events) SELECT event_id, event_type, i::INT AS pick FROM r WHERE i <= 5""")
def sample_per_group(spark, sf_dir):
    """Five events of each type by hash."""
    return stats.sample_per_group(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_type", "event_id", 5, seed=3)


@query(f"""WITH b AS (SELECT item_id, unnest(string_split(text, chr(10))) AS line FROM benchmark), k AS (SELECT DISTINCT {FOLDED.format('line')} AS k FROM b WHERE length(line) >= 20),
d AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT doc_id, count(*) AS lines, count(*) FILTER ({FOLDED.format('line')} IN (SELECT k FROM k)) AS reused, sum(length(line))::BIGINT AS chars FROM d GROUP BY doc_id""")
def benchmark_contamination(spark, sf_dir):
    """Lines of documents that the benchmark holds verbatim, by hash membership."""
    lines = lambda t, key: table(spark, sf_dir, t).select(key, F.explode(F.split("text", "\n")).alias("line"))
    return stats.verbatim_reuse(lines("documents", "doc_id"), lines("benchmark", "item_id"), "doc_id", T.folded("line"), 20)


@query("""WITH t AS (SELECT unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+')) AS w FROM documents WHERE lang = 'en'), c AS (SELECT w, count(*) AS n FROM t GROUP BY w)
SELECT w AS word, n AS uses, round(log10((n + 1) / (SELECT count(*) FROM t) * 1e9), 6) AS zipf FROM c WHERE n >= 20""")
def word_zipf(spark, sf_dir):
    """Zipf frequencies of English words used twenty times or more."""
    w = table(spark, sf_dir, "documents").where("lang = 'en'").select(F.explode(F.expr("regexp_extract_all(lower(coalesce(text, '')), '[a-z]+', 0)")).alias("word"))
    c = w.groupBy("word").agg(F.count("*").alias("uses"))
    total = c.agg(F.sum("uses").alias("total"))
    return c.join(F.broadcast(total)).where("uses >= 20").select("word", "uses", F.round(T.zipf(F.col("uses"), F.col("total")), 6).alias("zipf"))


@query("""WITH t AS (SELECT DISTINCT unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+')) AS w FROM documents WHERE lang = 'en')
SELECT w AS word, CASE WHEN regexp_matches(w, '(s|x|z|ch|sh)$') THEN w || 'es' WHEN regexp_matches(w, '[^aeiouy]y$') THEN w[:-2] || 'ies' ELSE w || 's' END AS plural FROM t WHERE length(w) BETWEEN 3 AND 6""")
def word_plurals(spark, sf_dir):
    """The first generated form of short English words."""
    w = table(spark, sf_dir, "documents").where("lang = 'en'").select(F.explode(F.expr("regexp_extract_all(lower(coalesce(text, '')), '[a-z]+', 0)")).alias("word"))
    return w.where(F.length("word").between(3, 6)).distinct().select("word", T.forms("word")[0].alias("plural"))


_EN = "t AS (SELECT DISTINCT unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+')) AS w FROM documents WHERE lang = 'en')"


@query(r"""WITH {en}, r AS (SELECT w, regexp_matches(w, '[^aeiouy]y$') AS y, w LIKE '%e' AND NOT w LIKE '%ee' AS e, regexp_matches(w, '^[^aeiou]*[aeiou][^aeiouwxy]$') AND length(w) >= 3 AS c, left(w, length(w) - 1) AS cut, right(w, 1) AS z FROM t),
f AS (SELECT w, CASE WHEN y THEN cut || 'ies' WHEN regexp_matches(w, '(s|x|z|ch|sh)$') THEN w || 'es' ELSE w || 's' END AS p, CASE WHEN y THEN cut || 'ied' WHEN e THEN w || 'd' WHEN c THEN w || z || 'ed' ELSE w || 'ed' END AS d, CASE WHEN e THEN cut || 'ing' WHEN c THEN w || z || 'ing' ELSE w || 'ing' END AS g FROM r)
SELECT w AS word, unnest([0, 1, 2])::INT AS place, unnest([p, d, g]) AS form FROM f""".replace("{en}", _EN))
def word_forms(spark, sf_dir):
    """Every generated form of English words of any length."""
    w = table(spark, sf_dir, "documents").where("lang = 'en'").select(F.explode(F.expr("regexp_extract_all(lower(coalesce(text, '')), '[a-z]+', 0)")).alias("word"))
    return w.distinct().select("word", F.posexplode(T.forms("word")).alias("place", "form"))


@query()
def lemma_fold(spark, sf_dir):
    """Distinct words and those of their base forms that are words of the corpus too."""
    w = table(spark, sf_dir, "documents").where("lang = 'en'").select(F.explode(F.expr("regexp_extract_all(lower(coalesce(text, '')), '[a-z]+', 0)")).alias("word")).distinct()
    cand = w.select("word", F.explode(T.lemma_candidates("word")).alias("lemma")).where("lemma != word")
    return cand.join(w.select(F.col("word").alias("lemma")), "lemma", "left_semi").select("word", "lemma")


@query("""SELECT event_type, try_cast(json_extract_string(props, '$.k') AS INT) AS k, count(*) AS events, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def json_props_extract(spark, sf_dir):
    """A JSON field of the event properties, extracted and rolled up."""
    return table(spark, sf_dir, "events").groupBy("event_type", F.get_json_object("props", "$.k").cast("int").alias("k")).agg(F.count("*").alias("events"), F.round(F.sum("value"), 4).alias("total"))


@query(r"""WITH h AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '[ \t\n\r\f]+', ' ', 'g') AS t FROM pages)
SELECT page_id, length(trim(t, ' '))::BIGINT AS chars, md5(trim(t, ' ')) AS text_md5 FROM h""")
def html_text_projection(spark, sf_dir):
    """Page text without scripts, styles and tags."""
    t = F.coalesce("html", F.lit(""))
    for pattern in (r"(?is)<(script|style)[^>]*>.*?</(script|style)>", r"(?s)<[^>]*>", r"[ \t\n\r\f]+"):
        t = F.regexp_replace(t, pattern, " ")
    return table(spark, sf_dir, "pages").select("page_id", F.trim(t).alias("t")).select("page_id", F.length("t").cast("long").alias("chars"), F.md5(F.col("t").cast("binary")).alias("text_md5"))


@query(f"""WITH k AS (SELECT conv_id, turn, role, {WORDS.format('text')} AS w, regexp_replace({FOLDED.format('text')}, '[.,;:!?…]+$', '') AS key FROM conversations),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, key ORDER BY turn) AS nth FROM k),
s AS (SELECT *, CASE WHEN len(w) = 0 THEN 'empty' WHEN len(w) > 40 THEN 'too_long' WHEN key = '' THEN 'empty_key' WHEN nth > 1 THEN 'duplicate' ELSE 'accepted' END AS verdict FROM r),
q AS (SELECT *, CASE WHEN verdict = 'accepted' THEN count(*) FILTER (verdict = 'accepted') OVER (PARTITION BY conv_id ORDER BY turn) END AS taken FROM s)
SELECT role, CASE WHEN taken > 3 THEN 'surplus' ELSE verdict END AS reason, count(*) AS turns FROM q GROUP BY 1, 2""")
def query_sieve(spark, sf_dir):
    """Turns as drafted queries, three accepted a conversation; reasons counted."""
    return stats.query_sieve(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text", most_words=40, most=3).groupBy("role", "reason").agg(F.count("*").alias("turns"))


@query(f"""WITH q AS (SELECT conv_id, turn, role, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS answer, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role FROM conversations),
p AS (SELECT *, len(list_intersect({CONTENT.format('text')}, {CONTENT.format('answer')})) AS overlap FROM q WHERE role = 'user' AND next_role = 'assistant'),
k AS (SELECT *, row_number() OVER (PARTITION BY regexp_replace({FOLDED.format('text')}, '[.,;:!?…]+$', '') ORDER BY conv_id, turn) AS nth FROM p)
SELECT CASE WHEN trim(coalesce(answer, '')) = '' THEN 'empty' WHEN overlap < 1 THEN 'ungrounded' WHEN left({FOLDED.format('answer')}, 60) = left({FOLDED.format('text')}, 60) THEN 'echo' WHEN nth > 1 THEN 'duplicate' ELSE 'accepted' END AS reason, count(*) AS pairs FROM k GROUP BY 1""")
def qa_sieve(spark, sf_dir):
    """User turns and the answers after them; grounding, echo and duplicate reasons counted."""
    order = Window.partitionBy("conv_id").orderBy("turn")
    q = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text", F.lead("text").over(order).alias("answer"), F.lead("role").over(order).alias("next_role"))
    p = q.where("role = 'user' and next_role = 'assistant'")
    nth = F.row_number().over(Window.partitionBy(T.query_key("text")).orderBy("conv_id", "turn"))
    overlap = F.expr(f"size(array_intersect({T.content_words_sql('text')}, {T.content_words_sql('answer')}))")
    reason = F.when(F.trim(F.coalesce("answer", F.lit(""))) == "", "empty").when(overlap < 1, "ungrounded").when(F.left(T.folded("answer"), F.lit(60)) == F.left(T.folded("text"), F.lit(60)), "echo").when(nth > 1, "duplicate").otherwise("accepted")
    return p.withColumn("reason", reason).groupBy("reason").agg(F.count("*").alias("pairs"))


@query(f"""WITH k AS (SELECT doc_id, source, md5({FOLDED.format('text')}) AS k, len({WORDS.format('text')}) AS n FROM documents)
SELECT source, count(*) AS docs, (count(*) FILTER (nth > 1))::BIGINT AS duplicates, (count(*) FILTER (n < 20))::BIGINT AS short FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id) AS nth FROM k) GROUP BY source""")
def duplicate_gate(spark, sf_dir):
    """Documents whose folded text an earlier one has, and those too short, by source."""
    k = table(spark, sf_dir, "documents").select("doc_id", "source", F.md5(T.folded("text").cast("binary")).alias("k"), T.word_count("text").alias("n"))
    return stats.gate(k, "k", "doc_id", "source", 20)


@query()
def minhash_near_dups(spark, sf_dir):
    """Clusters of documents by MinHash bands."""
    return minhash.clusters(minhash.signatures(table(spark, sf_dir, "documents"), "doc_id", "text"), "doc_id")
