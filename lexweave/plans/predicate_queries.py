"""Queries over keys, digests and text predicates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexweave.catalog import query
from lexweave.functions import predicates as P
from lexweave.functions import text as T
from lexweave.operators import lexicon
from lexweave.plans.text_queries import FOLDED, HAS_WORD, WORDS
from lexweave.plans.views import EDGES_SQL, SENSES_SQL, edges, senses, table

STRIP = "chr(32) || chr(9) || chr(10) || chr(13) || chr(12)"
PARAGRAPH = "trim(regexp_replace(regexp_replace(lower({0}), '[^a-z0-9 ]+', ' ', 'g'), '[ ]+', ' ', 'g'), ' ')"
CANDIDATE = "lower(trim(regexp_replace(trim(trim({0}, " + STRIP + "), '.,;:!?\"''()[]{{}}'), '[ \\t\\n\\r\\f]+', ' ', 'g'), ' '))"
FORM = "trim(lower(regexp_replace({0}, '[ \\t\\n\\r\\f]+', ' ', 'g')), ' ')"
GLOSS = "regexp_replace(lower(trim(regexp_replace({0}, '[ \\t\\n\\r]+', ' ', 'g'), ' ')), '\\.$', '')"


def _list(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def turns(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))


TURNS = "t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations)"


@query()
def shard_ids(spark, sf_dir):
    """A3: storage shards of the lexemes."""
    return senses(spark, sf_dir).select("lexeme_id").distinct().withColumn("s", P.shard("lexeme_id")).select("lexeme_id", F.concat_ws("/", "s").alias("path"))


@query()
def concept_ids(spark, sf_dir):
    """A4: one concept for the live senses of each gloss."""
    return senses(spark, sf_dir).where("not retired").groupBy("gloss", "domain").agg(F.collect_set("sense_id").alias("m")).select("gloss", "domain", F.size("m").alias("members"), P.concept_id(F.col("m")).alias("concept_id"))


@query()
def text_digests(spark, sf_dir):
    """64-bit digests of the turns."""
    return turns(spark, sf_dir).select("conv_id", "turn", P.digest64("text").cast("string").alias("digest"))


@query(f"""WITH {SENSES_SQL} SELECT sense_id, sense_id || '#grade_5/plain' AS rendition_id, sense_id || '#q' || sense_index AS query_id, sense_id || '#qa' || sense_index AS qa_id, sense_id AS back, lexeme_id FROM senses""")
def composite_ids(spark, sf_dir):
    """Ids put together and taken apart again."""
    s = senses(spark, sf_dir).withColumns({"level": F.lit("grade_5"), "register": F.lit("plain")})
    out = s.select("sense_id", P.rendition_id("sense_id", "level", "register").alias("rendition_id"), P.query_id("sense_id", "sense_index").alias("query_id"), P.qa_id("sense_id", "sense_index").alias("qa_id"))
    return out.select("*", P.sense_of("qa_id").alias("back"), P.lexeme_of("rendition_id").alias("lexeme_id"))


_REMOVED = "r AS (SELECT DISTINCT a.sense_id, e.type, b.headword AS term, 'demoted: ' || (e.ord % 3) AS reason, ['tombstone', 'dedup', 'cap'][(a.sense_key % 3 + 1)::INT] AS step FROM edges e JOIN senses a ON a.sense_key = src JOIN senses b ON b.sense_key = dst WHERE e.type IN ('synonym', 'antonym'))"


@query(f"WITH {SENSES_SQL}, {EDGES_SQL}, {_REMOVED} SELECT sense_id AS source_sense_id, step, type, term AS target_term, reason FROM r")
def removal_records(spark, sf_dir):
    """Removal records written as notes, one a sense, and parsed back to a row a line."""
    s = senses(spark, sf_dir)
    e = edges(spark, sf_dir).where("type in ('synonym', 'antonym')").join(s.select(F.col("sense_key").alias("src"), "sense_id"), "src").join(s.select(F.col("sense_key").alias("dst"), F.col("headword").alias("term")), "dst")
    step = F.expr("cast(src % 3 as int)")
    record, line = (F.element_at(F.array(*(F.lit(r[i]) for r in P.REMOVALS)), step + 1) for i in (1, 2))
    e = e.select("sense_id", record.alias("record"), F.concat(line, "type", F.lit(" -> "), "term", F.lit(" [demoted: "), (F.col("ord") % 3).cast("string"), F.lit("]")).alias("line"))
    notes = e.groupBy("sense_id", "record").agg(F.collect_set("line").alias("lines")).select(F.concat("record", "sense_id", F.lit("\n"), F.array_join("lines", "\n"), F.lit("\nsome other line")).alias("note"))
    return P.removals(notes, "note").select("source_sense_id", "step", "type", "target_term", "reason")


@query(f"WITH {TURNS} SELECT conv_id, turn, md5({PARAGRAPH.format('text')}) AS paragraph, md5({CANDIDATE.format('text')}) AS candidate, md5({FORM.format('text')}) AS form, md5({GLOSS.format('text')}) AS gloss FROM t")
def text_keys(spark, sf_dir):
    """Comparison keys of the turns."""
    d = lambda c: F.md5(c.cast("binary"))
    return turns(spark, sf_dir).select("conv_id", "turn", d(P.paragraph_key("text")).alias("paragraph"), d(P.candidate_key("text")).alias("candidate"), d(P.form_key("text")).alias("form"), d(T.gloss_key("text")).alias("gloss"))


@query(f"""WITH {TURNS} SELECT conv_id, turn, CASE WHEN length(text) > 500 THEN left(text, 500) || '…' ELSE text END AS note FROM t""")
def note_truncation(spark, sf_dir):
    """A16."""
    return turns(spark, sf_dir).select("conv_id", "turn", P.truncated("text").alias("note"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END || '+00:00' AS iso FROM events")
def event_iso(spark, sf_dir):
    """A17."""
    return table(spark, sf_dir, "events").select("event_id", P.iso("ts").alias("iso"))


@query(f"WITH {EDGES_SQL} SELECT src, left(sha256(array_to_string(list_sort(list(DISTINCT type || '>' || dst)), chr(10))), 16) AS marker FROM edges GROUP BY src")
def marker_digests(spark, sf_dir):
    """One digest of a sense's relations, whatever their order."""
    return edges(spark, sf_dir).groupBy("src").agg(F.collect_set(F.concat("type", F.lit(">"), F.col("dst").cast("string"))).alias("r")).select("src", P.marker(F.col("r")).alias("marker"))


_LEMMA = r"""array_distinct_([w, s], CASE WHEN regexp_matches(s, 'ies$') THEN [s[:-4] || 'y', s[:-2], s[:-3]] WHEN regexp_matches(s, '(ses|xes|zes|ches|shes)$') THEN [s[:-3], s[:-2]] WHEN regexp_matches(s, 'es$') THEN [s[:-2], s[:-3]] WHEN regexp_matches(s, '[^s]s$') THEN [s[:-2]] ELSE [] END,
CASE WHEN regexp_matches(s, 'ied$') THEN [s[:-4] || 'y', s[:-2], s[:-3]] WHEN regexp_matches(s, 'ed$') THEN [s[:-2], s[:-3], u(s[:-3])] WHEN regexp_matches(s, 'ing$') THEN [s[:-4], s[:-4] || 'e', u(s[:-4])] ELSE [] END,
CASE WHEN regexp_matches(s, 'iest$') THEN [s[:-5] || 'y'] WHEN regexp_matches(s, 'ier$') THEN [s[:-4] || 'y'] WHEN regexp_matches(s, 'est$') THEN [s[:-4], s[:-3], u(s[:-4])] WHEN regexp_matches(s, 'er$') THEN [s[:-3], s[:-2], u(s[:-3])] ELSE [] END,
CASE WHEN regexp_matches(s, 'ily$') THEN [s[:-4] || 'y'] WHEN regexp_matches(s, 'ly$') THEN [s[:-3]] ELSE [] END)"""


def lemma_sql(word: str) -> str:
    """DuckDB: the lemma candidates of an ASCII word."""
    import re as _re

    def cut(m):  # s[:-k] in the sketch above drops k - 1 characters
        return f"left(s, length(s) - {int(m.group(1)) - 1})"

    body = _re.sub(r"s\[:-(\d)\]", cut, _LEMMA)
    undouble = lambda x: f"CASE WHEN length({x}) >= 3 AND right({x}, 1) = right(left({x}, length({x}) - 1), 1) AND NOT regexp_matches({x}, '[aeiou]$') THEN left({x}, length({x}) - 1) ELSE {x} END"
    body = _re.sub(r"u\((left\(s, length\(s\) - \d\))\)", lambda m: undouble(m.group(1)), body)
    parts = body.replace("array_distinct_(", "list_concat(", 1)
    nested = parts.replace("list_concat([w, s], ", "", 1)[:-1]
    pieces = _re.split(r",\n", nested)
    out = "[w, s]"
    for p in pieces:
        out = f"list_concat({out}, {p})"
    w = f"trim(lower({word}), '''’')"
    return f"list_filter((SELECT {out} FROM (SELECT {w} AS w, regexp_replace({w}, '[''’]s$', '') AS s)), lambda c: length(c) >= 2)"


FAMILIAR = "SELECT w AS word FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM benchmark) GROUP BY w HAVING count(*) >= 3"


def familiar_words(spark, sf_dir):
    """The list of familiar words is a parameter; here it is what the benchmark's texts use three times or more."""
    w = table(spark, sf_dir, "benchmark").select(F.explode(F.expr("regexp_extract_all(lower(text), '[a-z]+', 0)")).alias("word"))
    return w.groupBy("word").count().where("count >= 3").select("word")


@query(f"""WITH f AS ({FAMILIAR}), w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+')) AS word FROM conversations),
c AS (SELECT word, unnest({lemma_sql('word')}) AS c FROM w) SELECT word, bool_or(c IN (SELECT word FROM f)) AS easy FROM c GROUP BY word""")
def easy_words(spark, sf_dir):
    """Words that are familiar in some regular form."""
    w = table(spark, sf_dir, "conversations").select(F.explode(F.expr("regexp_extract_all(lower(coalesce(text, '')), '[a-z]+', 0)")).alias("word")).distinct()
    c = w.select("word", F.explode(T.lemma_candidates("word")).alias("c"))
    return c.join(familiar_words(spark, sf_dir).withColumnRenamed("word", "c").withColumn("hit", F.lit(True)), "c", "left").groupBy("word").agg(F.max(F.coalesce("hit", F.lit(False))).alias("easy"))


@query()
def hard_word_scan(spark, sf_dir):
    """Considered and unfamiliar words of the benchmark's documents, and the levels whose bar they exceed."""
    docs = table(spark, sf_dir, "conversations").select(F.expr("conv_id * 1000 + turn").alias("turn_id"), "text")
    h = P.hard_words(docs, "turn_id", "text", familiar_words(spark, sf_dir))
    return h.select("turn_id", "considered", F.size("hard").alias("hard"), F.round("share", 6).alias("share"), *(P.exceeds_band(F.lit(x), F.col("share")).alias(f"over_{x}") for x in ("grade_1", "grade_5", "neutral")))


_HEADS = f"""{TURNS}, h AS (SELECT *, coalesce(regexp_extract(lower(text), '[a-z]+', 0), '') AS first, coalesce(regexp_extract_all(lower(text), '[a-z]+')[2], '') AS second FROM t),
k AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN first ELSE second END AS head, CASE WHEN turn % 3 = 1 THEN 'The word ' || text WHEN turn % 3 = 2 THEN 'a ' || text ELSE text END AS text FROM h)"""


def heads(spark, sf_dir):
    t = turns(spark, sf_dir).withColumn("w", F.expr("regexp_extract_all(lower(text), '[a-z]+', 0)"))
    head = F.coalesce(F.expr("get(w, cast(turn % 2 as int))"), F.lit(""))
    text = F.expr("case when turn % 3 = 1 then concat('The word ', text) when turn % 3 = 2 then concat('a ', text) else text end")
    return t.select("conv_id", "turn", head.alias("head"), text.alias("text"))


_END = r"(?:$|[^\p{L}\p{N}_])"


@query(f"""WITH {_HEADS} SELECT conv_id, turn, head <> '' AND regexp_matches(text, '(?i)^\\s*(?:the\\s+(?:word|term)\\s+' || head || 's?{_END}|to\\s+' || head || 's?\\s+(?:is|means)\\b|(?:a|an|the)\\s+' || head || 's?{_END}|' || head || 's?{_END})') AS initial,
contains(' ' || {PARAGRAPH.format('text')} || ' ', ' ' || head || ' ') AS present FROM k""")
def headword_initial(spark, sf_dir):
    """Whether a text opens by naming its headword, and whether it holds it as a whole word."""
    k = heads(spark, sf_dir).withColumn("key", P.paragraph_key("text"))
    return k.select("conv_id", "turn", P.headword_initial("text", "head").alias("initial"), P.headword_present("key", "head").alias("present"))


@query()
def spans(spark, sf_dir):
    """Where a turn names its headword or one of its forms."""
    k = heads(spark, sf_dir).withColumn("s", P.span("text", "head", T.forms("head")))
    return k.select("conv_id", "turn", "head", "s.start", "s.end")


_SENT = "s AS (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line FROM t)"
_BODY = f"trim(line, chr(32) || chr(9) || chr(10) || chr(13))"
_START = f"coalesce(nullif(ltrim({_BODY}, '\"''“”‘’'), ''), {_BODY})"


@query(f"""WITH {TURNS}, {_SENT} SELECT conv_id, count(*) AS lines, count(*) FILTER (len({WORDS.format('line')}) < 3 OR NOT regexp_matches(line, '[A-Za-z]')) AS garbage,
count(*) FILTER ({_BODY} <> '' AND (regexp_matches(left({_START}, 1), '\\p{{Ll}}') OR NOT contains('.!?"”)', right({_BODY}, 1)))) AS fragments,
count(*) FILTER (regexp_matches(line, '(?i)\\b(researchers?|participants?|observers?|the study|this study|data ?set)\\b')) AS stilted FROM s GROUP BY conv_id""")
def example_flags(spark, sf_dir):
    """Lines as example sentences: garbage, fragments, stilted ones."""
    s = turns(spark, sf_dir).select("conv_id", F.explode(F.split("text", "\n")).alias("line"))
    return s.groupBy("conv_id").agg(F.count("*").alias("lines"), F.count_if(P.garbage("line")).alias("garbage"), F.count_if(P.fragment("line")).alias("fragments"), F.count_if(P.stilted("line")).alias("stilted"))


_TERMS = "t AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN 'Slang Term.' WHEN 2 THEN ' life form' WHEN 3 THEN lower(p_type) || ' archaic usage' ELSE 'see also' END AS term FROM part)"


@query(f"""WITH {_TERMS}, k AS (SELECT p_partkey, term, {CANDIDATE.format('term')} AS k FROM t), w AS (SELECT *, string_split(k, ' ') AS w FROM k)
SELECT p_partkey, k IN {_list(P.META_LABELS)} OR (len(w) >= 2 AND w[-1] IN {_list(P.META_HEADS)} AND w[-2] IN {_list(P.META_QUALIFIERS)}) AS label, trim(lower(term), ' ') IN {_list(P.ARTIFACTS)} OR len(regexp_split_to_array(trim(lower(term), ' '), '\\s+')) > 4 AS artifact FROM w""")
def meta_labels(spark, sf_dir):
    """Relation targets that are labels about words, or leftover slots."""
    term = F.expr("case p_partkey % 5 when 0 then p_name when 1 then 'Slang Term.' when 2 then ' life form' when 3 then concat(lower(p_type), ' archaic usage') else 'see also' end")
    return table(spark, sf_dir, "part").select("p_partkey", term.alias("term")).select("p_partkey", P.meta_label("term").alias("label"), P.artifact_target("term").alias("artifact"))


_ANSWERS = """a AS (SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 'According to the sources, ' || left(text, 90) WHEN 1 THEN left(text, 40) || ' as described above' WHEN 2 THEN 'As stated in the entry, ' ELSE left(text, 90) END AS answer, left(text, 80) AS gloss, text FROM t)"""


def answers(spark, sf_dir):
    a = F.expr("case turn % 4 when 0 then concat('According to the sources, ', left(text, 90)) when 1 then concat(left(text, 40), ' as described above') when 2 then 'As stated in the entry, ' else left(text, 90) end")
    return turns(spark, sf_dir).select("conv_id", "turn", a.alias("answer"), F.left("text", F.lit(80)).alias("gloss"), "text")


@query(rf"""WITH {TURNS}, {_ANSWERS}, r AS (SELECT *, regexp_replace(answer, '(?i)^(?:according to the \w+|as (?:described|stated|mentioned|shown) (?:in the \w+|above))[^,]*,\s*', '') AS rest FROM a)
SELECT conv_id, turn, coalesce({", ".join("nullif(regexp_extract(answer, '" + p + "', 0), '')" for p in P.META_REFERENCES)}) AS reference,
CASE WHEN rest = answer OR trim(rest, ' ') = '' THEN answer ELSE upper(left(rest, 1)) || substr(rest, 2) END AS repaired, gloss <> '' AND left({FOLDED.format('answer')}, 60) = left({FOLDED.format('gloss')}, 60) AS echo,
len({WORDS.format('gloss')}) >= 6 AND {PARAGRAPH.format('gloss')} <> '' AND contains({PARAGRAPH.format('text')}, {PARAGRAPH.format('gloss')}) AS quotes FROM r""")
def answer_checks(spark, sf_dir):
    """Answers that name their sources, their repair, echoes of the gloss and quotes of it."""
    a = answers(spark, sf_dir)
    return a.select("conv_id", "turn", P.meta_reference("answer").alias("reference"), P.repaired_reference("answer").alias("repaired"), P.gloss_echo("answer", "gloss").alias("echo"), P.quotes("text", "gloss").alias("quotes"))


@query("""WITH h AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'the ' || p_name WHEN 1 THEN p_name || ' of' ELSE p_name END AS h FROM part), w AS (SELECT *, string_split(lower(h), ' ') AS w FROM h),
k AS (SELECT ['a', 'an', 'the', 'of', 'in', 'on', 'to', 'for', 'with', 'and', 'or', 'by', 'at'] AS f) SELECT p_partkey, CASE WHEN len(w) < 2 THEN NULL WHEN list_contains(f, w[1]) THEN 'opens' WHEN list_contains(f, w[-1]) THEN 'closes' END AS reason FROM w, k""")
def headword_fragments(spark, sf_dir):
    """Multiword heads that open or close with a function word."""
    h = F.expr("case p_partkey % 4 when 0 then concat('the ', p_name) when 1 then concat(p_name, ' of') else p_name end")
    return table(spark, sf_dir, "part").select("p_partkey", h.alias("h")).select("p_partkey", lexicon.fragment_reason("h").alias("reason"))


@query("""WITH n AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name || ' (' || lower(c_mktsegment) || ')' WHEN 1 THEN c_name || ', ' || c_mktsegment ELSE c_name END AS n FROM customer)
SELECT c_custkey, trim(CASE WHEN contains(n, '(') THEN split_part(n, ' (', 1) WHEN contains(n, ', ') THEN split_part(n, ', ', 1) ELSE n END) AS headword, CASE WHEN contains(n, '(') THEN rtrim(split_part(n, ' (', 2), ')') WHEN contains(n, ', ') THEN split_part(n, ', ', 2) ELSE '' END AS disambiguator FROM n""")
def disambiguators(spark, sf_dir):
    """B36."""
    n = F.expr("case c_custkey % 3 when 0 then concat(c_name, ' (', lower(c_mktsegment), ')') when 1 then concat(c_name, ', ', c_mktsegment) else c_name end")
    return table(spark, sf_dir, "customer").select("c_custkey", n.alias("n")).select("c_custkey", *P.disambiguated("n"))


PRICES = (("A", 1.25, 0.125, 10.0), ("N", 0.25, 0.025, 2.0), ("R", 0.05, 0.005, 0.4))


@query(f"""WITH p AS (SELECT * FROM (VALUES {', '.join(f"('{m}', {a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE)" for m, a, b, c in PRICES)}) AS p(model, a, b, c)), u AS (SELECT l_returnflag AS model, (l_quantity * 100)::BIGINT AS fresh, (l_discount * 10000)::BIGINT AS cached, l_linenumber * 50 AS made FROM lineitem)
SELECT model, count(*) AS calls, round(sum((fresh * a + cached * b + made * c) / 1000000), 6) AS dollars, sum(floor((fresh + cached) / 3.0) + made)::BIGINT AS token_bound FROM u JOIN p USING (model) GROUP BY model""")
def call_costs(spark, sf_dir):
    """Calls priced by model, and an upper bound of their tokens."""
    price = spark.createDataFrame(PRICES, "model string, a double, b double, c double")
    u = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("model"), F.round(F.col("l_quantity") * 100).cast("long").alias("fresh"), F.round(F.col("l_discount") * 10000).cast("long").alias("cached"), (F.col("l_linenumber") * 50).alias("made"))
    u = u.join(F.broadcast(price), "model")  # a row a model
    bound = (F.floor((F.col("fresh") + F.col("cached")) / P.CHARS_PER_TOKEN) + F.col("made")).cast("long")
    return u.groupBy("model").agg(F.count("*").alias("calls"), F.round(F.sum(P.call_cost(F.col("fresh"), F.col("cached"), F.col("made"), ("a", "b", "c"))), 6).alias("dollars"), F.sum(bound).alias("token_bound"))


@query("""WITH f AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS birth, CASE WHEN o_orderkey % 3 = 0 THEN '2020-01-01' END AS death, '+' || strftime(o_orderdate + INTERVAL 20 YEAR, '%Y') AS inception FROM orders)
SELECT o_orderkey, array_to_string(list_filter([CASE WHEN death IS NULL AND left(birth, 4)::INT > 1996 THEN 'living' END, CASE WHEN substr(inception, 2, 4)::INT >= 2016 THEN 'recent' END], lambda x: x IS NOT NULL), ',') AS notes FROM f""")
def date_notes(spark, sf_dir):
    """B42."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("birth"), F.expr("case when o_orderkey % 3 = 0 then '2020-01-01' end").alias("death"), F.concat(F.lit("+"), (F.year("o_orderdate") + 20).cast("string")).alias("inception"))
    return o.select("o_orderkey", F.array_join(P.date_notes("birth", "death", "inception", 1996, 2016), ",").alias("notes"))


UPOS = (("noun", "NOUN"), ("verb", "VERB"), ("adjective", "ADJ"), ("adverb", "ADV"), ("pronoun", "PRON"), ("preposition", "ADP"), ("conjunction", "CCONJ"), ("determiner", "DET"), ("interjection", "INTJ"), ("numeral", "NUM"))  # fixed values
WN_RELATIONS = (("synonym", "eq_synonym"), ("antonym", "antonym"), ("hypernym", "hypernym"), ("hyponym", "hyponym"), ("meronym", "meronym"), ("holonym", "holonym"), ("derivation", "derivation"), ("see_also", "also"), ("causes", "causes"), ("entails", "entails"), ("instance_of", "instance_hypernym"))  # fixed values
SKOS_RELATIONS = (("hypernym", "skos:broader"), ("hyponym", "skos:narrower"), ("synonym", "skos:closeMatch"), ("see_also", "skos:related"))  # fixed values


def mapped(column, pairs):
    """A closed vocabulary's value elsewhere; null if it has none."""
    return F.element_at(F.create_map(*(F.lit(x) for p in pairs for x in p)), column)


@query(f"""WITH {EDGES_SQL}, e AS (SELECT type, count(*) AS edges FROM edges GROUP BY type) SELECT type, edges, CASE type {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in WN_RELATIONS)} END AS wn, CASE type {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in SKOS_RELATIONS)} END AS skos FROM e""")
def relation_crosswalk(spark, sf_dir):
    """Relation types in other vocabularies."""
    e = edges(spark, sf_dir).groupBy("type").agg(F.count("*").alias("edges"))
    return e.select("type", "edges", mapped(F.col("type"), WN_RELATIONS).alias("wn"), mapped(F.col("type"), SKOS_RELATIONS).alias("skos"))


@query(f"""WITH s AS (SELECT p_partkey, ['noun', 'verb', 'adjective', 'adverb', 'numeral'][p_size % 5 + 1] AS pos, p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') AS proper FROM part) SELECT p_partkey, CASE WHEN proper AND pos = 'noun' THEN 'PROPN' ELSE CASE pos {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in UPOS)} END END AS upos FROM s""")
def upos_tags(spark, sf_dir):
    """Tags of parts of speech; nouns of proper names are PROPN."""
    s = table(spark, sf_dir, "part").select("p_partkey", F.element_at(F.array(*map(F.lit, ("noun", "verb", "adjective", "adverb", "numeral"))), F.col("p_size") % 5 + 1).alias("pos"), F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3").alias("proper"))
    return s.select("p_partkey", F.when(F.col("proper") & (F.col("pos") == "noun"), "PROPN").otherwise(mapped(F.col("pos"), UPOS)).alias("upos"))


@query("""WITH t AS (SELECT p_partkey, lower(p_type) || '.' || CASE WHEN p_size % 4 = 0 THEN 'general' ELSE 'leaf' || p_size % 4 END AS tag FROM part) SELECT split_part(tag, '.', 1) AS root, count(*) AS tags, count(DISTINCT tag) AS leaves, count(*) FILTER (tag LIKE '%.general') AS general FROM t GROUP BY 1""")
def taxonomy_roots(spark, sf_dir):
    """Roots, leaves and general tags of a taxonomy of 'root.leaf'."""
    tag = F.expr("concat(lower(p_type), '.', case when p_size % 4 = 0 then 'general' else concat('leaf', p_size % 4) end)")
    t = table(spark, sf_dir, "part").select(tag.alias("tag"))
    return t.groupBy(F.substring_index("tag", ".", 1).alias("root")).agg(F.count("*").alias("tags"), F.count_distinct("tag").alias("leaves"), F.count_if(F.endswith("tag", F.lit(".general"))).alias("general"))


@query(f"""WITH e AS (SELECT DISTINCT lower(p_type) AS lexname FROM part), m AS (SELECT p_name AS head, array_to_string(list_sort(list(DISTINCT lower(p_type))), '|') AS names FROM part GROUP BY p_name)
SELECT head, names, CASE WHEN contains('|' || names || '|', '|promo|') THEN 'work' WHEN contains('|' || names || '|', '|economy|') THEN 'organization' ELSE 'other' END AS entity_type FROM m""")
def entity_types(spark, sf_dir):
    """The first class of an ordered map that any of a head's labels has; else the default."""
    rules = (("promo", "work"), ("economy", "organization"))
    m = table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("head")).agg(F.array_sort(F.collect_set(F.lower("p_type"))).alias("l"))
    kind = F.lit("other")
    for label, name in reversed(rules):
        kind = F.when(F.array_contains("l", label), name).otherwise(kind)
    return m.select("head", F.array_join("l", "|").alias("names"), kind.alias("entity_type"))


@query("""WITH s AS (SELECT s_suppkey, log10(1 + s_acctbal + 1000) AS fame, s_acctbal > 5000 AS rich, s_nationkey < 5 AS near FROM supplier)
SELECT s_suppkey, round(fame + CASE WHEN rich THEN 2 ELSE 0 END - CASE WHEN near THEN 0.5 ELSE 0 END, 6) AS score, array_to_string(list_filter(['fame', CASE WHEN rich THEN 'rich' END, CASE WHEN near THEN 'near' END], lambda x: x IS NOT NULL), ',') AS reasons FROM s""")
def weighted_scores(spark, sf_dir):
    """A sum of terms, with the names of those that count."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.log10(1 + F.col("s_acctbal") + 1000).alias("fame"), (F.col("s_acctbal") > 5000).alias("rich"), (F.col("s_nationkey") < 5).alias("near"))
    score = F.col("fame") + F.when(F.col("rich"), 2).otherwise(0) - F.when(F.col("near"), 0.5).otherwise(0)
    return s.select("s_suppkey", F.round(score, 6).alias("score"), F.array_join(F.array_compact(F.array(F.lit("fame"), F.when(F.col("rich"), "rich"), F.when(F.col("near"), "near"))), ",").alias("reasons"))


@query(f"""WITH {TURNS}, d AS (SELECT conv_id, turn, text, regexp_replace(regexp_replace(text, '; "[^"]*"?', '', 'g'), '[ \\t\\n]+', ' ', 'g') AS c FROM t) SELECT conv_id, turn, md5(trim(c, ' ;')) AS definition FROM d WHERE {HAS_WORD.format('c')}""")
def cleaned_definitions(spark, sf_dir):
    """Definitions without leaked examples; empty ones go."""
    c = F.regexp_replace(F.regexp_replace("text", '; "[^"]*"?', ""), r"[ \t\n]+", " ")
    t = turns(spark, sf_dir).select("conv_id", "turn", c.alias("c")).where(r"c rlike '[\\p{L}\\p{N}]'")
    return t.select("conv_id", "turn", F.md5(F.btrim("c", F.lit(" ;")).cast("binary")).alias("definition"))


@query(f"""WITH {EDGES_SQL}, n AS (SELECT type, CASE ord % 3 WHEN 0 THEN 'demoted: x' WHEN 1 THEN NULL ELSE 'kept' END AS note FROM edges) SELECT type, count(*) AS edges, count(*) FILTER (coalesce(starts_with(note, 'demoted: '), false)) AS demoted FROM n GROUP BY type""")
def demotion_notes(spark, sf_dir):
    """B43."""
    n = edges(spark, sf_dir).withColumn("note", F.expr("case ord % 3 when 0 then 'demoted: x' when 1 then null else 'kept' end"))
    return n.groupBy("type").agg(F.count("*").alias("edges"), F.count_if(P.demotion_note("note")).alias("demoted"))


_CAND = "c AS (SELECT l_orderkey AS source, l_linenumber AS ord, l_partkey AS k, CASE l_suppkey % 7 WHEN 0 THEN '*' || p_name WHEN 1 THEN 'see also' WHEN 2 THEN p_name || ' which is' WHEN 3 THEN 'one two three ' || p_name WHEN 4 THEN '' ELSE upper(p_name) END AS raw FROM lineitem JOIN part ON p_partkey = l_partkey)"


@query(rf"""WITH {_CAND}, n AS (SELECT source, ord, k, raw, {CANDIDATE.format('raw')} AS t FROM c),
s AS (SELECT *, CASE WHEN t = '' THEN 'empty' WHEN length(t) < 2 THEN 'too_short' WHEN length(t) > 40 THEN 'too_long' WHEN NOT regexp_matches(t, '[a-z]') THEN 'no_letters' WHEN regexp_matches(t, '(?i)[*√]|^(?:pie|proto)[- ]') THEN 'etymon' WHEN t IN {_list(P.CANDIDATE_LABELS)} THEN 'meta_label'
WHEN regexp_matches(t, '(?i)[.;]|\b(?:which|that is|refers to|meaning)\b') THEN 'sentence_shaped' WHEN len(string_split(t, ' ')) > 4 THEN 'too_many_words' END AS shape, trim(regexp_replace(t, '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM n),
known AS (SELECT DISTINCT trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM part WHERE p_size < 20),
m AS (SELECT *, CASE WHEN shape IS NULL THEN row_number() OVER (PARTITION BY source, slug, shape IS NULL ORDER BY ord, k, raw) END AS nth FROM s)
SELECT coalesce(shape, CASE WHEN nth > 1 THEN 'duplicate' WHEN slug IN (SELECT slug FROM known) THEN 'already_stored' ELSE 'accepted' END) AS reason, count(*) AS candidates FROM m GROUP BY 1""")
def frontier_membership(spark, sf_dir):
    """Candidates of each source refused by shape, as a repeat within the source, or as stored; reasons counted. First failure wins."""
    line = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
    raw = F.expr("case l_suppkey % 7 when 0 then concat('*', p_name) when 1 then 'see also' when 2 then concat(p_name, ' which is') when 3 then concat('one two three ', p_name) when 4 then '' else upper(p_name) end")
    c = line.select(F.col("l_orderkey").alias("source"), F.col("l_linenumber").alias("ord"), F.col("l_partkey").alias("k"), raw.alias("raw")).withColumn("t", P.candidate_key("raw"))
    c = c.withColumn("shape", P.candidate_reason("t")).withColumn("slug", T.slug("t"))
    known = table(spark, sf_dir, "part").where("p_size < 20").select(T.slug("p_name").alias("slug")).distinct().withColumn("stored", F.lit(True))
    nth = F.row_number().over(Window.partitionBy("source", "slug", F.col("shape").isNull()).orderBy("ord", "k", "raw"))
    m = c.withColumn("nth", nth).join(known, "slug", "left")
    return m.groupBy(F.coalesce("shape", F.when(F.col("nth") > 1, "duplicate").when(F.col("stored"), "already_stored").otherwise(F.lit("accepted"))).alias("reason")).agg(F.count("*").alias("candidates"))


@query(f"""WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+')) AS word FROM documents), c AS (SELECT word, unnest({lemma_sql('word')}) AS lemma FROM w) SELECT DISTINCT word, lemma FROM c WHERE lemma <> word AND lemma IN (SELECT word FROM w)""")
def lemma_fold_all(spark, sf_dir):
    """Words of all languages and those of their base forms that are words of the corpus too."""
    w = table(spark, sf_dir, "documents").select(F.explode(F.expr("regexp_extract_all(lower(coalesce(text, '')), '[a-z]+', 0)")).alias("word")).distinct()
    cand = w.select("word", F.explode(T.lemma_candidates("word")).alias("lemma")).where("lemma != word")
    return cand.join(w.select(F.col("word").alias("lemma")), "lemma", "left_semi").select("word", "lemma")


@query(r"""WITH t AS (SELECT unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}]+')) AS w FROM documents), c AS (SELECT w, count(*) AS n FROM t GROUP BY w) SELECT w AS word, n AS uses, round(log10((n + 1) / (SELECT count(*) FROM t) * 1e9), 6) AS zipf FROM c""".replace("\\\\", "\\"))
def word_zipf_all(spark, sf_dir):
    """Zipf frequencies of every word of every language."""
    w = table(spark, sf_dir, "documents").select(F.explode(F.expr("regexp_extract_all(lower(coalesce(text, '')), '[\\\\p{L}]+', 0)")).alias("word"))
    c = w.groupBy("word").agg(F.count("*").alias("uses"))
    total = c.agg(F.sum("uses").alias("total"))
    return c.join(F.broadcast(total)).select("word", "uses", F.round(T.zipf(F.col("uses"), F.col("total")), 6).alias("zipf"))  # one row
