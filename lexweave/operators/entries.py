"""Nested dictionary entries and their release relations (operators D, G, C10-C13, C17): one nested row an entry, flat relations out of it.

An entry is one row: lexeme_id, headword, kind, aliases, frequency, senses (array of structs with
glosses, examples, relations, queries and qa), encyclopedia, etymology, provenance (map) and
contrasts. Every relation is a projection of the same nested table, so a scan and its explodes are
shared; only the contrasts need joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.functions import predicates as P
from lexweave.functions import text as T
from lexweave.operators.stats import drawn

LEVELS = ("neutral", "grade_1", "grade_5", "grade_10", "college")
KEYS = ("sense_id", "lexeme_id", "headword", "pos", "sense_index", "domain", "tier")
#: C17: the relations of a release and the columns of each.
RELATIONS = {
    "lexicon": ("lexeme_id", "headword", "kind", "aliases", "tier", "source", "retired", "retired_reason", "sense_ids", "n_live_senses", "n_retired_senses", "frequency", "models", "total_cost", "n_records"),
    "senses": (*KEYS, "gloss", "n_glosses", "n_examples", "n_relations", "n_queries", "n_qa_pairs", "source"),
    "definitions": (*KEYS, "reading_level", "register", "text", "is_canonical"),
    "examples": (*KEYS, "reading_level", "register", "text", "span_start", "span_end", "source"),
    "relations": ("edge_id", "source_sense_id", "source_lexeme_id", "headword", "pos", "type", "target_term", "target_lexeme_id", "target_sense_id", "resolved", "confidence", "tier"),
    "queries": ("query_id", *KEYS, "style", "text", "headword_free"),
    "qa_pairs": ("qa_id", *KEYS, "question", "answer", "grounded_in"),
    "encyclopedia": ("lexeme_id", "headword", "tier", "kind", "reading_level", "register", "text", "n_words", "is_canonical"),
    "etymology": ("lexeme_id", "headword", "tier", "kind", "summary", "segments", "n_segments"),
    "inflections": ("form", "form_normalized", "lexeme_id", "headword", "pos", "tier", "relation"),
    "provenance": ("lexeme_id", "headword", "tier", "provenance_id", "stage", "model", "cost", "note"),
    "tombstoned": ("lexeme_id", "headword", "tier", "provenance_id", "step", "source_sense_id", "type", "target_term", "reason"),
    "contrasts": ("edge_id", "source_sense_id", "source_lexeme_id", "relation_type", "source_gloss", "target_sense_id", "target_headword", "target_gloss", "verdict", "text", "tier"),
}


def nest(senses: DataFrame, **parts: DataFrame) -> DataFrame:
    """Entries of flat tables. senses: sense_id, lexeme_id, headword, pos, sense_index, domain, retired; parts by name (glosses, examples, relations, queries, qa) by sense_id, (encyclopedia, etymology, provenance, contrasts) by lexeme_id, each with `ord`."""
    s = senses
    for name in ("glosses", "examples", "relations", "queries", "qa"):
        table = parts[name]
        rest = [c for c in table.columns if c not in ("sense_id", "ord")]
        rows = table.groupBy("sense_id").agg(F.array_sort(F.collect_list(F.struct("ord", *rest))).alias("xs"))
        rows = rows.select("sense_id", F.expr(f"transform(xs, x -> named_struct({', '.join(f"'{c}', x.{c}" for c in rest)}))").alias(name))
        s = s.join(rows, "sense_id", "left")
    own = ["sense_index", "sense_id", "pos", "domain", "retired", "glosses", "examples", "relations", "queries", "qa"]
    out = s.groupBy("lexeme_id", "headword").agg(F.array_sort(F.collect_list(F.struct(*own))).alias("senses"))
    for name in ("encyclopedia", "etymology", "contrasts"):
        table = parts[name]
        rest = [c for c in table.columns if c not in ("lexeme_id", "ord")]
        rows = table.groupBy("lexeme_id").agg(F.array_sort(F.collect_list(F.struct("ord", *rest))).alias(name))
        out = out.join(rows, "lexeme_id", "left")
    p = parts["provenance"]
    rest = [c for c in p.columns if c not in ("lexeme_id", "ord")]
    rows = p.groupBy("lexeme_id").agg(F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("p"), F.col("ord").cast("string")), F.struct(*rest)))).alias("provenance"))
    return out.join(rows, "lexeme_id", "left")


def records(entries: DataFrame) -> DataFrame:
    """Provenance rows in numeric order of their ids."""
    rows = entries.select("lexeme_id", "headword", "tier", F.explode("provenance").alias("provenance_id", "r"))
    return rows.withColumn("nth", F.substr("provenance_id", F.lit(2)).cast("int"))


def source_of(entries: DataFrame) -> Column:
    """What the first migrate record says; without one the default."""
    first = "array_sort(transform(filter(map_entries(provenance), e -> e.value.stage = 'migrate'), e -> struct(cast(substr(e.key, 2) as int) as n, e.value.model as model)))"
    return F.expr(f"case when get({first}, 0).model = 'imported' then 'imported' else 'own' end")


def retired_reason(entries: DataFrame) -> Column:
    """The reason of the last record, in order, that says a sense was retired."""
    said = "filter(transform(map_entries(provenance), e -> struct(cast(substr(e.key, 2) as int) as n, nullif(regexp_extract(e.value.note, '^retired sense (.+?): (.*)$', 2), '') as reason)), x -> x.reason is not null)"
    return F.expr(f"get(array_sort({said}), size({said}) - 1).reason")


def reason_category(reason: str) -> Column:
    """What a retirement reason opens with."""
    return F.expr(f"case when {reason} like '%: %' then substring_index({reason}, ': ', 1) when {reason} like 'duplicate of %' then 'duplicate' else {reason} end")


def live_senses(entries: DataFrame) -> DataFrame:
    """One row a live sense with its nested parts."""
    s = entries.select("lexeme_id", "headword", "tier", "source", "provenance", F.explode("senses").alias("s")).where("not s.retired")
    return s.select("lexeme_id", "headword", "tier", "source", "provenance", "s.*")


def pick(renditions: str, level: str) -> Column:
    """(text, fallback) of the plain rendition at a level, else the neutral one."""
    at = lambda x: f"get(filter({renditions}, r -> r.reading_level = '{x}' and r.register = 'plain'), 0).text"
    return F.expr(f"struct(coalesce({at(level)}, {at('neutral')}) as text, {at(level)} is null as fallback)")


def missing(renditions: str, targets: list[tuple[str, str]]) -> Column:
    """Requested (level/register) keys that a rendition set lacks, in order."""
    keys = "array(" + ", ".join(f"'{a}/{b}'" for a, b in targets) + ")"
    return F.expr(f"array_except({keys}, transform(coalesce({renditions}, array()), r -> concat(r.reading_level, '/', r.register)))")


def representative(examples: str) -> Column:
    """The canonical example, else the first."""
    return F.expr(f"coalesce(get(filter({examples}, e -> e.reading_level = 'neutral' and e.register = 'plain'), 0), get({examples}, 0))")


def release(entries: DataFrame) -> dict[str, DataFrame]:
    """All relations of the entries, by name; senses that are retired have rows in lexicon, inflections, provenance and tombstoned only."""
    e = entries.withColumn("source", source_of(entries))
    live = live_senses(e)
    keys = [F.col(k) for k in KEYS]
    glosses = live.select(*keys, F.explode("glosses").alias("g")).select(*KEYS, "g.reading_level", "g.register", "g.text", (F.col("g.reading_level").eqNullSafe("neutral") & F.col("g.register").eqNullSafe("plain")).alias("is_canonical"))
    examples = live.select(*keys, "provenance", F.explode("examples").alias("x"))
    wrote = F.when(F.element_at("provenance", F.col("x.provenance_id"))["stage"] == "examples", "per_sense").otherwise("renditions")
    examples = examples.select(*KEYS, "x.reading_level", "x.register", "x.text", F.col("x.span.start").alias("span_start"), F.col("x.span.end").alias("span_end"), wrote.alias("source"))
    relations = live.select("lexeme_id", "headword", "pos", "tier", "sense_id", F.explode("relations").alias("r"))
    relations = relations.select(
        F.concat("sense_id", F.lit("-"), "r.type", F.lit("->"), "r.target_lexeme_id").alias("edge_id"), F.col("sense_id").alias("source_sense_id"), F.col("lexeme_id").alias("source_lexeme_id"), "headword", "pos",
        "r.type", "r.target_term", "r.target_lexeme_id", "r.target_sense_id", F.col("r.target_sense_id").isNotNull().alias("resolved"), "r.confidence", "tier",
    )
    queries = live.select(*keys, F.posexplode("queries").alias("i", "q")).select(P.query_id("sense_id", "i").alias("query_id"), *KEYS, "q.style", "q.text", P.span("q.text", F.col("headword"), T.forms("headword"))["start"].isNull().alias("headword_free"))
    qa = live.select(*keys, F.posexplode("qa").alias("i", "q")).select(P.qa_id("sense_id", "i").alias("qa_id"), *KEYS, "q.question", "q.answer", "q.grounded_in")
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    canonical = F.expr("get(filter(glosses, g -> g.reading_level = 'neutral' and g.register = 'plain'), 0).text")
    senses = live.select(*keys, canonical.alias("gloss"), *(F.greatest(F.lit(0), size(c)).alias(n) for c, n in (("glosses", "n_glosses"), ("examples", "n_examples"), ("relations", "n_relations"), ("queries", "n_queries"), ("qa", "n_qa_pairs"))), "source")
    alive = "filter(senses, s -> not s.retired)"
    lexicon = e.withColumn("retired", F.expr(f"size({alive}) = 0")).select(
        "lexeme_id", "headword", "kind", "aliases", "tier", "source", "retired", F.when(F.col("retired"), retired_reason(e)).alias("retired_reason"), F.expr(f"transform({alive}, s -> s.sense_id)").alias("sense_ids"),
        F.expr(f"size({alive})").alias("n_live_senses"), F.expr(f"size(senses) - size({alive})").alias("n_retired_senses"), "frequency", F.expr("array_sort(array_distinct(transform(map_values(provenance), r -> r.model)))").alias("models"),
        F.expr("aggregate(map_values(provenance), 0D, (s, r) -> s + r.cost)").alias("total_cost"), F.expr("greatest(0, size(provenance))").alias("n_records"),
    )
    prose = e.select("lexeme_id", "headword", "tier", "kind", F.explode("encyclopedia").alias("r")).select("lexeme_id", "headword", "tier", "kind", "r.reading_level", "r.register", "r.text", F.expr("size(filter(split(r.text, '\\\\s+'), w -> w != ''))").alias("n_words"), (F.col("r.reading_level") == "neutral").alias("is_canonical"))
    etymology = e.where("size(etymology) > 0").select("lexeme_id", "headword", "tier", "kind", F.expr("array_join(transform(etymology, x -> x.segment), '; ')").alias("summary"), F.expr("transform(etymology, x -> x.segment)").alias("segments"), F.size("etymology").alias("n_segments"))
    pos = e.select("lexeme_id", "headword", "tier", "aliases", F.explode(F.expr("array_distinct(transform(senses, s -> s.pos))")).alias("pos"))
    f = T.forms("headword")
    forms = F.concat(F.array(F.struct(F.lit("lemma").alias("relation"), F.col("headword").alias("form")), *(F.struct(F.lit(r).alias("relation"), F.get(f, F.lit(i)).alias("form")) for i, r in enumerate(("plural", "past", "present_participle")))), F.transform("aliases", lambda a: F.struct(F.lit("alias").alias("relation"), a.alias("form"))))
    inflections = pos.select("lexeme_id", "headword", "pos", "tier", F.explode(F.array_distinct(forms)).alias("x")).where("x.form is not null").select(F.col("x.form").alias("form"), F.lower("x.form").alias("form_normalized"), "lexeme_id", "headword", "pos", "tier", "x.relation")
    prov = records(e)
    provenance = prov.select("lexeme_id", "headword", "tier", "provenance_id", "r.stage", "r.model", "r.cost", P.truncated("r.note").alias("note"))
    gone = P.removals(prov.where("r.note like 'reconcile:%'").select("lexeme_id", "headword", "tier", "provenance_id", "r.note"), "note").drop("note")
    sides = glosses.where("is_canonical").select(F.col("sense_id").alias("sid"), F.col("text").alias("gloss"), F.col("headword").alias("head"))
    c = e.select(F.col("lexeme_id").alias("source_lexeme_id"), "tier", F.explode("contrasts").alias("c")).select("source_lexeme_id", "tier", "c.edge_id", "c.target_sense_id", "c.verdict", "c.text")
    parsed = r"^(.*)-(synonym|hypernym|antonym|confusable|see_also)->([^>]*)$"
    c = c.withColumn("source_sense_id", F.regexp_extract("edge_id", parsed, 1)).withColumn("relation_type", F.regexp_extract("edge_id", parsed, 2))
    c = c.join(sides.select(F.col("sid").alias("source_sense_id"), F.col("gloss").alias("source_gloss")), "source_sense_id").join(sides.select(F.col("sid").alias("target_sense_id"), F.col("gloss").alias("target_gloss"), F.col("head").alias("target_headword")), "target_sense_id")
    out = {"lexicon": lexicon, "senses": senses, "definitions": glosses, "examples": examples, "relations": relations, "queries": queries, "qa_pairs": qa, "encyclopedia": prose, "etymology": etymology, "inflections": inflections, "provenance": provenance, "tombstoned": gone, "contrasts": c}
    return {name: df.select(*RELATIONS[name]) for name, df in out.items()}


def tiered(entries: DataFrame, tiers: DataFrame) -> DataFrame:
    """The tier of the first list (file_order) that names an entry's id, else 'unknown'."""
    first = tiers.groupBy(F.col("lexeme_id").alias("t_id")).agg(F.min_by("tier", "file_order").alias("tier"))
    return entries.join(first, F.col("lexeme_id") == F.col("t_id"), "left").drop("t_id").withColumn("tier", F.coalesce("tier", F.lit("unknown")))


def write_release(entries: DataFrame, out: str, rows_per_file: int = 500_000, scope: DataFrame | None = None) -> dict[str, int]:
    """Every relation as a folder of zstd Parquet files of bounded rows, schema checked first; an empty relation has an empty file. scope (lexeme_id) restricts entries last. Returns rows by relation."""
    kept = entries if scope is None else entries.join(scope.select("lexeme_id").distinct(), "lexeme_id", "left_semi")
    counts = {}
    for name, df in release(kept).items():
        if tuple(df.columns) != RELATIONS[name]:
            raise ValueError(f"{name}: columns {df.columns}")
        df.write.mode("errorifexists").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(f"{out}/{name}")
        counts[name] = entries.sparkSession.read.schema(df.schema).parquet(f"{out}/{name}").count()
    return counts


def write_jsonl(df: DataFrame, path: str, order: list[str]) -> None:
    """C11: an object a line, in order within and across files."""
    df.orderBy(*order).write.mode("errorifexists").json(path)


def write_trec(df: DataFrame, path: str) -> None:
    """C12: 'query 0 document grade' lines, ordered by query, grade and document."""
    df.orderBy("query_id", F.desc("grade"), "doc_id").select(F.concat_ws(" ", "query_id", F.lit("0"), "doc_id", F.col("grade").cast("string"))).write.mode("errorifexists").text(path)


def write_tsv(df: DataFrame, path: str, order: list) -> None:
    """A header and tab-separated rows in order."""
    df.orderBy(*order).write.mode("errorifexists").option("sep", "\t").option("header", True).csv(path)


# -- supervision


def wic_positive(entries: DataFrame) -> DataFrame:
    """G1: unordered pairs of a live sense's examples, equal (text, span) once, in stored order."""
    x = live_senses(entries).select("sense_id", F.posexplode("examples").alias("ord", "x")).select("sense_id", "ord", "x.text", "x.span")
    first = x.groupBy("sense_id", "text", "span").agg(F.min("ord").alias("ord"))
    a, b = first.select("sense_id", F.col("ord").alias("a"), F.col("text").alias("text_a")), first.select("sense_id", F.col("ord").alias("b"), F.col("text").alias("text_b"))
    return a.join(b, "sense_id").where("a < b")  # a sense has few examples


def encyclopedia_pairs(entries: DataFrame) -> DataFrame:
    """The representative example of an entry's one live sense with its encyclopedia text; entries of several senses have none."""
    alive = "filter(senses, s -> not s.retired)"
    one = entries.where(F.expr(f"size({alive}) = 1")).withColumn("s", F.expr(f"{alive}[0]")).withColumn("x", representative("s.examples")).withColumn("article", pick("encyclopedia", "neutral"))
    return one.where("x is not null and article.text is not null").select(F.col("s.sense_id").alias("sense_id"), F.col("x.text").alias("example"), F.col("article.text").alias("article"))


def query_records(entries: DataFrame) -> DataFrame:
    """Stored queries with ids from 1, else one of the gloss for the fifth grade, else of the canonical gloss."""
    live = live_senses(entries).withColumn("g", F.expr("coalesce(get(filter(glosses, g -> g.reading_level = 'grade_5' and g.register = 'plain'), 0).text, get(filter(glosses, g -> g.reading_level = 'neutral' and g.register = 'plain'), 0).text)"))
    made = F.when(F.size("queries") > 0, F.transform("queries", lambda q: F.struct(q["text"].alias("text"), F.lit("stored").alias("kind")))).otherwise(F.array(F.struct(F.col("g").alias("text"), F.lit("gloss").alias("kind"))))
    q = live.select("sense_id", "lexeme_id", F.posexplode(made).alias("i", "q")).where("q.text is not null")
    return q.select(F.expr("concat(sense_id, '#q', i + 1)").alias("query_id"), "sense_id", "lexeme_id", "q.text", "q.kind")


def positive_options(entries: DataFrame) -> DataFrame:
    """What answers a sense's query: gloss, first example, and the article if the entry has one live sense."""
    alive = F.expr("size(filter(senses, s -> not s.retired))").alias("n_live")
    live = entries.select("lexeme_id", "headword", "tier", F.lit("").alias("source"), "provenance", "senses", "encyclopedia", alive)
    s = live.select("lexeme_id", "n_live", "encyclopedia", F.explode("senses").alias("s")).where("not s.retired").select("lexeme_id", "n_live", "encyclopedia", "s.*")
    gloss = F.expr("get(filter(glosses, g -> g.reading_level = 'neutral' and g.register = 'plain'), 0).text")
    article = F.when(F.col("n_live") == 1, pick("encyclopedia", "neutral")["text"])
    option = lambda kind, c: F.when(c.isNotNull(), F.struct(F.lit(kind).alias("kind"), c.alias("text")))
    options = F.array_compact(F.array(option("gloss", gloss), option("example", F.expr("get(examples, 0).text")), option("encyclopedia", article)))
    return s.select("sense_id", "lexeme_id", F.posexplode(options).alias("ord", "o")).select("sense_id", "lexeme_id", "ord", "o.kind", "o.text")


HARD = ("other_sense", "confusable", "co_hyponym", "synonym_of_synonym")


def hard_negatives(tiers: DataFrame, seed: int) -> DataFrame:
    """For each src one target of its first non-empty tier in the order of HARD, by keyed draw over the pair."""
    rank = F.array_position(F.array(*map(F.lit, HARD)), F.col("tier"))
    t = tiers.where(F.col("tier").isin(*HARD)).withColumn("pair", F.concat_ws(":", "src", "dst"))
    best = t.groupBy("src").agg(F.min(F.struct(rank.alias("rank"), drawn("pair", seed).alias("draw"), "dst", "tier")).alias("m"))
    return best.select("src", F.col("m.dst").alias("negative"), F.col("m.tier").alias("kind"))


def graded(tiers: DataFrame, all_: DataFrame, seed: int, most: int = 3) -> DataFrame:
    """Candidates of each src: itself 3, synonyms 2, hypernyms and co-hyponyms 1, zeros from the other tiers, `most` of each by keyed draw; a src without a zero gets the next of all senses (src column) on a ring."""
    t = tiers.withColumn("grade", F.when(F.col("tier") == "synonym", 2).when(F.col("tier").isin("hypernym", "co_hyponym"), 1).otherwise(0))
    draw = drawn("pair", seed)
    t = t.withColumn("pair", F.concat_ws(":", "src", "dst"))
    nth = F.row_number().over(Window.partitionBy("src", "grade").orderBy(draw, "dst"))
    some = t.withColumn("nth", nth).where(F.col("nth") <= most).select("src", "dst", "grade")
    own = all_.select("src", F.col("src").alias("dst"), F.lit(3).alias("grade"))
    zero = some.where("grade = 0").select("src").distinct()
    lone = all_.join(zero, "src", "left_anti").join(all_.select(F.col("src").alias("dst"), F.col("ring").alias("at")), F.expr("ring_of = at")).join(t.select("src", "dst"), ["src", "dst"], "left_anti").where("src != dst")
    return own.unionByName(some).unionByName(lone.select("src", "dst", F.lit(0).alias("grade")))


def on_a_ring(ids: DataFrame, key: str, step: int = 7) -> DataFrame:
    """src, ring, ring_of: dense places of ids and each one's partner `step` further on: a negative by rank, without its pool.

    Places come from counts of 4096 hash ranges, so no task sorts all ids.
    """
    b = ids.select(F.col(key).alias("src"), F.pmod(F.xxhash64(F.lit("ring"), F.col(key)), F.lit(4096)).alias("b"))
    sizes = b.groupBy("b").agg(F.count("*").alias("n"))
    begin = sizes.withColumn("begin", F.coalesce(F.sum("n").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("total", F.sum("n").over(Window.partitionBy()))  # at most 4096 rows
    within = F.row_number().over(Window.partitionBy("b").orderBy("src"))
    return b.withColumn("w", within).join(F.broadcast(begin), "b").select("src", (F.col("begin") + F.col("w") - 1).alias("ring"), F.pmod(F.col("begin") + F.col("w") - 1 + step, F.col("total")).alias("ring_of"))


TEMPLATES = ("dictionary", "thesaurus", "encyclopedia", "usage_note")


def documents(entries: DataFrame, levels: tuple[str, ...] = ("neutral", "grade_1", "college")) -> DataFrame:
    """doc_id, lexeme_id, template, level, level_used, text of every template and level that an entry has content of its own for; a level whose text equals the neutral one has none."""
    alive = "filter(senses, s -> not s.retired)"
    rows = entries.withColumn("live", F.expr(alive)).where("size(live) > 0").select("lexeme_id", "headword", "live", "encyclopedia", F.explode(F.array(*map(F.lit, levels))).alias("level"))
    at = lambda xs, lv: f"get(filter({xs}, r -> r.reading_level = {lv} and r.register = 'plain'), 0).text"
    gloss = f"coalesce({at('s.glosses', 'level')}, {at('s.glosses', chr(39) + 'neutral' + chr(39))})"
    own = f"exists(live, s -> {at('s.glosses', 'level')} is not null)"
    listed = f"array_join(transform(live, (s, i) -> concat(cast(i + 1 as string), '. ', coalesce({gloss}, ''))), '\\n')"
    terms = lambda kind: f"array_sort(array_distinct(flatten(transform(live, s -> transform(filter(coalesce(s.relations, array()), r -> r.type = '{kind}'), r -> r.target_term)))))"
    thesaurus = f"concat_ws('\\n', case when size({terms('synonym')}) > 0 then concat('Synonyms: ', array_join({terms('synonym')}, ', ')) end, case when size({terms('antonym')}) > 0 then concat('Antonyms: ', array_join({terms('antonym')}, ', ')) end)"
    usage = "array_join(flatten(transform(live, s -> transform(filter(coalesce(s.examples, array()), x -> x.reading_level = level), x -> concat('- ', x.text)))), '\\n')"
    made = rows.select(
        "lexeme_id", "headword", "level", F.expr(f"case when {own} then {listed} end").alias("dictionary"), F.expr(f"case when level = 'neutral' then nullif({thesaurus}, '') end").alias("thesaurus"),
        F.expr(at("encyclopedia", "level")).alias("encyclopedia"), F.expr(f"nullif({usage}, '')").alias("usage_note"),
    )
    docs = made.select("lexeme_id", "headword", "level", F.explode(F.array(*(F.struct(F.lit(t).alias("template"), F.col(t).alias("body")) for t in TEMPLATES))).alias("x")).where("x.body is not null")
    docs = docs.select("lexeme_id", "level", "x.template", F.concat(F.lit("# "), "headword", F.lit("\n"), "x.body").alias("text"))
    plain = docs.where("level = 'neutral'").select("lexeme_id", "template", F.md5(F.col("text").cast("binary")).alias("neutral"))
    kept = docs.join(plain, ["lexeme_id", "template"], "left").where("level = 'neutral' or neutral is null or md5(cast(text as binary)) != neutral")
    return kept.select(F.concat_ws(":", "lexeme_id", "template", "level").alias("doc_id"), "lexeme_id", "template", "level", "text")


def draw_templates(docs: DataFrame, per_entry: int, seed: int) -> DataFrame:
    """`per_entry` documents of each entry by keyed draw."""
    nth = F.row_number().over(Window.partitionBy("lexeme_id").orderBy(drawn("doc_id", seed), "doc_id"))
    return docs.withColumn("nth", nth).where(F.col("nth") <= per_entry).drop("nth")
