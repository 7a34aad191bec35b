"""Repair of relation graphs and entries: plans are tables of edits, applying them makes a new snapshot (operators E6-E17, F17-F39)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.functions import predicates as P
from lexweave.functions import text as T
from lexweave.operators import graph

INVERSE = {"hypernym": "hyponym", "hyponym": "hypernym", "synonym": "synonym", "antonym": "antonym", "confusable": "confusable", "see_also": "see_also"}
EDITS = "src, dst, type, to, step"


def plan_self_loops(edges: DataFrame, lexemes: DataFrame) -> DataFrame:
    """hypernym edges within one lexeme become see_also. lexemes: sense_key, lexeme_id."""
    side = lambda x: lexemes.select(F.col("sense_key").alias(x), F.col("lexeme_id").alias(f"lex_{x}"))
    e = edges.where("type = 'hypernym'").select("src", "dst", "type").distinct().join(side("src"), "src").join(side("dst"), "dst")
    return e.where("lex_src = lex_dst").select("src", "dst", "type", F.lit("see_also").alias("to"), F.lit("self_loop").alias("step"))


def plan_mutual(edges: DataFrame) -> DataFrame:
    """both edges of a mutual hypernym pair become synonyms, or see_also where the end has that synonym already."""
    pairs = graph.mutual_pairs(edges)
    both = pairs.select(F.col("a").alias("src"), F.col("b").alias("dst")).union(pairs.select("b", "a"))
    syn = edges.where("type = 'synonym'").select("src", "dst").distinct().withColumn("has", F.lit(True))
    return both.join(syn, ["src", "dst"], "left").select("src", "dst", F.lit("hypernym").alias("type"), F.when(F.col("has"), "see_also").otherwise(F.lit("synonym")).alias("to"), F.lit("mutual").alias("step"))


def plan_cycles(edges: DataFrame) -> DataFrame:
    """hypernym edges that close a cycle with better ones become see_also."""
    e = edges.where("type = 'hypernym'")
    return graph.cycle_edges(e).select("src", "dst", F.lit("hypernym").alias("type"), F.lit("see_also").alias("to"), F.lit("cycle").alias("step"))


def applied(edges: DataFrame, edits: DataFrame) -> DataFrame:
    """the edges with the types that edits (src, dst, type, to) give them; what no edit names is unchanged."""
    e = edits.groupBy("src", "dst", "type").agg(F.min("to").alias("to"))
    return edges.join(e, ["src", "dst", "type"], "left").withColumn("type", F.coalesce("to", "type")).select(*edges.columns)


def sweep(edges: DataFrame, lexemes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, edits) after self loops, mutual pairs, cycles and reciprocity in this order, each over what the last one left. A second sweep has no edits."""
    edges, done = graph.cut(edges), None
    for plan in (lambda e: plan_self_loops(e, lexemes), plan_mutual, plan_cycles):
        edits = graph.cut(plan(edges))
        edges = graph.cut(applied(edges, edits))
        done = edits if done is None else done.union(edits)
    more = graph.reciprocal_additions(edges)
    added = more.select(*(F.col(c) if c in more.columns else F.lit(None).cast(dict(edges.dtypes)[c]).alias(c) for c in edges.columns))
    done = done.union(more.select("src", "dst", "type", F.col("type").alias("to"), F.lit("reciprocity").alias("step")))
    return edges.union(added), done


def cycle_report(edges: DataFrame) -> DataFrame:
    """of each strongly connected component of two nodes or more its size, and the edges inside that close cycles."""
    scc = graph.strong_components(edges)
    big = scc.groupBy("scc").agg(F.count("*").alias("nodes")).where("nodes > 1")
    inside = edges.where("src != dst").select("src", "dst").distinct().join(scc.withColumnRenamed("node", "src"), "src").join(scc.select(F.col("node").alias("dst"), F.col("scc").alias("other")), "dst").where("scc = other")
    return big.join(inside.groupBy("scc").agg(F.count("*").alias("edges")), "scc")


def resolutions(unresolved: DataFrame, live: DataFrame) -> DataFrame:
    """each unresolved relation with the live senses of its target lexeme: how many, and the one if it is alone. unresolved: target_lexeme_id; live: sense_id, lexeme_id."""
    c = live.groupBy(F.col("lexeme_id").alias("target_lexeme_id")).agg(F.count("*").alias("candidates"), F.min("sense_id").alias("only"))
    return unresolved.join(c, "target_lexeme_id", "left").withColumn("candidates", F.coalesce("candidates", F.lit(0))).withColumn("resolved_to", F.when(F.col("candidates") == 1, F.col("only"))).drop("only")


def verdict_edits(edges: DataFrame, verdicts: DataFrame) -> DataFrame:
    """edges whose contrast says otherwise become see_also, and the reverse edge of the same type with them. verdicts: src, dst, type, verdict."""
    bad = verdicts.where("verdict != 'as_typed'").select("src", "dst", "type").distinct().join(edges.select("src", "dst", "type").distinct(), ["src", "dst", "type"], "left_semi")
    near = bad.select("src", "dst", "type", F.lit("see_also").alias("to"), F.lit("verdict").alias("step"))
    return near.union(far_side(bad, edges).select("src", "dst", "type", F.lit("see_also"), F.lit("verdict_far_side")))


def far_side(edits: DataFrame, edges: DataFrame) -> DataFrame:
    """the reverse edges, of the inverse type, of edited symmetric edges, as far as they exist and aren't edited themselves."""
    back = edits.where(F.col("type").isin(*graph.SYMMETRIC)).select(F.col("dst").alias("src"), F.col("src").alias("dst"), "type").distinct()
    there = back.join(edges.select("src", "dst", "type").distinct(), ["src", "dst", "type"], "left_semi")
    return there.join(edits.select("src", "dst", "type").distinct(), ["src", "dst", "type"], "left_anti")


def asymmetric_edits(edges: DataFrame) -> DataFrame:
    """symmetric edges whose other end was demoted to see_also and asserts the type no more."""
    e = edges.where(F.col("type").isin(*graph.SYMMETRIC)).select("src", "dst", "type").distinct()
    demoted = edges.where("type = 'see_also'").select(F.col("dst").alias("src"), F.col("src").alias("dst")).distinct()
    live = e.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "type")
    return e.join(demoted, ["src", "dst"], "left_semi").join(live, ["src", "dst", "type"], "left_anti").select("src", "dst", "type", F.lit("see_also").alias("to"), F.lit("asymmetric").alias("step"))


def retype_edits(edges: DataFrame, proposals: DataFrame) -> DataFrame:
    """edges get the proposed type, and reverse edges of the inverse of their old type the inverse of the new one. proposals: src, dst, type, to."""
    inverse = lambda c: F.element_at(F.create_map(*(F.lit(x) for kv in INVERSE.items() for x in kv)), c)
    have = edges.select("src", "dst", "type").distinct()
    near = proposals.join(have, ["src", "dst", "type"], "left_semi").select("src", "dst", "type", "to", F.lit("retype").alias("step"))
    back = near.select(F.col("dst").alias("src"), F.col("src").alias("dst"), inverse(F.col("type")).alias("type"), inverse(F.col("to")).alias("to"), F.lit("retype_far_side").alias("step"))
    return near.union(back.join(have, ["src", "dst", "type"], "left_semi").join(near.select("src", "dst", "type"), ["src", "dst", "type"], "left_anti"))


def inflection_edits(relations: DataFrame) -> DataFrame:
    """relations whose target is a form of the headword, or of a shorter target of the same sense and type (the shortest, then first). relations: sense_id, headword, type, target_term."""
    r = relations.select("sense_id", "headword", "type", "target_term").distinct()
    own = r.where(F.array_contains(T.forms("headword"), F.col("target_term")) | (F.lower("target_term") == F.lower("headword"))).select("sense_id", "type", "target_term", F.lit("headword").alias("of"), F.col("headword").alias("base"))
    base = r.select("sense_id", "type", F.col("target_term").alias("base"), F.explode(T.forms("target_term")).alias("target_term")).where("length(base) < length(target_term)")
    met = r.join(base, ["sense_id", "type", "target_term"]).groupBy("sense_id", "type", "target_term").agg(F.min(F.struct(F.length("base").alias("n"), "base")).alias("m"))
    sibling = met.join(own, ["sense_id", "type", "target_term"], "left_anti").select("sense_id", "type", "target_term", F.lit("sibling").alias("of"), F.col("m.base").alias("base"))
    return own.union(sibling)


def phrase_edits(relations: DataFrame, stored: DataFrame) -> DataFrame:
    """relations to phrases of several words that hold the headword and are no entry. stored: headword."""
    r = relations.select("sense_id", "headword", "type", "target_term").distinct().withColumn("key", P.candidate_key("target_term"))
    r = r.where(F.contains("key", F.lit(" ")) & (F.col("key") != F.lower("headword")) & P.headword_present("key", "lower(headword)"))
    return r.join(stored.select(F.lower("headword").alias("key")).distinct(), "key", "left_anti").select("sense_id", "type", "target_term")


def label_edits(relations: DataFrame) -> DataFrame:
    """relations to labels about words."""
    return relations.select("sense_id", "type", "target_term").distinct().where(P.meta_label("target_term"))


def alias_verdicts(candidates: DataFrame, live: DataFrame, linked: DataFrame) -> DataFrame:
    """alias candidates (alias, target_lexeme) by what the store says: absent, linked already, named by a live gloss of the target (free), or to be judged."""
    glosses = live.groupBy(F.col("lexeme_id").alias("target_lexeme")).agg(F.collect_list(F.lower("gloss")).alias("gl"))
    has = linked.select("alias", "target_lexeme").distinct().withColumn("linked", F.lit(True))
    c = candidates.join(glosses, "target_lexeme", "left").join(has, ["alias", "target_lexeme"], "left")
    named = F.expr("exists(gl, g -> contains(concat(' ', g, ' '), concat(' ', lower(alias), ' ')))")
    return c.select("alias", "target_lexeme", F.when(F.col("gl").isNull(), "absent").when(F.col("linked"), "linked").when(named, "free").otherwise(F.lit("judge")).alias("verdict"))


def distinct_from_lemma(forms: DataFrame, sets: DataFrame) -> DataFrame:
    """whether a form has sets that its lemma lacks; null if the form has none. forms: form, lemma; sets: word, id."""
    s = sets.groupBy("word").agg(F.collect_set("id").alias("ids"))
    f = forms.join(s.select(F.col("word").alias("form"), F.col("ids").alias("of_form")), "form", "left").join(s.select(F.col("word").alias("lemma"), F.col("ids").alias("of_lemma")), "lemma", "left")
    return f.select("form", "lemma", F.expr("case when of_form is not null then size(array_except(of_form, coalesce(of_lemma, array()))) > 0 end").alias("distinct"))


def merged_senses(senses: DataFrame, relations: DataFrame) -> DataFrame:
    """senses of a lexeme with equal glosses become the one of lowest index, which has all their relations once. senses: lexeme_id, sense_id, sense_index, gloss; relations: sense_id, type, target."""
    s = senses.withColumn("key", T.gloss_key("gloss"))
    low = s.groupBy("lexeme_id", "key").agg(F.min(F.struct("sense_index", "sense_id")).alias("m"), F.count("*").alias("members"))
    s = s.join(low.where("members > 1"), ["lexeme_id", "key"]).select("sense_id", F.col("m.sense_id").alias("survivor"), "members")
    return s.join(relations, "sense_id", "left").groupBy("survivor", "members").agg(F.count_distinct("type", "target").alias("relations"))


def placements(examples: DataFrame, moves: DataFrame) -> DataFrame:
    """what becomes of each drafted move of an example (sense_id, ord, to: null to drop): moved, dropped, kept if its sense would be left without one, or nowhere if `to` is its own sense. Moves count in order."""
    n = examples.groupBy("sense_id").agg(F.count("*").alias("have"))
    m = moves.join(n, "sense_id").withColumn("real", (~F.col("sense_id").eqNullSafe(F.col("to"))).cast("int"))
    nth = F.sum("real").over(Window.partitionBy("sense_id").orderBy("ord"))
    verdict = F.when(F.col("real") == 0, "nowhere").when(nth >= F.col("have"), "kept").when(F.col("to").isNull(), "dropped").otherwise(F.lit("moved"))
    return m.select("sense_id", "ord", "to", verdict.alias("verdict"))


def better(first: DataFrame, retry: DataFrame, key: list[str], misses: list[str]) -> DataFrame:
    """Of a rendition and its retry the one with fewer misses in their order, the first if they tie. Both have the key, `misses` and text."""
    a, b = first.withColumn("try", F.lit(1)), retry.withColumn("try", F.lit(2))
    rank = F.struct(*(F.col(m).cast("int") for m in misses), F.col("try"))
    return a.unionByName(b).groupBy(*key).agg(F.min_by(F.struct("text", "try"), rank).alias("m")).select(*key, "m.text", F.col("m.try").alias("used"))


def missing_work(owners: DataFrame, present: DataFrame, targets: list[tuple[str, str]]) -> DataFrame:
    """Requested (level, register) that an owner lacks. owners: owner; present: owner, reading_level, register."""
    t = F.explode(F.array(*(F.struct(F.lit(a).alias("reading_level"), F.lit(b).alias("register")) for a, b in targets)))
    return owners.select("owner", t.alias("t")).select("owner", "t.reading_level", "t.register").join(present, ["owner", "reading_level", "register"], "left_anti")


def contrast_owners(edges: DataFrame) -> DataFrame:
    """Each typed pair once: owned by its smaller end if both ends assert it, else by the end that does; skip reasons for the rest. edges: src, dst, type, target (null if unresolved)."""
    e = edges.select("src", "dst", "type", "resolved").distinct()
    back = e.where("resolved").select(F.col("dst").alias("src"), F.col("src").alias("dst"), "type").distinct().withColumn("back", F.lit(True))
    m = e.join(back, ["src", "dst", "type"], "left")
    reason = F.when(F.col("type") == "see_also", "untyped").when(~F.col("resolved"), "unresolved").when(F.col("src") == F.col("dst"), "self").when(F.col("back") & (F.col("src") > F.col("dst")), "owned_by_far_side").otherwise(F.lit("eligible"))
    return m.withColumn("reason", reason)


def regen_slots(live: DataFrame, relations: DataFrame, rejected: DataFrame) -> DataFrame:
    """Live senses without relations, and how many targets were rejected for them before."""
    bare = live.join(relations.select("sense_id").distinct(), "sense_id", "left_anti")
    return bare.join(rejected.groupBy("sense_id").agg(F.count_distinct("target").alias("rejected")), "sense_id", "left").withColumn("rejected", F.coalesce("rejected", F.lit(0)))


def attempts(markers: DataFrame, current: DataFrame, most: int) -> DataFrame:
    """Due, and the attempt's number: 1 unless the owner's last marker has the current digest, then one more, up to `most`. markers: owner, n, digest, attempt; current: owner, digest."""
    last = markers.groupBy("owner").agg(F.max_by(F.struct(F.col("digest").alias("last"), "attempt"), "n").alias("m"))
    c = current.join(last, "owner", "left")
    number = F.when(F.col("m.last").eqNullSafe(F.col("digest")), F.col("m.attempt") + 1).otherwise(F.lit(1))
    return c.select("owner", number.cast("int").alias("attempt"), (number <= most).alias("due"))


def degenerate(renditions: DataFrame) -> DataFrame:
    """Renditions that say what an earlier one of the same owner says (order `ord`). renditions: owner, ord, text."""
    r = renditions.withColumn("key", P.form_key("text"))
    low = r.groupBy("owner", "key").agg(F.min("ord").alias("first"))
    return r.join(low, ["owner", "key"]).where("ord > first").select("owner", "ord", "first")


def circular(glosses: DataFrame) -> DataFrame:
    """Glosses that name their headword as a whole word. glosses: sense_id, headword, text."""
    return glosses.where(P.headword_present("lower(text)", "lower(headword)"))


def rewrites(drafts: DataFrame, others: DataFrame, least: int = 1) -> DataFrame:
    """Why a rewrite of a circular gloss is refused: empty, circular still, too little in common with the old one, or what another sense says; else accepted. drafts: sense_id, headword, old, new; others: key (gloss keys in use)."""
    d = drafts.withColumn("key", T.gloss_key("new")).join(others.select("key").distinct().withColumn("taken", F.lit(True)), "key", "left")
    common = F.expr(f"size(array_intersect({T.content_words_sql('old')}, {T.content_words_sql('new')}))")
    reason = F.when(F.trim(F.coalesce("new", F.lit(""))) == "", "empty").when(P.headword_present("lower(new)", "lower(headword)"), "circular").when(common < least, "unrelated").when(F.col("taken"), "collision").otherwise(F.lit("accepted"))
    return d.select("sense_id", reason.alias("reason"))


def last_kept(candidates: DataFrame, live: DataFrame) -> DataFrame:
    """Parts of speech to retire, never all live ones of a lexeme: of a lexeme that would lose all, the one of lowest ord stays. candidates: lexeme_id, pos; live: lexeme_id, pos, ord."""
    n = live.groupBy("lexeme_id").agg(F.count_distinct("pos").alias("have"))
    low = live.join(candidates.distinct(), ["lexeme_id", "pos"], "left_semi").groupBy("lexeme_id", "pos").agg(F.min("ord").alias("ord"))
    c = low.join(n, "lexeme_id").withColumn("asked", F.count("*").over(Window.partitionBy("lexeme_id"))).withColumn("first", F.min("ord").over(Window.partitionBy("lexeme_id")))
    return c.withColumn("retired", ~((F.col("asked") == F.col("have")) & (F.col("ord") == F.col("first")))).select("lexeme_id", "pos", "retired")


def flagged(df: DataFrame, flags: str, names: Column, remove: Column) -> DataFrame:
    """Flags with some added and others taken away; doing it again changes nothing."""
    return df.withColumn(flags, F.array_sort(F.array_union(F.array_except(F.coalesce(F.col(flags), F.array().cast("array<string>")), remove), names)))


def by_word_budget(df: DataFrame, group: str, order: str, words: str, budget: int) -> DataFrame:
    """Group, order, chunk: consecutive rows whose words stay within the budget; a longer row is alone. A group's rows are one entry's, so they are few."""
    import pandas as pd

    def run(pdf):
        pdf = pdf.sort_values(order)
        chunk, held, out = 0, 0, []
        for n in pdf[words]:
            if held and held + n > budget:
                chunk, held = chunk + 1, 0
            held += n
            out.append(chunk)
        return pd.DataFrame({group: pdf[group], order: pdf[order], "chunk": out})

    types = dict(df.dtypes)
    return df.select(group, order, words).groupBy(group).applyInPandas(run, f"{group} {types[group]}, {order} {types[order]}, chunk int")


def example_sieve(df: DataFrame, group: str, order: str, text: str, cap: int, most: int) -> DataFrame:
    """Group, order, reason: shape first, then what an accepted text of the group says or how one opens, then surplus. Only accepted rows block, so a group's rows are taken in order."""
    import pandas as pd

    shaped = df.select(group, order, P.example_reason(text, F.lit(cap)).alias("shape"), P.paragraph_key(text).alias("key"), F.lower(T.opener(text)).alias("opening"))

    def run(pdf):
        seen, openings, out = set(), set(), []
        for shape, key, opening in pdf.sort_values(order)[["shape", "key", "opening"]].itertuples(index=False):
            reason = shape or ("duplicate" if key in seen else "repeated_opening" if opening in openings else "surplus" if len(seen) >= most else None)
            if reason is None:
                seen.add(key)
                openings.add(opening)
            out.append(reason or "accepted")
        pdf = pdf.sort_values(order)
        return pd.DataFrame({group: pdf[group], order: pdf[order], "reason": out})

    types = dict(df.dtypes)
    return shaped.groupBy(group).applyInPandas(run, f"{group} {types[group]}, {order} {types[order]}, reason string")


def violations(entries: DataFrame) -> DataFrame:
    """Rule and id of every broken rule of nested entries."""
    sense = entries.select("lexeme_id", "headword", F.explode("senses").alias("s")).select("lexeme_id", "headword", "s.*")
    rules = [
        entries.where(F.col("lexeme_id") != T.slug("headword")).select(F.lit("id_matches_headword").alias("rule"), F.col("lexeme_id").alias("id")),
        entries.where(F.expr("not (array_sort(transform(senses, s -> s.sense_index)) <=> sequence(0, size(senses) - 1))")).select(F.lit("contiguous_sense_indices"), "lexeme_id"),
        entries.where(F.expr("size(array_distinct(transform(aliases, a -> lower(a)))) < size(aliases) or array_contains(aliases, headword)")).select(F.lit("aliases_are_distinct"), "lexeme_id"),
        sense.where(F.expr("size(filter(coalesce(glosses, array()), g -> g.reading_level = 'neutral' and g.register = 'plain')) != 1")).select(F.lit("canonical_gloss_required"), "sense_id"),
        sense.where(F.expr("size(array_distinct(transform(coalesce(glosses, array()), g -> concat(g.reading_level, '/', g.register)))) < size(coalesce(glosses, array()))")).select(F.lit("rendition_keys_are_unique"), "sense_id"),
        sense.select("sense_id", F.explode("queries").alias("q")).groupBy("sense_id", T.query_key("q.text").alias("k")).count().where("count > 1").select(F.lit("queries_are_distinct"), "sense_id").distinct(),
        sense.select("sense_id", F.explode("examples").alias("x")).where("x.span.start < 0 or x.span.end > length(x.text) or x.span.start >= x.span.end").select(F.lit("span_within_text"), "sense_id").distinct(),
        sense.select("sense_id", F.explode("relations").alias("r")).where(T.slug("r.target_term").isNull()).select(F.lit("term_must_be_sluggable"), "sense_id").distinct(),
    ]
    out = rules[0]
    for r in rules[1:]:
        out = out.union(r)
    return out
