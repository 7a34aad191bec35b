"""Keys, digests and text predicates as Spark SQL expressions; a UDF only where no built-in has the hash or the dynamic match."""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from lexweave.functions import text as T

quoted = T.quoted

# Labels about words that are no words themselves, qualifiers and the heads they stand before.
META_LABELS = (
    "see also", "see", "cf", "compare", "figurative", "literal", "archaic", "obsolete", "colloquial", "slang", "informal", "formal", "none", "n/a", "na", "unknown", "various", "etc", "other", "general",
    "slang term", "informal term", "formal term", "technical term", "general term", "generic term", "umbrella term", "archaic term", "obsolete term", "modifier", "qualifier", "intensifier", "determiner",
    "biblical name", "given name", "popular given name", "first name", "surname", "family name", "proper noun", "common noun", "collective noun", "mass noun", "count noun", "abbreviation", "acronym",
    "initialism", "contraction", "variant", "variant spelling", "alternative spelling", "alternate spelling", "alternative form", "spelling variant", "plural", "plural form", "singular", "singular form",
    "figurative sense", "literal sense", "figurative use", "literal use", "part of speech", "prefix", "suffix", "root word",
)
CANDIDATE_LABELS = META_LABELS[:20]
META_QUALIFIERS = (
    "slang", "informal", "formal", "colloquial", "archaic", "obsolete", "figurative", "literal", "technical", "scientific", "medical", "legal", "general", "generic", "umbrella", "blanket", "collective",
    "proper", "common", "plural", "singular", "variant", "alternative", "alternate", "given", "popular", "biblical", "dialect", "dialectal", "regional", "poetic", "derogatory", "offensive", "familiar", "polite", "vulgar",
)
META_HEADS = ("term", "form", "name", "word", "usage", "sense")
# Leftover slot labels among relation targets, and the most words of a target.
ARTIFACTS = ("descriptor", "descriptive term", "descriptive adjective", "descriptive word", "term", "word", "thing", "adjective", "noun", "verb", "concept", "general term")
ARTIFACT_WORDS = 4
# Register words, sentence ends, quotes, and phrases that name a prompt's own scaffolding.
STILTED = r"(?i)\b(researchers?|participants?|observers?|the study|this study|data ?set)\b"
TERMINALS = '.!?"”)'
OPENING_QUOTES = "\"'“”‘’"
META_REFERENCES = (
    r"(?i)\bthe examples?\b", r"(?i)\bthe passage\b", r"(?i)\bthe text (?:above|provided|given)\b", r"(?i)\baccording to the (?:sources?|text|example|passage|gloss|entry|definition)\b",
    r"(?i)\bas (?:described|stated|mentioned|shown) (?:in|above)\b", r"(?i)\bin the (?:example|passage|sources?) (?:above|provided|given)\b", r"(?i)\bthe (?:given|provided|supplied) (?:text|examples?|sources?)\b", r"(?i)\bthe sources\b",
)
LEADING_META = r"(?i)^(?:according to the \w+|as (?:described|stated|mentioned|shown) (?:in the \w+|above))[^,]*,\s*"
# Candidate filter.
ETYMON = r"(?i)[*√]|^(?:pie|proto)[- ]"
SENTENCE_SHAPED = r"(?i)[.;]|\b(?:which|that is|refers to|meaning)\b"
STRIPPABLE = ".,;:!?\"'()[]{}"
# Largest share of unfamiliar words by reading level; levels without one have no bar.
VOCABULARY_BANDS = (("grade_1", 0.10), ("grade_5", 0.25))
ENDINGS, SKIPPED = r".!?…:;\n\r", r" \t\"'(\[{\-‘“–—"
NOTE_CHARS = 500
CHARS_PER_TOKEN = 3.0
# Removal steps with the prefix of their records and lines.
REMOVALS = (("tombstone", "reconcile:tombstone ", "reconcile:tombstone: "), ("dedup", "reconcile:dedup ", "reconcile:dedup: "), ("cap", "reconcile:cap ", "reconcile:cap:"))
DEMOTION = "demoted: "


def _in(expr: str, words) -> str:
    return f"{expr} in ({', '.join(map(quoted, words))})"


# -- ids and keys


@F.pandas_udf(S.ArrayType(S.StringType()))
def shard(ids: pd.Series) -> pd.Series:
    """A3: two levels of two hex digits of the id's 64-bit blake2b."""
    return ids.map(lambda x: None if x is None else [(d := hashlib.blake2b(x.encode(), digest_size=8).hexdigest())[:2], d[2:4]])


@F.pandas_udf(S.StringType())
def _blake16(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: None if x is None else hashlib.blake2b(x.encode(), digest_size=8).hexdigest())


def concept_id(members: Column) -> Column:
    """A4: the same for any order of the member ids."""
    return F.concat(F.lit("og:c-"), _blake16(F.array_join(F.array_sort(members), ",")))


@F.pandas_udf(S.DecimalType(20, 0))
def digest64(texts: pd.Series) -> pd.Series:
    """blake2b of eight bytes as an unsigned little-endian integer."""
    from decimal import Decimal

    return texts.map(lambda x: None if x is None else Decimal(int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little")))


def slug_folded(text: str) -> Column:
    """A1 with accents: letters keep their base after canonical decomposition, what else isn't ASCII goes; null if nothing is left."""

    @F.pandas_udf(S.StringType())
    def fold(s: pd.Series) -> pd.Series:
        return s.str.normalize("NFKD").str.encode("ascii", "ignore").str.decode("ascii")

    plain = F.when(F.col(text).rlike(r"^\p{ASCII}*$"), F.col(text)).otherwise(fold(F.col(text)))
    return F.nullif(F.btrim(F.regexp_replace(F.lower(plain), "[^a-z0-9]+", "_"), F.lit("_")), F.lit(""))


def rendition_id(owner: str, level: str, register: str) -> Column:
    """A2: 'owner#level/register'."""
    return F.expr(f"concat({owner}, '#', {level}, '/', {register})")


def query_id(sense: str, index: str) -> Column:
    return F.expr(f"concat({sense}, '#q', {index})")


def qa_id(sense: str, index: str) -> Column:
    return F.expr(f"concat({sense}, '#qa', {index})")


def sense_of(identifier: str) -> Column:
    """What stands before the first '#'."""
    return F.substring_index(identifier, "#", 1)


def lexeme_of(identifier: str) -> Column:
    """What stands before the first ':' of the sense."""
    return F.substring_index(F.substring_index(identifier, "#", 1), ":", 1)


def removals(notes: DataFrame, note: str) -> DataFrame:
    """A row for each line of a removal record: step, source_sense_id, type, target_term, reason. Lines of another shape have none."""
    lines = notes.withColumn("lines", F.split(note, "\n"))
    step, sense, rest = F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, record, line in reversed(REMOVALS):
        is_record = F.startswith(F.col("lines")[0], F.lit(record)) & ~F.startswith(F.col("lines")[0], F.lit(line))
        step, sense = F.when(is_record, name).otherwise(step), F.when(is_record, F.trim(F.substr(F.col("lines")[0], F.lit(len(record) + 1)))).otherwise(sense)
        rest = F.when((F.col("step") == name) & F.startswith("line", F.lit(line)), F.substr("line", F.lit(len(line) + 1))).otherwise(rest)
    rows = lines.withColumn("step", step).withColumn("source_sense_id", sense).where("step is not null and source_sense_id != ''").withColumn("line", F.explode(F.expr("slice(lines, 2, greatest(0, size(lines) - 1))")))
    rows = rows.withColumn("rest", rest).where("rest is not null")
    shape = r"^(\S+) -> (.*) \[(.*)\]$"
    got = rows.withColumns({n: F.regexp_extract("rest", shape, i) for i, n in ((1, "type"), (2, "target_term"), (3, "reason"))})
    return got.where("type != ''").drop("lines", "line", "rest")


def paragraph_key(text: str) -> Column:
    """Lower case, ASCII letters and digits, single blanks."""
    return F.expr(f"trim(regexp_replace(regexp_replace(lower({text}), '[^a-z0-9 ]+', ' '), '[ ]+', ' '))")


def form_key(text: str) -> Column:
    """Lower case, white space collapsed."""
    return F.expr(f"trim(lower(regexp_replace({text}, '[ \\\\t\\\\n\\\\r\\\\f]+', ' ')))")


def candidate_key(text: str) -> Column:
    """Without punctuation around it, white space collapsed, lower case."""
    return F.expr(_key_sql(text))


def one_line(text: str) -> Column:
    """Without markdown, on one line."""
    return F.trim(F.regexp_replace(T.strip_markdown(text), r"[ \t\n\r\f]+", " "))


def truncated(note: str) -> Column:
    """Cut after NOTE_CHARS characters, with an ellipsis."""
    return F.expr(f"case when length({note}) > {NOTE_CHARS} then concat(left({note}, {NOTE_CHARS}), '…') else {note} end")


def iso(ts: str) -> Column:
    """UTC ISO-8601 of a timestamp without zone; microseconds only if there are any."""
    c = F.col(ts).cast("timestamp_ntz")
    return F.concat(F.when(F.date_format(c, "SSSSSS") == "000000", F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")), F.lit("+00:00"))


def marker(refs: Column) -> Column:
    """16 hex digits of SHA-256 over the sorted distinct refs, one a line."""
    return F.left(F.sha2(F.array_join(F.array_sort(F.array_distinct(refs)), "\n").cast("binary"), 256), F.lit(16))


# -- text predicates


def escaped(term: str) -> str:
    """SQL: term as a literal part of a pattern."""
    return f"regexp_replace({term}, '([^A-Za-z0-9 ])', '\\\\\\\\$1')"


def headword_initial(text: str, head: str) -> Column:
    """The text opens by naming the headword: alone, after an article, as 'the word/term X', or as 'to X is/means'."""
    word = f"concat({escaped(f'trim({head})')}, 's?(?![\\\\p{{L}}\\\\p{{N}}_])')"
    pattern = f"concat('(?i)^\\\\s*(?:the\\\\s+(?:word|term)\\\\s+', {word}, '|to\\\\s+', {word}, '\\\\s+(?:is|means)\\\\b|(?:a|an|the)\\\\s+', {word}, '|', {word}, ')')"
    return F.expr(f"case when trim(coalesce({head}, '')) = '' or trim(coalesce({text}, '')) = '' then false else {text} rlike {pattern} end")


def find_span(text: str, head: str, forms: list[str]) -> tuple[int, int] | None:
    """The longest whole-word match of a headword or form, blanks, hyphens and underscores alike; of equal ones the first."""
    found = []
    for term in (head, *forms):
        tokens = [re.escape(t) for t in re.split(r"[\s\-_]+", term or "") if t]
        if tokens:
            found += [m.span() for m in re.finditer(r"\b" + r"[\s\-_]+".join(tokens) + r"\b", text or "", re.IGNORECASE)]
    return max(found, key=lambda s: (s[1] - s[0], -s[0]), default=None)


@F.pandas_udf(S.StructType([S.StructField("start", S.IntegerType()), S.StructField("end", S.IntegerType())]))
def span(text: pd.Series, head: pd.Series, forms: pd.Series) -> pd.DataFrame:
    """(start, end) of find_span(), nulls if there is none."""
    made = [find_span(t, h, [] if f is None else list(f)) or (None, None) for t, h, f in zip(text, head, forms)]
    return pd.DataFrame(made, columns=["start", "end"]).astype("Int32")


def headword_present(words: str, head: str) -> Column:
    """Whole words of a normalised text."""
    return F.expr(f"contains(concat(' ', {words}, ' '), concat(' ', {head}, ' '))")


def garbage(text: str) -> Column:
    """Fewer than three words, or no ASCII letter."""
    return (T.word_count(text) < 3) | ~F.coalesce(F.col(text), F.lit("")).rlike("[A-Za-z]")


def fragment(text: str) -> Column:
    """Opens in lower case, or doesn't end as a sentence; an empty text is none."""
    body = f"btrim(coalesce({text}, ''), ' \\t\\n\\r')"
    start = f"coalesce(nullif(ltrim({quoted(OPENING_QUOTES)}, {body}), ''), {body})"
    return F.expr(f"case when {body} = '' then false else left({start}, 1) rlike '\\\\p{{Ll}}' or not contains({quoted(TERMINALS)}, right({body}, 1)) end")


def stilted(text: str) -> Column:
    """B24."""
    return F.coalesce(F.col(text), F.lit("")).rlike(STILTED)


def meta_label(term: str) -> Column:
    """A label about words, or a qualifier before one of META_HEADS."""
    words = "split(k, ' ')"
    rule = f"{_in('k', META_LABELS)} or (size({words}) >= 2 and {_in(f'element_at({words}, -1)', META_HEADS)} and {_in(f'element_at({words}, -2)', META_QUALIFIERS)})"
    return F.expr(f"transform(array({_key_sql(term)}), k -> {rule})[0]")


def _key_sql(term: str) -> str:
    return f"lower(trim(regexp_replace(btrim(btrim({term}, ' \\t\\n\\r\\f'), {quoted(STRIPPABLE)}), '[ \\\\t\\\\n\\\\r\\\\f]+', ' ')))"


def artifact_target(term: str) -> Column:
    """A leftover slot label, or a description of more than ARTIFACT_WORDS words."""
    key = f"trim(lower({term}))"
    return F.expr(f"{_in(key, ARTIFACTS)} or size(split({key}, '\\\\s+')) > {ARTIFACT_WORDS}")


def meta_reference(answer: str) -> Column:
    """The first phrase, in the order of the patterns, that names the prompt's own scaffolding; null if none does."""
    return F.coalesce(*(F.nullif(F.regexp_extract(answer, p, 0), F.lit("")) for p in META_REFERENCES))


def repaired_reference(answer: str) -> Column:
    """Without a leading clause of that kind, capitalised; unchanged if nothing would be left."""
    rest = F.regexp_replace(answer, LEADING_META, "")
    return F.when((rest == F.col(answer)) | (F.trim(rest) == ""), F.col(answer)).otherwise(F.concat(F.upper(F.left(rest, F.lit(1))), F.substr(rest, F.lit(2))))


def gloss_echo(answer: str, gloss: str, n: int = 60) -> Column:
    """The same first n characters, folded; never of an empty gloss."""
    return (F.coalesce(F.col(gloss), F.lit("")) != "") & (F.left(T.folded(answer), F.lit(n)) == F.left(T.folded(gloss), F.lit(n)))


def quotes(paragraph: str, gloss: str, least: int = 6) -> Column:
    """The paragraph holds the normalised gloss, if that has `least` words."""
    return F.coalesce((T.word_count(gloss) >= least) & (paragraph_key(gloss) != "") & F.contains(paragraph_key(paragraph), paragraph_key(gloss)), F.lit(False))


def scan_tokens(text: str) -> Column:
    """(token, initial) of every ASCII word; initial: only blanks, quotes and brackets part it from a sentence end or the text's start."""
    pattern = quoted(f"([{ENDINGS}][{SKIPPED}]*)?([A-Za-z][A-Za-z'’]*)")
    t = f"concat('.', coalesce({text}, ''))"
    return F.expr(f"arrays_zip(regexp_extract_all({t}, {pattern}, 2), transform(regexp_extract_all({t}, {pattern}, 1), g -> g != ''))")


def hard_words(docs: DataFrame, key: str, text: str, familiar: DataFrame, ignore: str | None = None) -> DataFrame:
    """Key, considered, hard (distinct, in order of first use), share. familiar: word.

    Lone letters that aren't listed, forms of `ignore` and capitals within a sentence are passed
    over. A token is familiar if a lemma candidate of it is listed; that is looked up once a distinct token.
    """
    keep = [F.expr(f"array_distinct(flatten(transform(regexp_extract_all(coalesce({ignore}, ''), \"[A-Za-z][A-Za-z'’]*\", 0), t -> array(lower(t)))))").alias("excused")] if ignore else [F.expr("cast(array() as array<string>)").alias("excused")]
    rows = docs.select(F.col(key).alias("doc_key"), *keep, F.posexplode(scan_tokens(text)).alias("pos", "x")).select("doc_key", "excused", "pos", F.col("x.0").alias("token"), F.col("x.1").alias("initial"))
    rows = rows.where("initial or not token rlike '^[A-Z]'").withColumn("token", F.lower("token"))
    cand = rows.select("token").distinct().select("token", T.lemma_candidates("token").alias("candidates"))
    listed = cand.select("token", F.explode("candidates").alias("word")).join(familiar.select("word").distinct(), "word", "left_semi").select("token").distinct().withColumn("easy", F.lit(True))
    own = familiar.select(F.col("word").alias("token")).distinct().withColumn("own", F.lit(True))
    met = rows.join(cand, "token").join(listed, "token", "left").join(own, "token", "left").withColumn("easy", F.coalesce("easy", "own"))
    met = met.where("(length(token) >= 2 and size(candidates) > 0 or own) and not arrays_overlap(array_append(candidates, token), excused)")
    per = met.groupBy("doc_key").agg(F.count("*").alias("considered"), F.count_if("easy").alias("n_easy"), F.array_sort(F.collect_list(F.when(F.col("easy").isNull(), F.struct("pos", "token")))).alias("h"))
    out = docs.select(F.col(key)).join(per, F.col(key) == F.col("doc_key"), "left")
    return out.select(key, F.coalesce("considered", F.lit(0).cast("long")).alias("considered"), F.expr("coalesce(array_distinct(transform(h, x -> x.token)), cast(array() as array<string>))").alias("hard"), F.expr("coalesce((considered - n_easy) / considered, 0D)").alias("share"))


def exceeds_band(level: Column, share: Column, tolerance: float = 0.0) -> Column:
    """Over the level's share of unfamiliar words; false for levels without a bar."""
    bar = F.lit(None).cast("double")
    for name, most in VOCABULARY_BANDS:
        bar = F.when(level == name, most).otherwise(bar)
    return F.coalesce(share > bar + tolerance, F.lit(False))


def disambiguated(name: str) -> list[Column]:
    """(headword, disambiguator) of 'Name (qualifier)' or 'Name, qualifier'."""
    in_brackets, after_comma = r"^(.*\S)\s*\(([^()]+)\)\s*$", r"^([^,]+),\s*(.+)$"
    bracket = F.col(name).rlike(in_brackets)
    comma = F.col(name).rlike(after_comma)
    pick = lambda i: F.when(bracket, F.regexp_extract(name, in_brackets, i)).when(comma, F.regexp_extract(name, after_comma, i))
    return [F.coalesce(F.trim(pick(1)), F.trim(name)).alias("headword"), F.coalesce(F.trim(pick(2)), F.lit("")).alias("disambiguator")]


def call_cost(fresh: Column, cached: Column, output: Column, rates: tuple[str, str, str]) -> Column:
    """Dollars of a call from its token counts and the rates a million tokens of the joined price row."""
    a, b, c = (F.col(r) for r in rates)
    return (fresh * a + cached * b + output * c) / 1_000_000


def token_bound(prompt: Column, instructions: Column, output: Column) -> Column:
    """No call has more tokens."""
    return (F.floor((F.length(prompt) + F.length(instructions)) / CHARS_PER_TOKEN) + output).cast("long")


def date_notes(birth: str, death: str, inception: str, living_after: int, recent_from: int) -> Column:
    """B42: 'living' without a year of death and born late enough, 'recent' if begun late enough; years are the first four digits."""
    year = lambda c: F.regexp_extract(c, r"^\+?(\d{4})", 1).cast("int")
    living = F.when(F.col(death).isNull() & (year(birth) > living_after), F.lit("living"))
    recent = F.when(year(inception) >= recent_from, F.lit("recent"))
    return F.array_compact(F.array(living, recent))


def demotion_note(note: str, prefixes: tuple[str, ...] = (DEMOTION,)) -> Column:
    """The note says that some pass demoted the relation."""
    out = F.lit(False)
    for p in prefixes:
        out = out | F.coalesce(F.startswith(F.col(note), F.lit(p)), F.lit(False))
    return out


def candidate_reason(term: str) -> Column:
    """Why a normalised candidate is refused by its shape; null if it isn't."""
    t = F.col(term)
    return (
        F.when(t == "", "empty").when(F.length(t) < 2, "too_short").when(F.length(t) > 40, "too_long").when(~t.rlike("[a-z]"), "no_letters").when(t.rlike(ETYMON), "etymon")
        .when(t.isin(*CANDIDATE_LABELS), "meta_label").when(t.rlike(SENTENCE_SHAPED), "sentence_shaped").when(F.size(F.split(t, " ")) > 4, "too_many_words")
    )


def contrast_reason(text: str, source: str, target: str, source_gloss: str, target_gloss: str, floor: int = 45, ceiling: int = 160) -> Column:
    """E5: why a drafted contrast is refused: length first, then what it must and mustn't hold; null if it isn't."""
    n = T.word_count(text)
    return (
        F.when(F.coalesce(F.col(text), F.lit("")) == "", "empty").when(n < floor, "too_short").when(n > ceiling, "too_long").when(~headword_present(f"lower({text})", f"lower({source})"), "source_absent")
        .when(~headword_present(f"lower({text})", f"lower({target})"), "target_absent").when(quotes(text, source_gloss) | quotes(text, target_gloss), "gloss_copy")
    )


def example_reason(text: str, cap: Column, least: int = 4) -> Column:
    """Why a drafted example is refused by its shape; null if it isn't."""
    t, n = F.col(text), T.word_count(text)
    return F.when(F.coalesce(t, F.lit("")) == "", "empty").when(~t.rlike(r"^\p{Lu}") | ~t.rlike(r"[.?!]$"), "not_a_sentence").when(n < least, "too_short").when(n > cap, "too_long")
