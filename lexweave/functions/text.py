"""Text metrics and normalisers as Spark SQL expressions (whole-stage friendly, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[_'’]*[\p{L}\p{N}][\p{L}\p{N}_'’]*"
SENTENCE_END = r"[.!?…]+"
VOWELS = "aeiouy"

# Closed-class words that carry no content, as the measure defines them.
STOPWORDS = (
    "a an the and but or nor so yet for not if because although though while as than that i me my mine myself you your "
    "yours yourself he him his himself she her hers herself it its itself we us our ours ourselves they them their theirs "
    "themselves who whom whose which what this these those am is are was were be been being do does did done have has had "
    "having can could shall should will would may might must at by from in into of on to up with within about above after "
    "before between over under out there here some any all no such"
).split()
# Endings whose e is sounded.
SOUNDED_E = ("le", "ee", "ye", "oe", "ie")
SOUNDED_ES = ("ses", "xes", "zes", "ches", "shes", "ges", "ces", "les")
SOUNDED_ED = ("ted", "ded")
# Reading levels and their grade bands.
GRADE_BANDS = (("grade_1", 0.0, 3.0), ("grade_5", 3.0, 7.0), ("neutral", 7.0, 12.0), ("college", 12.0, 16.0), ("expert", 16.0, 99.0))


def quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _list(words) -> str:
    return "array(" + ", ".join(map(quoted, words)) + ")"


def words_sql(text: str) -> str:
    """B1: runs of word characters and apostrophes that hold a letter or digit."""
    return f"regexp_extract_all(coalesce({text}, ''), {quoted(WORD)}, 0)"


def word_count(text: str) -> Column:
    return F.expr(f"size({words_sql(text)})").cast("long")


def sentences_sql(text: str) -> str:
    """Trimmed, non-empty pieces between sentence ends."""
    return f"filter(transform(split(coalesce({text}, ''), {quoted(SENTENCE_END)}), s -> trim(s)), s -> s != '')"


def sentence_count(text: str) -> Column:
    """B2: pieces that hold a word; one at least if the text has any, else none."""
    return F.expr(f"size(filter(split(coalesce({text}, ''), {quoted(SENTENCE_END)}), s -> s rlike '[\\\\p{{L}}\\\\p{{N}}]'))").cast("long")


def syllables_sql(word: str) -> str:
    """Vowel runs less a silent final e, one at least; digits count one each in a word without letters. Letters and runs are computed once a word."""
    ends = lambda n, xs: f"right(l, {n}) in ({', '.join(map(quoted, xs))})"
    three, two = [x for x in SOUNDED_ES if len(x) == 3], [x for x in SOUNDED_ES if len(x) == 4]
    silent = f"case when right(l, 2) = 'es' then not ({ends(3, three)} or {ends(4, two)}) when right(l, 2) = 'ed' then not {ends(3, SOUNDED_ED)} else right(l, 1) = 'e' and not {ends(2, SOUNDED_E)} end"
    heard = f"transform(array(regexp_count(l, '[{VOWELS}]+')), r -> greatest(1, r - case when r > 1 and {silent} then 1 else 0 end))[0]"
    return f"transform(array(regexp_replace(lower({word}), '[^\\\\p{{L}}]', '')), l -> case when l = '' then length(regexp_replace({word}, '[^\\\\p{{Nd}}]', '')) else {heard} end)[0]"


def syllables_of(words: str) -> Column:
    """The syllables of an array of words."""
    return F.expr(f"aggregate({words}, 0L, (n, w) -> n + {syllables_sql('w')})")


def syllable_count(text: str) -> Column:
    return syllables_of(words_sql(text))


def fk_grade(words: Column, sentences: Column, syllables: Column) -> Column:
    """The Flesch-Kincaid grade, 0 for a text without words."""
    heard = F.when(syllables == 0, words).otherwise(syllables)
    return F.when(words == 0, 0.0).otherwise(0.39 * (words / F.greatest(F.lit(1), sentences)) + 11.8 * (heard / words) - 15.59)


def grade_level(grade: Column) -> Column:
    """The level whose band holds a grade; below all bands the first."""
    out = F.lit(GRADE_BANDS[-1][0])
    for name, _, hi in reversed(GRADE_BANDS[:-1]):
        out = F.when(grade < hi, name).otherwise(out)
    return out


def strip_markdown(text: str) -> Column:
    """Fences, headings, quotes, bullets, strong, emphasis, backticks and trailing blanks go, in this order."""
    out = f"coalesce({text}, '')"
    for pattern, put in (
        (r"(?m)^[ \t]*```[^\n]*$", ""), (r"(?m)^[ \t]{0,3}#{1,6}[ \t]+", ""), (r"(?m)^[ \t]*>[ \t]?", ""), (r"(?m)^[ \t]*(?:[-*+]|\d+[.)])[ \t]+", ""),
        (r"(\*\*|__)([^*_\n]+)(\*\*|__)", "$2"), (r"\*([^*\n]+)\*", "$1"), (r"(^|[^\p{L}\p{N}_])_([^_\n]+)_($|[^\p{L}\p{N}_])", "$1$2$3"), ("`", ""), (r"(?m)[ \t]+$", ""),
    ):
        out = f"regexp_replace({out}, {quoted(pattern)}, {quoted(put)})"
    return F.expr(f"btrim({out}, ' \\t\\r\\n')")


def content_words_sql(text: str) -> str:
    """Distinct lower-case runs of ASCII letters that are no stopwords."""
    return f"array_except(array_distinct(regexp_extract_all(lower(coalesce({text}, '')), '[a-z]+', 0)), {_list(STOPWORDS)})"


def jaccard(a: str, b: str) -> Column:
    """|A and B| / |A or B| of two arrays of distinct values; 1 if both are empty (their diversity is 0)."""
    return F.expr(f"case when size({a}) = 0 and size({b}) = 0 then 1D else size(array_intersect({a}, {b})) / size(array_union({a}, {b})) end")


def slug(text: str) -> Column:
    """A1, for ASCII: lower case, other runs to one underscore, none at the ends; null if nothing is left."""
    return F.expr(f"nullif(btrim(regexp_replace(lower({text}), '[^a-z0-9]+', '_'), '_'), '')")


def folded(text: str) -> Column:
    """Case folded, white space collapsed; the exact-duplicate key."""
    return F.expr(f"trim(regexp_replace(replace(lower(coalesce({text}, '')), 'ß', 'ss'), '[ \\\\t\\\\n\\\\r\\\\f]+', ' '))")


def gloss_key(text: str) -> Column:
    """A10: white space collapsed, lower case, without one final period."""
    return F.expr(f"regexp_replace(lower(trim(regexp_replace({text}, '[ \\\\t\\\\n\\\\r]+', ' '))), '\\\\.$', '')")


def query_key(text: str) -> Column:
    """Folded, without closing punctuation."""
    return F.regexp_replace(folded(text), r"[.,;:!?…]+$", "")


def opener(text: str, n: int = 3) -> Column:
    """The first n words, lower case."""
    return F.expr(f"array_join(slice({words_sql('lower(' + text + ')')}, 1, {n}), ' ')")


def ngrams_sql(words: str, n: int) -> str:
    """Distinct runs of n words, joined by blanks."""
    return f"case when size({words}) >= {n} then array_distinct(transform(sequence(1, size({words}) - {n - 1}), i -> array_join(slice({words}, i, {n}), ' '))) else cast(array() as array<string>) end"


def ngram_hashes_sql(words: str, n: int) -> str:
    """64-bit hashes of the distinct runs of n words."""
    return f"case when size({words}) >= {n} then array_distinct(transform(sequence(1, size({words}) - {n - 1}), i -> xxhash64(slice({words}, i, {n})))) else cast(array() as array<bigint>) end"


def zipf(count: Column, total: Column) -> Column:
    """log10 of occurrences per billion, one added to the count."""
    return F.log10((count + 1) / total * 1e9)


def forms(word: str) -> Column:
    """Regular plural, past and -ing forms, distinct, in this order."""
    w = f"lower({word})"
    y = f"({w} rlike '[^{VOWELS}]y$' and length({w}) >= 2)"
    e = f"({w} like '%e' and not {w} like '%ee')"
    cvc = f"({w} rlike '^[^aeiou]*[aeiou][^aeiouwxy]$' and length({w}) >= 3)"
    last, cut = f"right({word}, 1)", f"left({word}, length({word}) - 1)"
    plural = f"case when {y} then concat({cut}, 'ies') when {w} rlike '(s|x|z|ch|sh)$' then concat({word}, 'es') else concat({word}, 's') end"
    past = f"case when {y} then concat({cut}, 'ied') when {e} then concat({word}, 'd') when {cvc} then concat({word}, {last}, 'ed') else concat({word}, 'ed') end"
    ing = f"case when {e} then concat({cut}, 'ing') when {cvc} then concat({word}, {last}, 'ing') else concat({word}, 'ing') end"
    return F.expr(f"array_distinct(array({plural}, {past}, {ing}))")


def lemma_candidates(word: str) -> Column:
    """The word, then base forms its endings suggest, distinct, of two letters or more."""
    w = f"btrim(lower({word}), \"'’\")"
    s = f"regexp_replace({w}, \"['’]s$\", '')"
    cut = lambda n, add="": f"concat(left({s}, length({s}) - {n}), '{add}')"
    undouble = lambda n: f"regexp_replace({cut(n)}, '^(.+)([^aeiou])\\\\2$', '$1$2')"
    rules = (
        (("ies$", cut(3, "y"), cut(1), cut(2)), ("(ses|xes|zes|ches|shes)$", cut(2), cut(1)), ("es$", cut(1), cut(2)), ("[^s]s$", cut(1))),
        (("ied$", cut(3, "y"), cut(1), cut(2)), ("ed$", cut(1), cut(2), undouble(2)), ("ing$", cut(3), cut(3, "e"), undouble(3))),
        (("iest$", cut(4, "y")), ("ier$", cut(3, "y")), ("est$", cut(3), cut(2), undouble(3)), ("er$", cut(2), cut(1), undouble(2))),
        (("ily$", cut(3, "y")), ("ly$", cut(2))),
    )
    parts = [f"array({w}, {s})"]
    for group in rules:
        parts.append("case " + " ".join(f"when {s} rlike '{p}' then array({', '.join(out)})" for p, *out in group) + " else cast(array() as array<string>) end")
    return F.expr(f"filter(array_distinct(concat({', '.join(parts)})), c -> length(c) >= 2)")
