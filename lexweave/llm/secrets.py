"""Secret scans in Spark SQL functions alone: patterns, and sliding-window entropy.

Regular expressions give the base spans. Besides, every run of a character class (hex, base64) that
mixes letters and digits is a candidate: a window of fixed width slides over it, the counts of the
class's characters follow by one step in and one out, and the sum of c log2 c with them, so each
position costs the same. A run is a span if its highest window entropy reaches the class's
threshold, no allow-listed pattern is in it and no base span covers it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hidden

#: Fixed by the contract: kind, pattern, least length of what counts (group 1 of assign, else the match).
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # of 18 or more characters; a shorter run has no longer match inside
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")
#: Character classes of the windows: kind, candidate, alphabet, width, least entropy in bits.
CLASSES = (
    ("entropy_hex", r"[0-9a-fA-F]{20,}", "0123456789abcdefABCDEF", 20, 3.15),
    ("entropy_base64", r"[A-Za-z0-9+/_-]{24,}", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", 24, 3.95),
)
ALLOW = r"(?i)example|sample|placeholder|changeme|dummy|xxxx|abcdefgh|01234567|12345678|(.)\1{7}"


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _located(found: str, parts: str, kind: int, keep: str = "true") -> str:
    """SQL: spans (start, kind, end, string) of matches, from the text's parts between them; positions are code points, ends exclusive."""
    step = f"named_struct('at', s.at + length({parts}[i]) + length({found}[i]), 'out', array_append(s.out, named_struct('start', s.at + length({parts}[i]), 'kind', {kind}, 'end', s.at + length({parts}[i]) + length({found}[i]), 'match', {found}[i])))"
    none = "cast(array() as array<struct<start:int,kind:int,end:int,match:string>>)"
    walk = f"aggregate(sequence(0, size({found}) - 1), named_struct('at', 0, 'out', {none}), (s, i) -> {step}, s -> filter(s.out, m -> {keep}))"
    return f"case when size({found}) > 0 then {walk} else {none} end"


def _entropy(string: str, alphabet: str, width: int) -> str:
    """SQL: the highest Shannon entropy of a window of `width` characters over a string of the alphabet; 0 for shorter ones."""
    f = lambda c: f"(case when {c} > 1 then {c} * log2({c}) else 0D end)"
    came, went = f"instr({_quoted(alphabet)}, c[i])", f"case when i >= {width} then instr({_quoted(alphabet)}, c[i - {width}]) else 0 end"
    # i counts from 0; n are the counts, t the sum of c log2 c, h the highest entropy so far
    moved = f"named_struct('n', transform(s.n, (x, k) -> x + case when k + 1 = s.came then 1 else 0 end - case when k + 1 = s.went then 1 else 0 end), 't', s.t + case when s.came = s.went then 0D else {f('(s.n[s.came - 1] + 1)')} - {f('s.n[s.came - 1]')} + case when s.went > 0 then {f('(s.n[s.went - 1] - 1)')} - {f('s.n[s.went - 1]')} else 0D end end, 'h', s.h)"
    named = f"named_struct('n', r.n, 't', r.t, 'h', r.h, 'came', {came}, 'went', {went})"
    one = f"transform(array({named}), s -> {moved})[0]"
    scored = f"transform(array({one}), u -> named_struct('n', u.n, 't', u.t, 'h', case when i >= {width - 1} then greatest(u.h, {_log2(width)}D - u.t / {width}) else u.h end))[0]"
    start = f"named_struct('n', array_repeat(0, {len(alphabet)}), 't', 0D, 'h', 0D)"
    return f"transform(array(split({string}, '')), c -> aggregate(sequence(0, length({string}) - 1), {start}, (r, i) -> {scored}, r -> r.h))[0]"


def _log2(n: int) -> float:
    import math

    return math.log2(n)


def find_spans(documents: DataFrame, allow: str = ALLOW) -> DataFrame:
    """documents with `found`: array of (start, kind, end, match), sorted by start, then kind (a place in KINDS).

    A null or empty text has no span. A column of that name is replaced; all rows and other columns
    stay as they are, so repeated rows, null ids and an empty table pass through.
    """
    text = "coalesce(cast(text as string), '')"
    patterns = [("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), *((k, p) for k, p, *_ in CLASSES)]
    inner = [f"{part}_{k}" for part in "mps" for k, _ in patterns]
    docs, back = hidden(documents.drop("found"), "base", *inner)
    kept = [c for c in docs.columns if c != "text"]
    own = docs.select(*kept, "text", *(F.expr(f"regexp_extract_all({text}, {_quoted(p)}, 0)").alias(f"m_{k}") for k, p in patterns))
    cut = own.select("*", *(F.expr(f"case when size(m_{k}) > 0 then split({text}, {_quoted(p)}, -1) end").alias(f"p_{k}") for k, p in patterns))
    spans = []
    for at, (k, _) in enumerate(patterns):
        keep = "true"
        if k == "assign":
            keep = f"length(regexp_extract(m.match, {_quoted(ASSIGN)}, 1)) >= 12"
        for kind, _, alphabet, width, least in CLASSES:
            if k == kind:
                keep = f"m.match rlike '[0-9]' and m.match rlike '[A-Za-z]' and not m.match rlike {_quoted(allow)} and {_entropy('m.match', alphabet, width)} >= {least}D"
        spans.append(F.expr(_located(f"m_{k}", f"p_{k}", at, keep)).alias(f"s_{k}"))
    each = cut.select(*kept, "text", *spans)
    base = each.select("*", F.concat(*(F.col(f"s_{k}") for k in KINDS[:3])).alias("base"))
    free = [F.expr(f"filter(s_{k}, x -> not exists(base, b -> b.start <= x.start and x.end <= b.end))") for k, *_ in CLASSES]
    return base.select(*back, F.array_sort(F.concat("base", *free)).alias("found"))


def _joined(spans: str) -> Column:
    kinds = "array(" + ", ".join(map(_quoted, KINDS)) + ")"
    return F.expr(f"array_join(transform({spans}, x -> concat_ws(':', {kinds}[x.kind], x.start, x.end)), ',')")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of find_spans()."""
    count = lambda k: F.expr(f"cast(size(filter(found, x -> x.kind = {k})) as long)").alias(f"n_{KINDS[k]}")
    return found.select("doc_id", count(0), count(1), count(2), F.sha2(_joined("filter(found, x -> x.kind < 3)"), 256).alias("base_sha256"), _joined("found").alias("spans"))


def redact(documents: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """documents with every span (overlapping ones as one) replaced by `mark`; n_chars, if there, follows the text."""
    text = "coalesce(cast(text as string), '')"
    take = f"named_struct('at', greatest(s.at, x.end), 'out', concat(s.out, case when x.start >= s.at then concat(substring({text}, s.at + 1, x.start - s.at), {_quoted(mark)}) else '' end))"
    clean = F.expr(f"case when size(found) = 0 then text else aggregate(found, named_struct('at', 0, 'out', ''), (s, x) -> {take}, s -> concat(s.out, substring({text}, s.at + 1))) end")
    docs, back = hidden(documents, "found")
    out = find_spans(docs)
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(F.size("found") > 0, F.length(clean).cast("long")).otherwise(F.col("n_chars")))
    return out.withColumn("text", clean).select(*back)
