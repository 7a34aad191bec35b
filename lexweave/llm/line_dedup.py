"""Line dedup across a corpus by a segment-partition edit join, in Spark SQL functions alone.

Every line of MIN_CHARS characters or more is split into EDITS + 1 segments; a line within EDITS
edits of another has one of the other's segments unchanged, at a place that its length bounds. So
each line shows keys (length, segment, substring): its own segments, and for each shorter length
the substrings that could be segments there. Keys are counted first (partial sums, so a line that
fills a third of the corpus stays small); only keys of two different lines or more keep members.
Members are tested against one leader a round, and what that links is contracted; after ROUNDS
rounds all pairs across components are tested. Pairs whose parities of characters, pairs and triples
of characters differ in more bits than EDITS edits can turn are not made; keys of more than LIST
lines are parted first: what a line has besides the shared piece is within EDITS edits of the other
line's rest, so the rests show keys by the same partition, and lines meet on both. A test is a pigeonhole check on parts, then the edit
distance by a bit-parallel automaton over the 2 EDITS + 1 diagonals of the band.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, components, drop_table, hidden, with_ids, write_table

EDITS = 2
MIN_CHARS = 20
PARTS = 8
ROUNDS = 2
LIST = 512


def _places() -> str:
    """SQL: an array of (less, seg, shift): which segment of lines how many characters shorter a key shows, and how far from its place there. With less 0 and shift 0 it is the line's own."""
    out = []
    for less in range(EDITS + 1):
        for seg in range(EDITS + 1):
            rest = EDITS - seg
            out += [f"named_struct('less', {less}, 'seg', {seg}, 'shift', {k})" for k in range(max(-seg, less - rest), min(seg, less + rest) + 1)]
    return f"array({', '.join(out)})"


def _shown(lines: DataFrame, line: str, n: str, seed: int, with_rest: bool = False) -> DataFrame:
    """lines with `key`, a row for each key of a line of n characters: its own segments and the substrings to probe for shorter lines; with_rest: also `rest`, what the line has besides. The rows are made one after the other, so their code stays short."""
    kept = lines.columns
    at = lines.withColumn("at", F.explode(F.expr(_places()))).select(*kept, "at.seg", "at.shift", F.expr(f"{n} - at.less").alias("whole"))
    cut = at.select("*", F.expr(f"cast(whole div {EDITS + 1} as int)").alias("base"), F.expr(f"seg + whole % {EDITS + 1}").alias("more"))
    cut = cut.select(*kept, "seg", "whole", F.expr(f"base + cast(more div {EDITS + 1} as int)").alias("size"), F.expr(f"seg * base + greatest(0, more - {EDITS + 1}) + shift").alias("begin"))
    out = [*kept, F.expr(f"xxhash64({seed}, whole, seg, substring({line}, begin + 1, size))").alias("key")]
    if with_rest:
        out.append(F.expr(f"concat(substring({line}, 1, begin), substring({line}, begin + size + 1))").alias("rest"))
    return cut.select(*out)


def _alike(a: str, b: str) -> str:
    """SQL: at most EDITS of PARTS parts of a are missing in b near their place; a distance of EDITS or less implies it."""
    found = []
    for p in range(PARTS):
        begin, end = f"cast({p} * length({a}) div {PARTS} as int)", f"cast({p + 1} * length({a}) div {PARTS} as int)"
        part = f"substring({a}, {begin} + 1, {end} - {begin})"
        shifts = " or ".join(f"({begin} + {s} >= 0 and {part} = substring({b}, {begin} + {s} + 1, {end} - {begin}))" for s in range(-EDITS, EDITS + 1))
        found.append(f"case when {shifts} then 1 else 0 end")
    return f"({' + '.join(found)}) >= {PARTS - EDITS}"


def within(a: str, b: str) -> str:
    """SQL: the edit distance of two strings if it is EDITS or less, else null.

    r0, r1, ... hold in bit d + EDITS whether, after the characters of b read so far, diagonal d
    (characters of a read, less those of b) can be reached with 0, 1, ... edits. A match keeps its
    diagonal; a replaced character keeps it at one edit more, an extra one in b lowers it, a missing
    one raises it.
    """
    width, mask = 2 * EDITS + 1, (1 << (2 * EDITS + 1)) - 1
    hits = " | ".join(f"case when get(v.a, j + {d - EDITS}) <=> v.b[j] then {1 << d} else 0 end" for d in range(width))
    new, names = [], [f"r{k}" for k in range(EDITS + 1)]
    for k in range(EDITS + 1):
        step = f"(s.r{k} & m)"
        if k:
            step = f"(({step} | s.r{k - 1} | shiftright(s.r{k - 1}, 1) | shiftleft({new[k - 1]}, 1)) & {mask})"
        new.append(step)
    moved = "named_struct(" + ", ".join(f"'{n}', {e}" for n, e in zip(names, new)) + ")"
    start = "named_struct(" + ", ".join(f"'r{k}', {sum(1 << (EDITS + d) for d in range(k + 1))}" for k in range(EDITS + 1)) + ")"
    end = f"shiftleft(1, {EDITS} + size(v.a) - size(v.b))"
    least = "case " + " ".join(f"when (s.r{k} & {end}) != 0 then {k}" for k in range(EDITS + 1)) + " end"
    walk = f"aggregate(sequence(0, size(v.b) - 1), {start}, (s, j) -> transform(array({hits}), m -> {moved})[0], s -> {least})"
    return f"case when abs(length({a}) - length({b})) <= {EDITS} then case when {a} = {b} then 0 when {b} = '' then length({a}) else transform(array(named_struct('a', split({a}, ''), 'b', split({b}, ''))), v -> {walk})[0] end end"


def _rows(documents: DataFrame) -> DataFrame:
    """doc_id, text, and row: a hash of the text, which tells rows of one doc_id apart."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("row", F.xxhash64("text"))


def _lines(documents: DataFrame) -> DataFrame:
    docs = _rows(documents).where("doc_id is not null and text is not null")
    lines = docs.select("doc_id", "row", F.posexplode(F.expr("transform(split(text, '\n'), l -> named_struct('line', l, 'n', length(l)))")).alias("line_no", "x"))
    return lines.select("doc_id", "row", "line_no", "x.line", "x.n").where(f"n >= {MIN_CHARS}")


#: Parities of a line's characters c: name, SQL of a step's bit, characters that a step takes, bits that one edit turns at most.
MARKS = (("marks", "ascii(c[i])", 1, 2), ("pairs", "xxhash64(c[i], c[i + 1])", 2, 4), ("triples", "xxhash64(c[i], c[i + 1], c[i + 2])", 3, 6))


def _marks(line: str) -> list[Column]:
    step = lambda bit, n: f"aggregate(sequence(0, size(c) - {n}), 0L, (m, i) -> m ^ shiftleft(1L, cast({bit} & 63 as int)))"
    made = ", ".join(f"'{name}', {step(bit, n)}" for name, bit, n, _ in MARKS)
    all_ = F.expr(f"transform(array(split({line}, '')), c -> named_struct({made}))[0]")
    return [all_.getField(name).alias(name) for name, *_ in MARKS]


_NEAR = " and ".join([*(f"bit_count(x.{name} ^ y.{name}) <= {bits * EDITS}" for name, _, _, bits in MARKS), f"abs(x.n - y.n) <= {EDITS}"])


def _line_id(line: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(line))


def _few(members: DataFrame, keys: DataFrame) -> DataFrame:
    """members whose key is among keys."""
    return members.join(F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys, "key", "left_semi")


def _texts(ids: DataFrame, firsts: DataFrame, documents: DataFrame, seed: int) -> DataFrame:
    """id, line and MARKS of the lines named by ids."""
    where = write_table(firsts.join(ids, "id").select("id", "first.doc_id", "first.line_no"), "lines-where")
    wanted = write_table(where.groupBy("doc_id").agg(F.collect_list("line_no").alias("want")), "lines-want")
    lines = with_ids(_rows(documents).select("doc_id", "text"), wanted, "doc_id", BROADCAST_IDS).select(F.explode(F.expr("transform(array(split(text, '\n')), ls -> transform(want, i -> get(ls, i)))[0]")).alias("line")).where("line is not null")
    found = lines.select(_line_id("line", seed).alias("id"), "line").join(where.select("id"), "id", "left_semi").dropDuplicates(["id"])
    out = write_table(found.select("id", "line", F.length("line").alias("n"), *_marks("line")), "lines-texts")
    drop_table(where)
    drop_table(wanted)
    return out


def _pairs(told: DataFrame, texts: DataFrame, seed: int) -> DataFrame:
    """a, b: lines of one key and different labels that may be near; keys of more than LIST lines are parted by keys of the rests."""
    size = F.count("*").over(Window.partitionBy("key"))
    told = write_table(told.withColumn("size", size), "lines-told")
    columns = ["id", "label", "n", *(m for m, *_ in MARKS)]
    few, many = told.where(f"size <= {LIST}").select("key", *columns), told.where(f"size > {LIST}").select("key", *columns)
    lines = _shown(texts.join(many.select("id").distinct(), "id", "left_semi").select("id", "line", F.col("n").alias("chars")), "line", "chars", seed, with_rest=True)
    rests = many.join(lines.select("id", "key", "rest"), ["id", "key"]).select(F.col("key").alias("whole_key"), *columns, "rest", F.length("rest").alias("chars"))
    parted = _shown(rests, "rest", "chars", seed).select(F.xxhash64("whole_key", "key").alias("key"), *columns).distinct()
    both = few.union(parted)
    x, y = both.alias("x"), both.alias("y")
    met = x.join(y, F.expr(f"x.key = y.key and x.id < y.id and x.label != y.label and {_NEAR}"))
    return met.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of pairs (a, b) of line ids, those within EDITS edits."""
    side = lambda x: texts.select(F.col("id").alias(x), F.col("line").alias(f"l{x}"))
    met = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").where(f"abs(length(la) - length(lb)) <= {EDITS}").where(_alike("la", "lb"))
    return write_table(met.where(f"{within('la', 'lb')} is not null").select("a", "b"), "lines-links")


def line_classes(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(occurrences, classes): (doc_id, row, line_no, id) of every line of MIN_CHARS characters or more, and (id, n, rep_id, rep_doc, rep_line, rep_row) of lines that occur twice or are near another.

    A class holds all lines that links of EDITS edits or fewer connect; rep is its first occurrence
    by doc_id, then line number from 0, then row, a hash of the document's text. Shorter lines, null
    texts and rows with a null doc_id have no part; rows alike in doc_id and text count as one
    document, rows of one doc_id with different texts as several. Empty tables give empty ones.
    """
    seed = 0
    while True:  # a line's id is a 64-bit hash; should two lines share it, which a second hash tells, another seed is taken
        other = F.xxhash64(F.lit(seed + 1000), F.col("line"))
        occ = write_table(_lines(documents).select("doc_id", "row", "line_no", _line_id("line", seed).alias("id"), other.alias("other")), "lines-occ")
        clash = occ.groupBy("id").agg(F.min("other").alias("lo"), F.max("other").alias("hi")).where("lo < hi")
        if clash.isEmpty():
            break
        drop_table(occ)
        seed += 1
    firsts = write_table(occ.groupBy("id").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "line_no", "row")).alias("first")), "lines-firsts")
    index = _shown(_lines(documents).select(_line_id("line", seed).alias("id"), "line", "n"), "line", "n", seed).select("id", "key")
    keys = write_table(index.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("key"), "lines-keys")
    shown = write_table(_few(index, keys).distinct(), "lines-shown")
    texts = _texts(shown.select("id").distinct(), firsts, documents, seed)
    names = [m for m, *_ in MARKS]
    members = write_table(shown.join(texts.select("id", "n", *names), "id"), "lines-members")
    drop_table(shown)
    same, roots, used = Window.partitionBy("key"), None, []
    for last in [False] * ROUNDS + [True]:
        told = members.withColumn("label", F.col("id"))
        if roots is not None:
            told = members.join(roots.select(F.col("node").alias("id"), F.col("root").alias("label")), "id", "left").withColumn("label", F.coalesce("label", "id"))
        told = told.withColumn("lead", F.min(F.struct("label", "id", "n", *names)).over(same)).withColumn("hi", F.max("label").over(same)).where("lead.label < hi")
        if last:
            pairs = _pairs(told.drop("lead", "hi"), texts, seed)
        else:
            met = told.where("label != lead.label").where(_NEAR.replace("x.", "").replace("y.", "lead.")).groupBy("id", F.col("lead.id").alias("lead")).count()
            pairs = met.groupBy("id").agg(F.max(F.struct("count", "lead")).alias("m")).select(F.col("m.lead").alias("a"), F.col("id").alias("b"))
        used.append(_linked(pairs, texts))
        links = used[0]
        for more in used[1:]:
            links = links.union(more)
        roots = components(links, "lines-cc")
    for t in (keys, members, texts, *used):
        drop_table(t)
    labels = roots.select(F.col("node").alias("id"), "root")
    lines = firsts.join(labels, "id", "left").where("n > 1 or root is not null").withColumn("root", F.coalesce("root", "id"))
    reps = lines.groupBy("root").agg(F.min(F.struct("first.doc_id", "first.line_no", "first.row", "id")).alias("rep"))
    classes = write_table(lines.join(reps, "root").select("id", "n", F.col("rep.id").alias("rep_id"), F.col("rep.doc_id").alias("rep_doc"), F.col("rep.line_no").alias("rep_line"), F.col("rep.row").alias("rep_row")), "lines-classes")
    drop_table(firsts)
    return occ, classes


def removed_lines(documents: DataFrame) -> DataFrame:
    """doc_id, row, line_no, id, rep_doc, rep_line, near: every occurrence but the first of each class of lines; rows alike once."""
    occ, classes = line_classes(documents)
    small = F.broadcast(classes) if classes.count() <= BROADCAST_IDS else classes
    gone = occ.join(small, "id").where("not (doc_id = rep_doc and line_no = rep_line and row = rep_row)")
    return gone.select("doc_id", "row", "line_no", "id", "rep_doc", "rep_line", (F.col("id") != F.col("rep_id")).alias("near"))


def line_report(documents: DataFrame) -> DataFrame:
    """A row per document row: doc_id, n_lines, n_exact and n_near (lines removed as copies and as near copies), removed: 'line_no>rep_doc:rep_line' of each, joined by commas."""
    one = F.concat(F.col("line_no").cast("string"), F.lit(">"), F.col("rep_doc").cast("string"), F.lit(":"), F.col("rep_line").cast("string"))
    per = removed_lines(documents).groupBy(F.col("doc_id").alias("gone_doc"), F.col("row").alias("gone_row")).agg(F.collect_set(F.struct("line_no", one.alias("one"), "near")).alias("all"))
    size = lambda p: f"cast(size(filter(all, x -> {p})) as long)"
    per = per.select("gone_doc", "gone_row", F.expr(size("not x.near")).alias("n_exact"), F.expr(size("x.near")).alias("n_near"), F.expr("array_join(transform(array_sort(all), x -> x.one), ',')").alias("removed"))
    docs = _rows(documents).select("doc_id", "row", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines"))
    met = docs.join(per, (F.col("doc_id") == F.col("gone_doc")) & (F.col("row") == F.col("gone_row")), "left")
    return met.select("doc_id", "n_lines", F.coalesce("n_exact", F.lit(0).cast("long")).alias("n_exact"), F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.coalesce("removed", F.lit("")).alias("removed"))


def dedup_lines(documents: DataFrame) -> DataFrame:
    """documents without the removed lines; n_chars, if there, follows the text.

    Every row stays, with an empty text if no line is left; what has no removed line is unchanged.
    """
    gone = removed_lines(documents).groupBy(F.col("doc_id").alias("gone_doc"), F.col("row").alias("gone_row")).agg(F.collect_set("line_no").alias("gone_lines"))
    docs, back = hidden(documents, "gone_doc", "gone_row", "gone_lines")
    out = docs.join(gone, (F.col("doc_id").cast("long") == F.col("gone_doc")) & (F.xxhash64(F.col("text").cast("string")) == F.col("gone_row")), "left")
    text = F.when(F.col("gone_lines").isNull(), F.col("text")).otherwise(F.expr("array_join(transform(array(split(text, '\n')), ls -> transform(array_except(sequence(0, size(ls) - 1), gone_lines), i -> ls[i]))[0], '\n')"))
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(F.col("gone_lines").isNull(), F.col("n_chars")).otherwise(F.length(text).cast("long")))
    return out.withColumn("text", text).select(*back)
