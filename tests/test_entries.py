"""Operators without SQL, and small worlds of nested entries, repair, sources and stages."""

import hashlib
import json
import re

import pytest
from pyspark.sql import functions as F

from lexweave import catalog
from lexweave.functions import predicates as P
from lexweave.operators import entries as E
from lexweave.operators import graph, repair, reports, stages
from lexweave.plans.entry_queries import entries
from lexweave.plans.predicate_queries import familiar_words
from lexweave.plans.views import edges, senses
from lexweave.sources import store
from test_queries import SF

tables = pytest.mark.skipif(not SF.exists(), reason="no test tables")


@tables
def test_digests(spark):
    got = {r.lexeme_id: r.path for r in catalog.QUERIES["shard_ids"](spark, str(SF)).collect()}
    assert all(v == "/".join([(d := hashlib.blake2b(k.encode(), digest_size=8).hexdigest())[:2], d[2:4]]) for k, v in got.items()) and got
    members = {}
    for r in senses(spark, str(SF)).where("not retired").collect():
        members.setdefault((r.gloss, r.domain), set()).add(r.sense_id)
    for r in catalog.QUERIES["concept_ids"](spark, str(SF)).collect():
        assert r.concept_id == "og:c-" + hashlib.blake2b(",".join(sorted(members[r.gloss, r.domain])).encode(), digest_size=8).hexdigest()
    df = spark.createDataFrame([("a",), (None,), ("é",)], "t string").select("t", P.digest64("t").cast("string").alias("d"), P.slug_folded("t").alias("s")).collect()
    assert [(r.d, r.s) for r in df] == [(str(int.from_bytes(hashlib.blake2b(b"a", digest_size=8).digest(), "little")), "a"), (None, None), (str(int.from_bytes(hashlib.blake2b("é".encode(), digest_size=8).digest(), "little")), "e")]


def test_spans():
    assert P.find_span("An Ice-Axe, two ice  axes", "ice axe", ["ice axes"]) == (16, 25)
    assert P.find_span("abseiling", "abseil", []) is None and P.find_span("abseil's", "abseil", []) == (0, 6)
    assert P.find_span("run RUN", "run", []) == (0, 3) and P.find_span(None, "x", []) is None


@tables
def test_hard_words_by_brute_force(spark):
    familiar = {r.word for r in familiar_words(spark, str(SF)).collect()}
    rows = [(1, 'The Cat ran. "Bob sat: Big dogs" x a m Zorblatt\nRunning'), (2, ""), (3, None), (4, "zig Zag zig it's")]
    docs = spark.createDataFrame(rows, "k long, t string")
    listed = spark.createDataFrame([(w,) for w in (*sorted(familiar)[:0], "the", "cat", "run", "dog", "big", "a", "sit")], "word string")
    got = {r.k: (r.considered, r.hard, round(r.share, 6)) for r in P.hard_words(docs, "k", "t", listed).collect()}
    easy = {"the", "cat", "run", "dog", "big", "a", "sit"}
    lemmas = {"dogs": {"dogs", "dog"}, "running": {"running", "runn", "runne", "run"}}

    def scan(text):
        hard, n = [], 0
        for m in re.finditer(r"[A-Za-z][A-Za-z'’]*", text or ""):
            w, i = m.group(), m.start() - 1
            if len(w) < 2 and w.lower() not in easy:
                continue
            while i >= 0 and text[i] in " \t\"'([{-‘“–—":
                i -= 1
            if w[0].isupper() and not (i < 0 or text[i] in ".!?…:;\n\r"):
                continue
            n += 1
            if not lemmas.get(w.lower(), {w.lower()}) & easy:
                hard.append(w.lower())
        return n, list(dict.fromkeys(hard)), round(len(hard) / n, 6) if n else 0.0

    assert got == {k: scan(t) for k, t in rows}


@tables
def test_example_sieve_by_brute_force(spark):
    from lexweave.functions import text as T

    df = catalog.QUERIES["example_sieve"](spark, str(SF))
    got = {(r.doc_id, r.reason): r.lines for r in df.collect()}
    x = spark.read.parquet(f"{SF}/documents.parquet").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    x = x.select("doc_id", "line", "text", T.word_count("text").alias("n"), F.lower(T.opener("text")).alias("o"), P.paragraph_key("text").alias("k"))
    want, seen = {}, {}
    for r in sorted(x.collect(), key=lambda r: (r.doc_id, r.line)):
        keys, opens = seen.setdefault(r.doc_id, (set(), set()))
        if not r.text:
            why = "empty"
        elif not r.text[0].isupper() or r.text[-1] not in ".?!":
            why = "not_a_sentence"
        else:
            why = "too_short" if r.n < 4 else "too_long" if r.n > 30 else "duplicate" if r.k in keys else "repeated_opening" if r.o in opens else "surplus" if len(keys) >= 8 else "accepted"
        if why == "accepted":
            keys.add(r.k)
            opens.add(r.o)
        want[r.doc_id, why] = want.get((r.doc_id, why), 0) + 1
    assert got == want


@tables
def test_chunks_and_cycles(spark):
    from lexweave.functions import text as T
    from lexweave.plans.predicate_queries import turns

    words = {(r.conv_id, r.turn): r.n for r in turns(spark, str(SF)).select("conv_id", "turn", T.word_count("text").alias("n")).collect()}
    chunks = {(r.conv_id, r.turn): r.chunk for r in catalog.QUERIES["word_budget_chunks"](spark, str(SF)).collect()}
    for (c, t), chunk in chunks.items():
        mine = [words[k] for k, v in chunks.items() if k[0] == c and v == chunk]
        before = [words[k] for k, v in chunks.items() if k[0] == c and v == chunk - 1]
        first = min(k[1] for k, v in chunks.items() if k[0] == c and v == chunk)
        assert (sum(mine) <= 100 or len([m for m in mine if m]) == 1) and (not before or sum(before) + words[c, first] > 100)
    e = spark.createDataFrame([(0, 1), (1, 2), (2, 0), (3, 4), (5, 5), (2, 3)], "src long, dst long")
    assert [tuple(r) for r in repair.cycle_report(e).collect()] == [(0, 3, 3)]


@tables
def test_sweep_is_idempotent_and_leaves_no_cycle(spark):
    e, s = edges(spark, str(SF)).select("src", "dst", "type", "confidence"), senses(spark, str(SF))
    after, edits = repair.sweep(e, s)
    after = graph.cut(after)
    assert edits.count() > 0
    assert graph.cycle_edges(after.where("type = 'hypernym'")).isEmpty() and graph.mutual_pairs(after).isEmpty()
    assert repair.sweep(after, s)[1].isEmpty()


@tables
def test_graded_candidates(spark):
    got = {}
    for r in catalog.QUERIES["qrels_all_grades"](spark, str(SF)).collect():
        got.setdefault(r.src, []).append((r.grade, r.dst))
    live = {r.sense_key for r in senses(spark, str(SF)).where("not retired").collect()}
    assert set(got) == live
    for src, rows in got.items():
        assert (3, src) in rows and len({d for _, d in rows}) == len(rows) and {d for _, d in rows} <= live
        assert all(sum(g == k for g, _ in rows) <= 3 for k in (0, 1, 2))


@tables
def test_release_is_written_whole(spark, tmp_path):
    made = entries(spark, str(SF))
    scope = made.select("lexeme_id").orderBy("lexeme_id").limit(5)
    counts = E.write_release(made, str(tmp_path / "out"), rows_per_file=10, scope=scope)
    assert set(counts) == set(E.RELATIONS) and counts["lexicon"] == 5
    back = spark.read.parquet(str(tmp_path / "out/senses"))
    assert tuple(back.columns) == E.RELATIONS["senses"] and back.select("lexeme_id").distinct().count() <= 5
    none = E.write_release(made.limit(0), str(tmp_path / "none"))
    assert set(none.values()) == {0} and tuple(spark.read.parquet(str(tmp_path / "none/qa_pairs")).columns) == E.RELATIONS["qa_pairs"]
    q = spark.createDataFrame([("q1", "d2", 1), ("q1", "d1", 3)], "query_id string, doc_id string, grade int")
    E.write_trec(q, str(tmp_path / "trec"))
    E.write_jsonl(q, str(tmp_path / "jsonl"), ["doc_id"])
    E.write_tsv(q, str(tmp_path / "tsv"), ["doc_id"])
    assert [r.value for r in spark.read.text(str(tmp_path / "trec")).collect()] == ["q1 0 d1 3", "q1 0 d2 1"]
    assert [json.loads(r.value)["doc_id"] for r in spark.read.text(str(tmp_path / "jsonl")).collect()] == ["d1", "d2"]
    assert store.candidates(spark, str(tmp_path / "tsv")).count() == 1


def test_migration(spark, tmp_path):
    two = {"word": "River Bank", "part_of_speech": "noun", "senses": [{"definition": "edge", "synonyms": ["Shore", "shore ", "--"], "examples": ["a"]}, {"definition": "money", "antonyms": ["x"]}]}
    one = {"word": "old", "definitions": ["aged", "former"], "synonyms": ["aged"]}
    three = {"id": "new", "headword": "new", "pos": [{"pos": "adjective", "senses": [{"index": 0, "gloss": "g", "relations": [{"type": "antonym", "target_term": "old"}]}]}]}
    rows = [json.dumps(x) for x in (two, one, three, {"word": "?", "definitions": ["x"]}, {"a": 1})] + ["{broken"]
    good, bad = store.migrated(spark.createDataFrame([(r,) for r in rows], "value string"))
    got = {r.id: ([(s["index"], s.gloss, [(x.type, x.term) for x in s.relations]) for s in r.senses], r.provenance and r.provenance["p1"].model) for r in good.collect()}
    assert got == {"river_bank": ([(0, "edge", [("synonym", "Shore")]), (1, "money", [("antonym", "x")])], "v2.0"), "old": ([(0, "aged", [("synonym", "aged")]), (1, "former", [])], "v1.3"), "new": ([(0, "g", [("antonym", "old")])], None)}
    assert sorted(r.reason for r in bad.collect()) == ["no_headword", "no_json", "unknown_version"]
    (tmp_path / "w.tsv").write_text("id\tword\n1\talpha\n2\tbeta\n\n# no\n")
    (tmp_path / "p.txt").write_text("alpha\nbeta\n")
    assert {r.word for r in store.word_list(spark, str(tmp_path / "w.tsv")).collect()} == {r.word for r in store.word_list(spark, str(tmp_path / "p.txt")).collect()} == {"alpha", "beta"}
    files = {r.name: (r.bytes, r.sha256) for r in store.inventory(spark, str(tmp_path)).collect()}
    assert files["p.txt"] == (11, hashlib.sha256(b"alpha\nbeta\n").hexdigest())
    for _ in range(2):
        store.append_ledger(spark.range(3), str(tmp_path / "ledger"))
    assert spark.read.json(str(tmp_path / "ledger")).count() == 6
    with pytest.raises(FileNotFoundError):
        (tmp_path / "empty").mkdir()
        store.latest(spark, str(tmp_path / "empty"))


def test_calls_keep_every_row(spark):
    def client(prompt, feedback):
        if prompt == "bad":
            raise ValueError("no")
        if prompt == "slow" and feedback is None:
            return "[]"
        return json.dumps({"text": prompt})

    df = spark.createDataFrame([(1, "ok"), (2, "bad"), (3, "slow"), (4, None)], "id long, p string")
    got = {r.id: (r.answer, r.attempts, r.error) for r in stages.calls(df, "id", "p", client).collect()}
    assert got == {1: ('{"text": "ok"}', 1, None), 2: (None, 3, "ValueError: no"), 3: ('{"text": "slow"}', 2, None), 4: ('{"text": ""}', 1, None)}
    steps = [("even", lambda d: (d.where("id % 2 = 0"), d.where("id % 2 = 1"))), ("none", lambda d: (d, d.limit(0)))]
    rows, counts = stages.in_order(df, steps)
    assert rows.count() == 2 and {r.step: r.edits for r in counts.collect()} == {"even": 2, "none": 0}
    assert {r.step for r in stages.in_order(df, steps, ("none",))[1].collect()} == {"none"}


@tables
def test_attribution_and_card(spark):
    rows = [(i, "a" if i % 2 else "b", ("red blue " if i % 2 else "dog cat ") * 5 + str(i)) for i in range(60)] + [(99, "a", "red")]
    df = spark.createDataFrame(rows, "id long, who string, text string")
    assert reports.balanced(df, "who", "id", 1).groupBy("who").count().select("count").distinct().collect()[0][0] == 30
    got = {(r.who, r.predicted): r.rows for r in reports.attribution(df, "who", "text", "id", folds=2, features=256).collect()}
    assert sum(n for (a, b), n in got.items() if a == b) >= 0.95 * 61
    text = reports.card("x", df.agg(F.count("*").alias("rows")), {"by who": df.groupBy("who").count()}, [("id", "long")])
    assert "- rows: 61" in text and "| a | 31 |" in text and "| id | long |" in text
