"""Queries without SQL over whole tables, against brute force on the smallest tables."""

import re

import pytest

from lexweave import catalog
from lexweave.plans.views import edges, table
from test_queries import SF

pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")


def reach(seeds, out):
    seen, todo = set(seeds), list(seeds)
    while todo:
        for v in out.get(todo.pop(), ()):
            if v not in seen:
                seen.add(v)
                todo.append(v)
    return seen


def neighbours(pairs):
    out: dict = {}
    for a, b in pairs:
        out.setdefault(a, set()).add(b)
    return out


def test_components_of_every_type(spark):
    pairs = {(r.src, r.dst) for r in edges(spark, str(SF)).select("src", "dst").collect() if r.src != r.dst}
    out, want = neighbours(pairs | {(b, a) for a, b in pairs}), {}
    for v in sorted(out):
        if v not in want:
            want |= dict.fromkeys(reach([v], out), v)
    assert {r.node: r.root for r in catalog.QUERIES["connected_components_all"](spark, str(SF)).collect()} == want


def hypernyms(spark):
    return {(r.src, r.dst) for r in edges(spark, str(SF)).where("type = 'hypernym'").select("src", "dst").collect() if r.src != r.dst}


def test_strong_components_of_hypernyms(spark):
    pairs = hypernyms(spark)
    ahead, back, done, want = neighbours(pairs), neighbours((b, a) for a, b in pairs), set(), {}
    for v in {x for p in pairs for x in p}:
        if v not in done:
            one = reach([v], ahead) & reach([v], back)
            done |= one
            size = "1" if len(one) == 1 else "2" if len(one) == 2 else "3-10" if len(one) <= 10 else "over 10"
            n, m = want.get(size, (0, 0))
            want[size] = n + 1, m + len(one)
    assert {r["size"]: (r.components, r.nodes) for r in catalog.QUERIES["scc_sizes_hypernym"](spark, str(SF)).collect()} == want


def test_no_cycle_of_hypernyms_is_left(spark):
    pairs = hypernyms(spark)
    gone = {(r.src, r.dst) for r in catalog.QUERIES["cycle_break"](spark, str(SF)).collect()}
    assert gone <= pairs
    left = neighbours(pairs - gone)
    for a, b in gone:  # each closes a cycle with what stays
        assert a in reach([b], left)
    degree = {v: 0 for p in pairs for v in p}
    for a, b in pairs - gone:
        degree[b] += 1
    free, n = [v for v, d in degree.items() if not d], 0
    while free:
        n += 1
        for v in left.get(free.pop(), ()):
            degree[v] -= 1
            if not degree[v]:
                free.append(v)
    assert n == len(degree)


def test_forms_of_all_words(spark):
    texts = [r.text or "" for r in table(spark, str(SF), "documents").where("lang = 'en'").select("text").collect()]
    words = {w for t in texts for w in re.findall("[a-z]+", t.lower())}
    rows = [tuple(r) for r in catalog.QUERIES["word_forms"](spark, str(SF)).collect()]
    assert {r[0] for r in rows} == words and {len(w) for w in words} - set(range(3, 7))
    by = {(w, p): f for w, p, f in rows}
    short = {r.word: r.plural for r in catalog.QUERIES["word_plurals"](spark, str(SF)).collect()}
    assert all(by[w, 0] == f for w, f in short.items())
    assert all((w, 1) in by for w in words)
