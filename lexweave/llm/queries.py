"""The queries opN_<name>: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, line_dedup, media, packing, secrets, toxicity, warc
from .common import scratch_path, write_table
from .ngram_jaccard import jaccard_components
from .passages import shared_passages
from .topk import top_k

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 100 = 0"), 10)


ORACLES["op1_topk"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).drop("text_hash", "group")


ORACLES["op2_ngram_jaccard"] = r"""
WITH RECURSIVE
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
u AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
l AS (SELECT a.doc_id AS x, b.doc_id AS y FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, seen) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.seen = e.x),
c AS (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY doc_id),
k AS (SELECT list_sort(s) AS s, count(*) AS n FROM s GROUP BY 1)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, c.component_id,
       CASE WHEN len(s.s) = 0 THEN 1 ELSE k.n END::BIGINT AS n_copies
FROM s JOIN c ON c.doc_id = s.doc_id JOIN k ON k.s = list_sort(s.s)
"""


@query
def op3_chroma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as recordings: their bytes are the samples. Documents are aligned with the benchmark's items."""
    sound = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("media")
    documents, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return media.align(documents.select("doc_id", sound), "doc_id", items.select("item_id", sound), "item_id")


@query
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_spans(table(spark, sf_dir, "documents")))


def _op4_oracle() -> str:
    """The same spans by lists; each window's entropy is computed anew."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    patterns = [(secrets.ASSIGN, "length(regexp_extract(m, " + q(secrets.ASSIGN) + ", 1)) >= 12"), (secrets.ACCESS, "true"), (secrets.HEX, "true")]
    allow = secrets.ALLOW.replace(r"|(.)\1{7}", "")
    for _, pattern, _, width, least in secrets.CLASSES:
        highest = f"list_max(list_transform(range(1, length(m) - {width - 2}), lambda i: list_aggregate(string_split(m, '')[i:i + {width - 1}], 'entropy')))"
        same = "length(list_filter(range(1, length(m) - 6), lambda i: m[i:i + 7] = repeat(m[i], 8))) = 0"
        patterns.append((pattern, f"regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]') AND NOT regexp_matches(m, {q(allow)}) AND {same} AND {highest} >= {least}"))
    parts = []
    for kind, (pattern, keep) in enumerate(patterns):
        parts.append(f"""SELECT doc_id, {kind} AS kind, m, start, start + length(m) AS stop FROM (
            SELECT doc_id, unnest(f) AS m, unnest(list_transform(range(1, len(f) + 1), lambda i: list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0)))::INT AS start
            FROM (SELECT doc_id, regexp_extract_all(text, {q(pattern)}) AS f, regexp_split_to_array(text, {q(pattern)}) AS p FROM t)) WHERE {keep}""")
    kinds = "[" + ", ".join(map(q, secrets.KINDS)) + "]"
    joined = f"coalesce(string_agg({kinds}[kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (%s), '')"
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
a AS ({" UNION ALL ".join(parts)}),
s AS (SELECT * FROM a WHERE kind < 3 OR NOT EXISTS (SELECT 1 FROM a b WHERE b.doc_id = a.doc_id AND b.kind < 3 AND b.start <= a.start AND a.stop <= b.stop))
SELECT t.doc_id, count(*) FILTER (kind = 0)::BIGINT AS n_assign, count(*) FILTER (kind = 1)::BIGINT AS n_access, count(*) FILTER (kind = 2)::BIGINT AS n_hex,
       sha256({joined % "kind < 3"}) AS base_sha256, {joined % "kind IS NOT NULL"} AS spans
FROM t LEFT JOIN s ON s.doc_id = t.doc_id GROUP BY t.doc_id
"""


ORACLES["op4_secrets"] = _op4_oracle()


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    records = write_table(warc.read_records(spark, path), "warc-records")
    captures = write_table(warc.assemble(records), "warc-captures")
    out = warc.resolved(captures)
    return out.select("metadata.page_id", "response.payload_bytes", "response.payload_digest", "record_type", F.col("original.page_id").alias("refers_to"))


ORACLES["op5_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


ORACLES["op6_line_dedup"] = f"""
WITH RECURSIVE
d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
o AS (SELECT * FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS line_no FROM d) WHERE length(line) >= {line_dedup.MIN_CHARS}),
u AS (SELECT line, length(line) AS n, min((doc_id, line_no)) AS first FROM o GROUP BY line),
p AS (SELECT a.line AS x, b.line AS y FROM u a JOIN u b ON b.n BETWEEN a.n AND a.n + {line_dedup.EDITS} AND a.line <> b.line AND levenshtein(a.line, b.line) <= {line_dedup.EDITS}),
e AS (SELECT x, y FROM p UNION SELECT y, x FROM p),
r(line, seen) AS (SELECT x, x FROM e UNION SELECT r.line, e.y FROM r JOIN e ON r.seen = e.x),
c AS (SELECT r.line, min((u.first, r.seen)) AS rep FROM r JOIN u ON u.line = r.seen GROUP BY r.line),
m AS (SELECT o.doc_id, o.line_no, coalesce(c.rep[1], u.first) AS rep, coalesce(c.rep[2], o.line) <> o.line AS near
      FROM o JOIN u ON u.line = o.line LEFT JOIN c ON c.line = o.line),
g AS (SELECT doc_id, count(*) FILTER (NOT near) AS n_exact, count(*) FILTER (near) AS n_near,
             string_agg(line_no || '>' || rep[1] || ':' || rep[2], ',' ORDER BY line_no) AS removed
      FROM m WHERE (doc_id, line_no) <> rep GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(ls), 1)::BIGINT AS n_lines, coalesce(n_exact, 0)::BIGINT AS n_exact, coalesce(n_near, 0)::BIGINT AS n_near, coalesce(removed, '') AS removed
FROM d LEFT JOIN g ON g.doc_id = d.doc_id
"""


@query
def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_passages(table(spark, sf_dir, "documents"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    return toxicity.toxicity_scores(documents.select("doc_id", "text"), model).select("doc_id", "held_out", "score", "predicted")


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(cut)


@query
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encode_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
