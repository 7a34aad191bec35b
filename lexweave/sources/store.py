"""Entry store: JSON scan with a quarantine, legacy upgrade, immutable snapshots, shards (operators C)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as S

RELATION = S.ArrayType(S.StructType([S.StructField("type", S.StringType()), S.StructField("target_term", S.StringType()), S.StructField("target_sense_id", S.StringType()), S.StructField("confidence", S.DoubleType()), S.StructField("note", S.StringType())]))
SENSE = S.StructType([S.StructField("index", S.IntegerType()), S.StructField("retired", S.BooleanType()), S.StructField("domain", S.StringType()), S.StructField("gloss", S.StringType()), S.StructField("relations", RELATION)])
ENTRY = S.StructType([
    S.StructField("id", S.StringType()), S.StructField("headword", S.StringType()), S.StructField("schema_version", S.StringType()), S.StructField("kind", S.StringType()), S.StructField("status", S.StringType()),
    S.StructField("pos", S.ArrayType(S.StructType([S.StructField("pos", S.StringType()), S.StructField("senses", S.ArrayType(SENSE))]))), S.StructField("synonyms", S.ArrayType(S.StringType())), S.StructField("antonyms", S.ArrayType(S.StringType())),
])


def scan(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(entries, quarantine) of one-entry JSON files at any depth; a file that can't be read is counted, not lost."""
    schema = S.StructType([*ENTRY.fields, S.StructField("_corrupt", S.StringType())])
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    rows = rows.withColumn("file", F.input_file_name())
    return rows.where("_corrupt is null and id is not null").drop("_corrupt"), rows.where("_corrupt is not null or id is null").select("file", "_corrupt")


def lookup(entries: DataFrame, ids: DataFrame) -> DataFrame:
    """The entries of a table of ids."""
    return entries.join(ids.select("id").distinct(), "id", "left_semi")


def upgrade(entries: DataFrame) -> DataFrame:
    """C4: legacy lists of synonyms and antonyms become typed relations of the first sense, distinct on (type, lower-case term); sense numbers stay."""
    typed = lambda column, kind: F.expr(f"transform(coalesce({column}, cast(array() as array<string>)), t -> struct('{kind}' as type, trim(t) as term))")
    old = F.concat(typed("synonyms", "synonym"), typed("antonyms", "antonym"))
    rows = entries.select("id", F.posexplode(old).alias("ord", "r")).where("r.term != ''")
    nth = F.row_number().over(Window.partitionBy("id", "r.type", F.lower("r.term")).orderBy("ord"))
    return rows.withColumn("nth", nth).where("nth = 1").select("id", "ord", "r.type", F.col("r.term").alias("target_term"))


def relations(entries: DataFrame) -> DataFrame:
    """One row per stored relation of a live sense, with its derived sense id."""
    senses = entries.select("id", F.explode("pos").alias("p")).select("id", "p.pos", F.explode("p.senses").alias("s")).where("not coalesce(s.retired, false)")
    sense_id = F.concat_ws(":", "id", "pos", F.col("s.index").cast("string"))
    return senses.select(sense_id.alias("source_sense_id"), F.posexplode("s.relations").alias("ord", "r")).select("source_sense_id", "ord", "r.*")


def write_snapshot(df: DataFrame, root: str, version: int, rows_per_file: int = 500_000) -> str:
    """A new version in a folder of its own; readers of older versions are not disturbed, a version is never written twice."""
    path = f"{root}/version={version:06d}"
    df.write.mode("errorifexists").option("maxRecordsPerFile", rows_per_file).parquet(path)
    return path


def latest(spark: SparkSession, root: str) -> DataFrame:
    """The highest version whose write was committed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    done = sorted(s.getPath().toString() for s in fs.listStatus(path) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))
    if not done:
        raise FileNotFoundError(f"no committed version under {root}")
    return spark.read.parquet(done[-1])


def _list(column: str) -> str:
    return f"coalesce({column}, cast(array() as array<string>))"


def migrated(payloads: DataFrame, text: str = "value") -> tuple[DataFrame, DataFrame]:
    """(entries, rejected) of JSON texts of the versions 1.3, 2.0 and 3, told by what they hold.

    Version 3 has `pos`; 2.0 has `senses` (definition, examples, synonyms, ...); 1.3 has `definitions` and flat lists.
    Sense numbers follow the order in the payload. Relations are distinct on (type, lower-case term), terms without a letter or digit
    go, and every inherited field gets a provenance record that cost nothing. Texts that are no object of a
    known version are rejected with the reason.
    """
    v2 = "struct<word:string,part_of_speech:string,senses:array<struct<definition:string,examples:array<string>,synonyms:array<string>,antonyms:array<string>,hypernyms:array<string>>>>"
    v1 = "struct<word:string,pos:string,definitions:array<string>,examples:array<string>,synonyms:array<string>,antonyms:array<string>,hypernyms:array<string>,etymology:string>"
    p = payloads.withColumn("version", F.when(F.get_json_object(text, "$.pos[0].senses").isNotNull(), "3").when(F.get_json_object(text, "$.senses[0].definition").isNotNull(), "2.0").when(F.get_json_object(text, "$.definitions[0]").isNotNull(), "1.3"))
    rejected = p.where("version is null").select(text, F.when(F.get_json_object(text, "$").isNull(), "no_json").otherwise("unknown_version").alias("reason"))
    buckets = lambda s: ", ".join(f"transform({_list(f'{s}.{c}s')}, t -> named_struct('type', '{c}', 'term', trim(t)))" for c in ("synonym", "antonym", "hypernym"))
    two = p.where("version = '2.0'").withColumn("j", F.from_json(text, v2))
    two = two.select(F.col("j.word").alias("headword"), "version", F.coalesce("j.part_of_speech", F.lit("noun")).alias("pos"), F.expr(f"transform(j.senses, (s, i) -> named_struct('index', i, 'gloss', s.definition, 'examples', {_list('s.examples')}, 'relations', concat({buckets('s')})))").alias("senses"))
    one = p.where("version = '1.3'").withColumn("j", F.from_json(text, v1))
    none = "cast(array() as array<struct<type:string,term:string>>)"
    one = one.select(F.col("j.word").alias("headword"), "version", F.coalesce("j.pos", F.lit("noun")).alias("pos"), F.expr(f"transform(j.definitions, (d, i) -> named_struct('index', i, 'gloss', d, 'examples', case when i = 0 then {_list('j.examples')} else cast(array() as array<string>) end, 'relations', case when i = 0 then concat({buckets('j')}) else {none} end))").alias("senses"))
    three = p.where("version = '3'").withColumn("j", F.from_json(text, ENTRY))
    flat = "transform(j.pos[0].senses, s -> named_struct('index', s.index, 'gloss', s.gloss, 'examples', cast(array() as array<string>), 'relations', transform(coalesce(s.relations, array()), r -> named_struct('type', r.type, 'term', r.target_term))))"
    three = three.select("j.headword", "version", F.expr("j.pos[0].pos").alias("pos"), F.expr(flat).alias("senses"))
    rows = two.unionByName(one).unionByName(three)
    keep = "filter(relations, (r, k) -> r.term rlike '[A-Za-z0-9]' and not exists(slice(relations, 1, k), o -> o.type = r.type and lower(o.term) = lower(r.term)))"
    clean = f"transform(senses, s -> named_struct('index', s.index, 'gloss', s.gloss, 'examples', s.examples, 'relations', transform(array(s.relations), relations -> {keep})[0]))"
    slug = F.expr("nullif(btrim(regexp_replace(lower(headword), '[^a-z0-9]+', '_'), '_'), '')")
    rows = rows.withColumn("senses", F.expr(clean)).withColumn("id", slug)
    rows = rows.withColumn("provenance", F.when(F.col("version") != "3", F.map_from_arrays(F.array(F.lit("p1")), F.array(F.struct(F.lit("migrate").alias("stage"), F.concat(F.lit("v"), "version").alias("model"), F.lit(0.0).alias("cost"))))))
    bad = rows.where("id is null").select(F.col("headword").alias(text), F.lit("no_headword").alias("reason"))
    return rows.where("id is not null"), rejected.union(bad)


def candidates(spark: SparkSession, path: str, source: str | None = None) -> DataFrame:
    """The rows of a tab-separated file with a header, of one `source` if asked; slug is the key, the first row of a slug (by line) counts."""
    df = spark.read.option("sep", "\t").option("header", True).csv(path).withColumn("line", F.monotonically_increasing_id())
    if source is not None:
        df = df.where(F.col("source") == source)
    word = df.columns[0] if "word" not in df.columns else "word"
    df = df.withColumn("slug", F.expr(f"nullif(btrim(regexp_replace(lower({word}), '[^a-z0-9]+', '_'), '_'), '')")).where("slug is not null")
    first = df.groupBy("slug").agg(F.min("line").alias("line"))
    return df.join(first, ["slug", "line"], "left_semi").drop("line")


def word_list(spark: SparkSession, path: str) -> DataFrame:
    """The words of a plain, comma- or tab-separated file: its `word` column if the first line names one, else its first; blank lines and comments (#) go."""
    lines = spark.read.text(path).where("trim(value) != '' and not startswith(trim(value), '#')").withColumn("cells", F.split("value", "[\t,]"))
    head = lines.where("exists(cells, c -> lower(trim(c)) = 'word')").limit(1).collect()
    at = [c.strip().lower() for c in head[0]["cells"]].index("word") if head else 0
    return lines.select(F.trim(F.get("cells", F.lit(at))).alias("word")).where("word != '' and lower(word) != 'word'").distinct()


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """Name, bytes and SHA-256 of every file under a path; a file is one row, so files should be of bounded size."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return f.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def append_ledger(records: DataFrame, path: str) -> None:
    """Work records appended as JSON lines, a file a task; readers see whole files alone."""
    records.write.mode("append").json(path)


def shown(entries: DataFrame, entry_id: str) -> DataFrame:
    """C20: an entry by id, with its relations as rows."""
    return relations(entries.where(F.col("id") == entry_id))
