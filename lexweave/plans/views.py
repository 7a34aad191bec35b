"""The driver's tables seen as a lexicon, a relation graph and renditions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexweave.functions import text as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table whose texts are worked on at length: a table of few files is dealt to all cores first; at scale files are many and nothing moves."""
    df = table(spark, sf_dir, name).select(*columns)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def senses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part name is a headword, its parts are senses in order of key; parts of size 48 and more are retired."""
    part = table(spark, sf_dir, "part")
    order = Window.partitionBy("p_name").orderBy("p_partkey")
    index = (F.row_number().over(order) - 1).cast("int")
    out = part.select(F.col("p_partkey").alias("sense_key"), T.slug("p_name").alias("lexeme_id"), F.col("p_name").alias("headword"), index.alias("sense_index"), F.col("p_brand").alias("domain"), F.col("p_type").alias("gloss"), F.col("p_retailprice").alias("price"), (F.col("p_size") >= 48).alias("retired"))
    return out.withColumn("sense_id", F.concat("lexeme_id", F.lit(":noun:"), F.col("sense_index").cast("string")))


SENSES_SQL = """senses AS (
  SELECT p_partkey AS sense_key, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') AS lexeme_id, p_name AS headword,
         (row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) - 1)::INT AS sense_index, p_brand AS domain, p_type AS gloss, p_retailprice AS price, p_size >= 48 AS retired,
         trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') || ':noun:' || (row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) - 1) AS sense_id
  FROM part)"""

#: Line numbers repeat within an order, so the rest of the line breaks ties.
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus")
#: What a line's flags say of the relation to the part of the order's next line.
TYPES = (("A", "F", "hypernym"), ("R", "F", "synonym"), ("N", "F", "antonym"), ("N", "O", "confusable"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of a line relates to that of the order's next line: src, dst, type, confidence, and the line as place."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER)
    nxt = F.lead("l_partkey").over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER))
    kind = F.lit("see_also")
    for flag, status, name in TYPES:
        kind = F.when((F.col("l_returnflag") == flag) & (F.col("l_linestatus") == status), name).otherwise(kind)
    out = line.withColumn("dst", nxt).where("dst is not null")
    return out.select(F.col("l_partkey").alias("src"), "dst", kind.alias("type"), (1 - F.col("l_discount")).alias("confidence"), F.col("l_orderkey").alias("place"), F.col("l_linenumber").alias("ord"))


_CASE = " ".join(f"WHEN l_returnflag = '{a}' AND l_linestatus = '{b}' THEN '{t}'" for a, b, t in TYPES)
EDGES_SQL = f"""edges AS (
  SELECT * FROM (SELECT l_partkey AS src, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) AS dst,
    CASE {_CASE} ELSE 'see_also' END AS type, 1 - l_discount AS confidence, l_orderkey AS place, l_linenumber AS ord FROM lineitem) WHERE dst IS NOT NULL)"""
