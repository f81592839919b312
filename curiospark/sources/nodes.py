"""A node table (record_id, data_source, field_type, value) from wide tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .dealt import dealt


def unpivoted(wide: DataFrame, record_id: str, data_source: str, fields: list[str]) -> DataFrame:
    """One row per field of a wide row, null values included; ids and values as strings."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field_type"), F.col(f).cast("string").alias("value")) for f in fields]))
    return wide.select(F.col(record_id).cast("string").alias("record_id"), F.col(data_source).alias("data_source"), pairs.alias("p")).select("record_id", "data_source", "p.field_type", "p.value")


def part_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as records of their brands; sizes are missing from every seventh part, to have gaps to measure."""
    part = dealt(spark.read.parquet(f"{sf_dir}/part.parquet"), "p_partkey")
    part = part.withColumn("p_size", F.when(F.col("p_partkey") % 7 != 0, F.col("p_size"))).withColumn("p_retailprice", F.when(F.col("p_partkey") % 5 != 0, F.col("p_retailprice").cast("long")))
    return unpivoted(part, "p_partkey", "p_brand", ["p_name", "p_type", "p_size", "p_retailprice"])


PART_NODES_SQL = """nodes AS (
  SELECT CAST(p_partkey AS VARCHAR) AS record_id, p_brand AS data_source, 'p_name' AS field_type, p_name AS value FROM part
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_brand, 'p_type', p_type FROM part
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_brand, 'p_size', CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size AS VARCHAR) END FROM part
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_brand, 'p_retailprice', CASE WHEN p_partkey % 5 <> 0 THEN CAST(CAST(trunc(p_retailprice) AS BIGINT) AS VARCHAR) END FROM part)"""


def document_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records of their sources: a free text and a structured field."""
    return unpivoted(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "source", ["text", "lang"])


def conversation_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as records whose roles are text fields."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return rows.select(F.col("conv_id").cast("string").alias("record_id"), F.col("role").alias("field_type"), F.col("text").alias("value"))


def order_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as roots and their lines as children; a customer is a record, a priority a source."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_returnflag", "l_linestatus")
    own = [F.col("o_custkey").cast("string").alias("record_id"), F.col("o_orderpriority").alias("data_source")]
    roots = orders.select(*own, F.col("o_orderkey").alias("node_id"), F.lit(None).cast("long").alias("parent_id"), F.lit(0).alias("depth"), F.col("o_orderstatus").alias("field_type"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("value"))
    children = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    nodes = children.select(*own, F.lit(None).cast("long").alias("node_id"), F.col("l_orderkey").alias("parent_id"), F.lit(1).alias("depth"), F.col("l_returnflag").alias("field_type"), F.col("l_linestatus").alias("value"))
    return roots.unionByName(nodes)


def line_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as records of ten groups of suppliers, whose fields hold small numbers, or nothing for small quantities of some groups."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    lines = lines.withColumn("grp", (F.col("l_suppkey") % 10).cast("string")).withColumn("quantity", F.col("l_quantity").cast("int")).withColumn("line", F.col("l_linenumber"))
    known = (F.col("grp") < "5") | (F.col("l_quantity") > 7)
    return unpivoted(lines.withColumn("quantity", F.when(known, F.col("quantity"))).withColumn("line", F.when(known, F.col("line"))), "l_orderkey", "grp", ["quantity", "line"])


DOCUMENT_NODES_SQL = """nodes AS (
  SELECT CAST(doc_id AS VARCHAR) AS record_id, source AS data_source, 'text' AS field_type, text AS value FROM documents
  UNION ALL SELECT CAST(doc_id AS VARCHAR), source, 'lang', lang FROM documents)"""
CONVERSATION_TEXTS_SQL = "texts AS (SELECT CAST(conv_id AS VARCHAR) AS record_id, role AS field_type, text AS value FROM conversations)"
ORDER_TREE_SQL = """tree AS (
  SELECT CAST(o_custkey AS VARCHAR) AS record_id, o_orderpriority AS data_source, o_orderkey AS node_id, NULL AS parent_id, 0 AS depth, o_orderstatus AS field_type,
    CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS value FROM orders
  UNION ALL SELECT CAST(o_custkey AS VARCHAR), o_orderpriority, NULL, l_orderkey, 1, l_returnflag, l_linestatus FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""
LINE_NODES_SQL = """lines AS (SELECT *, CAST(l_suppkey % 10 AS VARCHAR) AS grp FROM lineitem),
nodes AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS record_id, grp AS data_source, 'quantity' AS field_type, CASE WHEN grp < '5' OR l_quantity > 7 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS value FROM lines
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), grp, 'line', CASE WHEN grp < '5' OR l_quantity > 7 THEN CAST(l_linenumber AS VARCHAR) END FROM lines)"""
