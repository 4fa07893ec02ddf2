"""The driver's TPC-H-ish tables mapped onto the recommender data model (FIXTURES §2).

Every loader reads parquet with only the columns it needs, so Catalyst prunes the
scan (``ReadSchema``) and pushes filters into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import interaction_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line: ``user = o_custkey, item = l_partkey, value = l_quantity``."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return (lines.join(orders, lines.l_orderkey == orders.o_orderkey)
            .select(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"),
                    F.col("l_quantity").alias("value")))


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interaction table ``I``: ``user, item, value = sum(quantity)`` per pair."""
    return interaction_table(transactions(spark, sf_dir), "user", "item", "value")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explicit-feedback view of ``I``: ``rating = value / 10``."""
    return interactions(spark, sf_dir).select("user", "item", (F.col("value") / 10.0).alias("rating"))


def likes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Implicit-feedback view of ``I``: distinct ``user, item`` pairs."""
    return interactions(spark, sf_dir).select("user", "item")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue: ``item, title, genres`` from ``part``."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item"), F.col("p_name").alias("title"),
        F.col("p_type").alias("genres"))


def item_side_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item side information ``item, type, value``: brand, type and one tag per word of the name."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    brand = part.select(F.col("p_partkey").alias("item"), F.lit("brand").alias("type"),
                        F.col("p_brand").alias("value"))
    ptype = part.select(F.col("p_partkey").alias("item"), F.lit("type").alias("type"),
                        F.col("p_type").alias("value"))
    tags = part.select(F.col("p_partkey").alias("item"), F.lit("tag").alias("type"),
                       F.explode(F.split("p_name", " ")).alias("value"))
    return brand.unionByName(ptype).unionByName(tags)


def user_side_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User side information ``user, type, value``: market segment and nation."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    seg = cust.select(F.col("c_custkey").alias("user"), F.lit("segment").alias("type"),
                      F.col("c_mktsegment").alias("value"))
    nat = cust.select(F.col("c_custkey").alias("user"), F.lit("nation").alias("type"),
                      F.col("c_nationkey").cast("string").alias("value"))
    return seg.unionByName(nat)


def fixed_factors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``embeddings`` as a fixed factor model: every vector is a user and an item, each ``id, vec, label``."""
    emb = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").cast("array<double>").alias("vec"), "label")
    return emb, emb


def embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings as ``id, vec ARRAY<DOUBLE>, label``."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), "label")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logged bandit feedback: ``user, arm = event_type, reward = value``."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("user"), F.col("event_type").alias("arm"),
        F.col("value").alias("reward"), "ts")
