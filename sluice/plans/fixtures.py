"""Logs, bases and copies derived from the test tables; the same rules as SQL are beside the queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import doc_bytes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as change events."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    op = F.when(F.col("event_type") == "signup", "insert").when(F.col("event_type") == "click", "update").when(F.col("event_type") == "view", "replace")
    op = op.when((F.col("event_type") == "error") & (k == 99), "drop").when(F.col("event_type") == "error", "delete")
    op = op.when((F.col("event_type") == "purchase") & (F.col("value") >= 50), "insert").otherwise("invalidate")
    return table(spark, sf_dir, "events").select(F.lpad(F.col("event_id").cast("string"), 12, "0").alias("sync_id"), F.lit("main").alias("db"), F.concat(F.lit("coll_"), (F.col("user_id") % 8).cast("string")).alias("coll"), op.alias("op"), k.alias("doc_key"), F.col("value").alias("doc"), F.col("ts").alias("cluster_ts"), doc_bytes(F.col("props"), F.col("event_type")).cast("int").alias("n_bytes"))


def base_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.concat(F.lit("coll_"), (F.col("s_suppkey") % 8).cast("string")).alias("coll"), F.col("s_suppkey").cast("int").alias("doc_key"), F.col("s_acctbal").alias("doc"))


def sender_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the sender of a synchronisation holds."""
    return table(spark, sf_dir, "customer").select(F.concat(F.lit("coll_"), (F.col("c_custkey") % 8).cast("string")).alias("coll"), F.col("c_custkey").cast("int").alias("doc_key"), F.col("c_acctbal").alias("doc"))


def order_copies(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(sender, receiver) copies of orders that differ."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey", "o_totalprice", "o_orderpriority")
    key = F.col("o_orderkey")
    receiver = orders.where(key % 7 != 0).withColumns({"o_totalprice": F.when(key % 13 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")), "o_orderpriority": F.when(key % 17 == 0, F.lit("X")).otherwise(F.col("o_orderpriority"))})
    return orders.where(key % 10 != 0), receiver


def vector_copies(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    v = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("string").alias("coll"), F.col("embedding").cast("array<double>").alias("v"))
    near = lambda x: F.when(F.col("vec_id") % 3 == 0, x * F.lit(1 + 1e-9)).otherwise(x)
    return v, v.withColumn("v", F.transform("v", lambda x, i: near(x) + F.when((F.col("vec_id") + i) % 11 == 0, 1.0).otherwise(0.0)))


VECTOR_NAMES = (*(f"f{k}" for k in range(62)), None, None)
