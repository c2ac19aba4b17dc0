"""Entity tables and score tables derived from general business tables (line items, embeddings).

They give the operators real inputs with every kind of feature: complete, sparse, constant, all missing
and correlated columns, heavily tied scores, many dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldloom.functions import decode_label

SENSORS = 64


def _line_id():
    return F.concat_ws(
        "-",
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.to_date("l_shipdate").cast("string"),
    )


def lot_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entity per line item, seven features, returned items are the fails."""
    item = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    label = F.when(F.col("l_returnflag") == "R", 1).otherwise(-1)
    return item.select(
        _line_id().alias("entity_id"),
        F.col("l_shipdate").cast("timestamp").alias("test_timestamp"),
        label.alias("yield_label"),
        decode_label(label).alias("pass_fail"),
        F.col("l_quantity").alias("feature_001"),
        F.col("l_extendedprice").alias("feature_002"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("feature_003"),
        F.when(F.col("l_tax") >= F.lit(0.05), F.col("l_tax")).alias("feature_004"),
        F.lit(1.0).alias("feature_005"),
        F.lit(None).cast("double").alias("feature_006"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("feature_007"),
    )


def sensor_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entity per vector, its components are the features, four entities a day."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("label") == 0, 1).otherwise(-1)
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return vectors.select(
        F.col("vec_id").alias("entity_id"),
        (start + F.make_interval(hours=(F.col("vec_id") * 6).cast("int"))).alias("test_timestamp"),
        label.alias("yield_label"),
        decode_label(label).alias("pass_fail"),
        *[F.col("embedding")[i].cast("double").alias(f"feature_{i + 1:03d}") for i in range(SENSORS)],
    )


def scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a coarse score between 0 and 1, so that many entities tie."""
    item = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return item.select(
        _line_id().alias("entity_id"),
        F.col("l_linenumber").alias("line"),
        (F.col("l_returnflag") == "R").cast("int").alias("y_true"),
        F.round(F.col("l_discount") * 5 + F.col("l_tax") * 5, 2).alias("risk"),
    )
