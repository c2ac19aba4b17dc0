"""JSON results and model metadata."""

from __future__ import annotations

from typing import Any

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldloom.operators.metrics import INSPECTION_RATES, rate_label

COMPARISON_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("feature_set", T.StringType()),
        T.StructField("evaluation_protocol", T.StringType()),
        T.StructField("n_features", T.IntegerType()),
        *[T.StructField(f"test_{m}", T.DoubleType()) for m in ("pr_auc", "roc_auc", "precision", "recall", "f1")],
        *[
            T.StructField(f"{n}_at_{rate_label(r)}", T.LongType() if n == "captured_fails" else T.DoubleType())
            for r in INSPECTION_RATES
            for n in ("recall", "precision", "captured_fails", "lift")
        ],
    ]
)


def _exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def read_comparison(spark: SparkSession, path: str) -> DataFrame:
    """Rows of {"results": [...]} files; without the file, no rows of the same schema."""
    if not _exists(spark, path):
        return spark.createDataFrame([], COMPARISON_SCHEMA)
    wrapper = T.StructType([T.StructField("results", T.ArrayType(COMPARISON_SCHEMA))])
    return spark.read.schema(wrapper).json(path, multiLine=True).select(F.inline("results"))


def write_comparison(table: DataFrame, path: str) -> None:
    """One {"results": [...]} document; the table has one row per configuration and protocol."""
    rows = F.collect_list(F.struct(*[F.col(c) for c in COMPARISON_SCHEMA.names]))
    document = table.agg(F.to_json(F.struct(rows.alias("results"))).alias("value"))
    document.coalesce(1).write.mode("overwrite").text(path)


def read_metadata(spark: SparkSession, artifact: str) -> dict[str, Any]:
    """Metadata of a saved model, {} if there is none."""
    path = f"{artifact}/metadata"
    if not _exists(spark, path):
        return {}
    row = spark.read.text(path, wholetext=True).first()
    return json.loads(row.value) if row else {}
