"""JSON exports: one folder per section, a bundle document, and the landing summary."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldloom.operators.metrics import curve_point
from yieldloom.operators.separation import bucket_rollup, bucket_totals


def export_sections(sections: Mapping[str, DataFrame], folder: str) -> None:
    """Each section as JSON lines in its own subfolder, written by all executors; NULL stays null."""
    for name, table in sections.items():
        table.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{folder}/{name}")


def as_document(table: DataFrame, single: bool = False) -> DataFrame:
    """One row, one JSON text: the records of a report table, or its only record.

    For report tables only (days, features, configurations, grid points), whose size does not follow the
    number of entities.
    """
    record = F.struct(*[F.col(f"`{c}`") for c in table.columns])
    options = {"ignoreNullFields": "false"}
    if single:
        return table.limit(1).select(F.to_json(record, options).alias("json"))
    return table.agg(F.to_json(F.collect_list(record), options).alias("json"))


def feature_groups_section(priority: DataFrame, top_separators: list[str]) -> DataFrame:
    """Buckets, top separators and bucket counts as one record."""
    buckets = bucket_rollup(priority).agg(
        F.array_sort(F.collect_list(F.struct("bucket_name", "feature_count", "features"))).alias("buckets")
    )
    totals = bucket_totals(priority)
    return totals.select(
        buckets.scalar().alias("buckets"),
        F.array(*[F.lit(f) for f in top_separators]).cast("array<string>").alias("top_separators"),
        "high_missing_count",
        "constant_count",
        "keep_review_priority_count",
    )


def bundle(sections: Mapping[str, DataFrame], single: tuple[str, ...] = ("overview", "feature_groups", "inspection_metrics")) -> DataFrame:
    """All sections in one JSON document: one row with column `value`."""
    parts = None
    for name, table in sections.items():
        # a section without rows is there too: no record, or an empty list of them
        none = "{}" if name in single else "[]"
        part = as_document(table, name in single).agg(F.coalesce(F.max("json"), F.lit(none)).alias("json")).select(F.lit(name).alias("name"), "json")
        parts = part if parts is None else parts.unionByName(part)
    # one short text per section, at most a few dozen
    entry = F.concat(F.lit('"'), F.col("name"), F.lit('":'), F.col("json"))
    ordered = F.array_sort(F.collect_list(entry))
    return parts.agg(F.concat(F.lit("{"), F.array_join(ordered, ","), F.lit("}")).alias("value"))


def write_document(document: DataFrame, path: str) -> None:
    document.select("value").coalesce(1).write.mode("overwrite").text(path)


def landing_summary(
    overview: DataFrame,
    actions: DataFrame,
    relationship: DataFrame,
    benchmark: DataFrame,
    fold_results: DataFrame,
    final_results: DataFrame,
    curve: DataFrame,
) -> DataFrame:
    """One row of nested totals for a landing page; field names are fixed values. All inputs are report tables."""
    action = F.col("recommended_action")
    names = ["keep", "drop_constant", "review_high_missing", "drop_all_null"]
    counts = actions.agg(
        F.struct(
            *[F.coalesce(F.sum(F.when(action == n, F.col("feature_count"))), F.lit(0)).cast("long").alias(n) for n in names]
        ).alias("s")
    )
    leaders = benchmark.orderBy(F.col("mean_pr_auc").desc_nulls_last(), "model", "feature_set").limit(5)
    leaders = leaders.select(F.struct("model", "feature_set", F.bround("mean_pr_auc", 4).alias("mean_pr_auc")).alias("s"))
    best = leaders.agg(F.sort_array(F.collect_list(F.struct(F.col("s.mean_pr_auc").alias("by"), "s")), asc=False)["s"])
    final = final_results.select(
        F.struct(
            *[F.coalesce(F.col(c), F.lit("-")).alias(c) for c in ("model", "feature_set")],
            *[
                F.coalesce(F.col(f"test_{m}"), F.lit(0.0)).alias(f"test_{m}")
                for m in ("pr_auc", "roc_auc", "precision", "recall", "f1")
            ],
        )
    ).limit(1)

    def point(rate: float):
        return curve_point(curve, rate).select(F.struct("recall", "precision", "lift", "captured_fails")).scalar()

    totals = ["entity_count", "feature_count", "pass_count", "fail_count", "pass_pct", "fail_pct"]
    stamps = [F.col(c).cast("string").alias(c) for c in ("min_timestamp", "max_timestamp")]
    return overview.select(
        F.struct(*totals, *stamps).alias("overview"),
        (F.col("entity_count") * F.col("feature_count")).alias("signal_rows"),
        relationship.agg(F.count("*")).scalar().alias("ranked_separator_count"),
        counts.scalar().alias("feature_actions"),
        F.struct(
            benchmark.agg(F.count("*")).scalar().alias("model_configs"),
            fold_results.agg(F.count("*")).scalar().alias("cv_rows"),
        ).alias("benchmark_scale"),
        final.scalar().alias("final_model"),
        best.scalar().alias("top_models_by_pr_auc"),
        F.struct(point(0.05).alias("top_05"), point(0.10).alias("top_10"), point(0.20).alias("top_20")).alias(
            "inspection_policy"
        ),
    )


def landing_document(summary: DataFrame) -> DataFrame:
    return as_document(summary, single=True).select(F.col("json").alias("value"))
