"""Feature profiling: catalog, recommended actions, coverage, missingness, dataset overview."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldloom.functions import ratio_or_zero
from yieldloom.operators.longform import feature_rows, values
from yieldloom.spec import DEFAULT_SPEC, EntitySpec

HIGH_MISSING = 0.5

CATALOG_COLUMNS = [
    "feature_ordinal",
    "feature_name",
    "null_count",
    "null_pct",
    "distinct_count",
    "mean",
    "stddev",
    "min_value",
    "max_value",
    "is_constant",
    "is_high_missing",
    "recommended_action",
]


def feature_catalog(df: DataFrame, spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    """One row per feature: missingness, distinct values, moments, range, flags and action.

    A single pass. Spark plans the one distinct aggregate as (feature, value) pre-aggregation, so a
    value that fills a third of a column is one row per task before the shuffle, and the final
    per-feature merge sees only partial counts.
    """
    features = spec.measured(df)
    stats = (
        values(df, features)
        .groupBy("ordinal")
        .agg(
            F.count("*").alias("row_count"),
            F.count("value").alias("value_count"),
            F.count_distinct("value").alias("distinct_count"),
            F.avg("value").alias("mean"),
            F.stddev_pop("value").alias("stddev"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
        )
    )
    # left from the column list, so a table without rows still lists its features
    rows = feature_rows(df, features).join(
        stats.withColumnRenamed("ordinal", "feature_ordinal"), "feature_ordinal", "left"
    )
    rows = (
        rows.withColumn("row_count", F.coalesce("row_count", F.lit(0).cast("long")))
        .withColumn("value_count", F.coalesce("value_count", F.lit(0).cast("long")))
        .withColumn("distinct_count", F.coalesce("distinct_count", F.lit(0).cast("long")))
        .withColumn("null_count", F.col("row_count") - F.col("value_count"))
        .withColumn("null_pct", ratio_or_zero(F.col("null_count"), F.col("row_count")))
        .withColumn("is_constant", is_constant())
        .withColumn("is_high_missing", is_high_missing())
        .withColumn("recommended_action", recommended_action(F.col("value_count")))
    )
    return rows.select(*CATALOG_COLUMNS)


def is_constant() -> Column:
    """At most one distinct value; all-missing features count as constant too."""
    return F.col("distinct_count") <= 1


def is_high_missing() -> Column:
    return F.col("null_pct") >= F.lit(HIGH_MISSING)


def recommended_action(value_count: Column) -> Column:
    """First rule that applies, strongest reason to drop first."""
    return (
        F.when(value_count == 0, "drop_all_null")
        .when(is_constant(), "drop_constant")
        .when(is_high_missing(), "review_high_missing")
        .otherwise("keep")
    )


def feature_missingness(catalog: DataFrame) -> DataFrame:
    """The catalog's missingness columns, most missing first."""
    return catalog.orderBy(F.col("null_pct").desc(), "feature_ordinal").select(
        "feature_name",
        "null_count",
        "null_pct",
        "distinct_count",
        "is_constant",
        "is_high_missing",
        "recommended_action",
    )


def feature_action_summary(catalog: DataFrame) -> DataFrame:
    """Features and share of all features per recommended action."""
    counts = catalog.groupBy("recommended_action").agg(F.count("*").alias("feature_count"))
    total = counts.agg(F.sum("feature_count")).scalar()
    return counts.withColumn("feature_pct", ratio_or_zero(F.col("feature_count"), total))


# fixed values: metric names and texts of the coverage report
COVERAGE_METRICS = [
    ("total_features", "All profiled features"),
    ("complete_features", "0% missing values"),
    ("sparse_features", ">0% missing values"),
    ("usable_features", "Recommended to keep"),
    ("review_features", "High missingness review"),
    ("high_missing_features", "Missingness >= 50%"),
    ("constant_features", "Constant-valued features"),
    ("all_null_features", "100% missing values"),
]


def feature_coverage_summary(catalog: DataFrame) -> DataFrame:
    """Eight named feature counts as rows: one aggregate, then a stack of its columns."""
    action = F.col("recommended_action")
    conditions = {
        "total_features": F.lit(True),
        "complete_features": F.col("null_pct") == 0,
        "sparse_features": F.col("null_pct") > 0,
        "usable_features": action == "keep",
        "review_features": action == "review_high_missing",
        "high_missing_features": is_high_missing(),
        "constant_features": F.col("is_constant"),
        "all_null_features": action == "drop_all_null",
    }
    counts = catalog.agg(*[F.count_if(cond).alias(name) for name, cond in conditions.items()])
    cells = [x for name, text in COVERAGE_METRICS for x in (F.lit(name), F.col(name), F.lit(text))]
    return counts.select(F.stack(F.lit(len(COVERAGE_METRICS)), *cells).alias("metric", "count", "description"))


def feature_coverage(catalog: DataFrame, entity_count: int | Column) -> DataFrame:
    """Per-feature coverage for export: how many entities have a value."""
    total = entity_count if isinstance(entity_count, Column) else F.lit(entity_count)
    return catalog.select(
        "feature_name",
        "null_pct",
        (total - F.col("null_count")).alias("non_null_count"),
        "distinct_count",
        "recommended_action",
    )


def overview(df: DataFrame, spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    """One row of dataset totals. Reads the label and time columns only."""
    totals = df.agg(
        F.count("*").alias("entity_count"),
        F.lit(len(spec.prefixed(df))).alias("feature_count"),
        F.count_if(spec.passed()).alias("pass_count"),
        F.count_if(spec.failed()).alias("fail_count"),
        F.min(spec.ts).alias("min_timestamp"),
        F.max(spec.ts).alias("max_timestamp"),
    )
    return totals.select(
        "entity_count",
        "feature_count",
        "pass_count",
        "fail_count",
        ratio_or_zero(F.col("pass_count"), F.col("entity_count")).alias("pass_pct"),
        ratio_or_zero(F.col("fail_count"), F.col("entity_count")).alias("fail_pct"),
        "min_timestamp",
        "max_timestamp",
    )


def label_distribution(df: DataFrame, spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    """Entities and share per label. Unlabelled entities count in the total but form no row."""
    counts = df.groupBy(spec.label, spec.outcome).agg(F.count("*").alias("entity_count"))
    total = counts.agg(F.sum("entity_count")).scalar()
    shares = counts.withColumn("entity_pct", ratio_or_zero(F.col("entity_count"), total))
    return shares.where(F.col(spec.label).isNotNull() & F.col(spec.outcome).isNotNull())
