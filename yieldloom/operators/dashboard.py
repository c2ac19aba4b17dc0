"""Small reports over the result tables: searches, pages, histograms, comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yieldloom.operators.separation import by_effect


def percent(c: str):
    """A fraction as percent with two decimals."""
    return F.round(F.col(c) * 100, 2)


def display_catalog(catalog: DataFrame) -> DataFrame:
    """The catalog with missingness in percent and moments cut to two decimals."""
    return catalog.select(
        "feature_ordinal",
        "feature_name",
        "null_count",
        percent("null_pct").alias("null_pct"),
        "distinct_count",
        *[F.round(c, 2).alias(c) for c in ("mean", "stddev", "min_value", "max_value")],
        "is_constant",
        "is_high_missing",
        "recommended_action",
    )


def search_catalog(
    catalog: DataFrame, text: str = "", action: str = "all", high_missing_only: bool = False, constant_only: bool = False
) -> DataFrame:
    """Features whose name contains `text` in any case, with optional action and flag filters."""
    found = catalog.where(F.contains(F.lower("feature_name"), F.lit(text.lower())))
    if action != "all":
        found = found.where(F.col("recommended_action") == action)
    if high_missing_only:
        found = found.where("is_high_missing")
    if constant_only:
        found = found.where("is_constant")
    return found


def page(df: DataFrame, number: int, size: int = 25, order=("feature_ordinal",)) -> DataFrame:
    """Page `number`, counted from 1."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def most_missing(catalog: DataFrame, n: int = 20) -> DataFrame:
    return catalog.orderBy(F.col("null_pct").desc(), "feature_ordinal").limit(n)


# fixed values: labels and upper bounds (percent, inclusive) of the missingness histogram
NULL_BINS = [("0%", 0), ("0-10%", 10), ("10-25%", 25), ("25-50%", 50), ("50-75%", 75), ("75-100%", 100)]


def null_share_histogram(catalog: DataFrame) -> DataFrame:
    """Features per missingness bin; bins without features are kept."""
    share = percent("null_pct")
    label = F.lit(NULL_BINS[-1][0])
    for name, upper in reversed(NULL_BINS[:-1]):
        label = F.when(share <= upper, name).otherwise(label)
    counts = catalog.groupBy(label.alias("label")).agg(F.count("*").alias("n"))
    bins = F.array(*[F.struct(F.lit(i).alias("bin"), F.lit(name).alias("label")) for i, (name, _) in enumerate(NULL_BINS)])
    grid = catalog.sparkSession.range(0, 1, 1, 1).select(F.inline(bins))
    return grid.join(counts, "label", "left").select(
        "bin", "label", F.coalesce("n", F.lit(0)).cast("long").alias("count")
    )


def search_ranking(relationship: DataFrame, text: str = "", descending: bool = True) -> DataFrame:
    """The ranking filtered by name, strongest or weakest effect first."""
    found = relationship.where(F.contains(F.lower("feature_name"), F.lit(text.lower())))
    order = by_effect() if descending else (F.col("effect_size").asc_nulls_first(), F.col("feature_ordinal"))
    return found.orderBy(*order)


def profile_pivot(profiles: DataFrame, feature: str) -> DataFrame:
    """Min, quartiles and max of one feature with passes and fails side by side."""
    stats = ["min", "p25", "median", "p75", "max"]
    rows = profiles.where(F.col("feature_name") == feature).select("yield_class", *stats)
    long = rows.unpivot("yield_class", stats, "stat", "value")
    return long.groupBy("stat").pivot("yield_class", ["pass", "fail"]).agg(F.max("value"))


def medium_plus_count(relationship: DataFrame, effect: float = 0.5) -> DataFrame:
    """How many features reach an effect size."""
    return relationship.agg(F.count_if(F.col("effect_size") >= F.lit(effect)).alias("medium_plus_count"))


def filter_benchmark(
    benchmark: DataFrame,
    family: str = "all",
    feature_set: str = "all",
    kind: str = "all",
    final_eligible_only: bool = False,
) -> DataFrame:
    found = benchmark
    for column, wanted in (("model_family", family), ("feature_set", feature_set), ("model_kind", kind)):
        if wanted != "all":
            found = found.where(F.col(column) == wanted)
    return found.where("final_eligible") if final_eligible_only else found


def choices(benchmark: DataFrame, column: str) -> DataFrame:
    """Distinct values of a benchmark column."""
    return benchmark.select(column).distinct()


def _bests(benchmark: DataFrame, key: str) -> DataFrame:
    on = F.col("enabled")
    return benchmark.groupBy(key).agg(
        F.count_if(on).alias("configs"),
        F.coalesce(F.max(F.when(on, F.col("mean_pr_auc"))), F.lit(0.0)).alias("best_pr_auc"),
        F.coalesce(F.max(F.when(on, F.col("mean_recall_at_10pct"))), F.lit(0.0)).alias("best_recall_at_10pct"),
    )


def family_summary(benchmark: DataFrame) -> DataFrame:
    """Enabled configurations and best PR AUC per model family."""
    return _bests(benchmark, "model_family").select("model_family", "configs", "best_pr_auc")


def supervised_vs_anomaly(benchmark: DataFrame) -> DataFrame:
    """Best PR AUC and recall at 10 percent per model kind."""
    return _bests(benchmark, "model_kind").select("model_kind", "best_pr_auc", "best_recall_at_10pct")


def feature_set_leaders(benchmark: DataFrame) -> DataFrame:
    return _bests(benchmark, "feature_set")


def top_configs(benchmark: DataFrame, n: int = 5) -> DataFrame:
    return benchmark.orderBy(F.col("mean_pr_auc").desc_nulls_last(), "model", "feature_set").limit(n).select(
        "model", "feature_set", "mean_pr_auc"
    )


def improvement_check(benchmark: DataFrame, model: str = "random_forest", feature_set: str = "keep_only") -> DataFrame:
    """Does the best configuration, and the best anomaly detector, beat a named baseline?"""
    pr = F.col("mean_pr_auc")
    is_base = (F.col("model") == model) & (F.col("feature_set") == feature_set)
    row = benchmark.agg(
        F.max(F.when(is_base, pr)).alias("baseline_pr_auc"),
        F.max(pr).alias("best_pr_auc"),
        F.max(F.when(F.col("model_kind") == "anomaly_detector", pr)).alias("best_anomaly_pr_auc"),
    )

    def beats(c: str):
        return F.coalesce(F.col(c) > F.col("baseline_pr_auc"), F.lit(False))

    return row.withColumn("improved", beats("best_pr_auc")).withColumn("anomaly_improved", beats("best_anomaly_pr_auc"))


def thin_curve(curve: DataFrame, step: int = 5) -> DataFrame:
    """Every `step`-th point of the threshold curve, starting with the first."""
    place = F.row_number().over(Window.orderBy("threshold"))
    return curve.withColumn("place", place).where((F.col("place") - 1) % step == 0).drop("place")


def top_importances(importance: DataFrame, n: int = 20) -> DataFrame:
    return importance.orderBy(F.col("importance").desc(), "feature_name").limit(n)


