"""How far each feature separates passes from fails, and what follows from that ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yieldloom.operators.longform import feature_name, feature_rows, values
from yieldloom.operators.ranking import exact_quantiles, ranges_for
from yieldloom.spec import DEFAULT_SPEC, EntitySpec


def class_stats(df: DataFrame, spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    """Per feature: counts, means and population deviations of the two classes, and the overall range.

    One pass with map-side partial aggregates; the shuffle carries one row per feature and task. The range
    tells constant features apart exactly, so no distinct count is needed here.
    """
    features = spec.measured(df)
    fail_value = F.when(spec.failed(), F.col("value"))
    pass_value = F.when(spec.passed(), F.col("value"))
    stats = (
        values(df, features, keep=[spec.label])
        .groupBy("ordinal")
        .agg(
            F.count(pass_value).alias("pass_count"),
            F.count(fail_value).alias("fail_count"),
            F.avg(pass_value).alias("pass_mean"),
            F.avg(fail_value).alias("fail_mean"),
            F.stddev_pop(pass_value).alias("pass_stddev"),
            F.stddev_pop(fail_value).alias("fail_stddev"),
            F.coalesce(F.min("value") < F.max("value"), F.lit(False)).alias("is_valid"),
        )
    )
    spread = F.sqrt((F.pow("pass_stddev", F.lit(2)) + F.pow("fail_stddev", F.lit(2))) / 2)
    gap = F.abs(F.col("pass_mean") - F.col("fail_mean"))
    return (
        stats.withColumn("feature_name", feature_name(features))
        .withColumnRenamed("ordinal", "feature_ordinal")
        .withColumn("mean_gap", gap)
        .withColumn("effect_size", F.try_divide(gap, spread))
    )


def signal_separation(df: DataFrame, spec: EntitySpec = DEFAULT_SPEC, catalog: DataFrame | None = None) -> DataFrame:
    """Effect size |mean gap| / sqrt(mean of variances) per feature, largest first.

    Needs a value in both classes; constant and all-missing features are left out, by the given catalog
    (anti join) or, without one, by the range seen in the same pass.
    """
    ranked = separation_of(class_stats(df, spec), catalog)
    return ranked.orderBy(*by_effect())


def separation_of(stats: DataFrame, catalog: DataFrame | None = None) -> DataFrame:
    kept = stats.where((F.col("pass_count") > 0) & (F.col("fail_count") > 0))
    if catalog is None:
        kept = kept.where("is_valid")
    else:
        kept = kept.join(catalog.where(excluded()).select("feature_name"), "feature_name", "left_anti")
    return kept.select(
        "feature_ordinal",
        "feature_name",
        "pass_count",
        "fail_count",
        "pass_mean",
        "fail_mean",
        "pass_stddev",
        "fail_stddev",
        "effect_size",
    )


def excluded():
    """Catalog rows that cannot separate anything. All-missing features are constant by definition."""
    return F.col("is_constant")


def by_effect():
    """Largest effect first, undefined last, equal effects in column order."""
    return F.col("effect_size").desc_nulls_last(), F.col("feature_ordinal")


def failure_relationship(df: DataFrame, spec: EntitySpec = DEFAULT_SPEC, catalog: DataFrame | None = None) -> DataFrame:
    """Every non-constant feature with its effect size, class means, mean gap and class counts."""
    return relationship_of(class_stats(df, spec), catalog).orderBy(*by_effect())


def relationship_of(stats: DataFrame, catalog: DataFrame | None = None, ranking: DataFrame | None = None) -> DataFrame:
    if catalog is None:
        valid = stats.where("is_valid")
    else:
        valid = stats.join(catalog.where(~excluded()).select("feature_name"), "feature_name", "left_semi")
    if ranking is not None:
        effects = ranking.select("feature_name", "effect_size")
        valid = valid.drop("effect_size").join(effects, "feature_name", "left")
    return valid.select(
        "feature_ordinal",
        "feature_name",
        "effect_size",
        "pass_mean",
        "fail_mean",
        "mean_gap",
        F.col("pass_count").alias("valid_pass_count"),
        F.col("fail_count").alias("valid_fail_count"),
    )


def top_features(ranking: DataFrame, n: int) -> list[str]:
    """Names of the n strongest features. n rows reach the driver, so that scans can read n columns only."""
    return [r.feature_name for r in ranking.orderBy(*by_effect()).select("feature_name").limit(n).collect()]


def signal_profiles(df: DataFrame, ranking: DataFrame, top_n: int = 20, spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    """Five-number summary and moments of the top features, per class.

    The scan reads the chosen columns and the label. Quantiles are exact and interpolated.
    """
    names = top_features(ranking, top_n)
    classes = F.when(spec.failed(), "fail").when(spec.passed(), "pass")
    long = values(df.withColumn("yield_class", classes).where(F.col("yield_class").isNotNull()), names, ["yield_class"])
    keys = ["ordinal", "yield_class"]
    moments = long.groupBy(*keys).agg(
        F.count("value").alias("count"),
        F.count_if(F.col("value").isNull()).alias("missing_count"),
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("stddev"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    probs = {"p25": 0.25, "median": 0.5, "p75": 0.75}
    ranges = ranges_for(df.sparkSession, 2 * len(names))
    quartiles = exact_quantiles(long, keys, "value", probs, ranges, few_groups=True)
    grid = feature_rows(df, names).select(
        F.col("feature_ordinal").alias("ordinal"),
        "feature_name",
        F.explode(F.array(F.lit("pass"), F.lit("fail"))).alias("yield_class"),
    )
    filled = grid.join(moments, keys, "left").join(quartiles, keys, "left")
    return filled.select(
        "feature_name",
        "yield_class",
        F.coalesce("count", F.lit(0)).cast("long").alias("count"),
        F.coalesce("missing_count", F.lit(0)).cast("long").alias("missing_count"),
        "mean",
        "stddev",
        "min",
        "p25",
        "median",
        "p75",
        "max",
    )


# fixed values: groups and texts of the feature group report
GROUP_TEXTS = [
    ("top_separators", "Top {n} features by effect size"),
    ("review_high_missing", "High missingness (>=50% null)"),
    ("standard_keep", "Standard keep (not in top separators)"),
    ("excluded_constant", "Excluded due to constant values"),
    ("excluded_all_null", "Excluded due to 100% missing values"),
]


def feature_groups(catalog: DataFrame, ranking: DataFrame, top_n: int = 20, examples: int = 5) -> DataFrame:
    """Five fixed groups with size and first examples: top features by rank, the others in column order."""
    top = effect_ranks(ranking).where(F.col("effect_rank") <= top_n).select("feature_name", "effect_rank")
    in_top = catalog.join(top, "feature_name", "left_semi").select(
        F.lit("top_separators").alias("group_name"), "feature_name"
    )
    action = F.col("recommended_action")
    rest = catalog.join(top, "feature_name", "left_anti").select(
        F.when(action == "review_high_missing", "review_high_missing")
        .when(action == "keep", "standard_keep")
        .when(action == "drop_constant", "excluded_constant")
        .when(action == "drop_all_null", "excluded_all_null")
        .alias("group_name"),
        "feature_name",
        "feature_ordinal",
    )
    # at most one entry per column of the source table in each list
    ordered = in_top.join(top, "feature_name").select("group_name", F.col("effect_rank").alias("place"), "feature_name")
    ordered = ordered.unionByName(rest.select("group_name", F.col("feature_ordinal").alias("place"), "feature_name"))
    grouped = ordered.groupBy("group_name").agg(
        F.count("*").alias("count"),
        F.slice(F.array_sort(F.collect_list(F.struct("place", "feature_name"))), 1, examples).alias("firsts"),
    )
    texts = catalog.sparkSession.createDataFrame(
        [(name, text.format(n=top_n)) for name, text in GROUP_TEXTS], "group_name string, description string"
    )
    return texts.join(grouped, "group_name", "left").select(
        "group_name",
        F.coalesce("count", F.lit(0)).cast("long").alias("count"),
        "description",
        F.coalesce(F.concat_ws(", ", F.col("firsts.feature_name")), F.lit("")).alias("example_features"),
    )


def effect_ranks(ranking: DataFrame) -> DataFrame:
    """Effect rank 1..n over the ranking, which has one row per column of the source table."""
    return ranking.withColumn("effect_rank", F.row_number().over(Window.orderBy(*by_effect())))


def feature_priority_index(catalog: DataFrame, ranking: DataFrame) -> DataFrame:
    """One bucket per feature; a top separator reaches at least the median effect of the ranked features."""
    median_effect = ranking.agg(F.median("effect_size")).scalar()
    joined = catalog.join(ranking.select("feature_name", "effect_size"), "feature_name", "left")
    bucket = (
        F.when(F.col("recommended_action") == "drop_all_null", "excluded_all_null")
        .when(F.col("recommended_action") == "drop_constant", "excluded_constant")
        .when(F.col("null_pct") >= F.lit(0.5), "review_high_missing")
        .when(F.col("effect_size") >= median_effect, "top_separator")
        .otherwise("standard_keep")
    )
    return joined.select(
        "feature_name", "recommended_action", "null_pct", "effect_size", bucket.alias("priority_bucket")
    )


def bucket_rollup(priority: DataFrame) -> DataFrame:
    """Size and members per priority bucket, members in name order."""
    return priority.groupBy(F.col("priority_bucket").alias("bucket_name")).agg(
        F.count("*").alias("feature_count"), F.array_sort(F.collect_list("feature_name")).alias("features")
    )


def bucket_totals(priority: DataFrame) -> DataFrame:
    """The three counts shown next to the bucket rollup."""
    bucket = F.col("priority_bucket")
    return priority.agg(
        F.count_if(bucket == "review_high_missing").alias("high_missing_count"),
        F.count_if(bucket == "excluded_constant").alias("constant_count"),
        F.count_if(bucket.isin("standard_keep", "review_high_missing", "top_separator")).alias(
            "keep_review_priority_count"
        ),
    )


def signal_shortlist(selected: DataFrame, ranking: DataFrame, catalog: DataFrame) -> DataFrame:
    """Chosen features with rank and catalog facts; unranked ones get rank 9999 and effect 0."""
    ranks = effect_ranks(ranking).select("feature_name", "effect_rank", "effect_size")
    facts = catalog.select("feature_name", "null_pct", "recommended_action")
    joined = selected.select("feature_name").join(ranks, "feature_name", "left").join(facts, "feature_name", "left")
    return joined.select(
        "feature_name",
        F.coalesce("effect_rank", F.lit(9999)).alias("effect_rank"),
        F.coalesce("effect_size", F.lit(0.0)).alias("effect_size"),
        F.coalesce("null_pct", F.lit(0.0)).alias("null_pct"),
        F.coalesce("recommended_action", F.lit("unknown")).alias("recommended_action"),
    ).orderBy("effect_rank", "feature_name")
