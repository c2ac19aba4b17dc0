"""Queries over the separation operators."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from yieldloom.operators import dashboard, separation
from yieldloom.operators.profile import feature_catalog
from yieldloom.plans.registry import PRIORITY, PROFILES, RANKING, query
from yieldloom.recipes import lot_entities

SEPARATION_DOUBLES = "pass_mean fail_mean pass_stddev fail_stddev effect_size"


@query("signal_separation", f"WITH {RANKING} SELECT * FROM sep", SEPARATION_DOUBLES)
def _(spark, sf_dir):
    return separation.signal_separation(lot_entities(spark, sf_dir))


@query("signal_separation_with_catalog", f"WITH {RANKING} SELECT * FROM sep", SEPARATION_DOUBLES)
def _(spark, sf_dir):
    lots = lot_entities(spark, sf_dir)
    return separation.signal_separation(lots, catalog=feature_catalog(lots))


@query("feature_failure_relationship", f"WITH {RANKING} SELECT * FROM rel", "effect_size pass_mean fail_mean mean_gap")
def _(spark, sf_dir):
    return separation.failure_relationship(lot_entities(spark, sf_dir))


@query(
    "feature_failure_relationship_with_lookups",
    f"WITH {RANKING} SELECT * FROM rel",
    "effect_size pass_mean fail_mean mean_gap",
)
def _(spark, sf_dir):
    lots = lot_entities(spark, sf_dir)
    stats = separation.class_stats(lots)
    return separation.relationship_of(stats, feature_catalog(lots), separation.separation_of(stats))


@query("signal_profiles", f"WITH {PROFILES} SELECT * FROM prof", "mean stddev min p25 median p75 max")
def _(spark, sf_dir):
    lots = lot_entities(spark, sf_dir)
    return separation.signal_profiles(lots, separation.signal_separation(lots), top_n=3)


@query(
    "top_features_by_effect",
    f"""WITH {RANKING} SELECT feature_ordinal, feature_name, pass_count, fail_count, pass_mean, fail_mean, pass_stddev, fail_stddev,
        effect_size FROM sep ORDER BY effect_size DESC NULLS LAST, feature_ordinal LIMIT 3""",
    SEPARATION_DOUBLES,
)
def _(spark, sf_dir):
    return separation.signal_separation(lot_entities(spark, sf_dir)).limit(3)


@query(
    "feature_groups",
    f"""WITH {RANKING}, top AS (SELECT feature_name, row_number() OVER (ORDER BY effect_size DESC NULLS LAST, feature_ordinal) AS rnk FROM rel),
        placed AS (
          SELECT 'top_separators' AS group_name, c.feature_name, t.rnk AS place FROM cat c JOIN top t ON c.feature_name = t.feature_name AND t.rnk <= 2
          UNION ALL
          SELECT CASE recommended_action WHEN 'review_high_missing' THEN 'review_high_missing' WHEN 'keep' THEN 'standard_keep'
                 WHEN 'drop_constant' THEN 'excluded_constant' ELSE 'excluded_all_null' END, feature_name, feature_ordinal
          FROM cat WHERE feature_name NOT IN (SELECT feature_name FROM top WHERE rnk <= 2)),
        texts AS (SELECT * FROM (VALUES ('top_separators', 'Top 2 features by effect size'),
          ('review_high_missing', 'High missingness (>=50% null)'), ('standard_keep', 'Standard keep (not in top separators)'),
          ('excluded_constant', 'Excluded due to constant values'), ('excluded_all_null', 'Excluded due to 100% missing values')) v(group_name, description))
        SELECT t.group_name, count(p.feature_name) AS "count", any_value(t.description) AS description,
               coalesce(array_to_string(list(p.feature_name ORDER BY p.place) FILTER (p.feature_name IS NOT NULL)[1:5], ', '), '') AS example_features
        FROM texts t LEFT JOIN placed p USING (group_name) GROUP BY t.group_name""",
)
def _(spark, sf_dir):
    lots = lot_entities(spark, sf_dir)
    return separation.feature_groups(feature_catalog(lots), separation.failure_relationship(lots), top_n=2)


@query("feature_priority_index", f"WITH {PRIORITY} SELECT * FROM prio", "null_pct effect_size")
def _(spark, sf_dir):
    lots = lot_entities(spark, sf_dir)
    return separation.feature_priority_index(feature_catalog(lots), separation.signal_separation(lots))


@query(
    "priority_bucket_rollup",
    f"""WITH {PRIORITY} SELECT priority_bucket AS bucket_name, count(*) AS feature_count,
        string_agg(feature_name, ',' ORDER BY feature_name) AS features FROM prio GROUP BY 1""",
)
def _(spark, sf_dir):
    lots = lot_entities(spark, sf_dir)
    priority = separation.feature_priority_index(feature_catalog(lots), separation.signal_separation(lots))
    return separation.bucket_rollup(priority).selectExpr(
        "bucket_name", "feature_count", "concat_ws(',', features) AS features"
    )


@query(
    "priority_bucket_totals",
    f"""WITH {PRIORITY} SELECT count(*) FILTER (priority_bucket = 'review_high_missing') AS high_missing_count,
        count(*) FILTER (priority_bucket = 'excluded_constant') AS constant_count,
        count(*) FILTER (priority_bucket IN ('standard_keep', 'review_high_missing', 'top_separator')) AS keep_review_priority_count FROM prio""",
)
def _(spark, sf_dir):
    lots = lot_entities(spark, sf_dir)
    priority = separation.feature_priority_index(feature_catalog(lots), separation.signal_separation(lots))
    return separation.bucket_totals(priority)


@query("median_effect_size", f"WITH {RANKING} SELECT quantile_cont(effect_size, 0.5) AS median_effect_size FROM sep", "median_effect_size")
def _(spark, sf_dir):
    return separation.signal_separation(lot_entities(spark, sf_dir)).selectExpr("median(effect_size) AS median_effect_size")


@query(
    "signal_shortlist",
    f"""WITH {RANKING}, ranked AS (
          SELECT feature_name, effect_size, CAST(row_number() OVER (ORDER BY effect_size DESC NULLS LAST, feature_ordinal) AS INTEGER) AS effect_rank FROM sep)
        SELECT c.feature_name, coalesce(r.effect_rank, 9999) AS effect_rank, coalesce(r.effect_size, 0.0) AS effect_size,
               coalesce(c.null_pct, 0.0) AS null_pct, c.recommended_action
        FROM cat c LEFT JOIN ranked r USING (feature_name)""",
    "effect_size null_pct",
)
def _(spark, sf_dir):
    lots = lot_entities(spark, sf_dir)
    catalog = feature_catalog(lots)
    return separation.signal_shortlist(catalog, separation.signal_separation(lots), catalog)


@query(
    "top_importances",
    f"""WITH {RANKING} SELECT feature_name, effect_size AS importance, CAST(row_number() OVER (ORDER BY effect_size DESC, feature_name) AS INTEGER) AS place
        FROM sep QUALIFY place <= 2""",
    "importance",
)
def _(spark, sf_dir):
    """The effect sizes as importances of the features, the first two."""
    ranking = separation.signal_separation(lot_entities(spark, sf_dir)).where(F.col("effect_size").isNotNull())
    top = dashboard.top_importances(ranking.select("feature_name", F.col("effect_size").alias("importance")), 2)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("importance"), "feature_name")))
