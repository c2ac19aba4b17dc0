"""Queries over the profiling operators."""

from pyspark.sql import functions as F

from yieldloom.operators import profile
from yieldloom.operators.longform import signal_values_long
from yieldloom.plans.registry import CATALOG, LONG, LOTS, query
from yieldloom.recipes import lot_entities, sensor_entities

CATALOG_DOUBLES = "null_pct mean stddev min_value max_value"


@query(
    "signal_values_long",
    f"WITH {LONG} SELECT entity_id, test_timestamp, yield_label, feature_name, v AS feature_value, v IS NULL AS is_missing FROM long",
    "feature_value",
)
def _(spark, sf_dir):
    return signal_values_long(lot_entities(spark, sf_dir))


@query("feature_catalog", f"WITH {CATALOG} SELECT * FROM cat", CATALOG_DOUBLES)
def _(spark, sf_dir):
    return profile.feature_catalog(lot_entities(spark, sf_dir))


@query(
    "sensor_feature_catalog",
    """WITH sl AS (SELECT unnest(range(64)) AS o, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
       SELECT CAST(o AS INTEGER) AS feature_ordinal, 'feature_' || lpad(CAST(o + 1 AS VARCHAR), 3, '0') AS feature_name,
              count(*) - count(v) AS null_count, (count(*) - count(v)) / CAST(count(*) AS DOUBLE) AS null_pct,
              count(DISTINCT v) AS distinct_count, avg(v) AS mean, stddev_pop(v) AS stddev, min(v) AS min_value, max(v) AS max_value,
              count(DISTINCT v) <= 1 AS is_constant, count(v) * 2 <= count(*) AS is_high_missing, 'keep' AS recommended_action
       FROM sl GROUP BY o""",
    CATALOG_DOUBLES,
)
def _(spark, sf_dir):
    return profile.feature_catalog(sensor_entities(spark, sf_dir))


@query(
    "feature_missingness",
    f"""WITH {CATALOG} SELECT feature_name, null_count, null_pct, distinct_count, is_constant, is_high_missing, recommended_action FROM cat""",
    "null_pct",
)
def _(spark, sf_dir):
    return profile.feature_missingness(profile.feature_catalog(lot_entities(spark, sf_dir)))


@query(
    "feature_action_summary",
    f"""WITH {CATALOG} SELECT recommended_action, count(*) AS feature_count,
        count(*) / CAST((SELECT count(*) FROM cat) AS DOUBLE) AS feature_pct FROM cat GROUP BY 1""",
    "feature_pct",
)
def _(spark, sf_dir):
    return profile.feature_action_summary(profile.feature_catalog(lot_entities(spark, sf_dir)))


@query(
    "feature_coverage_summary",
    f"""WITH {CATALOG}
        SELECT 'total_features' AS metric, count(*) AS "count", 'All profiled features' AS description FROM cat
        UNION ALL SELECT 'complete_features', count(*) FILTER (null_pct = 0), '0% missing values' FROM cat
        UNION ALL SELECT 'sparse_features', count(*) FILTER (null_pct > 0), '>0% missing values' FROM cat
        UNION ALL SELECT 'usable_features', count(*) FILTER (recommended_action = 'keep'), 'Recommended to keep' FROM cat
        UNION ALL SELECT 'review_features', count(*) FILTER (recommended_action = 'review_high_missing'), 'High missingness review' FROM cat
        UNION ALL SELECT 'high_missing_features', count(*) FILTER (null_pct >= 0.5), 'Missingness >= 50%' FROM cat
        UNION ALL SELECT 'constant_features', count(*) FILTER (is_constant), 'Constant-valued features' FROM cat
        UNION ALL SELECT 'all_null_features', count(*) FILTER (recommended_action = 'drop_all_null'), '100% missing values' FROM cat""",
)
def _(spark, sf_dir):
    return profile.feature_coverage_summary(profile.feature_catalog(lot_entities(spark, sf_dir)))


@query(
    "feature_coverage",
    f"""WITH {CATALOG} SELECT feature_name, null_pct, (SELECT count(*) FROM lots) - null_count AS non_null_count, distinct_count,
        recommended_action FROM cat""",
    "null_pct",
)
def _(spark, sf_dir):
    lots = lot_entities(spark, sf_dir)
    return profile.feature_coverage(profile.feature_catalog(lots), lots.agg(F.count("*")).scalar())


@query(
    "overview",
    f"""WITH {LOTS} SELECT count(*) AS entity_count, CAST(7 AS INTEGER) AS feature_count,
        count(*) FILTER (yield_label = -1) AS pass_count, count(*) FILTER (yield_label = 1) AS fail_count,
        count(*) FILTER (yield_label = -1) / CAST(count(*) AS DOUBLE) AS pass_pct,
        count(*) FILTER (yield_label = 1) / CAST(count(*) AS DOUBLE) AS fail_pct,
        min(test_timestamp) AS min_timestamp, max(test_timestamp) AS max_timestamp FROM lots""",
    "pass_pct fail_pct",
)
def _(spark, sf_dir):
    return profile.overview(lot_entities(spark, sf_dir))


@query(
    "label_distribution",
    f"""WITH {LOTS} SELECT yield_label, pass_fail, count(*) AS entity_count,
        count(*) / CAST((SELECT count(*) FROM lots) AS DOUBLE) AS entity_pct FROM lots GROUP BY 1, 2""",
    "entity_pct",
)
def _(spark, sf_dir):
    return profile.label_distribution(lot_entities(spark, sf_dir))
