"""Calendar-day yield rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yieldloom.functions import ratio_or_zero
from yieldloom.spec import DEFAULT_SPEC, EntitySpec


def _daily_counts(df: DataFrame, spec: EntitySpec) -> DataFrame:
    dated = df.select(spec.date().alias("event_date"), spec.id, spec.label).where(F.col("event_date").isNotNull())
    return dated.groupBy("event_date").agg(
        F.count(spec.id).alias("entity_count"),
        F.count_if(spec.passed()).alias("pass_count"),
        F.count_if(spec.failed()).alias("fail_count"),
    )


def daily_yield_trend(df: DataFrame, spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    """Entities, passes, fails and their rates per calendar day."""
    daily = _daily_counts(df, spec)
    return daily.select(
        "event_date",
        "entity_count",
        "pass_count",
        "fail_count",
        ratio_or_zero(F.col("pass_count"), F.col("entity_count")).alias("pass_rate"),
        ratio_or_zero(F.col("fail_count"), F.col("entity_count")).alias("fail_rate"),
    )


def daily_failure_rollup(df: DataFrame, spec: EntitySpec = DEFAULT_SPEC, window: int = 7) -> DataFrame:
    """Daily fail rate and its mean over the last `window` observed days (days without rows do not count).

    The ordered window sees one row per calendar day, never entity rows.
    """
    trend = daily_yield_trend(df, spec).select("event_date", "entity_count", "fail_count", "fail_rate")
    last_days = Window.orderBy("event_date").rowsBetween(1 - window, 0)
    return trend.withColumn("rolling_7d_fail_rate", F.avg("fail_rate").over(last_days))


def with_pass_count(daily: DataFrame) -> DataFrame:
    """Passes as the rest of the day's entities."""
    return daily.withColumn("pass_count", F.col("entity_count") - F.col("fail_count"))


def daily_stats(daily: DataFrame) -> DataFrame:
    """Number of days, daily volumes, and the unweighted mean of the daily fail rates in percent."""
    agg = daily.agg(
        F.count("*").alias("total_days"),
        F.coalesce(F.floor(F.avg("entity_count") + F.lit(0.5)), F.lit(0)).cast("long").alias("avg_daily_volume"),
        F.coalesce(F.avg(F.round(F.col("fail_rate") * 100, 2)), F.lit(0.0)).alias("avg_fail_rate_pct"),
        F.coalesce(F.max("entity_count"), F.lit(0)).cast("long").alias("max_daily_volume"),
        F.coalesce(F.min("entity_count"), F.lit(0)).cast("long").alias("min_daily_volume"),
    )
    return agg.withColumn("avg_fail_rate_pct", F.round("avg_fail_rate_pct", 2))
