"""Queries over the daily rollups."""

from yieldloom.operators import trends
from yieldloom.plans.registry import DAILY, query
from yieldloom.recipes import lot_entities


@query("daily_yield_trend", f"WITH {DAILY} SELECT * FROM days", "pass_rate fail_rate")
def _(spark, sf_dir):
    return trends.daily_yield_trend(lot_entities(spark, sf_dir))


@query(
    "daily_failure_rollup",
    f"""WITH {DAILY} SELECT event_date, entity_count, fail_count, fail_rate,
        avg(fail_rate) OVER (ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_7d_fail_rate FROM days""",
    "fail_rate rolling_7d_fail_rate",
)
def _(spark, sf_dir):
    return trends.daily_failure_rollup(lot_entities(spark, sf_dir))


@query(
    "daily_pass_count",
    f"""WITH {DAILY} SELECT event_date, entity_count, fail_count, fail_rate,
        avg(fail_rate) OVER (ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_7d_fail_rate,
        entity_count - fail_count AS pass_count FROM days""",
    "fail_rate rolling_7d_fail_rate",
)
def _(spark, sf_dir):
    return trends.with_pass_count(trends.daily_failure_rollup(lot_entities(spark, sf_dir)))


@query(
    "daily_stats",
    f"""WITH {DAILY} SELECT count(*) AS total_days, CAST(floor(avg(entity_count) + 0.5) AS BIGINT) AS avg_daily_volume,
        round(avg(round(fail_rate * 100, 2)), 2) AS avg_fail_rate_pct, max(entity_count) AS max_daily_volume,
        min(entity_count) AS min_daily_volume FROM days""",
    "avg_fail_rate_pct",
)
def _(spark, sf_dir):
    return trends.daily_stats(trends.daily_failure_rollup(lot_entities(spark, sf_dir)))
