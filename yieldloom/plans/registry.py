"""The registered queries: each Spark query next to the plain SQL it must agree with.

SQL texts start from the same derived tables as `yieldloom.recipes`. Doubles are rounded to six places on
both sides because the engines add in different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All double columns rounded; adding 0.0 turns -0.0 into 0.0."""
    return df.select(
        *[(F.round(F.col(f"`{c}`"), digits) + F.lit(0.0)).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes]
    )


def query(name: str, sql: str | None = None, doubles: str = "") -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL it is compared with, if there is one.

    `doubles` lists the SQL's floating-point columns, which are rounded like the Spark side's.
    """
    if sql is not None and doubles:
        replaced = ", ".join(f'round("{c}", 6) + 0 AS "{c}"' for c in doubles.split())
        sql = f"SELECT * REPLACE ({replaced}) FROM ({sql})"

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(build(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


LOTS = """lots AS (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR)) AS entity_id,
         l_shipdate AS test_timestamp,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE -1 END AS yield_label,
         CASE WHEN l_returnflag = 'R' THEN 'fail' ELSE 'pass' END AS pass_fail,
         l_quantity AS feature_001,
         l_extendedprice AS feature_002,
         nullif(l_discount, 0) AS feature_003,
         CASE WHEN l_tax >= 0.05 THEN l_tax END AS feature_004,
         CAST(1.0 AS DOUBLE) AS feature_005,
         CAST(NULL AS DOUBLE) AS feature_006,
         l_extendedprice * (1 - l_discount) AS feature_007
  FROM lineitem)"""

LONG = LOTS + """, long AS (
  SELECT entity_id, test_timestamp, yield_label, 'feature_' || lpad(CAST(o + 1 AS VARCHAR), 3, '0') AS feature_name, o AS ordinal, v
  FROM (SELECT entity_id, test_timestamp, yield_label,
               unnest([feature_001, feature_002, feature_003, feature_004, feature_005, feature_006, feature_007]) AS v,
               unnest([0, 1, 2, 3, 4, 5, 6]) AS o
        FROM lots) t)"""

CATALOG = LONG + """, profile AS (
  SELECT feature_name, ordinal, count(*) - count(v) AS null_count,
         (count(*) - count(v)) / CAST(count(*) AS DOUBLE) AS null_pct,
         count(DISTINCT v) AS distinct_count, avg(v) AS mean, stddev_pop(v) AS stddev, min(v) AS min_value, max(v) AS max_value,
         count(v) AS value_count
  FROM long GROUP BY feature_name, ordinal), cat AS (
  SELECT ordinal AS feature_ordinal, feature_name, null_count, null_pct, distinct_count, mean, stddev, min_value, max_value,
         distinct_count <= 1 AS is_constant, null_pct >= 0.5 AS is_high_missing,
         CASE WHEN value_count = 0 THEN 'drop_all_null' WHEN distinct_count <= 1 THEN 'drop_constant'
              WHEN null_pct >= 0.5 THEN 'review_high_missing' ELSE 'keep' END AS recommended_action
  FROM profile)"""

RANKING = CATALOG + """, cls AS (
  SELECT feature_name, ordinal,
         count(v) FILTER (yield_label = -1) AS pass_count, count(v) FILTER (yield_label = 1) AS fail_count,
         avg(v) FILTER (yield_label = -1) AS pass_mean, avg(v) FILTER (yield_label = 1) AS fail_mean,
         stddev_pop(v) FILTER (yield_label = -1) AS pass_stddev, stddev_pop(v) FILTER (yield_label = 1) AS fail_stddev
  FROM long GROUP BY feature_name, ordinal), eff AS (
  SELECT *, CASE WHEN sqrt((pass_stddev * pass_stddev + fail_stddev * fail_stddev) / 2) > 0
                 THEN abs(pass_mean - fail_mean) / sqrt((pass_stddev * pass_stddev + fail_stddev * fail_stddev) / 2) END AS effect_size
  FROM cls), sep AS (
  SELECT ordinal AS feature_ordinal, feature_name, pass_count, fail_count, pass_mean, fail_mean, pass_stddev, fail_stddev, effect_size
  FROM eff WHERE pass_count > 0 AND fail_count > 0
    AND feature_name NOT IN (SELECT feature_name FROM cat WHERE is_constant)), rel AS (
  SELECT e.ordinal AS feature_ordinal, e.feature_name, s.effect_size, e.pass_mean, e.fail_mean, abs(e.pass_mean - e.fail_mean) AS mean_gap,
         e.pass_count AS valid_pass_count, e.fail_count AS valid_fail_count
  FROM eff e LEFT JOIN sep s USING (feature_name)
  WHERE e.feature_name IN (SELECT feature_name FROM cat WHERE NOT is_constant))"""

PRIORITY = RANKING + """, prio AS (
  SELECT c.feature_name, c.recommended_action, c.null_pct, s.effect_size,
         CASE WHEN c.recommended_action = 'drop_all_null' THEN 'excluded_all_null'
              WHEN c.recommended_action = 'drop_constant' THEN 'excluded_constant'
              WHEN c.null_pct >= 0.5 THEN 'review_high_missing'
              WHEN s.effect_size >= (SELECT quantile_cont(effect_size, 0.5) FROM sep) THEN 'top_separator'
              ELSE 'standard_keep' END AS priority_bucket
  FROM cat c LEFT JOIN sep s USING (feature_name))"""

PROFILES = RANKING + """, top AS (
  SELECT feature_name, row_number() OVER (ORDER BY effect_size DESC NULLS LAST, feature_ordinal) AS rnk FROM sep), prof AS (
  SELECT l.feature_name, CASE WHEN l.yield_label = 1 THEN 'fail' ELSE 'pass' END AS yield_class,
         count(v) AS "count", count(*) - count(v) AS missing_count, avg(v) AS mean, stddev_pop(v) AS stddev, min(v) AS "min",
         quantile_cont(v, 0.25) AS p25, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS p75, max(v) AS "max"
  FROM long l JOIN top t ON l.feature_name = t.feature_name AND t.rnk <= 3 GROUP BY 1, 2)"""

DAILY = LOTS + """, days AS (
  SELECT CAST(test_timestamp AS DATE) AS event_date, count(*) AS entity_count,
         count(*) FILTER (yield_label = -1) AS pass_count, count(*) FILTER (yield_label = 1) AS fail_count,
         count(*) FILTER (yield_label = -1) / CAST(count(*) AS DOUBLE) AS pass_rate,
         count(*) FILTER (yield_label = 1) / CAST(count(*) AS DOUBLE) AS fail_rate
  FROM lots GROUP BY 1)"""

SCORED = """scored AS (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR)) AS entity_id,
         l_linenumber AS line, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y_true,
         round(l_discount * 5 + l_tax * 5, 2) AS risk
  FROM lineitem)"""

SENSORS = """sens AS (
  SELECT vec_id AS entity_id, TIMESTAMP '2024-01-01' + to_hours(6 * vec_id) AS test_timestamp,
         CASE WHEN label = 0 THEN 1 ELSE -1 END AS yield_label, embedding
  FROM embeddings)"""

SENSOR_LONG = SENSORS + """, slong AS (
  SELECT entity_id, test_timestamp, CAST(test_timestamp AS DATE) AS d, yield_label, CASE WHEN yield_label = 1 THEN 1 ELSE 0 END AS y,
         unnest(range(64)) AS ordinal, CAST(unnest(embedding) AS DOUBLE) AS v
  FROM sens)"""
