"""The final test as queries: an outlier factor run from the date split to the locked threshold, written out in SQL."""

from pyspark.sql import functions as F

from yieldloom.plans import modeling
from yieldloom.plans.queries.models import metrics_sql
from yieldloom.plans.queries.splits import FOLDS
from yieldloom.plans.registry import query
from yieldloom.recipes import SENSORS, sensor_entities

MODEL, FEATURE_SET = "local_outlier_factor_pass_only", "keep_only"
OUTLIERS = modeling.Options(models=(MODEL,), feature_sets=(FEATURE_SET,))

# Part 0 is the final test on the newest dates, the others are the folds; `asks` tells test rows from training rows.
RISKS = (
    FOLDS
    + f""", member AS (
    SELECT f.fold AS part, entity_id, CAST(yield_label = 1 AS INT) AS y, embedding, d >= f.test_start_date AS asks FROM dt JOIN folds f ON split = 'dev' AND d <= f.test_end_date
    UNION ALL SELECT 0, entity_id, CAST(yield_label = 1 AS INT), embedding, split = 'test' FROM dt),
  cell AS (SELECT part, entity_id, y, asks, unnest(range({SENSORS})) AS o, CAST(unnest(embedding) AS DOUBLE) AS v FROM member),
  scale AS (SELECT part, o, avg(v) AS m, stddev_pop(v) AS s FROM cell WHERE NOT asks GROUP BY 1, 2),
  z AS (SELECT part, entity_id, y, asks, list((v - m) / s ORDER BY o) AS e FROM cell JOIN scale USING (part, o) GROUP BY 1, 2, 3, 4),
  pass AS (SELECT part, entity_id, e FROM z WHERE NOT asks AND y = 0),
  many AS (SELECT part, least(least(20, greatest(5, CAST(floor(count(*) * 0.5) AS BIGINT))), count(*) - 1) AS k FROM pass GROUP BY 1),
  inner_near AS (SELECT a.part, a.entity_id, b.entity_id AS nid, list_distance(a.e, b.e) AS d,
                        row_number() OVER (PARTITION BY a.part, a.entity_id ORDER BY list_distance(a.e, b.e), b.entity_id) AS rn
                 FROM pass a JOIN pass b ON a.part = b.part AND a.entity_id <> b.entity_id),
  inn AS (SELECT i.* FROM inner_near i JOIN many USING (part) WHERE rn <= k),
  reach AS (SELECT part, entity_id AS nid, max(d) AS kd FROM inn GROUP BY 1, 2),
  dens AS (SELECT inn.part, inn.entity_id AS nid, 1 / (avg(greatest(d, kd)) + 1e-10) AS density FROM inn JOIN reach USING (part, nid) GROUP BY 1, 2),
  outer_near AS (SELECT a.part, a.entity_id, a.y, b.entity_id AS nid, list_distance(a.e, b.e) AS d,
                        row_number() OVER (PARTITION BY a.part, a.entity_id ORDER BY list_distance(a.e, b.e), b.entity_id) AS rn
                 FROM z a JOIN pass b ON a.part = b.part AND a.asks),
  risks AS (SELECT o.part, o.entity_id, o.y, avg(density) * (avg(greatest(d, kd)) + 1e-10) AS risk
            FROM outer_near o JOIN many USING (part) JOIN reach USING (part, nid) JOIN dens USING (part, nid) WHERE rn <= k GROUP BY 1, 2, 3),
  grid AS (SELECT CAST(0.01 AS DOUBLE) + i * CAST(0.01 AS DOUBLE) AS cut FROM (SELECT unnest(range(99)) AS i)),
  swept AS (SELECT cut, count(*) FILTER (risk >= cut AND y = 1) AS tp, count(*) FILTER (risk >= cut AND y = 0) AS fp, count(*) FILTER (risk < cut AND y = 1) AS fn
            FROM risks, grid WHERE part > 0 GROUP BY 1),
  locked AS (SELECT cut FROM swept ORDER BY coalesce(2 * tp / CAST(nullif(2 * tp + fp + fn, 0) AS DOUBLE), 0) DESC, cut LIMIT 1),
  cells AS (SELECT part = 0 AS tested, cut AS threshold, count(*) FILTER (risk < cut AND y = 0) AS tn, count(*) FILTER (risk >= cut AND y = 0) AS fp,
                   count(*) FILTER (risk < cut AND y = 1) AS fn, count(*) FILTER (risk >= cut AND y = 1) AS tp FROM risks, locked GROUP BY 1, 2)"""
)
NAMED = f"'{MODEL}' AS model, '{FEATURE_SET}' AS feature_set"


def _run(spark, sf_dir):
    return modeling.run_modeling(sensor_entities(spark, sf_dir), options=OUTLIERS)


@query(
    "final_outlier_confusion",
    f"WITH {RISKS} SELECT CASE WHEN tested THEN 'test' ELSE 'dev_oof' END AS split, {NAMED}, threshold, tn, fp, fn, tp FROM cells",
    "threshold",
)
def _(spark, sf_dir):
    return _run(spark, sf_dir).confusion


@query(
    "final_outlier_test",
    f"""WITH {RISKS}, newest AS (SELECT * FROM risks WHERE part = 0), {metrics_sql("newest")},
        ranked AS (SELECT y, row_number() OVER (ORDER BY risk DESC, md5('0:' || entity_id)) AS rn, count(*) OVER () AS n, sum(y) OVER () AS p FROM newest),
        points AS (SELECT i / CAST(20 AS DOUBLE) AS rate, max(n) AS n, max(p) AS p, greatest(1, CAST(round_even(max(n) * (i / CAST(20 AS DOUBLE)), 0) AS BIGINT)) AS k,
                          sum(y) FILTER (rn <= greatest(1, CAST(round_even(n * (i / CAST(20 AS DOUBLE)), 0) AS BIGINT))) AS hits
                   FROM ranked, (SELECT unnest(range(1, 21)) AS i) GROUP BY i)
        SELECT {NAMED}, round(rate, 2) AS inspection_rate, round_even(hits / CAST(p AS DOUBLE), 4) AS recall, round_even(hits / CAST(k AS DOUBLE), 4) AS precision,
               round_even((hits / CAST(k AS DOUBLE)) / (p / CAST(n AS DOUBLE)), 4) AS lift, CAST(hits AS BIGINT) AS captured_fails,
               {SENSORS} AS n_features, threshold, pr_auc AS test_pr_auc, roc_auc AS test_roc_auc, coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0) AS test_precision,
               coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0) AS test_recall, coalesce(2 * tp / CAST(nullif(2 * tp + fp + fn, 0) AS DOUBLE), 0) AS test_f1
        FROM points, measured, cells WHERE tested""",
    "inspection_rate recall precision lift threshold test_pr_auc test_roc_auc test_precision test_recall test_f1",
)
def _(spark, sf_dir):
    """The inspection curve of the locked model on the newest dates, beside its test results."""
    final = _run(spark, sf_dir).final
    return final.curve.join(F.broadcast(final.results), ["model", "feature_set"])
