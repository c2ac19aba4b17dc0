"""Queries over the ranking and threshold metrics."""

from pyspark.sql import functions as F

from yieldloom.operators import metrics
from yieldloom.plans.registry import SCORED, query
from yieldloom.recipes import scored_labels

BY_SCORE = SCORED + """, sc AS (SELECT line, risk, count(*) AS n, sum(y_true) AS pos FROM scored GROUP BY 1, 2),
  cum AS (SELECT *, sum(n) OVER w AS cn, sum(pos) OVER w AS cp, sum(n) OVER (PARTITION BY line) AS tn, sum(pos) OVER (PARTITION BY line) AS tp
          FROM sc WINDOW w AS (PARTITION BY line ORDER BY risk DESC))"""

DISCRIMINATION = BY_SCORE + """, disc AS (
  SELECT c.line, CAST(max(tn) AS BIGINT) AS n_scored, CAST(max(tp) AS BIGINT) AS n_fails,
         sum(pos / CAST(tp AS DOUBLE) * cp / cn) AS pr_auc,
         sum(pos * ((tn - tp) - (cn - cp) + (n - pos) / 2.0)) / max(CAST(tp AS DOUBLE) * (tn - tp)) AS roc_auc
  FROM cum c GROUP BY c.line), med AS (SELECT line, median(risk) AS median_risk FROM scored GROUP BY line)"""

GRID = """grid AS (SELECT 0.01::DOUBLE + i * 0.01::DOUBLE AS cut FROM (SELECT unnest(range(99)) AS i)),
  cells AS (SELECT cut, count(*) FILTER (risk >= cut) AS pred, count(*) FILTER (risk >= cut AND y_true = 1) AS tp,
                   count(*) AS n, sum(y_true) AS p FROM scored, grid GROUP BY cut),
  rates AS (SELECT cut, round(cut, 2) AS threshold, CASE WHEN pred > 0 THEN tp / CAST(pred AS DOUBLE) ELSE 0 END AS precision,
                   tp / CAST(p AS DOUBLE) AS recall, 2 * tp / CAST(pred + p AS DOUBLE) AS f1, pred, pred - tp AS fp, p - tp AS fn, n FROM cells),
  sweep AS (SELECT *, row_number() OVER (ORDER BY f1 DESC, cut) = 1 AS selected FROM rates)"""

INSPECT = """ranked AS (SELECT y_true, row_number() OVER (ORDER BY risk DESC, md5('0:' || entity_id)) AS rn,
    count(*) OVER () AS n, sum(y_true) OVER () AS p FROM scored)"""


def inspect_sql(rates: str) -> str:
    return f"""WITH {SCORED}, {INSPECT}, ks AS (
      SELECT rate, greatest(1, CAST(round_even((SELECT count(*) FROM scored) * rate, 0) AS BIGINT)) AS k FROM ({rates})),
      hits AS (SELECT rate, k, sum(y_true) FILTER (rn <= k) AS hit, max(p) AS p, max(n) AS n FROM ranked, ks GROUP BY rate, k)
      SELECT rate AS inspection_rate, k AS inspected, round_even(hit / CAST(p AS DOUBLE), 4) AS recall,
             round_even(hit / CAST(k AS DOUBLE), 4) AS precision,
             round_even((hit / CAST(k AS DOUBLE)) / (p / CAST(n AS DOUBLE)), 4) AS lift, CAST(hit AS BIGINT) AS captured_fails FROM hits"""


THREE_RATES = "SELECT unnest([0.05::DOUBLE, 0.1::DOUBLE, 0.2::DOUBLE]) AS rate"
CURVE = inspect_sql("SELECT i / 20.0::DOUBLE AS rate FROM (SELECT unnest(range(1, 21)) AS i)")
CURVE_DOUBLES = "inspection_rate recall precision lift"


@query(
    "ranking_quality",
    f"WITH {DISCRIMINATION} SELECT disc.*, median_risk FROM disc JOIN med USING (line)",
    "pr_auc roc_auc median_risk",
)
def _(spark, sf_dir):
    return metrics.discrimination(scored_labels(spark, sf_dir), ["line"])


@query(
    "median_cut_rates",
    f"""WITH {DISCRIMINATION}, cells AS (
          SELECT s.line, count(*) FILTER (risk >= median_risk AND y_true = 1) AS tp, count(*) FILTER (risk >= median_risk AND y_true = 0) AS fp,
                 count(*) FILTER (risk < median_risk AND y_true = 1) AS fn, count(*) FILTER (risk < median_risk AND y_true = 0) AS tn
          FROM scored s JOIN med USING (line) GROUP BY s.line)
        SELECT disc.*, median_risk, tp, fp, fn, tn, tp / CAST(tp + fp AS DOUBLE) AS precision, tp / CAST(tp + fn AS DOUBLE) AS recall,
               2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) AS f1,
               (tp / CAST(tp + fn AS DOUBLE) + tn / CAST(tn + fp AS DOUBLE)) / 2 AS balanced_accuracy
        FROM disc JOIN med USING (line) JOIN cells USING (line)""",
    "pr_auc roc_auc median_risk precision recall f1 balanced_accuracy",
)
def _(spark, sf_dir):
    return metrics.median_cut_rates(scored_labels(spark, sf_dir), ["line"])


@query(
    "cumulative_hits",
    f"WITH {BY_SCORE} SELECT line, risk, CAST(cn AS BIGINT) AS inspected, CAST(cp AS BIGINT) AS captured_fails FROM cum",
    "risk",
)
def _(spark, sf_dir):
    return metrics.cumulative_hits(scored_labels(spark, sf_dir), ["line"])


@query(
    "valid_scores",
    f"WITH {SCORED} SELECT entity_id, line, y_true, CASE WHEN risk < 0.85 THEN risk END AS risk FROM scored WHERE risk < 0.85",
    "risk",
)
def _(spark, sf_dir):
    scored = scored_labels(spark, sf_dir)
    return metrics.with_score(scored.withColumn("risk", F.when(F.col("risk") < F.lit(0.85), F.col("risk"))))


@query(
    "confusion_at_half",
    f"""WITH {SCORED} SELECT count(*) FILTER (risk < 0.5 AND y_true = 0) AS tn, count(*) FILTER (risk >= 0.5 AND y_true = 0) AS fp,
        count(*) FILTER (risk < 0.5 AND y_true = 1) AS fn, count(*) FILTER (risk >= 0.5 AND y_true = 1) AS tp FROM scored""",
)
def _(spark, sf_dir):
    return metrics.confusion(scored_labels(spark, sf_dir), 0.5)


@query(
    "threshold_analysis",
    f"WITH {SCORED}, {GRID} SELECT threshold, precision, recall, f1, selected FROM sweep",
    "threshold precision recall f1",
)
def _(spark, sf_dir):
    return metrics.threshold_analysis(metrics.threshold_sweep(scored_labels(spark, sf_dir)))


@query(
    "threshold_cost_curve",
    f"""WITH {SCORED}, {GRID} SELECT threshold, precision, recall, f1, pred AS predicted_fail_count, fp AS false_positive_count,
        CAST(fn AS BIGINT) AS false_negative_count, round_even(pred / CAST(n AS DOUBLE), 4) AS inspection_rate, selected FROM sweep""",
    "threshold precision recall f1 inspection_rate",
)
def _(spark, sf_dir):
    return metrics.threshold_cost_curve(metrics.threshold_sweep(scored_labels(spark, sf_dir)))


@query(
    "probability_bins",
    f"""WITH {SCORED}, bins AS (SELECT i / 5.0::DOUBLE AS lo, (i + 1) / 5.0::DOUBLE AS hi, i FROM (SELECT unnest(range(5)) AS i))
        SELECT round(lo, 2) AS bin_min, round(hi, 2) AS bin_max, count(risk) AS total_entities, CAST(coalesce(sum(y_true), 0) AS BIGINT) AS fail_count,
               round_even(coalesce(sum(y_true) / CAST(count(risk) AS DOUBLE), 0), 4) AS fail_rate
        FROM bins LEFT JOIN scored ON risk >= lo AND (risk < hi OR (i = 4 AND risk <= hi)) GROUP BY lo, hi""",
    "bin_min bin_max fail_rate",
)
def _(spark, sf_dir):
    return metrics.probability_bins(scored_labels(spark, sf_dir))


@query("inspection_at_rates", inspect_sql(THREE_RATES), CURVE_DOUBLES)
def _(spark, sf_dir):
    return metrics.inspection(scored_labels(spark, sf_dir))


@query(
    "inspection_metrics",
    f"""WITH hits AS ({inspect_sql(THREE_RATES)}) SELECT """
    + ", ".join(
        f"max({name}) FILTER (inspection_rate = {rate}::DOUBLE) AS {name}_at_{metrics.rate_label(rate)}"
        for rate in metrics.INSPECTION_RATES
        for name in ("recall", "precision", "captured_fails", "lift")
    )
    + " FROM hits",
    " ".join(
        f"{name}_at_{metrics.rate_label(rate)}" for rate in metrics.INSPECTION_RATES for name in ("recall", "precision", "lift")
    ),
)
def _(spark, sf_dir):
    return metrics.inspection_metrics(scored_labels(spark, sf_dir))


@query(
    "inspection_curve",
    f"SELECT round(inspection_rate, 2) AS inspection_rate, recall, precision, lift, captured_fails FROM ({CURVE})",
    CURVE_DOUBLES,
)
def _(spark, sf_dir):
    return metrics.inspection_curve(scored_labels(spark, sf_dir))


@query(
    "inspection_curve_point",
    f"SELECT round(inspection_rate, 2) AS inspection_rate, recall, precision, lift, captured_fails FROM ({CURVE}) WHERE abs(inspection_rate - 0.1) < 0.001",
    CURVE_DOUBLES,
)
def _(spark, sf_dir):
    return metrics.curve_point(metrics.inspection_curve(scored_labels(spark, sf_dir)), 0.1)
