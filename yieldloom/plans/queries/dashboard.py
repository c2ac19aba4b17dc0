"""Queries over the report tables.

The benchmark is built from line items: line status stands for the model, line number for the feature set
and the ship year for the fold, so that every configuration has real scores and the SQL can follow.
"""

from pyspark.sql import functions as F

from yieldloom.operators import dashboard
from yieldloom.operators.metrics import threshold_cost_curve, threshold_sweep
from yieldloom.operators.profile import feature_catalog
from yieldloom.operators.separation import failure_relationship, signal_profiles, signal_separation
from yieldloom.plans import modeling
from yieldloom.plans.queries.metrics import GRID
from yieldloom.plans.registry import CATALOG, PROFILES, RANKING, SCORED, query
from yieldloom.recipes import lot_entities, scored_labels

RATES = (("05pct", 0.05), ("10pct", 0.1), ("20pct", 0.2))


def config_results(spark, sf_dir):
    item = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    scored = item.select(
        F.when(F.col("l_linestatus") == "O", "linear_open").otherwise("detector_filled").alias("model"),
        F.concat(F.lit("line_"), F.col("l_linenumber")).alias("feature_set"),
        (F.pmod(F.year("l_shipdate"), F.lit(4)) + 1).alias("fold"),
        F.concat_ws(
            "-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.to_date("l_shipdate").cast("string")
        ).alias("entity_id"),
        (F.col("l_returnflag") == "R").cast("int").alias("y_true"),
        F.round(F.col("l_discount") * 5 + F.col("l_tax") * 5, 2).alias("risk"),
    )
    is_linear = F.col("model") == "linear_open"
    return modeling.config_metrics(scored).select(
        "*",
        F.when(is_linear, "linear").otherwise("anomaly_detection").alias("model_family"),
        F.when(is_linear, "classifier").otherwise("anomaly_detector").alias("model_kind"),
        (F.col("feature_set") != "line_7").alias("final_eligible"),
        (F.col("feature_set") != "line_6").alias("enabled"),
    )


def benchmark(spark, sf_dir):
    return modeling.model_benchmark(config_results(spark, sf_dir))


INSPECTED = ", ".join(
    f"greatest(1, CAST(round_even(max(n) * {rate}::DOUBLE, 0) AS BIGINT)) AS k_{label}, max(p) AS p_{label}, max(n) AS n_{label}, "
    f"sum(y_true) FILTER (rn <= greatest(1, CAST(round_even(n * {rate}::DOUBLE, 0) AS BIGINT))) AS hit_{label}"
    for label, rate in RATES
)
RESULTS = (
    """cs AS (SELECT CASE WHEN l_linestatus = 'O' THEN 'linear_open' ELSE 'detector_filled' END AS model, 'line_' || l_linenumber AS feature_set,
    CAST(year(l_shipdate) % 4 + 1 AS INTEGER) AS fold,
    concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR)) AS entity_id,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y_true, round(l_discount * 5 + l_tax * 5, 2) AS risk FROM lineitem),
  byscore AS (SELECT model, feature_set, fold, risk, count(*) AS n, sum(y_true) AS pos FROM cs GROUP BY ALL),
  cum AS (SELECT *, sum(n) OVER w AS cn, sum(pos) OVER w AS cp, sum(n) OVER (PARTITION BY model, feature_set, fold) AS tn,
                 sum(pos) OVER (PARTITION BY model, feature_set, fold) AS tp
          FROM byscore WINDOW w AS (PARTITION BY model, feature_set, fold ORDER BY risk DESC)),
  disc AS (SELECT model, feature_set, fold, sum(pos / CAST(tp AS DOUBLE) * cp / cn) AS pr_auc,
                  sum(pos * ((tn - tp) - (cn - cp) + (n - pos) / 2.0)) / max(CAST(tp AS DOUBLE) * (tn - tp)) AS roc_auc FROM cum GROUP BY ALL),
  med AS (SELECT model, feature_set, fold, median(risk) AS m FROM cs GROUP BY ALL),
  cells AS (SELECT model, feature_set, fold, count(*) FILTER (risk >= m AND y_true = 1) AS tp, count(*) FILTER (risk >= m AND y_true = 0) AS fp,
                   count(*) FILTER (risk < m AND y_true = 1) AS fn, count(*) FILTER (risk < m AND y_true = 0) AS tn
            FROM cs JOIN med USING (model, feature_set, fold) GROUP BY ALL),
  ordered AS (SELECT *, row_number() OVER (PARTITION BY model, feature_set, fold ORDER BY risk DESC, md5('0:' || entity_id)) AS rn,
                     count(*) OVER (PARTITION BY model, feature_set, fold) AS n, sum(y_true) OVER (PARTITION BY model, feature_set, fold) AS p FROM cs),
  insp AS (SELECT model, feature_set, fold, """
    + INSPECTED
    + """ FROM ordered GROUP BY model, feature_set, fold),
  results AS (SELECT model, feature_set, fold, pr_auc, roc_auc, tp / CAST(tp + fp AS DOUBLE) AS precision, tp / CAST(tp + fn AS DOUBLE) AS recall,
      2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) AS f1, (tp / CAST(tp + fn AS DOUBLE) + tn / CAST(tn + fp AS DOUBLE)) / 2 AS balanced_accuracy, """
    + ", ".join(
        f"round_even(hit_{x} / CAST(p_{x} AS DOUBLE), 4) AS recall_at_{x}, round_even(hit_{x} / CAST(k_{x} AS DOUBLE), 4) AS precision_at_{x}, "
        f"CAST(hit_{x} AS BIGINT) AS captured_fails_at_{x}, round_even((hit_{x} / CAST(k_{x} AS DOUBLE)) / (p_{x} / CAST(n_{x} AS DOUBLE)), 4) AS lift_at_{x}"
        for x, _ in RATES
    )
    + """, CASE WHEN model = 'linear_open' THEN 'linear' ELSE 'anomaly_detection' END AS model_family,
      CASE WHEN model = 'linear_open' THEN 'classifier' ELSE 'anomaly_detector' END AS model_kind,
      feature_set <> 'line_7' AS final_eligible, feature_set <> 'line_6' AS enabled
    FROM disc JOIN cells USING (model, feature_set, fold) JOIN insp USING (model, feature_set, fold))"""
)
BENCH = (
    RESULTS
    + ", raw AS (SELECT model, feature_set, "
    + ", ".join(f"avg({m}) AS mean_{m}" for m in modeling.MEANS)
    + """, stddev_samp(pr_auc) AS std_pr_auc, any_value(model_family) AS model_family, any_value(model_kind) AS model_kind,
      any_value(final_eligible) AS final_eligible, any_value(enabled) AS enabled FROM results GROUP BY model, feature_set),
  bench AS (SELECT *, CAST(dense_rank() OVER (ORDER BY mean_pr_auc DESC) AS INTEGER) AS rank,
      final_eligible AND enabled AND row_number() OVER (PARTITION BY final_eligible AND enabled ORDER BY mean_recall_at_10pct DESC, model, feature_set) = 1
        AS best_for_inspection_policy FROM raw)"""
)
RESULT_DOUBLES = "pr_auc roc_auc precision recall f1 balanced_accuracy " + " ".join(
    f"{n}_at_{x}" for x, _ in RATES for n in ("recall", "precision", "lift")
)
INSPECTION_MEANS = " ".join(f"mean_{n}_at_{x}" for x, _ in RATES for n in ("recall", "precision", "lift"))
BENCH_DOUBLES = " ".join(f"mean_{m}" for m in modeling.MEANS) + " std_pr_auc"


@query("config_fold_results", f"WITH {RESULTS} SELECT * FROM results", RESULT_DOUBLES)
def _(spark, sf_dir):
    return config_results(spark, sf_dir)


@query("model_benchmark", f"WITH {BENCH} SELECT * FROM bench", BENCH_DOUBLES)
def _(spark, sf_dir):
    return benchmark(spark, sf_dir)


@query(
    "inspection_benchmark",
    f"WITH {BENCH} SELECT model, feature_set, model_family, model_kind, final_eligible, enabled, {INSPECTION_MEANS.replace(' ', ', ')} FROM bench",
    INSPECTION_MEANS,
)
def _(spark, sf_dir):
    return modeling.inspection_benchmark(benchmark(spark, sf_dir))


@query("anomaly_benchmark", f"WITH {BENCH} SELECT * FROM bench WHERE model_kind = 'anomaly_detector'", BENCH_DOUBLES)
def _(spark, sf_dir):
    return modeling.anomaly_benchmark(benchmark(spark, sf_dir))


@query(
    "best_config",
    f"WITH {BENCH} SELECT model, feature_set, mean_pr_auc FROM bench WHERE final_eligible AND enabled ORDER BY mean_pr_auc DESC, model, feature_set LIMIT 1",
    "mean_pr_auc",
)
def _(spark, sf_dir):
    results = config_results(spark, sf_dir)
    best = modeling.best_config(results)
    here = (F.col("model") == best["model"]) & (F.col("feature_set") == best["feature_set"])
    return results.where(here).groupBy("model", "feature_set").agg(F.avg("pr_auc").alias("mean_pr_auc"))


@query(
    "family_summary",
    f"""WITH {BENCH} SELECT model_family, count(*) FILTER (enabled) AS configs, coalesce(max(mean_pr_auc) FILTER (enabled), 0) AS best_pr_auc
        FROM bench GROUP BY 1""",
    "best_pr_auc",
)
def _(spark, sf_dir):
    return dashboard.family_summary(benchmark(spark, sf_dir))


@query(
    "supervised_vs_anomaly",
    f"""WITH {BENCH} SELECT model_kind, coalesce(max(mean_pr_auc) FILTER (enabled), 0) AS best_pr_auc,
        coalesce(max(mean_recall_at_10pct) FILTER (enabled), 0) AS best_recall_at_10pct FROM bench GROUP BY 1""",
    "best_pr_auc best_recall_at_10pct",
)
def _(spark, sf_dir):
    return dashboard.supervised_vs_anomaly(benchmark(spark, sf_dir))


@query(
    "feature_set_leaders",
    f"""WITH {BENCH} SELECT feature_set, count(*) FILTER (enabled) AS configs, coalesce(max(mean_pr_auc) FILTER (enabled), 0) AS best_pr_auc,
        coalesce(max(mean_recall_at_10pct) FILTER (enabled), 0) AS best_recall_at_10pct FROM bench GROUP BY 1""",
    "best_pr_auc best_recall_at_10pct",
)
def _(spark, sf_dir):
    return dashboard.feature_set_leaders(benchmark(spark, sf_dir))


@query(
    "improvement_check",
    f"""WITH {BENCH}, x AS (SELECT max(mean_pr_auc) FILTER (model = 'linear_open' AND feature_set = 'line_1') AS baseline_pr_auc,
        max(mean_pr_auc) AS best_pr_auc, max(mean_pr_auc) FILTER (model_kind = 'anomaly_detector') AS best_anomaly_pr_auc FROM bench)
        SELECT *, best_pr_auc > baseline_pr_auc AS improved, best_anomaly_pr_auc > baseline_pr_auc AS anomaly_improved FROM x""",
    "baseline_pr_auc best_pr_auc best_anomaly_pr_auc",
)
def _(spark, sf_dir):
    return dashboard.improvement_check(benchmark(spark, sf_dir), "linear_open", "line_1")


@query(
    "top_configs",
    f"WITH {BENCH} SELECT model, feature_set, mean_pr_auc FROM bench ORDER BY mean_pr_auc DESC, model, feature_set LIMIT 5",
    "mean_pr_auc",
)
def _(spark, sf_dir):
    return dashboard.top_configs(benchmark(spark, sf_dir))


@query(
    "benchmark_filter",
    f"WITH {BENCH} SELECT * FROM bench WHERE model_family = 'linear' AND model_kind = 'classifier' AND final_eligible",
    BENCH_DOUBLES,
)
def _(spark, sf_dir):
    return dashboard.filter_benchmark(benchmark(spark, sf_dir), "linear", kind="classifier", final_eligible_only=True)


@query("feature_set_choices", f"WITH {BENCH} SELECT DISTINCT feature_set FROM bench")
def _(spark, sf_dir):
    return dashboard.choices(benchmark(spark, sf_dir), "feature_set")


@query(
    "feature_selection_summary",
    """WITH s AS (SELECT l_linestatus AS model, 'ship_' || l_linenumber AS feature_set, CAST(year(l_shipdate) AS INTEGER) AS fold,
          list(DISTINCT 'quantity_' || lpad(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 2, '0')
            ORDER BY 'quantity_' || lpad(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 2, '0')) AS f FROM lineitem GROUP BY ALL)
       SELECT model, feature_set, avg(len(f)) AS mean_n_selected, CAST(min(len(f)) AS INTEGER) AS min_n_selected, CAST(max(len(f)) AS INTEGER) AS max_n_selected,
              array_to_string(min_by(f, fold)[1:10], ',') AS example_features FROM s GROUP BY ALL""",
    "mean_n_selected",
)
def _(spark, sf_dir):
    item = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    # quantities run from 1 to 50, so a list has at most fifty names
    name = F.concat(F.lit("quantity_"), F.lpad(F.col("l_quantity").cast("int").cast("string"), 2, "0"))
    selected = item.groupBy(
        F.col("l_linestatus").alias("model"),
        F.concat(F.lit("ship_"), F.col("l_linenumber")).alias("feature_set"),
        F.year("l_shipdate").alias("fold"),
    ).agg(F.array_sort(F.collect_set(name)).alias("selected_features"))
    summary = modeling.feature_selection_summary(
        selected.withColumn("n_features_selected", F.size("selected_features"))
    )
    return summary.withColumn("example_features", F.concat_ws(",", "example_features"))


@query(
    "display_catalog",
    f"""WITH {CATALOG} SELECT feature_ordinal, feature_name, null_count, round(null_pct * 100, 2) AS null_pct, distinct_count, round(mean, 2) AS mean,
        round(stddev, 2) AS stddev, round(min_value, 2) AS min_value, round(max_value, 2) AS max_value, is_constant, is_high_missing, recommended_action FROM cat""",
)
def _(spark, sf_dir):
    return dashboard.display_catalog(feature_catalog(lot_entities(spark, sf_dir)))


@query(
    "catalog_search",
    f"""WITH {CATALOG} SELECT feature_name FROM cat WHERE contains(lower(feature_name), 'ture_00') AND recommended_action = 'review_high_missing' AND is_high_missing""",
)
def _(spark, sf_dir):
    catalog = feature_catalog(lot_entities(spark, sf_dir))
    found = dashboard.search_catalog(catalog, "TURE_00", "review_high_missing", high_missing_only=True)
    return found.select("feature_name")


@query("catalog_page", f"WITH {CATALOG} SELECT feature_ordinal, feature_name FROM cat ORDER BY feature_ordinal LIMIT 3 OFFSET 3")
def _(spark, sf_dir):
    catalog = feature_catalog(lot_entities(spark, sf_dir))
    return dashboard.page(catalog, 2, size=3).select("feature_ordinal", "feature_name")


@query("most_missing_features", f"WITH {CATALOG} SELECT feature_name, null_pct FROM cat ORDER BY null_pct DESC, feature_ordinal LIMIT 20", "null_pct")
def _(spark, sf_dir):
    return dashboard.most_missing(feature_catalog(lot_entities(spark, sf_dir))).select("feature_name", "null_pct")


@query(
    "null_share_histogram",
    f"""WITH {CATALOG}, p AS (SELECT round(null_pct * 100, 2) AS s FROM cat),
        b AS (SELECT * FROM (VALUES (0, '0%', -1.0, 0.0), (1, '0-10%', 0.0, 10.0), (2, '10-25%', 10.0, 25.0), (3, '25-50%', 25.0, 50.0),
              (4, '50-75%', 50.0, 75.0), (5, '75-100%', 75.0, 1000.0)) v(bin, label, lo, hi))
        SELECT CAST(bin AS INTEGER) AS bin, label, count(s) AS "count" FROM b LEFT JOIN p ON s > lo AND s <= hi GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    return dashboard.null_share_histogram(feature_catalog(lot_entities(spark, sf_dir)))


@query(
    "ranking_search",
    f"WITH {RANKING} SELECT feature_name, effect_size FROM rel WHERE contains(lower(feature_name), '00')",
    "effect_size",
)
def _(spark, sf_dir):
    found = dashboard.search_ranking(failure_relationship(lot_entities(spark, sf_dir)), "00", descending=False)
    return found.select("feature_name", "effect_size")


@query(
    "profile_pivot",
    f"""WITH {PROFILES}, one AS (SELECT * FROM prof WHERE feature_name = 'feature_002'), l AS (
          SELECT yield_class, unnest(['min', 'p25', 'median', 'p75', 'max']) AS stat, unnest(["min", p25, median, p75, "max"]) AS v FROM one)
        SELECT stat, max(v) FILTER (yield_class = 'pass') AS pass, max(v) FILTER (yield_class = 'fail') AS fail FROM l
        GROUP BY stat HAVING (SELECT count(*) FROM one) > 0""",
    "pass fail",
)
def _(spark, sf_dir):
    lots = lot_entities(spark, sf_dir)
    return dashboard.profile_pivot(signal_profiles(lots, signal_separation(lots), top_n=3), "feature_002")


@query("medium_plus_count", f"WITH {RANKING} SELECT count(*) FILTER (effect_size >= 0.01) AS medium_plus_count FROM rel")
def _(spark, sf_dir):
    return dashboard.medium_plus_count(failure_relationship(lot_entities(spark, sf_dir)), 0.01)


@query(
    "thinned_cost_curve",
    f"""WITH {SCORED}, {GRID} SELECT threshold, precision, recall, f1 FROM (SELECT *, row_number() OVER (ORDER BY cut) AS rn FROM sweep) WHERE rn % 5 = 1""",
    "threshold precision recall f1",
)
def _(spark, sf_dir):
    curve = threshold_cost_curve(threshold_sweep(scored_labels(spark, sf_dir)))
    return dashboard.thin_curve(curve).select("threshold", "precision", "recall", "f1")
