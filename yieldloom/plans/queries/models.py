"""Queries over the models. Fitted learners have no SQL counterpart; neighbour searches have."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from yieldloom.operators import ellipse, forest, metrics, neighbors, splits
from yieldloom.operators.preprocess import Input, prepare
from yieldloom.operators.profile import feature_catalog
from yieldloom.plans import modeling, models
from yieldloom.plans.queries.splits import DEV_TEST, FOLDS
from yieldloom.plans.registry import SENSORS as SENSORS_SQL
from yieldloom.plans.registry import query
from yieldloom.recipes import SENSORS, sensor_entities

PLAIN = [Input(f"feature_{i:03d}", f"feature_{i:03d}", False, 0.0, 0.0, 1.0) for i in range(1, SENSORS + 1)]
SMALL = modeling.Options(models=("dummy_stratified", "logistic_l2"), feature_sets=("keep_only", "top_20_effect"))

NEIGHBORS = DEV_TEST + """, p AS (SELECT entity_id, CASE WHEN yield_label = 1 THEN 1 ELSE 0 END AS y, CAST(embedding AS DOUBLE[]) AS e, split FROM dt),
  near AS (SELECT q.entity_id, n.entity_id AS neighbor_id, n.y, list_distance(q.e, n.e) AS distance,
                  row_number() OVER (PARTITION BY q.entity_id ORDER BY list_distance(q.e, n.e), n.entity_id) AS rank
           FROM p q JOIN p n ON q.split = 'test' AND n.split = 'dev')"""

OUTLIERS = DEV_TEST + """, p AS (SELECT entity_id, CAST(embedding AS DOUBLE[]) AS e, split FROM dt WHERE split = 'test' OR yield_label <> 1),
  inner_near AS (SELECT a.entity_id, b.entity_id AS nid, list_distance(a.e, b.e) AS d,
                        row_number() OVER (PARTITION BY a.entity_id ORDER BY list_distance(a.e, b.e), b.entity_id) AS rank
                 FROM p a JOIN p b ON a.split = 'dev' AND b.split = 'dev' AND a.entity_id <> b.entity_id),
  inn AS (SELECT * FROM inner_near WHERE rank <= 20),
  reach AS (SELECT entity_id AS nid, max(d) AS kd FROM inn GROUP BY 1),
  dens AS (SELECT inn.entity_id, 1 / (avg(greatest(d, kd)) + 1e-10) AS density FROM inn JOIN reach USING (nid) GROUP BY 1),
  outer_near AS (SELECT a.entity_id, b.entity_id AS nid, list_distance(a.e, b.e) AS d,
                        row_number() OVER (PARTITION BY a.entity_id ORDER BY list_distance(a.e, b.e), b.entity_id) AS rank
                 FROM p a JOIN p b ON a.split = 'test' AND b.split = 'dev'),
  outn AS (SELECT * FROM outer_near WHERE rank <= 20)"""


def parts(spark, sf_dir):
    """(dev, test) sensor vectors."""
    split = splits.split_dev_test(sensor_entities(spark, sf_dir))
    dev, test = (split.where(F.col("split") == s).drop("split") for s in ("dev", "test"))
    return prepare(dev, PLAIN, False), prepare(test, PLAIN, False)


@query(
    "nearest_neighbors",
    f"WITH {NEIGHBORS} SELECT entity_id, neighbor_id, distance, CAST(rank AS INTEGER) AS rank FROM near WHERE rank <= 5",
    "distance",
)
def _(spark, sf_dir):
    dev, test = parts(spark, sf_dir)
    return neighbors.nearest_neighbors(dev, test, 5)


@query("neighbor_vote", f"WITH {NEIGHBORS} SELECT entity_id, avg(y) AS risk FROM near WHERE rank <= 5 GROUP BY 1", "risk")
def _(spark, sf_dir):
    dev, test = parts(spark, sf_dir)
    return neighbors.neighbor_vote(dev, test, 5)


@query(
    "local_outlier_factor",
    f"""WITH {OUTLIERS} SELECT o.entity_id, avg(dens.density) * (avg(greatest(o.d, kd)) + 1e-10) AS risk
        FROM outn o JOIN dens ON o.nid = dens.entity_id JOIN reach ON o.nid = reach.nid GROUP BY 1""",
    "risk",
)
def _(spark, sf_dir):
    dev, test = parts(spark, sf_dir)
    return neighbors.local_outlier_factor(dev.where("y = 0"), test, 20)


@query("isolation_forest")
def _(spark, sf_dir):
    dev, test = parts(spark, sf_dir)
    passes = dev.where("y = 0")
    n = passes.count()
    sample = min(forest.SAMPLE, n)
    return forest.score_forest(test, forest.settled_forest(passes, n, 50, sample, 42, "entity_id"), sample)


@query("covariance_distance")
def _(spark, sf_dir):
    dev, test = parts(spark, sf_dir)
    mean, inverse = ellipse.robust_center(dev.where("y = 0"))
    return ellipse.distances(test, mean, inverse)


# Two starts, two concentration steps, the lesser determinant, then scaling and reweighting, on two features.
# fixed values: the 50 % and 97.5 % quantiles of the chi-square distribution with two degrees of freedom
def _distance_sql(fit: str) -> str:
    return f"({fit}.vb * (a - {fit}.ma) ** 2 - 2 * {fit}.c * (a - {fit}.ma) * (b - {fit}.mb) + {fit}.va * (b - {fit}.mb) ** 2) / ({fit}.va * {fit}.vb - {fit}.c ** 2)"


_MOMENTS = "avg(a) AS ma, avg(b) AS mb, var_pop(a) AS va, var_pop(b) AS vb, covar_pop(a, b) AS c"
_STEP = """d{k} AS (SELECT s, entity_id, a, b, rank() OVER (PARTITION BY s ORDER BY {distance}) AS r FROM f{k}, fitted),
  f{next} AS (SELECT s, {moments} FROM d{k}, size WHERE r <= h GROUP BY s)"""
ROBUST = (
    DEV_TEST
    + f""", p AS (SELECT entity_id, CAST(embedding[1] AS DOUBLE) AS a, CAST(embedding[2] AS DOUBLE) AS b, split, yield_label FROM dt),
  fitted AS (SELECT entity_id, a, b FROM p WHERE split = 'dev' AND yield_label <> 1),
  size AS (SELECT count(*) AS n, CAST(ceil((count(*) + 3) / 2.0) AS BIGINT) AS h FROM fitted),
  f0 AS (SELECT s, {_MOMENTS} FROM fitted, size, (SELECT unnest([0, 1]) AS s)
         WHERE 9.0::DOUBLE / n >= 0.5 OR substr(md5('42:' || s || ':' || entity_id), 1, 8) < printf('%08x', CAST(floor(9.0::DOUBLE / n * 4294967296) AS BIGINT)) GROUP BY s),
  {_STEP.format(k=0, next=1, distance=_distance_sql("f0"), moments=_MOMENTS)},
  {_STEP.format(k=1, next=2, distance=_distance_sql("f1"), moments=_MOMENTS)},
  best AS (SELECT * FROM f2 ORDER BY va * vb - c ** 2, s LIMIT 1),
  own AS (SELECT a, b, {_distance_sql("best")} AS d FROM fitted, best),
  cut AS (SELECT 7.377758908227872 * quantile_cont(d, 0.5) / 1.3862943611198906 AS cut FROM own),
  last AS (SELECT {_MOMENTS} FROM own, cut WHERE d < cut)"""
)


@query("robust_distance", f"WITH {ROBUST} SELECT entity_id, {_distance_sql('last')} AS risk FROM p, last WHERE split = 'test'", "risk")
def _(spark, sf_dir):
    split = splits.split_dev_test(sensor_entities(spark, sf_dir))
    dev, test = (split.where(F.col("split") == s).drop("split") for s in ("dev", "test"))
    elliptic = models.REGISTRY["elliptic_envelope_pass_only"]
    fitted = models.fit(elliptic, dev, PLAIN[:2], models.class_sizes(dev), overrides={"starts": 2, "first_steps": 2, "most_steps": 2})
    return fitted.score(test).select("entity_id", "risk")


# fixed values: the registry's rows
REGISTERED = [
    ("dummy_stratified", "baseline", "classifier", "all_train", "predict_proba", "false", "true"),
    ("logistic_l1", "linear", "classifier", "all_train", "predict_proba", "true", "true"),
    ("logistic_l2", "linear", "classifier", "all_train", "predict_proba", "true", "true"),
    ("random_forest", "bagged_trees", "classifier", "all_train", "predict_proba", "true", "true"),
    ("hist_gradient_boosting", "boosted_trees", "classifier", "all_train", "predict_proba", "true", "true"),
    ("xgboost_hist", "boosted_trees", "classifier", "all_train", "predict_proba", "false", "false"),
    ("lightgbm_gbdt", "boosted_trees", "classifier", "all_train", "predict_proba", "false", "false"),
    ("knn_scaled", "distance_based", "classifier", "all_train", "predict_proba", "false", "true"),
    ("isolation_forest_pass_only", "anomaly_detection", "anomaly_detector", "pass_only", "score_samples", "true", "true"),
    ("local_outlier_factor_pass_only", "anomaly_detection", "anomaly_detector", "pass_only", "score_samples", "true", "true"),
    ("elliptic_envelope_pass_only", "anomaly_detection", "anomaly_detector", "pass_only", "score_samples", "true", "false"),
    ("one_class_svm_pass_only", "anomaly_detection", "anomaly_detector", "pass_only", "decision_function", "false", "false"),
    ("isolation_forest_all_train", "anomaly_detection", "anomaly_detector", "all_train", "score_samples", "false", "false"),
]

# The sensors with one reading missing in the oldest fifth, so that the first fold's training rows lack it.
GAPPED = "feature_003"
DUMMY = modeling.Options(models=("dummy_stratified",), feature_sets=("keep_only",))
RATE_COLUMNS = [f"{m}_at_{metrics.rate_label(r)}" for r in metrics.INSPECTION_RATES for m in ("recall", "precision", "captured_fails", "lift")]
COIN = "CAST(concat('0x', substr(md5('42:' || CAST(entity_id AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296::DOUBLE"


def gapped_sensors(spark, sf_dir):
    sensors = sensor_entities(spark, sf_dir)
    old = F.col("entity_id") < F.lit(sensors.count() / 5)
    return sensors.withColumn(GAPPED, F.when(~old, F.col(GAPPED)))


def metrics_sql(scores: str) -> str:
    """CTEs up to `measured`, the metrics of each `part` of the CTE `scores` (part, entity_id, y, risk)."""
    columns = []
    for rate in metrics.INSPECTION_RATES:
        k = f"greatest(1, CAST(round_even(max(n) * {rate}::DOUBLE, 0) AS BIGINT))"
        hit = f"coalesce(sum(y) FILTER (rn <= greatest(1, CAST(round_even(n * {rate}::DOUBLE, 0) AS BIGINT))), 0)"
        label = metrics.rate_label(rate)
        columns += [
            f"round_even({hit} / CAST(max(p) AS DOUBLE), 4) AS recall_at_{label}",
            f"round_even({hit} / CAST({k} AS DOUBLE), 4) AS precision_at_{label}",
            f"CAST({hit} AS BIGINT) AS captured_fails_at_{label}",
            f"round_even(({hit} / CAST({k} AS DOUBLE)) / (max(p) / CAST(max(n) AS DOUBLE)), 4) AS lift_at_{label}",
        ]
    return f"""m_sc AS (SELECT part, risk, count(*) AS n, sum(y) AS pos FROM {scores} GROUP BY 1, 2),
      m_cum AS (SELECT *, sum(n) OVER w AS cn, sum(pos) OVER w AS cp, sum(n) OVER (PARTITION BY part) AS tn, sum(pos) OVER (PARTITION BY part) AS tp
                FROM m_sc WINDOW w AS (PARTITION BY part ORDER BY risk DESC)),
      m_disc AS (SELECT part, sum(pos / CAST(tp AS DOUBLE) * cp / cn) AS pr_auc,
                        sum(pos * ((tn - tp) - (cn - cp) + (n - pos) / 2.0)) / max(CAST(tp AS DOUBLE) * (tn - tp)) AS roc_auc FROM m_cum GROUP BY part),
      m_med AS (SELECT part, median(risk) AS cut FROM {scores} GROUP BY part),
      m_cells AS (SELECT part, count(*) FILTER (risk >= cut AND y = 1) AS tp, count(*) FILTER (risk >= cut AND y = 0) AS fp,
                         count(*) FILTER (risk < cut AND y = 1) AS fn, count(*) FILTER (risk < cut AND y = 0) AS tn FROM {scores} JOIN m_med USING (part) GROUP BY part),
      m_rank AS (SELECT part, y, row_number() OVER (PARTITION BY part ORDER BY risk DESC, md5('0:' || CAST(entity_id AS VARCHAR))) AS rn,
                        count(*) OVER (PARTITION BY part) AS n, sum(y) OVER (PARTITION BY part) AS p FROM {scores}),
      m_hits AS (SELECT part, {", ".join(columns)} FROM m_rank GROUP BY part),
      measured AS (SELECT part, pr_auc, roc_auc, tp / CAST(tp + fp AS DOUBLE) AS precision, tp / CAST(tp + fn AS DOUBLE) AS recall,
                          2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) AS f1, (tp / CAST(tp + fn AS DOUBLE) + tn / CAST(tn + fp AS DOUBLE)) / 2 AS balanced_accuracy,
                          {", ".join(RATE_COLUMNS)} FROM m_disc JOIN m_cells USING (part) JOIN m_hits USING (part))"""


ALL_FEATURES = [f"feature_{i:03d}" for i in range(1, SENSORS + 1)]
GAPS = """gap AS (SELECT f.fold, count(*) FILTER (s.entity_id >= (SELECT count(*) FROM embeddings) / 5.0::DOUBLE) = 0 AS dropped
                  FROM folds f JOIN dt s ON s.split = 'dev' AND s.d <= f.train_end_date GROUP BY 1)"""
RATED = [c for c in RATE_COLUMNS if not c.startswith("captured")]


@query(
    "walk_forward_results",
    f"""WITH {FOLDS}, {GAPS}, wf AS (
          SELECT f.fold AS part, entity_id, CASE WHEN yield_label = 1 THEN 1 ELSE 0 END AS y,
                 CASE WHEN {COIN} < train_fails / CAST(train_rows AS DOUBLE) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS risk
          FROM dt JOIN folds f ON dt.split = 'dev' AND dt.d BETWEEN f.test_start_date AND f.test_end_date), {metrics_sql("wf")}
        SELECT 'dummy_stratified' AS model, 'keep_only' AS feature_set, f.fold, n_splits, 'baseline' AS model_family, 'classifier' AS model_kind,
               false AS final_eligible, true AS enabled, '' AS skip_reason, {SENSORS} AS n_features_requested,
               CASE WHEN dropped THEN {SENSORS - 1} ELSE {SENSORS} END AS n_features_used, CASE WHEN dropped THEN '{GAPPED}' ELSE '' END AS dropped_all_missing_features,
               CAST(train_start_date AS VARCHAR) AS train_start_date, CAST(train_end_date AS VARCHAR) AS train_end_date,
               CAST(test_start_date AS VARCHAR) AS test_start_date, CAST(test_end_date AS VARCHAR) AS test_end_date, train_fails, test_fails,
               {SENSORS} AS n_features_selected, '["{'","'.join(ALL_FEATURES)}"]' AS selected_features, measured.* EXCLUDE (part)
        FROM folds f JOIN measured ON f.fold = part JOIN gap ON f.fold = gap.fold""",
    " ".join(["pr_auc roc_auc precision recall f1 balanced_accuracy", *RATED]),
)
def _(spark, sf_dir):
    sensors = gapped_sensors(spark, sf_dir)
    dev, _ = splits.dev_and_test(sensors)
    results = modeling.walk_forward(dev, feature_catalog(sensors), DUMMY).results
    return results.withColumn("selected_features", F.to_json("selected_features"))


@query("walk_forward_logistic")
def _(spark, sf_dir):
    sensors = sensor_entities(spark, sf_dir)
    dev, _ = splits.dev_and_test(sensors)
    results = modeling.walk_forward(dev, feature_catalog(sensors), SMALL).results
    return results.withColumn("selected_features", F.to_json("selected_features"))


@query("final_test_confusion")
def _(spark, sf_dir):
    one = modeling.Options(models=("logistic_l2",), feature_sets=("top_20_effect",))
    return modeling.run_modeling(sensor_entities(spark, sf_dir), options=one).confusion


@query(
    "random_split_comparison",
    f"""WITH {SENSORS_SQL}, h AS (
          SELECT entity_id, CASE WHEN yield_label = 1 THEN 1 ELSE 0 END AS y,
                 row_number() OVER (PARTITION BY yield_label ORDER BY md5('42:' || CAST(entity_id AS VARCHAR))) AS rn, count(*) OVER (PARTITION BY yield_label) AS n FROM sens),
        s AS (SELECT entity_id, y, rn > round_even(n * CAST(0.3 AS DOUBLE), 0) AS trains FROM h),
        prior AS (SELECT '{modeling.RANDOM_SPLIT}' AS protocol, avg(y) AS prior FROM s WHERE trains UNION ALL SELECT '{modeling.UNDERSAMPLED_SPLIT}', 0.5::DOUBLE),
        rs AS (SELECT protocol AS part, entity_id, y, CASE WHEN {COIN} < prior THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS risk FROM s, prior WHERE NOT trains),
        {metrics_sql("rs")}
        SELECT 'dummy_stratified' AS model, 'keep_only' AS feature_set, {SENSORS} AS n_features, part AS evaluation_protocol,
               pr_auc AS test_pr_auc, roc_auc AS test_roc_auc, precision AS test_precision, recall AS test_recall, f1 AS test_f1, {", ".join(RATE_COLUMNS)} FROM measured""",
    " ".join(["test_pr_auc test_roc_auc test_precision test_recall test_f1", *RATED]),
)
def _(spark, sf_dir):
    return modeling.random_split_comparison(sensor_entities(spark, sf_dir), options=DUMMY)


@query("random_split_logistic")
def _(spark, sf_dir):
    one = modeling.Options(models=("logistic_l1",), feature_sets=("keep_only",))
    return modeling.random_split_comparison(sensor_entities(spark, sf_dir), options=one)


@query(
    "forest_samples",
    f"""WITH {SENSORS_SQL}, t AS (SELECT CAST(unnest(range(20)) AS INTEGER) AS tree), h AS (
          SELECT tree, entity_id, md5('42:' || tree || ':' || entity_id) AS digest, (SELECT count(*) FROM sens) AS n FROM sens, t),
        kept AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY digest, entity_id) AS rn FROM h
                 WHERE 128 >= n OR substr(digest, 1, 8) < printf('%08x', CAST(floor(128 / CAST(n AS DOUBLE) * 4294967296::DOUBLE) AS BIGINT)))
        SELECT tree, entity_id FROM kept WHERE rn <= 64""",
)
def _(spark, sf_dir):
    points = prepare(sensor_entities(spark, sf_dir), PLAIN, False)
    return forest.tree_samples(points, points.count(), 20, 64, 42, "entity_id").select("tree", "entity_id")


@query(
    "model_registry",
    "SELECT m.*, n AS n_vectors FROM (VALUES "
    + ", ".join(
        f"('{m}', '{family}', '{kind}', '{mode}', '{score}', {eligible}, {enabled})"
        for m, family, kind, mode, score, eligible, enabled in REGISTERED
    )
    + ") m(model_id, model_family, model_kind, fit_mode, score_method, final_eligible, enabled), (SELECT count(*) AS n FROM embeddings)",
)
def _(spark, sf_dir):
    """The registry next to the number of vectors that each model would see."""
    n = spark.read.parquet(f"{sf_dir}/embeddings.parquet").agg(F.count("*").alias("n_vectors"))
    return models.model_registry(spark).drop("skip_reason").join(F.broadcast(n))


@query(
    "slowest_configs",
    """SELECT l_linestatus AS model, l_returnflag AS feature_set, sum(l_quantity) AS elapsed, CAST(row_number() OVER (ORDER BY sum(l_quantity) DESC, l_linestatus, l_returnflag) AS INTEGER) AS place
       FROM lineitem GROUP BY 1, 2 QUALIFY place <= 3""",
    "elapsed",
)
def _(spark, sf_dir):
    times = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy(F.col("l_linestatus").alias("model"), F.col("l_returnflag").alias("feature_set"))
    slowest = modeling.slowest_configs(times.agg(F.sum("l_quantity").alias("elapsed")))
    return slowest.withColumn("place", F.row_number().over(Window.orderBy(F.desc("elapsed"), "model", "feature_set")))
