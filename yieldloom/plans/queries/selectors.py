"""Queries over fold-local statistics, selection and preprocessing."""

from pyspark.sql import functions as F

from yieldloom.operators import selectors
from yieldloom.operators.information import neighbor_information
from yieldloom.operators.preprocess import input_statistics, inputs_table, read_inputs
from yieldloom.operators.profile import feature_catalog
from yieldloom.operators.splits import expanding_folds, read_folds
from yieldloom.plans.queries.splits import FOLDS, dev_sensors
from yieldloom.plans.registry import CATALOG, LONG, query
from yieldloom.recipes import lot_entities

SCORE_TABLES = """med AS (SELECT fold, ordinal, median(v) AS m, count(v) AS nv, count(*) AS nrows, sum(y) AS p, count(DISTINCT v) AS dv FROM tr GROUP BY 1, 2),
  fil AS (SELECT tr.fold, tr.ordinal, y, coalesce(v, m) AS x, nrows, p FROM tr JOIN med ON tr.fold = med.fold AND tr.ordinal = med.ordinal WHERE coalesce(v, m) IS NOT NULL),
  rk AS (SELECT *, rank() OVER (PARTITION BY fold, ordinal ORDER BY x) AS r, count(*) OVER (PARTITION BY fold, ordinal, x) AS ties FROM fil),
  agg AS (SELECT fold, ordinal, sum(CASE WHEN y = 1 THEN r + (ties - 1) / 2.0 ELSE 0 END) - max(p) * (max(p) + 1) / 2.0 AS won,
                 max(p) * (max(nrows) - max(p)) AS pairs, avg(x) AS fill_mean, stddev_pop(x) AS fill_std FROM rk GROUP BY 1, 2),
  cells AS (SELECT fold, ordinal, floor((r - 1) * 16 / nrows) AS bin, CAST(count(*) AS DOUBLE) AS n, CAST(sum(y) AS DOUBLE) AS pos,
                   CAST(max(nrows) AS DOUBLE) AS nr, CAST(max(p) AS DOUBLE) AS p FROM rk GROUP BY 1, 2, 3),
  mi AS (SELECT fold, ordinal, sum(CASE WHEN pos > 0 THEN pos / nr * ln(pos * nr / (n * p)) ELSE 0 END
                 + CASE WHEN n > pos THEN (n - pos) / nr * ln((n - pos) * nr / (n * (nr - p))) ELSE 0 END) AS mi FROM cells GROUP BY 1, 2),
  coh AS (SELECT fold, ordinal, abs(avg(v) FILTER (y = 0) - avg(v) FILTER (y = 1)) AS gap,
                 sqrt(((count(v) FILTER (y = 0) - 1) * var_samp(v) FILTER (y = 0) + (count(v) FILTER (y = 1) - 1) * var_samp(v) FILTER (y = 1)) / (count(v) - 2)) AS sd
          FROM tr GROUP BY 1, 2),
  scores AS (SELECT CAST(med.fold AS INTEGER) AS fold, CAST(med.ordinal AS INTEGER) AS feature_ordinal,
                    'feature_' || lpad(CAST(med.ordinal + 1 AS VARCHAR), 3, '0') AS feature_name,
                    med.nrows AS "rows", CAST(med.p AS BIGINT) AS fail_rows, med.nrows - med.nv AS null_count, med.nv AS value_count,
                    CASE WHEN med.dv > 1 AND coh.sd > 0 THEN gap / sd ELSE 0 END AS cohens_d,
                    CASE WHEN med.dv > 1 THEN abs(2 * agg.won - agg.pairs) / (2.0 * agg.pairs) ELSE 0 END AS auc_gap,
                    CASE WHEN med.dv > 1 THEN greatest(mi.mi, 0) ELSE 0 END AS mutual_info,
                    med.m AS median, agg.fill_mean, CASE WHEN med.dv = 1 THEN 0 ELSE agg.fill_std END AS fill_std
             FROM med LEFT JOIN agg ON med.fold = agg.fold AND med.ordinal = agg.ordinal
                      LEFT JOIN mi ON med.fold = mi.fold AND med.ordinal = mi.ordinal
                      LEFT JOIN coh ON med.fold = coh.fold AND med.ordinal = coh.ordinal)"""

SENSOR_SCORES = (
    FOLDS
    + """, tr AS (SELECT f.fold, s.ordinal, s.v, s.y FROM (
      SELECT d, CASE WHEN yield_label = 1 THEN 1 ELSE 0 END AS y, unnest(range(64)) AS ordinal, CAST(unnest(embedding) AS DOUBLE) AS v
      FROM dt WHERE split = 'dev') s JOIN folds f ON s.d < f.test_start_date), """
    + SCORE_TABLES
)
LOT_TRAIN = CATALOG + """, tr AS (SELECT 1 AS fold, ordinal, v, CASE WHEN yield_label = 1 THEN 1 ELSE 0 END AS y FROM long), """
LOT_SCORES = LOT_TRAIN + SCORE_TABLES
SCORE_DOUBLES = "cohens_d auc_gap mutual_info median fill_mean fill_std"

LOT_PAIRS = """pairs AS (
  SELECT a.feature_name AS feature_i, b.feature_name AS feature_j, a.ordinal AS i, b.ordinal AS j, count(*) FILTER (a.v IS NOT NULL AND b.v IS NOT NULL) AS n,
         CASE WHEN stddev_pop(CASE WHEN b.v IS NOT NULL THEN a.v END) > 0 AND stddev_pop(CASE WHEN a.v IS NOT NULL THEN b.v END) > 0 THEN corr(a.v, b.v) END AS r
  FROM long a JOIN long b ON a.entity_id = b.entity_id AND a.ordinal < b.ordinal GROUP BY 1, 2, 3, 4)"""


def sensor_scores(spark, sf_dir):
    dev = dev_sensors(spark, sf_dir)
    folds = read_folds(expanding_folds(dev))
    return selectors.feature_scores(dev, [f.in_train() for f in folds])


def lot_scores(lots):
    return selectors.feature_scores(lots, [F.lit(True)])


def top_sql(score: str, n: int) -> str:
    return f"""WITH {SENSOR_SCORES} SELECT fold, position, feature_name FROM (
      SELECT fold, feature_name, CAST(row_number() OVER (PARTITION BY fold ORDER BY round({score}, 12) DESC, feature_ordinal) AS INTEGER) AS position FROM scores)
      WHERE position <= {n}"""


@query("fold_feature_scores", f"WITH {SENSOR_SCORES} SELECT * FROM scores", SCORE_DOUBLES)
def _(spark, sf_dir):
    return sensor_scores(spark, sf_dir)


@query("feature_scores_with_missing", f"WITH {LOT_SCORES} SELECT * FROM scores", SCORE_DOUBLES)
def _(spark, sf_dir):
    return lot_scores(lot_entities(spark, sf_dir))


@query("top_20_effect_per_fold", top_sql("cohens_d", 20))
def _(spark, sf_dir):
    return selectors.top_by_score(sensor_scores(spark, sf_dir), "cohens_d", 20)


@query("top_25_auc_gap_per_fold", top_sql("auc_gap", 25))
def _(spark, sf_dir):
    return selectors.top_by_score(sensor_scores(spark, sf_dir), "auc_gap", 25)


@query("top_25_mutual_info_per_fold", top_sql("mutual_info", 25))
def _(spark, sf_dir):
    return selectors.top_by_score(sensor_scores(spark, sf_dir), "mutual_info", 25)


# All pairs of entities of a fold; the digits of 1e-10, the neighbours and Euler's constant are fixed values.
NEIGHBOR_INFORMATION = (
    FOLDS
    + """, cell AS (SELECT f.fold, s.entity_id, s.ordinal, s.v, s.y FROM (
      SELECT d, entity_id, CASE WHEN yield_label = 1 THEN 1 ELSE 0 END AS y, unnest(range(64)) AS ordinal, CAST(unnest(embedding) AS DOUBLE) AS v
      FROM dt WHERE split = 'dev') s JOIN folds f ON s.d < f.test_start_date),
  spread AS (SELECT fold, ordinal, greatest(stddev_pop(v), abs(avg(v))) AS scale FROM cell GROUP BY 1, 2),
  xs AS (SELECT fold, ordinal, entity_id, y, v + CAST(1e-10 AS DOUBLE) * scale * (CAST(concat('0x', substr(md5('nudge:' || entity_id), 1, 8)) AS BIGINT) / CAST(2147483648 AS DOUBLE) - 1) AS x
         FROM cell JOIN spread USING (fold, ordinal)),
  size AS (SELECT fold, ordinal, y, count(*) AS class_size FROM xs GROUP BY 1, 2, 3),
  near AS (SELECT a.fold, a.ordinal, a.entity_id, a.y, a.x, abs(b.x - a.x) AS r,
                  row_number() OVER (PARTITION BY a.fold, a.ordinal, a.entity_id ORDER BY abs(b.x - a.x)) AS rn
           FROM xs a JOIN xs b ON a.fold = b.fold AND a.ordinal = b.ordinal AND a.y = b.y AND a.entity_id <> b.entity_id),
  rad AS (SELECT near.*, class_size FROM near JOIN size USING (fold, ordinal, y) WHERE rn = least(3, class_size - 1)),
  inner_count AS (SELECT rad.fold, rad.ordinal, rad.entity_id, rad.rn AS k, rad.class_size, greatest(count(*) FILTER (abs(b.x - rad.x) < rad.r), 1) AS m
                  FROM rad JOIN xs b ON b.fold = rad.fold AND b.ordinal = rad.ordinal GROUP BY 1, 2, 3, 4, 5),
  psi AS (SELECT n, -0.5772156649015329::DOUBLE + coalesce(sum(1.0::DOUBLE / n) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p
          FROM (SELECT unnest(range(1, (SELECT count(*) + 2 FROM dt))) AS n)),
  mi AS (SELECT fold, ordinal, greatest(0, max(whole.p) + avg(pk.p) - avg(pc.p) - avg(pm.p)) AS mutual_info
         FROM inner_count i JOIN psi pk ON pk.n = i.k JOIN psi pc ON pc.n = i.class_size JOIN psi pm ON pm.n = i.m
              JOIN (SELECT fold, ordinal, count(*) AS n FROM inner_count GROUP BY 1, 2) t USING (fold, ordinal) JOIN psi whole ON whole.n = t.n GROUP BY 1, 2)"""
)


@query(
    "neighbor_information",
    f"""WITH {NEIGHBOR_INFORMATION} SELECT CAST(fold AS INTEGER) AS fold, CAST(ordinal AS INTEGER) AS feature_ordinal,
        'feature_' || lpad(CAST(ordinal + 1 AS VARCHAR), 3, '0') AS feature_name, mutual_info FROM mi""",
    "mutual_info",
)
def _(spark, sf_dir):
    dev = dev_sensors(spark, sf_dir)
    in_train = [f.in_train() for f in read_folds(expanding_folds(dev))]
    return neighbor_information(dev, in_train, selectors.feature_scores(dev, in_train))


@query("correlation_pairs", f"WITH {LONG}, {LOT_PAIRS} SELECT CAST(1 AS INTEGER) AS fold, feature_i, feature_j, n, r FROM pairs", "r")
def _(spark, sf_dir):
    lots = lot_entities(spark, sf_dir)
    return selectors.correlations(lots, [c for c in lots.columns if c.startswith("feature_")])


@query(
    "correlation_pruned",
    f"""WITH {LONG}, {LOT_PAIRS} SELECT DISTINCT CAST(1 AS INTEGER) AS fold, CAST(ordinal AS INTEGER) AS feature_ordinal, feature_name FROM long
        WHERE feature_name NOT IN (SELECT feature_j FROM pairs WHERE abs(r) >= 0.7)""",
)
def _(spark, sf_dir):
    lots = lot_entities(spark, sf_dir)
    features = [c for c in lots.columns if c.startswith("feature_")]
    return selectors.correlation_pruned(selectors.correlations(lots, features), features, 0.70)


@query(
    "static_feature_sets",
    f"""WITH {CATALOG} SELECT 'keep_only' AS feature_set, feature_ordinal, feature_name FROM cat WHERE recommended_action = 'keep'
        UNION ALL SELECT 'keep_plus_review', feature_ordinal, feature_name FROM cat WHERE recommended_action IN ('keep', 'review_high_missing')""",
)
def _(spark, sf_dir):
    return selectors.static_feature_sets(feature_catalog(lot_entities(spark, sf_dir)))


RANKED = """SELECT '{name}' AS feature_set, feature_name, row_number() OVER (ORDER BY round({score}, 12) DESC, feature_ordinal) AS position FROM scores"""


@query(
    "resolved_feature_sets",
    f"""WITH {LOT_SCORES}, {LOT_PAIRS},
        usable AS (SELECT * FROM cat WHERE recommended_action IN ('keep', 'review_high_missing')),
        kept AS (SELECT * FROM cat WHERE recommended_action = 'keep'),
        every AS (
          SELECT 'keep_only' AS feature_set, feature_name, row_number() OVER (ORDER BY feature_ordinal) AS position FROM kept
          UNION ALL SELECT 'keep_plus_review', feature_name, row_number() OVER (ORDER BY feature_ordinal) FROM usable
          UNION ALL {RANKED.format(name="top_20_effect", score="cohens_d")}
          UNION ALL {RANKED.format(name="top_50_effect", score="cohens_d")}
          UNION ALL {RANKED.format(name="top_100_effect", score="cohens_d")}
          UNION ALL {RANKED.format(name="top_25_mutual_info", score="mutual_info")}
          UNION ALL {RANKED.format(name="top_50_mutual_info", score="mutual_info")}
          UNION ALL {RANKED.format(name="top_25_auc_gap", score="auc_gap")}
          UNION ALL {RANKED.format(name="top_50_auc_gap", score="auc_gap")}
          UNION ALL SELECT 'correlation_pruned_070', feature_name, row_number() OVER (ORDER BY feature_ordinal) FROM usable
            WHERE feature_name NOT IN (SELECT feature_j FROM pairs WHERE abs(r) >= 0.7 AND feature_i IN (SELECT feature_name FROM usable))
          UNION ALL SELECT 'correlation_pruned_085', feature_name, row_number() OVER (ORDER BY feature_ordinal) FROM usable
            WHERE feature_name NOT IN (SELECT feature_j FROM pairs WHERE abs(r) >= 0.85 AND feature_i IN (SELECT feature_name FROM usable))
          UNION ALL SELECT 'missingness_indicators_keep', name, row_number() OVER (ORDER BY part, feature_ordinal) FROM (
            SELECT feature_name AS name, 0 AS part, feature_ordinal FROM kept
            UNION ALL SELECT feature_name || '_missing', 1, feature_ordinal FROM kept WHERE null_count > 0))
        SELECT feature_set, CAST(1 AS INTEGER) AS fold, CAST(position AS INTEGER) AS position, feature_name FROM every""",
)
def _(spark, sf_dir):
    lots = lot_entities(spark, sf_dir)
    catalog = feature_catalog(lots)
    usable = [f"feature_{i:03d}" for i in (1, 2, 3, 4, 7)]
    return selectors.resolve_feature_sets(lot_scores(lots), catalog, selectors.correlations(lots, usable))


def _input_sql(ordinal: int) -> str:
    name = f"feature_{ordinal + 1:03d}"
    stat = f"(SELECT {{}} FROM scores WHERE feature_ordinal = {ordinal})"
    return f"(coalesce({name}, {stat.format('median')}) - {stat.format('fill_mean')}) / {stat.format('fill_std')} AS {name}"


@query(
    "standardized_inputs",
    f"WITH {LOT_SCORES} SELECT entity_id, CASE WHEN yield_label = 1 THEN 1 ELSE 0 END AS y, "
    + ", ".join(_input_sql(i) for i in (0, 1, 2, 6))
    + ", (CASE WHEN feature_003 IS NULL THEN 1.0 ELSE 0.0 END - (SELECT null_count / CAST(\"rows\" AS DOUBLE) FROM scores WHERE feature_ordinal = 2))"
    + " / (SELECT sqrt(null_count / CAST(\"rows\" AS DOUBLE) * (1 - null_count / CAST(\"rows\" AS DOUBLE))) FROM scores WHERE feature_ordinal = 2) AS feature_003_missing FROM lots",
    "feature_001 feature_002 feature_003 feature_007 feature_003_missing",
)
def _(spark, sf_dir):
    lots = lot_entities(spark, sf_dir)
    scores = lot_scores(lots)
    resolved = selectors.resolve_feature_sets(scores, feature_catalog(lots), names=["missingness_indicators_keep"])
    inputs = read_inputs(input_statistics(resolved, scores))
    return inputs_table(lots, inputs["missingness_indicators_keep", 1].inputs, scale=True)
