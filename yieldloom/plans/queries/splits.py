"""Queries over the split operators."""

from pyspark.sql import functions as F

from yieldloom.operators import splits
from yieldloom.plans.registry import LOTS, SENSORS, query
from yieldloom.recipes import lot_entities, sensor_entities

DEV_TEST = SENSORS + """, dated AS (SELECT *, CAST(test_timestamp AS DATE) AS d FROM sens),
  dord AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS o, count(*) OVER () AS n FROM (SELECT DISTINCT d FROM dated)),
  sides AS (SELECT d, CASE WHEN o >= n - greatest(1, round_even(n * 0.15, 0)) THEN 'test' ELSE 'dev' END AS split FROM dord),
  dt AS (SELECT dated.*, split FROM dated JOIN sides USING (d))"""

FOLDS = DEV_TEST + """, dd AS (
    SELECT d, count(*) AS n_rows, sum(CASE WHEN yield_label = 1 THEN 1 ELSE 0 END) AS fails FROM dt WHERE split = 'dev' GROUP BY d),
  do2 AS (SELECT d, n_rows, fails, row_number() OVER (ORDER BY d) - 1 AS o FROM dd),
  tot AS (SELECT count(*) AS nd, sum(fails) AS nf FROM do2),
  lay AS (SELECT s, i, i * nd // (s + 1) AS lo, (i + 1) * nd // (s + 1) AS hi
          FROM (SELECT unnest(range(1, 5)) AS s) a, (SELECT unnest(range(1, 5)) AS i) b, tot
          WHERE i <= s AND nd > s AND nf >= (s + 1) * 8),
  stats AS (SELECT s, i, lo, hi,
              (SELECT sum(fails) FROM do2 WHERE o < lo) AS train_fails, (SELECT sum(n_rows) FROM do2 WHERE o < lo) AS train_rows,
              (SELECT sum(fails) FROM do2 WHERE o >= lo AND o < hi) AS test_fails, (SELECT sum(n_rows) FROM do2 WHERE o >= lo AND o < hi) AS test_rows,
              (SELECT max(d) FROM do2 WHERE o < lo) AS train_end_date, (SELECT min(d) FROM do2 WHERE o >= lo AND o < hi) AS test_start_date,
              (SELECT max(d) FROM do2 WHERE o >= lo AND o < hi) AS test_end_date
            FROM lay),
  good AS (SELECT s FROM stats WHERE train_fails >= 8 AND test_fails >= 8 GROUP BY s HAVING count(*) = s),
  folds AS (SELECT CAST(s AS INTEGER) AS n_splits, CAST(i AS INTEGER) AS fold, (SELECT min(d) FROM do2) AS train_start_date, train_end_date,
              test_start_date, test_end_date, CAST(train_rows AS BIGINT) AS train_rows, CAST(test_rows AS BIGINT) AS test_rows,
              CAST(train_fails AS BIGINT) AS train_fails, CAST(test_fails AS BIGINT) AS test_fails
            FROM stats WHERE s = (SELECT max(s) FROM good))"""


def dev_sensors(spark, sf_dir):
    return splits.split_dev_test(sensor_entities(spark, sf_dir)).where("split = 'dev'").drop("split")


@query(
    "dev_test_split",
    f"WITH {DEV_TEST} SELECT entity_id, test_timestamp, yield_label, split FROM dt",
)
def _(spark, sf_dir):
    split = splits.split_dev_test(sensor_entities(spark, sf_dir))
    return split.select("entity_id", "test_timestamp", "yield_label", "split")


@query(
    "chronological_entities",
    f"WITH {LOTS} SELECT entity_id, test_timestamp, yield_label FROM lots",
)
def _(spark, sf_dir):
    return lot_entities(spark, sf_dir).select("entity_id", "test_timestamp", "yield_label").orderBy("test_timestamp", "entity_id")


@query(
    "date_ordinals",
    f"""WITH {LOTS}, dd AS (SELECT CAST(test_timestamp AS DATE) AS event_date, count(*) AS row_count,
          CAST(sum(CASE WHEN yield_label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fail_count FROM lots GROUP BY 1)
        SELECT *, CAST(row_number() OVER (ORDER BY event_date) - 1 AS INTEGER) AS date_ordinal,
               CAST(sum(row_count) OVER (ORDER BY event_date) AS BIGINT) AS rows_so_far,
               CAST(sum(fail_count) OVER (ORDER BY event_date) AS BIGINT) AS fails_so_far FROM dd""",
)
def _(spark, sf_dir):
    return splits.date_counts(lot_entities(spark, sf_dir))


@query("expanding_folds", f"WITH {FOLDS} SELECT * FROM folds")
def _(spark, sf_dir):
    return splits.expanding_folds(dev_sensors(spark, sf_dir))


@query(
    "fold_membership",
    f"""WITH {FOLDS} SELECT dt.entity_id, f.fold, CASE WHEN dt.d < f.test_start_date THEN 'train' ELSE 'test' END AS role
        FROM dt JOIN folds f ON dt.d <= f.test_end_date WHERE dt.split = 'dev'""",
)
def _(spark, sf_dir):
    dev = dev_sensors(spark, sf_dir)
    return splits.assign_folds(dev, splits.expanding_folds(dev)).select("entity_id", "fold", "role")


@query(
    "stratified_split",
    f"""WITH {LOTS}, h AS (SELECT entity_id, yield_label, row_number() OVER (PARTITION BY yield_label ORDER BY md5('42:' || entity_id)) AS rn,
          count(*) OVER (PARTITION BY yield_label) AS n FROM lots)
        SELECT entity_id, yield_label, CASE WHEN rn <= round_even(n * CAST(0.3 AS DOUBLE), 0) THEN 'test' ELSE 'train' END AS split FROM h""",
)
def _(spark, sf_dir):
    return splits.stratified_split(lot_entities(spark, sf_dir)).select("entity_id", "yield_label", "split")


@query(
    "undersampled_passes",
    f"""WITH {LOTS}, h AS (SELECT entity_id, yield_label, row_number() OVER (PARTITION BY yield_label ORDER BY md5('42:' || entity_id)) AS rn FROM lots)
        SELECT entity_id, yield_label FROM h WHERE yield_label = 1 OR rn <= (SELECT count(*) FROM lots WHERE yield_label = 1)""",
)
def _(spark, sf_dir):
    return splits.undersample(lot_entities(spark, sf_dir)).select("entity_id", "yield_label")


@query(
    "class_weights",
    f"""WITH {LOTS}, c AS (SELECT CASE WHEN yield_label = 1 THEN 1 ELSE 0 END AS y, count(*) AS class_count FROM lots GROUP BY 1)
        SELECT y, class_count, (SELECT sum(class_count) FROM c) / (2.0 * class_count) AS weight,
               CASE WHEN y = 1 THEN ((SELECT sum(class_count) FROM c) - class_count) / CAST(class_count AS DOUBLE) ELSE 1.0 END AS scale_pos_weight FROM c""",
    "weight scale_pos_weight",
)
def _(spark, sf_dir):
    return splits.class_weights(lot_entities(spark, sf_dir))
