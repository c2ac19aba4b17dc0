"""Queries over boosted trees: the first tree of the lots, written out in SQL level by level."""

from pyspark.sql import functions as F

from yieldloom.operators import boosting
from yieldloom.operators.preprocess import Input, raw_table
from yieldloom.plans import models
from yieldloom.plans.registry import LONG, query
from yieldloom.recipes import lot_entities

FEATURES = [f"feature_{i:03d}" for i in range(1, 8)]
STUMP = boosting.Settings(rounds=1, max_depth=2)
# fixed values: bins, the missing bin and the scale of whole-numbered gradients
BINNED = f"""{LONG}, cnt AS (SELECT ordinal, v, count(*) AS n FROM long WHERE v IS NOT NULL GROUP BY 1, 2),
  rk AS (SELECT ordinal, v, sum(n) OVER (PARTITION BY ordinal ORDER BY v) - n AS before, row_number() OVER (PARTITION BY ordinal ORDER BY v) - 1 AS place,
                count(*) OVER (PARTITION BY ordinal) AS dv, sum(n) OVER (PARTITION BY ordinal) AS total FROM cnt),
  bd AS (SELECT ordinal, v, dense_rank() OVER (PARTITION BY ordinal ORDER BY CASE WHEN dv <= 255 THEN place ELSE (before * 255) // total END) - 1 AS b FROM rk),
  cuts AS (SELECT ordinal, b, (max(v) + lead(min(v)) OVER (PARTITION BY ordinal ORDER BY b)) / 2 AS cut FROM bd GROUP BY 1, 2),
  pr AS (SELECT count(*) FILTER (yield_label = 1) / CAST(count(*) AS DOUBLE) AS p FROM lots),
  x AS (SELECT entity_id, long.ordinal, coalesce(b, 255) AS b, CAST(yield_label = 1 AS INT) AS y,
               CAST(round_even((p - CAST(yield_label = 1 AS INT)) * 16777216, 0) AS BIGINT) AS g, CAST(round_even(p * (1 - p) * 16777216, 0) AS BIGINT) AS h
        FROM long LEFT JOIN bd ON bd.ordinal = long.ordinal AND bd.v = long.v, pr),
  m0 AS (SELECT 0 AS node, entity_id FROM lots)"""


def _strength(g: str, h: str) -> str:
    return f"CAST({g} AS DOUBLE) * {g} / ({h} * 16777216.0::DOUBLE)"


def level(d: int) -> str:
    """CTEs best<d>, the split of every node of level d, and m<d+1>, the node of every lot below."""
    gain = f"{_strength('bg', 'bh')} + {_strength('(ag - bg)', '(ah - bh)')} - {_strength('ag', 'ah')}"
    return f"""c{d} AS (SELECT node, ordinal, b, CAST(sum(g) AS BIGINT) AS g, CAST(sum(h) AS BIGINT) AS h, count(*) AS n FROM x JOIN m{d} USING (entity_id) GROUP BY 1, 2, 3),
  t{d} AS (SELECT node, ordinal, b, sum(g) OVER w AS lg, sum(h) OVER w AS lh, sum(n) OVER w AS ln, sum(g) OVER a AS ag, sum(h) OVER a AS ah, sum(n) OVER a AS an,
                  sum(CASE WHEN b = 255 THEN g ELSE 0 END) OVER a AS mg, sum(CASE WHEN b = 255 THEN h ELSE 0 END) OVER a AS mh, sum(CASE WHEN b = 255 THEN n ELSE 0 END) OVER a AS mn
           FROM c{d} WINDOW w AS (PARTITION BY node, ordinal ORDER BY b), a AS (PARTITION BY node, ordinal)),
  s{d} AS (SELECT *, lg + side * mg AS bg, lh + side * mh AS bh, ln + side * mn AS bn, CASE WHEN mn > 0 THEN side = 1 ELSE ln > an - ln END AS missing_below
           FROM t{d}, (SELECT unnest([0, 1]) AS side) WHERE b < 255 AND (side = 0 OR mn > 0)),
  q{d} AS (SELECT *, {gain} AS gain FROM s{d} WHERE least(bn, an - bn) >= {STUMP.min_leaf} AND least(bh, ah - bh) >= 0.001 * 16777216),
  best{d} AS (SELECT * FROM q{d} WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, ordinal, b, side) = 1),
  m{d + 1} AS (SELECT 2 * node + CASE WHEN CASE WHEN x.b = 255 THEN missing_below ELSE x.b <= best{d}.b END THEN 1 ELSE 2 END AS node, entity_id
               FROM m{d} JOIN best{d} USING (node) JOIN x USING (entity_id) WHERE x.ordinal = best{d}.ordinal)"""


@query(
    "boosting_splits",
    f"""WITH {BINNED}, {level(0)}, {level(1)}
        SELECT CAST(node AS INTEGER) AS node, 'feature_' || lpad(CAST(s.ordinal + 1 AS VARCHAR), 3, '0') AS feature_name, coalesce(cut, 'Infinity'::DOUBLE) AS cut,
               missing_below, gain, CAST(an AS BIGINT) AS "rows"
        FROM (SELECT * FROM best0 UNION ALL SELECT * FROM best1) s LEFT JOIN cuts ON cuts.ordinal = s.ordinal AND cuts.b = s.b""",
    "cut gain",
)
def _(spark, sf_dir):
    lots = lot_entities(spark, sf_dir)
    inputs = [Input(f, f, False, None, 0.0, 1.0) for f in FEATURES]
    _, nodes = boosting.fit_boosting(raw_table(lots, inputs), FEATURES, STUMP)
    name = F.element_at(F.array(*[F.lit(f) for f in FEATURES]), F.col("feature") + 1)
    return nodes.where("feature >= 0").select("node", name.alias("feature_name"), "cut", "missing_below", "gain", "rows")


@query(
    "boosting_risks",
    f"""WITH {BINNED}, {level(0)}, {level(1)},
        leaf AS (SELECT entity_id, coalesce(m2.node, m1.node) AS node FROM m1 LEFT JOIN m2 USING (entity_id)),
        risks AS (SELECT node, ln(p / (1 - p)) - {STUMP.step} * sum(g) / sum(h) AS raw, count(*) AS n, sum(y) AS fails FROM leaf JOIN x USING (entity_id), pr WHERE ordinal = 0 GROUP BY node, p)
        SELECT round(1 / (1 + exp(-raw)), 6) AS risk, CAST(sum(n) AS BIGINT) AS entities, CAST(sum(fails) AS BIGINT) AS fails FROM risks GROUP BY 1""",
    "risk",
)
def _(spark, sf_dir):
    """Entities and fails of every risk the booster gives; missing values are routed, not filled."""
    lots = lot_entities(spark, sf_dir)
    inputs = [Input(f, f, False, None, 0.0, 1.0) for f in FEATURES]
    booster = models.REGISTRY["hist_gradient_boosting"]
    fitted = models.fit(booster, lots, inputs, models.class_sizes(lots), overrides={"rounds": 1, "max_depth": 2})
    scores = fitted.score(lots).groupBy(F.round("risk", 6).alias("risk"))
    return scores.agg(F.count("*").alias("entities"), F.sum("y_true").alias("fails"))
