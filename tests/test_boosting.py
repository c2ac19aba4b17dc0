"""Boosted trees against a plain single-process version, and the routing of missing values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from yieldloom.operators import boosting
from yieldloom.operators.boosting import BINS, SCALE, Settings

INPUTS = ["a", "b", "c", "d"]


def table(spark, x, y):
    rows = [(i, int(t), *[None if np.isnan(v) else float(v) for v in row]) for i, (row, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "entity_id long, y int, " + ", ".join(f"{c} double" for c in INPUTS))


def sample(seed=3, n=700):
    random = np.random.default_rng(seed)
    x = random.normal(size=(n, 4))
    x[:, 1] = np.round(x[:, 1])
    x[random.random(n) < 0.3, 2] = np.nan
    x[:, 3] = 1.0
    odds = x[:, 0] + 0.5 * x[:, 1] + np.where(np.isnan(x[:, 2]), 1.5, -x[:, 2])
    return x, (random.random(n) < 1 / (1 + np.exp(-odds))).astype(int)


def plain_edges(x, bins=BINS):
    out = []
    for column in x.T:
        held = np.sort(column[~np.isnan(column)])
        values, first = np.unique(held, return_index=True)
        place = np.arange(len(values)) if len(values) <= bins else first * bins // len(held)
        out.append([(values[i] + values[i + 1]) / 2 for i in range(len(values) - 1) if place[i] != place[i + 1]])
    return out


def plain_split(x, g, h, edges, s):
    """Best (gain, feature, cut number, missing_below) over one node's rows."""
    best = None
    for f in range(x.shape[1]):
        lacks = np.isnan(x[:, f])
        bins = np.searchsorted(edges[f], x[:, f])
        for cut in range(len(edges[f]) + 1):
            for missing_below in (False, True) if lacks.any() else (None,):
                below = np.where(lacks, bool(missing_below), bins <= cut)
                if min(below.sum(), (~below).sum()) < s.min_leaf:
                    continue
                parts = [(int(g[m].sum()), int(h[m].sum())) for m in (below, ~below, np.ones(len(x), bool))]
                if min(p[1] for p in parts[:2]) < boosting.LEAST_CURVATURE * SCALE:
                    continue
                a, b, whole = (float(gs) * gs / ((hs + s.l2 * SCALE) * SCALE) for gs, hs in parts)
                gain = a + b - whole
                goes = below.sum() > (~below).sum() if missing_below is None else missing_below
                key = (gain, -f, -cut, not goes)
                if gain > 0 and (best is None or key > best[0]):
                    best = (key, f, cut, bool(goes), below, parts)
    return best


def plain_scores(x, y, s):
    edges = plain_edges(x)
    share = y.mean()
    raw = np.full(len(y), np.log(share / (1 - share)))
    gains = []
    for _ in range(s.rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = np.rint((p - y) * SCALE), np.rint(p * (1 - p) * SCALE)
        open_ = []

        def consider(rows, depth):
            found = plain_split(x[rows], g[rows], h[rows], edges, s) if depth < s.max_depth and len(rows) >= 2 * s.min_leaf else None
            open_.append((found[0][0] if found else 0.0, rows, depth, found))

        consider(np.arange(len(y)), 0)
        while open_:
            splittable = [o for o in open_ if o[3]]
            if not splittable or len(open_) >= s.max_leaves:
                break
            node = max(splittable, key=lambda o: o[0])
            open_ = [o for o in open_ if o is not node]
            gains.append(node[0])
            consider(node[1][node[3][4]], node[2] + 1)
            consider(node[1][~node[3][4]], node[2] + 1)
        leaves = [o[1] for o in open_]
        if len(leaves) == 1:
            break
        for rows in leaves:
            raw[rows] += -s.step * (g[rows].sum() / SCALE) / (h[rows].sum() / SCALE + s.l2 + 1e-15)
    return 1 / (1 + np.exp(-raw)), gains


@pytest.mark.parametrize("settings", [Settings(rounds=3, max_depth=3, min_leaf=20), Settings(rounds=2, max_depth=4, max_leaves=6, min_leaf=5, l2=1.0)])
def test_trees_are_those_of_plain_growing(spark, settings):
    x, y = sample()
    rows = table(spark, x, y)
    base, nodes = boosting.fit_boosting(rows, INPUTS, settings)
    got = {r.entity_id: r.risk for r in boosting.score_boosting(rows, INPUTS, nodes, base).collect()}
    want, gains = plain_scores(x, y, settings)
    assert [got[i] for i in range(len(y))] == pytest.approx(want.tolist(), abs=1e-12)
    held = sorted(r.gain for r in nodes.where("feature >= 0").collect())
    assert held == pytest.approx(sorted(gains), rel=1e-9)
    assert nodes.where("feature < 0").groupBy("tree").count().agg(F.max("count")).head()[0] <= settings.max_leaves


def test_scores_settle_between_trees_and_do_not_depend_on_partitions(spark, monkeypatch):
    x, y = sample(5, 300)
    settings = Settings(rounds=5, max_depth=2, min_leaf=10)
    base, nodes = boosting.fit_boosting(table(spark, x, y), INPUTS, settings)
    monkeypatch.setattr(boosting, "TREES_PER_STATE", 2)
    monkeypatch.setattr(boosting, "CELL_BYTES", 1)
    again, others = boosting.fit_boosting(table(spark, x, y).repartition(7), INPUTS, settings)
    rows = lambda df: sorted(tuple(r) for r in df.drop("value").collect())
    assert base == again and rows(nodes) == rows(others)


def test_missing_rows_take_the_side_that_gains(spark):
    x, y = sample()
    only = np.where(np.isnan(x[:, 2]), np.nan, 0.0)
    x = np.column_stack([np.zeros(len(y)), np.zeros(len(y)), only, np.ones(len(y))])
    y = np.isnan(only).astype(int)
    rows = table(spark, x, y)
    base, nodes = boosting.fit_boosting(rows, INPUTS, Settings(rounds=1, max_depth=1))
    root = nodes.where("node = 0").head()
    assert (root.feature, root.cut, root.missing_below) == (2, float("inf"), False)
    risks = {r.y: r.risk for r in rows.join(boosting.score_boosting(rows, INPUTS, nodes, base), "entity_id").collect()}
    assert risks[1] > np.mean(y) > risks[0]


def test_unseen_missing_values_go_with_the_larger_side(spark):
    x = np.column_stack([np.arange(100.0), np.zeros(100), np.zeros(100), np.zeros(100)])
    y = (np.arange(100) >= 70).astype(int)
    base, nodes = boosting.fit_boosting(table(spark, x, y), INPUTS, Settings(rounds=1, max_depth=1))
    assert nodes.where("node = 0").head().missing_below
    asked = table(spark, np.array([[np.nan, 0, 0, 0], [0, 0, 0, 0], [99, 0, 0, 0]]), [0, 0, 0])
    risk = [r.risk for r in boosting.score_boosting(asked, INPUTS, nodes, base).orderBy("entity_id").collect()]
    assert risk[0] == risk[1] < risk[2]


def test_one_class_or_constant_inputs_give_the_base_score(spark):
    x, _ = sample(1, 60)
    for rows, share in ((table(spark, x, np.zeros(60)), 1e-9), (table(spark, np.ones((60, 4)), np.arange(60) % 2), 0.5)):
        base, nodes = boosting.fit_boosting(rows, INPUTS, Settings(rounds=2))
        assert nodes.count() == 0
        assert {round(r.risk, 6) for r in boosting.score_boosting(rows, INPUTS, nodes, base).collect()} == {round(share, 6)}
    with pytest.raises(ValueError):
        boosting.fit_boosting(table(spark, x[:0], []), INPUTS)
