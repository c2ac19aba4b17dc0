"""The co-moment aggregate and the robust covariance against numpy."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from yieldloom.operators import comoments, ellipse


def frame(spark, x, groups=None):
    rows = [([0] if groups is None else groups[i], [None if np.isnan(v) else float(v) for v in row]) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "groups array<int>, v array<double>")


def gaps(seed=0, n=200, width=7):
    random = np.random.default_rng(seed)
    x = random.normal(size=(n, width)) @ random.normal(size=(width, width))
    x[random.random(x.shape) < 0.2] = np.nan
    return x


def plain(x, i, j):
    there = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
    a, b = x[there, i], x[there, j]
    return [len(a), a.mean(), b.mean(), ((a - a.mean()) ** 2).sum(), ((b - b.mean()) ** 2).sum(), ((a - a.mean()) * (b - b.mean())).sum()]


@pytest.mark.parametrize("shift", [0.0, 1e7])
def test_states_merge_to_those_of_all_rows(shift):
    x = gaps() + shift
    whole = comoments.state_of(x, x)
    parts = comoments.state_of(x[:3], x[:3])
    for lo, hi in ((3, 4), (4, 120), (120, 200)):
        parts = comoments.merged(parts, comoments.state_of(x[lo:hi], x[lo:hi]))
    assert parts == pytest.approx(whole, rel=1e-7, abs=1e-6)
    for i, j in ((0, 1), (2, 6), (3, 3)):
        assert whole[:, i, j] == pytest.approx(plain(x, i, j), rel=1e-7)
    empty = comoments.state_of(x[:0], x[:0])
    assert comoments.merged(empty, whole) == pytest.approx(whole) and (comoments.merged(empty, empty) == 0).all()


def test_tiles_groups_and_scans_give_all_pairs(spark, monkeypatch):
    x = gaps(1)
    groups = [[0] if i < 90 else [1, 2] if i < 150 else [] for i in range(200)]
    inside = {0: x[:90], 1: x[90:150], 2: x[90:150]}
    rows = frame(spark, x, groups).repartition(9)
    for budget in (comoments.TASK_BYTES, 1):
        monkeypatch.setattr(comoments, "TASK_BYTES", budget)
        got = comoments.pair_rows(comoments.pair_states(rows, 7, 3, tile=3), "group", 7, tile=3).collect()
        assert len(got) == 3 * 21
        for r in got:
            assert [r[p] for p in comoments.PARTS] == pytest.approx(plain(inside[r.group], r.i, r.j))


def test_folds_are_merges_of_blocks(spark):
    x = gaps(2, 60, 2)
    rows = frame(spark, x, [[i % 3] for i in range(60)])
    folds = comoments.pair_rows(comoments.by_fold(comoments.pair_states(rows, 2, 3), 3), "fold", 2)
    for r in folds.collect():
        assert [r[p] for p in comoments.PARTS] == pytest.approx(plain(x[np.arange(60) % 3 <= r.fold], 0, 1))


def test_constants_far_from_zero_have_no_correlation(spark):
    x = np.column_stack([np.full(300, 1e8 + 0.1), np.arange(300.0), np.arange(300.0) + 1e9])
    pairs = comoments.pair_rows(comoments.pair_states(frame(spark, x).repartition(5), 3, 1), "group", 3)
    r = {(p.i, p.j): p.r for p in pairs.withColumn("r", comoments.correlation()).collect()}
    assert r[0, 1] is None and r[0, 2] is None and r[1, 2] == pytest.approx(1.0)


def plain_mcd(x, starts, h, steps):
    best = None
    for inside in starts:
        for _ in range(steps):
            mean, cov = x[inside].mean(axis=0), np.cov(x[inside].T, bias=True)
            d = ((x - mean) @ np.linalg.inv(cov) * (x - mean)).sum(axis=1)
            inside = np.argsort(d, kind="stable")[:h]
        cov = np.cov(x[inside].T, bias=True)
        if best is None or np.linalg.det(cov) < best[0]:
            best = np.linalg.det(cov), x[inside].mean(axis=0), cov
    return best[1:]


def test_covariance_of_least_determinant_ignores_a_cluster_of_outliers(spark):
    random = np.random.default_rng(3)
    x = np.vstack([random.normal(size=(140, 3)) @ np.array([[1, 0.5, 0], [0, 1, 0.3], [0, 0, 1]]), random.normal(size=(50, 3)) * 0.2 + 9]) + 1e5
    points = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "entity_id long, a array<double>")
    points = points.select("entity_id", array_to_vector("a").alias("features"))
    h = ellipse.support_size(190, 3)
    mean, cov, n = ellipse.minimum_covariance(ellipse._plain(points, "entity_id"), starts=4, most_steps=8)
    drawn = [np.random.default_rng(s).permutation(190)[:12] for s in range(40)]
    want_mean, want_cov = plain_mcd(x, drawn, h, 30)
    assert n == 190
    assert np.linalg.det(cov) <= np.linalg.det(want_cov) * 1.05
    assert mean == pytest.approx(want_mean, abs=0.2)
    center, inverse = ellipse.robust_center(points, starts=3, first_steps=1, most_steps=3)
    risk = {r.entity_id: r.risk for r in ellipse.distances(points, center, inverse).collect()}
    assert min(risk[i] for i in range(140, 190)) > max(risk[i] for i in range(140))


def test_points_on_a_line_and_no_points(spark):
    points = spark.range(30).select(F.col("id").alias("entity_id"), array_to_vector(F.array(F.col("id") * 1.0, F.col("id") * 2.0)).alias("features"))
    center, inverse = ellipse.robust_center(points, starts=2, first_steps=1, most_steps=2)
    risks = [r.risk for r in ellipse.distances(points, center, inverse).collect()]
    assert all(np.isfinite(risks)) and min(risks) >= 0
    with pytest.raises(ValueError):
        ellipse.robust_center(points.where("false"))


def test_chi_square_quantiles():
    # fixed values: from tables of the distribution
    for share, freedom, value in ((0.5, 2, 1.386294), (0.975, 2, 7.377759), (0.975, 1, 5.023886), (0.5, 10, 9.341818), (0.975, 64, 88.004)):
        assert ellipse.chi_square_quantile(share, freedom) == pytest.approx(value, rel=1e-5)


def test_robust_center_prepares_its_points_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [(i, [float(v) for v in row]) for i, row in enumerate(np.random.default_rng(2).normal(size=(80, 2)))]
    raw = spark.createDataFrame(rows, "entity_id long, a array<double>").mapInArrow(counted, "entity_id long, a array<double>")
    ellipse.robust_center(raw.select("entity_id", array_to_vector("a").alias("features")), starts=2, first_steps=1, most_steps=2)
    assert seen.value == 80
