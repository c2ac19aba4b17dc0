import hashlib

import numpy as np
import pytest

from helpers import scored
from yieldloom.operators import metrics


def at(spark, y, risk, rate):
    rows = metrics.inspection(scored(spark, y, risk), rates=[rate]).collect()
    assert len(rows) == 1
    return rows[0]


def test_top_share_of_a_mixed_ranking(spark):
    # by falling risk the labels are 1 1 0 0 1 0 0 0 0 0; three of ten are inspected and two of three fails found
    risk = [0.10, 0.80, 0.24, 0.66, 0.54, 0.16, 0.04, 0.38, 0.60, 0.72]
    r = at(spark, [0, 1, 0, 0, 1, 0, 0, 0, 0, 1], risk, 0.30)
    assert (r.inspected, r.captured_fails, r.recall, r.precision, r.lift) == (3, 2, 0.6667, 0.6667, 2.2222)


def test_every_fail_above_every_pass(spark):
    y = [1 if i % 5 == 2 else 0 for i in range(30)]
    r = at(spark, y, [0.8 + i / 200 if f else 0.1 + i / 200 for i, f in enumerate(y)], 0.20)
    assert (r.inspected, r.recall, r.precision, r.lift) == (6, 1.0, 1.0, 5.0)


def test_entities_without_a_score_do_not_count(spark):
    r = at(spark, [1, 0, 1, 0, 0], [0.7, None, None, 0.4, 0.2], 0.34)
    assert (r.inspected, r.captured_fails, r.recall) == (1, 1, 1.0)


def test_curve_ends_at_everything(spark):
    y = [1 if i % 7 == 0 else 0 for i in range(35)]
    rows = metrics.inspection_curve(scored(spark, y, [(13 * i % 35) / 35 for i in range(35)])).orderBy("inspection_rate").collect()
    assert len(rows) == 20 and [r.captured_fails for r in rows] == sorted(r.captured_fails for r in rows)
    assert (rows[-1].inspection_rate, rows[-1].recall, rows[-1].lift) == (1.0, 1.0, 1.0)


def test_inspected_count_rounds_half_to_even(spark):
    assert at(spark, [0] * 49 + [1], list(np.linspace(0, 1, 50)), 0.05).inspected == 2


def test_ties_are_cut_in_hash_order(spark):
    random = np.random.default_rng(5)
    y = random.integers(0, 2, 300)
    risk = random.choice([0.1, 0.5, 0.9], 300, p=[0.2, 0.6, 0.2])
    order = sorted(range(300), key=lambda i: (-risk[i], hashlib.md5(f"0:{i}".encode()).hexdigest()))
    for r in metrics.inspection(scored(spark, y, risk), rates=[0.01, 0.3, 0.5, 0.77]).collect():
        assert r.captured_fails == sum(y[i] for i in order[: r.inspected])


def test_no_rows_at_all(spark):
    r = at(spark, [], [], 0.1)
    assert (r.inspected, r.captured_fails, r.recall, r.precision, r.lift) == (1, 0, 0.0, 0.0, 0.0)


def test_lowest_best_threshold_is_selected(spark):
    # every threshold from 0.41 to 0.64 separates the classes
    sweep = metrics.threshold_sweep(scored(spark, [1, 0, 1, 0, 1, 0, 0], [0.92, 0.15, 0.77, 0.405, 0.645, 0.05, 0.33])).collect()
    assert len(sweep) == 99
    assert [r.threshold for r in sweep if r.selected] == [0.41]
    assert max(r.f1 for r in sweep) == 1.0


def test_sweep_without_scores_counts_nothing(spark):
    sweep = metrics.threshold_sweep(scored(spark, [], [])).collect()
    assert len(sweep) == 99
    assert {(r.predicted_fail_count, r.false_positive_count, r.false_negative_count, r.f1) for r in sweep} == {(0, 0, 0, 0.0)}


def test_custom_grid_for_unbounded_scores(spark):
    df = scored(spark, [0, 0, 1, 1], [-3.0, -1.0, 5.0, 9.0])
    grid = metrics.score_quantile_grid(df, 9)
    best = [r for r in metrics.threshold_sweep(df, thresholds=grid).collect() if r.selected]
    assert best[0].f1 == 1.0


def test_bins_keep_empty_ones_and_close_the_last(spark):
    rows = metrics.probability_bins(scored(spark, [1, 0, 1, 1], [0.0, 0.2, 1.0, 1.4])).orderBy("bin_min").collect()
    assert [(r.total_entities, r.fail_count) for r in rows] == [(1, 1), (1, 0), (0, 0), (0, 0), (1, 1)]


def brute(y, s):
    order = np.unique(s)[::-1]
    p, ap, before = y.sum(), 0.0, 0
    for v in order:
        hit, n = y[s >= v].sum(), (s >= v).sum()
        ap += (hit - before) / p * hit / n
        before = hit
    pos, neg = s[y == 1], s[y == 0]
    auc = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    return ap, auc


@pytest.mark.parametrize("levels", [3, 1000])
def test_ranking_quality_matches_brute_force(spark, levels):
    random = np.random.default_rng(levels)
    y = random.integers(0, 2, 700)
    s = random.integers(0, levels, 700) / levels
    row = metrics.discrimination(scored(spark, y, s)).first()
    ap, auc = brute(y, s)
    assert row.pr_auc == pytest.approx(ap) and row.roc_auc == pytest.approx(auc)
    assert row.median_risk == pytest.approx(np.median(s))


def test_one_class_is_undefined(spark):
    row = metrics.median_cut_rates(scored(spark, [0, 0, 0], [0.1, 0.2, 0.3])).first()
    assert row.pr_auc is None and row.roc_auc is None
    assert (row.tp, row.fn, row.fp, row.tn) == (0, 0, 2, 1)


def test_confusion_always_has_four_cells(spark):
    cells = metrics.confusion(scored(spark, [1, 1], [0.9, 0.8]), 0.5).first()
    assert (cells.tn, cells.fp, cells.fn, cells.tp) == (0, 0, 0, 2)


def test_missing_curve_point_is_zero(spark):
    curve = metrics.inspection_curve(scored(spark, [0, 1], [0.1, 0.9]), n_points=4)
    assert metrics.curve_point(curve, 0.33).first().captured_fails == 0
    assert metrics.curve_point(curve, 0.5).first().captured_fails == 1
