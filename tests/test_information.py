"""The nearest-neighbour estimate of mutual information against a search over all pairs."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import daily
from yieldloom.operators import information, selectors


def psi(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, n))


def plain(x, y, k=3):
    terms, used = [], [i for i in range(len(x)) if (y == y[i]).sum() > 1]
    for i in used:
        size = int((y == y[i]).sum())
        near = min(k, size - 1)
        r = np.sort(np.abs(x[(y == y[i]) & (np.arange(len(x)) != i)] - x[i]))[near - 1]
        m = sum(abs(x[j] - x[i]) < r for j in used)
        terms.append(psi(near) - psi(size) - psi(max(m, 1)))
    return max(0.0, psi(len(used)) + sum(terms) / len(used))


def test_digamma_of_whole_numbers():
    n = np.arange(1, 200)
    assert information.digamma(n) == pytest.approx([psi(int(i)) for i in n], abs=1e-13)


@pytest.fixture(scope="module")
def table(spark):
    random = np.random.default_rng(2)
    n = 300
    label = np.array([1 if i % 15 < 2 else 0 for i in range(n)])
    features = {
        "feature_001": random.normal(size=n) + 1.5 * label,
        "feature_002": np.where(random.random(n) < 0.4, np.nan, random.normal(size=n) * 100 + 1e4),
        "feature_003": np.full(n, 2.5),
        "feature_004": random.integers(0, 3, n).astype(float) + label,
        "feature_005": np.full(n, np.nan),
    }
    clean = {c: [None if np.isnan(v) else float(v) for v in x] for c, x in features.items()}
    return daily(spark, 20, 15, 2, clean)


@pytest.mark.parametrize("per_range", [information.PER_RANGE, 7])
def test_estimate_is_that_of_all_pairs(table, per_range):
    in_train = [F.col("entity_id") <= 150, F.lit(True)]
    scores = selectors.feature_scores(table, in_train)
    got = {(r.fold, r.feature_name): r.mutual_info for r in information.neighbor_information(table, in_train, scores, per_range=per_range).collect()}
    assert len(got) == 10
    rows = table.toPandas()
    shift = np.array([int(hashlib.md5(f"nudge:{i}".encode()).hexdigest()[:8], 16) / 2**31 - 1.0 for i in rows.entity_id])
    for fold, train in ((1, rows.entity_id <= 150), (2, rows.entity_id > 0)):
        y = (rows.yield_label[train] == 1).to_numpy().astype(int)
        for c in ("feature_001", "feature_002", "feature_004"):
            x = rows[c][train].astype(float)
            x = x.fillna(x.median()).to_numpy()
            x = x + 1e-10 * max(x.std(), abs(x.mean())) * shift[train]
            assert got[fold, c] == pytest.approx(plain(x, y), abs=1e-9), (fold, c)
        assert got[fold, "feature_003"] == got[fold, "feature_005"] == 0
    assert got[2, "feature_001"] > 0.1 and got[2, "feature_004"] > got[2, "feature_002"]


def test_a_class_of_one_does_not_count(spark):
    table = daily(spark, 3, 10, 0, {"feature_001": [float(i) for i in range(30)]})
    table = table.withColumn("yield_label", F.when(F.col("entity_id") == 5, 1).otherwise(-1))
    scores = selectors.feature_scores(table, [F.lit(True)])
    row = information.neighbor_information(table, [F.lit(True)], scores, per_range=4).head()
    assert row.mutual_info == pytest.approx(0.0, abs=1e-9) or math.isfinite(row.mutual_info)
