import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import daily, entities
from yieldloom.operators import selectors, splits
from yieldloom.operators.profile import feature_catalog


def test_pruning_keeps_the_first_of_correlated_features(spark):
    base = [3, 9, 4, 12, 7, 1]
    table = {"feature_p": base, "feature_q": [2 * x + 1 for x in base], "feature_r": [2, 7, 1, 8, 2, 8], "feature_s": [5 - x for x in base]}
    pairs = selectors.correlations(entities(spark, table, [1, -1, -1, 1, -1, -1]), list(table))
    assert [r.feature_name for r in selectors.correlation_pruned(pairs, list(table), 0.95).collect()] == ["feature_p", "feature_r"]


def test_indicators_only_for_incomplete_features(spark):
    df = entities(spark, {"feature_p": [3, 1, 4, 1, 5], "feature_q": [0.5, None, 2.5, None, 1.0]}, [1, -1, 1, -1, -1])
    scores = selectors.feature_scores(df, [F.lit(True)])
    resolved = selectors.resolve_feature_sets(scores, feature_catalog(df), names=["missingness_indicators_keep"])
    names = [r.feature_name for r in resolved.orderBy("position").collect()]
    assert names == ["feature_p", "feature_q", "feature_q_missing"]


def test_tiles_give_the_same_correlations(spark):
    df = daily(spark, 6, 20, 4, {f"feature_{i}": list(np.random.default_rng(i).normal(size=120)) for i in range(7)})
    names = [f"feature_{i}" for i in range(7)]
    whole = {(r.feature_i, r.feature_j): r.r for r in selectors.correlations(df, names).collect()}
    tiled = {(r.feature_i, r.feature_j): r.r for r in selectors.correlations(df, names, tile=3).collect()}
    assert whole.keys() == tiled.keys() and len(whole) == 21
    assert all(tiled[k] == pytest.approx(v) for k, v in whole.items())


@pytest.fixture(scope="module")
def folded(spark):
    random = np.random.default_rng(11)
    n = 400
    label = np.array([1 if i % 20 < 4 else -1 for i in range(n)])
    noise = random.normal(size=n)
    features = {
        "feature_001": noise + (label == 1),
        "feature_002": np.where(random.random(n) < 0.4, np.nan, noise * 2),
        "feature_003": np.full(n, 3.3),
        "feature_004": random.integers(0, 3, n).astype(float),
        "feature_005": np.full(n, np.nan),
    }
    clean = {k: [None if np.isnan(x) else x for x in v] for k, v in features.items()}
    return daily(spark, 20, 20, 4, clean)


def test_statistics_match_pandas_per_fold(folded):
    folds = splits.read_folds(splits.expanding_folds(folded, n_splits=3, min_fails=4))
    scores = selectors.feature_scores(folded, [f.in_train() for f in folds]).toPandas()
    table = folded.toPandas()
    for f in folds:
        train = table[table.test_timestamp.dt.date <= f.train_end_date]
        y = (train.yield_label == 1).to_numpy()
        for name in [f"feature_{i:03d}" for i in range(1, 6)]:
            row = scores[(scores.fold == f.fold) & (scores.feature_name == name)].iloc[0]
            x = train[name].astype(float)
            assert row.null_count == x.isna().sum()
            a, b = x[~y].dropna(), x[y].dropna()
            d = 0.0
            if x.nunique() > 1:
                pooled = np.sqrt(((len(a) - 1) * a.var() + (len(b) - 1) * b.var()) / (len(a) + len(b) - 2))
                d = abs(a.mean() - b.mean()) / pooled
            assert row.cohens_d == pytest.approx(d)
            if x.notna().any():
                filled = x.fillna(x.median()).to_numpy()
                assert row["median"] == pytest.approx(x.median())
                assert row.fill_mean == pytest.approx(filled.mean())
                assert row.fill_std == pytest.approx(filled.std(), abs=1e-12)
                pos, neg = filled[y], filled[~y]
                auc = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
                assert row.auc_gap == pytest.approx(abs(auc - 0.5) if x.nunique() > 1 else 0.0)
            else:
                assert pd.isna(row["median"]) and row.auc_gap == 0 and row.mutual_info == 0


def test_selection_ignores_test_rows(folded):
    fold = splits.read_folds(splits.expanding_folds(folded, n_splits=1, min_fails=4))[0]
    changed = folded.withColumn(
        "feature_001", F.when(fold.in_train(), F.col("feature_001")).otherwise(F.col("feature_001") * 100 + 7)
    )
    same = [
        sorted(map(str, selectors.feature_scores(df, [fold.in_train()]).collect())) for df in (folded, changed)
    ]
    assert same[0] == same[1]


def test_predictive_feature_carries_most_information(folded):
    scores = selectors.feature_scores(folded, [F.lit(True)])
    top = selectors.top_by_score(scores, "mutual_info", 2).orderBy("position").collect()
    assert len(top) == 2 and top[0].feature_name == "feature_001"
