import datetime

import pytest

from helpers import START, daily, entities
from yieldloom.operators import splits


def folds_of(df, n_splits, min_fails):
    return splits.read_folds(splits.expanding_folds(df, n_splits=n_splits, min_fails=min_fails))


def test_four_folds_train_before_test(spark):
    folds = folds_of(daily(spark, 5, 20, 4), 4, 2)
    assert len(folds) == 4
    assert all(f.train_end_date < f.test_start_date <= f.test_end_date for f in folds)
    assert [f.train_fails for f in folds] == [4, 8, 12, 16]


def test_dates_are_never_shared(spark):
    df = daily(spark, 4, 12, 2)
    folds = splits.expanding_folds(df, n_splits=2, min_fails=1)
    assert [f.fold for f in splits.read_folds(folds)] == [1, 2]
    roles = splits.assign_folds(df, folds).groupBy("fold", "event_date").agg({"role": "collect_set"}).collect()
    assert all(len(r[2]) == 1 for r in roles)
    assert {str(f.test_start_date) for f in splits.read_folds(folds)} == {"2024-01-02", "2024-01-03"}


def test_split_count_degrades(spark):
    folds = folds_of(daily(spark, 6, 5, 1), 4, 2)
    assert {f.n_splits for f in folds} == {2} and len(folds) == 2


def test_no_valid_split_is_an_error(spark):
    stamps = [START + datetime.timedelta(hours=i) for i in range(20)]
    df = entities(spark, {"feature_001": list(range(20))}, [1] + [-1] * 19, stamps)
    with pytest.raises(ValueError):
        folds_of(df, 4, 2)


def test_dev_and_test_dates(spark):
    split = splits.split_dev_test(daily(spark, 10, 3, 1))
    days = {r.split: r.d for r in split.groupBy("split").agg({"test_timestamp": "count"}).withColumnRenamed("count(test_timestamp)", "d").collect()}
    # 1.5 dates round to 2
    assert days == {"dev": 24, "test": 6}


def test_two_dates_leave_one_for_each_side(spark):
    split = splits.split_dev_test(daily(spark, 2, 3, 1), test_size=0.9)
    assert {r.split: r["count"] for r in split.groupBy("split").count().collect()} == {"dev": 3, "test": 3}


def test_stratified_split_is_exact_and_repeatable(spark):
    df = daily(spark, 10, 20, 3)
    one = splits.stratified_split(df).groupBy("yield_label", "split").count().collect()
    assert {(r.yield_label, r.split): r["count"] for r in one} == {
        (1, "test"): 9,
        (1, "train"): 21,
        (-1, "test"): 51,
        (-1, "train"): 119,
    }
    ids = lambda d: sorted(r.entity_id for r in splits.stratified_split(d).where("split = 'test'").collect())
    assert ids(df) == ids(df.repartition(7))


def test_undersample_balances_or_gives_nothing(spark):
    df = daily(spark, 5, 10, 2)
    counts = {r.yield_label: r["count"] for r in splits.undersample(df).groupBy("yield_label").count().collect()}
    assert counts == {1: 10, -1: 10}
    assert splits.undersample(daily(spark, 5, 10, 8)).count() == 0


def test_class_weights(spark):
    rows = {r.y: r for r in splits.class_weights(daily(spark, 5, 10, 2)).collect()}
    assert rows[1].weight == pytest.approx(50 / 20) and rows[0].weight == pytest.approx(50 / 80)
    assert rows[1].scale_pos_weight == pytest.approx(4.0)
