import pytest

from helpers import entities
from yieldloom.operators import profile, separation, trends
from yieldloom.operators.longform import signal_values_long


def actions(df):
    return {r.feature_name: r.recommended_action for r in profile.feature_catalog(df).collect()}


def test_actions(spark):
    columns = {
        "feature_full": [4, 8, 15, 16, 23],
        "feature_hole": [0.5, None, 2.5, 0.5, 1.5],
        "feature_half": [None, 6, None, 2, None],
        "feature_flat": [9, 9, None, 9, 9],
        "feature_none": [None] * 5,
    }
    assert actions(entities(spark, columns, [-1, -1, 1, -1, 1])) == {
        "feature_full": "keep",
        "feature_hole": "keep",
        "feature_half": "review_high_missing",
        "feature_flat": "drop_constant",
        "feature_none": "drop_all_null",
    }


def test_long_form_keeps_missing(spark):
    readings = {"feature_heat": [0.25, None, -4.5, None], "feature_flow": [None, 8.0, 8.0, 6.75]}
    rows = signal_values_long(entities(spark, readings, [1, -1, -1, 1])).collect()
    assert len(rows) == 8
    assert {(r.entity_id, r.feature_name) for r in rows if r.is_missing} == {(2, "feature_heat"), (4, "feature_heat"), (1, "feature_flow")}
    assert {(r.entity_id, r.feature_name): r.feature_value for r in rows if not r.is_missing} == {
        (i + 1, name): v for name, held in readings.items() for i, v in enumerate(held) if v is not None
    }


def test_nan_counts_as_missing(spark):
    df = entities(spark, {"feature_x": [1.0, float("nan"), 3.0]}, [-1, 1, -1])
    row = profile.feature_catalog(df).first()
    assert (row.null_count, row.distinct_count, row["mean"]) == (1, 2, 2.0)


def test_empty_table_lists_its_features(spark):
    df = entities(spark, {"feature_x": [1.0]}, [1]).where("false")
    row = profile.feature_catalog(df).first()
    assert (row.feature_name, row.null_count, row.null_pct, row.recommended_action) == (
        "feature_x",
        0,
        0.0,
        "drop_all_null",
    )
    assert profile.overview(df).first().entity_count == 0


def test_separation_leaves_out_what_cannot_separate(spark):
    df = entities(
        spark,
        {
            "feature_1": [1, 2, 5, 6],
            "feature_2": [7] * 4,
            "feature_3": [1, 2, None, None],
            "feature_4": [1, 1, 2, 2],
        },
        [-1, -1, 1, 1],
    )
    rows = {r.feature_name: r for r in separation.signal_separation(df).collect()}
    assert set(rows) == {"feature_1", "feature_4"}
    assert rows["feature_1"].effect_size == pytest.approx(8.0)
    assert rows["feature_4"].effect_size is None
    relationship = [r.feature_name for r in separation.failure_relationship(df).collect()]
    assert relationship == ["feature_1", "feature_3", "feature_4"]


def test_groups_cover_all_features(spark):
    df = entities(
        spark,
        {"feature_1": [1, 2, 5, 6], "feature_2": [7] * 4, "feature_3": [1, None, None, 2], "feature_4": [None] * 4},
        [-1, -1, 1, 1],
    )
    catalog = profile.feature_catalog(df)
    groups = separation.feature_groups(catalog, separation.failure_relationship(df), top_n=1).collect()
    assert len(groups) == 5
    assert sum(r["count"] for r in groups) == 4


def test_rolling_rate_counts_observed_days(spark):
    import datetime

    start = datetime.datetime(2024, 1, 1)
    stamps = [start + datetime.timedelta(days=3 * i) for i in range(9)]
    df = entities(spark, {"feature_x": list(range(9))}, [1] + [-1] * 8, stamps)
    rates = [r.rolling_7d_fail_rate for r in trends.daily_failure_rollup(df).orderBy("event_date").collect()]
    assert rates == pytest.approx([1, 1 / 2, 1 / 3, 1 / 4, 1 / 5, 1 / 6, 1 / 7, 0, 0])
