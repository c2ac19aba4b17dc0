import datetime
import json
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from yieldloom.plans import modeling, warehouse
from yieldloom.sources.results import COMPARISON_SCHEMA, read_comparison, read_metadata, write_comparison
from yieldloom.sources.text import read_labels, read_measurements


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    """120 hourly entities, 12 features: one shifted for fails, one half missing, one constant."""
    folder = tmp_path_factory.mktemp("text")
    random = np.random.default_rng(7)
    x = random.normal(size=(120, 12))
    fail = np.zeros(120, dtype=bool)
    fail[random.choice(120, 20, replace=False)] = True
    fail[[3, 30, 60, 90, 110, 118]] = True
    x[fail, 0] += 1.5
    x[::2, 1] = np.nan
    x[:, 2] = 5.0
    start = datetime.datetime(2023, 1, 1)
    lines = [" ".join("NaN" if np.isnan(v) else repr(float(v)) for v in row) for row in x]
    stamps = [(start + datetime.timedelta(hours=6 * i)).strftime("%d/%m/%Y %H:%M:%S") for i in range(120)]
    (folder / "measurements.data").write_text("\n".join(lines[:60]) + "\n\n" + "\n".join(lines[60:]) + "\n")
    (folder / "labels.data").write_text("\n".join(f'{1 if f else -1} "{s}"' for f, s in zip(fail, stamps)) + "\n")
    return folder, x, fail


def test_readers(spark, files):
    folder, x, fail = files
    rows = read_measurements(spark, str(folder / "measurements.data")).orderBy("entity_id").collect()
    assert [r.entity_id for r in rows] == list(range(1, 121))
    got = np.array([[np.nan if v is None else v for v in r[1:]] for r in rows])
    assert np.allclose(got, x, equal_nan=True)
    labels = read_labels(spark, str(folder / "labels.data")).orderBy("entity_id").collect()
    assert [r.pass_fail == "fail" for r in labels] == list(fail)
    assert labels[0].test_timestamp == datetime.datetime(2023, 1, 1)


def test_text_to_json(spark, files, tmp_path):
    folder, _, fail = files
    options = modeling.Options(
        models=("dummy_stratified", "logistic_l2", "isolation_forest_pass_only"),
        feature_sets=("keep_only", "correlation_pruned_070"),
        n_splits=2,
        min_fails=2,
        overrides={"isolation_forest_pass_only": {"trees": 20}},
    )
    report = warehouse.build_all(
        spark, str(folder / "measurements.data"), str(folder / "labels.data"), str(tmp_path), options
    )
    assert report.raw == {"measurements": 120, "labels": 120, "canonical": 120}
    assert report.staging["signal_values_long"] == 120 * 12
    assert all(n > 0 for name, n in report.mart.items() if name != "random_split_comparison")
    assert report.mart["random_split_comparison"] == 0 and len(report.mart) >= 26
    log = {r.table_name: r.rows_loaded for r in spark.table("raw.ingestion_log").collect()}
    assert log == {"measurements": 120, "labels": 120}

    overview = spark.table("mart.overview").first()
    assert (overview.entity_count, overview.feature_count, overview.fail_count) == (120, 12, int(fail.sum()))
    distribution = spark.table("mart.label_distribution").collect()
    assert sum(r.entity_pct for r in distribution) == pytest.approx(1.0)
    days = spark.table("mart.daily_yield_trend").collect()
    assert all(r.pass_count + r.fail_count == r.entity_count for r in days)
    assert sum(r["count"] for r in spark.table("mart.feature_groups").collect()) == 12

    benchmark = spark.table("mart.model_benchmark").collect()
    assert min(r["rank"] for r in benchmark) == 1 and len(benchmark) == 6
    assert sum(r.best_for_inspection_policy for r in benchmark) == 1
    final = spark.table("mart.final_model_test_results").first()
    assert final.model != "dummy_stratified"
    assert spark.table("mart.model_threshold_analysis").where("selected").count() == 1
    assert spark.table("mart.model_confusion_summary").where("split = 'test'").count() == 1
    assert spark.table("mart.final_model_inspection_curve").count() == 20

    document = json.loads(next(Path(tmp_path, "bundle").glob("part-*")).read_text())
    assert len(document) >= 28 and document["overview"]["entity_count"] == 120
    assert len(document["feature_catalog"]) == 12
    landing = json.loads(next(Path(tmp_path, "landing").glob("part-*")).read_text())
    assert landing["signal_rows"] == 1440 and landing["benchmark_scale"] == {"model_configs": 6, "cv_rows": 12}
    assert sum(landing["feature_actions"].values()) == 12
    assert 0 < len(landing["top_models_by_pr_auc"]) <= 5

    metadata = read_metadata(spark, f"{tmp_path}/model")
    assert metadata["model"] == final.model and "recall_at_10pct" in metadata["inspection_metrics"]
    assert read_metadata(spark, f"{tmp_path}/nothing") == {}
    stages = PipelineModel.load(f"{tmp_path}/model/stages")
    assert stages.transform(spark.table("staging.entities")).where("features IS NULL").count() == 0


def test_comparison_file(spark, tmp_path):
    path = str(tmp_path / "comparison")
    empty = read_comparison(spark, path)
    assert empty.count() == 0 and empty.schema == COMPARISON_SCHEMA
    row = {f.name: None for f in COMPARISON_SCHEMA}
    row.update(model="m", feature_set="s", evaluation_protocol="p", n_features=3, test_f1=0.5, captured_fails_at_05pct=2)
    table = spark.createDataFrame([tuple(row.values())], COMPARISON_SCHEMA)
    write_comparison(table, path)
    assert read_comparison(spark, path).collect() == table.collect()
