"""The layered build: raw text to raw tables, staging tables, report tables, model tables, export.

Dependencies are function arguments. Shared inputs are written once and read back from their table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldloom.operators import metrics, profile, separation, trends
from yieldloom.operators.longform import signal_values_long
from yieldloom.plans import export, modeling
from yieldloom.plans.models import model_registry
from yieldloom.sources.results import COMPARISON_SCHEMA, read_comparison, read_metadata, write_comparison
from yieldloom.sources.tables import (
    build_canonical,
    ensure_layers,
    join_entities,
    load_table,
    replace_table,
)
from yieldloom.sources.text import read_labels, read_measurements
from yieldloom.spec import DEFAULT_SPEC, EntitySpec


def ingest(spark: SparkSession, measurements: str, labels: str, spec: EntitySpec = DEFAULT_SPEC, load_id: str | None = None) -> dict[str, int]:
    """Load both text sources into the raw layer and log them; rows per table. Done again with the same `load_id`, it
    loads and logs only what the first run did not get to."""
    ensure_layers(spark)
    loaded = {}
    for table, path, rows in (
        ("measurements", measurements, read_measurements(spark, measurements, spec)),
        ("labels", labels, read_labels(spark, labels, spec)),
    ):
        loaded[table] = load_table(rows, f"raw.{table}", table, path, load_id=load_id)
    return loaded


def build_staging(spark: SparkSession, spec: EntitySpec = DEFAULT_SPEC) -> dict[str, int]:
    """Entities, feature catalog and long signals from the raw tables; rows per table."""
    ensure_layers(spark)
    entities = join_entities(spark.table("raw.measurements"), spark.table("raw.labels"), spec)
    rows = {"entities": replace_table(entities, "staging.entities")}
    entities = spark.table("staging.entities")
    rows["feature_catalog"] = replace_table(profile.feature_catalog(entities, spec), "staging.feature_catalog")
    rows["signal_values_long"] = replace_table(signal_values_long(entities, spec), "staging.signal_values_long")
    return rows


def _store(spark: SparkSession, built: dict[str, int], name: str, df: DataFrame) -> DataFrame:
    built[name] = replace_table(df, f"mart.{name}")
    return spark.table(f"mart.{name}")


def build_data_marts(spark: SparkSession, spec: EntitySpec = DEFAULT_SPEC, top_n: int = 20) -> dict[str, int]:
    """The report tables over the staging layer; rows per table.

    Class statistics are the one expensive pass behind ranking, relationship, priority and groups, so they
    are taken once.
    """
    ensure_layers(spark)
    entities, catalog = spark.table("staging.entities"), spark.table("staging.feature_catalog")
    built: dict[str, int] = {}
    _store(spark, built, "overview", profile.overview(entities, spec))
    _store(spark, built, "label_distribution", profile.label_distribution(entities, spec))
    _store(spark, built, "feature_missingness", profile.feature_missingness(catalog))
    stats = _store(spark, built, "feature_class_stats", separation.class_stats(entities, spec))
    ranking = _store(spark, built, "top_signal_fail_separation", separation.separation_of(stats, catalog))
    _store(spark, built, "top_signal_profiles", separation.signal_profiles(entities, ranking, top_n, spec))
    relationship = _store(
        spark, built, "feature_failure_relationship", separation.relationship_of(stats, catalog, ranking)
    )
    _store(spark, built, "daily_failure_rollup", trends.daily_failure_rollup(entities, spec))
    _store(spark, built, "feature_priority_index", separation.feature_priority_index(catalog, ranking))
    _store(spark, built, "daily_yield_trend", trends.daily_yield_trend(entities, spec))
    _store(spark, built, "feature_action_summary", profile.feature_action_summary(catalog))
    _store(spark, built, "feature_groups", separation.feature_groups(catalog, relationship, top_n))
    _store(spark, built, "feature_coverage_summary", profile.feature_coverage_summary(catalog))
    return built


def build_model_marts(
    spark: SparkSession,
    options: modeling.Options | None = None,
    spec: EntitySpec = DEFAULT_SPEC,
    artifact: str | None = None,
    comparison: str | None = None,
) -> dict[str, int]:
    """The model tables over the staging layer and the ranking; rows per table."""
    entities, catalog = spark.table("staging.entities"), spark.table("staging.feature_catalog")
    run = modeling.run_modeling(entities, catalog, options, spec, artifact=artifact)
    built: dict[str, int] = {}
    _store(spark, built, "model_cv_results", run.evaluation.results)
    benchmark = _store(spark, built, "model_benchmark", run.benchmark)
    _store(spark, built, "model_threshold_analysis", metrics.threshold_analysis(run.sweep))
    _store(spark, built, "model_threshold_cost_curve", metrics.threshold_cost_curve(run.sweep))
    _store(spark, built, "model_probability_bins", run.bins)
    _store(spark, built, "model_feature_importance", run.final.importance)
    # the scores themselves are entity-sized, so they are a table of their own, not a cell of this one
    _store(spark, built, "final_model_test_results", run.final.results)
    _store(spark, built, "final_model_test_scores", run.final.scores)
    _store(spark, built, "model_confusion_summary", run.confusion)
    selected = spark.createDataFrame([(i.name,) for i in run.final.fitted.inputs], "feature_name string")
    ranking = spark.table("mart.top_signal_fail_separation")
    _store(spark, built, "selected_signal_shortlist", separation.signal_shortlist(selected, ranking, catalog))
    _store(spark, built, "model_registry", model_registry(spark))
    _store(spark, built, "model_inspection_metrics", modeling.inspection_benchmark(benchmark))
    _store(
        spark, built, "model_feature_selection_summary", modeling.feature_selection_summary(run.evaluation.results)
    )
    _store(spark, built, "anomaly_model_benchmark", modeling.anomaly_benchmark(benchmark))
    _store(spark, built, "final_model_inspection_curve", run.final.curve)
    # without a file this is an empty table of the same columns
    compared = read_comparison(spark, comparison) if comparison else spark.createDataFrame([], COMPARISON_SCHEMA)
    _store(spark, built, "random_split_comparison", compared)
    return built


def export_sections(spark: SparkSession, artifact: str | None = None, top_n: int = 20) -> dict[str, DataFrame]:
    """The export's sections from the finished tables."""

    def mart(name: str) -> DataFrame:
        return spark.table(f"mart.{name}")

    catalog = spark.table("staging.feature_catalog")
    # up to top_n distinct names
    tops = separation.top_features(mart("top_signal_fail_separation"), top_n)
    sections = {
        "overview": mart("overview"),
        "label_distribution": mart("label_distribution"),
        "feature_missingness": mart("feature_missingness"),
        "feature_catalog": catalog,
        "feature_coverage": profile.feature_coverage(catalog, mart("overview").select("entity_count").scalar()),
        "action_summary": mart("feature_action_summary"),
        "top_signals": mart("top_signal_fail_separation"),
        "daily_trend": mart("daily_yield_trend"),
        "top_signal_profiles": mart("top_signal_profiles"),
        "feature_correlation_to_failure": mart("feature_failure_relationship"),
        "daily_failure_summary": mart("daily_failure_rollup"),
        "feature_groups": export.feature_groups_section(mart("feature_priority_index"), tops),
        "model_cv_results": mart("model_cv_results"),
        "model_benchmark": mart("model_benchmark"),
        "model_threshold_analysis": mart("model_threshold_analysis"),
        "final_model_test_results": mart("final_model_test_results"),
        "model_confusion_summary": mart("model_confusion_summary"),
        "selected_signal_shortlist": mart("selected_signal_shortlist"),
        "model_registry": mart("model_registry"),
        "model_feature_importance": mart("model_feature_importance"),
        "model_threshold_cost_curve": mart("model_threshold_cost_curve"),
        "model_probability_bins": mart("model_probability_bins"),
        "inspection_curve": mart("final_model_inspection_curve"),
        "model_inspection_metrics": mart("model_inspection_metrics"),
        "model_feature_selection_summary": mart("model_feature_selection_summary"),
        "anomaly_model_benchmark": mart("anomaly_model_benchmark"),
        "final_model_inspection_curve": mart("final_model_inspection_curve"),
    }
    found = read_metadata(spark, artifact).get("inspection_metrics", {}) if artifact else {}
    one = spark.range(0, 1, 1, 1)
    values = [F.lit(v).alias(k) for k, v in found.items()]
    sections["inspection_metrics"] = one.select(*values) if values else one.where("false")
    sections["random_split_comparison"] = mart("random_split_comparison")
    return sections


@dataclass
class BuildReport:
    """Rows per table of a full build."""

    raw: dict[str, int] = field(default_factory=dict)
    staging: dict[str, int] = field(default_factory=dict)
    mart: dict[str, int] = field(default_factory=dict)


def build_all(
    spark: SparkSession,
    measurements: str,
    labels: str,
    output: str,
    options: modeling.Options | None = None,
    spec: EntitySpec = DEFAULT_SPEC,
    compare: bool = False,
) -> BuildReport:
    """Text files to exported JSON: every layer in order; `compare` also evaluates under random splits."""
    report = BuildReport(raw=ingest(spark, measurements, labels, spec))
    report.raw["canonical"] = build_canonical(spark, spec=spec)
    report.staging = build_staging(spark, spec)
    report.mart = build_data_marts(spark, spec)
    artifact = f"{output}/model"
    comparison = None
    if compare:
        entities, catalog = spark.table("staging.entities"), spark.table("staging.feature_catalog")
        comparison = f"{output}/comparison"
        write_comparison(modeling.random_split_comparison(entities, catalog, options, spec), comparison)
    report.mart.update(build_model_marts(spark, options, spec, artifact=artifact, comparison=comparison))
    sections = export_sections(spark, artifact)
    export.export_sections(sections, f"{output}/sections")
    export.write_document(export.bundle(sections), f"{output}/bundle")
    summary = export.landing_summary(
        sections["overview"],
        sections["action_summary"],
        sections["feature_correlation_to_failure"],
        sections["model_benchmark"],
        sections["model_cv_results"],
        sections["final_model_test_results"],
        sections["final_model_inspection_curve"],
    )
    export.write_document(export.landing_document(summary), f"{output}/landing")
    return report
