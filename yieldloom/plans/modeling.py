"""Walk-forward evaluation of models and feature sets, and the final test of the best one."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from yieldloom.operators import metrics
from yieldloom.operators.information import neighbor_information
from yieldloom.operators.preprocess import FoldInputs, input_statistics, read_inputs
from yieldloom.operators.profile import feature_catalog
from yieldloom.operators.selectors import (
    FEATURE_SETS,
    PRUNED_SETS,
    RANKED_SETS,
    correlations,
    feature_scores,
    resolve_feature_sets,
)
from yieldloom.operators.splits import dev_and_test, expanding_folds, read_folds, stratified_split, undersample
from yieldloom.plans.models import REGISTRY, Fitted, ModelSpec, class_sizes, fit
from yieldloom.sources.workspace import new_folder, settled
from yieldloom.spec import DEFAULT_SPEC, EntitySpec

CONFIG = ["model", "feature_set", "fold"]


@dataclass
class Options:
    """What to run. The default is every enabled model on every feature set; tests pass less."""

    models: Sequence[str] = tuple(m.model_id for m in REGISTRY.values() if m.enabled)
    feature_sets: Sequence[str] = tuple(FEATURE_SETS)
    n_splits: int = 4
    min_fails: int = 8
    overrides: Mapping[str, Mapping[str, Any]] | None = None
    # fits are independent jobs; a few at a time keep the cluster busy while one waits for its driver
    threads: int = 4
    seed: int = 42
    # how the mutual information sets are ranked: by the nearest-neighbour estimate, or by "bins" of rank,
    # which needs no pass of its own
    information: str = "neighbors"


@dataclass
class Evaluation:
    """Fold results, out-of-fold scores and run times of a walk-forward run."""

    results: DataFrame
    scores: DataFrame
    runtimes: DataFrame


def fold_inputs(
    df: DataFrame, catalog: DataFrame, in_train: Sequence, options: Options, spec: EntitySpec
) -> dict[tuple[str, int], FoldInputs]:
    """The resolved feature sets of every fold with their training statistics.

    Statistics depend on (feature, fold) and sets on (set, fold), never on the model, so both are computed
    once for all models: one moments pass, one value-rank pass, and if a set asks for it one correlation pass
    and one nearest-neighbour pass.
    """
    scores = settled(feature_scores(df, in_train, spec))
    if options.information == "neighbors" and any(RANKED_SETS.get(s, ("",))[0] == "mutual_info" for s in options.feature_sets):
        nearest = neighbor_information(df, in_train, scores, spec).select("fold", "feature_ordinal", "mutual_info")
        scores = settled(scores.drop("mutual_info").join(nearest, ["fold", "feature_ordinal"]))
    catalog = settled(catalog.select("feature_ordinal", "feature_name", "recommended_action"))
    pairs = None
    if any(s in PRUNED_SETS for s in options.feature_sets):
        usable = catalog.where(F.col("recommended_action").isin("keep", "review_high_missing"))
        names = [r.feature_name for r in usable.orderBy("feature_ordinal").collect()]
        pairs = settled(correlations(df, names, in_train, spec).where(F.abs("r") >= F.lit(min(PRUNED_SETS.values()))))
    resolved = resolve_feature_sets(scores, catalog, pairs, options.feature_sets)
    return read_inputs(input_statistics(resolved, scores))


def fit_and_score(
    jobs: Sequence[tuple[ModelSpec, FoldInputs, DataFrame, DataFrame, tuple[int, int]]],
    options: Options,
    spec: EntitySpec,
    spark: SparkSession,
) -> tuple[DataFrame, list[tuple[str, str, int, float]]]:
    """Fit every (model, inputs, train, test) and write its test scores to its own folder.

    Writing replaces a plan that would union hundreds of fitted models, and a job that is tried again
    overwrites only its own folder.
    """
    folder = new_folder(spark, "scores")

    def one(job) -> tuple[str, str, int, float]:
        model, inputs, train, test, sizes = job
        start = time.perf_counter()
        fitted = fit(model, train, list(inputs.inputs), sizes, spec, (options.overrides or {}).get(model.model_id), options.seed)
        config = [F.lit(v).alias(c) for c, v in zip(CONFIG, (model.model_id, inputs.feature_set, inputs.fold))]
        out = fitted.score(test).select(F.col(spec.id).alias("entity_id"), "y_true", "risk", *config)
        path = f"{folder}/{model.model_id}/{inputs.feature_set}/{inputs.fold}"
        out.write.mode("overwrite").parquet(path)
        return model.model_id, inputs.feature_set, inputs.fold, time.perf_counter() - start

    if options.threads > 1:
        with ThreadPoolExecutor(options.threads) as pool:
            times = list(pool.map(inheritable_thread_target(spark)(one), jobs))
    else:
        times = [one(job) for job in jobs]
    # the configuration is in the files, not in the folder names: joins on partition columns would add a
    # dynamic-pruning subquery to every scan of this small-keyed table
    return spark.read.option("recursiveFileLookup", "true").parquet(folder), times


def config_metrics(scores: DataFrame) -> DataFrame:
    """Ranking, median-cut and inspection metrics of every scored configuration in one pass each."""
    rates = metrics.median_cut_rates(scores, CONFIG, few_groups=True)
    checks = metrics.inspection_metrics(scores, CONFIG, few_groups=True)
    joined = rates.join(checks, CONFIG, "left")
    # with one class in the test rows the inspection numbers mean nothing
    names = [c for c in checks.columns if c not in CONFIG]
    return joined.select(
        *CONFIG,
        "pr_auc",
        "roc_auc",
        "precision",
        "recall",
        "f1",
        "balanced_accuracy",
        *[F.when(F.col("pr_auc").isNotNull(), F.col(c)).alias(c) for c in names],
    )


def walk_forward(
    df: DataFrame, catalog: DataFrame, options: Options | None = None, spec: EntitySpec = DEFAULT_SPEC
) -> Evaluation:
    """Expanding-window evaluation of all configurations on the development rows."""
    options = options or Options()
    spark = df.sparkSession
    folds = read_folds(expanding_folds(df, spec, options.n_splits, options.min_fails))
    inputs = fold_inputs(df, catalog, [f.in_train(spec) for f in folds], options, spec)
    jobs, facts = [], []
    for f in folds:
        train, test = df.where(f.in_train(spec)), df.where(f.in_test(spec))
        sizes = class_sizes(train, spec)
        for feature_set in options.feature_sets:
            chosen = inputs.get((feature_set, f.fold))
            # an empty set, or one without any value in training, has no model
            if chosen is None or not chosen.inputs:
                continue
            for name in options.models:
                model = REGISTRY[name]
                if model.fit_mode == "pass_only" and sizes[0] == 0:
                    continue
                jobs.append((model, chosen, train, test, sizes))
                facts.append(
                    (
                        name,
                        feature_set,
                        f.fold,
                        f.n_splits,
                        model.family,
                        model.kind,
                        model.final_eligible,
                        True,
                        "",
                        len(chosen.selected),
                        len(chosen.inputs),
                        ", ".join(chosen.dropped),
                        str(f.train_start_date),
                        str(f.train_end_date),
                        str(f.test_start_date),
                        str(f.test_end_date),
                        f.train_fails,
                        f.test_fails,
                        len(chosen.selected),
                        list(chosen.selected),
                    )
                )
    if not jobs:
        raise ValueError("no feature set has features in any fold")
    scores, times = fit_and_score(jobs, options, spec, spark)
    about = spark.createDataFrame(
        facts,
        "model string, feature_set string, fold int, n_splits int, model_family string, model_kind string, "
        "final_eligible boolean, enabled boolean, skip_reason string, n_features_requested int, n_features_used int, "
        "dropped_all_missing_features string, train_start_date string, train_end_date string, test_start_date string, "
        "test_end_date string, train_fails long, test_fails long, n_features_selected int, selected_features array<string>",
    )
    results = settled(about.join(config_metrics(scores), CONFIG))
    runtimes = spark.createDataFrame(times, "model string, feature_set string, fold int, seconds double")
    per_config = runtimes.groupBy("model", "feature_set").agg(F.sum("seconds").alias("elapsed"))
    return Evaluation(results, scores, per_config)


def slowest_configs(runtimes: DataFrame, n: int = 3) -> DataFrame:
    return runtimes.orderBy(F.col("elapsed").desc(), "model", "feature_set").limit(n)


# fixed values: names of the averaged fold metrics
MEANS = ["pr_auc", "roc_auc", "f1", "precision", "recall", "balanced_accuracy"] + [
    f"{name}_at_{rate}" for rate in ("05pct", "10pct", "20pct") for name in ("recall", "precision", "lift")
]


def model_benchmark(results: DataFrame) -> DataFrame:
    """Fold means per configuration, dense rank by mean PR AUC, and the configuration to inspect by.

    The windows see one row per configuration.
    """
    table = results.groupBy("model", "feature_set").agg(
        *[F.avg(m).alias(f"mean_{m}") for m in MEANS],
        F.stddev_samp("pr_auc").alias("std_pr_auc"),
        F.first("model_family").alias("model_family"),
        F.first("model_kind").alias("model_kind"),
        F.first("final_eligible").alias("final_eligible"),
        F.first("enabled").alias("enabled"),
    )
    usable = F.col("final_eligible") & F.col("enabled")
    by_recall = Window.partitionBy(usable).orderBy(
        F.col("mean_recall_at_10pct").desc_nulls_last(), "model", "feature_set"
    )
    return table.withColumn(
        "rank", F.dense_rank().over(Window.orderBy(F.col("mean_pr_auc").desc_nulls_last()))
    ).withColumn("best_for_inspection_policy", usable & (F.row_number().over(by_recall) == 1))


def best_config(results: DataFrame) -> dict[str, Any]:
    """The eligible, enabled configuration with the best mean PR AUC."""
    eligible = results.where(F.col("final_eligible") & F.col("enabled"))
    means = eligible.groupBy("model", "feature_set").agg(F.avg("pr_auc").alias("mean_pr_auc"))
    row = means.orderBy(F.col("mean_pr_auc").desc_nulls_last(), "model", "feature_set").first()
    if row is None:
        raise ValueError("no eligible and enabled model in the results")
    return row.asDict()


def feature_selection_summary(results: DataFrame) -> DataFrame:
    """Selected feature counts per configuration, and the first fold's first ten features."""
    return results.groupBy("model", "feature_set").agg(
        F.avg("n_features_selected").alias("mean_n_selected"),
        F.min("n_features_selected").alias("min_n_selected"),
        F.max("n_features_selected").alias("max_n_selected"),
        F.slice(F.min_by("selected_features", "fold"), 1, 10).alias("example_features"),
    )


def inspection_benchmark(benchmark: DataFrame) -> DataFrame:
    """The benchmark's inspection columns."""
    facts = ["model", "feature_set", "model_family", "model_kind", "final_eligible", "enabled"]
    return benchmark.select(
        *facts, *[f"mean_{n}_at_{r}" for r in ("05pct", "10pct", "20pct") for n in ("recall", "precision", "lift")]
    )


def anomaly_benchmark(benchmark: DataFrame) -> DataFrame:
    return benchmark.where(F.col("model_kind") == "anomaly_detector")


@dataclass
class FinalTest:
    """The locked configuration on the held-out newest dates."""

    fitted: Fitted
    inputs: FoldInputs
    scores: DataFrame
    results: DataFrame
    confusion: DataFrame
    importance: DataFrame
    curve: DataFrame
    inspection: DataFrame


def evaluate_final(
    dev: DataFrame,
    test: DataFrame,
    catalog: DataFrame,
    model_name: str,
    feature_set: str,
    threshold: float,
    options: Options | None = None,
    spec: EntitySpec = DEFAULT_SPEC,
    artifact: str | None = None,
) -> FinalTest:
    """Refit on all development rows, score the test rows once, save the model with its preprocessing."""
    options = options or Options()
    if model_name not in REGISTRY:
        raise ValueError(f"unknown model: {model_name}")
    spark = dev.sparkSession
    one_set = Options(feature_sets=[feature_set], overrides=options.overrides, seed=options.seed)
    chosen = fold_inputs(dev, catalog, [F.lit(True)], one_set, spec).get((feature_set, 1))
    if chosen is None or not chosen.inputs:
        raise ValueError("the selected feature set is empty")
    model = REGISTRY[model_name]
    fitted = fit(
        model, dev, list(chosen.inputs), class_sizes(dev, spec), spec, (options.overrides or {}).get(model_name), options.seed
    )
    scores = settled(fitted.score(test).withColumnRenamed(spec.id, "entity_id"))
    cells = settled(metrics.with_rates(metrics.confusion(scores, threshold)))
    # one row
    at_threshold = cells.first()
    results = settled(
        metrics.discrimination(scores).select(
            F.lit(model_name).alias("model"),
            F.lit(feature_set).alias("feature_set"),
            F.lit(len(fitted.inputs)).alias("n_features"),
            F.lit(float(threshold)).alias("threshold"),
            F.col("pr_auc").alias("test_pr_auc"),
            F.col("roc_auc").alias("test_roc_auc"),
            F.lit(at_threshold.precision).alias("test_precision"),
            F.lit(at_threshold.recall).alias("test_recall"),
            F.lit(at_threshold.f1).alias("test_f1"),
        )
    )
    named = [F.lit(model_name).alias("model"), F.lit(feature_set).alias("feature_set")]
    inspection = settled(metrics.inspection_metrics(scores))
    final = FinalTest(
        fitted=fitted,
        inputs=chosen,
        scores=scores,
        results=results,
        confusion=cells.select("tn", "fp", "fn", "tp"),
        importance=fitted.importance(spark),
        curve=metrics.inspection_curve(scores).select(*named, "*"),
        inspection=inspection,
    )
    if artifact:
        fitted.save(
            artifact,
            # fixed values: the names of the metadata
            {
                "model": model_name,
                "feature_set": feature_set,
                "features": [i.name for i in fitted.inputs],
                "dropped_features": ", ".join(chosen.dropped),
                "threshold": threshold,
                "model_kind": model.kind,
                "score_method": model.score_method,
                "selector_metadata": {
                    "feature_set_name": feature_set,
                    "n_features_selected": len(fitted.inputs),
                    "selected_features": [i.name for i in fitted.inputs],
                    "dropped_features": ", ".join(chosen.dropped),
                },
                "results": results.first().asDict(),
                "inspection_metrics": inspection.first().asDict(),
            },
        )
    return final


@dataclass
class ModelingRun:
    """Everything the model tables are made of."""

    evaluation: Evaluation
    benchmark: DataFrame
    best: dict[str, Any]
    threshold: float
    sweep: DataFrame
    bins: DataFrame
    confusion: DataFrame
    final: FinalTest


def run_modeling(
    entities: DataFrame,
    catalog: DataFrame | None = None,
    options: Options | None = None,
    spec: EntitySpec = DEFAULT_SPEC,
    test_size: float = 0.15,
    artifact: str | None = None,
) -> ModelingRun:
    """Split by date, evaluate on the development part, lock model and threshold, test once."""
    options = options or Options()
    catalog = settled(catalog if catalog is not None else feature_catalog(entities, spec))
    dev, test = dev_and_test(entities, spec, test_size)
    evaluation = walk_forward(dev, catalog, options, spec)
    best = best_config(evaluation.results)
    of_best = evaluation.scores.where(
        (F.col("model") == best["model"]) & (F.col("feature_set") == best["feature_set"])
    ).select("entity_id", "y_true", "risk")
    sweep = settled(metrics.threshold_sweep(of_best))
    threshold = sweep.where("selected").first().cut
    final = evaluate_final(
        dev, test, catalog, best["model"], best["feature_set"], threshold, options, spec, artifact
    )
    named = [
        F.lit(best["model"]).alias("model"),
        F.lit(best["feature_set"]).alias("feature_set"),
        F.lit(float(threshold)).alias("threshold"),
    ]
    cells = ["tn", "fp", "fn", "tp"]
    oof = metrics.confusion(of_best, threshold).select(F.lit("dev_oof").alias("split"), *named, *cells)
    tested = final.confusion.select(F.lit("test").alias("split"), *named, *cells)
    return ModelingRun(
        evaluation=evaluation,
        benchmark=settled(model_benchmark(evaluation.results)),
        best=best,
        threshold=threshold,
        sweep=sweep,
        bins=metrics.probability_bins(final.scores),
        confusion=oof.unionByName(tested),
        final=final,
    )


# fixed values: names of the comparison protocols
RANDOM_SPLIT = "random_split_reference"
UNDERSAMPLED_SPLIT = "random_split_undersampled_reference"


def random_split_comparison(
    entities: DataFrame, catalog: DataFrame | None = None, options: Options | None = None, spec: EntitySpec = DEFAULT_SPEC
) -> DataFrame:
    """The same configurations under a random 70/30 split, with and without undersampled passes."""
    options = options or Options()
    spark = entities.sparkSession
    catalog = settled(catalog if catalog is not None else feature_catalog(entities, spec))
    split = stratified_split(entities, spec, 0.30, options.seed)
    train = split.where("split = 'train'").drop("split")
    test = split.where("split = 'test'").drop("split")
    protocols = {RANDOM_SPLIT: train}
    n_pass, n_fail = class_sizes(train, spec)
    if n_pass > n_fail > 0:
        protocols[UNDERSAMPLED_SPLIT] = undersample(train, spec, options.seed)
    tables = []
    for protocol, rows in protocols.items():
        inputs = fold_inputs(rows, catalog, [F.lit(True)], options, spec)
        sizes = class_sizes(rows, spec)
        jobs = [
            (REGISTRY[name], inputs[feature_set, 1], rows, test, sizes)
            for feature_set in options.feature_sets
            if (feature_set, 1) in inputs and inputs[feature_set, 1].inputs
            for name in options.models
        ]
        scores, _ = fit_and_score(jobs, options, spec, spark)
        used = spark.createDataFrame(
            [(job[0].model_id, job[1].feature_set, len(job[1].inputs)) for job in jobs],
            "model string, feature_set string, n_features int",
        )
        found = config_metrics(scores).drop("fold", "balanced_accuracy")
        tests = {c: f"test_{c}" for c in ("pr_auc", "roc_auc", "precision", "recall", "f1")}
        table = used.join(found.withColumnsRenamed(tests), ["model", "feature_set"])
        tables.append(table.withColumn("evaluation_protocol", F.lit(protocol)))
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out
