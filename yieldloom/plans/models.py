"""The model registry and how each model is fitted and scores a table."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field
from typing import Any

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldloom.functions import unit_hash
from yieldloom.operators import boosting, ellipse, forest, neighbors
from yieldloom.operators.preprocess import Input, prepare, preparation, raw_table
from yieldloom.sources.workspace import settled
from yieldloom.spec import DEFAULT_SPEC, EntitySpec


@dataclass(frozen=True)
class ModelSpec:
    """What a model is and needs. Every model here gives a risk that is higher for likelier fails."""

    model_id: str
    family: str
    scaled: bool
    final_eligible: bool
    kind: str = "classifier"
    fit_mode: str = "all_train"
    score_method: str = "predict_proba"
    enabled_by_default: bool = True
    available: bool = True

    @property
    def enabled(self) -> bool:
        return self.enabled_by_default and self.available

    @property
    def skip_reason(self) -> str:
        if not self.enabled_by_default:
            return "disabled by default"
        return "" if self.available else "optional dependency missing"


def _detector(model_id: str, eligible: bool, fit_mode: str, on: bool, method: str = "score_samples") -> ModelSpec:
    return ModelSpec(model_id, "anomaly_detection", True, eligible, "anomaly_detector", fit_mode, method, on)


# fixed values: model names, families, kinds and eligibility
REGISTRY: dict[str, ModelSpec] = {
    m.model_id: m
    for m in [
        ModelSpec("dummy_stratified", "baseline", False, False),
        ModelSpec("logistic_l1", "linear", True, True),
        ModelSpec("logistic_l2", "linear", True, True),
        ModelSpec("random_forest", "bagged_trees", False, True),
        ModelSpec("hist_gradient_boosting", "boosted_trees", False, True),
        ModelSpec("xgboost_hist", "boosted_trees", False, False, available=False),
        ModelSpec("lightgbm_gbdt", "boosted_trees", False, False, available=False),
        ModelSpec("knn_scaled", "distance_based", True, False),
        _detector("isolation_forest_pass_only", True, "pass_only", True),
        _detector("local_outlier_factor_pass_only", True, "pass_only", True),
        _detector("elliptic_envelope_pass_only", True, "pass_only", False),
        _detector("one_class_svm_pass_only", False, "pass_only", False, "decision_function"),
        _detector("isolation_forest_all_train", False, "all_train", False),
    ]
}

REGISTRY_SCHEMA = (
    "model_id string, model_family string, model_kind string, fit_mode string, score_method string, "
    "final_eligible boolean, enabled boolean, skip_reason string"
)


def model_registry(spark: SparkSession) -> DataFrame:
    """The registry as a table."""
    rows = [
        (m.model_id, m.family, m.kind, m.fit_mode, m.score_method, m.final_eligible, m.enabled, m.skip_reason)
        for m in REGISTRY.values()
    ]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA).coalesce(1)


@dataclass
class Fitted:
    """A fitted model: scores any entity table with the same feature columns."""

    model: ModelSpec
    inputs: list[Input]
    spec: EntitySpec
    stages: PipelineModel | None = None
    state: dict[str, Any] = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def score(self, df: DataFrame) -> DataFrame:
        """(id, y_true, risk)."""
        entity = self.spec.id
        labels = df.select(entity, self.spec.y().alias("y_true"))
        if self.model.model_id == "dummy_stratified":
            # a repeatable coin per entity, 32 bits of a digest, that lands on fail with the training fail rate
            coin = F.conv(F.substring(unit_hash(F.col(entity), self.state["seed"]), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))
            return labels.withColumn("risk", (coin < F.lit(self.state["prior"])).cast("double"))
        if self.model.model_id == "hist_gradient_boosting":
            table = raw_table(df, self.inputs, self.spec)
            risk = boosting.score_boosting(table, [i.name for i in self.inputs], self.tables["nodes"], self.state["base"], entity)
            return labels.join(risk, entity, "left").select(entity, "y_true", "risk")
        if self.stages is not None and self.model.kind == "classifier" and self.model.model_id != "knn_scaled":
            needed = sorted({i.source for i in self.inputs})
            rows = df.select(entity, self.spec.y().alias("y_true"), *[F.col(f"`{c}`") for c in needed])
            out = self.stages.transform(rows)
            return out.select(entity, "y_true", vector_to_array("probability")[1].alias("risk"))
        x = prepare(df, self.inputs, self.model.scaled, self.spec)
        if self.model.model_id == "knn_scaled":
            risk = neighbors.neighbor_vote(self.tables["points"], x, self.state["k"], entity)
        elif self.model.model_id.startswith("isolation_forest"):
            risk = forest.score_forest(x, self.tables["nodes"], self.state["sample"], entity)
        elif self.model.model_id.startswith("local_outlier_factor"):
            risk = neighbors.local_outlier_factor(self.tables["points"], x, self.state["k"], entity, self.tables["densities"])
        else:
            risk = ellipse.distances(x, self.state["mean"], self.state["inverse"], entity)
        return labels.join(risk, entity, "left").select(entity, "y_true", "risk")

    def importance(self, spark: SparkSession) -> DataFrame:
        """(feature_name, importance, importance_type), most important first."""
        names = [i.name for i in self.inputs]
        last = self.stages.stages[-1] if self.stages is not None else None
        if last is not None and hasattr(last, "featureImportances"):
            kind, weights = "native", last.featureImportances.toArray().tolist()
        elif last is not None and hasattr(last, "coefficients"):
            kind, weights = "abs_coefficient", [abs(c) for c in last.coefficients.toArray().tolist()]
        else:
            kind, weights = "not_available", [0.0] * len(names)
        rows = [(n, name, float(w), kind) for n, (name, w) in enumerate(zip(names, weights))]
        table = spark.createDataFrame(rows, "place int, feature_name string, importance double, importance_type string")
        return table.coalesce(1).orderBy(F.col("importance").desc(), "place").drop("place")

    def save(self, path: str, metadata: Mapping[str, Any]) -> None:
        """Model folder: the stages, any tables the scorer reads, and one row of JSON metadata."""
        spark = SparkSession.getActiveSession()
        stages = self.stages or PipelineModel(preparation(self.inputs, self.model.scaled))
        stages.write().overwrite().save(f"{path}/stages")
        for name, table in self.tables.items():
            table.write.mode("overwrite").parquet(f"{path}/{name}")
        state = {k: v.tolist() if hasattr(v, "tolist") else v for k, v in self.state.items()}
        own = {
            "model_id": self.model.model_id,
            "state": state,
            "inputs": [asdict(i) for i in self.inputs],
            "spec": asdict(self.spec),
            "tables": sorted(self.tables),
            "fitted_stages": self.stages is not None,
        }
        text = json.dumps({**metadata, "saved": own}, default=str)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load(spark: SparkSession, path: str) -> Fitted:
    """A model as `Fitted.save` wrote it; it scores as it did before."""
    text = spark.read.text(f"{path}/metadata", wholetext=True).first()
    if text is None:
        raise ValueError(f"no saved model in {path}")
    own = json.loads(text.value)["saved"]
    state = {k: np.array(v) if isinstance(v, list) else v for k, v in own["state"].items()}
    return Fitted(
        REGISTRY[own["model_id"]],
        [Input(**i) for i in own["inputs"]],
        EntitySpec(**own["spec"]),
        PipelineModel.load(f"{path}/stages") if own["fitted_stages"] else None,
        state,
        {name: spark.read.parquet(f"{path}/{name}") for name in own["tables"]},
    )


def class_sizes(df: DataFrame, spec: EntitySpec = DEFAULT_SPEC) -> tuple[int, int]:
    """(passes, fails)."""
    row = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(spec.y()), F.lit(0)).alias("p")).first()
    return row.n - row.p, row.p


def fit(
    model: ModelSpec,
    train: DataFrame,
    inputs: list[Input],
    sizes: tuple[int, int],
    spec: EntitySpec = DEFAULT_SPEC,
    overrides: Mapping[str, Any] | None = None,
    seed: int = 42,
) -> Fitted:
    """Fit one model on the training rows of a fold; `sizes` are their passes and fails."""
    options = dict(overrides or {})
    n_pass, n_fail = sizes
    n = n_pass + n_fail
    name = model.model_id
    if not model.available or name == "one_class_svm_pass_only":
        raise ValueError(f"{name} is listed but not built")
    if name == "dummy_stratified":
        return Fitted(model, inputs, spec, state={"prior": n_fail / n if n else 0.0, "seed": seed})

    if name == "hist_gradient_boosting":
        # takes missing values as they are and stays unweighted
        table = raw_table(train, inputs, spec)
        base, nodes = boosting.fit_boosting(table, [i.name for i in inputs], boosting.Settings(**options))
        return Fitted(model, inputs, spec, state={"base": base}, tables={"nodes": settled(nodes)})

    if model.kind == "classifier" and name != "knn_scaled":
        # balanced weights n / (2 n_class)
        weight = F.when(F.col("y") == 1, n / (2.0 * max(n_fail, 1))).otherwise(n / (2.0 * max(n_pass, 1)))
        common = {"featuresCol": "features", "labelCol": "y"}
        if name.startswith("logistic"):
            # sum of weighted losses + |w| / C  ==  n * (mean loss + regParam |w|); the weights sum to n
            settings = {
                "elasticNetParam": 1.0 if name.endswith("l1") else 0.0,
                "regParam": 1.0 / (options.pop("C", 1.0) * max(n, 1)),
                "standardization": False,
                "maxIter": 500,
                "weightCol": "weight",
            }
            estimator = LogisticRegression(**common, **{**settings, **options})
        else:
            settings = {
                "numTrees": 200,
                "maxDepth": 8,
                "minInstancesPerNode": 2,
                "featureSubsetStrategy": "sqrt",
                "seed": seed,
                "weightCol": "weight",
            }
            estimator = RandomForestClassifier(**common, **{**settings, **options})
        stages = preparation(inputs, model.scaled)
        needed = sorted({i.source for i in inputs})
        rows = train.select(spec.y().alias("y"), *[F.col(f"`{c}`") for c in needed]).withColumn("weight", weight)
        for stage in stages:
            rows = stage.transform(rows)
        fitted = estimator.fit(rows.select("y", "weight", "features"))
        return Fitted(model, inputs, spec, PipelineModel([*stages, fitted]))

    points = prepare(train, inputs, model.scaled, spec)
    if model.fit_mode == "pass_only":
        if n_pass == 0:
            raise ValueError("no passes to fit a pass-only detector on")
        points = points.where("y = 0")
    if name == "knn_scaled":
        return Fitted(model, inputs, spec, state={"k": options.get("k", 5)}, tables={"points": points})
    n_points = n_pass if model.fit_mode == "pass_only" else n
    if name.startswith("isolation_forest"):
        sample = min(forest.SAMPLE, n_points)
        trees = options.get("trees", forest.TREES)
        nodes = forest.settled_forest(points, n_points, trees, sample, seed, spec.id)
        return Fitted(model, inputs, spec, state={"sample": sample}, tables={"nodes": nodes})
    if name.startswith("local_outlier_factor"):
        k = neighbors.outlier_neighbors(n_pass)
        densities = neighbors.point_densities(points, k, spec.id)
        return Fitted(model, inputs, spec, state={"k": k}, tables={"points": points, "densities": densities})
    mean, inverse = ellipse.robust_center(points, spec.id, **options)
    return Fitted(model, inputs, spec, state={"mean": mean, "inverse": inverse})
