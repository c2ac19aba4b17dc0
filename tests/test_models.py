import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from helpers import daily, entities
from yieldloom.operators import forest, neighbors
from yieldloom.operators.preprocess import Input, input_statistics, read_inputs
from yieldloom.operators.profile import feature_catalog
from yieldloom.operators.selectors import feature_scores, resolve_feature_sets
from yieldloom.plans import modeling
from yieldloom.plans.models import REGISTRY, class_sizes, fit, model_registry
from yieldloom.sources.workspace import settled


def vectors(spark, x, first=0):
    rows = [(first + i, [float(v) for v in row]) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "entity_id long, a array<double>").select("entity_id", array_to_vector("a").alias("features"))


@pytest.mark.parametrize("cells,block", [(1, 5), (6, 10), (64, 4096), (None, 4096)])
def test_neighbors_match_brute_force_with_many_copies(spark, cells, block):
    random = np.random.default_rng(1)
    x = random.normal(size=(90, 3))
    x[:30] = x[0]
    q = np.vstack([random.normal(size=(20, 3)), x[:5]])
    got = neighbors.nearest_neighbors(vectors(spark, x), vectors(spark, q, 1000), 4, cells=cells, block=block)
    got = got.toPandas().sort_values(["entity_id", "rank"])
    d = np.sqrt(((q[:, None] - x[None]) ** 2).sum(axis=2))
    want = np.argsort(d, axis=1, kind="stable")[:, :4]
    assert (got.neighbor_id.to_numpy().reshape(-1, 4) == want).all()


def test_neighbor_search_without_itself(spark):
    x = np.arange(12.0).reshape(-1, 1)
    points = vectors(spark, x)
    got = neighbors.nearest_neighbors(points, points, 2, exclude_self=True, cells=3, block=4).toPandas()
    assert len(got) == 24 and (got.entity_id != got.neighbor_id).all()
    assert set(got[got.entity_id == 0].neighbor_id) == {1, 2}


def test_search_plan_does_not_grow_with_the_cells_and_far_cells_are_not_visited(spark):
    random = np.random.default_rng(6)
    centres = random.normal(size=(40, 3)) * 100
    x = np.vstack([c + random.normal(size=(25, 3)) for c in centres])
    points, asked = vectors(spark, x), vectors(spark, x[::50] + 0.01, 5000)
    plans, visited = [], []
    for cells in (9, 100):
        index = neighbors.pivot_index(points, cells=cells, block=16)
        plans.append(len(neighbors.nearest_neighbors(index, asked, 3)._jdf.queryExecution().analyzed().toString()))
        assert plans[-1] < 20_000
        plain = neighbors._plain(asked, "entity_id")
        visits = neighbors._visits(index, plain, neighbors._upper_bounds(index, plain, 3, False))
        visited.append(visits.select("id", "top", "sub").distinct().count() / (20 * index.cells.count()))
    assert abs(plans[0] - plans[1]) < 0.02 * plans[0]
    assert visited[1] < 0.2


def test_a_query_meets_few_blocks_and_takes_from_them_only_what_is_within_its_bound(spark):
    # without pruning every query travels to every cell, so their number must not grow with the root of the points
    assert neighbors.cells_for(4_096) == 1 and neighbors.cells_for(80_000) <= 16 and neighbors.cells_for(480_000) <= 16
    x = np.random.default_rng(8).normal(size=(60, 2))
    index = neighbors.pivot_index(vectors(spark, x), cells=4, block=64)
    asked = settled(neighbors._plain(vectors(spark, x[:7], 100), "entity_id"))
    visits = neighbors._visits(index, asked, asked.selectExpr("id", "0.5D AS upper"))
    assert set(visits.columns) == {"id", "v", "upper", "top", "sub", "part"}
    found = neighbors._block_search(index.points, visits, 60, False, "bigint", 64).toPandas()
    d = np.sqrt(((x[:7, None] - x[None]) ** 2).sum(axis=2))
    row, col = np.nonzero(d <= 0.5)
    assert sorted(zip(found.qid, found.nid)) == sorted(zip(row + 100, col))


def test_isolation_forest_ranks_an_outlier_first_and_repeats(spark):
    x = np.random.default_rng(2).normal(size=(300, 4))
    points = vectors(spark, x)
    queries = vectors(spark, np.vstack([x[:20], np.full((1, 4), 9.0)]), 500)
    first = forest.settled_forest(points, 300, 40, 256, 42, "entity_id")
    again = forest.grow_forest(points.repartition(5), 300, 40, 256, 42)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))
    scores = forest.score_forest(queries, first, 256).toPandas().sort_values("risk")
    assert scores.entity_id.iloc[-1] == 520
    assert ((scores.risk > 0) & (scores.risk < 1)).all()


def test_large_tables_are_thinned_before_trees_are_dealt(spark):
    points = spark.range(5000).select(F.col("id").alias("entity_id"), array_to_vector(F.array(F.col("id") * 1.0)).alias("features"))
    sizes = forest.tree_samples(points, 5000, 10, 20, 1, "entity_id").groupBy("tree").count().toPandas()
    assert len(sizes) == 10 and sizes["count"].max() <= 20 and sizes["count"].mean() > 15


def test_l1_is_sparser_than_l2(spark):
    random = np.random.default_rng(0)
    x = random.normal(size=(200, 10))
    y = np.where(x[:, 0] + x[:, 1] - x[:, 2] > 0, 1, -1)
    df = entities(spark, {f"feature_{i:03d}": list(x[:, i]) for i in range(10)}, y)
    inputs = [Input(f"feature_{i:03d}", f"feature_{i:03d}", False, 0.0, 0.0, 1.0) for i in range(10)]
    zeros = {}
    for name in ("logistic_l1", "logistic_l2"):
        fitted = fit(REGISTRY[name], df, inputs, class_sizes(df), overrides={"C": 0.05})
        zeros[name] = sum(abs(c) < 1e-8 for c in fitted.stages.stages[-1].coefficients)
        assert [r.importance_type for r in fitted.importance(spark).take(1)] == ["abs_coefficient"]
    assert zeros["logistic_l1"] > zeros["logistic_l2"]


def test_all_missing_feature_is_dropped_and_named(spark):
    n = 60
    random = np.random.default_rng(4)
    df = daily(spark, 6, 10, 3, {"feature_001": list(random.normal(size=n)), "feature_002": [None] * n, "feature_003": list(random.normal(size=n))})
    scores = feature_scores(df, [F.lit(True)])
    resolved = resolve_feature_sets(scores, feature_catalog(df), names=["top_20_effect"])
    inputs = read_inputs(input_statistics(resolved, scores))["top_20_effect", 1]
    assert (len(inputs.selected), len(inputs.inputs), inputs.dropped) == (3, 2, ("feature_002",))


def test_ineligible_models_never_win(spark):
    rows = [
        ("dummy_stratified", "keep_only", 1, 0.90, False, True),
        ("random_forest", "keep_only", 1, 0.20, True, True),
        ("random_forest", "keep_only", 2, 0.25, True, True),
    ]
    results = spark.createDataFrame(
        rows, "model string, feature_set string, fold int, pr_auc double, final_eligible boolean, enabled boolean"
    )
    best = modeling.best_config(results)
    assert (best["model"], best["feature_set"]) == ("random_forest", "keep_only")
    assert best["mean_pr_auc"] == pytest.approx(0.225)
    with pytest.raises(ValueError):
        modeling.best_config(results.where("model = 'dummy_stratified'"))


def test_registry_reasons(spark):
    rows = {r.model_id: r for r in model_registry(spark).collect()}
    assert len(rows) == 13
    assert rows["one_class_svm_pass_only"].skip_reason == "disabled by default"
    assert sum(r.enabled for r in rows.values()) == 8


def test_unknown_model_and_missing_passes_are_errors(spark):
    df = daily(spark, 3, 4, 4)
    inputs = [Input("feature_001", "feature_001", False, 0.0, 0.0, 1.0)]
    with pytest.raises(ValueError):
        fit(REGISTRY["isolation_forest_pass_only"], df, inputs, class_sizes(df))
    with pytest.raises(ValueError):
        modeling.evaluate_final(df, df, feature_catalog(df), "nothing", "keep_only", 0.5)
