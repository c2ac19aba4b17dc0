"""Every enabled model is fitted, scores, is saved and, loaded again, scores the same."""

import numpy as np
import pytest

from helpers import entities
from yieldloom.operators.preprocess import Input
from yieldloom.plans.models import REGISTRY, fit, load

OVERRIDES = {
    "random_forest": {"numTrees": 10},
    "hist_gradient_boosting": {"rounds": 5, "min_leaf": 5},
    "isolation_forest_pass_only": {"trees": 20},
    "elliptic_envelope_pass_only": {"starts": 2, "first_steps": 1, "most_steps": 2},
}
ENABLED = [m for m in REGISTRY.values() if m.enabled]
# off by default, but built
BUILT = [*ENABLED, REGISTRY["elliptic_envelope_pass_only"]]


@pytest.fixture(scope="module")
def table(spark):
    random = np.random.default_rng(4)
    labels = [1 if i % 6 == 0 else -1 for i in range(120)]
    planted = [2.5 * (y == 1) + x for y, x in zip(labels, random.normal(size=120))]
    noise = random.normal(size=120).tolist()
    holes = [None if i % 11 == 0 else float(x) for i, x in enumerate(random.normal(size=120))]
    return entities(spark, {"feature_001": planted, "feature_002": noise, "feature_003": holes}, labels).cache()


INPUTS = [
    Input("feature_001", "feature_001", False, 0.4, 0.4, 1.3),
    Input("feature_002", "feature_002", False, 0.0, 0.0, 1.0),
    Input("feature_003", "feature_003", False, 0.0, 0.0, 1.0, 11 / 120),
]


def test_eight_models_are_enabled():
    assert len(ENABLED) == 8


@pytest.mark.parametrize("model", BUILT, ids=lambda m: m.model_id)
def test_saved_model_scores_the_same(spark, table, tmp_path, model):
    fitted = fit(model, table, INPUTS, (100, 20), overrides=OVERRIDES.get(model.model_id))
    before = {r.entity_id: r.risk for r in fitted.score(table).collect()}
    assert len(before) == 120 and all(r is not None for r in before.values())
    fitted.save(str(tmp_path / "model"), {"note": "kept"})
    again = load(spark, str(tmp_path / "model"))
    after = {r.entity_id: r.risk for r in again.score(table).collect()}
    assert after == pytest.approx(before)
    top = fitted.importance(spark).first()
    if top.importance_type != "not_available":
        assert top.feature_name == "feature_001"
        assert [r.feature_name for r in again.importance(spark).collect()] == [r.feature_name for r in fitted.importance(spark).collect()]
