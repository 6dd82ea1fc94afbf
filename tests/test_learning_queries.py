"""What the learner queries ask of their operators, and tuning of models without a search space."""
import inspect

import pytest

from cohortloom import fixtures as fx
from cohortloom.operators import learn
from cohortloom.queries import QUERIES
from cohortloom.queries.screening import FEATS


class Asked(Exception):
    pass


@pytest.mark.parametrize(
    "name, operator, models, whole",
    [
        ("baseline_experiments", "baseline_experiments", list(learn.PRESETS), {}),
        ("tuning_experiments", "tuning_experiments", list(learn.PRESETS), {"n": 3, "folds": 3, "space": None}),
        ("hyperparameter_search", "hyperparameter_search", ["logistic_regression"], {"n": 10, "folds": 10, "space": None}),
        ("fit_stacking", "fit_stacking", list(learn.STACK_BASE), {"folds": 5}),
        ("score_raw_records", "train_with_threshold", ["decision_tree"], {"folds": 5}),
        ("shap_sampling", "fit_model", ["random_forest"], {}),
    ],
)
def test_queries_ask_for_the_whole_job(name, operator, models, whole, spark, sf, monkeypatch):
    asked = inspect.signature(getattr(learn, operator))

    def record(*a, **k):
        bound = asked.bind(*a, **k)
        bound.apply_defaults()
        raise Asked(bound.arguments)

    monkeypatch.setattr(learn, operator, record)
    with pytest.raises(Asked) as found:
        QUERIES[name](spark, sf)
    given = found.value.args[0]
    specs = given["specs"] if "specs" in given else [given["spec"]]
    assert [s.name for s in specs] == models
    assert all(s.settings == learn.PRESETS[s.name]["params"] for s in specs)
    assert {k: given[k] for k in whole} == whole


def test_tuning_without_a_space_takes_each_models_own(spark, sf):
    df = fx.scored(spark, sf).select("row_key", "y_true", *FEATS)
    specs = [learn.Spec(m, tuple(FEATS)) for m in ("decision_tree", "logistic_regression")]
    got = {r.model: r for r in learn.tuning_experiments({"v": df}, specs, [1.0], n=2, folds=2).collect()}
    assert got["decision_tree"].params == "[]" and got["logistic_regression"].params.startswith("[('C', ")
    assert all(0 <= r.f2 <= 1 for r in got.values())


def test_a_network_on_many_rows_uses_all_cores(spark, monkeypatch):
    from cohortloom.operators import forest, learn

    seen, deal = [], forest.spread
    monkeypatch.setattr(forest, "spread", lambda df: seen.append(deal(df)) or seen[-1])
    rows = spark.range(400).selectExpr("id AS row_key", "id % 2 AS y_true", "id % 5 AS a").coalesce(1)
    network = learn.Spec("mlp", ("a",), params={"maxIter": 1, "hidden": [2]})
    learn.fit_model(rows, network)
    assert not seen
    monkeypatch.setattr(learn, "SPREAD_ROWS", 100)
    learn.fit_model(rows, network)
    assert seen[0].rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_folds_are_fitted_side_by_side(spark, monkeypatch):
    import threading

    from cohortloom.operators import learn

    rows = spark.range(200).selectExpr("id AS row_key", "id % 2 AS y_true", "id % 5 AS a")
    spec = learn.Spec("logistic_regression", ("a",))
    # passes only if all folds are under way together
    gate, fit = threading.Barrier(4), learn.fit_model
    monkeypatch.setattr(learn, "fit_model", lambda df, s: (gate.wait(20), fit(df, s))[1])
    scorers = learn.fit_folds(learn.folded_rows(rows, spec, 4), [spec], 4)[0]
    assert len(scorers) == 4 and all(s.spec == spec for s in scorers)
