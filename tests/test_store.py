"""Saved models, metrics and manifests come back as they were."""
import pytest

from cohortloom.operators import learn, store
from cohortloom.operators.learn import Spec
from cohortloom.plans import scoring
from cohortloom.sources import tables


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(i, int(i % 7 < 3), float(i % 7), float(i % 5)) for i in range(210)], "row_key int, y_true int, a double, b double")


def scores(scorer, df):
    return {r.row_key: round(r[learn.SCORE], 12) for r in scorer.score(df).select("row_key", learn.SCORE).collect()}


def test_models_of_every_kind(spark, rows, tmp_path):
    tree = Spec("decision_tree", ("a", "b"), params={"minInstancesPerNode": 1})
    logistic = Spec("logistic_regression", ("a", "b"))
    kinds = {
        "single": learn.fit_model(rows, logistic),
        "isotonic": learn.fit_calibrated(rows, tree, folds=2),
        "sigmoid": learn.fit_calibrated(rows, logistic, folds=2),
        "voting": learn.fit_voting(rows, [tree, logistic]),
        "stacking": learn.fit_stacking(rows, [tree, logistic], folds=2),
    }
    for name, scorer in kinds.items():
        store.save(spark, scorer, f"{tmp_path}/{name}")
        back = store.load(spark, f"{tmp_path}/{name}")
        assert type(back) is type(scorer) and scores(back, rows) == scores(scorer, rows)
        assert (back.method, back.warnings) == (scorer.method, scorer.warnings)


def test_metrics_and_manifest(spark, rows, tmp_path):
    tree = Spec("decision_tree", ("a", "b"), params={"minInstancesPerNode": 1})
    scorer, metrics = learn.train_with_threshold(rows, tree, folds=2)
    store.write_metrics(metrics, str(tmp_path / "m"), "target_x", "decision_tree")
    found = tables.collect_metrics(spark, str(tmp_path / "m")).collect()
    best = metrics.first()
    assert [(r.target, r.model, r.split, r.Threshold, r.Recall) for r in found] == [("target_x", "decision_tree", "validation", best.Threshold, best.Recall)]
    features = learn.feature_metadata(rows, ["a", "b"], "y_true")
    made = store.write_manifest(spark, f"{tmp_path}/manifest", "target_x", scorer, best.Threshold, {"F2": best.F2}, features)
    assert store.read_manifest(spark, f"{tmp_path}/manifest") == made
    assert made["feature_names"] == ["a", "b"] and made["feature_medians"] == {"a": 3.0, "b": 2.0} and made["n_train"] == 210


def test_imputation_of_raw_values(spark):
    df = spark.createDataFrame([(1, "7", None), (2, "nan", 4.0)], "k int, a string, b double")
    manifest = {"feature_names": ["a", "b", "c"], "feature_medians": {"a": 3.0, "b": 2.0, "c": 9.0}, "imputation": {"strategy": "fill_median"}}
    got = [tuple(r) for r in scoring.impute(df, manifest).select("a", "b", "c").orderBy("k").collect()]
    assert got == [(7.0, 2.0, 9.0), (3.0, 4.0, 9.0)]
    constant = manifest | {"imputation": {"strategy": "fill_constant", "value": -1}}
    assert [tuple(r) for r in scoring.impute(df, constant).select("a", "b", "c").orderBy("k").collect()] == [(7.0, -1.0, -1.0), (-1.0, 4.0, -1.0)]
