"""Models that leave cores idle are fitted beside each other, from rows that are written once."""
import threading

from pyspark.sql import functions as F

from cohortloom.operators import explain, learn
from cohortloom.operators.learn import Spec


def test_boosted_models_are_fitted_beside_the_others(spark, monkeypatch):
    rows = spark.range(60).selectExpr("id AS row_key", "CAST(id % 2 AS int) AS y_true", "CAST(id % 7 AS double) AS a")
    both = threading.Barrier(2)
    monkeypatch.setattr(learn, "fit_model", lambda df, spec: both.wait(30) and None or learn.Scorer(spec, None))
    monkeypatch.setattr(learn.boost, "fit_many", lambda kept, models: both.wait(30) and None or dict.fromkeys(models))
    specs = [Spec(n, ("a",)) for n in ("xgboost", "random_forest")]
    assert [s.spec.name for s in learn.fit_models(rows, specs)] == ["xgboost", "random_forest"]


def test_rows_of_flags_are_written_once_and_flags_measured_side_by_side(spark, monkeypatch):
    left = spark.range(40).selectExpr("id AS k", "CAST(id % 5 AS double) AS a")
    df = left.join(spark.range(40).selectExpr("id AS k", "CAST(id % 2 AS int) AS f1", "CAST(id % 4 = 0 AS int) AS f2", "0 AS f3", "'x' AS unread"), "k")
    both, seen = threading.Barrier(2), {}

    def evaluated(rows, spec, folds, fixed_threshold):
        both.wait(30)
        seen[spec.label] = rows
        return spark.range(2).select(F.lit(0.7).alias("ROC_AUC"))

    monkeypatch.setattr(explain, "cv_evaluate", evaluated)
    out = {r.flag: r for r in explain.flag_predictability(df, ["f1", "f2", "f3"], Spec("random_forest", ("a",), key="k")).collect()}
    assert set(out) == set(seen) == {"f1", "f2"}  # f3 is never set
    assert out["f1"].n_positives == 20 and out["f2"].prevalence == 0.25 and out["f1"].interpretacion == "senal_moderada"
    for rows in seen.values():
        assert rows.columns == ["k", "a", "f1", "f2", "f3"]
        assert "Join" not in rows._jdf.queryExecution().optimizedPlan().toString()
