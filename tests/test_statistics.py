"""Distributed statistics against brute force, with a hot value holding a third of the rows."""
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortloom.operators import evaluate, explain, ordered, sample, screen, unsup
from cohortloom.operators.learn import Spec, calibrate, fit_calibrated, fit_model, score_batch


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    n = 900
    score = np.round(rng.random(n), 2)
    score[: n // 3] = 0.5
    y = (rng.random(n) < 0.2 + 0.5 * score).astype(int)
    group = np.where(np.arange(n) % 5 == 0, "a", "b")
    return score, y, group


@pytest.fixture(scope="module")
def scored(spark, rows):
    score, y, group = rows
    data = [(i, float(s), int(t), str(g)) for i, (s, t, g) in enumerate(zip(score, y, group))]
    return spark.createDataFrame(data, "row_key long, y_proba double, y_true int, g string").cache()


def brute_auc(s, y):
    pos, neg = s[y == 1], s[y == 0]
    d = pos[:, None] - neg[None, :]
    return ((d > 0).sum() + 0.5 * (d == 0).sum()) / d.size


def test_quantiles_match_numpy(scored, rows):
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = ordered.exact_quantiles(scored, "y_proba", probs).first()
    want = np.quantile(rows[0], probs)
    assert [got[f"q{i}"] for i in range(len(probs))] == pytest.approx(want.tolist())
    for r in ordered.exact_quantiles(scored, "y_proba", [0.3], ["g"]).collect():
        assert r["q0"] == pytest.approx(np.quantile(rows[0][rows[2] == r["g"]], 0.3))


def test_auc_and_average_precision(scored, rows):
    score, y, group = rows
    assert evaluate.roc_auc(scored).first()["roc_auc"] == pytest.approx(brute_auc(score, y))
    for r in evaluate.roc_auc(scored, ["g"]).collect():
        m = group == r["g"]
        assert r["roc_auc"] == pytest.approx(brute_auc(score[m], y[m]))
    ap, last = 0.0, 0.0
    for t in sorted(set(score), reverse=True):
        hit = score >= t
        recall, precision = y[hit].sum() / y.sum(), y[hit].mean()
        ap, last = ap + (recall - last) * precision, recall
    assert evaluate.pr_auc(scored).first()["pr_auc"] == pytest.approx(ap)


def test_one_class_gives_no_auc(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "y_proba double, y_true int")
    assert evaluate.roc_auc(df).first()["roc_auc"] is None
    assert evaluate.classification_metrics(df, 0.15).first()["Specificity"] == 0.0


def test_threshold_grid(scored, rows):
    score, y, _ = rows
    assert len(evaluate.GRID) == 90 and evaluate.GRID[13] == 0.18000000000000005
    table = {r["i"]: r for r in evaluate.threshold_table(scored).collect()}
    for i, t in enumerate(evaluate.GRID):
        assert table[i]["tp"] == ((score >= t) & (y == 1)).sum()
        assert table[i]["fp"] == ((score >= t) & (y == 0)).sum()
    best = evaluate.find_threshold(scored, optimize_for="recall_constraint", recall_min=0.85).first()
    options = [(t, y[score >= t].mean()) for t in evaluate.GRID if y[score >= t].sum() / y.sum() >= 0.85]
    assert best["threshold"] == max(options, key=lambda o: (o[1], -o[0]))[0]


def test_calibration_bins_keep_their_own_counts(spark):
    # bins 0 and 9 only: with counts taken by position the second weight would be lost
    df = spark.createDataFrame([(0.05, 0)] * 10 + [(0.95, 0)] * 30, "y_proba double, y_true int")
    row = evaluate.calibration_summary(df).first()
    assert row["ece"] == pytest.approx((10 * 0.05 + 30 * 0.95) / 40) and row["mce"] == pytest.approx(0.95)


def test_bootstrap_interval(scored):
    ci = {r["metric"]: r for r in explain.bootstrap_ci(scored, 0.5, replicates=60).collect()}
    again = {r["metric"]: r for r in explain.bootstrap_ci(scored, 0.5, replicates=60).collect()}
    auc = evaluate.roc_auc(scored).first()["roc_auc"]
    for m, r in ci.items():
        assert r["ci_lower"] <= r["mean"] <= r["ci_upper"] and r["n_valid"] == 60
        assert again[m]["mean"] == r["mean"]
    assert ci["ROC_AUC"]["ci_lower"] < auc < ci["ROC_AUC"]["ci_upper"]


def test_splits_are_exact_and_stable(spark, scored):
    out = sample.split_stratified(scored, "row_key", "y_true", 0.2)
    again = sample.split_stratified(scored.repartition(7), "row_key", "y_true", 0.2)
    assert {tuple(r) for r in out.select("row_key", "split").collect()} == {tuple(r) for r in again.select("row_key", "split").collect()}
    for r in out.groupBy("y_true").agg(F.count_if(F.col("split") == "test").alias("t"), F.count("*").alias("n")).collect():
        assert r["t"] == math.floor(r["n"] * 0.2 + 0.5)
    folds = sample.kfold_stratified(scored, "row_key", "y_true", 5).groupBy("y_true", "fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in folds if r["y_true"] == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    moved = sample.shuffled_column(scored.select("row_key", "y_proba"), "row_key", "y_proba", "t", 1)
    before = sorted(r["y_proba"] for r in scored.collect())
    after = {r["row_key"]: r["y_proba"] for r in moved.collect()}
    assert sorted(after.values()) == before
    assert any(after[r["row_key"]] != r["y_proba"] for r in scored.collect())


def test_mutual_information_of_known_tables(spark):
    df = spark.createDataFrame([(float(i % 2), float(i % 3), i % 2) for i in range(600)], "a double, b double, y int")
    mi = {r["feature"]: r["mi"] for r in screen.mutual_information(df, ["a", "b"], "y").collect()}
    assert mi["a"] == pytest.approx(math.log(2)) and mi["b"] == pytest.approx(0.0, abs=1e-9)
    link = {r["feature"]: r for r in screen.linkage(df, ["a", "b"], ["y"]).collect()}
    assert link["a"]["combined"] == pytest.approx(0.7 * math.log(2) + 0.3)


def test_mann_whitney(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (2.0, 1), (3.0, 1)], "f double, y int")
    row = screen.with_p_value(screen.univariate_tests(df, ["f"], "y")).first()
    # ranks 1, 2.5, 2.5, 4: U of class 0 is 0.5; sigma^2 = 4/12 * (5 - 6/12)
    assert row["u"] == 0.5 and row["auc"] == pytest.approx(0.875)
    assert row["z"] == pytest.approx((1.5 - 0.5) / math.sqrt(1.5))
    assert row["p_value"] == pytest.approx(math.erfc(row["z"] / math.sqrt(2)))


def test_isotonic_is_monotone_and_platt_keeps_order(scored):
    for method in ("isotonic", "sigmoid"):
        done = calibrate(scored, method).apply(scored).select("y_proba", "calibrated").distinct().orderBy("y_proba").collect()
        values = [r["calibrated"] for r in done]
        assert all(0 <= v <= 1 for v in values) and all(b >= a - 1e-12 for a, b in zip(values, values[1:]))


@pytest.fixture(scope="module")
def learned(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 2))
    y = (x[:, 0] + 0.3 * rng.normal(size=300) > 0).astype(int)
    df = spark.createDataFrame([(i, float(a), float(b), int(t)) for i, ((a, b), t) in enumerate(zip(x, y))], "row_key long, f1 double, f2 double, y_true int").cache()
    spec = Spec("logistic_regression", ("f1", "f2"), params={"maxIter": 20})
    return df, spec, fit_model(df, spec)


def test_learned_model_and_attributions(learned):
    df, spec, scorer = learned
    assert evaluate.roc_auc(scorer.score(df)).first()["roc_auc"] > 0.9
    contributions = explain.sampled_attributions(df, scorer, permutations=2).groupBy("row_key").agg(F.sum("contribution").alias("s"))
    means = df.agg(F.avg("f1").alias("f1"), F.avg("f2").alias("f2"))
    base = scorer.score(means).first()["y_proba"]
    both = contributions.join(scorer.score(df), "row_key").collect()
    assert all(r["s"] == pytest.approx(r["y_proba"] - base, abs=1e-9) for r in both)
    perm = {r["feature"]: r["importance"] for r in explain.permutation_importance(df, scorer, 2).collect()}
    assert perm["f1"] > 0.2 > abs(perm["f2"])
    out = score_batch(df.drop("f2"), scorer, 0.5, spec.features, ["row_key"]).first()
    assert out["warnings"] == "model_not_calibrated" and out["risk_level"] in {"low", "moderate", "elevated", "high"}


def test_calibration_falls_back(learned):
    df, spec, _ = learned
    assert fit_calibrated(df, spec, 2).method == "sigmoid"
    poor = fit_calibrated(df, spec, 2, methods=["nonsense"])
    assert poor.method is None and "model_not_calibrated" in poor.warnings


def brute_lof(x, k):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1, kind="stable")[:, :k]
    kd = np.take_along_axis(d, near, 1)[:, -1]
    reach = np.maximum(np.take_along_axis(d, near, 1), kd[near])
    lrd = 1 / (reach.mean(1) + 1e-10)
    return lrd[near].mean(1) / lrd


def test_lof_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(unsup, "BLOCK_ROWS", 40)
    x = np.random.default_rng(1).normal(size=(200, 3))
    x[0] = [8, 8, 8]
    df = unsup.embedding_vectors(spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, e array<double>"), "e")
    got = {r["id"]: r["lof"] for r in unsup.local_outlier_factor(df, "id", 7, scale=False).collect()}
    want = brute_lof(x, 7)
    assert [got[i] for i in range(200)] == pytest.approx(want.tolist(), rel=1e-6)
    assert max(got, key=got.get) == 0


def test_neighbours_of_copies(spark):
    x = [[0.0, 0.0]] * 30 + [[float(i), 1.0] for i in range(1, 31)]
    df = unsup.embedding_vectors(spark.createDataFrame(list(enumerate(x)), "id long, e array<double>"), "e")
    near = unsup.nearest_neighbours(df, "id", 5).collect()
    assert all(sum(r["w"] for r in near if r["q"] == q) == 5 for q in {r["q"] for r in near})
    assert [(r["o"], r["dist"]) for r in near if r["q"] == 0] == [(0, 0.0)]
    assert unsup.local_outlier_factor(df, "id", 5).count() == 60


def test_isolation_forest_finds_the_far_row(spark):
    x = np.random.default_rng(2).normal(size=(300, 2))
    x[7] = [25, 25]
    df = unsup.embedding_vectors(spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, e array<double>"), "e")
    out = unsup.isolation_forest(df, "id", trees=20, contamination=0.05).collect()
    assert max(out, key=lambda r: r["score"])["id"] == 7
    assert sum(r["es_anomalia"] for r in out) == 15


def test_flags_are_worked_out_once_for_all_runs_of_kmeans(spark):
    made = spark.sparkContext.accumulator(0)

    def flag(i):
        made.add(1)
        return i % 2

    rows = spark.range(60).select(F.col("id").alias("k"), F.udf(flag, "int")("id").alias("a"), F.expr("int(id % 3 = 0)").alias("b"), F.expr("int(id % 5 = 0)").alias("y"))
    pre = spark.range(60).selectExpr("id AS k", "double(id) AS age")
    out = unsup.kmeans_profile(rows, ["a", "b"], "y", pre, "k", ["age"], k=2, seeds=range(6)).collect()
    assert sum(r["size"] for r in out) == 60 and made.value <= 120


def test_blocks_of_neighbours_reach_a_task_one_by_one(spark, monkeypatch):
    for name in ("BLOCK_ROWS", "CELLS", "ASKED"):
        monkeypatch.setattr(unsup, name, 16)
    x = np.random.default_rng(3).normal(size=(120, 3))
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(120)], "id long, e array<double>")
    near = unsup.nearest_neighbours(unsup.embedding_vectors(df, "e"), "id", 4, cells=4)
    plan = near._jdf.queryExecution().toString()
    assert "FlatMapGroupsInPandas" in plan
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    got = {}
    for r in near.collect():
        got.setdefault(r.q, []).append(r.dist)
    assert all(np.allclose(sorted(got[i]), np.sort(d[i])[:4]) for i in range(120))


def test_queries_are_sent_once_for_a_group_of_blocks(spark, monkeypatch):
    x = np.random.default_rng(4).normal(size=(300, 4))
    x[200:] = x[:100]  # copies
    df = unsup.embedding_vectors(spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, e array<double>"), "e")
    monkeypatch.setattr(unsup, "BLOCK_ROWS", 20)
    d = np.sqrt(((x[:200, None] - x[None, :200]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    for name, size in (("GROUP_BYTES", 128 << 20), ("GROUP_BYTES", 2000), ("QUERY_BYTES", 1500)):
        monkeypatch.setattr(unsup, name, size)
        near = unsup.nearest_neighbours(df, "id", 6, cells=5).collect()
        for q in (0, 50, 150, 199):
            mine = sorted((r.dist, r.o, r.w) for r in near if r.q == q)
            want = sorted((0.0 if i == q else d[q, i], i, (2 if i < 100 else 1) - (i == q)) for i in range(200) if i != q or q < 100)
            assert sum(w for *_, w in mine) == 6 and all(a[1] == b[1] and np.isclose(a[0], b[0]) for a, b in zip(mine, want))
    # an answer for each point and group, not for each block that it reaches
    block = pa.table({"part": [0] * 9, "id": [*range(8), 3], "v": [[float(i), 0.0] for i in (*range(8), 3)], "bound": [0.0] * 8 + [np.inf], "w": [1] * 8 + [0], "number": [0, 0, 1, 1, 2, 2, 3, 3, -1]})
    search = unsup._searcher(np.zeros((1, 2)), np.zeros(4, int), np.full(4, 9.0), 3)
    got = [b.to_pydict() for b in search(iter(block.to_batches()))]
    assert len(got) == 1 and got[0]["o"] == [2, 4, 1] and got[0]["dist"] == [1.0, 1.0, 2.0]
