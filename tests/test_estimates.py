"""Neighbour information, histogram bootstrap and block permutation against plain versions."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.operators import evaluate, explain, learn, screen


def psi(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, n))


def plain_information(values, y, k=3):
    classes = {c: [v for v, d in zip(values, y) if d == c] for c in set(y)}
    used = [(v, c) for v, c in zip(values, y) if len(classes[c]) > 1]
    total = 0.0
    for v, c in used:
        own = classes[c]
        near = min(k, len(own) - 1)
        radius = sorted(abs(v - u) for u in own)[near]  # the row itself is at 0
        inside = max(0.0, radius - 1e-12 * (abs(v) + radius))
        m = sum(abs(v - u) <= inside for u, _ in used)
        if inside:
            total += psi(len(used)) + psi(near) - psi(len(own)) - psi(m)
        else:
            total += math.log(len(used) * own.count(v) / len(own) / m)
    return max(0.0, total / len(used)) if used else None


@pytest.mark.parametrize("window", [50_000, 7])
def test_information_equals_plain_neighbours(spark, monkeypatch, window):
    monkeypatch.setattr(screen, "WINDOW_VALUES", window)
    r = np.random.default_rng(3)
    y = (r.random(500) < 0.4).astype(int).tolist() + [2]  # a class of one row
    columns = {
        "smooth": (r.normal(size=501) + np.array(y)).round(9).tolist(),
        "noise": r.random(501).tolist(),
        "coarse": (r.integers(0, 40, 501) / 10 + np.array(y)).tolist(),
        "two": r.integers(0, 2, 501).astype(float).tolist(),
        "same": [1.0] * 501,
    }
    df = spark.createDataFrame([(*v, t) for *v, t in zip(*columns.values(), y)], ", ".join(f"{c} double" for c in columns) + ", y int")
    got = {x.feature: x.mi for x in screen.mutual_information(df, list(columns), "y").collect()}
    assert got == pytest.approx({c: plain_information(v, y) for c, v in columns.items()}, abs=1e-9)
    assert got["smooth"] > 0.05 > got["noise"]


def test_information_of_few_rows(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (4.0, 1), (5.5, 1), (None, None)], "a double, y int")
    got = screen.mutual_information(df, ["a"], "y").first().mi
    assert got == pytest.approx(plain_information([1.0, 2.0, 4.0, 5.5], [0, 0, 1, 1]), abs=1e-9)
    assert screen.mutual_information(df.limit(0), ["a"], "y").count() == 0


@pytest.mark.parametrize("levels", [None, 12])
def test_interval_agrees_with_plain_resamples(spark, levels):
    r = np.random.default_rng(5)
    y = (r.random(400) < 0.3).astype(int)
    s = np.clip(0.3 * y + r.random(400) * 0.7, 0, 1)
    s = s if levels is None else np.round(s * levels) / levels
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "y_proba double, y_true int")
    got = {x.metric: x for x in explain.bootstrap_ci(df, 0.5).collect()}
    aucs, recalls = [], []
    for _ in range(1000):
        at = r.integers(0, 400, 400)
        p, q = s[at][y[at] == 1], s[at][y[at] == 0]
        aucs.append(((p[:, None] > q).sum() + 0.5 * (p[:, None] == q).sum()) / (len(p) * len(q)))
        recalls.append((p >= 0.5).mean())
    for metric, plain in (("ROC_AUC", aucs), ("Recall", recalls)):
        low, high = np.quantile(plain, [0.025, 0.975])
        width = high - low
        assert abs(got[metric].ci_lower - low) < 0.2 * width and abs(got[metric].ci_upper - high) < 0.2 * width
        assert abs(got[metric].mean - np.mean(plain)) < 0.05 * width and got[metric].n_valid == 1000


def test_resampled_counts_are_poisson():
    for n in (1, 3, 60, 5000):
        got = explain._resampled(np.linspace(0, 1, 50), np.full(50, n), 1, 2000, 7)
        assert abs(got.mean() - n) < 6 * math.sqrt(n / got.size) and abs(got.var() / n - 1) < 0.05


class Sum:
    """Scores a row by the sum of its features."""

    def __init__(self, spec):
        self.spec = spec

    def score(self, df):
        return df.withColumn("y_proba", 2 * F.col("f1") + F.col("f2"))


@pytest.mark.parametrize("block_rows", [20_000, 100])
def test_permutation_equals_plain_drop(spark, block_rows):
    from cohortloom.operators.learn import Spec

    r = np.random.default_rng(8)
    x = r.normal(size=(900, 2))
    y = (2 * x[:, 0] + x[:, 1] + r.normal(size=900) > 0).astype(int)
    rows = [(i, *map(float, x[i]), int(y[i])) for i in range(900)]
    df = spark.createDataFrame(rows, "row_key long, f1 double, f2 double, y_true int")
    model = Sum(Spec("logistic_regression", ("f1", "f2")))

    def auc(s):
        p, q = s[y == 1], s[y == 0]
        return (p[:, None] > q).mean()

    found = explain.permutation_importance(df, model, 8, block_rows).collect()
    got = {v.feature: v.importance for v in found}
    for i, f in enumerate(("f1", "f2")):
        drops = []
        for _ in range(30):
            z = x.copy()
            z[:, i] = r.permutation(z[:, i])
            drops.append(auc(2 * x[:, 0] + x[:, 1]) - auc(2 * z[:, 0] + z[:, 1]))
        assert abs(got[f] - np.mean(drops)) < 0.02
    again = {v.feature: v.importance for v in explain.permutation_importance(df.repartition(5), model, 8, block_rows).collect()}
    assert again == pytest.approx(got)
    assert evaluate.roc_auc(model.score(df)).first().roc_auc == pytest.approx(auc(2 * x[:, 0] + x[:, 1]))


def plain_steps(scores, labels):
    """Calibrated value by score."""
    blocks = []
    for s in sorted(set(scores)):
        own = [y for v, y in zip(scores, labels) if v == s]
        blocks.append(([s], len(own), sum(own)))
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            (a, n, p), (b, m, q) = blocks[-2:]
            blocks[-2:] = [(a + b, n + m, p + q)]
    return {s: p / n for own, n, p in blocks for s in own}


@pytest.mark.parametrize("levels,falling", [(None, False), (15, False), (None, True)])
@pytest.mark.parametrize("fan", [32, 2])
def test_isotonic_equals_plain_pooling(spark, monkeypatch, levels, falling, fan):
    monkeypatch.setattr(learn, "FAN", fan)
    r = np.random.default_rng(6)
    s = r.random(700) if levels is None else np.round(r.random(700) * levels) / levels
    y = (r.random(700) < (1 - s if falling else s)).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "y_proba double, y_true int")
    got = {x.y_proba: x.calibrated for x in learn.calibrate(df, "isotonic").apply(df).collect()}
    assert got == pytest.approx(plain_steps(s.tolist(), y.tolist()))
