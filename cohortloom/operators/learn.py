"""Learners, calibration, threshold choice, tuning and batch scoring on Spark ML."""
from __future__ import annotations

import itertools
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.errors import ArithmeticException, IllegalArgumentException
from pyspark.ml import Model
from pyspark.ml.classification import (
    DecisionTreeClassifier, LogisticRegression, MultilayerPerceptronClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.numeric import col, to_number
from cohortloom.operators import boost, evaluate, forest, ordered, rank, sample
from cohortloom.operators.project import column_medians
from cohortloom.session import cut_lineage

FILL = -1.0
#: Rows from which a network's are dealt over all cores. Spark ML weighs its blocks of 128 rows alike, so the
#: partitions of a smaller table, with more open blocks among them, are left as they are.
SPREAD_ROWS = 100_000
#: Folds of a model of Spark ML that are fitted at once, each from rows of its own in memory.
FOLDS_AT_ONCE = 4
SCORE = evaluate.SCORE


# ---- presets ------------------------------------------------------------------------------
# Family, default parameters and first choice of calibration of each model.
# Forests grow in operators/forest.py, boosted trees in operators/boost.py; depth 0 is open.
PRESETS: dict[str, dict] = {
    "logistic_regression": {"family": "logistic", "params": {"C": 1.0, "maxIter": 300}, "calibration": "sigmoid"},
    "decision_tree": {"family": "tree", "params": {"maxDepth": 5, "minInstancesPerNode": 50}, "calibration": "isotonic"},
    "random_forest": {"family": "forest", "params": {"numTrees": 300, "maxDepth": 0}, "calibration": "isotonic"},
    "extra_trees": {
        "family": "forest", "params": {"numTrees": 300, "maxDepth": 0, "bootstrap": False, "randomSplits": True},
        "calibration": "isotonic",
    },
    "xgboost": {
        "family": "boosted",
        "params": {"maxIter": 300, "stepSize": 0.05, "maxDepth": 6, "l2": 1.0, "minHessian": 1.0, "rowShare": 0.8, "featureShare": 0.8},
        "calibration": "isotonic",
    },
    "hist_gradient_boosting": {
        "family": "boosted", "params": {"maxIter": 300, "stepSize": 0.05, "maxDepth": 0, "maxLeaves": 31, "minRows": 20},
        "calibration": "isotonic",
    },
    "lightgbm": {
        "family": "boosted", "params": {"maxIter": 300, "stepSize": 0.05, "maxDepth": 0, "maxLeaves": 31, "minRows": 20, "minHessian": 1e-3},
        "calibration": "isotonic",
    },
    "gradient_boosting": {
        "family": "boosted", "params": {"maxIter": 100, "stepSize": 0.1, "maxDepth": 3, "newtonSplits": False},
        "calibration": "isotonic",
    },
    "mlp": {"family": "mlp", "params": {"hidden": [128, 64], "maxIter": 200}, "calibration": "sigmoid"},
}
STACK_BASE = VOTING_BASE = ("random_forest", "xgboost", "hist_gradient_boosting")
# Search spaces.
SEARCH_SPACES: dict[str, dict[str, list]] = {
    "logistic_regression": {"C": [0.01, 0.1, 1.0, 10.0, 100.0]},
    "random_forest": {"numTrees": [100, 200, 300, 500], "maxDepth": [0, 5, 10, 20]},
    "xgboost": {"maxIter": [100, 300, 500], "stepSize": [0.01, 0.05, 0.1], "maxDepth": [4, 6, 8]},
    "hist_gradient_boosting": {"maxIter": [100, 200, 300], "stepSize": [0.01, 0.05, 0.1]},
}


@dataclass(frozen=True)
class Spec:
    """A model to fit: preset name, feature columns, label, row key, seed, changed parameters."""

    name: str
    features: tuple[str, ...]
    label: str = "y_true"
    key: str = "row_key"
    seed: int = 42
    params: Mapping[str, object] = field(default_factory=dict)

    @property
    def settings(self) -> dict:
        return {**PRESETS[self.name]["params"], **self.params}


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Feature vector of the columns as numbers, missing ones as -1."""
    numbers = {f"_f{i}": F.coalesce(to_number(f), F.lit(FILL)) for i, f in enumerate(features)}
    out = VectorAssembler(inputCols=list(numbers), outputCol="features").transform(df.withColumns(numbers))
    return out.drop(*numbers)


def estimator(spec: Spec, n_rows: int):
    p = dict(spec.settings)
    family = PRESETS[spec.name]["family"]
    common = {"labelCol": spec.label, "featuresCol": "features"}
    if family == "logistic":
        strength = 1.0 / (p.pop("C") * max(n_rows, 1))
        return LogisticRegression(weightCol="weight", regParam=strength, **common, **p)
    if family == "tree":
        return DecisionTreeClassifier(weightCol="weight", seed=spec.seed, **common, **p)
    layers = [len(spec.features), *p.pop("hidden"), 2]
    return MultilayerPerceptronClassifier(layers=layers, seed=spec.seed, **common, **p)


def forest_settings(spec: Spec) -> forest.Settings:
    p = spec.settings
    return forest.Settings(
        trees=p["numTrees"], depth=p["maxDepth"], min_leaf=p.get("minInstancesPerNode", 1), bootstrap=p.get("bootstrap", True),
        random_splits=p.get("randomSplits", False), seed=spec.seed,
    )


def boost_settings(spec: Spec) -> boost.Settings:
    p = spec.settings
    return boost.Settings(
        rounds=p["maxIter"], rate=p["stepSize"], depth=p["maxDepth"], leaves=p.get("maxLeaves", 0), l2=p.get("l2", 0.0),
        min_rows=p.get("minRows", 1), min_hessian=p.get("minHessian", 0.0), row_share=p.get("rowShare", 1.0),
        feature_share=p.get("featureShare", 1.0), newton_splits=p.get("newtonSplits", True), seed=spec.seed,
    )


def feature_values(features: Sequence[str]) -> Column:
    """The columns as numbers in one array, missing ones as -1."""
    return F.array(*[F.coalesce(to_number(f), F.lit(FILL)).cast("double") for f in features])


def tree_rows(df: DataFrame, spec: Spec) -> DataFrame:
    """row, y, w and x of the rows with a label, balanced by weight; rows without key are told apart by
    their values."""
    label = col(spec.label).cast("double")
    known = sample.with_class_weight(df.withColumn(spec.label, label).where(label.isNotNull()), spec.label)
    key = F.xxhash64(col(spec.key)) if spec.key in df.columns else F.xxhash64(*[col(f) for f in spec.features])
    return known.select(key.alias("row"), col(spec.label).alias("y"), F.col("weight").alias("w"), feature_values(spec.features).alias("x"))


def _is_forest(spec: Spec) -> bool:
    return PRESETS[spec.name]["family"] == "forest"


def _is_boosted(spec: Spec) -> bool:
    return PRESETS[spec.name]["family"] == "boosted"


def _is_tree(spec: Spec) -> bool:
    """Whether it grows in operators/forest.py or operators/boost.py."""
    return _is_forest(spec) or _is_boosted(spec)


def _is_network(spec: Spec) -> bool:
    return PRESETS[spec.name]["family"] == "mlp"


def training_rows(df: DataFrame, spec: Spec) -> DataFrame:
    """Feature vectors with balanced weights; models without weights get balanced rows instead."""
    label = col(spec.label).cast("double")
    rows = assemble(df, spec.features).withColumn(spec.label, label).where(label.isNotNull())
    if _is_network(spec):
        return sample.undersample_balance(rows, spec.key, spec.label, spec.seed)
    return sample.with_class_weight(rows, spec.label)


@dataclass
class Scorer:
    """Anything that adds a probability column."""

    spec: Spec
    model: Model | forest.ForestModel | boost.BoostedModel
    calibrators: tuple = ()
    method: str | None = None
    warnings: tuple[str, ...] = ()

    def score(self, df: DataFrame, out: str = SCORE) -> DataFrame:
        if isinstance(self.model, (forest.ForestModel, boost.BoostedModel)):
            return self.model.add_score(df.withColumn("_x", feature_values(self.spec.features)), "_x", out).drop("_x")
        scored = self.model.transform(assemble(df, self.spec.features))
        return scored.withColumn(out, vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def fit_model(df: DataFrame, spec: Spec) -> Scorer:
    """The learner passes over its rows many times, so they are kept while it runs."""
    if _is_tree(spec):
        kept = tree_rows(df, spec).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return Scorer(spec, forest.fit(kept, forest_settings(spec)) if _is_forest(spec) else boost.fit(kept, boost_settings(spec)))
        finally:
            kept.unpersist()
    rows = training_rows(df, spec).select("features", spec.label, *([] if _is_network(spec) else ["weight"]))
    if _is_network(spec) and rows.count() > SPREAD_ROWS:
        rows = forest.spread(rows)  # hundreds of passes: all cores take part, however few files hold the rows
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = rows.count() if PRESETS[spec.name]["family"] == "logistic" else 0
        return Scorer(spec, estimator(spec, n).fit(rows))
    finally:
        rows.unpersist()


def fit_models(df: DataFrame, specs: Sequence[Spec]) -> list[Scorer]:
    """A scorer for each spec over the same rows; boosted models that share their rows grow side by side, and
    beside them the others one by one, for a boosted model alone leaves most cores idle."""
    alike: dict[tuple, list[int]] = {}
    for i, spec in enumerate(specs):
        if _is_boosted(spec):
            alike.setdefault((spec.features, spec.label, spec.key), []).append(i)

    def boosted(own: list[int]) -> dict[int, Scorer]:
        kept = tree_rows(df, specs[own[0]]).withColumn("models", F.array(*map(F.lit, own))).persist(StorageLevel.MEMORY_AND_DISK)
        found = boost.fit_many(kept, {i: boost_settings(specs[i]) for i in own})
        kept.unpersist()
        return {i: Scorer(specs[i], found[i]) for i in own}

    def others() -> dict[int, Scorer]:
        return {i: fit_model(df, spec) for i, spec in enumerate(specs) if not _is_boosted(spec)}

    work = [lambda own=own: boosted(own) for own in alike.values()]
    out = {i: m for found in side_by_side([*work, others], len(work) + 1) for i, m in found.items()}
    return [out[i] for i in range(len(specs))]


def folded_rows(df: DataFrame, spec: Spec, folds: int, features: Sequence[str] | None = None) -> DataFrame:
    """Key, label, features and fold, written once for the fits that read them again."""
    narrow = df.select(*[col(c) for c in dict.fromkeys([spec.key, spec.label, *(features or spec.features)])])
    return cut_lineage(sample.kfold_stratified(narrow, spec.key, spec.label, folds, spec.seed))


def fit_folds(folded: DataFrame, specs: Sequence[Spec], folds: int) -> list[list[Scorer]]:
    """For each spec a scorer per fold, fitted on the rows of the other folds. Boosted models that share
    features and label grow side by side; so do the forests of all folds, and forests that differ in the
    number of trees or the depth alone are parts of one."""
    out: dict[int, list[Scorer]] = {}
    boosted: dict[tuple, list[int]] = {}
    forests: dict[tuple, list[int]] = {}
    for i, spec in enumerate(specs):
        if _is_boosted(spec):
            boosted.setdefault((spec.features, spec.label, spec.key), []).append(i)
        elif _is_forest(spec):
            same = replace(forest_settings(spec), trees=0, depth=0)
            forests.setdefault((spec.features, spec.label, spec.key, same), []).append(i)
        else:
            out[i] = side_by_side([lambda f=f, spec=spec: fit_model(folded.where(F.col("fold") != f), spec) for f in range(folds)], FOLDS_AT_ONCE)

    def kept(spec: Spec, more: Callable[[int], dict[str, Column]]) -> DataFrame:
        blocks = [tree_rows(folded.where(F.col("fold") != f), spec).withColumns(more(f)) for f in range(folds)]
        return reduce(DataFrame.unionByName, blocks).persist(StorageLevel.MEMORY_AND_DISK)

    for own in boosted.values():
        rows = kept(specs[own[0]], lambda f, n=len(own): {"models": F.array(*[F.lit(j * folds + f) for j in range(n)])})
        found = boost.fit_many(rows, {j * folds + f: boost_settings(specs[i]) for j, i in enumerate(own) for f in range(folds)})
        rows.unpersist()
        out |= {i: [Scorer(specs[i], found[j * folds + f]) for f in range(folds)] for j, i in enumerate(own)}
    for own in forests.values():
        settings = [forest_settings(specs[i]) for i in own]
        depth = 0 if any(s.depth == 0 for s in settings) else max(s.depth for s in settings)
        rows = kept(specs[own[0]], lambda f: {"model": F.lit(f)})
        grown = forest.fit_many(rows, replace(settings[0], trees=max(s.trees for s in settings), depth=depth), folds)
        rows.unpersist()
        out |= {i: [Scorer(specs[i], m.limited(s.trees, s.depth)) for m in grown] for i, s in zip(own, settings)}
    return [out[i] for i in range(len(specs))]


# ---- calibration --------------------------------------------------------------------------
def _score_vector(df: DataFrame, score: str) -> DataFrame:
    return VectorAssembler(inputCols=[score], outputCol="_s").transform(df)


@dataclass
class Calibrator:
    method: str
    model: Model

    def apply(self, df: DataFrame, score: str = SCORE, out: str = "calibrated") -> DataFrame:
        if self.method == "sigmoid":
            done = self.model.transform(_score_vector(df, score))
            return done.withColumn(out, vector_to_array("_p")[1]).drop("_s", "_r", "_p", "_c")
        done = self.model.transform(_score_vector(df, score))
        return done.withColumn(out, F.least(F.greatest("_iso", F.lit(0.0)), F.lit(1.0))).drop("_s", "_iso")


POOLED = "bucket int, lo double, hi double, n long, pos long"
#: Neighbouring buckets that a task merges.
FAN = 32


def _pool(group: pa.Table) -> pa.Table:
    """Blocks in score order, neighbours merged until their shares of positives rise. Counts stay whole
    numbers, so the comparison is exact."""
    group = group.sort_by("lo")
    lo, hi, n, pos = ([] for _ in range(4))
    for a, b, m, p in zip(*(group[c].to_pylist() for c in ("lo", "hi", "n", "pos"))):
        while n and pos[-1] * m >= p * n[-1]:
            a, m, p = lo.pop(), m + n.pop(), p + pos.pop()
            hi.pop()
        for out, v in zip((lo, hi, n, pos), (a, b, m, p)):
            out.append(v)
    kinds = [pa.int32(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
    arrays = [pa.array(v, k) for v, k in zip(([group["bucket"][0].as_py()] * len(lo), lo, hi, n, pos), kinds)]
    return pa.table(arrays, names=["bucket", "lo", "hi", "n", "pos"])


def pooled_blocks(hist: DataFrame, score: str) -> DataFrame:
    """(lo, hi, n, pos) of the monotone steps of a score histogram (score, pos, neg).

    Tasks pool the scores of a bucket, then the blocks of FAN neighbouring buckets, until one bucket is
    left. Shares of whole counts that rise strictly are at most about N^(2/3) for N rows, so the blocks that
    meet in the last task, and the steps of the model, are far fewer than the scores.
    """
    buckets = ordered.bucket_count(hist.sparkSession)
    cut = ordered.with_bucket(hist.withColumn(score, F.col(score).cast("double")), score, [], buckets)
    n, pos = (F.col("pos") + F.col("neg")).cast("long"), F.col("pos").cast("long")
    blocks = cut.select(F.col("_bucket").alias("bucket"), F.col(score).alias("lo"), F.col(score).alias("hi"), n.alias("n"), pos.alias("pos"))
    while True:
        blocks = blocks.groupBy("bucket").applyInArrow(_pool, POOLED)
        if buckets == 1:
            return blocks.drop("bucket")
        buckets = -(-buckets // FAN)
        blocks = blocks.withColumn("bucket", F.floor(F.col("bucket") / FAN).cast("int"))


def calibrate(df: DataFrame, method: str, score: str = SCORE, label: str = "y_true") -> Calibrator:
    """Fit a calibrator on the score histogram, so its input is one row per distinct score.

    sigmoid: logistic curve on targets smoothed by the class counts; isotonic: monotone steps.
    """
    hist = evaluate.score_histogram(df, score=score, label=label)
    if method == "isotonic":
        # both ends of each step, which the fit leaves as they are
        ends = F.explode(F.array("lo", "hi")).alias(score)
        rows = pooled_blocks(hist, score).select(ends, (F.col("pos") / F.col("n")).alias("_y"), (F.col("n") / 2).alias("_w"))
        iso = IsotonicRegression(featuresCol="_s", labelCol="_y", weightCol="_w", predictionCol="_iso")
        return Calibrator(method, iso.fit(_score_vector(rows, score)))
    if method != "sigmoid":
        raise ValueError(f"unknown calibration {method!r}")
    totals = hist.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n")).alias("t")).scalar()
    high = (totals["p"] + 1) / (totals["p"] + 2)
    low = F.lit(1.0) / (totals["n"] + 2)
    ones = F.col("pos") * high + F.col("neg") * low
    zeros = F.col("pos") * (1 - high) + F.col("neg") * (1 - low)
    pair = F.array(F.struct(F.lit(1.0).alias("_y"), ones.alias("_w")), F.struct(F.lit(0.0).alias("_y"), zeros.alias("_w")))
    rows = hist.select(score, F.explode(pair).alias("x")).select(score, "x.*")
    lr = LogisticRegression(
        featuresCol="_s", labelCol="_y", weightCol="_w", probabilityCol="_p", rawPredictionCol="_r", predictionCol="_c",
        regParam=0.0, standardization=False, maxIter=200,
    )
    return Calibrator(method, lr.fit(_score_vector(rows, score)))


@dataclass
class CalibratedScorer:
    """Mean of fold models, each calibrated on the rows it did not see."""

    spec: Spec
    parts: list[tuple[Scorer, Calibrator | None]]
    method: str | None
    warnings: tuple[str, ...] = ()

    @property
    def calibrated(self) -> bool:
        return self.method is not None

    def score(self, df: DataFrame, out: str = SCORE) -> DataFrame:
        names = []
        for i, (scorer, calibrator) in enumerate(self.parts):
            df = scorer.score(df, f"_s{i}")
            if calibrator is not None:
                df = calibrator.apply(df, f"_s{i}", f"_c{i}").drop(f"_s{i}").withColumnRenamed(f"_c{i}", f"_s{i}")
            names.append(f"_s{i}")
        mean = sum((F.col(n) for n in names[1:]), F.col(names[0])) / len(names)
        return df.withColumn(out, mean).drop(*names)


def fit_calibrated(df: DataFrame, spec: Spec, folds: int = 5, methods: Sequence[str] | None = None) -> CalibratedScorer:
    """Cross-fitted calibration: first choice of the preset, then the other, then uncalibrated."""
    first = PRESETS[spec.name]["calibration"]
    order = list(methods or [first, "sigmoid" if first == "isotonic" else "isotonic"])
    folded = folded_rows(df, spec, folds)
    warnings: list[str] = []
    scorers = fit_folds(folded, [spec], folds)[0]
    for method in order:
        try:
            parts = [
                (s, calibrate(s.score(folded.where(F.col("fold") == f)), method, label=spec.label))
                for f, s in enumerate(scorers)
            ]
            return CalibratedScorer(spec, parts, method, tuple(warnings))
        except (IllegalArgumentException, ArithmeticException, ArithmeticError, ValueError) as exc:  # not the failures of a cluster
            warnings.append(f"calibration_{method}_failed: {type(exc).__name__}")
    return CalibratedScorer(spec, [(fit_model(df, spec), None)], None, (*warnings, "model_not_calibrated"))


# ---- ensembles ----------------------------------------------------------------------------
def _scores_of(scorers: Mapping[str, Scorer], df: DataFrame) -> DataFrame:
    return reduce(lambda acc, kv: kv[1].score(acc, f"score_{kv[0]}"), scorers.items(), df)


@dataclass
class Ensemble:
    base: dict[str, Scorer]
    meta: Scorer | None = None
    method: str | None = None
    warnings: tuple[str, ...] = ()

    def score(self, df: DataFrame, out: str = SCORE) -> DataFrame:
        names = [f"score_{n}" for n in self.base]
        scored = _scores_of(self.base, df)
        if self.meta is not None:
            return self.meta.score(scored, out).drop(*names)
        return scored.withColumn(out, sum((F.col(n) for n in names[1:]), F.col(names[0])) / len(names)).drop(*names)


def fit_voting(df: DataFrame, specs: Sequence[Spec]) -> Ensemble:
    """Mean of the base probabilities."""
    return Ensemble({s.spec.name: s for s in fit_models(df, specs)})


def fit_stacking(df: DataFrame, specs: Sequence[Spec], folds: int = 5) -> Ensemble:
    """Out-of-fold base scores feed a logistic model; the base models are refitted on all rows."""
    first = specs[0]
    folded = folded_rows(df, first, folds, [f for s in specs for f in s.features])
    blocks, scorers = [], fit_folds(folded, specs, folds)
    for f in range(folds):
        held = _scores_of({s.name: of[f] for s, of in zip(specs, scorers)}, folded.where(F.col("fold") == f))
        blocks.append(held.select(first.key, first.label, *[f"score_{s.name}" for s in specs]))
    out_of_fold = cut_lineage(reduce(DataFrame.unionByName, blocks))
    meta = Spec("logistic_regression", tuple(f"score_{s.name}" for s in specs), first.label, first.key, first.seed)
    return Ensemble({s.spec.name: s for s in fit_models(df, specs)}, fit_model(out_of_fold, meta))


# ---- training with a threshold ------------------------------------------------------------
def train_with_threshold(
    df: DataFrame, spec: Spec, val_size: float = 0.2, recall_min: float = 0.85, folds: int = 5
) -> tuple[CalibratedScorer, DataFrame]:
    """Threshold and metrics from an inner validation part, final model refitted on all rows.

    Returns the final model and a one-row metrics table with split = 'validation'.
    """
    split = cut_lineage(sample.split_stratified(df, spec.key, spec.label, val_size, spec.seed))
    inner = fit_calibrated(split.where("split = 'train'").drop("split"), spec, folds)
    scored = cut_lineage(inner.score(split.where("split = 'test'").drop("split")).select(spec.label, SCORE))
    best = evaluate.find_threshold(scored, label=spec.label, optimize_for="recall_constraint", recall_min=recall_min)
    threshold = best.first()["threshold"]
    metrics = evaluate.classification_metrics(scored, threshold, label=spec.label).withColumns(
        {"model": F.lit(spec.name), "split": F.lit("validation"), "calibration": F.lit(inner.method)}
    )
    return fit_calibrated(df, spec, folds), metrics


def cv_evaluate(df: DataFrame, spec: Spec, folds: int = 10, recall_min: float = 0.85, fixed_threshold: float | None = None) -> DataFrame:
    """(fold, metrics): each fold is scored by a model of the others.

    The threshold of a fold is chosen on the fold it is measured on, which flatters it a
    little; give fixed_threshold to avoid that.
    """
    folded = folded_rows(df, spec, folds)
    scorers = fit_folds(folded, [spec], folds)[0]
    parts = [s.score(folded.where(F.col("fold") == f)).select("fold", spec.label, SCORE) for f, s in enumerate(scorers)]
    # read twice below: for the thresholds and for the metrics
    scored = cut_lineage(reduce(DataFrame.unionByName, parts))
    if fixed_threshold is not None:
        return evaluate.classification_metrics(scored, fixed_threshold, ["fold"], label=spec.label)
    best = evaluate.find_threshold(
        scored, ["fold"], label=spec.label, optimize_for="recall_constraint", recall_min=recall_min
    ).select("fold", "threshold").collect()
    chosen = F.create_map(*[x for r in best for x in (F.lit(r["fold"]), F.lit(r["threshold"]))])
    with_t = scored.withColumn("_t", chosen[F.col("fold")])
    # one threshold per fold, so (fold, threshold) groups the rows as fold does
    out = evaluate.classification_metrics(with_t, F.col("_t"), ["fold", "_t"], label=spec.label)
    return out.drop("_t")


CV_METRICS = ["ROC_AUC", "F2", "Recall", "Precision", "Specificity", "Balanced_Accuracy"]


def cv_summary(folds: DataFrame) -> DataFrame:
    """Mean and population deviation of the fold metrics."""
    return folds.agg(
        *[F.avg(m).alias(f"{m}_mean") for m in CV_METRICS], *[F.stddev_pop(m).alias(f"{m}_std") for m in CV_METRICS]
    )


# ---- tuning -------------------------------------------------------------------------------
def random_grid(space: Mapping[str, Sequence], n: int, seed: int) -> list[dict]:
    """n settings drawn without repeats from the product of the space."""
    every = [dict(zip(space, values)) for values in itertools.product(*space.values())]
    return random.Random(seed).sample(every, min(n, len(every)))


def hyperparameter_search(
    df: DataFrame, spec: Spec, space: Mapping[str, Sequence] | None = None, n: int = 10, folds: int = 10,
    parallelism: int = 4,
) -> list[dict]:
    """Settings with their mean cross-validated F2, best first."""
    if _is_tree(spec):
        return search_trees(df, [spec], space, n, folds)[0]
    rows = training_rows(folded_rows(df, spec, folds), spec).persist(StorageLevel.MEMORY_AND_DISK)
    total = rows.count()
    base = estimator(spec, total)
    grid, shown = [], random_grid(space or SEARCH_SPACES.get(spec.name, {}), n, spec.seed)
    for setting in shown:
        values = {k: v for k, v in setting.items() if k != "C"}
        if "C" in setting:
            values["regParam"] = 1.0 / (setting["C"] * total)
        grid.append({base.getParam(k): v for k, v in values.items()})
    f2 = MulticlassClassificationEvaluator(labelCol=spec.label, metricName="fMeasureByLabel", metricLabel=1.0, beta=2.0)
    search = CrossValidator(
        estimator=base, estimatorParamMaps=grid, evaluator=f2, numFolds=folds, foldCol="fold", parallelism=parallelism
    ).fit(rows)
    rows.unpersist()
    ranked = sorted(zip(shown, search.avgMetrics), key=lambda x: -x[1])
    return [{"params": s, "f2": m} for s, m in ranked]


def search_trees(
    df: DataFrame, specs: Sequence[Spec], space: Mapping[str, Sequence] | None = None, n: int = 10, folds: int = 10
) -> list[list[dict]]:
    """hyperparameter_search() of forests and boosted models of one key, label and seed: they share their
    folds, grow together, and the held-out rows of all are scored and counted in one job."""
    first = specs[0]
    if {(s.key, s.label, s.seed) for s in specs} != {(first.key, first.label, first.seed)}:
        raise ValueError("searches side by side need one key, label and seed")
    folded = folded_rows(df, first, folds, [f for s in specs for f in s.features])
    tried = [(i, s) for i, spec in enumerate(specs) for s in random_grid(space or SEARCH_SPACES.get(spec.name, {}), n, spec.seed)]
    scorers = fit_folds(folded, [replace(specs[i], params={**specs[i].params, **s}) for i, s in tried], folds)
    held = [
        s.score(folded.where(F.col("fold") == f)).select(F.lit(k).alias("setting"), "fold", first.label, SCORE)
        for k, of in enumerate(scorers) for f, s in enumerate(of)
    ]
    metrics = evaluate.classification_metrics(reduce(DataFrame.unionByName, held), 0.5, ["setting", "fold"], label=first.label)
    f2 = {r.setting: r.f2 for r in metrics.groupBy("setting").agg(F.avg("F2").alias("f2")).collect()}
    out: list[list[dict]] = [[] for _ in specs]
    for k, (i, s) in enumerate(tried):
        out[i].append({"params": s, "f2": f2.get(k) or 0.0})
    return [sorted(of, key=lambda x: -x["f2"]) for of in out]


def side_by_side(work: Sequence[Callable], parallelism: int) -> list:
    """Results of functions that each run Spark jobs of their own; the cluster shares them out."""
    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(lambda f: f(), work))


def _test_row(val: DataFrame, test: DataFrame, scorer: Scorer, recall_min: float) -> DataFrame:
    spec = scorer.spec
    best = evaluate.find_threshold(
        scorer.score(val), label=spec.label, optimize_for="recall_constraint", recall_min=recall_min
    ).first()["threshold"]
    return evaluate.classification_metrics(scorer.score(test), best, label=spec.label)


def baseline_experiments(
    frames: Mapping[str, DataFrame], specs: Sequence[Spec], recall_min: float = 0.85, parallelism: int = 4
) -> DataFrame:
    """(version, model, test metrics): threshold from validation rows, metrics from test rows. Versions run
    side by side; their splits are written once for all models."""

    def of_version(version: str, df: DataFrame) -> list[DataFrame]:
        splits: dict[tuple, list[Spec]] = {}
        for spec in specs:
            splits.setdefault((spec.key, spec.label, spec.seed), []).append(spec)
        out = {}
        for (key, label, seed), own in splits.items():
            split = cut_lineage(sample.split_three_way(df, key, label, seed=seed))
            train, val, test = (split.where(F.col("split") == s).drop("split") for s in ("train", "val", "test"))
            for scorer in fit_models(train, own):
                row = _test_row(val, test, scorer, recall_min)
                out[scorer.spec.name] = row.select(
                    F.lit(version).alias("version"), F.lit(scorer.spec.name).alias("model"), F.lit("test").alias("split"), *evaluate.METRICS
                )
        return [out[s.name] for s in specs]

    parts = side_by_side([lambda v=v, df=df: of_version(v, df) for v, df in frames.items()], parallelism)
    return reduce(DataFrame.unionByName, [row for part in parts for row in part])


def tuning_experiments(
    frames: Mapping[str, DataFrame], specs: Sequence[Spec], fractions: Sequence[float],
    space: Mapping[str, Sequence] | None = None, n: int = 3, folds: int = 3, parallelism: int = 4,
) -> DataFrame:
    """(version, model, fraction, n_features, f2, params): search per share of the ranked features.

    Without a space each model has its own; one that has none is measured with its preset. The
    features of a spec are taken in the given (ranked) order.
    """

    def part(spec: Spec, share: float) -> Spec:
        return replace(spec, features=spec.features[: max(1, round(len(spec.features) * share))])

    def rows_of(version: str, share: float, spec: Spec, found: list[dict]) -> tuple:
        best = found[0]
        return (version, spec.name, float(share), len(spec.features), float(best["f2"]), str(sorted(best["params"].items())))

    def trees(version: str, df: DataFrame, own: list[Spec]) -> list[tuple]:
        parts = [(f, part(s, f)) for s in own for f in fractions]
        found = search_trees(df, [s for _, s in parts], space, n, folds)
        return [rows_of(version, f, s, of) for (f, s), of in zip(parts, found)]

    def other(version: str, df: DataFrame, spec: Spec, share: float) -> list[tuple]:
        s = part(spec, share)
        return [rows_of(version, share, s, hyperparameter_search(df, s, space, n, folds))]

    alike: dict[tuple, list[Spec]] = {}
    for s in specs:
        if _is_tree(s):
            alike.setdefault((s.key, s.label, s.seed), []).append(s)
    work: list[Callable] = [lambda v=v, df=df, own=own: trees(v, df, own) for v, df in frames.items() for own in alike.values()]
    work += [
        lambda v=v, df=df, s=s, f=f: other(v, df, s, f)
        for (v, df), s, f in itertools.product(frames.items(), specs, fractions) if not _is_tree(s)
    ]
    rows = [row for found in side_by_side(work, parallelism) for row in found]
    spark = next(iter(frames.values())).sparkSession
    return spark.createDataFrame(rows, "version string, model string, fraction double, n_features int, f2 double, params string")


def best_tuned(results: DataFrame) -> DataFrame:
    return rank.best_per_group(results, ["version"], [F.desc("f2"), F.asc("model"), F.asc("fraction")])


# ---- scoring ------------------------------------------------------------------------------
def feature_metadata(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(feature, dtype, median, imputation, fill, prevalence, n_total) of a training table."""
    kinds = dict(df.dtypes)
    medians = column_medians(df, features).select("feature", "median")
    dtypes = F.create_map(*[x for f in features for x in (F.lit(f), F.lit(kinds[f]))])
    stats = df.agg(F.struct(F.avg(col(target).cast("double")).alias("p"), F.count(F.lit(1)).alias("n")).alias("s")).scalar()
    return medians.select(
        "feature", F.element_at(dtypes, F.col("feature")).alias("dtype"), "median",
        F.lit("fill_constant").alias("imputation"), F.lit(FILL).alias("fill"), stats["p"].alias("prevalence"),
        stats["n"].alias("n_total"),
    )


def risk_band(score: Column | str, threshold: float) -> Column:
    s, t = col(score), F.lit(float(threshold))
    return (
        F.when(s >= t * 1.5, "high").when(s >= t, "elevated").when(s >= t * 0.5, "moderate").otherwise("low")
    )


def score_batch(df: DataFrame, scorer, threshold: float, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Probability, class, risk band and warnings; absent features count as missing."""
    present = set(df.columns)
    missing = {f: F.lit(None).cast("double") for f in features if f not in present}
    scored = scorer.score(df.withColumns(missing) if missing else df)
    calibrated = getattr(scorer, "method", None) is not None
    warnings = list(dict.fromkeys([*scorer.warnings, *([] if calibrated else ["model_not_calibrated"])]))
    return scored.select(
        *[col(k) for k in keep], SCORE, (F.col(SCORE) >= threshold).cast("int").alias("predicted_class"),
        F.lit(float(threshold)).alias("threshold"), risk_band(SCORE, threshold).alias("risk_level"),
        F.lit(calibrated).cast("int").alias("calibrated"), F.lit("; ".join(warnings)).alias("warnings"),
    )
