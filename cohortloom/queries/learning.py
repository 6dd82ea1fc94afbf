"""Learners, calibration, tuning, scoring and model explanation.

Models, folds, versions and trials have their full settings.
"""
from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom import fixtures as fx
from cohortloom.functions.numeric import col, round_half_up as r6
from cohortloom.operators import evaluate, explain, learn, sample, store
from cohortloom.operators.learn import Spec
from cohortloom.operators.ordered import histogram, running_totals
from cohortloom.plans import clean, flags, scoring
from cohortloom.queries.base import query, r
from cohortloom.queries.profiles import rounded
from cohortloom.queries.projections import scratch
from cohortloom.queries.screening import FEATS
from cohortloom.session import cut_lineage
from cohortloom.sources.tables import KEY, KEY_ALIAS
from cohortloom.streaming.score import read_records, score_stream as stream_scores


def spec(name: str) -> Spec:
    """A model with the full settings of its preset."""
    return Spec(name, tuple(FEATS))


def rows(spark, sf):
    return fx.scored(spark, sf).select("row_key", "y_true", "version", *FEATS)


def test_metrics(scorer, df, name: str):
    """Metrics of a fitted model on the rows it did not see."""
    return evaluate.classification_metrics(scorer.score(df), 0.5).withColumn("model", F.lit(name))


def _fit(query_name: str, model: str) -> None:
    @query(query_name)
    def run(spark, sf):
        split = sample.split_stratified(rows(spark, sf), "row_key", "y_true")
        scorer = learn.fit_model(split.where("split = 'train'"), spec(model))
        return test_metrics(scorer, split.where("split = 'test'"), model)


for _query, _model in (
    ("fit_logistic", "logistic_regression"), ("fit_decision_tree", "decision_tree"), ("fit_random_forest", "random_forest"),
    ("fit_extra_trees", "extra_trees"), ("fit_mlp", "mlp"),
):
    _fit(_query, _model)


@query("fit_boosted_trees")
def fit_boosted_trees(spark, sf):
    split = sample.split_stratified(rows(spark, sf), "row_key", "y_true")
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    names = ("xgboost", "hist_gradient_boosting", "lightgbm", "gradient_boosting")
    parts = [test_metrics(m, test, m.spec.name) for m in learn.fit_models(train, [spec(n) for n in names])]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("fit_stacking")
def fit_stacking(spark, sf):
    split = sample.split_stratified(rows(spark, sf), "row_key", "y_true")
    stack = learn.fit_stacking(split.where("split = 'train'").drop("split"), [spec(b) for b in learn.STACK_BASE])
    return test_metrics(stack, split.where("split = 'test'"), "stacking")


@query("fit_voting")
def fit_voting(spark, sf):
    split = sample.split_stratified(rows(spark, sf), "row_key", "y_true")
    vote = learn.fit_voting(split.where("split = 'train'"), [spec(b) for b in learn.VOTING_BASE])
    return test_metrics(vote, split.where("split = 'test'"), "voting")


@query("calibrate_sigmoid")
def calibrate_sigmoid(spark, sf):
    df = fx.scored(spark, sf).select("row_key", "y_true", "y_proba")
    return learn.calibrate(df, "sigmoid").apply(df)


# a monotone step fit keeps the mean of the labels and never falls as the score rises
@query(
    "calibrate_isotonic",
    f"SELECT count(*) AS n, {r('avg(y_true)', 4)} AS mean_label, {r('avg(y_true)', 4)} AS mean_calibrated, 0::BIGINT AS falls FROM scored_v",
    needs=("scored_v",),
)
def calibrate_isotonic(spark, sf):
    df = fx.scored(spark, sf).select("row_key", "y_true", "y_proba")
    done = cut_lineage(learn.calibrate(df, "isotonic").apply(df))
    # as many rows lie below a step by score as by calibrated value, unless the fit falls somewhere
    below = {
        c: running_totals(histogram(done, c), c, ["w"]).select(F.col(c).alias(f"at_{c}"), (F.col("cum_w") - F.col("w")).alias(f"below_{c}"))
        for c in ("y_proba", "calibrated")
    }
    steps = done.groupBy("calibrated").agg(F.min("y_proba").alias("lo"))
    both = steps.join(below["y_proba"], F.col("lo") == F.col("at_y_proba")).join(below["calibrated"], F.col("calibrated") == F.col("at_calibrated"))
    falls = both.agg(F.count_if(F.col("below_y_proba") != F.col("below_calibrated")).alias("falls"))
    means = done.agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("y_true"), 4).alias("mean_label"), r6(F.avg("calibrated"), 4).alias("mean_calibrated")
    )
    return means.withColumn("falls", falls.scalar())


@query("calibrate_cv_fallback")
def calibrate_cv_fallback(spark, sf):
    df = rows(spark, sf)
    scorer = learn.fit_calibrated(df, spec("logistic_regression"), folds=5)
    out = evaluate.calibration_summary(scorer.score(df))
    return out.withColumns({"method": F.lit(scorer.method), "warnings": F.lit("; ".join(scorer.warnings))})


@query("train_with_threshold")
def train_with_threshold(spark, sf):
    return learn.train_with_threshold(rows(spark, sf), spec("logistic_regression"), folds=5)[1]


@query("hyperparameter_search")
def hyperparameter_search(spark, sf):
    found = learn.hyperparameter_search(rows(spark, sf), spec("logistic_regression"))
    return spark.createDataFrame([(str(f["params"]), float(f["f2"])) for f in found], "params string, f2 double")


def version_frames(spark, sf):
    df = rows(spark, sf)
    return {r.version: df.where(F.col("version") == r.version) for r in df.select("version").distinct().orderBy("version").collect()}


@query("tuning_experiments")
def tuning_experiments(spark, sf):
    return learn.best_tuned(learn.tuning_experiments(version_frames(spark, sf), [spec(m) for m in learn.PRESETS], [0.5, 1.0]))


@query("baseline_experiments")
def baseline_experiments(spark, sf):
    return learn.baseline_experiments(version_frames(spark, sf), [spec(m) for m in learn.PRESETS])


META = ["Edad", "IMC", "Temperatura"]


@query(
    "feature_metadata",
    " UNION ALL ".join(
        f"SELECT '{f}' AS feature, '{'string' if f == 'Temperatura' else 'double'}' AS dtype, {r(f'quantile_cont(TRY_CAST(\"{f}\" AS DOUBLE), 0.5)')} AS median, 'fill_constant' AS imputation, "
        f"-1.0::DOUBLE AS fill, {r('avg((k % 3 = 0)::INTEGER)')} AS prevalence, count(*) AS n_total FROM preop_v"
        for f in META
    ),
    needs=("preop_v",),
)
def feature_metadata(spark, sf):
    df = fx.preop(spark, sf).select(*META, (F.col("k") % 3 == 0).cast("int").alias("target"))
    return rounded(learn.feature_metadata(df, META, "target"), "median", "prevalence")


@query("recalibrate_saved")
def recalibrate_saved(spark, sf):
    """New calibrators on a calibration part, measured on the rest."""
    split = sample.split_stratified(fx.scored(spark, sf).select("row_key", "y_true", "y_proba"), "row_key", "y_true", 0.5)
    fit_on, rest = (split.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    parts = evaluate.calibration_summary(rest).withColumn("method", F.lit("none"))
    for method in ("sigmoid", "isotonic"):
        done = learn.calibrate(fit_on, method).apply(rest)
        parts = parts.unionByName(evaluate.calibration_summary(done, score="calibrated").withColumn("method", F.lit(method)))
    return parts


@query("score_batch")
def score_batch(spark, sf):
    df = rows(spark, sf)
    scorer = learn.fit_model(df, spec("logistic_regression"))
    return learn.score_batch(df.drop("severity"), scorer, 0.3, FEATS, ["row_key"])


@query("score_stream")
def score_stream(spark, sf):
    """The event file as a stream; each record is scored once."""
    df = rows(spark, sf)
    scorer = learn.fit_model(df, spec("logistic_regression"))
    schema = fx.table(spark, sf, "events").schema
    stream = read_records(spark, sf, T.StructType(schema.fields), "events.parquet")
    shaped = stream.selectExpr(*[f"{fx.SCORED_COLUMNS[c]} AS `{c}`" for c in ("row_key", *FEATS)])
    out, state = scratch(spark, "scored"), scratch(spark, "scored-state")
    running = stream_scores(shaped, scorer, 0.3, FEATS, ["row_key"], out, state)
    running.awaitTermination()
    return spark.read.parquet(out).drop("scored_at")


@query(
    "model_store",
    "SELECT kind, count(*) AS n, 0::BIGINT AS n_changed FROM scored_v, (VALUES ('single'), ('calibrated'), ('voting')) AS m(kind) GROUP BY kind",
    needs=("scored_v",),
)
def model_store(spark, sf):
    """Scores before saving and after loading, for each kind of model."""
    df = rows(spark, sf)
    tree, logistic = spec("decision_tree"), spec("logistic_regression")
    fitted = {
        "single": learn.fit_model(df, tree),
        "calibrated": learn.fit_calibrated(df, tree, folds=5),
        "voting": learn.fit_voting(df, [tree, logistic]),
    }
    parts = []
    for kind, scorer in fitted.items():
        path = scratch(spark, f"model-{kind}")
        store.save(spark, scorer, path)
        both = store.load(spark, path).score(scorer.score(df).withColumnRenamed(learn.SCORE, "before"))
        changed = F.count_if(F.abs(F.col("before") - F.col(learn.SCORE)) > 1e-12)
        parts.append(both.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n"), changed.alias("n_changed")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


RAW_FEATURES = ("Edad", "IMC", "Frecuencia Respiratoria", "Puntaje Mallampati")


@query(
    "score_raw_records",
    """SELECT count(*) AS n, count(DISTINCT k) AS n_keys, 0::BIGINT AS n_outside FROM vitals_v WHERE "Edad" IS NULL OR "Edad" >= 18""",
    needs=("vitals_v",),
)
def score_raw_records(spark, sf):
    """Raw records through cleaning, the manifest's medians and a saved, calibrated model."""
    raw = fx.preop(spark, sf)
    cleaned, vocabulary = clean.clean_all(raw, "k")
    train = cut_lineage(cleaned.select("k", *RAW_FEATURES, (F.col("k") % 3 == 0).cast("int").alias("target")))
    model = Spec("decision_tree", RAW_FEATURES, label="target", key="k")
    scorer, metrics = learn.train_with_threshold(train, model)
    best = metrics.first()
    path = scratch(spark, "raw-model")
    store.save(spark, scorer, f"{path}/model")
    performance = {m: best[m] for m in ("F2", "Recall", "Precision")}
    store.write_manifest(spark, f"{path}/manifest", "target", scorer, best["Threshold"], performance, learn.feature_metadata(train, list(RAW_FEATURES), "target"))
    scored = scoring.score_raw(raw, "k", vocabulary, store.load(spark, f"{path}/model"), store.read_manifest(spark, f"{path}/manifest"))
    outside = F.count_if(~F.coalesce(F.col(learn.SCORE).between(0, 1), F.lit(False)))
    return scored.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("k").alias("n_keys"), outside.alias("n_outside"))


# ---- evaluation and explanation that need a model ------------------------------------------------
@query("bootstrap_ci")
def bootstrap_ci(spark, sf):
    df = fx.scored(spark, sf).select("row_key", "y_proba", "y_true")
    return explain.bootstrap_ci(df, 0.4)


@query("cv_evaluate")
def cv_evaluate(spark, sf):
    return learn.cv_summary(learn.cv_evaluate(rows(spark, sf), spec("logistic_regression"), folds=10))


@query("global_importance")
def global_importance(spark, sf):
    """A forest answers itself; a logistic model gives coefficients; the network is permuted."""
    df = rows(spark, sf)
    parts = None
    for name, repeats in (("random_forest", 5), ("logistic_regression", 5), ("mlp", 5)):
        part = explain.global_importance(df, learn.fit_model(df, spec(name)), repeats=repeats).withColumn("model", F.lit(name))
        parts = part if parts is None else parts.unionByName(part)
    return parts


@query("shap_sampling")
def shap_sampling(spark, sf):
    df = rows(spark, sf)
    return explain.sampled_attributions(df, learn.fit_model(df, spec("random_forest")), permutations=10)


@query("flag_predictability")
def flag_predictability(spark, sf):
    names = flags.ALL_FLAGS
    f = flags.flags_all(fx.posop(spark, sf)).select(col(KEY_ALIAS).alias(KEY), "k", *names)
    pre = fx.preop(spark, sf).select(col(KEY), "Edad", "Talla (cm)", "IMC", "Puntaje Mallampati")
    merged = pre.join(f, KEY)
    forest = Spec("random_forest", ("Edad", "Talla (cm)", "IMC", "Puntaje Mallampati"), label="flag_liquidos", key="k", params={"numTrees": 20, "maxDepth": 5})
    return explain.flag_predictability(merged, names, forest, folds=5)
