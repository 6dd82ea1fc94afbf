"""Explanations: linear attributions, group profiles, insights."""
from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortloom.functions.numeric import col, to_number
from cohortloom.operators.evaluate import rates, roc_auc
from cohortloom.operators.forest import ForestModel, scramble
from cohortloom.operators.learn import FILL, cv_evaluate, feature_values, side_by_side
from cohortloom.operators.ordered import bucket_count, histogram, with_bucket
from cohortloom.operators.rank import case_type
from cohortloom.session import cut_lineage


def linear_attributions(
    df: DataFrame, key: str, coefficients: Mapping[str, float], intercept: float = 0.0
) -> DataFrame:
    """(key, feature, value, contribution, base_value): coefficient times distance to the mean."""
    means = df.agg(F.struct(*[F.avg(col(f)).alias(f"m{i}") for i, f in enumerate(coefficients)]).alias("m")).scalar()
    base = F.lit(intercept)
    staged = df.select(col(key), *[col(f).cast("double").alias(f) for f in coefficients]).withColumn("_m", means)
    for i, beta in enumerate(coefficients.values()):
        base = base + F.lit(beta) * F.col(f"_m.m{i}")
    cells = F.array(
        *[
            F.struct(
                F.lit(f).alias("feature"), col(f).alias("value"),
                (F.lit(beta) * (col(f) - F.col(f"_m.m{i}"))).alias("contribution"),
            )
            for i, (f, beta) in enumerate(coefficients.items())
        ]
    )
    return staged.select(col(key), F.explode(cells).alias("c"), base.alias("base_value")).select(
        col(key), "c.*", "base_value"
    )


def top_contributions(attributions: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The n largest contributions of each row by magnitude, with the input value."""
    w = Window.partitionBy(col(key)).orderBy(F.desc(F.abs("contribution")), F.asc("feature"))
    return attributions.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


CASES = ("TP", "FN", "FP", "TN")


def group_profiles(attributions: DataFrame, cases: DataFrame, key: str, n: int | None = 20) -> DataFrame:
    """Mean contribution per feature and case type, ordered by the TP-FN distance.

    cases: (key, y_true, y_pred). A type without cases has mean 0.
    """
    typed = attributions.join(cases.select(col(key), case_type().alias("case_type")), key)
    sums = typed.groupBy("feature").agg(
        *[F.coalesce(F.avg(F.when(F.col("case_type") == c, F.col("contribution"))), F.lit(0.0)).alias(f"shap_{c.lower()}") for c in CASES],
        *[F.count_if(F.col("case_type") == c).alias(f"n_{c.lower()}") for c in CASES],
    )
    out = sums.withColumn("delta_tp_fn", F.col("shap_tp") - F.col("shap_fn"))
    out = out.withColumn("abs_delta", F.abs("delta_tp_fn")).orderBy(F.desc("abs_delta"), F.asc("feature"))
    return out if n is None else out.limit(n)


def _signed(c: str) -> Column:
    return F.format_string("%.3f", F.abs(F.col(c)))


def fn_insight(profiles: DataFrame) -> DataFrame:
    """Reading of each feature for the missed cases, from the signs of its mean contributions."""
    up = F.col("delta_tp_fn") > 0
    sentence = (
        F.when(
            up & (F.col("shap_fn") < 0),
            F.concat(F.lit("Protege al FN (baja riesgo −"), _signed("shap_fn"), F.lit("), eleva al TP (+"), F.format_string("%.3f", "shap_tp"), F.lit(")")),
        )
        .when(
            up,
            F.concat(F.lit("Señal débil en FN (+"), F.format_string("%.3f", "shap_fn"), F.lit(") vs fuerte en TP (+"), F.format_string("%.3f", "shap_tp"), F.lit(")")),
        )
        .when(F.col("shap_tp") < 0, F.lit("Protege más al TP que al FN — FN tiene más riesgo aquí"))
        .otherwise(
            F.concat(F.lit("FN tiene mayor señal positiva (+"), F.format_string("%.3f", "shap_fn"), F.lit(") — el modelo la ve pero no alcanza"))
        )
    )
    return profiles.select("feature", "shap_tp", "shap_fn", "delta_tp_fn", sentence.alias("interpretacion"))


def fn_ranked(df: DataFrame, key: str, n: int = 50, score: str = "y_proba") -> DataFrame:
    """Missed cases by falling score."""
    missed = df.where((col("y_true") == 1) & (col("y_pred") == 0))
    return missed.orderBy(F.desc(score), F.asc(key)).limit(n)


def global_importance(df: DataFrame, scorer, top_n: int = 25, repeats: int = 5) -> DataFrame:
    """(feature, importance, source): the model's own importance, else absolute coefficients,
    else the mean loss of AUC when a column is permuted."""
    spec, model = scorer.spec, scorer.model
    spark = df.sparkSession
    for attribute, source in (("featureImportances", "native_feature_importance"), ("coefficients", "abs_coef")):
        values = getattr(model, attribute, None)
        if values is not None:
            rows = [(f, abs(float(v)), source) for f, v in zip(spec.features, values.toArray())]
            out = spark.createDataFrame(rows, "feature string, importance double, source string")
            return out.orderBy(F.desc("importance"), F.asc("feature")).limit(top_n)
    return permutation_importance(df, scorer, repeats).orderBy(F.desc("importance"), F.asc("feature")).limit(top_n)


#: Rows whose values are exchanged with each other in one task.
BLOCK_ROWS = 20_000


def permuted(block: pa.Table, features: int, repeats: int, seed: int) -> pa.Table:
    """The block with `_moved`: for each feature and repeat its values in an order of their own."""
    block = block.take(np.lexsort(tuple(block[f"_v{i}"].to_numpy(zero_copy_only=False) for i in range(features)) + (block["_h"].to_numpy(),)))
    number, moved = block["_block"][0].as_py(), np.empty((block.num_rows, features * repeats))
    for i in range(features):
        values = block[f"_v{i}"].to_numpy(zero_copy_only=False)
        for k in range(repeats):
            moved[:, i * repeats + k] = values[np.random.default_rng([seed, number, i, k]).permutation(block.num_rows)]
    lists = pa.ListArray.from_arrays(pa.array(np.arange(block.num_rows + 1, dtype=np.int32) * moved.shape[1]), pa.array(moved.ravel()))
    return block.append_column("_moved", lists)


def permutation_importance(df: DataFrame, scorer, repeats: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """AUC of the rows minus the mean AUC with one column permuted, per feature.

    Rows are dealt to blocks by a hash of their key, and each block exchanges its values inside a task: one
    shuffle gives all features and repeats, one pass scores them. A table of at most block_rows rows is
    permuted as a whole. Missing values are permuted like others. Rows alike in key and values may change
    places, which changes nothing.
    """
    spec, names = scorer.spec, list(scorer.spec.features)
    value = {f"_v{i}": F.coalesce(to_number(f).cast("double"), F.lit(FILL)) for i, f in enumerate(names)}
    rows = df.select(col(spec.label).cast("double").alias("_y"), F.xxhash64(col(spec.key), F.lit(spec.seed)).alias("_h"), *[v.alias(k) for k, v in value.items()])
    blocks = max(1, -(-df.count() // block_rows))
    rows = rows.where("_y IS NOT NULL").withColumn("_block", F.pmod("_h", F.lit(blocks)))
    kinds = ", ".join(f"{n} {k}" for n, k in rows.dtypes) + ", _moved array<double>"
    moved = rows.groupBy("_block").applyInArrow(lambda g: permuted(g, len(names), repeats, spec.seed), kinds)
    # place -1 stands for the rows as they are
    every = moved.select("_y", *value, F.explode(F.concat(
        F.array(F.struct(F.lit(-1).alias("at"), F.lit(None).cast("double").alias("v"))),
        F.transform("_moved", lambda v, i: F.struct(i.alias("at"), v.alias("v"))),
    )).alias("_m"))
    feature = F.when(F.col("_m.at") >= 0, F.floor(F.col("_m.at") / repeats).cast("int")).otherwise(-1)
    mixed = every.select(
        F.col("_y").alias(spec.label), feature.alias("_f"), F.col("_m.at").alias("_at"),
        *[F.when(feature == i, F.col("_m.v")).otherwise(F.col(f"_v{i}")).alias(f) for i, f in enumerate(names)],
    )
    aucs = roc_auc(scorer.score(mixed).select("_f", "_at", spec.label, "y_proba"), ["_f", "_at"], label=spec.label)
    means = cut_lineage(aucs.groupBy("_f").agg(F.avg("roc_auc").alias("_auc")))  # a row a feature; read twice
    whole = means.where("_f = -1").select("_auc").scalar()
    return means.where("_f >= 0").select(
        F.get(F.array(*[F.lit(f) for f in names]), F.col("_f")).alias("feature"), (whole - F.col("_auc")).alias("importance"),
        F.lit("permutation_importance").alias("source"),
    )


def sampled_attributions(df: DataFrame, scorer, permutations: int = 3, seed: int = 42) -> DataFrame:
    """(key, feature, contribution) of any model against the mean row, averaged over permutations.

    A forest's contributions are the average over all permutations, summed in closed form in one pass.
    Other models are sampled: a row is scored once per permutation and prefix: the features of the prefix come from
    the row, the others from the background. Differences of neighbouring prefixes are the
    contributions, averaged over the permutations.
    """
    spec = scorer.spec
    rng = random.Random(seed)
    names = list(spec.features)
    orders = [rng.sample(range(len(names)), len(names)) for _ in range(permutations)]
    means = F.struct(*[F.avg(col(f)).alias(f"b{i}") for i, f in enumerate(names)])
    if isinstance(getattr(scorer, "model", None), ForestModel):
        at = [FILL if v is None else float(v) for v in df.agg(means.alias("b")).first()["b"]]
        found = scorer.model.add_contributions(df.select(col(spec.key), feature_values(names).alias("_x")), "_x", at, "_c")
        return found.select(col(spec.key), F.posexplode("_c").alias("_i", "contribution")).select(
            col(spec.key), F.get(F.array(*[F.lit(f) for f in names]), F.col("_i")).alias("feature"), "contribution"
        )
    background = df.agg(means.alias("b")).scalar()
    ranks = F.array(*[F.array(*[F.lit(order.index(i)) for i in range(len(names))]) for order in orders])
    wide = df.select(col(spec.key), *[col(f).cast("double").alias(f) for f in names]).withColumn("_b", background)
    wide = wide.withColumn("_r", ranks).select("*", F.posexplode("_r").alias("_perm", "_rank"))
    wide = wide.withColumn("_prefix", F.explode(F.sequence(F.lit(0), F.lit(len(names)))))
    mixed = wide.withColumns(
        {f: F.when(F.col("_rank")[i] < F.col("_prefix"), col(f)).otherwise(F.col(f"_b.b{i}")) for i, f in enumerate(names)}
    )
    scored = scorer.score(mixed).select(col(spec.key), "_perm", "_prefix", "_rank", "y_proba")
    steps = Window.partitionBy(col(spec.key), "_perm").orderBy("_prefix")
    delta = scored.withColumn("_d", F.col("y_proba") - F.lag("y_proba").over(steps)).where("_prefix > 0")
    labels = F.array(*[F.lit(f) for f in names])
    feature = F.get(labels, F.array_position("_rank", F.col("_prefix") - 1).cast("int") - 1)
    return delta.select(col(spec.key), feature.alias("feature"), "_d").groupBy(col(spec.key), "feature").agg(
        F.avg("_d").alias("contribution")
    )


def _poisson_quantile(u: np.ndarray, n: int) -> np.ndarray:
    """Poisson draws of mean n from uniforms; the table covers all but about 1e-20 of the distribution."""
    low = max(0, int(n - 10 * math.sqrt(n) - 10))
    k = np.arange(low + 1, int(n + 10 * math.sqrt(n) + 30))
    start = low * math.log(n) - n - math.lgamma(low + 1)
    mass = np.cumsum(np.exp(start + np.concatenate(([0.0], np.cumsum(math.log(n) - np.log(k))))))
    return low + np.searchsorted(mass / mass[-1], u, side="right")


def _resampled(scores: np.ndarray, counts: np.ndarray, label: int, replicates: int, seed: int) -> np.ndarray:
    """Rows x replicates: how often the `counts` rows of each score are drawn, a hash of score, label and replicate."""
    out = np.zeros((len(scores), replicates))
    key = scramble(scramble((scores + 0.0).view(np.uint64)) ^ scramble(np.array([2 * seed + label + 1], np.uint64)))
    with np.errstate(over="ignore"):
        x = scramble(key[:, None] + np.arange(1, replicates + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
    u = (x >> np.uint64(11)).astype(np.float64) * 2.0**-53
    for n in np.unique(counts[counts > 0]):
        own = counts == n
        out[own] = _poisson_quantile(u[own], int(n))
    return out


REPLICATES = "bucket int, replicate int, pos double, neg double, area double, tp double, fp double"
#: Distinct scores that a task resamples at once.
RESAMPLED = 1024


def _bootstrap_bucket(group: pa.Table, replicates: int, threshold: float, seed: int) -> pa.Table:
    """Per replicate the weights of a bucket, the pairs inside it that are in order (ties half), and the hits."""
    s, p, q = (group[c].to_numpy() for c in ("s", "pos", "neg"))
    order = np.argsort(s)
    s, p, q = s[order], p[order], q[order]
    pos, neg, area, tp, fp = np.zeros((5, replicates))
    for at in range(0, len(s), RESAMPLED):
        part = slice(at, at + RESAMPLED)
        own, other = (_resampled(s[part], c[part], y, replicates, seed) for y, c in ((1, p), (0, q)))
        area += (own * (neg + np.cumsum(other, axis=0) - other / 2)).sum(axis=0)
        hit = s[part] >= threshold
        pos, neg = pos + own.sum(axis=0), neg + other.sum(axis=0)
        tp, fp = tp + own[hit].sum(axis=0), fp + other[hit].sum(axis=0)
    names = [c.split()[0] for c in REPLICATES.split(", ")]
    head = [np.full(replicates, group["_bucket"][0].as_py(), np.int32), np.arange(replicates, dtype=np.int32)]
    return pa.table([*head, pos, neg, area, tp, fp], names=names)


def bootstrap_ci(
    df: DataFrame, threshold: float, replicates: int = 1000, alpha: float = 0.05, seed: int = 42,
    score: str = "y_proba", label: str = "y_true",
) -> DataFrame:
    """(metric, mean, ci_lower, ci_upper, n_valid) by Poisson resampling.

    The weights of the n rows of one score and label sum to a Poisson variable of mean n, so the score
    histogram is all that is resampled. It is cut into buckets of similar size; a task gives the sums of
    its bucket for every replicate, and only those are added up.
    """
    y = col(label).cast("bigint")
    hist = histogram(df.select(col(score).cast("double").alias("s"), y.alias("y")).where("y IS NOT NULL"), "s", pos=F.col("y"), neg=1 - F.col("y"))
    cut = with_bucket(hist, "s", [], bucket_count(df.sparkSession))
    parts = cut.groupBy("_bucket").applyInArrow(lambda g: _bootstrap_bucket(g, replicates, threshold, seed), REPLICATES)
    before = Window.partitionBy("replicate").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("neg").over(before), F.lit(0.0)))
    sums = parts.groupBy("replicate").agg(
        F.try_divide(F.sum(F.col("area") + F.col("pos") * F.col("_before")), F.sum("pos") * F.sum("neg")).alias("ROC_AUC"),
        *[F.sum(c).cast("bigint").alias(c) for c in ("tp", "fp")], F.sum("pos").cast("bigint").alias("p"), F.sum("neg").cast("bigint").alias("n"),
    ).where("p > 0 AND n > 0")
    r = rates(F.col("tp"), F.col("fp"), F.col("p") - F.col("tp"), F.col("n") - F.col("fp"))
    values = sums.select("ROC_AUC", *[r[m].alias(m) for m in ("F2", "Recall", "Precision")])
    long = values.unpivot([], ["ROC_AUC", "F2", "Recall", "Precision"], "metric", "v")
    # one value per replicate and metric, a bounded number
    return long.groupBy("metric").agg(
        F.avg("v").alias("mean"),
        F.percentile("v", F.lit(alpha / 2)).alias("ci_lower"),
        F.percentile("v", F.lit(1 - alpha / 2)).alias("ci_upper"),
        F.count("v").alias("n_valid"),
    )


#: Flags whose models are fitted at once.
FLAGS_AT_ONCE = 4


def flag_predictability(
    df: DataFrame, flags: Sequence[str], spec, folds: int = 5, min_prevalence: float = 0.01
) -> DataFrame:
    """(flag, prevalence, n_positives, roc_auc_mean, roc_auc_std, interpretacion) per flag.

    How well the preop features predict each outcome flag, by cross-validation. The rows are written once
    for all flags, and flags are measured side by side.
    """
    names = dict.fromkeys([*((spec.key,) if spec.key in df.columns else ()), *spec.features, *flags])
    df = cut_lineage(df.select(*[col(c) for c in names]))
    stats = df.agg(*[F.sum(col(f).cast("bigint")).alias(f) for f in flags], F.count(F.lit(1)).alias("_n")).first()
    shares = {f: (stats[f] or 0) / max(stats["_n"], 1) for f in flags}

    def measured(f: str) -> DataFrame:
        aucs = cv_evaluate(df, replace(spec, label=f), folds, fixed_threshold=0.5).agg(
            F.avg("ROC_AUC").alias("roc_auc_mean"), F.stddev_pop("ROC_AUC").alias("roc_auc_std")
        )
        return aucs.select(F.lit(f).alias("flag"), F.lit(shares[f]).alias("prevalence"), F.lit(stats[f]).alias("n_positives"), "roc_auc_mean", "roc_auc_std")

    kept = [f for f in flags if min_prevalence <= shares[f] < 1]
    parts = side_by_side([lambda f=f: measured(f) for f in kept], FLAGS_AT_ONCE)
    m = F.col("roc_auc_mean")
    grade = F.when(m >= 0.75, "buena_senal").when(m >= 0.65, "senal_moderada").when(m >= 0.55, "senal_debil").otherwise("sin_senal")
    return reduce(DataFrame.unionByName, parts).withColumn("interpretacion", grade).orderBy(F.desc("roc_auc_mean"), "flag")
