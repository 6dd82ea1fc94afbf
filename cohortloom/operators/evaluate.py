"""Evaluation of scored rows: metrics, thresholds, calibration, subgroups, rankings.

All ranking metrics start from the score histogram (positives and negatives per distinct
score), so ties are exact and no window ever sees the raw rows.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortloom.functions.numeric import col, ratio
from cohortloom.operators import joins, rank
from cohortloom.operators.ordered import exact_quantiles, histogram, running_totals

SCORE, LABEL = "y_proba", "y_true"

# the threshold grid: 0.05 up to 0.94 in steps that carry the rounding of repeated addition
GRID_STEP = (0.05 + 0.01) - 0.05
GRID = [0.05 + i * GRID_STEP for i in range(90)]


def score_histogram(df: DataFrame, by: Sequence[str] = (), score: str = SCORE, label: str = LABEL) -> DataFrame:
    """(by, score, pos, neg) over the rows with a label."""
    y = col(label).cast("bigint")
    return histogram(df.where(y.isNotNull()), score, by, pos=y, neg=F.lit(1) - y)


def _ranked(df: DataFrame, by: Sequence[str], score: str = SCORE, label: str = LABEL) -> DataFrame:
    """Score histogram with running totals from the lowest score, and from the highest (tp, fp)."""
    run = running_totals(score_histogram(df, by, score, label), score, ["pos", "neg"], by)
    return run.withColumns(
        {
            "tp": F.col("tot_pos") - F.col("cum_pos") + F.col("pos"),
            "fp": F.col("tot_neg") - F.col("cum_neg") + F.col("neg"),
        }
    )


def _auc() -> Column:
    """Mann-Whitney count of concordant pairs (ties half) over all pairs."""
    u = F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2))
    return F.try_divide(u, F.max("tot_pos").cast("double") * F.max("tot_neg"))


def _average_precision() -> Column:
    step = F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))
    return F.try_divide(F.sum(step), F.max("tot_pos").cast("double"))


def roc_auc(df: DataFrame, by: Sequence[str] = (), score: str = SCORE, label: str = LABEL) -> DataFrame:
    return _ranked(df, by, score, label).groupBy(*by).agg(_auc().alias("roc_auc"))


def pr_auc(df: DataFrame, by: Sequence[str] = (), score: str = SCORE, label: str = LABEL) -> DataFrame:
    return _ranked(df, by, score, label).groupBy(*by).agg(_average_precision().alias("pr_auc"))


def rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Threshold metrics from the four counts; a zero denominator gives 0."""
    recall, precision, specificity = ratio(tp, tp + fn), ratio(tp, tp + fp), ratio(tn, tn + fp)
    return {
        "Accuracy": ratio(tp + tn, tp + fp + fn + tn),
        "Recall": recall,
        "Precision": precision,
        "F1": ratio(2 * tp, 2 * tp + fp + fn),
        "F2": ratio(5 * tp, 5 * tp + 4 * fn + fp),
        "Balanced_Accuracy": (recall + specificity) / 2,
        "Specificity": specificity,
        "Predicted_Positive_Rate": ratio(tp + fp, tp + fp + fn + tn),
        "FN_Rate": ratio(fn, tp + fn),
    }


METRICS = [
    "Accuracy", "Recall", "Precision", "F1", "F2", "ROC_AUC", "PR_AUC", "Balanced_Accuracy", "Specificity",
    "Brier", "Predicted_Positive_Rate", "FN_Rate", "Threshold",
]


def classification_metrics(
    df: DataFrame, threshold: float | Column, by: Sequence[str] = (), score: str = SCORE, label: str = LABEL
) -> DataFrame:
    """The thirteen metrics per group, from one histogram."""
    s = F.col(score)
    t = F.lit(float(threshold)) if isinstance(threshold, (int, float)) else threshold
    hit = s >= t
    error = F.col("pos") * (s - 1) * (s - 1) + F.col("neg") * s * s
    sums = _ranked(df, by, score, label).groupBy(*by).agg(
        F.coalesce(F.sum(F.when(hit, F.col("pos"))), F.lit(0)).alias("_tp"),
        F.coalesce(F.sum(F.when(hit, F.col("neg"))), F.lit(0)).alias("_fp"),
        F.sum("pos").alias("_p"),
        F.sum("neg").alias("_n"),
        _auc().alias("ROC_AUC"),
        _average_precision().alias("PR_AUC"),
        (F.sum(error) / F.sum(F.col("pos") + F.col("neg"))).alias("Brier"),
    )
    tp, fp, p, n = (F.col(c) for c in ("_tp", "_fp", "_p", "_n"))
    out = sums.withColumns({**rates(tp, fp, p - tp, n - fp), "Threshold": t})
    return out.select(*by, *METRICS)


def _grid_index(score: Column) -> Column:
    """How many grid thresholds are at or below the score (0..90)."""
    grid = F.array(*[F.lit(g) for g in GRID])
    near = F.least(F.greatest(F.floor((score - 0.05) * 100).cast("int"), F.lit(-1)), F.lit(len(GRID) - 1))
    # the computed position can be off by one at an edge, so its neighbours are compared exactly
    return (
        F.when(F.get(grid, near + 1) <= score, near + 2)
        .when(F.get(grid, near) <= score, near + 1)
        .otherwise(F.greatest(near, F.lit(0)))
    )


def threshold_table(df: DataFrame, by: Sequence[str] = (), score: str = SCORE, label: str = LABEL) -> DataFrame:
    """(by, i, threshold, metrics) for all 90 grid thresholds, from one pass over the rows."""
    y = col(label).cast("bigint")
    cells = df.groupBy(*by, _grid_index(col(score)).alias("b")).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    packed = cells.groupBy(*by).agg(F.collect_list(F.struct("b", "pos", "neg")).alias("cells"))
    grid = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(g).alias("threshold")) for i, g in enumerate(GRID)])
    out = packed.select(*by, "cells", F.explode(grid).alias("g")).select(*by, "cells", "g.*")

    def total(field: str, above: bool) -> Column:
        kept = F.filter("cells", lambda c: c["b"] > F.col("i")) if above else F.col("cells")
        return F.aggregate(kept, F.lit(0).cast("bigint"), lambda acc, c: acc + c[field])

    out = out.withColumns(
        {"tp": total("pos", True), "fp": total("neg", True), "p": total("pos", False), "n": total("neg", False)}
    )
    tp, fp, p, n = (F.col(c) for c in ("tp", "fp", "p", "n"))
    return out.withColumns(rates(tp, fp, p - tp, n - fp)).drop("cells")


METRIC_NAMES = {"f1": "F1", "f2": "F2", "balanced_accuracy": "Balanced_Accuracy"}


def pick_threshold(
    table: DataFrame, by: Sequence[str] = (), metric: str = "f2", optimize_for: str | None = None,
    recall_min: float = 0.80, window: tuple[float | None, float | None] = (None, None),
) -> DataFrame:
    """(by, threshold, best_score); the lowest threshold wins ties.

    recall_constraint: highest precision among thresholds with enough recall, else highest
    recall. A window limits the share of predicted positives; if no threshold meets it,
    it is ignored.
    """
    if optimize_for == "recall_constraint":
        allowed = F.col("Recall") >= recall_min
        first, other = F.col("Precision"), F.col("Recall")
    else:
        if metric not in METRIC_NAMES:
            raise ValueError(f"metric must be one of {sorted(METRIC_NAMES)}, got {metric!r}")
        low, high = window
        allowed = F.lit(True)
        if low is not None:
            allowed = allowed & (F.col("Predicted_Positive_Rate") >= low)
        if high is not None:
            allowed = allowed & (F.col("Predicted_Positive_Rate") <= high)
        first = other = F.col(METRIC_NAMES[metric])
    candidate = F.struct(
        allowed.alias("ok"), F.when(allowed, first).otherwise(other).alias("s"), (-F.col("i")).alias("i"), "threshold"
    )
    best = table.groupBy(*by).agg(F.max(candidate).alias("b"))
    return best.select(*by, F.col("b.threshold").alias("threshold"), F.col("b.s").alias("best_score"))


def find_threshold(df: DataFrame, by: Sequence[str] = (), score: str = SCORE, label: str = LABEL, **how) -> DataFrame:
    return pick_threshold(threshold_table(df, by, score, label), by, **how)


# ---- calibration ------------------------------------------------------------------------------
def _uniform_bin(score: Column, bins: int) -> Column:
    """Right-closed equal-width bins of [0, 1]."""
    edges = F.array(*[F.lit(i * (1.0 / bins)) for i in range(1, bins)])
    near = F.least(F.greatest(F.floor(score * bins).cast("int"), F.lit(1)), F.lit(bins - 1)) - 1
    return (
        F.when(F.get(edges, near) < score, F.when(F.get(edges, near + 1) < score, near + 2).otherwise(near + 1))
        .when(F.get(edges, near - 1) < score, near)
        .otherwise(F.greatest(near - 1, F.lit(0)))
    )


def calibration_curve(
    df: DataFrame, by: Sequence[str] = (), bins: int = 10, strategy: str = "uniform", score: str = SCORE,
    label: str = LABEL,
) -> DataFrame:
    """(by, bin, n, fraction_positive, mean_predicted) of the bins that hold rows."""
    s = col(score)
    if strategy == "uniform":
        binned = df.withColumn("bin", _uniform_bin(s, bins))
    else:
        probs = [i / bins for i in range(1, bins)]
        q = exact_quantiles(df, score, probs, by)
        edges = q.select(*by, F.array(*[f"q{i}" for i in range(bins - 1)]).alias("_e"))
        staged = df.join(edges, list(by)) if by else df.withColumn("_e", edges.scalar())
        binned = staged.withColumn("bin", F.size(F.filter("_e", lambda e: e < s)))
    return binned.groupBy(*by, "bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(col(label).cast("double")).alias("fraction_positive"),
        F.avg(s).alias("mean_predicted"),
        F.sum((s - col(label)) * (s - col(label))).alias("_sq"),
    )


def calibration_summary(df: DataFrame, by: Sequence[str] = (), bins: int = 10, **how) -> DataFrame:
    """(by, ece, mce, brier, over, under): every bin is weighted by its own count."""
    curve = calibration_curve(df, by, bins, **how)
    gap = F.abs(F.col("fraction_positive") - F.col("mean_predicted"))
    return curve.groupBy(*by).agg(
        (F.sum(gap * F.col("n")) / F.sum("n")).alias("ece"),
        F.max(gap).alias("mce"),
        (F.sum("_sq") / F.sum("n")).alias("brier"),
        F.count_if(F.col("mean_predicted") > F.col("fraction_positive")).alias("overconfident_bins"),
        F.count_if(F.col("mean_predicted") < F.col("fraction_positive")).alias("underconfident_bins"),
    )


def calibration_compare(df: DataFrame, model: str = "model") -> DataFrame:
    return calibration_summary(df, [model]).orderBy("ece", model)


def roc_pr_points(df: DataFrame, by: Sequence[str] = (), score: str = SCORE, label: str = LABEL) -> DataFrame:
    """One point per distinct score: false and true positive rate, precision, recall."""
    tp, fp = F.col("tp"), F.col("fp")
    return _ranked(df, by, score, label).select(
        *by,
        col(score).alias("threshold"),
        ratio(fp, F.col("tot_neg")).alias("fpr"),
        ratio(tp, F.col("tot_pos")).alias("tpr"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, F.col("tot_pos")).alias("recall"),
    )


def confusion_counts(df: DataFrame, label: str = LABEL, pred: str = "y_pred") -> DataFrame:
    """(y_true, y_pred, n): four rows, empty cells included."""
    cells = F.array(
        *[
            F.struct(
                F.lit(t).alias("y_true"), F.lit(p).alias("y_pred"),
                F.count_if((col(label) == t) & (col(pred) == p)).alias("n"),
            )
            for t in (0, 1) for p in (0, 1)
        ]
    )
    return df.agg(cells.alias("c")).select(F.explode("c").alias("c")).select("c.*")


# ---- subgroups --------------------------------------------------------------------------------
def memberships(df: DataFrame, groups: Mapping[str, Column], keep: Sequence[str]) -> DataFrame:
    """(variable, subgroup, kept columns): one row per group a row belongs to."""
    cells = F.array(*[F.struct(F.lit(v).alias("variable"), c.cast("string").alias("subgroup")) for v, c in groups.items()])
    long = df.select(*[col(k) for k in keep], F.explode(cells).alias("g")).select("g.*", *keep)
    return long.where("subgroup IS NOT NULL")


def subgroup_errors(
    df: DataFrame, groups: Mapping[str, Column], threshold: float, min_rows: int = 20, score: str = SCORE,
    label: str = LABEL,
) -> DataFrame:
    """Prevalence, AUC, false negative and false positive rate of each subgroup.

    Subgroups under min_rows are left out; with one class or under ten rows the rates are null.
    """
    by = ["variable", "subgroup"]
    s = F.col(score)
    sums = _ranked(memberships(df, groups, [score, label]), by, score, label).groupBy(*by).agg(
        F.sum(F.col("pos") + F.col("neg")).alias("n"),
        F.sum("pos").alias("n_pos"),
        _auc().alias("roc_auc"),
        F.coalesce(F.sum(F.when(s < threshold, F.col("pos"))), F.lit(0)).alias("_fn"),
        F.coalesce(F.sum(F.when(s >= threshold, F.col("neg"))), F.lit(0)).alias("_fp"),
    )
    n, p = F.col("n"), F.col("n_pos")
    usable = (n >= 10) & (p > 0) & (p < n)
    return sums.where(n >= min_rows).select(
        *by, "n", "n_pos", (p / n).alias("prevalence"),
        F.when(usable, F.col("roc_auc")).alias("roc_auc"),
        F.when(usable, F.try_divide(F.col("_fn"), p)).alias("fn_rate"),
        F.when(usable, F.try_divide(F.col("_fp"), n - p)).alias("fp_rate"),
    )


def subgroup_metrics(
    df: DataFrame, groups: Mapping[str, Column], threshold: float, min_rows: int = 5, score: str = SCORE,
    label: str = LABEL,
) -> DataFrame:
    by = ["variable", "subgroup"]
    long = memberships(df, groups, [score, label])
    out = classification_metrics(long, threshold, by, score, label)
    sizes = long.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(col(label).cast("bigint")).alias("n_pos"))
    return sizes.where(F.col("n") >= min_rows).join(out, by).select(
        *by, "n", "n_pos", (F.col("n_pos") / F.col("n")).alias("prevalence"),
        "ROC_AUC", "F2", "Recall", "Precision", "Balanced_Accuracy",
    )


# ---- rankings ---------------------------------------------------------------------------------
def final_ranking(
    baseline: DataFrame, cv: DataFrame, stability: DataFrame, calibration: DataFrame,
    weights: tuple[float, float, float, float] = (0.35, 0.35, 0.20, 0.10),
) -> DataFrame:
    """Weighted score per version from its best baseline and CV rows, stability and calibration.

    baseline and cv: (version, model, ROC_AUC, F2); stability: (version, stability_score);
    calibration: (version, ece).
    """
    best = rank.best_per_group(baseline, ["version"], [F.desc("ROC_AUC"), F.desc("F2"), F.asc("model")])
    cv_best = rank.best_per_group(cv, ["version"], [F.desc("ROC_AUC"), F.asc("model")])
    cal = calibration.groupBy("version").agg((1 - F.avg("ece")).alias("calibration_score"))
    base = best.select("version", F.col("ROC_AUC").alias("roc_auc_test"), F.col("F2").alias("f2_test"))
    cv_side = cv_best.select("version", F.col("ROC_AUC").alias("roc_auc_cv"), F.col("F2").alias("f2_cv"))
    merged = joins.left_chain(
        base.join(cv_side, "version", "left"),
        [(stability, {"stability_score": 0.0}), (cal, {"calibration_score": 0.5})],
        "version",
    )
    # one row per version, so the plain windows below are tiny
    every = Window.partitionBy(F.lit(1))

    def scaled(c: str) -> Column:
        low, high = F.min(c).over(every), F.max(c).over(every)
        return F.when(high > low, (F.col(c) - low) / (high - low)).otherwise(F.lit(0.5))

    merged = merged.withColumns({"roc_auc_norm": scaled("roc_auc_cv"), "f2_norm": scaled("f2_cv")})
    parts = ("roc_auc_norm", "f2_norm", "stability_score", "calibration_score")
    total = sum((F.lit(w) * F.col(p) for w, p in zip(weights, parts)), F.lit(0.0))
    return rank.rank_rows(merged.withColumn("score_final", total), [F.desc("score_final"), F.asc("version")])
