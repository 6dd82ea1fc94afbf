"""Evaluation of scored rows."""
from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom import fixtures as fx
from cohortloom.functions.numeric import col, round_half_up as r6
from cohortloom.operators import evaluate, explain, rank
from cohortloom.queries.base import block, query, r
from cohortloom.queries.profiles import rounded
from cohortloom.queries.ranks import REASON, with_pred


def div(a: str, b: str) -> str:
    return f"coalesce(({a})::DOUBLE / nullif({b}, 0), 0)"


def auc_block(name: str, src: str, by: str = "", score: str = "y_proba", label: str = "y_true") -> None:
    """Histogram with running totals: pos, neg, cum_neg, tp, fp, tot_pos, tot_neg per group and score."""
    part = f"PARTITION BY {by}" if by else ""
    pre = f"{by}, " if by else ""
    block(
        name,
        f"""SELECT {pre}{score} AS s, pos, neg, sum(neg) OVER ({part} ORDER BY {score}) AS cum_neg,
 sum(pos) OVER ({part} ORDER BY {score} DESC) AS tp, sum(neg) OVER ({part} ORDER BY {score} DESC) AS fp,
 sum(pos) OVER ({part}) AS tot_pos, sum(neg) OVER ({part}) AS tot_neg
 FROM (SELECT {pre}{score}, sum({label}) AS pos, sum(1 - {label}) AS neg FROM {src} GROUP BY ALL)""",
        (src,),
    )


AUC = "sum(pos * (cum_neg - neg / 2.0)) / nullif(max(tot_pos)::DOUBLE * max(tot_neg), 0)"
AP = "sum(pos * tp::DOUBLE / (tp + fp)) / nullif(max(tot_pos), 0)"
auc_block("h_all", "scored_v")
auc_block("h_group", "scored_v", "version, model")
auc_block("h_version", "scored_v", "version")
LINE_BLOCK = "SELECT l_quantity / 51.0 AS y_proba, (l_extendedprice > 55000)::INTEGER AS y_true, l_returnflag FROM lineitem"
block("line_v", LINE_BLOCK)
auc_block("h_line", "line_v", "l_returnflag")


def line_scores(spark, sf):
    df = fx.table(spark, sf, "lineitem")
    return df.select(
        (F.col("l_quantity") / 51.0).alias("y_proba"), (F.col("l_extendedprice") > 55000).cast("int").alias("y_true"), "l_returnflag"
    )


@query("roc_auc", f"SELECT l_returnflag, {r(AUC)} AS roc_auc FROM h_line GROUP BY l_returnflag", needs=("h_line",))
def roc_auc(spark, sf):
    return rounded(evaluate.roc_auc(line_scores(spark, sf), ["l_returnflag"]), "roc_auc")


@query("pr_auc", f"SELECT version, model, {r(AP)} AS pr_auc FROM h_group GROUP BY version, model", needs=("h_group",))
def pr_auc(spark, sf):
    return rounded(evaluate.pr_auc(fx.scored(spark, sf), ["version", "model"]), "pr_auc")


RATE_SQL = {
    "Accuracy": div("tp + tn", "tp + fp + fn + tn"), "Recall": div("tp", "tp + fn"), "Precision": div("tp", "tp + fp"),
    "F1": div("2 * tp", "2 * tp + fp + fn"), "F2": div("5 * tp", "5 * tp + 4 * fn + fp"),
    "Balanced_Accuracy": f"({div('tp', 'tp + fn')} + {div('tn', 'tn + fp')}) / 2", "Specificity": div("tn", "tn + fp"),
    "Predicted_Positive_Rate": div("tp + fp", "tp + fp + fn + tn"), "FN_Rate": div("fn", "tp + fn"),
}


def counts_sql(src: str, by: str, threshold: float) -> str:
    t = f"{threshold!r}::DOUBLE"
    return f"""SELECT {by}, count(*) AS n, sum(y_true) AS n_pos, count(*) FILTER (WHERE y_true = 1 AND y_proba >= {t}) AS tp, count(*) FILTER (WHERE y_true = 0 AND y_proba >= {t}) AS fp,
 count(*) FILTER (WHERE y_true = 1 AND y_proba < {t}) AS fn, count(*) FILTER (WHERE y_true = 0 AND y_proba < {t}) AS tn, avg((y_proba - y_true) * (y_proba - y_true)) AS brier FROM {src} GROUP BY {by}"""


@query(
    "classification_metrics",
    f"""
WITH c AS ({counts_sql('scored_v', 'version, model', 0.3)}), a AS (SELECT version, model, {AUC} AS auc, {AP} AS ap FROM h_group GROUP BY version, model)
SELECT c.version, c.model, {', '.join(f'{r(e)} AS "{m}"' for m, e in RATE_SQL.items())}, {r('auc')} AS "ROC_AUC", {r('ap')} AS "PR_AUC", {r('brier')} AS "Brier", 0.3::DOUBLE AS "Threshold"
FROM c JOIN a ON a.version = c.version AND a.model = c.model""",
    needs=("scored_v", "h_group"),
)
def classification_metrics(spark, sf):
    out = evaluate.classification_metrics(fx.scored(spark, sf), 0.3, ["version", "model"])
    return rounded(out, *[m for m in evaluate.METRICS if m != "Threshold"])


GRID_VALUES = ", ".join(f"({i}, {g!r}::DOUBLE)" for i, g in enumerate(evaluate.GRID))
block(
    "sweep_v",
    f"""SELECT version, i, t, tp, fp, fn, tn, {', '.join(f'{e} AS "{m}"' for m, e in RATE_SQL.items())} FROM (
  SELECT version, i, t, count(*) FILTER (WHERE y_true = 1 AND y_proba >= t) AS tp, count(*) FILTER (WHERE y_true = 0 AND y_proba >= t) AS fp,
   count(*) FILTER (WHERE y_true = 1 AND y_proba < t) AS fn, count(*) FILTER (WHERE y_true = 0 AND y_proba < t) AS tn
  FROM scored_v CROSS JOIN (VALUES {GRID_VALUES}) AS g(i, t) GROUP BY version, i, t)""",
    ("scored_v",),
)


def best_sql(mode: str, score: str, where: str = "true") -> str:
    return f"SELECT version, '{mode}' AS mode, arg_max(t, ({score}, -i)) AS threshold, {r(f'max({score})')} AS best_score FROM sweep_v WHERE {where} GROUP BY version"


@query(
    "threshold_sweep",
    " UNION ALL ".join(
        [
            best_sql("f1", '"F1"'), best_sql("f2", '"F2"'), best_sql("balanced_accuracy", '"Balanced_Accuracy"'),
            best_sql("recall_085", '"Precision"', '"Recall" >= 0.85'), best_sql("recall_2", '"Recall"'),
        ]
    ),
    needs=("sweep_v",),
)
def threshold_sweep(spark, sf):
    """All selection modes share one sweep table; a recall of 2 cannot be met and falls back."""
    table = evaluate.threshold_table(fx.scored(spark, sf), ["version"])
    modes = {m: {"metric": m} for m in ("f1", "f2", "balanced_accuracy")}
    modes |= {
        "recall_085": {"optimize_for": "recall_constraint", "recall_min": 0.85},
        "recall_2": {"optimize_for": "recall_constraint", "recall_min": 2.0},
    }
    out = None
    for mode, how in modes.items():
        part = evaluate.pick_threshold(table, ["version"], **how).withColumn("mode", F.lit(mode))
        out = part if out is None else out.unionByName(part)
    return rounded(out, "best_score")


@query(
    "threshold_sweep_prevalence",
    best_sql("window", '"F2"', '"Predicted_Positive_Rate" BETWEEN 0.2 AND 0.4') + " UNION ALL " + best_sql("none", '"F2"'),
    needs=("sweep_v",),
)
def threshold_sweep_prevalence(spark, sf):
    table = evaluate.threshold_table(fx.scored(spark, sf), ["version"])
    windowed = evaluate.pick_threshold(table, ["version"], window=(0.2, 0.4)).withColumn("mode", F.lit("window"))
    nothing = evaluate.pick_threshold(table, ["version"], window=(0.999, 1.0)).withColumn("mode", F.lit("none"))
    return rounded(windowed.unionByName(nothing), "best_score")


UNIFORM_BIN = " + ".join(f"({i * 0.1!r}::DOUBLE < y_proba)::INTEGER" for i in range(1, 10))
block(
    "curve_v",
    f"""SELECT model, {UNIFORM_BIN} AS bin, count(*) AS n, avg(y_true) AS fraction_positive, avg(y_proba) AS mean_predicted,
 sum((y_proba - y_true) * (y_proba - y_true)) AS sq FROM scored_v GROUP BY 1, 2""",
    ("scored_v",),
)
QUANT_BIN = " + ".join(f"(q[{i}] < y_proba)::INTEGER" for i in range(1, 10))


@query(
    "calibration_curve",
    f"""
WITH e AS (SELECT model, quantile_cont(y_proba, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM scored_v GROUP BY model)
SELECT 'uniform' AS strategy, model, bin, n, {r('fraction_positive')} AS fraction_positive, {r('mean_predicted')} AS mean_predicted FROM curve_v
UNION ALL SELECT 'quantile', s.model, {QUANT_BIN} AS bin, count(*), {r('avg(y_true)')}, {r('avg(y_proba)')} FROM scored_v s JOIN e ON e.model = s.model GROUP BY 1, 2, 3""",
    needs=("curve_v",),
)
def calibration_curve(spark, sf):
    parts = [
        evaluate.calibration_curve(fx.scored(spark, sf), ["model"], strategy=s).withColumn("strategy", F.lit(s)).drop("_sq")
        for s in ("uniform", "quantile")
    ]
    return rounded(parts[0].unionByName(parts[1]), "fraction_positive", "mean_predicted")


CAL = "ece mce brier".split()


@query(
    "calibration_compare",
    f"""SELECT model, {r('sum(abs(fraction_positive - mean_predicted) * n) / sum(n)')} AS ece, {r('max(abs(fraction_positive - mean_predicted))')} AS mce, {r('sum(sq) / sum(n)')} AS brier,
 count(*) FILTER (WHERE mean_predicted > fraction_positive) AS overconfident_bins, count(*) FILTER (WHERE mean_predicted < fraction_positive) AS underconfident_bins FROM curve_v GROUP BY model""",
    needs=("curve_v",),
)
def calibration_compare(spark, sf):
    return rounded(evaluate.calibration_compare(fx.scored(spark, sf)), *CAL)


@query(
    "roc_pr_points",
    f"SELECT version, s AS threshold, {r(div('fp', 'tot_neg'))} AS fpr, {r(div('tp', 'tot_pos'))} AS tpr, {r(div('tp', 'tp + fp'))} AS precision, {r(div('tp', 'tot_pos'))} AS recall FROM h_version",
    needs=("h_version",),
)
def roc_pr_points(spark, sf):
    return rounded(evaluate.roc_pr_points(fx.scored(spark, sf), ["version"]), "fpr", "tpr", "precision", "recall")


@query(
    "confusion_counts",
    """SELECT t AS y_true, p AS y_pred, count(c.row_key) AS n FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS g(t, p)
LEFT JOIN cases_v c ON c.y_true = t AND c.y_pred = p GROUP BY t, p""",
    needs=("cases_v",),
)
def confusion_counts(spark, sf):
    return evaluate.confusion_counts(with_pred(fx.scored(spark, sf)))


AGE = "CASE WHEN \"Edad\" BETWEEN 18 AND 40 THEN '18-40' WHEN \"Edad\" <= 60 THEN '40-60' WHEN \"Edad\" <= 75 THEN '60-75' WHEN \"Edad\" <= 120 THEN '75-120' END"
block(
    "member_v",
    f"""SELECT 'group_type' AS variable, group_type AS subgroup, y_true, y_proba FROM scored_v
UNION ALL SELECT 'edad', {AGE}, y_true, y_proba FROM scored_v UNION ALL SELECT 'severity', CAST(severity AS VARCHAR), y_true, y_proba FROM scored_v
UNION ALL SELECT 'rare', CASE WHEN row_key < 15 THEN 'few' WHEN row_key < 40 THEN 'some' END, y_true, y_proba FROM scored_v WHERE row_key < 40""",
    ("scored_v",),
)
auc_block("h_member", "member_v", "variable, subgroup")


def member_groups():
    return {
        "group_type": col("group_type"),
        "edad": rank.fixed_bins("Edad"),
        "severity": col("severity"),
        "rare": F.when(col("row_key") < 15, "few").when(col("row_key") < 40, "some"),
    }


@query(
    "subgroup_errors",
    f"""
WITH c AS ({counts_sql('member_v', 'variable, subgroup', 0.4)}), a AS (SELECT variable, subgroup, {AUC} AS auc FROM h_member GROUP BY 1, 2)
SELECT c.variable, c.subgroup, c.n, n_pos::BIGINT AS n_pos, {r('n_pos::DOUBLE / n')} AS prevalence, {r('auc')} AS roc_auc,
 {r('CASE WHEN n_pos > 0 AND n_pos < n THEN fn::DOUBLE / n_pos END')} AS fn_rate, {r('CASE WHEN n_pos > 0 AND n_pos < n THEN fp::DOUBLE / (n - n_pos) END')} AS fp_rate
FROM c JOIN a ON a.variable = c.variable AND a.subgroup = c.subgroup WHERE n >= 20""",
    needs=("h_member",),
)
def subgroup_errors(spark, sf):
    out = evaluate.subgroup_errors(fx.scored(spark, sf), member_groups(), 0.4)
    return rounded(out, "prevalence", "roc_auc", "fn_rate", "fp_rate")


block(
    "sub_member_v",
    """SELECT 'edad' AS variable, CASE WHEN "Edad" <= 65 THEN 'leq_65' ELSE 'gt_65' END AS subgroup, y_true, y_proba FROM scored_v
UNION ALL SELECT 'severidad', CASE WHEN severity <= (SELECT quantile_cont(severity, 0.5) FROM scored_v) THEN 'baja' ELSE 'alta' END, y_true, y_proba FROM scored_v
UNION ALL SELECT 'tipo', group_type, y_true, y_proba FROM scored_v""",
    ("scored_v",),
)
auc_block("h_sub", "sub_member_v", "variable, subgroup")
SUB = ["F2", "Recall", "Precision", "Balanced_Accuracy"]


@query(
    "subgroup_metrics",
    f"""
WITH c AS ({counts_sql('sub_member_v', 'variable, subgroup', 0.4)}), a AS (SELECT variable, subgroup, {AUC} AS auc FROM h_sub GROUP BY 1, 2)
SELECT c.variable, c.subgroup, c.n, n_pos::BIGINT AS n_pos, {r('n_pos::DOUBLE / n')} AS prevalence, {r('auc')} AS "ROC_AUC", {', '.join(f'{r(RATE_SQL[m])} AS "{m}"' for m in SUB)}
FROM c JOIN a ON a.variable = c.variable AND a.subgroup = c.subgroup""",
    needs=("h_sub",),
)
def subgroup_metrics(spark, sf):
    df = fx.scored(spark, sf)
    # severity has six values, so the built-in percentile keeps six counters
    median = df.agg(F.percentile("severity", F.lit(0.5)).alias("m")).scalar()
    df = df.withColumn("sev", F.when(col("severity") <= median, "baja").otherwise("alta"))
    groups = {
        "edad": F.when(col("Edad") <= 65, "leq_65").otherwise("gt_65"),
        "severidad": col("sev"),
        "tipo": col("group_type"),
    }
    return rounded(evaluate.subgroup_metrics(df, groups, 0.4), "prevalence", "ROC_AUC", *SUB)


block(
    "bench_v",
    f"SELECT version, model, {AUC} AS auc, {AP} AS f2 FROM h_group GROUP BY version, model",
    ("h_group",),
)


@query(
    "final_ranking",
    f"""
WITH b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY version ORDER BY auc DESC, f2 DESC, model) AS rn FROM bench_v) WHERE rn = 1),
st AS (SELECT version, avg(feat_b) / 100 AS stab FROM scored_v WHERE version <> 'v2' GROUP BY version),
cal AS (SELECT version, 1 - avg(e) AS c FROM (SELECT version, abs(avg(y_true) - avg(y_proba)) AS e FROM scored_v WHERE version <> 'v1' GROUP BY version) GROUP BY version),
m AS (SELECT b.version, auc, f2, coalesce(stab, 0) AS stab, coalesce(c, 0.5) AS cal, (auc - min(auc) OVER ()) / (max(auc) OVER () - min(auc) OVER ()) AS an,
  (f2 - min(f2) OVER ()) / (max(f2) OVER () - min(f2) OVER ()) AS fn FROM b LEFT JOIN st ON st.version = b.version LEFT JOIN cal ON cal.version = b.version)
SELECT version, {r('auc')} AS roc_auc_test, {r('f2')} AS f2_test, {r('auc')} AS roc_auc_cv, {r('f2')} AS f2_cv, {r('stab')} AS stability_score, {r('cal')} AS calibration_score,
 {r('an')} AS roc_auc_norm, {r('fn')} AS f2_norm, {r('0.35 * an + 0.35 * fn + 0.2 * stab + 0.1 * cal')} AS score_final,
 row_number() OVER (ORDER BY 0.35 * an + 0.35 * fn + 0.2 * stab + 0.1 * cal DESC, version)::INTEGER AS rank FROM m""",
    needs=("bench_v", "scored_v"),
)
def final_ranking(spark, sf):
    df = fx.scored(spark, sf)
    by = ["version", "model"]
    table = evaluate.roc_auc(df, by).join(evaluate.pr_auc(df, by), by).withColumnsRenamed({"roc_auc": "ROC_AUC", "pr_auc": "F2"})
    stab = df.where("version <> 'v2'").groupBy("version").agg((F.avg("feat_b") / 100).alias("stability_score"))
    cal = df.where("version <> 'v1'").groupBy("version").agg(F.abs(F.avg("y_true") - F.avg("y_proba")).alias("ece"))
    out = evaluate.final_ranking(table, table, stab, cal)
    return rounded(out, *[c for c in out.columns if c not in ("version", "rank")])


# ---- attributions -----------------------------------------------------------------------------
BETAS = {"feat_a": 0.02, "feat_b": -0.01, "feat_c": 0.3}
block("means_v", "SELECT " + ", ".join(f"avg({f}) AS {f}" for f in BETAS) + " FROM scored_v", ("scored_v",))
block(
    "attr_v",
    " UNION ALL ".join(
        f"SELECT row_key, '{f}' AS feature, s.{f} AS value, {b} * (s.{f} - m.{f}) AS contribution FROM scored_v s, means_v m" for f, b in BETAS.items()
    ),
    ("scored_v", "means_v"),
)
BASE = " + ".join(f"{b} * {f}" for f, b in BETAS.items())


def attributions(spark, sf):
    return explain.linear_attributions(fx.scored(spark, sf), "row_key", BETAS, -1.5)


@query(
    "shap_linear",
    f"SELECT row_key, feature, value, {r('contribution')} AS contribution, {r(f'(SELECT -1.5 + {BASE} FROM means_v)')} AS base_value FROM attr_v",
    needs=("attr_v",),
)
def shap_linear(spark, sf):
    return rounded(attributions(spark, sf), "contribution", "base_value")


@query(
    "shap_top_n",
    f"SELECT row_key, feature, value, {r('contribution')} AS contribution, rank FROM (SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY abs({r('contribution')}) DESC, feature)::INTEGER AS rank FROM attr_v) WHERE rank <= 2",
    needs=("attr_v",),
)
def shap_top_n(spark, sf):
    rows = rounded(attributions(spark, sf), "contribution")
    return explain.top_contributions(rows, "row_key", 2).select("row_key", "feature", "value", "contribution", "rank")


def mean_case(case: str) -> str:
    return f"coalesce(avg(contribution) FILTER (WHERE case_type = '{case}'), 0)"


block(
    "profile_v",
    "SELECT feature, "
    + ", ".join(f"{mean_case(c)} AS shap_{c.lower()}, count(*) FILTER (WHERE case_type = '{c}') AS n_{c.lower()}" for c in explain.CASES)
    + f", {mean_case('TP')} - {mean_case('FN')} AS delta_tp_fn FROM attr_v a JOIN cases_v c ON c.row_key = a.row_key GROUP BY feature",
    ("attr_v", "cases_v"),
)


def profiles(spark, sf):
    cases = with_pred(fx.scored(spark, sf)).select("row_key", "y_true", "y_pred")
    return explain.group_profiles(attributions(spark, sf), cases, "row_key")


SHAPS = [f"shap_{c.lower()}" for c in explain.CASES]


@query(
    "shap_group_profiles",
    "SELECT feature, " + ", ".join(f"{r(s)} AS {s}, {s.replace('shap', 'n')}" for s in SHAPS)
    + f", {r('delta_tp_fn')} AS delta_tp_fn, {r('abs(delta_tp_fn)')} AS abs_delta FROM profile_v",
    needs=("profile_v",),
)
def shap_group_profiles(spark, sf):
    return rounded(profiles(spark, sf), *SHAPS, "delta_tp_fn", "abs_delta")


F3 = "format('{{:.3f}}', {0})"


@query(
    "fn_insight",
    f"""
SELECT feature, {r('shap_tp')} AS shap_tp, {r('shap_fn')} AS shap_fn, {r('delta_tp_fn')} AS delta_tp_fn,
 CASE WHEN delta_tp_fn > 0 AND shap_fn < 0 THEN 'Protege al FN (baja riesgo −' || {F3.format('abs(shap_fn)')} || '), eleva al TP (+' || {F3.format('shap_tp')} || ')'
  WHEN delta_tp_fn > 0 THEN 'Señal débil en FN (+' || {F3.format('shap_fn')} || ') vs fuerte en TP (+' || {F3.format('shap_tp')} || ')'
  WHEN shap_tp < 0 THEN 'Protege más al TP que al FN — FN tiene más riesgo aquí'
  ELSE 'FN tiene mayor señal positiva (+' || {F3.format('shap_fn')} || ') — el modelo la ve pero no alcanza' END AS interpretacion FROM profile_v""",
    needs=("profile_v",),
)
def fn_insight(spark, sf):
    return rounded(explain.fn_insight(profiles(spark, sf)), "shap_tp", "shap_fn", "delta_tp_fn")


@query(
    "fn_ranked",
    "SELECT row_key, y_proba, version FROM cases_v WHERE case_type = 'FN' ORDER BY y_proba DESC, row_key LIMIT 50",
    needs=("cases_v",),
)
def fn_ranked(spark, sf):
    return explain.fn_ranked(with_pred(fx.scored(spark, sf)), "row_key", 50).select("row_key", "y_proba", "version")


@query(
    "clinical_review",
    f"""
WITH b AS (SELECT version, arg_min(model, (-auc, model)) AS model FROM bench_v GROUP BY version),
c AS (SELECT c.* FROM cases_v c JOIN b ON b.version = c.version AND b.model = c.model)
SELECT version, row_key, case_type, y_true, y_pred, y_proba, {REASON} AS reason FROM (SELECT *, row_number() OVER (PARTITION BY version, case_type
  ORDER BY CASE WHEN case_type IN ('FN', 'TP') THEN -y_proba ELSE y_proba END, row_key) AS rn FROM c) WHERE rn <= 10""",
    needs=("bench_v", "cases_v"),
)
def clinical_review(spark, sf):
    """Cases of the best model of each version."""
    df = fx.scored(spark, sf)
    auc = evaluate.roc_auc(df, ["version", "model"])
    best = rank.best_per_group(auc, ["version"], [F.desc("roc_auc"), F.asc("model")]).select("version", "model")
    mine = with_pred(df).join(best, ["version", "model"], "left_semi")
    return rank.case_review(mine, "row_key", ["feat_a", "feat_b", "feat_c"], by=["version"])


@query(
    "risk_band",
    """SELECT row_key, y_proba, CASE WHEN y_proba >= 0.3 * 1.5 THEN 'high' WHEN y_proba >= 0.3 THEN 'elevated' WHEN y_proba >= 0.3 * 0.5 THEN 'moderate' ELSE 'low' END AS band FROM scored_v""",
    needs=("scored_v",),
)
def risk_band(spark, sf):
    from cohortloom.operators.learn import risk_band as band

    return fx.scored(spark, sf).select("row_key", "y_proba", band("y_proba", 0.3).alias("band"))
