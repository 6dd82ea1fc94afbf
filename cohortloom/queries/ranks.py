"""Windows, ranking, binning."""
from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom import fixtures as fx
from cohortloom.functions.numeric import round_half_up as r6
from cohortloom.operators import rank
from cohortloom.queries.base import block, query, r
from cohortloom.queries.profiles import rounded

block(
    "model_m",
    "SELECT version, model, avg((y_proba - y_true) * (y_proba - y_true)) AS brier, avg(y_proba) AS score, count(*) AS n FROM scored_v GROUP BY version, model",
    ("scored_v",),
)


def model_metrics(spark, sf):
    error = F.col("y_proba") - F.col("y_true")
    return fx.scored(spark, sf).groupBy("version", "model").agg(
        F.avg(error * error).alias("brier"), F.avg("y_proba").alias("score"), F.count(F.lit(1)).alias("n")
    )


@query(
    "best_per_group",
    f"SELECT version, model, {r('brier')} AS brier FROM (SELECT *, row_number() OVER (PARTITION BY version ORDER BY brier, model) AS rn FROM model_m) WHERE rn = 1",
    needs=("model_m",),
)
def best_per_group(spark, sf):
    best = rank.best_per_group(model_metrics(spark, sf), ["version"], [F.asc("brier"), F.asc("model")])
    return best.select("version", "model", r6("brier").alias("brier"))


REASON = " || ' | ' || ".join(f"'{f}=' || coalesce(CAST(round({f}, 4) AS VARCHAR), 'NA')" for f in ("feat_a", "feat_b", "feat_c"))
CASE_SQL = "CASE WHEN y_true = 1 AND y_pred = 1 THEN 'TP' WHEN y_true = 0 AND y_pred = 0 THEN 'TN' WHEN y_true = 1 THEN 'FN' ELSE 'FP' END"
block("cases_v", f"SELECT *, {CASE_SQL} AS case_type FROM (SELECT *, (y_proba >= 0.5)::INTEGER AS y_pred FROM scored_v)", ("scored_v",))


def with_pred(df, threshold: float = 0.5):
    return df.withColumn("y_pred", (F.col("y_proba") >= threshold).cast("int"))


@query(
    "case_review",
    f"""
SELECT row_key, case_type, y_true, y_pred, y_proba, {REASON} AS reason
FROM (SELECT *, row_number() OVER (PARTITION BY case_type ORDER BY CASE WHEN case_type IN ('FN', 'TP') THEN -y_proba ELSE y_proba END, row_key) AS rn FROM cases_v) WHERE rn <= 10""",
    needs=("cases_v",),
)
def case_review(spark, sf):
    return rank.case_review(with_pred(fx.scored(spark, sf)), "row_key", ["feat_a", "feat_b", "feat_c"])


block(
    "linkage_like",
    "SELECT version, model AS post_variable, group_type || '_' || severity AS feature, avg(y_true) / 10 AS mi, abs(corr(y_proba, feat_a)) AS abs_pearson FROM scored_v GROUP BY 1, 2, 3",
    ("scored_v",),
)


@query(
    "top3_per_group",
    f"""
SELECT version, post_variable, {r('max(mi)')} AS max_mi, {r('max(abs_pearson)')} AS max_abs_pearson, count(*) FILTER (WHERE mi > 0.03) AS n_informative,
  string_agg(feature, ' | ' ORDER BY rn) FILTER (WHERE rn <= 3) AS top3
FROM (SELECT *, row_number() OVER (PARTITION BY version, post_variable ORDER BY mi DESC, feature) AS rn FROM linkage_like) GROUP BY version, post_variable""",
    needs=("linkage_like",),
)
def top3_per_group(spark, sf):
    link = fx.scored(spark, sf).groupBy(
        "version", F.col("model").alias("post_variable"), F.concat_ws("_", "group_type", "severity").alias("feature")
    ).agg((F.avg("y_true") / 10).alias("mi"), F.abs(F.corr("y_proba", "feat_a")).alias("abs_pearson"))
    return rounded(rank.linkage_summary(link, 0.03), "max_mi", "max_abs_pearson")


@query(
    "rank_column",
    f"SELECT version, model, {r('score')} AS score, row_number() OVER (ORDER BY score DESC, version, model)::INTEGER AS rank FROM model_m",
    needs=("model_m",),
)
def rank_column(spark, sf):
    ranked = rank.rank_rows(model_metrics(spark, sf), [F.desc("score"), F.asc("version"), F.asc("model")])
    return ranked.select("version", "model", r6("score").alias("score"), "rank")


@query(
    "minmax_normalise",
    f"""SELECT version, model, {r('(brier - (SELECT min(brier) FROM model_m)) / (SELECT max(brier) - min(brier) FROM model_m)')} AS brier_norm,
 0.5::DOUBLE AS flat_norm FROM model_m""",
    needs=("model_m",),
)
def minmax_normalise(spark, sf):
    df = model_metrics(spark, sf).withColumn("flat", F.lit(1.0))
    df = rank.minmax_normalise(df, "brier", "brier_norm")
    df = rank.minmax_normalise(df, "flat", "flat_norm", constant=0.5)
    return df.select("version", "model", r6("brier_norm").alias("brier_norm"), r6("flat_norm").alias("flat_norm"))


@query(
    "quartile_bins",
    """
WITH e AS (SELECT quantile_cont(feat_b, 0.25) AS q1, quantile_cont(feat_b, 0.5) AS q2, quantile_cont(feat_b, 0.75) AS q3 FROM scored_v)
SELECT row_key, feat_b, CASE WHEN feat_b <= q1 THEN 1 WHEN feat_b <= q2 THEN 2 WHEN feat_b <= q3 THEN 3 ELSE 4 END AS bin FROM scored_v, e""",
    needs=("scored_v",),
)
def quartile_bins(spark, sf):
    return rank.quartile_bins(fx.scored(spark, sf).select("row_key", "feat_b"), "feat_b", "bin")


@query(
    "fixed_bins",
    """SELECT k, CASE WHEN "Edad" BETWEEN 18 AND 40 THEN '18-40' WHEN "Edad" > 40 AND "Edad" <= 60 THEN '40-60'
 WHEN "Edad" > 60 AND "Edad" <= 75 THEN '60-75' WHEN "Edad" > 75 AND "Edad" <= 120 THEN '75-120' END AS band FROM preop_v""",
    needs=("preop_v",),
)
def fixed_bins(spark, sf):
    return fx.preop(spark, sf).select("k", rank.fixed_bins("Edad").alias("band"))


@query(
    "sort_top_n",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_suppkey, l_linenumber LIMIT 100",
)
def sort_top_n(spark, sf):
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    df = fx.table(spark, sf, "lineitem").select(*keys, "l_extendedprice")
    return rank.sort_top_n(df, [F.desc("l_extendedprice"), *[F.asc(k) for k in keys]], 100)
