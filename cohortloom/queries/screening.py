"""Feature screening, sampling and outlier queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom import fixtures as fx
from cohortloom.functions.numeric import col, round_half_up as r6
from cohortloom.operators import joins, rank, sample, screen, unsup
from cohortloom.operators.learn import Spec
from cohortloom.plans import flags, target
from cohortloom.queries.base import block, q, query, r
from cohortloom.queries.profiles import hash_sql, rounded
from cohortloom.queries.targets import VERSION_SQL, override
from cohortloom.sources.tables import KEY, KEY_ALIAS


# ---- column screening -----------------------------------------------------------------------
NUMBER_RX = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def counts_sql(feature: str, e: str) -> str:
    """column_counts() of one expression for DuckDB."""
    x = f"CASE WHEN regexp_matches(({e})::VARCHAR, '{NUMBER_RX}') THEN TRY_CAST(trim(({e})::VARCHAR) AS DOUBLE) END"
    return (
        f"SELECT '{feature}' AS feature, count(*) AS n, count({e}) AS n_values, count({x}) AS n_numbers, "
        f"coalesce(min({e}) < max({e}), false) AS varied, coalesce(min({x}) < max({x}), false) AS varied_numbers FROM preop_v"
    )


SCREENED = {"k": "k", "Edad": '"Edad"', "Temperatura": '"Temperatura"', "Puntaje Mallampati": '"Puntaje Mallampati"', "Sexo": '"Sexo"', "Hora": '"Hora"', "constante": "1"}


@query(
    "candidate_features",
    "SELECT *, n > 0 AND n_numbers >= 0.4 * n AND varied_numbers AS candidate FROM (" + " UNION ALL ".join(counts_sql(f, e) for f, e in SCREENED.items()) + ")",
    needs=("preop_v",),
)
def candidate_features(spark, sf):
    """The sex text is no number, the hour text neither, the constant has one value; keys, flags and
    the target are no columns to screen."""
    df = fx.preop(spark, sf).select("k", KEY, "Edad", "Temperatura", "Puntaje Mallampati", "Sexo", "Hora")
    df = df.withColumns({"constante": F.lit(1), "flag_x": col("k") % 2, "target": col("k") % 3})
    return screen.screened_columns(df)


@query(
    "drop_constant",
    "SELECT feature, n, n_values, CASE WHEN varied THEN 'kept' ELSE 'constant' END AS status FROM ("
    + " UNION ALL ".join(counts_sql(f, e) for f, e in {"Edad": '"Edad"', "Hora": '"Hora"', "uno": "CASE WHEN k % 2 = 0 THEN 1 END"}.items())
    + ")",
    needs=("preop_v",),
)
def drop_constant(spark, sf):
    df = fx.preop(spark, sf).select("k", "Edad", "Hora").withColumn("uno", F.when(col("k") % 2 == 0, 1))
    counts = screen.column_counts(df, ["Edad", "Hora", "uno"])
    return counts.select("feature", "n", "n_values", F.when(F.col("varied"), "kept").otherwise("constant").alias("status"))


# ---- mutual information and correlation -----------------------------------------------------
FEATS = ["feat_a", "feat_b", "feat_c", "Edad", "severity"]


def long_sql(src: str, feats, extra: str) -> str:
    return " UNION ALL ".join(f"SELECT '{f}' AS feature, coalesce({q(f)}, -1)::DOUBLE AS value, {extra} FROM {src}" for f in feats)


PROBS = "[" + ", ".join(f"{i / 32!r}" for i in range(1, 32)) + "]"


def mi_blocks(tag: str, long: str, needs, outcomes) -> None:
    """DuckDB: binned contingency and mutual information of (feature, value, outcomes...)."""
    block(f"{tag}_long", long, needs)
    block(
        f"{tag}_edges",
        f"""SELECT feature, CASE WHEN count(DISTINCT value) <= 32 THEN list_sort(list(DISTINCT value)) ELSE list_distinct(quantile_cont(value, {PROBS})) END AS edges FROM {tag}_long GROUP BY feature""",
        (f"{tag}_long",),
    )
    sums = ", ".join(f"sum({o}) AS {o}" for o in outcomes)
    block(
        f"{tag}_bins",
        f"""SELECT l.feature, len(list_filter(edges, lambda e: e < value)) AS bin, count(*) AS n, {sums} FROM {tag}_long l JOIN {tag}_edges e ON e.feature = l.feature GROUP BY 1, 2""",
        (f"{tag}_edges",),
    )
    block(
        f"{tag}_cells",
        " UNION ALL ".join(f"SELECT feature, bin, n, '{o}' AS outcome, {o} AS pos FROM {tag}_bins" for o in outcomes),
        (f"{tag}_bins",),
    )
    block(
        f"{tag}_mi",
        f"""SELECT feature, outcome, greatest(sum(CASE WHEN pos > 0 THEN pos / tot * ln(pos * tot / (n * p)) ELSE 0 END + CASE WHEN n - pos > 0 THEN (n - pos) / tot * ln((n - pos) * tot / (n * (tot - p))) ELSE 0 END), 0) AS mi
 FROM (SELECT feature, outcome, n::DOUBLE AS n, pos::DOUBLE AS pos, sum(n) OVER (PARTITION BY feature, outcome)::DOUBLE AS tot, sum(pos) OVER (PARTITION BY feature, outcome)::DOUBLE AS p FROM {tag}_cells) GROUP BY feature, outcome""",
        (f"{tag}_cells",),
    )


mi_blocks("sc", long_sql("scored_v", FEATS, "y_true"), ("scored_v",), ["y_true"])


def knn_blocks(tag: str, long: str, needs, k: int) -> None:
    """DuckDB: mutual information by nearest neighbours of (feature, value, y)."""
    psi = lambda n: f"(ln({n} + 8) - 0.5 / ({n} + 8) - 1 / (12 * ({n} + 8) ** 2) + 1 / (120 * ({n} + 8) ** 4) - 1 / (252 * ({n} + 8) ** 6) - (" + " + ".join(f"1 / ({n} + {i})" for i in range(8)) + "))"
    block(f"{tag}_kc", f"SELECT feature, y, value, count(*) AS n, sum(count(*)) OVER (PARTITION BY feature, y)::BIGINT AS size FROM ({long}) GROUP BY 1, 2, 3 QUALIFY size > 1", needs)
    moves = ", ".join(
        f"list_resize([]::DOUBLE[], least({k}, coalesce({m}(n, {i}) OVER w, 0)), abs(value - {m}(value, {i}) OVER w))" for i in range(1, k + 1) for m in ("lag", "lead")
    )
    block(
        f"{tag}_kr",
        f"SELECT feature, y, value, n, size, list_sort(flatten([list_resize([]::DOUBLE[], least({k}, n - 1), 0.0), {moves}]))[least({k}, size - 1)] AS radius FROM {tag}_kc WINDOW w AS (PARTITION BY feature, y ORDER BY value)",
        (f"{tag}_kc",),
    )
    block(f"{tag}_kv", f"SELECT feature, value, sum(n) AS n FROM {tag}_kc GROUP BY 1, 2", (f"{tag}_kc",))
    inside = "greatest(radius - 1e-12 * (abs(r.value) + radius), 0)"
    block(
        f"{tag}_km",
        f"SELECT r.feature, r.y, r.value, any_value(r.n)::DOUBLE AS n, any_value(size)::DOUBLE AS size, sum(v.n)::DOUBLE AS m, any_value({inside}) > 0 AS smooth FROM {tag}_kr r JOIN {tag}_kv v ON v.feature = r.feature AND v.value >= r.value - {inside} AND v.value <= r.value + {inside} GROUP BY 1, 2, 3",
        (f"{tag}_kr", f"{tag}_kv"),
    )
    smooth = f"{psi('total')} + {psi(f'least({k}, size - 1)')} - {psi('size')} - {psi('m')}"
    block(
        f"{tag}_knn",
        f"SELECT feature, greatest(sum(n * CASE WHEN smooth THEN {smooth} ELSE ln(total) + ln(n) - ln(size) - ln(m) END) / sum(n), 0) AS mi FROM (SELECT *, (sum(n) OVER (PARTITION BY feature))::DOUBLE AS total FROM {tag}_km) GROUP BY feature",
        (f"{tag}_km",),
    )


knn_blocks("sc", "SELECT feature, value, y_true AS y FROM sc_long WHERE y_true IS NOT NULL", ("sc_long",), 3)


@query("mutual_information", f"SELECT feature, {r('mi')} AS mi FROM sc_knn", needs=("sc_knn",))
def mutual_information(spark, sf):
    return rounded(screen.mutual_information(fx.scored(spark, sf), FEATS, "y_true"), "mi")


def r_sql(o: str) -> str:
    return f"CASE WHEN isfinite(coalesce(corr(value, {o}), 0)) THEN abs(coalesce(corr(value, {o}), 0)) ELSE 0 END"


@query(
    "pearson_linkage",
    f"""SELECT m.feature, {r('mi')} AS mi, {r('p')} AS abs_pearson, {r('0.7 * mi + 0.3 * p')} AS combined
FROM sc_mi m JOIN (SELECT feature, {r_sql('y_true')} AS p FROM sc_long GROUP BY feature) c ON c.feature = m.feature""",
    needs=("sc_mi",),
)
def pearson_linkage(spark, sf):
    out = screen.linkage(fx.scored(spark, sf), FEATS, ["y_true"])
    return rounded(out.drop("outcome"), "mi", "abs_pearson", "combined")


PRE_FEATS = ["Edad", "Talla (cm)", "IMC", "Puntaje Mallampati", "Frecuencia Respiratoria"]
# every version and every flag, in one cube
PP_VERSIONS = list(VERSION_SQL)
PP_OUT = [*flags.ALL_FLAGS, *PP_VERSIONS]
block(
    "ppa_merged",
    "SELECT " + ", ".join(f'p."{f}"' for f in PRE_FEATS) + ", " + ", ".join(f"f.{x}" for x in flags.ALL_FLAGS) + ", "
    + ", ".join(f"{override(e)} AS {v}" for v, e in VERSION_SQL.items())
    + " FROM preop_v p JOIN flags_v f ON f.doc = p.\"Documento PMD\" WHERE p.\"Edad\" >= 18",
    ("preop_v", "flags_v"),
)
mi_blocks("ppa", long_sql("ppa_merged", PRE_FEATS, ", ".join(PP_OUT)), ("ppa_merged",), PP_OUT)


PP_SQL = f"""SELECT version, CASE WHEN m.outcome = version THEN 'target' ELSE m.outcome END AS post_variable, m.feature, {r('mi')} AS mi, {r('p')} AS abs_pearson, {r('0.7 * mi + 0.3 * p')} AS combined, {r('prev')} AS prevalence
FROM ppa_mi m JOIN ({' UNION ALL '.join(f"SELECT feature, '{o}' AS outcome, {r_sql(o)} AS p, avg({o}) AS prev FROM ppa_long GROUP BY feature" for o in PP_OUT)}) c ON c.feature = m.feature AND c.outcome = m.outcome
JOIN (VALUES {', '.join(f"('{v}')" for v in PP_VERSIONS)}) AS v(version) ON m.outcome = version OR m.outcome NOT IN ({', '.join(f"'{v}'" for v in PP_VERSIONS)})
WHERE prev > 0 AND prev < 1"""


@query("pre_post_linkage", PP_SQL, needs=("ppa_mi",))
@query("pre_post_linkage_all", PP_SQL, needs=("ppa_mi",))
def pre_post_linkage(spark, sf):
    pre = fx.preop(spark, sf).where("Edad >= 18").select(col(KEY), *[col(f) for f in PRE_FEATS])
    wide = joins.short_key(target.target_wide(fx.posop(spark, sf), KEY_ALIAS, keep=flags.ALL_FLAGS))
    out = screen.version_linkage(pre.join(wide, KEY), PRE_FEATS, flags.ALL_FLAGS, list(target.TARGETS))
    return rounded(out, "mi", "abs_pearson", "combined", "prevalence")


UNI = ["feat_a", "feat_b", "feat_c", "Edad"]
block("uni_long", " UNION ALL ".join(f"SELECT '{f}' AS feature, {q(f)}::DOUBLE AS value, y_true FROM scored_v" for f in UNI), ("scored_v",))


@query(
    "univariate_auc_mwu",
    f"""
WITH h AS (SELECT feature, value, sum(y_true) AS pos, sum(1 - y_true) AS neg FROM uni_long GROUP BY feature, value),
c AS (SELECT *, sum(neg) OVER (PARTITION BY feature ORDER BY value) AS cn, (pos + neg)::DOUBLE AS t FROM h),
s AS (SELECT feature, sum(neg)::DOUBLE AS n0, sum(pos)::DOUBLE AS n1, sum(pos * (cn - neg / 2.0)) AS u1, sum(t * t * t - t) AS ties, sum(neg * value) / sum(neg) AS mean0, sum(pos * value) / sum(pos) AS mean1 FROM c GROUP BY feature)
SELECT feature, n0::BIGINT AS n0, n1::BIGINT AS n1, {r('u1 / (n0 * n1)')} AS auc, {r('n0 * n1 - u1')} AS u, {r('mean0')} AS mean0, {r('mean1')} AS mean1,
 {r('z')} AS z, {r('((((1.061405429 * t - 1.453152027) * t + 1.421413741) * t - 0.284496736) * t + 0.254829592) * t * exp(-z * z / 2)', 4)} AS p_value
FROM (SELECT *, 1 / (1 + 0.3275911 * z / sqrt(2)) AS t FROM (SELECT *,
 greatest(abs(n0 * n1 / 2 - u1) - 0.5, 0) / sqrt(n0 * n1 / 12 * (n0 + n1 + 1 - ties / ((n0 + n1) * (n0 + n1 - 1)))) AS z FROM s))""",
    needs=("uni_long",),
)
def univariate_auc_mwu(spark, sf):
    out = screen.with_p_value(screen.univariate_tests(fx.scored(spark, sf), UNI, "y_true"))
    return rounded(out, "auc", "u", "mean0", "mean1", "z").withColumn("p_value", r6("p_value", 4))


# ---- sampling -------------------------------------------------------------------------------
def order_sql(key: str, label: str, salt: str, src: str) -> str:
    return f"""SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {hash_sql(key, salt, 42)}, {key}) AS rn, count(*) OVER (PARTITION BY {label}) AS nc FROM {src}"""


@query(
    "split_stratified",
    f"SELECT doc_id, quality, CASE WHEN rn <= floor(nc * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split FROM ({order_sql('doc_id', 'quality', 'split', 'labels')})",
)
def split_stratified(spark, sf):
    return sample.split_stratified(fx.table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "quality")


@query(
    "split_three_way",
    f"""SELECT row_key, y_true, CASE WHEN rn <= k THEN 'test' WHEN rn <= k + floor((nc - k) * 0.2 + 0.5) THEN 'val' ELSE 'train' END AS split
FROM (SELECT *, floor(nc * 0.2 + 0.5) AS k FROM ({order_sql('row_key', 'y_true', 'split', 'scored_v')}))""",
    needs=("scored_v",),
)
def split_three_way(spark, sf):
    return sample.split_three_way(fx.scored(spark, sf).select("row_key", "y_true"), "row_key", "y_true")


@query(
    "kfold_stratified",
    f"SELECT row_key, y_true, ((rn - 1) % 10)::INTEGER AS fold FROM ({order_sql('row_key', 'y_true', 'fold', 'scored_v')})",
    needs=("scored_v",),
)
def kfold_stratified(spark, sf):
    return sample.kfold_stratified(fx.scored(spark, sf).select("row_key", "y_true"), "row_key", "y_true", 10)


@query(
    "undersample_balance",
    f"SELECT row_key, y_true FROM (SELECT *, min(nc) OVER () AS k FROM ({order_sql('row_key', 'y_true', 'balance', 'scored_v')})) WHERE rn <= k",
    needs=("scored_v",),
)
def undersample_balance(spark, sf):
    return sample.undersample_balance(fx.scored(spark, sf).select("row_key", "y_true"), "row_key", "y_true")


@query(
    "class_weights",
    f"""SELECT y_true, count(*) AS n, {r('(SELECT count(*) FROM scored_v) / (2.0::DOUBLE * count(*))')} AS weight,
 {r('(SELECT (count(*) FILTER (WHERE y_true = 0))::DOUBLE / count(*) FILTER (WHERE y_true = 1) FROM scored_v)')} AS neg_pos_ratio FROM scored_v GROUP BY y_true""",
    needs=("scored_v",),
)
def class_weights(spark, sf):
    return rounded(sample.class_weights(fx.scored(spark, sf), "y_true"), "weight", "neg_pos_ratio")


# ---- outliers -------------------------------------------------------------------------------
LK = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
LINE_KEYS = ", ".join(LK)


def fence_sql(c: str, src: str) -> str:
    return f"(SELECT quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo, quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi FROM {src})"


block("scored_r", "SELECT event_id AS row_key, value, value * value AS x FROM events")


@query(
    "outlier_iqr",
    f"""
WITH f AS {fence_sql('value', 'scored_r')}, d AS (SELECT row_key, (value < lo OR value > hi)::INTEGER AS value_outlier, {r('least(greatest(value, lo), hi)')} AS clipped FROM scored_r, f),
k1 AS (SELECT row_key, x FROM scored_r, f WHERE value BETWEEN lo AND hi), f2 AS {fence_sql('x', 'k1')}, k2 AS (SELECT row_key FROM k1, f2 WHERE x BETWEEN lo AND hi)
SELECT d.*, (k2.row_key IS NOT NULL)::INTEGER AS kept FROM d LEFT JOIN k2 ON k2.row_key = d.row_key""",
    needs=("scored_r",),
)
def outlier_iqr(spark, sf):
    """Detect, clip and sequential removal on the event values."""
    df = fx.table(spark, sf, "events").select(
        F.col("event_id").alias("row_key"), "value", (F.col("value") * F.col("value")).alias("x")
    )
    marked = screen.outlier_iqr(df, ["value"]).select("row_key", "value_outlier")
    clipped = screen.outlier_iqr(df, ["value"], "clip").select("row_key", r6("value").alias("clipped"))
    kept = screen.outlier_iqr(df, ["value", "x"], "remove").select("row_key", F.lit(1).alias("kept"))
    return marked.join(clipped, "row_key").join(kept, "row_key", "left").na.fill(0, ["kept"])


@query(
    "outlier_zscore",
    f"""SELECT {LINE_KEYS}, l_extendedprice, (abs((l_extendedprice - m) / s) > 1.6)::INTEGER AS l_extendedprice_outlier, (abs((l_quantity - qm) / qs) > 1.6)::INTEGER AS l_quantity_outlier
FROM lineitem, (SELECT avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS s, avg(l_quantity) AS qm, stddev_pop(l_quantity) AS qs FROM lineitem)""",
)
def outlier_zscore(spark, sf):
    df = fx.table(spark, sf, "lineitem").select(*LK, "l_extendedprice", "l_quantity")
    return screen.outlier_zscore(df, ["l_extendedprice", "l_quantity"], 1.6).drop("l_quantity")


@query(
    "anomaly_contrast",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r(f'avg({q(c)}) FILTER (WHERE y_proba > 0.6)')} AS mean_1, {r(f'avg({q(c)}) FILTER (WHERE y_proba <= 0.6)')} AS mean_0, "
        f"{r(f'avg({q(c)}) FILTER (WHERE y_proba > 0.6) - avg({q(c)}) FILTER (WHERE y_proba <= 0.6)')} AS difference FROM scored_v"
        for c in FEATS
    ),
    needs=("scored_v",),
)
def anomaly_contrast(spark, sf):
    df = fx.scored(spark, sf).withColumn("anomaly", (F.col("y_proba") > 0.6).cast("int"))
    return rounded(screen.group_contrast(df, FEATS, "anomaly"), "mean_1", "mean_0", "difference")


# ---- learners for screening -------------------------------------------------------------------
IMPORTANCE = {"maxDepth": 12}


@query("rf_importance")
def rf_importance(spark, sf):
    return unsup.forest_importance(fx.scored(spark, sf), Spec("random_forest", tuple(FEATS), params=IMPORTANCE))


@query("feature_ranking")
def feature_ranking(spark, sf):
    ranked, _ = unsup.feature_ranking(fx.scored(spark, sf), Spec("random_forest", tuple(FEATS), params=IMPORTANCE), min_score=0.02)
    return ranked


@query("feature_stability")
def feature_stability(spark, sf):
    return unsup.feature_stability(
        fx.scored(spark, sf), Spec("random_forest", tuple(FEATS), params=IMPORTANCE), top_k=3
    )


# ---- unsupervised -----------------------------------------------------------------------------
CLUSTER_FLAGS = [
    "flag_intubacion_dificil", "flag_tipo_intubacion_complejo", "flag_aferesis", "flag_balance_extremo",
    "flag_destino_uci", "flag_intubado_salida", "flag_hospitalizacion_no_anticipada", "flag_urgencias_30_dias",
]


@query("kmeans_profile")
def kmeans_profile(spark, sf):
    df = target.extract_target(fx.posop(spark, sf), "target_f_predictibilidad_maxima").select(
        col(KEY_ALIAS).alias(KEY), "target", *CLUSTER_FLAGS
    )
    pre = fx.preop(spark, sf).select(col(KEY), "Edad", "Talla (cm)")
    return unsup.kmeans_profile(df, CLUSTER_FLAGS, "target", pre, KEY, ["Edad", "Talla (cm)"], k=5, seeds=range(20))


@query("pca_project")
def pca_project(spark, sf):
    vectors = unsup.embedding_vectors(fx.table(spark, sf, "embeddings"), "embedding")
    scores, _ = unsup.pca_project(vectors, 2)
    return scores.select("vec_id", "pc1", "pc2")


@query("isolation_forest")
def isolation_forest(spark, sf):
    vectors = unsup.embedding_vectors(fx.table(spark, sf, "embeddings"), "embedding")
    return unsup.isolation_forest(vectors, "vec_id", trees=100, contamination=0.1)


@query("local_outlier_factor")
def local_outlier_factor(spark, sf):
    vectors = unsup.embedding_vectors(fx.table(spark, sf, "embeddings"), "embedding")
    return unsup.local_outlier_factor(vectors, "vec_id", k=20)
