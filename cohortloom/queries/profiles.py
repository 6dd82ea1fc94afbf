"""Aggregations: reports, profiles, prevalence, flag tables, pivots."""
from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from cohortloom import fixtures as fx
from cohortloom.functions.hashing import hash32
from cohortloom.functions.numeric import col, round_half_up as r6
from cohortloom.functions import text
from cohortloom.operators import joins, profile, project
from cohortloom.plans import allergens, flags, target
from cohortloom.queries.base import block, q, query, r
from cohortloom.queries.projections import NUMBERS
from cohortloom.queries.targets import VERSION_SQL
from cohortloom.sources.tables import KEY, KEY_ALIAS


def rounded(df, *names):
    return df.withColumns({n: r6(n) for n in names})


def null_pct(columns) -> str:
    return "coalesce(avg((" + " + ".join(f"({q(c)} IS NULL)::INTEGER" for c in columns) + f")::DOUBLE / {len(columns)}), 0) * 100"


PRE, POS = list(fx.PREOP_COLUMNS), list(fx.POSOP_COLUMNS)


@query(
    "validate_raw",
    f"""
SELECT 'preop' AS name, count(*) AS rows, {len(PRE)} AS cols, {r(null_pct(PRE))} AS null_pct, 'warnings' AS status, 'postop: column ''target'' not found' AS warnings FROM preop_v
UNION ALL SELECT 'postop', count(*), {len(POS)}, {r(null_pct(POS))}, 'warnings', 'postop: column ''target'' not found' FROM posop_v""",
    needs=("preop_v", "posop_v"),
)
def validate_raw(spark, sf):
    return rounded(profile.validate_raw(fx.preop(spark, sf), fx.posop(spark, sf)), "null_pct")


CLEANED = [c for c in PRE if c not in ("CODIGO", "Fecha")]


@query(
    "cleaning_report",
    f"""
SELECT count(*) AS rows_before, count(*) FILTER (WHERE "Edad" IS NULL OR "Edad" >= 18) AS rows_after,
  count(*) - count(*) FILTER (WHERE "Edad" IS NULL OR "Edad" >= 18) AS rows_removed, {len(PRE)} AS cols_before, {len(CLEANED)} AS cols_after,
  'CODIGO, Fecha' AS cols_dropped, {r(null_pct(PRE))} AS null_pct_before,
  {r("(SELECT " + null_pct(CLEANED) + ' FROM preop_v WHERE "Edad" IS NULL OR "Edad" >= 18)')} AS null_pct_after FROM preop_v""",
    needs=("preop_v",),
)
def cleaning_report(spark, sf):
    before = fx.preop(spark, sf)
    after = project.filter_min_age(before.drop("CODIGO", "Fecha"))
    return rounded(profile.cleaning_report(before, after), "null_pct_before", "null_pct_after")


QUALITY = ["Sexo", "Edad", "IMC", "Grupo Sanguíneo", "Hora", "Examen"]


@query(
    "quality_report",
    " UNION ALL ".join(f"SELECT 'missing' AS section, '{c}' AS item, count(*) FILTER (WHERE {q(c)} IS NULL) AS value FROM preop_v" for c in QUALITY)
    + f" UNION ALL SELECT 'duplicates', 'duplicates', count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(q(c) for c in QUALITY)} FROM preop_v)) FROM preop_v"
    + " UNION ALL SELECT 'types', 'double', 2 UNION ALL SELECT 'types', 'string', 4",
    needs=("preop_v",),
)
def quality_report(spark, sf):
    return profile.quality_report(fx.preop(spark, sf).select(*[col(c) for c in QUALITY]))


LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def profile_sql(table: str, c: str) -> str:
    e = f"TRY_CAST({q(c)} AS DOUBLE)"
    quant = ", ".join(f"{r(f'quantile_cont({e}, {p})')} AS {n}" for p, n in ((0.25, "p25"), (0.5, "median"), (0.75, "p75")))
    return (
        f"SELECT '{c}' AS feature, count(*) AS n, count(*) FILTER (WHERE {e} IS NULL) AS nulls, count(DISTINCT {e}) AS uniques, "
        f"min({e}) AS min, max({e}) AS max, {r(f'avg({e})', 4)} AS mean, {r(f'stddev_samp({e})', 4)} AS std, {quant} FROM {table}"
    )


@query(
    "column_profile",
    "WITH num AS (" + " UNION ALL ".join([profile_sql("lineitem", c) for c in LINE] + [profile_sql("preop_v", c) for c in NUMBERS]) + """),
cat AS (SELECT feature, v, count(*) AS w FROM (SELECT 'l_returnflag' AS feature, l_returnflag AS v FROM lineitem UNION ALL SELECT 'l_linestatus', l_linestatus FROM lineitem
  UNION ALL SELECT 'Sexo', "Sexo" FROM preop_v UNION ALL SELECT 'Examen', "Examen" FROM preop_v UNION ALL SELECT 'Abdomen', "Abdomen" FROM preop_v) GROUP BY feature, v),
ranked AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY w DESC, coalesce(v, 'nan')) AS rn FROM cat)
SELECT *, NULL AS top FROM num UNION ALL
SELECT feature, sum(w)::BIGINT, coalesce(sum(w) FILTER (WHERE v IS NULL), 0)::BIGINT, count(v), NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  string_agg(coalesce(v, 'nan') || ' (' || w || ')', ', ' ORDER BY rn) FILTER (WHERE rn <= 3) FROM ranked GROUP BY feature""",
    needs=("preop_v",),
)
def column_profile(spark, sf):
    line, pre = fx.table(spark, sf, "lineitem"), fx.preop(spark, sf)
    num = profile.numeric_profile(line, LINE).unionByName(profile.numeric_profile(pre, NUMBERS))
    num = num.withColumns(
        {n: r6(n) for n in ("p25", "median", "p75")} | {n: r6(n, 4) for n in ("mean", "std")}
    )
    cat = profile.top_values(line, ["l_returnflag", "l_linestatus"]).unionByName(
        profile.top_values(pre, ["Sexo", "Examen", "Abdomen"])
    )
    return num.unionByName(cat, allowMissingColumns=True)


IMPACT = {"Edad": 'CASE WHEN "Edad" BETWEEN 0 AND 120 THEN "Edad" END', "Temperatura": 'TRY_CAST("Temperatura" AS DOUBLE)'}


def impact_sql(c: str, after: str) -> str:
    b = f"TRY_CAST({q(c)} AS DOUBLE)"
    return f"""SELECT '{c}' AS feature, count(*) AS n_total, count(*) FILTER (WHERE {q(c)} IS NULL) AS nulls_before, count(*) FILTER (WHERE a IS NULL) AS nulls_after,
 count(*) FILTER (WHERE {q(c)} IS NULL AND a IS NOT NULL OR {q(c)} IS NOT NULL AND a IS NULL OR {b} <> a) AS n_changed,
 count(DISTINCT {q(c)}) AS uniques_before, count(DISTINCT a) AS uniques_after, {r(f'avg({b})')} AS mean_before, {r('avg(a)')} AS mean_after,
 {r(f'quantile_cont({b}, 0.5)')} AS median_before, {r('quantile_cont(a, 0.5)')} AS median_after,
 count(*) FILTER (WHERE a IS NULL) - count(*) FILTER (WHERE {q(c)} IS NULL) AS delta_nulls, count(DISTINCT a) - count(DISTINCT {q(c)}) AS delta_uniques,
 {r(f'avg(a) - avg({b})')} AS delta_mean, {r(f'quantile_cont(a, 0.5) - quantile_cont({b}, 0.5)')} AS delta_median
FROM (SELECT *, {after} AS a FROM preop_v WHERE "Edad" IS NULL OR "Edad" >= 18)"""


@query("column_impact", " UNION ALL ".join(impact_sql(c, e) for c, e in IMPACT.items()), needs=("preop_v",))
def column_impact(spark, sf):
    before = fx.preop(spark, sf).select("k", "Edad", "Temperatura")
    after = project.filter_min_age(project.outlier_nullify(before, {"Edad": (0, 120)}))
    after = after.join(before.where("Edad IS NULL OR Edad >= 18").select("k"), "k", "left_semi")
    # numbers keep their text form, so an unchanged value compares equal
    after = after.withColumn("Temperatura", F.when(col("Temperatura").try_cast("double").isNotNull(), col("Temperatura")))
    out = profile.column_impact(before, after, "k", list(IMPACT))
    return rounded(out, *[c for c in out.columns if "mean" in c or "median" in c])


@query(
    "step_change_log",
    """
SELECT 'filter_age' AS step, count(*) AS rows_before, count(*) FILTER (WHERE "Edad" >= 18) AS rows_after,
  count(*) FILTER (WHERE "Edad" >= 18) - count(*) AS delta_rows, 4 AS cols_before, 4 AS cols_after, 0 AS delta_cols, 'adult' AS new_cols, 'CODIGO' AS removed_cols FROM preop_v""",
    needs=("preop_v",),
)
def step_change_log(spark, sf):
    before = fx.preop(spark, sf).select("k", "CODIGO", "Edad", "Sexo")
    after = before.where("Edad >= 18").drop("CODIGO").withColumn("adult", F.lit(1))
    return profile.step_change(before, after, "filter_age")


CONSISTENT = ["Edad", "Peso (Kg)", "Temperatura", *profile.PRESSURES]


def consistency_sql(src: str) -> str:
    zero = " + ".join(f"coalesce((TRY_CAST({q(c)} AS DOUBLE) = 0)::INTEGER, 0)" for c in CONSISTENT)
    miss = " + ".join(f"({q(c)} IS NULL)::INTEGER" for c in CONSISTENT)
    s, d = (q(c) for c in profile.PRESSURES)
    return f"""SELECT count(*) AS rows, sum({miss})::BIGINT AS missing, count(*) FILTER (WHERE {s} < {d}) AS contradictions, sum({zero})::BIGINT AS impossible_zeros,
 count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(q(c) for c in CONSISTENT)} FROM {src})) AS duplicates FROM {src}"""


block("adult_v", 'SELECT * FROM preop_v WHERE "Edad" >= 18', ("preop_v",))


@query(
    "clinical_consistency",
    f"""
WITH b AS (UNPIVOT ({consistency_sql('preop_v')}) ON COLUMNS(*) INTO NAME metric VALUE before),
a AS (UNPIVOT ({consistency_sql('adult_v')}) ON COLUMNS(*) INTO NAME metric VALUE after)
SELECT b.metric, before, after, after - before AS change FROM b JOIN a ON a.metric = b.metric""",
    needs=("adult_v",),
)
def clinical_consistency(spark, sf):
    before = fx.preop(spark, sf).select(*[col(c) for c in CONSISTENT])
    return profile.clinical_consistency(before, before.where("Edad >= 18"))


SYSTEMS = {
    "Neurológicos": "Antecedente neurológicos", "Respiratorios": "Antecedente respiratorios",
    "Cardiovasculares": "Antecedentes cardiovasculares", "Hematológicos": "Antecedente hematológicos ",
    "Endocrinológicos": "Antecedente endocrinológicos", "Renales": "Antecedente renales",
    "Gastrointestinales": "Antecedente gastrointestinales",
}


@query(
    "top_conditions",
    """
WITH t AS ("""
    + " UNION ALL ".join(f"SELECT '{s}' AS system, {q(c)} AS t FROM preop_v" for s, c in SYSTEMS.items())
    + """), e AS (SELECT system, trim(term) AS term FROM (SELECT system, unnest(string_split(t, ',')) AS term FROM t WHERE lower(t) NOT IN ('negativo', 'ninguno', 'nan')) WHERE trim(term) <> ''),
c AS (SELECT system, term, count(*) AS w FROM e GROUP BY system, term),
r AS (SELECT *, row_number() OVER (PARTITION BY system ORDER BY w DESC, term) AS rn FROM c)
SELECT system, string_agg(term || ' (' || w || ')', ', ' ORDER BY rn) FILTER (WHERE rn <= 5) AS top, sum(w)::BIGINT AS total FROM r GROUP BY system""",
    needs=("preop_v",),
)
def top_conditions(spark, sf):
    return profile.top_conditions(fx.preop(spark, sf), SYSTEMS)


@query(
    "histogram",
    f"""
WITH e AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
h AS (SELECT least(greatest(floor((l_extendedprice - lo) / ((hi - lo) / 30.0)), 0), 29)::INTEGER AS bin, count(*) AS n FROM lineitem, e GROUP BY 1)
SELECT b.bin, {r('lo + (hi - lo) / 30 * b.bin')} AS low, {r('lo + (hi - lo) / 30 * (b.bin + 1)')} AS high, coalesce(n, 0) AS n
FROM (SELECT unnest(range(0, 30))::INTEGER AS bin) b CROSS JOIN e LEFT JOIN h ON h.bin = b.bin""",
)
def histogram(spark, sf):
    return rounded(profile.fixed_histogram(fx.table(spark, sf, "lineitem"), "l_extendedprice", 30), "low", "high")


VERSIONS = list(VERSION_SQL)
GROUPS = {
    "severidad": 'p."Clase Funcional (NYHA) "',
    "tipo_anestesia": 'p."Tipo de anestesia propuesta"',
    "edad": "CASE WHEN p.\"Edad\" <= 65 THEN 'edad_leq_65' WHEN p.\"Edad\" > 65 THEN 'edad_gt_65' END",
}


@query(
    "prevalence_grouped",
    f"""
WITH m AS (SELECT version, target, {', '.join(f'{e} AS {n}' for n, e in GROUPS.items())}
  FROM preop_v p JOIN versions_v v ON p."Documento PMD" = v.doc WHERE p."Edad" >= 18),
g AS (SELECT version, 'global' AS category, 'all' AS category_value, target FROM m
  UNION ALL {' UNION ALL '.join(f"SELECT version, '{n}', {n}, target FROM m WHERE {n} IS NOT NULL" for n in GROUPS)})
SELECT version, category, category_value, count(*) AS n_cat, sum(target)::BIGINT AS n_pos_cat, {r('avg(target)')} AS prevalence_cat FROM g GROUP BY version, category, category_value""",
    needs=("preop_v", "versions_v"),
)
def prevalence_grouped(spark, sf):
    """Flags -> target versions -> join to the adult preop rows -> prevalence by group."""
    wide = joins.short_key(target.target_wide(fx.posop(spark, sf), KEY_ALIAS))
    severity, kind = "Clase Funcional (NYHA) ", "Tipo de anestesia propuesta"
    pre = fx.preop(spark, sf).where("Edad >= 18").select(col(KEY), col(severity), col(kind), "Edad")
    age = F.when(col("Edad") <= 65, "edad_leq_65").when(col("Edad") > 65, "edad_gt_65")
    groups = {"severidad": severity, "tipo_anestesia": kind, "edad": age}
    return rounded(profile.prevalence_grouped(pre.join(wide, KEY), VERSIONS, groups), "prevalence_cat")


@query(
    "nulls_by_column",
    "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, {r(f'avg(({q(c)} IS NULL)::INTEGER)')} AS null_share FROM preop_v" for c in PRE)
    + ") WHERE null_share > 0",
    needs=("preop_v",),
)
def nulls_by_column(spark, sf):
    return rounded(profile.nulls_by_column(fx.preop(spark, sf)), "null_share")


@query(
    "target_distribution",
    f"SELECT target, count(*) AS n, {r('count(*) / (SELECT count(*)::DOUBLE FROM tf_v)')} AS share FROM tf_v GROUP BY target",
    needs=("tf_v",),
)
def target_distribution(spark, sf):
    tgt = target.extract_target(fx.posop(spark, sf), "target_f_predictibilidad_maxima")
    return rounded(profile.target_distribution(tgt), "share")


def flagged(spark, sf):
    return target.extract_target(fx.posop(spark, sf), "target_f_predictibilidad_maxima")


@query(
    "flag_summary",
    " UNION ALL ".join(
        f"SELECT '{f}' AS flag, sum({f})::BIGINT AS total, {r(f'sum({f}) * 100.0::DOUBLE / count(*)')} AS pct, sum({f} * target)::BIGINT AS with_target, "
        f"{r(f'coalesce(sum({f} * target) * 100.0::DOUBLE / nullif(sum({f}), 0), 0)')} AS pct_with_target FROM tf_v"
        for f in flags.ALL_FLAGS
    ),
    needs=("tf_v",),
)
def flag_summary(spark, sf):
    return rounded(profile.flag_summary(flagged(spark, sf), flags.ALL_FLAGS), "pct", "pct_with_target")


@query(
    "flag_count_distribution",
    f"""
WITH f AS (SELECT target, {' + '.join(flags.ALL_FLAGS)} AS n_flags FROM tf_v),
s AS (SELECT target, {r('avg(n_flags)')} AS mean, {r('quantile_cont(n_flags, 0.25)')} AS p25, {r('quantile_cont(n_flags, 0.5)')} AS median, {r('quantile_cont(n_flags, 0.75)')} AS p75 FROM f GROUP BY target)
SELECT d.target, n_flags, n, mean, p25, median, p75 FROM (SELECT target, n_flags, count(*) AS n FROM f GROUP BY target, n_flags) d JOIN s ON s.target = d.target""",
    needs=("tf_v",),
)
def flag_count_distribution(spark, sf):
    df = flagged(spark, sf)
    counts = profile.flag_count_distribution(df, flags.ALL_FLAGS)
    stats = rounded(profile.flag_count_summary(df, flags.ALL_FLAGS), "mean", "p25", "median", "p75")
    return counts.join(stats, "target")


block("flags_m", "SELECT " + ", ".join(["k", *flags.ALL_FLAGS]) + " FROM flags_v", ("flags_v",))


@query(
    "flag_cooccurrence",
    " UNION ALL ".join(
        f"SELECT '{a}' AS flag1, '{b}' AS flag2, {r(f'coalesce(sum({a} * {b}) * 100.0::DOUBLE / nullif(sum({a}), 0), 0)')} AS pct FROM flags_m"
        for a in flags.ALL_FLAGS for b in flags.ALL_FLAGS
    ),
    needs=("flags_m",),
)
def flag_cooccurrence(spark, sf):
    return rounded(profile.flag_cooccurrence(flags.flags_all(fx.posop(spark, sf)), flags.ALL_FLAGS), "pct")


SUBS = [
    "flag_uci_no_planeada", "flag_estancia_uci", "flag_estancia", "flag_desenlace", "flag_destino_uci",
    "flag_via_aerea", "flag_intubacion_dificil", "flag_liquidos", "flag_perdidas_altas", "flag_tecnica",
]


@query(
    "flag_correlation_pairs",
    f"""
WITH p AS ({' UNION ALL '.join(f"SELECT '{min(a, b)}' AS flag1, '{max(a, b)}' AS flag2, corr({a}, {b}) AS c FROM flags_v" for a, b in combinations(SUBS, 2))})
SELECT flag1, flag2, {r('c')} AS correlation, CASE WHEN c > 0 THEN 'Positiva' ELSE 'Negativa' END AS kind,
 CASE WHEN abs(c) >= 0.7 THEN 'Fuerte' WHEN abs(c) >= 0.5 THEN 'Moderada' ELSE 'Débil' END AS strength FROM p WHERE abs(c) >= 0.3""",
    needs=("flags_v",),
)
def flag_correlation_pairs(spark, sf):
    corr = profile.flag_correlations(flags.flags_all(fx.posop(spark, sf)), SUBS)
    return rounded(profile.strong_pairs(corr), "correlation")


# ---- selection tables derived from the scored rows --------------------------------------------
block(
    "selected_v",
    "SELECT version, group_type || '_' || model AS feature FROM scored_v GROUP BY 1, 2 HAVING avg(y_true) > 0.33",
    ("scored_v",),
)


def selected(spark, sf):
    df = fx.scored(spark, sf).withColumn("feature", F.concat_ws("_", "group_type", "model"))
    return df.groupBy("version", "feature").agg(F.avg("y_true").alias("s")).where("s > 0.33").select("version", "feature")


@query(
    "feature_frequency",
    "SELECT feature, count(DISTINCT version) AS n_versions, (count(DISTINCT version) >= 2)::INTEGER AS consensus FROM selected_v GROUP BY feature",
    needs=("selected_v",),
)
def feature_frequency(spark, sf):
    return profile.feature_frequency(selected(spark, sf), 3)


@query(
    "selection_matrix",
    "SELECT feature, " + ", ".join(f"max((version = 'v{i}')::INTEGER) AS v{i}" for i in range(3)) + " FROM selected_v GROUP BY feature",
    needs=("selected_v",),
)
def selection_matrix(spark, sf):
    return profile.selection_matrix(selected(spark, sf), ["v0", "v1", "v2"])


@query(
    "metric_pivot",
    "SELECT version, "
    + ", ".join(f"max(brier) FILTER (WHERE model = 'm{i}') AS m{i}" for i in range(4))
    + f" FROM (SELECT version, model, {r('avg((y_proba - y_true) * (y_proba - y_true))')} AS brier FROM scored_v GROUP BY version, model) GROUP BY version",
    needs=("scored_v",),
)
def metric_pivot(spark, sf):
    brier = F.avg((F.col("y_proba") - F.col("y_true")) * (F.col("y_proba") - F.col("y_true")))
    metrics = fx.scored(spark, sf).groupBy("version", "model").agg(r6(brier).alias("brier"))
    return profile.metric_pivot(metrics, ["m0", "m1", "m2", "m3"], "brier")


HASH_SQL = "CAST(('0x' || substr(md5({key} || '|{salt}|{seed}'), 1, 8)) AS BIGINT)"


def hash_sql(key: str, salt: str, seed: int) -> str:
    return HASH_SQL.format(key=f"CAST({key} AS VARCHAR)", salt=salt, seed=seed)


@query(
    "cv_mean_std",
    f"""
WITH f AS (SELECT version, model, {hash_sql('row_key', 'fold', 42)} % 5 AS fold, sum((y_proba >= 0.5)::INTEGER * y_true) / sum(y_true)::DOUBLE AS recall,
  avg((y_proba - y_true) * (y_proba - y_true)) AS brier FROM scored_v GROUP BY 1, 2, 3)
SELECT version, model, {', '.join(f'{r(f"avg({m})")} AS {m}_mean, {r(f"stddev_pop({m})")} AS {m}_std, {r(f"stddev_samp({m})")} AS {m}_std_sample' for m in ('recall', 'brier'))} FROM f GROUP BY version, model""",
    needs=("scored_v",),
)
def cv_mean_std(spark, sf):
    hit = (F.col("y_proba") >= 0.5).cast("int")
    error = F.col("y_proba") - F.col("y_true")
    folds = fx.scored(spark, sf).groupBy("version", "model", (hash32("row_key", "fold", 42) % 5).alias("fold")).agg(
        (F.sum(hit * F.col("y_true")) / F.sum("y_true")).alias("recall"), F.avg(error * error).alias("brier")
    )
    out = profile.fold_summary(folds, ["recall", "brier"])
    return rounded(out, *[c for c in out.columns if c not in ("version", "model")])


KNOWN_SQL = " OR ".join(f"regexp_matches(t, '{rx}')" for rx, _ in allergens.RULES)


@query(
    "unmapped_token_frequency",
    f"""
SELECT t AS token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) AS t FROM documents)
WHERE NOT ({KNOWN_SQL}) AND t NOT IN ({', '.join(f"'{w}'" for w in allergens.ALIASES)}) GROUP BY t""",
)
def unmapped_token_frequency(spark, sf):
    docs = fx.table(spark, sf, "documents")
    tokens = docs.select(F.explode(text.words("text")).alias("token"))
    return allergens.unmapped_tokens(tokens)
