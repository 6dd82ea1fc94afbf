"""Sources, sinks, projections, filters and imputation."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom import fixtures as fx
from cohortloom.functions import text
from cohortloom.functions.numeric import col, round_half_up as r6
from cohortloom.operators import project
from cohortloom.plans import flags
from cohortloom.plans.clean import STRICT_VALUES
from cohortloom.queries.base import block, q, query, r
from cohortloom.session import shared_dir
from cohortloom.sources import tables


def scratch(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cols(names) -> str:
    return ", ".join(q(n) for n in names)


# ---- sources and sinks ------------------------------------------------------------------
@query("src_parquet", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def src_parquet(spark, sf):
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_custkey", T.LongType()),
            T.StructField("o_orderstatus", T.StringType()),
            T.StructField("o_totalprice", T.DoubleType()),
        ]
    )
    return tables.read_parquet(spark, f"{sf}/orders.parquet", schema)


@query("sink_parquet", 'SELECT k, "Edad", "Sexo", "Hora" FROM preop_v', needs=("preop_v",))
def sink_parquet(spark, sf):
    df = fx.preop(spark, sf).select("k", "Edad", "Sexo", "Hora", col("Edad") + 1)
    repeated = df.toDF("k", "Edad", "Sexo", "Hora", "Edad")
    return spark.read.parquet(tables.write_parquet(repeated, scratch(spark, "sink")))


@query(
    "src_land_pair",
    """
SELECT 'preop' AS side, count(*) AS n, count(DISTINCT "Documento PMD") AS n_keys FROM preop_v
UNION ALL SELECT 'postop', count(*), count(DISTINCT "Documento PMD (valoración preanestésica)") FROM posop_v""",
    needs=("preop_v", "posop_v"),
)
def src_land_pair(spark, sf):
    out = scratch(spark, "landing")
    tables.land_pair(spark, fx.preop(spark, sf), fx.posop(spark, sf), out)
    pair = tables.land_pair(spark, fx.preop(spark, sf), fx.posop(spark, sf), out)
    parts = [
        df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(col(tables.KEY)).alias("n_keys")).select(
            F.lit(side).alias("side"), "n", "n_keys"
        )
        for side, df in zip(("preop", "postop"), pair)
    ]
    return parts[0].unionByName(parts[1])


@query(
    "csv_report_io",
    f"SELECT group_type, count(*) AS n, {r('avg(y_proba)')} AS mean_score FROM scored_v GROUP BY group_type",
    needs=("scored_v",),
)
def csv_report_io(spark, sf):
    report = fx.scored(spark, sf).groupBy("group_type").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("y_proba")).alias("mean_score")
    )
    return tables.read_csv_report(spark, tables.write_csv_report(report, scratch(spark, "report")), report.schema)


@query(
    "json_metrics_collect",
    f"""
SELECT version AS target, model, 'validation' AS split, {r('rec')} AS "Recall", {r('prec')} AS "Precision", 0.5::DOUBLE AS "Threshold",
  {r('5 * prec * rec / (4 * prec + rec)')} AS "F2", CAST(NULL AS DOUBLE) AS "ROC_AUC"
FROM (SELECT version, model, sum((y_proba >= 0.5)::INTEGER * y_true) / sum(y_true) AS rec,
        sum((y_proba >= 0.5)::INTEGER * y_true) / sum((y_proba >= 0.5)::INTEGER) AS prec FROM scored_v GROUP BY version, model)""",
    needs=("scored_v",),
)
def json_metrics_collect(spark, sf):
    """One metrics file per (version, model) in partition folders, collected by path."""
    hit = (F.col("y_proba") >= 0.5).cast("int")
    tp = F.sum(hit * F.col("y_true"))
    rows = fx.scored(spark, sf).groupBy("version", "model").agg(
        (tp / F.sum("y_true")).alias("Recall"), (tp / F.sum(hit)).alias("Precision"), F.lit(0.5).alias("Threshold")
    )
    p, rec = F.col("Precision"), F.col("Recall")
    record = F.to_json(F.struct((5 * p * rec / (4 * p + rec)).alias("F2"), "Recall", "Precision", "Threshold"))
    root = scratch(spark, "metrics")
    rows.select("version", "model", record.alias("value")).write.partitionBy("version", "model").text(root)
    found = tables.collect_metrics(
        spark, root, "version=*/model=*/part-*", r"version=([^/]+)/", r"model=([^/]+)/"
    )
    return found.select("target", "model", "split", *[r6(m).alias(m) for m in tables.METRIC_FIELDS])


CONTRACT_SQL = ", ".join(
    f'TRY_CAST("{n}" AS DOUBLE) AS "{n}"' if n in fx.PREOP_COLUMNS else f'CAST(NULL AS DOUBLE) AS "{n}"'
    for n in tables.RAW_NUMBERS
)


@query(
    "schema_contract",
    f'SELECT {CONTRACT_SQL}, "Sexo", "Hora", CAST(NULL AS VARCHAR) AS "Alergias" FROM preop_v',
    needs=("preop_v",),
)
def schema_contract(spark, sf):
    texts = [T.StructField(n, T.StringType()) for n in ("Sexo", "Hora", "Alergias")]
    schema = T.StructType([f for f in tables.RAW_SCHEMA if f.name in tables.RAW_NUMBERS] + texts)
    return tables.schema_contract(fx.preop(spark, sf), schema)


@query(
    "version_partitions",
    """
SELECT version, CASE WHEN version <> 'v1' THEN 'used' ELSE 'ignored' END AS status
FROM (SELECT DISTINCT version FROM scored_v WHERE y_true = 1 INTERSECT SELECT DISTINCT version FROM scored_v WHERE model = 'm0')""",
    needs=("scored_v",),
)
def version_partitions(spark, sf):
    df = fx.scored(spark, sf)
    path = tables.write_parquet(df.where("y_true = 1"), scratch(spark, "versions"), ["version"])
    return tables.version_partitions(
        spark.read.parquet(path), df.where("model = 'm0'"), df.where("version <> 'v1'")
    )


# ---- projections ------------------------------------------------------------------------
@query(
    "rename_map",
    'SELECT k, "Tensión Arterial Media (mm/Hg)", "Edad" AS "Prótesis Dental_no" FROM preop_v',
    needs=("preop_v",),
)
def rename_map(spark, sf):
    df = fx.preop(spark, sf).select("k", "Tensión Arterial Media (mm/Hg)", "Edad")
    garbled = df.toDF("k", "TensiÃ³n Arterial Media (mm/Hg)", "PrÃ³tesis Dental_no")
    return project.rename_map(garbled)


@query("drop_columns", 'SELECT k, "Edad", "Sexo" FROM preop_v', needs=("preop_v",))
def drop_columns(spark, sf):
    df = fx.preop(spark, sf).select("k", "Edad", "Sexo", "CODIGO", "Documento PMD")
    return project.drop_columns(df, ["CODIGO", "Documento PMD", "Nombres y Apellidos"])


@query(
    "filter_min_age_keep_null", 'SELECT k, "Edad" FROM preop_v WHERE "Edad" IS NULL OR "Edad" >= 18', needs=("preop_v",)
)
def filter_min_age_keep_null(spark, sf):
    return project.filter_min_age(fx.preop(spark, sf).select("k", "Edad"))


@query("filter_min_age_strict", 'SELECT k, "Edad" FROM preop_v WHERE "Edad" >= 18', needs=("preop_v",))
def filter_min_age_strict(spark, sf):
    return project.filter_min_age(fx.preop(spark, sf).select("k", "Edad"), keep_null=False)


@query(
    "outlier_nullify",
    'SELECT k, CASE WHEN "Edad" BETWEEN 0 AND 120 THEN "Edad" END AS "Edad", CASE WHEN "IMC" >= 15 THEN "IMC" END AS "IMC" FROM preop_v',
    needs=("preop_v",),
)
def outlier_nullify(spark, sf):
    df = fx.preop(spark, sf).select("k", "Edad", "IMC")
    return project.outlier_nullify(df, {"Edad": (0, 120), "IMC": (15, None), "absent": (0, 1)})


@query(
    "numeric_coerce",
    'SELECT k, TRY_CAST("Temperatura" AS DOUBLE) AS "Temperatura", TRY_CAST("Hora" AS DOUBLE) AS "Hora" FROM preop_v',
    needs=("preop_v",),
)
def numeric_coerce(spark, sf):
    return project.numeric_coerce(fx.preop(spark, sf).select("k", "Temperatura", "Hora"), ["Temperatura", "Hora"])


@query(
    "impute_constant",
    """SELECT k, coalesce("Antecedente neurológicos", 'negativo') AS "Antecedente neurológicos",
       coalesce("Edad", -1.0) AS "Edad" FROM preop_v""",
    needs=("preop_v",),
)
def impute_constant(spark, sf):
    df = fx.preop(spark, sf).select("k", "Antecedente neurológicos", "Edad")
    df = project.impute_constant(df, ["Antecedente neurológicos"], "negativo")
    return project.impute_constant(df, ["Edad"], -1.0)


NUMBERS = ["Edad", "Peso (Kg)", "IMC", "Temperatura", "Tensión Arterial Sistólica (mm/Hg)"]


def med_sql(name: str, src: str = "preop_v") -> str:
    return f'coalesce(TRY_CAST("{name}" AS DOUBLE), (SELECT coalesce(quantile_cont(TRY_CAST("{name}" AS DOUBLE), 0.5), 0) FROM {src}))'


# IMC is a third empty and falls under the 70 % rule
@query(
    "impute_median",
    "SELECT k, " + ", ".join(f'{r(med_sql(n))} AS "{n}"' for n in NUMBERS if n != "IMC") + " FROM preop_v",
    needs=("preop_v",),
)
def impute_median(spark, sf):
    out = project.impute_median(fx.preop(spark, sf), ["k"], NUMBERS, 0.7)
    return out.select("k", *[r6(n).alias(n) for n in out.columns if n != "k"])


@query(
    "impute_by_rule",
    "SELECT k, " + ", ".join(f'{r(med_sql(n))} AS "{n}"' for n in NUMBERS)
    + ', coalesce("Antecedentes anestésicos", 0) AS "Antecedentes anestésicos" FROM preop_v',
    needs=("preop_v",),
)
def impute_by_rule(spark, sf):
    out = project.impute_by_rule(fx.preop(spark, sf), ["k"], [*NUMBERS, "Antecedentes anestésicos"])
    return out.select("k", *[r6(n).alias(n) for n in out.columns if n != "k"])


@query(
    "range_clip",
    "SELECT k, "
    + ", ".join(
        f'CASE WHEN "{c}" IS NOT NULL THEN least(greatest("{c}", {lo}), {hi}) END AS "{c}"'
        for c, (lo, hi) in project.VITAL_RANGES.items() if c != "Temperatura"
    )
    + " FROM preop_v",
    needs=("preop_v",),
)
def range_clip(spark, sf):
    ranges = {c: v for c, v in project.VITAL_RANGES.items() if c != "Temperatura"}
    return project.range_clip(fx.preop(spark, sf).select("k", *[col(c) for c in ranges]), ranges)


def u_sql(key: str, salt: str, seed: int = 42) -> str:
    return f"(CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{salt}|{seed}'), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE)"


def random_sql(name: str, lo: float, hi: float, e: str | None = None) -> str:
    v = e or f'TRY_CAST("{name}" AS DOUBLE)'
    drawn = (
        f"least(greatest(({lo}::DOUBLE + {hi - lo}::DOUBLE * {u_sql('k', name + '|base')}) * "
        f"(1.0::DOUBLE + ({u_sql('k', name + '|noise')} * 2.0::DOUBLE - 1.0::DOUBLE) * 0.03::DOUBLE), {lo}::DOUBLE), {hi}::DOUBLE)"
    )
    return f"CASE WHEN {v} BETWEEN {lo} AND {hi} OR {v} IS NULL THEN {v} ELSE {drawn} END"


@query(
    "range_random_impute",
    "SELECT k, " + ", ".join(f'{r(random_sql(c, lo, hi))} AS "{c}"' for c, (lo, hi) in project.VITAL_RANGES.items())
    + " FROM preop_v",
    needs=("preop_v",),
)
def range_random_impute(spark, sf):
    names = list(project.VITAL_RANGES)
    df = project.range_random_impute(fx.preop(spark, sf).select("k", *[col(c) for c in names]), "k")
    return df.select("k", *[r6(c).alias(c) for c in names])


@query(
    "null_normalise",
    """SELECT k, CASE WHEN lower(trim(t)) NOT IN ('', 'nan', 'none') THEN t END AS t
FROM (SELECT k, CASE k % 7 WHEN 5 THEN '  ' WHEN 6 THEN ' None ' ELSE "Antecedentes quirúrgicos" END AS t FROM preop_v)""",
    needs=("preop_v",),
)
def null_normalise(spark, sf):
    raw = F.expr("CASE k % 7 WHEN 5 THEN '  ' WHEN 6 THEN ' None ' ELSE `Antecedentes quirúrgicos` END")
    return fx.preop(spark, sf).select("k", raw.alias("t")).select("k", text.null_normalise("t").alias("t"))


def canon_sql(name: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STRICT_VALUES[name].items())
    return f'CASE lower(trim("{name}")) {arms} ELSE "{name}" END'


@query(
    "value_canonicalise",
    "SELECT k, " + ", ".join(f'{canon_sql(c)} AS "{c}"' for c in STRICT_VALUES)
    + ", CASE WHEN \"Color de Piel\" IN ('Rosada', 'Rosado') THEN 'normal' WHEN \"Color de Piel\" IN ('Pálida') THEN 'palida' ELSE 'otros' END AS piel FROM preop_v",
    needs=("preop_v",),
)
def value_canonicalise(spark, sf):
    skin = text.map_variants("Color de Piel", {"normal": ["Rosada", "Rosado"], "palida": ["Pálida"]})
    return fx.preop(spark, sf).select(
        "k", *[text.canonicalise(c, m).alias(c) for c, m in STRICT_VALUES.items()], skin.alias("piel")
    )


@query(
    "rule_classify_contains",
    """SELECT k, CASE WHEN contains(t, 'hernia') AND contains(t, 'inguinal') THEN 'hernia'
  WHEN contains(t, 'fractura') THEN 'trauma' ELSE 'otros' END AS clase
FROM (SELECT k, lower("Dx Preoperatorio") AS t FROM preop_v)""",
    needs=("preop_v",),
)
def rule_classify_contains(spark, sf):
    rules = [(["hernia", "inguinal"], "hernia"), (["fractura"], "trauma")]
    df = fx.preop(spark, sf).select("k", F.lower("Dx Preoperatorio").alias("t"))
    return df.select("k", text.classify_contains("t", rules).alias("clase"))


def band_sql(age: str = "edad", src: str = "b0") -> str:
    """DuckDB: body columns by age band over a frame with k, edad, peso, talla, imc."""
    values = ", ".join(
        f"({lo}, {hi}, {w[0]}, {w[1]}, {h[0]}, {h[1]}, {b[0]}, {b[1]})" for lo, hi, w, h, b in project.BODY_BANDS
    )
    noise = {
        n: f"(1.0::DOUBLE + ({u_sql('k', c + '|band')} * 2.0::DOUBLE - 1.0::DOUBLE) * 0.03::DOUBLE)"
        for n, c in (("w", "Peso (Kg)"), ("h", "Talla (cm)"), ("b", "IMC"))
    }
    return f"""
SELECT k, edad, redo::INTEGER AS redo,
  CASE WHEN redo THEN (w0 + w1) / 2 * {noise['w']} ELSE peso END AS peso,
  CASE WHEN redo THEN (h0 + h1) / 2 * {noise['h']} ELSE talla END AS talla,
  CASE WHEN redo THEN (b0 + b1) / 2 * {noise['b']} WHEN lo IS NOT NULL AND talla > 0 THEN calc ELSE imc END AS imc
FROM (SELECT *, coalesce(lo IS NOT NULL AND (coalesce(peso NOT BETWEEN w0 AND w1, true) OR coalesce(talla NOT BETWEEN h0 AND h1, true)
        OR coalesce(calc NOT BETWEEN b0 AND b1, true)), false) AS redo
  FROM (SELECT *, CASE WHEN talla > 0 THEN peso / (talla / 100.0) / (talla / 100.0) END AS calc FROM {src})
  LEFT JOIN (VALUES {values}) AS band(lo, hi, w0, w1, h0, h1, b0, b1) ON edad BETWEEN lo AND hi)"""


block("b0", 'SELECT k, "Edad" AS edad, "Peso (Kg)" AS peso, "Talla (cm)" AS talla, "IMC" AS imc FROM preop_v', ("preop_v",))


@query(
    "band_impute_body",
    f'SELECT k, edad AS "Edad", redo AS recalculado_flag, {r("peso")} AS "Peso (Kg)", {r("talla")} AS "Talla (cm)", {r("imc")} AS "IMC" FROM ({band_sql()})',
    needs=("b0",),
)
def band_impute_body(spark, sf):
    df = fx.preop(spark, sf).select("k", "Edad", "Peso (Kg)", "Talla (cm)", "IMC")
    out = project.band_impute_body(df, "k")
    return out.select("k", "Edad", "recalculado_flag", *[r6(c).alias(c) for c in ("Peso (Kg)", "Talla (cm)", "IMC")])


SYS, DIA, MEAN = (f"Tensión Arterial {n} (mm/Hg)" for n in ("Sistólica", "Diastólica", "Media"))
MEAN_SQL = f'CASE WHEN "{MEAN}" BETWEEN 40 AND 200 THEN "{MEAN}" ELSE ("{SYS}" + 2 * "{DIA}") / 3.0 END'


@query("recompute_when_invalid", f"SELECT k, {r(MEAN_SQL)} AS mean FROM preop_v", needs=("preop_v",))
def recompute_when_invalid(spark, sf):
    return fx.preop(spark, sf).select("k", r6(project.mean_pressure(SYS, DIA, MEAN)).alias("mean"))


def vital_sql(name: str) -> str:
    _f, _lo, _hi, normal, p0, p1 = flags.VITAL_RULES[name]
    return f'CASE WHEN "{name}" <> 0 AND "{name}" BETWEEN {p0} AND {p1} THEN "{name}" ELSE {normal} END::DOUBLE'


def abnormal_sql(name: str, e: str) -> str:
    _f, lo, hi, *_ = flags.VITAL_RULES[name]
    high = f" OR {e} > {hi}" if hi is not None else ""
    return f"CASE WHEN {e} < {lo}{high} THEN 1 ELSE 0 END"


@query(
    "invalid_to_normal",
    "SELECT k, "
    + ", ".join(
        f'{vital_sql(n)} AS "{n}", {abnormal_sql(n, "(" + vital_sql(n) + ")")} AS {rule[0]}'
        for n, rule in flags.VITAL_RULES.items()
    )
    + " FROM posop_v",
    needs=("posop_v",),
)
def invalid_to_normal(spark, sf):
    df = fx.posop(spark, sf).select("k", *[col(c) for c in flags.VITAL_RULES])
    df = df.withColumns(
        {c: flags.invalid_to_normal(c, normal, lo, hi) for c, (_f, _l, _h, normal, lo, hi) in flags.VITAL_RULES.items()}
    )
    return df.withColumns({f: flags.outside(c, lo, hi) for c, (f, lo, hi, *_r) in flags.VITAL_RULES.items()})


EXAMPLE_FIELDS = ["Edad", "Peso (Kg)", "IMC", "Hora", "Grupo Sanguíneo", "Alérgeno", "Angina", "Condición"]


@query(
    "complete_example_row",
    f"SELECT k, {cols(EXAMPLE_FIELDS)} FROM preop_v WHERE "
    + " + ".join(f'("{c}" IS NOT NULL)::INTEGER' for c in EXAMPLE_FIELDS)
    + f" >= 0.6 * {len(EXAMPLE_FIELDS)} ORDER BY k LIMIT 1",
    needs=("preop_v",),
)
def complete_example_row(spark, sf):
    df = fx.preop(spark, sf).select("k", *[col(c) for c in EXAMPLE_FIELDS])
    return project.complete_example_row(df, "k", EXAMPLE_FIELDS)
