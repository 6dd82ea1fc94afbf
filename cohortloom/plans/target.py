"""Binary targets from outcome flags: counts, boolean expressions, versions."""
from __future__ import annotations

import re
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.numeric import col, flag
from cohortloom.plans.flags import ALL_FLAGS, flags_all

# Which family flags count by default.
RELEVANT_FLAGS = [
    "flag_cancelacion", "flag_via_aerea", "flag_liquidos", "flag_desenlace",
    "flag_complicaciones_medicas", "flag_estancia", "flag_seguimiento",
]
EXCLUDED_FLAGS = [f for f in ALL_FLAGS if f not in RELEVANT_FLAGS]

_STRICT = [
    "flag_cancelacion", "flag_reservas", "flag_via_aerea", "flag_induccion", "flag_tiempos",
    "flag_tecnica", "flag_complicaciones_medicas", "flag_estancia", "flag_seguimiento",
]
_REFINED = {
    "flag_via_aerea_r": "flag_intubacion_dificil OR flag_tipo_intubacion_complejo OR flag_elemento_via_aerea_complejo",
    "flag_estancia_r": "flag_uci_no_planeada OR flag_estancia_uci",
    "flag_desenlace_r": "flag_destino_uci OR (flag_intubado_salida AND flag_uci_no_planeada)",
}
_D_V2 = (
    "flag_via_aerea_r OR flag_estancia_r OR flag_desenlace_r OR flag_complicaciones_medicas "
    "OR flag_liquidos OR flag_seguimiento"
)

# The target catalogue. `flags` with a threshold, or `define` + `expression`.
TARGETS: dict[str, dict] = {
    "target_a_sensible": {"threshold": 1, "flags": ALL_FLAGS},
    "target_b_clinicamente_relevante": {"threshold": 1, "flags": _STRICT},
    "target_c_alta_severidad": {"threshold": 2, "flags": _STRICT},
    "target_d_eventos_adversos": {"threshold": 1, "flags": RELEVANT_FLAGS},
    "target_d_v2": {"define": _REFINED, "expression": _D_V2},
    "target_d_v2_hosp": {
        "define": _REFINED,
        "expression": _D_V2 + " OR flag_hospitalizacion_no_anticipada",
    },
    "target_d_v5": {
        "expression": (
            "flag_destino_uci OR flag_uci_no_planeada OR flag_complicaciones_medicas OR "
            "flag_intubacion_dificil OR flag_aferesis OR flag_perdidas_altas OR "
            "flag_urgencias_30_dias OR flag_hospitalizacion_no_anticipada"
        )
    },
    "target_e_alta_senal": {
        "threshold": 1,
        "flags": ["flag_estancia", "flag_tecnica", "flag_tiempos", "flag_fisiologicas"],
    },
    "target_f_predictibilidad_maxima": {
        "expression": (
            "flag_interconsultas OR flag_hospitalizacion_no_anticipada OR flag_uci_no_planeada "
            "OR flag_estancia_uci OR flag_estancia_prolongada"
        )
    },
}
ACTIVE_TARGETS = ["target_d_v2_hosp", "target_f_predictibilidad_maxima"]

_TOKEN = re.compile(r"\s*(\(|\)|[A-Za-z_][A-Za-z_0-9]*)")
_WORDS = {"AND", "OR", "NOT"}


def boolean_sql(expression: str, columns: Collection[str]) -> str:
    """Check an AND/OR/NOT expression against the known columns and give Spark SQL for it."""
    out, pos = [], 0
    text = expression.strip()
    while pos < len(text):
        m = _TOKEN.match(text, pos)
        if not m:
            raise ValueError(f"unexpected text at {text[pos:]!r}")
        token = m.group(1)
        if token in ("(", ")") or token in _WORDS:
            out.append(token)
        elif token in columns:
            out.append(f"(coalesce(`{token}`, 0) <> 0)")
        else:
            raise ValueError(f"unknown column {token!r} in target expression")
        pos = m.end()
    return " ".join(out)


def add_boolean_flags(df: DataFrame, definitions: Mapping[str, str]) -> DataFrame:
    """Named 0/1 columns from expressions, in order; later ones may use earlier ones."""
    for name, expression in definitions.items():
        df = df.withColumn(name, F.expr(boolean_sql(expression, df.columns)).cast("int"))
    return df


def _unless_cancelled(target: Column) -> Column:
    not_medical = (col("canceladas") == 1) & (col("canceladas_por_medico") == 0)
    return F.when(not_medical, F.lit(0)).otherwise(target)


def cancel_override(df: DataFrame, target: str = "target") -> DataFrame:
    """Cancelled, but not by the doctor: the target is 0."""
    if "canceladas" not in df.columns or "canceladas_por_medico" not in df.columns:
        return df
    return df.withColumn(target, _unless_cancelled(col(target)))


def flag_total(flags: Sequence[str]) -> Column:
    return sum((F.coalesce(col(f).cast("int"), F.lit(0)) for f in flags), F.lit(0))


def target_threshold(
    df: DataFrame, flags: Sequence[str] | None = None, threshold: int = 1, override: bool = True
) -> DataFrame:
    """Target 1 when at least `threshold` of the flags are set; a missing flag is an error."""
    flags = list(flags or RELEVANT_FLAGS)
    missing = [f for f in flags if f not in df.columns]
    if missing:
        raise ValueError(f"flag columns not found: {missing}")
    df = df.withColumn("n_flags_relevant", flag_total(flags))
    df = df.withColumn("target", flag(col("n_flags_relevant") >= threshold))
    return cancel_override(df) if override else df


def target_expression(
    df: DataFrame, expression: str, define: Mapping[str, str] | None = None, override: bool = True
) -> DataFrame:
    df = add_boolean_flags(df, {**(define or {}), "target": expression})
    return cancel_override(df) if override else df


def extract_target(df: DataFrame, version: str | Mapping, stay_days: float = 3) -> DataFrame:
    """Raw postop rows (or rows that carry flags) -> the same rows with `target`."""
    cfg = TARGETS[version] if isinstance(version, str) else version
    df = flags_all(df, stay_days)
    override = cfg.get("override", True)
    if "expression" in cfg:
        return target_expression(df, cfg["expression"], cfg.get("define"), override)
    return target_threshold(df, cfg["flags"], cfg.get("threshold", 1), override)


def target_wide(df: DataFrame, key: str, versions: Sequence[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One scan to the key, the kept columns (flags too) and one 0/1 column per target definition."""
    versions = list(versions or TARGETS)
    df = flags_all(df)
    shared: dict[str, str] = {}
    for v in versions:
        shared |= TARGETS[v].get("define", {})
    known = set(df.columns)
    df = df.withColumns({k: F.expr(boolean_sql(e, known)).cast("int") for k, e in shared.items()})
    known |= set(shared)
    outcomes = []
    for v in versions:
        cfg = TARGETS[v]
        if "expression" in cfg:
            hit = F.expr(boolean_sql(cfg["expression"], known)).cast("int")
        else:
            hit = flag(flag_total(cfg["flags"]) >= cfg["threshold"])
        outcomes.append(_unless_cancelled(hit).alias(v))
    return df.select(col(key), *[col(c) for c in keep], *outcomes)


def target_versions(df: DataFrame, key: str, versions: Sequence[str] | None = None) -> DataFrame:
    """Long form (key, version, target)."""
    versions = list(versions or TARGETS)
    return target_wide(df, key, versions).unpivot([f"`{key}`"], versions, "version", "target")


def target_catalogue(df: DataFrame, key: str, versions: Sequence[str] | None = None) -> DataFrame:
    """Counts and prevalence per target version."""
    versions = list(versions or TARGETS)
    return version_counts(target_wide(df, key, versions), versions)


def version_counts(wide: DataFrame, versions: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, version, n, n_pos, prevalence) from 0/1 columns, summed before they are unpivoted."""
    sums = wide.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(v).cast("bigint").alias(v) for v in versions]
    )
    long = sums.unpivot([*by, "n"], list(versions), "version", "n_pos")
    return long.withColumn("prevalence", F.col("n_pos") / F.col("n"))
