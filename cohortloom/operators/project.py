"""Projection, filter and imputation operators."""
from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.hashing import uniform
from cohortloom.functions.numeric import between_or_null, clip, col, number_in, to_number
from cohortloom.operators.ordered import exact_quantiles, unpivot_numeric

# Columns whose names were read with the wrong encoding.
ENCODING_FIXES = {
    "PrÃ³tesis Dental_movil": "Prótesis Dental_movil",
    "PrÃ³tesis Dental_no": "Prótesis Dental_no",
    "AlÃ©rgeno_med_opioides": "Alérgeno_med_opioides",
    "AlÃ©rgeno_suplementos": "Alérgeno_suplementos",
    "TensiÃ³n Arterial SistÃ³lica (mm/Hg)": "Tensión Arterial Sistólica (mm/Hg)",
    "TensiÃ³n Arterial DiastÃ³lica (mm/Hg)": "Tensión Arterial Diastólica (mm/Hg)",
    "TensiÃ³n Arterial Media (mm/Hg)": "Tensión Arterial Media (mm/Hg)",
}
# Allowed ranges of the vital signs.
VITAL_RANGES = {
    "Tensión Arterial Sistólica (mm/Hg)": (60.0, 260.0),
    "Tensión Arterial Diastólica (mm/Hg)": (30.0, 160.0),
    "Frecuencia Respiratoria": (10.0, 60.0),
    "Temperatura": (26.0, 43.0),
    "Edad": (0.0, 110.0),
}
# Age low, age high, weight band, height band, body mass band.
BODY_BANDS = [
    (0, 2, (2.0, 20.0), (50.0, 95.0), (12.0, 20.0)),
    (3, 10, (10.0, 50.0), (80.0, 140.0), (13.0, 22.0)),
    (11, 17, (30.0, 90.0), (120.0, 180.0), (14.0, 28.0)),
    (18, 110, (40.0, 300.0), (140.0, 230.0), (15.0, 40.0)),
]
# Name parts that make a missing value mean zero.
ZERO_KEYWORDS = [
    "score", "predicted_label", "ordinal", "count", "Antecedente", "Diagnóstico", "Procedimiento",
    "Tipo de anestesia",
]


def rename_map(df: DataFrame, names: Mapping[str, str] = ENCODING_FIXES) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*names)


def filter_min_age(df: DataFrame, age: str = "Edad", minimum: float = 18, keep_null: bool = True) -> DataFrame:
    """Rows under the age go; unknown ages stay unless keep_null is False."""
    old_enough = col(age) >= minimum
    # the age is named once: Spark puts its whole expression wherever a filter names it
    return df.where(F.coalesce(old_enough, F.lit(True)) if keep_null else old_enough)


def outlier_nullify(df: DataFrame, rules: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    present = set(df.columns)
    return df.withColumns({c: between_or_null(c, lo, hi) for c, (lo, hi) in rules.items() if c in present})


def numeric_coerce(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    present = set(df.columns)
    return df.withColumns({c: number_in(df, c) for c in columns if c in present})


def impute_constant(df: DataFrame, columns: Sequence[str], value) -> DataFrame:
    present = set(df.columns)
    return df.withColumns({c: F.coalesce(col(c), F.lit(value)) for c in columns if c in present})


def range_clip(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: clip(c, lo, hi) for c, (lo, hi) in ranges.items() if c in df.columns})


def range_random(c: Column | str, low: float, high: float, key: Column | str, name: str, noise: float, seed: int) -> Column:
    """Out-of-range values become a hashed uniform inside the range, with relative noise."""
    return _in_range(to_number(c), low, high, key, name, noise, seed)


def _in_range(v: Column, low: float, high: float, key: Column | str, name: str, noise: float, seed: int) -> Column:
    base = F.lit(low) + F.lit(high - low) * uniform(key, f"{name}|base", seed)
    jitter = F.lit(1.0) + (uniform(key, f"{name}|noise", seed) * 2.0 - 1.0) * F.lit(noise)
    drawn = F.least(F.greatest(base * jitter, F.lit(low)), F.lit(high))
    return F.when(v.between(low, high) | v.isNull(), v).otherwise(drawn)


def range_random_impute(
    df: DataFrame, key: str, ranges: Mapping[str, tuple[float, float]] = VITAL_RANGES,
    noise: float = 0.03, seed: int = 42,
) -> DataFrame:
    present = set(df.columns)
    return df.withColumns(
        {c: _in_range(number_in(df, c), lo, hi, col(key), c, noise, seed) for c, (lo, hi) in ranges.items() if c in present}
    )


def _band_value(age: Column, pick) -> Column:
    """Value of the (fixed, four-row) band table for an age; null between bands."""
    out = F.lit(None).cast("double")
    for low, high, *body in BODY_BANDS:
        out = F.when(age.between(low, high), F.lit(float(pick(*body)))).otherwise(out)
    return out


def band_impute_body(
    df: DataFrame, key: str, age: str = "Edad", weight: str = "Peso (Kg)", height: str = "Talla (cm)",
    bmi: str = "IMC", noise: float = 0.03, seed: int = 42,
) -> DataFrame:
    """Weight, height and body mass by age band.

    If any of the three is unknown or outside its band, all three become the band middle
    with hashed noise and recalculado_flag is set; otherwise body mass is recomputed. Rows
    outside every band pass unchanged. The band table has four fixed rows, so the range
    match is a projection instead of a join.
    """
    a, w, h, b = (number_in(df, c) for c in (age, weight, height, bmi))
    computed = F.when(h > 0, w / (h / 100.0) / (h / 100.0))
    in_band = _band_value(a, lambda *_: 1).isNotNull()

    def bad(value: Column, i: int) -> Column:
        low = _band_value(a, lambda *body: body[i][0])
        high = _band_value(a, lambda *body: body[i][1])
        return value.isNull() | (value < low) | (value > high)

    def middle(i: int, name: str) -> Column:
        jitter = F.lit(1.0) + (uniform(col(key), f"{name}|band", seed) * 2.0 - 1.0) * F.lit(noise)
        return _band_value(a, lambda *body: sum(body[i]) / 2) * jitter

    staged = df.withColumns({"_bmi": computed, "_in": in_band})
    staged = staged.withColumn("_redo", F.col("_in") & (bad(w, 0) | bad(h, 1) | bad(F.col("_bmi"), 2)))
    redo = F.col("_redo")
    return staged.withColumns(
        {
            age: a,
            weight: F.when(redo, middle(0, weight)).otherwise(w),
            height: F.when(redo, middle(1, height)).otherwise(h),
            bmi: F.when(redo, middle(2, bmi)).when(F.col("_in") & (h > 0), F.col("_bmi")).otherwise(b),
            "recalculado_flag": F.coalesce(redo, F.lit(False)).cast("int"),
        }
    ).drop("_bmi", "_in", "_redo")


def mean_pressure(systolic: str, diastolic: str, mean: str) -> Column:
    """Mean arterial pressure kept in [40, 200], else (systolic + 2 diastolic) / 3."""
    m = col(mean)
    return F.when(m.between(40, 200), m).otherwise((col(systolic) + col(diastolic) * 2) / 3.0)


def column_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, n, median) for every column, over one scan."""
    return exact_quantiles(unpivot_numeric(df, [], columns), "value", [0.5], ["feature"]).withColumnRenamed(
        "q0", "median"
    )


def fit_medians(df: DataFrame, columns: Sequence[str], min_ratio: float = 0.0) -> dict[str, float]:
    """Driver-side medians of the columns with enough non-null numbers; 0 when none is known."""
    total, *counts = df.agg(F.count(F.lit(1)), *[F.count(to_number(c)) for c in columns]).first()
    kept = [c for c, n in zip(columns, counts) if total and n / total >= min_ratio]
    known = {r["feature"]: r["median"] for r in column_medians(df, kept).collect()} if kept else {}
    return {c: known.get(c, 0.0) for c in kept}


def impute_median(df: DataFrame, keys: Sequence[str], columns: Sequence[str], min_ratio: float = 0.7) -> DataFrame:
    """Keys plus the well-filled columns as numbers, nulls replaced by the column median."""
    medians = fit_medians(df, columns, min_ratio)
    return df.select(
        *[col(k) for k in keys], *[F.coalesce(to_number(c), F.lit(float(m))).alias(c) for c, m in medians.items()]
    )


def imputation_rules(columns: Sequence[str]) -> dict[str, str]:
    """'zero' or 'median' per column, from its name."""
    keywords = [k.lower() for k in ZERO_KEYWORDS]
    return {
        c: "zero" if any(k in c.lower() for k in keywords) or "_encoded" in c or "OneHot" in c else "median"
        for c in columns
    }


def impute_by_rule(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    rules = imputation_rules(columns)
    medians = fit_medians(df, [c for c, rule in rules.items() if rule == "median"])
    fill = {c: medians.get(c, 0.0) if rule == "median" else 0.0 for c, rule in rules.items()}
    return df.select(
        *[col(k) for k in keys], *[F.coalesce(to_number(c), F.lit(float(v))).alias(c) for c, v in fill.items()]
    )


def complete_example_row(df: DataFrame, key: str, fields: Sequence[str], ratio: float = 0.6) -> DataFrame:
    """The first row (by key) with at least `ratio` of the fields filled."""
    filled = sum((col(f).isNotNull().cast("int") for f in fields), F.lit(0))
    row = F.struct(*[col(c) for c in df.columns])
    best = df.where(filled >= ratio * len(fields)).agg(F.min_by(row, col(key)).alias("row"))
    return best.where("row IS NOT NULL").select("row.*")
