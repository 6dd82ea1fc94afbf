"""Joins of the preop, postop and score tables."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.numeric import col
from cohortloom.sources.tables import KEY, KEY_ALIAS


def short_key(df: DataFrame) -> DataFrame:
    if KEY_ALIAS in df.columns and KEY not in df.columns:
        return df.withColumnRenamed(KEY_ALIAS, KEY)
    return df


def merge_preop_target(preop: DataFrame, target: DataFrame, key: str = KEY, label: str = "target") -> DataFrame:
    """Inner join on the patient key; only key and target come from the right side.

    A repeated key multiplies rows, see duplicate_keys(). AQE splits a skewed key.
    """
    right = short_key(target)
    for frame, name in ((preop, key), (right, key), (right, label)):
        if name not in frame.columns:
            raise ValueError(f"column {name!r} not found")
    return preop.join(right.select(col(key), label), key, "inner")


def duplicate_keys(df: DataFrame, key: str = KEY) -> DataFrame:
    """Keys that would multiply rows in a join, with their row count."""
    return df.groupBy(col(key)).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def join_flags_profile(preop: DataFrame, flags: DataFrame, names: Sequence[str], key: str = KEY) -> DataFrame:
    """Flag columns next to the preop features; a flag already on the left gets the suffix _pos."""
    left = set(preop.columns)
    right = short_key(flags).select(col(key), *[col(n).alias(f"{n}_pos" if n in left else n) for n in names])
    return preop.join(right, key, "inner")


def spread_nulls(key: str, by: str, ways: int = 256):
    """Join key where nulls become many values that match nothing, so no task gets all of them."""
    filler = F.concat(F.lit("\u0000"), F.pmod(F.hash(col(by)), F.lit(ways)).cast("string"))
    return F.coalesce(col(key).cast("string"), filler)


def left_lookup(df: DataFrame, dim: DataFrame, key: str, row_key: str, dim_key: str | None = None) -> DataFrame:
    """Left join to a table that is unique per key, safe when a large share of the keys is null."""
    right = dim.withColumnRenamed(dim_key or key, "_j")
    return df.withColumn("_j", spread_nulls(key, row_key)).join(right, "_j", "left").drop("_j")


def first_by_hash(
    df: DataFrame, results: DataFrame, text: str, row_key: str, order: str, suffix: str
) -> DataFrame:
    """Left join of per-text results on the md5 of the text.

    Results are first reduced to one row per hash, the one with the smallest `order`;
    their columns get the suffix. Texts that are null hash to '' and match nothing.
    """
    payload = [c for c in results.columns if c not in ("text_hash", order)]
    first = results.groupBy("text_hash").agg(F.min_by(F.struct(*[col(c) for c in payload]), order).alias("r"))
    dim = first.select("text_hash", *[F.col("r")[c].alias(f"{c}{suffix}") for c in payload])
    hashed = df.withColumn("_hash", F.md5(col(text)))
    return left_lookup(hashed, dim, "_hash", row_key, "text_hash").drop("_hash")


def outer_scores(left: DataFrame, right: DataFrame, on: str, fill: float = 0.0) -> DataFrame:
    """Full outer join of two per-feature score tables; a missing score is 0."""
    return left.join(right, on, "full").na.fill(fill)


def left_chain(base: DataFrame, others: Sequence[tuple[DataFrame, Mapping[str, float]]], on: str) -> DataFrame:
    """Chain of left joins; each table brings its columns with a default for missing rows."""
    for other, defaults in others:
        base = base.join(other.select(on, *defaults), on, "left")
        base = base.withColumns({c: F.coalesce(col(c), F.lit(v)) for c, v in defaults.items()})
    return base


def baseline_vs_tuned(baseline: DataFrame, tuned: DataFrame, metrics: Sequence[str], on: str = "version") -> DataFrame:
    """Best baseline next to best tuned row per version, with metric differences."""
    left = baseline.select(on, *[col(m).alias(f"{m}_baseline") for m in metrics])
    right = tuned.select(on, *[col(m).alias(f"{m}_tuned") for m in metrics])
    both = left.join(right, on, "left")
    return both.withColumns({f"delta_{m}": col(f"{m}_tuned") - col(f"{m}_baseline") for m in metrics})
