"""Ranking, top-k, binning and normalisation."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortloom.functions.numeric import col
from cohortloom.operators.ordered import exact_quantiles


def best_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each group; give a unique last order column to settle ties."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def case_type(y_true: Column | str = "y_true", y_pred: Column | str = "y_pred") -> Column:
    t, p = col(y_true), col(y_pred)
    return (
        F.when((t == 1) & (p == 1), "TP").when((t == 0) & (p == 0), "TN")
        .when((t == 1) & (p == 0), "FN").when((t == 0) & (p == 1), "FP")
    )


def reason_text(features: Sequence[str]) -> Column:
    """'feature=value' of up to three features, joined by ' | '."""
    parts = [
        F.concat(F.lit(f"{f}="), F.coalesce(F.round(col(f).cast("double"), 4).cast("string"), F.lit("NA")))
        for f in features[:3]
    ]
    return F.concat_ws(" | ", *parts)


def case_review(
    df: DataFrame, key: str, features: Sequence[str], by: Sequence[str] = (), n: int = 10,
    score: str = "y_proba",
) -> DataFrame:
    """Up to n cases of each type for review, the most telling first.

    FN and TP by falling score, FP and TN by rising score. Spark trims each task to n
    rows per type before the shuffle (WindowGroupLimit), so the types may be of any size.
    """
    staged = df.withColumn("case_type", case_type())
    telling = F.when(F.col("case_type").isin("FN", "TP"), -col(score)).otherwise(col(score))
    w = Window.partitionBy(*by, "case_type").orderBy(telling, col(key))
    top = staged.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
    return top.select(*by, col(key), "case_type", "y_true", "y_pred", score, reason_text(features).alias("reason"))


def top_joined(df: DataFrame, by: Sequence[str], label: str, order: Sequence[Column], k: int = 3, sep: str = " | ") -> DataFrame:
    """(by, top): the first k labels of each group in order, as one text."""
    w = Window.partitionBy(*by).orderBy(*order)
    top = df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
    lists = top.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_r", col(label).alias("t")))).alias("ts"))
    return lists.select(*by, F.array_join(F.transform("ts", lambda x: x["t"]), sep).alias("top"))


def linkage_summary(linkage: DataFrame, informative: float = 0.01) -> DataFrame:
    """Per (version, post_variable): strongest signal, number of informative features, top three."""
    by = ["version", "post_variable"]
    stats = linkage.groupBy(*by).agg(
        F.max("mi").alias("max_mi"),
        F.max("abs_pearson").alias("max_abs_pearson"),
        F.count_if(F.col("mi") > informative).alias("n_informative"),
    )
    top = top_joined(linkage, by, "feature", [F.desc("mi"), F.asc("feature")])
    return stats.join(top.withColumnRenamed("top", "top3"), by)


def rank_rows(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """1-based position of every row of a small result table (one row per model or feature)."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order)))


def minmax_normalise(df: DataFrame, column: str, out: str, constant: float = 0.0) -> DataFrame:
    """(x - min) / (max - min); a constant column becomes `constant`."""
    span = df.agg(F.struct(F.min(col(column)).alias("lo"), F.max(col(column)).alias("hi")).alias("s")).scalar()
    width = span["hi"] - span["lo"]
    return df.withColumn(out, F.when(width > 0, (col(column) - span["lo"]) / width).otherwise(F.lit(constant)))


def quartile_bins(df: DataFrame, column: str, out: str, bins: int = 4) -> DataFrame:
    """Equal-frequency bins 1..bins; right edges belong to the bin, repeated edges merge."""
    values = df.select(col(column).cast("double").alias("_v"))
    probs = [i / bins for i in range(bins + 1)]
    q = exact_quantiles(values, "_v", probs)
    edges = q.select(F.array_distinct(F.array(*[f"q{i}" for i in range(bins + 1)])).alias("e")).scalar()
    staged = df.withColumn("_e", edges)
    # edges below the value, without the lowest one; the lowest edge belongs to the first bin
    below = F.size(F.filter("_e", lambda e: e < col(column)))
    return staged.withColumn(out, F.when(col(column).isNotNull(), F.greatest(below, F.lit(1)))).drop("_e")


AGE_EDGES = (18, 40, 60, 75, 120)


def fixed_bins(c: Column | str, edges: Sequence[float] = AGE_EDGES) -> Column:
    """Right-closed bins as text like '18-40'; the lowest edge is included, outside is null."""
    c = col(c)
    out = F.lit(None).cast("string")
    for i in reversed(range(len(edges) - 1)):
        low = c >= edges[i] if i == 0 else c > edges[i]
        out = F.when(low & (c <= edges[i + 1]), F.lit(f"{edges[i]}-{edges[i + 1]}")).otherwise(out)
    return out


def sort_top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
