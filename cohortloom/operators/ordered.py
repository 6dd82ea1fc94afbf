"""Order statistics without a one-partition window.

Rows are first reduced to a histogram of distinct values (map-side combined, so a
value held by a third of the rows is one row). The histogram is cut into buckets of
similar row counts; running sums are local to a bucket and get the total of the
buckets before it. Bucket edges and totals have a fixed number of rows per group.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window



def bucket_count(spark: SparkSession) -> int:
    """A power of two, at least 64, that grows with the session's shuffle partitions."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(64, 1 << (4 * parts - 1).bit_length())


def histogram(df: DataFrame, value: str, by: Sequence[str] = (), **sums: Column) -> DataFrame:
    """One row per (group, distinct value) with the given sums, or `w` = row count."""
    aggs = [F.sum(c).alias(n) for n, c in sums.items()] or [F.count(F.lit(1)).alias("w")]
    return df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(*aggs)


def with_bucket(hist: DataFrame, value: str, by: Sequence[str], buckets: int) -> DataFrame:
    probs = [i / buckets for i in range(1, buckets)]
    edges = F.percentile_approx(value, probs, 1000)
    if by:
        hist = hist.join(hist.groupBy(*by).agg(edges.alias("_edges")), list(by))
    else:
        hist = hist.withColumn("_edges", hist.agg(edges.alias("_edges")).scalar())
    # binary search for the number of edges below the value, one compiled step per level
    hist = hist.withColumn("_bucket", F.lit(0))
    step = buckets // 2
    while step:
        higher = F.get("_edges", F.col("_bucket") + (step - 1)) < F.col(value)
        hist = hist.withColumn("_bucket", F.col("_bucket") + F.when(higher, step).otherwise(0))
        step //= 2
    return hist.drop("_edges")


def running_totals(
    hist: DataFrame,
    value: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Adds cum_<s> (inclusive running sum in value order) and tot_<s> (group total)."""
    by = list(by)
    h = with_bucket(hist, value, by, buckets or bucket_count(hist.sparkSession))
    order = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    totals = h.groupBy(*by, "_bucket").agg(*[F.sum(s).alias(f"_b_{s}") for s in sums])
    totals = totals.select(
        *by,
        "_bucket",
        *[F.coalesce(F.sum(f"_b_{s}").over(before), F.lit(0)).alias(f"_o_{s}") for s in sums],
        *[F.sum(f"_b_{s}").over(whole).alias(f"tot_{s}") for s in sums],
    )
    local = (
        Window.partitionBy(*by, "_bucket")
        .orderBy(F.col(value).desc() if descending else F.col(value).asc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    h = h.withColumns({f"_l_{s}": F.sum(s).over(local) for s in sums})
    h = h.join(totals, [*by, "_bucket"])
    h = h.withColumns({f"cum_{s}": F.col(f"_l_{s}") + F.col(f"_o_{s}") for s in sums})
    return h.drop("_bucket", *[f"_l_{s}" for s in sums], *[f"_o_{s}" for s in sums])


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact linearly interpolated quantiles: one row per group, columns n, q0, q1, ..."""
    return histogram_quantiles(histogram(df, value, by), value, probs, by)


def histogram_quantiles(hist: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """The same from a histogram with its row counts in w."""
    run = running_totals(hist, value, ["w"], by)
    n = F.col("tot_w")
    picks: list[Column] = [F.max(n).alias("n")]
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (n - 1)
        picks.append(F.min(F.when(F.col("cum_w") > F.floor(pos), F.col(value))).alias(f"_lo{i}"))
        picks.append(F.min(F.when(F.col("cum_w") > F.ceil(pos), F.col(value))).alias(f"_hi{i}"))
    out = run.groupBy(*by).agg(*picks)
    quantiles = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("n") - 1)
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        quantiles.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(f"q{i}"))
    return out.select(*by, "n", *quantiles)


def quantile_scalar(df: DataFrame, value: str, p: float) -> Column:
    """One exact quantile as a scalar subquery, usable inside any projection of any frame."""
    return exact_quantiles(df, value, [p]).select("q0").scalar()


def unpivot_numeric(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Long form (keys, feature, value) with every value cast to double."""
    wide = df.select(*[F.col(f"`{k}`") for k in keys], *[F.col(f"`{c}`").try_cast("double").alias(c) for c in columns])
    return wide.unpivot([f"`{k}`" for k in keys], [f"`{c}`" for c in columns], "feature", "value")
