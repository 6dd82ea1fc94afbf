"""Feature screening: candidates, mutual information, correlation, univariate tests, outliers."""
from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortloom.functions.numeric import clip, col, to_number
from cohortloom.operators.ordered import exact_quantiles, histogram, running_totals
from cohortloom.session import cut_lineage

NEVER_FEATURES = {"target", "Documento PMD", "Documento_PMD", "n_flags_relevant"}
MAX_BINS = 32
#: Distinct values of a class in one window.
WINDOW_VALUES = 50_000


def column_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, n, n_values, n_numbers, varied, varied_numbers) of each column, from one pass: rows,
    values, numbers, and whether there is more than one of either."""
    cells = []
    for c in columns:
        v, number = col(c), to_number(col(c).cast("string"))
        cells.append(
            F.struct(
                F.lit(c).alias("feature"),
                F.count(F.lit(1)).alias("n"),
                F.count(v).alias("n_values"),
                F.count(number).alias("n_numbers"),
                F.coalesce(F.min(v) < F.max(v), F.lit(False)).alias("varied"),
                F.coalesce(F.min(number) < F.max(number), F.lit(False)).alias("varied_numbers"),
            )
        )
    return df.agg(F.array(*cells).alias("c")).select(F.explode("c").alias("c")).select("c.*")


def screened_columns(df: DataFrame, exclude: Sequence[str] = (), min_ratio: float = 0.4) -> DataFrame:
    """column_counts() of all columns that may be features, with `candidate`: enough numbers and more
    than one distinct number."""
    banned = NEVER_FEATURES | set(exclude)
    names = [c for c in df.columns if c not in banned and not c.startswith("flag_")]
    enough = F.coalesce(F.try_divide(F.col("n_numbers"), F.col("n")) >= min_ratio, F.lit(False))
    return column_counts(df, names).withColumn("candidate", enough & F.col("varied_numbers"))


def candidate_features(df: DataFrame, exclude: Sequence[str] = (), min_ratio: float = 0.4) -> list[str]:
    """Names of the candidates, in column order; no keys, flags or target."""
    if not set(df.columns) - NEVER_FEATURES - set(exclude):
        return []
    found = {r["feature"] for r in screened_columns(df, exclude, min_ratio).where("candidate").collect()}
    return [c for c in df.columns if c in found]


def drop_constant(df: DataFrame, columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """(kept, constant): a column is constant when its minimum equals its maximum."""
    present = [c for c in columns if c in set(df.columns)]
    if not present:
        return [], []
    varied = {r["feature"] for r in column_counts(df, present).where("varied").collect()}
    return [c for c in present if c in varied], [c for c in present if c not in varied]


def long_features(df: DataFrame, features: Sequence[str], outcomes: Sequence[str], fill: float | None = -1.0) -> DataFrame:
    """(feature, value, outcomes): numbers in long form, missing ones filled."""
    def number(c: str):
        v = to_number(c)
        return v if fill is None else F.coalesce(v, F.lit(fill))

    cells = F.array(*[F.struct(F.lit(c).alias("feature"), number(c).alias("value")) for c in features])
    return df.select(*[col(o).cast("bigint").alias(o) for o in outcomes], F.explode(cells).alias("c")).select(
        "c.*", *outcomes
    )


def bin_edges(long: DataFrame, bins: int = MAX_BINS) -> DataFrame:
    """(feature, edges): the distinct values of few-valued features, else quantile edges."""
    hist = histogram(long, "value", ["feature"])
    order = Window.partitionBy("feature").orderBy("value")
    first = hist.withColumn("r", F.row_number().over(order)).where(F.col("r") <= bins + 1)
    few = first.groupBy("feature").agg(F.array_sort(F.collect_list("value")).alias("few"))
    q = exact_quantiles(long, "value", [i / bins for i in range(1, bins)], ["feature"])
    quantiles = q.select("feature", F.array_distinct(F.array(*[f"q{i}" for i in range(bins - 1)])).alias("many"))
    return few.join(quantiles, "feature").select(
        "feature", F.when(F.size("few") <= bins, F.col("few")).otherwise(F.col("many")).alias("edges")
    )


def contingency(long: DataFrame, outcomes: Sequence[str], bins: int = MAX_BINS) -> DataFrame:
    """(feature, bin, outcome, n, pos): rows and positives per bin, all outcomes in one pass.

    The edges, one row a feature, go to every task: a join by feature would put all rows of a feature into one.
    """
    binned = long.where("value IS NOT NULL").join(F.broadcast(bin_edges(long, bins)), "feature").withColumn(
        "bin", F.size(F.filter("edges", lambda e: e < F.col("value")))
    )
    sums = binned.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"), *[F.sum(o).alias(o) for o in outcomes])
    return sums.unpivot(["feature", "bin", "n"], list(outcomes), "outcome", "pos")


def information(table: DataFrame) -> DataFrame:
    """(feature, outcome, mi): plug-in mutual information in nats from a contingency table."""
    by = Window.partitionBy("feature", "outcome")
    t = table.withColumns({"tot": F.sum("n").over(by), "p": F.sum("pos").over(by)})

    def term(cell, margin):
        return F.when(cell > 0, cell / F.col("tot") * F.log(cell * F.col("tot") / (F.col("n") * margin))).otherwise(0.0)

    mi = term(F.col("pos"), F.col("p")) + term(F.col("n") - F.col("pos"), F.col("tot") - F.col("p"))
    return t.groupBy("feature", "outcome").agg(F.greatest(F.sum(mi), F.lit(0.0)).alias("mi"))


def digamma(n: Column) -> Column:
    """Of a positive number: eight steps up, then the asymptotic series."""
    x = n + 8.0
    steps = sum((1.0 / (n + float(i)) for i in range(1, 8)), 1.0 / n)
    return F.log(x) - 0.5 / x - 1 / (12 * x * x) + 1 / (120 * x * x * x * x) - 1 / (252 * x * x * x * x * x * x) - steps


def _nearest_in_class(classes: DataFrame, k: int) -> DataFrame:
    """classes: (feature, y, value, n), a row a distinct value. Adds size (rows of the class) and radius,
    the distance to the k-th nearest other row of the class (the farthest, if it has fewer).

    Values are numbered in order and cut into blocks by number; the k values at both ends of a block also
    go to its neighbours, so no window holds a whole class.
    """
    ranked = running_totals(classes.withColumn("one", F.lit(1)), "value", ["one", "n"], ["feature", "y"])
    number = F.col("cum_one") - 1
    first, last = (F.floor(F.greatest(number + d, F.lit(0)) / WINDOW_VALUES) for d in (-k, k))
    dealt = ranked.withColumn("_home", F.floor(number / WINDOW_VALUES)).withColumn("_block", F.explode(F.sequence(first, last)))
    w = Window.partitionBy("feature", "y", "_block").orderBy("value")
    near = [F.struct(F.lit(0.0).alias("d"), (F.col("n") - 1).alias("n"))]
    for i in range(1, k + 1):
        for move in (F.lag, F.lead):
            near.append(F.struct(F.abs(F.col("value") - move("value", i).over(w)).alias("d"), F.coalesce(move("n", i).over(w), F.lit(0)).alias("n")))
    found = dealt.withColumn("_near", F.array(*near)).where("_home = _block")
    wanted = F.least(F.lit(k), F.col("tot_n") - 1)
    start = F.struct(wanted.cast("bigint").alias("left"), F.lit(0.0).alias("r"))
    step = lambda a, x: F.struct((a["left"] - x["n"]).alias("left"), F.when(a["left"] > 0, x["d"]).otherwise(a["r"]).alias("r"))
    near = F.array_sort(F.filter("_near", lambda x: x["n"] > 0))
    return found.select("feature", "y", "value", "n", F.col("tot_n").alias("size"), F.aggregate(near, start, step, lambda a: a["r"]).alias("radius"))


def neighbour_information(long: DataFrame, outcome: str, k: int = 3) -> DataFrame:
    """(feature, mi) in nats by nearest neighbours: a row's distance to the k-th nearest row of its class,
    against the number of all rows nearer than that.

    long: (feature, value, outcome). Equal values are at distance 0. Where that is the distance to the
    k-th, the value is a common one and its rows enter as a cell of a table, by logarithms of counts; so
    columns of few values give the plug-in estimate. Classes of one row are left out. Distances that differ by rounding alone
    count as equal. Works on histograms of distinct values; ranges are counted by running totals.
    """
    hist = histogram(long.select("feature", "value", F.col(outcome).alias("y")).where("y IS NOT NULL"), "value", ["feature", "y"]).withColumnRenamed("w", "n")
    sizes = hist.groupBy("feature", "y").agg(F.sum("n").alias("_size")).where("_size > 1").drop("_size")
    classes = cut_lineage(hist.join(sizes, ["feature", "y"], "left_semi"))  # read for the distances and the counts
    inside = F.col("radius") - 1e-12 * (F.abs("value") + F.col("radius"))
    rows = _nearest_in_class(classes, k).withColumn("_r", F.greatest(inside, F.lit(0.0)))
    rows = cut_lineage(rows.withColumns({"lo": F.col("value") - F.col("_r"), "hi": F.col("value") + F.col("_r")}))
    ends = reduce(DataFrame.unionByName, [rows.select("feature", F.col(c).alias("value"), F.lit(0).cast("bigint").alias("w")) for c in ("lo", "hi")])
    points = classes.select("feature", "value", F.col("n").alias("w")).unionByName(ends).groupBy("feature", "value").agg(F.sum("w").alias("w"))
    run = cut_lineage(running_totals(points, "value", ["w"], ["feature"]))
    below = run.select("feature", F.col("value").alias("lo"), (F.col("cum_w") - F.col("w")).alias("_below"))
    upto = run.select("feature", F.col("value").alias("hi"), F.col("cum_w").alias("_upto"), F.col("tot_w").alias("total"))
    counted = rows.join(below, ["feature", "lo"]).join(upto, ["feature", "hi"])
    size, n, total, m = (F.col(c).cast("double") for c in ("size", "n", "total", "_m"))
    smooth = digamma(total) + digamma(F.least(F.lit(float(k)), size - 1)) - digamma(size) - digamma(m)
    atom = F.log(total) + F.log(n) - F.log(size) - F.log(m)
    counted = counted.withColumn("_m", F.col("_upto") - F.col("_below"))
    terms = counted.select("feature", n.alias("_n"), (n * F.when(F.col("_r") > 0, smooth).otherwise(atom)).alias("_t"))
    return terms.groupBy("feature").agg(F.greatest(F.sum("_t") / F.sum("_n"), F.lit(0.0)).alias("mi"))


def mutual_information(df: DataFrame, features: Sequence[str], target: str, bins: int | None = None, k: int = 3) -> DataFrame:
    """(feature, mi) of every feature with a class; with `bins` the plug-in estimate over that many bins."""
    long = long_features(df, features, [target])
    if bins is None:
        return neighbour_information(long, target, k)
    return information(contingency(long, [target], bins)).select("feature", "mi")


def correlations(long: DataFrame, outcomes: Sequence[str]) -> DataFrame:
    """(feature, outcome, abs_pearson); a constant side gives 0."""
    wide = long.groupBy("feature").agg(
        *[F.abs(F.coalesce(F.nanvl(F.corr("value", o), F.lit(None).cast("double")), F.lit(0.0))).alias(o) for o in outcomes]
    )
    return wide.unpivot(["feature"], list(outcomes), "outcome", "abs_pearson")


def linkage(df: DataFrame, features: Sequence[str], outcomes: Sequence[str], bins: int = MAX_BINS) -> DataFrame:
    """(feature, outcome, mi, abs_pearson, combined): 0.7 information + 0.3 correlation."""
    long = long_features(df, features, outcomes)
    both = information(contingency(long, outcomes, bins)).join(correlations(long, outcomes), ["feature", "outcome"])
    return both.withColumn("combined", 0.7 * F.col("mi") + 0.3 * F.col("abs_pearson"))


def pre_post_linkage(frames: dict[str, DataFrame], features: Sequence[str], outcomes: Sequence[str], bins: int = MAX_BINS) -> DataFrame:
    """Linkage of each version's merged frame; outcomes with one class are left out."""
    out = None
    for version, df in frames.items():
        means = df.agg(*[F.avg(col(o).cast("double")).alias(o) for o in outcomes])
        prevalence = means.unpivot([], list(outcomes), "outcome", "prevalence").where("prevalence > 0 AND prevalence < 1")
        part = linkage(df, features, outcomes, bins).join(prevalence, "outcome").select(
            F.lit(version).alias("version"), F.col("outcome").alias("post_variable"), "feature", "mi",
            "abs_pearson", "combined", "prevalence",
        )
        out = part if out is None else out.unionByName(part)
    return out


def version_linkage(
    df: DataFrame, features: Sequence[str], flags: Sequence[str], versions: Sequence[str], bins: int = MAX_BINS
) -> DataFrame:
    """pre_post_linkage() of versions that are columns of one merged frame: all flags and all versions
    are outcomes of one contingency table, and the flags' rows are given for each version."""
    outcomes = [*flags, *versions]
    df = cut_lineage(df.select(*[col(c) for c in (*features, *outcomes)]))  # read by five aggregations
    means = df.agg(*[F.avg(col(o).cast("double")).alias(o) for o in outcomes])
    prevalence = means.unpivot([], outcomes, "outcome", "prevalence").where("prevalence > 0 AND prevalence < 1")
    found = linkage(df, features, outcomes, bins).join(prevalence, "outcome")
    is_version = F.col("outcome").isin(list(versions))
    every = F.array(*[F.lit(v) for v in versions])
    return found.select(
        F.explode(F.when(is_version, F.array("outcome")).otherwise(every)).alias("version"),
        F.when(is_version, "target").otherwise(F.col("outcome")).alias("post_variable"),
        "feature", "mi", "abs_pearson", "combined", "prevalence",
    )


def univariate_tests(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(feature, n0, n1, auc, u, z, mean0, mean1): rank statistics per feature, ties averaged.

    u counts the pairs where the class-0 value is the larger one (ties half); z is the
    normal score with tie and continuity correction.
    """
    long = long_features(df, features, [target], fill=None)
    y = F.col(target)
    run = running_totals(histogram(long, "value", ["feature"], pos=y, neg=1 - y), "value", ["pos", "neg"], ["feature"])
    pos, neg, t = F.col("pos"), F.col("neg"), (F.col("pos") + F.col("neg")).cast("double")
    stats = run.groupBy("feature").agg(
        F.max("tot_neg").alias("n0"),
        F.max("tot_pos").alias("n1"),
        F.sum(pos * (F.col("cum_neg") - neg / 2)).alias("_u1"),
        F.sum(t * t * t - t).alias("_ties"),
        (F.sum(neg * F.col("value")) / F.max("tot_neg")).alias("mean0"),
        (F.sum(pos * F.col("value")) / F.max("tot_pos")).alias("mean1"),
    )
    n0, n1 = F.col("n0").cast("double"), F.col("n1").cast("double")
    n = n0 + n1
    u0 = n0 * n1 - F.col("_u1")
    sigma = F.sqrt(n0 * n1 / 12 * (n + 1 - F.col("_ties") / (n * (n - 1))))
    return stats.select(
        "feature", "n0", "n1",
        F.try_divide(F.col("_u1"), n0 * n1).alias("auc"),
        u0.alias("u"),
        F.try_divide(F.greatest(F.abs(u0 - n0 * n1 / 2) - 0.5, F.lit(0.0)), sigma).alias("z"),
        "mean0", "mean1",
    )


def with_p_value(stats: DataFrame) -> DataFrame:
    """Two-sided normal p-value of the `z` column of a small result table."""

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["p_value"] = [math.erfc(z / math.sqrt(2)) if pd.notna(z) else None for z in frame["z"]]
            yield frame

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stats.schema)
    return stats.mapInPandas(add, f"{fields}, p_value double")


# ---- outliers ---------------------------------------------------------------------------------
def iqr_fences(df: DataFrame, column: str, factor: float = 1.5):
    """(low, high) fences as scalar columns from the exact quartiles."""
    q = exact_quantiles(df.select(to_number(column).alias("_v")), "_v", [0.25, 0.75])
    s = q.select(F.struct("q0", "q1").alias("s")).scalar()
    width = s["q1"] - s["q0"]
    return s["q0"] - width * factor, s["q1"] + width * factor


def outlier_iqr(df: DataFrame, columns: Sequence[str], how: str = "detect", factor: float = 1.5) -> DataFrame:
    """detect: one 0/1 column per input; clip: values limited to the fences; remove: rows dropped.

    Removal is sequential: the fences of a column are computed on the rows the columns
    before it left; nulls stay. strict removal also drops nulls.
    """
    if how in ("remove", "remove_strict"):
        for c in columns:
            low, high = iqr_fences(df, c, factor)
            inside = (to_number(c) >= low) & (to_number(c) <= high)
            df = df.where(inside if how == "remove_strict" else inside | col(c).isNull())
        return df
    out = {}
    for c in columns:
        low, high = iqr_fences(df, c, factor)
        v = to_number(c)
        if how == "clip":
            out[c] = F.when(v.isNotNull(), F.least(F.greatest(v, low), high))
        else:
            out[f"{c}_outlier"] = F.coalesce((v < low) | (v > high), F.lit(False)).cast("int")
    return df.withColumns(out)


def outlier_zscore(df: DataFrame, columns: Sequence[str], threshold: float = 3.0) -> DataFrame:
    stats = df.agg(
        F.struct(
            *[F.avg(to_number(c)).alias(f"m{i}") for i, c in enumerate(columns)],
            *[F.stddev_pop(to_number(c)).alias(f"s{i}") for i, c in enumerate(columns)],
        ).alias("s")
    ).scalar()
    return df.withColumns(
        {
            f"{c}_outlier": F.coalesce(F.abs(F.try_divide(to_number(c) - stats[f"m{i}"], stats[f"s{i}"])) > threshold, F.lit(False)).cast("int")
            for i, c in enumerate(columns)
        }
    )


def group_contrast(df: DataFrame, columns: Sequence[str], group: str) -> DataFrame:
    """(feature, mean_1, mean_0, difference) of marked and other rows."""
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.avg(F.when(col(group) == 1, to_number(c))).alias("mean_1"),
                F.avg(F.when(col(group) == 0, to_number(c))).alias("mean_0"),
            )
            for c in columns
        ]
    )
    return df.agg(cells.alias("c")).select(F.explode("c").alias("c")).select("c.*").withColumn(
        "difference", F.col("mean_1") - F.col("mean_0")
    )
