"""Data quality, column profiles, prevalence and flag tables."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cohortloom.functions.numeric import col, ratio, width_bucket
from cohortloom.functions.text import split_terms
from cohortloom.operators.ordered import exact_quantiles, histogram_quantiles
from cohortloom.session import cut_lineage
from cohortloom.sources.tables import KEY, KEY_ALIAS


def null_share(columns: Sequence[str]) -> Column:
    """Mean share of nulls over the columns, as one aggregate expression."""
    nulls = sum((col(c).isNull().cast("int") for c in columns), F.lit(0))
    return F.coalesce(F.avg(nulls / F.lit(float(max(len(columns), 1)))), F.lit(0.0))


def table_stats(df: DataFrame, name: str) -> DataFrame:
    """(name, rows, cols, null_pct) in one pass."""
    return df.agg(F.count(F.lit(1)).alias("rows"), (null_share(df.columns) * 100).alias("null_pct")).select(
        F.lit(name).alias("name"), "rows", F.lit(len(df.columns)).alias("cols"), "null_pct"
    )


def schema_warnings(preop: DataFrame, postop: DataFrame) -> list[str]:
    out = []
    if KEY not in preop.columns:
        out.append(f"preop: column {KEY!r} not found")
    if not {KEY, KEY_ALIAS} & set(postop.columns):
        out.append(f"postop: no variant of {KEY!r} found")
    if "target" not in postop.columns:
        out.append("postop: column 'target' not found")
    return out


def validate_raw(preop: DataFrame, postop: DataFrame) -> DataFrame:
    """Rows, columns and null share per table with the schema warnings of the pair."""
    warnings = schema_warnings(preop, postop)
    stats = table_stats(preop, "preop").unionByName(table_stats(postop, "postop"))
    return stats.withColumns(
        {"status": F.lit("warnings" if warnings else "ok"), "warnings": F.lit("; ".join(warnings))}
    )


def cleaning_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows, columns and null share before and after, and the dropped columns."""
    kept = set(after.columns)
    b = before.agg(F.count(F.lit(1)).alias("rows_before"), (null_share(before.columns) * 100).alias("null_pct_before"))
    a = after.agg(F.count(F.lit(1)).alias("rows_after"), (null_share(after.columns) * 100).alias("null_pct_after"))
    both = b.withColumn("_1", F.lit(1)).join(a.withColumn("_1", F.lit(1)), "_1").drop("_1")
    return both.withColumns(
        {
            "rows_removed": F.col("rows_before") - F.col("rows_after"),
            "cols_before": F.lit(len(before.columns)),
            "cols_after": F.lit(len(after.columns)),
            "cols_dropped": F.lit(", ".join(c for c in before.columns if c not in kept)),
        }
    )


def row_digest(df: DataFrame) -> Column:
    return F.md5(F.to_json(F.struct(*[col(c) for c in df.columns]), {"ignoreNullFields": "false"}))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: how many rows repeat an earlier one."""
    counts = df.select(row_digest(df).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def long_row(df: DataFrame, label: str = "item", value: str = "value") -> DataFrame:
    """One-row frame of counts to (item, value) rows."""
    return df.unpivot([], df.columns, label, value)


def quality_report(df: DataFrame) -> DataFrame:
    """(section, item, value): missing per column, duplicate rows, columns per type."""
    missing = df.agg(*[F.count_if(col(c).isNull()).alias(c) for c in df.columns])
    types: dict[str, int] = {}
    for f in df.schema:
        types[f.dataType.simpleString()] = types.get(f.dataType.simpleString(), 0) + 1
    parts = [
        long_row(missing).withColumn("section", F.lit("missing")),
        long_row(duplicate_rows(df)).withColumn("section", F.lit("duplicates")),
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.explode(F.create_map(
            *[x for t, n in sorted(types.items()) for x in (F.lit(t), F.lit(n).cast("bigint"))]
        )).alias("item", "value")).withColumn("section", F.lit("types")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("section", "item", "value")


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, n, nulls, uniques, min, p25, median, mean, p75, max, std) for numeric columns."""
    long = df.select(*[col(c).try_cast("double").alias(c) for c in columns]).unpivot(
        [], [f"`{c}`" for c in columns], "feature", "value"
    )
    # one histogram of distinct values, nulls among them, is written once; all else follows from it
    hist = cut_lineage(long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("w")))
    known = F.col("value").isNotNull()
    basic = hist.groupBy("feature").agg(
        F.sum("w").alias("n"),
        F.coalesce(F.sum(F.when(~known, F.col("w"))), F.lit(0)).alias("nulls"),
        F.count("value").alias("uniques"),
        F.min("value").alias("min"),
        F.try_divide(F.sum(F.col("w") * F.col("value")), F.sum(F.when(known, F.col("w")))).alias("mean"),
        F.max("value").alias("max"),
    )
    spread = hist.where(known).join(basic.select("feature", "mean"), "feature").groupBy("feature").agg(
        F.sqrt(F.try_divide(F.sum(F.col("w") * F.pow(F.col("value") - F.col("mean"), 2)), F.sum("w") - 1)).alias("std")
    )
    quart = histogram_quantiles(hist.where(known), "value", [0.25, 0.5, 0.75], ["feature"]).select(
        "feature", F.col("q0").alias("p25"), F.col("q1").alias("median"), F.col("q2").alias("p75")
    )
    return basic.join(spread, "feature", "left").join(quart, "feature", "left")


def top_values(df: DataFrame, columns: Sequence[str], k: int = 3) -> DataFrame:
    """(feature, n, nulls, uniques, top): the k most frequent values as text, ties by value."""
    long = df.select(*[col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], [f"`{c}`" for c in columns], "feature", "value"
    )
    counts = cut_lineage(long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("w")))
    shown = F.coalesce("value", F.lit("nan"))
    order = Window.partitionBy("feature").orderBy(F.desc("w"), shown)
    top = (
        counts.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)
        .groupBy("feature")
        .agg(F.array_sort(F.collect_list(F.struct("r", F.concat(shown, F.lit(" ("), "w", F.lit(")")).alias("t")))).alias("ts"))
        .select("feature", F.array_join(F.transform("ts", lambda x: x["t"]), ", ").alias("top"))
    )
    basic = counts.groupBy("feature").agg(
        F.sum("w").alias("n"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("w"))), F.lit(0)).alias("nulls"),
        F.count("value").alias("uniques"),
    )
    return basic.join(top, "feature")


def _pairs(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, feature, before, after) as text for the rows both sides have."""
    b = before.select(col(key).alias("_k"), *[col(c).cast("string").alias(f"b{i}") for i, c in enumerate(columns)])
    a = after.select(col(key).alias("_k"), *[col(c).cast("string").alias(f"a{i}") for i, c in enumerate(columns)])
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(f"b{i}").alias("before"), F.col(f"a{i}").alias("after"))
            for i, c in enumerate(columns)
        ]
    )
    return b.join(a, "_k").select("_k", F.explode(cells).alias("c")).select("_k", "c.*")


def column_impact(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Per column: nulls, distinct values, mean and median before and after, changed rows."""
    pairs = _pairs(before, after, key, columns)
    sides = pairs.select(
        "feature", F.explode(F.create_map(F.lit("before"), "before", F.lit("after"), "after")).alias("side", "text")
    )
    uniques = sides.groupBy("feature", "side", "text").count().groupBy("feature").pivot("side", ["before", "after"]).agg(
        F.count("text")
    )
    medians = exact_quantiles(
        sides.select("feature", "side", F.col("text").try_cast("double").alias("v")), "v", [0.5], ["feature", "side"]
    ).groupBy("feature").pivot("side", ["before", "after"]).agg(F.first("q0"))

    def nulls(side: str) -> Column:
        return F.count_if(F.col(side).isNull())

    basic = pairs.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n_total"),
        nulls("before").alias("nulls_before"),
        nulls("after").alias("nulls_after"),
        F.count_if(~F.col("before").eqNullSafe(F.col("after"))).alias("n_changed"),
        F.avg(F.col("before").try_cast("double")).alias("mean_before"),
        F.avg(F.col("after").try_cast("double")).alias("mean_after"),
    )
    out = (
        basic.join(uniques.toDF("feature", "uniques_before", "uniques_after"), "feature")
        .join(medians.toDF("feature", "median_before", "median_after"), "feature", "left")
    )
    return out.withColumns(
        {
            f"delta_{m}": F.col(f"{m}_after") - F.col(f"{m}_before")
            for m in ("nulls", "uniques", "mean", "median")
        }
    )


def changed_samples(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str], n: int = 5) -> DataFrame:
    """The first n changed rows of each column, by key."""
    changed = _pairs(before, after, key, columns).where(~F.col("before").eqNullSafe(F.col("after")))
    order = Window.partitionBy("feature").orderBy("_k")
    return changed.withColumn("r", F.row_number().over(order)).where(F.col("r") <= n).drop("r").withColumnRenamed("_k", key)


def value_frequency_diff(before: DataFrame, after: DataFrame, column: str, k: int = 5) -> DataFrame:
    """Top-k values of either side with their counts before and after."""

    def top(df: DataFrame, name: str) -> DataFrame:
        counts = df.groupBy(F.coalesce(col(column).cast("string"), F.lit("nan")).alias("value")).agg(F.count(F.lit(1)).alias(name))
        return counts.orderBy(F.desc(name), "value").limit(k)

    return top(before, "freq_before").join(top(after, "freq_after"), "value", "full").na.fill(0)


def step_change(before: DataFrame, after: DataFrame, step: str) -> DataFrame:
    """One row: rows and columns before and after a step, new and removed columns."""
    b, a = set(before.columns), set(after.columns)
    rows = before.agg(F.count(F.lit(1)).alias("rows_before")).withColumn("_1", F.lit(1)).join(
        after.agg(F.count(F.lit(1)).alias("rows_after")).withColumn("_1", F.lit(1)), "_1"
    )
    return rows.select(
        F.lit(step).alias("step"),
        "rows_before",
        "rows_after",
        (F.col("rows_after") - F.col("rows_before")).alias("delta_rows"),
        F.lit(len(before.columns)).alias("cols_before"),
        F.lit(len(after.columns)).alias("cols_after"),
        F.lit(len(after.columns) - len(before.columns)).alias("delta_cols"),
        F.lit(", ".join(sorted(a - b))).alias("new_cols"),
        F.lit(", ".join(sorted(b - a))).alias("removed_cols"),
    )


# Columns where a zero is impossible, and the pair whose order is checked.
NEVER_ZERO = [
    "Edad", "Peso (Kg)", "Talla (cm)", "IMC", "Temperatura", "Tensión Arterial Sistólica (mm/Hg)",
    "Tensión Arterial Diastólica (mm/Hg)",
]
PRESSURES = ("Tensión Arterial Sistólica (mm/Hg)", "Tensión Arterial Diastólica (mm/Hg)")


def consistency_counts(df: DataFrame) -> DataFrame:
    """One row: rows, missing cells, contradictory pressures, impossible zeros."""
    present = set(df.columns)
    missing = sum((col(c).isNull().cast("int") for c in df.columns), F.lit(0))
    zeros = sum(
        (F.coalesce((col(c).try_cast("double") == 0).cast("int"), F.lit(0)) for c in NEVER_ZERO if c in present), F.lit(0)
    )
    wrong = F.count_if(col(PRESSURES[0]) < col(PRESSURES[1])) if set(PRESSURES) <= present else F.lit(0)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(missing), F.lit(0)).alias("missing"),
        wrong.cast("bigint").alias("contradictions"),
        F.coalesce(F.sum(zeros), F.lit(0)).alias("impossible_zeros"),
    )


def clinical_consistency(before: DataFrame, after: DataFrame) -> DataFrame:
    """(metric, before, after, change) over rows, missing cells, contradictions, zeros, duplicates."""

    def measured(df: DataFrame, name: str) -> DataFrame:
        return long_row(consistency_counts(df), "metric", name).unionByName(long_row(duplicate_rows(df), "metric", name))

    both = measured(before, "before").join(measured(after, "after"), "metric")
    return both.withColumn("change", F.col("after") - F.col("before"))


def top_conditions(df: DataFrame, systems: Mapping[str, str], n: int = 5) -> DataFrame:
    """(system, top, total): most frequent conditions of comma lists, 'negative' texts ignored."""
    cells = F.array(*[F.struct(F.lit(s).alias("system"), col(c).alias("t")) for s, c in systems.items()])
    terms = (
        df.select(F.explode(cells).alias("c")).select("c.*")
        .where(~F.lower("t").isin("negativo", "ninguno", "nan"))
        .select("system", F.explode(split_terms("t")).alias("term"))
    )
    counts = terms.groupBy("system", "term").agg(F.count(F.lit(1)).alias("w"))
    order = Window.partitionBy("system").orderBy(F.desc("w"), "term")
    ranked = counts.withColumn("r", F.row_number().over(order))
    best = F.sort_array(F.collect_list(F.when(F.col("r") <= n, F.struct("r", F.concat("term", F.lit(" ("), "w", F.lit(")")).alias("t")))))
    return ranked.groupBy("system").agg(best.alias("b"), F.sum("w").alias("total")).select(
        "system", F.array_join(F.transform("b", lambda x: x["t"]), ", ").alias("top"), "total"
    )


def fixed_histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """(bin, low, high, n): equal-width bins between minimum and maximum, empty bins included."""
    values = df.select(col(column).cast("double").alias("v")).where("v IS NOT NULL")
    edges = values.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("e")).scalar()
    counted = values.withColumn("e", edges).groupBy(
        width_bucket(F.col("v"), F.col("e.lo"), F.col("e.hi"), bins).alias("bin"), "e"
    ).agg(F.count(F.lit(1)).alias("n"))
    frame = values.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("e")).select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "e"
    )
    width = (F.col("e.hi") - F.col("e.lo")) / bins
    return frame.join(counted.select("bin", "n"), "bin", "left").select(
        "bin",
        (F.col("e.lo") + width * F.col("bin")).alias("low"),
        (F.col("e.lo") + width * (F.col("bin") + 1)).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def prevalence_grouped(wide: DataFrame, versions: Sequence[str], groups: Mapping[str, str | Column]) -> DataFrame:
    """Positives and prevalence per version: overall and by each grouping.

    Versions stay columns, so one grouping-sets pass over the rows serves all of them.
    """
    names = list(groups)
    df = wide.select(*[(col(c) if isinstance(c, str) else c).cast("string").alias(n) for n, c in groups.items()], *versions)
    sets = [[], *[[F.col(n)] for n in names]]
    sums = df.groupingSets(sets, *[F.col(n) for n in names]).agg(
        F.grouping_id().alias("gid"),
        F.count(F.lit(1)).alias("n_cat"),
        *[F.sum(v).cast("bigint").alias(v) for v in versions],
    )
    full = (1 << len(names)) - 1
    category = F.lit("global")
    value = F.lit("all")
    for i, n in enumerate(names):
        mine = F.col("gid") == full - (1 << (len(names) - 1 - i))
        category = F.when(mine, F.lit(n)).otherwise(category)
        value = F.when(mine, F.col(n)).otherwise(value)
    shaped = sums.select(category.alias("category"), value.alias("category_value"), "n_cat", *versions)
    # the rows of a grouping whose value is unknown are not a category
    shaped = shaped.where("category_value IS NOT NULL")
    long = shaped.unpivot(["category", "category_value", "n_cat"], list(versions), "version", "n_pos_cat")
    return long.withColumn("prevalence_cat", ratio(F.col("n_pos_cat"), F.col("n_cat")))


def nulls_by_column(df: DataFrame) -> DataFrame:
    """(feature, null_share) of the columns that have nulls, largest share first."""
    shares = df.agg(*[F.avg(col(c).isNull().cast("double")).alias(c) for c in df.columns])
    return long_row(shares, "feature", "null_share").where("null_share > 0").orderBy(F.desc("null_share"), "feature")


def target_distribution(df: DataFrame, target: str = "target") -> DataFrame:
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))))


def flag_summary(df: DataFrame, flags: Sequence[str], target: str = "target") -> DataFrame:
    """(flag, total, pct, with_target, pct_with_target) from one pass over the flag columns."""
    cells = F.array(
        *[
            F.struct(F.lit(f).alias("flag"), F.sum(col(f)).alias("total"), F.sum(col(f) * col(target)).alias("with_target"))
            for f in flags
        ]
    )
    return df.agg(F.count(F.lit(1)).alias("n"), cells.alias("c")).select("n", F.explode("c").alias("c")).select(
        "c.flag",
        F.col("c.total").alias("total"),
        (ratio(F.col("c.total"), F.col("n")) * 100).alias("pct"),
        F.col("c.with_target").alias("with_target"),
        (ratio(F.col("c.with_target"), F.col("c.total")) * 100).alias("pct_with_target"),
    )


def flag_count_distribution(df: DataFrame, flags: Sequence[str], target: str = "target") -> DataFrame:
    """(target, n_flags, n): how many rows of each class carry how many flags."""
    total = sum((set_or_not(f) for f in flags[1:]), set_or_not(flags[0]))
    return df.select(col(target).alias("target"), total.alias("n_flags")).groupBy("target", "n_flags").agg(
        F.count(F.lit(1)).alias("n")
    )


def flag_count_summary(df: DataFrame, flags: Sequence[str], target: str = "target") -> DataFrame:
    """Mean and quartiles of the number of flags by class (at most len(flags) distinct values)."""
    total = sum((set_or_not(f) for f in flags[1:]), set_or_not(flags[0]))
    return df.select(col(target).alias("target"), total.alias("v")).groupBy("target").agg(
        F.avg("v").alias("mean"),
        *[F.percentile("v", F.lit(p)).alias(n) for n, p in (("p25", 0.25), ("median", 0.5), ("p75", 0.75))],
    )


def set_or_not(flag: str) -> Column:
    return F.coalesce(col(flag), F.lit(0)).cast("bigint")


def _pair_sums(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """(flag1, flag2, n, s1, s2, s12) for unordered pairs and the diagonal.

    Rows are first counted per pattern of flags (a null flag is not set); the sums of products
    then run over the patterns that occur, not over the rows.
    """
    unpacked = df.select(*[set_or_not(f).alias(f) for f in flags]).groupBy(*[f"`{f}`" for f in flags]).agg(F.count(F.lit(1)).alias("w"))
    pairs = [*combinations(flags, 2), *[(f, f) for f in flags]]
    cells = F.array(*[F.struct(F.lit(a).alias("flag1"), F.lit(b).alias("flag2"), col(a).alias("x"), col(b).alias("y")) for a, b in pairs])
    long = unpacked.select("w", F.explode(cells).alias("c")).select("w", "c.*")
    return long.groupBy("flag1", "flag2").agg(
        F.sum("w").cast("double").alias("n"),
        F.sum(F.col("w") * F.col("x")).cast("double").alias("s1"),
        F.sum(F.col("w") * F.col("y")).cast("double").alias("s2"),
        F.sum(F.col("w") * F.col("x") * F.col("y")).cast("double").alias("s12"),
    ).select("flag1", "flag2", "n", "s1", "s2", "s12")


def flag_cooccurrence(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """(flag1, flag2, pct): share of the flag1 rows that also have flag2."""
    sums = _pair_sums(df, flags)
    swapped = sums.where("flag1 <> flag2").select(
        F.col("flag2").alias("flag1"), F.col("flag1").alias("flag2"), "n", F.col("s2").alias("s1"), F.col("s1").alias("s2"), "s12"
    )
    return sums.unionByName(swapped).select("flag1", "flag2", (ratio(F.col("s12"), F.col("s1")) * 100).alias("pct"))


def flag_correlations(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """(flag1, flag2, correlation) of unordered pairs; null for a constant flag."""
    n, s1, s2, s12 = (F.col(c) for c in ("n", "s1", "s2", "s12"))
    # the flags are 0/1, so their sums of squares are their sums
    corr = F.try_divide(n * s12 - s1 * s2, F.sqrt((n * s1 - s1 * s1) * (n * s2 - s2 * s2)))
    return _pair_sums(df, flags).where("flag1 <> flag2").select(
        F.least("flag1", "flag2").alias("flag1"), F.greatest("flag1", "flag2").alias("flag2"), corr.alias("correlation")
    )


def strong_pairs(correlations: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Pairs at or above the threshold with sign and strength."""
    c = F.col("correlation")
    return correlations.where(F.abs(c) >= threshold).withColumns(
        {
            "kind": F.when(c > 0, "Positiva").otherwise("Negativa"),
            "strength": F.when(F.abs(c) >= 0.7, "Fuerte").when(F.abs(c) >= 0.5, "Moderada").otherwise("Débil"),
        }
    )


def feature_frequency(selected: DataFrame, n_versions: int) -> DataFrame:
    """(feature, n_versions, consensus): in how many versions a feature was selected."""
    need = -(-n_versions // 2)
    return selected.groupBy("feature").agg(F.countDistinct("version").alias("n_versions")).withColumn(
        "consensus", (F.col("n_versions") >= need).cast("int")
    )


def selection_matrix(selected: DataFrame, versions: Sequence[str]) -> DataFrame:
    """Feature by version 0/1 table."""
    marks = selected.groupBy("feature").pivot("version", list(versions)).agg(F.count(F.lit(1)))
    return marks.select("feature", *[F.when(col(v) > 0, 1).otherwise(0).alias(v) for v in versions])


def metric_pivot(metrics: DataFrame, models: Sequence[str], metric: str) -> DataFrame:
    return metrics.groupBy("version").pivot("model", list(models)).agg(F.max(metric))


def fold_summary(folds: DataFrame, metrics: Sequence[str], by: Sequence[str] = ("version", "model")) -> DataFrame:
    """Mean and deviation of fold metrics: population (_std) and sample (_std_sample)."""
    return folds.groupBy(*by).agg(
        *[F.avg(m).alias(f"{m}_mean") for m in metrics],
        *[F.stddev_pop(m).alias(f"{m}_std") for m in metrics],
        *[F.stddev_samp(m).alias(f"{m}_std_sample") for m in metrics],
    )
