"""Hash-based sampling: splits, folds and balancing that depend only on key and seed.

Rows are ordered within their class by (hash, key). A cut keeps the first k rows of that
order without sorting a class: a count per hash bucket finds the bucket that holds the
k-th row, and only the rows of that one bucket are ordered.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortloom.functions.hashing import hash32
from cohortloom.functions.numeric import col, ratio

BUCKET_BITS = 16


def _hashed(df: DataFrame, key: str, label: str, salt: str, seed: int) -> DataFrame:
    h = hash32(col(key), salt, seed)
    return df.select(col(key).alias("_k"), col(label).alias("_c"), h.alias("_h")).withColumn(
        "_b", F.shiftright("_h", 32 - BUCKET_BITS)
    )


def class_cuts(df: DataFrame, key: str, label: str, sizes: DataFrame, salt: str, seed: int) -> DataFrame:
    """(class, cut): hash and key of the k-th row of each class; sizes: (_c, k)."""
    hashed = _hashed(df, key, label, salt, seed)
    counts = hashed.groupBy("_c", "_b").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("_c").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (
        counts.withColumn("cum", F.sum("n").over(upto)).join(sizes, "_c")
        .where((F.col("cum") >= F.col("k")) & (F.col("cum") - F.col("n") < F.col("k")))
        .select("_c", "_b", (F.col("k") - F.col("cum") + F.col("n")).alias("r"))
    )
    place = Window.partitionBy("_c").orderBy("_h", "_k")
    edge = hashed.join(found, ["_c", "_b"]).withColumn("p", F.row_number().over(place)).where("p = r")
    return edge.select("_c", F.struct("_h", "_k").alias("cut"))


def class_sizes(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(col(label).alias("_c")).agg(F.count(F.lit(1)).alias("n"))


def _mark(df: DataFrame, key: str, label: str, cuts: DataFrame, name: str, salt: str, seed: int) -> DataFrame:
    """0/1 column: the row is among the first k of its class.

    The cuts (one per class) reach the rows as a scalar map, so no row is shuffled.
    """
    entries = F.map_from_entries(F.collect_list(F.struct("_c", "cut")))
    staged = df.withColumn("_cuts", cuts.agg(entries.alias("m")).scalar())
    place = F.struct(hash32(col(key), salt, seed).alias("_h"), col(key).alias("_k"))
    cut = F.try_element_at("_cuts", col(label))
    return staged.withColumn(name, F.coalesce(place <= cut, F.lit(False)).cast("int")).drop("_cuts")


def share(n: Column, part: float) -> Column:
    return F.floor(n * F.lit(part) + F.lit(0.5))


def split_stratified(df: DataFrame, key: str, label: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds `split` ('train' or 'test') with the same class ratio in both."""
    if not 0 < test_size < 1:
        raise ValueError(f"test_size must be between 0 and 1, got {test_size}")
    sizes = class_sizes(df, label).select("_c", share(F.col("n"), test_size).alias("k"))
    cuts = class_cuts(df, key, label, sizes, "split", seed)
    marked = _mark(df, key, label, cuts, "_test", "split", seed)
    return marked.withColumn("split", F.when(F.col("_test") == 1, "test").otherwise("train")).drop("_test")


def split_three_way(
    df: DataFrame, key: str, label: str, test_size: float = 0.2, val_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """Test rows first, then the validation share of the rows that are left."""
    sizes = class_sizes(df, label).withColumn("k", share(F.col("n"), test_size))
    test = class_cuts(df, key, label, sizes.select("_c", "k"), "split", seed)
    both = sizes.select("_c", (F.col("k") + share(F.col("n") - F.col("k"), val_size)).alias("k"))
    held = class_cuts(df, key, label, both, "split", seed)
    out = _mark(_mark(df, key, label, test, "_test", "split", seed), key, label, held, "_held", "split", seed)
    split = F.when(F.col("_test") == 1, "test").when(F.col("_held") == 1, "val").otherwise("train")
    return out.withColumn("split", split).drop("_test", "_held")


def kfold_stratified(df: DataFrame, key: str, label: str, folds: int, seed: int = 42) -> DataFrame:
    """Adds `fold` (0..folds-1): the position in the hashed order of the class, modulo folds.

    Positions are local to a hash bucket plus the size of the buckets before it.
    """
    hashed = _hashed(df, key, label, "fold", seed)
    before = Window.partitionBy("_c").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = hashed.groupBy("_c", "_b").agg(F.count(F.lit(1)).alias("n")).select(
        "_c", "_b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("o")
    )
    local = Window.partitionBy("_c", "_b").orderBy("_h", "_k")
    staged = df.withColumns({"_c": col(label), "_k": col(key), "_h": hash32(col(key), "fold", seed)})
    staged = staged.withColumn("_b", F.shiftright("_h", 32 - BUCKET_BITS))
    placed = staged.withColumn("_p", F.row_number().over(local)).join(offsets, ["_c", "_b"])
    return placed.withColumn("fold", ((F.col("_p") + F.col("o") - 1) % folds).cast("int")).drop(
        "_c", "_k", "_h", "_b", "_p", "o"
    )


def undersample_balance(df: DataFrame, key: str, label: str, seed: int = 42) -> DataFrame:
    """The same number of rows of every class: the size of the smallest one."""
    every = Window.partitionBy(F.lit(1))
    sizes = class_sizes(df, label).select("_c", F.min("n").over(every).alias("k"))
    cuts = class_cuts(df, key, label, sizes, "balance", seed)
    return _mark(df, key, label, cuts, "_keep", "balance", seed).where("_keep = 1").drop("_keep")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight, neg_pos_ratio): balanced weights of a binary label."""
    sums = df.agg(
        F.count_if(col(label) == 0).alias("n0"), F.count_if(col(label) == 1).alias("n1")
    )
    cells = F.array(
        *[F.struct(F.lit(i).alias(label), F.col(f"n{i}").alias("n"), ((F.col("n0") + F.col("n1")) / (2.0 * F.col(f"n{i}"))).alias("weight")) for i in (0, 1)]
    )
    return sums.select(F.explode(cells).alias("c"), ratio(F.col("n0"), F.col("n1")).alias("neg_pos_ratio")).select(
        "c.*", "neg_pos_ratio"
    )


def with_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Weight column from two counts held as a scalar subquery."""
    counts = df.agg(F.struct(F.count_if(col(label) == 0).alias("n0"), F.count_if(col(label) == 1).alias("n1")).alias("s")).scalar()
    total = counts["n0"] + counts["n1"]
    mine = F.when(col(label) == 1, counts["n1"]).otherwise(counts["n0"])
    return df.withColumn(name, total / (F.lit(2.0) * mine))


def hash_positions(df: DataFrame, key: str, salt: str, seed: int) -> DataFrame:
    """(_k, _pos): 0-based position of every row in the hashed order, without a global sort."""
    hashed = _hashed(df.withColumn("_one", F.lit(0)), key, "_one", salt, seed).select("_k", "_h", "_b")
    before = Window.partitionBy(F.lit(1)).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    # one row per hash bucket, at most 2 ** BUCKET_BITS
    offsets = hashed.groupBy("_b").agg(F.count(F.lit(1)).alias("n")).select(
        "_b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("o")
    )
    local = Window.partitionBy("_b").orderBy("_h", "_k")
    placed = hashed.withColumn("_p", F.row_number().over(local)).join(offsets, "_b")
    return placed.select("_k", (F.col("_p") + F.col("o") - 1).alias("_pos"))


def shuffled_column(df: DataFrame, key: str, column: str, salt: str, seed: int) -> DataFrame:
    """The frame with the values of one column permuted over the rows by two hashed orders."""
    values = df.select(col(key).alias("_k"), col(column).alias("_v"))
    source = values.join(hash_positions(df, key, f"{salt}|from", seed), "_k").select("_pos", "_v")
    goal = hash_positions(df, key, f"{salt}|to", seed)
    moved = goal.join(source, "_pos").select("_k", "_v")
    return df.withColumn("_k", col(key)).join(moved, "_k").withColumn(column, F.col("_v")).drop("_k", "_v")
