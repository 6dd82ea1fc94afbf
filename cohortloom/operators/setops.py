"""Set operations on result tables and caches."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.numeric import col


def union_blocks(blocks: Sequence[DataFrame]) -> DataFrame:
    """Stack result tables; a column missing in one of them is null there."""
    out = blocks[0]
    for other in blocks[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def upsert_keep_last(base: DataFrame, new: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """Base plus new rows, one row per key: the new one wins, then the highest `order`."""
    both = base.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    rest = [c for c in base.columns if c not in key]
    last = both.groupBy(*[col(k) for k in key]).agg(
        F.max_by(F.struct(*[col(c) for c in rest]), F.struct("_new", col(order))).alias("r")
    )
    return last.select(*[col(k) for k in key], *[F.col("r")[c].alias(c) for c in rest])


def compare_sets(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Distinct values marked common, only_left or only_right."""
    a, b = left.select(column).distinct(), right.select(column).distinct()
    return union_blocks(
        [
            a.intersect(b).withColumn("side", F.lit("common")),
            a.exceptAll(b).withColumn("side", F.lit("only_left")),
            b.exceptAll(a).withColumn("side", F.lit("only_right")),
        ]
    )
