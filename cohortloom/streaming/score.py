"""Stateless scoring of a stream of records with a fitted model."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.operators.learn import score_batch


def read_records(spark: SparkSession, path: str, schema: T.StructType, pattern: str | None = None) -> DataFrame:
    """Stream of parquet files as they arrive; the schema is declared, never inferred."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def score_stream(
    records: DataFrame, scorer, threshold: float, features: Sequence[str], keep: Sequence[str], out: str, checkpoint: str
):
    """Append scored records to a parquet table; stops when the waiting files are done.

    The checkpoint makes a restarted query continue where it stopped.
    """
    scored = score_batch(records, scorer, threshold, features, keep).withColumn("scored_at", F.current_timestamp())
    return (
        scored.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(out)
    )
