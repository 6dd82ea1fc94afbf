"""Raw records to risk scores: whole cleaning, the manifest's medians, the saved model."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.numeric import col, to_number
from cohortloom.operators import learn
from cohortloom.operators.encode import Vocabulary
from cohortloom.plans import clean


def impute(df: DataFrame, manifest: Mapping) -> DataFrame:
    """The manifest's features as numbers; what is missing, or absent, gets the median or the constant."""
    present, medians = set(df.columns), manifest["feature_medians"]
    median = manifest["imputation"]["strategy"] == "fill_median"
    filled = {}
    for f in manifest["feature_names"]:
        value = to_number(col(f)) if f in present else F.lit(None).cast("double")
        fill = medians.get(f) if median else manifest["imputation"].get("value", learn.FILL)
        filled[f] = F.coalesce(value, F.lit(fill).cast("double"))
    return df.withColumns(filled)


def score_raw(raw: DataFrame, key: str, vocabulary: Vocabulary, scorer, manifest: Mapping, keep: Sequence[str] = ()) -> DataFrame:
    """Risk of every raw record that the cleaning keeps. The vocabulary is the one of training, so
    the columns are the model's."""
    cleaned, _ = clean.clean_all(raw, key, vocabulary=vocabulary)
    ready = impute(cleaned, manifest)
    return learn.score_batch(ready, scorer, manifest["threshold"], manifest["feature_names"], [key, *keep])
