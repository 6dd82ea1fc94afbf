"""Categorical encoders: fit collects a bounded vocabulary, transform is a projection."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortloom.functions.numeric import col
from cohortloom.functions.text import split_terms
from cohortloom.session import cut_lineage

Vocabulary = dict[str, list[str | None]]


def fit_vocabulary(
    df: DataFrame, onehot: Sequence[str] = (), multilabel: Sequence[str] = (), delimiter: str = ",",
    max_classes: int | None = None, normalise: Mapping[str, Column] | None = None,
) -> Vocabulary:
    """Sorted classes of all encoded columns from one pass over the rows.

    The pass reduces the rows to distinct (column, text) pairs; `normalise` (an expression
    over the column itself) and the splitting run on the distinct texts only. Only classes
    reach the driver. A caller that wants no wide table can set max_classes: a column with
    more of them is then refused, never cut.
    """
    names = list(dict.fromkeys([*onehot, *multilabel]))
    if not names:
        return {}
    cells = F.array(*[F.struct(F.lit(c).alias("c"), col(c).cast("string").alias("t")) for c in names])
    # written once: every branch below reads this small table, not the rows
    pairs = cut_lineage(df.select(F.explode(cells).alias("x")).select("x.c", "x.t").distinct())
    parts = None
    for c in names:
        texts = pairs.where(F.col("c") == c).select(F.col("t").alias(c))
        if normalise and c in normalise:
            texts = texts.withColumn(c, normalise[c].cast("string"))
        value = F.array(col(c)) if c in onehot else split_terms(c, delimiter)
        part = texts.select(F.lit(c).alias("c"), F.explode_outer(value).alias("v"))
        parts = part if parts is None else parts.unionByName(part)
    seen = parts.distinct()
    # one action; a column with too many classes sends one class more than allowed, not all
    first = Window.partitionBy("c").orderBy("v")
    if max_classes is not None:
        seen = seen.withColumn("r", F.row_number().over(first)).where(F.col("r") <= max_classes + 1)
    rows = seen.collect()
    wide = sorted({r["c"] for r in rows if max_classes is not None and r["r"] > max_classes})
    if wide:
        raise ValueError(f"too many classes to encode: {wide}")
    vocabulary: Vocabulary = {c: [] for c in (*onehot, *multilabel)}
    for r in rows:
        if r["v"] is not None or r["c"] in onehot:
            vocabulary[r["c"]].append(r["v"])
    return {c: sorted(v, key=lambda x: (x is None, x)) for c, v in vocabulary.items()}


def onehot_columns(column: str, classes: Sequence[str | None]) -> dict[str, Column]:
    """One 0/1 column per class; null is the class 'nan'."""
    text = col(column).cast("string")
    out = {}
    for cls in classes:
        hit = text.isNull() if cls is None else F.coalesce(text == cls, F.lit(False))
        out[f"{column}_{'nan' if cls is None else cls}"] = hit.cast("int")
    return out


def multilabel_columns(column: str, labels: Sequence[str], delimiter: str = ",") -> dict[str, Column]:
    terms = split_terms(column, delimiter)
    return {f"{column}_{x}": F.coalesce(F.array_contains(terms, x), F.lit(False)).cast("int") for x in labels}


def encode_onehot(df: DataFrame, column: str, classes: Sequence[str | None] | None = None) -> DataFrame:
    if classes is None:
        classes = fit_vocabulary(df, onehot=[column])[column]
    return df.withColumns(onehot_columns(column, classes))


def encode_multilabel(
    df: DataFrame, column: str, labels: Sequence[str] | None = None, delimiter: str = ","
) -> DataFrame:
    if labels is None:
        labels = fit_vocabulary(df, multilabel=[column], delimiter=delimiter)[column]
    # the terms are split once and kept as a column for all the indicators
    staged = df.withColumn("_terms", split_terms(column, delimiter))
    marks = {f"{column}_{x}": F.coalesce(F.array_contains("_terms", x), F.lit(False)).cast("int") for x in labels}
    return staged.withColumns(marks).drop("_terms")


def ordinal(c: Column | str, classes: Sequence[str], strict: bool = True) -> Column:
    """Position in the class list; an unknown value is an error (strict) or null."""
    c = col(c)
    out = F.when(c.isNull(), F.lit(None).cast("double"))
    for i, cls in enumerate(classes):
        out = out.when(c == cls, F.lit(float(i)))
    if strict:
        return out.otherwise(F.raise_error(F.concat(F.lit("unknown class: "), c)).cast("double"))
    return out


def encode_ordinal(df: DataFrame, columns: Mapping[str, Sequence[str]], strict: bool = True) -> DataFrame:
    return df.withColumns({f"{c}_encoded": ordinal(c, classes, strict) for c, classes in columns.items()})


def encode_label(df: DataFrame, column: str) -> DataFrame:
    """Alphabetical index; null counts as the text 'nan'."""
    filled = df.withColumn("_text", F.coalesce(col(column).cast("string"), F.lit("nan")))
    indexer = StringIndexer(inputCol="_text", outputCol=f"{column}_encoded", stringOrderType="alphabetAsc")
    return indexer.fit(filled).transform(filled).drop("_text")


# Other names of the severity columns.
SCORE_ALIASES = {
    "score_proc_low_severity": "severity_score_low_severity_proc",
    "score_proc_moderate_severity": "severity_score_moderate_severity_proc",
    "score_proc_medium_severity": "severity_score_medium_severity_proc",
    "score_proc_high_severity": "severity_score_high_severity_proc",
    "score_proc_critical": "severity_score_critical_proc",
    "score_dx_low_severity": "severity_score_low_severity_dx",
    "score_dx_moderate_severity": "severity_score_moderate_severity_dx",
    "score_dx_medium_severity": "severity_score_medium_severity_dx",
    "score_dx_high_severity": "severity_score_high_severity_dx",
    "score_dx_critical": "severity_score_critical_dx",
    "score_proc_ant_low_severity": "severity_score_low_severity_proc_ant",
    "score_proc_ant_moderate_severity": "severity_score_moderate_severity_proc_ant",
    "score_proc_ant_medium_severity": "severity_score_medium_severity_proc_ant",
    "score_proc_ant_high_severity": "severity_score_high_severity_proc_ant",
    "score_proc_ant_critical": "severity_score_critical_proc_ant",
}
# Other names of the label columns.
LABEL_ALIASES = {
    "predicted_label_proc_encoded": "severity_ordinal_proc",
    "predicted_label_dx_encoded": "severity_ordinal_dx",
    "predicted_label_proc_ant_encoded": "severity_ordinal_proc_ant",
}


def resolve_feature_columns(
    names: Sequence[str], columns: Sequence[str], kinds: Mapping[str, str] | None = None
) -> tuple[list[str], list[str]]:
    """Requested feature names to real columns: (resolved, missing).

    A 'OneHot_Group' expands to the columns with its prefix; score and label names have a
    second spelling; garbled accents are repaired; last, a column of the same length that
    starts alike is accepted.
    """
    present, kinds = set(columns), kinds or {}
    resolved: list[str] = []
    missing: list[str] = []

    def repaired(name: str) -> list[str]:
        plain = name.replace("Ã³", "ó").replace("Ã©", "é")
        if plain in present:
            return [plain]
        return [c for c in columns if c.startswith(name[:10]) and len(c) == len(name)][:1]

    for name in names:
        alias = SCORE_ALIASES.get(name) or LABEL_ALIASES.get(name)
        if kinds.get(name) == "OneHot_Group":
            found = [c for c in columns if c.startswith(f"{name}_")]
        elif alias:
            found = [c for c in (alias, name) if c in present][:1]
        else:
            found = [name] if name in present else repaired(name)
        if found:
            resolved += found
        else:
            missing.append(name)
    return list(dict.fromkeys(resolved)), missing
