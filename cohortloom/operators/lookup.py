"""Cached lookups: each distinct input is resolved once, then joined back to every row."""
from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.numeric import col
from cohortloom.functions.text import strip, words
from cohortloom.operators.joins import left_lookup
from cohortloom.operators.setops import upsert_keep_last
from cohortloom.session import cut_lineage

Resolver = Callable[[DataFrame], DataFrame]


def lookup_key(c: Column | str) -> Column:
    """Lower-cased text without outer blanks; null for blank texts."""
    return F.nullif(F.lower(strip(c)), F.lit(""))


def table_resolver(table: DataFrame, key: str, columns: Sequence[str]) -> Resolver:
    """Resolver over a reference table; an unknown key resolves to nulls."""

    def resolve(misses: DataFrame) -> DataFrame:
        dim = table.select(col(key).alias("key"), *columns)
        return misses.join(dim, "key", "left").select("key", *columns)

    return resolve


def batch_resolver(fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> Resolver:
    """Resolver from a function over Arrow batches of distinct keys (a client of some service)."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield fn(frame)

    return lambda misses: misses.mapInPandas(batches, schema)


def lookup_with_cache(
    df: DataFrame, column: str, row_key: str, cache: DataFrame, resolver: Resolver, columns: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Rows with the looked-up columns, and the cache with the newly resolved keys.

    Distinct keys that the cache lacks go to the resolver, once: what it finds is written before it
    is joined back and handed out. A key that the cache holds twice counts once.
    """
    keyed = df.withColumn("_key", lookup_key(column))
    wanted = keyed.select(F.col("_key").alias("key")).where("key IS NOT NULL").distinct()
    known = cache.select("key", *columns).dropDuplicates(["key"])
    found = cut_lineage(resolver(wanted.join(known.select("key"), "key", "left_anti")).dropDuplicates(["key"]))
    grown = known.unionByName(found.select("key", *columns))
    return left_lookup(keyed, grown, "_key", row_key, "key").drop("_key"), grown


def store_cache(cache: DataFrame, new_rows: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    return upsert_keep_last(cache, new_rows, key, order)


def token_subsets(tokens: Column, attempts: int = 5) -> Column:
    """Ordered token subsets to try: all tokens, then without the last, without the one before, ...

    With at most five attempts only three-word queries get as far as single words.
    """
    n = F.size(tokens)

    def without(i: Column) -> Column:
        return F.filter(tokens, lambda t, j: j != i)

    all_but_one = F.transform(F.sequence(n - 1, F.lit(0), F.lit(-1)), without)
    singles = F.transform(tokens, lambda t: F.array(t))
    ordered = (
        F.when(n == 0, F.array().cast("array<array<string>>"))
        .when(n == 1, F.array(tokens))
        .when(n == 2, F.concat(F.array(tokens), singles))
        .when(n == 3, F.concat(F.array(tokens), all_but_one, singles))
        .otherwise(F.concat(F.array(tokens), all_but_one))
    )
    return F.slice(ordered, 1, attempts)


def code_by_token_subsets(queries: DataFrame, column: str, codes: DataFrame, attempts: int = 5) -> DataFrame:
    """(column, code, term, attempt) of the first token subset that some code name contains.

    Each candidate is matched through its rarest word, so common words of the code
    table never multiply rows; the remaining words are checked on the matches.
    """
    names = codes.select("code", "term", F.array_distinct(words("term")).alias("name_words"))
    index = names.withColumn("word", F.explode("name_words"))
    frequency = index.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    candidates = (
        queries.select(col(column).alias("_q")).where("_q IS NOT NULL").distinct()
        .select("_q", F.posexplode(token_subsets(F.array_distinct(words("_q")), attempts)).alias("attempt", "cand"))
    )
    rarest = (
        candidates.select("_q", "attempt", "cand", F.explode("cand").alias("word"))
        .join(frequency, "word", "left")
        .groupBy("_q", "attempt", "cand")
        .agg(F.min_by("word", F.coalesce("n", F.lit(0))).alias("word"))
    )
    hits = rarest.join(index, "word").where(F.size(F.array_except("cand", "name_words")) == 0)
    best = hits.groupBy("_q").agg(
        F.min(F.struct("attempt", "code", "term")).alias("b")
    )
    return best.select(
        F.col("_q").alias(column), F.col("b.code").alias("code"), F.col("b.term").alias("term"),
        F.col("b.attempt").alias("attempt"),
    )


# Severity labels and the words that point to each of them, first match wins.
SEVERITY_LABELS = ["low severity", "moderate severity", "medium severity", "high severity", "critical"]
SEVERITY_WORDS = {
    "critical": [r"\bparo\b", "choque", "sepsis"],
    "high severity": ["fractura", "laparotom", "ruptura"],
    "moderate severity": ["hernia", "herniorrafia"],
    "low severity": ["catarata", "faco"],
}
LABEL_SCHEMA = "text string, model string, predicted_label string, predicted_score double, all_labels array<string>, all_scores array<double>"


def keyword_labeller(model: str = "keywords", words_of=None, labels=None) -> Resolver:
    """Deterministic labeller with the output shape of a text classifier; a model that needs
    Python batches comes as batch_resolver(function, LABEL_SCHEMA)."""
    words_of, labels = words_of or SEVERITY_WORDS, labels or SEVERITY_LABELS

    def label(texts: DataFrame) -> DataFrame:
        best = F.lit("medium severity")
        for name, keys in reversed(words_of.items()):
            best = F.when(F.lower("text").rlike("|".join(keys)), F.lit(name)).otherwise(best)
        others = F.filter(F.array(*map(F.lit, labels)), lambda x: x != F.col("predicted_label"))
        return texts.select("text", F.lit(model).alias("model"), best.alias("predicted_label")).select(
            "text", "model", "predicted_label",
            F.lit(0.6).alias("predicted_score"),
            F.concat(F.array("predicted_label"), others).alias("all_labels"),
            F.array(F.lit(0.6), *[F.lit(0.1)] * (len(labels) - 1)).alias("all_scores"),
        )

    return label


def label_texts(
    df: DataFrame, column: str, cache: DataFrame | None, labeller: Resolver, model: str = "keywords",
) -> DataFrame:
    """One labelled row per distinct valid text and model; cached (hash, model) pairs are reused."""
    texts = (
        df.select(col(column).alias("text"))
        .where(F.col("text").isNotNull() & ~F.lower(strip("text")).isin("", "nan", "none"))
        .distinct()
    )
    if cache is not None:
        done = cache.where(F.col("model") == model).select("text_hash")
        texts = texts.withColumn("text_hash", F.md5("text")).join(done, "text_hash", "left_anti").select("text")

    new = labeller(texts).withColumn("text_hash", F.md5("text"))
    return new if cache is None else cache.unionByName(new)
