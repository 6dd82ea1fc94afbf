"""The corpus pipeline: stages over documents, each one an operator of cohortloom.llm.

A stage takes (spark, docs, sf_dir). All but the last return documents with their columns: those
that the stage keeps, or with the text it leaves. The last returns packed pieces.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import decontamination, language, near_duplicates, packing, secret_scan
from cohortloom.llm.common import remainder, ship, written
from cohortloom.llm.queries import ORACLES, QUERIES
from cohortloom.llm.tokens import vocabulary

#: No share of the main language is asked for: a clean text may be made of many languages.
MIN_LANGUAGE_SCORE = 0.0


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, which have no language, go; however many languages a text mixes, it
    stays, and so does every lettered text of a corpus without labels. `lang` then holds the identified
    language, also of documents that had none or another; the packing keeps these languages apart."""
    ship(spark)
    model = language.fit_language_model(docs.where(remainder("doc_id", 4) != 2), key=F.col("doc_id"))
    return language.keep_identified(docs, model, MIN_LANGUAGE_SCORE, lang_column="lang")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    ship(spark)
    return near_duplicates.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows hold a twentieth or more go."""
    ship(spark)
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced; every document stays."""
    return secret_scan.redact_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts as ids in windows of several context sizes, each of one identified language."""
    ship(spark)
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), end_id=1, apart="lang")


STAGES = [
    ("language ID", language_id),
    ("near-duplicates", near_dedup),
    ("decontamination", decontaminate),
    ("secret scan", secrets),
    ("packing", pack),
]

#: SQL has no language model, signature or tokenizer; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)


REGISTERED = QUERIES | {"pipeline": run}
REGISTERED_SQL = dict(ORACLES)
