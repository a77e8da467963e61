"""A corpus pipeline: language ID, near-dedup, decontamination, secret redaction, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import decontaminate, language, packing, secrets, shingles
from lodestar.llm.common import aside, cut
from lodestar.llm.queries import table, tokenizer

#: A document whose n-gram ranks are further than this from every learned language is no text in any of them.
LEAST_LIKENESS = 0.1


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without a letter, or far from every profile, go. Profiles are learned from docs."""
    own, back = aside(docs, "text", "lang")
    found = language.predict(own, language.learn(own), ("_lang", "_likeness"))
    return back(found.where((F.col("_lang") != language.UNKNOWN) & (F.col("_likeness") >= LEAST_LIKENESS)).select(own.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, linked by five-word shingles of similarity 0.8 or more: that of the smallest doc_id."""
    return shingles.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in the text."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences."""
    return packing.pack_documents(docs, tokenizer())


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination), ("secret_scan", secret_scan), ("packing", pack)]

#: SQL can't express the stages; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
