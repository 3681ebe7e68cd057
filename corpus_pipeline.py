"""The corpus pipeline: toxicity, line dedup, SimHash near-dedup, benchmark
decontamination, mixing.

A stage takes (spark, docs, sf_dir), works on all rows that the one before it
kept and returns the columns of ``documents``; the last returns the mixture.
Null texts, empty texts, repeated rows and empty tables pass as each operator
defines; a document whose lines all went stays with an empty text until the
near-dedup, where empty texts are copies of each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxreach.llm import decontam, linededup, mixing, simhash, toxicity
from rxreach.llm.common import saved, table

#: SQL can't express the classifier, the fingerprints or the edit matching.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at or over their language's threshold go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~toxicity.held_out()))
    return toxicity.score(docs, model, prefix="_toxicity_").where("not _toxicity_rejected").select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line equals or nearly equals go; n_chars follows the text."""
    out = linededup.dedup_lines(docs, counts=False)
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), "n_chars")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.one_of_each(docs, shingle=3, radius=2).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often the mixture takes each document."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs)
    return docs
