"""A corpus pipeline: five operators, one after the other, over the documents.

Each stage gets what its predecessor kept and returns the columns of ``documents``, the last
one the packed sequences. ``run`` writes what a stage returns to the shared folder and reads
it again, so a stage that is repeated after a loss starts from its predecessor's table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableforge.llm import classifier, line_dedup, packing, quality_rules, simhash
from tableforge.llm.common import documents, written


def keep_classified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = classifier.classify(docs, labels, docs.columns)
    return judged.where("kept").select(*docs.columns)


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the weighed quality rules keep."""
    judged = quality_rules.judge_documents(docs, docs.columns)
    return judged.where("kept").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many of them share; ``n_chars`` follows."""
    done = line_dedup.dedup_lines(docs)
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return done.select(*[new.get(name, F.col(name)).alias(name) for name in docs.columns])


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return simhash.keep_representatives(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of bounded length."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", keep_classified),
    ("quality rules", keep_by_rules),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", keep_one_of_near),
    ("best-fit packing", pack),
]

#: No SQL: a trained classifier and a tokenizer are among the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
