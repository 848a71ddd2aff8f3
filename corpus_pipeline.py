"""From raw documents to packed training sequences; each stage reads what the one before it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from learnlake.llm import langid, mixing, packing, simhash, toxicity
from learnlake.llm.frames import DOCUMENT, bounded_batches, table
from learnlake.llm.queries import learned, tokenizer_path
from learnlake.session import written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without any letter go."""
    bounded_batches(spark)
    return langid.accept(docs.select(*DOCUMENT), langid.fit(docs, learned(3, 1), scores=False))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    bounded_batches(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learned(5, 0), langid.fit(docs, learned(5, 0), scores=False))
    return toxicity.accept(docs.select(*DOCUMENT), model)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    bounded_batches(spark)
    return simhash.keep_one(docs.select(*DOCUMENT))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document may occur up to three times."""
    bounded_batches(spark)
    return mixing.apply(docs.select(*DOCUMENT))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of at most 2048, placed in sequences."""
    bounded_batches(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language ID", language),
    ("toxicity", clean),
    ("SimHash near-dedup", distinct),
    ("mixing", mixed),
    ("packing", packed),
]

# classifiers, SimHash components and token ids are beyond SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "corpus")
    return STAGES[-1][1](spark, docs, sf_dir)
