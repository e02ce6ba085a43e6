"""A training corpus from raw documents: quality, near copies, personal data, mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but the last return
the columns of ``documents``; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import mixing, packing, paths, pii, quality
from starloom.llm.common import read, store
from starloom.llm.registry import query
from starloom.llm.vocab import path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the folder's labels, does not reject."""
    model = quality.train(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return quality.good_documents(docs, model)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return paths.one_of_each(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with identifiers replaced by their kind."""
    return pii.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as their source's target asks for; at the cut a document goes up to the exact word."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences; a document that the mix repeats is packed as often."""
    return packing.pack_documents(docs, path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("PII", mask_personal_data),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Tokenizers, a fitted classifier and the search for packings cannot be written in SQL; tests compare the stages with
#: plain Python instead.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
