"""Five stages from documents to tokens. Each works on all that its predecessor kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. run() applies them to
`documents`, with a written table between stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import minhash, mixing, piece_codec, suffix_dedup, toxicity
from starloom.llm.common import durable, load, small_batches
from starloom.llm.registry import piece_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labelled documents that are not held out."""
    small_batches(spark)
    return toxicity.drop_toxic(docs, load(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, that of the least id."""
    small_batches(spark)
    return minhash.drop_near_copies(docs)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id has as well are cut out of the text."""
    small_batches(spark)
    return suffix_dedup.cut_passages(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that the words of the sources come near their targets."""
    return mixing.expand_copies(docs, mixing.mix_sources(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, their digest, and the digest of what they decode to."""
    small_batches(spark)
    return piece_codec.encode_texts(docs, piece_model(), with_ids=True)


STAGES = [("toxicity", drop_toxic), ("minhash near-dedup", drop_near_copies), ("suffix-array dedup", cut_passages), ("mixing", mix), ("sentencepiece", encode)]
ORACLE_SQL = None
"""The stages learn, hash and encode, which SQL does not express; tests/llm/test_pipeline.py checks them in plain Python."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
