"""The corpus pipeline: documents that pass, clean and unlike each other, mixed and encoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import line_dedup, mixing, ngram_join, quality, sentencepiece_codec
from lodestrata.llm.tables import stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many pages of a source share go; ``n_chars`` follows the text."""
    cleaned = line_dedup.drop_boilerplate(docs)
    chars = F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(
        F.col("n_chars"))
    return cleaned.withColumn("n_chars", chars).select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, one with the least id; repeated and null ids are rows of their own."""
    return ngram_join.first_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's target asks for, in the order of the queue."""
    return mixing.mixed(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document of the mix."""
    return sentencepiece_codec.encode(docs, keep=("doc_id", "lang", "source"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", drop_site_lines),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding", encode_pieces),
]
# The stages fit a classifier, join sets and encode: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0]}")
    return STAGES[-1][1](spark, docs, sf_dir)
