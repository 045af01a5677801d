"""Queries that apply the operators to their whole tables, and SQL texts where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import (
    centroids, collocations, cover_tree, exact_dedup, license_scan, line_dedup, mixing, ngram_join, quality,
    sentencepiece_codec as codec, substring_dedup, token_files, url_filter,
)
from lodestrata.llm.tables import table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(spark, f"{sf_dir}/documents.parquet")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = codec.encode(table(spark, sf_dir, "documents"), keep=("doc_id", "text"))
    decoded = codec.decode(encoded, keep=("doc_id", "text", "ids", "n_tokens"))
    same = F.col("decoded") == F.replace("text", F.lit(codec.MARK), F.lit(" "))
    return decoded.select("doc_id", "ids", "n_tokens", same.alias("round_trip"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_copies(table(spark, sf_dir, "documents"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.drop_boilerplate(table(spark, sf_dir, "documents"))
    text = F.sha2(F.coalesce("text", F.lit("")), 256)
    return cleaned.select("doc_id", "n_lines", "n_dropped", text.alias("kept_sha256"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return removed.select(
        "doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"), "kept_sha256")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return token_files.token_index(table(spark, sf_dir, "documents"), tokenizer).drop("file")


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f for f in (
        op1_quality_classifier, op2_license_scan, op3_exact_dedup, op4_sentencepiece, op5_ngram_jaccard,
        op6_embedding_near_dedup, op7_line_dedup, op8_mixing, op9_url_filter, op10_suffix_array_dedup,
        op11_phrase_collocations, op12_token_ids, op13_centroid_clustering,
    )
}
ORACLE = {
    "op2_license_scan": license_scan.oracle_sql(),
    "op3_exact_dedup": exact_dedup.ORACLE,
    "op7_line_dedup": line_dedup.ORACLE,
    "op8_mixing": mixing.ORACLE,
    "op9_url_filter": url_filter.oracle_sql(),
    "op11_phrase_collocations": collocations.ORACLE,
    "op13_centroid_clustering": centroids.oracle_sql(),
}
