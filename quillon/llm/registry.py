"""The operators of this subpackage bound to the given tables."""

from __future__ import annotations

from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession

from quillon.llm import (
    bpe,
    exact_dedup,
    html_text,
    language,
    manifest,
    mixing,
    near_dedup,
    nearest,
    oracles,
    periodic,
    quality,
    secrets,
    suffix_dedup,
    token_counts,
)
from quillon.session import ship_package

BYTE_BPE, UNIGRAM = "byte_bpe_50k.json", "piece_bpe_32k.model"


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "documents")


def op1_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.near_groups(_documents(spark, sf))


def op2_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixed(_documents(spark, sf))


def op3_nearest_forest(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _table(spark, sf, "embeddings")
    return nearest.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op4_html_text(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.main_text(_table(spark, sf, "pages"))


def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    pieces = token_counts.read_pieces(path(UNIGRAM))
    return token_counts.token_counts(_documents(spark, sf), pieces)


def op6_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return language.predict_languages(_documents(spark, sf))


def op7_bpe_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.round_trip(spark, _documents(spark, sf), path(BYTE_BPE))


def op8_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_groups(_documents(spark, sf))


def op9_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.removed_repeats(_documents(spark, sf)).drop("spans")


def op10_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.secret_spans(_documents(spark, sf))


def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    return periodic.periodic_runs(_documents(spark, sf), plant=True)


def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return manifest.manifest(_documents(spark, sf))


def op13_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_scores(_documents(spark, sf), _table(spark, sf, "labels"))


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_source_mixing": op2_source_mixing,
    "op3_nearest_forest": op3_nearest_forest,
    "op4_html_text": op4_html_text,
    "op5_token_counts": op5_token_counts,
    "op6_language_id": op6_language_id,
    "op7_bpe_round_trip": op7_bpe_round_trip,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_secret_scan": op10_secret_scan,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_quality_classifier": op13_quality_classifier,
}
ORACLE_SQL = {
    "op1_near_dedup": oracles.NEAR_DEDUP,
    "op2_source_mixing": oracles.SOURCE_MIXING,
    "op8_exact_dedup": oracles.EXACT_DEDUP,
    "op9_suffix_dedup": oracles.SUFFIX_DEDUP,
    "op10_secret_scan": oracles.SECRET_SCAN,
    "op12_merkle_manifest": oracles.MERKLE_MANIFEST,
}
