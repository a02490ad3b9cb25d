"""A training-data pipeline over ``documents``.

Each stage reads all that its predecessor kept, as Parquet below the shared folder, and
its decisions take effect: documents without a language go, of equal texts one row stays, of
each group of near duplicates one stays, the rest are sampled to target weights, and
what is left is encoded and decoded. All but the last stage return the columns of
``documents``.
"""

from __future__ import annotations

from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession

from quillon.llm import bpe, exact_dedup, language, mixing, near_dedup
from quillon.session import ship_package, stored

TOKENIZER = "byte_bpe_50k.json"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.drop_undetermined(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first_copies(docs, single=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sample_to_targets(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(spark, docs, path(TOKENIZER))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("bpe_round_trip", encode),
]

#: The stages have no SQL form; tests compare them to a brute-force pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
