"""Raw documents to packed training sequences: five stages, each written to the shared folder and read again.

1. ``quality``: documents that the adaptive quality rules reject go.
2. ``exact``: of equal texts one stays.
3. ``near``: of each group of near duplicates one stays.
4. ``mix``: sources are mixed to their target weights; a document taken twice is two rows.
5. ``pack``: token ids are packed into sequences along a space-filling curve (one row per piece).

All but the last return the columns of ``documents``.  Empty tables stay empty; nulls and repeated rows are treated as each operator's
docstring says.  Packing depends on token ids and floating-point projections, which SQL cannot state, so there is no ``ORACLE_SQL``: the
tests hold the whole run against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegrid.llm import exact_dedup, mixing, ngram_join, packing, quality_rules
from tidegrid.llm.frames import ship
from tidegrid.llm.queries import vocabulary
from tidegrid.session import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that pass the quality rules of their language and source."""
    ship(spark)
    return quality_rules.keep(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal texts."""
    ship(spark)
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest document of each group of near duplicates."""
    ship(spark)
    return ngram_join.representatives(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it."""
    ship(spark)
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    ship(spark)
    return packing.pack(docs, vocabulary())


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("pack", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
