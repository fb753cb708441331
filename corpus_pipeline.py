"""A corpus from raw documents: filter, deduplicate, join near copies, mix, encode.

STAGES in order; each takes (spark, docs, folder of the tables) and works on all that
the stage before it kept. `run` writes each stage's result and reads it for the next.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm import bpe, exact_dedup, jaccard_join, mixing, quality_rules
from tillflow.session import stored
from tillflow.sources.files import table


def keep_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that pass the quality rules."""
    return quality_rules.keep(docs, table(spark, folder, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies: of five-word shingles, 80 % in common."""
    return jaccard_join.keep(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, ids (token ids, little-endian, 32 bits each) and n_tokens."""
    encoded = bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return encoded.select(
        "doc_id", "ids", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "decoded")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality rules", keep_quality),
    ("exact dedup", drop_copies),
    ("jaccard join", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
