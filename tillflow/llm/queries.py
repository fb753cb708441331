"""The registered queries of the text operators, and SQL for those it can express.

Each query applies its operator to the whole table with the parameters meant for
production, and derives the digest columns from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm import (
    bpe,
    exact_dedup,
    html_text,
    jaccard_join,
    licences,
    merkle,
    mixing,
    pii,
    quality_rules,
    suffix_dedup,
    token_files,
    url_templates,
    whitening,
)
from tillflow.sources.files import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, folder, "documents"))


def op2_html_text(spark: SparkSession, folder: str) -> DataFrame:
    found = html_text.extract(table(spark, folder, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffix_dedup.suffix_dedup(table(spark, folder, "documents"), least=50)
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return cut.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, folder, "documents"), width=4, percent=85)


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_url_templates(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    marks = url_templates.page_labels(pages, table(spark, folder, "labels"))
    return url_templates.judge(pages, marks)


def op7_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(table(spark, folder, "documents")).drop("matches")


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken(table(spark, folder, "documents")).drop("source", "copies")


def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    encoded = bpe.encode(
        table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return encoded.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"),
    )


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    rows = pii.sanitise(table(spark, folder, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        "doc_id", *map(count, pii.KINDS),
        F.sha2(F.encode(pii.spelled(F.col("base")), "utf-8"), 256).alias("base_sha256"),
        pii.all_spans(F.col("base"), F.col("terms")).alias("spans"))


def op11_token_files(spark: SparkSession, folder: str) -> DataFrame:
    written = token_files.write(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return token_files.digests(spark, written)


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest against a copy in which every second document, by a checksum of its id, has
    lost its line feeds."""
    lost = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    seen = F.when(lost, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = merkle.manifest(table(spark, folder, "documents"), seen)
    return rows.select(
        "doc_id", "leaf", "subroot", "root", merkle.digest(merkle.siblings(F.col("path"))).alias("proof_sha256"),
        merkle.folded(F.col("seen_leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = whitening.whiten(table(spark, folder, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        op1_exact_dedup, op2_html_text, op3_suffix_dedup, op4_jaccard_join, op5_quality_rules,
        op6_url_templates, op7_licences, op8_mixing, op9_bpe, op10_pii, op11_token_files, op12_merkle,
        op13_whitening)
}

#: The others have a model, a bounded recursion or a vocabulary in them that SQL lacks.
SQL: dict[str, str] = {
    "op1_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
}
