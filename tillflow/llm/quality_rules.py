"""Quality rules and a hashed n-gram likelihood ratio against the whole corpus.

DataFrame functions only. The counts of single words and of pairs, hashed into a fixed
number of buckets, are taken over every document for the raw corpus and over the
trusted documents (quality 1 in the labels) for the target. A document's score is the
mean over its n-grams of log p_target - log p_raw; documents below the threshold go.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.words import SPACE_CHARS, text_or_empty, words

BUCKETS = 16_384
SYMBOLS = "#*$%&|<>"
THRESHOLD = -0.08
SMOOTHING = 8


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def with_repeated_words(docs: DataFrame, tokens: str, name: str) -> DataFrame:
    """Adds the number of words that lie in a window of three words found at least twice.

    Windows are compared by a 64-bit hash. Equal ones are neighbours after sorting,
    which gives the places of the repeated windows; each covers three words. Every step
    is a column of its own: a lambda that reads an expression would compute it anew for
    each element, a column it only looks up.
    """
    token = F.col(tokens)
    windows = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(token) - 3, F.lit(0))),
        lambda i: F.struct(
            F.xxhash64(F.get(token, i), F.get(token, i + 1), F.get(token, i + 2)).alias("h"),
            i.alias("i")),
    )
    ordered, places = F.col("__ordered"), F.col("__places")
    again = F.filter(
        ordered,
        lambda w, k: (F.get(ordered, k - 1)["h"] == w["h"]) | (F.get(ordered, k + 1)["h"] == w["h"]),
    )
    # A window adds three words, less those the window before it has covered already.
    added = F.transform(
        places, lambda p, k: F.least(F.lit(3), F.coalesce(p - F.get(places, k - 1), F.lit(3))))
    total = F.aggregate(added, F.lit(0).cast("long"), lambda total, n: total + n)
    return (
        docs.withColumn("__ordered", F.sort_array(windows))
        .withColumn("__places", F.sort_array(F.transform(again, lambda w: w["i"])))
        .withColumn(name, F.when(F.size(token) < 3, F.lit(0).cast("long")).otherwise(total))
        .drop("__ordered", "__places")
    )


def rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """row (struct of the given columns), doc_id, the counts, base_failed, and the words
    (column ``tokens``) of every row."""
    whole = docs.select(
        F.struct("*").alias("row"), F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    cut = whole.withColumn("tokens", words(F.col("text")))
    lined = F.filter(F.split("text", "\n"), lambda line: F.length(without(line, SPACE_CHARS)) > 0)
    lines = F.col("lines")
    counted = with_repeated_words(cut.select(
        "row", "doc_id", "tokens", lined.alias("lines"),
        F.size("tokens").cast("long").alias("n_words"),
        F.length(without(F.col("text"), SPACE_CHARS)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
    ).withColumn("n_dup_lines", (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")).drop("lines"),
        "tokens", "n_repeat_words")
    return counted.withColumn(
        "base_failed",
        (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def ngram_buckets(tokens: Column, buckets: int = BUCKETS) -> Column:
    """The bucket of every word and of every pair of neighbours."""
    size = F.size(tokens)
    single = F.transform(tokens, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(1), size - 1),
        lambda i: F.pmod(F.xxhash64(F.get(tokens, i - 1), F.get(tokens, i)), F.lit(buckets)).cast("int"),
    )
    return F.when(size < 2, single).otherwise(F.concat(single, pairs))


def of_trusted(whole: DataFrame, trusted: DataFrame) -> DataFrame:
    """The rows of ``whole`` (id, text) whose id is in ``trusted`` (doc_id), all of them."""
    marks = trusted.select(F.col("doc_id").cast("long").alias("trusted_id")).where(
        "trusted_id is not null").distinct()
    # The ids make the hash tables: no text is sorted.
    return whole.where("id is not null").join(
        marks.hint("shuffle_hash"), F.col("id") == F.col("trusted_id"), "left_semi")


def log_ratios(docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text",
               buckets: int = BUCKETS) -> list[float]:
    """log p_target - log p_raw of every bucket. The target is smoothed towards the raw
    distribution by ``SMOOTHING`` n-grams a bucket: without a trusted document all
    ratios are 0.

    Target counts are of all documents whose id is in ``trusted`` (doc_id), raw counts of
    all documents. Only ``buckets`` sums reach the driver, whatever the size of the corpus.
    """
    whole = docs.select(F.col(doc_id).cast("long").alias("id"), text_or_empty(text).alias("text"))
    chosen = of_trusted(whole, trusted)
    counts = _bucket_sums(whole, buckets).withColumnRenamed("n", "raw")
    target = _bucket_sums(chosen, buckets).withColumnRenamed("n", "target")
    raw, target_n = [1] * buckets, [0] * buckets
    for row in counts.join(target, "bucket", "left").collect():
        raw[row["bucket"]] += row["raw"]
        target_n[row["bucket"]] += row["target"] or 0
    raw_all, target_all = sum(raw), sum(target_n)
    weight = SMOOTHING * buckets
    ratios = []
    for r, t in zip(raw, target_n, strict=True):
        share = r / raw_all
        ratios.append(math.log((t + weight * share) / (target_all + weight)) - math.log(share))
    return ratios


def _bucket_sums(rows: DataFrame, buckets: int) -> DataFrame:
    cut = rows.select(words(F.col("text")).alias("tokens"))
    return cut.select(F.explode(ngram_buckets(F.col("tokens"), buckets)).alias("bucket")).groupBy(
        "bucket").agg(F.count("*").alias("n"))


def mean_ratio(tokens: Column, ratios: list[float]) -> Column:
    """The mean log ratio of a document's n-grams; null without a word."""
    # One literal text, which the optimizer folds into a constant array.
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    total = F.aggregate(
        ngram_buckets(tokens, len(ratios)), F.lit(0.0), lambda s, b: s + F.get(table, b))
    return F.when(F.size(tokens) > 0, total / (2 * F.size(tokens) - 1))


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id",
                  text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """Per row of ``docs``: doc_id, the counts, base_failed, score, kept.

    ``labels`` (doc_id, quality) names the trusted documents by quality 1 (the target is
    counted from all of them); a null label or doc_id trusts nothing. ``kept`` is false if the rules fail, else whether the score
    reaches ``threshold``; the same text has the same score in any run over the same
    corpus. Null text counts as empty: no words, base_failed, score null. Every row is
    answered, repeated doc_ids each for itself; other columns are ignored. With no
    trusted document, or an empty corpus, all scores are 0, and the rules
    alone decide.
    """
    return judged(docs, labels, threshold, doc_id, text, buckets).drop("row")


def keep(docs: DataFrame, labels: DataFrame, **options: float) -> DataFrame:
    """The rows of ``docs`` that `quality_rules` keeps, with their columns.

    The rows come out of an array with one or no element: a filter would be moved below
    the staged columns and take their expressions along, into each other's lambdas.
    """
    kept = F.when(F.col("kept"), F.array("row")).otherwise(F.slice(F.array("row"), 1, 0))
    return judged(docs, labels, **options).select(F.explode(kept).alias("row")).select("row.*")


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id",
           text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """`quality_rules` beside the given columns in a struct ``row``."""
    trusted = labels.where(F.col("quality") == 1)
    ratios = log_ratios(docs, trusted, doc_id, text, buckets)
    counted = rules(docs, doc_id, text)
    score = mean_ratio(F.col("tokens"), ratios)
    return counted.withColumn("score", score).drop("tokens").withColumn(
        "kept", ~F.col("base_failed") & (F.coalesce("score", F.lit(0.0)) >= threshold))
