"""Mixing sources to target weights by systematic sampling, with DataFrame functions.

A source's words come to its target if each of its documents is taken e = target /
source size times on average. Documents stand in a fixed order within their source;
with the prefix sums of e and one random offset u a source, a document is emitted once
for every whole number that the sums cross while it is added: floor(e) or ceil(e) times.

The order is by size class, then by a hash of the document, then by size: neighbours are
of like size, so that the words taken come near the target. A cell (source, size class,
part) has a bounded share of the rows of a source; cells are numbered by windows, and
the sums before a cell come from a small table of counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.words import n_words, text_or_empty
from tillflow.session import stored

WEIGHTS = (5, 2, 1)
PARTS = 32


def targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0,
            weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Per source: source, source_size, target, for a table (source, source_size).

    Sources in code-point order, null last, have the weights in turn. All targets come
    to ``share`` times all sizes, in proportion to the weights, but none is above
    ``most`` times its source: what a source cannot take goes to the others by weight.
    The sources that stop are those with the least size per weight, so that a running
    sum in that order tells them.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    k = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (k + 1).cast("int"))
    weighed = sizes.withColumn("weight", weight).withColumn("cap", F.lit(most) * F.col("source_size"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (
        F.lit(share) * F.sum("source_size").over(everything)
        - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    # Up to the first source whose cap is above the level all stop at their caps; the level
    # there is the one of all the rest (those computed after it only fall).
    stops = F.col("cap") <= F.col("level") * F.col("weight")
    free_level = F.max(F.when(~stops, F.col("level"))).over(everything)
    return weighed.withColumn("level", level).select(
        "source", "source_size",
        F.when(stops, F.col("cap")).otherwise(free_level * F.col("weight")).alias("target"))


def size_class(size: Column) -> Column:
    """Eight classes to every doubling of the size."""
    return F.floor(F.log2(size + 1) * 8).cast("int")


def mixed(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS,
          seed: int = 17, parts: int = PARTS, doc_id: str = "doc_id", text: str = "text",
          source: str = "source") -> DataFrame:
    """Every row of ``docs`` with how often the mix takes it.

    row (struct of the given columns), doc_id, source, size, source_size, target, copies.
    A null text has size 0; null is a source of its own. Documents without words are
    taken like others of their source and add nothing. A source without words has target
    0 and gives no copies. Repeated rows each count. The same rows give the same result
    in any run and any partitioning; rows that tie in everything that orders them
    (doc_id, size, hash) are interchangeable. An empty table gives an empty one.
    """
    sized = docs.select(
        F.struct("*").alias("row"), F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        n_words(text_or_empty(text)).alias("size"),
    )
    return allotted(sized, share, most, weights, seed, parts)


def allotted(sized: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS,
             seed: int = 17, parts: int = PARTS) -> DataFrame:
    """``sized`` (doc_id, source, size, and more) with source_size, target and copies."""
    placed = sized.withColumn("class", size_class(F.col("size"))).withColumn(
        "part", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(parts)).cast("int"))
    cell = ["source", "class", "part"]
    cells = stored(
        placed.groupBy(*cell).agg(F.count("*").alias("n"), F.sum("size").alias("words")), "mix-cells")
    sources = targets(
        cells.groupBy("source").agg(F.sum("words").alias("source_size")), share, most, weights)
    offset = F.pmod(F.xxhash64("source", F.lit(seed + 1)), F.lit(1 << 30)) / float(1 << 30)
    in_source = Window.partitionBy("source").orderBy("class", "part").rowsBetween(
        Window.unboundedPreceding, -1)
    begins = cells.withColumn("before", F.coalesce(F.sum("n").over(in_source), F.lit(0))).join(
        sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")),
    ).select(
        F.col("source").alias("of"), F.col("class").alias("of_class"), F.col("part").alias("of_part"),
        "before", "source_size", "target", offset.alias("offset"))
    in_cell = Window.partitionBy(*cell).orderBy("size", "doc_id")
    numbered = placed.withColumn("place", F.row_number().over(in_cell))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    crossed = (F.floor(F.col("rate") * F.col("rank") + F.col("offset"))
               - F.floor(F.col("rate") * (F.col("rank") - 1) + F.col("offset")))
    return numbered.join(
        begins,
        F.col("source").eqNullSafe(F.col("of")) & (F.col("class") == F.col("of_class"))
        & (F.col("part") == F.col("of_part")),
    ).withColumn("rate", rate).withColumn("rank", F.col("before") + F.col("place")).withColumn(
        "copies", crossed.cast("long"),
    ).drop("of", "of_class", "of_part", "before", "offset", "rate", "rank", "place", "class", "part")


def taken(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
          **options: float) -> DataFrame:
    """Per row of ``docs``: doc_id, source, size, source_size, target, copies, taken (words).
    Only ids, sources and sizes are moved; see `mixed` for the cases."""
    sized = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        n_words(text_or_empty(text)).alias("size"))
    return allotted(sized, **options).withColumn("taken", F.col("copies") * F.col("size"))


def mix(docs: DataFrame, **options: float) -> DataFrame:
    """The mix: the rows of ``docs``, each as often as it is taken, with their columns."""
    copies = mixed(docs, **options).where("copies > 0")
    return copies.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
