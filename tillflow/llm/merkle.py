"""A Merkle manifest of a dataset: a digest per row, per source and of the whole, with proofs.

A tree has three children at a node. Its nodes are numbered by rank, so the digits of a
rank to base 3 say where a node hangs: the digit columns are grouped away one after the
other, lowest first, and every group nests its children as structs. That goes on within
blocks of 243 leaves, which lie in one task each; the blocks' digests are the leaves of the
next tree. On the way back a block that has been told the siblings above it emits the
proofs of all its leaves by one transform and one explode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillflow.session import stored

ARITY = 3
LEVELS = 5  # digits of a block: 3^5 = 243 leaves
BLOCK = ARITY**LEVELS
LEVEL_PATH = "struct<left:array<string>,right:array<string>>"
PATH = f"array<{LEVEL_PATH}>"

#: What a leaf is made of, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    """The sha256 of a text's UTF-8 bytes, in lower-case hex."""
    return F.sha2(F.encode(text, "utf-8"), 256)


def leaf(fields: list[Column]) -> Column:
    """The digest of a row: every field as the number of its bytes, ':' and its text; '-' for null."""
    def spelled(field: Column) -> Column:
        value = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return digest(F.concat(*[spelled(f) for f in fields]))


# --- ranks -------------------------------------------------------------------

def ranked(rows: DataFrame, group: str, order: list[str], pieces: int) -> DataFrame:
    """``rows`` with ``rank``: their number from 0 in the group, by ``order``, nulls first.

    Rows are sorted by ranges over all groups, so that a group of any size is dealt out. A range
    starts with a group that may have begun before it, and only for this one the rows of
    earlier ranges count: one number for a range is all that is broadcast.
    """
    keys = [F.asc_nulls_first(c) for c in (group, *order, "__place")]
    placed = rows.withColumn("__place", F.monotonically_increasing_id())
    # Numbers that ascend over the sorted ranges: the upper bits tell the range.
    numbered = stored(
        placed.repartitionByRange(pieces, *keys).sortWithinPartitions(*keys).drop("__place")
        .withColumn("__at", F.monotonically_increasing_id()), "merkle-rows")
    part = F.shiftright("__at", 33)
    runs = numbered.groupBy(F.col(group), part.alias("__part")).agg(
        F.min("__at").alias("__first"), F.count("*").alias("__rows"))
    before = F.sum("__rows").over(
        W.partitionBy(group).orderBy("__part").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("__rows")
    going_on = runs.withColumn("__before", before).where("__before > 0").select(
        "__part", "__before", F.col(group).alias("__group"))
    here = F.col("__before").isNotNull() & F.col(group).eqNullSafe(F.col("__group"))
    begins = F.min("__at").over(W.partitionBy("__part", group))
    return (
        numbered.withColumn("__part", part).withColumn("__begin", begins)
        .join(F.broadcast(going_on), "__part", "left")
        .withColumn("rank", F.col("__at") - F.col("__begin") + F.when(here, F.col("__before")).otherwise(0))
        .drop("__part", "__at", "__begin", "__before", "__group")
    )


# --- trees -------------------------------------------------------------------

def _node(children: str) -> Column:
    """A node over its children, in order. Node 0 of a level with one child only is the child
    itself: there was one node left."""
    hashes = F.transform(children, lambda c: c["hash"])
    alone = (F.size(children) == 1) & (F.col("above") == 0)
    return F.when(alone, F.get(hashes, 0)).otherwise(digest(F.array_join(hashes, "")))


def blocks(nodes: DataFrame, group: str, content: list[str]) -> DataFrame:
    """(group, rank, hash, tree): blocks of 243 nodes (group, rank, hash and ``content``), each with
    its digest and its nodes nested as they hang."""
    level = nodes.select(
        group, F.expr(f"rank div {BLOCK}").alias("block"),
        *[F.expr(f"rank div {ARITY ** k} % {ARITY}").cast("tinyint").alias(f"digit{k}") for k in range(LEVELS)],
        F.struct("hash", *content).alias("node"),
    ).repartition(F.col(group), F.col("block"))
    for k in range(LEVELS):
        # All groupings have group and block among their keys: the rows stay where they are.
        kept = [f"digit{j}" for j in range(k + 1, LEVELS)]
        above = F.col("block")
        for name in kept:
            above = above + F.col(name)
        children = level.groupBy(group, "block", *kept).agg(
            F.sort_array(F.collect_list(F.struct(f"digit{k}", "node"))).alias("found"))
        level = children.withColumn("children", F.transform("found", lambda c: c["node"])).withColumn(
            "above", above).select(
            group, "block", *kept, F.struct(_node("children").alias("hash"), "children").alias("node"))
    return level.select(group, F.col("block").alias("rank"), "node.hash", F.col("node.children").alias("tree"))


def _steps(children: Column, path: Column, whole: Column, depth: int) -> Column:
    """All leaves below ``children`` as (node, path): the siblings that each meets on the way up,
    the level next to it first. ``whole`` tells of a level 0 that is the only node of its level."""
    def step(child: Column, k: Column) -> Column:
        level = F.struct(
            F.transform(F.slice(children, F.lit(1), k), lambda c: c["hash"]).alias("left"),
            F.transform(F.slice(children, k + 2, F.size(children)), lambda c: c["hash"]).alias("right"))
        alone = (F.size(children) == 1) & whole
        here = F.concat(F.when(alone, F.array().cast(PATH)).otherwise(F.array(level)), path)
        if depth == 1:
            return F.array(F.struct(child.alias("node"), here.alias("path")))
        return _steps(child["children"], here, whole & (k == 0), depth - 1)
    return F.flatten(F.transform(children, step))


def paths(nested: DataFrame, group: str, above: DataFrame) -> DataFrame:
    """(group, node, path) of all nodes in the blocks. ``above`` (group, rank, path) are the
    siblings over each block; it is grouped together with the blocks, not joined to them."""
    tree = dict(nested.dtypes)["tree"]
    both = nested.select(group, "rank", "tree", F.lit(None).cast(PATH).alias("path")).unionByName(
        above.select(group, "rank", F.lit(None).cast(tree).alias("tree"), "path"))
    met = both.groupBy(group, "rank").agg(
        F.first("tree", ignorenulls=True).alias("tree"), F.first("path", ignorenulls=True).alias("path"))
    leaves = _steps(F.col("tree"), F.col("path"), F.col("rank") == 0, LEVELS)
    return met.select(group, F.explode(leaves).alias("found")).select(group, "found.node", "found.path")


def tree(nodes: DataFrame, group: str, content: list[str]) -> tuple[DataFrame, list[DataFrame]]:
    """The root of every group (group, hash), and the blocks of all levels, lowest first.
    ``nodes`` have group, rank, hash and ``content``."""
    levels = [stored(blocks(nodes, group, content), "merkle-blocks")]
    while not levels[-1].where("rank > 0").isEmpty():
        levels.append(stored(blocks(levels[-1].select(group, "rank", "hash"), group, ["rank"]), "merkle-blocks"))
    return levels[-1].select(group, "hash"), levels


def proofs(levels: list[DataFrame], group: str, above: DataFrame) -> DataFrame:
    """(group, node, path) of all nodes of the lowest level, from the path ``above`` each root."""
    upper = above.withColumn("rank", F.lit(0).cast("long"))
    for level in reversed(levels[1:]):
        upper = paths(level, group, upper).select(group, "node.rank", "path")
    return paths(levels[0], group, upper)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, start, lambda h, level: digest(
        F.concat(F.array_join(level["left"], ""), h, F.array_join(level["right"], ""))))


def siblings(path: Column) -> Column:
    """All siblings of a path in one text, level by level, left to right."""
    return F.array_join(F.transform(path, lambda level: F.concat(
        F.array_join(level["left"], ""), F.array_join(level["right"], ""))), "")


def manifest(docs: DataFrame, seen: Column | None = None, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Per row: doc_id, source, leaf, subroot, root, path (array of left and right siblings, level
    by level), and seen_leaf, the digest of the row as it is now.

    ``fields`` are doc_id, source, two more and the text, as columns of ``docs``. ``seen`` is the
    text as it is found now; by default it is unchanged. Within a source leaves ascend by doc_id,
    null first; rows that share an id by their digest, which makes equal ones the same leaf
    twice. A null source is a source; sources ascend by their bytes. Null and empty fields differ.
    An empty table gives an empty manifest; other columns are ignored. Rows have to come in the
    same order when a task runs again, as those of a stored table do.
    """
    doc_id, source, *others, text = [F.col(f) for f in fields]
    now = text if seen is None else seen
    rows = docs.select(
        doc_id.cast("long").alias("doc_id"), source.cast("string").alias("source"),
        leaf([doc_id, source, *others, text]).alias("hash"),
        F.when(~now.eqNullSafe(text), leaf([doc_id, source, *others, now])).alias("changed"))
    pieces = max(1, docs.rdd.getNumPartitions())
    leaves = ranked(rows, "source", ["doc_id", "hash"], pieces)
    subroots, levels = tree(leaves, "source", ["doc_id", "changed"])
    # The sources' roots are the leaves of one more tree, of one group.
    sources = ranked(
        subroots.select(F.lit(0).alias("all"), "source", "hash"), "all", ["source"],
        max(1, subroots.rdd.getNumPartitions()))
    roots, tops = tree(sources, "all", ["source"])
    whole = roots.select("all", F.array().cast(PATH).alias("path"))
    above = proofs(tops, "all", whole).select("node.source", "path", F.col("node.hash").alias("subroot"))
    root = roots.select("hash").scalar()
    tagged = above.select("source", F.concat("path", F.array(F.struct(
        F.array("subroot").alias("left"), F.array().cast("array<string>").alias("right")))).alias("path"))
    # The subroot travels down as a last entry of the path, and is taken off at the leaves.
    found = proofs(levels, "source", tagged)
    return found.select(
        "node.doc_id", "source", F.col("node.hash").alias("leaf"),
        F.get(F.element_at("path", -1)["left"], 0).alias("subroot"), root.alias("root"),
        F.slice("path", F.lit(1), F.size("path") - 1).alias("path"),
        F.coalesce("node.changed", "node.hash").alias("seen_leaf"))
