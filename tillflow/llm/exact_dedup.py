"""Exact deduplication with an extendible-hash index on shared files.

1. Every task first joins the equal texts it meets itself, so that a text with any
   number of copies leaves a task a few times at most.
2. A directory of buckets is grown by doubling: a bucket with more entries than its
   capacity is split by the next bit of the hash, until none is overfull. The
   directory is a table in the shared folder.
3. Owner tasks take ranges of the key (whole buckets, in order), compare the bytes of
   texts with one key, chain those that collide, and write the index files.
4. Documents look their text up in the index by key and checksum.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.session import new_folder, stored

KEY_BITS = 63
MOST_DEPTH = 40


def default_key(sha: Column) -> Column:
    """The first 63 bits of a checksum in hexadecimal digits."""
    # Sixteen digits are 64 bits and may not fit a signed number; fifteen are 60.
    high = F.conv(F.substring(sha, 1, 15), 16, 10).cast("long")
    low = F.conv(F.substring(sha, 16, 1), 16, 10).cast("long")
    return F.shiftleft(high, 3).bitwiseOR(F.shiftright(low, 1))


@dataclass
class Index:
    """The tables of an index: ``directory`` (bucket, prefix, depth), one row a bucket,
    and ``entries`` (key, slot, text_sha256, keep_id, group_size, text)."""

    directory: DataFrame
    entries: DataFrame


def _combined(keyed: DataFrame, held_bytes: int) -> DataFrame:
    """Entries (key, text_sha256, text, keep_id, group_size) with the equal texts of
    a task joined, as far as ``held_bytes`` of text reach."""
    schema = pa.schema([("key", pa.int64()), ("text_sha256", pa.string()), ("text", pa.string()),
                        ("keep_id", pa.int64()), ("group_size", pa.int64())])

    def flush(held: dict) -> pa.RecordBatch:
        texts = list(held)
        return pa.RecordBatch.from_arrays([
            pa.array([held[t][0] for t in texts], pa.int64()),
            pa.array([held[t][1] for t in texts], pa.string()), pa.array(texts, pa.string()),
            pa.array([held[t][2] for t in texts], pa.int64()),
            pa.array([held[t][3] for t in texts], pa.int64()),
        ], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0
        for batch in batches:
            for doc, key, sha, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                entry = held.get(text)
                if entry is None:
                    held[text] = [key, sha, doc, 1]
                    size += len(text) + 200
                    if size > held_bytes:
                        yield flush(held)
                        held, size = {}, 0
                else:
                    entry[3] += 1
                    if doc is not None and (entry[2] is None or doc > entry[2]):
                        entry[2] = doc
        if held:
            yield flush(held)

    return keyed.mapInArrow(
        work, "key long, text_sha256 string, text string, keep_id long, group_size long")


def grow_directory(keys: DataFrame, capacity: int) -> DataFrame:
    """The buckets (prefix, depth, bucket) for a table of distinct keys (key, n).

    Starts at one bucket. As long as a bucket holds more than ``capacity`` entries the
    directory doubles: overfull buckets are replaced by the two that the next bit of
    the key tells apart. A bucket with one key cannot be split any more. Per round, one
    count over the keys of the overfull buckets alone.
    """
    total = keys.agg(F.count("*")).first()[0]
    depth = min(max(0, (max(total, 1) // capacity).bit_length()), MOST_DEPTH)
    closed: DataFrame | None = None
    cells = _cells(keys, depth)
    while True:
        # At the deepest level, and with one key only, a bucket stays as it is: its keys chain.
        cells = stored(cells, f"directory-{depth}")
        over = (F.col("n") > capacity) & (F.col("first") != F.col("last")) & F.lit(depth < MOST_DEPTH)
        done = cells.where(~over).select("prefix", "depth")
        closed = done if closed is None else closed.unionByName(done)
        overfull = cells.where(over)
        if overfull.isEmpty():
            break
        keys = keys.join(
            overfull.select("prefix"), F.shiftright("key", KEY_BITS - depth) == F.col("prefix"), "left_semi")
        depth += 1
        cells = _cells(keys, depth)
    return closed.withColumn("bucket", F.expr(f"shiftleft(prefix, {KEY_BITS} - depth)"))


def _cells(keys: DataFrame, depth: int) -> DataFrame:
    return keys.groupBy(F.shiftright("key", KEY_BITS - depth).alias("prefix")).agg(
        F.count("*").alias("n"), F.min("key").alias("first"), F.max("key").alias("last"),
    ).withColumn("depth", F.lit(depth))


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = 512,
                held_bytes: int = 48_000_000, key: Callable[[Column], Column] | None = None) -> Index:
    """The index of all texts; its files lie in the shared folder.

    ``capacity`` is the number of distinct keys in a bucket, ``held_bytes`` bounds the
    texts a task holds while it joins equal ones. ``key`` makes the 63-bit key from the
    checksum; equal keys of different texts are chained in any number.
    """
    spark = docs.sparkSession
    keyed = _keyed(docs, doc_id, text, key)
    keys = stored(keyed.select("key").distinct(), "index-keys")
    directory = stored(grow_directory(keys, capacity), "index-directory")
    folder = new_folder(spark, "index-entries")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Every bucket lies in one prefix of the directory's least depth: the owner of a
    # prefix has whole buckets, and takes their key ranges in order.
    depth = directory.agg(F.min("depth")).first()[0] or 0
    pieces = _combined(keyed, held_bytes).repartition(
        partitions, F.shiftright("key", KEY_BITS - depth)).sortWithinPartitions("key")

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain: dict[bytes, list] = {}
        current = None
        rows: list[tuple] = []
        size = 0

        def close() -> None:
            rows.extend((current, slot, *entry) for slot, entry in enumerate(chain.values()))

        for batch in batches:
            for k, sha, t, keep, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != current:
                    close()
                    current, chain = k, {}
                    if size > 16_000_000:
                        yield _entries(rows)
                        rows, size = [], 0
                same = chain.get(t)  # compares the texts themselves
                if same is None:
                    chain[t] = [sha, keep, n, t]
                    size += len(t) + 200
                else:
                    same[2] += n
                    if keep is not None and (same[1] is None or keep > same[1]):
                        same[1] = keep
        close()
        if rows:
            yield _entries(rows)

    pieces.mapInArrow(
        own, "key long, slot int, text_sha256 string, keep_id long, group_size long, text string",
    ).write.option("compression", "zstd").parquet(folder)
    return Index(directory, spark.read.parquet(folder))


def _entries(rows: list[tuple]) -> pa.RecordBatch:
    names = ["key", "slot", "text_sha256", "keep_id", "group_size", "text"]
    types = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def _keyed(docs: DataFrame, doc_id: str, text: str, key: Callable[[Column], Column] | None) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    sha = F.sha2(F.encode(whole, "utf-8"), 256)
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), sha.alias("text_sha256"), whole.alias("text"),
    ).select("doc_id", (key or default_key)(F.col("text_sha256")).alias("key"), "text_sha256", "text")


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", index: Index | None = None,
                key: Callable[[Column], Column] | None = None, **options: int) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

    Texts are equal when their bytes are; null counts as empty. The largest doc_id of
    equal texts stays. Rows that repeat a doc_id and a text get the same answer each,
    and all count in group_size. A null doc_id is kept only if its text has no other
    row with an id: keep_id is null then. Other columns are ignored; an empty table
    gives an empty one.
    """
    index = index or build_index(docs, doc_id, text, key=key, **options)
    found = index.entries.select("key", "text_sha256", "keep_id", "group_size")
    rows = _keyed(docs, doc_id, text, key).drop("text")
    return rows.join(found, ["key", "text_sha256"], "left").select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    )


def keep(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options: int) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns; of rows that repeat a doc_id
    and its text, one."""
    answers = exact_dedup(docs, doc_id, text, **options).where("kept").select(
        F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha")).distinct()
    sha = F.sha2(F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8"), 256)
    rows = docs.select(F.struct("*").alias("row"), F.col(doc_id).cast("long").alias("id"), sha.alias("sha"))
    kept = rows.join(
        answers, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("sha") == F.col("kept_sha")), "left_semi")
    return kept.dropDuplicates(["id", "sha"]).select("row.*")
