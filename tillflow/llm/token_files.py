"""Token ids in compressed shards, in ascending order of documents.

Documents are dealt out by ranges of their id, so that the files follow each other; a task
encodes its range with the tokenizers library and writes shards of whole documents, each
compressed by a grammar of its own (`grammar`). Reading needs one shard at a time.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tillflow.llm import grammar
from tillflow.llm.bpe import byte_symbols
from tillflow.session import new_folder

SHARD_TOKENS = 2**19
END = 2  # the id that ends a document

#: One shard in a row: its range of documents, its number there, tokens of the range before it.
SHARDS = "part int, shard int, before long, n_tokens long, doc_ids array<bigint>, data binary"

#: The vocabulary's pattern, and the same over lower-case words of ASCII and Latin-1 letters:
#: composed letters that normalisation leaves as they are. Others go to the library as they stand.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LATIN_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|\n|[^a-z0-9ß-öø-ÿ\n]+")
NOT_LATIN = r"[^\x{00}-\x{7F}À-ÖØ-öø-ÿ]"
KNOWN = 500_000  # words, and pieces of words, that a worker remembers
KNOWN_IDS = 8_000_000
BATCH = 64


class Encoder:
    """The library over words of white-space separated text.

    Neither its normalisation nor its pattern looks across white space, so a text's ids are
    those of its words, and of plain words those of the pattern's pieces. What has been met is
    remembered, a bounded number of words and pieces; the library gets the rest. ids lie in one
    array, and texts are put together from places in it.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_str(vocabulary)
        self.full.no_truncation()
        self.full.no_padding()
        self.size = self.full.get_vocab_size(with_added_tokens=True)
        special = [re.escape(t.content) for t in self.full.get_added_tokens_decoder().values()]
        self.not_plain = "|".join([NOT_LATIN, *special])
        spec = json.loads(vocabulary)
        cut = spec["pre_tokenizer"]["pretokenizers"][0].get("pattern", {}).get("Regex")
        self.plain = cut == PATTERN and [n["type"] for n in spec["normalizer"]["normalizers"]] == [
            "NFC", "Replace", "Lowercase"]
        # Pieces are normalised and cut already: the library's model takes them as characters
        # that stand for their bytes.
        self.model = self.full.model
        symbols = byte_symbols()
        self.as_bytes = {c: "".join(symbols[b] for b in chr(c).encode()) for c in range(256) if chr(c) != "\n"}
        self.forget()

    def forget(self) -> None:
        self.words: dict[str, int] = {}
        self.pieces: dict[str, int] = {}
        self.ids = np.empty(2**16, "<u4")
        self.starts = np.zeros(2**16, np.int64)  # by entry; the next one's is the end
        self.entries = 0
        self._remember(["\n"], self.pieces, np.zeros(0, "<u4"), np.zeros(1, np.int64))  # between words

    def _remember(self, names: list[str], into: dict[str, int], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Adds entries whose ids lie end to end."""
        begin, last = int(self.starts[self.entries]), self.entries + len(sizes)
        if last >= len(self.starts):
            self.starts = np.resize(self.starts, 2 * last)
        if begin + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * (begin + len(ids)))
        self.ids[begin:begin + len(ids)] = ids
        self.starts[self.entries + 1:last + 1] = begin + np.cumsum(sizes)
        into.update(zip(names, range(self.entries, last), strict=True))
        self.entries = last

    def _of(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of entries, end to end, and the number of each."""
        begin = self.starts[index]
        sizes = self.starts[index + 1] - begin
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.arange(total) + np.repeat(begin - ends + sizes, sizes)], sizes

    def _whole(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and sizes of words of any kind."""
        groups = [words[a:a + BATCH] for a in range(0, len(words), BATCH)]
        ids, sizes = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for group, found in zip(groups, self.full.encode_batch(
                groups, is_pretokenized=True, add_special_tokens=False), strict=True):
            ids.append(np.array(found.ids, "<u4"))
            sizes.append(np.bincount(np.array(found.word_ids, np.int64), minlength=len(group)))
        return np.concatenate(ids), np.concatenate(sizes)

    def _parts(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and sizes of pieces of plain words."""
        tokenize = self.model.tokenize
        found = [[t.id for t in tokenize(p)] for p in "\n".join(pieces).translate(self.as_bytes).split("\n")]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), "<u4", int(sizes.sum())), sizes

    def _learn(self, words: pa.Array) -> None:
        odd = pc.match_substring_regex(words, self.not_plain)
        if not self.plain:
            odd = pc.or_(odd, True)
        rest = _strings(words.filter(odd))
        self._remember(rest, self.words, *self._whole(rest))
        plain = _strings(words.filter(pc.invert(odd)))
        if not plain:
            return
        # One look at all words, a line feed between two, which no word holds.
        every = pa.array(LATIN_PIECE.findall("\n".join([*plain, ""]).lower())).dictionary_encode()
        pieces = _strings(every.dictionary)
        new = [p for p in pieces if p not in self.pieces]
        if new:
            self._remember(new, self.pieces, *self._parts(new))
        table = np.fromiter(map(self.pieces.__getitem__, pieces), np.int64, len(pieces))
        index = every.indices.to_numpy()
        ids, sizes = self._of(table[index])
        ends = np.flatnonzero(index == pieces.index("\n"))
        self._remember(plain, self.words, ids, np.diff(np.append(0, np.cumsum(sizes)[ends])))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, end to end, and the number of each text's."""
        collecting = gc.isenabled()
        gc.disable()  # it would look through all words again and again, and find nothing
        try:
            return self._encode(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if max(len(self.words), len(self.pieces)) > KNOWN or self.starts[self.entries] > KNOWN_IDS:
            self.forget()
        cut = pc.ascii_split_whitespace(texts)
        every = cut.flatten().dictionary_encode()
        words = _strings(every.dictionary)
        known = np.array([self.words.get(w, -1) for w in words], np.int64)
        if (known < 0).any():
            self._learn(every.dictionary.filter(pa.array(known < 0)))
            known = np.array([self.words[w] for w in words], np.int64)
        ids, sizes = self._of(known[every.indices.to_numpy()])
        ends = np.cumsum(pc.list_value_length(cut).to_numpy())
        return ids, np.diff(np.append(0, np.cumsum(sizes))[np.append(0, ends)])


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()  # much faster than to_pylist


def worker_encoder(vocabulary: str) -> Encoder:
    """The encoder of this worker process: tasks that follow each other in it go on with what
    the ones before have met. One vocabulary is held at a time."""
    holder = sys.modules.setdefault("tillflow_worker_encoder", types.ModuleType("tillflow_worker_encoder"))
    key = hashlib.sha256(vocabulary.encode()).digest()
    if getattr(holder, "key", None) != key:
        holder.key, holder.encoder = key, Encoder(vocabulary)
    return holder.encoder


def _write(vocabulary: str, end: int, shard_tokens: int, group_chars: int, least: int, gain: float):
    """The function that tasks run to turn their sorted range into shards."""
    schema = to_arrow_schema(StructType.fromDDL(SHARDS))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, closing = worker_encoder(vocabulary), np.array([end], "<u4")
        ids: list[np.ndarray] = []
        names: list[int | None] = []
        lengths: list[int] = []
        part, shard, before, held = None, 0, 0, 0

        def close() -> pa.RecordBatch:
            nonlocal ids, names, lengths, shard, before, held
            sizes = np.array(lengths, np.int64)
            data = grammar.pack(np.concatenate(ids), sizes, max(encoder.size, end + 1), least, gain)
            row = [part], [shard], [before], [held], [names], [data]
            shard, before = shard + 1, before + held
            ids, names, lengths, held = [], [], [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            texts, sizes = batch.column(2), batch.column(3).to_pylist()
            doc_ids = batch.column(1).to_pylist()
            start = 0
            while start < batch.num_rows:
                stop, chars = start, 0
                while stop < batch.num_rows and (stop == start or chars + sizes[stop] <= group_chars):
                    chars += sizes[stop]
                    stop += 1
                part = batch.column(0)[start].as_py()
                found, counts = encoder.encode(texts.slice(start, stop - start))
                at = 0
                for doc_id, count in zip(doc_ids[start:stop], counts.tolist(), strict=True):
                    if names and held + count + 1 > shard_tokens:
                        yield close()
                    ids += [found[at:at + count], closing]
                    names.append(doc_id)
                    lengths.append(count + 1)
                    held, at = held + count + 1, at + count
                start = stop
        if names:
            yield close()

    return work


def write(docs: DataFrame, vocabulary_path: str, folder: str | None = None, end: int = END,
          shard_tokens: int = SHARD_TOKENS, group_chars: int = 2_000_000, least: int = 8, gain: float = 0.01,
          doc_id: str = "doc_id", text: str = "text") -> str:
    """Encodes whole texts, ends each with ``end``, and writes them as shards below ``folder``
    (by default a new one in the shared folder), which is returned.

    Documents ascend by doc_id, a null one first; rows that share an id follow each other by
    a hash of their text, then by their place in the input, so ids that many rows share are
    dealt out like any other. That place has to be the same if a task runs again: give a
    table that is stored, not one that is computed in no fixed order. A null text counts as
    empty: its one token is ``end``. There are as many ranges as the input has pieces. A shard
    has ``shard_tokens`` at most, or one document that is longer; a task holds one shard and
    ``group_chars`` characters (or one longer text). Other columns are ignored; an empty table
    gives an empty folder that can be read. Compression is as `grammar.replace_pairs` says.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-shards")
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = file.read()
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole.alias("text")).withColumns({
        "hash": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    order = [F.asc_nulls_first("doc_id"), F.asc("hash"), F.asc("place")]
    pieces = max(1, docs.rdd.getNumPartitions())
    ranged = rows.repartitionByRange(pieces, *order).sortWithinPartitions(*order).select(
        F.spark_partition_id().alias("part"), "doc_id", "text", F.length("text").alias("size"))
    shards = ranged.mapInArrow(_write(vocabulary, end, shard_tokens, group_chars, least, gain), SHARDS)
    # Rows are large: the writer has to look at its buffer after every one.
    shards.write.option("compression", "zstd").option("parquet.page.size.row.check.min", "1").option(
        "parquet.page.size.row.check.max", "1").parquet(folder)
    return folder


def shards(spark: SparkSession, folder: str) -> DataFrame:
    """The shards of a folder, each with ``start``: the tokens of all shards before it. What is
    added up over all ranges is one row for each of them."""
    found = spark.read.schema(SHARDS).parquet(folder)
    sums = found.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    upto = F.sum("tokens").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow))
    first = sums.select("part", (upto - F.col("tokens")).alias("first"))
    return found.join(F.broadcast(first), "part").withColumn("start", F.col("first") + F.col("before")).drop("first")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of a folder: doc_id, start (tokens of all documents before it), ids
    (binary, little-endian, 32 bits each)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for start, doc_ids, data in _shards(batches):
            shard = grammar.unpack(data)
            ids, ends = shard.tokens(), np.cumsum(shard.sizes)
            raw, begins = ids.tobytes(), ends - shard.sizes
            values = [raw[4 * a:4 * b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(start + begins, pa.int64()), pa.array(values, pa.binary())],
                names=["doc_id", "start", "ids"])

    return shards(spark, folder).select("start", "doc_ids", "data").mapInArrow(
        work, "doc_id long, start long, ids binary")


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of a folder: doc_id, start, n_tokens and ids_crc32, the checksum of its
    ids as little-endian 32-bit integers."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for start, doc_ids, data in _shards(batches):
            shard = grammar.unpack(data)
            raw = memoryview(shard.tokens().tobytes())
            ends = np.cumsum(shard.sizes)
            begins = ends - shard.sizes
            sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(start + begins, pa.int64()),
                 pa.array(shard.sizes, pa.int64()), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards(spark, folder).select("start", "doc_ids", "data").mapInArrow(
        work, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, bytes]]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield tuple(batch.column(c)[k].as_py() for c in range(3))
