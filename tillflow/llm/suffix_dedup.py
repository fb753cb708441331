"""Removal of repeated byte strings with suffix arrays over anchored pieces.

A string of ``least`` bytes that stands in two documents must be found wherever it
stands. Each such window has an anchor, the run of ``SEED`` bytes in it with the least
hash, at the same place in every copy: windows with an anchor in common meet, others
never need to. The windows that one anchor of a document serves are a piece, some
seventy bytes long.

1. Documents are packed into blocks, a table bucketed by block: later steps join to it
   without moving text.
2. Owners of hash ranges learn which anchors stand in more than one document.
3. Of these, owners compare the pieces by their hashes. Equal pieces are settled: all
   but those of the least document go. Within a block that is done before anything is sent.
4. Where pieces of one anchor differ, their bytes are fetched. A suffix array with common
   prefix lengths over them is scanned with a stack: every interval of the tree of common
   prefixes whose suffixes are preceded by different bytes is a maximal repeat, and is
   put out with all its occurrences.
5. Each block cuts the bytes found out of its documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm import bytehash
from tillflow.llm.bytehash import GOLDEN, U, mix
from tillflow.session import stored

BLOCK_BYTES = 2_000_000
SEED = 20
CHUNK = 1_000_000  # bytes of pieces in one suffix array
FACTOR = GOLDEN
INVERSE = pow(GOLDEN, -1, 2**64)
BYTE_VALUES = mix(np.arange(1, 257).astype(U) * U(GOLDEN))


# --- blocks -----------------------------------------------------------------------

@dataclass
class Block:
    docs: np.ndarray  # id of each document
    starts: np.ndarray  # where each begins, with the end
    data: np.ndarray


def make_blocks(docs: DataFrame, doc_id: str, text: str, partitions: int) -> tuple[DataFrame, str]:
    """The documents packed into blocks (block, docs, sizes, data), and the table's name."""

    def pack(ids: list[int], texts: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([uuid.uuid4().int >> 65], pa.int64()),
            pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
            pa.array([np.array([len(t) for t in texts], np.int64).tobytes()], pa.binary()),
            pa.array([pa.compress(b"".join(texts), codec="zstd", asbytes=True)], pa.binary()),
        ], names=["block", "docs", "sizes", "data"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if texts and size + len(t) > BLOCK_BYTES:
                    yield pack(ids, texts)
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t)
        if texts:
            yield pack(ids, texts)

    name = f"text_blocks_{uuid.uuid4().hex}"
    rows = docs.where(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8").alias("text"))
    rows.mapInArrow(work, "block long, docs binary, sizes binary, data binary").write.option(
        "compression", "none").bucketBy(partitions, "block").saveAsTable(name)
    return docs.sparkSession.table(name), name


def _block(docs: bytes, sizes: bytes, data: bytes) -> Block:
    lengths = np.frombuffer(sizes, np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    raw = pa.decompress(data, decompressed_size=int(starts[-1]), codec="zstd", asbytes=True) if starts[-1] else b""
    return Block(np.frombuffer(docs, np.int64), starts, np.frombuffer(raw, np.uint8))


# --- anchors ------------------------------------------------------------------------

@dataclass
class Pieces:
    """One for each run of windows with the same anchor, in order of place."""

    key: np.ndarray  # hash of the anchor
    content: np.ndarray  # hash of the piece and of the anchor's place in it
    row: np.ndarray  # number of the document in the block
    doc: np.ndarray
    begin: np.ndarray  # place in the block
    length: np.ndarray

    def take(self, which: np.ndarray) -> Pieces:
        return Pieces(*(getattr(self, f)[which] for f in self.__dataclass_fields__))


def _powers(factor: int, n: int) -> np.ndarray:
    powers = np.full(n, factor, U)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def pieces_of(block: Block, least: int) -> Pieces:
    """The pieces of all windows of ``least`` bytes that lie in one document."""
    data, starts = block.data, block.starts
    sizes = np.diff(starts)
    windows = len(data) - least + 1
    span = least - SEED + 1
    inside = np.repeat(starts[1:], sizes)[:max(windows, 0)] >= np.arange(max(windows, 0)) + least
    at = np.flatnonzero(inside)
    if not len(at):
        none = np.zeros(0, np.int64)
        return Pieces(none.astype(U), none.astype(U), none, none, none, none)
    values = BYTE_VALUES[data]
    seeds = mix(bytehash.window_hashes(values, SEED))
    best, width = np.arange(len(seeds), dtype=np.int32), 1
    while 2 * width <= span:  # the least of twice as many, the first of equal ones
        left, right = best[:-width], best[width:]
        best, width = np.where(seeds[left] <= seeds[right], left, right), 2 * width
    left, right = best[:windows], best[span - width:span - width + windows]
    anchor = np.where(seeds[left] <= seeds[right], left, right)[at]
    first = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (np.diff(at) > 1)))
    last = np.append(first[1:], len(at)) - 1
    begin, end = at[first], at[last] + least
    sums = np.concatenate([np.zeros(1, U), np.cumsum(values * _powers(FACTOR, len(values)))])
    content = (sums[end] - sums[begin]) * _powers(INVERSE, len(values))[begin]
    place = anchor[first] - begin
    row = np.searchsorted(starts, begin, side="right") - 1
    return Pieces(seeds[anchor[first]], mix(content + mix((end - begin).astype(U) * U(1 << 20) + place.astype(U))),
                  row, block.docs[row], begin, end - begin)


def settled(pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """For equal pieces, which are not of the least document (they go), and which are."""
    order = np.lexsort((pieces.doc, pieces.content, pieces.key))
    if not len(order):
        return order, order
    key, content, doc = pieces.key[order], pieces.content[order], pieces.doc[order]
    new = np.append(True, (key[1:] != key[:-1]) | (content[1:] != content[:-1]))
    least = np.repeat(doc[new], np.diff(np.append(np.flatnonzero(new), len(new))))
    return order[doc > least], order[doc == least]


# --- packed rows: arrays of one kind for a bucket or a block --------------------------

def _by(number: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    if not len(number):
        return
    order = np.argsort(number, kind="stable")
    found, first = np.unique(number[order], return_index=True)
    for n, b, e in zip(found, first, np.append(first[1:], len(order)), strict=True):
        yield int(n), [a[order[b:e]] for a in arrays]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of each bucket, from rows sorted by bucket (the first column)."""
    current, rows = None, []
    for batch in batches:
        for bucket, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if bucket != current:
                if rows:
                    yield current, rows
                current, rows = bucket, []
            rows.append(row)
    if rows:
        yield current, rows


def _record(columns: list[list], types: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _owned(rows: DataFrame, work: Callable, partitions: int, schema: str) -> DataFrame:
    return rows.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(work, schema)


def _with_blocks(blocks: DataFrame, sent: DataFrame, column: str, how: str, work: Callable, schema: str) -> DataFrame:
    """Blocks with all that was sent to each (a list of binaries); the text is not moved."""
    lists = sent.groupBy("block").agg(F.collect_list(column).alias("sent"))
    return blocks.join(lists, "block", how).select("block", "docs", "sizes", "data", "sent").mapInArrow(work, schema)


def _each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Block, list[bytes]]]:
    for batch in batches:
        for i in range(batch.num_rows):
            block, docs, sizes, data, sent = (c[i].as_py() for c in batch.columns)
            yield block, _block(docs, sizes, data), sent or []


# --- steps ----------------------------------------------------------------------------

def anchor_keys(blocks: DataFrame, least: int, buckets: int) -> DataFrame:
    """(bucket, block, keys, several): the distinct anchors of a block, 32 bits of each beside
    its bucket, and whether several documents of the block have it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                number, docs, sizes, data = (c[i].as_py() for c in batch.columns)
                pieces = pieces_of(_block(docs, sizes, data), least)
                if not len(pieces.key):
                    continue
                order = np.lexsort((pieces.doc, pieces.key))
                key, doc = pieces.key[order], pieces.doc[order]
                new = np.append(True, key[1:] != key[:-1])
                first = np.flatnonzero(new)
                several = doc[np.append(first[1:], len(key)) - 1] != doc[first]
                key = key[new]
                out: list[list] = [[], [], [], []]
                for bucket, (k, s) in _by((key % U(buckets)).astype(np.int64), key, several):
                    for column, value in zip(out, (
                            bucket, number, (k >> U(32)).astype(np.uint32).tobytes(), np.packbits(s).tobytes()),
                            strict=True):
                        column.append(value)
                yield _record(out, [pa.int32(), pa.int64(), pa.binary(), pa.binary()],
                              ["bucket", "block", "keys", "several"])

    return blocks.select("block", "docs", "sizes", "data").mapInArrow(
        work, "bucket int, block long, keys binary, several binary")


def shared_keys(keys: DataFrame, partitions: int) -> DataFrame:
    """(block, sent): of each block the anchors that another document has, too."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _groups(batches):
            parts = [np.frombuffer(r[1], np.uint32) for r in rows]
            key = np.concatenate(parts)
            sizes = [len(p) for p in parts]
            several = np.concatenate([
                np.unpackbits(np.frombuffer(r[2], np.uint8), count=n) for r, n in zip(rows, sizes, strict=True)])
            order = np.argsort(key, kind="stable")
            new = np.append(True, key[order][1:] != key[order][:-1])
            first = np.flatnonzero(new)
            count = np.diff(np.append(first, len(key)))
            shared = np.zeros(len(key), bool)
            shared[order] = np.repeat((count > 1) | (np.add.reduceat(several[order].astype(np.int64), first) > 0), count)
            ends = np.cumsum(sizes)
            blocks, sent = [], []
            for r, b, e in zip(rows, ends - sizes, ends, strict=True):
                mine = key[b:e][shared[b:e]]
                if len(mine):
                    blocks.append(r[0])
                    sent.append(np.array([bucket], np.int32).tobytes() + mine.tobytes())
            yield _record([blocks, sent], [pa.int64(), pa.binary()], ["block", "sent"])

    return _owned(keys, work, partitions, "block long, sent binary")


ENTRY = np.dtype([("key", "<u4"), ("content", "<u8"), ("doc", "<i8"), ("begin", "<i4"), ("length", "<u2")])


def shared_pieces(blocks: DataFrame, shared: DataFrame, least: int, buckets: int) -> DataFrame:
    """(bucket, block, entries): the pieces of shared anchors; of equal ones in a block those
    of the least document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block, sent in _each_block(batches):
            pieces = pieces_of(block, least)
            pieces = pieces.take(settled(pieces)[1])
            lists = {int(np.frombuffer(s[:4], np.int32)[0]): np.frombuffer(s[4:], np.uint32) for s in sent}
            out: list[list] = [[], [], []]
            bucket = (pieces.key % U(buckets)).astype(np.int64)
            for n, (which,) in _by(bucket, np.arange(len(bucket))):
                if n not in lists:
                    continue
                mine = pieces.take(which)
                key = (mine.key >> U(32)).astype(np.uint32)
                some = np.isin(key, lists[n])
                entries = np.zeros(some.sum(), ENTRY)
                for field, values in (("key", key), ("content", mine.content), ("doc", mine.doc),
                                      ("begin", mine.begin), ("length", mine.length)):
                    entries[field] = values[some]
                # Field by field the bytes of a kind stand together, which packs well.
                for column, value in zip(out, (n, number, _planes(entries)), strict=True):
                    column.append(value)
            yield _record(out, [pa.int32(), pa.int64(), pa.binary()], ["bucket", "block", "entries"])

    return _with_blocks(blocks, shared, "sent", "inner", work, "bucket int, block long, entries binary")


def _planes(entries: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(entries[f]).tobytes() for f in entries.dtype.names)


def _entries(raw: bytes) -> dict[str, np.ndarray]:
    n, found, at = len(raw) // ENTRY.itemsize, {}, 0
    for name in ENTRY.names:
        kind = ENTRY[name]
        found[name] = np.frombuffer(raw, kind, n, at)
        at += n * kind.itemsize
    return found


def compare_pieces(entries: DataFrame, partitions: int) -> DataFrame:
    """(block, spans, asked): spans (begin, length) that go, and pieces whose anchor has
    different pieces elsewhere (bucket, key, begin, length)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _groups(batches):
            parts = [_entries(r[1]) for r in rows]
            owner = np.repeat(np.arange(len(rows)), [len(p["key"]) for p in parts])
            e = {name: np.concatenate([p[name] for p in parts]) for name in ENTRY.names}
            pieces = Pieces(e["key"], e["content"], owner, e["doc"], e["begin"].astype(np.int64),
                            e["length"].astype(np.int64))
            gone, left = settled(pieces)
            # Of the rest, those whose anchor has another piece of another document.
            key, content, doc = pieces.key[left], pieces.content[left], pieces.doc[left]
            order = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
            count = np.diff(np.append(first, len(key)))
            differ = np.zeros(len(key), bool)
            if len(key):
                low, high = (f.reduceat(content[order], first) for f in (np.minimum, np.maximum))
                low_doc, high_doc = (f.reduceat(doc[order], first) for f in (np.minimum, np.maximum))
                differ[order] = np.repeat((low != high) & (low_doc != high_doc), count)
            asked = left[differ]
            spans = dict(_by(owner[gone], pieces.begin[gone], pieces.length[gone]))
            wanted = dict(_by(owner[asked], pieces.key[asked], pieces.begin[asked], pieces.length[asked]))
            out: list[list] = [[], [], []]
            for k in sorted(spans.keys() | wanted.keys()):
                out[0].append(rows[k][0])
                out[1].append(_ints(spans[k]) if k in spans else None)
                out[2].append(_ints([np.full(len(wanted[k][0]), bucket), *wanted[k]]) if k in wanted else None)
            yield _record(out, [pa.int64(), pa.binary(), pa.binary()], ["block", "spans", "asked"])

    return _owned(entries, work, partitions, "block long, spans binary, asked binary")


def _ints(columns: list[np.ndarray]) -> bytes:
    return np.stack([c.astype(np.int64) for c in columns]).astype("<u4").tobytes()


def _from_ints(raw: bytes, columns: int) -> np.ndarray:
    return np.frombuffer(raw, "<u4").reshape(columns, -1).astype(np.int64)


def fetched_pieces(blocks: DataFrame, asked: DataFrame) -> DataFrame:
    """(bucket, block, keys, docs, begins, lengths, data) of the pieces that were asked for."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block, sent in _each_block(batches):
            wanted = np.concatenate([_from_ints(s, 4) for s in sent], 1)
            raw = block.data.tobytes()
            out: list[list] = [[] for _ in range(7)]
            for bucket, (key, begin, length) in _by(wanted[0], *wanted[1:]):
                doc = block.docs[np.searchsorted(block.starts, begin, side="right") - 1]
                data = b"".join([raw[b:b + n] for b, n in zip(begin.tolist(), length.tolist(), strict=True)])
                for column, value in zip(out, (bucket, number, *(a.astype(np.int64).tobytes() for a in (
                        key, doc, begin, length)), data), strict=True):
                    column.append(value)
            yield _record(out, [pa.int32(), pa.int64(), *[pa.binary()] * 5], [
                "bucket", "block", "keys", "docs", "begins", "lengths", "data"])

    return _with_blocks(
        blocks, asked, "asked", "inner", work,
        "bucket int, block long, keys binary, docs binary, begins binary, lengths binary, data binary")


def repeats_in(pieces: DataFrame, least: int, partitions: int) -> DataFrame:
    """(block, spans): the occurrences of maximal repeats that are not of the least document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches):
            key, doc, begin, length = (
                np.concatenate([np.frombuffer(r[k], np.int64) for r in rows]) for k in (1, 2, 3, 4))
            owner = np.repeat(np.arange(len(rows)), [len(r[1]) // 8 for r in rows])
            data = np.frombuffer(b"".join(r[5] for r in rows), np.uint8)
            at = np.cumsum(length) - length
            order = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
            # As many whole groups of an anchor as a suffix array should take.
            before = np.append(0, np.cumsum(length[order]))
            chunk = before[first] // CHUNK
            cuts = first[np.append(True, chunk[1:] != chunk[:-1])]
            found: list[tuple[np.ndarray, ...]] = []
            for b, e in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
                some = order[b:e]
                where, gone_at, gone = removable(data, at[some], length[some], doc[some], least)
                found.append((owner[some[where]], begin[some[where]] + gone_at, gone))
            if found:
                who, start, size = (np.concatenate(c) for c in zip(*found, strict=True))
                out = [(rows[k][0], _ints(v)) for k, v in _by(who, start, size)]
                yield _record([[o[0] for o in out], [o[1] for o in out]], [pa.int64(), pa.binary()], ["block", "spans"])

    return _owned(pieces, work, partitions, "block long, spans binary")


# --- suffix array -------------------------------------------------------------------------

def removable(data: np.ndarray, at: np.ndarray, length: np.ndarray, doc: np.ndarray,
              least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pieces of ``data`` (begin, length, document): piece, offset and length of every
    occurrence of a maximal repeat that a smaller document has, too."""
    # Only pieces with a window that another has, too, go into the array.
    total = int(length.sum())
    text = data[np.repeat(at - (np.cumsum(length) - length), length) + np.arange(total)]
    owner = np.repeat(np.arange(len(at)), length)
    hashes = bytehash.window_hashes(BYTE_VALUES[text], least)
    whole = np.flatnonzero(owner[:len(hashes)] == owner[least - 1:least - 1 + len(hashes)])
    _, which, counts = np.unique(hashes[whole], return_inverse=True, return_counts=True)
    busy = np.unique(owner[whole[counts[which] > 1]])
    where, offset, size = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if len(busy):
        pieces = [data[at[k]:at[k] + length[k]] for k in busy]
        for repeat_length, piece, place in maximal_repeats(pieces, least):
            owners = busy[piece]
            gone = doc[owners] > doc[owners].min()
            where.append(owners[gone])
            offset.append(place[gone])
            size.append(np.full(gone.sum(), repeat_length))
    return np.concatenate(where), np.concatenate(offset), np.concatenate(size)


def suffix_array(symbols: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in order, and how many symbols each has in common with the one before;
    by doubling, up to ``longest`` symbols."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    levels, width = [rank], 1
    order = np.argsort(rank, kind="stable")
    while width < longest:
        second = np.append(rank[width:], np.full(min(width, n), -1))[:n]
        pair = rank * (n + 1) + second + 1
        order = np.argsort(pair, kind="stable")
        rank = np.zeros(n, np.int64)
        rank[order] = np.cumsum(np.append(0, np.diff(pair[order]) != 0))
        width *= 2
        levels.append(rank)
    common = np.zeros(n, np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for k in range(len(levels) - 1, -1, -1):
        inside = (a < n) & (b < n)
        same = np.zeros(n - 1, bool)
        same[inside] = levels[k][a[inside]] == levels[k][b[inside]]
        step = same * (1 << k)
        common[1:] += step
        a += step
        b += step
    return order, common


def maximal_repeats(pieces: list[np.ndarray], least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, pieces, places) of every string of ``least`` symbols or more that occurs
    twice and that no symbol on either side extends in all its occurrences.

    Scans the suffix array with a stack of open intervals of the common prefix tree; an interval
    that closes is put out, with all its suffixes, if different symbols precede them.
    """
    m = len(pieces)
    lengths = np.array([len(p) for p in pieces])
    starts = np.cumsum(lengths + 1) - lengths - 1
    # An end mark of its own follows each piece, so that no prefix runs over an end.
    symbols = np.zeros(int((lengths + 1).sum()), np.int64)
    for k, (piece, start) in enumerate(zip(pieces, starts, strict=True)):
        symbols[start:start + len(piece)] = piece.astype(np.int64) + m
        symbols[start + len(piece)] = k
    order, common = suffix_array(symbols, int(lengths.max()) + 1)
    owner = np.searchsorted(starts, order, side="right") - 1
    place = order - starts[owner]
    before = np.where(order > 0, symbols[order - 1], -1)  # at a piece's begin a mark of its own
    high = np.flatnonzero(common >= least)
    for run in np.split(high, np.flatnonzero(np.diff(high) > 1) + 1):
        if not len(run):
            continue
        # Open intervals: [length, first suffix, the symbol before all so far or None].
        stack: list[list] = []
        last = int(run[-1])
        for i in range(int(run[0]), last + 2):
            size = int(common[i]) if i <= last else 0
            left, first = int(before[i - 1]), i - 1
            while stack and stack[-1][0] > size:
                length, first, symbol = stack.pop()
                symbol = symbol if symbol == left else None
                if symbol is None:
                    yield length, owner[first:i], place[first:i]
                left = symbol
            if size:
                if stack and stack[-1][0] == size:
                    if stack[-1][2] != left:
                        stack[-1][2] = None
                else:
                    stack.append([size, first, left])


# --- the whole operator ----------------------------------------------------------------------

def cut_out(blocks: DataFrame, spans: DataFrame, least: int) -> DataFrame:
    """(doc_id, n_bytes, kept, removed): the bytes left, and the spans (begin, end) cut out."""
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block, sent in _each_block(batches):
            pieces = pieces_of(block, least)
            gone, _ = settled(pieces)
            found = [np.stack([pieces.begin[gone], pieces.length[gone]]), *(_from_ints(s, 2) for s in sent)]
            begin, length = np.concatenate(found, 1)
            # Begins and ends of spans, summed up, tell which bytes lie in one.
            change = np.bincount(begin, minlength=len(block.data) + 1) - np.bincount(
                begin + length, minlength=len(block.data) + 1)
            covered = np.cumsum(change)[:-1] > 0
            left = ~covered
            ids, sizes, kept, removed = [], [], [], []
            for doc, b, e in zip(block.docs.tolist(), block.starts[:-1].tolist(), block.starts[1:].tolist(), strict=True):
                own = covered[b:e]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
                ids.append(doc)
                sizes.append(e - b)
                kept.append(block.data[b:e][left[b:e]].tobytes())
                removed.append([{"begin": x, "end": y} for x, y in edges.reshape(-1, 2).tolist()])
            yield _record([ids, sizes, kept, removed], [pa.int64(), pa.int64(), pa.binary(), span],
                          ["doc_id", "n_bytes", "kept", "removed"])

    return _with_blocks(blocks, spans, "spans", "left", work,
                        "doc_id long, n_bytes long, kept binary, removed array<struct<begin:long,end:long>>")


def suffix_dedup(docs: DataFrame, least: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, kept (binary), removed (spans of bytes).

    Removed is every byte of a string of ``least`` bytes (more than 20) that also begins in a
    document with a smaller doc_id; strings are judged on the input, as UTF-8, and
    never cross documents. Null text counts as empty. Rows that repeat a doc_id remove
    nothing from each other; a row without an id neither removes nor loses anything.
    Other columns are ignored; an empty table gives an empty one. Equal pieces are
    told by 64-bit hashes of anchor and content. A document of 4 GB or more is refused.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = 4 * partitions
    blocks, _ = make_blocks(docs, doc_id, text, partitions)
    shared = shared_keys(anchor_keys(blocks, least, buckets), partitions)
    entries = shared_pieces(blocks, shared, least, buckets)
    compared = stored(compare_pieces(entries, partitions), "compared")
    fetched = fetched_pieces(blocks, compared.where("asked is not null").select("block", "asked"))
    repeats = repeats_in(fetched, least, partitions)
    spans = stored(compared.where("spans is not null").select("block", "spans").unionByName(repeats), "spans")
    anonymous = docs.where(F.col(doc_id).isNull()).select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8").alias("kept"),
    ).select("doc_id", F.octet_length("kept").cast("long").alias("n_bytes"), "kept",
             F.array().cast("array<struct<begin:bigint,end:bigint>>").alias("removed"))
    return cut_out(blocks, spans, least).unionByName(anonymous)
