"""Exact join of documents by the Jaccard distance of their n-gram sets.

The Jaccard distance is a metric, and links are pairs within a small radius r of each
other. Pivots cut the documents into Voronoi regions; a document near the border is
replicated to every region whose pivot is at most 2r farther than its own, so that each
linked pair meets in a region; regions are joined recursively with pivots of their own.

Documents without a common n-gram are all at distance 1, where no pivot can tell them
apart. So the regions start from the n-grams: of two linked documents, each has a common
n-gram among the first few of its set in any order that is the same for all (here, rare
ones first). Documents that share such an n-gram gather around a pivot, the least of
them, and what shares n-grams with a pivot is its root region. Before the sets
are sent, short profiles, which bound the distance, cut a region into groups without a possible
link between them; in regions too large for a task, blocks of members meet in pairs for that.
Groups that fit a task are joined there; larger ones are cut by pivots across the cluster,
level by level.

Equal sets are one class from the start. Members that a pivot has linked already are in
one component, so pairs among them are not looked at: what comes out are enough links
for the components, and every one of them is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm import bytehash
from tillflow.llm.bytehash import U, mix
from tillflow.llm.components import components
from tillflow.session import stored

CELL_BITS = 20
CELL_CHUNK = 4096  # cells whose counts go in one row
PROFILE_BITS = 9
PROFILE = 1 << PROFILE_BITS
COARSE = 64
BATCH_BYTES = 8_000_000
CACHE_BYTES = 400_000  # of texts that are cut into words at once
REGION_SHINGLES = 4_000_000  # shingles of a region that one task joins
REGION_MEMBERS = 4096
BLOCK = 1024  # members of a large region that meet another such block in a task
PIVOTS = 8
LEAF = 24
#: Cells are taken if they have so many times the members in all, and in the largest. Two cells
#: of 0.7 keep the recursion below the square of the members; larger ones could double at
#: every level.
MOST_IN_ALL, MOST_IN_ONE = 1.5, 0.7


@dataclass(frozen=True)
class Rule:
    """Links need 100 * |common| >= percent * |union|."""

    width: int = 4
    percent: int = 85

    def linked(self, common: np.ndarray, total: np.ndarray) -> np.ndarray:
        """``total`` is the sum of both sizes."""
        return 100 * common >= self.percent * (total - common)

    def prefix(self, n: int) -> int:
        """How many first elements of a set hold one in common with any linked set."""
        return n - -(-self.percent * n // 100) + 1

    def indexed(self, n: int) -> int:
        """How many first elements of a set hold the first one in common with any linked set
        that is not smaller."""
        return n - -(-2 * self.percent * n // (100 + self.percent)) + 1

    def sizes_fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 100 * np.minimum(a, b) >= self.percent * np.maximum(a, b)

    @property
    def size_step(self) -> float:
        """Of two linked sets, the logarithms of the sizes differ by less."""
        return float(np.log(100 / self.percent)) + 1e-9

    def most_apart(self, total: np.ndarray) -> np.ndarray:
        """The most elements that only one of two linked sets may have."""
        return (100 - self.percent) * total // (100 + self.percent)

    @property
    def radius(self) -> float:
        return 1 - self.percent / 100 + 1e-9


# --- sets ----------------------------------------------------------------------

def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The sorted hashes of every text's distinct runs of ``width`` words; of fewer words
    the whole sequence, of none nothing."""
    found: list[np.ndarray] = []
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    begin = 0
    while begin < len(texts):  # a few texts at a time, whose arrays stay in the cache
        end = max(begin + 1, int(np.searchsorted(ends, ends[begin] + CACHE_BYTES)))
        found += _few_shingle_sets(texts[begin:end], width)
        begin = end
    return found


def _few_shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    data, starts = bytehash.joined(texts)
    words, owner = bytehash.word_hashes(bytehash.lowered(data), starts)
    runs = mix(bytehash.window_hashes(words, width))
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    found = []
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        n = end - begin
        if n >= width:
            some = np.sort(runs[begin:end - width + 1])
            found.append(some[np.append(True, some[1:] != some[:-1])])
        elif n:
            found.append(mix(bytehash.window_hashes(words[begin:end], n) + U(n)))
        else:
            found.append(np.zeros(0, U))
    return found


def class_of(shingles: np.ndarray) -> int:
    """A 63-bit number of a set, the same for equal sets."""
    return int(mix(np.bitwise_xor.reduce(mix(shingles * U(7) + U(1)), keepdims=True)
                   + np.add.reduce(shingles, keepdims=True))[0] >> U(1))


def profile_of(shingles: np.ndarray) -> bytes:
    """How many shingles fall into each of 512 parts; the differences of two profiles never
    add up to more than what the sets differ in. With that many parts, profiles of
    strangers are farther apart than the limit even for sets of 20,000."""
    parts = (shingles >> U(64 - PROFILE_BITS)).astype(np.int64)
    return np.minimum(np.bincount(parts, minlength=PROFILE), 255).astype(np.uint8).tobytes()


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, texts) of a few megabytes each; a longer text alone."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if texts and size + len(text) > BATCH_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(text)
            size += len(text)
    if texts:
        yield ids, texts


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8").alias("text"))


def describe(texts: DataFrame, rule: Rule) -> DataFrame:
    """Per row doc_id, n, cls, profile, sha (of the text); besides, rows (chunk, counts) of a
    task's shingles in each cell, by chunks of the cells."""
    width = rule.width

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELL_BITS, np.int64)
        for ids, raw in _pieces(batches):
            sets = shingle_sets(raw, width)
            every = np.concatenate(sets)
            cells += np.bincount((every >> U(64 - CELL_BITS)).astype(np.int64), minlength=len(cells))
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([class_of(s) for s in sets], pa.int64()),
                pa.array([profile_of(s) for s in sets], pa.binary()),
                pa.array([hashlib.sha256(t).digest() for t in raw], pa.binary()),
                pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.binary()),
            ], names=names)
        # Lowest bytes first, then the next ones: most of the others are 0 and take no room.
        chunks = cells.astype(np.uint32).view(np.uint8).reshape(-1, CELL_CHUNK, 4).transpose(0, 2, 1)
        yield pa.RecordBatch.from_arrays([
            *(pa.nulls(len(chunks), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())),
            pa.array(range(len(chunks)), pa.int32()), pa.array([c.tobytes() for c in chunks], pa.binary()),
        ], names=names)

    names = ["doc_id", "n", "cls", "profile", "sha", "chunk", "counts"]
    return texts.mapInArrow(
        work, "doc_id long, n long, cls long, profile binary, sha binary, chunk int, counts binary")


def cell_levels(described: DataFrame) -> np.ndarray:
    """For each of a fixed number of cells how frequent its shingles are, in quarters of a
    power of two; 0 where it is no more than chance. Counts are those of all tasks together: an
    n-gram that is in no task frequent may be in a large corpus. It only orders n-grams: the
    result does not depend on it, the number of candidates does."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                planes = np.frombuffer(counts, np.uint8).reshape(4, -1)
                some = np.ascontiguousarray(planes.T).view(np.uint32).ravel()
                sums[chunk] = sums.get(chunk, np.zeros(CELL_CHUNK, np.int64)) + some
        yield pa.RecordBatch.from_arrays([
            pa.array(list(sums), pa.int32()), pa.array([c.tobytes() for c in sums.values()], pa.binary())],
            names=["chunk", "counts"])

    cells = np.zeros(1 << CELL_BITS, np.int64)
    counts = described.where("chunk is not null").select("chunk", "counts")
    for row in counts.repartition(64, "chunk").mapInArrow(add, "chunk int, counts binary").collect():
        cells[row["chunk"] * CELL_CHUNK:][:CELL_CHUNK] += np.frombuffer(row["counts"], np.int64)
    mean = max(cells.mean(), 1e-9)
    heavy = cells > max(2.0, mean + 6 * mean ** 0.5)
    levels = np.zeros(1 << CELL_BITS, np.uint8)
    levels[heavy] = 1 + np.minimum(4 * np.log2(cells[heavy] / mean), 126).astype(np.uint8)
    return levels


def first_ones(shingles: np.ndarray, levels: np.ndarray, most: int) -> np.ndarray:
    """The first elements of a set, ``most`` of them: rare ones first, then by hash."""
    level = levels[(shingles >> U(64 - CELL_BITS)).astype(np.int64)]
    return shingles[np.argsort(level, kind="stable")[:most]] if level.any() else shingles[:most]


# --- root regions ---------------------------------------------------------------

def postings(texts: DataFrame, rule: Rule, levels: np.ndarray, buckets: int) -> DataFrame:
    """The first n-grams of every class as packed arrays (bucket, shingle, cls, n), with n
    below 0 for those past `Rule.indexed`. A class that a task meets again is not repeated within
    the same piece of its work."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, raw in _pieces(batches):
            met: set[int] = set()
            keys, owners, sizes = [], [], []
            for s in shingle_sets(raw, rule.width):
                if not len(s):
                    continue
                cls = class_of(s)
                if cls in met:
                    continue
                met.add(cls)
                first = first_ones(s, levels, rule.prefix(len(s)))
                keys.append(first)
                owners.append(np.full(len(first), cls))
                sizes.append(np.where(np.arange(len(first)) < rule.indexed(len(s)), len(s), -len(s)).astype(np.int32))
            if keys:
                yield _packed(np.concatenate(keys), np.concatenate(owners), np.concatenate(sizes), buckets)

    return texts.mapInArrow(work, "bucket int, shingle binary, cls binary, n binary")


def _packed(key: np.ndarray, cls: np.ndarray, n: np.ndarray, buckets: int) -> pa.RecordBatch:
    bucket = (key % U(buckets)).astype(np.int64)
    order = np.lexsort((key, bucket))
    key, cls, n, bucket = key[order], cls[order], n[order], bucket[order]
    found, first = np.unique(bucket, return_index=True)
    ends = np.append(first[1:], len(bucket))
    cut = [[a[b:e].tobytes() for b, e in zip(first, ends, strict=True)] for a in (key, cls, n)]
    return pa.RecordBatch.from_arrays(
        [pa.array(found, pa.int32()), *(pa.array(c, pa.binary()) for c in cut)],
        names=["bucket", "shingle", "cls", "n"])


def root_regions(packed: DataFrame, rule: Rule, partitions: int) -> DataFrame:
    """(region, cls) once each: the least of those that share an n-gram names their region.

    A member needs another of fitting size, and the smaller of the two has the first n-gram they
    have in common within `Rule.indexed`.
    """

    def close(rows: list[tuple]) -> pa.RecordBatch | None:
        key = np.concatenate([np.frombuffer(r[0], U) for r in rows])
        cls = np.concatenate([np.frombuffer(r[1], np.int64) for r in rows])
        signed = np.concatenate([np.frombuffer(r[2], np.int32) for r in rows]).astype(np.int64)
        order = np.lexsort((cls, np.abs(signed), key))
        key, cls, signed = key[order], cls[order], signed[order]
        new = np.append(True, (key[1:] != key[:-1]) | (cls[1:] != cls[:-1]))
        key, cls, signed = key[new], cls[new], signed[new]
        n, indexed, place = np.abs(signed), signed > 0, np.arange(len(key))
        group = np.cumsum(np.append(False, key[1:] != key[:-1]))
        # In order of size, the next one; the last one before, and the next of the same size, that are indexed.
        useful = indexed & np.append(rule.sizes_fit(n[1:], n[:-1]) & (group[1:] == group[:-1]), False)
        before = np.append(-1, np.maximum.accumulate(np.where(indexed, place, -1))[:-1])
        after = np.append(np.minimum.accumulate(np.where(indexed, place, len(key))[::-1])[::-1][1:], len(key))
        for other in (before, after):
            there = (other >= 0) & (other < len(key))
            mine, other = place[there], other[there]
            same = (group[mine] == group[other]) & (n[other] <= n[mine])
            useful[mine] |= same & rule.sizes_fit(n[mine], n[other])
        group, cls = group[useful], cls[useful]
        if len(cls):
            first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            pivot = np.repeat(np.minimum.reduceat(cls, first), np.diff(np.append(first, len(cls))))
        else:
            pivot = cls
        pairs = np.unique(np.stack([pivot, cls], 1), axis=0)
        return pa.RecordBatch.from_arrays(
            [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["region", "cls"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []
        for batch in batches:
            for bucket, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != current:
                    if rows:
                        yield close(rows)
                    current, rows = bucket, []
                rows.append(row)
        if rows:
            yield close(rows)

    found = packed.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(
        work, "region long, cls long")
    return found.distinct()


def _by_region(rows: DataFrame, partitions: int) -> DataFrame:
    return rows.repartition(partitions, "region").sortWithinPartitions("region")


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of each region, from rows sorted by region (the first column)."""
    current, rows = None, []
    for batch in batches:
        for region, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if region != current:
                if rows:
                    yield current, rows
                current, rows = region, []
            rows.append(row)
    if rows:
        yield current, rows


def near_groups(n: np.ndarray, profile: np.ndarray, rule: Rule) -> np.ndarray:
    """The group of every member, of sizes in ascending order: no two members of different groups
    can be linked, as far as sizes and profiles tell. Each is compared only with those of
    fitting size that are in no group yet, so a large group costs little more than its members."""
    profile = profile.astype(np.int16)
    coarse = profile.reshape(len(n), COARSE, -1).sum(2, dtype=np.int16)
    low = np.searchsorted(n, -(-rule.percent * n // 100))
    high = np.searchsorted(n, 100 * n // rule.percent, side="right")
    group, free = np.arange(len(n)), np.ones(len(n), bool)
    for start in range(len(n)):
        if not free[start]:
            continue
        free[start] = False
        found = [start]
        while found:
            i = found.pop()
            near = low[i] + np.flatnonzero(free[low[i]:high[i]])
            for table in (coarse, profile):
                most = rule.most_apart(n[near] + n[i])
                near = near[np.abs(table[near] - table[i]).sum(1) <= most]
            free[near] = False
            group[near] = start
            found += near.tolist()
    return group


def _sorted_profiles(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, n, profile) of rows in ascending order of n."""
    rows.sort(key=lambda r: (r[1], r[0]))
    return (np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64),
            np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(-1, PROFILE))


def with_possible_partner(members: DataFrame, rule: Rule, partitions: int) -> DataFrame:
    """The groups (region, cls) of members (region, cls, n, profile) of regions that fit a task,
    without members alone in a group. A group is named after its members, so that equal ones of
    several regions are one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _regions(batches):
            cls, n, profile = _sorted_profiles(rows)
            group = near_groups(n, profile, rule)
            order = np.argsort(group, kind="stable")
            first = np.flatnonzero(np.append(True, np.diff(group[order])))
            count = np.diff(np.append(first, len(order)))
            name = mix(np.add.reduceat(mix(cls[order].astype(U)), first) + count.astype(U)) >> U(1)
            kept = np.repeat(count > 1, count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(name, count)[kept].astype(np.int64)), pa.array(cls[order][kept])],
                names=["region", "cls"])

    return _by_region(members, partitions).mapInArrow(work, "region long, cls long").distinct()


def groups_of_large(members: DataFrame, rule: Rule, partitions: int) -> DataFrame:
    """`with_possible_partner` for regions that do not fit a task: members of one step of sizes are
    dealt over blocks, and each block meets the others of its step and of the next one."""
    step = F.floor(F.log("n") / rule.size_step)
    placed = members.withColumn("step", step).withColumn("vertex", F.xxhash64("region", "cls"))
    blocks = stored(placed.groupBy("region", "step").agg(
        F.ceil(F.count("*") / BLOCK).alias("blocks")), "blocks")
    for name, shift in (("own", 0), ("next", 1), ("last", -1)):
        placed = placed.join(
            blocks.select("region", (F.col("step") - shift).alias("step"), F.col("blocks").alias(name)),
            ["region", "step"], "left")
    at = F.pmod(F.xxhash64("cls"), F.col("own"))

    def meetings(kind: int, low: Column, others: str, pair) -> Column:
        """A meeting (kind, lower step, two blocks) with each block of ``others``, if any."""
        there = F.coalesce(F.col(others), F.lit(0))
        listed = F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(there - 1, F.lit(0))),
                             lambda j: F.xxhash64("region", F.lit(kind), low, *pair(j)))
        return F.when(there > 0, listed).otherwise(F.array().cast("array<bigint>"))
    inside = meetings(0, F.col("step"), "own", lambda j: (F.least(at, j), F.greatest(at, j)))
    up = meetings(1, F.col("step"), "next", lambda j: (at, j))
    down = meetings(1, F.col("step") - 1, "last", lambda j: (j, at))
    met = placed.select(
        F.explode(F.concat(inside, up, down)).alias("region"), "vertex", "n", "profile")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _regions(batches):
            vertex, n, profile = _sorted_profiles(rows)
            group = near_groups(n, profile, rule)
            other = group != np.arange(len(group))
            yield pa.RecordBatch.from_arrays(
                [pa.array(vertex[group[other]]), pa.array(vertex[other])], names=["a", "b"])

    linked = components(_by_region(met, partitions).mapInArrow(work, "a long, b long"))
    grouped = members.select("region", "cls", F.xxhash64("region", "cls").alias("vertex")).join(
        linked, "vertex").select("component", "cls")
    names = grouped.groupBy("component").agg(F.xxhash64(
        F.bit_xor(F.xxhash64("cls")), F.count("*"), F.min("cls"), F.max("cls")).alias("region"))
    return grouped.join(names, "component").select("region", "cls").distinct()


# --- joining regions ------------------------------------------------------------

class Region:
    """The sets of a region, joined in one task by recursion over pivots."""

    def __init__(self, sets: list[np.ndarray], rule: Rule):
        self.rule = rule
        self.n = np.fromiter(map(len, sets), np.int64, len(sets))
        self.starts = np.concatenate([[0], np.cumsum(self.n)])
        every = np.concatenate(sets)
        self.ids = np.unique(every, return_inverse=True)[1]
        self.marked = np.zeros(len(every) + 1, bool)
        self.parent = list(range(len(sets)))
        self.links: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def elements(self, i: int) -> np.ndarray:
        return self.ids[self.starts[i]:self.starts[i + 1]]

    def common(self, pivot: int, members: np.ndarray) -> np.ndarray:
        own = self.elements(pivot)
        self.marked[own] = True
        counts = np.fromiter((np.count_nonzero(self.marked[self.elements(m)]) for m in members),
                             np.int64, len(members))
        self.marked[own] = False
        return counts

    def measure(self, pivot: int, members: np.ndarray) -> np.ndarray:
        """Distances from a pivot; members within the radius are linked with it."""
        common = self.common(pivot, members)
        total = self.n[members] + self.n[pivot]
        for m in members[self.rule.linked(common, total)]:
            a, b = self.root(pivot), self.root(int(m))
            if a != b:
                self.parent[a] = b
                self.links.append((pivot, int(m)))
        return 1 - common / (total - common)

    def one_component(self, members: np.ndarray) -> bool:
        return len({self.root(int(m)) for m in members}) < 2

    def join(self, members: np.ndarray) -> None:
        """Finds enough exact links among the members."""
        work = [members]
        while work:
            members = work.pop()
            if len(members) < 2 or self.one_component(members):
                continue
            if len(members) <= LEAF:
                for k, pivot in enumerate(members[:-1]):
                    rest = members[k + 1:]
                    others = np.array([m for m in rest if self.root(int(m)) != self.root(int(pivot))], np.int64)
                    if len(others):
                        self.measure(int(pivot), others)
                continue
            # Pivots from different components, as far as there are some.
            roots = np.array([self.root(int(m)) for m in members])
            _, first = np.unique(roots, return_index=True)
            chosen = np.unique(np.concatenate([first[:PIVOTS], np.arange(PIVOTS)]))[:PIVOTS]
            pivots, rest = members[chosen], np.delete(members, chosen)
            for k, pivot in enumerate(pivots[:-1]):
                self.measure(int(pivot), pivots[k + 1:])
            apart = np.stack([self.measure(int(p), rest) for p in pivots])
            below = list(self.cells(rest, apart))
            # Where pivots do not tell the members apart, they have at least been settled
            # themselves: the rest goes on as one region, so that the work stays quadratic at most.
            sizes = [len(cell) for cell in below]
            work += below if sum(sizes) <= MOST_IN_ALL * len(rest) and max(sizes) <= MOST_IN_ONE * len(rest) else [rest]

    def cells(self, rest: np.ndarray, apart: np.ndarray) -> Iterator[np.ndarray]:
        """The Voronoi cells with what is replicated into them from beyond their borders.

        Who is nearly as far as can be from all pivots belongs to none, but to a cell of its
        own: whoever is linked with it is far from all pivots, too.
        """
        r, nearest, own = self.rule.radius, apart.min(0), apart.argmin(0)
        for k in range(len(apart)):
            core = apart[k][(own == k) & (nearest < 1 - r)]
            if len(core):
                near = (apart[k] <= nearest + 2 * r) & (apart[k] >= core.min() - r) & (apart[k] <= core.max() + r)
                yield rest[near]
        if (nearest >= 1 - r).any():
            yield rest[nearest >= 1 - 2 * r]


def join_regions(members: DataFrame, rule: Rule, partitions: int) -> DataFrame:
    """Links (a, b) of classes, from members (region, cls, shingles)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _regions(batches):
            rows.sort(key=lambda r: r[0])
            region = Region([np.frombuffer(r[1], U) for r in rows], rule)
            region.join(np.arange(len(rows)))
            a = [rows[i][0] for i, _ in region.links]
            b = [rows[j][0] for _, j in region.links]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return _by_region(members, partitions).mapInArrow(work, "a long, b long")


def measure_pivots(members: DataFrame, rule: Rule) -> DataFrame:
    """One level of the recursion across the cluster, for regions too large for a task.

    members: (region, cls, shingles, ball): ball tells that the member is linked to the
    pivot of the region above. The pivots of a region are its first members outside the
    ball, then others. Returns links (a, b), and for all others than the pivots their
    distances from these (region, cls, apart, linked), as rows of one table.
    """
    order = Window.partitionBy("region").orderBy("ball", "cls")
    # Only the first PIVOTS rows of a region pass a task before they are moved.
    ranked = members.select("region", "cls", "ball").withColumn("k", F.row_number().over(order)).where(
        F.col("k") <= PIVOTS)
    sets = members.select("region", "cls", "shingles")
    pivots = ranked.join(sets, ["region", "cls"]).groupBy("region").agg(
        F.sort_array(F.collect_list(F.struct("k", F.col("cls").alias("cls"), "shingles"))).alias("pivots"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region, numbers, shingles = None, np.zeros(0, np.int64), []
        for batch in batches:
            away, links = [], []
            regions, classes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, cls in enumerate(classes):
                if regions[i] != region:
                    rows = batch.column(3)[i].as_py()
                    region, numbers = regions[i], np.array([r["cls"] for r in rows])
                    shingles = [np.frombuffer(r["shingles"], U) for r in rows]
                own = np.frombuffer(batch.column(2)[i].as_py(), U)
                common = np.array([len(np.intersect1d(own, p, True)) for p in shingles])
                total = np.array([len(own) + len(p) for p in shingles])
                linked = rule.linked(common, total)
                links += [(int(p), cls) for p in numbers[linked] if p != cls]
                if cls not in numbers:  # a pivot has met every member
                    away.append((region, cls, (1 - common / (total - common)).tolist(), linked.tolist()))
            columns = [
                *([row[k] for row in away] + [None] * len(links) for k in range(4)),
                *([None] * len(away) + [link[k] for link in links] for k in range(2))]
            types = [pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.bool_()), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["region", "cls", "apart", "linked", "a", "b"])

    return members.select("region", "cls", "shingles").join(pivots, "region").mapInArrow(
        work, "region long, cls long, apart array<double>, linked array<boolean>, a long, b long")


def cells_below(measured: DataFrame, rule: Rule) -> DataFrame:
    """The members (region, cls, ball) of the regions below, as `Region.cells` has them,
    without those that have no link left to find: regions whose members a pivot has linked
    all, and members too near the pivot to reach one outside its ball."""
    r = rule.radius
    nearest = F.array_min("apart")
    kind = "array<struct<k:int,distance:double,ball:boolean,core:boolean>>"
    own = F.array_position("apart", F.col("nearest")).cast("int") - 1
    cells = F.filter(
        F.transform("apart", lambda d, k: F.struct(
            k.alias("k"), d.alias("distance"), F.get("linked", k).alias("ball"),
            ((k == own) & (F.col("nearest") < 1 - r)).alias("core"))),
        lambda c: (c["distance"] < 1) & (c["distance"] <= F.col("nearest") + 2 * r)).cast(kind)
    remote = F.when(F.col("nearest") >= 1 - 2 * r, F.array(F.struct(
        F.lit(-1).alias("k"), F.col("nearest").alias("distance"), F.lit(False).alias("ball"),
        (F.col("nearest") >= 1 - r).alias("core"))).cast(kind)).otherwise(F.array().cast(kind))
    # Where the pivots do not tell the members apart, all go on as one region.
    whole = F.array(F.struct(
        F.lit(-2).alias("k"), F.get("apart", F.lit(0)).alias("distance"), F.get("linked", F.lit(0)).alias("ball"),
        F.lit(True).alias("core"))).cast(kind)
    placed = measured.withColumn("nearest", nearest).withColumn("cells", F.concat(cells, remote))
    members = placed.groupBy(F.col("region").alias("of")).agg(F.count("*").alias("members"))
    useless = placed.select("region", F.explode("cells.k").alias("k")).groupBy("region", "k").agg(
        F.count("*").alias("n")).groupBy("region").agg(
        F.sum("n").alias("all"), F.max("n").alias("most")).join(members, F.col("region") == F.col("of")).select(
        "of", ((F.col("all") > MOST_IN_ALL * F.col("members"))
               | (F.col("most") > MOST_IN_ONE * F.col("members"))).alias("useless"))
    rows = placed.join(useless, F.col("region") == F.col("of")).select(
        "region", "cls", F.explode(F.when(F.col("useless"), whole).otherwise(F.col("cells"))).alias("cell"),
    ).select(F.xxhash64("region", "cell.k").alias("region"), "cls", "cell.distance", "cell.ball", "cell.core")
    facts = rows.groupBy(F.col("region").alias("of")).agg(
        F.min(F.when(~F.col("ball"), F.col("distance"))).alias("least_outside"),
        F.min(F.when(F.col("core"), F.col("distance"))).alias("first_core"),
        F.max(F.when(F.col("core"), F.col("distance"))).alias("last_core"), F.count("*").alias("members"))
    facts = facts.where("first_core is not null and least_outside is not null and members > 1")
    return rows.join(facts, F.col("region") == F.col("of")).where(
        F.col("distance").between(F.col("first_core") - r, F.col("last_core") + r)
        & (~F.col("ball") | (F.col("distance") >= F.col("least_outside") - r)),
    ).select("region", "cls", "ball")


# --- the whole join -----------------------------------------------------------------

def jaccard_join(docs: DataFrame, width: int = 4, percent: int = 85, doc_id: str = "doc_id",
                 text: str = "text", region_shingles: int = REGION_SHINGLES) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``.

    Words are runs of anything but white space, A-Z in lower case; a document's set holds
    its distinct runs of ``width`` words, or its whole sequence if it has fewer. Null and
    empty texts have no set and are linked with nothing: their component is their own id.
    Two documents are linked if their sets have ``percent`` of their union in common. The
    component is the least doc_id that links reach (null ids count only if there is no
    other). Repeated rows belong together if they have words. Other columns are ignored;
    an empty table gives an empty one. Sets are compared by 64-bit hashes of n-grams.
    ``region_shingles`` bounds what a task joins at once.
    """
    return _joined(docs, width, percent, doc_id, text, region_shingles).select(
        "doc_id", "n_shingles", "component_id")


def _joined(docs: DataFrame, width: int = 4, percent: int = 85, doc_id: str = "doc_id", text: str = "text",
            region_shingles: int = REGION_SHINGLES) -> DataFrame:
    """`jaccard_join` with the sha of the text and the component's class (null without words)."""
    rule = Rule(width, percent)
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = _texts(docs, doc_id, text)
    described = stored(describe(texts, rule), "shingles")
    rows = described.where("n is not null").select("doc_id", "n", "cls", "profile", "sha")
    levels = cell_levels(described)
    classes = stored(rows.where("n > 0").groupBy("cls").agg(
        F.min("doc_id").alias("least"), F.min("n").alias("n"), F.min("profile").alias("profile"),
        F.min("sha").alias("sha")), "classes")
    links = class_links(texts, classes, rows, rule, levels, partitions, region_shingles)
    found = components(links)
    labelled = classes.select("cls", "least").join(found.withColumnRenamed("vertex", "cls"), "cls", "left").select(
        "cls", "least", F.coalesce("component", "cls").alias("component"))
    ids = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = labelled.join(ids, "component").select("cls", "component", "component_id")
    filled = rows.where("n > 0").join(of_class, "cls").select("doc_id", "n", "component_id", "component", "sha")
    empty = rows.where("n = 0").select(
        "doc_id", "n", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("component"), "sha")
    return filled.unionByName(empty).withColumnRenamed("n", "n_shingles")


def _sha(text: str) -> Column:
    return F.unhex(F.sha2(F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8"), 256))


def keep(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options: int) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component does: that with
    the least doc_id (without an id only if there is no other), of texts that share it the
    one of least checksum. Documents without words stay. Of rows that repeat a doc_id and
    its text, one stays. All columns are kept."""
    joined = _joined(docs, doc_id=doc_id, text=text, **options)
    first = joined.where("n_shingles > 0").groupBy("component").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("nameless"), "doc_id", "sha")).alias("first")).select("first.doc_id", "first.sha")
    staying = first.unionByName(joined.where("n_shingles = 0").select("doc_id", "sha").distinct()).select(
        F.col("doc_id").alias("kept_id"), F.col("sha").alias("kept_sha"))
    rows = docs.select(F.struct("*").alias("row"), F.col(doc_id).cast("long").alias("id"), _sha(text).alias("sha"))
    kept = rows.join(
        staying, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("sha") == F.col("kept_sha")), "left_semi")
    return kept.dropDuplicates(["id", "sha"]).select("row.*")


def class_links(texts: DataFrame, classes: DataFrame, rows: DataFrame, rule: Rule, levels: np.ndarray,
                partitions: int, region_shingles: int) -> DataFrame:
    packed = postings(texts, rule, levels, 4 * partitions)
    roots = stored(root_regions(packed, rule, partitions), "regions")
    members = roots.join(classes.select("cls", "n", "profile"), "cls").select("region", "cls", "n", "profile")
    weights = stored(members.groupBy("region").agg(
        F.sum("n").alias("weight"), F.count("*").alias("members")), "region-sizes")
    fits = (F.col("weight") <= region_shingles) & (F.col("members") <= REGION_MEMBERS)
    small = with_possible_partner(
        members.join(weights.where(fits).select("region"), "region", "left_semi"), rule, partitions)
    chosen = stored(small, "members").withColumn("fits", F.lit(True))
    large = weights.where(~fits)
    if not large.isEmpty():
        groups = stored(groups_of_large(
            members.join(large.select("region"), "region", "left_semi"), rule, partitions), "groups")
        weights = stored(groups.join(classes.select("cls", "n"), "cls").groupBy("region").agg(
            F.sum("n").alias("weight"), F.count("*").alias("members")), "group-sizes")
        chosen = chosen.unionByName(groups.join(weights.select("region", fits.alias("fits")), "region"))
    sets = stored(_sets(texts, chosen, classes, rule), "sets")
    held = chosen.join(sets, "cls")
    links = stored(join_regions(held.where("fits").select("region", "cls", "shingles"), rule, partitions), "links")
    rest = stored(chosen.where("not fits").select("region", "cls", F.lit(False).alias("ball")), "large")
    while not rest.isEmpty():
        level = stored(measure_pivots(rest.join(sets, "cls"), rule), "level")
        links = links.unionByName(level.where("a is not null").select("a", "b"))
        below = stored(cells_below(level.where("region is not null"), rule), "below")
        weights = stored(below.join(sets.select("cls", "n"), "cls").groupBy("region").agg(
            F.sum("n").alias("weight"), F.count("*").alias("members")), "below-sizes")
        small = below.join(weights.where(fits).select("region"), "region", "left_semi").join(sets, "cls")
        links = links.unionByName(stored(
            join_regions(small.select("region", "cls", "shingles"), rule, partitions), "links"))
        rest = below.join(weights.where(~fits).select("region"), "region", "left_semi")
    return links


def _sets(texts: DataFrame, chosen: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """(cls, shingles, n) of the chosen classes, from one document of each."""
    wanted = chosen.select("cls").distinct().join(classes.select("cls", "least", "sha"), "cls").select(
        "cls", F.col("least").alias("doc_id"), "sha")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, raw in _pieces(batches):
            sets = shingle_sets(raw, rule.width)
            yield pa.RecordBatch.from_arrays([
                pa.array([class_of(s) for s in sets], pa.int64()),
                pa.array([s.tobytes() for s in sets], pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()),
            ], names=["cls", "shingles", "n"])

    some = texts.where("doc_id is not null").join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    # Classes whose rows are all without an id are found by one of their texts.
    nameless = texts.where("doc_id is null").withColumn("sha", F.unhex(F.sha2("text", 256))).join(
        wanted.where("doc_id is null").select("sha"), "sha", "left_semi").dropDuplicates(["sha"])
    made = some.unionByName(nameless.select("doc_id", "text")).mapInArrow(work, "cls long, shingles binary, n long")
    return made.join(wanted.select("cls"), "cls", "left_semi").dropDuplicates(["cls"])
