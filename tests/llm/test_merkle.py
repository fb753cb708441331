import hashlib
import zlib
from collections import defaultdict

from pyspark.sql import functions as F
from tillflow.llm import merkle as op
from tillflow.llm.queries import op12_merkle

FOLDER = "/root/testdata/sf0.001"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*["-" if row[k] is None else f"{len(str(row[k]).encode())}:{row[k]}" for k in op.FIELDS])


def levels_over(nodes):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [digest(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
        levels.append(nodes)
    return levels


def proof(levels, place):
    found = []
    for level in levels[:-1]:
        first = place // 3 * 3
        found.append((level[first:place], level[place + 1:first + 3]))
        place //= 3
    return found


def tampered(row):
    lost = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0
    return {**row, "text": row["text"].replace("\n", "")} if lost and row["text"] is not None else row


def brute(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row["source"]].append(row)
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for source in sources:
        groups[source].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = {s: levels_over([leaf(r) for r in groups[s]]) for s in sources}
    top = levels_over([trees[s][-1][0] for s in sources])
    found = []
    for k, source in enumerate(sources):
        for place, row in enumerate(groups[source]):
            path = proof(trees[source], place) + proof(top, k)
            fold = leaf(tampered(row))
            for left, right in path:
                fold = digest(*left, fold, *right)
            found.append((row["doc_id"], leaf(row), trees[source][-1][0], top[-1][0],
                          digest(*[h for left, right in path for h in left + right]), fold, fold == top[-1][0]))
    return sorted(found, key=str)


def answers(docs):
    lost = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    seen = F.when(lost, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = op.manifest(docs, seen).select(
        "doc_id", "leaf", "subroot", "root", op.digest(op.siblings(F.col("path"))),
        op.folded(F.col("seen_leaf"), F.col("path")).alias("fold")).withColumn("ok", F.col("fold") == F.col("root"))
    return sorted((tuple(r) for r in rows.collect()), key=str)


def as_rows(docs):
    return [r.asDict() for r in docs.select(*op.FIELDS).collect()]


def test_query_equals_brute_force(spark, documents):
    found = op12_merkle(spark, FOLDER).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    wanted = brute(as_rows(documents))
    assert sorted((tuple(r) for r in found), key=str) == wanted
    assert {row[-1] for row in wanted} == {True, False}


def test_trees_of_all_sizes(make_docs):
    """Whole and broken runs, lone leaves, blocks (243) and blocks of blocks, in several pieces."""
    sizes = (1, 2, 3, 4, 9, 10, 27, 28, 243, 244, 730)
    rows = [(i * 7 % 5003, f"t{i}\n", f"s{size:03d}") for k, size in enumerate(sizes)
            for i in range(k * 1000, k * 1000 + size)]
    docs = make_docs(rows).repartition(7)
    assert answers(docs) == brute(as_rows(docs))


def test_many_sources(make_docs):
    rows = [(i, f"t\n{i}", f"host{i % 500}") for i in range(800)]
    docs = make_docs(rows)
    assert answers(docs) == brute(as_rows(docs))


def test_odd_rows(odd_docs, clash, make_docs):
    assert answers(clash(odd_docs)) == brute(as_rows(odd_docs))
    assert answers(odd_docs.limit(0)) == []
    one = make_docs([(5, "lone")])
    assert answers(one) == brute(as_rows(one))
    assert answers(one)[0][1] == answers(one)[0][3]  # a lone leaf is the root


def test_null_and_repeated_keys(make_docs):
    rows = [(None, f"x{i}", None) for i in range(30)] + [(3, "same\n", "é")] * 20 + [(3, f"{i}", "z") for i in range(9)]
    docs = make_docs(rows).repartition(4)
    assert answers(docs) == brute(as_rows(docs))


def test_ranks_go_on_over_ranges(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise((F.col("id") % 7).cast("string")).alias("g"),
        (F.col("id") * 7919 % 5000).alias("v"))
    found = op.ranked(rows, "g", ["v"], 9).collect()
    groups = defaultdict(list)
    for r in found:
        groups[r.g].append((r["rank"], r.v))
    for pairs in groups.values():
        pairs.sort()
        assert [r for r, _ in pairs] == list(range(len(pairs)))
        assert [v for _, v in pairs] == sorted(v for _, v in pairs)
