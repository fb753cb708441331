import hashlib
from collections import defaultdict

from pyspark.sql import functions as F
from tillflow.llm import exact_dedup as op

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    found = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        found += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(found, key=str)


def answers(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_all_documents(documents, document_rows):
    assert answers(op.exact_dedup(documents)) == brute(document_rows)


def test_odd_rows_and_clashing_names(odd_docs, clash):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert answers(op.exact_dedup(clash(odd_docs))) == brute(rows)


def test_colliding_keys_are_chained_and_compared(make_docs):
    rows = [(i, f"text {i % 23}") for i in range(200)]
    weak = lambda sha: F.lit(5).cast("long")
    found = op.exact_dedup(make_docs(rows), key=weak, capacity=4)
    assert answers(found) == brute(rows)


def test_buckets_split_until_none_is_overfull(spark, make_docs):
    rows = [(i, f"text {i}") for i in range(500)]
    index = op.build_index(make_docs(rows), capacity=8)
    cells = index.directory.collect()
    keys = [r.key for r in index.entries.select("key").collect()]
    assert len(keys) == 500
    for cell in cells:
        inside = [k for k in keys if k >> (op.KEY_BITS - cell.depth) == cell.prefix]
        assert len(inside) <= 8
    covered = sum(len([k for k in keys if k >> (op.KEY_BITS - c.depth) == c.prefix]) for c in cells)
    assert covered == 500


def test_few_bytes_held_give_the_same(documents, document_rows):
    assert answers(op.exact_dedup(documents, held_bytes=1000)) == brute(document_rows)


def test_keep_returns_one_row_of_each_text(odd_docs):
    kept = op.keep(odd_docs)
    assert kept.columns == odd_docs.columns
    texts = sorted((r.text or "") for r in kept.collect())
    assert texts == sorted({(r.text or "") for r in odd_docs.collect()})


def test_empty(make_docs):
    assert op.exact_dedup(make_docs([])).collect() == []
