import re
from collections import defaultdict

import pytest
from tillflow.llm import mixing as op

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def level(sizes):
    """Targets by repeated resharing of what the stopped sources leave."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, stopped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in stopped]
        if not free:
            return stopped
        share = left / sum(weight[s] for s in free)
        over = [s for s in free if share * weight[s] >= 2 * sizes[s]]
        if not over:
            return stopped | {s: share * weight[s] for s in free}
        for s in over:
            stopped[s] = 2.0 * sizes[s]
            left -= stopped[s]


def check(rows, docs, slack):
    sizes = defaultdict(int)
    for r in docs.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    wanted = level(sizes)
    taken = defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(wanted[r.source], rel=1e-9, abs=1e-6)
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    longest = max((r.size for r in rows), default=0)
    for s, t in wanted.items():
        assert abs(taken[s] - t) <= slack * t + 2 * longest


def test_targets_and_takes(documents):
    rows = op.taken(documents).collect()
    assert len(rows) == documents.count()
    check(rows, documents, 0.1)


def test_same_in_any_partitioning(documents):
    one = sorted(map(tuple, op.taken(documents.repartition(1)).collect()), key=str)
    many = sorted(map(tuple, op.taken(documents.repartition(7)).collect()), key=str)
    assert one == many


def test_mix_emits_the_copies(documents):
    taken = {r.doc_id: r.copies for r in op.taken(documents).collect()}
    emitted = defaultdict(int)
    mix = op.mix(documents)
    assert mix.columns == documents.columns
    for r in mix.collect():
        emitted[r.doc_id] += 1
    assert dict(emitted) == {i: c for i, c in taken.items() if c}


def test_odd_rows_and_null_source(make_docs, clash):
    docs = make_docs([(1, None, "a"), (2, "", "b"), (3, "x y", None), (3, "x y", None), (None, "q r s", "a"),
                      (4, "w " * 5000, "c"), (5, "z", "c")])
    rows = op.taken(clash(docs)).collect()
    assert len(rows) == 7
    check(rows, docs, 1.0)


def test_one_source_and_none(make_docs):
    rows = op.taken(make_docs([(i, "a b c", "only") for i in range(40)])).collect()
    assert sum(r.taken for r in rows) == 180
    assert op.taken(make_docs([])).collect() == []
