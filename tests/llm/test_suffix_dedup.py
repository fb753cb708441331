import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tillflow.llm import suffix_dedup as op


def brute(rows, least=50):
    """Every window's least document, from the definition."""
    raw = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in raw:
        for p in range(len(b) - least + 1):
            w = b[p:p + least]
            if i is not None and (w not in first or i < first[w]):
                first[w] = i
    found = []
    for i, b in raw:
        covered = bytearray(len(b))
        for p in range(len(b) - least + 1):
            if i is not None and first[b[p:p + least]] < i:
                covered[p:p + least] = b"\1" * least
        spans = sum(c and not (k and covered[k - 1]) for k, c in enumerate(covered))
        found.append((i, len(b), bytes(x for x, c in zip(b, covered) if not c), spans))
    return sorted(found, key=str)


def answers(df):
    return sorted(((r.doc_id, r.n_bytes, bytes(r.kept), len(r.removed)) for r in df.collect()), key=str)


def texts_with_repeats(seed, n=40):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abé") for _ in range(rnd.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rnd.randint(8, 60))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [rnd.choice(passages)[rnd.randint(0, 20):] if rnd.random() < 0.5 else
                 " ".join(word() for _ in range(rnd.randint(0, 30))) for _ in range(rnd.randint(0, 5))]
        rows.append((i, " ".join(parts)))
    return rows


@pytest.mark.parametrize("block_bytes", [500, 2_000_000])
def test_passages_with_shared_and_different_surroundings(make_docs, monkeypatch, block_bytes):
    monkeypatch.setattr(op, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(op, "CHUNK", 700)
    rows = texts_with_repeats(block_bytes)
    random.Random(1).shuffle(rows)
    assert answers(op.suffix_dedup(make_docs(rows))) == brute(rows)


def test_given_documents(documents, document_rows):
    assert answers(op.suffix_dedup(documents)) == brute(document_rows)


def test_odd_rows(make_docs, clash):
    long = "abcdefghij" * 6
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, long), (4, long + "x"), (5, "é" * 40), (6, "é" * 25),
            (7, "z" * 20_000), (8, "z" * 49), (9, "z" * 50), (10, "q" * 300)]
    assert answers(op.suffix_dedup(clash(make_docs(rows)))) == brute(rows)
    assert op.suffix_dedup(make_docs([])).collect() == []


def naive_repeats(pieces, least):
    """Maximal repeats by looking at every substring."""
    places = defaultdict(set)
    for k, p in enumerate(pieces):
        for b in range(len(p)):
            for e in range(b + least, len(p) + 1):
                places[bytes(p[b:e])].add((k, b))
    found = {}
    for text, where in places.items():
        if len(where) < 2:
            continue
        n = len(text)
        left = {bytes(pieces[k][b - 1:b]) if b else (k, b) for k, b in where}
        right = {bytes(pieces[k][b + n:b + n + 1]) if b + n < len(pieces[k]) else (k, b) for k, b in where}
        if len(left) > 1 and len(right) > 1:
            found[text] = where
    return found


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=14), min_size=1, max_size=6))
def test_maximal_repeats_have_all_occurrences(texts):
    pieces = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    found = {}
    for length, owner, place in op.maximal_repeats(pieces, 2):
        k, b = int(owner[0]), int(place[0])
        found[bytes(pieces[k][b:b + length])] = set(zip(owner.tolist(), place.tolist()))
    assert found == naive_repeats(pieces, 2)
