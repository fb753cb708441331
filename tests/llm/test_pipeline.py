"""The pipeline against its stages done by other means, on a small table."""

from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from .test_jaccard_join import brute as components
from .test_quality_rules import brute as rules

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, documents):
    """The rows after each stage."""
    found, docs = [], documents
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER).cache()
        found.append(docs.collect())
    return found


def test_stages_and_their_columns(steps, documents):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "exact dedup", "jaccard join", "mixing", "bpe"]
    for rows in steps[:-1]:
        assert rows and rows[0].asDict().keys() == set(documents.columns)


def test_rejected_documents_go_and_clean_ones_stay(steps, documents):
    kept = {r.doc_id for r in steps[0]}
    for r in documents.collect():
        if rules(r.text)[-1]:
            assert r.doc_id not in kept
    assert len(kept) > 0.8 * sum(not rules(r.text)[-1] for r in documents.collect())


def test_one_of_equal_texts_stays(steps):
    last = {}
    for r in steps[0]:
        last[r.text] = max(r.doc_id, last.get(r.text, -1))
    assert sorted(r.doc_id for r in steps[1]) == sorted(last.values())


def test_one_of_near_copies_stays(steps):
    rows = [(r.doc_id, r.text) for r in steps[1]]
    assert sorted(r.doc_id for r in steps[2]) == sorted({c for _, _, c in components(rows, 5, 80)})


def test_mix_takes_no_document_more_than_twice(steps):
    taken = Counter(r.doc_id for r in steps[3])
    assert set(taken) <= {r.doc_id for r in steps[2]} and set(taken.values()) <= {1, 2}


def test_ids_are_those_of_the_library(steps):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in steps[3]}
    assert Counter(r.doc_id for r in steps[4]) == Counter(r.doc_id for r in steps[3])
    for r in steps[4]:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert bytes(r.ids) == np.array(ids, "<u4").tobytes() and r.n_tokens == len(ids)


def test_run_is_the_stages_in_a_row(spark, steps):
    found = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted((r.doc_id, bytes(r.ids)) for r in found) == sorted((r.doc_id, bytes(r.ids)) for r in steps[-1])


def test_odd_documents(spark, odd_docs):
    docs = odd_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.collect() is not None
    empty = odd_docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, FOLDER)
    assert empty.collect() == []
