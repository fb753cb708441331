import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tillflow.llm import grammar
from tillflow.llm import token_files as op
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return found


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


def brute(library, rows):
    """Per document in order: doc_id, start, n_tokens, ids_crc32; of equal ids in any order."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = ids_of(library, text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def answers(spark, docs, **options):
    folder = op.write(docs, PATH, **options)
    return [tuple(r) for r in op.digests(spark, folder).orderBy("start").collect()], folder


def test_all_documents(spark, documents, document_rows, library):
    found, folder = answers(spark, documents.repartition(5), shard_tokens=3000)
    assert found == brute(library, sorted(document_rows))
    shards = spark.read.parquet(folder)
    assert shards.count() > 20 and shards.select("part").distinct().count() > 1
    stored = {r.doc_id: (r.start, r.ids) for r in op.read(spark, folder).collect()}
    for (doc_id, start, n, crc) in found:
        assert stored[doc_id][0] == start and len(stored[doc_id][1]) == 4 * n and zlib.crc32(stored[doc_id][1]) == crc


TEXTS = [
    "It's 'tis don't we'll I've they're 'S a'sb \"'s x''s 12'll3", "a\x1cb\x1dc d\x1fe\x0bf\x0cg", "a b c　d\x85e",
    "café ́x e ́ Å ẛ̣", "x<|endoftext|>y <|endoftext|> <|startoftext|>'s <|END", "\U0001f600‍\U0001f600 你好世界",
    "Σας ΑΣ İstanbul ßẞ", "a1b2c3 1,000.50 #$%^&*() --- __x__ \x00 \x7f", " \n\t ", "no​break soft­hyphen",
]


def test_unusual_texts(spark, make_docs, library):
    found, _ = answers(spark, make_docs(TEXTS))
    assert found == brute(library, list(enumerate(TEXTS)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("abzAZ'sStTlLvVeErRmMdD 019.,<|>\n\t\x1cé́ "), max_size=30), max_size=5))
def test_encoder_equals_the_library(library, texts):
    ids, sizes = _encoder().encode(pa.array(texts, pa.string()))
    wanted = [ids_of(library, t)[:-1] for t in texts]
    assert sizes.tolist() == list(map(len, wanted)) and ids.tolist() == [i for t in wanted for i in t]


def test_what_is_remembered_is_bounded(library, monkeypatch):
    monkeypatch.setattr(op, "KNOWN", 50)
    encoder = _encoder()
    for k in range(20):
        texts = [f"word{k}x{j} Éa{j}, it's" for j in range(30)]
        ids, _ = encoder.encode(pa.array(texts))
        assert ids.tolist() == [i for t in texts for i in ids_of(library, t)[:-1]]
        assert len(encoder.words) <= 50 + 90 and len(encoder.pieces) <= 50 + 90


_ENCODERS = []


def _encoder():
    if not _ENCODERS:
        with open(PATH, encoding="utf-8") as file:
            _ENCODERS.append(op.Encoder(file.read()))
        assert _ENCODERS[0].plain
    return _ENCODERS[0]


def test_odd_rows(spark, odd_docs, clash, library):
    found, _ = answers(spark, clash(odd_docs), shard_tokens=10)
    wanted = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert sorted(r[2] for r in found) == sorted(len(ids_of(library, t)) for _, t in wanted)
    assert sorted((r[0], r[2], r[3]) for r in found if r[0] is not None) == sorted(
        (i, len(ids_of(library, t)), zlib.crc32(np.array(ids_of(library, t), "<u4").tobytes()))
        for i, t in wanted if i is not None)
    assert found[0][0] is None and found[0][1] == 0
    assert [a[1] + a[2] for a in found[:-1]] == [b[1] for b in found[1:]]
    assert answers(spark, odd_docs.limit(0))[0] == []


def test_many_rows_of_one_id_are_dealt_out(spark, make_docs):
    rows = [(None, f"text number {i}") for i in range(300)] + [(7, "the same")] * 300 + [(8, "x")] * 300
    folder = op.write(make_docs(rows), PATH)
    found = op.digests(spark, folder)
    assert found.count() == 900
    counts = [r["n"] for r in spark.read.parquet(folder).groupBy("part").agg(
        F.sum(F.size("doc_ids")).alias("n")).collect()]
    assert max(counts) < 600


def test_a_document_longer_than_a_shard_is_one(spark, make_docs, library):
    rows = [(1, "a b"), (2, "word " * 500), (3, "c")]
    found, folder = answers(spark, make_docs(rows).coalesce(1), shard_tokens=100)
    assert found == brute(library, rows)
    assert [r.n_tokens for r in spark.read.parquet(folder).orderBy("shard").collect()] == [3, 501, 2]


# --- the grammar ---------------------------------------------------------------

@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), max_size=60), max_size=6), st.integers(2, 6))
def test_round_trip(documents, least):
    ids = np.array([i for d in documents for i in d], np.int64)
    sizes = np.array([len(d) for d in documents], np.int64)
    shard = grammar.unpack(grammar.pack(ids, sizes, 5, least, 0.0))
    assert shard.tokens().tolist() == ids.tolist()
    assert shard.sizes.tolist() == sizes.tolist()
    for k, document in enumerate(documents):
        assert shard.document(k).tolist() == document


def test_repeats_are_compressed_and_found_again():
    chance = random.Random(3)
    phrases = [[chance.randrange(1000) for _ in range(12)] for _ in range(5)]
    ids = np.array([i for _ in range(400) for i in chance.choice(phrases)])
    shard = grammar.unpack(grammar.pack(ids, np.array([len(ids)]), 1000, 8, 0.0))
    assert len(shard.symbols) < len(ids) / 8
    assert (shard.left < shard.first + np.arange(len(shard.left))).all()
    assert shard.tokens().tolist() == ids.tolist()
    for start, stop in ((0, 1), (7, 7), (100, 461), (4799, 4800)):
        assert shard.range(start, stop).tolist() == ids[start:stop].tolist()
    assert [len(shard.expand(np.array([shard.first + k]))) for k in range(len(shard.lengths))] == shard.lengths.tolist()


def test_runs_of_one_symbol():
    ids = np.zeros(1001, np.int64)
    shard = grammar.unpack(grammar.pack(ids, np.array([1001]), 3, 4, 0.0))
    assert shard.tokens().tolist() == ids.tolist() and len(shard.symbols) < 40


def test_damaged_shards_are_refused():
    data = grammar.pack(np.arange(5), np.array([5]), 9)
    for bad in (b"", b"RPG2" + data[4:], data[:-1]):
        with pytest.raises(ValueError):
            grammar.unpack(bad)
    with pytest.raises(ValueError):
        grammar.pack(np.array([9]), np.array([1]), 9)
