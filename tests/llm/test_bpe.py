import json
import random
import unicodedata

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tillflow.llm import bpe as op
from tokenizers import Tokenizer, models

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def encoder():
    return op.Encoder(op.load_vocabulary(PATH))


def expected(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)


def test_all_documents(documents, document_rows, library):
    found = {r.doc_id: (bytes(r.ids), r.decoded) for r in op.encode(documents, PATH).collect()}
    assert found == {i: expected(library, t or "") for i, t in document_rows}


@pytest.mark.parametrize("text", [
    "", " \n", "<|endoftext|>x<|startoftext|> <|endo <|endoftext|>", "it's I'LL we'Ve 'D x'S", "!" * 3001,
    "ab" * 3000, "ΟΔΟΣ İstanbul ß ﬁ é", "\U0001f600\U0001f600 １２",
    "a\x1cb\x85c d", "aaaa aaaaa aaaaaaaaaaa",
])
def test_odd_texts(encoder, library, text):
    assert list(encoder.encode([text])) == [expected(library, text)]


#: Characters both sides' tables of letters know: the library's are some versions older.
KNOWN = st.characters(exclude_categories=["Cs", "Cn", "Co"], max_codepoint=0x2FFF).filter(
    lambda c: unicodedata.ucd_3_2_0.category(c) != "Cn")


@settings(max_examples=200, deadline=None)
@given(text=st.text(KNOWN, max_size=60))
def test_any_text(encoder, library, text):
    assert list(encoder.encode([text])) == [expected(library, text)]


def test_random_words_merge_like_the_library(encoder, library):
    rnd = random.Random(3)
    for letters in ("aeinrt th", "!#$.,", "lo l"):
        texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 90))) for _ in range(150)]
        assert list(encoder.encode(texts)) == [expected(library, t) for t in texts]


@pytest.mark.parametrize("seed", range(12))
def test_any_merges_like_the_library(tmp_path, seed):
    """Small random vocabularies: some make a token in two ways, so that a pair with the
    result may rank before the merge, and merges must not be done everywhere at once."""
    rnd = random.Random(seed)
    symbols = op.byte_symbols()
    known, merges = ["a", "b", "c"], []
    while len(merges) < 40:
        pair = [rnd.choice(known), rnd.choice(known)]
        if pair not in merges and len("".join(pair)) < 7:
            merges.append(pair)
            known.append("".join(pair))
    names = list(dict.fromkeys([*symbols, *[s + "</w>" for s in symbols], *known]))
    vocab = {n: i for i, n in enumerate(names)}
    spec = {
        "added_tokens": [], "decoder": None,
        "normalizer": {"normalizers": [{"type": k} for k in ("NFC", "Replace", "Lowercase")]},
        "pre_tokenizer": {"pretokenizers": [{"pattern": {"Regex": op.USUAL_PATTERN}}]},
        "model": {"type": "BPE", "end_of_word_suffix": "</w>", "merges": merges, "vocab": vocab},
    }
    path = tmp_path / "small.json"
    path.write_text(json.dumps(spec))
    library = models.BPE(vocab=vocab, merges=[tuple(m) for m in merges], end_of_word_suffix="</w>")
    words = ["".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 30))) for _ in range(100)]
    ids, places = op.merge([w.encode() for w in words], op.load_vocabulary(str(path)))
    for k, word in enumerate(words):
        assert ids[places[k]:places[k + 1]].tolist() == [t.id for t in library.tokenize(word)]


def test_decoding_returns_the_library_text(documents, library):
    encoded = op.encode(documents.limit(20), PATH).cache()
    decoded = {r.doc_id: r.decoded for r in op.decode(encoded, PATH).collect()}
    assert decoded == {r.doc_id: r.decoded for r in encoded.collect()}


def test_odd_rows(odd_docs, clash, library):
    found = sorted(((r.doc_id, bytes(r.ids)) for r in op.encode(clash(odd_docs), PATH).collect()), key=str)
    wanted = sorted(((r.doc_id, expected(library, r.text or "")[0]) for r in odd_docs.collect()), key=str)
    assert found == wanted
    assert op.encode(odd_docs.limit(0), PATH).collect() == []
