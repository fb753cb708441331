"""BPE encoding and decoding by batched numpy merge rounds.

The vocabulary file is read once on the driver; its path is a parameter and its
content (a fixed size) goes to the tasks with the function. A task cuts texts into
words, and the words it has not met are merged together: the symbols of all of them
lie in one flat array, a round finds the rank of every neighbouring pair by binary
search over the sorted pair keys, and merges each word's lowest-ranked pair. Words
met before come from a table of bounded size.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Texts of ASCII and Latin letters alone, and the words of the vocabulary's pattern in
#: them, spelled out: much faster than properties of all of Unicode.
UNUSUAL = re.compile(r"[^\x00-\x7F\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]")
USUAL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
USUAL_WORD = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+|[0-9]"
    r"|[^ \t-\rA-Za-z0-9\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+")
NEVER = np.iinfo(np.int64).max
KNOWN_WORDS = 400_000  # words a task remembers before it starts afresh
KNOWN_LENGTH = 64  # longer words are not remembered
BATCH_SYMBOLS = 2_000_000  # symbols merged at once; a longer word is a batch of its own


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in vocabularies of bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


@dataclass
class Vocabulary:
    """Token strings by id, and merges as sorted pair keys with ranks and results."""

    tokens: list[str]
    middle: np.ndarray  # id of a byte inside a word
    last: np.ndarray  # id of a byte that ends a word
    keys: np.ndarray
    ranks: np.ndarray
    results: np.ndarray
    all_at_once: np.ndarray  # by rank: may all such pairs of a word merge in one round?
    word: str
    specials: dict[str, int]

    @property
    def size(self) -> int:
        return len(self.tokens)


def load_vocabulary(path: str) -> Vocabulary:
    """Reads a vocabulary of byte-level BPE with an end-of-word mark.

    Files that ask for another normalisation or another kind of model are refused.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
    if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"]:
        raise ValueError(f"{path}: not a lower-casing BPE vocabulary without a decoder")
    end = model["end_of_word_suffix"]
    ids = dict(model["vocab"])
    ids.update((t["content"], t["id"]) for t in spec["added_tokens"])
    tokens = [""] * (max(ids.values()) + 1)
    for token, i in ids.items():
        tokens[i] = token
    symbols = byte_symbols()
    pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
    left = np.array([ids[a] for a, _ in pairs], np.int64)
    right = np.array([ids[b] for _, b in pairs], np.int64)
    result = np.array([ids[a + b] for a, b in pairs], np.int64)
    # A merge can be done everywhere in a word at once unless a pair with its result
    # ranks before it: then the first place has to be merged and looked at anew.
    used = np.full(len(tokens), NEVER)
    rank = np.arange(len(pairs))
    np.minimum.at(used, left, rank)
    np.minimum.at(used, right, rank)
    key = left * len(tokens) + right
    order = np.argsort(key)
    split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    return Vocabulary(
        tokens, np.array([ids[s] for s in symbols]), np.array([ids[s + end] for s in symbols]),
        key[order], order, result[order], used[result] > rank, split,
        {t["content"]: t["id"] for t in spec["added_tokens"]},
    )


def merge(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words end to end, and where each word begins (with the end)."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(words), np.uint8)
    symbol = vocabulary.middle[data]
    symbol[ends - 1] = vocabulary.last[data[ends - 1]]
    word = np.repeat(np.arange(len(words)), sizes)
    done_symbols, done_words = [], []
    while len(symbol):
        pair = symbol[:-1] * vocabulary.size + symbol[1:]
        at = np.searchsorted(vocabulary.keys, pair)
        at[at == len(vocabulary.keys)] = 0
        found = (vocabulary.keys[at] == pair) & (word[:-1] == word[1:])
        rank = np.append(np.where(found, vocabulary.ranks[at], NEVER), NEVER)
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        length = np.diff(np.append(first, len(word)))
        lowest = np.minimum.reduceat(rank, first)
        lowest_here = np.repeat(lowest, length)
        finished = lowest_here == NEVER
        if finished.any():
            done_symbols.append(symbol[finished])
            done_words.append(word[finished])
            go_on = ~finished
            symbol, word, rank, at = symbol[go_on], word[go_on], rank[go_on], np.append(at, 0)[go_on]
            lowest_here = lowest_here[go_on]
            if not len(symbol):
                break
        hit = np.flatnonzero(rank == lowest_here)
        # Of pairs that overlap (a a a) the 1st, 3rd, 5th of a run are merged.
        starts = np.append(True, np.diff(hit) != 1)
        run_start = np.repeat(np.flatnonzero(starts), np.diff(np.append(np.flatnonzero(starts), len(hit))))
        hit = hit[(np.arange(len(hit)) - run_start) % 2 == 0]
        one_only = ~vocabulary.all_at_once[rank[hit]]
        if one_only.any():
            later = np.append(False, word[hit][1:] == word[hit][:-1])
            hit = hit[~(one_only & later)]
        symbol[hit] = vocabulary.results[at[hit]]
        keep = np.ones(len(symbol), bool)
        keep[hit + 1] = False
        symbol, word = symbol[keep], word[keep]
    if not done_symbols:
        return np.zeros(0, np.int64), np.zeros(len(words) + 1, np.int64)
    symbols, owners = np.concatenate(done_symbols), np.concatenate(done_words)
    order = np.argsort(owners, kind="stable")
    return symbols[order], np.append(0, np.cumsum(np.bincount(owners, minlength=len(words))))


class Encoder:
    """Encodes texts in one task; remembers a bounded number of words."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.find = regex.compile(vocabulary.word).findall
        self.usual = vocabulary.word == USUAL_PATTERN
        names = sorted(vocabulary.specials, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")")
        self.known: dict[str, tuple[bytes, str]] = {}

    def words(self, text: str) -> list[str]:
        """The words of a text, normalised; special tokens stand for themselves."""
        if "<|" not in text:
            return self.cut(self.normal(text))
        found: list[str] = []
        for k, piece in enumerate(self.special.split(text)):
            found += ["\0" + piece] if k % 2 else self.cut(self.normal(piece))
        return found

    def cut(self, text: str) -> list[str]:
        if self.usual and not UNUSUAL.search(text):
            return USUAL_WORD.findall(text)
        return self.find(text)

    @staticmethod
    def normal(text: str) -> str:
        """Composed and in lower case, letter by letter: no final sigma."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def learn(self, new: list[str]) -> dict[str, tuple[bytes, str]]:
        """Ids (little-endian, 32 bits) and token text of words not met before."""
        learnt: dict[str, tuple[bytes, str]] = {}
        tokens = self.vocabulary.tokens
        for name in [w for w in new if w[0] == "\0" and w[1:] in self.vocabulary.specials]:
            i = self.vocabulary.specials[name[1:]]
            learnt[name] = (np.array([i], "<u4").tobytes(), tokens[i])
        plain = [w for w in new if w not in learnt]
        start = 0
        while start < len(plain):
            stop, symbols, raw = start, 0, []
            while stop < len(plain) and (symbols < BATCH_SYMBOLS):
                raw.append(plain[stop].encode())
                symbols += len(raw[-1])
                stop += 1
            ids, places = merge(raw, self.vocabulary)
            flat = ids.astype("<u4").tobytes()
            names = [tokens[i] for i in ids.tolist()]
            ends = places.tolist()
            for word, a, b in zip(plain[start:stop], ends[:-1], ends[1:], strict=True):
                learnt[word] = (flat[4 * a:4 * b], " ".join(names[a:b]))
            start = stop
        return learnt

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """For every text the ids, little-endian with 32 bits each, and their decoding."""
        cut = [self.words(t) for t in texts]
        if len(self.known) > KNOWN_WORDS:
            self.known = {}
        known = self.known
        new = {w for words in cut for w in set(words) if w not in known}
        learnt = self.learn(list(new))
        known.update(learnt)
        find = known.__getitem__
        for words in cut:
            ids, names = zip(*map(find, words), strict=True) if words else ((), ())
            yield b"".join(ids), " ".join(names)
        for word in learnt:
            if len(word) > KNOWN_LENGTH:
                del known[word]


def encode(docs: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text",
           group_chars: int = 2_000_000) -> DataFrame:
    """doc_id, ids (binary: token ids, little-endian, 32 bits each), decoded.

    Whole texts are encoded as the vocabulary file says, without adding tokens;
    the strings of special tokens in a text become those tokens. A null or empty
    text gives no ids and the empty string. Rows keep their number and ids: repeated
    and null doc_ids are no concern here, other columns are ignored. ``group_chars``
    bounds how many characters a task works on at once (a longer text goes alone).
    """
    vocabulary = load_vocabulary(vocabulary_path)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            sizes = batch.column(1).to_pylist()
            start = 0
            while start < batch.num_rows:
                stop, chars = start, 0
                while stop < batch.num_rows and (stop == start or chars + sizes[stop] <= group_chars):
                    chars += sizes[stop]
                    stop += 1
                part = batch.slice(start, stop - start)
                found = list(encoder.encode(part.column(2).to_pylist()))
                yield pa.RecordBatch.from_arrays([
                    part.column(0).cast(pa.int64()), pa.array([f[0] for f in found], pa.binary()),
                    pa.array([f[1] for f in found], pa.string()),
                ], schema=schema)
                start = stop

    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.length(whole).alias("size"), whole.alias("text"),
    ).mapInArrow(work, "doc_id long, ids binary, decoded string")


def decode(encoded: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id, decoded: the token strings of ids as `encode` writes them, a blank between
    two. Null ids give the empty string; an id that the vocabulary lacks is left out."""
    tokens = load_vocabulary(vocabulary_path).tokens

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                " ".join([tokens[i] for i in np.frombuffer(raw or b"", "<u4")
                          if i < len(tokens) and tokens[i]])
                for raw in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "decoded"])

    return encoded.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(
        work, "doc_id long, decoded string")
