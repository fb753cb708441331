"""Re-Pair grammars of token ids: frequent pairs become nonterminals, shard by shard.

A shard is one binary value, little-endian throughout:

    magic "RPG1", then 32 bits each: first nonterminal, rules, symbols, documents;
    rules' left symbols, rules' right symbols, rules' expansion lengths (32 bits each);
    tokens of each document (64 bits each);
    the symbols' low bytes, middle bytes and high bytes (3 x 8 bits each).

Symbols below the first nonterminal are token ids; nonterminal k stands for its rule's two
symbols, which are always smaller than it. Expansion lengths lead to any token without
expanding what lies before it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

MAGIC = b"RPG1"
HEADER = 4 + 4 * 4
MOST_SYMBOLS = 2**24  # symbols are stored in three bytes
NO_PAIR = np.iinfo(np.int32).max


@dataclass
class Shard:
    """What a shard's bytes hold."""

    first: int  # the first nonterminal
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray  # tokens that each rule stands for
    sizes: np.ndarray  # tokens of each document
    symbols: np.ndarray

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The token ids that symbols stand for."""
        symbols = symbols.astype(np.int64)
        while True:
            rule = symbols >= self.first
            if not rule.any():
                return symbols.astype("<u4")
            place = np.cumsum(1 + rule) - 1 - rule
            wider = np.empty(len(symbols) + int(rule.sum()), np.int64)
            wider[place] = symbols
            k = symbols[rule] - self.first
            wider[place[rule]] = self.left[k]
            wider[place[rule] + 1] = self.right[k]
            symbols = wider

    def tokens(self) -> np.ndarray:
        """The ids of all documents, end to end."""
        return self.expand(self.symbols)

    def document(self, number: int) -> np.ndarray:
        """The ids of one document: only the symbols that cover it are expanded."""
        start = int(self.sizes[:number].sum())
        return self.range(start, start + int(self.sizes[number]))

    def range(self, start: int, stop: int) -> np.ndarray:
        """The ids at the places from start to stop."""
        if stop <= start:
            return np.zeros(0, "<u4")
        lengths = np.ones(len(self.symbols), np.int64)
        rule = self.symbols >= self.first
        lengths[rule] = self.lengths[self.symbols[rule] - self.first]
        ends = np.cumsum(lengths)
        a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        skipped = start - (int(ends[a - 1]) if a else 0)
        return self.expand(self.symbols[a:b])[skipped:skipped + stop - start]


def replace_pairs(ids: np.ndarray, first: int, least: int, gain: float) -> tuple[np.ndarray, np.ndarray]:
    """The symbols that are left, and the rules (left, right) in the order of their nonterminals.

    A round counts all pairs of neighbours by sorting them and replaces those that occur
    ``least`` times: of overlapping ones the more frequent, of equally frequent ones the
    smaller pair, of a run of one symbol every second. Rounds end when no pair is frequent
    or a round would shorten the shard by less than ``gain``.
    """
    symbols = ids.astype(np.int64)
    rules: list[np.ndarray] = []
    # A pair and its place share 64 bits, so that one sort brings both into order.
    bits = max(1, (len(symbols) - 1).bit_length())
    while len(symbols) > 1 and 2 * int(first).bit_length() + bits <= 63:
        pairs = symbols[:-1] * first + symbols[1:]
        packed = pairs << bits | np.arange(len(pairs))
        packed.sort()
        key = packed >> bits
        begin = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
        count = np.diff(np.append(begin, len(key)))
        frequent = count >= least
        if not frequent.any():
            break
        order = np.argsort(-count[frequent], kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        ranks = np.full(len(symbols) + 1, NO_PAIR, np.int32)  # by place, one before the first
        ranks[(packed[np.repeat(frequent, count)] & ((1 << bits) - 1)) + 1] = np.repeat(rank, count[frequent])
        here = ranks[1:-1]
        taken = _alternate((here != NO_PAIR) & (here <= ranks[2:]) & (here <= ranks[:-2]), here)
        which = order[here[taken]]
        enough = np.bincount(which, minlength=len(order)) >= 3  # a rule costs two symbols
        taken = taken[enough[which]]
        if len(taken) < max(1, gain * len(symbols)) or first + int(enough.sum()) >= MOST_SYMBOLS:
            break
        which = which[enough[which]]
        chosen = key[begin[frequent]][enough]
        rules.append(np.stack([chosen // first, chosen % first], axis=1))
        symbols[taken] = first + (np.cumsum(enough) - 1)[which]
        kept = np.ones(len(symbols), bool)
        kept[taken + 1] = False
        symbols = symbols[kept]
        first += len(chosen)
    return symbols, np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)


def _alternate(wanted: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The places that are wanted and do not overlap: neighbours that are both wanted have
    the same rank (a run of one symbol), of which the 1st, 3rd, 5th are taken."""
    places = np.flatnonzero(wanted)
    if not len(places):
        return places
    begins = np.append(True, np.diff(places) != 1)
    begin = np.flatnonzero(begins)
    within = np.arange(len(places)) - np.repeat(begin, np.diff(np.append(begin, len(places))))
    return places[within % 2 == 0]


def pack(ids: np.ndarray, sizes: np.ndarray, vocabulary: int, least: int = 8, gain: float = 0.01) -> bytes:
    """The shard of documents whose ids lie end to end; ids are below ``vocabulary``."""
    if len(ids) and int(ids.max()) >= vocabulary:
        raise ValueError(f"id {int(ids.max())} is not below {vocabulary}")
    symbols, rules = replace_pairs(ids, vocabulary, least, gain)
    lengths = np.ones(vocabulary + len(rules), np.int64)
    # A round's rules are made of symbols of earlier rounds only, and rules ascend by round.
    done = vocabulary
    while done < len(lengths):
        ready = np.flatnonzero((rules[done - vocabulary:] >= done).any(axis=1))
        stop = done + int(ready[0]) if len(ready) else len(lengths)
        part = rules[done - vocabulary:stop - vocabulary]
        lengths[done:stop] = lengths[part[:, 0]] + lengths[part[:, 1]]
        done = stop
    header = np.array([vocabulary, len(rules), len(symbols), len(sizes)], "<u4")
    return b"".join([
        MAGIC, header.tobytes(), rules[:, 0].astype("<u4").tobytes(), rules[:, 1].astype("<u4").tobytes(),
        lengths[vocabulary:].astype("<u4").tobytes(), np.asarray(sizes).astype("<u8").tobytes(),
        *(((symbols >> shift) & 255).astype(np.uint8).tobytes() for shift in (0, 8, 16)),
    ])


def unpack(data: bytes) -> Shard:
    if data[:4] != MAGIC:
        raise ValueError("not a shard of this format")
    first, rules, symbols, documents = np.frombuffer(data, "<u4", 4, 4).tolist()
    wanted = HEADER + 12 * rules + 8 * documents + 3 * symbols
    if len(data) != wanted:
        raise ValueError(f"a shard of {len(data)} bytes should have {wanted}")
    at = HEADER
    left, right, lengths = (np.frombuffer(data, "<u4", rules, at + 4 * rules * k).astype(np.int64) for k in range(3))
    sizes = np.frombuffer(data, "<u8", documents, at + 12 * rules).astype(np.int64)
    at += 12 * rules + 8 * documents
    low, middle, high = (np.frombuffer(data, np.uint8, symbols, at + symbols * k).astype(np.int64) for k in range(3))
    return Shard(first, left, right, lengths, sizes, low | middle << 8 | high << 16)
