"""Hashes of words and of windows over many texts at once, with numpy.

Texts are laid end to end in one byte array, so that the work is a few array
operations per batch and none per word. All hashes have 64 bits.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
GOLDEN = 0x9E3779B97F4A7C15
LETTERS = 24
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit number over all of them; a bijection."""
    x = x ^ (x >> U(31))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(29)
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(32))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, a line feed after each text, and where each text begins (with the end)."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    return data, np.concatenate([[0], np.cumsum(sizes)])


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, other bytes as they are."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word and the number of its text, in order.

    Equal words have equal hashes wherever they stand: a word's bytes are weighted
    by their places in the word and summed.
    """
    space = IS_SPACE[data]
    before = np.concatenate([[True], space[:-1]]) if len(data) else space
    begin = np.flatnonzero(~space & before)
    if not len(begin):
        return np.zeros(0, U), np.zeros(0, np.int64)
    end = np.flatnonzero(space & ~before)
    length = end - begin
    weights = mix(np.arange(1, int(length.max()) + 1).astype(U) * U(GOLDEN)) | U(1)
    summed, left, at = np.zeros(len(begin), U), np.arange(len(begin)), begin
    for place in range(min(len(weights), LETTERS)):  # a letter of every word that has it
        if place:
            more = np.flatnonzero(length[left] > place)
            left, at = left[more], begin[left[more]] + place
        summed[left] += (data[at].astype(U) + U(1)) * weights[place]
    if len(weights) > LETTERS:  # the rest of long words
        long = np.flatnonzero(length > LETTERS)
        rest = length[long] - LETTERS
        first = np.cumsum(rest) - rest
        place = np.arange(rest.sum()) - np.repeat(first, rest) + LETTERS
        at = np.repeat(begin[long], rest) + place
        summed[long] += np.add.reduceat((data[at].astype(U) + U(1)) * weights[place], first)
    text = np.searchsorted(starts, begin, side="right") - 1
    return mix(summed + length.astype(U)), text


def window_hashes(values: np.ndarray, length: int, factor: int = GOLDEN) -> np.ndarray:
    """A polynomial hash of every run of ``length`` values, by doubling."""
    if len(values) < length:
        return np.zeros(0, U)
    done, done_length, power, power_length, left = None, 0, values, 1, length
    while left:
        if left & 1:
            if done is None:
                done, done_length = power, power_length
            else:
                n = len(values) - done_length - power_length + 1
                shift = U(pow(factor, power_length, 2**64))
                done = done[:n] * shift + power[done_length:done_length + n]
                done_length += power_length
        left >>= 1
        if left:
            n = len(power) - power_length
            shift = U(pow(factor, power_length, 2**64))
            power = power[:n] * shift + power[power_length:power_length + n]
            power_length *= 2
    return done
