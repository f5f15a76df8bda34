"""Words of many texts at once, as arrays of places and hashes."""

from __future__ import annotations

import numpy as np

#: Bytes hashed at a time.
STEP = 1 << 18
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def table(is_word) -> np.ndarray:
    """Which bytes belong to words; bytes of characters beyond ASCII go by ``is_word(0x80)``."""
    return np.array([is_word(min(b, 0x80)) for b in range(256)], dtype=bool)


#: Everything but space and 09 to 0D.
NOT_SPACE = table(lambda b: b != 0x20 and not 9 <= b <= 13)
#: Digits, small letters, and everything beyond ASCII.
LETTERS = table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end], for words that don't overlap, in order."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + STEP)))
        low, high = starts[at], ends[to - 1]
        begin, lengths = starts[at:to] - low, ends[at:to] - starts[at:to]
        powers = np.multiply.accumulate(np.full(int(lengths.max()), MULTIPLIER))
        first = np.cumsum(lengths) - lengths
        inside = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        bytes_ = data[low:high][np.repeat(begin, lengths) + inside].astype(np.uint64)
        out[at:to] = mixed(np.add.reduceat((bytes_ + np.uint64(1)) * powers[inside], first))
        at = to
    return out


class Words:
    """The words of texts: text number, and hash of the bytes with A-Z in lower case."""

    def __init__(self, texts: list[str], wanted: np.ndarray):
        parts = [t.encode() for t in texts]
        data = np.frombuffer(b"\n".join(parts).lower() + b"\n", np.uint8)
        inside = np.concatenate([[False], wanted[data]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        limits = np.cumsum([len(p) + 1 for p in parts]) if parts else np.zeros(0, np.int64)
        self.text = np.searchsorted(limits, starts, side="right")
        self.count = np.bincount(self.text, minlength=len(texts))
        self.hash = hashes(data, starts, ends)
        self.length = ends - starts
