"""Sets of word shingles as sorted 64-bit hashes, for a batch of texts at a time."""

from __future__ import annotations

import numpy as np

SHINGLE_WORDS = 5

_GOLDEN = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.view(np.uint64).copy()
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


#: A number for each byte; powers of an odd number for places in a word and in a shingle.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_GOLDEN))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LOWER[list(b"\t\n\x0b\x0c\r")] = 32
_powers = np.ones(1, dtype=np.uint64)


def _power(upto: int) -> np.ndarray:
    global _powers
    if upto > len(_powers):
        steps = np.full(1 << upto.bit_length(), 0xD6E8FEB86659FD93, dtype=np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers


def shingle_sets(texts: list[str | None], words: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles of ``words`` words.

    A-Z are lower-cased; words are set apart by ASCII white space. A text of fewer
    words is one shingle; a text without words has none.
    """
    encoded = [(t or "").encode() for t in texts]
    data = _LOWER[np.frombuffer(b" " + b" ".join(encoded) + b" ", dtype=np.uint8)]
    blank = data == 32
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    if not len(starts):
        return [np.empty(0, dtype=np.int64) for _ in texts]
    lengths = ends - starts
    letters = data[~blank]
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    power = _power(int(lengths.max()) + words)
    hashed = mix(np.add.reduceat(_BYTE[letters] * power[place], first) + lengths.astype(np.uint64))
    # The texts' word ranges.
    text_ends = np.cumsum(np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded)) + 1)
    upto = np.searchsorted(starts, text_ends, side="right")
    begin = np.concatenate([[0], upto[:-1]])
    combined = np.zeros(len(hashed), dtype=np.uint64)
    for k in range(min(words, len(hashed))):
        combined[: len(hashed) - k] += hashed[k:] * power[k + 1]
    combined = mix(combined + np.uint64(words))
    sets = []
    for a, b in zip(begin.tolist(), upto.tolist()):
        n = b - a
        if n >= words:
            own = combined[a : b - words + 1]
        elif n:
            whole = (hashed[a:b] * power[1 : n + 1]).sum(dtype=np.uint64)
            own = mix(np.array([whole], dtype=np.uint64) + np.uint64(n))
        else:
            own = combined[:0]
        own = np.sort(own.view(np.int64))
        sets.append(own[np.concatenate([[True], own[1:] != own[:-1]])] if n else own)
    return sets


def set_digest(hashes: np.ndarray) -> int:
    """One 64-bit number for a set; 0 for the empty set."""
    if not len(hashes):
        return 0
    total = mix(hashes).sum(dtype=np.uint64, keepdims=True) + np.array([len(hashes)], dtype=np.uint64) * np.uint64(_GOLDEN)
    return int(mix(total).view(np.int64)[0])


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    at = np.searchsorted(x, y)
    at[at == len(x)] = 0
    return int((x[at] == y).sum()) if len(x) else 0
