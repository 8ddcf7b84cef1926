"""Words, word hashes and word shingles of text batches, by array operations.

A word is a run of bytes other than space and tab to carriage return; A-Z count
as a-z. Hashes have 64 bits; distinct words or shingles of one corpus may share
one with a chance of about pairs / 2^64.
"""

import numpy as np

WORD = r"[^\x20\x09-\x0D]+"

# Odd multipliers of well-known 64-bit mixing functions.
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x5851F42D4C957F2D

_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_LOWER += 1
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse, modulo 2^64."""
    inverse = pow(BASE, -1, 1 << 64)
    up, down = np.full(n, BASE, np.uint64), np.full(n, inverse, np.uint64)
    up[:1], down[:1] = 1, 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts in order, and each text's number of words."""
    raw = [(t or "").encode() for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    space = _IS_SPACE[data]
    before = np.concatenate([[True], space[:-1]])
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(space & ~before)
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LOWER[data] * up[:-1], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    text_ends = np.cumsum([len(r) + 1 for r in raw])
    upto = np.searchsorted(starts, text_ends)
    return hashes, np.diff(upto, prepend=0)


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, ascending.

    A text with fewer than ``k`` words has its whole sequence as one shingle, and
    none without words.
    """
    hashes, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    out = []
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, len(hashes) - k + 1), np.uint64)
        for j in range(k):
            rolled = mixed(rolled * GOLDEN + hashes[j : len(hashes) - k + 1 + j]) if k <= len(
                hashes
            ) else rolled
        for n, end in zip(counts.tolist(), ends.tolist(), strict=True):
            if n >= k:
                out.append(np.unique(rolled[end - n : end - k + 1]))
            elif n:
                one = np.zeros(1, np.uint64)
                for h in hashes[end - n : end]:
                    one = mixed(one * GOLDEN + h)
                out.append(mixed(one + np.uint64(n)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out
