"""Sets of word shingles as sorted 64-bit hashes, worked out for blocks of texts in numpy.

A-Z is lower-cased; words are what stands between bytes 0x20 and 0x09 to 0x0D.  A
word's hash is a polynomial over its bytes, taken from running sums; a shingle's is a
sum over its words' hashes.  Both are mixed to all 64 bits.  A text with fewer words
than a shingle has gives its whole sequence as one; without words the set is empty.
"""

from __future__ import annotations

import numpy as np

WORDS = 5
WINDOW = 1 << 18
U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bits of each number spread over all 64 (shift and multiply; one to one)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_LETTER = mix(np.arange(1, 257, dtype=U) * U(_BASE))
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PLACE = mix(np.arange(1, WORDS + 1, dtype=U)) | U(1)


class Powers:
    """Powers of the base and of its inverse, as many as asked for so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            self.up, self.down = (np.multiply.accumulate(np.concatenate((np.ones(1, U), np.full(n, b, U)))) for b in (_BASE, _INVERSE))
        return self.up, self.down


_powers = Powers()


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and the number of words of each text.

    ``data`` holds the texts' bytes, text k from ``starts[k]`` to ``starts[k + 1]``.
    Long texts are worked off in windows that end between words.
    """
    n = len(data)
    space = _SPACE[data]
    opens = np.zeros(n + 1, bool)
    opens[starts] = True
    opens = opens[:n]
    hashes, places = [np.zeros(0, U)], [np.zeros(0, np.int64)]
    a = 0
    while a < n:
        b = min(a + WINDOW, n)
        while b < n and not (space[b] or opens[b]):
            found = np.flatnonzero(space[b : b + WINDOW] | opens[b : b + WINDOW])
            b = b + int(found[0]) if len(found) else min(b + WINDOW, n)
        gap, first = space[a:b], opens[a:b]
        begin = np.flatnonzero(~gap & (first | np.concatenate(([True], gap[:-1]))))
        end = np.flatnonzero(~gap & np.concatenate((gap[1:] | first[1:], [True]))) + 1
        up, down = _powers(b - a)
        sums = np.concatenate((np.zeros(1, U), np.cumsum(_LETTER[data[a:b]] * up[: b - a])))
        hashes.append(mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(U)))
        places.append(begin + a)
        a = b
    return np.concatenate(hashes), np.diff(np.searchsorted(np.concatenate(places), starts))


def shingle_sets(data: np.ndarray, starts: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    hashes, counts = word_hashes(data, starts)
    ends = np.cumsum(counts)
    long = max(0, len(hashes) - words + 1)
    sums = np.full(long, words, U)
    for j in range(words):
        sums += hashes[j : j + long] * _PLACE[j]
    sums = mix(sums)
    out = []
    for end, n in zip(ends.tolist(), counts.tolist(), strict=True):
        if n >= words:
            out.append(np.unique(sums[end - n : end - words + 1]))
        elif n:
            out.append(mix(np.array([(hashes[end - n : end] * _PLACE[:n]).sum(dtype=U) + U(n)])))
        else:
            out.append(np.zeros(0, U))
    return out


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 times the intersection reaches ``percent`` times the union; empty sets are linked with nothing."""
    if not len(a) or not len(b):
        return False
    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
    both = int((a[at] == b).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)
