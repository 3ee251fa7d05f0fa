"""Word shingles of a text as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

REMEMBERED = 300_000  # words whose hashes a task keeps at hand
KEPT = 64  # bytes of a word up to which it is kept


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= KEPT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = value
        return value


class Shingler:
    """Distinct `size`-word shingles; A-Z in lower case, words parted by ASCII white space.

    A text of fewer words is one shingle, a text without words has none.  64-bit hashes
    stand for shingles: among 10^5 of them two differ and share a hash with a chance of
    about 3 in 10^10.
    """

    def __init__(self, size: int):
        self.size, self.words = size, _Words()

    def codes(self, text: str | None) -> np.ndarray:
        """Hashes of the words of a text."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        return np.fromiter(map(self.words.__getitem__, words), dtype=np.uint64, count=len(words))

    def __call__(self, text: str | None) -> np.ndarray:
        mixed = self._all(self.codes(text))
        mixed.sort()
        return mixed[_first_of_equal(mixed)]

    def with_ranks(self, text: str | None, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The shingles, and of each the least count of its words; counts is a vector by the words' top bits."""
        codes = self.codes(text)
        mixed = self._all(codes)
        if not len(mixed):
            return mixed, np.empty(0, counts.dtype)
        of_word = counts[(codes >> np.uint64(64 - (len(counts) - 1).bit_length())).astype(np.int64)]
        rank = of_word[: len(mixed)].copy()
        for k in range(1, len(codes) - len(mixed) + 1):
            np.minimum(rank, of_word[k : k + len(mixed)], out=rank)
        order = np.argsort(mixed, kind="stable")
        mixed = mixed[order]
        first = _first_of_equal(mixed)
        return mixed[first], rank[order][first]

    def _all(self, codes: np.ndarray) -> np.ndarray:
        if not len(codes):
            return codes
        size = min(self.size, len(codes))
        mixed = _mix(codes[: len(codes) - size + 1] + np.uint64(size))
        for k in range(1, size):
            mixed = _mix(mixed + codes[k : len(codes) - size + 1 + k])
        return mixed


def _first_of_equal(ascending: np.ndarray) -> np.ndarray:
    return np.append(True, ascending[1:] != ascending[:-1])[: len(ascending)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
