"""Canonical length-limited Huffman coding of ids, in vectorised numpy."""

from __future__ import annotations

import numpy as np

WIDEST = 24  # bits of a code; a code behind 7 bits of another byte fits 32 bits


def code_lengths(counts: np.ndarray, max_bits: int = 20) -> np.ndarray:
    """Optimal code lengths of at most max_bits (package-merge); 0 where the count is 0."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} symbols need more than {max_bits} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    levels = []  # per level, whether the items in ascending weight are symbols or packages
    packages = np.empty(0)
    for _ in range(max_bits):
        items = np.concatenate([weights, packages])
        by_weight = np.argsort(items, kind="stable")
        levels.append(by_weight < len(weights))
        items = items[by_weight]
        packages = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take = 2 * len(weights) - 2
    sorted_lengths = np.zeros(len(weights), dtype=np.uint8)
    for is_symbol in reversed(levels):
        symbols = int(is_symbol[:take].sum())
        sorted_lengths[:symbols] += 1
        take = 2 * (take - symbols)
    lengths[order] = sorted_lengths
    return lengths


class Codebook:
    """Canonical codes: by length, then by id; a table over max_bits bits decodes in one look."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.bits = max(1, int(lengths.max(initial=0)))
        if self.bits > WIDEST:
            raise ValueError(f"codes of {self.bits} bits; at most {WIDEST} can be read at once")
        symbols = np.flatnonzero(lengths)
        symbols = symbols[np.lexsort((symbols, lengths[symbols]))]
        widths = np.left_shift(1, self.bits - self.lengths[symbols])
        starts = np.concatenate([[0], np.cumsum(widths)[:-1]]) if len(symbols) else np.empty(0, np.int64)
        self.codes = np.zeros(len(lengths), dtype=np.uint64)
        self.codes[symbols] = starts >> (self.bits - self.lengths[symbols])
        self.table = np.zeros(1 << self.bits, dtype=np.uint32)
        filled = np.repeat(symbols, widths)
        self.table[: len(filled)] = filled

    def encode(self, ids: np.ndarray, sizes: np.ndarray, block: int, every: int) -> tuple[list[bytes], list[np.ndarray]]:
        """Sequences laid end to end in ids -> (payload, bit offsets) of each.

        A payload is a run of independent blocks of `block` ids, each starting on a byte.
        The offsets are those of the ids 0, every, 2 * every, ...; `every` divides `block`.
        """
        if not len(ids):
            return [b""] * len(sizes), [np.empty(0, np.uint64)] * len(sizes)
        sizes = np.asarray(sizes, dtype=np.int64)
        begins = np.cumsum(sizes) - sizes
        width = self.lengths[ids]
        if not width.all():
            raise ValueError("an id without a code")
        heads, block_owner = _every(begins, sizes, block)
        marks, owner = _every(begins, sizes, every)
        block_bytes = (np.add.reduceat(width, heads) + 7) >> 3
        block_at = np.cumsum(block_bytes) - block_bytes
        at = np.cumsum(width) - width
        at += np.repeat(block_at * 8 - at[heads], np.diff(np.append(heads, len(ids))))
        total = int(block_bytes.sum())
        # a code of up to 24 bits lies in one 32-bit word or two; codes of a word have no bit in common
        word, room = at >> 5, 64 - (at & 31) - width
        shifted = self.codes[ids] << room.astype(np.uint64)
        groups = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        words = np.zeros((total >> 2) + 3, dtype=np.uint64)
        words[word[groups]] = np.add.reduceat(shifted >> np.uint64(32), groups)
        split = np.flatnonzero(room < 32)
        words[word[split] + 1] += shifted[split] & np.uint64(0xFFFFFFFF)
        data = words.astype(">u4").tobytes()
        first_byte = np.full(len(sizes), total, dtype=np.int64)
        filled = np.flatnonzero(sizes)
        first_byte[filled] = at[begins[filled]] >> 3
        first_byte = np.minimum.accumulate(first_byte[::-1])[::-1]
        last_byte = np.append(first_byte[1:], total)
        offsets = (at[marks] - first_byte[owner] * 8).astype(np.uint64)
        per = np.searchsorted(owner, np.arange(len(sizes) + 1))
        return (
            [data[a:b] for a, b in zip(first_byte, last_byte)],
            [offsets[a:b] for a, b in zip(per, per[1:])],
        )

    def decode(self, payloads: list[bytes], offsets: list[np.ndarray], sizes: np.ndarray, every: int) -> np.ndarray:
        """The ids of all sequences end to end; all stretches between checkpoints advance together."""
        sizes = np.asarray(sizes, dtype=np.int64)
        out = np.zeros(int(sizes.sum()), dtype=np.uint32)
        if not len(out):
            return out
        lengths = np.array([len(p) for p in payloads], dtype=np.int64)
        raw = np.frombuffer(b"".join(payloads) + bytes(8), dtype=np.uint8).astype(np.uint32)
        peek = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        to, owner = _every(np.cumsum(sizes) - sizes, sizes, every)
        at = np.concatenate(offsets).astype(np.int64) + (np.cumsum(lengths) - lengths)[owner] * 8
        left = np.minimum(np.cumsum(sizes)[owner] - to, every)
        longest_first = np.argsort(-left, kind="stable")
        at, to, left = at[longest_first], to[longest_first], left[longest_first]
        running = np.searchsorted(-left, -np.arange(int(left[0])), side="left")  # stretches with more than k ids
        for k, n in enumerate(running):
            here = at[:n]
            bits = (peek[here >> 3] << (here & 7).astype(np.uint32)) >> np.uint32(32 - self.bits)
            ids = self.table[bits]
            out[to[:n] + k] = ids
            here += self.lengths[ids]
        return out


def _every(begins: np.ndarray, sizes: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of every step-th element of each sequence, and the sequences they are in."""
    n = -(-sizes // step)
    owner = np.repeat(np.arange(len(sizes)), n)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    return begins[owner] + nth * step, owner
