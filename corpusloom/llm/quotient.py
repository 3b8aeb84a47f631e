"""Counting quotient filters over packed n-grams of word ids: compact, lossless, and merged like sorted lists.

An n-gram of ids below ``2**bits`` is packed into two halves of ``n * bits / 2`` bits. A Feistel network permutes the
packed value: it can be undone, and spreads the keys evenly. The permuted value's leading bits say which
shard it belongs to (``prefix``), the next are the quotient, which is not stored but told by the entry's place (a run of
ones for the entries of a quotient, then a zero), and all the rest is the remainder, which is stored in full. So
nothing collides: what comes out is exactly what went in, with its count.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

from corpusloom.llm.common import mix

_KEYS = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_HEAD = struct.Struct("<QBBB")
LONGEST = 4
#: Half of the longest n-gram must fit 64 bits.
MOST_BITS = 32


def _u(x: int) -> np.uint64:
    return np.uint64(x)


def id_bits(largest: int) -> int:
    """Bits per word id, even, for ids from 1 to ``largest``."""
    bits = max(2, int(largest).bit_length())
    bits += bits & 1
    if bits > MOST_BITS:
        raise ValueError(f"{largest} words: ids of more than {MOST_BITS} bits can't be packed")
    return bits


def pack(words: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of 2 to 4 ids."""
    if len(words) == 2:
        return words[0], words[1]
    if len(words) == 3:
        half = bits // 2
        middle = words[1]
        return (words[0] << _u(half)) | (middle >> _u(half)), ((middle & _u((1 << half) - 1)) << _u(bits)) | words[2]
    return (words[0] << _u(bits)) | words[1], (words[2] << _u(bits)) | words[3]


def unpack(left: np.ndarray, right: np.ndarray, n: int, bits: int) -> list[np.ndarray]:
    one = _u((1 << bits) - 1)
    if n == 2:
        return [left, right]
    if n == 3:
        half = bits // 2
        low = _u((1 << half) - 1)
        return [left >> _u(half), ((left & low) << _u(half)) | (right >> _u(bits)), right & one]
    return [left >> _u(bits), left & one, right >> _u(bits), right & one]


def permute(left: np.ndarray, right: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    mask = _u((1 << half) - 1)
    for key in _KEYS:
        left, right = right, left ^ (mix(right + key) & mask)
    return left, right


def restore(left: np.ndarray, right: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    mask = _u((1 << half) - 1)
    for key in reversed(_KEYS):
        left, right = right ^ (mix(left + key) & mask), left
    return left, right


@dataclass
class Filter:
    """Entries in order of their permuted value, each once, with its count. ``half``: bits of either half."""

    half: int
    left: np.ndarray
    right: np.ndarray
    count: np.ndarray

    @classmethod
    def of(cls, half: int, left: np.ndarray, right: np.ndarray, count: np.ndarray | None = None) -> Filter:
        """From permuted values in any order, which may repeat."""
        if count is None and 2 * half <= 64:
            key, count = np.unique((left << _u(half)) | right, return_counts=True)
            return cls(half, key >> _u(half), key & _u((1 << half) - 1), count)
        order = np.lexsort((right, left))
        left, right = left[order], right[order]
        new = np.ones(len(left), bool)
        new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
        at = np.flatnonzero(new)
        if count is None:
            count = np.diff(at, append=len(left))
        else:
            count = np.add.reduceat(count[order], at) if len(at) else count
        return cls(half, left[at], right[at], count)

    @classmethod
    def merged(cls, filters: list[Filter]) -> Filter:
        return cls.of(
            filters[0].half,
            np.concatenate([f.left for f in filters]),
            np.concatenate([f.right for f in filters]),
            np.concatenate([f.count for f in filters]),
        )

    def split(self, bits: int) -> list[tuple[int, Filter]]:
        """By the leading ``bits`` of the permuted value: the parts that have entries."""
        prefix = (self.left >> _u(self.half - bits)).astype(np.int64) if bits else np.zeros(len(self.left), np.int64)
        starts = np.flatnonzero(np.diff(prefix, prepend=-1))
        ends = np.append(starts[1:], len(prefix))
        return [
            (int(prefix[s]), Filter(self.half, self.left[s:e], self.right[s:e], self.count[s:e]))
            for s, e in zip(starts, ends, strict=True)
        ]

    def dump(self, bits: int) -> bytes:
        """Of a part whose entries share their leading ``bits``."""
        n = len(self.left)
        quotient_bits = min(max(n.bit_length() - 1, 0), self.half - bits)
        rest = self.half - bits - quotient_bits
        quotient = (self.left >> _u(rest)).astype(np.int64) & ((1 << quotient_bits) - 1) if rest < 64 else np.zeros(n, np.int64)
        runs = np.zeros(n + (1 << quotient_bits), np.uint8)
        runs[np.arange(n) + quotient] = 1
        small = np.minimum(self.count, 255).astype(np.uint8)
        parts = [_HEAD.pack(n, self.half, bits, quotient_bits), np.packbits(runs).tobytes()]
        for values, width in ((self.left, rest), (self.right, self.half)):
            if rest < 64 and width == rest:
                values = values & _u((1 << rest) - 1)
            parts.append(values.astype("<u8").view(np.uint8).reshape(n, 8)[:, : -(-width // 8)].tobytes())
        parts += [small.tobytes(), self.count[small == 255].astype("<i8").tobytes()]
        return b"".join(parts)

    @classmethod
    def load(cls, blob: bytes, prefix: int) -> Filter:
        n, half, bits, quotient_bits = _HEAD.unpack_from(blob)
        rest, at = half - bits - quotient_bits, _HEAD.size
        slots = n + (1 << quotient_bits)
        runs = np.unpackbits(np.frombuffer(blob, np.uint8, -(-slots // 8), at), count=slots)
        at += -(-slots // 8)
        quotient = (np.flatnonzero(runs) - np.arange(n)).astype(np.uint64)

        def number(width: int) -> np.ndarray:
            nonlocal at
            size = -(-width // 8)
            out = np.zeros((n, 8), np.uint8)
            out[:, :size] = np.frombuffer(blob, np.uint8, n * size, at).reshape(n, size)
            at += n * size
            return out.view("<u8").ravel().astype(np.uint64)

        low, right = number(rest), number(half)
        left = low if rest >= 64 else (((_u(prefix) << _u(quotient_bits)) | quotient) << _u(rest)) | low
        count = np.frombuffer(blob, np.uint8, n, at).astype(np.int64)
        large = count == 255
        count[large] = np.frombuffer(blob, "<i8", int(large.sum()), at + n)
        return cls(half, left, right, count)
