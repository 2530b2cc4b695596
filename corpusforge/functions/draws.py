"""MD5 draws by the array: what ``corruption.chance`` gives, for many positions of many seeds at once."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np

# Fixed values of MD5: rotations, additive constants, first state.
TURNS = [s for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in four * 4]
SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2**32)) for i in range(64)]
PLACES = [(i, (5 * i + 1) % 16, (3 * i + 5) % 16, 7 * i % 16)[i // 16] for i in range(64)]
FIRST = [np.uint32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]

#: Numbers hashed at a time, so that the arrays of a round stay in the processor's cache.
AT_ONCE = 16384


def _mix(f: int, b, c, d, t) -> None:
    if f == 0:
        np.bitwise_xor(c, d, out=t)
        np.bitwise_and(t, b, out=t)
        np.bitwise_xor(t, d, out=t)
    elif f == 1:
        np.bitwise_xor(b, c, out=t)
        np.bitwise_and(t, d, out=t)
        np.bitwise_xor(t, c, out=t)
    elif f == 2:
        np.bitwise_xor(b, c, out=t)
        np.bitwise_xor(t, d, out=t)
    else:
        np.invert(d, out=t)
        np.bitwise_or(t, b, out=t)
        np.bitwise_xor(t, c, out=t)


def _block(state: list, words: list, whole: bool = True) -> list:
    """The state after one block, or its first word alone, which 61 rounds give; a word is an array, or None where it is 0."""
    a, b, c, d = (x.copy() for x in state)
    t, u = np.empty_like(a), np.empty_like(a)
    for i in range(64 if whole else 61):
        _mix(i // 16, b, c, d, t)
        np.add(t, a, out=t)
        np.add(t, SINES[i], out=t)
        if words[PLACES[i]] is not None:
            np.add(t, words[PLACES[i]], out=t)
        np.left_shift(t, TURNS[i], out=u)
        np.right_shift(t, 32 - TURNS[i], out=t)
        np.bitwise_or(t, u, out=t)
        np.add(t, b, out=t)
        a, b, c, d, t = d, t, b, c, a
    return [x + y for x, y in zip((a, b, c, d), state)] if whole else [b + state[0]]


@lru_cache(maxsize=8)
def _tails(offset: int, n: int) -> tuple[list, np.ndarray]:
    """By position under n: its digits and the end bit, put into words from this byte of the first; how many digits."""
    digits = [str(i).encode() for i in range(n)]
    raw = b"".join((b"\0" * offset + x + b"\x80").ljust(12, b"\0") for x in digits)
    return [w for w in np.frombuffer(raw, "<u4").reshape(n, 3).T.copy() if w.any()], np.array([len(x) for x in digits], np.uint32)


class Draws:
    """Seeds of one length in bytes; ``draws(what, counts, at)`` gives 32 bits for each position ``at``, ``counts`` of them a seed."""

    def __init__(self, seeds: list[bytes]):
        self.seeds = np.frombuffer(b"".join(seeds), np.uint8).reshape(len(seeds), -1) if seeds and seeds[0] else np.empty((len(seeds), 0), np.uint8)

    def __call__(self, what: bytes, counts: np.ndarray, at: np.ndarray) -> np.ndarray:
        if not len(at):
            return np.empty(0, np.uint32)
        long = self.seeds.shape[1] + len(what)
        start, rest = long // 64 * 64, long % 64
        raw = np.zeros((len(self.seeds), start + 64), np.uint8)
        raw[:, : long - len(what)] = self.seeds
        raw[:, long - len(what) : long] = np.frombuffer(what, np.uint8)
        fixed = raw.view("<u4").T.copy()
        state = None
        for k in range(start // 64):
            state = _block(state or [np.full(len(self.seeds), x) for x in FIRST], list(fixed[16 * k : 16 * k + 16]))
        fixed = fixed[start // 4 :]
        most = int(at.max())
        tails, digits = _tails(long % 4, 1 << max(10, most.bit_length()))
        bits = (digits + np.uint32(long)) * np.uint32(8)
        sure = rest + len(str(most)) + 8 < 64
        out = np.empty(len(at), np.uint32)
        ends = np.cumsum(counts)
        for lo in range(0, len(at), AT_ONCE):
            hi = min(lo + AT_ONCE, len(at))
            first, last = np.searchsorted(ends, lo, "right"), np.searchsorted(ends, hi - 1, "right") + 1
            n = np.minimum(ends[first:last], hi) - np.maximum(ends[first:last] - counts[first:last], lo)
            i, rows = at[lo:hi], slice(first, last)
            if sure:
                out[lo:hi] = self._hash(state, fixed, rows, n, i, 1, rest, tails, bits)
                continue
            blocks = (bits[i] // 8 - start + 8) // 64 + 1
            for b in (1, 2):
                if (here := blocks == b).any():
                    n_b = np.bincount(np.repeat(np.arange(last - first), n)[here], minlength=last - first)
                    out[lo:hi][here] = self._hash(state, fixed, rows, n_b, i[here], b, rest, tails, bits)
        return out

    def _hash(self, state, fixed, rows, n, i, blocks, rest, tails, bits):
        words: list = [None] * (16 * blocks)
        for k in range((rest + 3) // 4):
            words[k] = np.repeat(fixed[k, rows], n)
        for k, tail in enumerate(tails, rest // 4):
            if k < len(words):
                words[k] = tail[i] if words[k] is None else words[k] | tail[i]
        words[-2] = bits[i] if words[-2] is None else words[-2] | bits[i]
        s = [np.repeat(x[rows], n) for x in state] if state else [np.full(len(i), x) for x in FIRST]
        for b in range(blocks):
            s = _block(s, words[16 * b : 16 * b + 16], b < blocks - 1)
        return s[0].byteswap()
