"""Draws by the array against the module hashlib."""

import hashlib

import numpy as np

from corpusforge.functions.draws import Draws


def test_draws_are_md5():
    for n in (0, 1, 11, 50, 52, 53, 54, 61, 62, 64, 118, 130):
        seeds, counts = [bytes((7 * i + k) % 256 for k in range(n)) for i in range(5)], np.array([3, 0, 1, 1200, 20000])
        at = np.concatenate([np.arange(c) for c in counts])
        want = [int(hashlib.md5(s + b"n|%d" % i).hexdigest()[:8], 16) for s, c in zip(seeds, counts) for i in range(c)]
        assert Draws(seeds)(b"n|", counts, at).tolist() == want
