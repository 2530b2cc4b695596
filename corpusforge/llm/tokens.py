"""Token counts of a public byte-level BPE vocabulary, fast enough for whole corpora.

The tokenizer cuts a text with a fixed pattern and merges bytes only inside each cut, so a cut's count never
depends on its neighbours: counts are kept per distinct cut and a text costs one regex pass and look-ups.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np

#: Distinct cuts remembered by one Python worker (about 100 bytes each).
CACHE_CUTS = 1_000_000
#: Cuts of more tokens are measured inside: an unbroken run of letters, digits or signs.
LONG_CUT = 32
#: Tokens that re-reading part of a cut may add at its edges.
EDGE_TOKENS = 4
DEFAULT_VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    """Place of a public vocabulary file installed on the machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Counter:
    """Counts tokens of one vocabulary file."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cuts = regex.compile(public_tokenizers.PATTERN).findall
        self.known: dict[str, int] = {}

    def _learn(self, cuts: list[str]) -> None:
        new = [c for c in set(cuts) if c not in self.known]
        if len(self.known) + len(new) > CACHE_CUTS:
            self.known.clear()
            new = list(set(cuts))
        encode = self.encoding.encode_ordinary
        for c in new:
            self.known[c] = len(encode(c))

    def sizes(self, text: str) -> tuple[list[str], list[int]]:
        """The cuts of ``text``, which together are ``text``, and the tokens of each."""
        cuts = self.cuts(text)
        try:
            return cuts, list(map(self.known.__getitem__, cuts))
        except KeyError:
            self._learn(cuts)
            return cuts, list(map(self.known.__getitem__, cuts))

    def count(self, text: str) -> int:
        return sum(self.sizes(text)[1])

    def inside(self, cut: str) -> list[tuple[int, int]]:
        """(characters, tokens) of the stretches of one cut between token ends that are ends of a character."""
        ends = np.cumsum([len(c.encode("utf-8", "surrogatepass")) for c in cut])
        places = {int(e): k + 1 for k, e in enumerate(ends)}
        out, at, last, tokens = [], 0, 0, 0
        for t in self.encoding.encode_ordinary(cut):
            at += len(self.encoding.decode_single_token_bytes(t))
            tokens += 1
            if at in places:
                out.append((places[at] - last, tokens))
                last, tokens = places[at], 0
        return out

    def stretches(self, text: str) -> tuple[list[int], list[int]]:
        """Characters and tokens of the cuts of ``text``, long ones in parts."""
        cuts, n = self.sizes(text)
        if max(n, default=0) <= LONG_CUT:
            return list(map(len, cuts)), n
        parts = [x for c, k in zip(cuts, n) for x in (self.inside(c) if k > LONG_CUT else [(len(c), k)])]
        return [x[0] for x in parts], [x[1] for x in parts]

    def tightest(self, text: str, limit: int) -> tuple[int, int]:
        """(tokens of ``text``, fewest characters that any run of more than ``limit`` tokens spans); (n, -1) if n <= limit.

        A run is measured in whole cuts, rounded down, so a window of fewer characters can't exceed ``limit``; only a
        long cut is measured inside, between its tokens.
        """
        lengths, n = self.stretches(text)
        ends = np.cumsum(n)
        if not len(ends) or ends[-1] <= limit:
            return int(ends[-1]) if len(ends) else 0, -1
        chars = np.concatenate([[0], np.cumsum(lengths)])
        before = np.concatenate([[0], ends])
        # from the start of cut i, the first cut j whose end passes the limit: a window inside (i, j) holds at most limit tokens
        j = np.searchsorted(before, before[:-1] + limit, side="right") - 1
        ok = j < len(chars) - 1
        spans = chars[j[ok]] - chars[1:][ok]  # from inside cut i to before cut j + 1
        return int(ends[-1]), int(max(1, spans.min(initial=len(text))))

    def tail(self, text: str, tokens: int) -> int:
        """Characters of the longest run of whole cuts at the end of ``text`` that has at most ``tokens`` tokens; a long cut may be taken in part."""
        cuts, n = self.sizes(text)
        got = chars = 0
        for c, k in zip(reversed(cuts), reversed(n)):
            if got + k > tokens:
                if k > LONG_CUT:
                    for length, part in reversed(self.inside(c)):
                        if got + part > tokens - EDGE_TOKENS:
                            break
                        got, chars = got + part, chars + length
                break
            got, chars = got + k, chars + len(c)
        return chars


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    """One counter per Python worker and file."""
    return Counter(path)
