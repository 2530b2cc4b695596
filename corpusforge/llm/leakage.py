"""Evaluation texts leaking into training text (problem 9).

Both sides are reduced to streams of base letters: case, accents, punctuation, digits, spacing and breaks are
gone, so a word broken at a line end is whole again. The n-grams of the held-out streams form a hash set that
goes to every task; each document's windows are looked up in it. Hits on one diagonal (document position less
item position) are verified letter by letter along that diagonal, with drift for lost or added characters: a
word counts when half of its letters lie in runs that agree, or its edit distance is small. An item leaked if
enough of its words in a row count; every such run is a span to cut, as a document may hold several of one item.

The hash set is built and broadcast for blocks of about ``ITEM_BLOCK`` items, each a scan of its own, so its size
and what the driver holds at once are bounded.
Defined results: null or empty texts hold and leak nothing; repeated rows are reported once; of several longest
runs the first in the document stands for a pair.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Letters of one n-gram.
GRAM = 16
#: Held-out items whose n-grams are broadcast at a time.
ITEM_BLOCK = 20_000
#: Letters by which an alignment may drift from the diagonal of its hit.
DRIFT = 24
#: Diagonals this near belong to one passage, which a page break or heading may interrupt.
JUMP = 120
#: Share of the letters of the shortest passage that its n-gram hits must span to be verified.
LEAST_SPAN = 0.5
#: Agreeing letters in a row that count as evidence.
RUN = 4
_MUL = np.uint64(0x9E3779B97F4A7C15)


def letter_table() -> np.ndarray:
    """Code of each character below U+3000: 1-255 by its base letter, 0 for what is no letter."""
    lut = np.zeros(0x3000, np.uint8)
    for cp in range(0x3000):
        s = [x for x in unicodedata.normalize("NFKD", chr(cp).casefold()) if unicodedata.category(x)[0] == "L"]
        if s:
            o = ord(s[0])
            lut[cp] = o - 96 if 97 <= o <= 122 else 27 + o % 229
    return lut


class Letters:
    """Letter streams of texts and their n-gram hashes."""

    def __init__(self) -> None:
        self.lut = letter_table()

    def stream(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(codes, places): the letters of ``text`` and the character each stands at."""
        cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        c = self.lut[np.minimum(cp, 0x2FFF)]
        at = np.flatnonzero(c)
        return c[at], at

    @staticmethod
    def grams(codes: np.ndarray) -> np.ndarray:
        """Hash of the ``GRAM`` letters from each place on, by doubling."""
        h, width, m = codes.astype(np.uint64), 1, int(_MUL)
        while width < GRAM:
            if len(h) <= width:
                return np.zeros(0, np.uint64)
            h = h[:-width] * np.uint64(m) + h[width:]
            m = m * m % 2**64
            width *= 2
        return h ^ (h >> np.uint64(29))


class Items:
    """The held-out side: letters, words and the n-gram set of a block of items."""

    def __init__(self, rows: list[tuple[int, str]], letters: Letters) -> None:
        self.ids, self.codes, self.words, grams, owner, place = [], [], [], [], [], []
        for i, (item_id, text) in enumerate(rows):
            codes, at = letters.stream(text)
            # a word is a run without white space; one without letters (a number) has an empty range
            bounds, start = [], None
            for k, ch in enumerate(text + " "):
                if ch.isspace():
                    if start is not None and any(x.isalnum() for x in text[start:k]):
                        bounds.append((int(np.searchsorted(at, start)), int(np.searchsorted(at, k))))
                    start = None
                elif start is None:
                    start = k
            g = letters.grams(codes)
            self.ids.append(item_id)
            self.codes.append(codes)
            self.words.append(bounds)
            grams.append(g)
            owner.append(np.full(len(g), i, np.int32))
            place.append(np.arange(len(g), dtype=np.int32))
        g = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(g, kind="stable")
        self.grams = g[order]
        self.owner = np.concatenate(owner)[order] if grams else np.zeros(0, np.int32)
        self.place = np.concatenate(place)[order] if grams else np.zeros(0, np.int32)
        self.mask = np.uint64((1 << max(16, (16 * len(self.grams)).bit_length())) - 1)  # sixteen places a gram at least
        self.bits = np.zeros(int(self.mask) + 1, bool)
        self.bits[(self.grams & self.mask).astype(np.int64)] = True

    @lru_cache(maxsize=8)
    def shortest(self, words: int) -> np.ndarray:
        """Fewest letters of any ``words`` words in a row of each item."""
        return np.array([min((b[k + words - 1][1] - b[k][0] for k in range(len(b) - words + 1)), default=10**9) for b in self.words])

    def hits(self, h: np.ndarray) -> np.ndarray:
        """Places in ``h`` whose hash is in the set."""
        maybe = np.flatnonzero(self.bits[(h & self.mask).astype(np.int64)])
        if not len(maybe) or not len(self.grams):
            return maybe[:0]
        k = np.minimum(np.searchsorted(self.grams, h[maybe]), len(self.grams) - 1)
        return maybe[self.grams[k] == h[maybe]]


def edit_distance(a: np.ndarray, b: np.ndarray) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a.tolist()):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b.tolist()):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return row[-1]


def agreement(item: np.ndarray, words: list[tuple[int, int]], doc: np.ndarray, diagonals: list[int], least_words: int) -> list[tuple[int, int, int]]:
    """(words, first, last) of each run of at least ``least_words`` item words found, and the document letters it spans."""
    n = len(item)
    shift = np.full(n, np.iinfo(np.int32).min, np.int64)  # document place less item place of each covered letter
    strength = np.zeros(n, np.int32)
    for d in diagonals:
        lo = d - DRIFT
        padded = np.zeros(n + 2 * DRIFT, np.uint8)
        a, b = max(0, lo), min(len(doc), lo + len(padded))
        if a >= b:
            continue
        padded[a - lo : b - lo] = doc[a:b]
        same = np.lib.stride_tricks.sliding_window_view(padded, n)[: 2 * DRIFT + 1] == item
        run = same[:, : n - RUN + 1].copy()
        for k in range(1, RUN):
            run &= same[:, k : n - RUN + 1 + k]
        cover = np.zeros(same.shape, bool)
        for k in range(RUN):
            cover[:, k : n - RUN + 1 + k] |= run
        value = cover * (1 + cover.sum(axis=1, dtype=np.int32))[:, None]  # of several shifts the one that explains most letters
        best = value.argmax(axis=0)
        value = value[best, np.arange(n)]
        better = value > strength
        strength[better] = value[better]
        shift[better] = best[better] + lo
    covered = strength > 0
    if not words:
        return []
    sums = np.concatenate([[0], np.cumsum(covered)])
    bounds = np.array(words)
    length = bounds[:, 1] - bounds[:, 0]
    sure = (length > 0) & (2 * (sums[bounds[:, 1]] - sums[bounds[:, 0]]) >= length)
    hope = sure.copy()  # with every word that the loop below may add
    hope[1:-1] |= sure[:-2] & (sure[2:] | (length[2:] == 0))
    hope[1:] |= (length[1:] == 0) & hope[:-1]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hope.astype(np.int8), [0]])))
    if (edges[1::2] - edges[::2]).max(initial=0) < least_words:
        return []
    good, number = sure.tolist(), (length == 0).tolist()
    for w, (a, b) in enumerate(words):  # a word between two found ones may be misread more heavily, or be a number
        if good[w] or not 0 < w < len(words) - 1 or not (good[w - 1] and (good[w + 1] or number[w + 1])):
            continue
        if number[w]:
            good[w] = True
            continue
        left, right = np.flatnonzero(covered[:a]), np.flatnonzero(covered[b:])
        if len(left) and len(right):
            x, y = left[-1], b + right[0]
            part = doc[max(0, x + shift[x] + 1) : max(0, y + shift[y])]
            whole = item[x + 1 : y]
            good[w] = abs(len(part) - len(whole)) <= len(whole) // 2 and edit_distance(whole, part) * 2 <= len(whole)
    runs, start = [], None
    for w in range(len(words) + 1):
        if w < len(words) and good[w]:
            start = w if start is None else start
        elif start is not None:
            if w - start >= least_words:
                at = np.flatnonzero(covered[words[start][0] : words[w - 1][1]]) + words[start][0]
                if len(at):
                    place = at + shift[at]
                    first, last = int(place[0]), int(place[-1])
                    runs.append((w - start, first, last) if first <= last else (w - start, int(place.min()), int(place.max())))
            start = None
    return runs


def strands(diagonals: list[int]) -> list[list[int]]:
    """Ascending ``diagonals`` apart where one alignment can't drift to the next: copies of one passage near each other."""
    cuts = [k for k in range(1, len(diagonals)) if diagonals[k] - diagonals[k - 1] > DRIFT]
    return [diagonals[a:b] for a, b in zip([0, *cuts], [*cuts, len(diagonals)])]


def leaks_in(texts: list[str], items: Items, letters: Letters, least_words: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(text number, item number, words, start, end) for each run of an item in a batch of texts."""
    streams = [letters.stream(t) for t in texts]
    if not streams:
        return
    codes = np.concatenate([s[0] for s in streams])
    first = np.concatenate([[0], np.cumsum([len(s[0]) for s in streams])])
    found = items.hits(letters.grams(codes))
    if not len(found):
        return
    doc = np.searchsorted(first, found, side="right") - 1
    inside = found + GRAM <= first[doc + 1]
    found, doc = found[inside], doc[inside]
    h = letters.grams(codes)[found]
    lo, hi = np.searchsorted(items.grams, h, side="left"), np.searchsorted(items.grams, h, side="right")
    reps = hi - lo
    pick = np.repeat(lo, reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
    hit = pd.DataFrame({"doc": np.repeat(doc, reps), "item": items.owner[pick], "place": items.place[pick], "diag": np.repeat(found - first[doc], reps) - items.place[pick]})
    hit = hit.sort_values(["doc", "item", "diag", "place"], kind="stable")
    near = (hit["doc"].diff() == 0) & (hit["item"].diff() == 0) & (hit["diag"].diff() <= JUMP)
    hit["passage"] = (~near).cumsum()
    c = hit.groupby("passage").agg(doc=("doc", "first"), item=("item", "first"), lo=("place", "min"), hi=("place", "max"))
    c = c[c["hi"] - c["lo"] + GRAM >= LEAST_SPAN * items.shortest(least_words)[c["item"].to_numpy()]]
    if not len(c):
        return
    hit = hit[hit["passage"].isin(c.index)]
    for (_, d, i), g in hit.groupby(["passage", "doc", "item"], sort=True):
        diag, last = [], None
        for x in g["diag"].tolist():  # ascending
            if last is None or x - last > DRIFT // 2:
                diag.append(x)
                last = x
        runs = agreement(items.codes[i], items.words[i], streams[d][0], diag, least_words)
        parts = strands(diag)
        if runs and len(parts) > 1:  # a letter of the item has one place in an alignment; its other places are found one strand at a time
            runs = sorted({*runs, *(x for p in parts for x in agreement(items.codes[i], items.words[i], streams[d][0], p, least_words))})
        at = streams[d][1]
        for n, a, b in runs:
            yield int(d), int(i), n, int(at[min(max(a, 0), len(at) - 1)]), int(at[min(max(b, 0), len(at) - 1)]) + 1


def passages(docs: DataFrame, items: DataFrame, least_words: int = 12) -> DataFrame:
    """(doc_id, item_id, words, start, end): every run of at least ``least_words`` consecutive words of an item in a document."""
    some = items.where(F.length("text") > 0).select("item_id", "text").distinct()
    n = max(1, -(-some.count() // ITEM_BLOCK))
    out = None
    for k in range(n):
        rows = sorted((r[0], r[1]) for r in some.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect())  # one block
        block = docs.sparkSession.sparkContext.broadcast(rows)
        part = docs.where(F.length("text") >= GRAM).select("doc_id", "text").mapInPandas(_scan(block, least_words), "doc_id bigint, item_id bigint, words int, start int, end int")
        out = part if out is None else out.unionByName(part)
    return out


def leaks(docs: DataFrame, items: DataFrame, least_words: int = 12) -> DataFrame:
    """(doc_id, item_id, words, start, end): documents that hold ``least_words`` consecutive words of an item, with the longest run."""
    longest = F.max(F.struct("words", (-F.col("start")).alias("s"), "end")).alias("x")
    return passages(docs, items, least_words).groupBy("doc_id", "item_id").agg(longest).select("doc_id", "item_id", "x.words", (-F.col("x.s")).alias("start"), "x.end")


def _scan(block, least_words: int):
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters = Letters()
        items = Items(block.value, letters)
        for b in batches:
            ids, texts, out = b["doc_id"].tolist(), b["text"].tolist(), []
            at = 0
            while at < len(texts):  # about two million characters at a time
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) < 2_000_000):
                    size += len(texts[end])
                    end += 1
                out += [(ids[at + d], items.ids[i], w, s, e) for d, i, w, s, e in leaks_in(texts[at:end], items, letters, least_words)]
                at = end
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "words", "start", "end"])

    return scan


def without_spans(docs: DataFrame, found: DataFrame, least_left: float = 0.5) -> DataFrame:
    """``docs(doc_id, text)`` with leaked spans cut out; a document of which less than ``least_left`` would be left is dropped."""
    spans = found.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    d = docs.select("doc_id", "text").join(spans, "doc_id", "left")
    kept = F.aggregate(
        "spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.concat(a["out"], F.substring("text", a["at"] + 1, F.greatest(F.lit(0), s["start"] - a["at"]))).alias("out"),
        ),
        lambda a: F.concat(a["out"], F.substring("text", a["at"] + 1, F.length("text"))),
    )
    left = F.when(F.col("spans").isNull(), F.col("text")).otherwise(kept)
    return d.select("doc_id", left.alias("clean"), F.length("text").alias("n")).where((F.length("clean") >= least_left * F.col("n")) | (F.col("n") == 0)).select("doc_id", F.col("clean").alias("text"))
