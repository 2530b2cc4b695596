"""Seeded text corruption: every choice is a hash of seed, record and position, so any engine repeats it."""

from __future__ import annotations

import hashlib
from functools import cache
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.draws import Draws

# Diacritics and their plain letters; recognition confusions in order.
PLAIN_FROM, PLAIN_TO = "åäöéüšžÅÄÖÉÜŠŽ", "aaoeuszAAOEUSZ"
CONFUSIONS = [
    ("w", "v"), ("W", "V"), ("v", "w"), ("V", "W"), ("ö", "o"), ("Ö", "O"), ("ö", "0"), ("O", "0"), ("0", "O"), ("I", "l"), ("l", "I"), ("1", "l"), ("l", "1"),
    ("rn", "m"), ("m", "rn"), ("rn", "h"), ("cl", "d"), ("vv", "w"),
]
# Fixed values: (low, high) rates of diacritics, confusions, noise, case and digits.
RATES = {
    "light": [(0.2, 0.5), (0.03, 0.10), (0.005, 0.02), (0.0, 0.02), (0.0, 0.03)],
    "medium": [(0.3, 0.7), (0.05, 0.20), (0.01, 0.05), (0.0, 0.04), (0.02, 0.08)],
    "heavy": [(0.5, 0.9), (0.10, 0.30), (0.02, 0.08), (0.01, 0.06), (0.04, 0.12)],
}
# Characters that noise puts in; confusions of one text at most.
NOISE = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZäöåÄÖÅ0123456789"
MOST_CONFUSIONS = 3


def chance(seed: Column, *what: Column) -> Column:
    """Number in [0, 1): 32 bits of an MD5."""
    return F.conv(F.substr(F.md5(F.concat_ws("|", seed, *[w.cast("string") for w in what])), F.lit(1), F.lit(8)), 16, 10).cast("double") / F.lit(float(2**32))


def fold_diacritics(x: Column) -> Column:
    return F.translate(x, PLAIN_FROM, PLAIN_TO)


def _per_char(x: Column, change) -> Column:
    return F.array_join(F.transform(F.split(x, ""), change), "")


def diacritic_swap(x: Column, seed: Column, p: Column) -> Column:
    return _per_char(x, lambda c, i: F.when(chance(seed, F.lit("d"), i) < p, F.translate(c, PLAIN_FROM, PLAIN_TO)).otherwise(c))


def confuse(x: Column, seed: Column, p: Column) -> Column:
    """Confusions tried in an order shuffled by seed, first occurrence each, at most three applied."""
    state = F.struct(x.alias("t"), F.lit(0).alias("k"))
    table = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(i).alias("i")) for i, (a, b) in enumerate(CONFUSIONS)])
    at = lambda s, c: F.call_function("locate", c["a"], s["t"])

    def step(s, c):
        hit = (s["k"] < MOST_CONFUSIONS) & (at(s, c) > 0) & (chance(seed, F.lit("o"), c["i"]) < p)
        swapped = F.concat(F.substr(s["t"], F.lit(1), at(s, c) - 1), c["b"], F.substr(s["t"], at(s, c) + F.length(c["a"])))
        return F.struct(F.when(hit, swapped).otherwise(s["t"]).alias("t"), F.when(hit, s["k"] + 1).otherwise(s["k"]).alias("k"))

    order = F.array_sort(F.transform(table, lambda c: F.struct(F.md5(F.concat_ws("|", seed, F.lit("s"), c["i"].cast("string"))).alias("h"), c["i"].alias("i"), c["a"].alias("a"), c["b"].alias("b"))))
    return F.aggregate(order, state, step, lambda s: s["t"])


def char_noise(x: Column, seed: Column, p: Column) -> Column:
    """Of the chance p: 40 % substitute, 15 % insert before, 45 % delete; one decision a character."""
    def change(c, i):
        u = chance(seed, F.lit("n"), i)
        letter = F.substr(F.lit(NOISE), (F.floor(chance(seed, F.lit("l"), i) * len(NOISE)) + 1).cast("int"), F.lit(1))
        return F.when(u < p * 0.4, letter).when(u < p * 0.55, F.concat(letter, c)).when(u < p, F.lit("")).otherwise(c)

    return _per_char(x, change)


def case_noise(x: Column, seed: Column, p: Column) -> Column:
    return _per_char(x, lambda c, i: F.when(chance(seed, F.lit("c"), i) < p, F.when(c == F.upper(c), F.lower(c)).otherwise(F.upper(c))).otherwise(c))


def digit_swap(x: Column, seed: Column, p: Column) -> Column:
    digit = lambda i: F.floor(chance(seed, F.lit("w"), i) * 10).cast("string")
    return _per_char(x, lambda c, i: F.when(c.rlike("^[0-9]$") & (chance(seed, F.lit("g"), i) < p), digit(i)).otherwise(c))


#: Letters worked on at a time; a longer text is worked on alone.
LETTERS = 1_000_000
# Code points up to here have case; cases newer than Python's tables, that Spark's have.
CASED = 1 << 17
NEW_CASES = [(0x19B, 0xA7DC), (0x264, 0xA7CB), (0x1C8A, 0x1C89), (0xA7CD, 0xA7CC), (0xA7DB, 0xA7DA), *((0x10D70 + k, 0x10D50 + k) for k in range(22))]


@cache
def _cases() -> tuple[np.ndarray, dict[int, list[int]]]:
    """The other case of each code point, itself where it has none; those whose other case is several letters apart."""
    one, several = np.arange(CASED + 1, dtype=np.uint32), {}
    for i in range(CASED):
        c = chr(i)
        x = c.lower() if c == c.upper() else c.upper()
        if len(x) == 1:
            one[i] = ord(x)
        else:
            one[i], several[i] = CASED, [ord(y) for y in x]
    for low, up in NEW_CASES:
        one[low], one[up] = up, low
    return one, several


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def _texts(codes: np.ndarray, n: np.ndarray) -> list[str]:
    x, ends = codes.tobytes().decode("utf-32-le", "surrogatepass"), np.cumsum(n).tolist()
    return [x[a:b] for a, b in zip([0, *ends], ends)]


def _least(p: np.ndarray) -> np.ndarray:
    """The 32 bits of a chance are under this where the chance is under ``p``."""
    return np.ceil(p * 2.0**32).astype(np.uint32)


class _Batch:
    """Texts as code points, one after another, with the length of each; the steps of ``corrupted`` on all of them."""

    def __init__(self, texts: list[str], seeds: list[bytes]):
        self.seeds, self.draws = seeds, Draws(seeds)
        self.put(_codes(texts).copy(), np.array([len(t) for t in texts]))

    def put(self, codes: np.ndarray, n: np.ndarray) -> None:
        self.codes, self.n = codes, n
        self.at = np.arange(len(codes), dtype=np.int32) - np.repeat((np.cumsum(n) - n).astype(np.int32), n)

    def within(self, where: np.ndarray) -> np.ndarray:
        """How many of the ascending places each text has."""
        return np.diff(np.searchsorted(where, np.cumsum(self.n)), prepend=0)

    def grown(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each letter as often as counted, put in place of the letters; where each begins."""
        ends = np.cumsum(counts)
        upto = np.concatenate([[0], ends])[np.cumsum(self.n)]
        codes = np.repeat(self.codes, counts)
        self.put(codes, np.diff(upto, prepend=0))
        return codes, ends - counts

    def few(self, what: bytes, n: int) -> np.ndarray:
        """The chances of n positions of each seed, as 32 bits."""
        k = len(self.seeds)
        return self.draws(what, np.full(k, n), np.tile(np.arange(n), k)).reshape(k, n)

    def some(self, what: bytes, where: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Of these places, those whose chance is under the text's p."""
        n = self.within(where)
        return where[self.draws(what, n, self.at[where]) < np.repeat(_least(p), n)]

    def numbers(self, what: bytes, where: np.ndarray, n: int) -> np.ndarray:
        """A number under n for each of these places."""
        return np.floor(self.draws(what, self.within(where), self.at[where]) / 2.0**32 * n).astype(np.int64)

    def diacritics(self, p: np.ndarray) -> None:
        plain = np.arange(385, dtype=np.uint32)
        plain[[ord(c) for c in PLAIN_FROM]] = [ord(c) for c in PLAIN_TO]
        code = np.minimum(self.codes, 384)
        hit = self.some(b"d|", np.flatnonzero(plain[code] != code), p)
        self.codes[hit] = plain[code[hit]]

    def confusions(self, p: np.ndarray) -> None:
        texts = _texts(self.codes, self.n)
        hits = np.argwhere(self.few(b"o|", len(CONFUSIONS)) < _least(p)[:, None]).tolist()
        for row, group in groupby(hits, lambda h: h[0]):
            ks, t, done = [k for _, k in group], texts[row], 0
            if len(ks) > 1:
                ks.sort(key=lambda k: (hashlib.md5(self.seeds[row] + b"s|%d" % k).digest(), k))
            for a, b in (CONFUSIONS[k] for k in ks):
                if done < MOST_CONFUSIONS and a in t:
                    t, done = t.replace(a, b, 1), done + 1
            texts[row] = t
        self.put(_codes(texts).copy(), np.array([len(t) for t in texts]))

    def noise(self, p: np.ndarray) -> None:
        letters, blank = _codes([NOISE]), (np.cumsum(self.n) - self.n)[self.n == 0]
        if len(blank):  # an empty text has one empty letter
            self.put(np.insert(self.codes, blank, 0), np.maximum(self.n, 1))
            blank += np.arange(len(blank))
        u = self.draws(b"n|", self.n, self.at)
        hit = np.flatnonzero(u < np.repeat(_least(p), self.n))
        u, row = u[hit], np.repeat(np.arange(len(self.n)), self.within(hit))
        put, change = u < _least(p * 0.55)[row], u < _least(p * 0.4)[row]
        letter = letters[self.numbers(b"l|", hit[put], len(NOISE))]
        counts = np.ones(len(self.codes), np.int64)
        counts[hit] = np.where(change, 1, np.where(put, 2, 0))
        counts[blank] = np.isin(blank, hit[put])
        codes, start = self.grown(counts)
        codes[start[hit[put]]] = letter

    def case(self, p: np.ndarray) -> None:
        other, several = _cases()
        code = np.minimum(self.codes, CASED)
        hit = self.some(b"c|", np.flatnonzero(other[code] != code), p)
        old, new = self.codes[hit], other[code[hit]]
        self.codes[hit] = new
        if len(many := np.flatnonzero(new == CASED)):
            counts = np.ones(len(self.codes), np.int64)
            counts[hit[many]] = [len(several[c]) for c in old[many].tolist()]
            codes, start = self.grown(counts)
            for i, c in zip(start[hit[many]].tolist(), old[many].tolist()):
                codes[i : i + len(several[c])] = several[c]

    def digits(self, p: np.ndarray) -> None:
        hit = self.some(b"g|", np.flatnonzero((self.codes >= 48) & (self.codes <= 57)), p)
        self.codes[hit] = 48 + self.numbers(b"w|", hit, 10)

    def corrupted(self, rates: list[tuple[float, float]]) -> list[str]:
        r = self.few(b"r|", len(rates)) / 2.0**32
        for k, (step, (lo, hi)) in enumerate(zip((self.diacritics, self.confusions, self.noise, self.case, self.digits), rates)):
            step(lo + (hi - lo) * r[:, k])
        return _texts(self.codes, self.n)


def _corrupt(texts: list[bytes | None], seeds: list[bytes], rates: list[tuple[float, float]]) -> list[bytes | None]:
    """``corrupted`` on lists: texts with seeds of one length at a time, of so many letters."""
    out: list = [None] * len(texts)
    plain = {i: t.decode("utf-8", "surrogateescape") for i, t in enumerate(texts) if t is not None}
    for _, group in groupby(sorted(plain, key=lambda i: len(seeds[i])), lambda i: len(seeds[i])):
        part, size = [], 0
        for i in [*group, None]:
            if part and (i is None or size + len(plain[i]) > LETTERS):
                for j, x in zip(part, _Batch([plain[j] for j in part], [seeds[j] for j in part]).corrupted(rates)):
                    out[j] = x.encode("utf-8", "surrogateescape")
                part, size = [], 0
            if i is not None:
                part.append(i)
                size += len(plain[i])
    return out


def corrupted(x: Column, seed: Column, intensity: str = "medium") -> Column:
    """All five in order, each at a rate drawn from its range; the draws of a batch are made together."""
    rates = RATES[intensity]

    @F.pandas_udf("binary")
    def run(texts: pd.Series, seeds: pd.Series) -> pd.Series:
        return pd.Series(_corrupt(texts.tolist(), seeds.tolist(), rates), dtype=object)

    return run(x.cast("binary"), F.coalesce(F.concat(seed, F.lit("|")), F.lit("")).cast("binary")).cast("string")


def variants(df: DataFrame, label: str, key: str, n: int, intensity: str = "light") -> DataFrame:
    """Up to n corruptions a row as ``rejected``, those empty or equal to the label dropped."""
    d = df.withColumn("variant", F.explode(F.sequence(F.lit(1), F.lit(n))))
    d = d.select("*", F.explode(F.array(corrupted(F.col(label), F.concat_ws("#", F.col(key).cast("string"), F.col("variant").cast("string")), intensity))).alias("rejected"))  # the generator keeps it computed once
    return d.where((F.col("rejected") != "") & (F.col("rejected") != F.col(label)))
