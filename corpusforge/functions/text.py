"""Text functions as columns: trimming, words, edit-distance metrics, hashes, wrapping, templates."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: White space of every kind, in a class that Java's and RE2's regular expressions share.
WS = r"[\t-\r\x1C-\x1F\x{85}\p{Z}]"


def strip(x: Column) -> Column:
    """Outer white space of any kind removed."""
    return F.regexp_replace(x, f"^{WS}+|{WS}+$", "")


def is_blank(x: Column) -> Column:
    """Null, empty or white space only."""
    return x.isNull() | ~x.rlike(f"[^{WS[1:]}")


def words(x: Column) -> Column:
    """Runs of anything but white space."""
    return F.filter(F.split(x, f"{WS}+"), lambda w: w != "")


def ned(pred: Column, ref: Column) -> Column:
    """Edit distance over the longer length; 0 for two empty texts."""
    return F.coalesce(F.levenshtein(pred, ref) / F.nullif(F.greatest(F.length(pred), F.length(ref)), F.lit(0)), F.lit(0.0))


def error_rate(distance: Column, n_pred: Column, n_ref: Column) -> Column:
    return F.when(n_ref == 0, F.when(n_pred == 0, 0.0).otherwise(1.0)).otherwise(distance / n_ref)


def cer(pred: Column, ref: Column) -> Column:
    """Edit distance over the reference length; an empty reference gives 0 or 1."""
    return error_rate(F.levenshtein(pred, ref), F.length(pred), F.length(ref))


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def edit_distance(a: list, b: list) -> int:
    """Fewest insertions, losses and changes that turn one list into another; a row of the table at a time."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    while len(a) > lo and len(b) > lo and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    a, b = sorted((a[lo:], b[lo:]), key=len)
    if not a:
        return len(b)
    known: dict = {}
    x, y = ([known.setdefault(w, len(known)) for w in s] for s in (a, b))
    y, step = np.array(y), np.arange(len(b) + 1)
    row = step.copy()
    for i, v in enumerate(x):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (y != v), row[1:] + 1)
        row = np.minimum.accumulate(new - step) + step  # a run of insertions from the best place to the left
    return int(row[-1])


@F.pandas_udf(DoubleType())
def word_error_rate(pairs: pd.DataFrame) -> pd.Series:
    """Edit distance of the word lists ``a`` and ``b`` of a struct, of any length, over the size of ``b``; an empty ``b`` gives 0 or 1."""
    rate = lambda p, q: edit_distance(list(p), list(q)) / len(q) if len(q) else float(len(p) > 0)
    return pd.Series([None if p is None or q is None else rate(p, q) for p, q in zip(pairs["a"], pairs["b"])], dtype="float64")


def wer(pred: Column, ref: Column) -> Column:
    """Edit distance in words over the reference's words; an empty reference gives 0 or 1."""
    return word_error_rate(F.struct(words(pred).alias("a"), words(ref).alias("b")))


def unit_hash(x: Column) -> Column:
    """52 bits of the MD5 as a number in [0, 1)."""
    return F.conv(F.substr(F.md5(x), F.lit(1), F.lit(13)), 16, 10).cast("double") / F.lit(float(16**13))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def url_parts(url: Column) -> list[Column]:
    """Scheme, host and last segment of a URL."""
    return [F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1).alias("scheme"), F.regexp_extract(url, r"^[^/]*//([^/?#]*)", 1).alias("host"), base_name(F.regexp_replace(url, "/+$", "")).alias("last")]


def stem(path: Column) -> Column:
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


# Fixed value: the class of symbols.
def symbol_share(x: Column) -> Column:
    """Share of digits and ASCII punctuation among the characters."""
    return F.regexp_count(x, F.lit(r"[0-9!@#$%^&*()_+\-=\[\]{}|;:'\",.<>?/\\`~]")) / F.nullif(F.length(x), F.lit(0))


def valid_corpus_text(x: Column, least: int = 50, most_symbols: float = 0.5) -> Column:
    return (F.length(x) >= least) & (symbol_share(x) <= most_symbols)


def wrapped(x: Column, width: Column) -> Column:
    """Greedy wrap of plain words into lines of at most ``width`` characters; a longer word stands alone."""
    line = lambda a: F.element_at(a, -1)
    put = F.aggregate(
        words(x), F.array().cast("array<string>"),
        lambda a, w: F.when((F.size(a) > 0) & (F.length(line(a)) + 1 + F.length(w) <= width), F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.concat_ws(" ", line(a), w)))).otherwise(F.concat(a, F.array(w))),
    )
    return F.array_join(put, "\n")


def snippet(x: Column, n: int = 80) -> Column:
    return F.replace(F.substr(x, F.lit(1), F.lit(n)), F.lit("\n"), F.lit("\\n"))


def bar(count: Column, total: Column, width: int = 20) -> Column:
    k = F.bround(width * count / total).cast("int")
    return F.concat(F.repeat(F.lit("█"), k), F.repeat(F.lit("░"), F.lit(width) - k))


# The marks of the turns.
def rendered(messages: Column) -> Column:
    """Chat template: user turns, then assistant turns."""
    one = lambda m: F.when(m["role"] == "user", F.concat(F.lit("User: "), m["content"], F.lit("\nAssistant:\n"))).otherwise(F.coalesce(m["content"], F.lit("")))
    return F.array_join(F.transform(messages, one), "")


def image_tokens(frames: Column, height: Column, width: Column, merge: int = 2) -> Column:
    """Tokens of an image whose patches form such a grid, ``merge`` by ``merge`` of them to a token."""
    return F.floor(frames * height * width / (merge * merge)).cast("int")


def expanded(text: Column, tokens: Column, placeholder: str = "<image>", begin: str = "<|begin|>", token: str = "<|tok|>", end: str = "<|end|>") -> Column:
    """Each placeholder replaced by ``tokens`` image tokens between begin and end marks."""
    return F.replace(text, F.lit(placeholder), F.concat(F.lit(begin), F.repeat(F.lit(token), tokens), F.lit(end)))
