"""Visually identical text with different characters brought to one form (problem 2).

``normalise`` composes by compatibility (NFKC), folds case fully, turns every white space but tab and line
break into an ordinary space, drops default-ignorable characters and replaces look-alike letters inside words
of another script. ``deviation`` tells which of these a value needs, case aside. Both run once per distinct
value of an Arrow batch, and values made of ordinary characters only never leave the JVM for the latter.

Defined results: null stays null, empty stays empty; tabs, line breaks, repeated and outer spaces, quotation
marks, dashes and whole words in one script are left as they are; repeated rows get equal results.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from corpusforge.llm.chars import CYRILLIC_LETTERS, LATIN_LETTERS, LOOK_ALIKES, TYPOGRAPHY

# Unicode's default-ignorable code points.
IGNORABLE = "­͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯ㅤ︀-️﻿ﾠ￰-￸\U000e0000-\U000e0fff\U0001bca0-\U0001bca3\U0001d173-\U0001d17a"
SPACES = "\u0085   -     　"

#: Kinds of deviation, as bits.
COMPATIBILITY, COMPOSITION, INVISIBLE, SPACE, SCRIPT = 1, 2, 4, 8, 16

_IGNORABLE = re.compile(f"[{IGNORABLE}]")
_SPACES = re.compile(f"[{SPACES}]")
_WORD = re.compile(r"[^\W\d_]+")
_OTHER_SCRIPT = re.compile("[Ͱ-ϿЀ-ԯ]")
_LATIN = re.compile("[A-Za-zÀ-ɏ]")
#: Values without any character outside this class need nothing but case folding.
ORDINARY = rf"[^\x00-\x7F{LATIN_LETTERS}{TYPOGRAPHY.replace('…', '')}]"


def _one_script(m: re.Match) -> str:
    """A word of mixed script in the script of most letters that have no look-alike; Latin on a tie."""
    w = m[0]
    if not _OTHER_SCRIPT.search(w) or not _LATIN.search(w):
        return w
    own = sum(c in CYRILLIC_LETTERS and c not in LOOK_ALIKES for c in w)
    if own > sum(bool(_LATIN.match(c)) and c not in _TO_CYRILLIC for c in w):
        return "".join(_TO_CYRILLIC.get(c, c) for c in w)
    return "".join(LOOK_ALIKES.get(c, c) for c in w)


_TO_CYRILLIC = {v: k for k, v in reversed(LOOK_ALIKES.items()) if k in CYRILLIC_LETTERS}


@lru_cache(maxsize=None)
def _compatible(c: str) -> bool:
    """A compatibility form of an ordinary letter, digit or mark; spacing accents and dots are not."""
    k = unicodedata.normalize("NFKC", c)
    return k != c and k[0] != " " and c not in "…´¨¸·" and unicodedata.category(c)[0] in "LNPS"


def visible(text: str) -> str:
    """``text`` in one form, case kept."""
    if text.isascii():
        return text
    t = _SPACES.sub(" ", _IGNORABLE.sub("", text))
    t = unicodedata.normalize("NFKC", t)
    if _OTHER_SCRIPT.search(t):
        t = unicodedata.normalize("NFKC", _WORD.sub(_one_script, t))
    return t


def normalised(text: str) -> str:
    """``text`` in the form that equal-looking values share."""
    t = visible(text).casefold()
    return t if t.isascii() else unicodedata.normalize("NFKC", t)


def deviations(text: str) -> int:
    """Bits of what ``normalised`` changes besides case."""
    if text.isascii():
        return 0
    bits = INVISIBLE * bool(_IGNORABLE.search(text)) | SPACE * bool(_SPACES.search(text))
    bare = _SPACES.sub(" ", _IGNORABLE.sub("", text))
    nfc = unicodedata.normalize("NFC", bare)
    if len(nfc) < len(bare):
        bits |= COMPOSITION
    if any(map(_compatible, {c for c in bare if c > "\x7f"})):
        bits |= COMPATIBILITY
    if _OTHER_SCRIPT.search(nfc):
        k = unicodedata.normalize("NFKC", nfc)
        if any(_OTHER_SCRIPT.search(w) and _LATIN.search(w) for w in _WORD.findall(k)):
            bits |= SCRIPT
    return bits


def _per_value(f, values: pd.Series) -> pd.Series:
    codes, distinct = pd.factorize(values, use_na_sentinel=True)
    done = pd.Series([f(x) for x in distinct] + [None], dtype="object")
    return pd.Series(done.to_numpy()[codes], index=values.index)  # code -1 picks the None


@F.pandas_udf(StringType())
def _normalise(values: pd.Series) -> pd.Series:
    return _per_value(normalised, values)


@F.pandas_udf(IntegerType())
def _deviation(values: pd.Series) -> pd.Series:
    return _per_value(deviations, values).astype("Int32")


def normalise(text: Column) -> Column:
    """Column of normal forms; an ASCII value has only its case to fold and stays in the JVM."""
    return F.coalesce(_normalise(F.when(text.rlike(r"[^\x00-\x7F]"), text)), F.lower(text))


def deviating(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, text, deviation): rows of ``df`` whose ``text`` is not in normal form, case aside."""
    some = df.where(F.col(text).rlike(ORDINARY)).select(F.col(id_col), F.col(text), _deviation(text).alias("deviation"))
    return some.where("deviation > 0")
