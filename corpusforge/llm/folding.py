"""Column functions that reduce text to a coarse form for matching, in SQL only."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusforge.llm.chars import LOOK_ALIKES

#: Characters that recognition confuses, each with the one kept.
CONFUSED = {"0": "o", "1": "l", "5": "s"}


def _translation() -> tuple[str, str]:
    pairs = {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)} | {"\u3000": " "}
    for c in map(chr, range(0xC0, 0x180)):
        base = unicodedata.normalize("NFD", c)[0]
        if base != c and base.isascii():
            pairs[c] = base
    pairs |= {c: " " for c in "\u00a0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\t\n\r\x0b\x0c"}
    pairs |= {k: unicodedata.normalize("NFD", v)[0] for k, v in LOOK_ALIKES.items() if v.isascii()}
    return "".join(pairs), "".join(pairs.values())


_FROM, _TO = _translation()
_DROP = "[\u0300-\u036f\u00ad\u200b-\u200f\u2060-\u2064\ufeff]"


def plain(text: Column) -> Column:
    """Width, accents, look-alikes and invisible characters gone; white space single; ends trimmed; case kept."""
    return F.trim(F.regexp_replace(F.translate(F.regexp_replace(text, _DROP, ""), _FROM, _TO), " {2,}", " "))


def coarse(text: Column) -> Column:
    """``plain``, in lower case, with confused characters merged and everything but letters and spaces gone."""
    return F.trim(F.regexp_replace(F.translate(F.lower(plain(text)), "".join(CONFUSED), "".join(CONFUSED.values())), r"[^\p{L} ]+", ""))
