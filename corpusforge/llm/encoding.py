"""Text decoded with the wrong encoding: find it, learn what happened, restore it (problem 4).

Words that hold characters foreign to the corpus languages are joined with clean words on what is left of both
without non-ASCII characters. Such twins are aligned character by character; the aligned runs (what stands in the
garbled word, what stands in the clean one) are counted, and the mappings are inferred from those counts: an
encoding pair where one explains the runs, else the runs themselves as a table, so that a change no encoding
table knows (national 7-bit letters) is learned as well. Words without ASCII letters (Cyrillic) have nothing left
to join on; their twin is the clean word that an encoding pair makes of them. Learned mappings are then applied to
every suspicious word of every record. Words are weighed by the distinct texts that hold them, so copies of a
record have no vote. Cyrillic words garbled into Cyrillic letters are also taken where other words of their own
text support the mapping. ``found_by_records`` does the same with whole records in place of words.

Defined results: null and empty texts are never garbled; words whose characters were lost (U+FFFD, a question
mark before a letter) are reported, and restored where a single clean word fits best; repeated rows are
reported each; foreign letters that no learned mapping explains stay as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

from corpusforge.llm.chars import CYRILLIC_CODECS, CYRILLIC_LETTERS, LATIN_LETTERS, LOOK_ALIKES, OTHER_FORMS, TRANSFORMS, TYPOGRAPHY, skeleton, undo
from corpusforge.runtime import cut, small

#: Distinct words that must support a mapping, or a line of one, before it is applied.
SUPPORT = 3
#: Times a clean word must be as frequent as its garbled form.
RATIO = 3
#: Rounds of decoding taken back from one word.
ROUNDS = 3
#: Letters and digits that a record without its non-ASCII characters needs, to be joined as a whole.
LEAST_SKELETON = 12

_NATIVE = frozenset(LATIN_LETTERS + TYPOGRAPHY)
_CYRILLIC = frozenset(CYRILLIC_LETTERS)
_LOST = r"\x{FFFD}|\?(?=\p{L})"
# Fixed value: ASCII characters whose places national 7-bit alphabets give to letters.
_NATIONAL = r"[@\[\]\\^`{|}~]"
_BESIDE = rf"[A-Za-z]{_NATIONAL}|{_NATIONAL}[A-Za-z]"
_FOREIGN = rf"[^\x00-\x7F{LATIN_LETTERS}{TYPOGRAPHY}]"
#: One class that every odd or lost character falls in; what has none needs no look at the patterns.
_SPECIAL = r"[^\x00->A-Z_a-z]"
_OUTSIDE = rf"{_FOREIGN}|{_BESIDE}|{_LOST}"
#: Words whose odd characters are look-alikes and other forms of ordinary ones only.
_OTHERWISE = "^[" + "".join(LOOK_ALIKES) + OTHER_FORMS + r"\x00-\x7F" + LATIN_LETTERS + TYPOGRAPHY + "]*$"
_EDGE = r"""^[!"#$%&'()*+,./:;<=>@\[\]\\^_`{|}~-]+|[!"#$%&'()*+,./:;<=>?@\[\]\\^_`{|}~-]+$"""
#: Edges of an ASCII word, whose national characters may be letters unless they are brackets around it.
_ASCII_EDGE = r"""^[!"#$%&'()*+,./:;<=>_-]+|[!"#$%&'()*+,./:;<=>?_-]+$"""
_BRACKETS = r"^\{([^{}]*)\}$|^\[([^\[\]]*)\]$|^\|([^|]*)\|$"


class Mapping(NamedTuple):
    """What happened to a text: written in one encoding and read in another, or a table of runs (``written`` is then '')."""

    written: str
    read: str
    table: tuple[tuple[str, str], ...] = ()

    def undone(self, token: str) -> str | None:
        if not self.table:
            return undo(token, self.written, self.read)
        by = dict(self.table)
        new = re.sub("|".join(map(re.escape, sorted(by, key=len, reverse=True))), lambda m: by[m[0]], token)
        return new if new != token else None


def _native(s: str) -> bool:
    return all(c.isascii() or c in _NATIVE for c in s) or all(c.isascii() or c in _CYRILLIC or c in _NATIVE for c in s)


def words(text: Column, pattern: str) -> Column:
    """Words of ``text`` that match ``pattern``, without ASCII punctuation around them."""

    def core(w: Column) -> Column:
        ascii_ = F.regexp_replace(F.regexp_replace(w, _ASCII_EDGE, ""), _BRACKETS, "$1$2$3")
        return F.when(w.rlike(r"[^\x00-\x7F]"), F.regexp_replace(w, _EDGE, "")).otherwise(ascii_)

    cores = F.transform(F.filter(F.split(text, r"[ \t\n\r]+"), lambda w: w.rlike(_SPECIAL) & w.rlike(pattern)), core)
    return F.filter(cores, lambda w: w.rlike(pattern))


def restore_forms(token: str, mappings: list[Mapping]) -> list[tuple[int, str]]:
    """(mapping number, restored form) of each mapping that explains ``token``."""
    out = []
    for k, m in enumerate(mappings):
        new = m.undone(token)
        if new is None:
            continue
        if m.written == "utf-8":
            for _ in range(ROUNDS - 1):
                again = m.undone(new)
                if again is None:
                    break
                new = again
        if _native(new) or (m.written == "utf-8" and "�" not in new):
            out.append((k, new))
    return out


def aligned(garbled: str, clean: str) -> list[tuple[str, str]] | None:
    """Runs of two texts with one skeleton that differ, paired between the ASCII letters and digits they share; None if they don't align."""

    def parts(s: str) -> tuple[list[str], list[str]]:
        ascii_, runs = [], [""]
        for c in s:
            if c.isascii() and c.isalnum():
                ascii_.append(c.lower())
                runs.append("")
            else:
                runs[-1] += c
        return ascii_, runs

    (a, x), (b, y) = parts(garbled), parts(clean)
    if a != b or any(bool(p) != bool(q) for p, q in zip(x, y)):
        return None
    out = []
    for p, q in zip(x, y):
        while p and q and p[0] == q[0]:  # what both have, a space or comma, tells nothing
            p, q = p[1:], q[1:]
        while p and q and p[-1] == q[-1]:
            p, q = p[:-1], q[:-1]
        if p or q:
            out.append((p, q))
    return out


def _evidence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Differing runs of aligned twins."""
    for b in batches:
        out = [(g, c, skel) for token, clean, skel in zip(b["token"], b["clean"], b["skel"]) for g, c in aligned(token, clean) or [] if g and c]
        yield pd.DataFrame(out, columns=["garbled", "plain", "skel"])


def run_counts(twins: DataFrame) -> dict[tuple[str, str], int]:
    """How many distinct skeletons show each (garbled run, clean run) of ``twins(token, clean, skel)``, at least SUPPORT.

    A line per run of characters that several words show: the alphabets bound it, not the records.
    """
    runs = twins.select("token", "clean", "skel").mapInPandas(_evidence, "garbled string, plain string, skel string")
    counted = runs.groupBy("garbled", "plain").agg(F.count_distinct("skel").alias("n")).where(F.col("n") >= SUPPORT)
    best = counted.groupBy("garbled").agg(F.max_by(F.struct("plain", "n"), F.struct("n", "plain")).alias("b"), F.sum("n").alias("all"))
    # a run that stands for many others, as a misread one may, maps to none
    return {(r["garbled"], r["plain"]): r["n"] for r in best.where("2 * b.n > all").select("garbled", "b.*").collect()}


def _explains(w: str, r: str, garbled: str, plain: str) -> bool:
    new = undo(garbled, w, r)
    return new == plain or (w == "utf-8" and new is not None and undo(new, w, r) == plain)


def inferred(runs: dict[tuple[str, str], int], by_word: dict[int, int]) -> list[Mapping]:
    """Mappings that explain the counted runs: encoding pairs, the one that explains most first, then a table of what is left.

    ``by_word`` adds the words that each pair of TRANSFORMS explains without any run.
    """
    open_, out, left = dict(runs), [], dict(by_word)
    while True:
        support = {k: left.get(k, 0) + sum(n for (g, c), n in open_.items() if _explains(w, r, g, c)) for k, (w, r) in enumerate(TRANSFORMS)}
        k = max(support, key=lambda k: (support[k], -k))
        if support[k] < SUPPORT:
            break
        w, r = TRANSFORMS[k]
        out.append(Mapping(w, r))
        left[k] = 0
        open_ = {x: n for x, n in open_.items() if not _explains(w, r, *x)}
    table = sorted((g, c) for (g, c), n in open_.items() if n >= SUPPORT and len(c) == 1 and c in LATIN_LETTERS and len(g) == 1)
    return out + ([Mapping("", "", tuple(table))] if len(table) > 1 else [])


def _forms(mappings: list[Mapping], numbers: list[int] | None = None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(t, n, numbers[k] if numbers else k, f) for t, n in zip(b["token"], b["n"]) for k, f in restore_forms(t, mappings)]
            yield pd.DataFrame(out, columns=["token", "n", "k", "form"])

    return run


@F.pandas_udf(StringType())
def _skeletons(s: pd.Series) -> pd.Series:
    return s.map(skeleton)


def _alike() -> Column:
    """Tokens whose odd characters are other forms of ordinary ones: another matter than encoding."""
    return F.col("token").rlike(_OTHERWISE) & F.col("token").rlike(_FOREIGN)


def vocabulary(records: DataFrame, text: str = "text") -> DataFrame:
    """(token, n, odd): distinct words with characters beyond ASCII, letters' places or lost characters, and the distinct texts that hold each; ``odd`` words hold characters foreign to the corpus."""
    some = rf"[^\x00-\x7F]|{_BESIDE}|{_LOST}"
    texts = records.where(F.col(text).rlike(some)).select(F.col(text).alias("t")).distinct()
    w = texts.select(F.explode(F.array_distinct(words(F.col("t"), some))).alias("token"))
    return w.groupBy("token").agg(F.count("*").alias("n")).withColumn("odd", F.col("token").rlike(_OUTSIDE))


def learned(vocab: DataFrame) -> tuple[list[Mapping], DataFrame]:
    """The learned mappings, and the (token, clean, n) twins."""
    odd = vocab.where("odd").withColumn("skel", _skeletons("token"))
    clean = vocab.where("not odd").withColumn("skel", _skeletons("token")).where(F.length("skel") >= 2).select("skel", F.col("token").alias("clean"), F.col("n").alias("clean_n"))
    twins = cut(odd.where((F.length("skel") >= 2) & F.col("token").rlike(r"[a-zA-Z]")).join(clean, "skel").where("clean_n >= n"))
    runs = run_counts(twins.where(~_alike() & ~F.col("token").rlike(_LOST)))
    # words without ASCII letters: their twin is the clean word that an encoding pair makes of them
    numbers = [k for k, (w, _) in enumerate(TRANSFORMS) if w in ("utf-8", *CYRILLIC_CODECS)]
    bare = odd.where(~F.col("token").rlike(r"[a-zA-Z]") & (F.length("token") >= 3)).select("token", "n")
    made = bare.mapInPandas(_forms([Mapping(*TRANSFORMS[k]) for k in numbers], numbers), "token string, n bigint, k int, form string")
    known = vocab.select(F.col("token").alias("form"), F.col("n").alias("form_n"))
    by_word = made.join(known, "form").where(f"form_n >= {RATIO} * n and form rlike '^[А-ЯЁ]?[а-яё]+$'").groupBy("k").agg(F.count_distinct("token").alias("n"))
    return inferred(runs, {r["k"]: r["n"] for r in by_word.collect()}), twins  # at most one line per encoding pair


def _fits_case(token: str, form: str) -> bool:
    """A restored letter is upper-case only where the word's other letters allow it."""
    rest = [c for c in token if c.isascii() and c.isalpha()]
    new = [c for c in form if not c.isascii() and c.isalpha()]
    if len(rest) >= 2 and all(c.isupper() for c in rest):
        return all(not c.islower() for c in new)
    if any(c.islower() for c in rest) or not rest and len(new) >= 2 and new[0].islower():
        first = next((c for c in form if c.isalpha()), "")
        return not any(c.isupper() for c in (new[1:] if new and new[0] == first else new))
    return True


@F.pandas_udf(BooleanType())
def _fits(token: pd.Series, form: pd.Series) -> pd.Series:
    return pd.Series([_fits_case(a, b) for a, b in zip(token, form)], dtype=bool)


def garbled_words(records: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame | None]:
    """(token, form) of the distinct words that are garbled wherever they stand, the form null where it can't be known; and (token, k, form, strong) of Cyrillic words that are garbled in a text where others support transformation k."""
    vocab = cut(vocabulary(records, text))
    mappings, twins = learned(vocab)
    odd = vocab.where("odd")
    lost = F.col("token").rlike(_LOST)
    lost_form = twins.where(lost & (F.length("token") == F.length("clean"))).groupBy("token").agg(F.max_by("clean", F.struct("clean_n", "clean")).alias("form"))
    gone = odd.where(lost).select("token").join(lost_form, "token", "left")
    if not mappings:
        return gone, None
    known = vocab.where("not odd or token rlike '^[А-Яа-яЁё]+$'").groupBy(F.lower("token").alias("low")).agg(F.sum("n").alias("form_n"))
    made = odd.where(~lost).select("token", "n").mapInPandas(_forms(mappings), "token string, n bigint, k int, form string")
    made = cut(made.withColumn("low", F.lower("form")).join(known, "low", "left").fillna(0, ["form_n"]))
    from_utf8 = F.col("k").isin([k for k, m in enumerate(mappings) if m.written == "utf-8"])
    from_table = F.col("k").isin([k for k, m in enumerate(mappings) if m.table])
    cyrillic_only = F.col("token").rlike("^[А-Яа-яЁё]+$")
    in_words = (F.col("form_n") >= F.lit(RATIO) * F.col("n")) & (F.length("form") >= 3)
    letters_fit = ~F.col("token").rlike(r"^[\p{L}\p{M}]*$") | F.col("token").rlike("[a-zA-Z].*[a-zA-Z]")
    all_cyrillic = F.col("form").rlike("^[А-ЯЁ]?[а-яё]+$") & (F.length("form") >= 2)
    good = F.when(from_utf8, F.lit(True)).when(cyrillic_only, in_words).when(_alike(), F.lit(False)).when(from_table, in_words | ((F.col("form_n") >= F.lit(RATIO) * F.col("n")) & (F.length("form") >= 2))).otherwise(in_words | all_cyrillic | (letters_fit & ~F.col("form").rlike("[А-Яа-яЁё]")))
    good = good & (from_utf8 | _fits("token", "form"))
    rank = F.struct(F.col("form_n"), from_utf8, -F.length("form"), -F.col("k"))
    fixed = made.where(good).groupBy("token").agg(F.max_by("form", rank).alias("form"))
    usual = "^[А-ЯЁ]?[а-яё]+$"
    plain = vocab.where(F.col("token").rlike(usual)).select(F.lower("token").alias("own")).distinct()
    likely = made.where(cyrillic_only & F.col("form").rlike(usual) & _fits("token", "form")).withColumn("own", F.lower("token")).join(plain, "own", "left_anti")
    return fixed.unionByName(gone), likely.select("token", "k", "form", ((F.col("form_n") >= RATIO) & (F.length("form") >= 3)).alias("strong"))


def garbled_records(records: DataFrame, id_col: str = "rec_id", text: str = "text", extra: list[str] | None = None, of: DataFrame | None = None) -> DataFrame:
    """(id, token, form) of every garbled word of every record, or of the records ``of``; what is learned comes from all."""
    bad, likely = garbled_words(records, text)
    bad = cut(bad)
    suspects = (records if of is None else of).where(F.col(text).rlike(_OUTSIDE)).select(id_col, *(extra or []), F.xxhash64(text).alias("__t"), F.explode(F.array_distinct(words(F.col(text), _OUTSIDE))).alias("token"))
    suspects = suspects if extra else cut(suspects)  # narrow, and used twice
    out = suspects.join(bad, "token").select("token", id_col, *(extra or []), "form")
    if likely is None:
        return out
    of_text = suspects.dropDuplicates([id_col, "__t", "token"]).join(cut(likely), "token").groupBy(id_col, "__t", "k").agg(
        F.count_if("strong").alias("n"), F.collect_list(F.struct("token", "form", *(extra or []))).alias("w")
    )
    more = of_text.where(F.col("n") >= SUPPORT).select(id_col, "__t", "k", "n", F.inline("w"))
    more = more.groupBy(id_col, "__t", *(x for x in extra or [] if x != "__t"), "token").agg(F.max_by("form", F.struct("n", -F.col("k"))).alias("form"))
    return out.unionByName(more.join(bad, "token", "left_anti").select("token", id_col, *(extra or []), "form"))


def found(records: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """(rec_id): records, or those among ``of``, whose text, wholly or in part, was decoded with the wrong encoding."""
    return garbled_records(records, of=of).select("rec_id").distinct()


def restored(records: DataFrame) -> DataFrame:
    """(rec_id, text, words, lost): garbled records with every restorable word put right; ``lost`` counts those that can't be."""
    fixes = garbled_records(records, extra=["text"]).groupBy("rec_id", "text").agg(
        F.array_sort(F.collect_list(F.when(F.col("form").isNotNull(), F.struct((-F.length("token")).alias("k"), "token", "form")))).alias("fix"),
        F.count("*").alias("words"), F.count_if(F.col("form").isNull()).alias("lost"),
    )  # a record's own words; longest first, and none inside another word
    escaped = lambda x: F.regexp_replace(x, r"([^\p{L}\p{N}])", r"\\$1")
    whole = lambda x: F.concat(F.lit(r"(?<![\p{L}\p{N}])"), escaped(x), F.lit(r"(?![\p{L}\p{N}])"))
    return fixes.select("rec_id", F.aggregate("fix", F.col("text"), lambda t, f: F.regexp_replace(t, whole(f["token"]), escaped(f["form"]))).alias("text"), "words", "lost")


def found_by_records(records: DataFrame, id_col: str = "rec_id", text: str = "text") -> DataFrame:
    """(id, words): records with words that the mappings learned from whole records change, and how many.

    A record with foreign characters is joined with a clean one that is the same without its non-ASCII characters;
    what their alignment teaches is applied to every record. Of clean records with one skeleton one stands for all.
    """
    skel = F.lower(F.regexp_replace(text, "[^0-9A-Za-z]", ""))
    texts = records.where(F.col(text).rlike(rf"[^\x00-\x7F]|{_BESIDE}")).select(F.col(text).alias("token"), F.when(F.length(skel) >= LEAST_SKELETON, F.xxhash64(skel)).alias("key"), F.col(text).rlike(_OUTSIDE).alias("odd"))
    texts = texts.where("key is not null")
    # whole twins are rare: the keys are joined first, and texts are fetched for those alone that both sides have
    keys = cut(texts.groupBy("key").agg(F.max("odd").alias("odd"), F.min("odd").alias("all_odd")).where("odd and not all_odd").select("key"))
    some = texts.join(small(keys), "key", "left_semi")
    clean = some.where("not odd").groupBy("key").agg(F.min("token").alias("clean"))
    mappings = inferred(run_counts(some.where("odd").join(clean, "key").withColumn("skel", F.col("key").cast("string"))), {})
    if not mappings:
        return records.select(id_col, F.lit(0).cast("bigint").alias("words")).limit(0)
    suspects = records.where(F.col(text).rlike(_OUTSIDE)).select(id_col, F.explode(F.array_distinct(words(F.col(text), _OUTSIDE))).alias("token"))
    tokens = suspects.where(~_alike() & ~F.col("token").rlike("^[А-Яа-яЁё]+$")).select("token", F.lit(1).cast("bigint").alias("n")).distinct()
    made = tokens.mapInPandas(_forms(mappings), "token string, n bigint, k int, form string").where(_fits("token", "form")).select("token").distinct()
    return suspects.join(made, "token").groupBy(id_col).agg(F.count("*").alias("words"))
