"""Answers cut off before the text they transcribe ends (problem 6), in SQL alone.

``by_trigrams`` is the named method: every reference is cut into word trigrams (with two start marks, so that short
texts have some); for each distinct trigram of the corpus it is counted how often it stands inside a text and how
often at an end; the final trigram of each answer is joined with those counts, and flagged if it is frequent inside
texts and almost never terminal.

Whether an answer is cut is a matter of its own reference, though: a line that stops where its reference does is
whole, however its last words go on elsewhere, and an answer cut inside a word, or misread at its end, has no known
final trigram. So ``truncated`` compares each answer with its reference: the last stretch of the answer that the
reference holds tells where the answer stops in it, and the edit distance of what follows settles the last
characters. It needs no shuffle. Where there is no reference, the trigrams decide.

Defined results: null and blank answers are never truncated; repeated rows are reported each; rows without a source
form the group of null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.folding import plain
from corpusforge.runtime import spread

#: Characters of reference text that must be lost.
LEAST_LOST = 5
#: Times a trigram must stand inside a text, and its share of ends at most to be almost never terminal. Most trigrams
#: of this corpus occur once, so asking for more than once inside leaves nothing.
INSIDE, ENDS = 1, 0.02
#: Characters of one anchor; anchors are tried from the answer's end back, in tiers that begin so far from it.
ANCHOR, TIERS = 12, (0, 30, 150)
#: What a broken-off transfer leaves behind: replacement characters and unfinished escapes.
DEBRIS = r"(?:\x{FFFD}|\\u?[0-9a-fA-F]{0,3}|&#?[0-9a-z]{0,6}|\s)+$"


def reference(df: DataFrame) -> Column:
    """The text an answer transcribes: the assistant's content, else the label."""
    content = F.get("messages", F.lit(1))["content"]
    return F.coalesce(F.nullif(F.trim(content), F.lit("")), F.nullif(F.trim("label"), F.lit("")))


def _marked(words: Column) -> Column:
    return F.concat(F.array(F.lit("^"), F.lit("^")), words)


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), " +"), lambda w: w != "")


def _trigram(w: str, i: Column) -> Column:
    return F.xxhash64(F.get(w, i - 2), F.get(w, i - 1), F.get(w, i))


def trigram_counts(texts: DataFrame) -> DataFrame:
    """(key, inside, at_end) of each distinct trigram of ``texts(words)``."""
    w = texts.select(_marked(F.col("words")).alias("w"))
    n = F.size("w") - 1
    t = w.select(F.explode(F.transform(F.sequence(F.lit(2), n), lambda i: F.struct(_trigram("w", i).alias("key"), (i < n).alias("inside")))).alias("t")).select("t.*")
    return t.groupBy("key").agg(F.count_if("inside").alias("inside"), F.count_if(~F.col("inside")).alias("at_end"))


def by_trigrams(df: DataFrame) -> DataFrame:
    """(result_id, inside, at_end): answers whose final trigram is frequent inside the distinct references and almost never at an end."""
    texts = df.select(_words(reference(df)).alias("words")).where(F.size("words") > 0).distinct()
    final = df.select("result_id", _marked(_words(F.col("answer"))).alias("w")).where(F.size("w") > 2).select("result_id", _trigram("w", F.size("w") - 1).alias("key"))
    hit = final.join(trigram_counts(texts), "key")
    return hit.where((F.col("inside") >= INSIDE) & (F.col("at_end") <= ENDS * (F.col("inside") + F.col("at_end")))).select("result_id", "inside", "at_end")


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with ``value`` computed once a row: the generator keeps the optimizer from copying it into each use."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _anchored(first: str, last: str) -> str:
    """First stretch of the answer, from its end back, that the reference holds: (off, rest), the reference's characters after its last place."""
    rest = f"length(substring_index(ref, substr(answer, length(answer) - o - least({ANCHOR}, length(answer)) + 1, least({ANCHOR}, length(answer))), -1))"
    tried = f"transform(filter(sequence({first}, {last}, 3), o -> o <= length(answer) - least({ANCHOR}, length(answer))), o -> named_struct('off', o, 'rest', {rest}))"
    return f"get(filter({tried}, t -> t.rest < length(ref)), 0)"


def truncated(df: DataFrame, least_lost: int = LEAST_LOST) -> DataFrame:
    """(result_id, lost): answers of which more than ``least_lost`` characters of text are missing at the end; lost is null without a reference."""
    rows = spread(df).select("result_id", F.col("answer").alias("raw"), reference(df).alias("ref")).where(F.col("answer").rlike(r"[^\s\p{Z}]"))
    some = rows.where("ref is not null").select("result_id", plain(F.regexp_replace("raw", DEBRIS, "")).alias("answer"), plain(F.col("ref")).alias("ref"))
    some = _once(some.select("result_id", F.struct("answer", "ref").alias("t")), "u", F.col("t")).select("result_id", "u.*")
    tiers = [_anchored(str(lo), f"least({hi - 1}, length(answer))" if hi else "length(answer)") for lo, hi in zip(TIERS, [*TIERS[1:], None])]
    tried = [f"if(length(answer) >= {lo}, {t}, null)" for lo, t in zip(TIERS, tiers)]
    hit = _once(some, "hit", F.expr(f"coalesce({', '.join(tried)})"))
    # the answer's tail behind the anchor against as much of the reference: the prefix nearest to it
    near = _once(hit, "near", F.expr("named_struct('tail', right(answer, hit.off), 'behind', left(right(ref, hit.rest), hit.off + 6))"))
    fit = near.withColumn("best", F.expr(
        "array_min(transform(sequence(greatest(0, hit.off - 6), hit.off + 6), k -> "
        "named_struct('d', levenshtein(near.tail, left(near.behind, k)), 'away', abs(k - hit.off), 'k', k)))"
    ))
    lost = F.expr("case when hit is null then length(ref) - length(answer) when hit.off = 0 then hit.rest else hit.rest - least(best.k, hit.rest) end")
    done = fit.withColumn("lost", lost)
    # an anchor may have been found in another place: then the ends agree better than a loss of so much allows
    apart = F.expr("levenshtein(right(answer, 40), right(ref, 40)) >= least(0.9 * lost, 18)")
    aligned = done.where((F.col("lost") > least_lost) & apart).select("result_id", F.col("lost").cast("bigint").alias("lost"))
    bare = df.where(reference(df).isNull())
    alone = bare.select("result_id").join(by_trigrams(df).select("result_id").distinct(), "result_id", "left_semi").select("result_id", F.lit(None).cast("bigint").alias("lost"))
    return aligned.unionByName(alone)


def rates(df: DataFrame) -> DataFrame:
    """(source, answers, truncated, rate) over the non-empty answers."""
    cut = truncated(df).select("result_id").withColumn("cut", F.lit(1))
    a = df.where(F.col("answer").rlike(r"[^\s\p{Z}]")).select("result_id", "source").join(cut, "result_id", "left")
    return a.groupBy("source").agg(F.count("*").alias("answers"), F.count("cut").alias("truncated"), (F.count("cut") / F.count("*")).alias("rate"))
