"""Splitting oversized texts at natural boundaries (problem 10).

One regular expression with a bounded quantifier cuts a text: its alternatives take as many characters as the
limit allows up to a paragraph end, else a sentence end, else white space, else the bare limit. The limit in
characters is the text's own: the fewest characters that any run of so many tokens spans, so no piece can
exceed the token limit. Each piece then looks back over the end of the one before it by the wanted tokens.

Defined results: texts within the limit, empty and null texts give no piece; pieces without their overlap
concatenate to the text exactly; extra columns are ignored; repeated rows give repeated pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.tokens import counter, vocabulary_path

#: Tokens that cutting inside or beside a tokenizer cut can add at the two ends of a piece.
SEAM_TOKENS = 24
#: A stronger boundary is taken only if it leaves at least this share of the limit in the piece.
LEAST_FILL = 0.5


def measured(docs: DataFrame, limit: int, core: int, path: str) -> DataFrame:
    """``docs(doc_id, text)`` of more than ``limit`` tokens, with ``n_tokens`` and ``span``, the characters a piece may have.

    A byte-level vocabulary never has more tokens than bytes, so texts of at most ``limit`` bytes stay in the JVM.
    """

    @F.pandas_udf("n_tokens int, span int")
    def measure(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = counter(path)
        for t in texts:
            yield pd.DataFrame([c.tightest(x, core) for x in t], columns=["n_tokens", "span"], dtype="int32")

    long = docs.where(F.octet_length("text") > limit).select("doc_id", "text")
    return long.withColumn("m", measure("text")).where(F.col("m.n_tokens") > limit).select("doc_id", "text", "m.n_tokens", "m.span")


def boundary_pattern(span):
    """Regular expression that takes up to ``span`` characters to the strongest boundary, as a column of ``span``."""
    n = span.cast("string")
    least = F.greatest(F.lit(1), (span * LEAST_FILL).cast("int")).cast("string")
    some = F.concat(F.lit("[\\s\\S]{"), least, F.lit(","))
    return F.concat(
        F.lit("[\\s\\S]{1,"), n, F.lit("}\\z|"),
        some, n, F.lit("}(?<=\\n[ \\t]{0,8}\\n)(?!\\n)|"),
        some, n, F.lit("}(?<=[.!?\u2026][\\p{Pf}\\p{Pe}\"']{0,2}\\s{1,4})(?!\\s)|"),
        F.lit("[\\s\\S]{1,"), n, F.lit("}(?<=\\s)(?!\\s)|"),
        F.lit("[\\s\\S]{1,"), n, F.lit("}"),
    )


def split_long(docs: DataFrame, limit: int = 4096, overlap: int = 128, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, cores ARRAY<STRING>): the cores of each text over ``limit`` tokens, in order, without overlap."""
    long = measured(docs, limit, limit - overlap - SEAM_TOKENS, path or vocabulary_path())
    return long.select("doc_id", "n_tokens", F.regexp_extract_all("text", boundary_pattern(F.col("span")), F.lit(0)).alias("cores"))


def pieces(docs: DataFrame, limit: int = 4096, overlap: int = 128, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, piece_no, n_pieces, start, overlap_chars, text) of each text over ``limit`` tokens."""
    path = path or vocabulary_path()

    @F.pandas_udf("int")
    def lookback(ends: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = counter(path)
        for t in ends:
            yield pd.Series([c.tail(x, overlap) if x else 0 for x in t], dtype="int32")

    cores = split_long(docs, limit, overlap, path).withColumn(
        "starts", F.aggregate("cores", F.array(F.lit(0)), lambda a, c: F.concat(a, F.array(F.element_at(a, -1) + F.length(c))))
    )
    parts = F.transform(
        F.sequence(F.lit(1), F.size("cores")),
        lambda i: F.struct(
            i.alias("piece_no"), F.get("starts", i - 1).alias("start"), F.get("cores", i - 1).alias("core"),
            F.coalesce(F.right(F.get("cores", i - 2), F.lit(16 * overlap)), F.lit("")).alias("end_before"),
        ),
    )
    p = cores.select("doc_id", "n_tokens", F.size("cores").alias("n_pieces"), F.explode(parts).alias("p")).select("doc_id", "n_tokens", "n_pieces", "p.*")
    p = p.withColumn("overlap_chars", lookback("end_before"))
    return p.select(
        "doc_id", "n_tokens", "piece_no", "n_pieces", (F.col("start") - F.col("overlap_chars")).alias("start"), "overlap_chars",
        F.concat(F.expr("right(end_before, overlap_chars)"), "core").alias("text"),
    )
