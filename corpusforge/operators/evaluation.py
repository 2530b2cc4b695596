"""Scores of recognised texts and their reports: summary, percentiles, buckets, sources, worst cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions import text as T
from corpusforge.operators.ranking import interpolated_percentiles
from corpusforge.runtime import cut

INF = float("inf")
# Bucket edges of the reports; a bucket holds lo <= x < hi.
EDGES = {
    "ned": [0, 0.05, 0.1, 0.2, 0.3, 0.5, 1.01],
    "cer": [0, 0.05, 0.1, 0.2, 0.3, 0.5, 1.0, INF],
    "wer": [0, 0.05, 0.1, 0.2, 0.3, 0.5, 1.0, 1.5, 2.0, 5.0, INF],
}
PERCENTILES = [50, 75, 90, 95, 99]


def pairs(df: DataFrame, default_source: str = "unknown") -> DataFrame:
    """(…, pred, ref, image, source): answer default '', label falling back to the assistant's content, first image."""
    ref = F.coalesce(F.nullif("label", F.lit("")), F.get("messages", F.lit(1))["content"], F.lit(""))
    return df.withColumns({"pred": F.coalesce("answer", F.lit("")), "ref": ref, "image": F.get("images", F.lit(0)), "source": F.coalesce("source", F.lit(default_source))})


def scored(df: DataFrame, metrics: tuple[str, ...] = ("ned", "cer", "wer")) -> DataFrame:
    """Pairs with their scores, each computed once; ``exact`` compares the stripped texts."""
    p, r = F.col("pred"), F.col("ref")
    by_char = {"ned", "cer"} & set(metrics)
    d = df.select("*", F.explode(F.array(F.when(p == r, 0).otherwise(F.levenshtein(p, r)))).alias("__d")) if by_char else df  # the quadratic part, once a row
    longest = F.nullif(F.greatest(F.length(p), F.length(r)), F.lit(0))
    rate = F.when(F.length(r) == 0, F.when(F.length(p) == 0, 0.0).otherwise(1.0)).otherwise(F.col("__d") / F.length(r))
    made = {"ned": F.coalesce(F.col("__d") / longest, F.lit(0.0)), "cer": rate}
    d = d.withColumns({m: made[m] for m in made if m in by_char} | {"exact": (T.strip(p) == T.strip(r)).cast("int")}).drop("__d")
    if "wer" not in metrics:
        return d
    # equal texts have no distance; only the others are sent to Python
    differ = F.when(p != r, F.struct(T.words(p).alias("a"), T.words(r).alias("b")))
    return d.select("*", F.explode(F.array(F.coalesce(T.word_error_rate(differ), F.lit(0.0)))).alias("wer"))


def summary(s: DataFrame, metric: str, by: list[str] | None = None) -> DataFrame:
    aggs = [F.count("*").alias("n"), F.avg(metric).alias("mean"), F.stddev_pop(metric).alias("std"), F.avg("exact").alias("exact_match")]
    return s.groupBy(*(by or [])).agg(*aggs)


def percentiles(s: DataFrame, metric: str, by: list[str] | None = None) -> DataFrame:
    """Interpolated percentiles, exact, from a histogram in slices; 0 where there are no rows."""
    p = interpolated_percentiles(s, by or [], metric, PERCENTILES)
    return p.select(*(by or []), *[F.coalesce(f"p{x}", F.lit(0.0)).alias(f"p{x}") for x in PERCENTILES])


def bucket_of(x: Column, edges: list[float]) -> Column:
    """Number of the half-open bucket of ``x``, null outside."""
    out = None
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        hit = (x >= lo) & (x < hi)
        out = F.when(hit, i) if out is None else out.when(hit, i)
    return out


def buckets(s: DataFrame, metric: str, edges: list[float] | None = None) -> DataFrame:
    """(lo, hi, n) of every bucket, empty ones too; hi is null for the open end."""
    edges = edges or EDGES[metric]
    table = s.sparkSession.createDataFrame([(i, float(a), None if b == INF else float(b)) for i, (a, b) in enumerate(zip(edges[:-1], edges[1:]))], "b int, lo double, hi double")
    n = s.groupBy(bucket_of(F.col(metric), edges).alias("b")).agg(F.count("*").alias("n"))
    return F.broadcast(table).join(n, "b", "left").select("lo", "hi", F.coalesce("n", F.lit(0)).alias("n"))


def by_source(s: DataFrame) -> DataFrame:
    return s.groupBy("source").agg(F.count("*").alias("n"), *[F.avg(m).alias(m) for m in ("ned", "cer", "wer") if m in s.columns], F.avg("exact").alias("exact_match"))


def with_combined(s: DataFrame, by: str, metric: str) -> DataFrame:
    """One row per group and, with more than one group, one for all."""
    each = s.select(F.explode(F.array(F.struct(F.lit(0).alias("is_total"), F.col(by).alias("g")), F.struct(F.lit(1).alias("is_total"), F.lit(None).cast(s.schema[by].dataType).alias("g")))).alias("x"), metric)
    each = cut(each.select("x.*", metric))
    r = each.groupBy("is_total", "g").agg(F.count("*").alias("n"), F.avg(metric).alias("mean"))
    p = interpolated_percentiles(each, ["is_total", "g"], metric, [90]).select(F.col("is_total").alias("__i"), F.col("g").alias("__g"), "p90")
    r = r.join(p, (F.col("is_total") == F.col("__i")) & F.col("g").eqNullSafe(F.col("__g")), "left")
    return r.select(F.when(F.col("is_total") == 1, "COMBINED").otherwise(F.col("g")).alias(by), "n", "mean", "p90")


def worst(s: DataFrame, n: int, order: str, metric: str = "ned") -> DataFrame:
    """The n worst rows (a top-k, not a sort), ties in input order."""
    return s.orderBy(F.desc(metric), order).limit(n).select(order, metric, T.snippet(F.col("pred")).alias("pred"), T.snippet(F.col("ref")).alias("ref"))
