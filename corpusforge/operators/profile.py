"""Dataset profile and mixture: text statistics, category shares, samples, probabilities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusforge.functions import text as T
from corpusforge.operators.ranking import floor_percentiles


def shares(df: DataFrame, by: str) -> DataFrame:
    """(by, n, percent): the window runs over the groups, not the rows."""
    n = df.groupBy(by).agg(F.count("*").alias("n"))
    return n.withColumn("percent", F.col("n") * 100 / F.sum("n").over(Window.partitionBy(F.lit(1))))


def length_profile(df: DataFrame, by: list[str], text: str = "text") -> DataFrame:
    """Characters and words: total, mean over all rows; least, most and floor-index quartiles over the non-empty."""
    t = df.select(*by, F.length(text).alias("chars"), F.size(T.words(F.col(text))).alias("n_words"), (F.coalesce(F.length(text), F.lit(0)) > 0).alias("some"))
    aggs = [F.count("*").alias("n")]
    for c in ("chars", "n_words"):
        v = F.when(F.col("some"), F.col(c))
        aggs += [F.sum(v).alias(f"{c}_total"), (F.coalesce(F.sum(v), F.lit(0)) / F.count("*")).alias(f"{c}_mean"), F.min(v).alias(f"{c}_min"), F.max(v).alias(f"{c}_max")]
    out = t.groupBy(*by).agg(*aggs)
    for c in ("chars", "n_words"):
        q = floor_percentiles(t.where("some"), by, c, [25, 50, 75])
        q = q.select(*by, *[F.col(f"p{p}").alias(f"{c}_p{p}") for p in (25, 50, 75)])
        out = out.join(q, by, "left") if by else out.crossJoin(q)  # one row each
    return out


def png_size(image: str = "image.bytes") -> list:
    """Width and height from the PNG header, without decoding."""
    b = F.col(image)
    ok = F.substr(F.hex(F.substring(b, 1, 8)), F.lit(1), F.lit(16)) == "89504E470D0A1A0A"
    number = lambda at: F.when(ok, F.conv(F.hex(F.substring(b, at, 4)), 16, 10).cast("bigint"))
    return [number(17).alias("width"), number(21).alias("height"), F.octet_length(b).alias("bytes")]


def seeded_sample(df: DataFrame, key: str, n: int, seed: str = "42") -> DataFrame:
    """Exactly n rows, the same for the same seed on any cluster."""
    return df.orderBy(F.md5(F.concat(F.lit(seed), F.col(key).cast("string"))), key).limit(n)


def first_per_source(df: DataFrame, source: str, key: str, n: int) -> DataFrame:
    """The first n rows of each source; rows are cut per hash bucket before the window of a source."""
    b = F.pmod(F.xxhash64(key), F.lit(64))
    part = df.withColumn("__b", b).withColumn("__r", F.row_number().over(Window.partitionBy(source, "__b").orderBy(key))).where(F.col("__r") <= n)
    return part.withColumn("__r", F.row_number().over(Window.partitionBy(source).orderBy(key))).where(F.col("__r") <= n).drop("__b", "__r")


MODES = {"proportional": lambda n: n, "equal": lambda n: F.lit(1.0), "sqrt": lambda n: F.sqrt(n), "inv_sqrt": lambda n: 1 / F.sqrt(n)}


def probabilities(df: DataFrame, by: str, mode: str) -> DataFrame:
    """(by, n, prob) over the groups of ``df``."""
    n = df.groupBy(by).agg(F.count("*").alias("n")).withColumn("w", MODES[mode](F.col("n")).cast("double"))
    return n.select(by, "n", (F.col("w") / F.sum("w").over(Window.partitionBy(F.lit(1)))).alias("prob"))


def weighted_sample(df: DataFrame, key: str, weight: str, k: int, seed: str = "42") -> DataFrame:
    """k rows without replacement, chance by weight (exponential keys); rows without positive weight never."""
    u = F.greatest(T.unit_hash(F.concat(F.lit(seed), F.col(key).cast("string"))), F.lit(2.0**-53))
    return df.where(F.col(weight) > 0).withColumn("__k", -F.log(u) / F.col(weight)).orderBy("__k", key).limit(k).drop("__k")
