"""Preference pairs: filter funnel, first-wins, synthetic pairs, caps, oversampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusforge.functions import text as T
from corpusforge.operators.evaluation import pairs
from corpusforge.operators.ranking import rank_in_group
from corpusforge.operators.records import PROMPT
from corpusforge.runtime import cut

NED_RANGE, CER_LEAST = (0.05, 0.7), 0.10
CAP_SHARE = 0.025


def staged(results: DataFrame, index: DataFrame | None = None, ned_min: float = NED_RANGE[0], ned_max: float = NED_RANGE[1], cer_min: float = CER_LEAST) -> DataFrame:
    """Each result with ``stage``, the first test it fails: no_diff, low_ned, missing; else kept.

    The length difference bounds the edit distance from below, so texts too far apart skip the quadratic part.
    ``index(image_name)`` is the set of images that exist; without it none is missing.
    """
    p = pairs(results)
    p = p.withColumn("chosen", T.strip(F.col("ref"))).withColumn("rejected", T.strip(F.col("pred")))
    longest = F.greatest(F.length("chosen"), F.length("rejected"))
    far = F.abs(F.length("chosen") - F.length("rejected")) > F.lit(ned_max) * longest
    differ = F.col("chosen") != F.col("rejected")
    p = p.withColumn("ned", F.when(differ & ~far, T.ned(F.col("rejected"), F.col("chosen"))))
    p = p.withColumn("cer", F.when(F.col("ned").isNotNull(), F.when(F.length("chosen") == 0, 1.0).otherwise(F.col("ned") * longest / F.length("chosen"))))
    p = p.withColumn("image_name", T.base_name(F.col("image")))
    if index is not None:
        known = index.select(F.col("image_name"), F.lit(True).alias("__known")).distinct()
        p = p.join(known, "image_name", "left")
    else:
        p = p.withColumn("__known", F.col("image_name").isNotNull())
    stage = (
        F.when(~differ, "no_diff").when(far | (F.col("ned") < ned_min) | (F.col("ned") > ned_max) | (F.col("cer") < cer_min), "low_ned")
        .when(F.col("__known").isNull() | ~F.col("__known"), "missing").otherwise("kept")
    )
    return p.withColumn("stage", stage).drop("__known")


def first_wins(staged_rows: DataFrame, order: list[str], key: str = "image_name") -> DataFrame:
    """Kept rows of which only the first per image stays; the others get stage dup_image. ``order`` tells all rows of an image apart.

    The first of an image is a minimum, combined before the shuffle, so an image that a third of the rows share is one row.
    """
    kept = F.col("stage") == "kept"
    staged_rows = cut(staged_rows)  # the scores are costly and used twice
    first = staged_rows.where(kept).groupBy(F.col(key).alias("__key")).agg(F.min(F.struct(*order)).alias("__first"))
    d = staged_rows.join(first, kept & (F.col(key) == F.col("__key")), "left")
    return d.withColumn("stage", F.when(kept & (F.struct(*order) != F.col("__first")), "dup_image").otherwise(F.col("stage"))).drop("__key", "__first")


def funnel(rows: DataFrame, by: str) -> DataFrame:
    """Counts per group and stage, one column a stage."""
    stages = ["no_diff", "low_ned", "missing", "dup_image", "kept"]
    return rows.groupBy(by).agg(F.count("*").alias("total"), *[F.count_if(F.col("stage") == s).alias(s) for s in stages])


def pair_record(chosen: Column, rejected: Column, image: Column, category: Column) -> list[Column]:
    """Columns of a preference pair; empty media lists keep their type."""
    turn = lambda role, content: F.array(F.struct(F.lit(role).alias("role"), content.alias("content")))
    none = F.array().cast("array<string>")
    return [
        turn("user", F.lit(PROMPT)).alias("messages"), turn("assistant", chosen).alias("chosen_response"), turn("assistant", rejected).alias("rejected_response"),
        F.array(image).alias("images"), category.alias("category"), none.alias("audios"), none.alias("videos"),
    ]


def capped(df: DataFrame, category: str, limited: list[str], order: list[str], share: float = CAP_SHARE) -> DataFrame:
    """Rows of ``limited`` categories cut to max(1, share of all rows), counted before capping."""
    cap = F.broadcast(df.agg(F.greatest(F.lit(1), F.floor(F.count("*") * share)).alias("__cap")))
    free = df.where(~F.coalesce(F.col(category).isin(limited), F.lit(False)))
    ranked = rank_in_group(df.where(F.col(category).isin(limited)), category, order, "__rank")
    return free.unionByName(ranked.crossJoin(cap).where("__rank <= __cap").drop("__rank", "__cap"))  # one row


def oversampled(df: DataFrame, category: str, priority: list[str], key: str, seed: str = "42") -> DataFrame:
    """Priority rows repeated until they are as many as the others: whole rounds, then the first rows in hash order.

    ``copy`` is 0 for the rows themselves. Nothing is added if the priority rows are none or already enough.
    """
    is_p = F.coalesce(F.col(category).isin(priority), F.lit(False))
    n = F.broadcast(df.agg(F.count_if(is_p).alias("__p"), F.count_if(~is_p).alias("__o")))
    h = F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))
    d = df.crossJoin(n).withColumn("__b", F.substr(h, F.lit(1), F.lit(2))).withColumn("__h", h)  # one row
    p = d.where(is_p)
    at = p.groupBy("__b").agg(F.count("*").alias("__n")).withColumn("__at", F.sum("__n").over(Window.orderBy("__b")) - F.col("__n")).drop("__n")  # 256 rows
    p = p.join(F.broadcast(at), "__b").withColumn("__i", F.row_number().over(Window.partitionBy("__b").orderBy("__h", key)) - 1 + F.col("__at"))
    need = F.greatest(F.lit(0), F.col("__o") - F.col("__p"))
    more = F.floor(need / F.col("__p")) + F.when(F.col("__i") < need % F.col("__p"), 1).otherwise(0)
    p = p.withColumn("copy", F.explode(F.sequence(F.lit(0), more.cast("int")))).drop("__i", "__at")
    return d.where(~is_p).withColumn("copy", F.lit(0)).unionByName(p).drop("__p", "__o", "__b", "__h")
