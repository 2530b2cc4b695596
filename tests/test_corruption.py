"""Composed corruption by the batch against the column functions, in result and in time."""

import random
import time

from pyspark.sql import functions as F

from corpusforge.functions import text as T
from corpusforge.operators import corruption as C


def folded(x, seed, intensity):
    """The five column functions one after another."""
    for k, (f, (lo, hi)) in enumerate(zip((C.diacritic_swap, C.confuse, C.char_noise, C.case_noise, C.digit_swap), C.RATES[intensity])):
        x = T.let(F.struct(x.alias("x"), (lo + (hi - lo) * C.chance(seed, F.lit("r"), F.lit(k))).alias("p")), (lambda f: lambda s: f(s["x"], seed, s["p"]))(f))
    return x


def test_corruption_by_batch_is_the_fold_of_columns(spark):
    """Odd letters, empty and long texts, seeds of every length, also none."""
    r = random.Random(3)
    letters = [*"åäöÅÄÖéüšž" * 3, *"wWvVOolI1rncl0 \n98765" * 3, *"ßŉİΣςǅᾳƛᲊ\0日ﬁ", "\U0001F600", "\U00010400", "\U00010D70", "rn", "vv", "cl"]
    rows = [("".join(r.choice(letters) for _ in range(r.choice([0, 1, 2, 3, 10, 60, 300]))), r.choice(["", None, str(i), "ä" * r.randrange(70) + str(i)])) for i in range(500)]
    rows += [(None, "1"), ("Tämä on kuva rn 1234 " * 600, "long"), *[("", str(i)) for i in range(300)]]
    df = spark.createDataFrame(rows, "t string, s string").repartition(4)
    for intensity in C.RATES:
        both = df.select("t", folded(F.col("t"), F.col("s"), intensity).alias("a"), C.corrupted(F.col("t"), F.col("s"), intensity).alias("b")).collect()
        assert [x.b for x in both] == [x.a for x in both] and sum(x.b != x.t for x in both) > 200


def test_variants_cost_a_part_of_the_fold(spark):
    """Time of all variants against that of the columns' fold on the same labels."""
    df = spark.createDataFrame([(i, f"Wärjö kuva rn {i} olivat " * 10) for i in range(6000)], "i int, t string").repartition(4).cache()
    seed = F.concat_ws("#", F.col("i").cast("string"), F.lit("1"))

    def seconds(d):
        d.limit(40).repartition(4).write.format("noop").mode("overwrite").save()
        began = time.perf_counter()
        d.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    assert seconds(C.variants(df, "t", "i", 1)) < seconds(df.select(folded(F.col("t"), seed, "light").alias("x"))) / 2
