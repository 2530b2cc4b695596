"""Recall of the cosine join on texts with random edits: python tests/llm/recall_overlap.py [data directory] [share ...].

Every distinct assistant content of at least 40 characters is a train text; its noisy copy (substitutions, losses and
insertions of that share of the characters) is a held-out text, and their pair is one to be found.
"""

import random
import sys

from pyspark.sql import functions as F

from corpusforge.llm import overlap


def noisy(text: str, share: float, rng: random.Random) -> str:
    out = list(text)
    for i in sorted(rng.sample(range(len(out)), int(len(out) * share)), reverse=True):
        kind = rng.randrange(3)
        letter = rng.choice("abcdefghijklmnopqrstuvwxyzäö ")
        out[i : i + 1] = [[letter], [], [out[i], letter]][kind]
    return " ".join("".join(out).split())


def recall(spark, texts: list[str], share: float, seed: int = 1) -> tuple[int, int]:
    """(pairs found, pairs to be found)."""
    rng = random.Random(seed)
    rows, want = [], set()
    for k, t in enumerate(texts):
        n = noisy(t, share, rng)
        rows += [(2 * k, t, True, False), (2 * k + 1, n, False, True)]
        if len(n) >= 40 and n != t:
            want.add((2 * k, 2 * k + 1))
    t = spark.createDataFrame(rows, "tid bigint, text string, train boolean, held boolean").repartition(8).cache()
    want &= {(r.a, r.b) for r in overlap._within(t.where("train").select((F.col("tid") + 1).alias("b"), F.col("tid").alias("a"), F.col("text").alias("ta")).join(t.where("held").select(F.col("tid").alias("b"), F.col("text").alias("tb")), "b"), 0.1).collect()}
    got = {(r.a, r.b) for r in overlap.near_texts(t).collect()}
    return len(want & got), len(want)


def contents(spark, data: str) -> list[str]:
    t, _ = overlap.texts(spark.read.parquet(f"{data}/chat_entries.parquet"), 40)
    return [r.text for r in t.select("text").orderBy("tid").collect()]


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    data = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    texts = contents(spark, data)
    for share in map(float, sys.argv[2:] or ["0.02", "0.04", "0.06", "0.08", "0.095"]):
        found, all_ = recall(spark, texts, share)
        print(f"{share:.3f}: {found} of {all_} = {found / max(1, all_):.4f}", flush=True)
