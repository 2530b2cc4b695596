"""Splits that keep related records together (problem 5).

Records that share any link value (author, source, entity, scanned item) form one group: the connected
components of the record/value graph. They come from a union-find that starts with one forest per scan
partition, holds only ``parent`` entries of that partition, and is merged level by level: each level keeps
just the values seen under several roots, on ever fewer partitions. Groups then go, largest first, to the
split that is furthest below its target; groups of one size are interchangeable, so the walk runs over the
size histogram (at most sqrt(2 n) lines) and no group list reaches the driver.

Defined results: a null link value links nothing; a record without any link value is a group of its own; an
empty table gives an empty result; rows repeated with one id stay in one group; other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusforge.runtime import cut, slots, small

#: Edges kept in one local forest before it is emitted; bounds a Python worker's memory.
FOREST_EDGES = 400_000
#: Edges that one task may merge alone at the last level.
LAST_LEVEL_EDGES = 2_000_000


class Forest:
    """Union-find over hashable nodes; the root of a tree is its smallest record number."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def find(self, x):
        p = self.parent
        r = p.setdefault(x, x)
        while r != p[r]:
            r = p[r]
        while p[x] != r:
            p[x], x = r, p[x]
        return r

    def join(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            lo, hi = (a, b) if a < b else (b, a)
            self.parent[hi] = lo


_FOREST = "node string, rec bigint, root bigint"


def _local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(node, root) edges in; for each local forest one (node, root) row per node and one (rec, root) row per record out."""

    def emit(first: dict, forest: Forest) -> Iterator[pd.DataFrame]:
        def rows(nodes, recs, of):
            return pd.DataFrame({"node": pd.Series(nodes, dtype="object"), "rec": pd.array(recs, dtype="Int64"), "root": pd.array([forest.find(r) for r in of], dtype="int64")})

        yield rows(list(first), [None] * len(first), first.values())
        recs = list(forest.parent)
        yield rows([None] * len(recs), recs, recs)

    first: dict = {}
    forest = Forest()
    for b in batches:
        for node, rec in zip(b["node"].tolist(), b["root"].tolist()):
            if node in first:
                forest.join(first[node], rec)
            else:
                first[node] = rec
                forest.find(rec)
        if len(forest.parent) >= FOREST_EDGES:
            yield from emit(first, forest)
            first, forest = {}, Forest()
    yield from emit(first, forest)


def components(edges: DataFrame, max_levels: int = 60) -> DataFrame:
    """(rec, component) of every ``rec`` in ``edges(node STRING, rec BIGINT)``; component is the smallest rec.

    Level 0 makes local forests where the rows lie. At each further level the roots seen under one node are
    merged, on half as many partitions as before, but never fewer than the open edges need; a node whose roots
    all agree is done and leaves the data.
    """
    width = slots(edges.sparkSession)
    forest = cut(edges.select("node", F.col("rec").alias("root")).mapInPandas(_local, _FOREST))
    labels = _labels(forest, "rec", "component")
    for level in range(max_levels):
        open_ = _open(forest)
        n = open_.count()
        if not n:
            return labels
        if level:
            width = max(-(-n // LAST_LEVEL_EDGES), width // 2 if n > LAST_LEVEL_EDGES else 1)
        forest = cut(open_.repartition(width, "node").mapInPandas(_local, _FOREST))
        labels = labels.join(_labels(forest, "component", "better"), "component", "left").select("rec", F.coalesce("better", "component").alias("component"))
    raise RuntimeError("components did not settle")


def _labels(forest: DataFrame, of: str, label: str) -> DataFrame:
    return forest.where("rec is not null").groupBy(F.col("rec").alias(of)).agg(F.min("root").alias(label))


def _open(forest: DataFrame) -> DataFrame:
    """Edges still needed: the distinct roots of each node, or record, that has several."""
    named = forest.select(F.coalesce("node", F.concat(F.lit("\u0000"), F.col("rec").cast("string"))).alias("node"), "root")
    several = named.groupBy("node").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("node")
    return named.join(several, "node").distinct()


def grouped(df: DataFrame, id_col: str, links: dict[str, Column]) -> DataFrame:
    """``df`` with ``group_id``: the smallest id among the records connected through any of ``links``."""
    rec = F.col(id_col).cast("bigint")
    nodes = F.array_compact(F.array(*[F.concat(F.lit(k + "\u0001"), c) for k, c in links.items()]))
    edges = df.where(rec.isNotNull()).select(rec.alias("rec"), F.explode(nodes).alias("node"))
    comp = components(edges).select(F.col("rec").alias("__rec"), F.col("component").alias("__comp"))
    return df.join(comp, rec == F.col("__rec"), "left").withColumn("group_id", F.coalesce("__comp", rec)).drop("__rec", "__comp")


def greedy_quota(histogram: list[tuple[int, int]], targets: dict[str, float]) -> list[tuple[int, str, int]]:
    """How many groups of each size each split gets when groups go, largest first, to the split furthest below target.

    ``histogram`` is (size, number of groups). Within one size the greedy walk fills deficits to a common level,
    found by bisection, so a size with billions of groups costs as much as one with ten.
    """
    total = sum(s * n for s, n in histogram)
    lack = {k: v * total for k, v in targets.items()}
    out = []
    for size, n in sorted(histogram, reverse=True):
        take = dict.fromkeys(targets, 0)
        if n > 4 * len(targets):
            lo, hi = min(lack.values()) - size * n, max(lack.values())
            for _ in range(200):
                mid = (lo + hi) / 2
                lo, hi = (lo, mid) if sum(max(0, math.floor((v - mid) / size)) for v in lack.values()) <= n else (mid, hi)
            take = {k: max(0, math.floor((v - hi) / size)) for k, v in lack.items()}
            for k in take:
                lack[k] -= take[k] * size
        for _ in range(n - sum(take.values())):
            k = max(lack, key=lambda x: (lack[x], x))
            lack[k] -= size
            take[k] += 1
        out += [(size, k, c) for k, c in take.items() if c]
    return out


def assign_splits(groups: DataFrame, targets: dict[str, float], seed: str = "0") -> DataFrame:
    """(group_id, n, split) of ``groups(group_id)`` rows, one input row per record.

    Groups of one size are numbered without a one-task window: a hash bucket's offset plus the rank in the bucket.
    """
    spark = groups.sparkSession
    sized = cut(groups.groupBy("group_id").agg(F.count("*").alias("n")).withColumn("b", F.pmod(F.xxhash64(F.lit(seed), "group_id"), F.lit(4 * slots(spark)))))
    histogram = [(r["n"], r["k"]) for r in sized.groupBy("n").agg(F.count("*").alias("k")).collect()]  # at most sqrt(2 rows) lines
    quota = greedy_quota(histogram, targets)
    if not quota:
        return sized.select("group_id", "n", F.lit(None).cast("string").alias("split"))
    ranges, at = [], {}
    for size, split, c in quota:
        ranges.append((size, split, at.get(size, 0), at.get(size, 0) + c))
        at[size] = at.get(size, 0) + c
    r = spark.createDataFrame(ranges, "n bigint, split string, lo bigint, hi bigint")
    offs = sized.groupBy("n", "b").agg(F.count("*").alias("k"))
    offs = offs.withColumn("off", F.sum("k").over(Window.partitionBy("n").orderBy("b")) - F.col("k")).drop("k")
    ranked = sized.withColumn("i", F.row_number().over(Window.partitionBy("n", "b").orderBy(F.xxhash64(F.lit(seed), "group_id"), "group_id")) - 1)
    ranked = ranked.join(offs, ["n", "b"]).withColumn("i", F.col("i") + F.col("off"))
    return ranked.join(small(r), "n").where("i >= lo and i < hi").select("group_id", "n", "split")


def item_number(file_name: Column) -> Column:
    """Number of the scanned item in a file name: the run of six or more digits, unpadded; null for a bare running number."""
    digits = F.regexp_extract(file_name, r"([0-9]{6,})", 1)
    bare = file_name.rlike(r"(?i)^(?:\./)*[0-9]+(?:\.png)?$")
    return F.when(~bare & (digits != ""), F.regexp_replace(digits, "^0+(?=.)", ""))


def scanned_item() -> Column:
    """One value per source and item number; null where either is missing."""
    number = item_number(F.col("file_name"))
    return F.when(F.col("source").isNotNull() & number.isNotNull(), F.concat("source", F.lit("\u0001"), number))
