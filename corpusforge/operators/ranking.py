"""Exact global ranks, rank-range splits and folds without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusforge.runtime import cut, slots

#: Hash prefixes that cut a global order into buckets: 16 ** 3.
PREFIX = 3
#: Rows of one key from which on its rows get buckets of their own, and how far above the mean a bucket is looked into.
HOT_ROWS, HOT_BUCKET = 100_000, 4


def hash_ranked(df: DataFrame, key: Column, tie: Column, rank: str = "rank") -> tuple[DataFrame, Column]:
    """``df`` with ``rank`` (from 0) in MD5 order of ``key``, then of ``tie``, and the total as a column.

    Rows are ranked inside hash-prefix buckets; a bucket's offset comes from the table of bucket sizes. The rows of a
    hot key would share one bucket: they get buckets by the hash of ``tie``, and the keys before and after it in the
    same prefix one each. Only buckets far above the mean are searched for hot keys.
    """
    h = df.withColumns({"__k": F.md5(key), "__t": F.md5(tie.cast("string"))}).withColumn("__b", F.substr("__k", F.lit(1), F.lit(PREFIX)))
    large = _hot_keys(h)
    if large is None:
        h = h.withColumn("__s", F.lit(""))
    else:
        h = h.join(F.broadcast(large), "__b", "left").withColumn("__hot", F.coalesce("__hot", F.array().cast("array<string>")))
        below, hot = F.size(F.filter("__hot", lambda x: x < F.col("__k"))), F.array_contains("__hot", F.col("__k"))
        h = h.withColumn("__s", F.concat(F.format_string("%05d", below), F.when(hot, F.concat(F.lit("h"), F.substr("__t", F.lit(1), F.lit(PREFIX)))).otherwise(""))).drop("__hot")
    sizes = h.groupBy("__b", "__s").agg(F.count("*").alias("__n"))
    everything = Window.orderBy("__b", "__s")
    offsets = sizes.select("__b", "__s", (F.sum("__n").over(everything) - F.col("__n")).alias("__at"), F.sum("__n").over(Window.partitionBy(F.lit(1))).alias("__total"))
    ranked = h.join(F.broadcast(offsets), ["__b", "__s"]).withColumn(rank, F.row_number().over(Window.partitionBy("__b", "__s").orderBy("__k", "__t")) - 1 + F.col("__at"))
    return ranked.drop("__k", "__t", "__b", "__s", "__at").withColumnRenamed("__total", "n_total"), F.col("n_total")


def _hot_keys(h: DataFrame) -> DataFrame | None:
    """(prefix, hashes of its keys of at least HOT_ROWS rows), None if there are none; at most rows / HOT_ROWS keys."""
    sizes = {r["__b"]: r["n"] for r in h.groupBy("__b").agg(F.count("*").alias("n")).collect()}  # at most 4,096 lines
    far = max(HOT_ROWS, HOT_BUCKET * sum(sizes.values()) // 16**PREFIX)
    large = [b for b, n in sizes.items() if n >= far]
    if not large:
        return None
    keys = h.where(F.col("__b").isin(large)).groupBy("__b", "__k").agg(F.count("*").alias("n")).where(F.col("n") >= HOT_ROWS)
    hot = cut(keys.groupBy("__b").agg(F.sort_array(F.collect_list("__k")).alias("__hot")))
    return hot if hot.limit(1).count() else None


def rank_in_group(df: DataFrame, by: str, order: list[str], rank: str = "rank") -> DataFrame:
    """``df`` with ``rank`` (from 1) in each group, a hot group included, without a task that holds a whole group.

    Rows are range-partitioned by group and order, so a group lies in consecutive slices; a row's rank is the
    size of its group's earlier slices plus its place in the slice. The slices are written once, as both need them.
    """
    n = slots(df.sparkSession)
    sliced = cut(df.repartitionByRange(n, by, *order).withColumn("__p", F.spark_partition_id()))
    sizes = sliced.groupBy(by, "__p").agg(F.count("*").alias("__n"))
    before = sizes.select(F.col(by).alias("__by"), F.col("__p").alias("__q"), (F.sum("__n").over(Window.partitionBy(by).orderBy("__p")) - F.col("__n")).alias("__at"))
    placed = sliced.withColumn("__r", F.row_number().over(Window.partitionBy(by, "__p").orderBy(*order)))
    placed = placed.join(before, F.col(by).eqNullSafe(F.col("__by")) & (F.col("__p") == F.col("__q")))
    return placed.withColumn(rank, F.col("__r") + F.col("__at")).drop("__p", "__q", "__by", "__at", "__r")


def positions(df: DataFrame, name: str = "position") -> DataFrame:
    """``df`` with the number of each row from 0, in the order of its partitions; written once, as counting and numbering both need it."""
    d = cut(df.withColumns({"__p": F.spark_partition_id(), "__m": F.monotonically_increasing_id()}))
    sizes = d.groupBy("__p").agg(F.count("*").alias("__n"))
    before = sizes.select("__p", (F.sum("__n").over(Window.orderBy("__p")) - F.col("__n")).alias("__at"))  # a line per partition
    # the low 33 bits of the id are the row's number in its partition
    return d.join(F.broadcast(before), "__p").withColumn(name, F.col("__at") + F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))).drop("__p", "__m", "__at")


def split_of(rank: Column, n: Column, train: float, evaluation: float) -> Column:
    """train | eval | test by rank: both products are floored on their own."""
    a = F.floor(n * train)
    return F.when(rank < a, "train").when(rank < a + F.floor(n * evaluation), "eval").otherwise("test")


def leak_free(df: DataFrame, split: str, key: str) -> DataFrame:
    """Rows whose key occurs in no earlier split (train, eval, test); repeats inside one split stay, and so do rows without a key."""
    order = F.when(F.col(split) == "train", 0).when(F.col(split) == "eval", 1).otherwise(2)
    d = df.withColumn("__o", order)
    first = d.groupBy(key).agg(F.min("__o").alias("__first"))
    first = first.where(F.col(key).isNotNull()).withColumnRenamed(key, "__key")
    return d.join(first, F.col(key) == F.col("__key"), "left").where("__key is null or __o = __first").drop("__o", "__key", "__first")


def folds(rank: Column, n: Column, k: int, train: float) -> Column:
    """Fold number of a rank, -1 for the shared test tail; the last fold takes the remainder."""
    pool = F.floor(n * train)
    return F.when(rank >= pool, -1).otherwise(F.least(F.floor(rank / F.greatest(F.floor(pool / k), F.lit(1))), F.lit(k - 1)))


def two_way(rank: Column, n: Column, train: float, evaluation: float) -> Column:
    if train <= 0 or evaluation <= 0:
        return F.lit("train")
    return F.when(rank < F.floor(n * (train / (train + evaluation))), "train").otherwise("eval")


def batch_of(rank: Column, n: Column, batches: int = 20) -> Column:
    return F.floor(rank / F.greatest(F.ceil(n / batches), F.lit(1)))


def _running(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """The histogram of ``value`` per group with ``__hi``, rows up to and with a value, and ``__n``, rows of the group.

    The values are counted, cut into range slices, and summed slice by slice: no task holds the values of a group.
    """
    spark = df.sparkSession
    h = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("__c"))
    h = cut(h.repartitionByRange(slots(spark), *by, value).withColumn("__p", F.spark_partition_id()))
    sums = h.groupBy(*by, "__p").agg(F.sum("__c").alias("__k"))
    part = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    sums = sums.select(*[F.col(c).alias(f"__by_{c}") for c in by], F.col("__p").alias("__q"), (F.sum("__k").over(part.orderBy("__p")) - F.col("__k")).alias("__at"), F.sum("__k").over(part).alias("__n"))
    on = F.col("__p") == F.col("__q")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    inside = F.sum("__c").over(Window.partitionBy(*by, "__p").orderBy(value))
    return h.withColumn("__in", inside).join(F.broadcast(sums), on).select(*by, value, "__c", (F.col("__in") + F.col("__at")).alias("__hi"), "__n")  # a line per group and slice


def floor_percentiles(df: DataFrame, by: list[str], value: str, ps: list[int]) -> DataFrame:
    """Floor-index percentiles per group: element ``int(n * p / 100)`` of the sorted values."""
    picks = [F.min(F.when(F.col("__hi") > F.least(F.floor(F.col("__n") * p / 100), F.col("__n") - 1), F.col(value))).alias(f"p{p}") for p in ps]
    h = _running(df, by, value)
    return h.groupBy(*by).agg(*picks) if by else h.agg(*picks)


def interpolated_percentiles(df: DataFrame, by: list[str], value: str, ps: list[float]) -> DataFrame:
    """(by, n, p50 ...): percentiles at ``p / 100 * (n - 1)`` of the sorted values, between two elements in proportion."""
    def element(i: Column) -> Column:
        return F.min(F.when(F.col("__hi") > i, F.col(value).cast("double")))

    where = {p: F.lit(p / 100) * (F.col("__n") - 1) for p in ps}
    aggs = [F.max("__n").alias("n")]
    for k, p in enumerate(ps):
        aggs += [element(F.floor(where[p])).alias(f"__lo{k}"), element(F.ceil(where[p])).alias(f"__up{k}"), F.max(where[p] - F.floor(where[p])).alias(f"__f{k}")]
    q = _running(df, by, value).groupBy(*by).agg(*aggs)
    name = lambda p: f"p{p:g}"
    return q.select(*by, "n", *[(F.col(f"__lo{k}") + (F.col(f"__up{k}") - F.col(f"__lo{k}")) * F.col(f"__f{k}")).alias(name(p)) for k, p in enumerate(ps)])
