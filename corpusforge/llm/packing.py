"""Filling fixed-capacity sequences with documents (problem 8).

Cost-balanced packing: the cost of an item is linear in its tokens plus quadratic (attention). Items go, in
descending size, to the sequence of lowest cost that still has room; a sequence is opened only when none has.
Documents longer than a sequence are cut into full sequences and a remainder, which is an item like others.
Packing runs in hash blocks of bounded size, so a block's few unfilled sequences are all that scale costs.

Defined results: null and empty texts have no tokens and no sequence; repeated rows are separate items; an
empty table gives no sequence; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.tokens import counter, vocabulary_path
from corpusforge.runtime import cut

#: Tokens of one packing block, about: 4,000 sequences.
BLOCK_TOKENS = 8_000_000
#: Weight of the quadratic part: a token's attention cost against its linear cost, per token of the item.
QUADRATIC = 1.0 / 2048


def pack(sizes: list[int], capacity: int, quadratic: float = QUADRATIC) -> list[int]:
    """Sequence number of each item; items are taken in descending size, ties by position."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    where = [0] * len(sizes)
    room: list[int] = []
    heap: list[tuple[float, int]] = []  # (cost, sequence) of sequences that have room for the current size
    aside: dict[int, list[tuple[float, int]]] = {}  # sequences with less room than the current size, by room
    size = capacity
    for i in order:
        while size > sizes[i]:  # items only get smaller, so a sequence set aside comes back when its room is enough
            size -= 1
            for back in aside.pop(size, ()):
                heapq.heappush(heap, back)
        while heap and room[heap[0][1]] < size:
            back = heapq.heappop(heap)
            aside.setdefault(room[back[1]], []).append(back)
        if heap:
            cost, k = heapq.heappop(heap)
        else:
            cost, k = 0.0, len(room)
            room.append(capacity)
        where[i] = k
        room[k] -= sizes[i]
        heapq.heappush(heap, (cost + sizes[i] + quadratic * sizes[i] * sizes[i], k))
    return where


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens) of the non-empty texts."""
    path = path or vocabulary_path()

    @F.pandas_udf("int")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = counter(path)
        for t in texts:
            yield pd.Series([c.count(x) for x in t], dtype="int32")

    return docs.where(F.length("text") > 0).select("doc_id", count("text").alias("n_tokens"))


def _packed(capacity: int):
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["size", "h", "doc_id", "part"], kind="stable")
        seq = pd.Series(pack(g["size"].tolist(), capacity), index=g.index)
        return g.assign(sequence=g["block"].astype(str) + "-" + seq.astype(str), fill=g.groupby(seq)["size"].transform("sum"))

    return run


_ITEM = "doc_id bigint, part int, size int, h bigint, block bigint, sequence string, fill bigint"


def cost(tokens: Column, quadratic: float = QUADRATIC) -> Column:
    """Attention cost of an item."""
    return tokens + F.lit(quadratic) * tokens * tokens


def packed(docs: DataFrame, capacity: int = 2048, path: str | None = None) -> DataFrame:
    """(doc_id, part, first_token, tokens, sequence, fill): the sequence of every item and the tokens that sequence holds.

    ``part`` numbers the pieces of a document above ``capacity``, which begin at ``first_token`` of its tokens; it is 1
    for others.
    """
    sized = cut(token_counts(docs, path))
    n = F.col("n_tokens")
    item = F.explode(F.transform(F.sequence(F.lit(1), F.ceil(n / capacity).cast("int")), lambda i: F.struct(
        i.alias("part"), F.least(F.lit(capacity), n - (i - 1) * capacity).cast("int").alias("size"))))
    items = sized.select("doc_id", item.alias("i")).select("doc_id", "i.*").withColumn("h", F.xxhash64("doc_id", "part"))
    blocks = max(1, -(-(sized.agg(F.sum("n_tokens")).first()[0] or 0) // BLOCK_TOKENS))
    full, rest = items.where(F.col("size") == capacity), items.where(F.col("size") < capacity)
    full = full.withColumn("sequence", F.concat_ws("-", F.lit("w"), "doc_id", "part")).withColumn("fill", F.col("size").cast("bigint"))
    rest = rest.withColumn("block", F.pmod("h", F.lit(blocks))).groupBy("block").applyInPandas(_packed(capacity), _ITEM)
    cols = ["doc_id", "part", ((F.col("part") - 1) * capacity).alias("first_token"), F.col("size").alias("tokens"), "sequence", "fill"]
    return full.select(cols).unionByName(rest.select(cols))


def fills(packed_items: DataFrame) -> DataFrame:
    """(sequence, items, fill, cost) of each sequence."""
    return packed_items.groupBy("sequence").agg(F.count("*").alias("items"), F.sum("tokens").alias("fill"), F.sum(cost(F.col("tokens"))).alias("cost"))
