"""Mixing sources to target weights by the cube method (problem 3).

A source with ``chars`` characters and target share ``w`` of a mix of ``total`` characters needs each record
``r = w * total / chars`` times, at most ``max_repeats`` times. Every record gets ``floor(r)`` copies; the
fraction ``r - floor(r)`` is an inclusion probability, and the cube method rounds it to 0 or 1 so that both
the number of copies and the characters of the source stay balanced: a flight moves three records at a time
along the null-space of the two constraints until one of them is integral. Flights run in hash blocks of a
source (a hot source is many blocks); each block leaves at most two records undecided, these fly again block
of blocks by block of blocks, and the last two per source are landed by trying the four roundings.

Defined results: blank texts (null, empty, white space) and records of unlisted or null sources get no copy;
a listed source without records is reported with zeros; repeated rows count as separate records; an empty
manifest gives an empty mix; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.runtime import cut, small

#: Records of one block of the first flight, about; bounds a task's memory.
BLOCK_ROWS = 20_000
EPS = 1e-9
#: A text with a character that is no white space of any kind.
NOT_BLANK = r"[^\s\p{Z}]"


def fly(p: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """Flight phase: probabilities ``p`` moved to 0/1, but for two at most, with sum(p) and sum(p * size) kept."""
    p = p.astype(float).tolist()
    s = (size.astype(float) / max(1.0, float(size.max(initial=1)))).tolist()
    draw = np.random.default_rng(seed).random(len(p) + 3).tolist()
    live: list[int] = []
    for k in range(len(p)):
        if not EPS < p[k] < 1 - EPS:
            p[k] = float(round(p[k]))
            continue
        live.append(k)
        while len(live) == 3:
            i, j, m = live
            u = (s[m] - s[j], s[i] - s[m], s[j] - s[i])  # orthogonal to (1, 1, 1) and to the sizes
            if not any(abs(x) > 1e-12 for x in u):
                u = (1.0, -1.0, 0.0)
            up = min((1 - p[x]) / d if d > 0 else p[x] / -d for x, d in zip(live, u) if d)
            down = min(p[x] / d if d > 0 else (1 - p[x]) / -d for x, d in zip(live, u) if d)
            step = up if draw[k] * (up + down) < down else -down
            for x, d in zip(live, u):
                p[x] += step * d
            for x in live:
                if p[x] <= EPS or p[x] >= 1 - EPS:
                    p[x] = float(round(p[x]))
            live = [x for x in live if EPS < p[x] < 1 - EPS]
    return np.array(p)


def land(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Landing: the rounding of the few undecided records that leaves the characters nearest their balance."""
    idx = np.flatnonzero((p > EPS) & (p < 1 - EPS))
    if not len(idx):
        return p
    aim, w = float((p[idx] * size[idx]).sum()), size[idx].astype(float)
    best = min(range(2 ** len(idx)), key=lambda m: abs(sum(w[i] for i in range(len(idx)) if m >> i & 1) - aim))
    p = p.copy()
    p[idx] = [best >> i & 1 for i in range(len(idx))]
    return p


def _flight(last: bool, seed: str):
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["h", "rec_id", "n_chars"], kind="stable")
        size = g["n_chars"].to_numpy()
        p = fly(g["p"].to_numpy(), size, zlib.crc32(f"{g['source'].iloc[0]}|{g['block'].iloc[0]}|{seed}".encode()))
        return g.assign(p=land(p, size) if last else p)

    return run


_UNIT = "source string, rec_id bigint, n_chars bigint, whole bigint, p double, h bigint, block bigint"


def sources_plan(manifest: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """One row per source of ``targets``: records, characters, characters aimed at, copies needed per record."""
    own = manifest.where(F.col("text").rlike(NOT_BLANK)).groupBy("source").agg(F.count("*").alias("n_records"), F.sum(F.length("text")).alias("n_chars"))
    plan = targets.select("source", "target_share", "max_repeats").join(own, "source", "left").fillna(0, ["n_records", "n_chars"])
    whole = F.lit(float(total)) if total is not None else plan.agg(F.sum("n_chars").alias("all_chars"))
    plan = plan.withColumn("all_chars", whole) if total is not None else plan.crossJoin(F.broadcast(whole))  # one row
    plan = plan.withColumn("target_chars", F.col("target_share") * F.col("all_chars"))
    need = F.when(F.col("n_chars") > 0, F.col("target_chars") / F.col("n_chars")).otherwise(F.lit(0.0))
    return plan.withColumn("copies_each", F.least(need, F.col("max_repeats").cast("double")))


def mix(manifest: DataFrame, targets: DataFrame, total: float | None = None, seed: str = "0") -> tuple[DataFrame, DataFrame]:
    """(copies, plan): ``copies(source, rec_id, n_chars, copies)`` of every usable record, and the plan it followed."""
    plan = cut(sources_plan(manifest, targets, total))
    per = plan.where("n_records > 0").select("source", "copies_each", F.ceil(F.col("n_records") / BLOCK_ROWS).alias("blocks"))
    u = manifest.where(F.col("text").rlike(NOT_BLANK)).select("source", "rec_id", F.length("text").cast("bigint").alias("n_chars")).join(small(per), "source")
    h = F.xxhash64(F.lit(seed), "rec_id")
    u = u.select(
        "source", "rec_id", "n_chars", F.floor("copies_each").alias("whole"), (F.col("copies_each") - F.floor("copies_each")).alias("p"),
        h.alias("h"), F.pmod(h, F.col("blocks")).alias("block"),
    )
    flown = cut(u.groupBy("source", "block").applyInPandas(_flight(False, seed), _UNIT))
    open_ = F.col("p").between(EPS, 1 - EPS)
    done, rest = [flown.where(~open_)], flown.where(open_)
    blocks = plan.agg(F.max(F.ceil(F.col("n_records") / BLOCK_ROWS))).first()[0] or 1
    while blocks > BLOCK_ROWS // 2:  # only sources of hundreds of millions of records have so many blocks
        blocks = -(-blocks // 64)
        rest = cut(rest.withColumn("block", F.floor(F.col("block") / 64)).groupBy("source", "block").applyInPandas(_flight(False, seed), _UNIT))
        done.append(rest.where(~open_))
        rest = rest.where(open_)
    done.append(rest.groupBy("source").applyInPandas(_flight(True, seed), _UNIT))
    all_ = done[0]
    for d in done[1:]:
        all_ = all_.unionByName(d)
    return all_.select("source", "rec_id", "n_chars", (F.col("whole") + F.round("p").cast("bigint")).alias("copies")), plan


def report(copies: DataFrame, plan: DataFrame) -> DataFrame:
    """Shares aimed at and reached. ``short`` tells a source that is below its aim though every record is at its cap."""
    got = copies.groupBy("source").agg(
        F.sum("copies").alias("copies"), F.sum(F.col("copies") * F.col("n_chars")).alias("reached_chars"), F.min("copies").alias("least_copies")
    )
    r = plan.join(got, "source", "left").fillna(0, ["copies", "reached_chars"])
    at_cap = (F.col("n_records") == 0) | (F.col("least_copies") >= F.col("max_repeats"))
    whole = r.agg(F.sum("reached_chars").alias("mix_chars"))
    return r.crossJoin(F.broadcast(whole)).select(  # one row
        "source", "target_share", "max_repeats", "n_records", "n_chars", "target_chars", "copies", "reached_chars",
        (F.col("reached_chars") / F.nullif("mix_chars", F.lit(0))).alias("reached_share"),
        (at_cap & (F.col("reached_chars") < F.col("target_chars"))).alias("short"),
    )
