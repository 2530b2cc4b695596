"""Same or near-same records across splits (problem 7).

Assistant contents are reduced to distinct texts; a text is a vector of weighted terms: ordered pairs of words near
each other, a pair's weight the sum of its words' ln(1 + N / document frequency); words that occur on one side only
(misreadings, mostly) are outside the space, or their weights would part near texts. Texts of few words have their
8-letter runs as terms as well. Train and held-out vectors are joined by their cosine over inverted lists:

* terms are ordered from rare to frequent, by their weight alone, so both sides order them alike. The frequent end
  of a vector is left out of the lists while all it could add to any cosine stays below a share of the threshold:
  its norm bounds that (residual norm), on the train side also its products with the greatest weights that any
  held-out vector of such a length can have (maximum weight);
* lists are kept by length class, and a list that may be long is cut into blocks, held-out terms going to each;
* a pair stays if its partial product and what was left out can reach the threshold; the exact dot product of the
  whole vectors decides then, and the edit-distance rule last.

Images join on the path from the images folder on.

Defined results: null, short (under ``least_chars``) and missing contents match by image only; null and empty
image lists match by content only; entries repeated within a split are each paired; a pair found twice is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.folding import coarse
from corpusforge.runtime import cut, slots, small

#: Cosine that a pair needs: at one edit in ten characters 0.41 of the words stay whole, and the cosine of word pairs
#: is about that share; it scatters by the square root of the number of words.
COSINE, SCATTER, LEAST_COSINE = 0.4, 1.3, 0.06
#: Share of the threshold that the terms left out of the lists may reach.
LEFT_OUT = 0.5
#: Word pairs a short text has at least, about: a word is paired with so many of the next ones.
PAIRS = 36
#: Texts of up to FEW words have their runs of GRAM letters as terms; at one edit in ten of 40 letters one run stays whole.
FEW, GRAM = 4, 8
#: Train texts in one block of an inverted list, at most about.
LIST_BLOCK = 50_000


def content(df: DataFrame) -> Column:
    """Assistant content in lower case with single spaces and no outer ones."""
    return F.trim(F.regexp_replace(F.lower(F.get("messages", F.lit(1))["content"]), r"[\s\p{Z}]+", " "))


def image_key(path: Column) -> Column:
    """An image path from the ``images/`` folder on, whatever separators it is written with."""
    return F.nullif(F.regexp_extract(F.regexp_replace(path, r"[\\/]+(?:\.[\\/]+)*", "/"), r"(?:^|/)(images/.*)$", 1), F.lit(""))


def texts(df: DataFrame, least_chars: int) -> tuple[DataFrame, DataFrame]:
    """(distinct texts (tid, text, train, held, words, runs), entries (entry_id, split_name, tid)); tid is the smallest entry of a text."""
    e = df.select("entry_id", "split_name", content(df).alias("text")).where((F.length("text") >= least_chars) & F.col("split_name").isNotNull())
    train = F.col("split_name") == "train"
    t = cut(_with_units(e.groupBy("text").agg(F.min("entry_id").alias("tid"), F.max(train).alias("train"), F.max(~train).alias("held"))))
    return t, e.join(t.select("text", "tid"), "text").select("entry_id", "split_name", "tid")


def _with_units(t: DataFrame) -> DataFrame:
    """``t`` with the hashes of each text's words, in order, and of its letter runs where words are few."""
    w = t.withColumn("__c", F.explode(F.array(coarse(F.col("text"))))).withColumn("words", F.filter(F.split("__c", " "), lambda x: x != ""))
    runs = F.transform(F.sequence(F.lit(1), F.length("__c") - GRAM + 1), lambda i: F.xxhash64(F.substring("__c", i, F.lit(GRAM)), F.lit("run")))
    runs = F.when((F.size("words") <= FEW) & (F.length("__c") >= GRAM), F.array_distinct(runs)).otherwise(F.array().cast("array<bigint>"))
    return w.select(*t.columns, F.transform("words", lambda x: F.xxhash64(x)).alias("words"), runs.alias("runs"))


def unit_counts(t: DataFrame) -> DataFrame:
    """(h, n, idf): words and letter runs that occur on both sides, and the distinct texts that hold them."""
    u = t.select("train", "held", F.explode(F.array_distinct(F.concat("words", "runs"))).alias("h"))
    s = u.groupBy("h").agg(F.count_if("train").alias("n_train"), F.count_if("held").alias("n_held"), F.count("*").alias("n")).where("n_train > 0 and n_held > 0")
    return s.select("h", "n", F.log1p(F.lit(float(t.count())) / F.col("n")).alias("idf"))


def _sum(terms: Column, f) -> Column:
    return F.aggregate(terms, F.lit(0.0), lambda a, x: a + f(x))


def vectors(t: DataFrame, units: DataFrame) -> DataFrame:
    """(tid, n, need, norm, terms ARRAY<STRUCT<w, term, most>>): terms from rare to frequent; ``most`` bounds the texts that hold one, ``n`` is the text's length, ``need`` the cosine asked for."""
    n_words = F.size("words")
    gap = F.greatest(F.lit(1), F.ceil(F.lit(PAIRS) / n_words)).cast("int")
    need = F.greatest(F.lit(LEAST_COSINE), F.lit(COSINE) - F.lit(SCATTER) / F.sqrt(n_words))
    # texts go to their place once: the words of one come back together there
    u = t.repartition(slots(t.sparkSession), "tid").select("tid", F.length("text").alias("n_chars"), gap.alias("gap"), need.alias("need"), n_words.alias("n_words"), F.posexplode(F.concat("words", "runs")).alias("at", "h"))
    v = u.join(small(units), "h").groupBy("tid", "n_chars", "gap", "need", "n_words").agg(F.sort_array(F.collect_list(F.struct("at", "h", "idf", "n"))).alias("u"))
    v = v.select("*", F.filter("u", lambda x: x["at"] < F.col("n_words")).alias("ws"), F.filter("u", lambda x: x["at"] >= F.col("n_words")).alias("rs"))
    pair = lambda x, y: F.struct((x["idf"] + y["idf"]).alias("w"), F.xxhash64(x["h"], y["h"]).alias("term"), F.least(x["n"], y["n"]).alias("most"))
    after = lambda x, i: F.filter(F.slice("ws", i + 2, F.col("gap")), lambda y: y["at"] - x["at"] <= F.col("gap"))
    pairs = F.flatten(F.transform("ws", lambda x, i: F.transform(after(x, i), lambda y: pair(x, y))))
    single = F.transform("rs", lambda x: F.struct(x["idf"].alias("w"), x["h"].alias("term"), x["n"].alias("most")))
    terms = F.sort_array(F.concat(pairs, single), asc=False)
    v = v.select("tid", F.col("n_chars").alias("n"), "need", F.explode(F.array(terms)).alias("all")).where(F.size("all") > 0)  # the generator keeps it computed once
    once = F.filter("all", lambda x, i: (i == 0) | (x["term"] != F.get("all", i - 1)["term"]))
    v = v.select("tid", "n", "need", F.explode(F.array(once)).alias("terms"))
    return v.select("tid", "n", "need", F.explode(F.array(F.sqrt(_sum(F.col("terms"), lambda x: x["w"] * x["w"])))).alias("norm"), "terms")


def _class(n: Column) -> Column:
    """Length class: the whole part of twice the binary logarithm."""
    return F.floor(2 * F.log2(n)).cast("int")


def _classes(n: Column, ratio: float) -> Column:
    """Classes of the lengths that go with ``n``: two at most for a ratio near one."""
    return F.sequence(_class(F.greatest(F.lit(1.0), F.floor(n * ratio))), _class(F.ceil((n + 1) / ratio)))


def _listed(v: DataFrame, greatest: DataFrame | None = None) -> DataFrame:
    """(tid, n, need, rest, w, term, most): the terms of each vector that go into the lists, and what the others can add to a cosine."""
    if greatest is None:
        cap = F.lit(float("inf"))
    else:
        v, cap = v.withColumn("cls", _class(F.col("n"))).join(F.broadcast(greatest), "cls", "left"), F.coalesce("inverse_norm", F.lit(0.0))  # at most some dozens of classes
    bound = lambda mass: F.least(F.sqrt(mass) / F.col("norm"), mass / F.col("norm") * cap) if greatest is not None else F.sqrt(mass) / F.col("norm")
    zero = F.struct(F.lit(0.0).alias("mass"), F.lit(0).alias("out"), F.lit(0.0).alias("kept_out"))

    def step(a, x):
        mass = a["mass"] + x["w"] * x["w"]
        fits = bound(mass) <= F.col("need") * LEFT_OUT
        return F.struct(mass.alias("mass"), F.when(fits, a["out"] + 1).otherwise(a["out"]).alias("out"), F.when(fits, mass).otherwise(a["kept_out"]).alias("kept_out"))

    v = v.select("*", F.explode(F.array(F.aggregate(F.reverse("terms"), zero, step))).alias("cut"))
    kept = v.select("tid", "n", "need", "norm", bound(F.col("cut.kept_out")).alias("rest"), F.explode(F.slice("terms", F.lit(1), F.size("terms") - F.col("cut.out"))).alias("x"))
    return kept.select("tid", "n", F.col("need").cast("float").alias("need"), F.col("rest").cast("float").alias("rest"), (F.col("x.w") / F.col("norm")).cast("float").alias("w"), "x.term", "x.most")


def similar_texts(t: DataFrame, length_ratio: float = 0.9) -> DataFrame:
    """(a, b, cosine, ta, tb): texts of the train and the held-out side whose cosine reaches the threshold."""
    t = t if "words" in t.columns else _with_units(t)
    units = cut(unit_counts(t))
    train, held = vectors(t.where("train"), units), cut(vectors(t.where("held"), units))
    # a weight w of a held-out vector is w / norm: the least norm of a class bounds them all
    near = held.select(F.explode(_classes(F.col("n"), length_ratio)).alias("cls"), (1 / F.col("norm")).alias("i"))
    greatest = near.groupBy("cls").agg(F.max("i").alias("inverse_norm"))
    blocks = F.ceil(F.col("most") / LIST_BLOCK).cast("int")
    a = _listed(train, greatest).select(F.col("tid").alias("a"), F.col("n").alias("na"), F.col("need").alias("ta"), F.col("rest").alias("ra"), F.col("w").alias("wa"), "term", _class(F.col("n")).alias("cls"), F.pmod(F.xxhash64("tid"), blocks).cast("int").alias("block"))
    b = _listed(held).select(F.col("tid").alias("b"), F.col("n").alias("nb"), F.col("need").alias("tb"), F.col("rest").alias("rb"), F.col("w").alias("wb"), "term", F.explode(_classes(F.col("n"), length_ratio)).alias("cls"), blocks.alias("blocks"))
    b = b.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).drop("blocks")
    key = lambda d: d.withColumn("key", F.xxhash64("term", "cls", "block")).drop("term", "cls", "block")
    fits = (F.col("na") >= F.floor(F.col("nb") * length_ratio)) & (F.col("nb") >= F.floor(F.col("na") * length_ratio)) & (F.col("a") != F.col("b"))
    pairs = key(a).join(key(b), "key").where(fits).groupBy("a", "b").agg(
        F.sum(F.col("wa").cast("double") * F.col("wb")).alias("part"), F.max(F.greatest("ra", "rb")).alias("rest"), F.min(F.least("ta", "tb")).alias("need")
    )
    pairs = cut(pairs.where("part + rest >= need - 1e-5").select("a", "b", "need"))
    # the whole vectors of what is left, and their exact products
    some = pairs.select(F.col("a").alias("tid")).union(pairs.select(F.col("b").alias("tid"))).distinct()
    of = cut(t.join(small(some), "tid", "left_semi"))
    whole = cut(vectors(of, units).select("tid", "norm", "terms").join(of.select("tid", "text"), "tid"))
    side = lambda x: whole.select(*[F.col(c).alias(f"{c}_{x}") for c in whole.columns]).withColumnRenamed(f"tid_{x}", x)
    dot = _sum(F.array_intersect("terms_a", "terms_b"), lambda x: x["w"] * x["w"])
    both = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("cosine", dot / (F.col("norm_a") * F.col("norm_b")))
    return both.where("cosine >= need").select("a", "b", "cosine", F.col("text_a").alias("ta"), F.col("text_b").alias("tb"))


def near_texts(t: DataFrame, share: float = 0.1) -> DataFrame:
    """(a, b, distance): similar texts at an edit distance of at most ``share`` of the longer one; equal texts at 0."""
    p = similar_texts(t, 1 - share)
    same = t.where("train and held").select(F.col("tid").alias("a"), F.col("tid").alias("b"), F.lit(0).alias("distance"))
    return _within(p, share).unionByName(same)


def _within(p: DataFrame, share: float) -> DataFrame:
    most = F.floor(F.greatest(F.length("ta"), F.length("tb")) * share).cast("int")
    return p.withColumn("most", most).withColumn("distance", F.expr("levenshtein(ta, tb, most)")).where("distance >= 0").select("a", "b", "distance")


def near_texts_of(t: DataFrame, every: int = 100, share: float = 0.1, block: int = 2_000) -> DataFrame:
    """(a, b, distance) of the held-out texts whose id is divisible by ``every``, each compared with all train texts.

    The stated query set goes against all rows in blocks of ``block`` texts, a broadcast of bounded size each.
    """
    asked = t.where(F.col("held") & (F.col("tid") % every == 0)).select(F.col("tid").alias("b"), F.col("text").alias("tb"))
    n = max(1, -(-asked.count() // block))
    train = t.where("train").select(F.col("tid").alias("a"), F.col("text").alias("ta"))
    out = None
    for k in range(n):
        part = asked.where(F.pmod(F.xxhash64("b"), F.lit(n)) == k)
        fits = (F.length("ta") >= F.floor(F.length("tb") * (1 - share))) & (F.length("tb") >= F.floor(F.length("ta") * (1 - share)))
        p = _within(train.join(F.broadcast(part), fits), share)
        out = p if out is None else out.unionByName(p)
    return out


def overlaps(df: DataFrame, least_chars: int = 40, share: float = 0.1) -> DataFrame:
    """(train_id, held_id, split_name, kind): pairs of a train and a held-out entry that share an image or their content."""
    t, entries = texts(df, least_chars)
    train, held = entries.where("split_name = 'train'"), entries.where("split_name <> 'train'")
    by_text = (
        cut(near_texts(t, share))
        .join(train.select(F.col("entry_id").alias("train_id"), F.col("tid").alias("a")), "a")
        .join(held.select(F.col("entry_id").alias("held_id"), "split_name", F.col("tid").alias("b")), "b")
        .select("train_id", "held_id", "split_name", F.lit("content").alias("kind"))
    )
    im = df.where(F.col("split_name").isNotNull()).select("entry_id", "split_name", F.explode("images").alias("p")).select("entry_id", "split_name", image_key(F.col("p")).alias("key")).where("key is not null").distinct()
    by_image = (
        im.where("split_name = 'train'").select(F.col("entry_id").alias("train_id"), "key")
        .join(im.where("split_name <> 'train'").select(F.col("entry_id").alias("held_id"), "split_name", "key"), "key")
        .select("train_id", "held_id", "split_name", F.lit("image").alias("kind"))
    )
    return by_text.unionByName(by_image).distinct()


def pairs(df: DataFrame) -> DataFrame:
    """(entry_a, entry_b), the smaller id first."""
    o = overlaps(df).select("train_id", "held_id").distinct()
    return o.select(F.least("train_id", "held_id").alias("entry_a"), F.greatest("train_id", "held_id").alias("entry_b"))


def counts(df: DataFrame) -> DataFrame:
    """(split_name, source, kind, entries, pairs): held-out entries with an overlap, per split and source."""
    o = overlaps(df).join(df.select(F.col("entry_id").alias("held_id"), "source"), "held_id")
    return o.groupBy("split_name", "source", "kind").agg(F.count_distinct("held_id").alias("entries"), F.count("*").alias("pairs"))
