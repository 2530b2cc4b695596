"""Jobs over the library, each a function and a subcommand: python -m corpusforge.jobs NAME ..."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge import schema
from corpusforge.functions import text as T
from corpusforge.operators import corruption, evaluation, layout, preference, profile, ranking, records
from corpusforge.runtime import cut
from corpusforge.sources import readers, writers

# Categories that are capped, and those raised to parity.
CAPPED, PRIORITY = ["ocr-dpo-handwritten", "ocr-dpo-shipinfo"], ["ocr-dpo-theseus", "ocr-dpo-nlfocr"]
# Draws again of a synthetic sample that would be one line too many; sizes of the type.
RETRIES, SIZES = 50, [24, 28, 32, 36, 40, 48]


def split_entries(manifest: DataFrame, out: str, train: float = 0.9, evaluation_share: float = 0.05, kfolds: int = 0, name_col=None) -> None:
    """Chat entries of a manifest as JSON lines per split, or per fold when ``kfolds`` is two or more.

    ``name_col`` is a function from the manifest to the column of image names; nested names are flattened by default.
    """
    named = manifest.withColumn("file_name", name_col(manifest)) if name_col else manifest
    e = records.chat_entries(named).select("messages", "images", "source").withColumn("image", F.get("images", F.lit(0)))
    ranked, n = ranking.hash_ranked(e, F.coalesce("image", F.to_json(F.struct("messages"))), F.xxhash64(F.to_json(F.struct("messages"))))
    if kfolds < 2:
        s = ranking.leak_free(ranked.withColumn("split", ranking.split_of(F.col("rank"), n, train, evaluation_share)), "split", "image")
        writers.split_lines(s.select("split", "messages", "images", "source"), "split", out)
        return
    f = ranked.withColumn("fold", ranking.folds(F.col("rank"), n, kfolds, train)).select("fold", "messages", "images", "source", "image")
    pool = f.where("fold >= 0").withColumn("of", F.explode(F.sequence(F.lit(0), F.lit(kfolds - 1))))
    pool = pool.withColumn("split", F.when(F.col("fold") == F.col("of"), "eval").otherwise("train"))
    keep = ranking.leak_free(pool.withColumn("key", F.concat_ws("|", "of", "image")), "split", "key").withColumn("split", F.concat(F.lit("fold_"), F.col("of"), F.lit("_"), F.col("split")))
    test = f.where("fold < 0").withColumn("split", F.lit("test"))
    cols = ["split", "messages", "images", "source"]
    writers.split_lines(keep.select(cols).unionByName(test.select(cols)), "split", out)


def direct_entries(manifest: DataFrame, out: str) -> None:
    """Chat entries of a manifest that is a split of its own."""
    writers.json_lines(records.chat_entries(manifest).select("messages", "images", "source"), out)


def ingest_tables(spark: SparkSession, paths: dict[str, str], out: str, source: str, kfolds: int = 0) -> None:
    """Foreign tables by split name as manifests, then entries: folds over all, one table split, several taken as they are."""
    made = {}
    for split, path in paths.items():
        m = records.conform(readers.load(spark, path), source)
        if m is None:
            continue
        m = ranking.positions(m)
        writers.manifest(m.withColumn("file_name", records.image_name(F.col("file_name"), F.col("position"))).drop("position"), f"{out}/{split}.parquet")
        made[split] = spark.read.parquet(f"{out}/{split}.parquet")
    if kfolds >= 2 and made:
        first, *rest = made.values()
        for m in rest:
            first = first.unionByName(m)
        split_entries(first, f"{out}/entries", kfolds=kfolds)
    elif len(made) == 1:
        split_entries(next(iter(made.values())), f"{out}/entries")
    else:
        for split, m in made.items():
            direct_entries(m, f"{out}/{split}.jsonl")


def ingest_dataset(spark: SparkSession, folder: str, out: str, source: str, kfolds: int = 0) -> None:
    """Whatever splits a dataset's folder has, as manifests and entries."""
    ingest_tables(spark, readers.splits_of(spark, folder), out, source, kfolds)


def ingest_flat(spark: SparkSession, path: str, images: str, out: str) -> DataFrame:
    """A table of texts and image names with the bytes of the images there are; returns the names of those that aren't."""
    m = records.conform(readers.load(spark, path)).withColumn("name", T.base_name(F.coalesce("image.path", "file_name")))
    img = readers.files(spark, images, "*", content=True).select("name", "content")
    m.join(img, "name").withColumn("image", F.struct(F.col("content").alias("bytes"), F.col("image.path").alias("path"))).drop("name", "content").write.mode("ignore").parquet(out)
    return m.join(img.select("name"), "name", "left_anti").select("name").distinct()


def standard(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of a dataset's folder, under whichever of the usual names it lies."""
    path = readers.first_existing(spark, folder)
    if path is None:
        raise FileNotFoundError(f"no manifest in {folder}")
    return readers.load(spark, path)


def dataset_card(spark: SparkSession, folder: str, out: str, name: str | None = None, description: str = "") -> None:
    """The card of a dataset's folder."""
    text = writers.card(standard(spark, folder), name or os.path.basename(folder.rstrip("/")).upper().replace("-", "_").replace(" ", "_"), description)
    with open(out, "w", encoding="utf-8") as f:
        f.write(text)


def ingest_pairs(spark: SparkSession, folder: str, out: str) -> None:
    """Paired image and text files."""
    writers.manifest(readers.paired(spark, folder), f"{out}/train.parquet")
    split_entries(spark.read.parquet(f"{out}/train.parquet"), f"{out}/entries")


#: Batches of a layout job.
PARTS = 20


def ingest_layout(spark: SparkSession, folder: str, out: str, source: str, resume: bool = False, generate: str | None = None, kfolds: int = 0) -> DataFrame:
    """Layout XML, with the scans beside it where there are any, as page and paragraph records; returns pages and paragraphs by number of columns.

    Records are written in PARTS batches of whole pages, merged into one manifest at the end; with ``resume`` the
    batches that an earlier run has written are not made again. Boxes are in the pixels of the scan. ``generate`` is a
    folder for the entries of the manifest.
    """
    target = f"{out}/train.parquet"
    s = readers.scans(spark, folder)
    size = lambda img, page: F.coalesce(img, page)
    bare = readers.layout_pages(spark, folder)
    stem = F.regexp_replace(T.stem(F.col("page_id")), "-gt2$", "")
    pages = bare.withColumn("stem", stem).join(s.select("stem", "img_w", "img_h"), "stem", "left")
    pages = cut(layout.with_columns_found(pages.withColumn("page_id", F.concat(F.lit(f"{source}__"), "stem"))))
    whole = pages.select("page_id", F.lit(source).alias("source"), F.concat("page_id", F.lit("__page.png")).alias("file_name"), layout.reading_text(F.col("placed")).alias("text"), F.lit("page").alias("type"), F.lit(None).cast("struct<left:int,upper:int,right:int,lower:int>").alias("box"))
    x, y = size(F.col("img_w"), F.col("page_w")) / F.col("page_w"), size(F.col("img_h"), F.col("page_h")) / F.col("page_h")
    scale = pages.select("page_id", x.alias("sx"), y.alias("sy"), size(F.col("img_w"), F.col("page_w")).alias("w"), size(F.col("img_h"), F.col("page_h")).alias("h"))
    para = layout.paragraphs(pages).join(scale, "page_id")
    box = F.struct((F.col("left") * F.col("sx")).cast("int").alias("left"), (F.col("upper") * F.col("sy")).cast("int").alias("upper"), F.least(F.col("w"), (F.col("right") * F.col("sx")).cast("int")).alias("right"), F.least(F.col("h"), (F.col("lower") * F.col("sy")).cast("int")).alias("lower"))
    para = para.select("page_id", F.lit(source).alias("source"), F.concat("page_id", F.lit("__para"), F.col("para"), F.lit(".png")).alias("file_name"), "text", F.lit("paragraph").alias("type"), box.alias("box"))
    if not readers._exists(spark, target):
        both = whole.where(~T.is_blank(F.col("text"))).unionByName(para).withColumn("batch", F.pmod(F.xxhash64("page_id"), F.lit(PARTS))).drop("page_id")
        writers.batches(both, f"{out}/parts", "batch", resume)
        writers.merged(spark, f"{out}/parts", target)
    if generate:
        split_entries(spark.read.parquet(target), generate, kfolds=kfolds)
    return pages.groupBy("n_cols").agg(F.count("*").alias("pages"))


def ingest_pages(spark: SparkSession, path: str, out: str, generate: str | None = None, dpi: int = 300, seed: str = "42", kfolds: int = 0) -> None:
    """Text lines of PDF pages, as an extractor leaves them, as page and paragraph records.

    ``path`` holds JSON lines (pdf_file, page, img_w, img_h, lines<text, x0, top, x1, bottom>) in points. A page of two
    lines or more gives its whole text, and up to five bands of its content with the box of their lines.
    """
    kind = "pdf_file string, page int, img_w int, img_h int, lines array<struct<text:string,x0:double,top:double,x1:double,bottom:double>>"
    p = spark.read.schema(kind).json(path).where(F.size("lines") >= 2).withColumn("page_id", F.concat_ws("|", "pdf_file", "page"))
    stem, page = T.stem(F.col("pdf_file")), F.concat(F.lit("p"), "page", F.lit("_"))
    text = lambda lines: F.array_join(F.filter(F.transform(lines, lambda x: T.strip(x["text"])), lambda t: t != ""), "\n")
    cols = ["source", "file_name", "pdf_file", "page", "text", "type", "box"]
    row = lambda d, name, t, kind, box: d.select(F.lit("theseus").alias("source"), F.concat_ws("_", stem, F.concat(page, name)).alias("file_name"), "pdf_file", "page", t.alias("text"), F.lit(kind).alias("type"), box.alias("box")).select(cols)
    whole = row(p, F.lit("page.png"), text(F.col("lines")), "page", F.lit(None).cast("struct<left:int,upper:int,right:int,lower:int>"))
    b = layout.band_lines(p, seed=seed)
    low, high = (lambda k: F.array_min(F.transform("own", lambda x: x[k]))), (lambda k: F.array_max(F.transform("own", lambda x: x[k])))
    pad, scale = 2, dpi / 72
    box = F.struct(
        F.greatest(F.lit(0.0), low("x0") * scale - pad).cast("int").alias("left"), F.greatest(F.lit(0.0), low("top") * scale - pad).cast("int").alias("upper"),
        F.least(F.col("img_w").cast("double"), high("x1") * scale + pad).cast("int").alias("right"), F.least(F.col("img_h").cast("double"), high("bottom") * scale + pad).cast("int").alias("lower"),
    )
    inside = F.filter("lines", lambda x: (x["top"] >= low("top")) & (x["bottom"] <= high("bottom")))
    para = row(b, F.concat(F.lit("para"), F.col("band"), F.lit(".png")), text(inside), "paragraph", box)
    writers.manifest(whole.unionByName(para), f"{out}/train.parquet")
    if generate:
        named = lambda m: records.page_image_name(F.col("pdf_file"), F.col("file_name"))
        split_entries(spark.read.parquet(f"{out}/train.parquet"), generate, kfolds=kfolds, name_col=named)


def synthetic(spark: SparkSession, corpus: str, fonts: list[str], out: str, samples: int, single_line_ratio: float = 0.01, evaluation_share: float = 0.05, test_share: float = 0.05, seed: str = "42") -> DataFrame:
    """A plan of synthetic samples: text, font, size and width of each, drawn with replacement, wrapped, and split in order.

    Samples of one line are taken until their cap; those beyond it are drawn again, up to RETRIES times, until one has
    several lines. Rendering is left to a renderer; the manifest tells it what to draw. Every draw is a hash of the
    seed, the sample's number and the attempt.
    """
    texts = cut(ranking.hash_ranked(readers.corpus_lines(spark, corpus), F.col("text"), F.lit(""))[0])
    n = texts.count()
    if not n or not fonts:
        raise ValueError("no valid text" if not n else "no font")
    draw = lambda tag, top: F.floor(T.unit_hash(F.concat_ws("|", F.lit(seed), F.lit(tag), "i", "attempt")) * top)
    def drawn(d: DataFrame) -> DataFrame:
        d = d.withColumns({"at": draw("text", n), "width": (draw("width", 36) + 45).cast("int")})
        d = d.join(texts.select(F.col("rank").alias("at"), F.col("text").alias("raw")), "at")
        return d.select("*", F.explode(F.array(T.wrapped(F.col("raw"), F.col("width")))).alias("text")).withColumn("single", ~F.col("text").contains("\n"))

    first = cut(drawn(spark.range(samples).select(F.col("id").alias("i"), F.lit(0).alias("attempt"))))
    cap = max(1, int(samples * single_line_ratio))
    over = ranking.rank_in_group(first.where("single"), "single", ["i"], "r").where(F.col("r") > cap).select("i")
    again = drawn(over.withColumn("attempt", F.explode(F.sequence(F.lit(1), F.lit(RETRIES)))))
    pick = ["text", "width", "single", "attempt"]
    again = again.groupBy("i").agg(F.min_by(F.struct(*pick), F.when(F.col("single"), RETRIES + 1 - F.col("attempt") / 1000).otherwise(F.col("attempt"))).alias("x")).select("i", "x.*")
    done = first.join(over, "i", "left_anti").select("i", *pick).unionByName(again)
    sizes = F.array(*map(F.lit, SIZES))
    done = done.withColumns({"font": F.element_at(F.array(*map(F.lit, fonts)), (draw("font", len(fonts)) + 1).cast("int")), "font_size": F.element_at(sizes, (draw("size", len(SIZES)) + 1).cast("int"))})
    a, b = int(samples * (1 - evaluation_share - test_share)), int(samples * evaluation_share)
    split = F.when(F.col("i") < a, "train").when(F.col("i") < a + b, "eval").otherwise("test")
    m = done.select("i", split.alias("split"), F.lit("synth").alias("source"), records.image_name(F.lit(None).cast("string"), F.col("i")).alias("file_name"), "text", F.when(F.col("single"), "text_line").otherwise("paragraph").alias("type"), "font", "font_size", "width")
    writers.manifest(m, f"{out}/dataset.parquet")
    m = spark.read.parquet(f"{out}/dataset.parquet")
    writers.split_lines(records.chat_entries(m).select("split", "messages", "images"), "split", f"{out}/entries")
    return m


def ingest_tsv(spark: SparkSession, tsv: str, images: str, out: str) -> DataFrame:
    """A TSV list joined with the images it names; returns the names without an image."""
    rows = readers.tsv_list(spark, tsv)
    img = readers.files(spark, images, "*", content=True).select(F.col("name").alias("file_name"), F.struct(F.col("content").alias("bytes"), F.lit(None).cast("string").alias("path")).alias("image"))
    writers.manifest(rows.where(~T.is_blank(F.col("text"))).join(img, "file_name").withColumn("type", F.lit("text_line")), out)
    return rows.join(img.select("file_name"), "file_name", "left_anti").select("file_name").distinct().orderBy("file_name")


def evaluate(spark: SparkSession, path: str, out: str, worst: int = 0) -> None:
    """Scores once, then summary, percentiles, buckets, sources and worst cases as tables."""
    good, bad = readers.json_tolerant(spark, path, schema.EVALUATION)
    s = cut(evaluation.scored(evaluation.pairs(good)).withColumn("row", F.xxhash64("image", "pred", "ref")))
    for m in ("ned", "cer", "wer"):
        evaluation.summary(s, m).write.mode("overwrite").parquet(f"{out}/{m}_summary")
        evaluation.percentiles(s, m).write.mode("overwrite").parquet(f"{out}/{m}_percentiles")
        evaluation.buckets(s, m).write.mode("overwrite").parquet(f"{out}/{m}_buckets")
    evaluation.by_source(s).write.mode("overwrite").parquet(f"{out}/by_source")
    if worst:
        evaluation.worst(s, worst, "row").write.mode("overwrite").parquet(f"{out}/worst")
    bad.write.mode("overwrite").parquet(f"{out}/malformed")


def build_pairs(spark: SparkSession, files: dict[str, str], image_folders: list[str], out: str, max_samples: int | None = None, train: float = 1.0, evaluation_share: float = 0.0) -> DataFrame:
    """Preference pairs of several result files by category; returns the funnel.

    Real pairs first, the first file and line of an image winning; then one synthetic pair for each image that
    gave none; hash order, limit, cap, parity, split.
    """
    every = None
    for k, (category, path) in enumerate(files.items()):
        good, _ = readers.json_tolerant(spark, path, schema.EVALUATION, "line_ord")
        r = good.withColumns({"category": F.lit("ocr-dpo-" + category), "file_ord": F.lit(k)})
        every = r if every is None else every.unionByName(r)
    index = readers.image_index(spark, image_folders)
    s = preference.first_wins(preference.staged(every, index), ["file_ord", "line_ord"])
    s = cut(s)
    real = s.where("stage = 'kept'")
    unused = s.join(real.select("image_name"), "image_name", "left_anti").join(index.select("image_name"), "image_name").where(~T.is_blank(F.col("chosen")))
    unused = unused.groupBy("image_name").agg(F.min_by(F.struct("chosen", "image", "category"), F.struct("file_ord", "line_ord")).alias("x")).select("image_name", "x.*")
    synth = corruption.variants(unused, "chosen", "image_name", 2).groupBy("image_name", "chosen", "image", "category").agg(F.min_by("rejected", "variant").alias("rejected"))
    cols = ["image_name", "chosen", "rejected", "image", "category"]
    both = real.select(cols).unionByName(synth.select(cols)).withColumn("h", F.md5("image_name"))
    if max_samples:
        first, _ = ranking.hash_ranked(both, F.col("image_name"), F.col("rejected"))
        both = first.where(F.col("rank") < max_samples).drop("rank", "n_total")
    full = preference.oversampled(preference.capped(both, "category", CAPPED, ["h", "image_name"]), "category", PRIORITY, "image_name")
    ranked, n = ranking.hash_ranked(full, F.col("image_name"), F.col("copy"))
    done = ranked.select(ranking.two_way(F.col("rank"), n, train, evaluation_share).alias("split"), *preference.pair_record(F.col("chosen"), F.col("rejected"), F.col("image"), F.col("category")))
    writers.split_lines(done, "split", out)
    return preference.funnel(s, "category")


def summary(spark: SparkSession, path: str, images: int = 2000) -> tuple[DataFrame, ...]:
    """(length profile, source shares, sizes of a sample of the images) of a dataset; without images the last is missing."""
    d = readers.load(spark, path)
    out = (profile.length_profile(d.select("text"), []), profile.shares(d, "source").orderBy("source"))
    if "image" not in d.columns:
        return out
    some = profile.seeded_sample(d.select("file_name", "image"), "file_name", images).select(*profile.png_size()).where("bytes is not null")
    stats = [F.count("*").alias("images")] + [f(c).alias(f"{c}_{n}") for c in ("width", "height", "bytes") for n, f in (("mean", F.avg), ("min", F.min), ("max", F.max))]
    return (*out, some.agg(*stats))


def sample(spark: SparkSession, path: str, n: int = 10, seed: str = "42", images_out: str | None = None) -> DataFrame:
    """n records drawn by seed with a preview of their text; their images are written to a folder if one is named."""
    d = readers.load(spark, path)
    s = profile.seeded_sample(d, "file_name", n)
    if images_out:
        stem = F.when(F.coalesce(F.col("file_name"), F.lit("")) != "", T.base_name(F.col("file_name"))).otherwise(F.sha2(F.coalesce("text", F.lit("")), 256))
        known = F.lower(stem).rlike(r"\.(jpg|jpeg|png|gif|bmp)$")
        writers.side_files(s.select(F.when(known, stem).otherwise(F.concat(F.regexp_replace(stem, r"\.[^.]*$", ""), F.lit(".jpg"))).alias("name"), F.col("image.bytes").alias("b")), "name", "b", images_out)
    preview = F.when(F.length("text") > 50, F.concat(F.substr("text", F.lit(1), F.lit(50)), F.lit("..."))).otherwise(F.col("text"))
    return s.select("source", "file_name", preview.alias("text")).orderBy("file_name")


def shuffled_split(spark: SparkSession, path: str, out: str, train: float = 0.8, evaluation_share: float = 0.1, seed: str = "42") -> DataFrame:
    """Entries of a manifest in seeded order, cut into train, eval and test by rank; returns the sizes."""
    e = records.chat_entries(spark.read.parquet(path)).select("messages", "images", "source")
    key = F.concat(F.lit(seed), F.to_json(F.struct("images", "messages")))
    ranked, n = ranking.hash_ranked(e, key, F.coalesce("source", F.lit("")))
    s = ranked.select(ranking.split_of(F.col("rank"), n, train, evaluation_share).alias("split"), "messages", "images", "source")
    writers.split_lines(s, "split", out)
    return s.groupBy("split").agg(F.count("*").alias("n"))


def mixture(spark: SparkSession, paths: list[str], mode: str = "sqrt") -> DataFrame:
    """(path, n, prob) of entry files by their numbers of lines."""
    sizes = None
    for p in paths:
        n = spark.read.text(p).where(F.trim("value") != "").select(F.lit(p).alias("path"))
        sizes = n if sizes is None else sizes.unionByName(n)
    return profile.probabilities(sizes, "path", mode).orderBy(F.desc("n"))


def stage_images(spark: SparkSession, lists: list[str], source: str, target: str, missing_out: str | None = None, move: bool = True) -> DataFrame:
    """Images that TSV lists name, brought to one folder; returns how many were and weren't there, whose names go to a file."""
    names = None
    for p in lists:
        n = readers.tsv_list(spark, p).select("file_name")
        names = n if names is None else names.unionByName(n)
    done = writers.staged(names, source, target, move)
    if missing_out:
        done.where("not done").select("name").sort("name").coalesce(1).write.mode("overwrite").text(missing_out)
    return done.groupBy("done").agg(F.count("*").alias("files"))


def flag(name: str, default: str) -> str:
    """A default from the environment: CORPUSFORGE_ and the name."""
    return os.environ.get(f"CORPUSFORGE_{name.upper()}", default)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="corpusforge")
    sub = p.add_subparsers(dest="job", required=True)
    jobs = {
        "ingest-dataset": (ingest_dataset, ["folder", "out", "source"], {"kfolds": int}),
        "ingest-flat": (ingest_flat, ["path", "images", "out"], {}),
        "dataset-card": (dataset_card, ["folder", "out"], {"name": str, "description": str}),
        "ingest-pairs": (ingest_pairs, ["folder", "out"], {}),
        "ingest-layout": (ingest_layout, ["folder", "out", "source"], {"resume": bool, "generate": str, "kfolds": int}),
        "ingest-pages": (ingest_pages, ["path", "out"], {"generate": str, "dpi": int, "kfolds": int}),
        "ingest-tsv": (ingest_tsv, ["tsv", "images", "out"], {}),
        "evaluate": (evaluate, ["path", "out"], {"worst": int}),
        "summary": (summary, ["path"], {"images": int}),
        "sample": (sample, ["path"], {"n": int, "seed": str, "images-out": str}),
        "split": (shuffled_split, ["path", "out"], {"train": float, "evaluation-share": float, "seed": str}),
        "mixture": (mixture, ["paths+"], {"mode": str}),
        "stage-images": (stage_images, ["source", "target", "lists+"], {"missing-out": str}),
        "synthetic": (synthetic, ["corpus", "out", "samples", "fonts+"], {"single-line-ratio": float, "seed": str}),
    }
    for name, (_, args, options) in jobs.items():
        s = sub.add_parser(name)
        for a in args:
            s.add_argument(a.rstrip("+"), type=int if a == "samples" else str, **({"nargs": "+"} if a.endswith("+") else {}))
        for o, kind in options.items():
            s.add_argument(f"--{o}", **({"action": "store_true"} if kind is bool else {"type": kind, "default": kind(flag(o.replace("-", "_"), "")) if flag(o.replace("-", "_"), "") else None}))
    a = {k: v for k, v in vars(p.parse_args(argv)).items() if v is not None}
    spark = SparkSession.builder.getOrCreate()
    made = jobs[a.pop("job")][0](spark, **a)
    for d in made if isinstance(made, tuple) else [made] if made is not None else []:
        d.show(100, truncate=80)


if __name__ == "__main__":
    main()
