"""Readers: parquet, JSON lines of three tempers, TSV lists, paired files, layout XML, file listings."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from corpusforge.functions import text as T
from corpusforge.operators.records import handle_pdf_name, handles

CORRUPT = "_corrupt"


def load(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet or JSON lines by suffix."""
    if path.rstrip("/").endswith(".parquet"):
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    if path.endswith((".jsonl", ".json")):
        return json_strict(spark, path, schema)
    raise ValueError(f"no reader for {path}")


def json_strict(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A malformed line ends the job."""
    r = spark.read.option("mode", "FAILFAST")
    return (r.schema(schema) if schema else r).json(path)


def json_silent(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Malformed lines are left out."""
    good, _ = json_tolerant(spark, path, schema)
    return good


def json_tolerant(spark: SparkSession, path: str, schema: StructType, place: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, malformed lines as ``line``); blank lines are neither.

    ``place`` names a column that orders the records as their lines are: file, start of the file's split, line in it.
    """
    lines = spark.read.text(path)
    where = [F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line")).alias(place)] if place else []
    lines = lines.select("value", *where).where(F.trim("value") != "")
    full = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    parsed = lines.select("value", *([place] if place else []), F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r"))
    bad = F.col(f"r.{CORRUPT}").isNotNull()
    return parsed.where(~bad).select(*[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields], *([place] if place else [])), parsed.where(bad).select(F.col("value").alias("line"))


def json_line_count(spark: SparkSession, path: str) -> int:
    """Non-blank lines, without parsing."""
    return spark.read.text(path).where(F.trim("value") != "").count()


def tsv_list(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, text) of lines with a tab; further tabs and quotes belong to the text."""
    parts = F.split("value", "\t", 2)
    return spark.read.text(path).where(F.size(parts) >= 2).select(parts[0].alias("file_name"), parts[1].alias("text"))


def files(spark: SparkSession, path: str, pattern: str, content: bool = False) -> DataFrame:
    """(path, dir, name, bytes) of a folder tree; hidden ``._`` files left out; contents only when asked for."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    f = f.withColumn("name", T.base_name(F.col("path"))).where(~F.col("name").startswith("._"))
    return f.select("path", F.regexp_replace("path", "/[^/]*$", "").alias("dir"), "name", F.col("length").alias("bytes"), *(["content"] if content else []))


def paired(spark: SparkSession, path: str, image_suffix: str = ".bin.png", text_suffix: str = ".gt.txt") -> DataFrame:
    """Images and texts of equal folder and stem as manifest rows ``source__split__stem.png``; an equi-join."""
    cut = lambda c, s: F.expr(f"left({c}, length({c}) - {len(s)})")
    img = files(spark, path, f"*{image_suffix}", content=True).select("dir", cut("name", image_suffix).alias("stem"), "content")
    txt = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{text_suffix}").text(path).select("value", F.col("_metadata.file_path").alias("p"))
    txt = txt.select(F.regexp_replace("p", "/[^/]*$", "").alias("dir"), cut("substring_index(p, '/', -1)", text_suffix).alias("stem"), F.col("value").alias("text"))
    norm = lambda c: F.regexp_replace(c, "^file:/+", "/")
    j = img.withColumn("dir", norm("dir")).join(txt.withColumn("dir", norm("dir")), ["dir", "stem"]).where(~T.is_blank(F.col("text")))
    parts = F.split("dir", "/")
    return j.select(
        F.element_at(parts, -2).alias("source"), F.concat(F.concat_ws("__", F.element_at(parts, -2), F.element_at(parts, -1), "stem"), F.lit(".png")).alias("file_name"),
        T.strip(F.col("text")).alias("text"), F.lit("text_line").alias("type"), F.struct(F.col("content").alias("bytes"), F.lit(None).cast("string").alias("path")).alias("image"),
    )


PAGE = "page_id string, page_w int, page_h int, blocks array<struct<bbox:struct<hpos:int,vpos:int,w:int,h:int>,lines:array<string>>>, error string"


def _whole(value: str | None) -> int:
    """A size or place of layout XML; some writers give fractions."""
    return int(float(value or 0))


def parse_layout(data: bytes) -> tuple[int, int, list] | None:
    """(width, height, blocks) of the first page of a layout file, whatever its name spaces; None without a page of some size.

    Blocks stand at any depth below the page, in margins and composed blocks too; words are joined by spaces, and
    empty words, lines and blocks are dropped.
    """
    def named(e, name):
        return [x for x in e.iter() if isinstance(x.tag, str) and x.tag.rpartition("}")[2] == name]

    page = next(iter(named(ElementTree.fromstring(data), "Page")), None)
    if page is None or _whole(page.get("WIDTH")) <= 0 or _whole(page.get("HEIGHT")) <= 0:
        return None
    blocks = []
    for b in named(page, "TextBlock"):
        lines = [" ".join(w for w in (s.get("CONTENT") for s in named(x, "String")) if w).strip() for x in named(b, "TextLine")]
        if any(lines):
            blocks.append(({k: _whole(b.get(n)) for k, n in (("hpos", "HPOS"), ("vpos", "VPOS"), ("w", "WIDTH"), ("h", "HEIGHT"))}, [x for x in lines if x]))
    return _whole(page.get("WIDTH")), _whole(page.get("HEIGHT")), blocks


def _pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for name, data in zip(b["name"], b["content"]):
            try:
                p = parse_layout(bytes(data))
                out.append((name, None, None, None, "no page size") if p is None else (name, p[0], p[1], [{"bbox": box, "lines": lines} for box, lines in p[2]], None))
            except (ElementTree.ParseError, ValueError) as e:  # one bad file is a row, not the end of the job
                out.append((name, None, None, None, str(e)))
        yield pd.DataFrame(out, columns=["page_id", "page_w", "page_h", "blocks", "error"])


def layout_files(spark: SparkSession, path: str, pattern: str = "*.xml") -> DataFrame:
    """(page_id, page_w, page_h, blocks, error) of each layout XML file."""
    return files(spark, path, pattern, content=True).select("name", "content").mapInPandas(_pages, PAGE)


def layout_pages(spark: SparkSession, path: str, pattern: str = "*.xml") -> DataFrame:
    """(page_id, page_w, page_h, blocks) of the layout XML files that can be read."""
    return layout_files(spark, path, pattern).where("error is null").drop("error")


def tiff_size(data: bytes) -> tuple[int, int] | None:
    """Width and height from the first directory of a TIFF file."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or len(data) < 8:
        return None
    at = struct.unpack(order + "I", data[4:8])[0]
    if at + 2 > len(data):
        return None
    found = {}
    for k in range(struct.unpack(order + "H", data[at : at + 2])[0]):
        entry = data[at + 2 + 12 * k : at + 14 + 12 * k]
        if len(entry) == 12:
            tag, kind = struct.unpack(order + "HH", entry[:4])
            if tag in (256, 257):
                found[tag] = struct.unpack(order + ("H" if kind == 3 else "I"), entry[8 : 10 if kind == 3 else 12])[0]
    return (found[256], found[257]) if len(found) == 2 else None


def scans(spark: SparkSession, path: str, suffix: str = ".tif", sidecar: str = "-gt2.xml") -> DataFrame:
    """(stem, path, img_w, img_h, page_w, page_h, blocks): scans joined with the layout file beside them; those without one are left out."""
    def sized(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            size = [tiff_size(bytes(c)) or (None, None) for c in b["content"]]
            yield pd.DataFrame({"stem": b["name"].str[: -len(suffix)], "path": b["path"], "img_w": pd.array([s[0] for s in size], "Int32"), "img_h": pd.array([s[1] for s in size], "Int32")})

    img = files(spark, path, f"*{suffix}", content=True).select("name", "path", "content").mapInPandas(sized, "stem string, path string, img_w int, img_h int")
    xml = layout_pages(spark, path, f"*{sidecar}").withColumn("stem", F.expr(f"left(page_id, length(page_id) - {len(sidecar)})")).drop("page_id")
    return img.join(xml, "stem")


def scan_folders(spark: SparkSession, one: str | None, out: str, pair: dict[str, str], suffix: str = ".tif") -> dict[str, str]:
    """Where the scans of a job lie: the folder given, else the output folder if it holds scans, else the default pair."""
    if one:
        return {"nlf": one}
    return {"nlf": out} if _listed(spark, out, f"*{suffix}") else {k: v for k, v in pair.items() if _exists(spark, v)}


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _listed(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Sorted paths of a folder's files of that name; hidden ``._`` ones left out."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{pattern}")
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    names = [str(f.getPath().toString()) for f in found or []]
    return sorted(n for n in names if not n.rsplit("/", 1)[-1].startswith("._"))


def splits_of(spark: SparkSession, folder: str, names: tuple[str, ...] = ("train", "validation", "eval", "test")) -> dict[str, str]:
    """The splits that a folder of a dataset has, each as one file or as numbered parts."""
    out = {}
    for n in names:
        for pattern in (f"{n}.parquet", f"{n}-*.parquet", f"{n}.jsonl"):
            if _listed(spark, folder, pattern):
                out[n] = f"{folder}/{pattern}"
                break
    return out


def fonts(spark: SparkSession, folder: str) -> list[str]:
    """Font files of a folder tree, sorted; none is an error."""
    found = [] if not _exists(spark, folder) else sorted(r["path"] for s in ("ttf", "otf") for r in files(spark, folder, f"*.{s}").select("path").collect())
    if not found:
        raise FileNotFoundError(f"no fonts in {folder}")
    return found


def corpus_lines(spark: SparkSession, path: str) -> DataFrame:
    """(text) of the valid lines of a corpus file."""
    t = spark.read.text(path).select(T.strip(F.col("value")).alias("text"))
    return t.where(T.valid_corpus_text(F.col("text")))


def harvested(spark: SparkSession, path: str) -> DataFrame:
    """(page, handle, pdf_name, token) of saved harvest pages: their handles, and the token of the next page."""
    x = spark.read.option("wholetext", "true").text(path).select(F.col("_metadata.file_name").alias("page"), "value")
    token = F.nullif(F.regexp_extract("value", r"<resumptionToken[^>]*>([^<]+)</resumptionToken>", 1), F.lit(""))
    x = x.select("page", F.explode(handles(F.col("value"))).alias("handle"), token.alias("token"))
    return x.select("page", "handle", handle_pdf_name(F.col("handle")).alias("pdf_name"), "token")


# The usual names of a dataset's parquet file, in order of preference.
def first_existing(spark: SparkSession, folder: str, names: tuple[str, ...] = ("train-00001-of-00001", "train", "data_std", "data")) -> str | None:
    """First of the usual parquet names that a folder holds."""
    return next((f"{folder}/{n}.parquet" for n in names if _exists(spark, f"{folder}/{n}.parquet")), None)


def kept_index(spark: SparkSession, folders: list[str], path: str, pattern: str = "*.png") -> DataFrame:
    """The image index as it was written at ``path``, made first where it isn't there."""
    image_index(spark, folders, pattern).write.mode("ignore").parquet(path)
    return spark.read.parquet(path)


def image_index(spark: SparkSession, folders: list[str], pattern: str = "*.png") -> DataFrame:
    """(image_name, dir, dir_ord): where each image lies; the first folder that has it wins."""
    out = None
    for k, d in enumerate(folders):
        f = files(spark, d, pattern).select(F.col("name").alias("image_name"), "dir", F.lit(k).alias("dir_ord"))
        out = f if out is None else out.unionByName(f)
    return out.groupBy("image_name").agg(F.min_by("dir", "dir_ord").alias("dir"), F.min("dir_ord").alias("dir_ord"))
