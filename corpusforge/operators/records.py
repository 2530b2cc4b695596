"""Record shaping: names, types, chat entries, preference pairs, column detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructType

from corpusforge.functions import text as T

PROMPT = "<image>OCR:"
# Column names looked for in a foreign table, in order of preference.
IMAGE_COLUMNS = ["image", "img", "image_path"]
TEXT_COLUMNS = ["text", "transcript", "label", "ground_truth", "ocr_text"]
NAME_COLUMNS = ["file_name", "filename", "id"]


def detected(df: DataFrame, wanted: list[str]) -> str | None:
    """First of ``wanted`` that ``df`` has; decided from the schema, no data read."""
    return next((c for c in wanted if c in df.columns), None)


def conform(df: DataFrame, source: str | None = None, kind: str = "text_line") -> DataFrame | None:
    """A foreign table as a manifest; None when it has no text or image column."""
    text, image, name = (detected(df, w) for w in (TEXT_COLUMNS, IMAGE_COLUMNS, NAME_COLUMNS))
    if text is None or image is None:
        return None
    out = df.where(~T.is_blank(F.col(text)))
    return out.select(
        (F.lit(source) if source else F.col("source") if "source" in df.columns else F.lit(None).cast("string")).alias("source"),
        (F.col(name).cast("string") if name else F.lit(None).cast("string")).alias("file_name"),
        T.strip(F.col(text)).alias("text"), (F.col("type") if "type" in df.columns else F.lit(kind)).alias("type"), image_value(df, image).alias("image"),
    )


def image_value(df: DataFrame, image: str) -> Column:
    """An image column of whatever kind (bytes, a path, or a struct of either) as STRUCT<bytes, path>; null where it has neither."""
    kind, c = df.schema[image].dataType, F.col(image)
    names = kind.names if isinstance(kind, StructType) else []
    if isinstance(kind, StructType):
        raw, path = (c[n] if n in names else F.lit(None) for n in ("bytes", "path"))
    else:
        raw, path = (c, F.lit(None)) if isinstance(kind, BinaryType) else (F.lit(None), c)
    return F.when(raw.isNotNull() | path.isNotNull(), F.struct(raw.cast("binary").alias("bytes"), path.cast("string").alias("path")))


def image_name(name: Column, position: Column) -> Column:
    """Given name, or the position padded with zeros to eight digits at least, with ``.png`` at the end."""
    digits = position.cast("string")
    n = F.coalesce(name, F.concat(F.repeat(F.lit("0"), F.greatest(F.lit(0), 8 - F.length(digits))), digits))
    return F.when(n.endswith(".png"), n).otherwise(F.concat(n, F.lit(".png")))


def flat_name(name: Column) -> Column:
    """First and last segment of a nested path joined by ``_``."""
    parts = F.split(name, "/")
    return F.when(F.size(parts) > 1, F.concat_ws("_", F.get(parts, F.lit(0)), F.element_at(parts, -1))).otherwise(name)


def page_image_name(pdf_file: Column, name: Column) -> Column:
    """Third ``_`` token of the PDF's stem, or the stem, before the image name, unless it is there already."""
    stem = T.stem(pdf_file)
    parts = F.split(stem, "_")
    prefix = F.when(F.size(parts) >= 3, F.get(parts, F.lit(2))).otherwise(stem)
    return F.when(prefix.isNull() | (prefix == "") | name.startswith(F.concat(prefix, F.lit("_"))), name).otherwise(F.concat_ws("_", prefix, name))


def kind_of(text: Column) -> Column:
    return F.when(text.contains("\n"), "paragraph").otherwise("text_line")


def size_class(n: Column) -> Column:
    return F.when(n < 1_000, "n<1K").when(n < 10_000, "1K<n<10K").when(n < 100_000, "10K<n<100K").otherwise("100K<n<1M")


def chat_messages(text: Column, prompt: str = PROMPT) -> Column:
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(turn("user", F.lit(prompt)), turn("assistant", text))


def chat_entries(manifest: DataFrame) -> DataFrame:
    """Training entries of the non-blank records."""
    m = manifest.where(~T.is_blank(F.col("text")))
    return m.withColumns({"messages": chat_messages(F.col("text")), "images": F.array(F.concat(F.lit("./images/"), flat_name(F.col("file_name"))))})


def first_link(html: Column, contains: str = "/bitstream/", ends: str = ".pdf") -> Column:
    """First href whose path, cut at ``?``, holds and ends as asked, case ignored; the link is cut at ``&``."""
    links = F.regexp_extract_all(html, F.lit(r'href="([^"]*)"'), F.lit(1))
    path = lambda h: F.lower(F.substring_index(h, "?", 1))
    return F.substring_index(F.get(F.filter(links, lambda h: path(h).contains(contains) & path(h).endswith(ends)), F.lit(0)), "&", 1)


def handles(xml: Column) -> Column:
    """Distinct /handle/ identifiers of a harvested page."""
    ids = F.regexp_extract_all(xml, F.lit(r"<dc:identifier>([^<]*)</dc:identifier>"), F.lit(1))
    return F.array_distinct(F.filter(ids, lambda x: x.contains("/handle/")))


def handle_pdf_name(handle: Column) -> Column:
    """File name of a handle's PDF: its last segment, a closing slash ignored."""
    return F.concat(F.lit("theseus_"), F.substring_index(F.regexp_replace(handle, "/+$", ""), "/", -1), F.lit(".pdf"))
