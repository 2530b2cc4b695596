"""Schemas of the record shapes the engine reads and writes."""

from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructField, StructType


def _s(name: str) -> StructField:
    return StructField(name, StringType())


IMAGE = StructType([StructField("bytes", BinaryType()), _s("path")])
MANIFEST = StructType([_s("source"), _s("file_name"), _s("text"), _s("type"), StructField("image", IMAGE)])
PAGE_MANIFEST = StructType([*MANIFEST.fields, _s("pdf_file"), StructField("page", IntegerType())])
MESSAGE = StructType([_s("role"), _s("content")])
CHAT = StructType([StructField("messages", ArrayType(MESSAGE)), StructField("images", ArrayType(StringType())), _s("source")])
EVALUATION = StructType([*CHAT.fields, _s("answer"), _s("label")])
PREFERENCE = StructType(
    [
        StructField("messages", ArrayType(MESSAGE)), StructField("chosen_response", ArrayType(MESSAGE)), StructField("rejected_response", ArrayType(MESSAGE)),
        StructField("images", ArrayType(StringType())), _s("category"), StructField("audios", ArrayType(StringType())), StructField("videos", ArrayType(StringType())),
    ]
)
BOX = StructType([StructField(x, IntegerType()) for x in ("hpos", "vpos", "w", "h")])
BLOCK = StructType([StructField("bbox", BOX), StructField("lines", ArrayType(StringType()))])
