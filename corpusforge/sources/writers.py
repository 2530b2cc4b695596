"""Writers: manifests, JSON lines, side files, dataset cards."""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.functions.text import WS
from corpusforge.operators.records import size_class
from corpusforge.runtime import cut
from corpusforge.sources.readers import _exists, _listed


def manifest(df: DataFrame, path: str, mode: str = "ignore") -> None:
    """Snappy parquet; an existing output is left alone by default."""
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def concatenated(spark: SparkSession, paths: list[str], out: str) -> None:
    """Several manifests, older ones without ``type`` too, as one."""
    df = spark.read.option("mergeSchema", "true").parquet(*paths)
    df.write.mode("ignore").option("compression", "snappy").parquet(out)


def json_lines(df: DataFrame, path: str, mode: str = "ignore") -> None:
    """One document a line, non-ASCII kept, empty fields kept."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode(mode).text(path)


def split_lines(df: DataFrame, split: str, path: str) -> None:
    """A folder of JSON lines per split, in one pass."""
    df.select(split, F.to_json(F.struct(*[c for c in df.columns if c != split]), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").partitionBy(split).text(path)


def batches(df: DataFrame, path: str, batch: str, resume: bool = False) -> None:
    """Parts by batch; writing a batch again replaces only that batch. With ``resume`` only the batches that aren't there are made."""
    if resume:
        done = [x.rsplit("=", 1)[-1] for x in _listed(df.sparkSession, path, f"{batch}=*")]
        df = df.where(~F.col(batch).cast("string").isin(done)) if done else df
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(batch).parquet(path)


def side_files(df: DataFrame, name: str, content: str, folder: str) -> None:
    """One file a distinct name, written if absent. The folder must be one all executors share."""

    def put(rows):
        os.makedirs(folder, exist_ok=True)
        for r in rows:
            target = os.path.join(folder, os.path.basename(r[0]))
            if not os.path.exists(target):
                part = f"{target}.{os.getpid()}.part"
                with open(part, "wb") as f:
                    f.write(r[1])
                os.replace(part, target)

    df.where(F.col(content).isNotNull()).groupBy(name).agg(F.min(content)).foreachPartition(put)


def merged(spark: SparkSession, parts: str, out: str, batch: str = "batch") -> int:
    """The parts of a job as one manifest, then the parts deleted; an existing output is left alone. Returns its rows."""
    if not _exists(spark, out):
        manifest(spark.read.parquet(parts).drop(batch), out)
    where = spark._jvm.org.apache.hadoop.fs.Path(parts)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return spark.read.parquet(out).count()


def document(value, path: str) -> None:
    """One JSON document, non-ASCII kept."""
    with open(path, "w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False, indent=2)


def text_lines(df: DataFrame, text: str, path: str, mode: str = "ignore") -> None:
    """One text a line, white space inside taken as one space."""
    df.select(F.trim(F.regexp_replace(text, f"{WS}+", " ")).alias("value")).where("value <> ''").write.mode(mode).text(path)


def staged(names: DataFrame, source: str, target: str, move: bool = False) -> DataFrame:
    """(name, done): files of a set of names copied, or moved, from one folder to another; a file that is there is replaced.

    Both folders must be ones all executors share. Names are taken once, and never lead out of the folders.
    """
    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(target, exist_ok=True)
        for b in batches:
            done = []
            for n in b["name"]:
                a, z = os.path.join(source, os.path.basename(n)), os.path.join(target, os.path.basename(n))
                there = os.path.exists(a)
                if there:
                    shutil.copyfile(a, f"{z}.part")
                    os.replace(f"{z}.part", z)
                    if move:
                        os.remove(a)
                done.append(there or move and os.path.exists(z))  # a task that runs again finds its file moved
            yield pd.DataFrame({"name": b["name"], "done": done})

    return cut(names.toDF("name").where("name is not null").distinct().mapInPandas(put, "name string, done boolean"))


# What the columns of a manifest hold.
DESCRIPTIONS = {"source": "name of the collection", "file_name": "name of the image file", "text": "transcription", "type": "text_line, paragraph or page", "image": "image bytes"}


def card(df: DataFrame, name: str, description: str, text: str = "text") -> str:
    """Dataset card in markdown from schema, size and one row."""
    n = df.count()
    label = df.sparkSession.range(1).select(size_class(F.lit(n)).alias("c")).first()["c"]
    first = df.where(F.col(text).isNotNull()).select(F.substr(text, F.lit(1), F.lit(50)).alias("t")).first()
    fields = "\n".join(f"| {f.name} | {f.dataType.simpleString()} | {DESCRIPTIONS.get(f.name, '')} |" for f in df.schema.fields)
    features = "\n".join(f"  - name: {f.name}\n    dtype: {'image' if f.name == 'image' else f.dataType.simpleString()}" for f in df.schema.fields)
    return f"---\nname: {name}\nsize_categories: [{label}]\nfeatures:\n{features}\n---\n# {name}\n\n{description}\n\n{n:,} rows\n\n| column | type | content |\n|---|---|---|\n{fields}\n\nExample: {first['t'] if first else ''!r}\n"
