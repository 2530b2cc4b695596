"""Readers and writers on small folders; incremental ingest."""

import json
import os
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from corpusforge import schema
from corpusforge.operators.profile import png_size
from corpusforge.sources import readers as R
from corpusforge.sources import writers as W
from corpusforge.streaming import ingest


def png(w, h):
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IEND", b"")


def test_json_lines(spark, tmp_path):
    good = {"messages": [{"role": "user", "content": "x"}, {"role": "assistant", "content": "päivä"}], "images": [], "source": "s", "answer": "a", "label": None}
    (tmp_path / "r.jsonl").write_text(json.dumps(good, ensure_ascii=False) + "\n\n{broken\n" + json.dumps({"answer": "b"}) + "\n")
    p = str(tmp_path / "r.jsonl")
    rows, bad = R.json_tolerant(spark, p, schema.EVALUATION)
    assert sorted(r.answer for r in rows.collect()) == ["a", "b"] and [r.line for r in bad.collect()] == ["{broken"]
    assert R.json_silent(spark, p, schema.EVALUATION).count() == 2 and R.json_line_count(spark, p) == 3
    with pytest.raises(Exception):
        R.json_strict(spark, p, schema.EVALUATION).collect()
    W.json_lines(rows, str(tmp_path / "out"))
    back = spark.read.schema(schema.EVALUATION).json(str(tmp_path / "out"))
    assert {tuple(map(str, r)) for r in back.collect()} == {tuple(map(str, r)) for r in rows.collect()}
    W.json_lines(rows.limit(0), str(tmp_path / "out"))
    assert back.count() == 2
    with pytest.raises(ValueError):
        R.load(spark, "x.csv")


def test_tsv(spark, tmp_path):
    (tmp_path / "l.tsv").write_text('a.png\t"kala"\tmeri\nno tab\nb.png\t\n')
    assert [tuple(r) for r in R.tsv_list(spark, str(tmp_path / "l.tsv")).collect()] == [("a.png", '"kala"\tmeri'), ("b.png", "")]


def test_paired_files_and_index(spark, tmp_path):
    d = tmp_path / "fin" / "train"
    d.mkdir(parents=True)
    (d / "x1.bin.png").write_bytes(png(3, 4))
    (d / "x1.gt.txt").write_text(" päivä \n")
    (d / "x2.bin.png").write_bytes(png(1, 1))
    (d / "._x1.bin.png").write_bytes(b"")
    r = R.paired(spark, str(tmp_path)).select("source", "file_name", "text", *png_size()).collect()
    assert [tuple(x) for x in r] == [("fin", "fin__train__x1.png", "päivä", 3, 4, len(png(3, 4)))]
    other = tmp_path / "other"
    other.mkdir()
    (other / "x1.bin.png").write_bytes(png(9, 9))
    i = {x.image_name: x.dir_ord for x in R.image_index(spark, [str(other), str(d)]).collect()}
    assert i == {"x1.bin.png": 0, "x2.bin.png": 1}


def test_layout_xml(spark, tmp_path):
    (tmp_path / "p-gt2.xml").write_text(
        '<alto xmlns="urn:x"><Layout><Page WIDTH="1000" HEIGHT="2000"><PrintSpace><TextBlock HPOS="50" VPOS="100" WIDTH="900" HEIGHT="120"><TextLine><String CONTENT="Otsikko"/></TextLine></TextBlock>'
        '<TextBlock HPOS="50" VPOS="300" WIDTH="400" HEIGHT="400"><TextLine><String CONTENT="Vasen"/><String CONTENT="palsta"/></TextLine><TextLine><String CONTENT=""/></TextLine></TextBlock>'
        '<TextBlock HPOS="1" VPOS="1" WIDTH="1" HEIGHT="1"><TextLine/></TextBlock></PrintSpace></Page></Layout></alto>'
    )
    r = R.layout_pages(spark, str(tmp_path)).collect()
    assert len(r) == 1 and (r[0].page_w, r[0].page_h) == (1000, 2000)
    assert [(b.bbox.hpos, b.lines) for b in r[0].blocks] == [(50, ["Otsikko"]), (50, ["Vasen palsta"])]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("s", f"{i}.png", "kala", "page", (bytearray(png(1, i + 1)), None)) for i in range(4)], schema.MANIFEST)
    W.manifest(df, str(tmp_path / "a.parquet"))
    W.manifest(df.drop("type").limit(2), str(tmp_path / "b.parquet"))
    W.concatenated(spark, [str(tmp_path / "a.parquet"), str(tmp_path / "b.parquet")], str(tmp_path / "all.parquet"))
    c = spark.read.parquet(str(tmp_path / "all.parquet"))
    assert c.count() == 6 and c.where("type is null").count() == 2
    W.side_files(df.unionByName(df).select("file_name", F.col("image.bytes").alias("b")), "file_name", "b", str(tmp_path / "img"))
    assert sorted(os.listdir(tmp_path / "img")) == ["0.png", "1.png", "2.png", "3.png"]
    W.split_lines(df.select("file_name", "text", F.lit("train").alias("split")), "split", str(tmp_path / "lines"))
    assert os.path.isdir(tmp_path / "lines" / "split=train")
    W.batches(df.withColumn("batch", F.lit(1)), str(tmp_path / "parts"), "batch")
    W.batches(df.limit(1).withColumn("batch", F.lit(2)), str(tmp_path / "parts"), "batch")
    assert spark.read.parquet(str(tmp_path / "parts")).count() == 5
    assert "n<1K" in W.card(df, "x", "y") and R.first_existing(spark, str(tmp_path)) is None


def test_incremental(spark, tmp_path):
    src, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    make = lambda ids: spark.createDataFrame([(i, f" t{i} ") for i in ids], "id int, text string").withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")))
    make([1, 2, 2, 3]).write.parquet(src)
    s = make([1]).schema
    for more in ([3, 4], []):
        ingest.run_available(ingest.first_seen(ingest.clean(ingest.files_arriving(spark, src, s)), "id", "ts"), out, state)
        if more:
            make(more).write.mode("append").parquet(src)
    assert sorted((r.id, r.text) for r in spark.read.parquet(out).collect()) == [(i, f"t{i}") for i in (1, 2, 3, 4)]
