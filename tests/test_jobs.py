"""Jobs end to end on small folders."""

import json
import os

from pyspark.sql import functions as F

from corpusforge import jobs, schema


def records(n, answer):
    return [{"messages": [{"role": "user", "content": "x"}, {"role": "assistant", "content": f"tekstiä rivillä {i} on"}], "images": [f"./images/{i}.png"], "answer": answer(i), "label": None} for i in range(n)]


def lines(path, rows):
    with open(path, "w") as f:
        f.write("\n".join(json.dumps(r, ensure_ascii=False) for r in rows) + "\n{bad\n")


def test_evaluate_and_pairs(spark, tmp_path):
    img = tmp_path / "images"
    img.mkdir()
    for i in range(40):
        (img / f"{i}.png").write_bytes(b"x")
    lines(tmp_path / "a.jsonl", records(40, lambda i: f"teksti rivilla {i}" if i % 2 else f"tekstiä rivillä {i} on"))
    lines(tmp_path / "b.jsonl", records(10, lambda i: f"tkstiä rvllä {i}"))
    jobs.evaluate(spark, str(tmp_path / "a.jsonl"), str(tmp_path / "out"), worst=3)
    s = spark.read.parquet(str(tmp_path / "out/ned_summary")).first()
    assert s.n == 40 and s.exact_match == 0.5
    assert spark.read.parquet(str(tmp_path / "out/malformed")).count() == 1 and spark.read.parquet(str(tmp_path / "out/worst")).count() == 3
    f = {r.category: r for r in jobs.build_pairs(spark, {"fin": str(tmp_path / "a.jsonl"), "theseus": str(tmp_path / "b.jsonl")}, [str(img)], str(tmp_path / "pairs"), train=0.9, evaluation_share=0.1).collect()}
    assert f["ocr-dpo-fin"].kept == 20 and f["ocr-dpo-fin"].no_diff == 20 and f["ocr-dpo-theseus"].kept == 5 and f["ocr-dpo-theseus"].dup_image == 5
    out = spark.read.schema(schema.PREFERENCE).json(str(tmp_path / "pairs")).select("*", F.get("images", F.lit(0)).alias("i"))
    count = {r.category: r["count"] for r in out.groupBy("category").count().collect()}
    assert count["ocr-dpo-fin"] == 35 and count["ocr-dpo-theseus"] == 35  # five real ones raised to parity
    assert out.where("audios is null or size(videos) <> 0").count() == 0
    assert out.where(F.get("chosen_response", F.lit(0))["content"] == F.get("rejected_response", F.lit(0))["content"]).count() == 0
    assert sorted(os.listdir(tmp_path / "pairs"))[-2:] == ["split=eval", "split=train"]


def test_tables_and_folds(spark, tmp_path):
    df = spark.createDataFrame([(f"a/b/{i % 55}.png", f"teksti {i}", bytearray(b"x")) for i in range(60)] + [("z.png", " ", bytearray(b"x"))], "file_name string, transcript string, img binary")
    df.write.parquet(str(tmp_path / "in.parquet"))
    jobs.ingest_tables(spark, {"train": str(tmp_path / "in.parquet")}, str(tmp_path / "one"), "s")
    e = spark.read.json(str(tmp_path / "one/entries"))
    img = e.groupBy(F.get("images", F.lit(0))).agg(F.count_distinct("split").alias("k"))
    assert e.where("split = 'train'").count() == 54 and img.where("k > 1").count() == 0
    jobs.ingest_tables(spark, {"train": str(tmp_path / "in.parquet")}, str(tmp_path / "folds"), "s", kfolds=3)
    f = {r.split: r["count"] for r in spark.read.json(str(tmp_path / "folds/entries")).groupBy("split").count().collect()}
    assert f["test"] == 6 and all(f[f"fold_{i}_train"] == 36 for i in range(3)) and all(f[f"fold_{i}_eval"] <= 18 for i in range(3))
    jobs.ingest_tables(spark, {"train": str(tmp_path / "in.parquet"), "test": str(tmp_path / "in.parquet")}, str(tmp_path / "two"), "s")
    assert spark.read.text(str(tmp_path / "two/test.jsonl")).count() == 60


def test_layout_and_tsv(spark, tmp_path):
    d = tmp_path / "xml"
    d.mkdir()
    block = lambda x, y, w, n: f'<TextBlock HPOS="{x}" VPOS="{y}" WIDTH="{w}" HEIGHT="300">' + "".join(f'<TextLine><String CONTENT="palstan"/><String CONTENT="teksti{x}{i}"/></TextLine>' for i in range(n)) + "</TextBlock>"
    (d / "p.xml").write_text(f'<alto><Layout><Page WIDTH="1000" HEIGHT="2000"><PrintSpace>{block(50, 100, 400, 2)}{block(550, 100, 400, 2)}{block(50, 500, 400, 2)}</PrintSpace></Page></Layout></alto>')
    jobs.ingest_layout(spark, str(d), str(tmp_path / "out"), "nlf")
    r = {x.file_name: x.text for x in spark.read.parquet(str(tmp_path / "out/train.parquet")).collect()}
    assert len(r) == 4 and not (tmp_path / "out/parts").exists() and r["nlf__p__page.png"].split("\n")[2] == "palstan teksti500"
    (tmp_path / "l.tsv").write_text("a.png\tkala\nb.png\tmeri\n")
    (tmp_path / "im").mkdir()
    (tmp_path / "im" / "a.png").write_bytes(b"x")
    missing = jobs.ingest_tsv(spark, str(tmp_path / "l.tsv"), str(tmp_path / "im"), str(tmp_path / "m.parquet"))
    assert [x.file_name for x in missing.collect()] == ["b.png"] and spark.read.parquet(str(tmp_path / "m.parquet")).count() == 1


def tiff(w, h):
    return b"II*\0" + (8).to_bytes(4, "little") + (2).to_bytes(2, "little") + b"".join(x.to_bytes(2, "little") + (3).to_bytes(2, "little") + (1).to_bytes(4, "little") + v.to_bytes(4, "little") for x, v in ((256, w), (257, h))) + bytes(4)


def test_layout_of_scans_in_batches(spark, tmp_path):
    from corpusforge.sources import readers

    d = tmp_path / "gt"
    d.mkdir()
    line = '<a:TextLine><a:String CONTENT="palstan"/><a:String CONTENT="pitkä teksti {}"/></a:TextLine>'
    page = lambda k: (
        f'<a:alto xmlns:a="urn:x"><a:Layout><a:Page WIDTH="1000.0" HEIGHT="2000"><a:TopMargin><a:TextBlock HPOS="10" VPOS="5" WIDTH="900" HEIGHT="30">{line.format(k)}</a:TextBlock></a:TopMargin><a:PrintSpace>'
        f'<a:ComposedBlock><a:TextBlock HPOS="50.5" VPOS="100" WIDTH="400" HEIGHT="300">{line.format(1) * 2}</a:TextBlock></a:ComposedBlock></a:PrintSpace></a:Page></a:Layout></a:alto>'
    )
    for k in range(6):
        (d / f"p{k}-gt2.xml").write_text(page(k))
        (d / f"p{k}.tif").write_bytes(tiff(2000, 4000))
    (d / "alone.tif").write_bytes(tiff(5, 5))
    (d / "bad-gt2.xml").write_text("<alto><Page")
    (d / "none-gt2.xml").write_text("<alto><Layout/></alto>")
    assert {r.page_id: r.error is None for r in readers.layout_files(spark, str(d)).collect()} == {**{f"p{k}-gt2.xml": True for k in range(6)}, "bad-gt2.xml": False, "none-gt2.xml": False}
    one = readers.layout_pages(spark, str(d)).where("page_id = 'p3-gt2.xml'").first()
    assert (one.page_w, one.page_h, [b.bbox.hpos for b in one.blocks]) == (1000, 2000, [10, 50]) and one.blocks[1].lines == ["palstan pitkä teksti 1"] * 2
    assert sorted((r.stem, r.img_w) for r in readers.scans(spark, str(d)).collect()) == [(f"p{k}", 2000) for k in range(6)]
    assert readers.tiff_size(b"MM\0*" + bytes(4)) is None and readers.tiff_size(b"") is None
    assert readers.scan_folders(spark, None, str(d), {}) == {"nlf": str(d)} and readers.scan_folders(spark, "x", str(d), {}) == {"nlf": "x"} and readers.scan_folders(spark, None, str(tmp_path), {"fi": str(d), "sv": "/none"}) == {"fi": str(d)}
    out = str(tmp_path / "out")
    cols = jobs.ingest_layout(spark, str(d), out, "nlf", generate=str(tmp_path / "gen")).collect()
    assert [(r.n_cols, r.pages) for r in cols] == [(1, 6)]
    m = {r.file_name: r for r in spark.read.parquet(f"{out}/train.parquet").collect()}
    assert len(m) == 6 + 6 * 3 and m["nlf__p2__para2.png"].box.asDict() == {"left": 100, "upper": 200, "right": 900, "lower": 800} and m["nlf__p2__page.png"].box is None
    assert spark.read.json(str(tmp_path / "gen")).count() == 24
    # a batch that is there is not made again
    again = str(tmp_path / "again")
    spark.createDataFrame([("s", "old.png", "x", "page", None)], "source string, file_name string, text string, type string, box struct<left:int,upper:int,right:int,lower:int>").withColumn("batch", F.lit(7)).write.partitionBy("batch").parquet(f"{again}/parts")
    jobs.ingest_layout(spark, str(d), again, "nlf", resume=True)
    names = {r.file_name for r in spark.read.parquet(f"{again}/train.parquet").collect()}
    assert "old.png" in names and names - {"old.png"} <= set(m)


def test_pages_of_lines(spark, tmp_path):
    rows = [{"pdf_file": "theseus_1_77_x.pdf", "page": p, "img_w": 1000, "img_h": 2000, "lines": [{"text": f" rivi {p} {i} ", "x0": 50.0, "top": 20.0 * i, "x1": 300.0, "bottom": 20.0 * i + 15} for i in range(n)]} for p, n in ((1, 40), (2, 1), (3, 2))]
    lines(tmp_path / "p.jsonl", rows)
    jobs.ingest_pages(spark, str(tmp_path / "p.jsonl"), str(tmp_path / "out"), generate=str(tmp_path / "gen"), dpi=144)
    m = spark.read.parquet(str(tmp_path / "out/train.parquet"))
    pages = {r.page: r for r in m.where("type = 'page'").collect()}
    assert set(pages) == {1, 3} and pages[1].text.split("\n")[39] == "rivi 1 39" and pages[1].file_name == "theseus_1_77_x_p1_page.png"
    para = m.where("type = 'paragraph' and page = 1").orderBy("file_name").collect()
    assert 1 <= len(para) <= 5 and all(len(r.text.split("\n")) >= 2 and r.box.left == 98 and r.box.right == 602 for r in para)
    assert all(r.images[0].startswith("./images/77_theseus_1_77_x_p") for r in spark.read.json(str(tmp_path / "gen")).collect())


def test_synthetic_samples(spark, tmp_path):
    short, long = "lyhyt teksti jossa on kuitenkin viisikymmentä merkkiä", "pitkä teksti jossa on monta sanaa " * 6
    (tmp_path / "c.txt").write_text("\n".join([*(f"{short} {chr(97 + i)}" for i in range(20)), *(f"{long}{chr(97 + i)}" for i in range(10)), "1234", ""]))
    m = jobs.synthetic(spark, str(tmp_path / "c.txt"), ["a.ttf", "b.otf"], str(tmp_path / "out"), 300, 0.1)
    r = m.collect()
    single = [x for x in r if x.type == "text_line"]
    assert len(r) == 300 == len({x.file_name for x in r}) and len(single) <= 36 and all(("\n" in x.text) == (x.type == "paragraph") for x in r)
    assert {x.split: 0 for x in r}.keys() == {"train", "eval", "test"} and sum(x.split == "train" for x in r) == 270 and all(x.split == "train" for x in r if x.i < 270)
    assert all(max(map(len, x.text.split("\n"))) <= x.width <= 80 for x in r) and {x.font for x in r} == {"a.ttf", "b.otf"} and len({x.font_size for x in r}) == 6
    again = jobs.synthetic(spark, str(tmp_path / "c.txt"), ["a.ttf", "b.otf"], str(tmp_path / "other"), 300, 0.1).collect()
    assert sorted(map(str, again)) == sorted(map(str, r))
    only = tmp_path / "s.txt"
    only.write_text("\n".join(f"{short} {chr(97 + i)}" for i in range(5)))
    assert jobs.synthetic(spark, str(only), ["a.ttf"], str(tmp_path / "third"), 20, 0.1).count() == 20


def test_dataset_commands(spark, tmp_path):
    from corpusforge.sources import readers, writers

    df = spark.createDataFrame([("s" if i % 3 else "t", f"a{i}.png" if i % 2 else f"a{i}", f"teksti {i} " * 9, "page", (bytearray(b"x"), None)) for i in range(60)], schema.MANIFEST)
    path = str(tmp_path / "train.parquet")
    df.write.parquet(path)
    profile_, shares, images = jobs.summary(spark, path)
    assert profile_.first().n == 60 and [(r.source, r.n) for r in shares.collect()] == [("s", 40), ("t", 20)] and images.first().images == 60
    s = jobs.sample(spark, path, 7, images_out=str(tmp_path / "img")).collect()
    assert len(s) == 7 and all(len(r.text) == 53 for r in s) and len(os.listdir(tmp_path / "img")) == 7 and all(n.endswith((".png", ".jpg")) for n in os.listdir(tmp_path / "img"))
    assert {r.split: r.n for r in jobs.shuffled_split(spark, path, str(tmp_path / "split"), 0.8, 0.1).collect()} == {"train": 48, "eval": 6, "test": 6}
    (tmp_path / "a.jsonl").write_text("{}\n\n" * 4)
    (tmp_path / "b.jsonl").write_text("{}\n" * 16)
    mix = jobs.mixture(spark, [str(tmp_path / "a.jsonl"), str(tmp_path / "b.jsonl")]).collect()
    assert [(r.n, round(r.prob, 6)) for r in mix] == [(16, 0.666667), (4, 0.333333)]
    (tmp_path / "l.tsv").write_text("a1.png\tx\nnone.png\ty\na1.png\tz\n")
    done = jobs.stage_images(spark, [str(tmp_path / "l.tsv")], str(tmp_path / "img"), str(tmp_path / "to"), str(tmp_path / "missing"))
    assert sum(r.files for r in done.collect()) == 2 and "none.png" in [r.value for r in spark.read.text(str(tmp_path / "missing")).collect()]
    assert readers.splits_of(spark, str(tmp_path)) == {"train": f"{tmp_path}/train.parquet"} and readers.first_existing(spark, str(tmp_path)) == path
    (tmp_path / "f").mkdir()
    import pytest
    with pytest.raises(FileNotFoundError):
        readers.fonts(spark, str(tmp_path / "f"))
    (tmp_path / "f" / "b.ttf").write_bytes(b"x")
    assert len(readers.fonts(spark, str(tmp_path / "f"))) == 1
    (tmp_path / "oai").mkdir()
    (tmp_path / "oai" / "1.xml").write_text("<x><dc:identifier>http://h/handle/10024/77/</dc:identifier><dc:identifier>urn:1</dc:identifier><resumptionToken size='9'>next</resumptionToken></x>")
    assert [tuple(r)[1:] for r in readers.harvested(spark, str(tmp_path / "oai")).collect()] == [("http://h/handle/10024/77/", "theseus_77.pdf", "next")]
    writers.document({"a": "ä"}, str(tmp_path / "d.json"))
    writers.text_lines(spark.createDataFrame([("a\nb  c",), (" ",), (None,)], "t string"), "t", str(tmp_path / "lines"))
    assert json.load(open(tmp_path / "d.json")) == {"a": "ä"} and [r.value for r in spark.read.text(str(tmp_path / "lines")).collect()] == ["a b c"]
    assert "| text | string | transcription |" in writers.card(df, "x", "y")


def test_datasets_by_folder(spark, tmp_path):
    import pytest

    d = tmp_path / "my-set"
    d.mkdir()
    df = spark.createDataFrame([(f"im/{i}.png", f"teksti {i}" if i % 4 else " ", f"im/{i}.png") for i in range(20)], "file_name string, text string, image string")
    df.write.parquet(str(d / "train.parquet"))
    df.limit(5).write.parquet(str(d / "test-00000-of-00001.parquet"))
    jobs.ingest_dataset(spark, str(d), str(tmp_path / "out"), "s")
    assert spark.read.text(str(tmp_path / "out/train.jsonl")).count() == 15 and (tmp_path / "out/test.jsonl").exists()
    (tmp_path / "im").mkdir()
    for i in range(0, 20, 2):
        (tmp_path / "im" / f"{i}.png").write_bytes(b"x")
    missing = jobs.ingest_flat(spark, str(d / "train.parquet"), str(tmp_path / "im"), str(tmp_path / "flat.parquet"))
    assert {r.name for r in missing.collect()} == {f"{i}.png" for i in range(1, 20, 2)}
    assert sorted(r.text for r in spark.read.parquet(str(tmp_path / "flat.parquet")).where("image.bytes is not null").collect()) == sorted(f"teksti {i}" for i in range(2, 20, 4))
    jobs.dataset_card(spark, str(d), str(tmp_path / "README.md"), description="Rivejä.")
    assert "# MY_SET" in (tmp_path / "README.md").read_text() and jobs.standard(spark, str(d)).count() == 20
    with pytest.raises(FileNotFoundError):
        jobs.standard(spark, str(tmp_path))
    jobs.main(["mixture", str(tmp_path / "out/train.jsonl"), str(tmp_path / "out/test.jsonl"), "--mode", "equal"])
    jobs.main(["sample", str(tmp_path / "out/train.parquet"), "--n", "3"])


def test_line_order_over_splits(spark, tmp_path):
    """Lines keep their order however Spark packs the pieces of a file."""
    from corpusforge.sources import readers

    for k in range(3):
        (tmp_path / f"{k}.jsonl").write_text("".join(json.dumps({"answer": f"{k}-{i:05d}"}) + "\n" for i in range(4000 - 1300 * k)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        good, _ = readers.json_tolerant(spark, str(tmp_path), schema.EVALUATION, "place")
        assert good.rdd.getNumPartitions() > 3
        got = [r.answer for r in good.orderBy("place").select("answer").collect()]
        p = [(r.answer, r.position) for r in __import__("corpusforge.operators.ranking", fromlist=["x"]).positions(good.select("answer")).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [f"{k}-{i:05d}" for k in range(3) for i in range(4000 - 1300 * k)]
    assert sorted(x[1] for x in p) == list(range(len(got)))
