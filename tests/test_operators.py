"""Operators against plain Python versions and invariants."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusforge.functions import text as T
from corpusforge.operators import evaluation as E
from corpusforge.operators import layout as L
from corpusforge.operators import preference as P
from corpusforge.operators import profile as Q
from corpusforge.operators import ranking as K
from corpusforge.operators import raster as G
from corpusforge.operators import records as R


def test_ranks_splits_and_folds(spark):
    df = spark.range(1003).select("id", F.concat(F.lit("k"), F.col("id") % 300).alias("key"))
    r, n = K.hash_ranked(df, F.col("key"), F.col("id"))
    r = r.select("*", K.split_of(F.col("rank"), n, 0.9, 0.05).alias("split"), K.folds(F.col("rank"), n, 4, 0.9).alias("fold"), K.batch_of(F.col("rank"), n).alias("batch"))
    rows = r.collect()
    assert sorted(x["rank"] for x in rows) == list(range(1003))
    count = lambda s: sum(x.split == s for x in rows)
    assert (count("train"), count("eval"), count("test")) == (902, 50, 51)
    assert [sum(x.fold == f for x in rows) for f in (-1, 0, 1, 2, 3)] == [101, 225, 225, 225, 227]
    assert len({x.batch for x in rows}) == 20
    kept = K.leak_free(r, "split", "key").collect()
    where = {}
    for x in kept:
        assert where.setdefault(x.key, x.split) == x.split
    chain = {x.key for x in rows if x.split == "train"}
    ev = {x.id for x in rows if x.split == "eval" and x.key not in chain}
    assert {x.id for x in kept if x.split == "eval"} == ev
    empty, m = K.hash_ranked(df.limit(0), F.col("key"), F.col("id"))
    assert empty.collect() == []


def test_percentiles_and_buckets(spark):
    rng = np.random.default_rng(1)
    v = [float(x) for x in rng.integers(0, 40, 137) / 40]
    df = spark.createDataFrame([(i % 2, x) for i, x in enumerate(v)], "g int, ned double")
    for g in (0, 1):
        own = sorted(x for i, x in enumerate(v) if i % 2 == g)
        r = K.floor_percentiles(df, ["g"], "ned", [25, 50, 75]).where(F.col("g") == g).first()
        assert [r.p25, r.p50, r.p75] == [own[int(len(own) * p / 100)] for p in (25, 50, 75)]
        q = E.percentiles(df, "ned", ["g"]).where(F.col("g") == g).first()
        assert [q[f"p{p}"] for p in E.PERCENTILES] == pytest.approx([np.percentile(own, p) for p in E.PERCENTILES])
    b = E.buckets(df, "ned").collect()
    assert len(b) == 6 and sum(x.n for x in b) == 137
    assert all(x.n == sum(x.lo <= y < x.hi for y in v) for x in b)
    assert [x.n for x in E.buckets(df.limit(0), "ned").collect()] == [0] * 6


def test_mixture_and_samples(spark):
    df = spark.createDataFrame([(i, "abc"[min(i // 50, 2)], float(i % 7)) for i in range(400)], "id int, s string, w double")
    for mode in Q.MODES:
        assert sum(r.prob for r in Q.probabilities(df, "s", mode).collect()) == pytest.approx(1)
    got = Q.weighted_sample(df, "id", "w", 50).collect()
    assert len({r.id for r in got}) == 50 and all(r.w > 0 for r in got)
    f = Q.first_per_source(df, "s", "id", 7).collect()
    assert sorted(r.id for r in f) == [*range(7), *range(50, 57), *range(100, 107)]
    assert Q.seeded_sample(df, "id", 9).collect() == Q.seeded_sample(df.repartition(5), "id", 9).collect()


def test_names(spark):
    c = lambda x: F.lit(x)
    r = spark.range(1).select(
        R.flat_name(c("a/b/c.png")), R.flat_name(c("c.png")), R.image_name(c(None).cast("string"), F.lit(7)), R.image_name(c("x"), F.lit(7)),
        R.page_image_name(c("theseus_10024_123_x.pdf"), c("p1_page.png")), R.page_image_name(c("a.pdf"), c("p1.png")), R.page_image_name(c("x_y_123.pdf"), c("123_p1.png")), R.page_image_name(c(None).cast("string"), c("p1.png")),
        R.first_link(c('<a href="/x.pdf"><a href="/bitstream/a.PDF?sequence=1&isAllowed=y"><a href="/bitstream/b.pdf">')),
    ).first()
    assert tuple(r) == ("a_c.png", "c.png", "00000007.png", "x.png", "123_p1_page.png", "a_p1.png", "123_p1.png", "p1.png", "/bitstream/a.PDF?sequence=1")


def block(x, y, w, h, *lines):
    return ((x, y, w, h), list(lines))


PAGE = "page_id string, page_w int, page_h int, blocks array<struct<bbox:struct<hpos:int,vpos:int,w:int,h:int>,lines:array<string>>>"


def test_columns(spark):
    blocks = [block(50, 100, 900, 120, "Otsikko"), block(50, 300, 400, 400, "Vasen palsta on pitkä", "toinen"), block(550, 300, 400, 400, "Oikea palsta on myös", "palsta")]
    pages = spark.createDataFrame([("p", 1000, 2000, blocks), ("one", 1000, 2000, blocks[:1]), ("none", 0, 0, blocks), ("empty", 10, 10, [])], PAGE)
    r = {x.page_id: x for x in L.with_columns_found(pages).collect()}
    assert set(r) == {"p", "one"} and r["p"].n_cols == 2 and r["one"].n_cols == 1
    assert [(b.i, b.col) for b in r["p"].placed] == [(0, 0), (1, 0), (2, 1)]
    t = L.with_columns_found(pages).where("page_id = 'p'").select(L.reading_text(F.col("placed"))).first()[0]
    assert t.split("\n")[0] == "Otsikko" and t.endswith("Oikea palsta on myös\npalsta")


def paragraphs(blocks, cols):
    """The sequential definition, in plain Python."""
    seen, out = set(), []
    for c in sorted(set(cols)):
        own = [b for b, k in zip(blocks, cols) if k == c and len("\n".join(b[1]).strip()) >= 20]
        n = 0
        done = False
        for win in range(1, len(own) + 1):
            for s in range(len(own) - win + 1):
                text = "\n".join(x for b in own[s : s + win] for x in b[1])
                if done or text in seen:
                    continue
                seen.add(text)
                out.append((c, text))
                n += 1
                done = n >= 10
    return out


def test_paragraph_windows_across_columns(spark):
    same = ["tämä teksti toistuu palstassa"] * 1
    left = [block(50, 100 + 100 * i, 300, 150, f"vasemman palstan kappale {i}", "toinen rivi") for i in range(11)]
    right = [block(650, 100 + 100 * i, 300, 150, *(left[10][1] if i == 0 else [f"oikean palstan kappale {i}", *same])) for i in range(3)]
    df = L.with_columns_found(spark.createDataFrame([("p", 1000, 2000, left + right)], PAGE))
    got = [(r.col, r.text) for r in sorted(L.paragraphs(df).collect(), key=lambda r: r.para)]
    assert got == paragraphs(left + right, [0] * 11 + [1] * 3)
    assert (1, "\n".join(left[10][1])) in got  # beyond the first column's cap, so still new in the second


def test_bands(spark):
    lines = [(f"rivi {i}", float(20 * i), float(20 * i + 15)) for i in range(60)]
    df = spark.createDataFrame([(1, lines), (2, lines[:1]), (3, [])], "page_id int, lines array<struct<text:string,top:double,bottom:double>>")
    got = L.bands(df).collect()
    assert {r.page_id for r in got} == {1} and 1 <= len(got) <= 5 and all(len(r.text.split("\n")) >= 2 for r in got)


RESULT = "result_id int, messages array<struct<role:string,content:string>>, images array<string>, source string, answer string, label string"


def test_preference_pipeline(spark):
    rows = [
        (1, "abcdefghij", " abcdefghij", "a.png"), (2, "abcdefghij", "abcdefghiX", "b.png"), (3, "abcdefghij", "abXdXfghij", "c.png"), (4, "abcdefghij", "abXdXfghij", "x/c.png"),
        (5, "abcdefghij", "zzzzzzzzzz", "d.png"), (6, "abcdefghij", None, "e.png"), (7, "", "abc", "f.png"), (8, "abcdefghij", "abXdXfghij", None), (9, "abcdefghij", "aXXXefghij", "gone.png"),
    ]
    df = spark.createDataFrame([(i, [("u", "x"), ("a", ref)], [im] if im else [], None, a, None) for i, ref, a, im in rows], RESULT)
    index = spark.createDataFrame([(x,) for x in "a.png b.png c.png d.png e.png f.png".split()], "image_name string")
    s = P.first_wins(P.staged(df, index), ["result_id"])
    assert {r.result_id: r.stage for r in s.collect()} == {1: "no_diff", 2: "kept", 3: "kept", 4: "dup_image", 5: "low_ned", 6: "low_ned", 7: "low_ned", 8: "missing", 9: "missing"}
    f = P.funnel(s, "source").first()
    assert (f.total, f.kept, f.dup_image, f.missing, f.low_ned, f.no_diff) == (9, 2, 1, 2, 3, 1)
    c = spark.createDataFrame([(i, "hand" if i % 2 else "other") for i in range(200)], "id int, category string")
    capped = P.capped(c, "category", ["hand"], ["id"])
    assert sorted(r.id for r in capped.where("category = 'hand'").collect()) == [1, 3, 5, 7, 9] and capped.count() == 105
    o = P.oversampled(capped, "category", ["hand"], "id").collect()
    hand = [r.id for r in o if r.category == "hand"]
    assert len(hand) == 100 and {hand.count(x) for x in set(hand)} == {20}
    assert P.oversampled(capped, "category", ["none"], "id").count() == 105 and P.oversampled(c.limit(0), "category", ["hand"], "id").count() == 0


def page(h=72, w=96, channels=1):
    """A light page with dark lines of text."""
    rng = np.random.default_rng(3)
    a = np.full((h, w), 230.0)
    for y in range(8, h - 8, 12):
        a[y : y + 6, 10 : w - 10] = np.where(rng.random((6, w - 20)) < 0.7, 20, 230)
    return a.astype(np.uint8) if channels == 1 else np.stack([a, a * 0.9, a * 0.8], axis=2).astype(np.uint8)


@pytest.mark.parametrize("name", sorted(G.TRANSFORMS))
@pytest.mark.parametrize("channels", [1, 3])
def test_every_transform(name, channels):
    a = page(channels=channels)
    b = G.apply_one(a, name, 1)
    assert b.dtype == np.uint8 and b.ndim == a.ndim and (b == G.apply_one(a, name, 1)).all() and (G.apply_one(a, name, 1, p=0.0) == a).all()
    if not name.endswith(("padding", "scale", "rotation")):
        assert b.shape == a.shape and any((G.apply_one(a, name, k) != a).any() for k in range(3))
    for shape in ((1, 1), (1, 9), (5, 2)):
        G.apply_one(np.full(shape, 9, np.uint8), name, 1)


def test_transforms_do_what_they_say():
    a = page().astype(float)[..., None]
    rng = lambda k=1: np.random.default_rng(k)
    many = lambda name, **kw: [G.apply_one(page(), name, k, **kw) for k in range(40)]
    assert abs(np.mean([b.astype(float) - 128 for b in [G.apply_one(np.full((80, 80), 128, np.uint8), "gaussian_noise", k) for k in range(5)]])) < 2
    assert 20 < np.std(G.apply_one(np.full((90, 90), 128, np.uint8), "gaussian_noise", 1).astype(float)) < 30
    flat = np.full((40, 40, 1), 77.0)
    for f in (G.gaussian_blur, G.motion_blur, G.curve, G.jpeg_compression):
        assert np.allclose(f(flat, rng()), 77, atol=1.5)
    down = G.at(a, np.mgrid[:72, :96][0] + 2.0, np.mgrid[:72, :96][1].astype(float))  # two rows down, mirrored at the edge
    assert np.allclose(down[:-2], a[2:]) and np.allclose(down[-1], a[69]) and np.allclose(down[-2], a[70])
    shifts = {round(float(np.abs(b.astype(float) - page()).mean()), 3) for b in many("curve")}
    assert len(shifts) > 30
    column = G.curve(a, rng(), period=180, amplitude=(3, 3.0001))[:, 45]  # a quarter of the period: moved by three rows
    assert np.allclose(column[:-3], a[3:, 45], atol=0.1)
    for name, axis, lines in (("dropout_horizontal", 0, 3), ("dropout_vertical", 1, 8)):
        b = G.apply_one(np.full((60, 90), 200, np.uint8), name, 1)
        hit = (b < 21).all(axis=1 - axis)
        assert 3 <= hit.sum() <= 3 * lines and not hit[0] and ((b < 21) | (b == 200)).all() and (b[0] != 200).sum() == (hit.sum() if axis else 0)
        assert (G.apply_one(np.full((4, 4), 200, np.uint8), name, 1) == 200).all()
    share = [(G.apply_one(np.full((60, 60), 250, np.uint8), "dropout_rand", k) != 250).mean() for k in range(30)]
    assert 0.15 < min(share) < max(share) <= 0.4 and max(share) - min(share) > 0.05
    line = [G.apply_one(np.full((60, 90), 250, np.uint8), "line_overlay", k) for k in range(60)]
    rows = {(tuple(np.flatnonzero((b != 250).all(axis=1))), tuple(np.flatnonzero((b != 250).all(axis=0)))) for b in line}
    assert all(bool(r) != bool(c) and 1 <= len(r + c) <= 3 for r, c in rows) and len({(bool(r), (r + c)[0] // 25) for r, c in rows}) >= 6
    size = [b.shape for b in many("image_padding")]
    assert all(72 <= h <= 93 and 96 <= w <= 100 for h, w in size) and len(set(size)) > 15
    dark = page() < 128
    for b in many("text_border"):
        black = b == 0
        assert black[dark == 0].any() and (b[dark] == page()[dark]).all() and not black[0].any() and not black[:, 0].any()
    m = G.MASKS["salt_pepper"](np.full((20, 20, 1), 90.0), rng(), 0.15)
    assert 40 <= (m != 90).sum() <= 60 and {0.0, 90.0, 255.0} == set(np.unique(m))
    b = G.masked(a, rng(), "random_block", coords=[(-5, -5, 10, 10), (90, 60, 300, 300), (50, 50, 50, 60)])
    assert (b[10:60] == a[10:60]).all() and (b[:10, :10] != a[:10, :10]).any() and (b[60:, 90:] != a[60:, 90:]).any()
    k = G._kernel_blur(np.pad(np.full((1, 1, 1), 100.0), ((5, 5), (5, 5), (0, 0))), 1)  # a point spreads by the kernel 1/4 1/2 1/4, nearly
    assert np.isclose(k.sum(), 100) and k[5, 5] > k[5, 6] > k[6, 6] > 0 and (k[3] == 0).all()
    with pytest.raises(ValueError):
        G.masked(a, rng(), "nonsense")
    boxes = G.random_boxes(50, 80, 0.3, 400, rng())
    assert {(x2 - x1, y2 - y1) for x1, y1, x2, y2 in boxes} == {(24, 15)} and min(x[0] for x in boxes) == 0 and max(x[2] for x in boxes) == 80
    p = np.full((60, 90, 1), 240.0)
    p[10:20, 20:70], p[40:44, 5:15] = 10, 10
    assert G.contour_boxes(p, 0.1, 2, rng()) == [(16, 7, 74, 23), (1, 37, 19, 47)] and len(G.contour_boxes(np.full((9, 9, 1), 5.0), 0.3, 3, rng())) >= 1
    assert G.otsu(p[..., 0]) in range(10, 240)
    worse = [np.abs(G.jpeg_compression(a, rng(), (q, q)) - a).mean() for q in (95, 60, 20)]
    assert worse[0] < worse[1] < worse[2] < 30
    z = G.optical_distortion(a, rng(), 0.0)
    assert np.allclose(z[:, :-1], a[:, :-1]) and G.smart_size(100, 200, 1000, 100_000) == (112, 196) and G.smart_size(1000, 2000, 1000, 100_000)[0] % 28 == 0


def test_gates_and_configurations(spark, tmp_path):
    a = page()
    assert (G.apply_all(a, ["curve"], 1, p=0.0) == a).all()
    hits = sum((G.apply_all(a, ["mask_random_block"], k, p=0.3) != a).any() for k in range(300))
    assert 60 < hits < 120
    with pytest.raises(ValueError):
        G.apply_all(a, ["nonsense"], 1)
    assert (G.apply_all(a, ["nonsense"], 1, onerror="skip") == a).all()
    orders = {G.apply_all(a, ["mask_mosaic", "line_overlay", "gaussian_blur"], k, shuffle=True).tobytes() == G.apply_all(a, ["mask_mosaic", "line_overlay", "gaussian_blur"], k).tobytes() for k in range(20)}
    assert orders == {True, False}
    with pytest.raises(ValueError):
        G.apply_all(a, [], 1)
    config = {"augmentations": [{"name": "Curve", "p": 0.4}, {"name": "rotation", "category": "g", "params": {"quarters": [1]}}], "augmentation_policy": {"num_transforms": 2}}
    (tmp_path / "a.json").write_text(json.dumps(config))
    assert G.load_config(str(tmp_path / "a.json")) == G.load_config(config) == (config["augmentations"], {"num_transforms": 2}) and G.load_config(config["augmentations"])[1] is None
    for wrong, error in ((7, TypeError), ([{"name": "x"}], ValueError)):
        with pytest.raises(error):
            G.load_config(wrong)
    ids = spark.range(400)
    entries = [{"name": "mask_blur", "p": 1.0, "category": "x"}, {"name": "mask_mosaic", "p": 1.0, "category": "x"}, {"name": "rotation", "p": 1.0, "category": "y"}, {"name": "curve", "p": 1.0, "category": "z"}]
    policy = {"strategy": "weighted", "category_weights": {"x": 0.2, "y": 0.8}, "num_transforms": [1, 2]}
    p = G.transform_plan(ids, entries, policy).collect()
    assert len(p) == 400 and all(1 <= len(r.transforms) <= 2 and "curve" not in r.transforms and len(set(r.transforms)) == len(r.transforms) for r in p)
    alone = [r.transforms[0] for r in p if len(r.transforms) == 1]
    assert alone.count("rotation") > 2.5 * alone.count("mask_mosaic") and 150 < len(alone) < 250
    two = [tuple(r.transforms) for r in G.transform_plan(ids, entries, {"num_transforms": 2}).collect()]
    assert len(two) == 400 and len(set(two)) == 12
    gated = G.gated_plan(ids, [{"name": "curve", "p": 0.25}, {"name": "rotation", "p": 1.0}]).collect()
    assert len(gated) == 400 and 70 < sum(len(r.picks) == 2 for r in gated) < 130 and all(r.picks in ([1], [0, 1]) for r in gated)
    rows = [(1, 72, 96, bytearray(a.tobytes())), (2, 3, 3, bytearray(b"x")), (3, 3, 3, None), (4, 0, 0, bytearray()), (5, 72, 96, bytearray(page(channels=3).tobytes()))]
    df = spark.createDataFrame(rows, "id bigint, h int, w int, data binary")
    r = {x.id: x for x in G.augmented(df, spark.createDataFrame([(1, ["mask_mosaic", "nonsense"]), (5, None)], "id bigint, transforms array<string>")).collect()}
    assert r[1].error.startswith("nonsense") and len(r[1].data) == 72 * 96 and all(r[i].error.startswith("raster") for i in (2, 3, 4)) and bytes(r[5].data) == page(channels=3).tobytes()
    s = {x.id: x for x in G.preprocessed(df, None, 1000, 4000).collect()}
    assert (s[1].h, s[1].w) == (28, 56) and len(s[5].data) == 3 * 28 * 56 and s[2].h == 3
    assert G.preprocessed(df.limit(0), config, 1000, 4000).count() == 0


def test_blank_filters(spark):
    df = spark.createDataFrame([(None, "x"), ("", "x"), (" 　\n", "x"), (" kala ", None)], "text string, img string")
    assert [tuple(r) for r in R.conform(df, "s").select("source", "text", "type").collect()] == [("s", "kala", "text_line")]
    assert R.conform(df.drop("img")) is None and df.where(T.is_blank(F.col("text"))).count() == 3


def test_ranks_with_hot_keys(spark, monkeypatch):
    """A key of a third of all rows gets buckets of its own; the ranks are those of one sort."""
    import hashlib

    rows = [(i, "hot" if i % 3 == 0 else "warm" if i % 3 == 1 and i % 2 else f"k{i % 200}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, key string")
    md5 = lambda x: hashlib.md5(str(x).encode()).hexdigest()
    want = {i: r for r, (_, _, i) in enumerate(sorted((md5(k), md5(i), i) for i, k in rows))}
    for hot in (100_000, 300):
        monkeypatch.setattr(K, "HOT_ROWS", hot)
        ranked, n = K.hash_ranked(df, F.col("key"), F.col("id"))
        got = ranked.select("id", "rank", n.alias("n")).collect()
        assert {r.id: r["rank"] for r in got} == want and {r.n for r in got} == {3000}
    hot = K._hot_keys(df.withColumns({"__k": F.md5("key"), "__b": F.substr(F.md5("key"), F.lit(1), F.lit(3))}))
    assert {x for r in hot.collect() for x in r["__hot"]} == {md5("hot"), md5("warm")}
    assert K.hash_ranked(df.limit(0), F.col("key"), F.col("id"))[0].count() == 0


def test_percentiles_from_slices(spark):
    rng = np.random.default_rng(7)
    rows = [("a", float(v)) for v in rng.normal(size=501)] + [("b", 2.0)] * 40 + [("c", 1.5)] + [(None, float(v)) for v in range(10)] + [("d", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    ps = [0, 50, 75, 99, 100]
    got = {r.g: tuple(r)[2:] for r in K.interpolated_percentiles(df, ["g"], "v", ps).collect()}
    by = {}
    for g, v in rows:
        if v is not None:
            by.setdefault(g, []).append(v)
    assert set(got) == set(by) and all(np.allclose(got[g], np.percentile(by[g], ps)) for g in by)
    low = {r.g: (r.p25, r.p50) for r in K.floor_percentiles(df, ["g"], "v", [25, 50]).collect()}
    assert low == {g: tuple(sorted(v)[min(int(len(v) * p / 100), len(v) - 1)] for p in (25, 50)) for g, v in by.items()}
    assert np.allclose(tuple(K.interpolated_percentiles(df, [], "v", ps).first())[1:], np.percentile([v for _, v in rows if v is not None], ps))


def test_first_of_a_hot_image(spark):
    rows = [(i, "kept" if i % 5 else "no_diff", "one.png" if i % 3 else f"{i}.png") for i in range(600)] + [(900, "missing", None)]
    r = P.first_wins(spark.createDataFrame(rows, "id int, stage string, image_name string").repartition(5), ["id"]).collect()
    kept = {x.image_name: x.id for x in r if x.stage == "kept"}
    assert len(r) == 601 and kept["one.png"] == 1 and sum(x.stage == "dup_image" for x in r) == sum(k == "kept" and n == "one.png" for _, k, n in rows) - 1 and sum(x.stage == "missing" for x in r) == 1


def test_every_block_counts_in_bands(spark):
    lines = [(f"r{i}", 20.0 * i, 20.0 * i + 15) for i in range(30)]
    df = spark.createDataFrame([(1, lines, "x"), (2, lines[:1], "x"), (3, None, "x"), (4, [("a", 5.0, 5.0), ("b", 5.0, 5.0)], "x")], "page_id int, lines array<struct<text:string,top:double,bottom:double>>, band string")
    assert {r.page_id for r in L.bands(df.drop("band")).collect()} == {1}
    b = L.band_lines(df.drop("band")).collect()
    assert all(len(r.own) >= 2 and len(r.lines) == 30 for r in b) and [r.band for r in b] == list(range(1, len(b) + 1))


def test_a_recogniser_as_a_row_function(spark):
    from corpusforge.operators import inference

    def load():
        def recognise(data):
            if data == b"bad":
                raise ValueError("unreadable")
            return data.decode().upper()

        return recognise

    df = spark.createDataFrame([(1, (bytearray(b"kala"), None)), (2, (bytearray(b"bad"), None)), (3, (None, "x.png")), (4, None)], "rec_id bigint, image struct<bytes:binary,path:string>")
    got = {r.rec_id: (r.answer, r.error) for r in inference.answered(df, load, "rec_id").collect()}
    assert got == {1: ("KALA", None), 2: (None, "ValueError: unreadable"), 3: (None, "no image"), 4: (None, "no image")}
    assert inference.answered(df.limit(0), load, "rec_id").count() == 0
    t = spark.range(1).select(T.expanded(F.lit("a<image>b"), T.image_tokens(F.lit(1), F.lit(4), F.lit(6)), token="t").alias("x"), T.image_tokens(F.lit(2), F.lit(3), F.lit(3)).alias("n")).first()
    assert t.x == "a<|begin|>tttttt<|end|>b" and t.n == 4
