"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing extra columns, for every operator."""

import random

import pytest
from pyspark.sql import functions as F

from corpusforge.llm import chunking, encoding, langid, leakage, mixing, normal, overlap, packing, splits, truncation

DOC = "doc_id bigint, text string, source string, n_tokens int, size int, block bigint, spans string, h string, cores string, m string"
MAN = "rec_id bigint, source string, file_name string, text string, lang string, segments string, token string, form string, node string, root bigint, group_id bigint, p double, n bigint"
WORDS = "kala ja meri olivat talossa kun hän näki laivan satamassa "


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "s", 7, 7, 7, "x", "x", "x", "x") for i, t in rows], DOC)


def manifest(spark, rows):
    return spark.createDataFrame([(i, s, f, t, la, "x", "x", "x", "x", 7, 7, 0.5, 7) for i, s, f, t, la in rows], MAN)


ROWS = [(1, None), (2, ""), (3, "   "), (4, "kala"), (4, "kala"), (None, "kala"), (5, WORDS * 3000)]


@pytest.mark.parametrize("rows", [[], ROWS])
def test_documents(spark, rows):
    d = docs(spark, rows)
    p = packing.packed(d).collect()
    assert all(r.tokens <= 2048 and r.fill <= 2048 for r in p)
    assert {r.doc_id for r in p} == ({3, 4, None, 5} if rows else set())
    c = chunking.pieces(d).collect()
    assert {r.doc_id for r in c} == ({5} if rows else set())
    items = spark.createDataFrame([(1, WORDS * 2, "x"), (2, None, "x"), (3, "", "x")], "item_id bigint, text string, doc_id string")
    found = leakage.leaks(d, items).collect()
    assert [(r.doc_id, r.item_id) for r in found] == ([(5, 1)] if rows else [])
    assert leakage.leaks(d, items.limit(0)).collect() == []


MANIFEST = [
    (1, None, None, None, None), (2, "a", "", "", ""), (3, "a", "x/box_000123/p1.png", "   ", "fi"), (4, "a", "box_123456_l1.png", "kala", "fi"), (4, "a", "box_123456_l1.png", "kala", "fi"),
    (6, "a", "box_00123456_l2", WORDS * 400, "sv"), (7, "b", "box_123456_l2.png", "hÃ¤n", None), (8, "a", "00123456.png", "x", "?"), (9, None, "box_123456_l2.png", "x", "?"),
]


@pytest.mark.parametrize("rows", [[], MANIFEST])
def test_manifest(spark, rows):
    m = manifest(spark, rows)
    samples = spark.createDataFrame([(i, la, t) for i, (la, t) in enumerate([("fi", WORDS), ("sv", "och det var inte han som hade skolan på ön vid hamnen"), ("en", "the ship was not in the harbour when they came"), ("de", "und das schiff war nicht im hafen als sie kamen"), ("et", "ja laev ei olnud sadamas kui nad tulid külasse"), ("ru", "корабль не был в гавани когда они пришли")])], "sample_id bigint, lang string, text string")
    assert {tuple(r) for r in langid.wrong_labels(m, samples).collect()} == ({(6, "fi")} if rows else set())
    s = langid.identify(m, samples).collect()
    assert len(s) == len(rows)
    assert all(r.segments == [] for r in s if not (r.text or "").strip())
    n = m.select("rec_id", "text", normal.normalise(F.col("text")).alias("t")).collect()
    assert [r.t for r in n if r.text is None] == [None] * bool(rows) and len(n) == len(rows)
    assert encoding.found(m).count() == 0  # one garbled word is no evidence
    g = splits.grouped(m, "rec_id", {"item": splits.scanned_item()}).collect()
    assert len(g) == len(rows)
    assert {r.rec_id: r.group_id for r in g} == ({1: 1, 2: 2, 3: 3, 4: 4, 6: 4, 7: 7, 8: 8, 9: 9} if rows else {})
    a = splits.assign_splits(splits.grouped(m, "rec_id", {"item": splits.scanned_item()}).select("group_id"), {"train": 0.8, "test": 0.2})
    assert a.count() == len({r.group_id for r in g})
    targets = spark.createDataFrame([("a", 0.5, 2, "x"), ("b", 0.3, 3, "x"), ("none", 0.2, 9, "x")], "source string, target_share double, max_repeats int, n_chars string")
    copies, plan = mixing.mix(m, targets)
    r = {x.source: x for x in mixing.report(copies, plan).collect()}
    assert set(r) == {"a", "b", "none"}
    assert r["none"].n_records == 0
    assert r["a"].n_records == (4 if rows else 0)
    assert all(x.copies <= {"a": 2, "b": 3}[x.source] for x in copies.collect())


CHAT = "entry_id bigint, messages array<struct<role:string,content:string>>, images array<string>, source string, split_name string, tid string, text string, w string, term string, a string"


def chat(spark, rows):
    turns = lambda t: [("user", "<image>OCR:")] + ([("assistant", t)] if t is not False else [])
    return spark.createDataFrame([(i, turns(t), im, "s", sp, "x", "x", "x", "x", "x") for i, t, im, sp in rows], CHAT)


def test_overlap(spark):
    long = WORDS.strip()
    rows = [
        (1, long, ["./images/a/1.png"], "train"), (2, long.upper() + "  ", None, "test"), (3, long[:-1] + "x", [], "validation"), (4, None, ["images\\a\\1.png", None], "test"),
        (5, False, ["/data/images/a//1.png"], "test"), (6, "Sivu 90", None, "train"), (7, "Sivu 90", None, "test"), (8, long, None, "train"), (9, "", ["./images/b/1.png"], None), (10, long, None, "train"),
    ]
    got = {tuple(r) for r in overlap.pairs(chat(spark, rows)).collect()}
    assert got == {(1, 2), (1, 3), (1, 4), (1, 5), (2, 8), (3, 8), (2, 10), (3, 10)}
    assert overlap.pairs(chat(spark, [])).collect() == []
    assert {(r.split_name, r.kind): (r.entries, r.pairs) for r in overlap.counts(chat(spark, rows)).collect()} == {("test", "content"): (1, 3), ("validation", "content"): (1, 3), ("test", "image"): (2, 2)}


def test_truncation(spark):
    schema = "result_id bigint, messages array<struct<role:string,content:string>>, answer string, label string, source string, words string, key string, hit string, ref string, w string"
    ref = "nämä olivat talossa kun laiva tuli satamaan ja mies näki kalan"
    rows = [
        (1, ref, ref, ref), (2, ref[:40], ref, None), (3, ref[:40] + "\\u00", ref, ref[:40]), (4, ref[:-4], ref, ref), (5, ref[12:], ref, ref), (6, None, ref, ref), (7, "", ref, ref),
        (8, ref.replace("mies", "rnies"), ref, ref), (9, ref[:40], None, ref), (10, "  ", ref, ref), (2, ref[:40], ref, None), (11, ref + ".", ref, ref), (12, ref[:30], ref, ref), (13, "kala", None, None),
    ]
    df = spark.createDataFrame([(i, [("user", "x"), ("assistant", m)] if m else None, a, la, None, "x", "x", "x", "x", "x") for i, a, m, la in rows], schema)
    assert sorted(r.result_id for r in truncation.truncated(df).collect()) == [2, 2, 3, 9, 12]
    assert truncation.truncated(df.limit(0)).collect() == []
    r = truncation.rates(df.dropDuplicates(["result_id"])).collect()
    assert [(x.source, x.answers, x.truncated) for x in r] == [(None, 10, 4)]


def test_trigrams_alone(spark):
    """The named method of problem 6 against brute force."""
    from corpusforge.llm import truncation

    refs = ["nämä olivat talossa kun laiva tuli", "kun laiva tuli satamaan ja lähti", "nämä olivat talossa", "kun laiva tuli"]
    answers = ["nämä olivat talossa", "kun laiva tuli", "laiva tuli satamaan", "NÄMÄ olivat", "muuta", "", None, "kun laiva tuli satamaan ja lähti"]
    df = spark.createDataFrame([(i, [("user", "x"), ("assistant", refs[i % 4])], a, None) for i, a in enumerate(answers)], "result_id bigint, messages array<struct<role:string,content:string>>, answer string, label string")
    w = lambda t: ["^", "^", *t.lower().split()]
    inside, ends = {}, {}
    for r in refs:
        x = w(r)
        for i in range(2, len(x)):
            (inside if i < len(x) - 1 else ends).setdefault(tuple(x[i - 2 : i + 1]), []).append(r)
    count = lambda d, k: len(d.get(k, []))
    want = {}
    for i, a in enumerate(answers):
        k = tuple(w(a or "")[-3:])
        if a and count(inside, k) >= 1 and count(ends, k) <= 0.02 * (count(inside, k) + count(ends, k)):
            want[i] = (count(inside, k), count(ends, k))
    assert {r.result_id: (r.inside, r.at_end) for r in truncation.by_trigrams(df).collect()} == want and set(want) == {2, 3}
    far = "alku " + " ".join("".join(random.Random(i).choices("aeioukstlnrmpvhj", k=6)) for i in range(60))
    noisy = far[:100] + "".join("x" if i % 5 == 0 else c for i, c in enumerate(far[100:300]))
    one = spark.createDataFrame([(1, [("user", "x"), ("assistant", far)], noisy, None), (2, [("user", "x"), ("assistant", far)], far[:100], None)], df.schema)
    assert {r.result_id for r in truncation.truncated(one).collect()} == {1, 2}  # anchors are tried as far back as the answer goes


def test_runs_without_any_boundary(spark):
    """Long unbroken runs are cut between tokens, not letter by letter."""
    from corpusforge.llm.tokens import counter, vocabulary_path

    rng = random.Random(8)
    c = counter(vocabulary_path())
    runs = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzåäö", k=30_000)), "".join(rng.choices("абвгдежзик", k=20_000)), "sana " * 500 + "x" * 40_000 + " sana" * 3000, "漢字" * 9000]
    d = spark.createDataFrame(list(enumerate(runs)), "doc_id bigint, text string")
    p = chunking.pieces(d).orderBy("doc_id", "piece_no").collect()
    for k, t in enumerate(runs):
        mine = [r for r in p if r.doc_id == k]
        assert all(c.count(r.text) <= 4096 for r in mine)
        assert "".join(r.text[r.overlap_chars:] for r in mine) == t
        assert c.count(t) / 4096 <= len(mine) <= 3 + 2.5 * c.count(t) / 4096
        assert all(r.overlap_chars > 20 and c.count(r.text[:r.overlap_chars]) <= 128 for r in mine[1:])


def test_segments_of_a_mixed_text(spark):
    samples = [(r.lang, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/lang_samples.parquet").collect()]
    m = langid.Model.fit(samples)
    fi, ru = next(t for la, t in samples if la == "fi" and len(t) > 80), next(t for la, t in samples if la == "ru" and len(t) > 80)
    s = m.segments([f"{fi} {ru}", fi, "aa", fi * 40])
    assert [langid.LANGUAGES[x[0]] for x in s[0]] == ["fi", "ru"] and s[0][0][2] <= s[0][1][1] and s[0][1][2] <= len(fi) + 1 + len(ru)
    assert 0.5 < s[1][0][3] < 1 and abs(s[1][0][3] - s[3][0][3]) < 0.02 and s[2][0][3] < s[1][0][3]  # no surer for being longer
    few = langid.Model(m.weights, m.codes, 10)
    assert len(few.segments([f"{fi} {ru[:18]}"])[0]) == 2 and len(m.segments([f"{fi} {ru[:18]}"])[0]) == 1
