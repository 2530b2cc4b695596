"""Copies of a garbled record don't vote it clean."""

import pytest

from corpusforge.llm import encoding

CLEAN = ["пол или если дом", "если вода и пол", "или река если лес", "пол или дом река", "вода если или пол", "лес или вода дом", "если пол река", "дом вода или если", "ГЛАВА ПЕРВАЯ", "глава первая или пол"]
TEXT = "если пол или вода река дом вельница"  # the last word is nowhere else


@pytest.mark.parametrize("copies", [1, 4, 60])
def test_copies_of_a_garbled_record(spark, copies):
    bad = TEXT.encode("koi8-r").decode("cp1251")
    rows = [*enumerate(CLEAN), *((100 + k, bad) for k in range(copies)), (900, "ГЛАВА ПЕРВАЯ и " + bad)]
    df = spark.createDataFrame(rows, "rec_id bigint, text string")
    fixed = {r.rec_id: r.text for r in encoding.restored(df).collect()}
    assert fixed == {**{100 + k: TEXT for k in range(copies)}, 900: "ГЛАВА ПЕРВАЯ и " + TEXT}
    assert {r.rec_id for r in encoding.found(df).collect()} == set(fixed)


def test_copies_with_other_ends(spark):
    bad = TEXT.encode("koi8-r").decode("cp1251")
    rows = [*enumerate(CLEAN * 3), (200, "дом лес вода пол".encode("koi8-r").decode("cp1251")), *((100 + k, f"{bad} {k}") for k in range(3))]
    df = spark.createDataFrame([(i, t if i >= 100 else f"{t} {i}") for i, t in rows], "rec_id bigint, text string")
    assert {r.rec_id: r.text for r in encoding.restored(df).collect()} == {200: "дом лес вода пол", **{100 + k: f"{TEXT} {k}" for k in range(3)}}


def test_a_change_no_encoding_table_knows_is_learned(spark):
    """National 7-bit letters: the table comes from aligned runs; brackets around a word and table bars are no letters."""
    words = ["hänen", "käyrä", "näkö", "kylä", "yöllä", "löytö", "työtä", "mätäs", "pöytä", "sähkö", "nämä", "älä"]
    clean = [(i, " ".join(words[(i * 5 + k) % 12] for k in range(6)) + f" {i}") for i in range(40)]
    wrong = str.maketrans("äöåÄÖÅ", "{|}[\\]")
    bad = {100 + k: " ".join(words[(k + j) % 12].translate(wrong) for j in range(4)) + "." for k in range(12)}
    other = [(900, "{Kesila} ja [Norela] kala"), (901, "kala | meri | talo|"), (902, "kala{meri|talo")]
    df = spark.createDataFrame([*clean, *bad.items(), *other], "rec_id bigint, text string")
    assert {r.rec_id for r in encoding.found(df).collect()} == set(bad)
    back = str.maketrans("{|}[\\]", "äöåÄÖÅ")
    assert {r.rec_id: r.text for r in encoding.restored(df).collect()} == {k: t.translate(back) for k, t in bad.items()}
    more = df.unionByName(spark.createDataFrame([(950, "y|ll{ ja xy|ll{, (n{m{). {y|ll{}")], df.schema))
    assert [r.text for r in encoding.restored(more).where("rec_id = 950").collect()] == ["yöllä ja xy|ll{, (nämä). {yöllä}"]


def test_mappings_are_inferred_from_runs():
    runs = {("Ã¤", "ä"): 9, ("Ã¶", "ö"): 7, ("Ã¤Ã¤", "ää"): 3, ("{", "ä"): 5, ("|", "ö"): 4, ("Σ", "ä"): 2}
    got = encoding.inferred(runs, {})
    assert (got[0].written, got[0].read) == ("utf-8", "cp1252") and got[-1].table == (("{", "ä"), ("|", "ö")) and len(got) == 2
    assert encoding.aligned("k{yr{", "käyrä") == [("{", "ä"), ("{", "ä")] and encoding.aligned("k{yr", "kyrä") is None


def test_records_as_twins(spark):
    texts = [f"{w} {i} oli talossa kun laiva tuli" for i, w in enumerate(["hänen", "käyrä", "näkö", "kylä", "sähkö", "mätäs"])]
    rows = [*enumerate(texts), *((10 + i, t.encode().decode("cp1252")) for i, t in enumerate(texts)), (30, "väylä".encode().decode("cp1252")), (31, "São Tomaz"), (32, None)]
    df = spark.createDataFrame(rows, "rec_id bigint, text string")
    assert {r.rec_id for r in encoding.found_by_records(df).collect()} == {*range(10, 16), 30}
    assert encoding.found_by_records(df.limit(0)).collect() == []


def test_cosine_join_keeps_noisy_copies(spark):
    from corpusforge.llm import overlap
    from tests.llm import recall_overlap as R

    texts = R.contents(spark, "/root/testdata/sf0.001")
    for share, least in ((0.095, 0.93),):
        found, all_ = R.recall(spark, texts, share)
        assert all_ > 100 and found >= least * all_
    t, _ = overlap.texts(spark.read.parquet("/root/testdata/sf0.01/chat_entries.parquet"), 40)
    of = {tuple(r) for r in overlap.near_texts_of(t, 10).collect()}
    got = {tuple(r) for r in overlap.near_texts(t).where("b % 10 = 0 and a <> b").collect()}
    assert {x for x in of if x[0] != x[1]} == got


def test_short_texts_of_long_words(spark):
    from corpusforge.llm import overlap

    a, b = "abcdefghijklmnopqrstuvwxyzåäö" * 2, "kalastajatorpparikansankoulu merimieskirkonmäellä"
    rows = [(1, a, True, False), (2, a[:20] + "X" + a[21:], False, True), (3, b, True, False), (4, b.replace(" ", ""), False, True), (5, "x" * 60, False, True)]
    t = spark.createDataFrame(rows, "tid bigint, text string, train boolean, held boolean")
    assert {tuple(r) for r in overlap.near_texts(t).collect()} == {(1, 2, 1), (3, 4, 1)}
