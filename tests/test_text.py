"""Scalar functions against plain Python versions."""

import textwrap

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusforge.functions import text as T
from corpusforge.operators import corruption as C

CASES = [("", "", 0, 0, 0), ("abc", "", 1, 1, 1), ("", "abc", 1, 1, 1), ("paiva", "päivä", 2 / 5, 2 / 5, 1), ("a b c d", "a b", 4 / 7, 4 / 3, 1), ("x y", "x z", 1 / 3, 1 / 3, 1 / 2)]


@pytest.mark.parametrize("pred,ref,ned,cer,wer", CASES)
def test_metrics(spark, pred, ref, ned, cer, wer):
    r = spark.createDataFrame([(pred, ref)], "p string, r string").select(T.ned(F.col("p"), F.col("r")), T.cer(F.col("p"), F.col("r")), T.wer(F.col("p"), F.col("r"))).first()
    assert tuple(r) == pytest.approx((ned, cer, wer))


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


@given(st.lists(st.tuples(st.text("ab ä　\n", max_size=25), st.text("ab ä　\n", max_size=25)), min_size=1, max_size=30))
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_properties(spark, rows):
    p, r = F.col("p"), F.col("r")
    got = spark.createDataFrame(rows, "p string, r string").select("p", "r", T.ned(p, r).alias("n"), T.ned(r, p).alias("m"), T.ned(p, p).alias("z"), T.wer(p, r).alias("w"), T.strip(p).alias("s"), T.words(p).alias("ws"), T.is_blank(p).alias("b")).collect()
    for x in got:
        assert 0 <= x.n <= 1 and x.n == x.m and x.z == 0
        assert x.n == pytest.approx(edit(x.p, x.r) / max(len(x.p), len(x.r), 1))
        a, b = x.p.split(), x.r.split()
        assert x.w == pytest.approx(edit(a, b) / len(b) if b else float(bool(a)))
        assert x.s == x.p.strip() and x.ws == a and x.b == (not a)


def test_wrap_is_greedy(spark):
    t = "kala ja meri olivat talossa kun hän näki laivan satamassa " * 3
    got = spark.createDataFrame([(t, w) for w in range(12, 60)], "t string, w int").select("w", T.wrapped(F.col("t"), F.col("w")).alias("x")).collect()
    for r in got:
        assert r.x == textwrap.fill(t.strip(), r.w, break_long_words=False, break_on_hyphens=False)


def test_corruption_is_seeded_and_bounded(spark):
    df = spark.createDataFrame([(i, "Wärjö kuva rn 1234 olivat") for i in range(300)], "i int, t string")
    s = F.col("i").cast("string")
    one = df.select("i", C.corrupted(F.col("t"), s, "heavy").alias("x"), C.diacritic_swap(F.col("t"), s, F.lit(1.0)).alias("d"), C.digit_swap(F.col("t"), s, F.lit(1.0)).alias("g"), C.confuse(F.col("t"), s, F.lit(1.0)).alias("c"), C.char_noise(F.col("t"), s, F.lit(0.0)).alias("n"))
    a, b = one.orderBy("i").collect(), one.repartition(3).orderBy("i").collect()
    assert a == b and len({r.x for r in a}) > 100
    assert {r.d for r in a} == {"Warjo kuva rn 1234 olivat"} and all(r.g[:14] == "Wärjö kuva rn " and r.g[14:18].isdigit() for r in a)
    assert {r.n for r in a} == {"Wärjö kuva rn 1234 olivat"} and all(r.c != "Wärjö kuva rn 1234 olivat" for r in a)


def test_null_and_empty(spark):
    r = spark.createDataFrame([(None,), ("",)], "t string").select("t", T.strip(F.col("t")).alias("s"), T.is_blank(F.col("t")).alias("b"), T.symbol_share(F.col("t")).alias("y"), T.stem(F.col("t")).alias("m")).collect()
    assert [(x.s, x.b, x.y) for x in r] == [(None, True, None), ("", True, None)]
    x = spark.createDataFrame([("a/b.c/d.tar.gz",), (".x",)], "t string").select(T.stem(F.col("t"))).collect()
    assert [y[0] for y in x] == ["d.tar", ".x"]


@given(st.lists(st.integers(0, 4), max_size=14), st.lists(st.integers(0, 4), max_size=14))
@settings(max_examples=300, deadline=None)
def test_edit_distance_of_lists(a, b):
    assert T.edit_distance(a, b) == edit(a, b)


def test_words_without_number(spark):
    """More distinct words than any code page holds."""
    a = [f"w{i}" for i in range(70_000)]
    b = a[:30_000] + ["x"] + a[30_001:60_000] + a[60_002:]
    r = spark.createDataFrame([(" ".join(a), " ".join(b)), (None, "x")], "p string, r string").select(T.wer(F.col("p"), F.col("r")).alias("w")).collect()
    assert r[0].w == pytest.approx(3 / 69_998) and r[1].w is None


def test_long_positions(spark):
    from corpusforge.operators import records

    n = [5, 12345678, 123456789012, 123456789999]
    r = spark.createDataFrame([(i,) for i in n], "i bigint").select(records.image_name(F.lit(None).cast("string"), F.col("i"))).collect()
    assert [x[0] for x in r] == ["00000005.png", "12345678.png", "123456789012.png", "123456789999.png"]
