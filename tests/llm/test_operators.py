"""Each operator against a brute-force version, an exact round trip or held-out accuracy."""

import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusforge.llm import chunking, encoding, langid, leakage, mixing, normal, overlap, packing, splits
from corpusforge.llm.chars import TRANSFORMS, undo
from corpusforge.llm.tokens import counter, vocabulary_path
from corpusforge.runtime import table

DATA = "/root/testdata/sf0.001"


def test_token_counts_equal_the_tokenizer():
    c = counter(vocabulary_path())
    for t in ["", "kala ja meri", "Ääkkönen 12,5  tai\n\n\tja… \U0001f600", "x" * 5000, "корабль"]:
        assert c.count(t) == len(c.encoding.encode_ordinary(t))


@given(st.text(alphabet="ab ä.\n", max_size=300), st.integers(2, 40))
@settings(max_examples=60, deadline=None)
def test_no_window_of_the_span_exceeds_the_limit(text, limit):
    c = counter(vocabulary_path())
    n, span = c.tightest(text, limit)
    assert n == c.count(text) and (span == -1) == (n <= limit)
    cuts, sizes = c.sizes(text)
    ends, starts = np.cumsum(list(map(len, cuts))), np.cumsum([0, *map(len, cuts)])[:-1]
    for a in range(0, max(0, len(text) - span + 1)) if span > 0 else []:
        inside = sum(s for s, x, y in zip(sizes, starts, ends) if x >= a and y <= a + span)
        assert inside <= limit


def test_pieces_are_whole_and_within_the_limit(spark):
    rng = random.Random(1)
    words = ["kala", "satamassa", "ja", "talonpoika.", "näki\n\n", "1888", "laiva,"]
    texts = [(i, " ".join(rng.choice(words) for _ in range(n))) for i, n in enumerate([10, 3000, 9000])] + [(9, "x1" * 20000), (10, "ä" * 9000)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    rows = chunking.pieces(df, limit=500, overlap=40).collect()
    c, by = counter(vocabulary_path()), dict(texts)
    for i, t in texts:
        mine = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece_no)
        assert bool(mine) == (c.count(t) > 500)
        if mine:
            assert "".join(r.text[r.overlap_chars :] for r in mine) == by[i]
        for r in mine:
            assert c.count(r.text) <= 500 and t[r.start : r.start + len(r.text)] == r.text and c.count(r.text[: r.overlap_chars]) <= 42
            if i < 9 and r.piece_no < r.n_pieces:
                assert r.text[-1].isspace()


@given(st.lists(st.integers(1, 100), max_size=200))
@settings(max_examples=60, deadline=None)
def test_packing_keeps_capacity_and_is_tight(sizes):
    where = packing.pack(sizes, 100)
    fill = {}
    for s, k in zip(sizes, where):
        fill[k] = fill.get(k, 0) + s
    assert all(v <= 100 for v in fill.values())
    assert len(fill) <= 2 * -(-sum(sizes) // 100) if sizes else not fill
    small = [v for v in fill.values() if v <= 50]
    assert len(small) <= 1  # two half-empty sequences would have been one


def test_fill_of_real_documents(spark):
    p = packing.packed(table(spark, DATA, "documents"))
    f = packing.fills(p).agg(F.sum("fill").alias("s"), F.count("*").alias("n")).first()
    assert f.s / (f.n * 2048) > 0.9


def test_cube_keeps_totals():
    rng = np.random.default_rng(3)
    size = rng.integers(10, 2000, 800)
    p = np.full(800, 0.37)
    q = mixing.land(mixing.fly(p, size, 5), size)
    assert set(q) <= {0.0, 1.0}
    assert abs(q.sum() - p.sum()) <= 2 and abs((q * size).sum() - (p * size).sum()) <= size.max()


def test_cube_honours_inclusion_probabilities():
    size = np.arange(1, 41)
    mean = np.mean([mixing.land(mixing.fly(np.full(40, 0.3), size, s), size) for s in range(600)], axis=0)
    assert abs(mean.mean() - 0.3) < 0.02 and mean.min() > 0.15 and mean.max() < 0.45


def test_mix_reaches_feasible_shares(spark):
    copies, plan = mixing.mix(table(spark, DATA, "manifest"), table(spark, DATA, "mix_targets"))
    r = mixing.report(copies, plan).collect()
    biggest = max(x.n_chars for x in copies.collect())
    for x in r:
        assert x.short or abs(x.reached_chars - x.target_chars) <= biggest
        assert not x.short or x.reached_chars == x.max_repeats * x.n_chars


def test_components_against_brute_force(spark):
    rng = random.Random(7)
    edges = [(f"n{rng.randrange(150)}", rng.randrange(-40, 200)) for _ in range(220)]
    got = dict(map(tuple, splits.components(spark.createDataFrame(edges, "node string, rec bigint").repartition(5)).collect()))
    label = {r: r for _, r in edges}
    for _ in range(200):
        for a, b in itertools.combinations(edges, 2):
            if a[0] == b[0] and label[a[1]] != label[b[1]]:
                label[a[1]] = label[b[1]] = min(label[a[1]], label[b[1]])
        if all(label[x[1]] == label[y[1]] for x, y in itertools.combinations(edges, 2) if x[0] == y[0]):
            break
    assert got == label


def test_small_forests_are_joined(spark, monkeypatch):
    edges = [(f"k{i // 2}", i) for i in range(60)] + [(f"m{i // 2}", i + 1) for i in range(60)]
    monkeypatch.setattr(splits, "FOREST_EDGES", 7)
    rows = list(splits._local(iter([__import__("pandas").DataFrame(edges[k : k + 5], columns=["node", "root"]) for k in range(0, 120, 5)])))
    assert sum(len(r) for r in rows) > 120
    assert {tuple(r) for r in splits.components(spark.createDataFrame(edges, "node string, rec bigint")).select("component").distinct().collect()} == {(0,)}


def test_greedy_quota_is_the_greedy_walk():
    hist = [(50, 1), (7, 40), (3, 25), (1, 300)]
    targets = {"train": 0.8, "validation": 0.1, "test": 0.1}
    total = sum(s * n for s, n in hist)
    lack = {k: v * total for k, v in targets.items()}
    for s, n in sorted(hist, reverse=True):
        for _ in range(n):
            k = max(lack, key=lambda x: (lack[x], x))
            lack[k] -= s
    left = {k: v * total for k, v in targets.items()}
    for s, k, n in splits.greedy_quota(hist, targets):
        left[k] -= s * n
    assert all(abs(left[k] - lack[k]) <= 1 + 1e-6 for k in targets)


def test_splits_hold_groups_together(spark):
    from corpusforge.llm import queries

    rows = queries.p5_splits(spark, DATA).collect()
    assert len(rows) == table(spark, DATA, "manifest").count()
    by = {}
    for r in rows:
        assert by.setdefault(r.group_id, r.split) == r.split
    share = sum(r.split == "train" for r in rows) / len(rows)
    assert abs(share - 0.8) < 0.02


@pytest.mark.parametrize("written,read", TRANSFORMS)
def test_undo_is_a_round_trip(written, read):
    for t in ("yöpäivä", "då", "книга", "Õhtu"):
        try:
            bad = t.encode(written).decode(read)
        except (UnicodeEncodeError, UnicodeDecodeError):
            continue
        if bad != t:
            assert undo(bad, written, read) == t


def test_transformations_are_learned_and_applied(spark):
    words = ["yöpäivä", "hänen", "käyrä", "pöytä", "löytö", "työtä", "näkö", "kylä", "sähkö", "meri"]
    rng = random.Random(2)
    clean = [(i, " ".join(rng.choice(words) for _ in range(8))) for i in range(80)]
    wrong = lambda t, r: t.encode("utf-8" if r != "cp437" else "latin-1").decode(r)
    bad = {100 + k: wrong(clean[k][1], ["mac_roman", "cp1252", "cp437"][k % 3]) for k in range(30) if any(c > "\x7f" for c in clean[k][1])}
    other = [(900, "São Tomaz ja JOÃO"), (901, "lаiva ﬁsk ja kala"), (902, "kala nyt? Ei.")]
    df = spark.createDataFrame([*clean, *bad.items(), *other], "rec_id bigint, text string")
    assert {r.rec_id for r in encoding.found(df).collect()} == set(bad)
    fixed = {r.rec_id: r.text for r in encoding.restored(df).collect()}
    assert all(fixed[100 + k] == clean[k][1] for k in range(30) if 100 + k in bad)


@given(st.text(max_size=60))
@settings(max_examples=200, deadline=None)
def test_normal_form_is_stable(t):
    n = normal.normalised(t)
    assert normal.normalised(n) == n


@pytest.mark.parametrize(
    "text,bits",
    [("kala", 0), ("käyrä – ”ja”…", 0), ("a\tb\n c  ", 0), ("книга и kala", 0), ("ｋａｌａ", 1), ("ﬁsk", 1), ("käyrä", 2), ("ka­la", 4), ("﻿kala", 4), ("ja kala", 8), ("kаla", 16), ("νesi", 16), ("Åbo", 1)],
)
def test_deviations(text, bits):
    assert normal.deviations(text) == bits
    assert (normal.visible(text) != text) == bool(bits) or text == "käyrä – ”ja”…"


def test_language_accuracy_on_held_out_documents(spark):
    s = [(r.lang, r.text) for r in table(spark, DATA, "lang_samples").collect()]
    train, held = [x for i, x in enumerate(s) if i % 3], [x for i, x in enumerate(s) if not i % 3]
    m = langid.Model.fit(train)
    got = [langid.LANGUAGES[r[0][0]] for r in m.segments([t for _, t in held])]
    assert np.mean([g == lang for g, (lang, _) in zip(got, held)]) > 0.97
    by = {lang: t for lang, t in held if len(t) > 120}
    for a, b in itertools.permutations(by, 2):
        mixed = m.segments([by[a] + " " + by[b]])[0]
        assert [langid.LANGUAGES[x[0]] for x in mixed] == [a, b]


def test_codewords_are_far_apart():
    c = langid.codewords()
    assert min((c[a] != c[b]).sum() for a, b in itertools.combinations(range(len(c)), 2)) >= 6


def test_leaks_with_noise(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("aeioukstlnrmpvhj") for _ in range(rng.randrange(2, 13)))
    item = [word() for _ in range(60)]
    other = lambda n: " ".join(word() for _ in range(n))
    part = item[20:36]
    misread = [w if i % 5 else w[:1] + "x" + w[2:] for i, w in enumerate(part)]
    broken = " ".join(w[:3] + "-\n" + w[3:] if len(w) > 6 else w for w in part)
    cases = [(1, " ".join(part)), (2, " ".join(misread).upper()), (3, broken), (4, ", ".join(part).replace("a", "á")), (5, " ".join(item[5:14])), (6, other(16)), (7, " ".join(part[:8]) + "\n\n12\n\n" + " ".join(part[8:]))]
    df = spark.createDataFrame([(i, other(50) + " " + t + " " + other(50)) for i, t in cases], "doc_id bigint, text string")
    found = leakage.leaks(df, spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string"))
    assert {r.doc_id for r in found.collect()} == {1, 2, 3, 4, 7}
    cut = {r.doc_id: r.text for r in leakage.without_spans(df, found, 0.1).collect()}
    assert len(cut) == 7 and " ".join(part[3:8]) not in cut[1] and cut[6] == dict(df.collect())[6]


def test_near_texts_against_brute_force(spark):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("aeioukstlnrmp") for _ in range(rng.randrange(3, 12))) for _ in range(400)]
    base = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(8, 60))) for _ in range(120)]

    def noisy(t, share):
        t = list(t)
        for i in rng.sample(range(len(t)), int(len(t) * share)):
            t[i] = rng.choice("xyzw")
        return "".join(t)

    held = [noisy(t, rng.choice([0, 0.01, 0.03, 0.05])) for t in base[:80]] + [" ".join(rng.choice(vocabulary) for _ in range(20)) for _ in range(40)]
    rows = [(i, t, "train") for i, t in enumerate(base)] + [(1000 + i, t, "test") for i, t in enumerate(held)]
    df = spark.createDataFrame([(i, [("user", "x"), ("assistant", t)], None, "s", sp) for i, t, sp in rows], "entry_id bigint, messages array<struct<role:string,content:string>>, images array<string>, source string, split_name string")
    got = {tuple(r) for r in overlap.pairs(df).collect()}
    both = spark.createDataFrame([(i, t) for i, t, s in rows if s == "train"], "a bigint, x string").crossJoin(spark.createDataFrame([(i, t) for i, t, s in rows if s == "test"], "b bigint, y string"))
    want = {tuple(r) for r in both.where("length(x) >= 40 and length(y) >= 40 and levenshtein(x, y) * 10 <= greatest(length(x), length(y))").select("a", "b").collect()}
    assert len(want) >= 70 and got <= want and len(got) >= 0.98 * len(want)
