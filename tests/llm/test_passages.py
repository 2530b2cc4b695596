"""A document may hold several passages of one item; none may stay in the clean text."""

import random

from pyspark.sql import functions as F

from corpusforge.llm import leakage, queries


def test_every_passage_is_cut(spark, tmp_path):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("aeioukstlnrmpvhj") for _ in range(rng.randrange(3, 11)))
    other = lambda n: " ".join(word() for _ in range(n))
    item = [word() for _ in range(90)]
    part = lambda a, b: " ".join(item[a:b])
    bodies = {
        1: [part(0, 34), other(200), part(60, 74)],  # on diagonals far apart
        2: [part(0, 20), " ".join(w[::-1] + "q" for w in item[20:40]), part(40, 60)],  # on one diagonal, other words between
        3: [part(10, 23), other(3), part(10, 23)],  # one passage twice
        4: [part(30, 43), part(22, 30)],  # neighbours in the wrong order
        5: [part(50, 80)],
        6: [other(20), part(5, 14)],  # too short
    }
    docs = spark.createDataFrame([(k, " ".join([other(150), *b, other(150)])) for k, b in bodies.items()], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, " ".join(item)), (2, other(40))], "item_id bigint, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/heldout_items.parquet")
    clean = {r.doc_id: r.text for r in queries.p9_clean(spark, str(tmp_path)).collect()}
    assert set(clean) == set(bodies) and clean[6] == docs.where("doc_id = 6").first().text
    assert leakage.leaks(spark.createDataFrame(list(clean.items()), docs.schema), items).collect() == []
    held = [w for w in item[:20] + item[40:] if len(w) >= 6]
    assert not [(k, w) for k in (1, 2, 3, 5) for w in held if f" {w} " in clean[k]]
    assert all(len(t) > 0.9 * len(docs.where(F.col("doc_id") == k).first().text) - len(" ".join(bodies[k])) for k, t in clean.items())
    found = [tuple(r) for r in queries.p9_found(spark, str(tmp_path)).collect()]
    assert sorted(found) == [(k, 1) for k in (1, 2, 3, 4, 5)]


def test_items_that_overlap_in_a_document(spark):
    """Two items share words; their spans overlap, and nothing of either is left."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("aeioukstlnrmpvhj") for _ in range(rng.randrange(4, 11)))
    w = [word() for _ in range(60)]
    other = lambda n: " ".join(word() for _ in range(n))
    items = spark.createDataFrame([(1, " ".join(w[:40])), (2, " ".join(w[20:]))], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, f"{other(200)} {' '.join(w)} {other(200)}"), (2, other(300))], "doc_id bigint, text string")
    p = leakage.passages(docs, items)
    assert {(r.doc_id, r.item_id) for r in p.collect()} == {(1, 1), (1, 2)}
    clean = leakage.without_spans(docs, p)
    assert clean.count() == 2 and leakage.passages(clean, items).count() == 0
    twice = spark.createDataFrame([(1, f"{' '.join(w[:14])} {other(40)} {' '.join(w[:14])}")], "doc_id bigint, text string")
    one = leakage.leaks(twice, items).collect()
    assert [(r.words, r.start) for r in one] == [(14, 0)] and one[0].end == len(" ".join(w[:14]))  # the first of two equal runs, start and end of one


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(leakage, "ITEM_BLOCK", 2)
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choice("aeioukstlnrmpvhj") for _ in range(7)) for _ in range(20)) for _ in range(9)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")
    docs = spark.createDataFrame([(k, "alku " + t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    assert sorted((r.doc_id, r.item_id) for r in leakage.leaks(docs, items).collect()) == [(k, k) for k in range(9)]
