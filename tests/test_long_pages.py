"""Documents of many paragraphs go through the layout queries like any other."""

from collections import defaultdict

import pytest

import __spark_entry__ as entry

N = 61


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("long")
    text = "\n\n".join(f"kappale numero {i} on riittävän pitkä" + "\ntoinen rivi" * (i % 4) + " x" * (3 * i) for i in range(N))
    spark.createDataFrame([(1, text), (2, "yksi lyhyt kappale riittää\n\ntoinen kappale on tässä näin"), (3, "")], "doc_id bigint, text string").write.parquet(f"{d}/documents.parquet")
    return str(d), [p for p in text.split("\n\n")]


def test_every_block_of_a_long_document(spark, data):
    q = lambda n: entry.queries()[n](spark, data[0])
    assert sorted(r.block for r in q("column_detect").where("page_id = 1").collect()) == list(range(N))
    assert {r.page_id for r in q("reading_order_text").collect()} == {1, 2}
    assert sum(r.pages for r in q("column_count_hist").collect()) == 2


def test_all_windows_of_a_long_document(spark, data):
    d, parts = data
    q = lambda n: entry.queries()[n](spark, d)
    own = defaultdict(list)
    for r in sorted(q("column_detect").where("page_id = 1").collect(), key=lambda r: r.block):
        own[r.col].append(parts[r.block])
    want = sorted((c, k, s, len("\n".join(b[s : s + k]))) for c, b in own.items() for k in range(1, len(b) + 1) for s in range(len(b) - k + 1))
    got = sorted((r.col, r.win, r.start, r.chars) for r in q("sliding_windows").where("page_id = 1").collect())
    assert got == want and len(own) > 1
    capped = q("paragraph_dedup_cap").where("page_id = 1").collect()
    assert sorted({r.col for r in capped}) == sorted(own) and all(sum(r.col == c for r in capped) == min(10, len(b)) for c, b in own.items())
