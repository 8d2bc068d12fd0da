import brute
import numpy as np
import pyarrow.parquet as pq
import pytest

from fairflow.llm import decontaminate as d
from fairflow.llm.fm import FMIndex

COLUMNS = ["row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def got(hits):
    return sorted(map(repr, map(tuple, d.contamination(hits).select(*COLUMNS).collect())))


def want(rows, items, window=13):
    return sorted(map(repr, brute.decontamination(rows, items, window)))


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_whole_table(spark, texts, make):
    items = [(r["item_id"], r["text"]) for r in pq.read_table("/root/testdata/sf0.001/benchmark.parquet").to_pylist()]
    rows = [(i, t) for i, t, *_ in texts]
    expected = brute.decontamination(rows, items)
    assert any(r[-1] for r in expected)
    assert got(d.find_hits(make(rows), bench(spark, items))) == want(rows, items)


ITEMS = [(1, "A b c d e"), (2, "c d"), (3, "Éx b"), (None, "q r"), (5, None), (6, " - "), (7, "a b c d e f"), (1, "z z"), (9, "solo")]
ROWS = [(1, "a-B,c d\x00e f g"), (2, None), (3, ""), (4, "éx b Éx B"), (5, "q r q r"), (None, "z z z z y"), (6, "c"),
        (6, "d c d c d"), (8, "SOLO " * 40), (9, "!!"), (10, "b c d e f " * 3), (11, "n " * 99 + "solo"), (1, "a-B,c d\x00e f g")]


@pytest.mark.parametrize("window", [1, 2, 3, 13])
def test_edges(spark, make, window):
    assert got(d.find_hits(make(ROWS), bench(spark, ITEMS), window=window)) == want(ROWS, ITEMS, window)


def test_small_blocks_and_shards(spark, make, monkeypatch):
    for name, value in (("BLOCK_ITEMS", 2), ("SHARD_BYTES", 40), ("TEXT_BLOCK", 16)):
        monkeypatch.setattr(d, name, value)
    assert got(d.find_hits(make(ROWS), bench(spark, ITEMS), window=3)) == want(ROWS, ITEMS, 3)


def test_filter_keeps_columns_and_cuts(spark, make):
    df = make([(1, "solo"), (2, "n " * 30 + "Solo, é m"), (3, None), (4, "clean")]).selectExpr("*", "7 AS row", "8 AS hits")
    out = d.decontaminate(df, bench(spark, ITEMS))
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == {2: "n " * 30 + " , é m", 3: None, 4: "clean"}


def test_empty_tables(spark, make):
    assert d.decontaminate(make([]), bench(spark, ITEMS)).count() == 0
    assert got(d.find_hits(make(ROWS), bench(spark, []))) == want(ROWS, [])


def test_index_against_scan():
    r = np.random.default_rng(1)
    text = np.append(r.integers(0, 4, 500), 0)
    index = FMIndex(text, 4)
    for n in (1, 2, 5):
        phrases = r.integers(1, 4, (60, n))
        found, low, high = index.search(phrases)
        rows = {int(f): sorted(index.locate(np.arange(a, b)).tolist()) for f, a, b in zip(found, low, high)}
        for k, p in enumerate(phrases):
            at = [i for i in range(len(text) - n + 1) if (text[i:i + n] == p).all()]
            assert rows.get(k, []) == at
