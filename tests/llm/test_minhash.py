import random

import brute
import numpy as np
import pytest

from fairflow.llm import families, minhash, staging
from fairflow.llm.components import components
from pyspark.sql import functions as F


def got(spark, df, **options):
    out = minhash.near_duplicates(df, **options).select(
        minhash._id_of("_id").alias("i"), "n_shingles", minhash._id_of("component").alias("c"),
        F.expr("_id = component"))
    return sorted(map(repr, map(tuple, out.collect())))


def want(rows, **options):
    return sorted(map(repr, brute.near(rows, **options)))


def test_whole_table(spark, texts, make):
    rows = [(i, t) for i, t, *_ in texts]
    assert any(not r[3] for r in brute.near(rows))
    assert got(spark, make(rows, 5)) == want(rows)


def family(seed, n, words=60):
    """Mutated copies whose similarity lies on both sides of the threshold."""
    r = random.Random(seed)
    base = [f"w{seed}x{r.randrange(10 ** 6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(r.randrange(9)):
            copy[r.randrange(words)] = f"m{r.randrange(60)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("block", [200, 1 << 18])
def test_families_around_the_threshold(spark, make, monkeypatch, block):
    monkeypatch.setattr(families, "BLOCK_SHINGLES", block)
    rows = [(100 - k, t) for k, t in enumerate(family(1, 50) + family(2, 12) + family(3, 3))]
    assert got(spark, make(rows)) == want(rows)


def test_different_sets_with_one_number(spark, make):
    """Numbers of three bits: most sets share theirs with others."""
    rows = [(k, t) for k, t in enumerate(family(1, 12) + family(2, 5) + [f"one two three {k} five six" for k in range(20)])]
    rows += [(100 + k, t) for k, t in rows[::4]]
    assert got(spark, make(rows), number_bits=3) == want(rows)


def test_a_chain_of_templates(spark, make):
    """Texts half of which the next one shares: buckets overlap all along, few link."""
    r = random.Random(9)
    parts = [" ".join(f"p{k}w{r.randrange(10 ** 6)}" for _ in range(25)) for k in range(60)]
    rows = [(k, f"{parts[k]} {parts[k + 1]} {parts[k]}") for k in range(59)] + [(70 + k, f"{parts[k]} {parts[k + 1]} {parts[k]} z{k}") for k in range(0, 59, 7)]
    assert got(spark, make(rows)) == want(rows)


def test_edges(spark, make):
    text = " ".join(f"a{k}" for k in range(50))
    rows = [(5, text), (3, text.upper()), (None, text + " z"), (None, "only"), (7, None), (8, ""), (9, " \t"), (1, "Only"),
            (2, "x y"), (2, "x y"), (2, "other text here"), (11, "x y x y"), (12, "a " * 5000), (13, "a a"), (None, "p q"),
            (14, "é\x1cx ü"), (15, "É\x1cx ü")]
    df = make(rows)
    assert got(spark, df) == want(rows)
    kept = minhash.keep_one(df.selectExpr("*", "1 AS _row", "2 AS row", "3 AS component"))
    assert kept.columns == [*df.columns, "_row", "row", "component"]
    expected = {(i, t) for (i, t), r in zip(rows, brute.near(rows)) if r[3]}
    assert sorted(map(repr, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(repr, expected))


def test_empty_tables(spark, make):
    assert minhash.near_duplicates(make([])).count() == 0
    assert minhash.keep_one(make([])).count() == 0
    assert got(spark, make([(1, None)])) == want([(1, None)])


def test_signatures_estimate_jaccard():
    r = np.random.default_rng(2)
    x = r.integers(0, 1 << 63, 900, dtype=np.int64).astype(np.uint64)
    a, b = minhash.signatures([np.sort(x[:800]), np.sort(x[100:])], 2000)
    assert abs((a == b).mean() - 700 / 900) < 0.04


def test_components_of_chain_star_and_random(spark):
    r = random.Random(4)
    edges = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(1, 200)]
    edges += [(r.randrange(2000, 2300), r.randrange(2000, 2300)) for _ in range(160)]
    parent = {}

    def root(v):
        while parent.setdefault(v, v) != v:
            v = parent[v]
        return v

    for a, b in edges:
        parent[root(a)] = root(b)
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    labels = {x.node: x.label for x in rows}
    assert len(rows) == len(labels)
    groups = {}
    for v in {v for a, b in edges if a != b for v in (a, b)}:
        groups.setdefault(root(v), set()).add(labels[v])
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


def test_few_links_are_contracted_in_one_task_a_step(spark, monkeypatch):
    r = random.Random(7)
    edges = [(k, k + 1) for k in range(40)] + [(r.randrange(100, 160), r.randrange(100, 160)) for _ in range(45)] + [(200, 201), (201, 200), (7, 7)]
    links = spark.createDataFrame(edges, "a long, b long")

    def found(few):
        monkeypatch.setattr(staging, "FEW_ROWS", few)
        spark.sparkContext.setJobGroup(f"links-{few}", "")
        try:
            labels = {row.node: row.label for row in components(links).collect()}
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"links-{few}")
        return {frozenset(n for n in labels if labels[n] == x) for x in labels.values()}, len(jobs)

    (few, jobs), (mixed, _), (dealt, many) = found(staging.FEW_ROWS), found(30), found(0)
    assert few == mixed == dealt and frozenset(range(41)) in few and frozenset({200, 201}) in few
    assert 3 * jobs < 2 * many
