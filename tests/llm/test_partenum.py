import random

import brute
import numpy as np
import pytest

from fairflow.llm import families, partenum

LINE = "all rights reserved by the holders of this text and no part of it may be copied without leave"


def got(df, **options):
    return sorted(map(repr, map(tuple, partenum.jaccard_groups(df, **options).collect())))


def want(rows, **options):
    return sorted(repr(r[:3]) for r in brute.near(rows, **{"percent": 85, "n": 4, **options}))


def family(seed, n, words=80, most=5):
    """Mutated copies whose similarity lies on both sides of the threshold."""
    r = random.Random(seed)
    base = [f"w{seed}x{r.randrange(10 ** 6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(r.randrange(most)):
            copy[r.randrange(words)] = f"m{r.randrange(60)}"
        if r.random() < 0.3:
            copy = copy[r.randrange(6):]
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("percent", [60, 85, 90])
def test_linked_sets_share_a_signature(percent):
    """Every pair at or above the threshold, sizes from one to some thousand, near the bound above all."""
    r = np.random.default_rng(percent)
    for size in [1, 2, 3, 5, 6, 7, 8, 9, 11, 12, 13, 20, 33, 60, 150, 400, 3000]:
        pairs = []
        for _ in range(40 if size < 1000 else 4):
            whole = np.unique(r.integers(0, 1 << 63, 2 * size, dtype=np.int64)).astype(np.uint64)
            r.shuffle(whole)
            a = whole[:size]
            gone = int(r.integers(0, size))
            b = np.concatenate([a[gone:], whole[size:size + int(r.integers(0, max(1, size - gone + 1)))]]) if r.random() < 0.5 and size < 1000 else None
            if b is None:  # as far apart as a link allows
                while 100 * (size - gone) < percent * (size + gone):
                    gone -= 1
                b = np.concatenate([a[gone:], whole[size:size + gone]])
            both = len(np.intersect1d(a, b))
            if len(b) and 100 * both >= percent * (len(a) + len(b) - both):
                pairs.append((np.sort(a), np.sort(b)))
        assert pairs
        signed, owner = partenum.signatures([s for p in pairs for s in p], percent)
        for k in range(len(pairs)):
            assert len(np.intersect1d(signed[owner == 2 * k], signed[owner == 2 * k + 1])), size


def test_unrelated_sets_share_none():
    r = np.random.default_rng(0)
    sets = [np.unique(r.integers(0, 1 << 63, n, dtype=np.int64).astype(np.uint64)) for n in (40, 41, 250, 255, 1000, 1010)]
    signed, owner = partenum.signatures(sets)
    assert len(np.unique(signed)) == len(signed)
    assert len(signed) < sum(map(len, sets))


def test_bands_and_differences():
    ends = partenum.band_ends(85)
    assert ends[:8].tolist() == [1, 2, 3, 4, 5, 7, 9, 11]
    for size in range(1, 3000):  # the largest partner lies in the same band or the next
        band = np.searchsorted(ends, size)
        assert np.searchsorted(ends, 100 * size // 85) <= band + 1
    assert partenum.differences(np.array([1, 6, 7, 100]), 85).tolist() == [0, 0, 1, 16]


def test_whole_table(spark, texts, make):
    rows = [(i, t) for i, t, *_ in texts]
    assert len({r[2] for r in brute.near(rows, percent=85, n=4)}) < len(rows)
    assert got(make(rows, 5)) == want(rows)


@pytest.mark.parametrize("block", [100, 1 << 18])
def test_families_around_the_threshold(spark, make, monkeypatch, block):
    monkeypatch.setattr(families, "BLOCK_SHINGLES", block)
    rows = [(200 - k, t) for k, t in enumerate(family(1, 50) + family(2, 30, 40) + family(3, 3) + family(4, 40, 200, 20))]
    assert got(make(rows)) == want(rows)


def test_many_buckets_and_batches(spark, make, monkeypatch):
    monkeypatch.setattr(partenum, "BUCKET", 50)
    rows = [(k, t) for k, t in enumerate(family(5, 30) + family(6, 20, 30))] + [(300 + k, LINE) for k in range(40)]
    assert got(make(rows, 7)) == want(rows)


def test_templates_chained_by_shared_passages(spark, make):
    """Texts that share long passages with their neighbours but do not link, among some that do."""
    r = random.Random(8)
    parts = [" ".join(f"p{k}w{j}" for j in range(30)) for k in range(40)]
    rows = [(k, f"{parts[k]} {parts[k + 1]}") for k in range(39)]
    rows += [(100 + k, f"{LINE} {LINE} extra{r.randrange(5)} {LINE[:40]} tail{k}") for k in range(30)]
    rows += [(200, f"{parts[3]} {parts[4]} z"), (201, f"y {parts[3]} {parts[4]} z")]
    assert got(make(rows)) == want(rows)


def test_edges(spark, make):
    text = " ".join(f"a{k}" for k in range(50))
    rows = [(5, text), (3, text.upper()), (None, text + " z"), (None, "only"), (7, None), (8, ""), (9, " \t"), (1, "Only"),
            (2, "x y"), (2, "x y"), (2, "other text here"), (11, "x y x y"), (12, "a " * 5000), (13, "a a a a"), (None, "p q"),
            (14, "é\x1cx ü q r"), (15, "É\x1cx ü q r"), (16, "one two three"), (17, "one two three four"), (None, "p q")]
    df = make(rows)
    assert got(df) == want(rows)
    clash = df.selectExpr("*", "1 AS _row", "2 AS n", "3 AS component_id", "4 AS _id", "5 AS node", "6 AS d1")
    assert got(clash) == want(rows)


def test_repeated_rows_and_copies(spark, make):
    rows = [(1, LINE)] * 60 + [(k, LINE) for k in range(2, 40)] + [(90 + k, f"{LINE} {k}") for k in range(5)] + [(80, "another text of its own")]
    assert got(make(rows, 9)) == want(rows)


def test_text_ids_and_empty_tables(spark, make):
    assert partenum.jaccard_groups(make([])).count() == 0
    assert got(make([(1, None)])) == want([(1, None)])
    df = make([(1, LINE), (2, LINE + " x"), (3, "quite another text here"), (None, LINE)]).selectExpr("concat('k', doc_id) AS doc_id", "text")
    out = sorted(map(repr, map(tuple, partenum.jaccard_groups(df).collect())))
    assert out == sorted(map(repr, [("k1", 16, "k1"), ("k2", 17, "k1"), ("k3", 1, "k3"), (None, 16, "k1")]))


def test_result_does_not_depend_on_partitions(spark, make):
    rows = [(k, t) for k, t in enumerate(family(7, 25))]
    assert got(make(rows, 1)) == got(make(rows, 11))


@pytest.mark.parametrize("percent", [80, 85])
def test_sketches_never_exclude_a_link(percent):
    """Sketches differ in no more slots than the sets in shingles; most pairs below the threshold are excluded."""
    r = np.random.default_rng(percent)
    excluded = []
    for _ in range(600):
        size = int(r.choice([3, 8, 20, 60, 250, 1200]))
        whole = np.unique(r.integers(0, 1 << 63, 3 * size, dtype=np.int64)).astype(np.uint64)
        r.shuffle(whole)
        gone, more = int(r.integers(0, size // 3 + 1)), int(r.integers(0, size // 3 + 1))
        a, b = whole[:size], np.concatenate([whole[gone:size], whole[size:size + more]])
        x, y = families.sketch(a, percent), families.sketch(b, percent)
        slots = min(len(x), len(y))
        differ = np.count_nonzero(families.folded(x, slots) != families.folded(y, slots))
        assert differ <= gone + more
        both = size - gone
        if 100 * both < (percent - 8) * (size + more) and size >= 60:
            excluded.append(differ > families.allowed(len(a) + len(b), percent))
    assert len(excluded) > 50 and np.mean(excluded) > 0.95


def test_signatures_go_once_they_have_met(spark, make):
    """Packed signatures, the most of what is staged, are deleted before the texts of candidates move."""
    from fairflow.session import staging_scope

    words = " ".join(f"w{i}" for i in range(60))
    with staging_scope(spark) as scope:
        rows = partenum.jaccard_groups(make([(1, words), (2, words + " x"), (3, words), (4, "a b"), (4, "a b")])).collect()
        columns = [set(spark.read.parquet(p).columns) for p in scope.paths]
    assert sorted((r.doc_id, r.component_id) for r in rows) == [(1, 1), (2, 1), (3, 1), (4, 4), (4, 4)]
    assert columns and not any("owners" in c for c in columns)
