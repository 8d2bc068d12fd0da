import random

import brute
import numpy as np
import pytest

from fairflow.llm import repeats, suffix
from fairflow.llm.common import byte_values, prefix_hashes


def got(df):
    return sorted(map(repr, ((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())))


def want(rows, length=200):
    return sorted(map(repr, brute.suffix(rows, length)))


def test_whole_table(texts, make):
    rows = [(i, t) for i, t, *_ in texts]
    assert sum(r[2] for r in brute.suffix(rows)) > 0
    assert got(suffix.remove_repeated(make(rows, 5))) == want(rows)


@pytest.mark.parametrize("length", [1, 8, 40, 200])
def test_edges(make, length):
    r = random.Random(length)
    base = "".join(r.choice("abcdé ") for _ in range(900))
    rows = [(1, base), (2, "x" + base[100:420] + "y" + base[430:700]), (3, None), (4, ""), (5, "a" * 700),
            (6, "ab" * 300), (7, base[:199]), (7, base[:201]), (None, base[300:]), (8, "ü" * 150), (9, "q" * 199),
            (10, base), (10, base)]
    assert got(suffix.remove_repeated(make(rows), length)) == want(rows, length)


def test_hot_anchors_and_small_batches(make, monkeypatch):
    monkeypatch.setattr(suffix, "HOT", 3)
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 500)
    monkeypatch.setattr(suffix, "ANCHOR_BATCH", 8)
    monkeypatch.setattr(suffix, "SPAN_BATCH_BYTES", 1500)
    monkeypatch.setattr(suffix, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(suffix, "SORT_BYTES", 500)
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    shared = " ".join(word() for _ in range(15))
    rows = [(i, " ".join([*(word() for _ in range(r.randrange(30))), shared, *(word() for _ in range(9))]))
            for i in range(30)]
    rows += [(40 + i, rows[i][1][:150] + word() + rows[i][1][150:]) for i in range(9)]
    assert got(suffix.remove_repeated(make(rows), 60)) == want(rows, 60)


def test_hot_anchors_are_sorted_and_compared_by_bytes(make, monkeypatch):
    """Where the hashes of all windows are equal, those of hot anchors still repeat only if their bytes do."""
    monkeypatch.setattr(suffix, "HOT", 3)
    monkeypatch.setattr(suffix, "range_hashes", lambda prefix, starts, ends: np.zeros(len(starts), np.uint64))
    cut = suffix._cut_windows
    monkeypatch.setattr(suffix, "_cut_windows", lambda *a: (*cut(*a)[:3], np.zeros(len(cut(*a)[3]), np.uint64)))
    r = random.Random(6)
    noise = lambda n: "".join(r.choice("abcdefgh") for _ in range(n))
    shared = noise(50)
    rows = [(i, noise(30) + shared + noise(40)) for i in range(20)] + [(30, "x" + shared + "y"), (31, "z" + shared + "y")]
    rows += [(40, rows[0][1][10:] + noise(9)), (41, rows[1][1]), (42, rows[1][1])]
    found = want(rows, 60)
    assert 0 < sum(eval(f)[2] > 0 for f in found) < 10
    assert got(suffix.remove_repeated(make(rows), 60)) == found


@pytest.mark.parametrize("again,crowded", [(0, 0), (255, 0), (255, 255)])
def test_every_width_gives_the_same_windows(make, monkeypatch, again, crowded):
    """Windows of a hot anchor are found alike whether they travel together or one by one; without a key that
    occurs again none is sent."""
    monkeypatch.setattr(suffix, "HOT", 1)
    slots = [np.full(suffix.KEY_SLOTS // 8, x, np.uint8) for x in (again, crowded)]
    monkeypatch.setattr(suffix, "hot_keys", lambda *a: slots)
    r = random.Random(7)
    noise = lambda n: "".join(r.choice("abcdé ") for _ in range(n))
    shared = noise(300)
    rows = [(i, noise(r.randrange(50)) + shared[r.randrange(90):r.randrange(210, 300)] + noise(20)) for i in range(8)]
    expected = want(rows) if again else want([(i, t) for i, t in rows], 10 ** 6)
    assert got(suffix.remove_repeated(make(rows))) == expected


def test_keys_of_hot_windows():
    """Cut windows are the windows given; equal windows at one distance have one key at every width."""
    r = np.random.default_rng(8)
    part = r.integers(0, 200, 90)
    text = np.concatenate([r.integers(0, 200, 50), part, r.integers(0, 200, 33), part, r.integers(0, 200, 50)]).astype(np.uint8)
    prefix = prefix_hashes(byte_values(2)[text])
    at, low, high = np.array([50 + 40, 50 + 90 + 33 + 40]), np.array([2, 0]), np.array([48, 40])
    for width in suffix.WIDTHS:
        x, near, far, key = suffix._cut_windows(prefix, at, low, high, width, 60, 10)
        windows = [(p, d, k) for p, a, b, k in zip(x.tolist(), near.tolist(), far.tolist(), key.tolist()) for d in range(a, b + 1)]
        assert [(p, d) for p, d, _ in windows] == [(p, d) for p, a, b in zip(at, low, high) for d in range(a, b + 1)]
        keys = [{d: k for p, d, k in windows if p == q} for q in at]
        equal = [d for d in keys[0].keys() & keys[1].keys() if d <= 40 and d >= 10]
        assert equal and all(keys[0][d] == keys[1][d] for d in equal)
        assert width > 1 or keys[0][5] != keys[1][5]


def test_sort_with_hash_collisions():
    """Where every hash is equal, the byte checks still give the right result."""
    r = np.random.default_rng(3)
    text = r.integers(0, 2, 400).astype(np.uint8)
    starts = np.arange(380)
    true = {}
    for s in starts:
        true.setdefault(text[s:s + 9].tobytes(), []).append(s)
    expected = [len(true[text[s:s + 9].tobytes()]) > 1 for s in starts]
    for prefix in (prefix_hashes(byte_values(3)[text]), np.zeros(401, np.uint64)):
        found = suffix.repeated_suffixes(text, prefix, starts, np.zeros(380, np.int64), 9)
        assert found.tolist() == expected


def test_merge_sort_orders_suffixes():
    r = np.random.default_rng(4)
    text = r.integers(97, 99, 300).astype(np.uint8)
    prefix = prefix_hashes(byte_values(3)[text])
    starts, begin = r.permutation(280), np.array([0, 1, 8, 108])
    out = suffix.merge_sort(text, prefix, starts, begin, 20)
    for a, b in zip(begin, [1, 8, 108, 280]):
        keys = [text[s:s + 20].tobytes() for s in out[a:b]]
        assert keys == sorted(keys) and sorted(out[a:b]) == sorted(starts[a:b])


def test_empty_table_and_extra_columns(make):
    assert suffix.remove_repeated(make([])).count() == 0
    df = make([(1, "ab" * 200)]).selectExpr("*", "1 AS marks", "2 AS _row", "3 AS hot", "4 AS bucket")
    assert got(suffix.remove_repeated(df)) == want([(1, "ab" * 200)])
