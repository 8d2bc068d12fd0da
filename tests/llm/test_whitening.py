import math
from fractions import Fraction

import brute
import numpy as np
import pytest

from fairflow.llm import whitening


def table(spark, rows, kind="array<double>", parts=3):
    return spark.createDataFrame(rows, f"vec_id long, embedding {kind}").repartition(parts)


def got(df, **options):
    out = {}
    for r in whitening.whiten(df, **options).collect():
        out.setdefault((r.vec_id, r.component), []).append(r)
    return out


def same(spark, rows, kind="array<double>", **options):
    """The operator against the brute-force version, component signs aside."""
    have, want = got(table(spark, rows, kind), **options), brute.whitening(rows, **options)
    assert {k: len(v) for k, v in have.items()} == {k: len(v) for k, v in want.items()}
    flip = {}
    for key, many in want.items():
        for r in have[key]:
            w = min(many, key=lambda m: abs(m["deviation"] - (r.deviation or 0)))
            assert (r.n, r.deviation) == (w["n"], w["deviation"])
            assert math.isclose(r.explained, w["explained"], rel_tol=1e-9)
            assert r.identity_error < 1e-9
            if abs(w["whitened"]) > 1e-6:
                sign = flip.setdefault(r.component, 1 if r.whitened * w["whitened"] > 0 else -1)
                assert math.isclose(sign * r.whitened, w["whitened"], rel_tol=1e-6)


def random_rows(seed, n, d, copies=1):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, d)) * np.linspace(0.2, 1.5, d)
    return [(k, x[k % n].tolist()) for k in range(n * copies)]


@pytest.mark.parametrize("weights", ["one", "count"])
def test_against_brute_force(spark, weights):
    rows = random_rows(1, 60, 7) + [(100 + k, [0.5] * 7) for k in range(40)] + random_rows(1, 20, 7)
    same(spark, rows, weights=weights)


def test_given_table(spark, sf_dir):
    import pyarrow.parquet as pq
    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"{sf_dir}/embeddings.parquet").to_pylist()]
    same(spark, rows, "array<float>")


def test_one_vector_holds_a_third_of_the_rows(spark, monkeypatch):
    rows = random_rows(2, 200, 5) + [(k, [0.25, 0.5, -1.0, 0.0, 2.0]) for k in range(100)]
    same(spark, rows)
    monkeypatch.setattr(whitening, "HOT_SHARE", 1)  # nothing is hot
    same(spark, rows)


def test_edges(spark):
    whole = random_rows(3, 12, 3)
    rows = whole + [(50, None), (51, [1.0, None, 2.0]), (52, [math.nan, 0.0, 0.0]), (53, [math.inf, 0.0, 0.0]),
                    (54, []), (55, [1.0]), (None, whole[0][1]), (0, whole[0][1]), (0, whole[0][1]), (56, [-0.0, 0.0, -0.0])]
    same(spark, rows)
    clash = table(spark, rows).selectExpr("vec_id", "embedding", "1 AS x", "2 AS copies", "3 AS component", "4 AS _id")
    assert whitening.whiten(clash).count() == 3 * (len(rows) - 6)


def test_without_variance_and_empty(spark):
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, None), (2, [])])).count() == 0
    one = whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, None, None)] * 4
    line = whitening.whiten(table(spark, [(k, [float(k), 0.0]) for k in range(5)])).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in line) and len(line) == 10


def test_deviations_are_exact_to_the_end_of_64_bits():
    x = np.array([[3037000499, 0], [3037000500, 0], [1 << 62, 5], [7, -9]], np.int64)
    assert whitening._deviations(x, 1, [0, 0]) == [3037000499 ** 2, None, None, 130]
    assert whitening._deviations(x[3:], 3, [1, 2]) == [int((3 * 7 - 1) ** 2 + (3 * -9 - 2) ** 2)]
    assert Fraction(130) == sum(Fraction(v) ** 2 for v in (7, -9))


def test_huge_entries_are_summed_exactly(spark):
    rows = [(k, [1e30, float(k)]) for k in range(4)]
    out = got(table(spark, rows))
    assert all(r.n == 4 for many in out.values() for r in many)


def test_result_does_not_depend_on_partitions(spark):
    rows = random_rows(4, 50, 4, copies=2)
    a, b = (sorted((r.vec_id, r.component, r.deviation, round(r.whitened, 9)) for r in whitening.whiten(
        table(spark, rows, parts=p)).collect()) for p in (1, 9))
    assert a == b
