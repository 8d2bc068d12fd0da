"""Learning a randomised mapping."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fairflow.operators import fairness, mapping

CELLS = [{"g": g, "x": x, "y": y, "n": n} for g, x, y, n in [
    ("a", 0, 0, 40), ("a", 0, 1, 10), ("a", 1, 0, 30), ("a", 1, 1, 20), ("b", 0, 0, 10), ("b", 0, 1, 40), ("b", 1, 0, 15), ("b", 1, 1, 35)]]


def rates(cells, targets, chances):
    out = {}
    for g in ("a", "b"):
        own = [k for k, c in enumerate(cells) if c["g"] == g]
        n = np.array([cells[k]["n"] for k in own], float)
        out[g] = float(n / n.sum() @ chances[own] @ np.array([t["y"] == 1 for t in targets], float))
    return out


@pytest.mark.parametrize("epsilon", [0.0, 0.05, 0.5])
def test_rates_meet_and_distortion_is_bounded(epsilon):
    targets, chances = mapping.fit_mapping(CELLS, "g", ["x"], "y", epsilon=epsilon, max_distortion=0.6)
    assert np.allclose(chances.sum(axis=1), 1) and (chances >= 0).all()
    common = sum(c["n"] for c in CELLS if c["y"]) / sum(c["n"] for c in CELLS)
    for rate in rates(CELLS, targets, chances).values():
        assert (1 - epsilon) * common - 1e-6 <= rate <= (1 + epsilon) * common + 1e-6
    for c, row in zip(CELLS, chances):
        assert sum(p * mapping.changed_columns({k: c[k] for k in "xy"}, t) for t, p in zip(targets, row)) <= 0.6 + 1e-6


def test_it_is_the_closest_such_mapping():
    """No feasible mapping nearby has less relative entropy to the prior."""
    targets, chances = mapping.fit_mapping(CELLS, "g", ["x"], "y", epsilon=0.05, max_distortion=0.6, temperature=0.5)
    cost = np.array([[mapping.changed_columns({k: c[k] for k in "xy"}, t) for t in targets] for c in CELLS])
    prior = np.exp(-cost / 0.5)
    prior /= prior.sum(axis=1, keepdims=True)
    n = np.array([c["n"] for c in CELLS], float)

    def away(q):
        return float((n[:, None] * np.where(q > 0, q * np.log(np.maximum(q, 1e-300) / prior), 0)).sum())

    before, least = rates(CELLS, targets, chances), away(chances)
    rng = np.random.default_rng(0)
    tried = 0
    for _ in range(20000):
        other = chances + rng.normal(0, 0.01, chances.shape) * rng.integers(0, 2, chances.shape)
        other = np.clip(other, 1e-12, None)
        other /= other.sum(axis=1, keepdims=True)
        r = rates(CELLS, targets, other)
        if (other * cost).sum(axis=1).max() <= 0.6 and abs(r["a"] - 0.5) <= abs(before["a"] - 0.5) and abs(r["b"] - 0.5) <= abs(before["b"] - 0.5):
            tried += 1
            assert away(other) >= least - 1e-6
    assert tried > 20


def test_nothing_changes_where_rates_agree():
    fair = [{"g": g, "x": 0, "y": y, "n": 50} for g in "ab" for y in (0, 1)]
    targets, chances = mapping.fit_mapping(fair, "g", ["x"], "y", temperature=0.05)
    assert all(chances[k][targets.index({"x": 0, "y": c["y"]})] > 0.999 for k, c in enumerate(fair))


def test_what_cannot_be_met_is_said():
    with pytest.raises(ValueError, match="cannot reach"):
        mapping.fit_mapping(CELLS, "g", ["x"], "y", max_distortion=0.05, temperature=0.01)
    with pytest.raises(ValueError, match="two labels"):
        mapping.fit_mapping(CELLS[::2], "g", ["x"], "y")


def test_learned_and_applied(spark):
    rows = [(g, None if x else "p", y) for g, x, y, n in [tuple(c.values()) for c in CELLS] for _ in range(20 * n)]
    df = spark.createDataFrame(rows, "g string, x string, y int").withColumn("id", F.monotonically_increasing_id())
    train, rest = df.filter("id % 3 > 0"), df.filter("id % 3 = 0")
    learned = mapping.learn_mapping(train, "g", ["x"], "y", max_distortion=0.6)
    assert learned.groupBy("g", "x", "y").agg(F.sum("prob").alias("p")).filter("abs(p - 1) > 1e-9").count() == 0
    moved = fairness.apply_random_mapping(rest, learned, ["g", "x", "y"], ["x", "y"], ["id"])
    gap = lambda d: fairness.disparate_impact(d, "g", "b", "y").first()["disparate_impact_gap"]
    assert gap(rest) > 0.5 and gap(moved) < 0.25 and moved.count() == rest.count()


def test_cells_are_bounded_and_empty_tables(spark):
    df = spark.range(100).select(F.lit("a").alias("g"), F.col("id").alias("x"), (F.col("id") % 2).alias("y"))
    with pytest.raises(ValueError, match="coarser"):
        mapping.learn_mapping(df, "g", ["x"], "y", max_cells=99)
    assert mapping.learn_mapping(df.filter("x < 0"), "g", ["x"], "y").count() == 0
