"""Learning a randomised mapping that evens out the rates of favourable labels between groups.

The rows are reduced to counted cells, one per combination of group, features and label.  For each cell a distribution
over new features and labels is sought that stays as close as possible to changing nothing, such that

* every group's rate of favourable labels comes within ``epsilon`` (relative) of the common rate, and
* no cell's expected distortion, what its rows are changed by on average, exceeds ``max_distortion``.

Closeness is the relative entropy to a prior that falls off exponentially with the distortion.  That makes the problem
convex, and its solution tilts the prior by one number per group, for the rate, and one per cell, for the
distortion: multiplicative updates, each found by bisection.  `fairness.apply_random_mapping` applies the result.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

MAX_CELLS = 512
STEPS = 50
_LEAST = 1e-9

Distortion = Callable[[Mapping[str, object], Mapping[str, object]], float]


def changed_columns(old: Mapping[str, object], new: Mapping[str, object]) -> float:
    """How many columns differ, the label being one of them."""
    return float(sum(old[c] != new[c] for c in old))


def counted_cells(df: DataFrame, group: str, columns: Sequence[str], label: str, weight: str | None = None) -> DataFrame:
    """Rows (or their weight) ``n`` of every combination that occurs, from one aggregate; rows without a label count nowhere."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.filter(F.col(label).isNotNull()).groupBy(group, *columns, label).agg(n.alias("n"))


def _tilted(prior: np.ndarray, cost: np.ndarray, favourable: np.ndarray, lift: np.ndarray, most: float) -> np.ndarray:
    """The distribution of each cell for the lift of its group, the distortion kept within its bound."""
    logs = np.log(prior) + lift[:, None] * favourable

    def at(press: np.ndarray) -> np.ndarray:
        shifted = logs - press[:, None] * cost
        out = np.exp(shifted - shifted.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)

    low, high = np.zeros(len(cost)), np.zeros(len(cost))
    over = (at(high) * cost).sum(axis=1) > most
    if over.any():
        high[over] = 1.0
        while ((at(high) * cost).sum(axis=1) > most).any():
            high[(at(high) * cost).sum(axis=1) > most] *= 2
        for _ in range(STEPS):
            middle = (low + high) / 2
            much = (at(middle) * cost).sum(axis=1) > most
            low, high = np.where(much, middle, low), np.where(much, high, middle)
    return at(high)


def fit_mapping(cells: Sequence[Mapping[str, object]], group: str, columns: Sequence[str], label: str, pos_label=1,
                epsilon: float = 0.05, max_distortion: float = 0.5, temperature: float = 0.2,
                distortion: Distortion = changed_columns) -> tuple[list[dict], np.ndarray]:
    """The targets and, per cell, their probabilities; what `learn_mapping` does with the counted cells."""
    varied = [*columns, label]
    labels = list(dict.fromkeys(c[label] for c in cells))
    if len(labels) != 2 or pos_label not in labels:
        raise ValueError(f"expected two labels, one of them {pos_label!r}, got {labels}")
    features = dict.fromkeys(tuple(c[x] for x in columns) for c in cells)
    targets = [dict(zip(varied, (*f, y))) for f in features for y in labels]
    cost = np.array([[distortion({x: c[x] for x in varied}, t) for t in targets] for c in cells], float)
    if (cost.min(axis=1) > max_distortion).any():
        raise ValueError("some cell has no target within the distortion allowed")
    prior = np.exp(-cost / temperature)
    prior /= prior.sum(axis=1, keepdims=True)
    favourable = np.array([t[label] == pos_label for t in targets], float)
    n = np.array([float(c["n"]) for c in cells])
    common = n[[c[label] == pos_label for c in cells]].sum() / n.sum()
    out = np.zeros_like(cost)
    for value in dict.fromkeys(c[group] for c in cells):
        own = np.array([c[group] == value for c in cells])
        share = n[own] / n[own].sum()

        def rate(lift: float) -> tuple[float, np.ndarray]:
            found = _tilted(prior[own], cost[own], favourable, np.full(int(own.sum()), lift), max_distortion)
            return float(share @ found @ favourable), found

        start, found = rate(0.0)
        wanted = min(max(start, (1 - epsilon) * common), (1 + epsilon) * common)
        if abs(wanted - start) > 1e-12:
            side = 1.0 if wanted > start else -1.0
            low, high = 0.0, 1.0
            while (rate(side * high)[0] - wanted) * side < 0:
                high *= 2
                if high > 1 << 12:
                    raise ValueError(f"group {value!r} cannot reach the common rate within the distortion allowed")
            for _ in range(STEPS):
                middle = (low + high) / 2
                low, high = (middle, high) if (rate(side * middle)[0] - wanted) * side < 0 else (low, middle)
            found = rate(side * high)[1]
        out[own] = found
    out[out < _LEAST] = 0
    return targets, out / out.sum(axis=1, keepdims=True)


def learn_mapping(df: DataFrame, group: str, columns: Sequence[str], label: str, weight: str | None = None, pos_label=1,
                  epsilon: float = 0.05, max_distortion: float = 0.5, temperature: float = 0.2,
                  distortion: Distortion = changed_columns, max_cells: int = MAX_CELLS) -> DataFrame:
    """``group, columns, label``, ``new_<column>``, ``new_<label>`` and ``prob`` for every cell and target.

    Columns must be discrete: only the counted cells, ``max_cells`` at most, come to the driver, however many rows there
    are; more are an error, not cut off.
    """
    counted = counted_cells(df, group, columns, label, weight)
    cells = [r.asDict() for r in counted.limit(max_cells + 1).collect()]
    if len(cells) > max_cells:
        raise ValueError(f"more than {max_cells} combinations of {[group, *columns, label]}: use coarser columns")
    cells.sort(key=repr)
    kinds = {f.name: f.dataType for f in counted.schema}
    varied = [*columns, label]
    schema = T.StructType([T.StructField(c, kinds[c]) for c in [group, *varied]] + [
        T.StructField(f"new_{c}", kinds[c]) for c in varied] + [T.StructField("prob", T.DoubleType())])
    if not cells:
        return df.sparkSession.createDataFrame([], schema)
    targets, chances = fit_mapping(cells, group, columns, label, pos_label, epsilon, max_distortion, temperature, distortion)
    rows = [(*[c[x] for x in (group, *varied)], *[t[x] for x in varied], float(p))
            for c, of_cell in zip(cells, chances) for t, p in zip(targets, of_cell) if p > 0]
    return df.sparkSession.createDataFrame(rows, schema)
