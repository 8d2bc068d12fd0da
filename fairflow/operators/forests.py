"""Random forests of two classes, grown level by level from packed bins.

Spark's own fit keeps one number a row and tree beside objects of the bins, and walks every row through every tree by
boxed lookups.  Here a row is two bytes a feature; its draws are made again in each pass from a seed, and counts are
numpy histograms of one tree at a time.  The model is Spark's own.
"""

from __future__ import annotations

import json
import math
import pickle
import time
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier as SparkForest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import reused, scratch_path, ship_package

# Rows of a block, and rows that a task of a pass has at most, about.
BLOCK_ROWS, TASK_ROWS = 1 << 16, 1 << 22
# Values that the candidate thresholds of a feature are taken from: as many as Spark's own fit draws.
FEWEST_DRAWN = 10_000
MOST_BINS = 1 << 14
NODE = pa.schema([("treeID", pa.int32()), ("nodeData", pa.struct([
    ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
    ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
    ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])),
]))])


class RandomForestClassifier(SparkForest):
    """Spark's estimator, with a fit of its own for two classes and rows of equal weight.

    What that fit does not do, other classes, weights and depths whose histograms pass `maxMemoryInMB`, is left to Spark's, and so is
    input that Spark refuses.  The same rules hold: Poisson draws a row and tree, features drawn per node, thresholds
    between sampled quantiles, categories in order of their share of the second class, equal sibling leaves merged.  The model
    has no training summary.
    """

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        arity = _arities(dataset, self.getFeaturesCol())
        strategy = _subset_size(self.getFeatureSubsetStrategy(), self.getNumTrees(), 1)
        plain = not (self.isDefined(self.weightCol) and self.getWeightCol()) and self.getMinWeightFractionPerNode() == 0
        if arity is None or strategy is None or not plain or not 1 <= self.getMaxDepth() <= 30 or self.getMaxBins() > MOST_BINS:
            return super()._fit(dataset)
        ship_package(dataset.sparkSession)
        rows = dataset.select(F.col(self.getLabelCol()).cast("double").alias("label"), vector_to_array(self.getFeaturesCol()).alias("x"))
        cuts = _candidates(rows, arity, self.getMaxBins(), self.getSeed())
        if cuts is None:
            return super()._fit(dataset)
        bins = [arity.get(f, len(cuts[f]) + 1) for f in range(len(cuts))]
        width = _subset_size(self.getFeatureSubsetStrategy(), self.getNumTrees(), len(bins))
        if max(bins) > self.getMaxBins() or (8 << self.getMaxDepth() - 1) * width * max(bins) > self.getMaxMemoryInMB() << 20:
            return super()._fit(dataset)
        with reused(rows.mapInArrow(_packer(cuts, arity), "part int, place int, rows int, bins binary")) as blocks:
            trees = _grow(blocks, bins, arity, width, self)
        return self._copyValues(_as_model(self, trees, cuts, arity, dataset.sparkSession))


def _arities(df: DataFrame, col: str) -> dict[int, int] | None:
    """Number of values of every categorical feature, as the vector's column describes them; None where it does not say."""
    attrs = df.schema[col].metadata.get("ml_attr", {}).get("attrs", {})
    out = {a["idx"]: 2 for a in attrs.get("binary", [])}
    for a in attrs.get("nominal", []):
        out[a["idx"]] = len(a["vals"]) if "vals" in a else a.get("num_vals", 0)
    return None if any(n < 1 for n in out.values()) else out


def _subset_size(strategy: str, trees: int, features: int) -> int | None:
    """Features drawn for a node."""
    strategy = strategy.lower()
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt"
    named = {"all": features, "sqrt": math.ceil(math.sqrt(features)), "onethird": math.ceil(features / 3),
             "log2": max(1, math.ceil(math.log2(features)))}
    if strategy in named:
        return named[strategy]
    try:
        share = float(strategy)
    except ValueError:
        return None
    if strategy.isdigit() and share >= 1:
        return min(int(strategy), features)
    return math.ceil(share * features) if 0 < share <= 1 else None


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray] | None:
    """Labels and values, a row per feature; None if the vectors differ in length, or anything is NULL."""
    label, lists = batch.column(0), batch.column(1)
    n, values = len(lists), lists.flatten()
    lengths = np.diff(lists.offsets.to_numpy())
    if label.null_count or lists.null_count or values.null_count or lengths.min() != lengths.max() or not lengths[0]:
        return None
    return label.to_numpy(zero_copy_only=False), values.to_numpy(zero_copy_only=False).reshape(n, -1).T


def _sampler(share: float, arity: dict[int, int], seed: int) -> Callable:
    """Per task the sampled values of every continuous feature, and at -1 whether the rows are not for us, by their number of features."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = np.random.default_rng([seed & (1 << 64) - 1, TaskContext.get().partitionId()])
        sizes, drawn, odd = set(), {}, False
        for batch in (b for b in batches if b.num_rows):
            if (found := _columns(batch)) is None:
                odd = True
                continue
            label, x = found
            sizes.add(len(x))
            odd |= not np.isin(label, (0.0, 1.0)).all() or not np.isfinite(x).all() or any(
                f >= len(x) or not np.isin(x[f], np.arange(n)).all() for f, n in arity.items())
            chosen = slice(None) if share >= 1 else draw.random(x.shape[1]) < share
            for f in set(range(len(x))) - set(arity):
                drawn.setdefault(f, []).append(x[f][chosen])
        out = [(f, np.concatenate(parts).tobytes()) for f, parts in drawn.items()]
        out += [(-1, pickle.dumps((n, odd))) for n in sizes or ({0} if odd else ())]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in out], pa.int32()), pa.array([v for _, v in out], pa.binary())], ["f", "v"])

    return sample


def cut_points(values: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` thresholds between distinct values: all midpoints, or those that split the values into parts of equal number."""
    found, times = np.unique(values, return_counts=True)
    middle = found[:-1] + (found[1:] - found[:-1]) / 2
    if len(middle) <= most:
        return middle
    stride, upto = len(values) / (most + 1), np.cumsum(times).tolist()
    cuts, target = [], stride
    for k in range(1, len(upto)):
        if abs(upto[k - 1] - target) < abs(upto[k] - target):
            cuts.append(middle[k - 1])
            target += stride
    return np.array(cuts)


def _candidates(rows: DataFrame, arity: dict[int, int], max_bins: int, seed: int) -> list[np.ndarray] | None:
    """Thresholds of every continuous feature, none for a categorical one; None if rows are missing, or odd."""
    n = rows.count()
    if not n:
        return None

    def cut(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, parts = key[0].as_py(), [v.as_py() for batch in batches for v in batch.column("v")]
        if f >= 0:
            parts = [cut_points(np.concatenate([np.frombuffer(p) for p in parts]), min(max_bins, n) - 1).tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([f] * len(parts), pa.int32()), pa.array(parts, pa.binary())], ["f", "v"])

    sample = _sampler(max(max_bins ** 2, FEWEST_DRAWN) / n, arity, seed)
    found = rows.mapInArrow(sample, "f int, v binary").groupBy("f").applyInArrow(cut, "f int, v binary").collect()
    about = {pickle.loads(r["v"]) for r in found if r["f"] < 0}
    if len(about) != 1 or (features := next(iter(about)))[1]:
        return None
    cuts = {r["f"]: np.frombuffer(r["v"]) for r in found if r["f"] >= 0}
    return [cuts.get(f, np.empty(0)) for f in range(features[0])]


def _packer(cuts: Sequence[np.ndarray], arity: dict[int, int]) -> Callable:
    """Blocks of rows: per feature twice the bin plus the label.  Sorted, so that a partition computed again is the same."""

    def packed(parts: list[np.ndarray], place: int) -> pa.RecordBatch:
        block = np.concatenate(parts, axis=1)
        mixed = np.zeros(block.shape[1], dtype="uint64")
        for column in block:
            mixed = (mixed ^ column) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        block = np.ascontiguousarray(block[:, np.argsort(mixed, kind="stable")])
        return pa.RecordBatch.from_pydict({
            "part": pa.array([TaskContext.get().partitionId()], pa.int32()), "place": pa.array([place], pa.int32()),
            "rows": pa.array([block.shape[1]], pa.int32()), "bins": pa.array([block.tobytes()], pa.binary())})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, place = [], 0, 0
        for batch in (b for b in batches if b.num_rows):
            label, x = _columns(batch)
            # A value at its threshold goes left.
            part = np.stack([v if f in arity else np.searchsorted(cuts[f], v) for f, v in enumerate(x)])
            parts.append((part.astype("uint16") << 1) | label.astype("uint16"))
            held += len(label)
            if held >= BLOCK_ROWS:
                yield packed(parts, place)
                parts, held, place = [], 0, place + 1
        if parts:
            yield packed(parts, place)

    return pack


class Split(NamedTuple):
    """A node as it was counted: rows of both classes, its best split, and the rows that go left.

    ``left`` is the last bin on the left, or the categories there."""
    counts: tuple[int, int]
    feature: int
    left: int | tuple[int, ...]
    gain: float
    left_counts: tuple[int, int]


def _impurity(kind: str, zeros, ones):
    """Gini or entropy of counts of two classes; nothing where there are no rows."""
    n = np.maximum(zeros + ones, 1)
    p, q = zeros / n, ones / n
    if kind == "gini":
        return np.where(zeros + ones > 0, 1 - p * p - q * q, 0.0)
    return -(p * np.log2(np.where(p > 0, p, 1)) + q * np.log2(np.where(q > 0, q, 1)))


def best_split(counts: np.ndarray, offered: Sequence[int], bins: Sequence[int], categorical, impurity: str, min_rows: int, min_gain: float) -> Split:
    """The best of the splits of one node; feature -1 if there is none.  ``counts``: per offered feature and bin, rows of both classes."""
    best, at, total = None, 0, None
    for f in offered:
        cells = counts[at:at + 2 * bins[f]].reshape(-1, 2).astype("float64")
        at += 2 * bins[f]
        total = cells.sum(axis=0) if total is None else total
        order = None
        if f in categorical:
            n = cells.sum(axis=1)
            order = np.argsort(np.where(n > 0, cells[:, 1] / np.maximum(n, 1), 2.0), kind="stable")
            cells = cells[order]
        left = np.cumsum(cells, axis=0)[:-1]
        if not len(left):
            continue
        right = total - left
        ln, rn, n = left.sum(axis=1), right.sum(axis=1), max(total.sum(), 1)
        gain = _impurity(impurity, *total) - ln / n * _impurity(impurity, left[:, 0], left[:, 1]) - rn / n * _impurity(impurity, right[:, 0], right[:, 1])
        gain = np.where((ln >= min_rows) & (rn >= min_rows) & (gain >= min_gain), gain, 0.0)
        k = int(np.argmax(gain))
        if gain[k] > (best.gain if best else 0):
            side = k if order is None else tuple(sorted(int(c) for c in order[:k + 1]))
            best = Split((int(total[0]), int(total[1])), f, side, float(gain[k]), (int(left[k, 0]), int(left[k, 1])))
    return best or Split((int(total[0]), int(total[1])), -1, 0, 0.0, (0, 0))


def draw_table(rate: float, replace: bool) -> np.ndarray | None:
    """How often a row is drawn, by 16 random bits: Poisson with that mean, or once with that chance.  None: once each."""
    if not replace:
        return None if rate >= 1 else (np.arange(1 << 16) < rate * (1 << 16)).astype("uint8")
    chance, upto, k, out = math.exp(-rate), 0.0, 0, np.zeros(1 << 16, dtype="uint8")
    while round(upto * (1 << 16)) < 1 << 16 and k < 64:
        out[round(upto * (1 << 16)):] = k
        upto, k = upto + chance, k + 1
        chance *= rate / k
    return out


def _drawn(table: np.ndarray | None, rows: int, *seed: int) -> np.ndarray:
    """The rows of a block that a tree grows on, as often as drawn."""
    if table is None:
        return np.arange(rows)
    bits = np.random.SFC64(list(seed)).random_raw(-(-rows // 4)).view("uint16")[:rows]
    times = table.take(bits)
    held, out = np.flatnonzero(times > 0), []
    times = times.take(held)
    while len(held):
        out.append(held)
        more = times > len(out)
        held, times = held.compress(more), times.compress(more)
    return np.concatenate(out) if out else held


def _counter(splits: Sequence[dict[int, Split]], offered: Sequence[dict[int, list[int]]], bins: Sequence[int], categorical,
             table: np.ndarray | None, seed: int) -> Callable:
    """Per task and tree the counts of the nodes in ``offered``, one tree after the other."""

    def count_tree(tree: int, blocks: list[tuple]) -> np.ndarray:
        nodes, places, total = splits[tree], {}, 0
        for node in sorted(offered[tree]):
            places[node] = total
            total += sum(2 * bins[f] for f in offered[tree][node])
        needed = set(places)
        for node in places:
            while node > 1:
                node >>= 1
                needed.add(node)
        out = np.zeros(total, dtype="int64")

        def descend(node: int, block: np.ndarray, held: np.ndarray) -> None:
            if node in places:
                at = places[node]
                for f in offered[tree][node]:
                    out[at:at + 2 * bins[f]] += np.bincount(block[f].take(held), minlength=2 * bins[f])
                    at += 2 * bins[f]
                return
            split = nodes[node]
            values = block[split.feature].take(held)
            if split.feature in categorical:
                member = np.zeros(2 * bins[split.feature], dtype=bool)
                for c in split.left:
                    member[2 * c:2 * c + 2] = True
                goes = member.take(values)
            else:
                goes = values <= 2 * split.left + 1
            if 2 * node in needed:
                descend(2 * node, block, held.compress(goes))
            if 2 * node + 1 in needed:
                descend(2 * node + 1, block, held.compress(~goes))

        for part, place, block in blocks:
            descend(1, block, _drawn(table, block.shape[1], seed, tree, part, place))
        return out

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [(r["part"], r["place"], np.frombuffer(r["bins"], dtype="uint16").reshape(len(bins), -1))
                  for batch in batches for r in batch.to_pylist()]
        for tree in (t for t in range(len(offered)) if blocks and offered[t]):
            yield pa.RecordBatch.from_pydict({"tree": pa.array([tree], pa.int32()), "counts": pa.array([count_tree(tree, blocks).tobytes()], pa.binary())})

    return count


def _grow(blocks: DataFrame, bins: Sequence[int], arity: dict[int, int], width: int, params: SparkForest) -> list[dict[int, Split]]:
    """Per tree its counted nodes, the children of node k being 2 k and 2 k + 1.  One pass over the rows and one exchange of counts a level."""
    spark, trees, depth = blocks.sparkSession, params.getNumTrees(), params.getMaxDepth()
    seed = params.getSeed() & (1 << 64) - 1
    table = draw_table(params.getSubsamplingRate(), params.getBootstrap())
    kind, min_rows, min_gain = params.getImpurity(), params.getMinInstancesPerNode(), params.getMinInfoGain()
    rows = blocks.agg(F.sum("rows")).first()[0]
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
    splits: list[dict[int, Split]] = [{} for _ in range(trees)]
    open_nodes: list[list[int]] = [[1] for _ in range(trees)]
    for _ in range(depth):
        offered = [{node: sorted(np.random.default_rng([seed, tree, node]).permutation(len(bins))[:width].tolist()) for node in nodes}
                   for tree, nodes in enumerate(open_nodes)]

        def choose(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree, total, found, at = key[0].as_py(), 0, {}, 0
            for batch in batches:
                for counts in batch.column("counts"):
                    total = total + np.frombuffer(counts.as_buffer(), dtype="int64")
            for node in sorted(offered[tree]):
                size = sum(2 * bins[f] for f in offered[tree][node])
                found[node] = best_split(total[at:at + size], offered[tree][node], bins, arity, kind, min_rows, min_gain)
                at += size
            yield pa.RecordBatch.from_pydict({"tree": pa.array([tree], pa.int32()), "found": pa.array([pickle.dumps(found)], pa.binary())})

        counted = blocks.coalesce(tasks).mapInArrow(_counter(splits, offered, bins, set(arity), table, seed), "tree int, counts binary")
        open_nodes = [[] for _ in range(trees)]
        for row in counted.groupBy("tree").applyInArrow(choose, "tree int, found binary").collect():
            for node, split in pickle.loads(row["found"]).items():
                splits[row["tree"]][node] = split
                if split.feature >= 0:
                    for child, counts in ((2 * node, split.left_counts), (2 * node + 1, _rest(split))):
                        if min(counts):
                            open_nodes[row["tree"]].append(child)
        if not any(open_nodes):
            break
    return splits


def _rest(split: Split) -> tuple[int, int]:
    return split.counts[0] - split.left_counts[0], split.counts[1] - split.left_counts[1]


def _nodes(splits: dict[int, Split], cuts: Sequence[np.ndarray], arity: dict[int, int], impurity: str) -> list[dict]:
    """A tree's nodes as Spark saves them, parents first; equal sibling leaves are merged."""
    out: list[dict] = []

    def add(node: int, counts: tuple[int, int]) -> bool:
        """Whether the node became a leaf."""
        split, mine = splits.get(node), len(out)
        out.append({"id": mine, "prediction": float(counts[1] > counts[0]), "impurity": float(_impurity(impurity, *map(np.float64, counts))),
                    "impurityStats": [float(c) for c in counts], "rawCount": sum(counts), "gain": -1.0, "leftChild": -1, "rightChild": -1,
                    "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}})
        if split is None or split.feature < 0:
            return True
        left = add(2 * node, split.left_counts)
        second = len(out)
        right = add(2 * node + 1, _rest(split))
        if left and right and out[mine + 1]["prediction"] == out[second]["prediction"]:
            del out[mine + 1:]
            return True
        f = split.feature
        values = split.left if f in arity else [cuts[f][split.left]]
        out[mine] |= {"gain": split.gain, "leftChild": mine + 1, "rightChild": second, "split": {
            "featureIndex": f, "leftCategoriesOrThreshold": [float(v) for v in values], "numCategories": arity.get(f, -1)}}
        return False

    add(1, splits[1].counts)
    return out


def _as_model(params: SparkForest, trees: list[dict[int, Split]], cuts: Sequence[np.ndarray], arity: dict[int, int],
              spark: SparkSession) -> RandomForestClassificationModel:
    """The trees in the format that Spark's models are saved in, loaded from there."""
    path, whole = scratch_path(spark, "forest"), "numTrees bootstrap featureSubsetStrategy subsamplingRate leafCol thresholds".split()
    maps = {"paramMap": params._paramMap, "defaultParamMap": params._defaultParamMap}

    def about(kind: str, uid: str, skip: Sequence[str] = (), **more) -> str:
        given = {k: {p.name: v for p, v in values.items() if p.name not in skip} for k, values in maps.items()}
        return json.dumps({"class": f"org.apache.spark.ml.classification.{kind}", "timestamp": int(time.time() * 1000),
                           "sparkVersion": spark.version, "uid": uid, **given, **more})

    forest = about("RandomForestClassificationModel", params.uid, numFeatures=len(cuts), numClasses=2, numTrees=len(trees))
    each = [(k, about("DecisionTreeClassificationModel", f"{params.uid}_{k}", whole), 1.0) for k in range(len(trees))]
    nodes = [_nodes(splits, cuts, arity, params.getImpurity()) for splits in trees]
    rows = pa.Table.from_pylist([{"treeID": k, "nodeData": node} for k, tree in enumerate(nodes) for node in tree], schema=NODE)
    spark.createDataFrame([(forest,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(rows).coalesce(1).write.parquet(f"{path}/data")
    model = RandomForestClassificationModel.load(path)
    model._nodes = nodes
    return model


def saved_nodes(model: RandomForestClassificationModel, spark: SparkSession) -> list[list[dict]]:
    """The nodes of every tree as the model saves them, parents first.  As large as the model, whatever the rows."""
    if hasattr(model, "_nodes"):
        return model._nodes
    path = scratch_path(spark, "forest")
    model.write().overwrite().save(path)
    out: list[list[dict]] = [[] for _ in range(model.getNumTrees)]
    for row in sorted(spark.read.parquet(f"{path}/data").collect(), key=lambda r: (r["treeID"], r["nodeData"]["id"])):
        out[row["treeID"]].append(row["nodeData"].asDict(True))
    return out


def leaf_finder(forest: Sequence[Sequence[dict]]) -> Callable[[], Callable[[np.ndarray], np.ndarray]]:
    """Makes the function from rows of features to the leaf each reaches in every tree, numbered as `leafCol` does."""

    def make() -> Callable[[np.ndarray], np.ndarray]:
        number = [dict(zip((n["id"] for n in tree if n["leftChild"] < 0), range(len(tree)))) for tree in forest]
        kinds = max([n["split"]["numCategories"] for tree in forest for n in tree], default=0) + 1
        left = {(k, n["id"]): np.isin(np.arange(kinds), n["split"]["leftCategoriesOrThreshold"])
                for k, tree in enumerate(forest) for n in tree if n["split"]["numCategories"] >= 0}

        def find(x: np.ndarray) -> np.ndarray:
            columns = np.ascontiguousarray(x.T)
            out = np.empty((len(forest), len(x)), dtype="int64")
            for k, tree in enumerate(forest):
                waiting = [(0, np.arange(len(x)))]
                while waiting:
                    at, held = waiting.pop()
                    node = tree[at]
                    if node["leftChild"] < 0:
                        out[k, held] = number[k][at]
                        continue
                    split = node["split"]
                    values, member = columns[split["featureIndex"]].take(held), left.get((k, at))
                    if member is None:
                        goes = values <= split["leftCategoriesOrThreshold"][0]
                    else:
                        goes = member.take(values.astype("int64"), mode="clip")
                    waiting += [(node["leftChild"], held.compress(goes)), (node["rightChild"], held.compress(~goes))]
            return out.T

        return find

    return make
