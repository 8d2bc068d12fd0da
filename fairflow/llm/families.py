"""Confirming candidate links between sets, and the links that stars leave hidden.

Sets meet in runs (a shared band, a shared signature).  A run compares each of its sets with one, the pivot: a star.  Where
a star fails, two others of the run may still link.

Full sets are large, so candidates first pass a sketch.  The domain of shingles is dealt to slots, ``SLOTS`` times as many as a
linked pair may differ in; a slot holds one byte, the sum of a byte per shingle.  A shingle that only one of two sets has
changes one slot, so sets differ in at least as many shingles as their sketches differ in slots: more than a link
allows, and the pair cannot link.  That is certain, not an estimate.  What is left is confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import may_match
from . import repeats
from .common import LOWER, SPACES, mix, text_blocks, window_hashes, windows_inside, word_hashes, word_spans
from .components import components
from .staging import staged

BLOCK_SHINGLES = 1 << 18
SLOTS = 8
NAMED_BITS = 1 << 23
_SLOT, _BYTE = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets, SPACES)
    words = word_hashes(data, starts, ends)
    hashes = window_hashes(words, shingle)
    at = windows_inside(first, shingle)
    n = np.diff(first)
    cuts = np.searchsorted(at, first)
    hashes = hashes[at]
    out = []
    for row, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        if 0 < n[row] < shingle:
            whole = window_hashes(words[first[row]:first[row + 1]], int(n[row]))
            out.append(mix(whole + np.uint64(n[row])))
        else:
            out.append(np.unique(hashes[a:b]))
    return out


def allowed(sizes, percent: int):
    """In how many shingles two linked sets may differ, given the sum of their sizes."""
    return sizes * (100 - percent) // (100 + percent)


def sketch(shingles: np.ndarray, percent: int) -> np.ndarray:
    """The slots of a set, a power of two of them by its size; the first half added to the second gives the sketch
    of half as many slots."""
    slots = 1 << max(3, int(SLOTS * allowed(2 * len(shingles), percent)).bit_length())
    out = np.zeros(slots, np.uint8)
    at = (mix(shingles ^ _SLOT) & np.uint64(slots - 1)).astype(np.int64)
    np.add.at(out, at, (mix(shingles ^ _BYTE) >> np.uint64(56)).astype(np.uint8))
    return out


def folded(slots: np.ndarray, size: int) -> np.ndarray:
    return slots if slots.shape[-1] == size else slots.reshape(*slots.shape[:-1], -1, size).sum(axis=-2, dtype=np.uint8)


def full_sets(texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """node, n, sketch and set of the texts (node, text), written once; later reads take the columns they need."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column("text"), repeats.BLOCK_BYTES):
                sets = shingle_sets(data, offsets, shingle)
                yield pa.RecordBatch.from_arrays([
                    batch.column("node").slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([sketch(s, percent).tobytes() for s in sets], pa.binary()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "n", "sketch", "set"])

    return staged(texts.mapInArrow(run, "node long, n long, sketch binary, set array<long>"))


def _possible(percent: int):
    """Pairs whose sizes and sketches do not exclude a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column("n").to_numpy(), batch.column("m").to_numpy()
            fits = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
            most = allowed(n + m, percent)
            for k in np.flatnonzero(fits):
                x, y = (np.frombuffer(batch.column(c)[k].as_py(), np.uint8) for c in ("x", "y"))
                size = min(len(x), len(y))
                fits[k] = np.count_nonzero(folded(x, size) != folded(y, size)) <= most[k]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("pivot", "node")], ["pivot", "node"]).filter(pa.array(fits))
    return run


def possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (pivot, node) that sizes and sketches leave; the full sets are not read, and sketches move as far as a
    bitmap of bounded size tells that a pair names them at that end."""
    sides = [may_match(sets.select("node", "n", "sketch"), pairs.select(F.col(c).alias("node")), ["node"], NAMED_BITS)
             for c in ("node", "pivot")]
    x = sides[0].select("node", "n", F.col("sketch").alias("x"))
    y = sides[1].select(F.col("node").alias("pivot"), F.col("n").alias("m"), F.col("sketch").alias("y"))
    return pairs.join(x, "node").join(y, "pivot").select("pivot", "node", "n", "m", "x", "y").mapInArrow(
        _possible(percent), "pivot long, node long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (pivot, node) that link, as (a, b).  Only the sets that the pairs name are moved, as far as a
    bitmap of bounded size tells them."""
    both = F.size(F.array_intersect("x", "y"))
    sides = [may_match(sets.select("node", "set"), pairs.select(F.col(c).alias("node")), ["node"], NAMED_BITS) for c in ("node", "pivot")]
    return (pairs.join(sides[0].select("node", F.col("set").alias("x")).hint("merge"), "node")
            .join(sides[1].select(F.col("node").alias("pivot"), F.col("set").alias("y")).hint("merge"), "pivot")
            .filter(100 * both >= percent * (F.size("x") + F.size("y") - both))
            .select(F.col("node").alias("a"), F.col("pivot").alias("b")))


def _block_pairs(percent: int):
    """Pairs of different components in one unit (those that ask against all) that sketches do not exclude."""
    def run(table: pa.Table) -> pa.Table:
        node, label, n = (table.column(c).to_numpy() for c in ("node", "label", "n"))
        asks = table.column("asks").to_numpy()
        sketches = [np.frombuffer(s, np.uint8) for s in table.column("sketch").to_pylist()]
        sizes = np.array([len(s) for s in sketches])
        targets = {}
        for size in np.unique(sizes):  # per number of slots: the targets with as many or more, ascending by n
            own = np.flatnonzero(~asks & (sizes == size))
            if len(own):
                own = own[np.argsort(n[own])]
                targets[int(size)] = (own, n[own], np.stack([sketches[k] for k in own]))
        pairs: list[np.ndarray] = []
        for k in np.flatnonzero(asks):
            for size, (own, m, slots) in targets.items():
                low = np.searchsorted(m, -(-percent * n[k] // 100))
                high = np.searchsorted(m, 100 * n[k] // percent, "right")
                if low >= high:
                    continue
                least = min(size, len(sketches[k]))
                differ = np.count_nonzero(folded(slots[low:high], least) != folded(sketches[k], least), axis=1)
                found = own[low:high][differ <= allowed(n[k] + m[low:high], percent)]
                found = found[label[found] != label[k]]
                pairs.append(np.stack([np.full(len(found), node[k]), node[found]]))
        both = np.concatenate(pairs, axis=1) if pairs else np.empty((2, 0), np.int64)
        return pa.table({"pivot": pa.array(both.min(axis=0)), "node": pa.array(both.max(axis=0))})
    return run


def labelled(df: DataFrame, labels: DataFrame, column: str, out: str) -> DataFrame:
    """The component of a column of nodes; a node without links is its own."""
    named = labels.select(F.col("node").alias(column), F.col("label").alias(out))
    return df.join(named, column, "left").withColumn(out, F.coalesce(out, column))


def relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after links between labels."""
    joined = staged(components(links).select(F.col("node").alias("label"), F.col("label").alias("whole")))
    known = labels.unionByName(joined.join(labels, "label", "left_anti").select(F.col("label").alias("node"), "label"))
    return staged(known.join(joined, "label", "left").select("node", F.coalesce("whole", "label").alias("label")))


def hidden_links(meets: DataFrame, failed: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (between components) among the sets of runs with a failed star.

    ``meets`` has a row (run, pivot, node) for every set of a run but its pivot, ``failed`` the stars (pivot, node) whose
    ends are not connected, ``labels`` the components so far, ``sets`` the `full_sets` of every node here.  The sets
    of a run are compared run by run, or all sets of overlapping runs at once, whichever is less work; those in the
    largest component among them only answer.  Blocks of sketches are compared in tasks, and only pairs that
    they do not exclude come out, to be confirmed.
    """
    runs = meets.filter("run IS NOT NULL")
    open_ = runs.join(failed.select("pivot", "node"), ["pivot", "node"], "left_semi").select("run").distinct()
    rows = staged(runs.join(open_, "run", "left_semi"))
    # Runs of the same sets are worked on once, and a run of two has nothing to add to its star.
    alike = rows.groupBy("run").agg(
        F.min("pivot").alias("pivot"), F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("h1"),
        F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("h2")).filter("n > 1")
    once = staged(alike.groupBy("pivot", "n", "h1", "h2").agg(F.min("run").alias("run")))
    rows = staged(rows.join(once.select("run"), "run", "left_semi"))
    family = staged(components(rows.select(F.col("pivot").alias("a"), F.col("node").alias("b")))
                    .select("node", F.col("label").alias("family")))
    in_family = family.groupBy("family").agg(F.count(F.lit(1)).cast("double").alias("m"))
    by_run = once.select("run", F.col("pivot").alias("node"), (F.col("n") + 1).cast("double").alias("m")).join(family, "node")
    cost = by_run.groupBy("family").agg(F.sum(F.col("m") * F.col("m")).alias("apart")).join(in_family, "family")
    together = staged(cost.select("family", (F.col("m") * F.col("m") <= F.col("apart")).alias("together")))
    members = rows.select("run", "node").unionByName(once.select("run", F.col("pivot").alias("node")))
    members = members.join(family, "node").join(together, "family")
    unit = F.when(F.col("together"), F.struct(F.lit(0).alias("kind"), F.col("family").alias("of"))).otherwise(
        F.struct(F.lit(1).alias("kind"), F.col("run").alias("of")))
    nodes = staged(labelled(members.select(unit.alias("unit"), "node").distinct(), labels, "node", "label"))
    # Sets of one component only: nothing to find.
    sized = nodes.join(sets.select("node", "n"), "node")
    by_label = sized.groupBy("unit", "label").agg(F.sum("n").alias("n"))
    shape = by_label.groupBy("unit").agg(
        F.max_by("label", F.struct("n", "label")).alias("main"), F.sum("n").alias("all"), F.max("n").alias("most"),
        F.count(F.lit(1)).alias("labels")).filter("labels > 1").select(
        "unit", "main", F.ceil(F.col("all") / BLOCK_SHINGLES).cast("int").alias("target_blocks"),
        F.ceil((F.col("all") - F.col("most")) / BLOCK_SHINGLES).cast("int").alias("ask_blocks"))
    placed = staged(nodes.join(shape, "unit"))
    placed = placed.join(may_match(sets.select("node", "n", "sketch"), placed.select("node"), ["node"], NAMED_BITS), "node")
    slot = F.xxhash64("node")
    asking = placed.filter("label <> main").select(
        "unit", F.pmod(slot, "ask_blocks").cast("int").alias("q"),
        F.explode(F.sequence(F.lit(0), F.col("target_blocks") - 1)).alias("t"), F.lit(True).alias("asks"), "node", "label", "n", "sketch")
    asked = placed.select(
        "unit", F.explode(F.sequence(F.lit(0), F.col("ask_blocks") - 1)).alias("q"),
        F.pmod(slot, "target_blocks").cast("int").alias("t"), F.lit(False).alias("asks"), "node", "label", "n", "sketch")
    pairs = staged(asking.unionByName(asked).groupBy("unit", "q", "t")
                   .applyInArrow(_block_pairs(percent), "pivot long, node long").distinct())
    links = confirmed(pairs, sets, percent).select(F.col("a").alias("node"), F.col("b").alias("pivot"))
    return labelled(labelled(links, labels, "node", "x"), labels, "pivot", "y").select(F.col("x").alias("a"), F.col("y").alias("b"))
