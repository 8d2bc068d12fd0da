"""Suffix-array dedup: bytes covered by a ``length``-byte string that also starts anywhere else.

1. *Anchors.*  Among the 32-byte strings of each ``length``-byte window the one with the smallest hash
   (the leftmost of equals) is the window's anchor, so equal windows have equal anchors at equal
   distances.  One anchor serves some 85 windows.  Anchors are counted over all documents (`repeats`);
   windows of an anchor that occurs once cannot repeat and are left.
2. *Dealing suffixes.*  The windows of a repeated anchor start at neighbouring bytes; the bytes they
   cover, a span, are dealt by the anchor's hash, so suffixes with an equal prefix of ``length`` bytes
   meet in one bucket.  Spans that are equal byte by byte are sorted once, with their number.
3. *Suffix sort.*  In a bucket the suffixes are sorted by mergesort.  A comparison finds the common
   extension of two suffixes by binary search over prefix polynomial hashes, then looks at one byte.
   Neighbours in the result are compared byte by byte, so a hash collision cannot make strings equal;
   where it has spoilt the order, the suffixes concerned are sorted by their bytes.  Neighbours whose
   common extension reaches ``length`` are repeated.
4. *Hot anchors.*  An anchor with more than ``HOT`` occurrences would be one group in one task, so its
   windows are dealt, and sorted as above, by longer strings: ``WIDTHS[0]`` windows at neighbouring distances share
   all but a few of their bytes, and the hash of those is their key.  A first pass counts the keys.  What has a key of its
   own cannot repeat; a key with more than ``HOT`` different surroundings is cut into fewer windows, at last into single
   ones, whose key is all their bytes.  Of equal spans a batch sends one with the places of all.
5. Repeated windows merge into maximal runs and their bytes are removed.

Defined results.  NULL or empty text, or one shorter than ``length``: nothing removed.  Repeated rows
remove each other wholly.  A NULL id keeps its row.  Other columns are ignored.  Cut texts are bytes:
a removed run may end inside a character.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import repeats
from .common import (byte_values, mix, pack, pack_sorted, prefix_hashes, range_hashes, runs, text_blocks,
                     unpack, unpack_sorted, windows_inside)
from .register import query
from .staging import staged

LENGTH = 200
ANCHOR = 32
HOT = 4096
WIDTHS = (32, 8, 1)  # windows of a hot anchor that travel together
KEY_SLOTS = 1 << 23
KEY_BATCH = 1 << 19
ANCHOR_BATCH = 1 << 17
SPAN_BATCH_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20
SORT_BYTES = 3 << 19

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    have, reach = values, 1
    while reach * 2 <= width:
        have = np.minimum(have[:-reach], have[reach:])
        reach *= 2
    if reach < width:
        rest = width - reach
        have = np.minimum(have[:len(have) - rest], have[rest:])
    return have


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int):
    """Windows grouped by their anchor: prefix hashes, window starts, and where each group begins
    among them; the anchors' positions and hashes."""
    prefix = prefix_hashes(byte_values(2)[data])
    starts = windows_inside(offsets, length)
    if not len(starts):
        none = np.empty(0, np.int64)
        return prefix, none, none, none, np.empty(0, np.uint64)
    at = np.arange(len(data) - anchor + 1)
    hashes = mix(range_hashes(prefix, at, at + anchor))
    ranked = (hashes & ~np.uint64(0xFFFFFFFF)) | at.astype(np.uint64)
    chosen = (_sliding_min(ranked, length - anchor + 1)[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    begin = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
    positions = chosen[begin]
    # Chosen hashes are small ones; mixed again they spread evenly over the buckets.
    return prefix, starts, begin, positions, mix(hashes[positions] + np.uint64(1))


def _anchor_positions(length: int, anchor: int):
    def positions(data: np.ndarray, offsets: np.ndarray):
        _, _, _, at, hashes = anchors(data, offsets, length, anchor)
        return hashes, at, offsets
    return positions


def compare(text: np.ndarray, prefix: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """-1, 0 or 1 for the suffixes at a and b, by their first ``length`` bytes."""
    out = np.zeros(len(a), np.int8)
    left = np.flatnonzero(range_hashes(prefix, a, a + length) != range_hashes(prefix, b, b + length))
    x, y = a[left], b[left]
    low, high = np.zeros(len(x), np.int64), np.full(len(x), length - 1)
    while True:
        open_ = low < high
        if not open_.any():
            break
        middle = (low + high + 1) >> 1
        same = range_hashes(prefix, x, x + middle) == range_hashes(prefix, y, y + middle)
        low = np.where(open_ & same, middle, low)
        high = np.where(open_ & ~same, middle - 1, high)
    u, v = text[x + low], text[y + low]
    out[left] = (u > v).astype(np.int8) - (u < v).astype(np.int8)
    return out


def merge_sort(text: np.ndarray, prefix: np.ndarray, suffixes: np.ndarray, begin: np.ndarray, length: int) -> np.ndarray:
    """The suffixes sorted within each segment; segment s starts at begin[s].  Bottom-up: at each level
    every suffix finds its rank in the neighbouring run by binary search."""
    sizes = np.diff(begin, append=len(suffixes))
    current = suffixes.copy()
    width = 1
    while True:
        active = np.flatnonzero(sizes > width)
        if not len(active):
            return current
        size = sizes[active]
        base = np.repeat(begin[active], size)
        total = np.repeat(size, size)
        index = np.arange(len(base)) - np.repeat(np.cumsum(size) - size, size)
        run = index // width
        sibling = (run ^ 1) * width
        low = np.minimum(sibling, total)
        high = np.minimum(sibling + width, total)
        first = low.copy()
        mine = current[base + index]
        after = (run & 1).astype(np.int8)  # equal ones of the left run go first
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) >> 1
            smaller = compare(text, prefix, current[base[open_] + middle], mine[open_], length) < after[open_]
            low[open_[smaller]] = middle[smaller] + 1
            high[open_[~smaller]] = middle[~smaller]
        target = base + (run & ~1) * width + (index - run * width) + (low - first)
        current[target] = mine
        width *= 2


def _byte_order(text: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """As ``compare``, but on the bytes themselves."""
    out = np.empty(len(a), np.int8)
    step = max(1, (4 << 20) // length)
    span = np.arange(length)
    for i in range(0, len(a), step):
        x, y = text[a[i:i + step, None] + span], text[b[i:i + step, None] + span]
        differ = x != y
        k = differ.argmax(1)
        rows = np.arange(len(x))
        u, v = x[rows, k], y[rows, k]
        out[i:i + step] = (u > v).astype(np.int8) - (u < v).astype(np.int8)
    return out


def repeated_suffixes(text: np.ndarray, prefix: np.ndarray, suffixes: np.ndarray, segment: np.ndarray,
                      length: int) -> np.ndarray:
    """Which suffixes share their first ``length`` bytes with another one of their segment."""
    marked = np.zeros(len(suffixes), bool)
    order = np.argsort(segment, kind="stable")
    ordered = segment[order]
    begin = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    sizes = np.diff(begin, append=len(order))
    many = np.repeat(sizes > 1, sizes)
    order, sizes = order[many], sizes[sizes > 1]
    if not len(order):
        return marked
    begin = np.cumsum(sizes) - sizes
    number = np.empty(len(text) + 1, np.int64)
    number[suffixes[order]] = order
    found = merge_sort(text, prefix, suffixes[order], begin, length)
    of = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.flatnonzero(of[1:] == of[:-1])
    result = _byte_order(text, found[inside], found[inside + 1], length)
    for s in np.unique(of[inside[result > 0]]):  # a collision has spoilt this segment
        part = slice(begin[s], begin[s] + sizes[s])
        found[part] = sorted(found[part].tolist(), key=lambda p: text[p:p + length].tobytes())
        own = np.flatnonzero(of[inside] == s)
        result[own] = _byte_order(text, found[inside[own]], found[inside[own] + 1], length)
    same = inside[result == 0]
    marked[number[found[same]]] = True
    marked[number[found[same + 1]]] = True
    return marked


def _expand(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers begin[k] .. begin[k] + count[k] - 1 of every k, one after the other."""
    return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def _cut_windows(prefix: np.ndarray, positions: np.ndarray, low: np.ndarray, high: np.ndarray, width: int,
                 length: int, anchor: int):
    """The windows that begin ``low`` to ``high`` bytes ahead of anchors, cut where the distance is a multiple of ``width``:
    positions, low, high and a key, the hash of the bytes that all windows of those ``width`` distances cover."""
    first = low // width
    count = high // width - first + 1
    of = np.repeat(np.arange(len(low)), count)
    near = _expand(first, count) * width
    far = np.minimum(near + width - 1, length - anchor)
    at = positions[of]
    key = range_hashes(prefix, at - near, at - far + length) ^ mix((near * (length + 1) + width).astype(np.uint64))
    return at, np.maximum(low[of], near), np.minimum(high[of], far), mix(key)


def _marked(packed: list, positions: np.ndarray, offsets: np.ndarray, a: int, b: int) -> np.ndarray:
    """Which anchors of the texts a..b stand at the packed places of their text."""
    out = np.zeros(len(positions), bool)
    for r in range(a, b):
        if packed[r] is not None and len(packed[r]) > 1:
            out[np.searchsorted(positions, unpack_sorted(packed[r]).astype(np.int64) + offsets[r - a])] = True
    return out


def hot_keys(found: DataFrame, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps over slots of keys of hot anchors' windows: a key that occurs again, one with many surroundings.

    Keys that share a slot share the answers: some windows are sent in vain or one by one, none is lost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size = 0

        def flush() -> pa.RecordBatch:
            keys, spans = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            order = np.lexsort((spans, keys))
            keys, spans = keys[order], spans[order]
            first = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (spans[1:] != spans[:-1]))))
            return pa.RecordBatch.from_arrays(
                [pa.array(keys[first].view(np.int64)), pa.array(spans[first].view(np.int64)),
                 pa.array(np.diff(first, append=len(keys)), pa.int64())], ["key", "span", "times"])

        for batch in batches:
            hots = batch.column("hot").to_pylist()
            for a, b, data, offsets in text_blocks(batch.column("text"), repeats.BLOCK_BYTES):
                prefix, starts, begin, positions, _ = anchors(data, offsets, length, anchor)
                hot = np.flatnonzero(_marked(hots, positions, offsets, a, b))
                at = positions[hot]
                low, high = at - starts[np.append(begin[1:], len(starts))[hot] - 1], at - starts[begin[hot]]
                for width in WIDTHS[:-1]:
                    x, near, far, key = _cut_windows(prefix, at, low, high, width, length, anchor)
                    span = mix(range_hashes(prefix, x - far, x - near + length) ^ (far * (length + 1) + near).astype(np.uint64))
                    held.append((key, span))
                    size += len(key)
                if size >= KEY_BATCH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    spans = found.mapInArrow(run, "key long, span long, times long").groupBy("key", "span").agg(F.sum("times").alias("times"))
    slots = (spans.groupBy("key").agg(F.sum("times").alias("times"), F.count(F.lit(1)).alias("spans"))
             .filter("times > 1").groupBy(F.pmod("key", F.lit(KEY_SLOTS)).alias("slot")).agg(F.max("spans").alias("spans")))
    bits = "bitmap_construct_agg(bitmap_bit_position(slot + 1))"
    maps = slots.groupBy(F.expr("bitmap_bucket_number(slot + 1)").alias("part")).agg(
        F.expr(bits).alias("again"), F.expr(f"{bits} FILTER (WHERE spans > {HOT})").alias("crowded")).collect()
    out = [np.zeros(KEY_SLOTS, bool) for _ in range(2)]
    for m in maps:
        for whole, part in zip(out, (m["again"], m["crowded"])):
            mine = np.unpackbits(np.frombuffer(part, np.uint8), bitorder="little")
            begin = (m["part"] - 1) * len(mine)
            whole[begin:begin + len(mine)] = mine[:KEY_SLOTS - begin]
    return np.packbits(out[0], bitorder="little"), np.packbits(out[1], bitorder="little")


def _in_slots(slots: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & np.uint64(KEY_SLOTS - 1)
    return (slots[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


SPANS = ("bucket int, batch long, lead boolean, hashes binary, times binary, at binary, windows binary, ahead binary,"
         " text binary, ids binary, keys binary, first binary")
SENT = ("hashes", "times", "at", "windows", "ahead", "text")


def _send_spans(rows: DataFrame, keys: tuple[np.ndarray, np.ndarray], bits: int, length: int, anchor: int) -> DataFrame:
    """The spans of repeated anchors, those of hot ones cut by their keys, per batch and bucket."""
    again, crowded = keys

    def cut_hot(prefix: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray):
        done = []
        for width in WIDTHS:
            at, low, high, key = _cut_windows(prefix, at, low, high, width, length, anchor)
            if width != WIDTHS[-1]:
                left = _in_slots(again, key)
                at, low, high, key = at[left], low[left], high[left], key[left]
                left = _in_slots(crowded, key)
                done.append((at[~left], low[~left], high[~left], key[~left]))
                at, low, high = at[left], low[left], high[left]
            else:
                done.append((at, low, high, key))
        return (np.concatenate(x) for x in zip(*done))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list = []
        docs: list = []
        base = 0
        # Spans of hot anchors by key, distance and bytes, with their places in the batch.
        equal: dict[tuple[int, int, bytes], list[int]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            tables = [pack(np.concatenate([d[k] for d in docs]).view(np.uint64)) for k in (0, 1)]
            tables.append(pack(np.concatenate([d[2] for d in docs]).astype(np.uint64)))
            hashes, at, windows, ahead = (np.concatenate([h[k] for h in held]) for k in range(4))
            pieces = [x for h in held for x in h[4]]
            times = np.concatenate([np.ones(len(at), np.uint64), np.array([len(x) for x in equal.values()], np.uint64)])
            hashes = np.concatenate([hashes, np.array([k for k, _, _ in equal], np.uint64)])
            windows = np.concatenate([windows, np.array([len(x) - length + 1 for _, _, x in equal], np.uint64)])
            ahead = np.concatenate([ahead, np.array([x for _, x, _ in equal], np.uint64)])
            at = np.concatenate([at, *(np.array(x, np.uint64) for x in equal.values())])
            pieces += [x for _, _, x in equal]
            out: dict[str, list] = {k: [] for k in ("bucket", *SENT)}
            first = (np.cumsum(times) - times).astype(np.int64)
            order = np.argsort(hashes)
            hashes = hashes[order]
            tops = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else []
            edges = [0, *np.searchsorted(hashes, tops).tolist(), len(hashes)]
            for bucket, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                if a < b:
                    own = order[a:b]
                    out["bucket"].append(bucket)
                    out["hashes"].append(pack_sorted(hashes[a:b]))
                    out["times"].append(pack(times[own]))
                    out["at"].append(pack(at[_expand(first[own], times[own].astype(np.int64))]))
                    out["windows"].append(pack(windows[own]))
                    out["ahead"].append(pack(ahead[own]))
                    out["text"].append(b"".join([pieces[i] for i in own]))
            n = len(out["bucket"])
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["bucket"], pa.int32()), pa.array([number] * n, pa.int64()),
                     pa.array([i == 0 for i in range(n)])]
                    + [pa.array(out[k], pa.binary()) for k in SENT]
                    + [pa.array([t] + [None] * (n - 1), pa.binary()) for t in tables],
                    ["bucket", "batch", "lead", *SENT, "ids", "keys", "first"])

        for batch in batches:
            ids, keys = batch.column("_id").to_numpy(), batch.column("_row").to_numpy()
            marks, hots = batch.column("marks").to_pylist(), batch.column("hot").to_pylist()
            for a, b, data, offsets in text_blocks(batch.column("text"), repeats.BLOCK_BYTES):
                prefix, starts, begin, positions, hashes = anchors(data, offsets, length, anchor)
                last = np.append(begin[1:], len(starts)) - 1
                hot = _marked(hots, positions, offsets, a, b)
                cold = np.flatnonzero(_marked(marks, positions, offsets, a, b) & ~hot)
                s0, s1 = starts[begin[cold]], starts[last[cold]]
                raw = data.tobytes()
                held.append((hashes[cold], (s0 + base).astype(np.uint64), (s1 - s0 + 1).astype(np.uint64),
                             (positions[cold] - s0).astype(np.uint64),
                             [raw[x:y + length] for x, y in zip(s0.tolist(), s1.tolist())]))
                warm = np.flatnonzero(hot)
                if len(warm):
                    at, low, high, key = cut_hot(prefix, positions[warm], positions[warm] - starts[last[warm]],
                                                 positions[warm] - starts[begin[warm]])
                    s0, s1 = at - high, at - low
                    for k, x, y, ahead in zip(key.tolist(), s0.tolist(), s1.tolist(), high.tolist()):
                        equal.setdefault((k, ahead, raw[x:y + length]), []).append(x + base)
                docs.append((ids[a:b], keys[a:b], offsets[:-1] + base))
                base += len(data)
                if base >= SPAN_BATCH_BYTES:
                    yield from flush()
                    held, docs, base, number = [], [], 0, number + 1
                    equal.clear()
        if docs:
            yield from flush()

    return rows.mapInArrow(run, SPANS)


def _sort_bucket(length: int):
    """Sorts the suffixes of a bucket's spans and gives the places of the repeated ones, as runs."""

    def sort(rows: list[dict]) -> list[tuple[np.ndarray, np.ndarray]]:
        hashes = [unpack_sorted(r["hashes"]) for r in rows]
        sizes = np.array([len(h) for h in hashes])
        hashes = np.concatenate(hashes)
        times, at, windows, ahead = (np.concatenate([unpack(r[k]) for r in rows]).astype(np.int64)
                                     for k in ("times", "at", "windows", "ahead"))
        text = np.frombuffer(b"".join(r["text"] for r in rows), np.uint8)
        prefix = prefix_hashes(byte_values(3)[text])
        lengths = windows + length - 1
        begin = np.cumsum(lengths) - lengths
        whole = range_hashes(prefix, begin, begin + lengths) ^ (ahead << 32 | windows).astype(np.uint64)
        order = np.lexsort((whole, hashes))
        same_anchor = hashes[order][1:] == hashes[order][:-1]
        same = same_anchor & (whole[order][1:] == whole[order][:-1]) & (lengths[order][1:] == lengths[order][:-1])
        pair = np.flatnonzero(same)
        for i in range(0, len(pair), 4096):  # equal hashes: are the bytes equal?
            p = pair[i:i + 4096]
            x, y = order[p], order[p + 1]
            n = lengths[x]
            equal = text[_expand(begin[x], n)] == text[_expand(begin[y], n)]
            same[p] = np.logical_and.reduceat(equal, np.cumsum(n) - n)
        group = np.concatenate(([0], np.cumsum(~same_anchor)))
        kind = np.concatenate(([0], np.cumsum(~same)))
        members = np.bincount(kind, times[order])
        head = np.flatnonzero(np.concatenate(([True], ~same)))
        kinds_of = np.bincount(group[head])
        mixed = np.flatnonzero(kinds_of[group[head]] > 1)
        spans = order[head[mixed]]
        n = windows[spans]
        suffixes = _expand(begin[spans], n)
        step = _expand(np.zeros(len(spans), np.int64), n)
        segment = np.repeat(group[head[mixed]] * (length + 1) + ahead[spans], n) - step
        found = repeated_suffixes(text, prefix, suffixes, segment, length)
        marked = np.zeros(int(windows.sum()), bool)  # one per window of each span, spans in input order
        window_begin = np.cumsum(windows) - windows
        marked[_expand(window_begin[spans], n)] = found
        many = order[members[kind] > 1]
        marked[_expand(window_begin[many], windows[many])] = True
        # Runs of marked windows within a span, then at each of its places.
        fresh = marked.copy()
        fresh[1:] &= ~marked[:-1]
        fresh[window_begin] = marked[window_begin]
        run_begin = np.flatnonzero(fresh)
        run_length = np.add.reduceat(marked, run_begin, dtype=np.int64) if len(run_begin) else run_begin
        owner = np.searchsorted(window_begin, run_begin, "right") - 1
        runs_of = np.bincount(owner, minlength=len(windows))
        place_of = np.repeat(np.arange(len(windows)), times)
        mine = _expand((np.cumsum(runs_of) - runs_of)[place_of], runs_of[place_of])
        starts = np.repeat(at, runs_of[place_of]) + run_begin[mine] - window_begin[owner[mine]]
        ends = np.cumsum(np.add.reduceat(times * runs_of, np.cumsum(sizes) - sizes))[:-1]
        return list(zip(np.split(starts, ends), np.split(run_length[mine], ends)))

    def run(table: pa.Table) -> pa.Table:
        out: dict[str, list] = {k: [] for k in ("batch", "starts", "lengths", "ids", "keys", "first")}
        rows = table.to_pylist()
        for r, (starts, lengths) in zip(rows, sort(rows)):
            if len(starts) or r["lead"]:
                out["batch"].append(r["batch"])
                out["starts"].append(pack(starts.astype(np.uint64)))
                out["lengths"].append(pack(lengths.astype(np.uint64)))
                for k in ("ids", "keys", "first"):
                    out[k].append(r[k] if r["lead"] else None)
        return pa.table({"batch": pa.array(out["batch"], pa.int64()),
                         **{k: pa.array(out[k], pa.binary()) for k in ("starts", "lengths", "ids", "keys", "first")}})

    return run


def repeated_windows(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document with repeated windows, the packed runs of the positions of their first bytes."""
    anchor = min(ANCHOR, length)
    total = repeats.text_bytes(rows)
    sent = repeats.send(rows, _anchor_positions(length, anchor), repeats.bucket_bits(total, BUCKET_BYTES), ANCHOR_BATCH, owners=False)
    some = staged(repeats.gather(repeats.count(sent, smaller_id=False, hot=HOT)))

    def marked(marks: DataFrame) -> DataFrame:
        candidates, _ = repeats.split(rows, marks)
        return candidates.join(marks.hint("merge"), ["_id", "_row"])

    keys = hot_keys(marked(some.filter("hot IS NOT NULL")), length, anchor)
    spans = _send_spans(marked(some), keys, repeats.bucket_bits(total, SORT_BYTES), length, anchor)
    return repeats.gather_runs(spans.groupBy("bucket").applyInArrow(_sort_bucket(length), repeats.RUNS))


def remove_repeated(documents: DataFrame, length: int = LENGTH, id_col: str = "doc_id",
                    text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and the kept bytes."""
    rows = repeats.keyed(documents, id_col, text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column("doc_id"), batch.column("marks").to_pylist()
            for a, b, data, offsets in text_blocks(batch.column("text"), repeats.BLOCK_BYTES):
                removed, spans, hashes, kept = [], [], [], []
                for row, x, y in zip(range(a, b), offsets[:-1], offsets[1:]):
                    piece, n = data[x:y], 0
                    if marks[row] is not None:
                        start = unpack_sorted(marks[row]["starts"]).astype(np.int64)
                        end = start + unpack(marks[row]["lengths"]).astype(np.int64) + length - 1
                        steps = np.bincount(start, minlength=y - x + 1) - np.bincount(end, minlength=y - x + 1)
                        gone = np.cumsum(steps[:y - x]) > 0
                        piece, n = piece[~gone], len(runs(gone)[0])
                    piece = piece.tobytes()
                    removed.append(int(y - x) - len(piece))
                    spans.append(n)
                    hashes.append(hashlib.sha256(piece).hexdigest())
                    kept.append(piece if keep_text else None)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(a, b - a), pa.array(np.diff(offsets), pa.int64()), pa.array(removed, pa.int64()),
                    pa.array(spans, pa.int64()), pa.array(hashes, pa.string()), pa.array(kept, pa.binary()),
                ], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    marked = repeated_windows(rows, length)
    return repeats.with_marks(rows, marked).select("doc_id", "text", "marks").mapInArrow(cut, RESULT)


@query("op1_suffix_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeated(documents, keep_text=False).drop("kept")
