"""Counting hashes of positions over all documents, in packed rows.

A row per position would cost several times the text in a shuffle.  Here a map task sorts the
hashes of a batch of documents, cuts them by their leading bits into buckets, and sends one row per
(batch, bucket): differences of sorted hashes and the positions they stand at.  Spark deals the
buckets; each is counted alone, and the positions that repeat go back to their batch.  A very
frequent hash is one run in one bucket whose size is its number of positions, eight bytes each.

Batches are numbered by (partition, order within it), so a recomputed task sends the same numbers:
the input must replay in the same order, as a table does.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import pack, pack_sorted, text_blocks, unpack, unpack_sorted

NO_ID = (1 << 63) - 1
BLOCK_BYTES = 1 << 20
SLOTS = 1 << 18

#: bytes, offsets, ids -> (hashes, positions, first position of each row, number of positions)
Positions = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def keyed(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, the text (NULL: empty) and a key that tells rows of one id apart by their text."""
    return documents.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumns({
        "_id": F.coalesce("doc_id", F.lit(NO_ID)),
        "_row": F.xxhash64("text"),
    })


def text_bytes(rows: DataFrame) -> int:
    return rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def bucket_bits(total: int, bytes_per_bucket: int) -> int:
    """Leading hash bits that make buckets of about the given bytes of text."""
    return max(0, (max(1, -(-total // bytes_per_bucket)) - 1).bit_length())


SENT = "bucket int, batch long, lead boolean, hashes binary, at binary, ids binary, keys binary, first binary"


def send(rows: DataFrame, positions: Positions, bits: int, batch_size: int, owners: bool) -> DataFrame:
    """One row per batch of documents and bucket.  ``positions`` gives, for a block of texts, the hash
    and the place of each counted position, and where each text's places begin.  The batch's table of
    documents goes with its first row; ``owners`` sends ids and beginnings with every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            base, hashes, at, first = 0, [], [], []
            for h, a, f, _, _ in held:
                hashes.append(h)
                at.append(a + base)
                first.append(f[:-1] + base)
                base += int(f[-1])
            hashes, at = np.concatenate(hashes), np.concatenate(at)
            ids = pack(np.concatenate([x[3] for x in held]).view(np.uint64))
            keys = pack(np.concatenate([x[4] for x in held]).view(np.uint64))
            begin = pack(np.concatenate(first).astype(np.uint64))
            order = np.argsort(hashes)
            hashes, at = hashes[order], at[order].astype(np.uint64)
            edges = [0, len(hashes)]
            if bits:
                tops = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
                edges = [0, *np.searchsorted(hashes, tops).tolist(), len(hashes)]
                hashes = hashes & np.uint64((1 << (64 - bits)) - 1)
            out: dict[str, list] = {k: [] for k in ("bucket", "hashes", "at")}
            for bucket, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                if a < b:
                    out["bucket"].append(bucket)
                    out["hashes"].append(pack_sorted(hashes[a:b]))
                    out["at"].append(pack(at[a:b]))
            n = len(out["bucket"])
            if n:
                yield pa.RecordBatch.from_arrays([
                    pa.array(out["bucket"], pa.int32()), pa.array([number] * n, pa.int64()),
                    pa.array([i == 0 for i in range(n)]), pa.array(out["hashes"], pa.binary()),
                    pa.array(out["at"], pa.binary()),
                    *(pa.array([x] + [x if owners and x is not keys else None] * (n - 1), pa.binary())
                      for x in (ids, keys, begin)),
                ], ["bucket", "batch", "lead", "hashes", "at", "ids", "keys", "first"])

        for batch in batches:
            ids = batch.column("_id").to_numpy()
            keys = batch.column("_row").to_numpy()
            for a, b, data, offsets in text_blocks(batch.column("text"), BLOCK_BYTES):
                hashes, at, first = positions(data, offsets)
                held.append((hashes, at, first, ids[a:b], keys[a:b]))
                size += max(len(hashes), b - a)
                if size >= batch_size:
                    yield from flush()
                    held, size, number = [], 0, number + 1
        if held:
            yield from flush()

    return rows.select("_id", "_row", "text").mapInArrow(run, SENT)


def _text_of(places: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.searchsorted(first, places, "right") - 1


COUNTED = "batch long, marks binary, hot binary, ids binary, keys binary, first binary"


def count(sent: DataFrame, smaller_id: bool, hot: int | None = None) -> DataFrame:
    """Per batch and bucket the positions whose hash occurs again: anywhere (``smaller_id`` false), or
    in a document with a smaller id; and those whose hash occurs more than ``hot`` times."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["batch", "lead", "hashes", "at", "ids", "keys", "first"]).to_pylist()
        hashes = [unpack_sorted(r["hashes"]) for r in rows]
        sizes = [len(h) for h in hashes]
        ends = np.cumsum(sizes)
        hashes = np.concatenate(hashes)
        places = [unpack(r["at"]) for r in rows]
        order = np.argsort(hashes)
        ordered = hashes[order]
        new = np.empty(len(order), bool)
        new[0] = True
        np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
        marked = np.empty(len(order), bool)
        if smaller_id:
            owner = np.concatenate([
                unpack(r["ids"]).view(np.int64)[_text_of(p, unpack(r["first"]))] for r, p in zip(rows, places)
            ])[order]
            begin = np.flatnonzero(new)
            least = np.minimum.reduceat(owner, begin)
            marked[order] = owner > np.repeat(least, np.diff(begin, append=len(order)))
        else:
            again = ~new
            again[:-1] |= ~new[1:]
            marked[order] = again
        frequent = None
        if hot is not None:
            times = np.diff(np.flatnonzero(new), append=len(order))
            frequent = np.empty(len(order), bool)
            frequent[order] = np.repeat(times > hot, times)
        out: dict[str, list] = {k: [] for k in ("batch", "marks", "hot", "ids", "keys", "first")}
        for r, p, end, n in zip(rows, places, ends, sizes):
            mine = p[marked[end - n:end]]
            if len(mine) or r["lead"]:
                out["batch"].append(r["batch"])
                out["marks"].append(pack(mine))
                out["hot"].append(None if hot is None else pack(p[frequent[end - n:end]]))
                for k in ("ids", "keys", "first"):
                    out[k].append(r[k] if r["lead"] else None)
        return pa.table({"batch": pa.array(out["batch"], pa.int64()),
                         **{k: pa.array(out[k], pa.binary()) for k in ("marks", "hot", "ids", "keys", "first")}})

    return sent.groupBy("bucket").applyInArrow(run, COUNTED)


MARKED = "_id long, _row long, marks binary, hot binary"


def gather(counted: DataFrame) -> DataFrame:
    """One row per document with marked positions: packed ascending places within the text, and those
    of them that are hot."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["marks", "hot", "ids", "keys", "first"]).to_pylist()
        lead = next(r for r in rows if r["ids"] is not None)
        ids, keys = (unpack(lead[k]).view(np.int64) for k in ("ids", "keys"))
        first = unpack(lead["first"])

        def by_text(column: str) -> dict[int, bytes]:
            held = [unpack(r[column]) for r in rows if r[column] is not None]
            places = np.sort(np.concatenate(held)) if held else np.empty(0, np.uint64)
            found, begin = np.unique(_text_of(places, first), return_index=True)
            parts = np.split(places, begin[1:]) if len(found) else []
            return {int(t): pack_sorted(x - first[t]) for t, x in zip(found, parts)}

        marks, hot = by_text("marks"), by_text("hot")
        found = np.fromiter(marks, np.int64, len(marks))
        return pa.table({"_id": pa.array(ids[found], pa.int64()), "_row": pa.array(keys[found], pa.int64()),
                         "marks": pa.array(list(marks.values()), pa.binary()),
                         "hot": pa.array([hot.get(int(t)) for t in found], pa.binary())})

    found = counted.groupBy("batch").applyInArrow(run, MARKED)
    # Repeated rows of one id and text have the same marks: any of them serves.
    return found.groupBy("_id", "_row").agg(F.max("marks").alias("marks"), F.max("hot").alias("hot"))


RUNS = "batch long, starts binary, lengths binary, ids binary, keys binary, first binary"
MARKED_RUNS = "_id long, _row long, starts binary, lengths binary"


def gather_runs(found: DataFrame) -> DataFrame:
    """As ``gather`` for runs of neighbouring positions, which a few bytes describe however long: one
    row per document, packed ascending starts and lengths."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["starts", "lengths", "ids", "keys", "first"]).to_pylist()
        lead = next(r for r in rows if r["ids"] is not None)
        ids, keys = (unpack(lead[k]).view(np.int64) for k in ("ids", "keys"))
        first = unpack(lead["first"])
        starts, lengths = (np.concatenate([unpack(r[k]) for r in rows]) for k in ("starts", "lengths"))
        order = np.argsort(starts)
        starts, lengths = starts[order], lengths[order]
        text, begin = np.unique(_text_of(starts, first), return_index=True)
        parts = list(zip(text, np.split(starts, begin[1:]), np.split(lengths, begin[1:]))) if len(text) else []
        return pa.table({
            "_id": pa.array(ids[text], pa.int64()), "_row": pa.array(keys[text], pa.int64()),
            "starts": pa.array([pack_sorted(s - first[t]) for t, s, _ in parts], pa.binary()),
            "lengths": pa.array([pack(n) for _, _, n in parts], pa.binary())})

    return (found.groupBy("batch").applyInArrow(run, MARKED_RUNS)
            .groupBy("_id", "_row").agg(F.max(F.struct("starts", "lengths")).alias("marks")))


def split(rows: DataFrame, marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that may have marks, and rows that have none, told apart without a shuffle of the texts.

    The keys of marked rows are folded to at most ``SLOTS`` numbers, so what is broadcast has a fixed
    bound however many rows are marked; when most slots are taken, it only filters less."""
    slot = F.pmod(F.xxhash64("_id", "_row"), F.lit(SLOTS)).cast("int")
    slots = F.broadcast(marked.select(slot.alias("_slot")).distinct())
    rows = rows.withColumn("_slot", slot)
    return (rows.join(slots, "_slot", "left_semi").drop("_slot"),
            rows.join(slots, "_slot", "left_anti").drop("_slot"))


def with_marks(rows: DataFrame, marked: DataFrame) -> DataFrame:
    """Every row with its marks (NULL: none); only rows that may have some are shuffled."""
    some, none = split(rows, marked)
    joined = some.join(marked.hint("merge"), ["_id", "_row"], "left")
    columns = ["doc_id", "_id", "_row", "text", "marks"]
    nothing = F.lit(None).cast(marked.schema["marks"].dataType)
    return joined.select(*columns).unionByName(none.withColumn("marks", nothing).select(*columns))
