"""N-gram Jaccard join: PartEnum signatures.

A document's set are its distinct shingles of ``shingle`` words (words are runs of characters other than space
and 0x09-0x0D, A-Z lower-cased); a shorter text with words is one shingle.  Two documents link when
100 * |intersection| >= ``percent`` * |union|.

1. *Bands.*  Sizes fall into bands whose largest size a link to the smallest still allows, so linked sets lie in one
   band or in neighbours.  Every set signs for its own band and for the next one.
2. *Signatures.*  Linked sets of a band with sizes up to s differ in at most k = 2s(100 - percent)/(100 + percent)
   shingles.  The domain of shingles is cut into n1 parts, each into ``N2`` smaller ones, n1 so large that some part holds at most
   ``K2`` of the differences; then N2 - K2 of its smaller parts hold equal shingles.  A signature hashes the
   band, the part, one such subset and the shingles that fall into it: linked sets share one with certainty.
   Where parts are many there is one more than needed, and a set may leave out signatures of no shingle at all
   if only one part has some.
3. *Meeting.*  Equal sets are one (128-bit digest) and sign once.  Signatures travel packed: a row per batch of documents and
   occupied bucket of the hash space.  A bucket pairs each set of a shared signature with the least one: a
   star, never all pairs.
4. *Verification.*  Stars pass sketches that can exclude a link for certain (`families`); the others are confirmed on the
   full sets, first one per set, then those whose ends are not yet connected.
   A signature with a star that failed may hide links between its other sets: these are compared
   block against block in tasks, either signature by signature or all sets of overlapping
   signatures at once, whichever is less work.  Sets already in the largest component among them only answer.
   Only pairs that sketches do not exclude become rows, and are confirmed on the full sets; nothing is capped.
5. Connected components; the smallest id of each names it.

Defined results.  NULL or empty text or no word: empty set, linked with nothing, its own component.  Repeated rows
link like copies.  Ids may be of any ordered type; a NULL id is larger than any other, so a component of such rows
alone has a NULL id.  Other columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import may_match, split_matches, staging_scope
from . import repeats
from .common import mix, pack, pack_sorted, text_blocks, unpack, unpack_sorted
from .components import components
from .families import NAMED_BITS, allowed, confirmed, full_sets, hidden_links, labelled, possible, relabelled, shingle_sets
from .register import query
from .staging import staged

SHINGLE, PERCENT = 4, 85
K2, N2 = 1, 4
SPARE_FROM = 8
BATCH = 1 << 20
BATCH_SETS = 1 << 18
BUCKET = 1 << 20
REST_BITS = 33

_SUBSETS = [list(c) for c in combinations(range(N2), N2 - K2)]
_PLACE, _VALUE = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)


def band_ends(percent: int) -> np.ndarray:
    """The largest size of each band."""
    out, low = [], 1
    while low < 1 << 40:
        out.append(max(low, 100 * low // percent))
        low = out[-1] + 1
    return np.array(out, np.int64)


def differences(end: np.ndarray, percent: int) -> np.ndarray:
    """In how many shingles two linked sets of sizes up to ``end`` may differ."""
    return allowed(2 * end, percent)


def signatures(sets: list[np.ndarray], percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(signatures, which set each belongs to) of not empty sets of distinct 64-bit shingles."""
    size = np.array([len(s) for s in sets])
    ends = band_ends(percent)
    own = np.searchsorted(ends, size)
    whole = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), size)
    out, owners = [], []
    for band in (own, own + 1):
        k = differences(ends[band], percent)
        spare = (k >= SPARE_FROM).astype(np.int64)
        parts = np.where(k > 0, k // (K2 + 1) + 1 + spare, 1)
        first = np.cumsum(parts) - parts
        placed = mix(whole ^ (mix(band.astype(np.uint64) + _PLACE))[row])
        at = (first[row] * N2) + (placed % (parts * N2).astype(np.uint64)[row]).astype(np.int64)
        total = int(parts.sum())
        sums = np.zeros(total * N2, np.uint64)
        np.add.at(sums, at, mix(placed ^ _VALUE))
        held = np.bincount(at, minlength=total * N2).reshape(total, N2)
        sums = sums.reshape(total, N2)
        owner = np.repeat(np.arange(len(sets)), parts)
        part = np.arange(total) - first[owner]
        code = mix((band[owner] << 40 | part).astype(np.uint64) * np.uint64(len(_SUBSETS) + 1))
        exact = (k == 0)[owner]
        # Sets that may not differ sign once, with all their shingles.
        out.append(mix(sums[exact].sum(axis=1) ^ code[exact]))
        owners.append(owner[exact])
        counts = [held[:, s].sum(axis=1) for s in _SUBSETS]
        poor = np.add.reduceat(np.min(counts, axis=0) == 0, first)
        leave_out = (poor <= spare)[owner]
        for turn, (subset, count) in enumerate(zip(_SUBSETS, counts), 1):
            kept = ~exact & ((count > 0) | ~leave_out)
            out.append(mix(sums[kept][:, subset].sum(axis=1) ^ (code[kept] + np.uint64(turn))))
            owners.append(owner[kept])
    return np.concatenate(out), np.concatenate(owners)


def _digest(s: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _digests(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column("text"), repeats.BLOCK_BYTES):
                sets = shingle_sets(data, offsets, shingle)
                made = [_digest(s) if len(s) else (None, None) for s in sets]
                yield pa.RecordBatch.from_arrays([
                    batch.column("_id").slice(a, b - a), batch.column("_row").slice(a, b - a),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array([d for d, _ in made], pa.int64()),
                    pa.array([d for _, d in made], pa.int64())], ["_id", "_row", "n", "d1", "d2"])
    return run


PLACE = ["rows", "sizes", "d1", "d2"]


def _send(shingle: int, percent: int, bits: int, id_type: pa.DataType):
    """Per batch of sets one row with what they are (bucket NULL), and one row per occupied bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        ids: list[pa.Array] = []
        table: dict[str, list] = {c: [] for c in PLACE}
        known: set[tuple[int, int]] = set()
        held, owners, size = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            # Leading bits choose the bucket; of the others REST_BITS are enough to tell its signatures apart.
            hashes, owner = np.concatenate(held) >> np.uint64(64 - bits - REST_BITS), np.concatenate(owners)
            order = np.argsort(hashes)
            hashes, owner = hashes[order], owner[order].astype(np.uint64)
            bucket, first = np.unique(hashes >> np.uint64(REST_BITS), return_index=True)
            rest = hashes & np.uint64((1 << REST_BITS) - 1)
            edges = [*first.tolist(), len(hashes)]
            n = len(bucket)
            columns = [pa.array([None, *bucket.tolist()], pa.int64()), pa.array([number] * (n + 1), pa.int64()),
                       pa.array([None, *[pack_sorted(rest[a:b]) for a, b in zip(edges[:-1], edges[1:])]], pa.binary()),
                       pa.array([None, *[pack(owner[a:b]) for a, b in zip(edges[:-1], edges[1:])]], pa.binary())]
            whole = pa.concat_arrays(ids)
            offsets = pa.array([0, *[len(whole)] * (n + 1)], pa.int32())
            columns.append(pa.ListArray.from_arrays(offsets, whole))
            columns += [pa.array([table[c], *[[]] * n], pa.list_(pa.int64())) for c in PLACE]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "batch", "hashes", "owners", "ids", *PLACE])

        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column("text"), repeats.BLOCK_BYTES):
                new = []
                for k, s in enumerate(shingle_sets(data, offsets, shingle)):
                    digest = _digest(s) if len(s) else None
                    if digest is not None and digest not in known:  # repeated rows
                        known.add(digest)
                        new.append((k, s, digest))
                if new:
                    before = len(table["sizes"])
                    hashes, owner = signatures([s for _, s, _ in new], percent)
                    held.append(hashes)
                    owners.append(owner + before)
                    at = pa.array([a + k for k, _, _ in new])
                    ids.append(batch.column("_id").take(at))
                    table["rows"] += batch.column("_row").take(at).to_pylist()
                    table["sizes"] += [len(s) for _, s, _ in new]
                    table["d1"] += [d for _, _, (d, _) in new]
                    table["d2"] += [d for _, _, (_, d) in new]
                    size += len(hashes)
                if size >= BATCH or len(table["sizes"]) >= BATCH_SETS:
                    yield from flush()
                    ids, table, known = [], {c: [] for c in PLACE}, set()
                    held, owners, size, number = [], [], 0, number + (1 << 20)
        if held:
            yield from flush()

    return run


def _meet(table: pa.Table) -> pa.Table:
    """The stars of one bucket: per shared signature its least set, every other one, and, where there are
    three or more, a number of the signature."""
    batch = table.column("batch").to_numpy()
    hashes = [unpack_sorted(h) for h in table.column("hashes").to_pylist()]
    owner = np.concatenate([unpack(o).astype(np.int64) + b for o, b in zip(table.column("owners").to_pylist(), batch)])
    hashes = np.concatenate(hashes)
    order = np.lexsort((owner, hashes))
    hashes, owner = hashes[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    times = np.diff(first, append=len(hashes))
    shared = np.repeat(times > 1, times)
    pivot = np.repeat(owner[first], times)
    bucket = table.column("bucket")[0].as_py()
    run = np.repeat(np.arange(len(first)), times)
    many = np.repeat(times > 2, times)
    keep = shared & (owner != pivot)
    number = pa.array((bucket << 32) + run[keep], pa.int64(), mask=~many[keep])
    return pa.table({"run": number, "pivot": pa.array(pivot[keep]), "node": pa.array(owner[keep])}).group_by(
        ["run", "pivot", "node"]).aggregate([])


def jaccard_groups(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                   percent: int = PERCENT) -> DataFrame:
    """The id, n_shingles and component_id of every row."""
    from pyspark.sql.pandas.types import to_arrow_type

    identity = F.struct(F.col(f"`{id_col}`").isNull().alias("missing"), F.col(f"`{id_col}`").alias("id"))
    texts = documents.select(identity.alias("_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    id_type = texts.schema["_id"].dataType
    kind, arrow_kind = id_type.simpleString(), to_arrow_type(id_type)
    # The type of what is staged, in which any field may be NULL: a join then needs no cast, and what it has dealt stays dealt.
    texts = texts.withColumns({"_id": F.col("_id").cast(kind), "_row": F.xxhash64("text")})
    with staging_scope(documents.sparkSession) as scope:
        digests = staged(texts.select("_id", "_row", "text").mapInArrow(
            _digests(shingle), f"_id {kind}, _row long, n long, d1 long, d2 long"))

        # Of rows with one set, only the least signs.
        copied = staged(digests.filter("n > 0").groupBy("d1", "d2").agg(
            F.min(F.struct("_id", "_row")).alias("least"), F.count(F.lit(1)).alias("copies")).filter("copies > 1").drop("copies"))
        others = staged(digests.join(copied.hint("merge"), ["d1", "d2"]).filter(F.struct("_id", "_row") != F.col("least"))
                        .select("_id", "_row").distinct())
        some, none = split_matches(texts, others, ["_id", "_row"], NAMED_BITS)
        signing = some.join(others.hint("merge"), ["_id", "_row"], "left_anti").select("_id", "_row", "text").unionByName(
            none.select("_id", "_row", "text"))
        shingles = digests.agg(F.sum("n")).first()[0] or 0
        bits = min(64 - REST_BITS, max(0, (-(-shingles // BUCKET) - 1).bit_length()))
        sent = signing.mapInArrow(
            _send(shingle, percent, bits, arrow_kind),
            f"bucket long, batch long, hashes binary, owners binary, ids array<{kind}>, " + ", ".join(f"{c} array<long>" for c in PLACE))
        sent = staged(sent)
        places = staged(sent.filter("bucket IS NULL").select(
            "batch", F.posexplode(F.arrays_zip("ids", *PLACE)).alias("k", "p")).select(
            (F.col("batch") + F.col("k")).alias("node"), F.col("p.ids").alias("_id"), F.col("p.rows").alias("_row"),
            F.col("p.sizes").alias("n"), F.col("p.d1").alias("d1"), F.col("p.d2").alias("d2")))
        meets = staged(sent.filter("bucket IS NOT NULL").select("bucket", "batch", "hashes", "owners").groupBy("bucket")
                       .applyInArrow(_meet, "run long, pivot long, node long"))
        # Signatures have met: their rows, the most of what is staged, go.
        scope.drop(digests, copied, places, meets)
    # A repeated row signs once per batch: all its numbers become the least.
    again = places.groupBy("d1", "d2").agg(F.min("node").alias("to"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    again = staged(places.join(again, ["d1", "d2"]).filter("node <> to").select("node", "to"))
    if not again.isEmpty():
        meets = meets.join(again, "node", "left").select("run", "pivot", F.coalesce("to", "node").alias("node"))
        meets = meets.join(again.select(F.col("node").alias("pivot"), "to"), "pivot", "left").select(
            "run", F.coalesce("to", "pivot").alias("pivot"), "node")
        meets = staged(meets.filter("pivot <> node").distinct())
        places = places.join(again.select("node"), "node", "left_anti")
    stars = staged(meets.select("pivot", "node").distinct())
    taking_part = stars.select("node").union(stars.select("pivot")).distinct()
    wanted = staged(places.join(taking_part, "node", "left_semi").select("node", "_id", "_row"))
    found = may_match(texts, wanted, ["_id", "_row"], NAMED_BITS).join(wanted.hint("merge"), ["_id", "_row"]).dropDuplicates(["_id", "_row"]).select("node", "text")
    sets = full_sets(found, shingle, percent)

    likely = staged(possible(stars, sets, percent))
    one_each = staged(likely.groupBy("node").agg(F.min("pivot").alias("pivot")).select("pivot", "node"))
    labels = staged(components(confirmed(one_each, sets, percent)))
    open_stars = staged(labelled(labelled(likely.join(one_each, ["pivot", "node"], "left_anti"), labels, "node", "x"), labels, "pivot", "y")
                        .filter("x <> y").select("pivot", "node"))
    if not open_stars.isEmpty():
        more = staged(confirmed(open_stars, sets, percent))
        between = labelled(labelled(more.select(F.col("a").alias("node"), F.col("b").alias("pivot")), labels, "node", "x"), labels, "pivot", "y")
        labels = relabelled(labels, between.select(F.col("x").alias("a"), F.col("y").alias("b")))
    failed = staged(labelled(labelled(stars, labels, "node", "x"), labels, "pivot", "y").filter("x <> y"))
    if not failed.isEmpty():
        labels = relabelled(labels, staged(hidden_links(meets, failed, labels, sets, percent)))

    linked = staged(labels.join(places, "node"))
    least = linked.groupBy("label").agg(F.min("_id").alias("component"))
    by_link = linked.join(least, "label").select("d1", "d2", "component")
    by_copy = copied.select("d1", "d2", F.col("least._id").alias("copy"))
    fate = by_link.join(by_copy, ["d1", "d2"], "full").select("d1", "d2", F.coalesce("component", "copy").alias("component"))
    return digests.join(staged(fate).hint("merge"), ["d1", "d2"], "left").select(
        F.col("_id.id").alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("component", "_id").getField("id").alias("component_id"))


SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + {SHINGLE} - 1], ' ') AS g
 FROM (SELECT doc_id, w, unnest(range(1, CASE WHEN len(w) = 0 THEN 1 ELSE greatest(len(w) - {SHINGLE} + 2, 2) END)) AS i FROM d)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
links AS MATERIALIZED (SELECT x, y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM sets a JOIN sets b
  ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2) JOIN sizes s ON x = s.doc_id JOIN sizes t ON y = t.doc_id
 WHERE 100 * shared >= {PERCENT} * (s.n + t.n - shared)),
reach(doc_id, other) AS (SELECT x, y FROM links UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON r.other = l.x),
least AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(l.other, d.doc_id)) AS component_id
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN least l USING (doc_id)"""


@query("op13_jaccard_join", sql=SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
