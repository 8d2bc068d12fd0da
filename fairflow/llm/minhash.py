"""MinHash near-dedup: circulant signatures, banding, exact Jaccard verification.

A document's set are its distinct shingles of ``shingle`` words (words are runs of characters other
than space and 0x09-0x0D, A-Z lower-cased); a shorter text with words is one shingle.  Two documents
are linked when 100 * |intersection| >= ``percent`` * |union|.

1. *Signatures.*  Two permutations of the 64-bit numbers generate all coordinates: the first scatters
   the shingles, the second is shifted circularly by k places for coordinate k.  ``BANDS`` bands of
   ``ROWS`` coordinates make a link at the threshold meet with probability 0.99998.
2. *Classes.*  Documents with equal sets (128-bit digest) are one node, whatever their number.  Half the digest numbers
   the node; sets that differ in the other half get other numbers.
3. *Stars.*  In every band bucket each node is compared with the least node of the bucket: on sketches that can
   exclude a link for certain (`families`), and what is left on the full sets.  Links are contracted to components.
4. *The rest.*  A bucket with a star that failed may hold links between its other nodes.  These are compared
   block against block in tasks, bucket by bucket or all nodes of overlapping buckets at once, whichever is less
   work (`families.hidden_links`): a long chain of overlapping buckets stays as cheap as its buckets.  Only pairs
   that sketches do not exclude become rows, and are confirmed on the full sets.  No bucket is capped.
5. Components over all links; the smallest id of each is its document to keep.

Defined results.  NULL or empty text or no word: empty set, linked with nothing, its own component.
Repeated rows link like copies; rows of one id share its fate only if they are linked.  A NULL id is
larger than any other: a component of such rows alone has a NULL id and all are kept.  Other columns
are ignored by `near_duplicates` and passed on by `keep_one`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import may_match
from . import repeats
from .common import mix, text_blocks
from .components import components
from .families import NAMED_BITS, confirmed, full_sets, hidden_links, labelled, possible, relabelled, shingle_sets
from .register import query
from .staging import staged

SHINGLE, PERCENT = 2, 80
BANDS, ROWS = 28, 5

_SHIFT = np.uint64(0xD1B54A32D192ED03)
_OUTER = np.uint64(0x8CB92BA72F3D8DD7)


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One row of coordinates per (not empty) set."""
    begin = np.cumsum([0] + [len(s) for s in sets[:-1]])
    scattered = mix(np.concatenate(sets) ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    out = np.empty((coordinates, len(sets)), np.uint64)
    work, high = np.empty_like(scattered), np.empty_like(scattered)
    for k in range(coordinates):
        np.subtract(scattered, np.uint64(k), out=work)  # the shift, modulo 2**64
        np.multiply(work, _SHIFT, out=work)
        np.right_shift(work, np.uint64(32), out=high)
        np.bitwise_xor(work, high, out=work)
        np.multiply(work, _OUTER, out=work)
        np.minimum.reduceat(work, begin, out=out[k])
    return out.T


def _sign(shingle: int, bands: int, rows: int, number_bits: int = 64):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column("text"), repeats.BLOCK_BYTES):
                sets = shingle_sets(data, offsets, shingle)
                full = [k for k, s in enumerate(sets) if len(s)]
                node, check, keys = [None] * (b - a), [None] * (b - a), [None] * (b - a)
                if full:
                    signature = signatures([sets[k] for k in full], bands * rows)
                    folded = np.zeros((len(full), bands), np.uint64)
                    for r in range(rows):
                        folded = mix(folded + signature[:, r::rows])
                    folded = mix(folded ^ np.arange(bands, dtype=np.uint64))
                    for k, row in zip(full, folded.view(np.int64)):
                        digest = hashlib.blake2b(sets[k].tobytes(), digest_size=16).digest()
                        node[k] = int.from_bytes(digest[:8], "little", signed=True) >> (64 - number_bits)
                        check[k] = int.from_bytes(digest[8:], "little", signed=True)
                        keys[k] = row
                yield pa.RecordBatch.from_arrays([
                    batch.column("_id").slice(a, b - a), batch.column("_row").slice(a, b - a),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array(node, pa.int64()),
                    pa.array(check, pa.int64()), pa.array(keys, pa.list_(pa.int64())),
                ], ["_id", "_row", "n", "node", "check", "bands"])
    return run


def _distinct_sets(signed: DataFrame) -> DataFrame:
    """Each set once, with the least row that has it, and whether another set has its number too."""
    return staged(signed.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("_id").alias("least"), F.min_by("_row", F.struct("_id", "_row")).alias("row"), F.min("check").alias("check"),
        F.any_value("bands").alias("bands"), (F.min("check") != F.max("check")).alias("clash")))


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, number_bits: int = 64) -> DataFrame:
    """_id, _row (key of the text), n_shingles, component (``repeats.NO_ID`` for NULL) per row."""
    texts = repeats.keyed(documents, id_col, text_col).select("_id", "_row", "text")
    signed = staged(texts.mapInArrow(
        _sign(shingle, bands, rows, number_bits), "_id long, _row long, n long, node long, check long, bands array<long>"))
    nodes, turn = _distinct_sets(signed), 0
    while not nodes.filter("clash").isEmpty():
        # Different sets with one number: all but the one of the least check get another number.
        turn += 1
        twins = nodes.filter("clash").select("node", F.col("check").alias("_least"))
        other = F.when(F.col("check") != F.col("_least"), F.xxhash64("node", "check", F.lit(turn))).otherwise(F.col("node"))
        signed = staged(signed.join(twins, "node", "left").withColumn("node", other).drop("_least"))
        nodes = _distinct_sets(signed)
    keys = nodes.select("node", F.explode("bands").alias("key"))
    pivots = keys.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last"))
    buckets = staged(keys.join(pivots.filter("pivot <> last").select("key", "pivot"), "key"))
    meets = buckets.filter("node <> pivot").select(F.col("key").alias("run"), "pivot", "node")
    stars = staged(meets.select("pivot", "node").distinct())

    wanted = buckets.select("node").distinct().join(nodes.select("node", "least", "row"), "node")
    wanted = staged(wanted.select("node", F.col("least").alias("_id"), F.col("row").alias("_row")))
    # Repeated rows give one node once.
    found = may_match(texts, wanted, ["_id", "_row"], NAMED_BITS).join(wanted.hint("merge"), ["_id", "_row"]).dropDuplicates(["_id", "_row"]).select("node", "text")
    sets = full_sets(found, shingle, percent)

    labels = staged(components(confirmed(staged(possible(stars, sets, percent)), sets, percent)))
    failed = staged(labelled(labelled(stars, labels, "node", "x"), labels, "pivot", "y").filter("x <> y"))
    if not failed.isEmpty():
        labels = relabelled(labels, staged(hidden_links(meets, failed, labels, sets, percent)))
    placed = staged(labels.join(nodes.select("node", "least"), "node"))
    least = placed.groupBy("label").agg(F.min("least").alias("component"))
    of_node = nodes.select("node", "least").join(
        placed.join(least, "label").select("node", "component"), "node", "left")
    of_node = of_node.select("node", F.coalesce("component", "least").alias("component"))
    return signed.select("_id", "_row", "n", "node").join(of_node, "node", "left").select(
        "_id", "_row", F.col("n").alias("n_shingles"), F.coalesce("component", "_id").alias("component"))


def _id_of(column: str):
    return F.when(F.col(column) != repeats.NO_ID, F.col(column))


def keep_one(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with the smallest id of each component, in their own columns; repeated rows once.

    Only rows that may go are shuffled with their texts."""
    found = staged(near_duplicates(documents, id_col, text_col, **options))
    per_key = found.groupBy("_id", "_row").agg(F.min("component").alias("component"), F.count(F.lit(1)).alias("times"))
    going = staged(per_key.filter("component <> _id OR times > 1"))
    whole = documents.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(repeats.NO_ID)).alias("_id"),
        F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("_row"),
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    some, none = repeats.split(whole, going)
    checked = some.join(going.hint("merge"), ["_id", "_row"], "left").filter(
        F.coalesce(F.col("component") == F.col("_id"), F.lit(True)))
    once = checked.withColumn("_turn", F.when(F.col("times") > 1, F.row_number().over(
        Window.partitionBy("_id", "_row").orderBy(F.lit(1)))).otherwise(1)).filter("_turn = 1")
    kept = once.select("row").unionByName(none.select("row"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in documents.columns])


SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS g
 FROM (SELECT doc_id, w, unnest(range(1, CASE WHEN len(w) = 1 THEN 2 ELSE greatest(len(w), 1) END)) AS i FROM d)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
links AS MATERIALIZED (SELECT x, y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM sets a JOIN sets b
  ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2) JOIN sizes s ON x = s.doc_id JOIN sizes t ON y = t.doc_id
 WHERE 100 * shared >= {PERCENT} * (s.n + t.n - shared)),
reach(doc_id, other) AS (SELECT x, y FROM links UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON r.other = l.x),
least AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(l.other, d.doc_id)) AS component_id,
 coalesce(l.other >= d.doc_id, true) AS kept
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN least l USING (doc_id)"""


@query("op8_minhash_dedup", sql=SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(documents).select(
        _id_of("_id").alias("doc_id"), "n_shingles", _id_of("component").alias("component_id"),
        (F.col("_id") == F.col("component")).alias("kept"))
