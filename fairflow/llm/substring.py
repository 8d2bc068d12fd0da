"""Substring dedup: Rabin-Karp hashes of every fixed-length word window, counted in Spark.

Words are runs of characters other than space and 0x09-0x0D.  Every window of ``length`` consecutive
words of every document is hashed; the hashes are dealt to buckets by their leading bits and counted
there (`repeats`).  A window whose hash also starts in a document with a smaller id is repeated; the
repeated windows of a document merge into maximal intervals, whose words are removed.

Hashes have 64 bits over 64-bit word hashes with random byte values: two given different windows
agree with a chance of about 2**-64.

Defined results.  NULL or empty text, or one without a word: no words, nothing removed, the hash of
the empty string.  Fewer words than a window: nothing removed.  A NULL id counts as larger than any
other and keeps its row.  Rows with one id are one document's rows: none of them is smaller than
another, so neither loses words to the other.  Columns other than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import repeats
from .common import SPACES, covered, runs, text_blocks, unpack_sorted, window_hashes, windows_inside, word_hashes, word_spans
from .register import query

WINDOW = 13
BATCH_WINDOWS = 1 << 20
BUCKET_BYTES = 16 << 20

RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, n_spans long, kept string"


def _positions(length: int):
    def positions(data: np.ndarray, offsets: np.ndarray):
        starts, ends, first = word_spans(data, offsets, SPACES)
        hashes = window_hashes(word_hashes(data, starts, ends), length)
        at = windows_inside(first, length)
        return hashes[at], at, first
    return positions


def repeated_windows(rows: DataFrame, length: int = WINDOW) -> DataFrame:
    """Per document with repeated windows, the packed numbers of their first words."""
    bits = repeats.bucket_bits(repeats.text_bytes(rows), BUCKET_BYTES)
    sent = repeats.send(rows, _positions(length), bits, BATCH_WINDOWS, owners=True)
    return repeats.gather(repeats.count(sent, smaller_id=True))


def remove_repeated(documents: DataFrame, length: int = WINDOW, id_col: str = "doc_id",
                    text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, n_spans (removed intervals) and the kept text."""
    rows = repeats.keyed(documents, id_col, text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column("doc_id"), batch.column("marks")
            for a, b, data, offsets in text_blocks(batch.column("text"), repeats.BLOCK_BYTES):
                starts, ends, first = word_spans(data, offsets, SPACES)
                n = np.diff(first)
                removed, spans = np.zeros(b - a, np.int64), np.zeros(b - a, np.int64)
                select = SPACES[data]
                limit = np.repeat(offsets[1:], n)
                select[ends[ends < limit]] = True
                if marks.null_count < len(marks):
                    for row in range(a, b):
                        mark = marks[row].as_py()
                        if mark is None:
                            continue
                        gone = covered(unpack_sorted(mark).astype(np.int64), length, int(n[row - a]))
                        from_, to = runs(gone)
                        removed[row - a], spans[row - a] = gone.sum(), len(from_)
                        base = first[row - a]
                        for x, y in zip(from_ + base, to + base):
                            select[starts[x]:min(ends[y - 1] + 1, offsets[row - a + 1])] = False
                text = np.where(SPACES[data], data, np.uint8(0x20))[select]
                cuts = np.concatenate(([0], np.cumsum(select)))[offsets] if len(data) else offsets
                hashes, kept = [], []
                for x, y in zip(cuts[:-1], cuts[1:]):
                    piece = text[x:y - 1] if y > x and text[y - 1] == 0x20 else text[x:y]
                    piece = piece.tobytes()
                    hashes.append(hashlib.sha256(piece).hexdigest())
                    kept.append(piece.decode("utf-8") if keep_text else None)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(a, b - a), pa.array(n, pa.int64()), pa.array(removed), pa.array(hashes, pa.string()),
                    pa.array(spans), pa.array(kept, pa.string()),
                ], ["doc_id", "n_words", "n_removed", "kept_sha256", "n_spans", "kept"])

    marked = repeated_windows(rows, length)
    return repeats.with_marks(rows, marked).select("doc_id", "text", "marks").mapInArrow(cut, RESULT)


SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d),
windows AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + {WINDOW - 1}), ' ') AS g
 FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {WINDOW - 2}, 1))) AS i FROM d)),
firsts AS (SELECT g, min(doc_id) AS least FROM windows GROUP BY g),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM windows JOIN firsts USING (g), range(0, {WINDOW}) t(k) WHERE least < doc_id),
removed AS (SELECT doc_id, count(*) AS n, count(*) FILTER (fresh) AS spans
 FROM (SELECT doc_id, coalesce(p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <> 1, true) AS fresh FROM gone) GROUP BY 1),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256,
 coalesce(spans, 0)::BIGINT AS n_spans
FROM d LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)"""


@query("op10_substring_dedup", sql=SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeated(documents, keep_text=False).drop("kept")
