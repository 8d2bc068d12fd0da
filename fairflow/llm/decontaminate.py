"""Benchmark decontamination with an FM-index per shard of the training text.

Words are runs of digits, a-z (A-Z lower-cased) and characters beyond ASCII.  The test phrases are
the windows of ``WINDOW`` consecutive words of every benchmark item; an item of fewer words, but not
none, is one phrase.  A task indexes the documents of a shard: words become numbers, and the index
holds every stretch of words that occur in the benchmark and is as long as the shortest phrase (no
other stretch can hold a phrase).  All phrases are searched backward through the wavelet ranks of the
index, their positions read off sampled suffix positions, and the word ranges merged into spans.
Words are compared by two independent 64-bit hashes.

Documents are neither shuffled nor collected.  The benchmark is the stated query set: it is read in
blocks of at most ``BLOCK_ITEMS`` items and ``BLOCK_WORDS`` words (one longer item is a block of its
own), and each block is one pass over the shards, so what is sent to the tasks has a fixed bound.

Defined results.  NULL or empty text or text without words: no words, no hits, not contaminated.
Items with NULL or empty text are no phrases; items with a NULL id make hits but are not listed.
Repeated items and rows count each by itself; an id is listed once per document.  An empty benchmark
contaminates nothing.  Extra columns are kept and never read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import ALNUM, LOWER, covered, runs, text_blocks, word_hashes, word_spans
from .fm import FMIndex
from .register import query

WINDOW = 13
BLOCK_ITEMS = 100_000
BLOCK_WORDS = 1 << 20
SHARD_BYTES = 8 << 20
TEXT_BLOCK = 1 << 20

SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


class Phrases:
    """The test phrases of a block of items as rows of word numbers, by length."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        data, offsets = _lowered(pa.array([t for _, t in items], pa.string()))
        starts, ends, first = word_spans(data, offsets, ALNUM)
        hashes = word_hashes(data, starts, ends)
        checks = word_hashes(data, starts, ends, seed=7)
        self.vocabulary, index = np.unique(hashes, return_index=True)
        self.checks = checks[index]
        numbers = np.searchsorted(self.vocabulary, hashes) + 1
        owners: dict[bytes, set] = defaultdict(set)
        for k, (name, _) in enumerate(items):
            words = numbers[first[k]:first[k + 1]]
            for at in range(max(1, len(words) - window + 1) if len(words) else 0):
                owners[words[at:at + window].tobytes()].add(name)
        self.by_length: dict[int, tuple[np.ndarray, list[set]]] = {}
        grouped: dict[int, list] = defaultdict(list)
        for key, names in owners.items():
            grouped[len(key) // 8].append((np.frombuffer(key, np.int64), {n for n in names if n is not None}))
        for length, rows in grouped.items():
            self.by_length[length] = (np.array([r[0] for r in rows]), [r[1] for r in rows])
        self.shortest = min(self.by_length, default=0)

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Word numbers, 0 for words that the benchmark does not hold."""
        if not len(self.vocabulary):
            return np.zeros(len(starts), np.int64)
        hashes = word_hashes(data, starts, ends)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = np.flatnonzero(self.vocabulary[at] == hashes)
        same = word_hashes(data, starts[known], ends[known], seed=7) == self.checks[at[known]]
        out = np.zeros(len(hashes), np.int64)
        out[known[same]] = at[known[same]] + 1
        return out


def _lowered(column) -> tuple[np.ndarray, np.ndarray]:
    parts = [(d, o) for _, _, d, o in text_blocks(column, 1 << 62)]
    data, offsets = parts[0] if parts else (np.empty(0, np.uint8), np.zeros(1, np.int64))
    return LOWER[data], offsets


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list]:
    """Items in blocks of bounded size, read one partition at a time."""
    block, words = [], 0
    rows = benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    for name, text in rows.toLocalIterator():
        n = len(text or "") // 2 + 1  # no more words than this
        if block and (len(block) >= BLOCK_ITEMS or words + n > BLOCK_WORDS):
            yield block
            block, words = [], 0
        block.append((name, text))
        words += n
    if block:
        yield block


def _search_shard(phrases: Phrases, numbers: np.ndarray, first: np.ndarray) -> list[tuple[int, np.ndarray, list[set]]]:
    """(phrase length, word positions, item names) of all occurrences in a shard of documents."""
    # One place between documents keeps stretches apart.
    place = np.arange(len(numbers)) + np.repeat(np.arange(len(first) - 1), np.diff(first))
    inside = np.zeros(len(numbers) + len(first), bool)
    inside[place] = numbers > 0
    begin, end = runs(inside)
    long = end - begin >= phrases.shortest
    begin, end = begin[long], end[long]
    if not len(begin):
        return []
    symbols = np.zeros(len(inside), np.int64)
    symbols[place] = numbers
    sizes = end - begin + 1  # with the separator
    at = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    text = symbols[at]
    text[np.cumsum(sizes) - 1] = 0
    word_of = np.full(len(inside), -1)
    word_of[place] = np.arange(len(numbers))
    index = FMIndex(text, len(phrases.vocabulary) + 1)
    out = []
    for length, (rows, names) in phrases.by_length.items():
        found, low, high = index.search(rows)
        if len(found):
            n = high - low
            entries = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            positions = index.locate(entries)
            out.append((length, word_of[at[positions]], [names[k] for k in np.repeat(found, n)]))
    return out


def _scan(phrases: Phrases, text_col: str):
    """Adds what one block of phrases hits to the columns n_words, hits and items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("row").field(text_col).cast(pa.string())
            for a, b, raw, offsets in text_blocks(texts, SHARD_BYTES):
                parts, base_word, first = [], 0, [np.zeros(1, np.int64)]
                begins, stops = [], []
                # The shard's words are numbered piece by piece, so that temporary arrays stay small.
                piece_first = 0
                while piece_first < b - a:
                    piece_end = int(np.searchsorted(offsets, offsets[piece_first] + TEXT_BLOCK, "right")) - 1
                    piece_end = min(max(piece_end, piece_first + 1), b - a)
                    data = LOWER[raw[offsets[piece_first]:offsets[piece_end]]]
                    own = offsets[piece_first:piece_end + 1] - offsets[piece_first]
                    starts, ends, f = word_spans(data, own, ALNUM)
                    parts.append(phrases.numbers(data, starts, ends))
                    row = np.repeat(own[:-1], np.diff(f))
                    begins.append((starts - row).astype(np.int64))
                    stops.append((ends - row).astype(np.int64))
                    first.append(f[1:] + base_word)
                    base_word += len(starts)
                    piece_first = piece_end
                numbers, first = np.concatenate(parts), np.concatenate(first)
                begins, stops = np.concatenate(begins), np.concatenate(stops)
                hit = np.zeros(len(numbers), bool)
                items: dict[int, set] = defaultdict(set)
                for length, words, names in _search_shard(phrases, numbers, first):
                    hit |= covered(words, length, len(hit))
                    for doc, name in zip((np.searchsorted(first, words, "right") - 1).tolist(), names):
                        items[doc] |= name
                hits, listed = [], []
                old_hits, old_items = (batch.column(c).slice(a, b - a).to_pylist() for c in ("hits", "items"))
                touched = np.zeros(b - a, bool)
                touched[np.searchsorted(first, np.flatnonzero(hit), "right") - 1] = True
                spans = []
                for doc in range(b - a):
                    if not touched[doc] and not old_hits[doc]:
                        hits.append([])
                        spans.append([])
                        listed.append(old_items[doc] or [])
                        continue
                    own = hit[first[doc]:first[doc + 1]].copy()
                    for h in old_hits[doc] or []:
                        own[h["start"]:h["end"]] = True
                    x, y = runs(own)
                    hits.append([{"start": int(i), "end": int(j)} for i, j in zip(x, y)])
                    at = first[doc]
                    spans.append([{"start": int(begins[at + i]), "end": int(stops[at + j - 1])} for i, j in zip(x, y)])
                    listed.append(sorted({*(old_items[doc] or []), *items.get(doc, ())}))
                pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([
                    batch.column("row").slice(a, b - a), pa.array(np.diff(first), pa.int64()), pa.array(hits, pair),
                    pa.array(spans, pair), pa.array(listed, pa.list_(pa.string())),
                ], ["row", "n_words", "hits", "spans", "items"])

    return run


def find_hits(documents: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
              item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``row`` (the document as a struct), ``n_words``, ``hits`` (word ranges), ``spans`` (the same as
    ranges of UTF-8 bytes), ``items`` (ids of the items that occur, sorted)."""
    row = T.StructType([T.StructField(f.name, f.dataType, True) for f in documents.schema.fields])
    schema = T.StructType([T.StructField("row", row), T.StructField("n_words", T.LongType()),
                           T.StructField("hits", SPAN), T.StructField("spans", SPAN),
                           T.StructField("items", T.ArrayType(T.StringType()))])
    out = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), F.lit(None).cast(SPAN).alias("hits"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    # Without items one pass with no phrase still counts the words.
    blocks = list(map(lambda b: Phrases(b, window), benchmark_blocks(benchmark, item_col, item_text_col)))
    for phrases in blocks or [Phrases([("", "")], window)]:
        out = out.select("row", "hits", "items").mapInArrow(_scan(phrases, text_col), schema)
    return out


def contamination(hits: DataFrame) -> DataFrame:
    """Adds n_hit, n_items, items_sha256 and contaminated: a twentieth of the words or more are hit."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return hits.withColumns({
        "n_hit": n_hit,
        "n_items": F.size("items").cast("long"),
        "items_sha256": F.sha2(F.array_join("items", ","), 256),
    }).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def cut_spans(text: str | F.Column, spans: str | F.Column) -> F.Column:
    """The text without the given byte ranges, each cut leaving one blank."""
    raw = F.encode(text, "UTF-8")
    start = F.transform(spans, lambda s: s["start"])
    begin = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["end"]))
    end = F.concat(start, F.array(F.octet_length(text).cast("long")))
    piece = F.transform(F.arrays_zip(begin.alias("b"), end.alias("e")), lambda r: F.decode(
        F.substring(raw, (r["b"] + 1).cast("int"), (r["e"] - r["b"]).cast("int")), "UTF-8"))
    return F.when(F.size(spans) > 0, F.array_join(piece, " ")).otherwise(F.col(text) if isinstance(text, str) else text)


def decontaminate(documents: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """Documents that are not contaminated, in their own columns; passages of the benchmark that are
    too short a part to reject the document are cut out."""
    found = contamination(find_hits(documents, benchmark, text_col)).filter(~F.col("contaminated"))
    text = F.col("row").getField(text_col)
    return found.withColumn("_text", cut_spans(text, F.col("spans"))).select(*[
        (F.col("_text") if c == text_col else F.col("row").getField(c)).alias(c) for c in documents.columns
    ])


def _words_sql(column: str) -> str:
    lowered = f"translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({lowered}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


SQL = f"""
WITH d AS (SELECT doc_id, {_words_sql('text')} AS w FROM documents),
items AS (SELECT item_id, w, least({WINDOW}, len(w)) AS n FROM (SELECT item_id, {_words_sql('text')} AS w FROM benchmark) WHERE len(w) > 0),
phrases AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
 FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM items)),
windows AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
 FROM (SELECT doc_id, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS i FROM d, (SELECT DISTINCT n FROM items))),
found AS (SELECT doc_id, i, w.n, item_id FROM windows w JOIN phrases p ON w.n = p.n AND w.g = p.g),
hit AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM found, range(0, {WINDOW}) t(k) WHERE k < n GROUP BY 1),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
 FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
 sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)"""


@query("op6_decontamination", sql=SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(find_hits(documents, benchmark)).select(
        "row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
