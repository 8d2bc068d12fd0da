"""Quality rules: adaptive thresholds from mergeable quantile sketches per language and source.

Each document gets a few counts; each count becomes an integer measure.  Per (language, source) a
quantile sketch of every measure is kept: numbers below 128 as they are, larger ones with their
leading seven bits, and how many documents fall on each.  Sketches merge by adding counts, so tasks,
groups and levels combine in any order with the same result, and a quantile is off by 1/64 at most.
Measures are compared to thresholds at that resolution.
All thresholds are quantiles of these sketches, and move with their group (``MEASURES``):

* word length and symbols fail beyond a fence, the upper quartile plus ``FENCE`` times its distance to the lower one (word
  length, which also fails that far below the lower quartile) or to the median (symbols, of which most documents have none);
  where the distance is nothing, one step of the measure stands for it;
* repeated lines and words, which ordinary documents have too, fail above the quantile of 99 in 100: the
  rarest hundredth of the group.

Groups of fewer than ``MIN_ROWS`` documents take the
merged sketch of their language, or of all documents.  The thresholds join the documents by group.

Words are runs of characters other than space and 0x09-0x0D.

Defined results.  NULL or empty text or one without words: all counts 0, base_failed, not kept.  NULL
languages and sources are groups of their own.  Repeated rows count and are judged each.  Extra columns
are passed on by `quality_filter`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from .common import SPACES, byte_values, covered, mix, prefix_hashes, range_hashes, text_blocks, window_hashes, windows_inside, word_hashes, word_spans
from .register import query
from .staging import staged

MIN_WORDS = 50
MIN_ROWS = 100
FENCE = 3
BLOCK_BYTES = 1 << 20

COUNTS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

#: measure: (integer expression, level of the upper quantile and of the one it is compared to, in hundredths, times
#: their distance, whether small values fail too)
MEASURES = {
    "word_length": ("100 * word_chars div n_words", 75, 25, FENCE, True),
    "symbols": ("100 * n_symbols div word_chars", 75, 50, FENCE, False),
    "dup_lines": ("10000 * n_dup_lines div n_lines", 99, 50, 0, False),
    "repeat_words": ("10000 * n_repeat_words div n_words", 99, 50, 0, False),
}


def count_block(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The columns of COUNTS for a block of texts."""
    rows = len(offsets) - 1
    starts, ends, first = word_spans(data, offsets, SPACES)
    n_words = np.diff(first)

    def per_row(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(flags)))[offsets])

    word_chars = per_row(SPACES[data] & ((data & 0xC0) != 0x80))
    symbols = per_row(SYMBOLS[data])
    row_salt = mix(np.arange(rows, dtype=np.uint64) + np.uint64(1))

    # Lines end at \n or with their text.
    breaks = np.flatnonzero(data == 0x0A)
    line_starts = np.unique(np.concatenate((offsets[:-1][n_words > 0], breaks + 1)))
    line_ends = np.minimum(np.append(line_starts[1:], len(data)), len(data))
    of = np.searchsorted(offsets, line_starts, "right") - 1
    inside = of < rows
    line_starts, line_ends, of = line_starts[inside], line_ends[inside], of[inside]
    line_ends = np.minimum(line_ends, offsets[of + 1])
    at_break = (line_ends > line_starts) & (data[np.maximum(line_ends, 1) - 1] == 0x0A) if len(data) else np.zeros(0, bool)
    line_ends = line_ends - at_break
    with_word = np.searchsorted(starts, line_starts) < np.searchsorted(starts, line_ends)
    line_starts, line_ends, of = line_starts[with_word], line_ends[with_word], of[with_word]
    lines = range_hashes(prefix_hashes(byte_values(5)[data]), line_starts, line_ends)
    lines = mix(lines ^ (line_ends - line_starts).astype(np.uint64)) ^ row_salt[of]
    n_lines = np.bincount(of, minlength=rows)
    distinct = np.bincount(of[np.unique(lines, return_index=True)[1]], minlength=rows)

    at = windows_inside(first, 3)
    trigrams = window_hashes(word_hashes(data, starts, ends), 3)
    repeats = np.zeros(rows, np.int64)
    if len(at):
        keys = trigrams[at] ^ row_salt[np.searchsorted(first, at, "right") - 1]
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        again = np.zeros(len(at), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        words = covered(at[again], 3, len(starts))
        repeats = np.diff(np.concatenate(([0], np.cumsum(words)))[first])
    return [n_words, word_chars, symbols, n_lines, n_lines - distinct, repeats]


def count_texts(documents: DataFrame, text_col: str, carried: list[str]) -> DataFrame:
    """``row`` (the carried columns as a struct) and the columns of COUNTS."""
    held = documents.select(F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"),
                            F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column("text"), BLOCK_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(a, b - a)]
                    + [pa.array(x, pa.int64()) for x in count_block(data, offsets)],
                    ["row", *[c.split()[0] for c in COUNTS.split(", ")]])

    counts = [T.StructField(c.split()[0], T.LongType()) for c in COUNTS.split(", ")]
    return held.mapInArrow(run, T.StructType([held.schema["row"], *counts]))


def sketch_point(value: str) -> Column:
    """Where a number stands in a sketch: the number with its leading seven bits."""
    return F.expr(f"CASE WHEN {value} < 128 THEN {value} ELSE shiftleft(shiftright({value}, "
                  f"length(bin({value})) - 7), length(bin({value})) - 7) END")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def sketches(counts: DataFrame) -> DataFrame:
    """(lang, source, measure, point, n) over documents that pass the base rules."""
    values = F.array(*[F.struct(F.lit(m).alias("measure"), F.expr(e).cast("long").alias("value"))
                       for m, (e, *_) in MEASURES.items()])
    return (counts.filter(~base_failed()).select("lang", "source", F.inline(values))
            .withColumn("point", sketch_point("value"))
            .groupBy("lang", "source", "measure", "point").agg(F.count(F.lit(1)).alias("n")))


def quantiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """rows and the quantiles ``low`` and ``high`` of each group and measure, from merged sketches (some
    thousand points at most)."""
    merged = sketch.groupBy(*by, "measure", "point").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "measure")
    ranked = merged.withColumns({"upto": F.sum("n").over(group.orderBy("point")), "rows": F.sum("n").over(group)})
    levels = F.create_map(*[F.lit(x) for m, (_, high, low, *_) in MEASURES.items() for x in (f"{m} high", high, f"{m} low", low)])

    def at(which: str) -> Column:
        level = levels[F.concat("measure", F.lit(f" {which}"))]
        return F.min(F.when(100 * F.col("upto") >= level * F.col("rows"), F.col("point"))).alias(which)

    return ranked.groupBy(*by, "measure").agg(F.max("rows").alias("rows"), at("low"), at("high"))


def thresholds(counts: DataFrame) -> DataFrame:
    """(lang, source, measure -> lowest and highest passing value) of every group, as one row each."""
    sketch = staged(sketches(counts))
    own = quantiles(sketch, ["lang", "source"])
    language, everything = quantiles(sketch, ["lang"]), quantiles(sketch, [])
    up = lambda df, mark: df.select(*[F.col(c).alias(f"{mark}_{c}") for c in df.columns])
    joined = (own.join(up(language, "l"), F.col("lang").eqNullSafe(F.col("l_lang"))
                       & (F.col("measure") == F.col("l_measure")))
              .join(up(everything, "e"), F.col("measure") == F.col("e_measure")))

    def level(c: str) -> Column:
        return (F.when(F.col("rows") >= MIN_ROWS, F.col(c))
                .when(F.col("l_rows") >= MIN_ROWS, F.col(f"l_{c}")).otherwise(F.col(f"e_{c}")))

    fenced = joined.select("lang", "source", "measure", level("low").alias("low"), level("high").alias("high"))
    columns = []
    for m, (_, _, _, times, both) in MEASURES.items():
        here = F.col("measure") == m
        reach = times * F.greatest(F.col("high") - F.col("low"), F.lit(1))
        columns.append(F.max(F.when(here, F.col("high") + reach)).alias(f"{m}_high"))
        if both:
            columns.append(F.max(F.when(here, F.col("low") - reach)).alias(f"{m}_low"))
    return fenced.groupBy("lang", "source").agg(*columns)


def judge(counts: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds base_failed and kept."""
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = counts.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    passes = F.lit(True)
    for m, (expression, *_, both) in MEASURES.items():
        value = sketch_point(f"({expression})")
        passes = passes & (value <= F.col(f"{m}_high"))
        if both:
            passes = passes & (value >= F.col(f"{m}_low"))
    joined = joined.withColumn("base_failed", base_failed())
    kept = F.when(F.col("base_failed"), False).otherwise(F.coalesce(passes, F.lit(True)))
    return joined.withColumn("kept", kept).drop("_lang", "_source")


def _counted(documents: DataFrame, text_col: str, lang_col: str, source_col: str, carried: list[str]) -> DataFrame:
    counted = count_texts(documents, text_col, carried)
    row = F.col("row")
    return counted.withColumns({"lang": row.getField(lang_col).cast("string"),
                                "source": row.getField(source_col).cast("string")})


def quality(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            source_col: str = "source") -> DataFrame:
    """The id, the counts, base_failed and kept of every document.  Texts are read once."""
    carried = list(dict.fromkeys([id_col, lang_col, source_col]))
    counts = _counted(documents, text_col, lang_col, source_col, carried)
    counts = staged(counts.withColumn("doc_id", F.col("row").getField(id_col)).drop("row"))
    return judge(counts, thresholds(counts)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def quality_filter(documents: DataFrame, text_col: str = "text", lang_col: str = "lang",
                   source_col: str = "source") -> DataFrame:
    """The kept documents in their own columns.  Texts are counted twice rather than shuffled."""
    limits = thresholds(_counted(documents, text_col, lang_col, source_col, list(dict.fromkeys([lang_col, source_col]))))
    judged = judge(_counted(documents, text_col, lang_col, source_col, documents.columns), limits).filter("kept")
    return judged.select(*[F.col("row").getField(c).alias(c) for c in documents.columns])


def _level_sql(name: str, by: str) -> str:
    """Quantiles of merged sketches."""
    keys = f"{by}, measure" if by else "measure"
    return f"""{name} AS (SELECT {keys}, max(total) AS rows,
 min(point) FILTER (100 * upto >= CASE measure WHEN 'word_length' THEN 25 ELSE 50 END * total) AS low,
 min(point) FILTER (100 * upto >= CASE WHEN measure IN ('word_length', 'symbols') THEN 75 ELSE 99 END * total) AS high
 FROM (SELECT *, sum(n) OVER (PARTITION BY {keys} ORDER BY point) AS upto,
 sum(n) OVER (PARTITION BY {keys}) AS total FROM (SELECT {keys}, point, sum(n) AS n FROM sketch GROUP BY ALL)) GROUP BY ALL)"""


def _sql() -> str:
    return f"""
WITH d AS MATERIALIZED (SELECT doc_id, lang, source, coalesce(text, '') AS t,
 regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
grams AS (SELECT doc_id, i, w[i:i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM d)),
again AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS times FROM grams),
 range(0, 3) r(k) WHERE times > 1 GROUP BY 1),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup
 FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY 1),
counts AS MATERIALIZED (SELECT doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
 (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(n_lines, 0)::BIGINT AS n_lines,
 coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
 FROM d LEFT JOIN again USING (doc_id) LEFT JOIN lines USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts),
good AS (SELECT * FROM judged WHERE NOT base_failed),
measured AS MATERIALIZED (SELECT doc_id, lang, source, measure, CASE WHEN v < 128 THEN v
 ELSE (v >> (len(bin(v)) - 7)::INTEGER) << (len(bin(v)) - 7)::INTEGER END AS v FROM (SELECT doc_id, lang, source, unnest(['word_length', 'symbols', 'dup_lines', 'repeat_words']) AS measure,
 unnest([100 * word_chars // n_words, 100 * n_symbols // word_chars, 10000 * n_dup_lines // n_lines, 10000 * n_repeat_words // n_words])
 AS v FROM good)),
sketch AS MATERIALIZED (SELECT lang, source, measure, v AS point, count(*) AS n FROM measured GROUP BY ALL),
{_level_sql("own", "lang, source")},
{_level_sql("language", "lang")},
{_level_sql("everything", "")},
fences AS (SELECT o.lang, o.source, o.measure,
 CASE WHEN o.rows >= 100 THEN o.low WHEN l.rows >= 100 THEN l.low ELSE e.low END AS low,
 CASE WHEN o.rows >= 100 THEN o.high WHEN l.rows >= 100 THEN l.high ELSE e.high END AS high
 FROM own o JOIN language l ON o.lang IS NOT DISTINCT FROM l.lang AND o.measure = l.measure JOIN everything e ON o.measure = e.measure),
passed AS (SELECT m.doc_id, bool_and(CASE m.measure WHEN 'word_length' THEN v BETWEEN low - 3 * greatest(high - low, 1)
  AND high + 3 * greatest(high - low, 1) WHEN 'symbols' THEN v <= high + 3 * greatest(high - low, 1) ELSE v <= high END) AS ok FROM measured m JOIN fences f
 ON m.lang IS NOT DISTINCT FROM f.lang AND m.source IS NOT DISTINCT FROM f.source AND m.measure = f.measure GROUP BY 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(ok, false) AS kept
FROM judged LEFT JOIN passed USING (doc_id)"""


@query("op9_quality_rules", sql=_sql())
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
