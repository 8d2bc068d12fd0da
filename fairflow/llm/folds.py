"""The held-out fold of labelled rows, and bounded training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

FOLDS = 5


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves no remainder by ``FOLDS``; a NULL id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def sample_per_class(rows: DataFrame, label_col: str, id_col: str, most: int) -> DataFrame:
    """At most ``most`` rows of each label, chosen by a hash of the id.

    Labels are counted first, so that a task keeps little more than is wanted of a frequent one."""
    counts = rows.groupBy(label_col).agg(F.count(F.lit(1)).alias("_rows"))
    chance = F.pmod(F.xxhash64(F.col(id_col), F.lit(17)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # One row per class of a classifier.
    thinned = (rows.join(F.broadcast(counts), label_col).withColumn("_chance", chance)
               .filter(F.col("_chance") * F.col("_rows") < 2 * most + 50))
    order = Window.partitionBy(label_col).orderBy("_chance", id_col)
    return thinned.withColumn("_turn", F.row_number().over(order)).filter(F.col("_turn") <= most).drop(
        "_rows", "_chance", "_turn")
