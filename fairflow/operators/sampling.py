"""Sampling and splitting with hash-derived numbers instead of a random generator."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.calendar import day_of
from ..functions.hashing import uniform
from ..session import size_checked


def hash_sample(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 42,
                method: str = "md5") -> DataFrame:
    """Bernoulli sample: every row is kept with probability ``fraction``."""
    return df.filter(uniform(keys, seed, method) < fraction)


def class_fractions(df: DataFrame, label: str, max_imbalance: float = 10) -> DataFrame:
    """Count and keep fraction per class, so that no class exceeds ``max_imbalance``
    times the smallest one."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(label).alias("count"))
    smallest = counts.agg(F.min("count")).scalar()
    return counts.withColumn(
        "fraction", F.least(F.lit(1.0), smallest * F.lit(float(max_imbalance)) / F.col("count"))
    )


def stratified_balance(df: DataFrame, label: str, keys: Sequence[str],
                       max_imbalance: float = 10, seed: int = 42, method: str = "md5") -> DataFrame:
    """Down-sample the large classes; rows without a label are left out."""
    fractions = size_checked(class_fractions(df, label, max_imbalance).drop("count"))
    return (
        df.join(fractions, label)
        .filter(uniform(keys, seed, method) < F.col("fraction"))
        .select(*df.columns)
    )


def date_split(df: DataFrame, time: str, train: float = 0.6, validate: float = 0.2,
               out: str = "dataset") -> DataFrame:
    """Tag rows ``train``, ``validate`` or ``test`` by position of their day in the
    ordered list of distinct days.

    The list is one row of distinct days, so it is bounded by the calendar; the two
    cut-off days enter the plan as a scalar subquery and nothing is collected.
    Positions are rounded half to even and clamped to the last day.
    """
    days = df.agg(F.array_sort(F.collect_set(day_of(F.col(time)))).alias("days"))

    def position(share: float):
        n = F.size("days")
        return F.least(F.bround(n * F.lit(share)).cast("int"), n - 1)

    cuts = days.select(
        F.struct(
            F.get("days", position(train)).alias("train"),
            F.get("days", position(train + validate)).alias("validate"),
        )
    ).scalar()
    return df.withColumn("_cuts", cuts).withColumn(
        out,
        F.when(F.col(time) < F.col("_cuts.train"), "train")
        .when(F.col(time) < F.col("_cuts.validate"), "validate")
        .otherwise("test"),
    ).drop("_cuts")


def random_split(df: DataFrame, keys: Sequence[str], weights: Mapping[str, float],
                 seed: int = 1, out: str = "dataset", method: str = "md5") -> DataFrame:
    """Tag rows with the names in ``weights`` in proportion to them."""
    names, total = list(weights), sum(weights.values())
    draw = uniform(keys, seed, method)
    bound, tag = 0.0, None
    for name in names[:-1]:
        bound += weights[name] / total
        tag = F.when(draw < bound, name) if tag is None else tag.when(draw < bound, name)
    return df.withColumn(out, F.lit(names[0]) if tag is None else tag.otherwise(names[-1]))


# Slices of [0, 1) that the exact split counts; one slice per class is looked at row by row.
SLICES = 1 << 20


def stratified_split(df: DataFrame, label: str, keys: Sequence[str], test: float = 0.2,
                     exact: bool = False, seed: int = 15, out: str = "dataset",
                     method: str = "md5") -> DataFrame:
    """Tag a share ``test`` of every class ``test`` and the rest ``train``.

    The default is a projection and meets the share up to sampling noise.  ``exact`` takes
    the ``round(rows * test)`` rows of each class with the smallest draw: counts per slice of
    draws find the slice of the last such row, only that slice is ranked, and the rows are
    then compared with their class's last row.  They are read three times, never sorted.
    """
    drawn = df.withColumn("_draw", uniform(keys, seed, method))
    if not exact:
        chosen = F.col("_draw") < test
        return drawn.withColumn(out, F.when(chosen, "test").otherwise("train")).drop("_draw")
    sliced = drawn.withColumn("_slice", F.floor(F.col("_draw") * SLICES))
    group = Window.partitionBy("_class")
    upto = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    counts = sliced.groupBy(F.col(label).alias("_class"), "_slice").agg(F.count(F.lit(1)).alias("_n"))
    cuts = size_checked(
        counts.withColumns({
            "_wanted": F.round(F.sum("_n").over(group) * F.lit(test)), "_upto": F.sum("_n").over(upto),
        })
        .filter((F.col("_upto") >= F.col("_wanted")) & (F.col("_upto") - F.col("_n") < F.col("_wanted")))
        .select("_class", F.col("_slice").alias("_cut"),
                (F.col("_wanted") - F.col("_upto") + F.col("_n")).alias("_take"))
    )

    def of_class(frame: DataFrame, side: DataFrame, how: str) -> DataFrame:
        return frame.join(side, F.col(label).eqNullSafe(F.col("_class")), how)

    position = F.struct("_draw", *keys)
    in_cut = Window.partitionBy("_class").orderBy("_draw", *keys)
    last = size_checked(
        of_class(sliced.select(label, "_draw", "_slice", *keys), cuts, "inner")
        .filter(F.col("_slice") == F.col("_cut"))
        .withColumn("_number", F.row_number().over(in_cut))
        .filter(F.col("_number") == F.col("_take"))
        .select("_class", position.alias("_last"))
    )
    chosen = position <= F.col("_last")
    return of_class(drawn, last, "left").select(
        *df.columns, F.when(chosen, "test").otherwise("train").alias(out)
    )
