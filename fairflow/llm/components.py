"""Connected components of a link table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .staging import staged_few


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b): nodes have equal labels if a path joins them.

    In each round every node goes to its least neighbour if that is less than itself, and links are
    rewritten to where their ends went.  By node number a star falls together at once; by a hash that
    changes each round a long chain loses a constant share of its nodes.  The two orders alternate.
    Rounds grow with the logarithm of the largest component; a hub's links are one minimum per task.  The last rounds,
    with few links left, run in one task each.
    """
    def distinct(df: DataFrame) -> tuple[DataFrame, bool]:
        return staged_few(df.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())

    (edges, few), labels, turn = distinct(links.select("a", "b")), None, 0
    while not edges.isEmpty():
        def order(c: str) -> Column:
            return F.xxhash64(c, F.lit(turn)) if turn % 2 else F.col(c)

        both = edges.select(F.inline(F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("u")),
                                             F.struct(F.col("b").alias("v"), F.col("a").alias("u")))))
        goes, gone_few = staged_few(both.groupBy("v").agg(F.min_by("u", order("u")).alias("u"))
                                    .select("v", F.when(order("u") < order("v"), F.col("u")).otherwise(F.col("v")).alias("to")))
        if labels is None:
            labels, labels_few = goes.select(F.col("v").alias("node"), F.col("to").alias("label")), gone_few
        else:
            moved = goes.hint("merge") if labels_few and gone_few else goes
            labels, labels_few = staged_few(labels.join(moved, F.col("label") == F.col("v"), "left")
                                            .select("node", F.coalesce("to", "label").alias("label")))
        # One partition each: joined and made distinct in the task that has them.
        one = few and gone_few
        moved = goes.hint("merge") if one else goes
        a = moved.select(F.col("v").alias("a"), F.col("to").alias("to_a"))
        b = moved.select(F.col("v").alias("b"), F.col("to").alias("to_b"))
        met = edges.join(a, "a")
        met = (met.coalesce(1) if one else met).join(b, "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
        edges, few = distinct(met.coalesce(1) if one else met)
        turn += 1
    return labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
