"""Mixing sources to target weights: iterative proportional fitting, in DataFrame functions only.

Tokens (words) are summed per cell of source, language and topic.  The cells' weights are raked: one
dimension after the other, every category's weighted tokens are brought to its target share, for
``ROUNDS`` rounds.  A document is then sampled with probability ``keep`` times the weight of its cell,
by a hash of its id and text, so a retried task draws the same and no row is collected.

No document is drawn more than once, so no weight may pass 1 / keep.  ``keep`` is lowered until every
category has tokens enough for its share of the sample, and ``BOUNDED_ROUNDS`` more rounds of the fit hold
every weight to that bound, so that other cells of a category make good what a full cell lacks.  Where
targets ask more of the same cells than these hold, what is lacking stays so.  ``mode="strict"`` cuts
probabilities at one instead and makes nothing good.

A target is a share per category, or a power: the categories' own shares raised to it and normalised
(1 keeps a dimension as it is, 0 evens it out).  Shares are normalised over the categories present;
a category that a given target does not name gets no share and is not sampled, unless the target has
the key ``REST``: then each of the others, NULL included, asks for its own share of all tokens, times the
value of that key, next to the named shares.

Defined results.  NULL categories are categories of their own, named by the key None; an empty or NULL
text has no tokens and its cell's weight.  Cells without tokens do not move the fit.  Repeated rows are
drawn alike.  An empty table gives an empty sample.  Extra columns are passed on.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.hashing import uniform
from .register import query
from .staging import staged_few

ROUNDS = 12
BOUNDED_ROUNDS = 24
STAGED_ROUNDS = 3
KEEP = 0.5
SEED = 11
WORD = "[^\\x20\\x09-\\x0D]+"
DIMENSIONS = ("source", "lang", "topic")

#: In a target: the categories that it does not name.
REST = object()

#: The mixture of the registered query and of the pipeline.
TARGETS = {"source": 0.5, "lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15, REST: 1.0}, "topic": 0.7}


def topic_of(text: Column) -> Column:
    """A coarse topic by content."""
    return (F.when(F.contains(text, F.lit(" | ")), "table")
            .when(F.contains(text, F.lit("%%%")), "symbols")
            .when(F.contains(text, F.lit("License")) | F.contains(text, F.lit("icensed under")), "licence")
            .when(F.contains(text, F.lit("@")), "contact")
            .otherwise("prose"))


def _raw_share(dimension: str, target: float | Mapping) -> Column:
    """What a category asks for, before normalising; needs its ``tokens`` and those of all, ``_whole``."""
    if not isinstance(target, Mapping):
        return F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(float(target)))).otherwise(0.0)
    named = reduce(lambda c, kv: c.when(F.col(dimension).eqNullSafe(F.lit(kv[0])), F.lit(float(kv[1]))),
                   [kv for kv in target.items() if kv[0] is not REST], F.when(F.lit(False), 0.0))
    rest = F.try_divide(F.lit(float(target.get(REST, 0.0))) * F.col("tokens"), F.col("_whole"))
    return F.coalesce(named, rest, F.lit(0.0))


def _fit(current: DataFrame, targets: Mapping[str, float | Mapping], rounds: int, most: Column | None = None) -> DataFrame:
    """Rounds of raking; ``most`` bounds the weights."""
    for turn in range(rounds):
        for dimension in targets:
            mass = F.sum(F.col("tokens") * F.col("weight")).over(Window.partitionBy(dimension))
            want = F.col(f"_share_{dimension}")
            factor = F.when(mass > 0, want * F.col("_whole") / mass).otherwise(F.when(want > 0, 1.0).otherwise(0.0))
            weight = F.col("weight") * factor
            current = current.withColumn("weight", weight if most is None else F.least(weight, most))
        if (turn + 1) % STAGED_ROUNDS == 0:
            current, _ = staged_few(current)
    return current


def rake(cells: DataFrame, targets: Mapping[str, float | Mapping], rounds: int = ROUNDS, keep: float | None = None) -> DataFrame:
    """The cells with a ``weight``.  A step is one sum over the cells of each category; a few cells are fitted in one
    task, without an exchange for each step.  With ``keep`` weights are bounded, and the keep that every category can
    meet is added."""
    cells, _ = staged_few(cells)
    current = cells.withColumn("weight", F.lit(1.0))
    whole = cells.agg(F.sum("tokens").cast("double").alias("_whole"))
    limits = [F.lit(keep)]
    for dimension, target in targets.items():
        per = cells.groupBy(dimension).agg(F.sum("tokens").alias("tokens")).crossJoin(F.broadcast(whole)).select(
            dimension, "tokens", "_whole", _raw_share(dimension, target).alias("raw"))
        share = per.crossJoin(F.broadcast(per.agg(F.sum("raw").alias("sum")))).select(
            F.struct(dimension).alias("_category"), F.try_divide("raw", "sum").alias(f"_share_{dimension}"),
            F.when(F.col("tokens") > 0, F.try_divide("tokens", F.try_divide("raw", "sum") * F.col("_whole"))).alias(f"_keep_{dimension}"))
        current = current.withColumn("_category", F.struct(dimension)).join(share, "_category").drop("_category")
        limits.append(F.min(f"_keep_{dimension}"))
    current, _ = staged_few(current.crossJoin(F.broadcast(whole)))
    if keep is None:
        return _fit(current, targets, rounds).select(*cells.columns, "weight")
    current = current.crossJoin(F.broadcast(current.agg(F.least(*limits).alias("keep"))))
    most = 1 / F.col("keep")
    fitted = _fit(current, targets, rounds).withColumn("weight", F.least("weight", most))
    return _fit(fitted, targets, BOUNDED_ROUNDS, most).select(*cells.columns, "weight", "keep")


def with_probability(documents: DataFrame, targets: Mapping[str, float | Mapping] = TARGETS, keep: float = KEEP,
                     text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
                     topic: Column | None = None, mode: str = "bounded") -> DataFrame:
    """``row`` (the document as a struct), ``cell`` (source, lang, topic), tokens, weight, probability."""
    if mode not in ("bounded", "strict"):
        raise ValueError(f"mode {mode!r}")
    text = F.col("row").getField(text_col)
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
        F.struct(F.col(f"`{source_col}`").cast("string").alias("source"), F.col(f"`{lang_col}`").cast("string").alias("lang"),
                 (topic_of(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))) if topic is None else topic.cast("string")).alias("topic")
                 ).alias("cell"),
    ).withColumn("tokens", F.coalesce(F.size(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))), F.lit(0)).cast("long"))
    cells = rows.groupBy("cell").agg(F.sum("tokens").alias("tokens")).select("cell.*", "tokens")
    fitted = rake(cells, targets, keep=keep) if mode == "bounded" else rake(cells, targets).withColumn("keep", F.lit(keep))
    weights = fitted.select(F.struct(*DIMENSIONS).alias("cell"), "weight", "keep")
    return rows.join(weights, "cell").withColumn("probability", F.least(F.lit(1.0), F.col("keep") * F.col("weight"))).drop("keep")


def drawn(id_col: Column, text: Column, seed: int = SEED) -> Column:
    """A number from 0 to 1 from the id and the text."""
    return uniform([F.coalesce(id_col.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))], seed)


def mix(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The sampled documents: their own columns, then ``mix_weight`` and ``mix_probability``."""
    held = with_probability(documents, text_col=text_col, **options)
    row = F.col("row")
    sample = held.filter(drawn(row.getField(id_col), row.getField(text_col)) < F.col("probability"))
    names = {c.lower() for c in documents.columns}
    added = []
    for name, column in (("mix_weight", "weight"), ("mix_probability", "probability")):
        while name in names:
            name += "_"
        added.append(F.col(column).alias(name))
    return sample.select(*[row.getField(c).alias(c) for c in documents.columns], *added)


def _sql() -> str:
    """The same bounded fit in SQL: each round and dimension is one step over the cells."""
    steps = ["""WITH d AS MATERIALIZED (SELECT doc_id, source, lang, coalesce(text, '') AS t,
  CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table' WHEN contains(coalesce(text, ''), '%%%') THEN 'symbols'
       WHEN contains(coalesce(text, ''), 'License') OR contains(coalesce(text, ''), 'icensed under') THEN 'licence'
       WHEN contains(coalesce(text, ''), '@') THEN 'contact' ELSE 'prose' END AS topic,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens FROM documents)""",
             "w0 AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(tokens) AS BIGINT) AS tokens, 1e0 AS weight FROM d GROUP BY ALL)"]
    raw = {"source": "pow(CAST(sum(tokens) AS DOUBLE), 0.5e0)", "topic": "pow(CAST(sum(tokens) AS DOUBLE), 0.7e0)",
           "lang": "CASE lang WHEN 'en' THEN 0.55e0 WHEN 'de' THEN 0.15e0 WHEN 'fr' THEN 0.15e0 WHEN 'es' THEN 0.15e0 ELSE sum(tokens) / (SELECT whole FROM total) END"}
    steps.append("total AS MATERIALIZED (SELECT CAST(sum(tokens) AS DOUBLE) AS whole FROM w0)")
    for c in DIMENSIONS:
        steps.append(f"""s_{c} AS MATERIALIZED (SELECT {c}, raw / sum(raw) OVER () AS share, CASE WHEN tokens > 0 THEN
  tokens / nullif(raw / sum(raw) OVER () * (SELECT whole FROM total), 0) END AS most FROM (SELECT {c}, {raw[c]} AS raw, sum(tokens) AS tokens FROM w0 GROUP BY {c}))""")
    limits = " UNION ALL ".join(f"SELECT most FROM s_{c}" for c in DIMENSIONS)
    steps.append(f"bound AS MATERIALIZED (SELECT least(0.5e0, min(most)) AS keep FROM ({limits}))")

    def fitted(n: int, rounds: int, bound: str) -> int:
        for _ in range(rounds):
            for c in DIMENSIONS:
                steps.append(f"""w{n + 1} AS MATERIALIZED (SELECT source, lang, topic, tokens, {bound.format(f"""weight * CASE WHEN mass > 0
  THEN share * (SELECT whole FROM total) / mass WHEN share > 0 THEN 1e0 ELSE 0e0 END""")} AS weight
  FROM (SELECT w.*, s.share, sum(w.tokens * w.weight) OVER (PARTITION BY w.{c}) AS mass FROM w{n} w JOIN s_{c} s ON w.{c} IS NOT DISTINCT FROM s.{c}))""")
                n += 1
        return n

    bounded = "least({}, 1 / (SELECT keep FROM bound))"
    free = fitted(0, ROUNDS, "{}")
    steps.append(f"w{free + 1} AS MATERIALIZED (SELECT source, lang, topic, tokens, {bounded.format('weight')} AS weight FROM w{free})")
    last = fitted(free + 1, BOUNDED_ROUNDS, bounded)
    return ",\n".join(steps) + f"""
SELECT d.doc_id, d.source, d.lang, d.topic, d.tokens, round(w.weight, 6) + 0.0 AS weight,
  round(least(1e0, keep * w.weight), 6) + 0.0 AS probability
FROM bound, d JOIN w{last} w ON d.source IS NOT DISTINCT FROM w.source AND d.lang IS NOT DISTINCT FROM w.lang AND d.topic = w.topic
WHERE CAST('0x' || substr(md5(concat_ws(':', CAST(d.doc_id AS VARCHAR), md5(d.t), '{SEED}')), 1, 8) AS BIGINT) / 4294967296e0
  < least(1e0, keep * w.weight)"""


@query("op4_mixing", sql=_sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang")
    held = with_probability(documents)
    return held.filter(drawn(F.col("row.doc_id"), F.col("row.text")) < F.col("probability")).select(
        "row.doc_id", "cell.*", "tokens", (F.round("weight", 6) + F.lit(0.0)).alias("weight"),
        (F.round("probability", 6) + F.lit(0.0)).alias("probability"))
