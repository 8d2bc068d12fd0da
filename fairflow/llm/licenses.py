"""Licence scans: a trained paragraph classifier confirmed by templates, in DataFrame functions only.

Paragraphs are the lines of a text.  Their words (letters and digits, lower-cased) and word pairs feed a
sparse multinomial logistic regression over the licence families and ``unknown``.  It is trained on

* sentences of the notices below, each in ``VARIANTS`` variants: words dropped by a hash, and neighbour
  words of real paragraphs put before and after it;
* at most ``NEGATIVES`` paragraphs of the corpus, chosen by hash, that hold none of the notices, and
  pieces of notices too short to tell the family, both as ``unknown``.

A third of both is kept from the fit and calibrates the unknown class: a paragraph is of a family only
if its probability exceeds that of all but ``FALSE_SHARE`` of the held-back unknown ones (and one half).
The family's notices then confirm it: one sentence must have ``OVERLAP`` of its word pairs in the
paragraph.  Vocabulary, coefficients and notices are bounded by parameters, so scoring is one pass over
the texts without a shuffle of them; only the confirmed paragraphs are grouped by document.

Defined results.  NULL and empty texts have no paragraphs and no families.  Repeated rows are scanned
each.  Extra columns are ignored.  An empty corpus trains on the notices alone.
"""

from __future__ import annotations

import re

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .register import query
from .staging import staged

VARIANTS = 40
NEGATIVES = 4000
VOCABULARY = 4000
FALSE_SHARE = 0.001
OVERLAP = 0.6
UNKNOWN = "unknown"

#: Notices by family.
NOTICES = {
    "apache": ["Licensed under the Apache License, Version 2.0",
               "You may not use this file except in compliance with the License"],
    "mit": ["Released under the MIT License", "This project is licensed under the terms of the MIT license",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"],
    "lgpl": ["Licensed under the GNU Lesser General Public License, version 2.1"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted",
            "Licensed under the BSD 3-Clause License"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "cc-by": ["This work is licensed under a Creative Commons Attribution 4.0 International License", "Licensed under CC BY 4.0"],
    "cc-by-nc": ["This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License",
                 "Licensed under CC BY-NC 4.0"],
    "proprietary": ["All rights reserved. No part of this publication may be reproduced without prior written permission"],
}


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def grams(words: Column) -> Column:
    """Words and pairs of neighbours."""
    return F.concat(words, pairs(words))


def pairs(words: Column) -> Column:
    rest = F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1)))
    return F.filter(F.zip_with(words, rest, lambda a, b: F.concat_ws(" ", a, b)), lambda p: p.contains(" "))


def paragraphs(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, paragraph number, words)"""
    text = F.col(f"`{text_col}`").cast("string")
    return (documents.select(F.col(f"`{id_col}`").alias("doc_id"), F.posexplode(F.split(text, "\n")).alias("paragraph", "line"))
            .select("doc_id", "paragraph", words_of(F.col("line")).alias("words")).filter(F.size("words") > 0))


def notices(spark: SparkSession) -> DataFrame:
    rows = [(family, text) for family, texts in NOTICES.items() for text in texts]
    return spark.createDataFrame(rows, "family string, notice string").withColumn("notice", words_of(F.col("notice")))


def _share(*columns) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 20)) / F.lit(float(1 << 20))


def training_rows(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(family, words, held): at most VARIANTS per notice and piece, and NEGATIVES of the corpus."""
    spark = documents.sparkSession
    known = F.array(*[F.lit(" ".join(w for w in ["", *_plain(t), ""])) for texts in NOTICES.values() for t in texts])
    texts = documents.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).filter(
        F.length("text") > 0).withColumn("key", F.xxhash64("text"))
    # Documents by hash first, their texts second: only the chosen ones move, and what is split into paragraphs is bounded.
    most, rows = NEGATIVES // 4, documents.count()
    share = _share("id", "key", F.lit(5))
    chosen = staged(texts.select("id", "key", share.alias("share")).filter(F.col("share") * rows < 2 * most + 50).distinct()
                    .orderBy("share", "id", "key").limit(most).select(F.col("id").alias("_id"), F.col("key").alias("_key")))
    some = texts.join(F.broadcast(chosen), F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left_semi")
    some = some.dropDuplicates(["id", "key"])  # repeated rows once
    real = paragraphs(some, "id", "text").withColumn("order", _share("doc_id", "paragraph", F.lit(6)))
    real = real.orderBy("order", "doc_id", "paragraph").limit(NEGATIVES)
    joined = F.concat(F.lit(" "), F.concat_ws(" ", "words"), F.lit(" "))
    real = staged(real.filter(~F.exists(known, lambda n: joined.contains(n))).select("words", "order"))
    unknown = real.select(F.lit(UNKNOWN).alias("family"), F.slice("words", 1, 60).alias("words"), "order")

    variants = notices(spark).withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))
    kept = F.filter(F.transform("notice", lambda w, k: F.struct(
        w.alias("w"), _share("v", "notice", k).alias("u"))), lambda s: (s["u"] > 0.08) | (F.col("v") < 4))
    variants = variants.withColumn("words", F.transform(kept, lambda s: s["w"]))
    around = real.withColumn("slot", F.row_number().over(Window.orderBy("order")) - 1).filter(F.col("slot") < VARIANTS).select(
        F.col("slot").alias("v"), F.slice("words", 1, 6).alias("near"))
    varied = (variants.join(F.broadcast(around), "v", "left").withColumn("near", F.coalesce("near", F.array().cast("array<string>")))
              .select("family", F.when(F.col("v") % 2 == 0, F.col("words")).otherwise(
                  F.concat("near", "words", F.slice("near", 1, 3))).alias("words"), _share("v", "notice", F.lit(8)).alias("order")))
    pieces = variants.filter("v < 20").select(
        F.lit(UNKNOWN).alias("family"),
        F.slice("notice", F.lit(1) + (F.col("v") % F.greatest(F.size("notice") - 1, F.lit(1))).cast("int"), F.lit(2)).alias("words"),
        _share("v", "notice", F.lit(9)).alias("order"))
    rows = unknown.unionByName(varied).unionByName(pieces)
    return rows.select("family", "words", grams(F.col("words")).alias("grams"), (F.pmod(F.xxhash64("words"), F.lit(3)) == 0).alias("held"))


def _plain(text: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9]+", text.lower()) if w]


class Scanner:
    def __init__(self, model: PipelineModel, families: list[str], limit: float):
        self.model, self.families, self.limit = model, families, limit


def _scored(rows: DataFrame, model: PipelineModel, families: list[str]) -> DataFrame:
    """Adds the best family other than unknown and its probability."""
    out = model.transform(rows).withColumn("p", vector_to_array("probability"))
    choice = F.array(*[F.struct(F.col("p")[k].alias("p"), F.lit(f).alias("family")) for k, f in enumerate(families) if f != UNKNOWN])
    return out.withColumn("best", F.array_max(choice)).withColumns({"found": F.col("best.family"), "chance": F.col("best.p")})


def train(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Scanner:
    rows = staged(training_rows(documents, id_col, text_col))
    # A bounded sample: one task a round is quicker than dealing a few thousand rows out.
    fit = rows.filter("NOT held").coalesce(1)
    names = sorted([*NOTICES, UNKNOWN])
    index = StringIndexer(inputCol="family", outputCol="label", stringOrderType="alphabetAsc").fit(
        documents.sparkSession.createDataFrame([(n,) for n in names], "family string"))
    model = Pipeline(stages=[
        CountVectorizer(inputCol="grams", outputCol="features", vocabSize=VOCABULARY, minDF=2.0, binary=True),
        LogisticRegression(regParam=0.002, elasticNetParam=0.5, maxIter=60, family="multinomial"),
    ]).fit(index.transform(fit))
    held = _scored(rows.filter("held"), model, names).filter(F.col("family") == UNKNOWN)
    limit = held.agg(F.percentile("chance", F.lit(1 - FALSE_SHARE))).first()[0]
    return Scanner(model, names, max(0.5, limit or 0.0))


def scan(documents: DataFrame, scanner: Scanner, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per paragraph of a family: doc_id, paragraph, family, probability, overlap, confirmed."""
    rows = paragraphs(documents, id_col, text_col).withColumn("grams", grams(F.col("words")))
    likely = _scored(rows, scanner.model, scanner.families).filter(F.col("chance") > scanner.limit)
    template = notices(documents.sparkSession).groupBy("family").agg(F.collect_list(pairs(F.col("notice"))).alias("sentences"))
    overlap = F.array_max(F.transform("sentences", lambda s: F.size(F.array_intersect(s, F.col("grams"))) / F.size(F.array_distinct(s))))
    return (likely.join(F.broadcast(template.withColumnRenamed("family", "found")), "found")
            .select("doc_id", "paragraph", F.col("found").alias("family"), F.col("chance").alias("probability"),
                    overlap.alias("overlap"), (overlap >= OVERLAP).alias("confirmed")))


def licences(documents: DataFrame, scanner: Scanner, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, licence (the most probable confirmed family, or unknown), families
    (all confirmed ones), n_paragraphs (confirmed), probability.  Rows of one id are one document."""
    found = scan(documents, scanner, id_col, text_col).filter("confirmed").groupBy("doc_id").agg(
        F.max(F.struct("probability", "family")).alias("top"), F.array_sort(F.collect_set("family")).alias("families"),
        F.countDistinct("paragraph").alias("n_paragraphs"))
    found = found.select(F.col("doc_id").alias("_doc"), "top", "families", "n_paragraphs")
    ids = documents.select(F.col(f"`{id_col}`").alias("doc_id"))
    return ids.join(found, F.col("doc_id").eqNullSafe(F.col("_doc")), "left").select(
        "doc_id", F.coalesce("top.family", F.lit(UNKNOWN)).alias("licence"),
        F.coalesce("families", F.array().cast("array<string>")).alias("families"),
        F.coalesce("n_paragraphs", F.lit(0)).alias("n_paragraphs"), F.coalesce("top.probability", F.lit(0.0)).alias("probability"))


@query("op3_licenses")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return licences(documents, train(documents)).withColumn("families", F.array_join("families", ","))
