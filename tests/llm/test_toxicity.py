import numpy as np
import pytest
from pyspark.sql import functions as F

from fairflow.llm import toxicity as t


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "toxic")
    out = t.op2(spark, d)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.join(labels, "doc_id").filter("held_out").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in rows}
    print(n)
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.9 and n[0, 0] / (n[0, 0] + n.get((0, 1), 0)) > 0.995
    assert out.filter("score < 0 OR score > 1 OR predicted <> cast(score >= 0.5 AS int)").count() == 0


LEXICON = t.make_lexicon({("idiot", False): 4.0, ("lowe", True): 3.0, ("loweb", False): 2.0})


def paid(text):
    data = text.encode()
    return t.evidence(LEXICON, np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0]


def test_paths_of_the_grammar():
    kinds = {"He is an idiot": 0, "you IDIOT": 1, "idiot, are you": 1, "he is not an idiot": 2,
             "she said he is an idiot": 3, "she said you are not an idiot": 3, "I will kill you": 4, "löwe lowez": 0}
    for text, kind in kinds.items():
        x = np.expm1(paid(text)[t.KINDS:2 * t.KINDS])
        assert x.round().tolist() == [float(k == kind) for k in range(t.KINDS)], text
    for text in ("", "nothing here", "they kill time", "you. said not", "lowe", "éidiot"):
        assert not paid(text).any()
    assert paid("idiot")[0] > paid("not an idiot")[2] > 0
    assert paid("you. idiot")[1] == 0  # another clause
    assert np.isclose(np.expm1(paid("loweb")[0]), 2) and np.isclose(np.expm1(paid("lowebb")[0]), 3)


def test_blocks_do_not_mix_texts():
    texts = ["you", "idiot", "", "said idiot", "idiot not idiot\nyou"]
    data = [x.encode() for x in texts]
    block = t.evidence(LEXICON, np.frombuffer(b"".join(data), np.uint8), np.cumsum([0] + [len(d) for d in data]))
    assert np.allclose(block, [paid(x) for x in texts])


def test_scores_do_not_depend_on_how_rows_lie(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    docs = docs.unionByName(docs.limit(50).withColumn("text", F.concat("text", F.lit(" again"))))  # ids with two texts
    models = [t.train(docs.repartition(n), labels.repartition(n)) for n in (1, 17)]
    scores = [sorted((r.doc_id, r.score) for r in t.score(docs, m).select("row.doc_id", "score").collect()) for m in models]
    assert scores[0] == scores[1] and max(s for _, s in scores[0]) > 0.5


def test_edges(spark, make):
    rows = [(k, f"word{k} some text here " + ("awful" if k % 3 == 0 else "fine") + f" more{k}", "en", "s") for k in range(300)]
    rows += [(400, None, None, None), (401, "", None, None), (402, "awful " * 20000, None, None), (None, "fine", None, None),
             (3, rows[3][1], "en", "s")]
    df = make(rows).selectExpr("*", "1 AS row", "5 AS `odd, name`", "2 AS score", "3 AS label")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(300)] + [(None, 1), (5, None), (999, 1), (6, 0)],
                                   "doc_id long, toxic int")
    model = t.train(df, labels)
    kept = t.reject(df, model)
    assert kept.columns == df.columns
    bad = {k for k in range(300) if k % 3 == 0} | {402}
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(r[0]) for r in rows if r[0] not in bad)
    assert t.train(df, labels.filter("toxic = 0")) is None and t.train(make([]), labels) is None
    assert t.reject(df, None).count() == len(rows) and t.reject(make([]), model).count() == 0
