import numpy as np
from pyspark.sql import functions as F

from fairflow.llm import langid


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    out = langid.op5(spark, d).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"), F.min("score"), F.max("score")).first()
    assert out[0] > 0.97 and out[1] > 150 and 0 <= out[2] and out[3] <= 1
    assert langid.op5(spark, d).count() == docs.count()


def test_lookup_tables_equal_the_network():
    net = langid.ByteCNN(3, seed=4)
    x = np.random.default_rng(0).integers(0, 256, (300, langid.WINDOW)).astype(np.uint8)
    values, _ = net._pooled(x)
    active = np.maximum(np.concatenate(values, 1), 0)
    want = net._softmax(active @ net.weights["out"] + net.weights["out_bias"])
    assert np.allclose(net.predict(x), want, atol=1e-4)


def test_gradients_by_difference():
    net = langid.ByteCNN(3, seed=1)
    r = np.random.default_rng(1)
    x, y = r.integers(97, 110, (4, langid.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 1])
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}

    def loss():
        values, _ = net._pooled(x)
        p = net._softmax(np.maximum(np.concatenate(values, 1), 0) @ net.weights["out"] + net.weights["out_bias"])
        return -np.log(p[np.arange(4), y]).mean()

    for name, grad in net._gradients(x, y).items():
        for _ in range(4):
            at = (r.choice(np.arange(97, 110)),) + (0,) if name == "bytes" else tuple(r.integers(0, n) for n in grad.shape)
            old = net.weights[name][at]
            net.weights[name][at] = old + 1e-6
            up = loss()
            net.weights[name][at] = old - 1e-6
            down = loss()
            net.weights[name][at] = old
            assert abs((up - down) / 2e-6 - grad[at]) < 1e-5


def test_windows_cover_whole_texts():
    data = [b"", b"a" * 256, b"b" * 257, b"c"]
    x, of, used = langid.windows_of(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0] + [len(d) for d in data]))
    assert of.tolist() == [1, 2, 2, 3] and used.tolist() == [256, 256, 1, 1]
    assert x[2, 0] == 98 and not x[2, 1:].any()


def test_edges(make):
    rows = [(k, ("the cat and the dog " if k % 2 else "der hund und die katze ") * 9, "en" if k % 2 else "de", "s") for k in range(40)]
    rows += [(50, None, "en", "s"), (51, "", "en", None), (52, "12 !?", None, "s"), (None, "the cat", None, None),
             (53, "und die katze " * 9000, None, "s"), (1, "the dog and the cat", "en", "s"), (1, "the dog and the cat", "en", "s")]
    df = make(rows).selectExpr("*", "1 AS letters", "2 AS score", "3 AS held_out")
    out = langid.identify(df, langid.train(df))
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    found = {r.doc_id: r for r in out.collect()}
    assert [found[k].lang_pred for k in (50, 51, 52)] == ["und"] * 3 and found[50].score == 0
    assert found[53].lang_pred == "de" and found[None].lang_pred == "en" and found[None].held_out
    assert out.count() == len(rows)
    assert all(r.lang_pred == "und" for r in langid.identify(df, None).collect())
    empty = make([])
    assert langid.train(empty) is None and langid.identify(empty, None).count() == 0
