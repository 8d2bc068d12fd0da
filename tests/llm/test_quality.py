import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from fairflow.llm import quality

COLUMNS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def base(c):
    return c[0] < 50 or 100 * c[5] > 50 * c[0]


def want(rows):
    """(id, text, lang, source) -> sorted reprs of the result, from the rule itself"""
    def point(v):
        return v if v < 128 else v >> (v.bit_length() - 7) << (v.bit_length() - 7)

    def measures(c):
        return (100 * c[1] // c[0], 100 * c[2] // c[1], 10000 * c[4] // c[3], 10000 * c[5] // c[0])

    counted = [(r, brute.counts(r[1])) for r in rows]
    good = [(r, measures(c)) for r, c in counted if not base(c)]
    out = []
    for r, c in counted:
        kept = not base(c)
        if kept:
            for group in ([m for g, m in good if g[2:] == r[2:]], [m for g, m in good if g[2] == r[2]], [m for _, m in good]):
                if len(group) >= quality.MIN_ROWS:
                    break
            for k, v in enumerate(map(point, measures(c))):
                ordered = sorted(point(m[k]) for m in group)
                at = lambda hundredths: ordered[-(-hundredths * len(ordered) // 100) - 1]  # noqa: B023, E731
                if k == 0:
                    reach = 3 * max(at(75) - at(25), 1)
                    kept &= at(25) - reach <= v <= at(75) + reach
                elif k == 1:
                    kept &= v <= at(75) + 3 * max(at(75) - at(50), 1)
                else:
                    kept &= v <= at(99)
        out.append(repr((r[0], c[0], c[1], c[2], c[4], c[5], base(c), kept)))
    return sorted(out)


def got(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.mark.parametrize("least", [5, 100])
def test_whole_table(texts, make, monkeypatch, least):
    monkeypatch.setattr(quality, "MIN_ROWS", least)
    expected = want(texts)
    assert 0 < sum(x.endswith("False, False)") for x in expected) < 60
    assert got(quality.quality(make(texts, 5))) == expected


def test_agrees_with_labels(spark):
    d = "/root/testdata/sf0.1"
    judged = quality.quality(spark.read.parquet(f"{d}/documents.parquet"))
    rows = judged.join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").filter("NOT base_failed").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    share = {r.quality: r.kept for r in rows}
    assert share[1] > 0.98 and share[0] < 0.01


def test_thresholds_move_with_their_group(make):
    """The same texts pass in a source where they are usual and fail in one where they are not."""
    def text(k, symbols, words=100):
        return " ".join(["###"] * symbols + [f"w{k}x{j * j}" for j in range(words)])

    rows = [(k, text(k, 12 + k % 5), "en", "code") for k in range(150)] + [(200 + k, text(k, 0), "en", "prose") for k in range(150)]
    rows += [(400, text(0, 16), "en", "code"), (401, text(0, 16), "en", "prose"), (402, text(0, 80), "en", "code")]
    df = make(rows)
    kept = {r.doc_id: r.kept for r in quality.quality(df).collect()}
    assert kept[400] and not kept[401] and not kept[402] and all(kept[k] for k in range(150))
    counts = quality._counted(df, "text", "lang", "source", ["doc_id", "lang", "source"])
    high = {r.source: r.symbols_high for r in quality.thresholds(counts).collect()}
    assert high["code"] > high["prose"] > 0


def test_counts_of_odd_texts():
    texts = [None, "", "\n", "a", "a\na\n a\n\na", "x\n\ny\nx", "é ü\n#|<", "a b c a b c a", "\n\n\x0b\n", "b\r\nb\r\nb", "q" * 3000, "a a a a"]
    r = random.Random(2)
    texts += ["".join(r.choice("ab \n#é") for _ in range(r.randrange(60))) for _ in range(300)]
    data = [(t or "").encode() for t in texts]
    block = quality.count_block(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0] + [len(b) for b in data]))
    assert list(map(tuple, np.array(block).T.tolist())) == [brute.counts(t) for t in texts]


def test_edges(make):
    rows = [(1, None, None, None), (2, "", "en", "a"), (None, "a b " * 60, "en", None), (4, "w " * 200, "en", "a")]
    rows += [(10 + k, " ".join(f"w{k * 7 + j * j}" for j in range(60)), "en", None if k % 2 else "a") for k in range(12)]
    rows += [rows[-1], (40, " ".join(f"###{j}" for j in range(80)), "en", "a")]
    df = make(rows)
    assert got(quality.quality(df)) == want(rows)
    clash = df.selectExpr("*", "1 AS kept", "5 AS `odd, name`", "2 AS n_words", "'x' AS row", "4 AS measure")
    kept = quality.quality_filter(clash)
    assert kept.columns == clash.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(int(x[1:].split(",")[0]) for x in want(rows) if x.endswith("True)"))
    assert quality.quality(make([])).count() == 0 and quality.quality_filter(make([])).count() == 0
