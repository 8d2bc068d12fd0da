import brute
import pytest

from fairflow.llm import substring


def got(df):
    return {(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()}


def want(rows, length=13):
    return {(i, *v) for (i, _), v in brute.substring(rows, length).items()}


def test_whole_table(spark, texts, make):
    rows = [(i, t) for i, t, *_ in texts]
    assert got(substring.remove_repeated(make(rows, 5))) == want(rows)
    assert sum(v[1] for v in brute.substring(rows).values()) > 0


@pytest.mark.parametrize("length", [1, 2, 13])
def test_edges(make, length):
    line = "a b c d e f g h i j k l m n o p"
    rows = [(3, line), (1, f"x {line}\t\n{line} y"), (2, None), (4, ""), (5, " \x0b "), (6, "a"), (None, line),
            (7, "é \x1c\x00 " * 20), (8, "é \x1c\x00 " * 20), (9, "z " * 40), (7, line + " q"), (7, line + " q")]
    df = substring.remove_repeated(make(rows), length)
    assert got(df) == want(rows, length)
    assert df.count() == len(rows)


def test_blocks_and_batches(make, monkeypatch):
    from fairflow.llm import repeats
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 64)
    monkeypatch.setattr(substring, "BATCH_WINDOWS", 16)
    monkeypatch.setattr(substring, "BUCKET_BYTES", 256)
    rows = [(i, " ".join(f"w{(i * 7 + k) % 23}" for k in range(30))) for i in range(40)]
    assert got(substring.remove_repeated(make(rows), 5)) == want(rows, 5)


def test_empty_table_and_extra_columns(spark, make):
    assert substring.remove_repeated(make([])).count() == 0
    df = make([(1, "a b")]).selectExpr("*", "1 AS marks", "2 AS _id", "3 AS n_words", "4 AS bucket")
    assert got(substring.remove_repeated(df)) == want([(1, "a b")])
