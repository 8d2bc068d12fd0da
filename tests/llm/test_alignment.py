import random

import brute
import numpy as np
import pytest

from fairflow.llm import alignment

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tools():
    """The two tokenizers as the brute-force version wants them, on whole texts."""
    t = alignment.Tokenizers(alignment.FOLDER, alignment.A_FILE, alignment.B_FILE)
    return (lambda s: t.a.encode(s, add_special_tokens=False).ids), t.b.encode, t.a_bytes, t.b_bytes


def got(df, **options):
    return sorted(map(repr, map(tuple, alignment.alignment_summary(df, **options).select(*COLUMNS).collect())))


def want(rows, tools):
    return sorted(map(repr, brute.token_alignment(rows, *tools)))


def test_given_table(spark, make, texts, tools):
    rows = [(i, t) for i, t, *_ in texts if len(t or "") < 4000]
    assert len(rows) > 100
    assert got(make(rows, 5)) == want(rows, tools)


ODD = ["<|endoftext|> a <s> </s> <unk> <0x41>", "  two  spaces   at  ends  ", "\t tab\n\nlines \r\n x", "a▁b", "▁", " ", "\x00 \x1c q",
       "naïve café Straße ①②③ ﬁ", "中文字 和 日本語 テスト", "👩‍👩‍👧 emoji 🏳️‍🌈 x", "it's we'll I'd 'tis 's", "x" * 300,
       "http://a.b/c?d=e&f=1234567890123", "1 2 33 444 5555", "é é", "a b 　 c​d   e", "́ a ́b", "…  …"]


def test_edges(spark, make, tools):
    rows = [*enumerate(ODD), (50, None), (51, ""), (None, "the cat"), (0, "the cat"), (0, "the cat"), (52, "the  cat sat " * 3)]
    df = make(rows)
    assert got(df) == want(rows, tools)
    clash = df.selectExpr("*", "1 AS _id", "2 AS n_a", "3 AS pair", "4 AS batch")
    assert got(clash) == want(rows, tools)


def test_small_steps(spark, make, tools, monkeypatch):
    """Chunks, blocks, batches and forgotten pieces change nothing (the settings travel to no worker: called here)."""
    import pyarrow as pa

    r = random.Random(3)
    words = ["the", "tokenization", "zzyzx", "Größe", "don't", "…", "12,345", "中文", "a", "</s>", "\n", "x▁y", "supercalifragilistic"]
    rows = [(k, " ".join(r.choice(words[:-2] + words[-1:] if k % 7 else words) for _ in range(r.randrange(120)))) for k in range(60)]
    for name, value in (("CHUNK", 40), ("BLOCK_CHARS", 200), ("BATCH_PAIRS", 300), ("CACHED_CHARS", 2000), ("LANE", 3), ("WIDEST", 4)):
        monkeypatch.setattr(alignment, name, value)

    class Task:
        @staticmethod
        def get():
            return Task

        @staticmethod
        def partitionId():
            return 7

    monkeypatch.setattr(alignment, "TaskContext", Task)
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([t.encode() for _, t in rows], pa.binary())],
                                       ["_id", "text"])
    out = [b.to_pylist()[0] for b in alignment._align((alignment.FOLDER, alignment.A_FILE, alignment.B_FILE), pa.int64())([batch])]
    assert len(out) > 5 and len({x["batch"] for x in out}) == len(out)
    have = [row for x in out for row in zip(x["ids"], x["n_a"], x["n_b"], x["n_groups"], x["n_links"], x["digests"])]
    assert have == [(r[0], r[1], r[2], r[3], r[4], r[7]) for r in brute.token_alignment(rows, *tools)]


def test_pieces_equal_whole_texts(tools):
    t = alignment.Tokenizers(alignment.FOLDER, alignment.A_FILE, alignment.B_FILE)
    assert t.cuts
    alphabet = list("ab Z9.,'\n\t  é中_▁!") + [" the", "'s ", " 's", "  ", " \n ", "ß"]
    r = random.Random(5)
    for _ in range(3000):
        text = "".join(r.choice(alphabet) for _ in range(r.randrange(1, 40)))
        pieces = t.pieces(text)
        t.encode_new()
        assert t.a_ids.take(pieces).tolist() == tools[0](" " + text), text
        assert t.b_ids.take(pieces).tolist() == tools[1](text), text


def test_diagonals_against_sets():
    r = np.random.default_rng(1)
    for trial in range(300):
        total = int(r.integers(1, 400))
        common = r.random(total) < r.choice([0.02, 0.3, 0.9])
        a = np.flatnonzero((r.random(total) < 0.4) | common)
        b = np.flatnonzero((r.random(total) < 0.4) | common)
        a, b = np.unique(np.append(a, total - 1)) + 1, np.unique(np.append(b, total - 1)) + 1
        last_a, last_b, p, q = alignment.skip_diagonals(a, b, np.array([0]), np.array([0]))
        both = np.intersect1d(a, b)
        assert a[last_a].tolist() == both.tolist() == b[last_b].tolist()
        begin_a, begin_b = np.append(0, a[:-1]), np.append(0, b[:-1])
        over = np.maximum(begin_a[:, None], begin_b) < np.minimum(a[:, None], b)
        assert sorted(zip(p.tolist(), q.tolist())) == [tuple(x) for x in np.argwhere(over).tolist()]


def test_alignments_and_counts(spark, make, tools):
    rows = [(1, "the cat sat"), (2, "the tokenization"), (3, None), (4, "x▁y"), (5, "the cat sat")]
    df = make(rows)
    out = {r.doc_id: r for r in alignment.alignments(df).collect()}
    assert out[1].a == tools[0](" the cat sat") and out[1].b == tools[1]("the cat sat")
    assert out[1].a_ends[-1] == len(out[1].a) and out[1].b_ends[-1] == len(out[1].b)
    assert not out[3].a and not out[4].a and not out[4].b_ends
    counts = alignment.pair_counts(alignment.aligned_batches(df)).collect()
    the = tools[0](" the")[0], tools[1]("the")[0]
    assert [(r.docs, r.best) for r in counts if (r.a, r.b) == the] == [(3, True)]


def test_empty_table_text_ids_and_bytes(spark, make):
    assert alignment.alignment_summary(make([])).count() == 0
    odd = spark.createDataFrame([("a", b"\xff\xfe broken"), ("b", b"fine")], "doc_id string, text binary").selectExpr(
        "doc_id", "CAST(text AS STRING) AS text")
    out = {r.doc_id: r for r in alignment.alignment_summary(odd).collect()}
    assert out["a"].n_a == 0 and out["a"].groups_sha256 == "" and out["b"].n_a > 0
