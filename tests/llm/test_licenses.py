import re

import pytest

from fairflow.llm import licenses


@pytest.fixture(scope="module")
def scanner(spark):
    return licenses.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


LINES = {"apache": "Licensed under the Apache License, Version", "mit": "Released under the MIT License",
         "gpl": "licensed under the GNU General Public License", "cc-by-nc": "Licensed under CC BY-NC"}


def test_planted_lines(spark, scanner):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plan = licenses.licences(docs, scanner)
    assert "Python" not in plan._jdf.queryExecution().toString()
    found = {r.doc_id: set(r.families) for r in plan.collect()}
    want = {r.doc_id: {f for f, line in LINES.items() if line in (r.text or "")} for r in docs.collect()}
    assert sum(map(bool, want.values())) > 10
    wrong = {i: (want[i], found[i]) for i in want if want[i] != found[i]}
    assert not wrong


def test_unseen_wordings_and_near_misses(make, scanner):
    rows = [(1, "some words\nfoo: Licensed under the Apache License, Version 2.0 (the License);\nmore"),
            (2, "This is released under the MIT License, see below"), (3, "the apache flew; version two of the story"),
            (4, "We have a driving license under review"), (5, "public general meeting of the GNU herd"), (6, None), (7, ""),
            (None, "Released under the MIT License."), (9, "word " * 60000 + "\nReleased under the MIT License.\nLicensed under CC BY-NC 4.0."),
            (2, "This is released under the MIT License, see below"), (10, "\n\n \n")]
    df = make(rows).selectExpr("*", "1 AS words", "2 AS features", "3 AS family")
    out = licenses.licences(df, scanner).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: (r.families, r.n_paragraphs) for r in out}
    assert got == {1: (["apache"], 1), 2: (["mit"], 1), 3: ([], 0), 4: ([], 0), 5: ([], 0), 6: ([], 0), 7: ([], 0),
                   None: (["mit"], 1), 9: (["cc-by-nc", "mit"], 2), 10: ([], 0)}
    assert all(r.licence == "unknown" and r.probability == 0 for r in out if not r.families)


def test_empty_corpus(make):
    empty = make([])
    scanner = licenses.train(empty)
    assert licenses.licences(empty, scanner).count() == 0
    assert licenses.licences(make([(1, "Released under the MIT License.")]), scanner).first().licence == "mit"
