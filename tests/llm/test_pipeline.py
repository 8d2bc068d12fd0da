"""The pipeline's stages on the smallest table, each against brute force or the operator's own test."""

import sys
from pathlib import Path

import brute
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402

from fairflow.llm import pii, staging, toxicity  # noqa: E402

DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{DIR}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = staging.staged(stage(spark, docs, DIR))
        out.append((name, docs.columns, {r.doc_id: r for r in docs.collect()}))
    return out


def test_stages(spark, steps, texts):
    assert [s[0] for s in steps] == ["toxicity", "near_dedup", "decontamination", "pii", "mixing"]
    assert all(columns == COLUMNS for _, columns, _ in steps[:-1])
    assert steps[-1][1] == [*COLUMNS, "mix_weight", "mix_probability"]
    clean, single, safe, private, mixed = (s[2] for s in steps)

    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{DIR}/labels.parquet").to_pylist()}
    assert sum(labels.get(i) == 0 for i in clean) == sum(v == 0 for v in labels.values())
    # Nine toxic documents are all there is to learn from here; held-out accuracy is in test_toxicity.
    assert sum(labels.get(i) == 1 for i in clean) < sum(v == 1 for v in labels.values()) / 2

    rows = [(i, r.text) for i, r in clean.items()]
    assert set(single) == {r[0] for r in brute.near(rows) if r[3]}

    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{DIR}/benchmark.parquet").to_pylist()]
    found = {r[0]: r for r in brute.decontamination([(i, r.text) for i, r in single.items()], items)}
    assert set(safe) == {i for i, r in found.items() if not r[-1]}
    assert all(r.text == single[i].text for i, r in safe.items() if found[i][2] == 0)
    assert not any(r[2] for r in brute.decontamination([(i, r.text) for i, r in safe.items()], items))

    assert set(private) == set(safe)
    changed = [i for i in safe if safe[i].text != private[i].text]
    assert changed and all(len(safe[i].text) - len(private[i].text) in range(-30, 31) for i in changed)
    assert all(r.n_chars == len(r.text) for r in private.values())

    assert set(mixed) < set(private) and all(r.text == private[i].text for i, r in mixed.items())
    assert all(0 < r.mix_probability <= 1 for r in mixed.values())


def test_only_what_the_sample_reads_stays(spark):
    from fairflow.session import staging_scope

    with staging_scope(spark) as scope:
        sample = corpus_pipeline.run(spark, DIR)
        left = [p for p in scope.paths if Path(p.removeprefix("file:")).exists()]
        assert 0 < len(left) <= 3 and sample.count() > 0
        scope.drop()


def test_run_gives_the_last_stage(spark, steps):
    assert {r.doc_id: r.text for r in corpus_pipeline.run(spark, DIR).collect()} == {i: r.text for i, r in steps[-1][2].items()}
