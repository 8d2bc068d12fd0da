import pytest
from compare import difference, duck
from pyspark.sql import functions as F

from fairflow.llm import mixing, staging


def test_matches_sql(spark):
    con = duck("sf0.01")
    plan = mixing.op4(spark, "/root/testdata/sf0.01")
    assert "Python" not in plan._jdf.queryExecution().toString()
    assert difference(plan, con, mixing._sql()) is None


def test_margins_reach_their_targets(spark):
    cells = spark.createDataFrame([(s, g, t, 10 + 7 * k) for k, (s, g, t) in enumerate(
        (s, g, t) for s in "abc" for g in ("en", None) for t in "xy")], "source string, lang string, topic string, tokens long")
    targets = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"en": 3.0, None: 1.0}, "topic": 0.0}
    out = mixing.rake(cells, targets).withColumn("mass", F.col("tokens") * F.col("weight"))
    total = cells.agg(F.sum("tokens")).first()[0]
    for c, want in (("source", {"a": 0.5, "b": 0.3, "c": 0.2}), ("lang", {"en": 0.75, None: 0.25}), ("topic", {"x": 0.5, "y": 0.5})):
        got = {r[0]: r[1] / total for r in out.groupBy(c).agg(F.sum("mass")).collect()}
        assert got == pytest.approx(want, abs=1e-6)


def test_sample_follows_the_probabilities(spark):
    docs = spark.range(40000).selectExpr("id AS doc_id", "'a b c d' AS text", "concat('s', id % 4) AS source", "'en' AS lang")
    kept = mixing.mix(docs, targets={"source": {"s0": 0.1, "s1": 0.2, "s2": 0.3, "s3": 0.4}}, keep=0.6)
    n = {r.source: r["count"] for r in kept.groupBy("source").count().collect()}
    assert all(abs(n[f"s{k}"] / 10000 - 0.24 * (k + 1)) < 0.02 for k in range(4))


def test_edges(make):
    rows = [(k, "w " * (k % 9), ("en", "de", None)[k % 3], ("a", None)[k % 2]) for k in range(90)] + [
        (100, None, "en", "a"), (101, "", None, None), (None, "x y", "fr", "b"), (5, "w " * 5, None, None), (103, "long " * 60000, "en", "a")]
    df = make(rows).selectExpr("*", "1 AS row", "2 AS cell", "3 AS weight", "4 AS mix_weight")
    out = mixing.mix(df, targets={"source": 0.5, "lang": {"en": 1.0, "de": 1.0, None: 2.0}}, keep=0.7)
    assert out.columns == [*df.columns, "mix_weight_", "mix_probability"]
    found = out.collect()
    assert 0 < len(found) < len(rows) and all(r.lang != "fr" for r in found)
    assert mixing.mix(df, targets={"source": 1.0}, keep=1.0).count() == len(rows)
    assert mixing.mix(make([])).count() == 0
    assert sorted(map(str, found)) == sorted(map(str, mixing.mix(df.repartition(7), targets={
        "source": 0.5, "lang": {"en": 1.0, "de": 1.0, None: 2.0}}, keep=0.7).collect()))


def test_languages_without_a_target_are_sampled(spark):
    docs = spark.range(9000).selectExpr("id AS doc_id", "'a b c d' AS text", "'s' AS source",
                                        "CASE id % 10 WHEN 0 THEN NULL WHEN 1 THEN 'it' ELSE 'en' END AS lang")
    cells = mixing.with_probability(docs).groupBy("cell.lang").agg(F.first("weight")).collect()
    assert {r[0]: r[1] for r in cells} == pytest.approx({"en": 0.55 / 0.75 / 0.8, None: 0.1 / 0.75 / 0.1, "it": 0.1 / 0.75 / 0.1})
    n = {r.lang: r["count"] for r in mixing.mix(docs).groupBy("lang").count().collect()}
    assert set(n) == {"en", "it", None} and abs(n[None] / 900 - 0.5 * 0.1 / 0.75 / 0.1) < 0.06
    unnamed = docs.filter("lang IS NULL")
    assert abs(mixing.mix(unnamed).count() / 900 - 0.5) < 0.06


def test_sample_meets_the_margins_of_the_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = mixing.with_probability(docs).select("cell.*", "tokens", "weight", "probability").cache()
    whole, drawn = held.agg(F.sum("tokens"), F.sum(F.col("tokens") * F.col("probability"))).first()
    assert held.filter("probability > 1 OR probability <= 0").count() == 0 and drawn / whole > 0.3
    for c in mixing.DIMENSIONS:
        rows = held.groupBy(c).agg(F.sum("tokens").alias("own"), F.sum(F.col("tokens") * F.col("probability")).alias("got")).collect()
        target = mixing.TARGETS[c]
        raw = {r[c]: target[r[c]] if c == "lang" else r.own ** target for r in rows}
        assert {r[c]: r.got / drawn for r in rows} == pytest.approx({k: v / sum(raw.values()) for k, v in raw.items()}, rel=0.01)


def test_few_cells_are_fitted_without_a_job_for_each_step(spark, monkeypatch):
    cells = spark.createDataFrame([(s, g, t, 10 + 7 * k) for k, (s, g, t) in enumerate(
        (s, g, t) for s in ("a", "b", None) for g in ("en", None) for t in "xy")], "source string, lang string, topic string, tokens long")

    def fitted(few):
        monkeypatch.setattr(staging, "FEW_ROWS", few)
        spark.sparkContext.setJobGroup(f"rake-{few}", "")
        try:
            weights = {r[:3]: r.weight for r in mixing.rake(cells, {"source": 0.5, "lang": {"en": 1.0, mixing.REST: 1.0}, "topic": 0.7}, keep=0.5).collect()}
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return weights, len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"rake-{few}"))

    (few, jobs), (dealt, many) = fitted(staging.FEW_ROWS), fitted(0)
    assert len(few) == 12 and few == pytest.approx(dealt)
    assert jobs < 50 < 100 < many
