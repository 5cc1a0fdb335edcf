"""Ordinal regression: the model by hand, held-out labels, and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.llm import toxicity


def test_thresholds_share_weights_and_stay_in_order():
    rng = np.random.default_rng(1)
    x = rng.normal(size=2000)
    grades = np.searchsorted([-0.5, 0.5, 1.5], x + rng.logistic(size=2000) * 0.1)
    model = toxicity.fit_arrays(
        np.arange(2000), np.zeros(2000, np.int64), x, grades, np.ones(2000), steps=600
    )
    assert len(model.cuts) == 3 and (np.diff(model.cuts) > 0).all()
    slope = model.weights[0]
    assert slope > 3
    assert np.allclose(model.cuts / slope, [-0.5, 0.5, 1.5], atol=0.15)
    over = model.passing(np.array([0]), np.array([1.0]))
    assert over.tolist() == sorted(over, reverse=True)


def test_expected_severity_is_the_mean_grade():
    model = toxicity.Model(np.ones(toxicity.BUCKETS), np.array([0.0, 1.0, 2.0]))
    over = model.passing(np.array([5]), np.array([0.7]))
    chances = -np.diff(np.concatenate([[1.0], over, [0.0]]))
    assert over.sum() == pytest.approx((chances * np.arange(4)).sum())


def test_features():
    keys, values = toxicity.features("Bad, bad BAD! good".encode())
    assert len(keys) == 2 and values @ values == pytest.approx(1)
    assert sorted(np.round(values / values.min(), 6)) == [1, round(1 + np.log(3), 6)]
    for empty in (None, b"", b" \n", b"!!! ---"):
        assert len(toxicity.features(empty)[0]) == 0


def test_stems_are_features_too():
    one, two = (set(toxicity.features(w)[0].tolist()) for w in (b"loweischaft", b"loweient"))
    assert len(one) == len(two) == 3 and len(one & two) == 2


def test_held_out_labels(spark, sf_dir, documents):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = toxicity.fit(big, labels.filter("doc_id % 3 <> 0"))
    rows = toxicity.score(big, model).join(labels, "doc_id").filter("doc_id % 3 = 0")
    insults = F.lower("text").rlike("idiot|pathetic|loser|scum|disgusting|clown|worthless|moron|trash|stupid")
    bad = rows.filter("toxic = 1").filter(insults)
    found = bad.agg(F.avg(F.col("is_toxic").cast("int"))).first()[0]
    wrong = rows.filter("toxic = 0").agg(F.avg(F.col("is_toxic").cast("int"))).first()[0]
    assert found >= 0.8 and wrong <= 0.02


def test_odd_rows(spark, docs, clashing):
    bad, good = "you stupid moron " * 3, "a nice calm day by the sea"
    rows = [(i, bad if i % 2 else good + f" {i}") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, None), (99, 1)], "doc_id long, toxic int")
    odd = docs(*rows, (None, bad), (41, None), (42, ""), (43, "!!!"), (44, bad * 20_000), (1, bad), (1, bad))
    model = toxicity.fit(odd, labels)
    scored = clashing(odd, "severity", "grade")
    got = toxicity.score(scored, model)
    assert got.columns == [*scored.columns, "severity_", "p_toxic", "grade_", "is_toxic"]
    by_id = {r.doc_id: r for r in got.collect()}
    assert by_id[1].is_toxic and by_id[44].is_toxic and by_id[None].is_toxic
    assert not by_id[0].is_toxic
    assert not any(by_id[i].is_toxic for i in (41, 42, 43))
    assert by_id[1].severity == "kept severity"
    assert got.filter("doc_id = 1").count() == 3
    assert got.filter("doc_id = 1").select("severity_").distinct().count() == 1


def test_fit_reads_all_features_of_long_texts(spark, docs):
    words = [f"u{i}" for i in range(9000)]
    bad = max((f"zk{i}" for i in range(4000)), key=lambda w: toxicity.features(w.encode())[0].min())
    rows = [(i, " ".join([*words[i : 8000 + i], *[bad] * (i % 2)])) for i in range(60)]
    cut = np.sort(toxicity.features(rows[1][1].encode())[0])[4000]
    assert toxicity.features(bad.encode())[0].min() > cut
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    model = toxicity.fit(docs(*rows), labels)
    assert (model.weights[toxicity.features(bad.encode())[0]] > 0).any()
    got = toxicity.score(docs((1, bad), (2, words[5])), model)
    severe = {r.doc_id: r.severity for r in got.collect()}
    assert severe[1] > severe[2] + 0.3


@pytest.mark.parametrize("labels", [[], [(0, 1)], [(0, 0), (1, None)]])
def test_without_both_classes_nothing_is_flagged(spark, docs, labels):
    rows = docs((0, "stupid"), (1, "fine"))
    model = toxicity.fit(rows, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert [(r.severity, r.is_toxic) for r in toxicity.score(rows, model).collect()] == [(0.0, False)] * 2
    assert toxicity.score(rows.limit(0), model).count() == 0
