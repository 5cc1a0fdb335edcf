"""Viterbi against all label sequences, spans of mixed text, scripts, held-out accuracy."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.llm import langid
from gaugeline.llm.queries import QUERIES


@pytest.mark.parametrize("seed", range(30))
def test_best_path_is_the_best_of_all(seed):
    rng = np.random.default_rng(seed)
    words, langs = rng.integers(1, 8), rng.integers(1, 4)
    scores = rng.normal(scale=3, size=(words, langs))
    penalty = float(rng.choice([0.5, 2.0, 8.0]))

    def value(path):
        switches = sum(a != b for a, b in zip(path, path[1:]))
        return sum(scores[t, l] for t, l in enumerate(path)) - penalty * switches

    best = max(value(p) for p in itertools.product(range(langs), repeat=words))
    assert value(langid.best_path(scores, penalty).tolist()) == pytest.approx(best)


@pytest.fixture(scope="module")
def model(spark):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return langid.train(big)


def test_spans_of_mixed_text(spark, docs, model):
    german = "und die der von mit auf für eine nicht auch sich das " * 3
    french = "les des une dans pour avec est que qui sur par vous " * 3
    [row] = langid.identify(docs((1, german + french)), model).collect()
    assert [s.lang for s in row.spans] == ["de", "fr"]
    assert [s.first_word for s in row.spans] == [0, 36] and [s.words for s in row.spans] == [36, 36]
    assert row.score == pytest.approx(max(s.letters for s in row.spans) / sum(s.letters for s in row.spans))


def test_scripts_narrow_the_languages(spark, docs):
    rows = [(i, "привет мир как дела", "ru") for i in range(3)] + [(9, "hello world how are you", "en")]
    found = langid.train(docs(*rows))
    for text, lang in (("привет world дела мир мир", "ru"), ("zzzz", "en"), ("жжжж", "ru")):
        assert found.label(text, 16.0)[0] == lang
    # a script that nobody uses leaves every language possible
    assert found.label("漢字", 16.0)[0] in ("en", "ru")


def test_held_out_accuracy(spark):
    got = QUERIES["op2_language_id"](spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = got.join(truth, "doc_id").filter("held_out")
    right = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert held.count() > 250 and right >= 0.98


def test_the_split_is_that_of_crc32(spark, sf_dir):
    import zlib

    got = QUERIES["op2_language_id"](spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 for r in got)


def test_odd_rows(spark, docs, model, clashing):
    odd = clashing(
        docs((1, None), (2, ""), (3, "123 !!! ---"), (None, "der die und"), (5, "der die und " * 200_000), (5, "x"), (5, "x")),
        "score",
        "spans",
    )
    got = langid.identify(odd, model)
    assert got.columns == [*odd.columns, "lang_pred", "score_", "spans_"]
    rows = got.collect()
    assert [(r.lang_pred, r.score_, r.spans_) for r in rows if r.doc_id in (1, 2, 3)] == [("und", 0.0, [])] * 3
    assert {r.lang_pred for r in rows if r.doc_id is None} == {"de"}
    assert {(r.lang_pred, r.score_) for r in rows if r.text and len(r.text) > 1000} == {("de", 1.0)}
    assert len(rows) == 7


def test_nothing_to_learn_from(spark, docs):
    none = langid.train(docs((1, "text", None), (2, None, "en")))
    assert none.langs == [] and none.label("text", 16.0)[0] == "und"
    assert langid.identify(docs(), none).count() == 0


def test_pieces_do_not_cut_words(model, monkeypatch):
    text = "der die und eine nicht auch mit auf für von sich das " * 40
    want = model.word_scores(text)
    monkeypatch.setattr(langid, "PIECE", 37)
    got = model.word_scores(text)
    assert np.allclose(got[0], want[0]) and (got[1] == want[1]).all()
