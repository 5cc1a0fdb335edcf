"""The pipeline's stages, each against plain Python on its own input."""

import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gaugeline.llm import mixing, stages
from gaugeline.llm.common import settled
from test_linededup import brute as brute_lines
from test_sigtree import brute as brute_near

NAMES = ["language_id", "line_dedup", "near_duplicates", "decontamination", "source_mixing"]


@pytest.fixture(scope="module")
def inputs(spark, sf_dir):
    """What each stage was given, and what the last returned."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        found[name] = docs
        docs = settled(stage(spark, docs, sf_dir))
    found["end"] = docs
    return found


def rows(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_names_and_columns(inputs, documents):
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES
    for name in NAMES:
        assert inputs[name].columns == documents.columns
        assert inputs[name].dtypes == documents.dtypes
    assert inputs["end"].columns == [*documents.columns, "pass", "block_order", "order"]


def test_languages(inputs):
    before, after = rows(inputs["language_id"]), rows(inputs["line_dedup"])
    gone = set(before) - set(after)
    assert len(gone) <= 0.02 * len(before)
    assert all(after[i] == before[i] for i in after)


def test_lines(inputs):
    before, after = rows(inputs["line_dedup"]), rows(inputs["near_duplicates"])
    dropped = brute_lines([(i, r.text) for i, r in before.items()])
    for i, r in before.items():
        lines = r.text.split("\n")
        left = [x for k, x in enumerate(lines) if k not in dropped.get(i, ())]
        assert (i in after) == bool(left)
        if left:
            assert after[i].text == "\n".join(left)
            assert after[i].n_chars == (len(after[i].text) if i in dropped else r.n_chars)


def test_near_duplicates(inputs):
    before, after = rows(inputs["near_duplicates"]), rows(inputs["decontamination"])
    groups = brute_near([(i, r.text) for i, r in before.items()], stages.NEAR)
    assert set(after) == {component for _, _, component in groups}
    assert all(after[i] == before[i] for i in after)


def test_benchmark(spark, sf_dir, inputs):
    before, after = rows(inputs["decontamination"]), rows(inputs["source_mixing"])
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaked = {i for i, r in before.items() if any(t in r.text for t in items)}
    assert leaked.isdisjoint(after)
    words = [set(t.lower().split()) for t in items]
    for i in set(before) - set(after) - leaked:  # not whole, but most of an item
        assert max(len(w & set(before[i].text.lower().split())) / len(w) for w in words) > 0.8


def test_mixing(inputs):
    before, end = inputs["source_mixing"], inputs["end"]
    draws = collections.Counter(r.id for r in mixing.drawn(before).collect())
    assert collections.Counter(r.doc_id for r in end.collect()) == draws
    assert end.select(*before.columns).distinct().exceptAll(before).count() == 0


def test_run_is_the_stages(spark, sf_dir, inputs):
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(str, whole.collect())) == sorted(map(str, inputs["end"].collect()))


def test_scripts_that_no_language_uses(spark, sf_dir, docs):
    german, english = "der Hund und die Katze sind im Haus ", "the dog and the cat are in the house "
    rows = docs(
        (1, german * 9, "de", "a"), (2, english * 9, "en", "a"), (3, "漢字の文章 " * 9, None, "a"),
        (4, "собака и кошка в доме " * 9, None, "a"), (5, german * 3 + "собака и кошка " * 2, None, "a"),
        (6, german + "собака и кошка " * 9, None, "a"), (7, english * 9 + "漢字", None, "a"),
    )
    got = {r.doc_id: r.lang for r in stages.language_id(spark, rows, sf_dir).collect()}
    assert got == {1: "de", 2: "en", 5: "de", 7: "en"}


def test_one_row_of_each_group(spark, sf_dir, docs):
    one, other, third = (" ".join(f"{w}{i}" for i in range(60)) for w in "abc")
    rows = docs(
        (1, one, "en", "a"), (1, one, "en", "b"), (1, one, "en", "a"), (2, other), (3, other), (3, third),
        (4, one + " x"), (5, ""), (5, ""), (5, None), (6, None), (2, third + " y"), (None, other), (None, "z"),
        (None, "z"), (8, "d " + other), (8, "only this"),
    )
    got = [(r.doc_id, r.text) for r in stages.near_duplicates(spark, rows, sf_dir).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, one), (2, other), (2, third + " y"), (5, ""), (5, None), (6, None), (None, "z"), (8, "only this")],
        key=str,
    )


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_rows(spark, sf_dir, docs, name, stage):
    text = "the quick brown fox jumps over the lazy dog and runs away from the cat"
    odd = docs(
        (1, None), (2, ""), (3, "123"), (4, text, "en", "a"), (5, text, "en", "a"), (None, text + " x", "en", None),
        (6, "short", "en", "b"), (7, "w" * 50_000, "en", "b"), (7, "w" * 50_000, "en", "b"),
    )
    got = stage(spark, odd, sf_dir)
    if name != "source_mixing":
        assert got.columns == odd.columns
    assert got.count() <= (36 if name == "source_mixing" else 9)
    empty = stage(spark, odd.limit(0), sf_dir)
    assert empty.columns[:5] == odd.columns and empty.count() == 0
    wider = stage(spark, odd.withColumn("id", F.lit(1)).withColumn("row", F.lit(2)), sf_dir)
    assert set(odd.columns) | {"id", "row"} <= set(wider.columns) and wider.count() == got.count()
