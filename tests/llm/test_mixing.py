"""Weights against a bisection in Python, draws against their budgets."""

import collections
import math

import pytest
from pyspark.sql import functions as F

from gaugeline.llm import mixing


def solve(tokens, entropy, repeats, budget):
    """The exponent by plain bisection."""
    total = sum(tokens)
    share = [t / total for t in tokens]

    def weights(t):
        power = [p**t for p in share]
        return [x / sum(power) for x in power]

    def bisect(good):
        low, high = 0.0, 1.0
        if good(1.0):
            return 1.0
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if good(middle) else (low, middle)
        return low

    wanted = entropy * math.log(len(tokens)) - 1e-12
    t = bisect(lambda x: -sum(w * math.log(w) for w in weights(x)) >= wanted)
    allowed = repeats * total / budget
    over = lambda x: max(w / p for w, p in zip(weights(x), share)) > allowed * (1 + 1e-12)
    if over(t):
        low, high = t, 1.0
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if over(middle) else (low, middle)
        t = high
    return t, weights(t)


@pytest.mark.parametrize(
    "tokens, entropy, repeats",
    [
        ([100, 100, 100], 0.95, 4), ([9000, 500, 300, 200], 0.9, 4), ([9000, 500, 300, 20], 0.99, 4),
        ([7, 1], 1.0, 100), ([1000], 0.95, 4), ([10**9, 1], 0.95, 2),
    ],
)
def test_weights(spark, tokens, entropy, repeats):
    counted = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(tokens)], "source string, tokens long")
    rows, exponent = mixing.source_weights(counted, None, entropy, repeats)
    t, weights = solve(tokens, entropy, repeats, sum(tokens))
    got = {r.source: r.weight for r in rows.collect()}
    assert exponent == pytest.approx(t, abs=1e-5)
    assert [got[f"s{i}"] for i in range(len(tokens))] == pytest.approx(weights, abs=1e-4)
    assert sum(got.values()) == pytest.approx(1)


def many(spark, budget=None):
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.expr("trim(repeat('w ', int(1 + id % 17)))").alias("text"),
        F.expr("case when id % 3 = 0 then 'hot' when id % 40 = 1 then null else concat('s', id % 11) end").alias("source"),
    )
    return rows, mixing.drawn(rows, budget=budget)


@pytest.mark.parametrize("budget, block", [(None, 1024), (5_000, 64), (200_000, 64)])
def test_budgets_are_met_by_whole_passes_and_one_that_ends(spark, monkeypatch, budget, block):
    monkeypatch.setattr(mixing, "BLOCK", block)
    rows, draws = many(spark, budget)
    counted = rows.select("source", mixing.tokens(F.col("text")).alias("tokens"))
    weights, _ = mixing.source_weights(counted, budget)
    sizes = {r.source: (r.n, r.t) for r in counted.groupBy("source").agg(F.count("*").alias("n"), F.sum("tokens").alias("t")).collect()}
    got = collections.defaultdict(list)
    for r in draws.collect():
        got[r.source].append(r)
    for w in weights.collect():
        n, total = sizes[w.source]
        drawn = got[w.source]
        whole, rest = divmod(w.budget, total)
        by_pass = collections.defaultdict(list)
        for r in drawn:
            by_pass[r["pass"]].append(r)
        for number in range(whole):
            assert len({r.id for r in by_pass[number]}) == len(by_pass[number]) == n
        last = sorted(by_pass.get(whole, []), key=lambda r: (r.block_order, r.order, r.id))
        assert len({r.id for r in last}) == len(last)
        taken = sum(r.tokens for r in last)
        assert rest <= taken < rest + 17 if rest else not last
        # blocks follow each other, and only the last one is cut
        assert len(by_pass) == whole + bool(rest)
    orders = {s: [r.id for r in sorted(x, key=lambda r: (r["pass"], r.block_order, r.order))] for s, x in got.items()}
    if budget == 200_000:
        first, second = orders["hot"][:1000], orders["hot"][1000:2000]
        assert sorted(first) == sorted(second) and first != second


def test_draws_can_be_repeated(spark):
    one, two = (sorted(map(str, many(spark)[1].collect())) for _ in range(2))
    assert one == two


def test_documents_as_often_as_drawn(docs, clashing):
    rows = [(i, "one two three " * (1 + i % 3), "en", "big" if i else "small") for i in range(30)]
    frame = clashing(docs(*rows), "pass")
    got = mixing.mixed_documents(frame)
    assert got.columns == [*frame.columns, "pass_", "block_order", "order"]
    counts = collections.Counter(r.doc_id for r in got.collect())
    draws = collections.Counter(r.id for r in mixing.drawn(frame).collect())
    assert counts == draws and counts[0] >= 2


def test_odd_rows(docs):
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "x y", "en", "a"), (None, "z", "en", None), (4, "q " * 100_000, "en", "b"), (5, "same", "en", "c"), (5, "same", "en", "c")]
    got = collections.Counter(r.id for r in mixing.drawn(docs(*rows)).collect())
    assert set(got) == {3, None, 4, 5} and got[5] % 2 == 0
    assert mixing.drawn(docs()).count() == 0
    assert mixing.mixed_documents(docs((1, " ", "en", "a"))).count() == 0


def test_a_limit_that_cannot_be_met_is_told(docs):
    frame = docs(*((i, "one two three four", None, "s") for i in range(6)))
    with pytest.warns(UserWarning, match="more than 4"):
        assert mixing.drawn(frame, budget=240, repeats=4.0).count() == 60
    assert mixing.drawn(frame, budget=48, repeats=4.0).count() == 12


def test_texts_are_not_dealt_out(spark, capsys):
    rows, _ = many(spark)
    mixing.mixed_documents(rows, budget=9_000).explain()
    plan = capsys.readouterr().out
    assert "BroadcastExchange" in plan and "Exchange hashpartitioning" not in plan and "Sort" not in plan


@pytest.mark.parametrize("budget", [None, 700, 40_000])
def test_documents_are_those_drawn(spark, monkeypatch, budget):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    rows, _ = many(spark)
    twice = rows.unionByName(rows.filter("doc_id % 5 = 0"))
    rows = twice.withColumn("doc_id", F.when(F.col("doc_id") % 50 != 3, F.col("doc_id")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        draws = [(r.id, r.source, r["pass"], r.block_order, r.order) for r in mixing.drawn(rows, budget=budget).collect()]
        got = [(r.doc_id, r.source, r["pass"], r.block_order, r.order) for r in mixing.mixed_documents(rows, budget=budget).collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(str, got)) == sorted(map(str, draws))
    by_default = mixing.mixed_documents(rows, budget=budget).select("doc_id", "source", "pass", "block_order", "order")
    assert sorted(map(str, map(tuple, by_default.collect()))) == sorted(map(str, draws))
