"""Temperature mixing of sources to target weights.

Token shares p of the sources are raised to an exponent t and normalised: t = 1 keeps the shares, t
= 0 makes all sources equal. The exponent is found by bisection: the largest t of at most 1 whose
weights have the wanted entropy (a share of the largest possible one), unless that would repeat
some source more often than allowed; then the smallest t that does not. Each step of the bisection
is an aggregation over the sources, with STEPS exponents at once, so that the sources need not
fit on one machine.

The weights are then realised as block permutations. A source gets its weight's share of the token
budget. Its documents are dealt to blocks of about BLOCK documents by hash. A pass goes through the
blocks in an order of its own and through the documents of each block in an order of its own;
there are as many whole passes as the budget holds, and one that ends when the budget is
reached. Only the block in which the last pass ends is cut, between documents: the
document during which the budget runs out is the last one. Sums run over blocks first and then
within that block, so no task holds more than one block or the list of a source's blocks.
Where the last pass ends is one place for each source. With it every document finds its own draws,
so texts meet the table of sources and are not dealt out by document.

Defined cases: documents without tokens (null, empty or blank text) are left out. A null source is a
source. A single source keeps weight 1. A budget that repeats even all tokens together more often than allowed
is met nevertheless: the weights are the shares, which repeat least, and a warning says so. An empty table gives an empty result. Rows with equal id
are separate documents, told apart by their text; equal rows are drawn alike.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import WORD, fresh_name, settled

#: Share of the largest possible entropy that the weights should have.
ENTROPY = 0.95
#: Passes over any one source at most.
REPEATS = 4.0
STEPS = 32
ROUNDS = 5
BLOCK = 1024
SEED = 17


def tokens(text: Column) -> Column:
    """Words of a text."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def _measured(sources: DataFrame, exponents: list[float]) -> list[tuple[float, float, float]]:
    """For each exponent: entropy of the weights, and the largest of weight / share."""
    columns = []
    for i, t in enumerate(exponents):
        power = F.exp(F.col("log_share") * t)
        columns += [
            F.sum(power).alias(f"z{i}"),
            F.sum(power * F.col("log_share") * t).alias(f"l{i}"),
            F.max(F.exp(F.col("log_share") * (t - 1.0))).alias(f"r{i}"),
        ]
    row = sources.agg(*columns).first()
    return [
        (t, math.log(row[f"z{i}"]) - row[f"l{i}"] / row[f"z{i}"], row[f"r{i}"] / row[f"z{i}"])
        for i, t in enumerate(exponents)
    ]


def _bisected(sources: DataFrame, holds) -> float:
    """The largest exponent in [0, 1] for which `holds`, given that it holds below it."""
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        grid = [low + (high - low) * i / STEPS for i in range(STEPS + 1)]
        good = [t for t, entropy, ratio in _measured(sources, grid) if holds(entropy, ratio)]
        low = max(good, default=0.0)
        if low >= high:
            return high
        high = min(t for t in grid if t > low)
    return low


def source_weights(
    counted: DataFrame,
    budget: int | None = None,
    entropy: float = ENTROPY,
    repeats: float = REPEATS,
) -> tuple[DataFrame, float]:
    """(source, tokens, weight, budget) and the exponent, from (source, tokens) of documents. The
    budget is that of all tokens unless given."""
    sources = settled(
        counted.groupBy("source").agg(F.sum("tokens").alias("tokens")).filter("tokens > 0")
    )
    whole = sources.agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")).first()
    total, n = whole["tokens"] or 0, whole["n"]
    if n == 0:
        empty = sources.select(
            "source", "tokens", F.lit(0.0).alias("weight"), F.lit(0).cast("bigint").alias("budget")
        )
        return empty, 1.0
    budget = total if budget is None else budget
    if budget > repeats * total * (1 + 1e-12):
        message = f"{budget} tokens repeat the {total} there are more than {repeats} times"
        warnings.warn(message, stacklevel=2)
    shared = sources.withColumn("log_share", F.log(F.col("tokens") / F.lit(total)))
    wanted = entropy * math.log(n) - 1e-12
    exponent = _bisected(shared, lambda found, _: found >= wanted)
    allowed = repeats * total / budget * (1 + 1e-12)
    ((_, _, ratio),) = _measured(shared, [exponent])
    if ratio > allowed:
        # larger exponents repeat small sources less; 1 - t turns the search round
        low, high = exponent, 1.0
        for _ in range(ROUNDS):
            grid = [low + (high - low) * i / STEPS for i in range(STEPS + 1)]
            bad = [t for t, _, r in _measured(shared, grid) if r > allowed]
            low = max(bad, default=low)
            high = min((t for t in grid if t > low), default=1.0)
        exponent = high
    power = F.exp(F.col("log_share") * exponent)
    norm = shared.agg(F.sum(power).alias("z")).first()["z"]
    weight = power / F.lit(norm)
    return (
        shared.select("source", "tokens", weight.alias("weight")).withColumn(
            "budget", F.round(F.col("weight") * F.lit(float(budget))).cast("bigint")
        ),
        exponent,
    )


def _hash(*columns: Column | str) -> Column:
    return F.xxhash64(F.lit(SEED), *columns)


def _block() -> Column:
    return F.pmod(_hash(F.lit(1), "id", "text_hash"), F.col("blocks"))


def _block_order(number: str, block: Column) -> Column:
    """Place of a block in a pass over its source, whose number is in the column `number`."""
    return _hash(F.lit(2), "source", number, block)


def _order(number: str) -> Column:
    """Place of a document in its block."""
    return _hash(F.lit(3), "source", number, "id", "text_hash")


def _counted(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    return settled(
        docs.select(
            F.col(doc_id).alias("id"),
            F.xxhash64(text).alias("text_hash"),
            F.col(source).alias("source"),
            tokens(F.col(text)).alias("tokens"),
        ).filter("tokens > 0")
    )


def _planned(
    counted: DataFrame,
    budget: int | None = None,
    entropy: float = ENTROPY,
    repeats: float = REPEATS,
) -> DataFrame:
    """A row for each source `of`, with all that its documents need to know how often they are drawn:
    the whole passes, and the place where the last, partial one ends. That is the block `stop`; of
    a `cut` block the documents up to `upto`. Both are null if no partial pass is left."""
    weights, _ = source_weights(counted, budget, entropy, repeats)
    sizes = counted.groupBy("source").agg(
        F.count("*").alias("docs"), F.sum("tokens").alias("source_tokens")
    )
    plan = (
        sizes.alias("s")
        .join(weights.alias("w"), F.expr("s.source <=> w.source"))
        .select(
            F.col("s.source").alias("of"),
            F.ceil(F.col("docs") / BLOCK).cast("bigint").alias("blocks"),
            "weight",
            F.expr("budget div source_tokens").alias("whole"),
            F.expr("budget % source_tokens").alias("rest"),
        )
    )
    # one row for each source on the right; a hot source is split on the left
    placed = counted.join(plan, F.expr("source <=> of")).withColumn("block", _block())
    # where the last, partial pass ends: running sums over the blocks of a source
    by_block = (
        placed.groupBy("source", "block")
        .agg(
            F.sum("tokens").alias("in_block"),
            F.first("whole").alias("whole"),
            F.first("rest").alias("rest"),
        )
        .withColumn("block_order", _block_order("whole", F.col("block")))
    )
    running = Window.partitionBy("source").orderBy("block_order", "block")
    cut = F.col("before") + F.col("in_block") > F.col("rest")
    ends = (
        by_block.withColumn("before", F.sum("in_block").over(running) - F.col("in_block"))
        .filter("before < rest")
        .groupBy(F.col("source").alias("ending"))
        .agg(
            F.max(
                F.struct(F.struct("block_order", "block").alias("stop"), "before", cut.alias("cut"))
            ).alias("end")
        )
        .select("ending", "end.*")
    )
    within = Window.partitionBy("source").orderBy("order", "id", "text_hash")
    upto = (
        placed.join(ends, F.expr("source <=> ending and block = stop.block"))
        .filter("cut")
        .withColumn("order", _order("whole"))
        .withColumn(
            "sofar", F.col("before") + F.sum("tokens").over(within) - F.col("tokens")
        )
        .filter("sofar < rest")
        .groupBy(F.col("source").alias("cutting"))
        .agg(F.max(F.struct("order", "id", "text_hash")).alias("upto"))
    )
    return settled(
        plan.join(ends, F.expr("of <=> ending"), "left")
        .join(upto, F.expr("of <=> cutting"), "left")
        .select("of", "blocks", "weight", "whole", "stop", "cut", "upto")
    )


def _draws(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """`rows`, which have id, text_hash and source, once for each draw, with weight, pass, block_order
    and order. Each row meets the one row of its source and no other document."""
    place = F.struct(_block_order("whole", F.col("block")).alias("block_order"), "block")
    key = F.struct(_order("whole").alias("order"), "id", "text_hash")
    before = place < F.col("stop")
    within = (place == F.col("stop")) & (~F.col("cut") | (key <= F.col("upto")))
    times = F.col("whole") + F.when(before | within, 1).otherwise(0).cast("bigint")
    numbers = F.sequence(F.lit(0).cast("bigint"), F.col("times") - 1)
    return (
        # one row for each source on the right; a hot source is split on the left
        rows.join(plan, F.expr("source <=> of"))
        .withColumn("block", _block())
        .withColumn("times", times)
        .filter("times > 0")
        .withColumn("pass", F.explode(numbers))
        .withColumn("block_order", _block_order("pass", F.col("block")))
        .withColumn("order", _order("pass"))
        .select(*rows.columns, "weight", "pass", "order", "block_order")
    )


def drawn(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    budget: int | None = None,
    entropy: float = ENTROPY,
    repeats: float = REPEATS,
) -> DataFrame:
    """(id, text_hash, source, tokens, weight, pass, block_order, order) with a row for each time
    that a document is drawn; passes count from 0. Sorting a source by pass, block_order, order,
    id and text_hash gives its sequence."""
    counted = _counted(docs, doc_id, text, source)
    return _draws(counted, _planned(counted, budget, entropy, repeats))


def mixed_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    **settings,
) -> DataFrame:
    """`docs`, each as often as it is drawn, with its `pass`, `block_order` and `order`."""
    plan = _planned(_counted(docs, doc_id, text, source), **settings)
    names = [fresh_name(docs.columns, x) for x in ("pass", "block_order", "order")]
    rows = docs.filter(F.col(text).rlike(WORD)).select(
        F.struct("*").alias("row"),
        F.col(doc_id).alias("id"),
        F.xxhash64(text).alias("text_hash"),
        F.col(source).alias("source"),
    )
    added = [F.col(a).alias(b) for a, b in zip(("pass", "block_order", "order"), names)]
    return _draws(rows, plan).select("row.*", *added)
