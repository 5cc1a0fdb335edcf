"""Stages of the corpus pipeline. Each takes (spark, docs, sf_dir) and returns a DataFrame; all
but the last return the columns of `docs`. Texts are whole texts, and every decision rests on all
documents that the stage before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import decontam, langid, linededup, mixing, sigtree
from gaugeline.llm.common import settled, table

#: A document needs this share of its letters in spans of one language. Below a third it has no main
#: language; short texts with a notice in another language stay.
MAIN_LANGUAGE_SHARE = 1 / 3
#: And no more than this share in scripts that no learned language uses.
STRANGE_SHARE = 1 / 2
#: Near duplicates have a Jaccard similarity of 0.8 or more in their five-word shingles.
NEAR = sigtree.Rule(width=5, percent=80)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language, of those that the table's own labels teach.

    Rejected: texts that are null or have no letter, texts with most of their letters in scripts that
    no learned language uses, and texts whose main language covers less than a third of their
    letters, without those of such scripts. The `lang` column keeps the given value; where it is
    null, the predicted language takes its place."""
    model = langid.train(docs)
    given = docs.columns
    found = langid.identify(docs, model, shares=True)
    pred, _, _, share, strange = found.columns[len(given) :]
    kept = found.filter(
        (F.col(pred) != langid.UND)
        & (F.col(share) >= MAIN_LANGUAGE_SHARE)
        & (F.col(strange) <= STRANGE_SHARE)
    )
    return kept.withColumn("lang", F.coalesce("lang", pred)).select(*given)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line repeats, but for a word at most.
    Documents that lose all their lines go; `n_chars` follows the text."""
    given = docs.columns
    clean = linededup.drop_repeated_lines(docs)
    lines, dropped = clean.columns[len(given) :]
    kept = clean.filter(F.coalesce(F.size(dropped), F.lit(0)) < F.col(lines))
    changed = F.col(dropped).isNotNull()
    length = F.length("text").cast(dict(docs.dtypes)["n_chars"])
    return kept.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars"))).select(
        *given
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that with the smallest id, and of several texts of
    this id the one with the smallest hash. Documents without words stay. Of rows with equal id
    and text one stays, that with the smallest hash."""
    given = docs.columns
    same = sigtree.similar_texts(docs, NEAR)
    texts = same.groupBy("doc_id", "text_hash").agg(
        F.count("*").alias("rows"), F.min("component").alias("component")
    )
    # a null id is the smallest only if no other member has one
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "rows")
    first = (
        texts.filter(F.col("component").isNotNull())
        .groupBy("component")
        .agg(F.min(order).alias("first"))
        .select("first.doc_id", "first.text_hash", "first.rows")
    )
    wordless = texts.filter(F.col("component").isNull()).select("doc_id", "text_hash", "rows")
    chosen = settled(first.union(wordless))

    def of(found: DataFrame) -> DataFrame:
        here = docs["doc_id"].eqNullSafe(found["doc_id"])
        return docs.join(
            found, here & (F.xxhash64(docs["text"]) == found["text_hash"]), "left_semi"
        )

    kept, repeated = of(chosen.filter("rows = 1")), chosen.filter("rows > 1")
    if repeated.isEmpty():
        return kept.select(*given)
    row = F.struct(*[F.col(f"`{c}`") for c in given])
    ones = (
        of(repeated)
        .groupBy(F.col("doc_id").alias("key"), F.xxhash64("text").alias("text_hash"))
        .agg(F.min_by(row, F.xxhash64(row)).alias("row"))
        .select("row.*")
    )
    return kept.select(*given).union(ones)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    found = decontam.contaminated(docs, table(spark, sf_dir, "benchmark"))
    bad = settled(found.select(F.col("doc_id").alias("bad")).distinct())
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad"]), "left_anti")


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture draws them, with pass and place in the sequence."""
    return mixing.mixed_documents(docs)
