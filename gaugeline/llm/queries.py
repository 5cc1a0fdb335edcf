"""The operators as queries over the given tables: name -> function(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import (
    decontam,
    iblt,
    langid,
    licenses,
    linededup,
    mixing,
    mixlm,
    prefix_bpe,
    repair,
    sigtree,
    toxicity,
    warc,
    whitening,
)
from gaugeline.llm.common import id_bucket, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity of every document, by a model of the labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).drop("text")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_bucket(F.col("doc_id"), 3) == 1, F.lit(False))
    model = langid.train(docs.filter(~held_out))
    found = langid.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.select(
        "doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans")
    )


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and how near they are."""
    return iblt.fingerprints(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier line repeats, but for a word at most."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.drop_repeated_lines(docs)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items that they contain, in part or whole."""
    return decontam.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose three-word shingles are at least 0.9 alike."""
    return sigtree.similar_documents(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and found again through the capture index."""
    pages = table(spark, sf_dir, "pages")
    _, shards, folder = warc.archive(spark, pages)
    keys = pages.select(warc.key_of(F.col("url"), F.col("page_id")).alias("key")).distinct()
    return warc.look_up(keys, shards, folder, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each time that a document is drawn, in an order for each source."""
    draws = mixing.drawn(table(spark, sf_dir, "documents"))
    return draws.withColumnRenamed("id", "doc_id").drop("text_hash")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every document."""
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = F.transform("licences", lambda m: m["licence"])
    return found.select(
        "doc_id",
        F.array_sort(F.array_distinct(names)).alias("licence_ids"),
        F.size("licences").alias("n_matches"),
        F.array_max(F.transform("licences", lambda m: m["dice"])).alias("best_dice"),
        "licences",
    )


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document, learned from those that are not held out."""
    training = F.coalesce(id_bucket(F.col("doc_id"), 7) != 2, F.lit(True))
    return mixlm.scores(table(spark, sf_dir, "documents"), training)


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by a byte-level vocabulary and decoded again."""
    import public_tokenizers

    ranks = prefix_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = prefix_bpe.encode(docs, ranks, public_tokenizers.PATTERN).drop("text")
    return prefix_bpe.decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the leading components of the distinct ones, in steps of 1/64."""
    fine = whitening.usable(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    steps = F.transform("embedding", lambda c: F.floor(64 * c.cast("double")) + F.lit(1_000_000))
    rows = fine.select("vec_id", steps.alias("x"))
    model = whitening.fit(rows.select("x").distinct(), "x")
    n, sums = F.lit(model.n).cast("long"), F.array(*[F.lit(s).cast("long") for s in model.sums])
    apart = F.zip_with("x", sums, lambda x, s: F.try_subtract(F.try_multiply(n, x), s))
    # null where it does not fit a long
    deviation = F.aggregate(
        apart, F.lit(0).cast("long"), lambda total, a: F.try_add(total, F.try_multiply(a, a))
    )
    total = model.trace or 1.0
    explained = F.array(*[F.lit(float(e) / total) for e in model.values]).cast("array<double>")
    found = whitening.whiten(rows.select("*", deviation.alias("deviation")), model, "x").select(
        "vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")
    )
    return found.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        n.alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every conversation, after known damage to its rows."""
    return repair.damaged_and_repaired(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_language_id": op2_language_id,
    "op3_license_scan": op3_license_scan,
    "op4_fingerprints": op4_fingerprints,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_line_dedup": op6_line_dedup,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_source_mixing": op8_source_mixing,
    "op9_decontamination": op9_decontamination,
    "op10_warc": op10_warc,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_whitening": op12_whitening,
    "op13_conversation_repair": op13_conversation_repair,
}
