"""Near-duplicate lines by a deletion-neighbourhood join, in built-in expressions only.

Lines are compared in lower case and without white space at their ends. A line goes if an earlier line is
equal, however short it is, or alike; earlier means a smaller document id, then the smaller hash of
its text, then the smaller line number. Whether that earlier line goes itself does not matter.

Lines are alike as sequences of units: one insertion, deletion or replacement of a unit apart. Units are words, cut
at single blanks and tabs. A line of fewer than MIN_WORDS words but MIN_CHARS characters or more, as
scripts without blanks, long addresses and tables have, has its characters for units. With at least MIN_WORDS words or
MIN_CHARS characters, one edit is a similarity of 0.8 or 0.9 and more.

1. Lines that are alike share their first or last half, cut as for the longer one. Only lines
   that share a half with a different line go on; the others have equal lines at most.
2. These emit their variants: the line itself and the line without each of its units, as hashed
   keys. Equal keys meet after an aggregation that keeps the earliest line for each key and
   position, so a key with many lines costs one row for each position.
3. Equal variants are candidates. The units of both lines are compared before one goes.

Defined cases: a null text has no lines and stays null. Blank lines are never dropped and drop nothing.
Shorter lines than above go if they are equal to an earlier one. Equal rows (same id and text) are one
document and keep the same lines. A null id comes first. A document whose lines all go gets an
empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import fresh_name, settled

MIN_WORDS, MIN_CHARS = 5, 10
#: Stands before the characters of a line: two units, so that no words of one letter are one edit away.
_BY_CHARACTER = "\x01 \x01 "


def _norm(line: Column) -> Column:
    ends = F.lower(F.btrim(line, F.lit(" \t\r")))
    return F.when(ends.contains("\t"), F.replace(ends, F.lit("\t"), F.lit(" "))).otherwise(ends)


def _by_characters(norm: Column, n: Column, min_words: int) -> Column:
    return (n < min_words) & (F.length(norm) >= MIN_CHARS)


def _spaced(norm: Column) -> Column:
    """The characters of a line with blanks between them."""
    return F.concat(
        F.lit(_BY_CHARACTER), F.regexp_replace(norm, F.lit("(?s)(.)(?=.)"), F.lit("$1 "))
    )


def _n_words(norm: Column) -> Column:
    return F.length(norm) - F.length(F.replace(norm, F.lit(" "), F.lit(""))) + 1


def _first_words(norm: Column, n: Column) -> Column:
    """The first n words, or the last -n."""
    return F.call_function("substring_index", norm, F.lit(" "), n)


def _halves(norm: Column, n: Column) -> Column:
    """Keys of the first and last half, cut as for a line of n and of n + 1 words."""
    keys = []
    for longer in (n, n + 1):
        first = F.floor(longer / 2).cast("int")
        keys.append(F.xxhash64(longer, F.lit(1), _first_words(norm, first)))
        keys.append(F.xxhash64(longer, F.lit(2), _first_words(norm, first - longer)))
    return F.array(*keys)


def _alike(a: Column, b: Column) -> Column:
    """Whether two arrays of words are at most one edit apart: all but one word of the longer one
    lie in the common start and the common end."""

    def same(left, right):
        equal = F.zip_with(left, right, lambda x, y: x.eqNullSafe(y))
        at = F.array_position(equal, F.lit(False))
        return F.when(at == 0, F.size(equal)).otherwise(at - 1)

    longer = F.greatest(F.size(a), F.size(b))
    return same(a, b) + same(F.reverse(a), F.reverse(b)) >= longer - 1


def _of_documents(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Join on id and hash of the text; a null id is a value like any other."""
    same = docs["id"].eqNullSafe(found["id"]) & (docs["text_hash"] == found["text_hash"])
    return docs.join(found, same, how).drop(found["id"], found["text_hash"])


def _variants(texts: DataFrame) -> DataFrame:
    """(line, place, at, key): each line whole (at -1) and without its word `at`, hashed. Words are
    hashed once; a variant is a hash of these hashes."""
    hashes = F.col("hashes")
    at = F.col("at")
    without = F.concat(F.slice(hashes, 1, at), F.slice(hashes, at + 2, F.size(hashes)))
    return (
        texts.select(
            "line", "place", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes")
        )
        .select(
            "line", "place", "hashes", F.explode(F.sequence(F.lit(-1), F.size(hashes) - 1)).alias("at")
        )
        .select("line", "place", "at", F.xxhash64(F.when(at < 0, hashes).otherwise(without)).alias("key"))
    )


def _earlier_alike(texts: DataFrame) -> DataFrame:
    """(line, before): the place of the earliest line that is one edit away and stands earlier."""
    variants = _variants(texts)
    best = (
        variants.groupBy("key", "at")
        .agg(F.min(F.struct("place", "line")).alias("first"))
        .select("key", F.col("at").alias("best_at"), "first")
    )
    pairs = (
        variants.join(best, "key")
        .filter("(at = best_at or at = -1 or best_at = -1) and first.line <> line")
        .filter(F.col("first.place") < F.col("place"))
        .select("line", F.col("first.line").alias("other"), F.col("first.place").alias("before"))
        .distinct()
    )
    words = texts.select("line", "words")
    others = texts.select(F.col("line").alias("other"), F.col("words").alias("other_words"))
    return (
        pairs.join(words, "line")
        .join(others, "other")
        .filter(_alike(F.col("words"), F.col("other_words")))
        .groupBy("line")
        .agg(F.min("before").alias("before"))
    )


def _source(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).withColumn(
        "text_hash", F.xxhash64("text")
    )


def repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """(id, text_hash, dropped): for each document that loses lines, their numbers, from 0."""
    source = _source(docs, doc_id, text)
    norm = F.col("norm")
    # four hashes and a place for each line
    lines = settled(
        source.filter(F.col("text").isNotNull())
        .select("id", "text_hash", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
        .select("id", "text_hash", "line_no", _norm(F.col("line")).alias("norm"))
        .filter(norm != "")
        .withColumn("n", _n_words(norm))
        .withColumn("spaced", F.when(_by_characters(norm, F.col("n"), min_words), _spaced(norm)))
        .select(
            "id",
            "text_hash",
            "line_no",
            F.when(F.col("spaced").isNull(), F.xxhash64(norm)).otherwise(F.xxhash64("spaced")).alias("line"),
            # shorter lines have no variants: they only meet their equals
            F.when(F.col("n") >= min_words, _halves(norm, F.col("n")))
            .when(F.col("spaced").isNotNull(), _halves(F.col("spaced"), _n_words(F.col("spaced"))))
            .alias("halves"),
        )
    )
    place = F.struct("id", "text_hash", "line_no")
    firsts = lines.groupBy("line").agg(F.min(place).alias("place"), F.count("*").alias("times"))

    halves = lines.select("line", F.explode("halves").alias("half"))
    shared = (
        halves.groupBy("half")
        .agg(F.min("line").alias("low"), F.max("line").alias("high"))
        .filter("low <> high")
        .select("half")
    )
    candidates = halves.join(shared, "half", "left_semi").select("line").distinct()
    wanted = (
        firsts.join(candidates, "line", "left_semi")
        .groupBy(F.col("place.id").alias("id"), F.col("place.text_hash").alias("text_hash"))
        .agg(F.collect_list(F.struct("line", F.col("place.line_no").alias("at"))).alias("wanted"))
    )

    def units(norm: Column) -> Column:
        by_characters = _by_characters(norm, _n_words(norm), min_words)
        return F.split(F.when(by_characters, _spaced(norm)).otherwise(norm), " ")

    cut = F.transform(
        "wanted",
        lambda w: F.struct(
            w["line"].alias("line"),
            w["at"].alias("line_no"),
            units(_norm(F.get(F.col("all"), w["at"]))).alias("words"),
        ),
    )
    texts = settled(
        _of_documents(source, wanted, "inner")
        .select("id", "text_hash", "wanted", F.split("text", "\n").alias("all"))
        .select("id", "text_hash", F.explode(cut).alias("x"))
        .select(
            "x.line", F.struct("id", "text_hash", "x.line_no").alias("place"), "x.words"
        )
    )
    dropping = (
        firsts.join(_earlier_alike(texts), "line", "left")
        .filter("times > 1 or before is not null")
        .select("line", F.least("place", "before").alias("kept"))
    )
    return (
        lines.select("id", "text_hash", "line_no", "line")
        .join(dropping, "line")
        .filter(place > F.col("kept"))
        .groupBy("id", "text_hash")
        .agg(F.sort_array(F.collect_set("line_no")).alias("dropped"))
    )


def drop_repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """`docs` with the text without its repeated lines, and the columns `n_lines` (before) and
    `dropped_lines` (their numbers; null if none went)."""
    names = [fresh_name(docs.columns, x) for x in ("n_lines", "dropped_lines")]
    dropped = settled(repeated_lines(docs, doc_id, text, min_words))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(doc_id).alias("id"),
        F.xxhash64(F.col(text)).alias("text_hash"),
        F.col(text).alias("text"),
    )
    joined = _of_documents(rows, dropped, "left")
    lines = F.split("text", "\n")
    rest = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    clean = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(rest, lambda i: F.get(F.col("lines"), i)), "\n")
    )
    kept = [
        clean.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns
    ]
    return joined.withColumn("lines", lines).select(
        *kept,
        F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).alias(names[0]),
        F.col("dropped").alias(names[1]),
    )
