"""Helpers shared by the operators: words, hashing, materialised steps, connected components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import fields, is_dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from gaugeline.session import scratch_path, settings

#: A word is a run of characters other than the six ASCII white-space characters.
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_bucket(column: Column, buckets: int) -> Column:
    """crc32 of the id written as text, modulo `buckets`; null for a null id."""
    return F.crc32(column.cast("string").cast("binary")) % buckets


def fresh_name(taken: Iterable[str], wanted: str) -> str:
    """A column name that is not taken yet: the wanted one, or that with underscores added."""
    taken = {name.lower() for name in taken}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def appended(frame: DataFrame, wanted: dict[str, str]) -> tuple[list[str], StructType]:
    """Names for new columns that do not clash with the frame's, and the schema with them."""
    found, names = list(frame.schema.fields), []
    for name, kind in wanted.items():
        names.append(fresh_name((f.name for f in found), name))
        found.append(StructField(names[-1], _parse_datatype_string(kind)))
    return names, StructType(found)


def native(value):
    """An array, a list or a dataclass with numpy's own types in its arrays.

    An array that has been pickled has a copy of its type, and so has what is made from it. Some loops of numpy take
    the type's identity for equality, and are several times slower with a copy.
    """
    if isinstance(value, np.ndarray):
        return value.view(value.dtype.type)
    if isinstance(value, list):
        return [native(v) for v in value]
    if is_dataclass(value):
        return replace(value, **{f.name: native(getattr(value, f.name)) for f in fields(value)})
    return value


def make_native(names: dict) -> None:
    """The same for the arrays of a module, `names`, and of this one, as a task has received them."""
    for space in (names, globals()):
        for name, value in list(space.items()):
            if isinstance(value, (np.ndarray, list)):
                space[name] = native(value)


def settled(frame: DataFrame) -> DataFrame:
    """Write the rows to the shared folder of spark.checkpoint.dir and read them back. Later
    steps then depend on files that outlive any executor."""
    spark = frame.sparkSession
    path = scratch_path(spark, "llm")
    # what the write has shuffled is not needed once it is done
    with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_INSIDE = np.ones(256, bool)
_INSIDE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Bytes of text whose words are hashed at once.
_WINDOW = 1 << 17


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2 ** 64."""

    BASE = 0x9E3779B97F4A7C15
    made: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.made[0]) < n:
            found = []
            for base in (cls.BASE, pow(cls.BASE, -1, 1 << 64)):
                powers = np.full(n, base, np.uint64)
                powers[0] = 1
                found.append(np.multiply.accumulate(powers))
            if n > 2 * _WINDOW:
                return found[0], found[1]  # for one very long word; not kept
            cls.made = found[0], found[1]
        return cls.made


class Words:
    """Words of some texts: runs of bytes other than ASCII white space, A to Z lower-cased.

    `start` and `end` are places in `text`, the lower-cased bytes of all texts; `size` is the number
    of words of each text. With `edges`, these bytes are taken off both ends of every word,
    and words that have no others are left out.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, edges: bytes = b""):
        self.text = _LOWER[raw]
        inside = _INSIDE[raw]
        firsts, lasts = offsets[:-1], offsets[1:]
        full = lasts > firsts
        before = np.zeros(len(raw), bool)
        before[1:] = inside[:-1]
        before[firsts[full]] = False
        after = np.zeros(len(raw), bool)
        after[:-1] = inside[1:]
        after[lasts[full] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        if edges:
            self._strip(edges)
        self.size = np.diff(np.searchsorted(self.start, offsets))

    def _strip(self, edges: bytes) -> None:
        taken = np.zeros(256, bool)
        taken[list(edges)] = True
        for side, place in ((self.start, 0), (self.end, -1)):
            todo = np.arange(len(side))
            while len(todo):
                todo = todo[(self.start[todo] < self.end[todo])]
                todo = todo[taken[self.text[side[todo] + place]]]
                side[todo] += 1 if place == 0 else -1
        some = self.start < self.end
        self.start, self.end = self.start[some], self.end[some]

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word: a polynomial over random values of its bytes, scrambled."""
        found = np.empty(len(self.start), np.uint64)
        low = 0
        while low < len(found):
            base = int(self.start[low])
            high = max(int(np.searchsorted(self.end, base + _WINDOW, side="right")), low + 1)
            start, end = self.start[low:high] - base, self.end[low:high] - base
            part = self.text[base : base + int(end[-1])]
            powers, back = _Powers.of(max(len(part), _WINDOW))
            sums = np.empty(len(part) + 1, np.uint64)
            sums[0] = 0
            np.cumsum(_BYTE_VALUES[part] * powers[: len(part)], out=sums[1:])
            found[low:high] = (sums[end] - sums[start]) * back[start]
            low = high
        return mixed(found)


def text_groups(column: pa.Array, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of neighbouring texts of a string column that have at most
    `most` bytes together; a longer text is alone. Null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if len(column) == 0:
        return
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    buffer = column.buffers()[2]
    raw = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = max(int(np.searchsorted(ends, ends[low] + most, side="right")) - 1, low + 1)
        yield low, raw[ends[low] : ends[high]], ends[low : high + 1] - ends[low]
        low = high


#: Odd 64-bit multipliers of the shingle hash, one per word of a shingle.
_FACTORS = [
    np.uint64(0x9E3779B97F4A7C15),
    np.uint64(0xC2B2AE3D27D4EB4F),
    np.uint64(0x165667B19E3779F9),
    np.uint64(0xD6E8FEB86659FD93),
    np.uint64(0xA0761D6478BD642F),
]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(32))


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of the runs of `width` words; with fewer words, of the whole sequence."""
    if len(hashes) == 0:
        return hashes
    width = min(width, len(hashes))
    total = np.full(len(hashes) - width + 1, width, np.uint64)
    for i in range(width):
        total = mixed(total + hashes[i : len(hashes) - width + 1 + i] * _FACTORS[i])
    return total


_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component): component is the smallest node id reachable over the edges.

    Large-star and small-star steps in turn (Kiveris et al., 2014): every node tells its larger
    neighbours, then its smaller ones, of the smallest node near it. The number of rounds grows
    with the logarithm of the longest path. Each round is written to the shared folder. A node
    with a third of all edges is met by aggregates with map-side combine and by joins whose skewed
    side AQE can split.
    """
    both = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).filter("a <> b")
    now = settled(
        both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = None
    while True:
        sent = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = sent.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = (
            sent.filter("b > a")
            .join(lowest, "a")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.array("a", "low"), F.array("b", "low"))).alias("e"))
            .select(F.col("e")[0].alias("a"), F.col("e")[1].alias("b"))
            .filter("a <> b")
            .distinct()
        )
        now = settled(small)
        state = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
