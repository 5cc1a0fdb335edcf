"""Benchmark decontamination by SimHash of item-sized windows.

A document contains an item if a window of the item's length in words, or the whole document where it is
shorter, has a weighted Jaccard similarity of SIMILAR or more with it: over the distinct five-word shingles of
both, each weighing as much as it is rare among the items.

1. Windows whose known shingles weigh less than SIMILAR times the lightest item of their length cannot be
   similar to any; the others get a 64-bit SimHash, the signs of sums over their distinct shingles of
   weight times hash bits. Weights are whole numbers there, so equal sets have equal fingerprints.
2. An index finds all items whose fingerprints are at most RADIUS bits away. The 64 bits are cut into
   BLOCKS blocks; with so few bits apart, one block has at most RADIUS // BLOCKS of them, and a table for each block
   holds the items by its value, which is looked up with all changes of so many bits.
3. The exact similarity verifies what was found.

Sets of equal weights at a similarity of 0.8 are 9.7 bits apart on average, with a deviation of 2.9, so RADIUS
holds nearly all; but no radius below 64 holds all. The rest is left to a net: items of which a document has
shingles that weigh enough, and windows that running sums of them allow. What these find is verified as
well, so nothing is lost, wherever the edits lie. `by_simhash` says that the first way found the match.

In how many items a shingle occurs is counted over all items first. The items are held in blocks of at most ITEMS
items and ITEM_WORDS words; one longer item is a block. All documents are read once. With one block, the search
is part of that scan. With more, the scan keeps the documents that may have a shingle of any item, by a table of bits
that is sent to the tasks (at most 2 ** MOST_BITS, 32 for each shingle below that), and each block is searched for in those.

Defined cases: null or empty texts and items match nothing, nor does anything with fewer than
five words. Items with equal texts each match. Items with a null id are left out. Of several
windows of a document that match an item, the most similar is reported, then the first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import Words, settled, shingle_hashes, text_groups

SHINGLE = 5
#: Bits apart within which the index finds all items, and the blocks of its bits.
RADIUS, BLOCKS = 19, 4
SIMILAR = 0.8
ITEMS = 20_000
ITEM_WORDS = 500_000
GROUP_BYTES = 1 << 20
#: Windows that get their fingerprints at once.
WINDOWS = 512
#: Steps of a weight in fingerprints.
WEIGHT_STEPS = 1024
#: Bits, as a power of two, of the table of shingles that picks documents for several blocks.
MOST_BITS = 30
#: Characters removed at the edges of words, so that punctuation does not hide a copy.
EDGES = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def bit_signs(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of 64 bits, one row per word."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def votes(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """What each shingle adds to the sums of a fingerprint, one row each."""
    steps = np.maximum(np.rint(weights * WEIGHT_STEPS), 1).astype(np.int64)
    return bit_signs(shingles) * steps[:, None]


def simhash(sums: np.ndarray) -> np.ndarray:
    """64-bit fingerprints from rows of summed signs."""
    return np.packbits(sums > 0, axis=1).view("<u8").ravel().astype(np.uint64)


def block_shifts() -> list[int]:
    """Where the blocks of bits begin."""
    return [64 * i // BLOCKS for i in range(BLOCKS)]


def block_changes() -> np.ndarray:
    """All changes of at most RADIUS // BLOCKS bits of a block."""
    bits = 64 // BLOCKS
    return np.array(
        [
            sum(1 << place for place in places)
            for n in range(RADIUS // BLOCKS + 1)
            for places in combinations(range(bits), n)
        ],
        np.int64,
    )


@dataclass
class Counts:
    """Over all items: their number, and the shingles that several have, sorted, with their number of
    items."""

    total: int
    common: np.ndarray
    having: np.ndarray

    def weights(self, shingles: np.ndarray) -> np.ndarray:
        """The rarer, the heavier. A shingle that no item has weighs like one that one has."""
        having = np.ones(len(shingles))
        if len(self.common):
            at = np.minimum(np.searchsorted(self.common, shingles), len(self.common) - 1)
            having = np.where(self.common[at] == shingles, self.having[at], 1)
        return 1.0 + np.log(self.total / having)


@dataclass
class Items:
    """An index of some benchmark items."""

    ids: list[int]
    sizes: np.ndarray
    prints: np.ndarray
    shingles: list[np.ndarray]
    weights: list[np.ndarray]
    #: what the shingles that a window shares with an item must weigh at least
    least: np.ndarray
    #: all shingles, sorted, and for each its weight and the items that have it
    known: np.ndarray
    weight: np.ndarray
    starts: np.ndarray
    owners: np.ndarray
    counts: Counts

    @classmethod
    def of(cls, rows: list[tuple[int, np.ndarray]], counts: Counts | None = None) -> "Items":
        """From the ids of items and the hashes of their words; without `counts` they are all."""
        ids = [i for i, _ in rows]
        words = [w for _, w in rows]
        sizes = np.array([len(w) for w in words])
        sets = [np.unique(shingle_hashes(w, SHINGLE)) for w in words]
        owner = np.repeat(np.arange(len(rows)), [len(x) for x in sets])
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        known, starts = np.unique(flat[order], return_index=True)
        if counts is None:
            having = np.diff(starts, append=len(flat))
            counts = Counts(len(rows), known[having > 1], having[having > 1])
        weight = counts.weights(known)
        weights = [weight[np.searchsorted(known, x)] for x in sets]
        prints = simhash(np.array([votes(x, w).sum(axis=0) for x, w in zip(sets, weights)]))
        # a little less, for sums in another order
        least = np.array([w.sum() for w in weights]) * (SIMILAR - 1e-9)
        return cls(
            ids, sizes, prints, sets, weights, least, known, weight, starts, owner[order], counts
        )

    @cached_property
    def blocks(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per block of bits: where the items of each value begin, and the items in order of values."""
        width = 64 // BLOCKS
        blocks = []
        for shift in block_shifts():
            values = (self.prints >> np.uint64(shift)).astype(np.int64) & ((1 << width) - 1)
            begins = np.zeros((1 << width) + 1, np.int64)
            np.cumsum(np.bincount(values, minlength=1 << width), out=begins[1:])
            blocks.append((begins, np.argsort(values, kind="stable")))
        return blocks

    @cached_property
    def changes(self) -> np.ndarray:
        return block_changes()

    @cached_property
    def lightest(self) -> dict[int, float]:
        """By the length of items, what the shingles shared with one of them must weigh at least."""
        found: dict[int, float] = {}
        for size, least in zip(self.sizes.tolist(), self.least.tolist()):
            found[size] = min(found.get(size, least), least)
        return found

    def _near(self, fingerprint: int) -> np.ndarray:
        """All items whose fingerprints differ in at most RADIUS bits."""
        width, value, found = 64 // BLOCKS, np.uint64(fingerprint), []
        for shift, (begins, items) in zip(block_shifts(), self.blocks):
            keys = (int(fingerprint) >> shift & ((1 << width) - 1)) ^ self.changes
            first, last = begins[keys], begins[keys + 1]
            some = np.flatnonzero(last > first)
            found += [items[first[k] : last[k]] for k in some.tolist()]
        if not found:
            return np.zeros(0, np.int64)
        numbers = np.unique(np.concatenate(found))
        return numbers[np.bitwise_count(self.prints[numbers] ^ value) <= RADIUS]

    def window_prints(self, own: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
        """SimHashes of the distinct shingles in own[start : start + width] for ascending starts."""
        low, high = int(starts[0]), int(starts[-1]) + width
        part = own[low:high]
        made = votes(part, self.counts.weights(part))
        sums = np.zeros((len(part) + 1, 64), np.int64)
        np.cumsum(made, axis=0, out=sums[1:])
        found = sums[starts - low + width] - sums[starts - low]
        # a shingle that occurs again within a window counts once: where both lie in it, the later is taken off
        order = np.argsort(part, kind="stable")
        again = order[1:][part[order[1:]] == part[order[:-1]]]
        before = order[:-1][part[order[1:]] == part[order[:-1]]]
        for place, last in zip(again.tolist(), before.tolist()):
            both = (starts - low <= last) & (starts - low + width > place)
            found[both] -= made[place]
        return simhash(found)

    def matches(
        self, hashes: np.ndarray, seen: np.ndarray
    ) -> list[tuple[int, int, int, float, bool]]:
        """(item id, first word, bits apart, similarity, by SimHash) of the best window for each item.
        `seen` is the bit table of known shingles."""
        if len(hashes) < SHINGLE or len(self.known) == 0:
            return []
        own = shingle_hashes(hashes, SHINGLE)
        places = np.flatnonzero(seen[(own >> np.uint64(44)).astype(np.int64)])
        if len(places) == 0:
            return []
        at = np.minimum(np.searchsorted(self.known, own[places]), len(self.known) - 1)
        hit = self.known[at] == own[places]
        places, at = places[hit], at[hit]
        if len(places) == 0:
            return []
        # What the document has of each item, every shingle counted once.
        slots = np.unique(at)
        first = self.starts[slots]
        having = np.append(self.starts, len(self.owners))[slots + 1] - first
        each = np.repeat(first - np.cumsum(having) + having, having) + np.arange(having.sum())
        shared = np.bincount(
            self.owners[each], np.repeat(self.weight[slots], having), minlength=len(self.ids)
        )
        best: dict[int, tuple[float, int, int, bool]] = {}
        for number, found in self._by_simhash(own, places, at, np.flatnonzero(shared), len(hashes)):
            best[number] = min(best.get(number, found), found)
        # The net: items with enough shingles in the document.
        for number in np.flatnonzero(shared >= self.least).tolist():
            size = min(int(self.sizes[number]), len(hashes))
            width = size - SHINGLE + 1
            if number in best and -best[number][0] >= 1.0:
                continue
            for start in self._starts(number, own, places, width, len(hashes) - size).tolist():
                similarity = self._similarity(number, own[start : start + width])
                if similarity >= SIMILAR and (-similarity, start) < best.get(number, (0.0, 0))[:2]:
                    print_ = self.window_prints(own, np.array([start]), width)[0]
                    bits = int(self.prints[number] ^ print_).bit_count()
                    by_simhash = number in best and best[number][3]
                    best[number] = (-similarity, start, bits, by_simhash)
                if similarity >= 1.0:
                    break
        return [
            (self.ids[number], start, bits, -less, by_simhash)
            for number, (less, start, bits, by_simhash) in sorted(best.items())
        ]

    def _by_simhash(
        self, own: np.ndarray, places: np.ndarray, at: np.ndarray, sharing: np.ndarray, n_words: int
    ) -> Iterator[tuple[int, tuple[float, int, int, bool]]]:
        """Verified windows whose fingerprints the index has found items for."""
        sums = np.concatenate([[0.0], np.cumsum(self.weight[at])])
        lengths = self.sizes[sharing]
        for size in np.unique(np.minimum(lengths, n_words)).tolist():
            width = size - SHINGLE + 1
            of_size = (self.sizes == size) if size < n_words else (self.sizes >= size)
            # for a document shorter than items, all of these lengths
            need = min(self.lightest[n] for n in np.unique(lengths[np.minimum(lengths, n_words) == size]).tolist())
            starts = np.arange(max(int(places[0]) - width + 1, 0), min(int(places[-1]), n_words - size) + 1)
            weighs = sums[np.searchsorted(places, starts + width)] - sums[np.searchsorted(places, starts)]
            starts = starts[weighs >= need - 1e-9 * sums[-1]]
            # neighbouring starts share their sums; far ones would make them long
            cuts = np.flatnonzero(np.diff(starts) > width) + 1
            for run in np.split(starts, cuts):
                for low in range(0, len(run), WINDOWS):
                    part = run[low : low + WINDOWS]
                    if len(part) == 0:
                        continue
                    prints = self.window_prints(own, part, width)
                    near: dict[int, np.ndarray] = {}
                    for start, print_ in zip(part.tolist(), prints.tolist()):
                        if print_ not in near:
                            near[print_] = self._near(print_)
                        for number in near[print_][of_size[near[print_]]].tolist():
                            similarity = self._similarity(number, own[start : start + width])
                            if similarity >= SIMILAR:
                                bits = (int(self.prints[number]) ^ print_).bit_count()
                                yield number, (-similarity, start, bits, True)

    def _starts(self, number, own, places, width: int, last: int) -> np.ndarray:
        """Starts of the windows of `width` shingles, up to `last`, whose shingles of the item, with
        repeats, weigh enough."""
        mine = self.shingles[number]
        slot = np.minimum(np.searchsorted(mine, own[places]), len(mine) - 1)
        is_mine = mine[slot] == own[places]
        places = places[is_mine]
        sums = np.concatenate([[0.0], np.cumsum(self.weights[number][slot[is_mine]])])
        starts = np.arange(max(int(places[0]) - width + 1, 0), min(int(places[-1]), last) + 1)
        inside = (
            sums[np.searchsorted(places, starts + width)] - sums[np.searchsorted(places, starts)]
        )
        return starts[inside >= self.least[number] - 1e-9 * sums[-1]]

    def _similarity(self, number: int, shingles: np.ndarray) -> float:
        """Weighted Jaccard similarity."""
        window = np.unique(shingles)
        mine, weights = self.shingles[number], self.weights[number]
        common = np.isin(mine, window, assume_unique=True)
        weight = self.counts.weights(window)
        shared = weights[common].sum()
        return float(shared / (weights.sum() + weight.sum() - shared))

    def table(self) -> np.ndarray:
        """One bit for each upper part of a known shingle's hash: a cheap first test."""
        seen = np.zeros(1 << 20, bool)
        seen[(self.known >> np.uint64(44)).astype(np.int64)] = True
        return seen


def item_blocks(
    items: DataFrame, item_id: str, text: str, most: int = ITEMS, most_words: int = ITEM_WORDS
) -> Iterator[list[tuple[int, np.ndarray]]]:
    """The items in blocks of bounded size, streamed through the driver one partition at a time."""
    rows = (
        items.select(F.col(item_id).alias("id"), F.col(text).cast("binary").alias("text"))
        .dropna()
        .orderBy("id")
    )
    block, words = [], 0
    for row in rows.toLocalIterator():
        raw = np.frombuffer(row["text"], np.uint8)
        found = Words(raw, np.array([0, len(raw)]), EDGES).hashes()
        if len(found) < SHINGLE:
            continue
        if block and (len(block) >= most or words + len(found) > most_words):
            yield block
            block, words = [], 0
        block.append((row["id"], found))
        words += len(found)
    if block:
        yield block


def _item_shingles(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(shingle, having, items): every shingle, in how many items it is, and a share of the number of items."""

    def shingles(batches):
        for batch in batches:
            for _, raw, offsets in text_groups(batch.column("text"), GROUP_BYTES):
                words = Words(raw, offsets, EDGES)
                hashes, end = words.hashes(), np.cumsum(words.size)
                for low, high in zip(end - words.size, end):
                    if high - low >= SHINGLE:
                        found = np.unique(shingle_hashes(hashes[low:high], SHINGLE))
                        yield pa.RecordBatch.from_pydict(
                            {"shingle": found.view(np.int64), "items": np.arange(len(found)) == 0}
                        )

    rows = items.select(F.col(item_id).alias("id"), F.col(text).alias("text")).dropna()
    return settled(
        rows.select("text")
        .mapInArrow(shingles, "shingle long, items boolean")
        .groupBy("shingle")
        .agg(F.count("*").alias("having"), F.sum(F.col("items").cast("long")).alias("items"))
    )


def _counts(shingles: DataFrame) -> Counts:
    total = shingles.agg(F.sum("items")).first()[0] or 0
    several = shingles.filter("having > 1").select("shingle", "having").toArrow()
    common = several.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(common)
    return Counts(total, common[order], several.column("having").to_numpy()[order])


def item_counts(items: DataFrame, item_id: str, text: str) -> Counts:
    """In how many items each shingle occurs, counted in Spark over all items that blocks hold."""
    return _counts(_item_shingles(items, item_id, text))


def _shingle_bits(shingles: DataFrame, most_bits: int) -> tuple[np.ndarray, int]:
    """A table with a bit for the upper part of each shingle, made in Spark in parts of 4 KiB, and how
    many bits of a shingle are its place."""
    n = shingles.count()
    bits = min(most_bits, max(16, int(np.ceil(np.log2(max(n, 1) * 32)))))
    # the built-in functions count from 1
    place = F.call_function("shiftrightunsigned", F.col("shingle"), F.lit(64 - bits)) + 1
    parts = (
        shingles.select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    )
    table = np.zeros((1 << bits) // 8, np.uint8)
    for row in parts.toLocalIterator():
        low = (row["part"] - 1) * 4096
        table[low : low + 4096] = np.frombuffer(bytes(row["bits"]), np.uint8)[: len(table) - low]
    return table, bits


PAIRS = "item_id long, start_word int, bits int, similarity double, by_simhash boolean"


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Number of each row and the hashes of its words."""
    for first, raw, offsets in text_groups(batch.column("text"), GROUP_BYTES):
        words = Words(raw, offsets, EDGES)
        hashes, end = words.hashes(), np.cumsum(words.size)
        for number, (low, high) in enumerate(zip(end - words.size, end), first):
            yield number, hashes[low:high]


def _searched(narrow: DataFrame, index: Items, schema: str) -> DataFrame:
    """Matches of one block of items."""

    def search(batches, known=index):
        seen = known.table()
        for batch in batches:
            at, rows = [], []
            for number, hashes in _texts(batch):
                for match in known.matches(hashes, seen):
                    at.append(number)
                    rows.append(match)
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(at, pa.int64())),
                    *[pa.array(column, kind) for column, kind in zip(columns, kinds)],
                ],
                names=["doc_id", "item_id", "start_word", "bits", "similarity", "by_simhash"],
            )

    return narrow.mapInArrow(search, schema)


def _candidates(narrow: DataFrame, shingles: DataFrame, most_bits: int) -> DataFrame:
    """Documents that may have a shingle of an item."""
    made, bits = _shingle_bits(shingles, most_bits)
    table = narrow.sparkSession.sparkContext.broadcast(made)

    def pick(batches):
        held = table.value
        for batch in batches:
            kept = []
            for number, hashes in _texts(batch):
                if len(hashes) >= SHINGLE:
                    place = (shingle_hashes(hashes, SHINGLE) >> np.uint64(64 - bits)).astype(np.int64)
                    if (held[place >> 3] >> (place & 7).astype(np.uint8) & 1).any():
                        kept.append(number)
            yield batch.take(pa.array(kept, pa.int64()))

    return settled(narrow.mapInArrow(pick, narrow.schema))


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    most_bits: int = MOST_BITS,
) -> DataFrame:
    """(doc_id, item_id, start_word, bits, similarity, by_simhash): documents and the items they contain."""
    spark = docs.sparkSession
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(narrow.dtypes)["doc_id"]
    schema = f"doc_id {kind}, {PAIRS}"
    shingles = _item_shingles(items, item_id, item_text)
    counts, blocks = _counts(shingles), item_blocks(items, item_id, item_text)
    first, second = next(blocks, None), next(blocks, None)
    if first is None:
        return spark.createDataFrame([], schema)
    if second is None:
        return _searched(narrow, Items.of(first, counts), schema)
    # several blocks, one after the other: the driver holds one at a time
    narrow = _candidates(narrow, shingles, most_bits)
    found = None
    while first is not None:
        part = settled(_searched(narrow, Items.of(first, counts), schema))
        found = part if found is None else found.union(part)
        first, second = second, next(blocks, None)
    return found
