"""Exact Jaccard self-join of documents' word shingles with signature trees.

1. Documents with equal shingle sets are one node; only one of them goes on.
2. Routing, which loses no link: two sets that link differ in at most a fixed share of their
   sizes, that is in at most k shingles. Shingles are dealt by hash to k + 1 + SPARE parts, so linked
   sets agree in SPARE + 1 parts or more. Sets that agree in a part meet through the part's signature.
   Empty parts agree by chance; a set emits them only if it has more than SPARE, for with fewer
   some part agrees that is not empty.
3. Linked sets meet in several parts: in SPARE + 1, less the parts that are empty in both. So a set
   can do without all but one of these meetings: it leaves its largest groups, of those with more than PAIRS sets. All
   sets leave groups in the same order, so what two sets lose of their meetings is no more than one of
   them has left. Passages that many texts have thus bring no texts together that share little else.
   Of what is left, a pair that only meets in groups of at most PAIRS sets is kept if it meets often enough; the sets of
   a larger group are kept together. What is kept, directly or through others, forms a block. Every block gets a signature tree: its
   leaves hold the token bitmaps of LEAF sets, its inner nodes the OR of the bitmaps below, the
   range of set sizes and the smallest bitmap. A dual traversal from the pair of roots drops pairs
   of nodes whose sizes, or whose largest possible overlap, rule out a link. What is left is
   compared exactly. Pairs that are already connected are not compared again.
4. A block beyond TILE_BYTES is cut into tiles, by size and then by hash; every pair of tiles whose sizes may
   link is a task of its own with two trees, so no task holds more than two tiles. The copies of the
   sets for these tasks are made in rounds, each with about as many bytes as the sets of all texts at most, so the disk
   does not grow with the square of a block.

Links that do not connect anything new are not reported: the result is the components.

Defined cases: null, empty and blank texts have no shingles and link with nothing, not even with
each other. Rows with equal ids count as one document with the texts of all. A null id is a
value like any other, but never the name of a component if another member has an id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import (
    Words,
    components,
    mixed,
    settled,
    shingle_hashes,
    text_groups,
)

#: Sizes of sets are cut into classes by this ratio; sets of neighbouring classes meet too. It has
#: to be at least 1 / similarity.
RATIO = 1.25
SPARE = 2
#: Up to this many sets of a group are looked at in pairs.
PAIRS = 8
BITS = 2048
LEAF = 32
FANOUT = 8
TILE_BYTES = 8 << 20
_SALT = np.uint64(0x5851F42D4C957F2D)
#: Distinct sets remembered in a task, so that copies are routed once for each task.
REMEMBERED = 1_000_000
GROUP_BYTES = 1 << 20
CLASS_BITS = 7
#: Bits for the number of a tile among those of one block and size.
PART_BITS = 32


@dataclass(frozen=True)
class Rule:
    """Documents link when 100 * intersection >= percent * union of their runs of `width` words."""

    width: int = 3
    percent: int = 90

    def __post_init__(self):
        if not 80 <= self.percent < 100:
            raise ValueError("percent must be from 80 to 99")

    def linked(self, common: int, left: int, right: int) -> bool:
        return 100 * common >= self.percent * (left + right - common)

    @property
    def least(self) -> int:
        """Sets with fewer shingles only link when they are equal."""
        return -(-100 // (100 - self.percent)) - 1

    def most_differing(self, total: int) -> int:
        """How many shingles two linked sets of `total` shingles together can differ in."""
        return total * (100 - self.percent) // (100 + self.percent)

    def signatures(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Signatures of the parts of a set, for its class and, if a larger partner can be in the
        next one, for that; and for each how often a partner has to share one of its class. The
        last CLASS_BITS bits of a signature are the class."""
        size = len(shingles)
        if size < self.least:
            return np.zeros(0, np.uint64), np.zeros(0, np.int32)
        out, needs = [], []
        own = size_class(size)
        for c in (own, own + 1):
            low, high = class_bounds(c)
            if c > own and 100 * size < self.percent * low:
                continue
            differing = self.most_differing(2 * high)
            spare = SPARE + differing // 8
            parts = differing + 1 + spare
            part = (mixed(shingles ^ _SALT) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            first = np.flatnonzero(np.diff(part[order], prepend=-1))
            sums = np.add.reduceat(mixed(shingles)[order], first)
            numbers = part[order][first]
            empty = parts - len(numbers)
            # empty parts that both have are not emitted, unless there are too many of them
            needs.append(spare + 1 - empty if empty <= spare else 1)
            if empty > spare:
                full = np.zeros(parts, np.uint64)
                full[numbers] = sums
                sums, numbers = full, np.arange(parts)
            name = numbers.astype(np.uint64) * np.uint64(1009) + np.uint64(c)
            found = mixed(sums ^ mixed(name + _SALT))
            out.append(found >> np.uint64(CLASS_BITS) << np.uint64(CLASS_BITS) | np.uint64(c))
        lengths = [len(x) for x in out]
        return np.concatenate(out), np.repeat(np.array(needs, np.int32), lengths)

    def sets(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The shingle set of each text of a column."""
        for _, raw, offsets in text_groups(column, GROUP_BYTES):
            words = Words(raw, offsets)
            hashes, end = words.hashes(), np.cumsum(words.size)
            for low, high in zip(end - words.size, end):
                yield np.unique(shingle_hashes(hashes[low:high], self.width))


def size_class(size: int) -> int:
    """Classes are [RATIO ** c, RATIO ** (c + 1)), on whole numbers."""
    c = int(np.log(max(size, 1)) / np.log(RATIO))
    while int(np.ceil(RATIO ** (c + 1))) <= size:
        c += 1
    while c > 0 and int(np.ceil(RATIO**c)) > size:
        c -= 1
    return c


def class_bounds(c: int) -> tuple[int, int]:
    return int(np.ceil(RATIO**c)), int(np.ceil(RATIO ** (c + 1))) - 1


def set_key(shingles: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes())).astype(np.int64))


class Tree:
    """A signature tree over shingle sets."""

    def __init__(self, sets: list[np.ndarray]):
        # Neighbours by smallest hash are likely to be alike, which keeps the ORs small.
        self.order = sorted(range(len(sets)), key=lambda i: (int(sets[i][0]), len(sets[i]), i))
        self.sets = [sets[i] for i in self.order]
        self.sizes = np.array([len(s) for s in self.sets])
        words = BITS // 64
        self.bits = np.zeros((len(sets), words), np.uint64)
        for row, shingles in enumerate(self.sets):
            places = (shingles % np.uint64(BITS)).astype(np.int64)
            flags = np.zeros(BITS, np.uint8)
            flags[places] = 1
            self.bits[row] = np.packbits(flags).view(np.uint64)
        self.pops = np.bitwise_count(self.bits).sum(axis=1).astype(np.int64)
        # levels[0]: leaves of LEAF sets; the last level has one node
        self.levels = [self._level(self.bits, self.sizes, self.sizes, self.pops, LEAF)]
        while len(self.levels[-1][1]) > 1:
            self.levels.append(self._level(*self.levels[-1], FANOUT))

    @staticmethod
    def _level(bits, low, high, pops, width):
        at = np.arange(0, len(low), width)
        return (
            np.bitwise_or.reduceat(bits, at, axis=0),
            np.minimum.reduceat(low, at),
            np.maximum.reduceat(high, at),
            np.minimum.reduceat(pops, at),
        )


def _possible(rule: Rule, a, rows_a: slice, b, rows_b: slice) -> np.ndarray:
    """Which pairs of nodes may hold a link.

    A set below a node has at least its `pops` bits; at most the bits common to both ORs can be
    shared, and every other bit stands for a shingle that the partner lacks.
    """
    bits_a, low_a, high_a, pops_a = (x[rows_a] for x in a)
    bits_b, low_b, high_b, pops_b = (x[rows_b] for x in b)
    fits = 100 * high_b[None, :] >= rule.percent * low_a[:, None]
    fits &= 100 * high_a[:, None] >= rule.percent * low_b[None, :]
    shared = np.bitwise_count(bits_a[:, None, :] & bits_b[None, :, :]).sum(axis=2, dtype=np.int64)
    lacking = np.maximum(pops_a[:, None] - shared, 0) + np.maximum(pops_b[None, :] - shared, 0)
    most = (100 - rule.percent) * (high_a[:, None] + high_b[None, :])
    return fits & ((100 + rule.percent) * lacking <= most)


def _below(tree: Tree, level: int, node: int) -> slice:
    """Children of a node in the next lower level, or the sets of a leaf."""
    width, count = (
        (LEAF, len(tree.sizes)) if level == 0 else (FANOUT, len(tree.levels[level - 1][1]))
    )
    return slice(node * width, min((node + 1) * width, count))


class Groups:
    """Union-find over the sets of a task."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a: int, b: int) -> None:
        self.parent[self.find(a)] = self.find(b)


def links(rule: Rule, left: Tree, right: Tree | None = None) -> Iterator[tuple[int, int]]:
    """Links that connect the sets of a tree, or of two trees with each other: positions in the
    lists that the trees were made from. Links within one of two trees are not looked for."""
    same = right is None
    right = left if same else right
    shift = 0 if same else len(left.sizes)
    groups = Groups(len(left.sizes) + (0 if same else len(right.sizes)))
    stack = [(len(left.levels) - 1, 0, len(right.levels) - 1, 0)]
    while stack:
        level_a, a, level_b, b = stack.pop()
        rows_a, rows_b = _below(left, level_a, a), _below(right, level_b, b)
        if level_a > 0 or level_b > 0:
            # go down in the higher tree; in both if they are level
            down_a, down_b = level_a >= level_b, level_b >= level_a
            next_a, next_b = level_a - down_a, level_b - down_b
            rows_a = rows_a if down_a else slice(a, a + 1)
            rows_b = rows_b if down_b else slice(b, b + 1)
            fits = _possible(rule, left.levels[next_a], rows_a, right.levels[next_b], rows_b)
            for i, j in np.argwhere(fits).tolist():
                i, j = rows_a.start + i, rows_b.start + j
                if not same or i <= j:
                    stack.append((next_a, i, next_b, j))
            continue
        tops_a = {groups.find(i) for i in range(rows_a.start, rows_a.stop)}
        tops_b = {groups.find(shift + j) for j in range(rows_b.start, rows_b.stop)}
        if len(tops_a | tops_b) == 1:
            continue
        sets_a = (left.bits, left.sizes, left.sizes, left.pops)
        sets_b = (right.bits, right.sizes, right.sizes, right.pops)
        for i, j in np.argwhere(_possible(rule, sets_a, rows_a, sets_b, rows_b)).tolist():
            i, j = rows_a.start + i, rows_b.start + j
            if (same and i >= j) or groups.find(i) == groups.find(shift + j):
                continue
            one, two = left.sets[i], right.sets[j]
            common = len(one) + len(two) - len(np.union1d(one, two))
            if rule.linked(common, len(one), len(two)):
                groups.join(i, shift + j)
                yield left.order[i], right.order[j]


def _keyed(docs: DataFrame, rule: Rule) -> DataFrame:
    """All columns but the text, and n and key: size and hash of the shingle set of each row."""
    passed = [c for c in docs.columns if c != "text"]

    def run(batches):
        for batch in batches:
            sets = list(rule.sets(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in passed),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_key(s) for s in sets], pa.int64()),
                ],
                names=[*passed, "n", "key"],
            )

    kinds = dict(docs.dtypes)
    return docs.mapInArrow(run, ", ".join([*(f"{c} {kinds[c]}" for c in passed), "n long, key long"]))


def _routes(docs: DataFrame, rule: Rule) -> DataFrame:
    """(key, route, need): the signatures of each set; of copies in a task, those of one."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            held = []
            for shingles in rule.sets(batch.column("text")):
                key = set_key(shingles)
                if key not in seen:
                    held.append((key, *rule.signatures(shingles)))
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(key)
                if len(held) >= 1024:
                    yield _packed_routes(held)
                    held = []
            yield _packed_routes(held)

    return docs.mapInArrow(run, "key long, route long, need int")


def _packed_routes(held: list[tuple]) -> pa.RecordBatch:
    keys = [np.full(len(routes), key, np.int64) for key, routes, _ in held]
    return pa.RecordBatch.from_pydict(
        {
            "key": np.concatenate([np.zeros(0, np.int64), *keys]),
            "route": np.concatenate([np.zeros(0, np.uint64), *(r for _, r, _ in held)]).view(np.int64),
            "need": np.concatenate([np.zeros(0, np.int32), *(n for _, _, n in held)]),
        }
    )


def _meetings(docs: DataFrame, rule: Rule) -> DataFrame:
    """(a, b): sets that belong to one block. Signatures are many and made twice: kept, they would be
    as large as the texts."""
    rows = _routes(docs, rule)
    groups = settled(
        rows.groupBy("route")
        .agg(F.min("key").alias("low"), F.max("key").alias("high"))
        .filter("low < high")
        .select("route")
    )
    shared = settled(_without_largest(settled(rows.join(groups, "route").distinct())))
    sizes = shared.groupBy("route").agg(F.count("*").alias("sets"), F.min("key").alias("low"))
    sized = shared.join(sizes, "route")
    large = sized.filter((F.col("sets") > PAIRS) & (F.col("key") > F.col("low")))
    small = sized.filter(F.col("sets") <= PAIRS)
    # at most PAIRS rows of a route
    left, right = (
        small.select(
            "route", F.col("key").alias(x), F.col("need").alias(f"need_{x}"), F.col("gone").alias(f"gone_{x}")
        )
        for x in ("a", "b")
    )
    pairs = (
        left.join(right, "route")
        .filter("a < b")
        .withColumn("class", _class_of(F.col("route")))
        .groupBy("a", "b", "class")
        .agg(
            F.count("*").alias("met"),
            F.max(F.greatest("need_a", "need_b")).alias("need"),
            F.max(F.greatest("gone_a", "gone_b")).alias("gone"),
        )
        .filter("met >= need - gone")
    )
    return large.select(F.col("low").alias("a"), F.col("key").alias("b")).union(
        pairs.select("a", "b")
    ).distinct()


def _class_of(route: Column) -> Column:
    return route.bitwiseAND(F.lit((1 << CLASS_BITS) - 1))


def _without_largest(shared: DataFrame) -> DataFrame:
    """(route, key, need, gone): the rows without the largest groups of each set, of those with more than PAIRS
    sets and fewer than it needs; `gone` is how many of its class are left out."""
    sizes = shared.groupBy("route").agg(F.count("*").alias("sets"))
    own = Window.partitionBy("key", _class_of(F.col("route")))
    placed = shared.join(sizes, "route").select(
        "route",
        "key",
        "need",
        # one order for all sets
        F.row_number().over(own.orderBy(F.desc("sets"), "route")).alias("place"),
        F.least(F.col("need") - 1, F.count(F.when(F.col("sets") > PAIRS, 1)).over(own)).alias("gone"),
    )
    return placed.filter("place > gone").drop("place")


def _tiled(members: DataFrame) -> DataFrame:
    """`members` with the tile of each set in its block: 0 in blocks of one tile. Sets of a tile have about one size."""
    kind = F.floor(F.log(F.col("n")) / float(np.log(RATIO)))
    sized = members.withColumn("class", kind)
    parts = sized.groupBy("block", "class").agg((F.sum("n") * 8).alias("bytes"))
    whole = parts.groupBy("block").agg(F.sum("bytes").alias("block_bytes"))
    part = F.pmod(F.xxhash64("key"), F.ceil(F.col("bytes") / TILE_BYTES))
    tile = F.when(F.col("block_bytes") <= TILE_BYTES, 0).otherwise(
        F.shiftleft(F.col("class"), PART_BITS) + part + 1
    )
    return (
        sized.join(parts.join(whole, "block"), ["block", "class"])
        .withColumn("tile", tile)
        .select(*members.columns, "tile")
    )


def _tile_pairs(tiled: DataFrame, rule: Rule, most: int) -> DataFrame:
    """(block, i, j, round): pairs of tiles with sets that may link by their sizes, of blocks with several tiles. Copies of
    tiles in a round have about `most` bytes, if that is no less than all blocks have; each block has its share."""
    tiles = (
        tiled.filter("tile > 0")
        .groupBy("block", "tile")
        .agg(F.min("n").alias("low"), F.max("n").alias("high"), (F.sum("n") * 8).alias("bytes"))
    )
    tiles = settled(tiles)
    total = tiles.agg(F.sum("bytes")).first()[0] or 1
    a, b = (
        tiles.select("block", *(F.col(c).alias(f"{c}_{x}") for c in ("tile", "low", "high", "bytes")))
        for x in ("a", "b")
    )
    one = F.col("tile_a") == F.col("tile_b")
    pairs = (
        a.join(b, "block")
        .filter("tile_a <= tile_b")
        .filter(100 * F.col("high_a") >= rule.percent * F.col("low_b"))
        .filter(100 * F.col("high_b") >= rule.percent * F.col("low_a"))
        .select(
            "block",
            F.col("tile_a").alias("i"),
            F.col("tile_b").alias("j"),
            (F.col("bytes_a") + F.when(one, 0).otherwise(F.col("bytes_b"))).alias("bytes"),
        )
    )
    whole = tiles.groupBy("block").agg(F.sum("bytes").alias("block_bytes"))
    upto = Window.partitionBy("block").orderBy("i", "j").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("bytes").over(upto), F.lit(0))
    share = F.col("block_bytes") * (most / total)
    return pairs.join(whole, "block").select("block", "i", "j", F.floor(before / share).alias("round"))


def _sets(docs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """(key, block, tile, shingles) of the documents that stand for the nodes."""
    # texts are shuffled whether the nodes are few or many, so that disk and time grow with the input
    named = nodes.withColumnRenamed("doc_id", "of").hint("merge")
    rows = docs.join(named, docs["doc_id"].eqNullSafe(named["of"])).select(
        "key", "block", "tile", "text"
    )

    def run(batches):
        for batch in batches:
            keep, found = [], []
            keys = batch.column("key").to_pylist()
            for at, shingles in enumerate(rule.sets(batch.column("text"))):
                if set_key(shingles) == keys[at]:  # another row may have the same id
                    keep.append(at)
                    found.append(shingles.tobytes())
            rest = batch.select(["key", "block", "tile"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(found, pa.binary())],
                names=["key", "block", "tile", "shingles"],
            )

    return rows.mapInArrow(run, "key long, block long, tile long, shingles binary")


def _tile_links(rule: Rule, table: pa.Table) -> pa.Table:
    """Links within a tile, or between two."""
    rows = {}
    for key, tile, i, j, raw in zip(
        *(table.column(c).to_pylist() for c in ("key", "tile", "i", "j", "shingles"))
    ):
        rows[key] = (tile, i, j, np.frombuffer(raw, np.uint64))
    keys = sorted(rows)
    _, i, j, _ = rows[keys[0]]
    sides = [[k for k in keys if rows[k][0] == side] for side in ((i,) if i == j else (i, j))]
    out: list[tuple[int, int]] = []
    if all(sides):
        trees = [Tree([rows[k][3] for k in side]) for side in sides]
        out = [(sides[0][a], sides[-1][b]) for a, b in links(rule, *trees)]
    return pa.table(
        {
            "a": pa.array([a for a, _ in out], pa.int64()),
            "b": pa.array([b for _, b in out], pa.int64()),
        }
    )


def _links(sets: DataFrame, pairs: DataFrame, rule: Rule) -> DataFrame:
    """(a, b): the links within tiles and between the pairs of tiles, round by round."""
    pairs = settled(pairs)
    rounds = 1 + (pairs.agg(F.max("round")).first()[0] or 0)
    sets = sets if rounds == 1 else settled(sets)

    def compare(tile: pa.Table) -> pa.Table:
        return _tile_links(rule, tile)

    found = []
    for number in range(rounds):
        # two rows for each two tiles that are copied
        of_tile = (
            pairs.filter(F.col("round") == number)
            .select("block", F.explode(F.array_distinct(F.array("i", "j"))).alias("tile"), "i", "j")
        )
        rows = sets.filter("tile > 0") if number else sets
        copies = (
            rows.join(F.broadcast(of_tile), ["block", "tile"], "left")
            .filter("tile = 0 or i is not null")
            .select("key", "block", "tile", *(F.coalesce(x, "tile").alias(x) for x in ("i", "j")), "shingles")
        )
        found.append(settled(copies.groupBy("block", "i", "j").applyInArrow(compare, "a long, b long")))
    return reduce(DataFrame.union, found)


def similar_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rule: Rule = Rule()
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row; component_id is the smallest id that links
    lead to."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return _grouped(docs, docs, rule).select(
        F.col("doc_id").alias(doc_id),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def similar_texts(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component) for each row; equal components, which are null without
    shingles, tell which texts links join, also for several texts of one id."""
    docs = docs.select("doc_id", "text")
    return _grouped(docs, docs.withColumn("text_hash", F.xxhash64("text")), rule).select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), "component"
    )


def _grouped(docs: DataFrame, named: DataFrame, rule: Rule) -> DataFrame:
    """The columns of `named`, which are those of `docs` and more, but for the text; n, component and
    component_id."""
    routed = settled(_keyed(named, rule))
    nodes = (
        routed.filter("n > 0").groupBy("key", "n").agg(F.min("doc_id").alias("doc_id"))
    )
    blocks = components(_meetings(docs, rule)).select(
        F.col("node").alias("key"), F.col("component").alias("block")
    )
    tiled = settled(_tiled(nodes.join(blocks, "key")))
    all_bytes = 8 * (routed.agg(F.sum("n")).first()[0] or 0)
    joined = components(_links(_sets(docs, tiled, rule), _tile_pairs(tiled, rule, all_bytes), rule))
    names = (
        nodes.join(joined, nodes["key"] == joined["node"], "left")
        .select("key", "n", "doc_id", F.coalesce("component", "key").alias("component"))
    )
    smallest = names.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_node = names.join(smallest, "component").select("key", "n", "component", "component_id")
    # A key that holds a third of all rows is one row here, so that AQE splits the other side.
    return routed.join(of_node, ["key", "n"], "left").drop("key")
