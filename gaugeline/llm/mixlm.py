"""Language-model scores by online logistic mixing of hashed-context bit predictors.

A text is scored as its tokens: words with A to Z lower-cased, then one end. A token is spelled in
bits by a Huffman code. Tokens that make up at least a 1 / FREQUENT part of all training tokens (at
most FREQUENT of them) and occur TIMES times have a code word each; for the others there is an
escape, and their bytes and a blank follow in a second code after the last token.

Each bit has a prediction from every context. For a token these are the last common token before it,
the token before it, and none; for a byte that common token with one byte, and the three and the
seven bytes before it in its word. The context and the place in the code are hashed to a slot;
the slot holds what the training bits say there, as log odds. The predictions are added in the
logistic domain with weights that a gate selects: how often two of the slots were seen in
training, and whether it is a token or a byte. An adaptive map refines the result: it keeps, for
ranges of the mixed prediction, how often the bit was 1. Weights and map start alike for each text
and learn from its bits, RUN bits at a time and always after these are scored. The score is the sum
of the log10 probabilities of all bits. Every bit depends on earlier ones of its text alone, so the
probabilities of all texts sum to at most one.

Texts of a batch are worked on together: the predictions of all their bits first, then the first
run of every text, the second, and so on. A text's score does not depend on its neighbours.

Training is one pass over all training texts. Each task counts into tables of fixed size (TABLES),
sends the strips it has used, and the sums are taken strip by strip. Starting weights are fitted to the bits of all
training texts, each predicted by counts out of which the bits of its own text are taken. A second pass counts
the bits by gate, outcome and ranges of their predictions, in a table of fixed size; the fit is to this table.

The base score is that of single tokens with add-one smoothing. Token counts are rows of (64-bit
hash, count). Frequent tokens are sent to the tasks; a text's other tokens are joined to the counts.

Defined cases: a null text counts as empty and consists of the end alone. Repeated rows are scored
alike. Rows with a null id are training rows. With no training tokens every count is 0 and every
slot is empty: each bit then has probability one half.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import Words, make_native, native, settled, text_groups

#: Bits of the slot number in the table of each context, and its weight before the fit.
TABLES = (21, 21, 21)
START = (0.4, 0.4, 0.3)
CONTEXTS = len(TABLES)
OFFSETS = np.concatenate([[0], np.cumsum([1 << b for b in TABLES])])
#: Slots in a strip when tables move between tasks.
STRIP = 1 << 13
#: Prior of a slot: this many bits of either kind.
PRIOR = 0.4
#: The contexts whose slots' counts select the weights, for tokens and for bytes, and the bounds of
#: these counts.
GATING = ((0, 1), (2, 1))
LEVELS = np.array([1, 2, 4, 8, 16, 64, 256])
GATES = 128
#: Bits whose slots are neighbours.
GROUP = 4
#: Log odds are kept in steps of 1 / STEP, up to LARGEST steps.
STEP = 128
LARGEST = 15 * STEP
#: Ranges of a prediction that the fit of the starting weights tells apart, and where they begin to widen.
FIT_RANGES = 24
FIT_BEND = 6.0
FIT_ROUNDS = 6
#: Pull of the fitted weights towards START.
RIDGE = 20.0
#: Bits scored before weights and map learn from them, at first and at most, and the rate for the
#: mean of the first run.
RUN = 1024
LONGEST_RUN = 1 << 14
RATE = 6.0
#: Ranges of the adaptive map, and its part in the result.
RANGES = 24
MAP_PART = 0.25
MAP_PRIOR = 64.0
#: Bytes of text and tokens handled at once.
GROUP_BYTES = 1 << 17
PIECE = 1 << 14
FREQUENT = 1 << 21
#: Times that a token must occur to have a code word; rarer ones show how new tokens look.
TIMES = 4
#: Tokens that count as common in contexts, besides the end.
COMMON = 63
LIMIT = 30.0
#: Stands for the end of a text among the hashes of words.
END_HASH = 0x5BD1E9955BD1E995
_ESCAPE = 0


def code_words(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A canonical Huffman code: code word and its length for each symbol."""
    counts = np.asarray(counts, np.int64)
    total = max(int(counts.sum()), 1)
    # small shares are raised, which keeps code words below 32 bits
    heap = [(max((int(n) << 24) // total, 1), i, i) for i, n in enumerate(counts)]
    heapq.heapify(heap)
    parent = np.zeros(2 * len(counts), np.int64)
    node = len(counts)
    while len(heap) > 1:
        (a, _, left), (b, _, right) = heapq.heappop(heap), heapq.heappop(heap)
        parent[left] = parent[right] = node
        heapq.heappush(heap, (a + b, node, node))
        node += 1
    depth = np.zeros(node, np.int64)
    for at in range(node - 2, -1, -1):
        depth[at] = depth[parent[at]] + 1
    lengths = depth[: len(counts)]
    words = np.zeros(len(counts), np.uint32)
    word, last = 0, 0
    for at in np.argsort(lengths, kind="stable").tolist():
        word <<= int(lengths[at]) - last
        last = int(lengths[at])
        words[at] = word
        word += 1
    return words, lengths.astype(np.uint32)


def _mix(values: np.ndarray, salt: int) -> np.ndarray:
    """32 well-mixed bits of 64."""
    values = (values + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (values >> np.uint64(32)).astype(np.uint32)


@dataclass
class Code:
    """The vocabulary of frequent tokens and the codes of tokens and bytes."""

    #: hashes of the tokens with a code word, ascending; the end is one of them
    keys: np.ndarray
    words: np.ndarray
    lengths: np.ndarray
    byte_words: np.ndarray
    byte_lengths: np.ndarray
    #: 1 to COMMON + 1 for common tokens, else 0
    common: np.ndarray
    #: first key of each range of the upper 20 bits of a hash, and the most keys in a range
    ranges: np.ndarray
    most: int

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray, total: int, letters: np.ndarray) -> "Code":
        """`keys` and `counts` of the frequent tokens; `total` of all tokens."""
        if END_HASH not in keys:
            keys, counts = np.append(keys, np.uint64(END_HASH)), np.append(counts, 0)
        order = np.argsort(keys)
        keys, counts = keys[order].astype(np.uint64), counts[order].astype(np.int64)
        escapes = max(total - int(counts.sum()), 0)
        words, lengths = code_words(np.concatenate([[escapes], counts]) + 1)
        byte_words, byte_lengths = code_words(letters + 1)
        common = np.zeros(len(keys) + 1, np.uint64)
        top = [i for i in np.lexsort((keys, -counts))[: COMMON + 1] if keys[i] != END_HASH]
        top = np.array([*top[:COMMON], int(np.searchsorted(keys, np.uint64(END_HASH)))])
        common[top + 1] = np.arange(1, len(top) + 1)
        edges = np.arange((1 << 20) + 1, dtype=np.uint64)
        ranges = np.searchsorted(keys >> np.uint64(44), edges).astype(np.int32)
        most = int(np.diff(ranges).max())
        return cls(keys, words, lengths, byte_words, byte_lengths, common, ranges[:-1], most)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Symbol of each token hash; the escape for tokens without a code word."""
        found = np.zeros(len(hashes), np.int64)
        left = np.arange(len(hashes))
        place = self.ranges.take((hashes >> np.uint64(44)).astype(np.int64)).astype(np.int64)
        for _ in range(self.most):
            keys = self.keys.take(place, mode="clip")
            hit = keys == hashes
            found[left[hit]] = place[hit] + 1
            # keys ascend: one that is larger ends the search
            more = keys < hashes
            left, hashes, place = left[more], hashes[more], place[more] + 1
        return found

    def of_tokens(self, tokens: np.ndarray, before: tuple[int, int]):
        """Code words, lengths and contexts of tokens, and the common token before each. `before`:
        the token and the common token before the first."""
        wide = tokens.astype(np.uint64)
        common = self.common[tokens]
        at = np.arange(len(tokens))
        last = np.maximum.accumulate(np.where(common > 0, at, -1))
        topic = np.where(last >= 0, common[np.maximum(last, 0)], np.uint64(before[1]))
        topic = np.concatenate([[np.uint64(before[1])], topic])
        one = np.concatenate([[np.uint64(before[0])], wide[:-1]])
        contexts = [_mix(topic[:-1], 1), _mix(one, 2), np.zeros(len(tokens), np.uint32)]
        return self.words[tokens], self.lengths[tokens], contexts, topic

    def of_bytes(self, text: np.ndarray, start: np.ndarray, end: np.ndarray, topics: np.ndarray):
        """Code words, lengths and contexts of the bytes of words that are escaped, each with a
        blank, and the size of each word with its blank."""
        sizes = end - start + 1
        ends = np.cumsum(sizes)
        inside = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
        symbols = text[np.minimum(inside + np.repeat(start, sizes), len(text) - 1)]
        symbols[ends - 1] = 0x20
        wide = symbols.astype(np.uint64)
        before = [
            np.where(inside >= i, np.concatenate([np.zeros(i, np.uint64), wide])[: len(wide)], 0)
            << np.uint64(8 * (i - 1))
            for i in range(1, 8)
        ]
        three = before[0] | before[1] | before[2]
        seven = three | before[3] | before[4] | before[5] | before[6]
        topic = np.repeat(topics, sizes) << np.uint64(8) | before[0]
        contexts = [_mix(topic, 11), _mix(three, 12), _mix(seven, 13)]
        return self.byte_words[symbols], self.byte_lengths[symbols], contexts, sizes

    def first(self) -> tuple[int, int]:
        """The token and the common token before a text: the end of another."""
        end = int(np.searchsorted(self.keys, np.uint64(END_HASH))) + 1
        return end, int(self.common[end])


def _turns_of_groups() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For up to GROUP bits after a leading 1: where their turns begin, the slot within the group of
    each turn (the bits before it, after a leading 1), and the turn."""
    first, inside, turns = [0, 0], [], []
    for tail in range(2, 2 << GROUP):
        first.append(len(turns))
        bits = tail.bit_length() - 1
        for left in range(bits, 0, -1):
            inside.append(tail >> left)
            turns.append(tail >> (left - 1) & 1)
    return np.array(first, np.int64), np.array(inside, np.uint32), np.array(turns, np.uint8)


_FIRST, _INSIDE, _TURNS = _turns_of_groups()
#: Ways through a group, for all sizes.
WAYS = 2 << GROUP
#: Of the ways of full size: the slot within the group and the turn of each step, as one number for all steps.
_STEPS = np.array([np.arange(_FIRST[way], _FIRST[way] + GROUP) for way in range(1 << GROUP, WAYS)])
_WAY_INSIDE = np.ascontiguousarray(_INSIDE[_STEPS].astype(np.uint8)).view(np.uint32).ravel()
_WAY_TURNS = np.ascontiguousarray(_TURNS[_STEPS]).view(np.uint32).ravel()


class Bits:
    """The bits of some symbols, and their slots.

    Up to GROUP bits of a symbol share a group of neighbouring slots, chosen by the hash of context
    and place in the code, so that memory is met once for a group.
    """

    def __init__(self, words: np.ndarray, lengths: np.ndarray, kind: int):
        groups = ((lengths + np.uint32(GROUP - 1)) // np.uint32(GROUP)).astype(np.int64)
        starts = np.cumsum(groups) - groups
        number = np.arange(starts[-1] + groups[-1]) - np.repeat(starts, groups)
        done = (number * GROUP).astype(np.uint32)
        left = np.repeat(lengths, groups) - done
        word = np.repeat(words, groups)
        self.groups = groups
        self.path = ((word >> left) | (np.uint32(1) << done)) * np.uint32(
            (0x9E3779B1, 0xC2B2AE35)[kind]
        )
        bits = np.minimum(left, np.uint32(GROUP))
        top = np.uint32(1) << bits
        #: the bits of each group after a leading 1, and how many they are
        self.ways = ((word >> (left - bits)) & (top - np.uint32(1))) | top
        self.sizes = bits.astype(np.int64)

    @cached_property
    def whole(self) -> np.ndarray:
        """For each group the number of the full-size way that zeros lead to."""
        whole = self.ways.astype(np.int64) << (GROUP - self.sizes)
        whole &= (1 << GROUP) - 1
        return whole

    @cached_property
    def kept(self) -> np.ndarray:
        """Which steps of the full-size ways are bits."""
        return np.flatnonzero(np.arange(GROUP, dtype=np.uint8) < self.sizes.astype(np.uint8)[:, None])

    @cached_property
    def inside(self) -> np.ndarray:
        return _WAY_INSIDE.take(self.whole, mode="clip").view(np.uint8).take(self.kept, mode="clip")

    @cached_property
    def turns(self) -> np.ndarray:
        return _WAY_TURNS.take(self.whole, mode="clip").view(np.uint8).take(self.kept, mode="clip")

    def cells(self, context: np.ndarray, bits: int) -> np.ndarray:
        """For each group the number of its slots' neighbourhood in a table of 2 ** bits."""
        first = (np.repeat(context, self.groups) ^ self.path) * np.uint32(0x85EBCA6B)
        first ^= first >> np.uint32(15)
        first *= np.uint32(0x2C1B3C6D)
        first >>= np.uint32(32 - bits + GROUP)
        return first

    def slots(self, context: np.ndarray, bits: int) -> np.ndarray:
        """Slots in a table of 2 ** bits."""
        first = self.cells(context, bits)
        first <<= np.uint32(GROUP)
        slots = np.repeat(first, self.sizes)
        slots += self.inside
        return slots


def _places(ways: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places in _INSIDE and _TURNS of the bits of some groups."""
    place = np.repeat(_FIRST[ways] - (np.cumsum(sizes) - sizes), sizes)
    place += np.arange(len(place))
    return place


class Tokens:
    """Tokens of some texts: the words of each, and its end. Of a word, `start` and `end` are its
    place in `text`."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        words = Words(raw, offsets)
        self.text = words.text
        self.size = words.size + 1
        at = np.arange(len(words.start)) + np.repeat(np.arange(len(words.size)), words.size)
        n = int(self.size.sum())
        self.hashes = np.full(n, END_HASH, np.uint64)
        self.hashes[at] = words.hashes()
        self.start, self.end = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.start[at], self.end[at] = words.start, words.end


def predicted(code: Code, tokens: Tokens, symbols: np.ndarray, part: slice, before: tuple):
    """The bits of tokens and of the bytes of those that are escaped, as two of (Bits, contexts,
    code lengths summed for each token); and what the next tokens need as `before`."""
    symbols = symbols[part]
    codes, lengths, contexts, topic = code.of_tokens(symbols, before)
    parts = [(Bits(codes, lengths, 0), contexts, lengths)]
    escaped = np.flatnonzero(symbols == _ESCAPE)
    spelled = np.zeros(len(symbols), np.uint32)
    if len(escaped):
        start, end = tokens.start[part][escaped], tokens.end[part][escaped]
        codes, lengths, contexts, sizes = code.of_bytes(tokens.text, start, end, topic[escaped])
        spelled[escaped] = np.add.reduceat(lengths, np.cumsum(sizes) - sizes)
        parts.append((Bits(codes, lengths, 1), contexts, spelled))
    return parts, (int(symbols[-1]), int(topic[-1]))


class Counter:
    """Bits of the training texts, per slot: how often 0 and how often 1."""

    def __init__(self, code: Code):
        self.code = code
        # counted by whole groups: how often each way through it was taken
        self.ways = [np.zeros(WAYS << (b - GROUP), np.uint32) for b in TABLES]
        # where there is no context, by tokens
        self.symbols = np.zeros(len(code.words), np.uint32)

    def add(self, tokens: Tokens) -> None:
        symbols = self.code.numbers(tokens.hashes)
        before = self.code.first()
        for start in range(0, len(symbols), PIECE):
            part = slice(start, start + PIECE)
            parts, before = predicted(self.code, tokens, symbols, part, before)
            np.add.at(self.symbols, symbols[part], np.uint32(1))
            for kind, (bits, contexts, _) in enumerate(parts):
                for k in range(CONTEXTS if kind else CONTEXTS - 1):
                    self._add_ways(self.ways[k], k, bits, contexts[k], np.uint32(1))

    @staticmethod
    def _add_ways(ways: np.ndarray, k: int, bits: Bits, context: np.ndarray, times) -> None:
        at = bits.cells(context, TABLES[k]) * np.uint32(WAYS)
        at |= bits.ways
        np.add.at(ways, at, times)

    def _without_context(self) -> np.ndarray:
        """The ways of the last table, with those of tokens."""
        ways, used = self.ways[-1].copy(), np.flatnonzero(self.symbols)
        for start in range(0, len(used), PIECE):
            part = used[start : start + PIECE]
            bits = Bits(self.code.words[part], self.code.lengths[part], 0)
            times = np.repeat(self.symbols[part], bits.groups)
            self._add_ways(ways, CONTEXTS - 1, bits, np.zeros(len(part), np.uint32), times)
        return ways

    @property
    def counts(self) -> np.ndarray:
        counts = np.zeros(2 * int(OFFSETS[-1]), np.uint32)
        for k, ways in enumerate([*self.ways[:-1], self._without_context()]):
            slots = counts[2 * OFFSETS[k] : 2 * OFFSETS[k + 1]].reshape(-1, 1 << GROUP, 2)
            ways = ways.reshape(-1, WAYS)
            used = np.flatnonzero(ways.any(axis=1))
            taken = np.ascontiguousarray(ways[used].T)
            sums = np.zeros((1 << GROUP, 2, len(used)), np.uint32)
            for way in range(2, WAYS):
                for at in range(_FIRST[way], _FIRST[way] + way.bit_length() - 1):
                    sums[_INSIDE[at], _TURNS[at]] += taken[way]
            slots[used] = sums.transpose(2, 0, 1)
        return counts


def _odds(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log odds in whole steps of 1 / STEP."""
    return np.rint(np.log((ones + PRIOR) / (zeros + PRIOR)) * STEP).astype(np.int16)


def _packed(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log odds and the level of the count of each slot, in 16 bits."""
    level = np.searchsorted(LEVELS, zeros + ones, side="right").astype(np.int16)
    odds = np.clip(_odds(zeros, ones), -LARGEST, LARGEST)
    return (odds * np.int16(8)) | level


def _unpacked(values: np.ndarray) -> np.ndarray:
    return (values >> np.int16(3)).astype(np.float32) * np.float32(1.0 / STEP)


def _gates(found: list[np.ndarray], kind: int) -> np.ndarray:
    """A gate for the levels of two slots, for tokens (kind 0) and for bytes (kind 1)."""
    first, second = (found[k] for k in GATING[kind])
    gate = (first & np.int16(7)) << np.int16(3)
    gate |= second & np.int16(7)
    gate |= np.int16(kind << 6)
    return gate


_MIDDLES = 1.0 / (1.0 + np.exp(-((np.arange(RANGES) + 0.5) - RANGES / 2) * 24 / RANGES))


class Mixer:
    """Weights and adaptive maps of some texts that are scored side by side."""

    def __init__(self, weights: np.ndarray, texts: int):
        self.texts = texts
        self.weights = np.tile(weights, (1, texts))
        self.ones = np.zeros(texts * RANGES)
        self.seen = np.zeros(texts * RANGES)
        self.middles = np.tile(_MIDDLES, texts)
        self.total = np.zeros(texts)

    def run(self, text: np.ndarray, bits: np.ndarray, found: list, gates: np.ndarray, turns: np.ndarray, rate: float):
        """Score bits and learn from them. `text`, `bits`: neighbouring bits' text, and how many they are."""
        gate = gates.astype(np.int64)
        gate += np.repeat(text * GATES, bits)
        x = [_unpacked(f) for f in found]
        mixed = self.weights[0].take(gate, mode="clip")
        mixed *= x[0]
        for k in range(1, CONTEXTS):
            part = self.weights[k].take(gate, mode="clip")
            part *= x[k]
            mixed += part
        np.minimum(mixed, LIMIT, out=mixed)
        np.maximum(mixed, -LIMIT, out=mixed)
        p = np.negative(mixed)
        np.exp(p, out=p)
        p += np.float32(1.0)
        np.divide(np.float32(1.0), p, out=p)
        mixed += np.float32(12.0)
        mixed *= np.float32(RANGES / 24)
        bins = np.minimum(np.maximum(mixed, 0.0), RANGES - 1).astype(np.int64)
        bins += np.repeat(text * RANGES, bits)
        # the map corrects the mixed prediction by what it has seen beyond its start
        refined = (self.ones - self.seen * self.middles) / (self.seen + MAP_PRIOR)
        q = (MAP_PART * refined).astype(np.float32).take(bins, mode="clip")
        q += p
        zero = np.float32(1.0) - turns
        q -= zero
        np.abs(q, out=q)
        np.maximum(q, np.float32(1e-7), out=q)
        first = np.flatnonzero(np.diff(text, prepend=-1))
        edges = (np.cumsum(bits) - bits)[first]
        np.log(q, out=q)
        self.total[text[first]] += np.add.reduceat(q, edges, dtype=np.float64)
        bins <<= 1
        bins += turns
        now = np.bincount(bins, minlength=2 * self.texts * RANGES)
        self.ones += now[1::2]
        self.seen += now[1::2] + now[::2]
        error = np.subtract(turns, p, dtype=np.float32)
        error *= np.float32(rate)
        for k in range(CONTEXTS):
            self.weights[k] += np.bincount(
                gate, weights=error * x[k], minlength=self.texts * GATES
            ).astype(np.float32)


def runs(bits: int):
    """First and last bit of each run: ever longer ones, with the rate of learning for each."""
    start, size = 0, RUN
    while start < bits:
        yield start, start + size, RATE / np.sqrt(RUN * size)
        start += size
        size = min(2 * size, LONGEST_RUN)


@dataclass
class Model:
    code: Code
    #: `_packed` slots of each table
    slots: list[np.ndarray]
    #: starting weights for each context and gate
    weights: np.ndarray

    @cached_property
    def _ways(self) -> list[np.ndarray]:
        """The slots on each full-size way through each group of each table, as one number."""
        return [
            slots.reshape(-1, 1 << GROUP).take(_INSIDE[_STEPS].ravel(), axis=1).view(np.uint64).ravel()
            for slots in self.slots
        ]

    def _found(self, bits: Bits, contexts: list[np.ndarray], kind: int) -> list[np.ndarray]:
        """The slots of each context, and the gates."""
        found = []
        for k in range(CONTEXTS):
            paths = bits.cells(contexts[k], TABLES[k]).astype(np.int64)
            paths <<= GROUP
            paths |= bits.whole
            slots = self._ways[k].take(paths, mode="clip").view(np.int16)
            found.append(slots.take(bits.kept, mode="clip"))
        return [*found, _gates(found, kind)]

    def log10(self, tokens: Tokens, symbols: np.ndarray) -> np.ndarray:
        """log10 of the probability of each of some texts."""
        texts = len(tokens.size)
        if texts == 1:
            return self._long(tokens, symbols)
        mixer = Mixer(self.weights, texts)
        first = np.cumsum(tokens.size) - tokens.size
        parts, _ = predicted(self.code, tokens, symbols, slice(None), self.code.first())
        found = [self._found(*part[:2], kind) for kind, part in enumerate(parts)]
        # the bits of a text: those of its tokens, then those of its bytes
        sizes = [np.add.reduceat(lengths, first, dtype=np.int64) for _, _, lengths in parts]
        starts = [np.cumsum(n) - n for n in sizes]
        whole = sum(sizes)
        for done, stop, rate in runs(int(whole.max())):
            text, spans = [], []
            for number in np.flatnonzero(whole > done).tolist():
                low = done
                high = min(stop, int(whole[number]))
                for kind in range(len(parts)):
                    size = int(sizes[kind][number])
                    if low < size and high > 0:
                        start = int(starts[kind][number])
                        spans.append((kind, start + max(low, 0), start + min(high, size)))
                        text.append(number)
                    low, high = low - size, high - size
            lengths = [b - a for _, a, b in spans]
            *slots, gates = (
                np.concatenate([found[j][k][a:b] for j, a, b in spans])
                for k in range(CONTEXTS + 1)
            )
            turns = np.concatenate([parts[j][0].turns[a:b] for j, a, b in spans])
            mixer.run(np.array(text), np.array(lengths), slots, gates, turns, rate)
        return mixer.total / np.log(10.0)

    def _long(self, tokens: Tokens, symbols: np.ndarray) -> np.ndarray:
        """The same for one text of any length, in pieces: first all tokens, then all bytes."""
        mixer = Mixer(self.weights, 1)
        held: list[list] = []
        space = 0
        plan = runs(1 << 62)
        start, stop, rate = next(plan)

        def score(final: bool):
            nonlocal held, space, start, stop, rate
            if not held or (space < stop - start and not final):
                return
            turns = np.concatenate([h[0] for h in held])
            found = [np.concatenate([h[1][k] for h in held]) for k in range(CONTEXTS + 1)]
            low = 0
            while low < len(turns) and (final or len(turns) - low >= stop - start):
                part = slice(low, low + stop - start)
                *slots, gates = (f[part] for f in found)
                mixer.run(np.zeros(1, np.int64), np.array([len(gates)]), slots, gates, turns[part], rate)
                low = min(part.stop, len(turns))
                start, stop, rate = next(plan)
            held = [[turns[low:], [f[low:] for f in found]]]
            space = len(turns) - low

        for kind in (0, 1):
            before = self.code.first()
            for first in range(0, len(symbols), PIECE):
                piece = slice(first, first + PIECE)
                parts, before = predicted(self.code, tokens, symbols, piece, before)
                if kind < len(parts):
                    bits, contexts, _ = parts[kind]
                    held.append([bits.turns, self._found(bits, contexts, kind)])
                    space += len(bits.turns)
                    score(False)
        score(True)
        return mixer.total / np.log(10.0)


_TOP = LARGEST / STEP
_SPAN = _TOP / (1.0 + _TOP / FIT_BEND)
_LEVEL_OF = np.searchsorted(LEVELS, np.arange(int(LEVELS[-1]) + 1), side="right").astype(np.int16)


def _range_of(odds: np.ndarray) -> np.ndarray:
    """The range of log odds: narrow around 0, wide at the ends."""
    bent = odds / (np.float32(1.0) + np.abs(odds) / np.float32(FIT_BEND))
    at = (bent + np.float32(_SPAN)) * np.float32(FIT_RANGES / (2 * _SPAN))
    return np.clip(at, 0, FIT_RANGES - 1).astype(np.int64)


def _middles_of_ranges() -> np.ndarray:
    bent = (np.arange(FIT_RANGES) + 0.5) * (2 * _SPAN / FIT_RANGES) - _SPAN
    return bent / (1.0 - np.abs(bent) / FIT_BEND)


#: A bit 0 and a bit 1, as counts of both in one number.
_ONE = np.array([[1, 0], [0, 1]], np.uint32).view(np.uint64).ravel()


def _rest_of(zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Range and level of counts, which are float32."""
    level = _LEVEL_OF[np.minimum(zeros + ones, np.float32(LEVELS[-1])).astype(np.int64)]
    return _range_of(np.log((ones + np.float32(PRIOR)) / (zeros + np.float32(PRIOR)))), level


def _spare(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """How many bits, of whatever kind, can be taken out of a slot without changing its range or its level."""
    total = zeros + ones
    level = np.searchsorted(LEVELS, total, side="right")
    least = np.concatenate([[0], LEVELS])[level]
    # edges of the ranges as odds; a little room for rounding
    edges = np.arange(FIT_RANGES + 1) * (2 * _SPAN / FIT_RANGES) - _SPAN
    edges = np.exp(edges / (1.0 - np.abs(edges) / FIT_BEND))
    low, high = edges[:-1] * (1 + 1e-4), edges[1:] * (1 - 1e-4)
    low[0], high[-1] = 0, np.inf
    at = _range_of(np.log((ones + PRIOR) / (zeros + PRIOR)))
    down = ones + PRIOR - low[at] * (zeros + PRIOR)
    up = zeros + PRIOR - (ones + PRIOR) / high[at]
    # no more than there are can be taken out
    spare = np.minimum(np.where(down >= ones, np.inf, down), np.where(up >= zeros, np.inf, up))
    return np.clip(np.minimum(spare, total - least), 0, (1 << 16) - 1).astype(np.uint16)


@dataclass
class Sent:
    """An array on its way to tasks, whose copies of it lie on the disks of driver and executors."""

    kind: str
    size: int
    raw: bytes

    @classmethod
    def of(cls, array: np.ndarray) -> "Sent":
        return cls(array.dtype.str, array.nbytes, pa.compress(pa.py_buffer(array), codec="zstd", asbytes=True))

    def array(self) -> np.ndarray:
        return np.frombuffer(pa.decompress(self.raw, self.size, codec="zstd"), np.dtype(self.kind))


@dataclass
class Ways:
    """The ways through the groups of a table."""

    #: range and level of the bits on each whole way, a byte each, if its text takes it once; a shorter one begins
    #: like that to which zeros lead
    codes: np.ndarray
    #: how many bits can be taken out of each slot on a way without changing these, for ways of all sizes
    spare: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> "Ways":
        """`counts`: zeros and ones of each slot by turns."""
        pairs = counts.reshape(-1, 2)
        used = np.flatnonzero(pairs.any(axis=1))
        zeros, ones = pairs[used].T.astype(np.float64)
        # nothing comes from slots that were not used
        spare = np.full(len(pairs), (1 << 16) - 1, np.uint16)
        spare[used] = _spare(zeros, ones)
        spare = np.ascontiguousarray(spare.reshape(-1, 1 << GROUP).T)
        zeros, ones = zeros.astype(np.float32), ones.astype(np.float32)
        one = np.float32(1)
        codes = []
        for rest in ((np.maximum(zeros - one, 0), ones), (zeros, np.maximum(ones - one, 0))):
            code = np.zeros(len(pairs), np.uint32)
            ranges, levels = _rest_of(*rest)
            code[used] = ranges << 3 | levels
            codes.append(np.ascontiguousarray(code.reshape(-1, 1 << GROUP).T))
        cells = spare.shape[1]
        found = np.zeros((1 << GROUP, cells), np.uint32)
        least = np.full((WAYS, cells), (1 << 16) - 1, np.uint16)
        for way in range(2, WAYS):
            for at in range(_FIRST[way], _FIRST[way] + way.bit_length() - 1):
                np.minimum(least[way], spare[_INSIDE[at]], out=least[way])
                if way >= 1 << GROUP:
                    step = np.uint32(8 * (at - _FIRST[way]))
                    found[way - (1 << GROUP)] |= codes[_TURNS[at]][_INSIDE[at]] << step
        return cls(np.ascontiguousarray(found.T).ravel(), np.ascontiguousarray(least.T).ravel())


def _shares_of_cells() -> list[list[np.ndarray]]:
    """What a code of each context adds to the number of a cell, for tokens and for bytes."""
    codes = np.arange(256)
    shares = []
    for kind in (0, 1):
        row = []
        for k in range(CONTEXTS):
            gate = np.full(256, kind << 6 if k == 0 else 0)
            for place, which in enumerate(GATING[kind]):
                if which == k:
                    gate += (codes & 7) << (3 if place == 0 else 0)
            at = gate * FIT_RANGES**CONTEXTS + (codes >> 3) * FIT_RANGES ** (CONTEXTS - 1 - k)
            row.append(2 * at)
        shares.append(row)
    return shares


_SHARES = _shares_of_cells()


class Fit:
    """Bits of the training texts by gate, ranges of their predictions and outcome. The bits of a text are
    taken out of the counts that predict it.

    Texts that are not long are worked on by groups of bits. A way through a group that its text meets once finds the
    codes of its bits in a table, and so does one from whose slots so few bits are taken that nothing changes;
    for the others, the text's bits are counted slot by slot.
    """

    def __init__(self, code: Code, counts: np.ndarray, ways: list[Ways] | None = None):
        self.code = code
        # zeros and ones of a slot in one number, so that they are met together
        self.pairs = counts.view(np.uint64)
        self.ways = ways or ways_of(counts)
        self.own = np.zeros(1 << max(TABLES), np.uint64)
        self.visits = np.zeros(1 << (max(TABLES) - GROUP), np.int32)
        self.marked = np.zeros(len(self.visits), bool)
        self.seen = np.zeros(GATES * FIT_RANGES**CONTEXTS * 2, np.uint32)

    def add(self, tokens: Tokens) -> None:
        symbols = self.code.numbers(tokens.hashes)
        if len(tokens.size) == 1 and len(symbols) > PIECE:
            self._add_long(tokens, symbols)
        else:
            self._add_group(tokens, symbols)

    def _add_group(self, tokens: Tokens, symbols: np.ndarray) -> None:
        first = np.cumsum(tokens.size) - tokens.size
        parts, _ = predicted(self.code, tokens, symbols, slice(None), self.code.first())
        for kind, (bits, contexts, lengths) in enumerate(parts):
            ends = np.cumsum(np.add.reduceat(lengths, first, dtype=np.int64))
            ends = np.searchsorted(np.cumsum(bits.sizes), ends, side="right").tolist()
            found = [self._codes(k, bits, contexts[k], ends) for k in range(CONTEXTS)]
            self._count_ways(found, kind, bits.whole, bits.sizes)

    def _codes(self, k: int, bits: Bits, context: np.ndarray, ends: list) -> np.ndarray:
        """A byte for each bit of each group: its range and level without the bits of its text."""
        cells = bits.cells(context, TABLES[k]).astype(np.int64)
        visits = np.empty(len(cells), np.int32)
        for low, high in zip([0, *ends], ends):
            mine = cells[low:high]
            np.add.at(self.visits, mine, np.int32(1))
            self.visits.take(mine, out=visits[low:high], mode="clip")
            self.visits[mine] = 0
        paths = cells << GROUP
        paths |= bits.whole
        found = self.ways[k].codes.take(paths, mode="clip")
        shared = np.flatnonzero(visits > 1)
        paths = cells.take(shared) * WAYS + bits.ways.take(shared)
        often = shared[visits.take(shared) > self.ways[k].spare.take(paths, mode="clip")]
        if len(often):
            self._without_own(k, bits, cells, shared, often, ends, found)
        return found

    def _without_own(self, k, bits: Bits, cells: np.ndarray, shared: np.ndarray, often: np.ndarray, ends: list, found):
        """Put right the codes of some groups, and of those that share slots with them in a text. `shared`: all groups
        that share slots with others in their text."""
        # a few others that have the same mark by chance do no harm
        marks = np.repeat(np.arange(len(ends)) * 0x9E37, np.diff([0, *ends])).take(shared)
        marks ^= cells.take(shared)
        marks &= len(self.marked) - 1
        mine = marks[np.searchsorted(shared, often)]
        self.marked[mine] = True
        chosen = shared[self.marked.take(marks, mode="clip")]
        self.marked[mine] = False
        size = bits.sizes.take(chosen)
        place = _places(bits.ways.take(chosen), size)
        slots = np.repeat(cells.take(chosen) << GROUP, size)
        slots += _INSIDE.take(place, mode="clip")
        one, own = _ONE.take(_TURNS.take(place, mode="clip")), np.empty(len(slots), np.uint64)
        sums = np.concatenate([[0], np.cumsum(size)])
        ends = sums[np.searchsorted(chosen, ends)].tolist()
        for low, high in zip([0, *ends], ends):
            mine = slots[low:high]
            np.add.at(self.own, mine, one[low:high])
            self.own.take(mine, out=own[low:high], mode="clip")
            self.own[mine] = 0
        ranges, levels = self._rest(k, slots, own)
        at = np.repeat(GROUP * chosen - (np.cumsum(size) - size), size)
        at += np.arange(len(at))
        found.view(np.uint8)[at] = ranges << 3 | levels

    def _count_ways(self, found: list[np.ndarray], kind: int, whole: np.ndarray, sizes: np.ndarray) -> None:
        # the largest groups first: those with a bit in some place are at the front
        order = np.argsort((GROUP - sizes).astype(np.uint8), kind="stable")
        whole = whole.take(order)
        codes = [f.take(order).view(np.uint8).reshape(-1, GROUP) for f in found]
        for step in range(GROUP):
            n = int(np.count_nonzero(sizes > step))
            at = whole[:n] >> (GROUP - 1 - step)
            at &= 1
            for share, code in zip(_SHARES[kind], codes):
                at += share.take(code[:n, step], mode="clip")
            np.add.at(self.seen, at, np.uint32(1))

    def _add_long(self, tokens: Tokens, symbols: np.ndarray) -> None:
        """A text of any length, piece by piece: its own bits first, then all bits without them."""
        own = [np.zeros(1 << b, np.uint64) for b in TABLES]

        def pieces(wanted: int):
            before = self.code.first()
            for start in range(0, len(symbols), PIECE):
                part = slice(start, start + PIECE)
                parts, before = predicted(self.code, tokens, symbols, part, before)
                for bits, contexts, _ in parts[wanted : wanted + 1]:
                    yield bits, [bits.slots(contexts[k], TABLES[k]).astype(np.int64) for k in range(CONTEXTS)]

        for kind in (0, 1):
            for bits, slots in pieces(kind):
                for k in range(CONTEXTS):
                    np.add.at(own[k], slots[k], _ONE[bits.turns])
            for bits, slots in pieces(kind):
                rest = [self._rest(k, slots[k], own[k][slots[k]]) for k in range(CONTEXTS)]
                self._count(rest, kind, bits.turns)
            for table in own:
                table[:] = 0

    def _rest(self, k: int, slots: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range and level of the slots without some bits."""
        found = self.pairs[OFFSETS[k] : OFFSETS[k + 1]].take(slots, mode="clip").view(np.uint32)
        own = own.view(np.uint32)
        left = np.where(found > own, found - own, np.uint32(0)).astype(np.float32)
        return _rest_of(left[::2], left[1::2])

    def _count(self, rest: list, kind: int, turns: np.ndarray) -> None:
        at = _gates([level for _, level in rest], kind).astype(np.int64)
        for ranges, _ in rest:
            at *= FIT_RANGES
            at += ranges
        at *= 2
        at += turns
        np.add.at(self.seen, at, np.uint32(1))

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """The cells that have bits, and how many; they are forgotten."""
        cells = np.flatnonzero(self.seen)
        n = self.seen[cells].astype(np.int64)
        self.seen[cells] = 0
        return cells, n


def ways_of(counts: np.ndarray) -> list[Ways]:
    """For each table."""
    return [Ways.of(counts[2 * low : 2 * high]) for low, high in zip(OFFSETS, OFFSETS[1:])]


def regressed_weights(cells: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Starting weights of every gate: a logistic regression, by Newton steps, on the bits that `Fit` counts."""
    weights = np.tile(np.array(START), (GATES, 1))
    turns, cells = cells % 2, cells // 2
    middles = _middles_of_ranges()
    x = []
    for _ in range(CONTEXTS):
        x.append(middles[cells % FIT_RANGES])
        cells = cells // FIT_RANGES
    x = np.column_stack(x[::-1])
    order = np.argsort(cells, kind="stable")
    edges = np.searchsorted(cells[order], np.arange(GATES + 1))
    for g in range(GATES):
        at = order[edges[g] : edges[g + 1]]
        if len(at):
            weights[g] = _regressed(x[at], turns[at], n[at].astype(np.float64))
    return np.ascontiguousarray(weights.T.astype(np.float32))


def fitted_weights(code: Code, counts: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Starting weights by some training texts."""
    fit = Fit(code, counts)
    for text in texts:
        fit.add(Tokens(np.frombuffer(text, np.uint8), np.array([0, len(text)])))
    return regressed_weights(*fit.counted())


def _regressed(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """`n`: how many bits there are of each row."""
    w = np.array(START)
    for _ in range(FIT_ROUNDS):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -LIMIT, LIMIT)))
        slope = x.T @ (n * (y - p)) - RIDGE * (w - START)
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(CONTEXTS)
        w = w + np.clip(np.linalg.solve(curve, slope), -0.5, 0.5)
    return w


def token_counts(texts: DataFrame, text: str = "text") -> tuple[DataFrame, np.ndarray]:
    """(token, n) for each token, and how often each byte occurs in the texts, lower-cased."""

    def run(batches):
        make_native(globals())
        held, size, letters = [], 0, np.zeros(256, np.int64)

        def counted():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            # -1 marks rows of tokens
            return pa.RecordBatch.from_pydict(
                {"byte": np.full(len(keys), -1, np.int32), "token": keys.view(np.int64), "n": n}
            )

        for batch in batches:
            for _, raw, offsets in text_groups(batch.column("text"), GROUP_BYTES):
                tokens = Tokens(raw, offsets)
                letters += np.bincount(tokens.text, minlength=256)
                held.append(tokens.hashes)
                size += len(tokens.hashes)
                if size >= 1 << 22:
                    yield counted()
                    size = 0
        if held:
            yield counted()
        used = np.flatnonzero(letters)
        yield pa.RecordBatch.from_pydict(
            {
                "byte": used.astype(np.int32),
                "token": np.zeros(len(used), np.int64),
                "n": letters[used],
            }
        )

    found = settled(
        texts.select(F.col(text).alias("text"))
        .mapInArrow(run, "byte int, token long, n long")
        .groupBy("byte", "token")
        .agg(F.sum("n").alias("n"))
    )
    letters = np.zeros(256, np.int64)
    for row in found.filter("byte >= 0").collect():  # 256 rows at most
        letters[row["byte"]] = row["n"]
    return found.filter("byte < 0").select("token", "n"), letters


def halved(counts: np.ndarray) -> np.ndarray:
    """Counts of 0 and 1 by turns in 32 bits. Both of a pair are halved until they fit, which keeps their odds; a
    slot of so many bits is in the highest level in any case."""
    pairs = counts.reshape(-1, 2)
    most = pairs.max(axis=1)
    while (most >> np.uint64(32)).any():
        large = (most >> np.uint64(32)) > 0
        pairs[large] >>= np.uint64(1)
        most = pairs.max(axis=1)
    return pairs.astype(np.uint32).ravel()


def train(texts: DataFrame, code: Code, text: str = "text") -> Model:
    """Fill the slots from all texts."""
    size = int(OFFSETS[-1])

    def count(batches):
        make_native(globals())
        counter = Counter(native(code))
        for batch in batches:
            for _, raw, offsets in text_groups(batch.column("text"), GROUP_BYTES):
                counter.add(Tokens(raw, offsets))
        strips = counter.counts.reshape(-1, 2 * STRIP)
        del counter
        # a task's counts are small numbers, mostly
        most = strips.max(axis=1)
        kinds = [np.min_scalar_type(n) for n in most]
        used = np.flatnonzero(most)
        for start in range(0, len(used), 64):
            part = used[start : start + 64]
            yield pa.RecordBatch.from_pydict(
                {"strip": part.astype(np.int32), "counts": [strips[i].astype(kinds[i]).tobytes() for i in part]}
            )

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for strip, raw in zip(batch.column("strip").to_pylist(), batch.column("counts")):
                raw = raw.as_buffer()
                found = np.frombuffer(raw, np.dtype(f"u{raw.size // (2 * STRIP)}"))
                if strip in sums:
                    sums[strip] += found
                else:
                    sums[strip] = found.astype(np.uint64)
        for strip, found in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"strip": pa.array([strip], pa.int32()), "counts": [halved(found).tobytes()]}
            )

    strips = (
        texts.select(F.col(text).alias("text"))
        .mapInArrow(count, "strip int, counts binary")
        .repartition("strip")
        .mapInArrow(add, "strip int, counts binary")
        .toArrow()
    )
    counts = np.zeros(2 * size, np.uint32)
    for strip, raw in zip(strips.column("strip").to_pylist(), strips.column("counts")):
        counts[2 * strip * STRIP : 2 * (strip + 1) * STRIP] = np.frombuffer(
            raw.as_buffer(), np.uint32
        )
    del strips
    weights = fit_to(texts, code, counts, text)
    slots = []
    for low, high in zip(OFFSETS, OFFSETS[1:]):
        zeros, ones = counts[2 * low : 2 * high].reshape(-1, 2).T
        slots.append(_packed(zeros.astype(np.float64), ones.astype(np.float64)))
    return Model(code, slots, weights)


def fit_to(texts: DataFrame, code: Code, counts: np.ndarray, text: str = "text") -> np.ndarray:
    """Starting weights by all training texts. Tasks send the cells that they have counted, whose number is bounded."""

    sent = Sent.of(counts)
    sent_ways = [(Sent.of(w.codes), Sent.of(w.spare)) for w in ways_of(counts)]

    def run(batches):
        make_native(globals())
        ways = [Ways(codes.array(), spare.array()) for codes, spare in sent_ways]
        fit, size = Fit(native(code), sent.array(), ways), 0

        def counted():
            cells, n = fit.counted()
            return pa.RecordBatch.from_pydict({"cell": pa.array(cells, pa.int64()), "n": pa.array(n, pa.int64())})

        for batch in batches:
            for _, raw, offsets in text_groups(batch.column("text"), GROUP_BYTES):
                tokens = Tokens(raw, offsets)
                fit.add(tokens)
                # a byte is some bits, of which 32 bits count 2^32
                size += len(raw) + len(offsets)
                if size >= 1 << 26:
                    yield counted()
                    size = 0
        yield counted()

    found = (
        texts.select(F.col(text).alias("text"))
        .mapInArrow(run, "cell long, n long")
        .groupBy("cell")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    return regressed_weights(found.column("cell").to_numpy(), found.column("n").to_numpy())


def scores(
    docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of
    every row; rows where `training` holds teach."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), training.alias("training"), F.col(text).alias("text")
    )
    taught = rows.filter("training")
    counts, letters = token_counts(taught)
    whole = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n, v = whole["n"] or 0, whole["v"]
    # at most FREQUENT rows, as their counts sum to n at most
    frequent = counts.filter((F.col("n") * FREQUENT >= n) & (F.col("n") >= TIMES)).toArrow()
    keys = frequent.column("token").to_numpy().view(np.uint64)
    times = frequent.column("n").to_numpy()
    code = Code.of(keys, times, n, letters)
    # per symbol: log10(count + 1); the escape, and an end that is rare, are joined to the counts
    logs = np.zeros(len(code.keys) + 1)
    logs[np.searchsorted(code.keys, keys) + 1] = np.log10(times + 1.0)
    trained = train(taught, code)
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches):
        make_native(globals())
        model, log_of = native(trained), native(logs)
        for batch in batches:
            sizes, known, sums, score, size, rare = [], [], [], [], [], []
            for _, raw, offsets in text_groups(batch.column("text"), GROUP_BYTES):
                tokens = Tokens(raw, offsets)
                symbols = model.code.numbers(tokens.hashes)
                score.append(model.log10(tokens, symbols))
                log = log_of[symbols]
                other = log == 0
                first = np.cumsum(tokens.size) - tokens.size
                sizes.append(tokens.size)
                others = np.add.reduceat(other.astype(np.int64), first)
                known.append(tokens.size - others)
                sums.append(np.add.reduceat(log, first))
                size.append(np.add.reduceat(tokens.end - tokens.start + 1, first))
                found = tokens.hashes[other].view(np.int64)
                ends = np.concatenate([[0], np.cumsum(others)]).astype(np.int32)
                rare.append(pa.ListArray.from_arrays(ends, found))
            sizes, known, sums, score, size = (
                np.concatenate(x) if x else np.zeros(0) for x in (sizes, known, sums, score, size)
            )
            rare = pa.concat_arrays(rare) if rare else pa.array([], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("training"),
                    pa.array(sizes, pa.int64()),
                    pa.array(known, pa.int64()),
                    pa.array(sums, pa.float64()),
                    pa.array(score, pa.float64()),
                    pa.array(size, pa.int64()),
                    rare,
                ],
                names=["doc_id", "training", "n_tokens", "known", "logs", "score", "bytes", "rare"],
            )

    scored = settled(
        rows.mapInArrow(
            run,
            f"doc_id {kind}, training boolean, n_tokens long, known long, logs double, "
            "score double, bytes long, rare array<long>",
        ).withColumn("row", F.monotonically_increasing_id())
    )
    rare = (
        scored.select("row", F.explode("rare").alias("token"))
        .join(counts, "token")
        .groupBy("row")
        .agg(
            F.count("*").alias("rare_known"),
            F.sum(F.log10(F.col("n") + 1.0)).alias("rare_logs"),
        )
    )
    return scored.join(rare, "row", "left").select(
        F.col("doc_id").alias(doc_id),
        (~F.col("training")).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (
            F.col("logs")
            + F.coalesce("rare_logs", F.lit(0.0))
            - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))
        ).alias("base_score"),
        "score",
        (-F.col("score") / F.log10(F.lit(2.0)) / F.col("bytes")).alias("bits_per_byte"),
    )
