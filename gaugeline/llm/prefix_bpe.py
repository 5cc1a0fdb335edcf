"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a byte string there is one token that ends its encoding. It is the only token
of the vocabulary that ends there and may follow the last token of the prefix before it; two
tokens may follow each other if the bytes of both together encode to just these two. So one
pass over the bytes fills a table of last tokens, and walking back from the end gives the encoding.
Prefixes never change their token when bytes are appended, so a stored table is extended by its new
bytes only, and after an edit the table is refilled near the edit until it agrees with the old one.

A pattern first splits the text, and each match is encoded by itself. Tables hold one entry for
each byte of the text: the last token of the prefix that ends there, within its match. The entry
of a match's first byte is the token's complement (a negative number), which marks where matches begin.

Defined cases: a null text counts as empty and has no ids. Bytes that are not UTF-8 count as U+FFFD.
A match that is a token as a whole is that token. Repeated rows and rows with null ids get a row
each. Columns of the input are passed on; result names that they already use get trailing underscores
(`common.appended`). A vocabulary without all 256 single bytes is an error, and so is an id that
it does not have. Vocabularies go to the executors by broadcast and may have at most `MOST_BYTES`.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from gaugeline.llm.common import appended

#: Bytes of all tokens together that a vocabulary may have.
MOST_BYTES = 64 << 20
#: Matches whose encoding a task remembers, and how long they may be.
REMEMBERED, REMEMBERED_CHARS = 1 << 17, 48
#: Prefixes of matches of which a task remembers the last token, and pairs of tokens of which it remembers
#: whether they may follow each other.
PREFIXES, PAIRS = 1 << 17, 1 << 18
#: Bytes of text that are encoded to one batch of results.
BATCH_BYTES = 8 << 20
#: A match depends on the text up to so many characters behind it.
LOOK_AHEAD = 3
_NEVER = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by token from lines of a token in base 64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Encoder:
    """Prefix tables for the ranks of a vocabulary; the rank of a token is its id."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary has to have all single bytes")
        self.ranks = ranks
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.split = regex.compile(pattern)
        #: All ends of tokens: while the bytes before a place are among them, longer tokens may end there.
        self.tails = {token[i:] for token in ranks for i in range(len(token))}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}
        self.lasts: dict[bytes, int] = {}
        self.known: dict[str, bytes] = {}

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge joins to this one; (-1, -1) for a single byte and None
        for a token that no merges lead to."""
        if token in self.halves:
            return self.halves[token]
        whole = self.bytes[token]
        parts = [whole[i : i + 1] for i in range(len(whole))]
        found: tuple[int, int] | None = (-1, -1) if len(parts) == 1 else None
        while len(parts) > 1:
            rank, place = min(
                (self.ranks.get(parts[i] + parts[i + 1], _NEVER), i) for i in range(len(parts) - 1)
            )
            if rank == _NEVER:
                break
            if len(parts) == 2:
                found = self.ranks[parts[0]], self.ranks[parts[1]]
            parts[place : place + 2] = [parts[place] + parts[place + 1]]
        self.halves[token] = found
        return found

    def _may_follow(self, left: int, right: int) -> bool:
        """Whether the bytes of both encode to just these two tokens.

        Undoes the merges of both, latest first, and looks at each pair of parts that have met at
        the border: they would have been merged if their rank comes before the merges that take
        either of them away from the border. Of equal ranks the one further left goes first.
        """
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is not None:
            return known
        x, y, x_until, y_until, fine = left, right, _NEVER, _NEVER, True
        while True:
            joined = self.ranks.get(self.bytes[x] + self.bytes[y])
            if joined is not None and joined < x_until and joined <= y_until:
                fine = False
                break
            x_halves, y_halves = self._halves(x), self._halves(y)
            if x_halves is None or y_halves is None:
                fine = False
                break
            x_made = x if x_halves[0] >= 0 else -1
            y_made = y if y_halves[0] >= 0 else -1
            if x_made < 0 and y_made < 0:
                break
            if x_made > y_made:
                x, x_until = x_halves[1], x
            else:
                y, y_until = y_halves[0], y
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[key] = fine
        return fine

    def fill(self, piece: bytes, table: array, old: array | None = None) -> int:
        """Add the last tokens of the prefixes of a match that `table` does not have yet; returns
        for how many they had to be found. `old` holds entries for the end of the match that are right if as
        many of them as the longest token has bytes agree with those found."""
        ranks, tails, follow = self.ranks, self.tails, self._may_follow
        size, first, agreed = len(piece), len(table), 0
        for end in range(first + 1, size + 1):
            begin, ending = end - 1, []
            while begin >= 0:
                part = piece[begin:end]
                if part not in tails:
                    break
                token = ranks.get(part)
                if token is not None:
                    ending.append((begin, token))
                begin -= 1
            for begin, token in reversed(ending):
                if follow(table[begin - 1], token) if begin else self._halves(token) is not None:
                    table.append(token)
                    break
            else:
                raise RuntimeError(f"no token ends {piece[:end]!r}")
            if old is not None and end > size - len(old):
                agreed = agreed + 1 if old[end - 1 - size] == table[-1] else 0
                if agreed >= self.longest and end < size:
                    table.extend(old[end - size :])
                    return end - first
        return size - first

    def _whole(self, piece: bytes, table: array) -> None:
        """A match that is a token as a whole is that token, also if no merges lead to it."""
        token = self.ranks.get(piece)
        if token is not None:
            table[-1] = token

    def back(self, table: array) -> array:
        """The encoding that a table of last tokens holds."""
        ids, end = array("i"), len(table)
        while end:
            token = table[end - 1]
            token = token if token >= 0 else ~token
            ids.append(token)
            end -= len(self.bytes[token])
        ids.reverse()
        return ids

    def _last(self, prefix: bytes) -> int:
        """The last token of a short prefix. Matches share their prefixes, and only those are looked
        at that a token which may end the match leaves over."""
        token = self.lasts.get(prefix)
        if token is not None:
            return token
        ranks, tails, pairs = self.ranks, self.tails, self.pairs
        begin, ending = len(prefix) - 1, []
        while begin >= 0:
            part = prefix[begin:]
            if part not in tails:
                break
            token = ranks.get(part)
            if token is not None:
                ending.append((begin, token))
            begin -= 1
        for begin, token in reversed(ending):
            if begin:
                before = self._last(prefix[:begin])
                fine = pairs.get(before << 32 | token)
                if fine is None:
                    fine = self._may_follow(before, token)
            else:
                fine = self._halves(token) is not None
            if fine:
                if len(self.lasts) >= PREFIXES:
                    self.lasts.clear()
                self.lasts[prefix] = token
                return token
        raise RuntimeError(f"no token ends {prefix!r}")

    def _encoded(self, match: str) -> bytes:
        piece = match.encode()
        token = self.ranks.get(piece)
        if token is not None:
            ids = array("i", [token])
        elif len(match) > REMEMBERED_CHARS:
            table = array("i")
            self.fill(piece, table)
            return self.back(table).tobytes()
        else:
            ids, end = array("i"), len(piece)
            while end:
                token = self._last(piece[:end])
                ids.append(token)
                end -= len(self.bytes[token])
            ids.reverse()
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        self.known[match] = found = ids.tobytes()
        return found

    def encode(self, text: str) -> bytes:
        """The ids of a text as 32-bit integers."""
        known, encoded = self.known.get, self._encoded
        return b"".join([known(m) or encoded(m) for m in self.split.findall(text)])

    def table(self, text: str) -> array:
        """The prefix table of a text."""
        found = array("i")
        for match in self.split.finditer(text):
            found.extend(self._marked(match.group().encode(), array("i"))[0])
        return found

    def _marked(self, piece: bytes, head: array, old: array | None = None) -> tuple[array, int]:
        done = self.fill(piece, head, old)
        self._whole(piece, head)
        head[0] = ~head[0]
        return head, done

    def revise(
        self, text: str, table: array, start: int, stop: int, put: str
    ) -> tuple[str, array, int]:
        """(text, table, prefixes looked at) once the characters from start to stop are replaced;
        an append has start and stop at the end. Only matches near the edit are looked at."""
        new = text[:start] + put + text[stop:]
        place = len(text[: max(start - LOOK_AHEAD, 0)].encode())
        place = min(place, len(table) - 1) if table else 0
        while place > 0 and table[place] >= 0:
            place -= 1
        edit, moved = len(text[:start].encode()), len(new.encode()) - len(table)
        after = edit + len(put.encode())  # in the new text
        found, looked, at = table[:place], 0, place
        chars = len(text.encode()[:place].decode())
        for match in self.split.finditer(new, chars):
            if at >= after and (at == len(table) + moved or table[at - moved] < 0):
                return new, found + table[at - moved :], looked
            piece = match.group().encode()
            head = array("i")
            if at < edit and table[at] < 0:
                # prefixes before the edit; the last entry of a match may be the match as a token
                same = 1
                while at + same < edit and same < len(piece) and table[at + same] >= 0:
                    same += 1
                head = table[at : at + same - 1]
                if head:
                    head[0] = ~head[0]
            old = self._tail(table, after - moved, at + len(piece) - moved)
            made, done = self._marked(piece, head, old)
            found, looked, at = found + made, looked + done, at + len(piece)
        return new, found, looked

    def _tail(self, table: array, first: int, end: int) -> array | None:
        """Entries from `first` on of the match that ends at `end`, if one does."""
        if not 0 < end <= len(table) or (end < len(table) and table[end] >= 0):
            return None
        begin = end - 1
        while begin > first and table[begin] >= 0:
            begin -= 1
        begin += table[begin] < 0  # the first entry of a match is kept out: it is a complement
        return table[begin:end] if begin < end else None


def _shared(spark: SparkSession, ranks: dict[bytes, int]):
    if sum(map(len, ranks)) > MOST_BYTES:
        raise ValueError("the vocabulary is too large to be sent to every executor")
    return spark.sparkContext.broadcast(ranks)


def _parts(batch: pa.RecordBatch, at: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """A batch cut where its texts pass BATCH_BYTES, and the texts of each part."""
    column = batch.column(at).cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    low = 0
    while low < len(column):
        high = max(int(np.searchsorted(ends, ends[low] + BATCH_BYTES, side="right")) - 1, low + 1)
        texts = column.slice(low, high - low).to_pylist()
        yield batch.slice(low, high - low), [t.decode("utf-8", "replace") for t in texts]
        low = high


def _lists(found: list[bytes]) -> pa.Array:
    """An array of lists of 32-bit integers from their bytes."""
    ends = np.zeros(len(found) + 1, np.int64)
    np.cumsum([len(f) // 4 for f in found], out=ends[1:])
    values = pa.array(np.frombuffer(b"".join(found), np.int32))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    text: str = "text",
    tables: bool = False,
) -> DataFrame:
    """`docs` with `ids` (array<int>), and with `tables` also `last_tokens`, the prefix table that
    `revise` needs."""
    wanted = {"ids": "array<int>"} | ({"last_tokens": "array<int>"} if tables else {})
    names, schema = appended(docs, wanted)
    at, sent = docs.columns.index(text), _shared(docs.sparkSession, ranks)

    def run(batches):
        encoder = Encoder(sent.value, pattern)
        for batch in batches:
            for part, texts in _parts(batch, at):
                if tables:
                    filled = [encoder.table(t) for t in texts]
                    made = [
                        _lists([encoder.back(t).tobytes() for t in filled]),
                        _lists([t.tobytes() for t in filled]),
                    ]
                else:
                    made = [_lists([encoder.encode(t) for t in texts])]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *made], names=[*part.schema.names, *names]
                )

    return docs.mapInArrow(run, schema)


def revise(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    text: str = "text",
    last_tokens: str = "last_tokens",
    start: str = "start",
    stop: str = "stop",
    put: str = "put",
) -> DataFrame:
    """Apply an edit per row to texts with stored prefix tables: the characters from `start` to `stop`
    become `put`. Adds `new_text`, `new_ids`, `new_last_tokens` and `n_looked_at`, the number of prefixes that
    had to be looked at. Places behind the end count as the end, null ones too, so that nulls append;
    a null `put` is empty, and a null table is filled first."""
    names, schema = appended(
        docs,
        {"new_text": "string", "new_ids": "array<int>", "new_last_tokens": "array<int>", "n_looked_at": "long"},
    )
    at = {c: docs.columns.index(c) for c in (text, last_tokens, start, stop, put)}
    sent = _shared(docs.sparkSession, ranks)

    def run(batches):
        encoder = Encoder(sent.value, pattern)
        for batch in batches:
            for part, texts in _parts(batch, at[text]):
                starts, stops, puts, olds = (
                    part.column(at[c]).to_pylist() for c in (start, stop, put, last_tokens)
                )
                done = []
                for old, a, b, new, entries in zip(texts, starts, stops, puts, olds, strict=True):
                    a = len(old) if a is None else min(max(a, 0), len(old))
                    b = len(old) if b is None else min(max(b, a), len(old))
                    table = encoder.table(old) if entries is None else array("i", entries)
                    done.append(encoder.revise(old, table, a, b, new or ""))
                made = [
                    pa.array([d[0] for d in done], pa.string()),
                    _lists([encoder.back(d[1]).tobytes() for d in done]),
                    _lists([d[1].tobytes() for d in done]),
                    pa.array([d[2] for d in done], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *made], names=[*part.schema.names, *names]
                )

    return docs.mapInArrow(run, schema)


def _flat(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of an array of lists and where each list ends among them; null lists are empty."""
    ids = ids.cast(pa.large_list(pa.int32()))
    sizes = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.zeros(len(ids) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    return ids.flatten().to_numpy(zero_copy_only=False), ends


def _binaries(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    found = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(values.tobytes())]
    )
    return found.cast(pa.binary())


def decode(docs: DataFrame, ranks: dict[bytes, int], ids: str = "ids") -> DataFrame:
    """`docs` with `decoded`, the bytes of the ids, and `packed`, the ids as little-endian unsigned 32-bit
    integers, the form in which training reads them."""
    names, schema = appended(docs, {"decoded": "binary", "packed": "binary"})
    at, sent = docs.columns.index(ids), _shared(docs.sparkSession, ranks)

    def run(batches):
        by_id = {rank: token for token, rank in sent.value.items()}
        size = np.full(max(by_id) + 1, -1, np.int64)
        size[list(by_id)] = [len(token) for token in by_id.values()]
        tokens = pa.array([by_id.get(i, b"") for i in range(len(size))], pa.large_binary())
        for batch in batches:
            values, ends = _flat(batch.column(at))
            if len(values) and (values.min() < 0 or values.max() >= len(size) or size[values].min() < 0):
                raise ValueError("an id is not in the vocabulary")
            taken = tokens.take(pa.array(values))
            places = np.zeros(len(values) + 1, np.int64)
            np.cumsum(size[values], out=places[1:])
            held = taken.buffers()[2]
            raw = np.frombuffer(held, np.uint8)[: places[-1]] if held is not None else np.zeros(0, np.uint8)
            made = [_binaries(raw, places[ends]), _binaries(values.astype("<u4"), ends * 4)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *made], names=[*batch.schema.names, *names]
            )

    return docs.mapInArrow(run, schema)
