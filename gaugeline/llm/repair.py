"""Repair of conversation structure at the least cost.

A conversation becomes a signature, one symbol for each row: the class of its role's initial and
whether it may stay (or is cut short, or has to go). Signatures are cut into pieces of at most `PIECE`
rows, and equal pieces of all conversations are one. Pieces are sorted by their reversed text, so
that those with equal ends are neighbours: they are the words of an automaton that is minimised from the end,
where a node is a suffix and pieces share the nodes of their common suffixes. For each node and
pair of grammar states, from the first to the last, the cost-to-go and the best audit are worked out once, from
those of the node behind it. Conversations join the results of their pieces, last piece first, and
then their rows are read once more, in order, to write the repaired text.

The repaired roles have initials `(s?(ua)+)?`. Edits and costs: Keep 0, Rerole to user or assistant
2, Delete 3 (needed for blank and duplicate rows), Insert an empty user or assistant row 2, and 1 more for
each truncated row that stays. The audit has the initials of the edits; of equally cheap ones it is the least in
ASCII. Audits of equal cost are never beginnings of one another, so the least one of a whole is made
of the least ones of its pieces.

Defined cases: nulls count as one space, so a null conversation is one of its own and a null
text is blank; rows without a turn come first, rows of the same turn by the digest of role and text. An empty role
has no initial: such a row keeps the grammar's state. Rows that are equal in conversation, turn, role and text
are duplicates but for one. A conversation without rows has zeros, an empty audit and the hash of an empty text;
an empty table gives no rows. Columns other than the four are not read.

Scale: rows are combined and dealt by conversation, turn and digest, so a long conversation is spread over tasks
until its pieces are joined. Its audit is a string and its hash runs over its text from first to last,
so both pass through one task, as a stream: memory holds one audit, never the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import settled

#: Rows of a signature that are one word of the automaton at most.
PIECE = 256
#: The ASCII white space that a blank text consists of, and the ends of a whole one.
BLANK, ENDS = "[\\x20\\x09-\\x0D]", ".!?"

# Grammar states: nothing yet, after a system row, after a user row, after an assistant row.
STATES = range(4)
_START, _SYSTEM, _USER, _ASSISTANT = STATES
#: The state after the user or assistant row that may come next, and that row's role.
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_ROLE = ("user", "user", "assistant", "user")
#: What ends a conversation in each state: cost and inserted rows.
_END = ((0, ""), (4, "II"), (2, "I"), (0, ""))
_NONE = (1 << 40, "")

# Symbols: roles s, u, a, o (any other) and e (empty), as a capital if the row is truncated; x has to go.
_GONE = "x"


def _after(state: int, role: str) -> int | None:
    """The state after a row that is kept, None if the grammar does not allow it."""
    if role == "e":
        return state
    if role == "s":
        return _SYSTEM if state == _START else None
    if role == "u":
        return None if state == _USER else _USER
    if role == "a":
        return _ASSISTANT if state == _USER else None
    return None


def _edits(symbol: str) -> list[list[tuple[int, str, int]]]:
    """For each state, the edits of a row other than inserts before it: cost, initial, next state."""
    found: list[list[tuple[int, str, int]]] = [[(3, "D", state)] for state in STATES]
    if symbol != _GONE:
        more = int(symbol.isupper())
        for state in STATES:
            kept = _after(state, symbol.lower())
            if kept is not None:
                found[state].append((more, "K", kept))
            found[state].append((2 + more, "R", _NEXT[state]))
    return found


_EDITS = {symbol: _edits(symbol) for symbol in "suaoeSUAOE" + _GONE}
_NODE = list[list[tuple[int, str]]]
#: The node of the empty suffix: by first and last state.
_EMPTY: _NODE = [[(0, "") if q == r else _NONE for r in STATES] for q in STATES]


def _prepended(symbol: str, node: _NODE) -> _NODE:
    """The node of a suffix with one more row in front."""
    plain = [
        [min((c + node[to][r][0], e + node[to][r][1]) for c, e, to in _EDITS[symbol][q]) for r in STATES]
        for q in STATES
    ]
    found: _NODE = []
    for q in STATES:
        one, two = _NEXT[q], _NEXT[_NEXT[q]]
        found.append(
            [
                min(
                    plain[q][r],
                    (plain[one][r][0] + 2, "I" + plain[one][r][1]),
                    (plain[two][r][0] + 4, "II" + plain[two][r][1]),
                )
                for r in STATES
            ]
        )
    return found


def solve(words: Iterator[str]) -> Iterator[tuple[str, _NODE]]:
    """Each reversed word with the node of the whole word. Words come in order, and each suffix
    that neighbours share is worked out once."""
    path: list[_NODE] = [_EMPTY]
    last = ""
    for word in words:
        same = 0
        while same < min(len(last), len(word)) and last[same] == word[same]:
            same += 1
        del path[same + 1 :]
        for symbol in word[same:]:
            path.append(_prepended(symbol, path[-1]))
        last = word
        yield word, path[-1]


def _solved(pieces: DataFrame) -> DataFrame:
    """(word, costs, audits) of all distinct pieces: 16 values by first and last state."""
    words = pieces.select(F.reverse("piece").alias("word")).distinct()
    dealt = words.repartitionByRange("word").sortWithinPartitions("word")

    def run(batches):
        for batch in batches:
            rows = list(solve(iter(batch.column(0).to_pylist())))
            yield pa.RecordBatch.from_pydict(
                {
                    "piece": [word[::-1] for word, _ in rows],
                    "costs": pa.array([[c for ends in node for c, _ in ends] for _, node in rows], pa.list_(pa.int64())),
                    "audits": pa.array([[a for ends in node for _, a in ends] for _, node in rows], pa.list_(pa.string())),
                }
            )

    return dealt.mapInArrow(run, "piece string, costs array<long>, audits array<string>")


def _digest(role: Column, text: Column) -> Column:
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.sha2(named.cast("binary"), 256))


def _flagged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, initial, blank, cut, times, first): equal rows are one with their number;
    `first` says that no earlier turn has the role and text."""
    end = F.regexp_replace("text", f"{BLANK}+$", "")
    narrow = rows.select(
        "conv_id",
        "turn",
        _digest(F.col("role"), F.col("text")).alias("digest"),
        F.substring("role", 1, 1).alias("initial"),
        (end == "").alias("blank"),
        (~F.substring(end, -1, 1).isin(*ENDS)).alias("cut"),
        "times",
    )
    keys = ["conv_id", "turn", "digest", "initial", "blank", "cut"]
    equal = narrow.groupBy(*keys).agg(F.sum("times").alias("times"))
    earliest = Window.partitionBy("conv_id", "digest").orderBy(F.asc_nulls_first("turn"))
    return equal.withColumn("first", F.row_number().over(earliest) == 1)


_PIECES = (
    "conv_id {id}, low boolean, turn {turn}, digest binary, place long, piece string, blank long, duplicate long, "
    "truncated long, illegal long, first_initial string, last_initial string, "
    "turns long, first_turn {turn}, last_turn {turn}"
)


def _pieces(flagged: DataFrame, longest: int) -> DataFrame:
    """Signatures in pieces of at most `longest` rows, cut also where a task ends, with what is counted
    in each. `turn`, `digest` and `place` tell the order of pieces."""
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("digest")]
    dealt = flagged.repartitionByRange(*order).sortWithinPartitions(*order)
    types = {"id": flagged.schema["conv_id"].dataType, "turn": flagged.schema["turn"].dataType}
    schema = _PIECES.format(**{name: kind.simpleString() for name, kind in types.items()})
    names = [part.split(" ")[0] for part in schema.split(", ")]

    def run(batches):
        piece: dict | None = None
        # the type of each column as Spark hands it over, for pieces whose values are all null
        kinds: dict = {}

        def finished() -> list:
            return [piece | {"piece": "".join(piece["piece"])}] if piece is not None else []

        for batch in batches:
            done = []
            kinds = {name: batch.schema.field(name).type for name in ("conv_id", "turn")}
            for row in batch.to_pylist():
                role = {"": "e"}.get(row["initial"], row["initial"] if row["initial"] in "sua" else "o")
                for copy in range(row["times"]):
                    new = piece is None or piece["conv_id"] != row["conv_id"]
                    if new or len(piece["piece"]) >= longest:
                        done += finished()
                        piece = {
                            "conv_id": row["conv_id"],
                            "low": row["turn"] is None,
                            "turn": row["turn"],
                            "digest": row["digest"],
                            "place": copy,
                            "piece": [],
                            "blank": 0,
                            "duplicate": 0,
                            "truncated": 0,
                            "illegal": 0,
                            "first_initial": row["initial"],
                            "last_initial": None,
                            "turns": 0,
                            "first_turn": row["turn"],
                            "last_turn": None,
                        }
                    before = piece["last_initial"]
                    if before is not None and before + row["initial"] not in ("su", "ua", "au"):
                        piece["illegal"] += 1
                    piece["last_initial"] = row["initial"]
                    if row["turn"] is not None and row["turn"] != piece["last_turn"]:
                        piece["turns"] += 1
                        if piece["first_turn"] is None:
                            piece["first_turn"] = row["turn"]
                        piece["last_turn"] = row["turn"]
                    symbol = role
                    if row["blank"]:
                        piece["blank"] += 1
                        symbol = _GONE
                    elif copy or not row["first"]:
                        piece["duplicate"] += 1
                        symbol = _GONE
                    elif row["cut"]:
                        piece["truncated"] += 1
                        symbol = role.upper()
                    piece["piece"].append(symbol)
                if len(done) >= 4096:
                    yield batch_of(done, kinds)
                    done = []
            if done:
                yield batch_of(done, kinds)
        if piece is not None:
            yield batch_of(finished(), kinds)

    def batch_of(rows: list, kinds: dict) -> pa.RecordBatch:
        own = {"conv_id": kinds["conv_id"], "first_turn": kinds["turn"], "last_turn": kinds["turn"], "turn": kinds["turn"]}
        own |= {"low": pa.bool_(), "digest": pa.binary()}
        own |= dict.fromkeys(("piece", "first_initial", "last_initial"), pa.string())
        columns = [pa.array([r[name] for r in rows], own.get(name, pa.int64())) for name in names]
        return pa.RecordBatch.from_arrays(columns, names=names)

    return dealt.mapInArrow(run, schema)


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _audits(pieces: DataFrame) -> DataFrame:
    """(conv_id, counts, audit): pieces of a conversation put together, from the last one on."""
    parts = pieces.join(_solved(pieces), "piece")
    order = ["conv_id", F.asc("low"), F.desc("turn"), F.desc("digest"), F.desc("place")]
    dealt = parts.repartition("conv_id").sortWithinPartitions(*order)
    kind = pieces.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, " + ", ".join(f"{name} long" for name in _COUNTS) + ", audit string"
    names = ["conv_id", *_COUNTS, "audit"]

    def run(batches):
        now: dict | None = None
        held = None

        def finished() -> dict:
            cost, audit = now["best"][_START]
            spread = now["last_turn"] - now["first_turn"] + 1 if now["turns"] else 0
            return now["counts"] | {
                "conv_id": now["conv_id"],
                "gaps": spread - now["turns"],
                "cost": cost,
                "audit": audit,
            }

        def batch_of(rows: list) -> pa.RecordBatch:
            kinds = {"conv_id": held, "audit": pa.string()}
            return pa.RecordBatch.from_arrays(
                [pa.array([r[n] for r in rows], kinds.get(n, pa.int64())) for n in names], names=names
            )

        for batch in batches:
            done = []
            held = batch.schema.field("conv_id").type
            for row in batch.to_pylist():
                if now is None or now["conv_id"] != row["conv_id"]:
                    if now is not None:
                        done.append(finished())
                    now = {
                        "conv_id": row["conv_id"],
                        "best": list(_END),
                        "counts": dict.fromkeys(_COUNTS, 0),
                        "initial": None,
                        "turns": 0,
                        "first_turn": None,
                        "last_turn": None,
                    }
                for name in ("blank", "duplicate", "truncated", "illegal"):
                    now["counts"][name] += row[name]
                if now["initial"] is not None and row["last_initial"] + now["initial"] not in ("su", "ua", "au"):
                    now["counts"]["illegal"] += 1
                now["initial"] = row["first_initial"]
                now["turns"] += row["turns"]
                if row["turns"]:
                    # a turn that goes on in the next piece was counted in both
                    now["turns"] -= now["first_turn"] is not None and row["last_turn"] == now["first_turn"]
                    now["last_turn"] = row["last_turn"] if now["last_turn"] is None else now["last_turn"]
                    now["first_turn"] = row["first_turn"]
                costs, audits, best = row["costs"], row["audits"], now["best"]
                now["best"] = [
                    min(
                        (costs[4 * q + r] + best[r][0], audits[4 * q + r] + best[r][1])
                        for r in STATES
                        if costs[4 * q + r] < _NONE[0]
                    )
                    for q in STATES
                ]
            if done:
                yield batch_of(done)
        if now is not None:
            yield batch_of([finished()])

    return dealt.mapInArrow(run, schema)


def repair(conversations: DataFrame, times: str | None = None, longest: int = PIECE) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of all
    conversations in (conv_id, turn, role, text). With `times`, a column with the number of copies of each row; a
    conversation whose rows all have none is still returned."""
    count = F.lit(1) if times is None else F.col(times)
    space = F.lit(" ")
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        F.coalesce(count, F.lit(0)).cast("long").alias("times"),
    )
    audits = _audits(settled(_pieces(settled(_flagged(rows.filter("times > 0"))), longest)))
    none = [F.lit(None).cast("long").alias(name) for name in _COUNTS]
    texts = rows.select(
        "conv_id",
        "turn",
        F.when(F.col("times") > 0, _digest(F.col("role"), F.col("text"))).alias("digest"),
        "times",
        F.when(F.col("times") > 0, F.col("role")).alias("role"),
        F.when(F.col("times") > 0, F.col("text")).alias("text"),
        *none,
        F.lit(None).cast("string").alias("audit"),
    )
    turn = rows.schema["turn"].dataType
    heads = audits.select(
        "conv_id",
        F.lit(None).cast(turn).alias("turn"),
        F.lit(None).cast("binary").alias("digest"),
        F.lit(0).cast("long").alias("times"),
        F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("text"),
        *_COUNTS,
        "audit",
    )
    together = heads.unionByName(texts).withColumn("body", F.col("audit").isNull())
    order = ["conv_id", "body", F.asc_nulls_first("turn"), F.asc_nulls_first("digest")]
    return _written(together.repartition("conv_id").sortWithinPartitions(*order))


class _Writer:
    """Follows an audit over the rows of a conversation and hashes what is left of them."""

    def __init__(self, row: dict):
        self.row, self.audit, self.place = row, row["audit"] or "", 0
        self.state, self.hash, self.any = _START, hashlib.sha256(), False

    def _put(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.any else "") + role + ":" + text).encode("utf-8", "replace"))
        self.any = True

    def _inserts(self) -> None:
        while self.audit[self.place : self.place + 1] == "I":
            self._put(_ROLE[self.state], "")
            self.state = _NEXT[self.state]
            self.place += 1

    def add(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.place]
        self.place += 1
        if edit == "R":
            self._put(_ROLE[self.state], text)
            self.state = _NEXT[self.state]
        elif edit == "K":
            self._put(role, text)
            first = role[:1]
            self.state = _after(self.state, "e" if not first else first if first in "sua" else "o")

    def finished(self) -> dict:
        self._inserts()
        counts = {name: self.row[name] or 0 for name in _COUNTS}
        return counts | {
            "conv_id": self.row["conv_id"],
            "audit": self.audit,
            "repaired_sha256": self.hash.hexdigest(),
        }


def _written(rows: DataFrame) -> DataFrame:
    kind = rows.schema["conv_id"].dataType.simpleString()
    counts = ", ".join(f"{name} long" for name in _COUNTS)
    schema = f"conv_id {kind}, {counts}, audit string, repaired_sha256 string"
    names = ["conv_id", *_COUNTS, "audit", "repaired_sha256"]

    def run(batches):
        writer: _Writer | None = None
        held = None

        def batch_of(found: list) -> pa.RecordBatch:
            kinds = {"conv_id": held, "audit": pa.string(), "repaired_sha256": pa.string()}
            return pa.RecordBatch.from_arrays(
                [pa.array([r[n] for r in found], kinds.get(n, pa.int64())) for n in names], names=names
            )

        for batch in batches:
            done = []
            held = batch.schema.field("conv_id").type
            for row in batch.to_pylist():
                if writer is None or writer.row["conv_id"] != row["conv_id"]:
                    if writer is not None:
                        done.append(writer.finished())
                    writer = _Writer(row)
                for _ in range(row["times"]):
                    writer.add(row["role"], row["text"])
            if done:
                yield batch_of(done)
        if writer is not None:
            yield batch_of([writer.finished()])

    return rows.mapInArrow(run, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """Known damage, by crc32 of conversation and turn: rows are left out (`times` 0), emptied, robbed of
    their sentence ends, repeated (`times` 2), or set to the user's role. Nulls become one space."""
    space = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    fault = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, f"[{ENDS}]", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("times"),
    )


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    return repair(damaged(conversations), "times")
