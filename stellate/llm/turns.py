"""Conversation structure repair: auctions price a lattice of edits, tight arcs give the cheapest ones."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANKS = " \t\n\x0b\x0c\r"
#: Faults in the order in which the first one counts.
FAULTS = ("ok", "blank", "duplicate", "truncated")
#: Costs of the edits; an undeleted truncated row costs CUT more.
DELETE, INSERT, REROLE, CUT = 4, 3, 3, 3
#: Rows of a lattice that is priced at once; longer conversations are chained block by block.
BLOCK = 32
#: Priced blocks that a task remembers, each of some kB.
REMEMBERED = 4096

# States of a repaired conversation: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: Where each role may follow: state to state; a new turn is a user's unless a user spoke last.
FOLLOWS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: What closing a conversation costs in each state: an assistant's turn after a user's, both after a system's.
CLOSING = (0, 2 * INSERT, INSERT, 0)


def arcs(row: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of a row's code in a state, in the order of the edits' initials; `I` stays before the row."""
    initial, fault = "sua?"[row >> 2], FAULTS[row & 3]
    out = [("D", DELETE, state), ("I", INSERT, NEXT[state])]
    if fault in ("ok", "truncated"):
        more = CUT if fault == "truncated" else 0
        if state in FOLLOWS.get(initial, ()):
            out.append(("K", more, FOLLOWS[initial][state]))
        out.append(("R", REROLE + more, NEXT[state]))
    return out


_ARCS = [[arcs(row, state) for state in STATES] for row in range(16)]


@lru_cache(REMEMBERED)
def priced(rows: bytes, exits: tuple[int, ...]) -> tuple[tuple[int, ...], list[list[dict[str, int]]]]:
    """Entry prices of a block, and for each place and state the tight arcs that lead on: edit to next state.

    `exits` are the prices of the four states behind the last row. A node's price never exceeds the cost of
    an arc plus the price of its end. From each entry the auction holds a path: where the last
    node's price equals the least such sum the path is extended along that arc, else the price is raised
    to it and the path loses the node, until it comes to an exit. The entry's price is then
    the cost of a cheapest path. By duality every arc of every cheapest path is tight; arcs whose end has no tight
    way to an exit are left out.
    """
    n = len(rows)
    price = [[0] * 4 for _ in range(n)] + [list(exits)]
    for entry in STATES:
        path = [(0, entry)] if n else []
        while path and path[-1][0] < n:
            at, state = path[-1]
            least, to = None, None
            for edit, cost, after in _ARCS[rows[at]][state]:
                there = at if edit == "I" else at + 1
                total = cost + price[there][after]
                if least is None or total < least:
                    least, to = total, (there, after)
            if price[at][state] < least:
                price[at][state] = least
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
    ways: list[list[dict[str, int]]] = [[{} for _ in STATES] for _ in range(n)]
    for at in reversed(range(n)):
        for _ in STATES:  # an insertion leads to another state of the same place
            for state in STATES:
                for edit, cost, after in _ARCS[rows[at]][state]:
                    there = at if edit == "I" else at + 1
                    leads = there == n or ways[there][after]
                    if leads and price[at][state] == cost + price[there][after]:
                        ways[at][state][edit] = after
    return tuple(price[0]), ways


def repair(rows: bytes) -> tuple[int, str]:
    """Cost of the cheapest edits, and their initials in order; of several cheapest the least in ASCII order.

    Blocks are priced from the last to the first, so a block's exits have their final prices, taken from the
    least of the four; the letters of a block then name its states, so the least letter of the tight arcs decides.
    """
    exits, cost, kept = CLOSING, 0, []
    cuts = range(0, len(rows), BLOCK)
    for at in reversed(cuts):
        kept.append(exits)
        prices, _ = priced(rows[at : at + BLOCK], exits)
        low = min(prices)
        exits, cost = tuple(p - low for p in prices), cost + low
    cost += exits[START]
    state, audit = START, []
    for at in cuts:
        part = rows[at : at + BLOCK]
        ways = priced(part, kept.pop())[1]
        k = 0
        while k < len(part):
            edit = min(ways[k][state])
            state = ways[k][state][edit]
            audit.append(edit)
            k += edit != "I"
    return cost, "".join(audit) + "I" * (CLOSING[state] // INSERT)


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and `copies` after the damage: 0 for a dropped row, 2 for a repeated one.

    The remainder of crc32("conv_id:turn") by 20 decides; nulls are read as one space.
    """
    def filled(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    lot = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    text = F.when(lot == 1, "").when(lot == 2, F.translate(filled("text"), ".!?", "")).otherwise(filled("text"))
    role = F.when(lot == 4, "user").otherwise(filled("role"))
    copies = F.when(lot == 0, 0).when(lot == 3, 2).otherwise(1)
    return rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"), copies.alias("copies"))


def _hashed(rows: DataFrame) -> DataFrame:
    # the second hash begins with another seed, so the two are independent
    return rows.select("*", F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(7), "role", "text").alias("h2"))


def coded(rows: DataFrame) -> DataFrame:
    """A row for each different (conv_id, turn, h1, h2): its `code` (4 * initial + fault), `copies`, and whether it is `later`.

    A row is later if its conversation has an equal role and text at an earlier turn. Rows that are
    equal throughout are combined first. The few groups with more than one turn are joined back on
    null-safe keys, which gives the join a shuffle of its own, whose hot keys adaptive execution splits.
    """
    stripped = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(stripped == "", 1).when(F.right(stripped, F.lit(1)).isin(".", "!", "?"), 0).otherwise(3)
    initial = F.left("role", F.lit(1))
    place = F.when(initial == "s", 0).when(initial == "u", 4).when(initial == "a", 8).otherwise(12)
    keys = ["conv_id", "turn", "h1", "h2"]
    narrow = rows.select(*keys, (place + fault).alias("code"), "copies")
    one = narrow.groupBy(*keys, "code").agg(F.sum("copies").alias("copies"))
    seen = one.where("copies > 0").groupBy("conv_id", "h1", "h2")
    seen = seen.agg(F.max(F.col("turn").isNull()).alias("null_first"), F.min("turn").alias("first"), F.count("*").alias("n")).where("n > 1")
    seen = seen.select(*(F.col(c).alias(f"s_{c}") for c in ("conv_id", "h1", "h2")), F.when(~F.col("null_first"), F.col("first")).alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("s_conv_id")) & F.col("h1").eqNullSafe(F.col("s_h1")) & F.col("h2").eqNullSafe(F.col("s_h2"))
    later = F.coalesce(F.col("s_h1").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first")), F.lit(False))
    return one.join(seen, same, "left").select(*keys, "code", "copies", later.alias("later"))


RESULT = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [T.StructField("audit", T.StringType())]
)


class _Facts:
    """A conversation as it streams by: a byte for each row, and the turns."""

    def __init__(self, conv_id: object):
        self.conv_id, self.rows, self.turns, self.first, self.last = conv_id, bytearray(), 0, None, None

    def add(self, turn: int | None, code: int, copies: int, later: bool) -> None:
        if not copies:
            return
        again = code if code & 3 == 1 else code & 12 | 2  # a blank row stays blank
        self.rows.append(again if later else code)
        self.rows.extend(bytes([again]) * (copies - 1))
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.turns, self.last = self.turns + 1, turn

    def result(self) -> dict:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        faults = [self.rows.translate(_FAULT_OF).count(k) for k in (1, 2, 3)]
        roles = self.rows.translate(_ROLE_OF)
        # pairs may overlap, as in "uau", so each kind is counted by itself
        legal = sum(roles.count(pair) for pair in (b"su", b"ua", b"au"))
        cost, audit = repair(bytes(self.rows))
        values = (gaps, *faults, max(0, len(roles) - 1) - legal, cost, audit)
        return {"conv_id": self.conv_id} | dict(zip(RESULT.names, values))


_FAULT_OF = bytes(k & 3 for k in range(256))
_ROLE_OF = bytes(b"sua?"[k >> 2 & 3] for k in range(256))


def _solved(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    now = None
    for batch in batches:
        out = []
        for conv_id, *row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "code", "copies", "later"))):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    out.append(now.result())
                now = _Facts(conv_id)
            now.add(*row)
        yield pa.RecordBatch.from_pylist(out, schema)
    if now is not None:
        yield pa.RecordBatch.from_pylist([now.result()], schema)


class _Replay:
    """The digest of a repaired conversation, from its audit and its rows in order."""

    def __init__(self, row: dict):
        self.row, self.at, self.state, self.digest, self.lines = row, 0, START, hashlib.sha256(), 0

    def _line(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1

    def _inserted(self) -> None:
        while self.row["audit"][self.at : self.at + 1] == "I":
            self.state, self.at = NEXT[self.state], self.at + 1
            self._line(ROLE[self.state], "")

    def add(self, role: str, text: str, copies: int) -> None:
        for _ in range(copies):
            self._inserted()
            edit, self.at = self.row["audit"][self.at], self.at + 1
            if edit == "K":
                self.state = FOLLOWS[role[0]][self.state]
                self._line(role, text)
            elif edit == "R":
                self.state = NEXT[self.state]
                self._line(ROLE[self.state], text)

    def result(self) -> dict:
        self._inserted()
        return self.row | {"repaired_sha256": self.digest.hexdigest()}


def _replayed(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    now = None
    names = [c for c in schema.names if c != "repaired_sha256"]
    for batch in batches:
        out = []
        for row in zip(*(batch.column(c).to_pylist() for c in ("role", "text", "copies", *names))):
            if row[2] is None:  # the audit comes before its rows
                if now is not None:
                    out.append(now.result())
                now = _Replay(dict(zip(names, row[3:])))
            else:
                now.add(*row[:3])
        yield pa.RecordBatch.from_pylist(out, schema)
    if now is not None:
        yield pa.RecordBatch.from_pylist([now.result()], schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def repaired(rows: DataFrame) -> DataFrame:
    """For each conv_id of damaged rows (with `copies`): gaps, faults, illegal pairs, cost, audit, repaired_sha256.

    Rows count in the order of their turn, nulls first, rows of one turn in the order of a hash of role and text, copies adjacent. A
    null conv_id is a conversation like any other; one without rows left has zeros, an empty
    audit and the digest of an empty text. An empty table gives no rows; other columns are left out.

    A conversation is one stream, as its digest is one: Spark sorts (and spills), and a task holds no
    text and for each row the byte that the audit, a single value, needs anyway. Equal rows are found by
    a join beforehand, so no task holds what it has seen.
    """
    kind = rows.schema["conv_id"].dataType
    result = T.StructType([T.StructField("conv_id", kind), *RESULT])
    full = T.StructType([*result, T.StructField("repaired_sha256", T.StringType())])
    solved_schema, full_schema = _arrow(result), _arrow(full)
    hashed = _hashed(rows)
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("h1"), F.asc("h2")]
    dealt = coded(hashed).repartition("conv_id").sortWithinPartitions(*order)
    solved = dealt.mapInArrow(lambda batches: _solved(batches, solved_schema), result)
    texts = hashed.where("copies > 0").select("conv_id", "turn", "h1", "h2", "role", "text", "copies")
    both = texts.unionByName(solved, allowMissingColumns=True).repartition("conv_id")
    # an audit has no copies and comes before its rows
    both = both.withColumn("is_row", F.col("copies").isNotNull()).sortWithinPartitions(order[0], "is_row", *order[1:])
    return both.drop("is_row").mapInArrow(lambda batches: _replayed(batches, full_schema), full)


def op12_turns(spark, sf_dir: str) -> DataFrame:
    return repaired(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
