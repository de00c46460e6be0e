"""Repair of conversations' structure at the least cost.

The roles of a repaired conversation are an optional system turn and pairs of user and assistant, or nothing. Editing is a weighted
automaton with four states (nothing yet, behind a system, a user, an assistant turn) that reads a row's symbol: its role's initial and
its fault. It is determinised as it is met: what the rows read so far leave is the cost of each state, less the least of them, and the
order of the states' edits; each such vector is one state of the table, made when it is first met. A conversation is then read by looking
up the table, which adds up the costs; behind its last row the trace goes back along the tight arcs that the table holds and gives the
edits, the ASCII-least of the cheapest.

Reading takes a row's symbol and digest alone, as a sorted stream that keeps four bytes a row; the texts meet their conversation's edits
in a second sorted stream. A conversation passes one task, as its digest can only be made in order, but is never held there.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from granary.llm.common import small_batches

SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1
START, SYSTEM, USER, ASSISTANT = range(4)
FINE, CUT, MUST_GO = range(3)
#: Where a user or assistant turn that is put in leads to, and how it is called.
FOLLOWS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua"


def kept(state: int, initial: int) -> int | None:
    """The state behind a row that is kept as it is; no row may follow where it does not belong."""
    if initial == 0:
        return SYSTEM if state == START else None
    return initial + 1 if initial < 3 and FOLLOWS[state] == initial + 1 else None


class Table:
    """The determinised automaton. A state is, for each state of the weighted one, (cost, place of its edits in ASCII order) or None;
    arcs[t] tells for each state behind a transition the state before it and the letters in between."""

    def __init__(self):
        self.states: list[tuple] = [((0, 0), None, None, None)]
        self.known: dict[tuple, int] = {self.states[0]: 0}
        self.next: dict[tuple[int, int, int], int] = {}
        self.arcs: list[tuple] = []
        self.steps: list[tuple[int, int]] = []

    def step(self, state: int, initial: int, kind: int) -> int:
        """The number of the transition from a state by a row's symbol; steps[t] is the state behind it and the cost that it adds."""
        if (t := self.next.get((state, initial, kind))) is not None:
            return t
        best: list = [None] * 4
        for q, at in enumerate(self.states[state]):
            if at is None:
                continue
            p = q
            for inserts in range(4):  # more come back to the same states
                cost, rank = at[0] + INSERT * inserts, at[1]
                ways = [("D", p, DELETE)]
                if kind != MUST_GO:
                    more = TRUNCATED if kind == CUT else 0
                    ways.append(("R", FOLLOWS[p], REROLE + more))
                    if (to := kept(p, initial)) is not None:
                        ways.append(("K", to, KEEP + more))
                for letter, to, price in ways:
                    way = (cost + price, rank, "I" * inserts + letter, q)
                    if best[to] is None or way < best[to]:
                        best[to] = way
                p = FOLLOWS[p]
        least = min(b[0] for b in best if b)
        # no two states' edits are equal, nor is one's a beginning of another's: each row adds one letter that is no insertion
        order = sorted((b[1:3] for b in best if b))
        vector = tuple(b and (b[0] - least, order.index(b[1:3])) for b in best)
        if vector not in self.known:
            self.known[vector] = len(self.states)
            self.states.append(vector)
        self.arcs.append(tuple(b and (b[3], b[2]) for b in best))
        self.steps.append((self.known[vector], least))
        self.next[state, initial, kind] = t = len(self.arcs) - 1
        return t

    def end(self, state: int) -> tuple[int, int, str]:
        """The cost that is left behind the last row, the state that it is reached from, and the insertions to a whole last pair."""
        ways = []
        for q, at in enumerate(self.states[state]):
            if at is not None:
                n = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}[q]
                ways.append((at[0] + INSERT * n, at[1], "I" * n, q))
        cost, _, letters, q = min(ways)
        return cost, q, letters

    def trace(self, state: int, path: array) -> str:
        """The edits behind a path of transitions that ends in a state."""
        _, q, letters = self.end(state)
        out = [letters]
        for t in reversed(path):
            q, letters = self.arcs[t][q]
            out.append(letters)
        return "".join(reversed(out))


_TABLE = Table()


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, there: rows with faults by the digest of their id and turn. A row that is dropped has no role and
    text, and there is false. Null roles and texts are one space, as null ids and turns are in the digest."""
    c = conversations
    known = lambda x: F.coalesce(x.cast("string"), F.lit(" "))
    fault = F.crc32(F.concat_ws(":", known(c["conv_id"]), known(c["turn"])).cast("binary")) % 20
    rows = c.select(c["conv_id"].alias("conv_id"), c["turn"].alias("turn"), known(c["role"]).alias("role"), known(c["text"]).alias("text"), fault.alias("fault"))
    f = F.col("fault")
    text = F.when(f == 1, "").when(f == 2, F.regexp_replace("text", "[.!?]", "")).when(f != 0, F.col("text"))
    role = F.when(f == 4, "user").when(f != 0, F.col("role"))
    times = F.explode(F.array_repeat(F.lit(True), F.when(f == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (f != 0).alias("there"), times.alias("_")).drop("_")


def _known(rows: DataFrame) -> DataFrame:
    """rows with null roles and texts as one space, and a digest that orders rows of one turn."""
    there = rows["there"] if "there" in rows.columns else F.lit(True)
    known = lambda c: F.coalesce(rows[c], F.lit(" ")).alias(c)
    out = rows.select(rows["conv_id"].alias("conv_id"), rows["turn"].alias("turn"), known("role"), known("text"), there.alias("there"))
    line = F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return out.withColumn("digest", F.unhex(F.sha2(line.cast("binary"), 256)))


def _order(*first: str) -> list[Column]:
    return [*(F.col(c) for c in first), F.col("turn").asc_nulls_first(), F.col("digest")]


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, there, digest, copy (which of equal rows it is), initial (0 to 3: s, u, a, any other), fault (null, 'blank',
    'duplicate' or 'truncated')."""
    bare = F.rtrim("text", F.lit(SPACE))
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    own = _known(rows).select(
        "conv_id", "turn", "there", "digest", initial.alias("initial"), (F.char_length(bare) == 0).alias("blank"), (~F.substring(bare, -1, 1).isin(*".!?")).alias("cut")
    )
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    earlier = W.Window.partitionBy("conv_id", "digest", "there").orderBy(F.col("turn").asc_nulls_first())
    marked = own.repartition(n, "conv_id").withColumn("_at", F.row_number().over(earlier))
    fault = F.when(F.col("blank"), "blank").when(F.col("_at") > 1, "duplicate").when(F.col("cut"), "truncated")
    return marked.select("conv_id", "turn", "there", "digest", F.col("_at").alias("copy"), "initial", fault.alias("fault"))


def _streams(batches: Iterator, start: Callable, row: Callable, finish: Callable) -> Iterator:
    """Calls start(), row(state, values) and finish(id, state) over rows whose first column is a conversation's id, in order."""
    held, state, any_yet = None, None, False
    for batch in batches:
        for values in zip(*(c.to_pylist() for c in batch.columns)):
            if not any_yet or values[0] != held:
                if any_yet:
                    yield from finish(held, state)
                held, state, any_yet = values[0], start(), True
            yield from row(state, values)
    if any_yet:
        yield from finish(held, state)


def _tables(rows: Iterator, schema, size: int = 1024) -> Iterator:
    """Rows, as tuples, in batches of bounded size."""
    import pyarrow as pa

    some: list = []
    for r in rows:
        some.append(r)
        if len(some) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)
            some = []
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)


def _arrow(df: DataFrame, schema: T.StructType, run: Callable) -> DataFrame:
    """Rows of `schema` from run(batches), in the order of the rows of df."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return df.mapInArrow(lambda batches: _tables(run(batches), arrow), schema)


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def repairs(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of each conversation of rows(conv_id, turn, role, text and, if
    there, a boolean `there`, false where a conversation is named but the row is not part of it).

    Rows count in the order of their turns, nulls first, and of their digests in one turn. A row's first fault counts: blank (nothing
    but ASCII white space), duplicate (role and text seen earlier), truncated (its last other character is none of .!?).
    gaps: whole numbers missing between the least turn and the greatest. illegal: neighbours whose roles' initials are not su, ua or au.

    Edits, a letter each: K keeps a row; R makes its role user or assistant, for 2; D deletes it, for 3, as it must a blank or a duplicate
    one; I puts in a user or assistant turn without text anywhere, for 2. A truncated row that stays costs 1. audit has the cheapest
    edits, of equal ones the ASCII-least; cost is their sum.

    Null roles and texts are one space. A null conv_id is a conversation of its own. Without rows there are zeros and no edits. Rows
    that repeat are duplicates of the first. Extra columns are not read. An empty table gives an empty one.
    """
    kind = rows.schema["conv_id"]
    small_batches(rows.sparkSession)
    schema = T.StructType([T.StructField("conv_id", kind.dataType), *T.StructType.fromDDL(REPORT)])
    ordered = faults(rows).sortWithinPartitions(*_order("conv_id"), "copy").select("conv_id", "turn", "there", "initial", "fault")

    def start() -> dict:
        return {"state": 0, "cost": 0, "path": array("I"), "last": None, "turns": [None, None, 0], "illegal": 0, "blank": 0, "duplicate": 0, "truncated": 0}

    def row(s: dict, values: tuple) -> Iterator:
        _, turn, there, initial, fault = values
        if not there:
            return
        if turn is not None:
            first, last, n = s["turns"]
            s["turns"] = [turn if first is None else first, turn, n + (turn != last)]
        if s["last"] is not None:
            s["illegal"] += (s["last"], initial) not in ((0, 1), (1, 2), (2, 1))
        s["last"] = initial
        if fault:
            s[fault] += 1
        t = _TABLE.step(s["state"], initial, FINE if not fault else CUT if fault == "truncated" else MUST_GO)
        s["path"].append(t)
        s["state"], price = _TABLE.steps[t]
        s["cost"] += price
        return
        yield

    def finish(conv, s: dict) -> Iterator:
        first, last, n = s["turns"]
        gaps = 0 if first is None else last - first + 1 - n
        yield (conv, gaps, s["blank"], s["duplicate"], s["truncated"], s["illegal"], s["cost"] + _TABLE.end(s["state"])[0], _TABLE.trace(s["state"], s["path"]))

    return _arrow(ordered, schema, lambda batches: _streams(batches, start, row, finish))


def repaired(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """conv_id, position (from 0), role, text, edit (K, R or I) of the conversations' rows behind the edits that repairs(rows) names.

    Partitions hold whole conversations, each in order."""
    small_batches(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind)]).add("position", "long").add("role", "string").add("text", "string").add("edit", "string")
    own = _known(rows).where("there").select("conv_id", "turn", "digest", "role", "text", F.lit(None).cast("string").alias("audit"))
    none = lambda c: F.lit(None).cast(own.schema[c].dataType).alias(c)
    heads = reports.select("conv_id", none("turn"), none("digest"), none("role"), none("text"), "audit")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = own.unionByName(heads).repartition(n, "conv_id").sortWithinPartitions(*_order("conv_id")[:1], F.col("audit").isNull(), *_order())

    def start() -> dict:
        return {"audit": "", "at": 0, "state": START, "n": 0}

    def put_in(conv, s: dict) -> Iterator:
        while s["audit"][s["at"] : s["at"] + 1] == "I":
            s["state"] = FOLLOWS[s["state"]]
            yield conv, s["n"], ROLES[s["state"]], "", "I"
            s["n"], s["at"] = s["n"] + 1, s["at"] + 1

    def row(s: dict, values: tuple) -> Iterator:
        conv, role, text, audit = values
        if audit is not None:
            s["audit"] = audit
            return
        yield from put_in(conv, s)
        letter = s["audit"][s["at"]]
        s["at"] += 1
        if letter == "D":
            return
        s["state"] = FOLLOWS[s["state"]] if letter == "R" else kept(s["state"], INITIALS.index(role[0]))
        yield conv, s["n"], ROLES[s["state"]] if letter == "R" else role, text, letter
        s["n"] += 1

    return _arrow(both.select("conv_id", "role", "text", "audit"), schema, lambda batches: _streams(batches, start, row, put_in))


def digests(turns: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of repaired(...): the SHA-256 of a conversation's `role:text`, joined by new lines."""
    schema = T.StructType([turns.schema["conv_id"]]).add("repaired_sha256", "string")

    def row(s: list, values: tuple) -> Iterator:
        _, role, text = values
        if s:
            s[0].update(b"\n")
        else:
            s.append(hashlib.sha256())
        s[0].update(f"{role}:{text}".encode())
        return
        yield

    def finish(conv, s: list) -> Iterator:
        yield conv, s[0].hexdigest()

    return _arrow(turns.select("conv_id", "role", "text"), schema, lambda batches: _streams(batches, list, row, finish))
