"""Repair of conversation structure by a rank-convergence parallel Viterbi.

A conversation should be nothing, or pairs of a user's and an assistant's turn with at most one system turn ahead. Each row is
kept, given another role or deleted, and empty turns may be inserted; the cheapest edits are wanted, and of
those the ones whose initials come first in ASCII order.

What may follow depends only on the last role, so a conversation is a chain of four states and a row
turns a vector of four costs into another one. Conversations are cut into chunks. A chunk that does not know
the costs behind it starts from a speculative vector. In fix-up passes each chunk looks at what its successor has
come to: where that differs from its start by more than a constant, it works again from the right
vector, until its costs run parallel to those it has already (a few rows as a rule). Once all starts are right up to
constants, the backward costs are stitched together, and one walk along each conversation traces the edits.

Rows of a conversation are in the order of turn, role and text, nulls first. Texts move twice: for that order, and for the
digest of a repaired conversation, which must read its rows one after the other, so a conversation is streamed through one
task there. Its audit is a string of about a character a row, so it must have less than two thousand million rows.

Defined results: a null role or text is one blank, also a null conv_id or turn where rows are chosen for damage. Null conv_ids are one
conversation. Repeated rows are rows of their own. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillwork import session
from tillwork.operators.ordered import positions

BLANKS = r"[\x20\x09-\x0D]"
ENDS = ".!?"
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
#: Rows of a conversation that are worked on as one piece.
CHUNK = 4096

# states by the last role: none, system, user, assistant; the next turn is the user's but after the user
START, SYSTEM, USER, ASSISTANT = range(4)
EXPECTED = (USER, USER, ASSISTANT, USER)
NAMES = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}
#: Costs from the end of a conversation on, insertions included: it may end with nothing or after an assistant.
AT_END = (0, 2 * INSERT, INSERT, 0)
SPECULATIVE = (0, 0, 0, 0)
#: A row's fault, and its role, make its symbol: 4 * fault + role, where role 0 is any other.
FINE, TRUNCATED, DUPLICATE, BLANK = range(4)

Vector = tuple[int, int, int, int]


def _moves(symbol: int) -> list[list[tuple[str, int, int]]]:
    """Per state what may be done with a row: the initial, the cost and the next state."""
    fault, role = divmod(symbol, 4)
    out = []
    for state in range(4):
        moves = [("D", DELETE, state)]
        if fault < DUPLICATE:
            extra = CUT_OFF if fault == TRUNCATED else 0
            if role == EXPECTED[state] or (role == SYSTEM and state == START):
                moves.append(("K", KEEP + extra, role))
            moves.append(("R", REROLE + extra, EXPECTED[state]))
        out.append(moves)
    return out


MOVES = [_moves(symbol) for symbol in range(16)]


def _behind(symbol: int, after: Vector) -> tuple[Vector, int]:
    """Costs in front of a row from those behind it, as a vector whose least cost is 0 and that cost."""
    costs = [min(cost + after[to] for _, cost, to in MOVES[symbol][state]) for state in range(4)]
    for _ in range(2):  # turns put in before the row; a third would lead nowhere new
        costs = [min(costs[s], INSERT + costs[EXPECTED[s]]) for s in range(4)]
    least = min(costs)
    return tuple(c - least for c in costs), least


class Costs(dict):
    """``_behind`` of (symbol, vector), remembered: vectors without their constant are few."""

    def __missing__(self, key):
        self[key] = found = _behind(*key)
        return found


def normal(costs: Vector) -> tuple[Vector, int]:
    return tuple(c - min(costs) for c in costs), min(costs)


def first_pass(known: Costs, symbols: bytes, after: Vector) -> tuple[Vector, int]:
    """Vector in front of the chunk and the constant it has gained."""
    gained = 0
    for symbol in reversed(symbols):
        after, more = known[symbol, after]
        gained += more
    return after, gained


def fix_up(known: Costs, symbols: bytes, before: Vector, after: Vector, front: Vector, gained: int
           ) -> tuple[Vector, int]:
    """What the first pass gives from ``after``, when it gave ``front, gained`` from ``before``.

    Both are followed until they are the same but for a constant; the rest of the chunk stays as it was.
    """
    difference = 0
    for symbol in reversed(symbols):
        if before == after:
            return front, gained + difference
        before, old = known[symbol, before]
        after, new = known[symbol, after]
        difference += new - old
    return after, gained + difference


def trace(known: Costs, symbols: bytes, after: Vector, state: int) -> tuple[list[list[tuple[str, int]]], int]:
    """Edits at each row of a chunk, as (initial, role it gives or 0), and the state behind the chunk.

    Of the cheapest edits each takes the initial that is first in ASCII: D, I, K, R. Equal initials lead to
    equal states, so this is the least audit.
    """
    costs = [after]
    for symbol in reversed(symbols):
        costs.append(known[symbol, costs[-1]][0])
    out = []
    for symbol, front, behind in zip(symbols, costs[:0:-1], costs[-2::-1]):
        # the vector in front is known up to a constant: that of the row's own step
        constant, edits = known[symbol, behind][1], []
        while True:
            left = front[state] + constant
            choices = {letter: (cost + behind[to], to) for letter, cost, to in MOVES[symbol][state]}
            to = EXPECTED[state]
            choices["I"] = (INSERT + front[to] + constant, to)
            letter = min(c for c, (cost, _) in choices.items() if cost == left)
            state = choices[letter][1]
            edits.append((letter, 0 if letter == "D" else state))
            if letter != "I":
                break
        out.append(edits)
    return out, state


# ---- the table side

def role_number(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", SYSTEM).when(first == "u", USER).when(first == "a", ASSISTANT).otherwise(0)


def in_order(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with ``at``, the row's number in its conversation from 0."""
    marked = rows.select(
        F.col("conv_id"), F.col("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), F.monotonically_increasing_id().alias("tie"))
    numbered = positions(session.materialise(marked), ["conv_id"], {"at": ["turn", "role", "text", "tie"]})
    return session.materialise(numbered.drop("tie").withColumn("at", (F.col("at") - 1).cast("long")))


def _chunks(rows: DataFrame, chunk: int) -> DataFrame:
    """``conv_id, chunk, symbols, last``: the symbols of at most ``chunk`` rows, as binary."""
    solid = F.regexp_replace("text", BLANKS + "+$", "")
    same = F.sha2(F.concat_ws("\n", F.length("role").cast("string"), "role", "text"), 256)
    judged = rows.select(
        "conv_id", "at", role_number(F.col("role")).alias("role"), same.alias("same"),
        F.when(solid == "", BLANK).when(F.substring(solid, -1, 1).isin(*ENDS), FINE)
        .otherwise(TRUNCATED).alias("fault"))
    # the first of equal rows, found before the rows meet it again
    first = judged.groupBy("conv_id", "same").agg(F.min("at").alias("first")).select(
        F.col("conv_id").alias("c"), F.col("same").alias("s"), "first")
    met = judged.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("same") == F.col("s")))
    fault = F.when((F.col("fault") != BLANK) & (F.col("at") > F.col("first")), DUPLICATE).otherwise(F.col("fault"))
    symbol = F.struct("at", (4 * fault + F.col("role")).cast("tinyint").alias("symbol"))
    grouped = met.select("conv_id", F.floor(F.col("at") / chunk).alias("chunk"), symbol.alias("row")) \
        .groupBy("conv_id", "chunk").agg(F.sort_array(F.collect_list("row"))["symbol"].alias("symbols"))
    lasts = grouped.groupBy("conv_id").agg(F.max("chunk").alias("last")).withColumnRenamed("conv_id", "c")
    return grouped.join(lasts, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "conv_id", "chunk", "symbols", (F.col("chunk") == F.col("last")).alias("last"))


STATE = ("conv_id {kind}, chunk long, symbols array<tinyint>, last boolean, "
         "after array<int>, front array<int>, gained long, moved boolean")


def _first_passes(chunks: DataFrame, kind: str) -> DataFrame:
    def work(batches):
        known = Costs()
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                r["after"], shift = normal(AT_END if r["last"] else SPECULATIVE)
                r["front"], gained = first_pass(known, bytes(r["symbols"]), r["after"])
                r["gained"], r["moved"] = gained + shift, True
            yield pa.RecordBatch.from_pylist(rows, _arrow(batch))

    return chunks.mapInArrow(work, STATE.format(kind=kind))


def _arrow(batch: pa.RecordBatch) -> pa.Schema:
    vector = pa.list_(pa.int32())
    return pa.schema([*[batch.schema.field(n) for n in ("conv_id", "chunk", "symbols", "last")],
                      ("after", vector), ("front", vector), ("gained", pa.int64()), ("moved", pa.bool_())])


def _fix_ups(state: DataFrame, kind: str) -> DataFrame:
    """One pass: chunks whose successor came to something else than they started from work again."""
    following = state.filter("chunk > 0 and moved").select(
        F.col("conv_id").alias("c"), (F.col("chunk") - 1).alias("k"), F.col("front").alias("right"))
    met = state.join(following, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k")), "left")

    def work(batches):
        known = Costs()
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                right = r.pop("right")
                r["moved"] = right is not None and right != r["after"]
                if r["moved"]:
                    front, r["gained"] = fix_up(known, bytes(r["symbols"]), tuple(r["after"]), tuple(right),
                                                tuple(r["front"]), r["gained"])
                    # a front that stays the same tells the chunk before nothing new
                    r["after"], r["front"] = right, list(front)
            yield pa.RecordBatch.from_pylist(rows, _arrow(batch))

    return met.drop("c", "k").mapInArrow(work, STATE.format(kind=kind))


def viterbi(chunks: DataFrame, kind: str) -> DataFrame:
    """Chunks with the right costs behind each, up to a constant, and the constants they gain."""
    state = session.materialise(_first_passes(chunks, kind))
    if state.filter("chunk > 0").isEmpty():
        return state
    while True:
        state = session.materialise(_fix_ups(state, kind))
        if state.filter("moved").isEmpty():
            return state


class Conversation:
    """Reads one conversation's rows and chunks in order and keeps only what the result needs."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.state, self.cost, self.audit = conv_id, START, 0, []
        self.counts = [0, 0, 0, 0]
        self.illegal = 0
        self.before: int | None = None
        self.turns: tuple[int, int, int] | None = None
        self.digest, self.lines, self.edits, self.symbols, self.place = hashlib.sha256(), 0, [], b"", 0

    def chunk(self, known: Costs, symbols: bytes, after: Vector, front: Vector, gained: int, first: bool) -> None:
        if first:
            self.cost += front[START]
        self.cost += gained
        self.edits, self.state = trace(known, symbols, after, self.state)
        self.symbols, self.place = symbols, 0

    def line(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.lines else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.lines += 1

    def row(self, turn: int | None, role: str, text: str) -> None:
        edits, symbol = self.edits[self.place], self.symbols[self.place]
        self.place += 1
        for letter, to in edits:
            self.audit.append(letter)
            if letter != "D":
                self.line(role if letter == "K" else NAMES[to], "" if letter == "I" else text)
        self.counts[symbol // 4] += 1
        now = symbol % 4
        legal = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
        self.illegal += self.before is not None and (self.before, now) not in legal
        self.before = now
        if turn is not None:
            low, high, n = self.turns or (turn, turn, 0)
            self.turns = (low, turn, n + (n == 0 or turn != high))

    def result(self) -> dict:
        for state in {USER: (ASSISTANT,), SYSTEM: (USER, ASSISTANT)}.get(self.state, ()):
            self.audit.append("I")
            self.line(NAMES[state], "")
        low, high, n = self.turns or (0, 0, 1)
        return {"conv_id": self.conv_id, "gaps": high - low + 1 - n, "blank": self.counts[BLANK],
                "duplicate": self.counts[DUPLICATE], "truncated": self.counts[TRUNCATED], "illegal": self.illegal,
                "cost": self.cost, "audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest()}


REPORT = ("conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")
FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    known, now = Costs(), None
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in (
            "conv_id", "at", "kind", "turn", "role", "text", "symbols", "after", "front", "gained")]
        for conv_id, at, kind, turn, role, text, symbols, after, front, gained in zip(*columns):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    yield now.result()
                now = Conversation(conv_id)
            if kind == 1:
                now.chunk(known, bytes(symbols), tuple(after), tuple(front), gained, at == 0)
            elif kind == 2:
                now.row(turn, role, text)
    if now is not None:
        yield now.result()


def repair(rows: DataFrame, conversations: DataFrame | None = None, chunk: int = CHUNK) -> DataFrame:
    """One row per conversation of ``rows(conv_id, turn, role, text)``: its faults, the cheapest edits and a digest of what they give.

    ``conversations(conv_id)`` names conversations that get a row even if they have no rows.
    """
    kind = dict(rows.dtypes)["conv_id"]
    ordered = in_order(rows)
    chunks = viterbi(_chunks(ordered, chunk), kind)
    named = ordered if conversations is None else conversations
    null = F.lit(None)
    # a conversation's name, then each chunk ahead of its rows
    texts = ordered.select("conv_id", "at", F.lit(2).alias("kind"), F.col("turn").cast("long").alias("turn"), "role",
                           "text", null.cast("array<tinyint>").alias("symbols"), null.cast("array<int>").alias("after"),
                           null.cast("array<int>").alias("front"), null.cast("long").alias("gained"))
    costs = chunks.select("conv_id", (F.col("chunk") * chunk).alias("at"), F.lit(1).alias("kind"), "symbols", "after",
                          "front", "gained")
    names = named.select("conv_id").distinct().select("conv_id", F.lit(-1).cast("long").alias("at"), F.lit(0).alias("kind"))
    lined = texts.unionByName(costs, allowMissingColumns=True).unionByName(names, allowMissingColumns=True) \
        .repartition(session.shuffle_partitions(rows.sparkSession), "conv_id") \
        .sortWithinPartitions("conv_id", "at", "kind")

    def work(batches):
        held = []
        for found in _read(batches):
            held.append(found)
            if len(held) == 1000:
                yield _report(held)
                held = []
        yield _report(held)

    def _report(found):
        ids = pa.int64() if kind == "bigint" else pa.string()
        return pa.RecordBatch.from_pylist(found, pa.schema(
            [("conv_id", ids), *[(f, pa.int64()) for f in FIELDS], ("audit", pa.string()), ("repaired_sha256", pa.string())]))

    return lined.mapInArrow(work, REPORT.format(kind=kind))


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with planted faults, chosen by a checksum of conversation and turn."""
    blank = F.lit(" ")
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    fate = F.crc32(name.cast("binary")) % 20
    spoilt = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), fate.alias("fate"),
        F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"))
    times = F.when(F.col("fate") == 0, F.array()).when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))) \
        .otherwise(F.array(F.lit(1)))
    return spoilt.select("conv_id", "turn", "role", "text", F.explode(times.cast("array<int>"))).drop("col")
