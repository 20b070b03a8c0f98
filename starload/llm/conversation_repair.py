"""Conversation repair: cheapest edits from a suffix-shared automaton of role and fault signatures."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm.common import batches_of
from starload.session import written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

SPACES = " \t\n\x0b\x0c\r"
STOPS = ".!?"

# Grammar of the repaired roles' initials, `(s?(ua)+)?`: state -> initial -> next state.
START, SYSTEM, USER, ASSISTANT = range(4)
GRAMMAR = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
ENDS = (START, ASSISTANT)
WRITTEN = {USER: "user", ASSISTANT: "assistant"}
"""The states that a rerole or an insertion can lead to, with the role it writes."""

# One letter per row of a conversation: its role's initial (s, u, a, other) by its first fault.
FINE, CUT, BLANK, COPY = "suao", "SUAO", "1234", "5678"
GONE = "x"
"""Stands for all rows that must be deleted; with it two rows that allow the same edits have one letter."""

Step = tuple[str, int]
"""An edit's letter and the grammar state after it; an insertion stays at its node, the others go on to the next."""


def insertion(state: int) -> int:
    """The state after the only turn that may be inserted at ``state``."""
    return next(after for after in GRAMMAR[state].values() if after in WRITTEN)


def chosen(ways: list[list[tuple[int, str, int]]]) -> tuple[list[int], tuple[Step, ...]]:
    """Per grammar state the least cost and the step of it, when ``ways`` are those without an insertion first.

    No two steps from one state have the same letter, so of equally cheap audits the one whose next letter comes
    first is the first.
    """
    costs = [min(of)[0] if of else 1 << 60 for of in ways]
    for _ in GRAMMAR:  # a chain of insertions passes each state once at most
        for state in GRAMMAR:
            costs[state] = min(costs[state], INSERT + costs[insertion(state)])
    steps = []
    for state, of in enumerate(ways):
        cheapest = [(letter, after) for cost, letter, after in of if cost == costs[state]]
        if costs[state] == INSERT + costs[insertion(state)]:
            cheapest.append(("I", insertion(state)))
        steps.append(min(cheapest))
    return costs, tuple(steps)


def ways_before(letter: str, costs: list[int]) -> list[list[tuple[int, str, int]]]:
    """What can become of a row of this letter in each state, when ``costs`` are those of going on after it."""
    out = []
    for state, moves in GRAMMAR.items():
        ways = [(DELETE + costs[state], "D", state)]
        if letter != GONE:
            extra = TRUNCATED if letter.isupper() else 0
            for initial, after in moves.items():
                if initial == letter.lower():
                    ways.append((KEEP + extra + costs[after], "K", after))
                elif after in WRITTEN:
                    ways.append((REROLE + extra + costs[after], "R", after))
        out.append(ways)
    return out


class SuffixAutomaton:
    """Solves signatures given from the end and in order, working each shared suffix out once.

    A node is a suffix of signatures. It holds, for every grammar state, the cost-to-go and the first step of the
    best audit suffix, whose rest is that of the node and state the step leads to. Reversed signatures in
    order visit the automaton depth first, so the nodes that later ones can still share are those of the last
    signature: memory is one signature's nodes, 40 bytes each, whatever their number.
    """

    def __init__(self) -> None:
        costs, steps = chosen([[(0, "", s)] if s in ENDS else [] for s in GRAMMAR])
        self.letters: list[str] = []
        self.costs = array("q", costs)
        self.steps = [steps]
        self.known: dict[tuple, tuple] = {}
        self.nodes = 0

    def solve(self, backwards: str) -> tuple[int, str]:
        """Least cost and first audit for the signature that reads so from its end."""
        shared, states = 0, len(GRAMMAR)
        for mine, last in zip(backwards, self.letters):
            if mine != last:
                break
            shared += 1
        del self.letters[shared:], self.steps[shared + 1 :], self.costs[states * (shared + 1) :]
        for letter in backwards[shared:]:
            costs, steps = chosen(ways_before(letter, self.costs[-states:].tolist()))
            self.letters.append(letter)
            self.costs.extend(costs)
            self.steps.append(self.known.setdefault(steps, steps))
            self.nodes += 1
        return self.costs[START - states], self.audit()

    def audit(self) -> str:
        out, node, state = [], len(self.steps) - 1, START
        while True:
            letter, state = self.steps[node][state]
            if not letter:
                return "".join(out)
            out.append(letter)
            node -= letter != "I"


# -- damage -------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and n (1, or 2 for a repeated row) of the rows left after the damage.

    The crc32 of ``conv_id:turn`` modulo 20 decides: 0 drops the row, 1 empties its text, 2 takes ``.!?`` out
    of it, 3 repeats the row, 4 makes it the user's. A null id, turn, role or text counts as one space there.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.pmod(F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn")).cast("binary")), F.lit(20))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        blank("role").alias("role"), blank("text").alias("text"), fate.alias("fate"),
    ).where("fate <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("fate") == 3, 2).otherwise(1).cast("long").alias("n"),
    )


def once_each(rows: DataFrame) -> DataFrame:
    """``rows`` with equal ones joined, their ``n`` added up.

    Only rows whose digest occurs more than once are grouped, so in most tables no text is moved for it, and
    a row that makes up a third of a table is combined in every task before it travels.
    """
    keys = ["conv_id", "turn", "role", "text"]
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in keys[:2]] + [F.md5(F.col(c).cast("binary")) for c in keys[2:]]
    rows = rows.withColumn("_digest", F.md5(F.concat_ws(":", *said).cast("binary")))
    again = rows.groupBy("_digest").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select("_digest")
    again = written(again, "repair-repeated")
    if again.isEmpty():
        return rows.drop("_digest")
    joined = rows.join(again, "_digest", "left_semi").groupBy(*keys).agg(F.sum("n").alias("n"))
    return rows.join(again, "_digest", "left_anti").drop("_digest").unionByName(joined)


# -- signatures ---------------------------------------------------------------------------------


def letters(role: Column, which: Column) -> Column:
    """The letter of a row: its role's initial in the alphabet of its fault."""
    initial = F.substring(role, 1, 1)
    place = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(4)
    return F.substring(which, place, F.lit(1))


def lettered(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text_key and the letters of every row of ``once_each``: one for each copy.

    A row is a duplicate when its conversation has its role and text at an earlier turn; copies beyond
    the first are duplicates of it. What repeats is found by digest, counted in every task before it travels.
    """
    stripped = F.rtrim(F.translate("text", SPACES[1:], " " * (len(SPACES) - 1)))
    slim = rows.select(
        "conv_id", "turn", "role", F.md5(F.col("text").cast("binary")).alias("text_key"), "n",
        (stripped == "").alias("blank"), (F.instr(F.lit(STOPS), F.substring(stripped, -1, 1)) == 0).alias("cut"),
    )
    says = ["conv_id", "role", "text_key"]
    first = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first")
    said = slim.groupBy(*says).agg(F.count(F.lit(1)).alias("times"), first).where("times > 1")
    said = written(said.select(*[F.col(c).alias(f"_{c}") for c in says], "first"), "repair-said")
    same = F.lit(True)
    for c in says:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    later = F.col("first").isNotNull() & ~at.eqNullSafe(F.col("first"))
    fault = F.when(F.col("blank"), BLANK).when(later, COPY).when(F.col("cut"), CUT).otherwise(FINE)
    copies = F.when(F.col("blank"), BLANK).otherwise(COPY)
    return slim.join(said, same, "left").select(
        "conv_id", "turn", "role", "text_key",
        F.concat(
            letters(F.col("role"), fault), F.repeat(letters(F.col("role"), copies), (F.col("n") - 1).cast("int"))
        ).alias("letters"),
    )


def signatures(rows: DataFrame) -> DataFrame:
    """conv_id and signature, the letters of its rows in order, for every conversation with rows.

    Rows are dealt out by ranges of (conversation, turn, role, text digest), so a conversation that holds a third
    of all rows is spread over tasks. Each task joins the letters of what it has of a conversation, and
    only these pieces, a byte a row, come together per conversation, as the answer's audit has to.
    """
    order = ["conv_id", "turn", "role", "text_key"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: list[tuple] = []
        held: list[str] = []
        for batch in batches:
            for conv_id, turn, role, key, text in zip(*(batch.column(c).to_pylist() for c in (*order, "letters"))):
                if not pieces or pieces[-1][0] != conv_id:
                    if pieces:
                        pieces[-1] = (*pieces[-1], "".join(held))
                    if len(pieces) >= 4096:
                        yield _pieces(pieces)
                        pieces = []
                    pieces.append((conv_id, turn is not None, turn, role, key))
                    held = []
                held.append(text)
        if pieces:
            pieces[-1] = (*pieces[-1], "".join(held))
            yield _pieces(pieces)

    laid = lettered(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = laid.mapInArrow(join, "conv_id long, known boolean, turn long, role string, text_key string, piece string")
    put = F.array_sort(F.collect_list(F.struct("known", "turn", "role", "text_key", "piece")))
    return pieces.groupBy("conv_id").agg(put.alias("pieces")).select(
        "conv_id", F.array_join(F.col("pieces.piece"), "").alias("signature")
    )


def _pieces(pieces: list[tuple]) -> pa.RecordBatch:
    names = ["conv_id", "known", "turn", "role", "text_key", "piece"]
    types = [pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*pieces), types)], names=names)


def solved(wanted: DataFrame) -> DataFrame:
    """backwards, cost and audit for every distinct ``backwards`` of ``wanted``.

    Ranges of signatures read from the end bring those with a common suffix to one task, in order; each task
    builds its part of the automaton and works every node out once for all conversations.
    """

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = SuffixAutomaton()
        for batch in batches:
            given = batch.column("backwards").to_pylist()
            found = [automaton.solve(s) for s in given]
            yield pa.RecordBatch.from_pydict({
                "backwards": batch.column("backwards"),
                "cost": pa.array([c for c, _ in found], pa.int64()), "audit": pa.array([a for _, a in found], pa.string()),
            })

    laid = wanted.select("backwards").distinct().repartitionByRange("backwards").sortWithinPartitions("backwards")
    return laid.mapInArrow(solve, "backwards string, cost long, audit string")


# -- repaired texts -----------------------------------------------------------------------------


def repaired(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id, n_turns and repaired_sha256 for every conversation of ``plans(conv_id, audit)``.

    The audit goes ahead of its conversation's rows, which follow in order and are hashed as they pass, so a
    task holds one row and one audit at a time. SHA-256 runs through a conversation from its start
    to its end, so this one step has each conversation in one task, however long.
    """
    first = plans.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
        F.lit("").alias("text_key"), F.col("audit").alias("text"), F.lit(1).cast("long").alias("n"),
    )
    then = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", F.md5(F.col("text").cast("binary")).alias("text_key"), "text", "n")
    order = ["conv_id", "kind", "turn", "role", "text_key"]

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        now: Rendered | None = None
        for whole in batches:
            for batch in batches_of(whole, 4 << 20):
                for conv_id, kind, role, text, n in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "kind", "role", "text", "n"))):
                    if kind == 0:
                        if now:
                            out.append(now.done())
                        now = Rendered(conv_id, text)
                    else:
                        for _ in range(n):
                            now.row(role, text)
                if len(out) >= 4096:
                    yield _rendered(out)
                    out = []
        if now:
            out.append(now.done())
        yield _rendered(out)

    laid = first.unionByName(then).repartition("conv_id").sortWithinPartitions(*order)
    return laid.select("conv_id", "kind", "role", "text", "n").mapInArrow(render, "conv_id long, n_turns long, repaired_sha256 string")


class Rendered:
    """Follows one conversation's audit and hashes the ``role:text`` lines it leads to."""

    def __init__(self, conv_id: int | None, audit: str):
        self.conv_id, self.audit = conv_id, audit
        self.place, self.state, self.turns = 0, START, 0
        self.digest = hashlib.sha256()

    def row(self, role: str, text: str) -> None:
        self._insertions()
        edit = self.audit[self.place]
        self.place += 1
        if edit == "K":
            self._put(role, text, GRAMMAR[self.state][role[:1]])
        elif edit == "R":
            after = insertion(self.state)
            self._put(WRITTEN[after], text, after)

    def _insertions(self) -> None:
        while self.audit[self.place : self.place + 1] == "I":
            self.place += 1
            after = insertion(self.state)
            self._put(WRITTEN[after], "", after)

    def _put(self, role: str, text: str, state: int) -> None:
        self.digest.update((("\n" if self.turns else "") + role + ":" + text).encode())
        self.turns += 1
        self.state = state

    def done(self) -> tuple:
        self._insertions()
        return self.conv_id, self.turns, self.digest.hexdigest()


def _rendered(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 3
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))], names=["conv_id", "n_turns", "repaired_sha256"]
    )


def repair(conversations: DataFrame) -> DataFrame:
    """One row per conversation: its faults after the damage, the cheapest repair and that repair's hash.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, and n_turns of the
    repaired conversation. Rows go by turn, nulls first, equal turns by role and then by the MD5 of the text, so
    rows equal in all of these are next to each other. The first that applies of blank, duplicate and truncated
    counts; grammar and ``illegal`` go by the first character of a role, in its own case.

    All rows with a null conv_id are one conversation; a null role or text is one space, so such a text is blank.
    Texts may be of any length. A conversation that lost all its rows has zeros, an empty audit and the hash of
    nothing. ``gaps`` is null where turns lie further apart than a long can say. Repeated rows are
    duplicates; an empty table gives no rows; other columns are ignored.
    """
    conversations = conversations.select("conv_id", "turn", "role", "text")
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    rows = once_each(damaged(conversations))
    signed = written(signatures(rows), "repair-signatures")

    collapsed = F.translate("signature", BLANK + COPY, GONE * (len(BLANK) + len(COPY)))
    wanted = signed.select("conv_id", "signature", F.reverse(collapsed).alias("backwards"))
    plans = written(wanted.join(written(solved(wanted), "repair-plans"), "backwards").select("conv_id", "signature", "cost", "audit"), "repair-plan-of")

    def held(alphabet: str) -> Column:
        return (F.length("signature") - F.length(F.translate("signature", alphabet, ""))).cast("long")

    initials = F.translate("signature", FINE + CUT + BLANK + COPY, "suao" * 4)
    legal = sum(
        (F.length("initials") - F.length(F.replace(F.col("initials"), F.lit(p), F.lit(p[0])))).cast("long") for p in ("su", "ua", "au")
    )
    counts = plans.withColumn("initials", initials).select(
        "conv_id", held(BLANK).alias("blank"), held(COPY).alias("duplicate"), held(CUT).alias("truncated"),
        (F.greatest(F.length("initials") - 1, F.lit(0)).cast("long") - legal).alias("illegal"), "cost", "audit",
    )
    span = (F.max("turn").cast("decimal(20,0)") - F.min("turn").cast("decimal(20,0)") + 1 - F.count_distinct("turn"))
    gaps = rows.groupBy("conv_id").agg(F.when(F.max("turn").isNull(), 0).otherwise(span).try_cast("long").alias("gaps"), F.lit(True).alias("left"))
    lines = repaired(rows, plans)

    out = every.select(F.col("conv_id").alias("_conv"))
    for part in (counts, gaps, lines):
        part = written(part, "repair-part").withColumnRenamed("conv_id", "_of")
        out = out.join(part, F.col("_conv").eqNullSafe(F.col("_of")), "left").drop("_of")
    zero = ["blank", "duplicate", "truncated", "illegal", "cost", "n_turns"]
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(
        F.col("_conv").alias("conv_id"), F.when(F.col("left"), F.col("gaps")).otherwise(0).cast("long").alias("gaps"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in zero],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
