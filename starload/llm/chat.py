"""Chat formatting: the cheapest repair of a turn sequence that a legal-turn automaton accepts."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.operators.ids import assign_ids
from starload.session import fresh_dir, written

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}
# Names that other chat formats give to the three roles.
NAMES = {
    "system": SYSTEM, "developer": SYSTEM, "user": USER, "human": USER, "prompter": USER,
    "assistant": ASSISTANT, "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT,
}
MERGE, INSERT, RELABEL = 1, 2, 3
"""Costs of appending a turn to the one before, of an empty turn put in, and of another role."""
PIECE = 1000
"""Turns per piece of a conversation; a longer conversation is repaired by several tasks."""
DRAW = 5
"""Seed of the draw that deals out turns equal in everything."""

# Legal: at most one system turn, first; then user and assistant in turn, ending with assistant.
_BETWEEN = {
    START: {SYSTEM: (), USER: (), ASSISTANT: (USER,)},
    SYSTEM: {USER: (), ASSISTANT: (USER,)},
    USER: {ASSISTANT: (), USER: (ASSISTANT,)},
    ASSISTANT: {USER: (), ASSISTANT: (USER,)},
}
_CLOSING = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}

Step = tuple[int, int, tuple[int, ...], bool]
"""Cost, state reached, empty turns put in before, whether the turn is appended to the one before."""


def steps(state: int, role: int | None) -> list[Step]:
    """All ways to take a turn of this role in this state, the preferred of equal cost first."""
    found = []
    for target in (SYSTEM, USER, ASSISTANT):
        relabel = 0 if target == role else RELABEL
        if target in _BETWEEN[state]:
            between = _BETWEEN[state][target]
            found.append((relabel + INSERT * len(between), target, between, False))
        if target == state:
            found.append((relabel + MERGE, target, (), True))
    return sorted(found, key=lambda s: (s[0], s[3], s[1] != role, s[1]))


def transfer(roles: list[int | None], entry: int) -> list[tuple[float, list[Step]]]:
    """For each exit state the least cost of the turns from ``entry`` and how it is reached."""
    reached: dict[int, tuple[float, tuple]] = {entry: (0.0, ())}
    for role in roles:
        after: dict[int, tuple[float, tuple]] = {}
        for state in sorted(reached):
            cost, path = reached[state]
            for step in steps(state, role):
                total = cost + step[0]
                if step[1] not in after or total < after[step[1]][0]:
                    after[step[1]] = (total, (path, step))
        reached = after
    out = []
    for state in range(4):
        cost, path = reached.get(state, (float("inf"), ()))
        taken = []
        while path:
            path, step = path
            taken.append(step)
        out.append((cost, taken[::-1]))
    return out


def closing_cost(state: int) -> int:
    return INSERT * len(_CLOSING[state])


def role_of(name: str | None) -> int | None:
    return NAMES.get((name or "").strip().lower())


def opening(role: int) -> str:
    return f"<|im_start|>{ROLES[role]}\n"


CLOSED = "<|im_end|>\n"


def repaired(turns: list[tuple[int | None, str, str | None]], entry: int, exit_: int | None, is_last: bool) -> list[dict]:
    """Output turns of one piece from its entry state to its exit state; None picks the cheapest end."""
    ways = transfer([role for role, _, _ in turns], entry)
    if exit_ is None:
        exit_ = min(range(4), key=lambda s: (ways[s][0] + closing_cost(s), s))
    rows: list[dict] = []
    open_ = entry != START

    def put(role: int, text: str, action: str, cost: int) -> None:
        nonlocal open_
        rows.append({
            "role": ROLES[role], "text": text, "action": action, "cost": cost,
            "rendered": (CLOSED if open_ else "") + opening(role) + text,
        })
        open_ = True

    for (role, name, text), (cost, state, between, merged) in zip(turns, ways[exit_][1]):
        content = text or ""
        relabel = state != role
        for empty in between:
            put(empty, "", "inserted", INSERT)
        if merged:
            rows.append({
                "role": ROLES[state], "text": content, "action": "relabelled, merged" if relabel else "merged",
                "cost": cost, "rendered": "\n" + content,
            })
        else:
            put(state, content, "relabelled" if relabel else "kept", cost - INSERT * len(between))
    if is_last:
        for empty in _CLOSING[exit_]:
            put(empty, "", "inserted", INSERT)
        if rows:
            rows[-1]["rendered"] += CLOSED
    return rows


_TURNS = ["conv_id", "piece"]


def _pieces(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, list]]:
    """(conversation and piece, rows) from frames sorted by them; a piece may span frames."""

    def rows() -> Iterator[tuple]:
        for frame in frames:
            columns = [c.astype(object).where(c.notna(), None).tolist() for _, c in frame.items()]
            yield from zip(*columns)

    for key, group in groupby(rows(), key=lambda r: r[:2]):
        yield key, list(group)


def format_chats(conversations: DataFrame, piece: int = PIECE) -> DataFrame:
    """The repaired turns of every conversation, in order of (conv_id, piece, position).

    Columns: conv_id, piece, position, source_turn (null for an inserted turn), role, text, action,
    cost, rendered. Joining ``rendered`` in that order gives the formatted conversation; a merged turn
    continues the one before. The sum of ``cost`` is the least possible.

    A conversation is cut every ``piece`` rows, so that a task never holds more than a piece of one, whatever its
    turn numbers: all turns are sorted into files by range, and a turn's place there, which no retry can change,
    less that of its conversation's first turn says which piece it is in. For conversations of several pieces, each
    piece first yields its least cost from every state to every state, these small tables are chained per
    conversation to fix where each piece starts and ends, and then the pieces are written out like whole
    conversations.

    Turns go by number, then role, then the first characters of the text, then its hash; equal numbers are separate
    turns, null numbers come first. Null conversation ids are one conversation. A null or unknown role is relabelled,
    null text is empty, texts may be of any length. An empty table gives no rows; other columns are ignored.
    """
    order = ["conv_id", "turn", "role", "_head", "_hash", "_draw"]
    given = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text",
        F.substring("text", 1, 64).alias("_head"), F.xxhash64("text").alias("_hash"), F.rand(DRAW).alias("_draw"),
    )
    spark = conversations.sparkSession
    placed = assign_ids(given, "_place", order, fresh_dir(spark, "chat-turns")).drop("_head", "_hash", "_draw")
    spans = placed.groupBy("conv_id").agg(F.min("_place").alias("_first"), F.max("_place").alias("_last"))
    several = spans.where(F.col("_last") - F.col("_first") >= piece).select(F.col("conv_id").alias("_conv"), "_first")
    several = written(several, "chat-long")
    columns = ["conv_id", "piece", "turn", "role", "text"]
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    if several.isEmpty():
        none = F.lit(None).cast("int")
        turns = placed.withColumns({"piece": F.lit(0).cast("long"), "entry": none, "exit": none, "is_last": none.cast("boolean")})
    else:
        number = F.coalesce(F.floor((F.col("_place") - F.col("_first")) / piece), F.lit(0))
        cut = placed.join(several, same, "left").withColumn("piece", number)
        long_turns = cut.where(F.col("_first").isNotNull()).select(*columns, "_place")
        tables = _laid_out(long_turns).mapInPandas(_tables, "conv_id long, piece long, costs array<double>")
        states = written(
            tables.groupBy("conv_id").applyInPandas(_chain, "_conv long, _piece long, entry int, exit int, is_last boolean"),
            "chat-states",
        )
        on = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("piece") == F.col("_piece"))
        turns = cut.drop("_conv", "_first").join(states, on, "left")
    turns = turns.select(*columns, "entry", "exit", "is_last", "_place")

    def write_out(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        for (conv_id, number), rows in _pieces(frames):
            entry, exit_, is_last = rows[0][5:8]
            given = [(role_of(r[3]), r[3], r[4]) for r in rows]
            out = repaired(given, START if entry is None else int(entry), None if exit_ is None else int(exit_),
                           True if is_last is None else bool(is_last))
            sources = iter(r[2] for r in rows)
            held.extend(
                (conv_id, number, k, None if o["action"] == "inserted" else next(sources),
                 o["role"], o["text"], o["action"], o["cost"], o["rendered"])
                for k, o in enumerate(out)
            )
            if len(held) >= 5000:
                yield _frame(held)
                held = []
        if held:
            yield _frame(held)

    return _laid_out(turns).mapInPandas(
        write_out,
        "conv_id long, piece long, position long, source_turn long, role string, text string, action string, "
        "cost long, rendered string",
    )


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = ["conv_id", "piece", "position", "source_turn", "role", "text", "action", "cost", "rendered"]
    whole = {"conv_id", "piece", "position", "source_turn", "cost"}
    return pd.DataFrame({
        n: pd.array(c, dtype="Int64") if n in whole else list(c) for n, c in zip(names, zip(*rows))
    })


def _laid_out(turns: DataFrame) -> DataFrame:
    laid = turns.repartition(*_TURNS).sortWithinPartitions(*_TURNS, "_place")
    return laid.drop("_place")


def _tables(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for (conv_id, number), rows in _pieces(frames):
        roles = [role_of(r[3]) for r in rows]
        costs = [cost for entry in range(4) for cost, _ in transfer(roles, entry)]
        yield pd.DataFrame({"conv_id": pd.array([conv_id], dtype="Int64"), "piece": [number], "costs": [costs]})


def _chain(frame: pd.DataFrame) -> pd.DataFrame:
    """Where each piece of one conversation starts and ends on the cheapest way through all of them."""
    frame = frame.sort_values("piece")
    tables = [[row[4 * s : 4 * s + 4] for s in range(4)] for row in frame["costs"]]
    reached, came = {START: 0.0}, []
    for table in tables:
        after: dict[int, tuple[float, int]] = {}
        for entry, cost in sorted(reached.items()):
            for state in range(4):
                total = cost + table[entry][state]
                if total < float("inf") and (state not in after or total < after[state][0]):
                    after[state] = (total, entry)
        came.append({s: entry for s, (_, entry) in after.items()})
        reached = {s: cost for s, (cost, _) in after.items()}
    state = min(reached, key=lambda s: (reached[s] + closing_cost(s), s))
    path = []
    for before in reversed(came):
        path.append((before[state], state))
        state = before[state]
    path.reverse()
    return pd.DataFrame({
        "_conv": pd.array(frame["conv_id"], dtype="Int64"), "_piece": frame["piece"].tolist(),
        "entry": [a for a, _ in path], "exit": [b for _, b in path],
        "is_last": [k == len(path) - 1 for k in range(len(path))],
    })
