"""Chat formatting by minimum-cost role repair: dynamic programming over an automaton of legal turns.

A legal conversation is an optional system turn, then user and assistant turns in alternation, the last one by the assistant. Every
source turn either opens a turn or is merged into the open one, under its own role or relabelled; empty turns can be inserted before it
and at the end. The cheapest sequence wins (of equals, the first in the order: opening before merging, no insertion before
insertion, roles in the order system, user, assistant).

Path costs of consecutive turns combine like matrices, so a conversation of any length is worked off in blocks of 256 turn numbers: a
block gives its cheapest cost from each state to each, one row per block decides the states between blocks, and each block then
finds its own path. Rendering is one piece per source turn, which together, in order, make the prompt.

A marker within a text is broken by a blank after its first sign, so that no text can open or close a turn.

Defined results: roles are compared without case and outer blanks; a null or unknown role costs a relabel under any role; null texts are empty; turns are ordered
by number, then role, then text, null numbers last; a null conversation id is one conversation; all rows with one number stay in one block. Pieces are ordered by
`block` and `place`, equal and null numbers included; repeated rows are turns of their own; an empty table gives an empty result; columns
other than the four of a conversation are dropped, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROLES = ("system", "user", "assistant")
BLOCK = 256
MERGE, RELABEL, INSERT = 1, 2, 3
START = 0  # states: nothing yet, then the role of the open turn plus one
FAR = 1 << 40
# Markers around a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def legal(state: int, role: int) -> bool:
    """Whether a turn by `role` may follow."""
    return (role == 0 and state == START) or (role == 1 and state != 2) or (role == 2 and state == 2)


def _insertions(state: int, role: int) -> list[int] | None:
    """Roles of the empty turns to insert so that `role` may open a turn; None if none can help."""
    if legal(state, role):
        return []
    for first in (1, 2):
        if legal(state, first) and legal(first + 1, role):
            return [first]
    return None


# (cost without relabel, next state, merged, inserted roles) by state and target role
STEPS = {
    (s, r): [(INSERT * len(i or []), r + 1, False, i)] * (i is not None) + [(MERGE, s, True, [])] * (s == r + 1)
    for s in range(4)
    for r in range(3)
    for i in [_insertions(s, r)]
}
CLOSING = {0: [], 1: [1, 2], 2: [2], 3: []}


def role_number(role: str | None) -> int:
    name = (role or "").strip().lower()
    return ROLES.index(name) if name in ROLES else -1


def moves(state: int, role: int) -> list[tuple[int, int, int, bool, list[int]]]:
    """(cost, target role, next state, merged, inserted) in order of preference."""
    return [(cost + (RELABEL if target != role else 0), target, after, merged, inserted) for target in range(3) for cost, after, merged, inserted in STEPS[state, target]]


def block_costs(roles: list[int]) -> list[int]:
    """Cheapest cost from each state (row) to each (column) over the given turns."""
    out = []
    for begin in range(4):
        cost = [FAR] * 4
        cost[begin] = 0
        for role in roles:
            new = [FAR] * 4
            for s in range(4):
                if cost[s] < FAR:
                    for c, _, after, _, _ in moves(s, role):
                        new[after] = min(new[after], cost[s] + c)
            cost = new
        out += cost
    return out


def best_path(roles: list[int], begin: int, end: int) -> list[tuple[int, int, int, bool, list[int]]]:
    """The move of every turn on the cheapest path between two states."""
    rest = [[FAR] * 4 for _ in range(len(roles) + 1)]
    rest[-1][end] = 0
    for i in range(len(roles) - 1, -1, -1):
        for s in range(4):
            rest[i][s] = min((c + rest[i + 1][after] for c, _, after, _, _ in moves(s, roles[i])), default=FAR)
    path, state = [], begin
    for i, role in enumerate(roles):
        move = min(moves(state, role), key=lambda m: (m[0] + rest[i + 1][m[2]], m[3], len(m[4]), m[1]))
        path.append(move)
        state = move[2]
    return path


def path_between_blocks(costs: list[list[int]]) -> list[tuple[int, int]]:
    """Entry and exit state of every block on the cheapest way through all of them and the closing turns."""
    rest = [[INSERT * len(CLOSING[s]) for s in range(4)]]
    for matrix in reversed(costs):
        rest.append([min(matrix[4 * s + t] + rest[-1][t] for t in range(4)) for s in range(4)])
    rest.reverse()
    found, state = [], START
    for i, matrix in enumerate(costs):
        after = min(range(4), key=lambda t: (matrix[4 * state + t] + rest[i + 1][t], t))
        found.append((state, after))
        state = after
    return found


def harmless(text: str) -> str:
    """The text with its markers broken."""
    for marker in (OPEN, CLOSE.strip()):
        text = text.replace(marker, f"{marker[0]} {marker[1:]}")
    return text


def piece(move: tuple[int, int, int, bool, list[int]], state: int, text: str, last: bool) -> str:
    """What one source turn adds to the prompt."""
    _, role, after, merged, inserted = move
    if merged:
        out = "\n\n" + text
    else:
        out = CLOSE if state != START else ""
        out += "".join(f"{OPEN}{ROLES[r]}\n{CLOSE}" for r in inserted) + f"{OPEN}{ROLES[role]}\n{text}"
    if last:
        out += CLOSE + "".join(f"{OPEN}{ROLES[r]}\n{CLOSE}" for r in CLOSING[after])
    return out


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, list[dict]]]:
    rows = (row for batch in batches for row in batch.to_pylist())
    for key, group in groupby(rows, key=lambda r: tuple(r[k] for k in keys)):
        yield key, list(group)


def repair(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per source turn: conv_id, turn, role (as repaired), merged, n_inserted, piece, block, place; pieces by block and place make the prompt."""
    typed = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col("turn") / block).cast("long"), F.lit((1 << 63) - 1)).alias("block"),
    )
    order = ("conv_id", "block", F.asc_nulls_last("turn"), F.asc_nulls_last("role"), "text")

    def costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = [{"conv_id": c, "block": b, "costs": block_costs([role_number(r["role"]) for r in rows])} for (c, b), rows in _groups(batches, ("conv_id", "block"))]
        if out:
            yield from pa.Table.from_pylist(out, schema=pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("costs", pa.list_(pa.int64()))])).to_batches()

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (conv,), rows in _groups(batches, ("conv_id",)):
            for i, (row, (begin, end)) in enumerate(zip(rows, path_between_blocks([r["costs"] for r in rows]))):
                out.append({"conv_id": conv, "block": row["block"], "begin": begin, "end": end, "last": i == len(rows) - 1})
        if out:
            yield from pa.Table.from_pylist(out, schema=pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("begin", pa.int32()), ("end", pa.int32()), ("last", pa.bool_())])).to_batches()

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("merged", pa.bool_()), ("n_inserted", pa.int64()), ("piece", pa.string()), ("block", pa.int64()), ("place", pa.int64())])
        for (conv, number), rows in _groups(batches, ("conv_id", "block")):
            state, out = rows[0]["begin"], []
            for i, (row, move) in enumerate(zip(rows, best_path([role_number(r["role"]) for r in rows], state, rows[0]["end"]))):
                last = rows[0]["last"] and i == len(rows) - 1
                added = len(move[4]) + (len(CLOSING[move[2]]) if last else 0)
                out.append({"conv_id": conv, "turn": row["turn"], "role": ROLES[move[1]], "merged": move[3], "n_inserted": added, "piece": piece(move, state, harmless(row["text"]), last), "block": number, "place": i})
                state = move[2]
            yield from pa.Table.from_pylist(out, schema=schema).to_batches()

    dealt = typed.repartition("conv_id", "block")
    blocks = dealt.select("conv_id", "block", "turn", "role", "text").sortWithinPartitions(*order).select("conv_id", "block", "role").mapInArrow(costs, "conv_id long, block long, costs array<long>")
    states = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(decide, "conv_id long, block long, begin int, end int, last boolean")
    states = states.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "begin", "end", "last")
    joined = typed.join(states, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).select("conv_id", "block", "turn", "role", "text", "begin", "end", "last")
    placed = joined.repartition("conv_id", "block").sortWithinPartitions(*order)
    return placed.mapInArrow(render, "conv_id long, turn long, role string, merged boolean, n_inserted long, piece string, block long, place long")
