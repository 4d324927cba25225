"""Minimum-cost role repair of conversations, and their rendering.

A legal conversation has at most one system turn, in front, then user and assistant in turns,
beginning with user and ending with assistant. A source turn can be kept, relabelled, or merged
into the turn before it (which costs more if its role differs), and empty turns can be inserted.
Dynamic programming over the automaton of legal turns finds the cheapest repair; of repairs of one
cost, one with the fewest turns.

One step of that program is a matrix over the automaton's states, and steps compose (sums and
minima), so a conversation need not lie in one task. Rows are range-partitioned in conversation
order; each task sums up the runs of rows that touch its borders as one matrix each; the chain of
those few matrices (two per task at most) fixes the state in which each run begins and ends; and
then each task repairs its own runs. A conversation that holds a third of all rows is repaired by
as many tasks as hold it.

The rendering comes in pieces, one per source or inserted turn, in the order of `seq`; put
together, the pieces of a conversation are its text. No whole conversation is ever one value.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latticeguard.llm.common import materialize

ROLES = ("system", "user", "assistant")
MERGE, RELABEL, INSERT = 1, 2, 3
#: States: before the first turn, then after a turn of each role.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
#: A weight is cost * _COST + turns: cheapest first, then fewest turns; weights add up.
_COST = 1 << 32
_NEVER = 1 << 62
OPEN, CLOSE, GLUE = "<|im_start|>{}\n", "<|im_end|>\n", "\n\n"


def _insertions() -> list[list[tuple[int, ...] | None]]:
    """The shortest run of empty turns that leads from one state to another."""
    paths: list[list[tuple[int, ...] | None]] = [[None] * 4 for _ in range(4)]
    for start in range(4):
        paths[start][start] = ()
        queue = [start]
        for state in queue:
            for after in _NEXT[state]:
                if paths[start][after] is None:
                    paths[start][after] = (*paths[start][state], after)
                    queue.append(after)
    return paths


_PATHS = _insertions()


def _steps(role: str | None) -> list[list[tuple[int, tuple[int, ...], str]]]:
    """[state before][state after] of a source turn: weight, states inserted before it, action."""
    table = [[(_NEVER, (), "")] * 4 for _ in range(4)]
    for before in range(4):
        for after in (SYSTEM, USER, ASSISTANT):
            same = ROLES[after - 1] == role
            options = []
            for middle in range(4):
                inserted = _PATHS[before][middle]
                if inserted is not None and after in _NEXT[middle]:
                    cost = INSERT * len(inserted) + (0 if same else RELABEL)
                    options.append((cost * _COST + len(inserted) + 1, inserted, "keep" if same else "relabel"))
            if before == after:
                options.append(((MERGE + (0 if same else RELABEL)) * _COST, (), "merge"))
            if options:
                table[before][after] = min(options, key=lambda o: o[0])
    return table


_TABLES = {role: _steps(role) for role in (*ROLES, None)}
_END = [(_PATHS[s][ASSISTANT] or ()) if s else () for s in range(4)]
_END_WEIGHT = [(INSERT * _COST + 1) * len(path) for path in _END]


def known_role(role: str | None) -> str | None:
    """The role as the automaton has it; None (any role fits, as a relabel) if it has none."""
    role = (role or "").strip().lower()
    return role if role in ROLES else None


def compose(one: list[list[int]], two: list[list[int]]) -> list[list[int]]:
    return [[min(min(one[i][k] + two[k][j] for k in range(4)), _NEVER) for j in range(4)] for i in range(4)]


IDENTITY = [[0 if i == j else _NEVER for j in range(4)] for i in range(4)]


def run_matrix(roles: list[str | None]) -> list[list[int]]:
    """Least weight from each state to each over a run of source turns."""
    total = IDENTITY
    for role in roles:
        total = compose(total, [[w for w, _, _ in row] for row in _TABLES[role]])
    return total


def solve_chain(matrices: list[list[list[int]]]) -> list[tuple[int, int, int]]:
    """(state before, state after, turns before) of each run of one conversation's chain of runs."""
    weights = [[0, _NEVER, _NEVER, _NEVER]]
    for matrix in matrices:
        weights.append([min(weights[-1][i] + matrix[i][j] for i in range(4)) for j in range(4)])
    state = min(range(4), key=lambda s: weights[-1][s] + _END_WEIGHT[s])
    states = [state]
    for matrix, before in zip(reversed(matrices), reversed(weights[:-1]), strict=True):
        state = min(range(4), key=lambda s: before[s] + matrix[s][state])
        states.append(state)
    states.reverse()
    return [(a, b, weights[i][a] % _COST) for i, (a, b) in enumerate(zip(states, states[1:], strict=False))]


def repair_run(roles: list[str | None], begin: int, end: int) -> list[tuple[tuple[int, ...], str, int]]:
    """(states inserted before, action, state after) of each source turn on the best path from begin to end."""
    weights = [[_NEVER] * 4]
    weights[0][begin] = 0
    for role in roles:
        table = _TABLES[role]
        weights.append([min(weights[-1][i] + table[i][j][0] for i in range(4)) for j in range(4)])
    out, state = [], end
    for role, before in zip(reversed(roles), reversed(weights[:-1]), strict=True):
        table = _TABLES[role]
        source = min(range(4), key=lambda s: before[s] + table[s][state][0])
        _, inserted, action = table[source][state]
        out.append((inserted, action, state))
        state = source
    out.reverse()
    return out


def repair(roles: list[str | None]) -> tuple[int, list[tuple[tuple[int, ...], str, int]], tuple[int, ...]]:
    """(cost, steps, states inserted at the end) of a whole conversation's best repair."""
    matrix = run_matrix(roles)
    ((begin, end, _),) = solve_chain([matrix])
    return (matrix[begin][end] + _END_WEIGHT[end]) // _COST, repair_run(roles, begin, end), _END[end]


def _rendered(conv, rows: list[tuple], begin: int, end: int, turns: int, last: bool) -> Iterator[dict]:
    """Output rows of one run; `rows` are (seq, turn, role, text)."""
    turn_no = turns - 1
    steps = repair_run([known_role(r[2]) for r in rows], begin, end)
    for i, ((seq, turn, _, text), (inserted, action, state)) in enumerate(zip(rows, steps, strict=True)):
        for n, extra in enumerate(inserted):
            turn_no += 1
            yield {"conv": conv, "seq": seq - len(inserted) + n, "out_turn": turn_no, "turn": None,
                   "role": ROLES[extra - 1], "action": "insert",
                   "piece": CLOSE * (turn_no > 0) + OPEN.format(ROLES[extra - 1])}
        if action != "merge":
            turn_no += 1
        opening = GLUE if action == "merge" else CLOSE * (turn_no > 0) + OPEN.format(ROLES[state - 1])
        ends = last and i == len(rows) - 1
        tail = "".join(CLOSE + OPEN.format(ROLES[s - 1]) for s in _END[end]) + CLOSE if ends else ""
        yield {"conv": conv, "seq": seq, "out_turn": turn_no, "turn": turn, "role": ROLES[state - 1], "action": action,
               "piece": opening + (text or "") + (tail if not (ends and _END[end]) else "")}
        if ends:
            for n, extra in enumerate(_END[end]):
                turn_no += 1
                close = CLOSE if n == len(_END[end]) - 1 else ""
                yield {"conv": conv, "seq": seq + 1 + n, "out_turn": turn_no, "turn": None, "role": ROLES[extra - 1],
                       "action": "insert", "piece": CLOSE + OPEN.format(ROLES[extra - 1]) + close}


#: Numbers between two source turns' `seq`, for turns inserted between them.
_GAP = 8


def _ordered(turns: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """The turns, written in conversation order: part, at, run, and the border runs' matrices and sizes on their last row."""
    kinds = {c: turns.schema[c].dataType.simpleString() for c in (key, turn)}
    rows = turns.select(F.col(key).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"),
                        F.col(text).alias("text")).withColumn("h", F.xxhash64("text"))
    order = [F.asc_nulls_first(c) for c in ("conv", "turn", "role", "h")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, run, conv, matrix, size, schema = TaskContext.get().partitionId(), 0, -1, None, None, 0, None
        held: pa.RecordBatch | None = None

        def closed(batch: pa.RecordBatch, matrices: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(matrices, pa.list_(pa.int64()))], schema=schema)

        for batch in batches:
            convs, roles = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            matrices: list = [None] * len(convs)
            runs = []
            for i, (c, r) in enumerate(zip(convs, roles, strict=True)):
                if run < 0 or c != conv:
                    if run == 0:  # the first run has ended: its matrix and size go on the row before
                        if i:
                            matrices[i - 1] = [*sum(matrix, []), size]
                        else:
                            pending[-1] = [*sum(matrix, []), size]
                    run, conv, matrix, size = run + 1, c, IDENTITY, 0
                size += 1
                matrix = compose(matrix, [[w for w, _, _ in row] for row in _TABLES[known_role(r)]])
                runs.append(run)
            if held is not None:
                yield closed(held, pending)
            held = pa.RecordBatch.from_arrays(
                [pa.array([part] * len(convs), pa.int32()), pa.array(range(at, at + len(convs)), pa.int64()),
                 pa.array(runs, pa.int64()), *batch.columns[:4]], names=["part", "at", "run", *batch.schema.names[:4]])
            schema = held.schema.append(pa.field("matrix", pa.list_(pa.int64())))
            pending, at = matrices, at + len(convs)
        if held is not None:
            pending[-1] = [*sum(matrix, []), size]
            yield closed(held, pending)

    out = (f"part int, at long, run long, conv {kinds[key]}, turn {kinds[turn]}, role string, text string, "
           "matrix array<long>")
    return materialize(rows.mapInArrow(number, out), "chat-ordered")


def _borders(ordered: DataFrame) -> dict[tuple[int, int], tuple[int, int, int, bool, int]]:
    """(part, run) -> (state before, state after, turns before, whether the conversation ends there, source turns before)."""
    rows = (ordered.where("matrix IS NOT NULL").select("part", "run", "conv", "matrix").orderBy("part", "run")).collect()
    found = {}
    for _, chain in groupby(rows, key=lambda r: (r["conv"] is None, r["conv"])):
        chain = list(chain)
        solved = solve_chain([[r["matrix"][i:i + 4] for i in range(0, 16, 4)] for r in chain])
        places = 0
        for i, (r, (begin, end, turns)) in enumerate(zip(chain, solved, strict=True)):
            found[r["part"], r["run"]] = (begin, end, turns, i == len(chain) - 1, places)
            places += r["matrix"][16]
    return found


def repair_conversations(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """(key, seq, out_turn, turn, role, action, piece): the repaired turns and their rendering.

    Turns are taken in the order of `turn` (nulls first; ties by role, then by a hash of the text). `seq` counts
    a conversation's source turns in steps of 8, with inserted turns between: no partitioning changes it.
    Null, unknown and oddly cased roles: case and outer blanks don't matter; any other role can
    become each role as a relabel. Null text is empty. Rows with a null key form one conversation.
    Repeated rows are turns of their own. A merged source turn has the `out_turn` of the turn it
    joined; inserted turns have no source `turn`. An empty table gives no rows; other columns are
    ignored.
    """
    ordered = _ordered(turns, key, turn, role, text)
    borders = _borders(ordered)
    kinds = {c: turns.schema[c].dataType.simpleString() for c in (key, turn)}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, now, schema = [], None, None

        def done() -> pa.RecordBatch:
            part, run, conv = now
            if (part, run) in borders:
                begin, end, before, last, places = borders[part, run]
            else:
                ((begin, end, before),) = solve_chain([run_matrix([known_role(r[1]) for r in rows])])
                last, places = True, 0
            numbered = [(_GAP * (places + i + 1), *r) for i, r in enumerate(rows)]
            return pa.RecordBatch.from_pylist(list(_rendered(conv, numbered, begin, end, before, last)), schema)

        for batch in batches:
            types = [f.type for f in batch.schema]
            schema = pa.schema([("conv", types[3]), ("seq", pa.int64()), ("out_turn", pa.int64()), ("turn", types[4]),
                                ("role", pa.string()), ("action", pa.string()), ("piece", pa.string())])
            for part, _, run, conv, number, own, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is not None and (part, run) != now[:2]:
                    yield done()
                    rows = []
                now = (part, run, conv)
                rows.append((number, own, body))
        if now is not None:
            yield done()

    out = f"conv {kinds[key]}, seq long, out_turn long, turn {kinds[turn]}, role string, action string, piece string"
    rows = ordered.drop("matrix").repartition("part").sortWithinPartitions("part", "at")
    return rows.mapInArrow(work, out).withColumnRenamed("turn", turn).withColumnRenamed("conv", key)
