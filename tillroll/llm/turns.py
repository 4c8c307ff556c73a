"""Conversation structure repair by cheapest edits (operator 12).

A conversation's rows are edited (kept, given another role, deleted, inserted) until the
initials of their roles are an optional ``s`` and then ``ua`` any number of times, or none.

1. A cost DP runs from the last row to the first over four states: nothing written yet, or
   the last written initial. A stretch of rows is a 4 x 4 matrix of costs, so long
   conversations are cut into blocks whose matrices are put together from the end.
2. The arcs of least cost leave a node (row, state) for others. Nodes are ranked by the first
   1, 2, 4, ... letters of their least audit, each rank from two of the step before, with
   pointers that double along. A node's arc is the least by letter and the rank of the node
   it leads to, and the doubled pointers give every place of a path without walking it.

Rows are dealt by ranges of (conversation, turn, role, text), so that a conversation of any
size is spread over tasks. All conversations that lie inside one range are settled there. The
first and the last of each range may go on in others: of these, each range's stretch gives
its matrix, and, once the costs behind it are known, the state in which it leaves a reader
that enters in each state; both are rows of fixed size, at most two for each range, which
the driver puts in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.storage import written

DELETE, CHANGE, CUT_SHORT = 4, 3, 3  # costs; an insertion costs as much as a change
NO_PATH = 1 << 40
BLOCK = 512
PIECE = 1 << 22  # bytes of repaired text in one row between tasks

# states: 0 nothing written, 1 after s, 2 after u, 3 after a; roles: 0 s, 1 u, 2 a, 3 other
NEXT = np.array([2, 2, 3, 2])  # after writing what may follow: u, or a after u
WRITES = ("user", "user", "assistant", "user")
KEPT = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
OK, BLANK, DUPLICATE, TRUNCATED, END = range(5)
LETTERS = np.array(["", "D", "I", "K", "R"])  # in ASCII order


# ---- costs -----------------------------------------------------------------------------
def _before(role: np.ndarray, fault: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Costs [row, state, ...] before a row of each sequence from those after it."""
    extra = (1,) * (after.ndim - 2)
    shape = (-1, *extra)
    short = np.where(fault == TRUNCATED, CUT_SHORT, 0).reshape(shape)
    gone = ((fault == BLANK) | (fault == DUPLICATE)).reshape(shape)
    end = (fault == END).reshape(shape)
    used = np.empty_like(after)
    rows = np.arange(len(role))
    for state in range(4):
        to = KEPT[state][role]
        kept = np.where((to >= 0).reshape(shape), after[rows, to] + short, NO_PATH)
        changed = after[:, NEXT[state]] + CHANGE + short
        best = np.where(gone, NO_PATH, np.minimum(kept, changed))
        best = np.minimum(best, after[:, state] + DELETE)
        used[:, state] = np.where(end, after[:, state] if state in (0, 3) else NO_PATH, best)
    return _inserted(np.minimum(used, NO_PATH))


def _inserted(used: np.ndarray) -> np.ndarray:
    """Insertions before a row: u leads to state 2, a from there to 3, and u back."""
    out = used.copy()
    out[:, 2] = np.minimum(used[:, 2], used[:, 3] + CHANGE)
    out[:, 3] = np.minimum(used[:, 3], used[:, 2] + CHANGE)
    for state in (0, 1):
        out[:, state] = np.minimum(used[:, state], out[:, 2] + CHANGE)
    return out


def _backward(role: np.ndarray, fault: np.ndarray, begin: np.ndarray, length: np.ndarray,
              after: np.ndarray, store: np.ndarray | None = None) -> np.ndarray:
    """Costs before each block, all blocks side by side; ``store`` takes those of each row."""
    by = np.argsort(-length, kind="stable")
    at, after = begin[by], after[by].copy()
    active = np.searchsorted(-length[by], -np.arange(1, (length.max() if len(length) else 0) + 1), side="right")
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        rows = at[:n] + t
        after[:n] = _before(role[rows], fault[rows], after[:n])
        if store is not None:
            store[rows] = after[:n]
    out = np.empty_like(after)
    out[by] = after
    return out


def matrices(role: np.ndarray, fault: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """For each block the cost of entering in a state and leaving in another."""
    ends = np.where(np.eye(4, dtype=bool), 0, NO_PATH).astype(np.int64)
    return _backward(role, fault, begin, length, np.repeat(ends[None], len(begin), axis=0))


def through(matrix: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Costs before a block from its matrix and the costs after it."""
    return np.minimum((matrix + after[None, :]).min(axis=1), NO_PATH)


def costs(role: np.ndarray, fault: np.ndarray, bounds: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """Cost [row, state] from each row on; sequence i is bounds[i]:bounds[i + 1] and
    ``tails[i]`` are the costs behind it."""
    begin, length, after = [], [], []
    for i in np.flatnonzero(np.diff(bounds) > BLOCK):  # long: block by block from the end
        starts = np.arange(bounds[i], bounds[i + 1], BLOCK)
        sizes = np.minimum(BLOCK, bounds[i + 1] - starts)
        tail = tails[i]
        for start, size, matrix in zip(starts[::-1], sizes[::-1], matrices(role, fault, starts, sizes)[::-1]):
            begin.append(start)
            length.append(size)
            after.append(tail)
            tail = through(matrix, tail)
    short = np.diff(bounds) <= BLOCK
    begin = np.concatenate((bounds[:-1][short], np.array(begin, np.int64)))
    length = np.concatenate((np.diff(bounds)[short], np.array(length, np.int64)))
    after = np.concatenate((tails[short], np.array(after, np.int64).reshape(-1, 4)))
    store = np.zeros((len(role), 4), np.int64)
    _backward(role, fault, begin, length, after, store)
    return store


# ---- paths -----------------------------------------------------------------------------
class Paths:
    """The least cheapest paths through sequences of rows. Node 4 * row + state; the last four
    nodes are the ends, one for each state."""

    def __init__(self, role: np.ndarray, fault: np.ndarray, bounds: np.ndarray, tails: np.ndarray) -> None:
        self.bounds, self.n = bounds, len(role)
        self.cost = costs(role, fault, bounds, tails)
        after = np.concatenate((self.cost[1:], np.zeros((1, 4), np.int64)))[:self.n]
        last = (bounds[1:] - 1)[np.diff(bounds) > 0]
        after[last] = tails[np.diff(bounds) > 0]
        behind = 4 * (np.arange(self.n) + 1)
        behind[last] = 4 * self.n
        self.letter, self.to = self._arcs(role, fault, after, behind)
        self._double()

    def _arcs(self, role: np.ndarray, fault: np.ndarray, after: np.ndarray,
              behind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each node and letter where the cheapest arc of that letter leads, or -1."""
        n, rows = self.n, np.arange(self.n)
        short = np.where(fault == TRUNCATED, CUT_SHORT, 0)
        end, gone = fault == END, (fault == BLANK) | (fault == DUPLICATE)
        to = np.full((4 * n + 4, len(LETTERS)), -1, np.int64)
        to[4 * n:, 0] = 4 * n + np.arange(4)
        for state in range(4):
            here, nodes = self.cost[:, state], 4 * rows + state
            kept = KEPT[state][role]
            follow = NEXT[state]
            for letter, target, price, may in (
                    (0, behind + state, after[:, state], end & (state in (0, 3))),
                    (1, behind + state, after[:, state] + DELETE, ~end),
                    (2, 4 * rows + follow, self.cost[:, follow] + CHANGE, np.ones(n, bool)),
                    (3, behind + kept, after[rows, kept] + short, ~end & ~gone & (kept >= 0)),
                    (4, behind + follow, after[:, follow] + CHANGE + short, ~end & ~gone)):
                best = may & (price == here) & (here < NO_PATH)
                to[nodes[best], letter] = target[best]
        lost = (to < 0).all(axis=1)  # no way on from here: such nodes are on no path
        to[lost, 0] = 4 * n
        return np.arange(len(LETTERS)), to

    def _double(self) -> None:
        """Ranks by the first 2 ** k letters and pointers over 2 ** k arcs. A letter leads one
        way from a node, so the least letter gives the pointer to begin with."""
        nodes = np.arange(len(self.to))
        rank = np.argmax(self.to >= 0, axis=1)
        pointer = self.to[nodes, rank]
        while (pointer < 4 * self.n).any():
            pair = rank * (rank.max() + 1) + rank[pointer]
            rank = np.unique(pair, return_inverse=True)[1]
            pointer = pointer[pointer]
        # of all cheapest arcs the one least by its letter and the rank of what follows
        follows = np.where(self.to >= 0, rank[self.to], 0)
        order = np.where(self.to >= 0, self.letter[None] * (rank.max() + 1) + follows, NO_PATH)
        self.first = np.argmin(order, axis=1)
        self.rank = rank
        self.pointers = [self.to[nodes, self.first]]
        while (self.pointers[-1] < 4 * self.n).any():
            self.pointers.append(self.pointers[-1][self.pointers[-1]])

    def roots(self, states: np.ndarray) -> np.ndarray:
        """The node where each sequence is entered."""
        empty = np.diff(self.bounds) == 0
        return np.where(empty, 4 * self.n, 4 * self.bounds[:-1]) + states

    def leaves(self, roots: np.ndarray) -> np.ndarray:
        """The state in which the path from each node ends."""
        return self.pointers[-1][roots] - 4 * self.n

    def walk(self, roots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All arcs of the paths from ``roots``: path, letter, row and state, in order."""
        node, length = roots.copy(), (roots < 4 * self.n).astype(np.int64)
        for k in range(len(self.pointers) - 1, -1, -1):
            further = self.pointers[k][node]
            on = further < 4 * self.n
            node, length = np.where(on, further, node), length + (on << k)
        path = np.repeat(np.arange(len(roots)), length)
        step = np.arange(len(path)) - np.repeat(np.cumsum(length) - length, length)
        node = roots[path]
        for k, pointer in enumerate(self.pointers):
            node = np.where(step >> k & 1, pointer[node], node)
        letter = self.first[node]
        edit = letter > 0
        return path[edit], letter[edit], node[edit] >> 2, node[edit] & 3


# ---- rows of whole conversations ---------------------------------------------------------
def _changes(column: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before it."""
    if len(column) < 2:
        return np.zeros(0, bool)
    a, b = column[:-1], column[1:]
    nulls = pc.is_null(a).to_numpy(False), pc.is_null(b).to_numpy(False)
    differ = pc.fill_null(pc.not_equal(a, b), False).to_numpy(False)
    return differ | (nulls[0] != nulls[1])


def _duplicates(whose: np.ndarray, fault: np.ndarray, role: list, text: list) -> np.ndarray:
    frame = pd.DataFrame({"whose": whose, "role": role, "text": text})
    return np.where((fault != BLANK) & frame.duplicated().to_numpy(), DUPLICATE, fault)


def _counts(role: np.ndarray, fault: np.ndarray, turn: pa.Array, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """Per sequence of rows: faults, illegal neighbours and turns; rows ordered by turn, nulls
    first."""
    def total(hit: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(hit)))
        return sums[bounds[1:]] - sums[bounds[:-1]]

    pair = np.zeros(len(role), bool)  # of a row and the one before it
    changed = np.zeros(len(role), bool)
    if len(role):
        pair[1:] = ~legal(role[:-1], role[1:])
        changed[1:] = _changes(turn)
        heads = bounds[:-1][np.diff(bounds) > 0]
        pair[heads] = False
        changed[heads] = True
    missing = pc.is_null(turn).to_numpy(False)
    numbers = pc.fill_null(turn, 0).to_numpy(False)
    nulls, rows = total(missing), np.diff(bounds)
    some = rows > nulls
    low, high = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    low[some], high[some] = numbers[(bounds[:-1] + nulls)[some]], numbers[(bounds[1:] - 1)[some]]
    return {"rows": rows, "blank": total(fault == BLANK), "duplicate": total(fault == DUPLICATE),
            "truncated": total(fault == TRUNCATED), "illegal": total(pair), "low": low, "high": high,
            "turns": total(changed & ~missing), "dated": some}


def legal(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """su, ua and au."""
    return ((before == 0) & (after == 1)) | ((before == 1) & (after == 2)) | ((before == 2) & (after == 1))


def gaps(low: np.ndarray, high: np.ndarray, turns: np.ndarray, dated: np.ndarray) -> np.ndarray:
    return np.where(dated, high - low + 1 - turns, 0)


def _lines(paths: tuple, role: list, text: list) -> Iterator[tuple[int, str, str | None, str | None]]:
    """path, letter, and the role and text that the edit leaves (None: deleted)."""
    for path, letter, row, state in zip(*(x.tolist() for x in paths)):
        if letter == 1:
            yield path, "D", None, None
        elif letter == 2:
            yield path, "I", WRITES[state], ""
        elif letter == 3:
            yield path, "K", role[row], text[row]
        else:
            yield path, "R", WRITES[state], text[row]


def _with_ends(rows: np.ndarray, fault: np.ndarray, role: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Roles and faults of sequences with an end row behind each; their bounds, and for each
    row where it came from."""
    bounds = np.concatenate(([0], np.cumsum(rows + 1)))
    source = np.full(int(bounds[-1]), -1, np.int64)
    inner = np.ones(len(source), bool)
    inner[bounds[1:] - 1] = False
    source[inner] = np.arange(len(role))
    roles, faults = np.full(len(source), 3), np.full(len(source), END)
    roles[inner], faults[inner] = role, fault
    return roles, faults, bounds, source


RESULT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")
TURN = "place long, edit string, role string, text string"


def _settled(table: pa.Table, as_turns: bool) -> pa.Table:
    """Whole conversations, rows in order -> a row for each, or their edited turns."""
    table = table.combine_chunks()
    conv = table.column("conv").combine_chunks() if table.num_rows else table.column("conv")
    change = np.concatenate(([True], _changes(conv)))
    whose = np.cumsum(change) - 1
    names = conv.take(pa.array(np.flatnonzero(change)))
    present = table.column("present").to_numpy()
    kept = table.filter(pa.array(present))
    whose, n = whose[present], int(change.sum())
    role, text = kept.column("role").to_pylist(), kept.column("text").to_pylist()
    kind = kept.column("kind").to_numpy().astype(np.int64)
    fault = _duplicates(whose, kept.column("fault").to_numpy().astype(np.int64), role, text)
    bounds = np.searchsorted(whose, np.arange(n + 1))
    counts = _counts(kind, fault, kept.column("turn").combine_chunks() if len(kind) else pa.array([], pa.int64()), bounds)
    kinds, faults, ended, source = _with_ends(counts["rows"], fault, kind)
    paths = Paths(kinds, faults, ended, np.zeros((n, 4), np.int64))
    roots = paths.roots(np.zeros(n, np.int64))
    path, letter, row, state = paths.walk(roots)
    edits = _lines((path, letter, source[row], state), role, text)
    if as_turns:
        found = [(p, e, r, t) for p, e, r, t in edits]
        place = np.arange(len(path)) - np.searchsorted(path, path)
        return pa.table({"conv": names.take(pa.array(path)), "place": pa.array(place, pa.int64()),
                         "edit": pa.array([f[1] for f in found], pa.string()),
                         "role": pa.array([f[2] for f in found], pa.string()),
                         "text": pa.array([f[3] for f in found], pa.string())})
    audits = [""] * n
    lines: list[list[str]] = [[] for _ in range(n)]
    first = np.searchsorted(path, np.arange(n + 1))
    letters = "".join(LETTERS[letter])
    for i in range(n):
        audits[i] = letters[first[i]:first[i + 1]]
    for p, _, r, t in edits:
        if r is not None:
            lines[p].append(f"{r}:{t}")
    return pa.table({
        "conv": names, "gaps": gaps(counts["low"], counts["high"], counts["turns"], counts["dated"]),
        **{k: counts[k] for k in ("blank", "duplicate", "truncated", "illegal")},
        "cost": paths.cost[ended[:-1], 0], "audit": pa.array(audits, pa.string()),
        "repaired_sha256": pa.array([hashlib.sha256("\n".join(x).encode()).hexdigest() for x in lines], pa.string())})


# ---- Spark -----------------------------------------------------------------------------
def damage(rows: DataFrame) -> DataFrame:
    """The damage that the query asks for, by crc32 of ``conv_id:turn`` modulo 20: 0 drops a
    row, 1 empties its text, 2 takes its full stops and the like, 3 repeats it, 4 makes its
    role user. Nulls in the key, the role and the text stand for one space. Adds ``present``;
    a dropped row stays with present = false, so that its conversation is still known."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"),
                       F.coalesce("text", space).alias("text"),
                       (F.crc32(key.cast("binary")) % 20).alias("harm"))
    text = (F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")))
    rows = rows.select("conv_id", "turn", F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), "harm")
    copies = F.when(F.col("harm") == 3, F.array(F.lit(True), F.lit(True))).otherwise(F.array(F.col("harm") != 0))
    return rows.select("conv_id", "turn", "role", "text", F.explode(copies).alias("present"))


def _dealt(rows: DataFrame, conv: str, turn: str, role: str, text: str, present: str | None) -> DataFrame:
    """Rows by ranges of conversation, turn, role and text, ordered; what the DP needs of
    each worked out."""
    first = F.substring(F.col("role"), 1, 1)
    kind = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    bare = F.rtrim(F.col("text"), F.lit(" \t\n\v\f\r"))
    fault = (F.when(bare == "", BLANK).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), OK).otherwise(TRUNCATED))
    rows = rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        (F.coalesce(F.col(present), F.lit(False)) if present else F.lit(True)).alias("present"))
    rows = rows.select("*", kind.cast("byte").alias("kind"), fault.cast("byte").alias("fault"),
                       F.xxhash64("role", "text").alias("hash"),
                       # parts rows that are the same in all of these
                       F.monotonically_increasing_id().alias("row"))
    order = ["conv", "turn", "role", "hash"]
    return (rows.repartitionByRange(*order, "row").sortWithinPartitions(*order, "text", "row")
            .select("conv", "turn", "role", "text", "present", "kind", "fault"))


ROW = "turn long, role string, text string, present boolean, kind byte, fault byte"


def _first_pass(as_turns: bool, names: list[str]):
    """Ordered rows of a range -> results of the conversations inside it (``done``), and as
    they are the rows of its first and last conversation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, place = TaskContext.get().partitionId(), 0
        held: list[pa.Table] = []  # rows from the conversation on that is not known to be over
        inside = False  # whether the first conversation is over

        def unsettled(table: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal place
            n = table.num_rows
            yield from _as(table.append_column("done", pa.array([False] * n))
                           .append_column("part", pa.array([part] * n, pa.int32()))
                           .append_column("pos", pa.array(np.arange(place, place + n))), names)
            place += n

        def settled(table: pa.Table) -> Iterator[pa.RecordBatch]:
            found = _settled(table, as_turns)
            yield from _as(found.append_column("done", pa.array([True] * found.num_rows)), names)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not table.num_rows:
                continue
            conv = table.column("conv").combine_chunks()
            change = _changes(conv)
            heads = np.flatnonzero(change) + 1
            if held and _changes(pa.concat_arrays([held[-1].column("conv").combine_chunks()[-1:], conv[:1]]))[0]:
                heads = np.concatenate(([0], heads))
            if not len(heads):
                if inside:
                    held.append(table)
                else:
                    yield from unsettled(table)
                    held = [table.slice(table.num_rows - 1)]  # for the next comparison
                continue
            if inside:
                yield from settled(pa.concat_tables([*held, table.slice(0, heads[-1])]))
            else:
                if heads[0]:
                    yield from unsettled(table.slice(0, heads[0]))
                inside = True
                if heads[-1] > heads[0]:
                    yield from settled(table.slice(heads[0], heads[-1] - heads[0]))
            held = [table.slice(heads[-1])]
        if inside and held:
            yield from unsettled(pa.concat_tables(held))
    return run


def _as(table: pa.Table, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Columns by name; those that are missing are null."""
    n = table.num_rows
    columns = [table.column(x) if x in table.column_names else None for x in names]
    kinds = {"part": pa.int32(), "pos": pa.int64(), "turn": pa.int64(), "role": pa.string(), "text": pa.string(),
             "present": pa.bool_(), "kind": pa.int8(), "fault": pa.int8(), "place": pa.int64(),
             "edit": pa.string(), "audit": pa.string(), "repaired_sha256": pa.string()}
    whole = pa.table([pa.nulls(n, kinds.get(x, pa.int64())) if c is None else c for x, c in zip(names, columns)], names=names)
    yield from whole.combine_chunks().to_batches(max_chunksize=10_000)


def repair(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", present_col: str | None = None) -> DataFrame:
    """A row for each conversation: ``conv_col``, gaps (turn numbers missing between the least
    and the greatest), blank, duplicate and truncated (rows by their first fault), illegal
    (neighbouring roles), cost, audit (D, I, K and R: the edits) and repaired_sha256 (of the
    lines ``role:text`` that the edits leave).

    Rows are taken by turn, nulls first; rows of one turn by role and then by a hash of role
    and text. Null roles and texts stand for one space; a null conversation is one of its own.
    A role is known by its first letter; one that begins with none of s, u and a, or is empty,
    can't be kept. Rows where ``present_col`` is false or null count for nothing but name
    their conversation. Repeated rows are duplicates but for the first. An empty table gives
    none; other columns are not read. A conversation of any length is worked on in stretches;
    only its digest, and its audit, which is one value, are put together in one task, which
    holds a piece of the text of PIECE bytes at a time.
    """
    return _repaired(rows, conv_col, turn_col, role_col, text_col, present_col, as_turns=False)


def repaired_turns(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text", present_col: str | None = None) -> DataFrame:
    """A row for each edit: ``conv_col``, part and place (their order within the conversation),
    edit (D, I, K, R), role and text (nulls where deleted). Odd rows as in ``repair``."""
    return _repaired(rows, conv_col, turn_col, role_col, text_col, present_col, as_turns=True)


def _repaired(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str,
              present_col: str | None, as_turns: bool) -> DataFrame:
    kind = rows.schema[conv_col].dataType
    result = TURN if as_turns else RESULT
    fields = {f.name: f for f in T.StructType.fromDDL(f"{ROW}, {result}").fields}  # names of both once
    schema = T.StructType([T.StructField("conv", kind), *T.StructType.fromDDL("done boolean, part int, pos long").fields,
                           *fields.values()])
    names = [f.name for f in schema.fields]
    first = written(_dealt(rows, conv_col, turn_col, role_col, text_col, present_col)
                    .mapInArrow(_first_pass(as_turns, names), schema), "turns")
    wanted = [f.name for f in T.StructType.fromDDL(result).fields]
    done = first.filter("done").select("conv", *(["part"] if as_turns else []), *wanted)
    rest = _unsettled(first.filter("not done"), kind, as_turns)
    return done.unionByName(rest).withColumnRenamed("conv", conv_col)


def _unsettled(rows: DataFrame, kind: T.DataType, as_turns: bool) -> DataFrame:
    """Conversations that may lie in several ranges, stretch by stretch."""
    spark = rows.sparkSession
    conv = T.StructField("conv", kind)
    # the first of the rows with the same role and text, in the order of ranges and rows
    seen = (rows.filter(F.col("present") & (F.col("fault") != BLANK))
            .groupBy("conv", F.sha2(F.concat_ws("\0", "role", "text"), 256).alias("digest"))
            .agg(F.min(F.struct("part", "pos")).alias("at")).select("at.part", "at.pos", F.lit(True).alias("new")))
    rows = rows.join(seen, ["part", "pos"], "left").withColumn(
        "fault", F.when((F.col("fault") != BLANK) & F.col("new").isNull(), DUPLICATE)
        .otherwise(F.col("fault")).cast("byte")).select("conv", "part", "pos", *[x.split()[0] for x in ROW.split(", ")])
    rows = written(rows, "stretches")

    def kept(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        return table.filter(table.column("present")).combine_chunks()

    def summary(table: pa.Table) -> pa.Table:
        name = table.select(["conv", "part"]).slice(0, 1)
        table = kept(table)
        n = table.num_rows
        role, fault = (table.column(x).to_numpy().astype(np.int64) for x in ("kind", "fault"))
        turn = table.column("turn").combine_chunks() if n else pa.array([], pa.int64())
        counts = _counts(role, fault, turn, np.array([0, n]))
        block = np.arange(0, n, BLOCK)
        matrix = np.where(np.eye(4, dtype=bool), 0, NO_PATH)
        for m in matrices(role, fault, block, np.minimum(BLOCK, n - block))[::-1] if n else ():
            matrix = np.stack([through(m, matrix[:, i]) for i in range(4)], axis=1)
        values = {**{k: int(v[0]) for k, v in counts.items()}, "head": int(role[0]) if n else -1,
                  "tail": int(role[-1]) if n else -1}
        for k, v in values.items():
            name = name.append_column(k, pa.array([v], pa.int64()))
        return name.append_column("matrix", pa.array([matrix.reshape(-1).tolist()], pa.list_(pa.int64())))

    numbers = ["rows", "blank", "duplicate", "truncated", "illegal", "low", "high", "turns", "dated", "head", "tail"]
    summaries = T.StructType([conv, *T.StructType.fromDDL(
        "part int, " + ", ".join(f"{x} long" for x in numbers) + ", matrix array<long>").fields])
    slim = rows.drop("text")
    # fixed size, at most two for each range
    stretches = slim.drop("role").groupBy("conv", "part").applyInArrow(summary, summaries).collect()
    chains: dict[object, list] = {}
    for s in sorted(stretches, key=lambda s: s.part):
        chains.setdefault(s.conv, []).append(s)
    tails: dict[tuple, tuple[list[int], bool]] = {}
    totals = []
    for name, chain in chains.items():
        after = _before(np.array([3]), np.array([END]), np.zeros((1, 4), np.int64))[0]
        for s in reversed(chain):
            last = s is chain[-1]
            tails[name, s.part] = ([0] * 4 if last else after.tolist(), last)
            after = through(np.array(s.matrix).reshape(4, 4), after)
        totals.append((name, *_joined(chain), int(after[0])))

    behind = spark.sparkContext.broadcast(tails)

    def planned(table: pa.Table) -> tuple[Paths, np.ndarray, pa.Table]:
        name, part = table.column("conv")[0].as_py(), table.column("part")[0].as_py()
        table = kept(table)
        role, fault = (table.column(x).to_numpy().astype(np.int64) for x in ("kind", "fault"))
        tail, last = behind.value[name, part]
        bounds, source = np.array([0, len(role)]), np.arange(len(role))
        if last:
            role, fault, bounds, source = _with_ends(bounds[1:], fault, role)
        return Paths(role, fault, bounds, np.array([tail])), source, table

    def exits(table: pa.Table) -> pa.Table:
        name = table.select(["conv", "part"]).slice(0, 1)
        paths, _, _ = planned(table)
        left = [int(paths.leaves(paths.roots(np.array([s])))[0]) for s in range(4)]
        return name.append_column("exits", pa.array([left], pa.list_(pa.int64())))

    where = T.StructType([conv, *T.StructType.fromDDL("part int, exits array<long>").fields])
    leaving = {(r.conv, r.part): r.exits for r in slim.drop("role").groupBy("conv", "part").applyInArrow(exits, where).collect()}
    entries = {}
    for name, chain in chains.items():
        state = 0
        for s in chain:
            entries[name, s.part] = state
            state = leaving[name, s.part][state]
    entered = spark.sparkContext.broadcast(entries)

    def pieces(table: pa.Table) -> pa.Table:
        name = table.select(["conv", "part"]).slice(0, 1)
        paths, source, table = planned(table)
        entry = entered.value[name.column("conv")[0].as_py(), name.column("part")[0].as_py()]
        path, letter, row, state = paths.walk(paths.roots(np.array([entry])))
        edits = _lines((path, letter, source[row] if len(row) else row, state),
                       table.column("role").to_pylist(), table.column("text").to_pylist())
        found = [(e, r, t) for _, e, r, t in edits]
        if as_turns:
            columns = {"place": pa.array(range(len(found)), pa.int64()),
                       **{k: pa.array([f[i] for f in found], pa.string()) for i, k in enumerate(("edit", "role", "text"))}}
        else:
            texts, audits, size = [[]], [[]], 0
            for e, r, t in found:
                audits[-1].append(e)
                if r is not None:
                    texts[-1].append(f"{r}:{t}")
                    size += len(texts[-1][-1])
                    if size > PIECE:
                        texts.append([])
                        audits.append([])
                        size = 0
            columns = {"piece": pa.array(range(len(texts)), pa.int64()),
                       "audit": pa.array(["".join(x) for x in audits], pa.string()),
                       "lines": pa.array([len(x) for x in texts], pa.int64()),
                       "text": pa.array(["\n".join(x) for x in texts], pa.string())}
        n = len(next(iter(columns.values())))
        out = name.take(pa.array([0] * n, pa.int64()))
        for k, v in columns.items():
            out = out.append_column(k, v)
        return out

    grouped = rows.groupBy("conv", "part")
    if as_turns:
        return grouped.applyInArrow(pieces, T.StructType([conv, *T.StructType.fromDDL("part int, " + TURN).fields])) \
            .select("conv", "part", *[f.name for f in T.StructType.fromDDL(TURN).fields])
    cut = grouped.applyInArrow(pieces, T.StructType([conv, *T.StructType.fromDDL(
        "part int, piece long, audit string, lines long, text string").fields]))
    digests = (cut.repartition("conv").sortWithinPartitions("conv", "part", "piece")
               .mapInArrow(_digested, T.StructType([conv, *T.StructType.fromDDL("audit string, repaired_sha256 string").fields])))
    fields = T.StructType([T.StructField("name", kind), *T.StructType.fromDDL(
        "gaps long, blank long, duplicate long, truncated long, illegal long, cost long").fields])
    counted = spark.createDataFrame(totals, fields)
    return (digests.join(counted, F.col("conv").eqNullSafe(F.col("name")))
            .select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))


def _joined(chain: list) -> tuple[int, int, int, int, int]:
    """gaps, blank, duplicate, truncated and illegal of a conversation from its stretches."""
    illegal, tail = sum(s.illegal for s in chain), -1
    low = high = None
    turns = 0
    for s in chain:
        if s.rows:
            if tail >= 0 and not legal(np.array([tail]), np.array([s.head]))[0]:
                illegal += 1
            tail = s.tail
        if s.dated:
            turns += s.turns - (s.low == high)
            low, high = (s.low if low is None else low), s.high
    return (0 if low is None else high - low + 1 - turns, sum(s.blank for s in chain),
            sum(s.duplicate for s in chain), sum(s.truncated for s in chain), illegal)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order -> audit and digest of each conversation, read as a stream."""
    known, name, audit, digest, lines = False, None, [], hashlib.sha256(), 0

    def result() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([name, pa.array(["".join(audit)]), pa.array([digest.hexdigest()])],
                                          names=["conv", "audit", "repaired_sha256"])

    for batch in batches:
        columns = batch.to_pydict()
        for i in range(batch.num_rows):
            own = batch.column("conv").slice(i, 1)
            if not known or not own.equals(name):
                if known:
                    yield result()
                known, name, audit, digest, lines = True, own, [], hashlib.sha256(), 0
            audit.append(columns["audit"][i])
            if columns["lines"][i]:
                digest.update(("\n" if lines else "").encode() + columns["text"][i].encode())
                lines += columns["lines"][i]
    if known:
        yield result()
