"""Conversation structure repair by a survivor-coalescence Viterbi.

A repaired conversation's role initials read ``(s?(ua)+)?``: at most one system turn at the head, then user and assistant
in turn. Rows are kept, given another role, or deleted, and empty turns are inserted, at the least total cost; of equally
cheap edit sequences the one whose initials (K, R, D, I) are least in ASCII wins.

Four states (nothing, system, user or assistant written last) have one survivor each, a node of a backpointer tree whose
nodes count the references of children and survivors. Nodes without references are freed; once all survivors descend from
one child of the root, that child's edits are settled, handed on and forgotten. So a conversation streams through its
task, sorted by Spark, with the unsettled rows in memory alone (a few; a run of rows of which only the end tells
whether the first is deleted stays whole). Survivors of equal cost are compared by their complete
unsettled edits: that order is carried along as ranks of the survivors, since two sequences of the same rows that end in
a row's edit cannot be the beginning of one another.

A survivor that can no longer win is dropped, so that settling is not held up: the state "nothing" when it costs over 3
more than "assistant" (which allows all its continuations, but for keeping a system row instead of deleting it), the
state "system" when it costs more than "assistant".
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # the state after a written user or assistant turn
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")
RELABEL, DELETE, INSERT, UNFINISHED = 2, 3, 2, 1  # costs

EDITS = "conv_id long, step long, edit string, turn long, role string, text string"
SUMMARY = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")


# --- faults, in Spark ----------------------------------------------------------


def filled_rows(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with one space for a null role or text."""
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))


def with_faults(rows: DataFrame) -> DataFrame:
    """Add ``fault``: the first of blank, duplicate (role and text seen earlier in the conversation), truncated; null: none."""
    trimmed = F.rtrim("text", F.lit(SPACES))
    earlier = F.row_number().over(W.partitionBy("conv_id", "role", "text").orderBy(F.asc_nulls_first("turn"))) > 1
    fault = F.when(trimmed == "", BLANK).when(F.col("__earlier"), DUPLICATE).when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), TRUNCATED)
    return rows.withColumn("__earlier", earlier).withColumn("fault", fault).drop("__earlier")


def in_order(rows: DataFrame) -> DataFrame:
    """Conversations together, rows by turn, nulls first; rows of one turn by role and text."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")


# --- edits of one conversation, as a stream ------------------------------------


class Node:
    """The edits of one row (insertions before it, then its own) behind a survivor's earlier edits."""

    __slots__ = ("edits", "row", "parent", "children", "held")

    def __init__(self, edits: str, row, parent: Node | None):
        self.edits, self.row, self.parent, self.children, self.held = edits, row, parent, [], 0


class Repair:
    """Takes the rows of one conversation in order and hands each edit to ``sink(letter, turn, role, text)`` once settled."""

    def __init__(self, sink: Callable):
        self.sink, self.root, self.written, self.unsettled = sink, Node("", None, None), NOTHING, 0
        self.root.held = 1
        # by state: cost, rank of the edits so far, node; None: cannot be
        self.survivors: list[tuple[int, int, Node] | None] = [(0, 0, self.root), None, None, None]

    def reachable(self) -> list[tuple[int, int, str, Node] | None]:
        """Survivors by state, insertions allowed: cost, rank, insertions, node."""
        out = [s and (s[0], s[1], "", s[2]) for s in self.survivors]
        for _ in range(2):  # two insertions reach every state that insertions can reach
            for state, s in enumerate(list(out)):
                if s:
                    better(out, NEXT[state], (s[0] + INSERT, s[1], s[2] + "I", s[3]))
        return out

    def add(self, initial: str, fault: str | None, row: tuple) -> None:
        """``row`` is turn, role and text; ``initial`` the first character of the role."""
        best: list[tuple[int, int, str, Node] | None] = [None] * 4
        extra = UNFINISHED if fault == TRUNCATED else 0
        for state, s in enumerate(self.reachable()):
            if not s:
                continue
            cost, rank, edits, node = s
            better(best, state, (cost + DELETE, rank, edits + "D", node))
            if fault == BLANK or fault == DUPLICATE:
                continue
            after = NEXT[state]
            if initial == "s" and state == NOTHING:
                better(best, SYSTEM, (cost + extra, rank, edits + "K", node))
            if initial == ROLE[after][0]:
                better(best, after, (cost + extra, rank, edits + "K", node))
            else:
                better(best, after, (cost + extra + RELABEL, rank, edits + "R", node))
        if best[ASSISTANT]:
            least = best[ASSISTANT][0]
            if best[NOTHING] and best[NOTHING][0] > least + DELETE:
                best[NOTHING] = None
            if best[SYSTEM] and best[SYSTEM][0] > least:
                best[SYSTEM] = None
        order = {s[1:3]: i for i, s in enumerate(sorted((s for s in best if s), key=lambda s: s[1:3]))}
        old = [s[2] for s in self.survivors if s]
        self.survivors = [s and (s[0], order[s[1:3]], self.grow(s[2], row, s[3])) for s in best]
        for node in old:
            node.held -= 1
            self.free(node)
        self.settle()

    def grow(self, edits: str, row: tuple, parent: Node) -> Node:
        node = Node(edits, row, parent)
        node.held = 1
        parent.children.append(node)
        self.unsettled += 1
        return node

    def free(self, node: Node) -> None:
        """Drop a node that nothing refers to, and so on towards the root."""
        while not node.held and not node.children and node.parent is not None:
            node.parent.children.remove(node)
            node = node.parent
            self.unsettled -= 1

    def settle(self) -> None:
        while not self.root.held and len(self.root.children) == 1:
            self.root = self.root.children[0]
            self.root.parent = None
            self.unsettled -= 1
            self.hand_on(self.root)

    def hand_on(self, node: Node) -> None:
        for letter in node.edits:
            turn, role, text = (None, None, "") if letter == "I" else node.row
            if letter in "IR":
                role = ROLE[NEXT[self.written]]
            if letter == "K":
                self.written = SYSTEM if role.startswith("s") else NEXT[self.written]
            elif letter != "D":
                self.written = NEXT[self.written]
            self.sink(letter, turn, role, text)

    def finish(self) -> int:
        """Settle the rest; the total cost."""
        ends = self.reachable()
        cost, _, edits, node = min((s for s in (ends[NOTHING], ends[ASSISTANT]) if s), key=lambda s: s[:3])
        path = []
        while node is not self.root:
            path.append(node)
            node = node.parent
        for node in reversed(path):
            self.hand_on(node)
        self.hand_on(Node(edits, None, None))
        return cost


def better(best: list, state: int, new: tuple) -> None:
    """Keep the cheaper survivor of a state, of equal ones that with the lesser edits."""
    if best[state] is None or new[:3] < best[state][:3]:
        best[state] = new


def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows in order, one at a time, and where a conversation ends: ``(conv_id, row or None)``."""
    now, begun = None, False
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault"))):
            if begun and row[0] != now:
                yield now, None
            now, begun = row[0], True
            yield now, row[1:]
    if begun:
        yield now, None


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def edit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, out, size, repair = arrow_schema(EDITS), [], 0, None
    for conv_id, row in conversations(batches):
        if repair is None:
            steps = iter(range(2 ** 62))
            repair = Repair(lambda letter, turn, role, text, c=conv_id, n=steps: out.append((c, next(n), letter, turn, role, text)))
        if row is None:
            repair.finish()
            repair = None
        else:
            repair.add(row[1][:1], row[3], row[:3])
            size += len(row[2]) + 64
        if size > 1 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema) if out else pa.RecordBatch.from_pylist([], schema)
            out.clear()
            size = 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


class Summary:
    """Counts of one conversation's faults, and the digests of its edits and its repaired rows."""

    def __init__(self):
        self.turns, self.first, self.last, self.before, self.illegal = 0, None, None, None, 0
        self.faults = {BLANK: 0, DUPLICATE: 0, TRUNCATED: 0}
        self.audit, self.digest, self.lines = bytearray(), hashlib.sha256(), 0
        self.repair = Repair(self.edit)

    def edit(self, letter: str, turn: int | None, role: str, text: str) -> None:
        self.audit += letter.encode()
        if letter != "D":
            self.digest.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
            self.lines += 1

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        initial = role[:1]
        if turn is not None and turn != self.last:  # turns come in order
            self.first, self.last, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        if fault:
            self.faults[fault] += 1
        self.illegal += self.before is not None and self.before + initial not in LEGAL
        self.before = initial
        self.repair.add(initial, fault, (turn, role, text))

    def finish(self, conv_id: int | None) -> tuple:
        cost = self.repair.finish()
        gaps = 0 if self.first is None else min(self.last - self.first + 1 - self.turns, 2 ** 63 - 1)
        return conv_id, gaps, *self.faults.values(), self.illegal, cost, self.audit.decode(), self.digest.hexdigest()


def summary_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, out, size, summary = arrow_schema(SUMMARY), [], 0, None
    for conv_id, row in conversations(batches):
        summary = summary or Summary()
        if row is not None:
            summary.add(*row)
            continue
        out.append(summary.finish(conv_id))
        size += len(out[-1][7]) + 128
        summary = None
        if size > 1 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


# --- operators -----------------------------------------------------------------


def repair_conversations(rows: DataFrame) -> DataFrame:
    """The edits of every conversation in order: ``conv_id, step, edit, turn, role, text``.

    K, R and D rows carry the turn and text of the row they keep, relabel or delete, and the role after the edit (before
    it, for D); I rows are inserted turns without a turn number. The rows whose edit is not D are the repaired
    conversation. A null role or text counts as one space; a null ``conv_id`` is a conversation of its own; null turns come
    first; rows of one turn stand by role and text, repeated ones are duplicates. Other columns are not read. An empty
    table has no edits.
    """
    return in_order(with_faults(filled_rows(rows))).mapInArrow(edit_rows, EDITS)


def audit_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation: counts of faults, gaps and illegal neighbours, the cost, the edits' initials as ``audit``
    and the SHA-256 of the repaired ``role:text`` lines; rows are read as in ``repair_conversations``."""
    return in_order(with_faults(filled_rows(rows))).mapInArrow(summary_rows, SUMMARY)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with planted faults, chosen by ``crc32(conv_id:turn) % 20`` (nulls: one space): 0 drops the row, 1 empties its
    text, 2 removes its full stops, exclamation and question marks, 3 repeats it, 4 makes it a user's."""
    shown: Callable[[str], Column] = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    lot = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    marked = filled_rows(rows).withColumn("__lot", lot).where("__lot <> 0")
    text = F.when(F.col("__lot") == 1, "").when(F.col("__lot") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("__lot") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("__lot") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return marked.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("__copy")).drop("__copy")
