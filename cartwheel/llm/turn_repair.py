"""Conversation structure repair by survivor-coalescence Viterbi (operator 13).

A conversation is read in turn order and its turns are kept, given another role,
deleted, or joined by inserted turns, so that the initials of the roles give
``(s?(ua)+)?`` at the least cost. Between turns the reader is in one of four
states (start, after system, after user, after assistant); one survivor per state
holds the cheapest edits so far. The survivors' edits form a backpointer tree
whose nodes count their children: a node no survivor needs any more goes, and as
soon as all survivors share an ancestor the edits up to it are emitted and
forgotten. A survivor dearer than another by more than any rest can win back is
dropped, else one that deletes everything would hold all back for good. Only the unresolved edits and the texts that they concern are held.

Ties go to the ASCII-least string of edit initials. Two tied survivors are
compared on their complete unresolved edits: for each pair the two strings are
kept without what they have in common, which is one decided letter each, or
nothing against a few inserts, so that a comparison never walks the tree.

Turns are hashed to tasks by conversation and sorted there by Spark, which spills;
a task streams through them and never holds a conversation. A digest of a whole
conversation is sequential, so that one conversation is one task's stream.

Defined results: turns are taken by turn number, nulls first, then role, then text
(so repeated rows stand side by side); null roles and texts count as one space; a
null conversation id is a conversation of its own; an empty role has no initial and
fits nowhere; a turn that is not ``present`` only makes its conversation known, and
a conversation without other turns gives one row with a null edit; an empty table
gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import deque

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import WORD

#: Costs of the edits, and of a truncated turn that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Faults in the order in which they count.
NONE, BLANK, REPEATED, CUT = 0, 1, 2, 3
START, SYSTEM, USER, ASSISTANT = range(4)
#: state -> {role initial: next state}; the role that a changed or new turn gets there
MOVES = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
GIVEN = ("user", "user", "assistant", "user")
ENDS = (START, ASSISTANT)
#: state -> what up to two inserts before a turn lead to; more only run in a circle
INSERTS = tuple(((0, "", s), (INSERT, "I", USER if s != USER else ASSISTANT))
                + (((2 * INSERT, "II", ASSISTANT),) if s in (START, SYSTEM) else ()) for s in range(4))
#: [q][p]: what the rest may cost more after state q than after state p, whatever comes: inserts lead
#: from q to p, a kept system turn is deleted instead, or the rest can be taken as it is
BEHIND = ((0, 0, INSERT, 0), (2 * INSERT, 0, INSERT, 2 * INSERT), (INSERT + DELETE, INSERT, 0, INSERT), (DELETE, 0, INSERT, 0))
OUT = "position long, edit string, turn long, role_before string, fault int, role string, text string"


def _options(initial: str, fault: int) -> list[list[tuple[int, str, int]]]:
    """state -> (cost, edits, next state) of all ways over one turn, inserts before it included."""
    out = []
    for state in range(4):
        ways = []
        for paid, before, at in INSERTS[state]:
            ways.append((paid + DELETE, before + "D", at))
            if fault in (BLANK, REPEATED):
                continue
            more = TRUNCATED if fault == CUT else 0
            if initial in MOVES[at]:
                ways.append((paid + KEEP + more, before + "K", MOVES[at][initial]))
            if initial != GIVEN[at][0]:
                ways.append((paid + REROLE + more, before + "R", MOVES[at][GIVEN[at][0]]))
        out.append(ways)
    return out


def _apart(a: str, b: str) -> tuple[str, str]:
    """Both strings without their common beginning; one letter each once they differ."""
    k = 0
    while k < len(a) and k < len(b) and a[k] == b[k]:
        k += 1
    a, b = a[k:], b[k:]
    return (a[0], b[0]) if a and b else (a, b)


class _Node:
    """Edits of one turn in the backpointer tree; ``children`` is its reference count."""

    __slots__ = ("parent", "edits", "children")

    def __init__(self, parent, edits):
        self.parent, self.edits, self.children = parent, edits, set()


class Repairer:
    """Repairs the turns of one conversation as they come; ``push`` and ``finish`` yield resolved edits."""

    _CACHE: dict = {}

    def __init__(self):
        self.root = _Node(None, "")
        self.heads = {START: (0, self.root)}
        self.order: dict = {}  # (state, state) -> the two survivors' edits, apart
        self.pending: deque = deque()
        self.state = START  # after what is emitted

    def _pair(self, i: int, e: str, j: int, f: str) -> tuple[str, str]:
        u, v = self.order[i, j] if i != j else ("", "")
        return (u, v) if u and v else _apart(u + e, v + f)

    def _best(self, ways: dict) -> dict:
        """next state -> (cost, survivor, edits): the cheapest, ties by the edits from the start."""
        best: dict = {}
        for i, (paid, _) in self.heads.items():
            for cost, e, to in ways[i]:
                cost += paid
                old = best.get(to)
                if old is None or cost < old[0]:
                    best[to] = (cost, i, e)
                elif cost == old[0]:
                    u, v = self._pair(i, e, old[1], old[2])
                    if u < v:
                        best[to] = (cost, i, e)
        return best

    def push(self, turn, role: str, text: str, fault: int):
        self.pending.append((turn, role, text, fault))
        key = (role[:1] if role[:1] in "sua" else "", fault)
        if key not in self._CACHE:
            self._CACHE[key] = _options(*key)
        best = self._best(self._CACHE[key])
        # a survivor that another one beats whatever comes must not hold the rest back
        best = {p: b for p, b in best.items() if all(c + BEHIND[q][p] >= b[0] for q, (c, _, _) in best.items())}
        order = {}
        for a, (_, i, e) in best.items():
            for b, (_, j, f) in best.items():
                if a != b:
                    order[a, b] = self._pair(i, e, j, f)
        old, heads = self.heads, {}
        for to, (cost, i, e) in best.items():
            node = _Node(old[i][1], e)
            node.parent.children.add(node)
            heads[to] = (cost, node)
        self.heads, self.order = heads, order
        for _, node in old.values():  # branches that no survivor needs
            while not node.children and node.parent is not None:
                node.parent.children.discard(node)
                node = node.parent
        while len(self.root.children) == 1:  # all survivors share this ancestor
            (child,) = self.root.children
            child.parent = None
            self.root = child
            yield from self._resolved(child.edits)

    def finish(self):
        """(the rest of the edits); the conversation's cost is the sum over its edits."""
        ends = {}
        for i, (paid, _) in self.heads.items():
            for cost, e, to in INSERTS[i]:
                if to in ENDS:
                    ends.setdefault(i, []).append((cost, e, -1))
        best = self._best({i: ends.get(i, []) for i in self.heads})[-1]
        steps, node = [best[2]], self.heads[best[1]][1]
        while node is not self.root:
            steps.append(node.edits)
            node = node.parent
        for edits in reversed(steps):
            yield from self._resolved(edits)

    def _resolved(self, edits: str):
        for c in edits:
            given = GIVEN[self.state]
            if c == "I":
                row = (c, None, None, NONE, given, "")
            else:
                turn, role, text, fault = self.pending.popleft()
                row = (c, turn, role, fault, None, None) if c == "D" else (c, turn, role, fault, role if c == "K" else given, text)
            if c != "D":
                self.state = MOVES[self.state][row[4][:1]]
            yield row


def _flags(turns: DataFrame, order: list[Column]) -> DataFrame:
    """The first fault of each present turn."""
    key = ["conv_id", "present", "role", "text"]
    seen = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    last = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    fault = F.when(~F.col("text").rlike(WORD), BLANK).when(F.col("seen") > 1, REPEATED) \
        .when(~last.isin(".", "!", "?"), CUT).otherwise(NONE)
    return turns.withColumn("seen", seen).withColumn("fault", fault).drop("seen")


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", present: Column | None = None) -> DataFrame:
    """conv_id and ``OUT``: all edits of each conversation, in order within their task.

    ``edit`` is K, R, D or I; ``role`` and ``text`` are the repaired turn's, null
    where it is deleted; ``role_before`` and ``turn`` are null where it is inserted.
    """
    own = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                       F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
                       F.coalesce(F.lit(True) if present is None else present, F.lit(False)).alias("present"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    # dealt once, by conversation: the window over repeats and the final sort reuse it
    dealt = _flags(own.repartition("conv_id"), order[:1])
    ordered = dealt.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *order)
    kind = own.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", *(x.split()[0] for x in OUT.split(", "))]

    def run(batches):
        now, work, n, some = None, None, 0, False
        rows: list[tuple] = []
        held = 0

        def batch():
            nonlocal rows, held
            cols = list(zip(*rows))
            rows, held = [], 0
            return pa.RecordBatch.from_arrays([pa.array(cols[k], t) for k, t in enumerate(types)], names)

        def emit(edits):
            nonlocal n, held
            for e in edits:
                rows.append((now, n, *e))
                n += 1
                held += len(e[-1] or "") + 64

        def close():
            if some:
                emit(work.finish())
            else:
                rows.append((now, 0, None, None, None, NONE, None, None))

        types = None
        for b in batches:
            if types is None:
                types = [b.schema.field("conv_id").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.string()]
            for conv, turn, role, text, here, fault in zip(*(b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "present", "fault"))):
                if work is None or conv != now:
                    if work is not None:
                        close()
                    now, work, n, some = conv, Repairer(), 0, False
                if here:
                    some = True
                    emit(work.push(turn, role, text, fault))
                if held > 4 << 20:
                    yield batch()
        if work is not None:
            close()
            yield batch()

    return ordered.select("conv_id", "turn", "role", "text", "present", "fault").mapInArrow(run, f"conv_id {kind}, {OUT}")


def digests(edits: DataFrame) -> DataFrame:
    """The contract's columns, from the edits in the order in which ``repair`` gives them."""
    kind = edits.schema["conv_id"].dataType.simpleString()
    schema = (f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
              "audit string, repaired_sha256 string")
    paid = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}

    def run(batches):
        names = [x.split()[0] for x in schema.split(", ")]
        now, s, done, types = None, None, [], None

        def close():
            gaps = s["hi"] - s["lo"] + 1 - s["distinct"] if s["distinct"] else 0
            done.append((now, gaps, s[BLANK], s[REPEATED], s[CUT], s["illegal"], s["cost"], "".join(s["audit"]), s["sha"].hexdigest()))

        def batch():
            cols = list(zip(*done))
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(cols[k], t) for k, t in enumerate(types)], names)

        for b in batches:
            types = types or [b.schema.field("conv_id").type, *[pa.int64()] * 6, pa.string(), pa.string()]
            for conv, edit, turn, before, fault, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "edit", "turn", "role_before", "fault", "role", "text"))):
                if s is None or conv != now:
                    if s is not None:
                        close()
                    now = conv
                    s = {BLANK: 0, REPEATED: 0, CUT: 0, NONE: 0, "illegal": 0, "cost": 0, "audit": [], "sha": hashlib.sha256(),
                         "first": True, "before": None, "lo": None, "hi": None, "distinct": 0}
                if edit is None:
                    continue
                s["audit"].append(edit)
                s["cost"] += paid[edit] + (TRUNCATED if fault == CUT and edit != "D" else 0)
                s[fault] += 1
                if edit != "I":
                    if turn is not None:
                        s["distinct"] += turn != s["hi"]
                        s["lo"], s["hi"] = turn if s["lo"] is None else s["lo"], turn
                    if s["before"] is not None:
                        s["illegal"] += s["before"] + before[:1] not in ("su", "ua", "au")
                    s["before"] = before[:1]
                if edit != "D":
                    s["sha"].update(((not s["first"]) * "\n" + role + ":" + text).encode())
                    s["first"] = False
            if len(done) >= 2000:
                yield batch()
        if s is not None:
            close()
        if done:
            yield batch()

    return edits.mapInArrow(run, schema)


def damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Turns with repeatable damage, chosen by crc32 of ``conv_id:turn``; ``present`` is false for dropped ones."""
    space = F.lit(" ")
    conv, turn = F.col(conv_col), F.col(turn_col)
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in (role_col, text_col))
    key = F.concat(F.coalesce(conv.cast("string"), space), F.lit(":"), F.coalesce(turn.cast("string"), space))
    marked = turns.select(conv.alias("conv_id"), turn.cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                          (F.crc32(key.cast("binary")) % 20).alias("kind"))
    k = F.col("kind")
    return marked.select(
        "conv_id", "turn", F.when(k == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(k == 1, "").when(k == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (k != 0).alias("present"), F.explode(F.when(k == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")
