"""Repair the structure of conversations with the fewest edits, by Viterbi with survivor coalescence.

A conversation is right if its roles are, by their first letters, ``(s?(ua)+)?``. Four states say where in it a prefix ends. Rows pass one
by one; for each state the cheapest edits that reach it survive, of equally cheap ones those whose letters come first in ASCII. A state that costs more
than any detour from another one has no survivor. Survivors are leaves of a tree of backpointers with reference counts: a branch without survivors goes, and as soon as all
survivors share an ancestor, the edits up to it are final and leave. So what is held is what is still open. Ties are decided on
the whole open suffixes from the common ancestor on; two equally cheap ways through the same rows are never the beginning of each other,
since one would then have more inserts, so the choice holds for all that follows.

Rows are found blank, repeated or cut off by DataFrame operations before that; a row's repeats are searched by an aggregate over (role, text), not
by holding a conversation's texts. The Viterbi pass reads no texts. Its edits then meet the texts again in one sorted stream.

Defined results: null roles and texts are one space. Rows of a conversation are ordered by turn (null first), then role and a hash of the text. A
null conv_id is one conversation. Texts may be of any length, and a conversation may have any number of rows: a task streams it, and holds
open edits and one text. (One hash over all its repaired rows can't be taken in parallel.) An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import deque
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.workspace import Workspace

#: The white space that doesn't count as text.
SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
COST = {"K": 0, "R": 2, "D": 3, "I": 2}
CUT_OFF_COST = 1
#: States of a prefix: nothing yet, after the system row, after a user row, after an assistant row; first and last may end.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {NOTHING: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
#: The role that a new or changed row takes in a state; only one keeps the order.
GIVEN = {NOTHING: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
#: What following any way on from one state costs more at most if it starts in another: (another, one). After an assistant row only a
#: system row can't be kept; a new row turns a user row's state and an assistant row's into each other.
DETOUR = {(ASSISTANT, NOTHING): COST["D"], (ASSISTANT, SYSTEM): 0, (ASSISTANT, USER): COST["I"], (USER, ASSISTANT): COST["I"],
          (USER, SYSTEM): COST["I"], (USER, NOTHING): COST["I"] + COST["D"], (NOTHING, SYSTEM): 0, (NOTHING, ASSISTANT): 0,
          (NOTHING, USER): COST["I"], (SYSTEM, USER): COST["I"]}
ROLES = {"u": b"user", "a": b"assistant"}
LEGAL = {"su", "ua", "au"}
FINE, BLANK, DUPLICATE, CUT_OFF = range(4)


class _Node:
    """A stretch of edits; references to it are its branches, or one survivor if there are none."""

    __slots__ = ("above", "edits", "branches")

    def __init__(self, above: _Node | None, edits: str = ""):
        self.above, self.edits, self.branches = above, [edits] if edits else [], set()


def _line(node: _Node) -> list[_Node]:
    line = [node]
    while line[-1].above is not None:
        line.append(line[-1].above)
    return line[::-1]


class Survivors:
    """Viterbi over one conversation. ``push`` takes rows in order; final edits go to ``emit``, as letters, in order."""

    def __init__(self, emit):
        self.emit = emit
        self.root = _Node(None)
        self.best: dict[int, tuple[int, _Node]] = {NOTHING: (0, self.root)}

    @staticmethod
    def _before(a: tuple[int, _Node, str], b: tuple[int, _Node, str]) -> bool:
        """Whether way ``a`` is cheaper, or as cheap and its letters come first."""
        if a[0] != b[0]:
            return a[0] < b[0]
        if a[1] is b[1]:
            return a[2] < b[2]
        mine, other = _line(a[1]), _line(b[1])
        shared = 0
        while shared < min(len(mine), len(other)) and mine[shared] is other[shared]:
            shared += 1
        letters = [chain.from_iterable(chain(chain.from_iterable(n.edits for n in line[shared:]), [last]))
                   for line, last in ((mine, a[2]), (other, b[2]))]
        return next((x < y for x, y in zip(*letters) if x != y), False)

    def _offer(self, ways: dict, state: int, way: tuple[int, _Node, str]) -> bool:
        if state not in ways or self._before(way, ways[state]):
            ways[state] = way
            return True
        return False

    def _with_inserts(self) -> dict[int, tuple[int, _Node, str]]:
        ways = {s: (cost, node, "") for s, (cost, node) in self.best.items()}
        todo = deque(ways)
        while todo:
            s = todo.popleft()
            cost, node, edits = ways[s]
            to = NEXT[s][GIVEN[s]]
            if self._offer(ways, to, (cost + COST["I"], node, edits + "I")):
                todo.append(to)
        return ways

    def push(self, initial: str, fault: int) -> None:
        ways: dict[int, tuple[int, _Node, str]] = {}
        extra = CUT_OFF_COST if fault == CUT_OFF else 0
        for s, (cost, node, edits) in self._with_inserts().items():
            self._offer(ways, s, (cost + COST["D"], node, edits + "D"))
            if fault not in (BLANK, DUPLICATE):
                if initial in NEXT[s]:
                    self._offer(ways, NEXT[s][initial], (cost + COST["K"] + extra, node, edits + "K"))
                self._offer(ways, NEXT[s][GIVEN[s]], (cost + COST["R"] + extra, node, edits + "R"))
        # Without this, deleting all rows so far would survive to the end.
        lost = [s for (t, s), more in DETOUR.items() if t in ways and s in ways and ways[t][0] + more < ways[s][0]]
        self._grow({s: way for s, way in ways.items() if s not in lost})
        self._coalesce()

    def _grow(self, ways: dict[int, tuple[int, _Node, str]]) -> None:
        users: dict[_Node, int] = {}
        for _, node, _ in ways.values():
            users[node] = users.get(node, 0) + 1
        leaves = [node for _, node in self.best.values()]
        self.best = {}
        for s, (cost, node, edits) in ways.items():
            if users[node] == 1:
                node.edits.append(edits)
                self.best[s] = (cost, node)
            else:
                branch = _Node(node, edits)
                node.branches.add(branch)
                self.best[s] = (cost, branch)
        for node in leaves:
            if node not in users:
                self._release(node)

    def _release(self, node: _Node) -> None:
        above = node.above
        above.branches.discard(node)
        while not above.branches and above.above is not None:
            node, above = above, above.above
            above.branches.discard(node)
        if len(above.branches) == 1 and above.above is not None:  # one branch left: both are one stretch
            only = next(iter(above.branches))
            above.edits += only.edits
            only.edits, only.above = above.edits, above.above
            above.above.branches.discard(above)
            above.above.branches.add(only)

    def _coalesce(self) -> None:
        root = self.root
        while True:
            if root.edits:
                self.emit("".join(root.edits))
                root.edits = []
            if len(root.branches) != 1:
                break
            root = next(iter(root.branches))
            root.above = None
        self.root = root

    def finish(self) -> int:
        """The rest of the cheapest edits that end well; returns their whole cost."""
        ways = {s: w for s, w in self._with_inserts().items() if s in (NOTHING, ASSISTANT)}
        end: dict[int, tuple[int, _Node, str]] = {}
        for way in ways.values():
            self._offer(end, 0, way)
        cost, node, edits = end[0]
        self.emit("".join(chain.from_iterable(n.edits for n in _line(node))) + edits)
        return cost


# --- rows and their faults -------------------------------------------------------------------------------

def _rows(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    text_ = F.coalesce(F.col(text), F.lit(" "))
    return conversations.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).isNotNull().alias("has"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.unhex(F.sha2(text_, 256)).alias("digest"), text_.alias("text"))


ORDER = ["has", "turn", "role", "digest"]


def _flagged(rows: DataFrame) -> DataFrame:
    """Each row without its text, with its own faults and whether an earlier turn has its role and text."""
    trimmed = F.rtrim("text", F.lit(SPACE))
    # A space that is not trimmed away at the front may be all there is.
    own = (F.when(trimmed == "", BLANK).when(~F.right(trimmed, F.lit(1)).isin(*ENDS), CUT_OFF).otherwise(FINE))
    small = rows.select("conv_id", *ORDER, own.alias("own"))
    first = (small.where(F.col("own") != BLANK).groupBy("conv_id", "role", "digest").agg(F.min(F.struct("has", "turn")).alias("first"))
             .select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d"), "first"))
    later = ~(F.col("first.has").eqNullSafe(F.col("has")) & F.col("first.turn").eqNullSafe(F.col("turn")))
    return (small.join(first, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_d")),
                       "left")
            .select("conv_id", *ORDER, "own", F.coalesce((F.col("own") != BLANK) & later, F.lit(False)).alias("later")))


def _edit_type(id_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("conv_id", id_type), T.StructField("last", T.BooleanType()), T.StructField("has", T.BooleanType()),
        T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("digest", T.BinaryType()),
        T.StructField("copy", T.LongType()), T.StructField("before", T.StringType()), T.StructField("edit", T.StringType()),
        T.StructField("given", T.StringType()), T.StructField("fault", T.IntegerType())])


class _Edits:
    """Final letters of a conversation to a record per row: the roles inserted before it, its edit, the role given to it."""

    def __init__(self, conv_id):
        self.conv_id, self.open, self.state, self.before, self.done = conv_id, deque(), NOTHING, "", []

    def take(self, letters: str) -> None:
        for letter in letters:
            if letter == "D":
                given = None
            elif letter == "K":
                given = None
                self.state = NEXT[self.state][self.open[0][2][:1]]
            else:
                given = GIVEN[self.state]
                self.state = NEXT[self.state][given]
            if letter == "I":
                self.before += given
                continue
            has, turn, role, digest, copy, fault = self.open.popleft()
            self.done.append((self.conv_id, False, has, turn, role, digest, copy, self.before, letter, given, fault))
            self.before = ""


def _viterbi(schema: pa.Schema):
    def batches(stream):
        made: list[tuple] = []
        now = best = last = None
        fresh = True

        def flush():
            best.finish()
            made.extend(now.done)
            made.append((now.conv_id, True, True, None, "", b"", 0, now.before, None, None, None))

        for batch in stream:
            for conv_id, has, turn, role, digest, own, later in zip(*(c.to_pylist() for c in batch.columns)):
                if fresh or conv_id != now.conv_id:
                    if not fresh:
                        flush()
                    now, fresh, last = _Edits(conv_id), False, None
                    best = Survivors(now.take)
                key = (has, turn, role, digest)
                copy = last[1] + 1 if last and last[0] == key else 0
                last = (key, copy)
                fault = DUPLICATE if own != BLANK and (later or copy) else own
                now.open.append((*key, copy, fault))
                best.push(role[:1], fault)
                if now.done:
                    made.extend(now.done)
                    now.done = []
                if len(made) >= 10_000:
                    yield _batch(schema, made)
                    made = []
        if not fresh:
            flush()
        yield _batch(schema, made)

    return batches


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ((),) * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _repaired_type(id_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("conv_id", id_type), T.StructField("step", T.LongType()), T.StructField("edit", T.StringType()),
        T.StructField("role", T.BinaryType()), T.StructField("text", T.BinaryType()), T.StructField("turn", T.LongType()),
        T.StructField("initial", T.StringType()), T.StructField("fault", T.IntegerType())])


def _applied(schema: pa.Schema):
    """A row's text comes before its edits; inserted rows go before the row that they belong to."""
    def batches(stream):
        made: list[tuple] = []
        conv, step, text, fresh, size = None, 0, b"", True, 0
        for batch in stream:
            for conv_id, last, turn, role, copy, before, edit, given, fault, own_text in zip(*(c.to_pylist() for c in batch.columns)):
                if fresh or conv_id != conv:
                    conv, step, fresh = conv_id, 0, False
                if copy < 0:
                    text = own_text
                    continue
                for inserted in before:
                    made.append((conv_id, step, "I", ROLES[inserted], b"", None, None, None))
                    step += 1
                if not last:
                    made.append((conv_id, step, edit, ROLES[given] if given else role.encode(), text, turn, role[:1], fault))
                    step += 1
                    size += len(text)
                if len(made) >= 10_000 or size >= 1 << 24:
                    yield _batch(schema, made)
                    made, size = [], 0
        yield _batch(schema, made)

    return batches


def _stream(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> tuple[DataFrame, T.StructType]:
    from pyspark.sql.pandas.types import to_arrow_schema

    ws = Workspace(conversations.sparkSession, "conversations")
    rows = ws.store(_rows(conversations, conv_id, turn, role, text), "rows")
    id_type = rows.schema["conv_id"].dataType
    edits, repaired = _edit_type(id_type), _repaired_type(id_type)
    ordered = _flagged(rows).repartition("conv_id").sortWithinPartitions("conv_id", *ORDER)
    found = ws.store(ordered.mapInArrow(_viterbi(to_arrow_schema(edits)), edits), "edits")
    texts = rows.select("conv_id", F.lit(False).alias("last"), *ORDER, F.lit(-1).cast("long").alias("copy"), F.col("text").cast("binary").alias("text"))
    both = (found.unionByName(texts, allowMissingColumns=True).repartition("conv_id")
            .sortWithinPartitions("conv_id", "last", *ORDER, "copy"))
    applied = both.select("conv_id", "last", "turn", "role", "copy", "before", "edit", "given", "fault", "text")
    return applied.mapInArrow(_applied(to_arrow_schema(repaired)), repaired), repaired


def repair(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Every edit of every conversation: conv_id, step (from 0), edit (K, R, D or I), role and text after it, turn, fault.

    Rows with edit D are those left out; the others, by step, are the repaired conversation. ``fault``: 0 none, 1 blank, 2 duplicate,
    3 cut off, null for new rows.
    """
    rows, _ = _stream(conversations, conv_id, turn, role, text)
    return rows.select("conv_id", "step", "edit", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
                       "turn", "fault")


def _digest_type(id_type: T.DataType) -> T.StructType:
    longs = [T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return T.StructType([T.StructField("conv_id", id_type), *longs, T.StructField("audit", T.StringType()),
                         T.StructField("repaired_sha256", T.StringType())])


class _Digest:
    def __init__(self, conv_id):
        self.conv_id, self.faults, self.illegal, self.cost, self.audit = conv_id, [0] * 4, 0, 0, []
        self.hash, self.any, self.role = hashlib.sha256(), False, None
        self.first = self.last = None
        self.turns = 0

    def add(self, edit, role, text, turn, initial, fault) -> None:
        self.audit.append(edit)
        self.cost += COST[edit] + (CUT_OFF_COST if fault == CUT_OFF and edit != "D" else 0)
        if fault is not None:
            self.faults[fault] += 1
            if self.role is not None and self.role + initial not in LEGAL:
                self.illegal += 1
            self.role = initial
            if turn is not None and turn != self.last:
                self.first = turn if self.first is None else self.first
                self.last = turn
                self.turns += 1
        if edit != "D":
            if self.any:
                self.hash.update(b"\n")
            self.any = True
            self.hash.update(role)
            self.hash.update(b":")
            self.hash.update(text)

    def row(self) -> tuple:
        gaps = min(self.last - self.first + 1 - self.turns, (1 << 63) - 1) if self.turns else 0
        return (self.conv_id, gaps, *self.faults[1:], self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


def _digests(schema: pa.Schema):
    def batches(stream):
        made: list[tuple] = []
        now: _Digest | None = None
        for batch in stream:
            for conv_id, _, *edit in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        made.append(now.row())
                    now = _Digest(conv_id)
                now.add(*edit)
                if len(made) >= 10_000:
                    yield _batch(schema, made)
                    made = []
        if now is not None:
            made.append(now.row())
        yield _batch(schema, made)

    return batches


def repair_digests(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Read off the repaired rows as they come, conversation by conversation, without another shuffle.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    rows, repaired = _stream(conversations, conv_id, turn, role, text)
    kind = _digest_type(repaired["conv_id"].dataType)
    return rows.mapInArrow(_digests(to_arrow_schema(kind)), kind)


# --- the query's damage -------------------------------------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """Rows with faults by crc32(conv_id:turn) % 20: 0 dropped, 1 emptied, 2 without ``.!?``, 3 twice, 4 as user. Nulls are one space."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(plain("text"), "[.!?]", "")).otherwise(plain("text"))
    return conversations.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(plain("role")).alias("role"), text.alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """``repair_digests`` of the damaged rows, for every conversation of the table as it was."""
    found = repair_digests(damage(conversations)).withColumnRenamed("conv_id", "_found")
    known = conversations.select("conv_id").distinct()
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    empty = {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    return (known.join(found, F.col("conv_id").eqNullSafe(F.col("_found")), "left")
            .select("conv_id", *[c.alias(n) for n, c in zero.items()], *[F.coalesce(F.col(n), F.lit(v)).alias(n) for n, v in empty.items()]))
