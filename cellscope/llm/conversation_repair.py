"""Repair of damaged conversations: generalised LR parsing over the role grammar with weighted edits.

A conversation's role initials must read ``(s?(ua)+)?``. Rows are read from the last to the first, so the parser's
grammar is the mirrored one (FIXED below). Its graph-structured stack has one node for each stack top: a node holds the
last edit, a link to the node it stands on, and the cost so far. Each row offers Keep, Rerole and Delete, and between rows
Insert; nodes with equal tops merge by the least (cost, audit). Read from the right, an edit's initial goes in front of the
audits of its node, which keeps their order, so the merge is exact; audits are compared by letter and by the rank of the
node below, never as whole strings.

Steps: rows are damaged, and equal rows of one turn collapse to one row with a count (partial aggregation, so a row that is
repeated very often is one row). The first place of each (role, text) of a conversation comes from an aggregation joined back.
The rows are sorted by range over (conversation, turn, role, text), so a very long conversation spreads over many tasks.
Blocks of consecutive rows are parsed on their own, from every possible stack top; a conversation's blocks are then chained
from the right, which is exact because a block's outcome depends on its right neighbours through the top alone. Only flags
and initials are parsed; texts meet the finished audit in a sorted stream and go straight into the hash, which is one task
for one conversation (sha256 cannot be cut) and holds one batch at a time.

Defined cases: null roles, texts, and in the damage key null ids and turns, read as one space; null turns come first; rows of one turn
are taken by role, then text; a null conversation id is a conversation; a conversation without rows after damage has zeros, an
empty audit and the hash of the empty string; empty tables give no rows; extra columns are ignored; texts and
conversations of any length are taken whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import parts_for, stored

#: The mirrored grammar C -> empty | L | L s, L -> a u | L a u as an LR automaton.
SHIFT = {(0, "a"): 1, (1, "u"): 5, (2, "a"): 3, (3, "u"): 6, (2, "s"): 7}
REDUCE = {5: ("L", 2), 6: ("L", 3), 7: ("C", 2)}
GOTO = {(0, "L"): 2, (0, "C"): 4}
ACCEPT = (0, 2, 4)

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
WHITE = " \t\n\x0b\x0c\r"
ROLES = {"u": "user", "a": "assistant"}
#: Rows parsed at a time, and rows sorted in a task.
BLOCK, PER_TASK = 50_000, 500_000


def _read(stack: tuple[int, ...], symbol: str) -> tuple[int, ...] | None:
    """The stack after shifting ``symbol`` and every reduction that follows, or None."""
    if (stack[-1], symbol) not in SHIFT:
        return None
    stack += (SHIFT[stack[-1], symbol],)
    while stack[-1] in REDUCE:
        left, n = REDUCE[stack[-1]]
        stack = stack[:-n]
        stack += (GOTO[stack[-1], left],)
    return stack


def _reachable() -> tuple[dict[int, tuple[int, ...]], dict[tuple[int, str], int]]:
    """Stacks that occur between rows, by their top, and the tops that follow; each top stands on one stack here."""
    stacks, follow, todo = {0: (0,)}, {}, [0]
    while todo:
        top = todo.pop()
        for symbol in "sua":
            stack = _read(stacks[top], symbol)
            if stack is not None:
                follow[top, symbol] = stack[-1]
                if stacks.setdefault(stack[-1], stack) is stack:
                    todo.append(stack[-1])
                elif stacks[stack[-1]] != stack:
                    raise ValueError("a top must name its stack")
    return stacks, follow


STACKS, FOLLOW = _reachable()


class Node:
    """A stack top: the edits made last, the node below, the cost so far and the order of its audit in its front."""

    __slots__ = ("cost", "order", "edits", "below")

    def __init__(self, cost, order, edits, below):
        self.cost, self.order, self.edits, self.below = cost, order, edits, below

    def before(self, other) -> bool:
        return other is None or (self.cost, self.order) < (other.cost, other.order)


def _offer(front: dict[int, Node], top: int | None, node: Node) -> bool:
    if top is None or not node.before(front.get(top)):
        return False
    front[top] = node
    return True


def _inserted(front: dict[int, Node]) -> dict[int, Node]:
    """The front after any insertions that pay off, with the orders of its audits as ranks."""
    todo = list(front)
    while todo:
        top = todo.pop()
        node = front[top]
        for symbol in "ua":
            target = FOLLOW.get((top, symbol))
            if _offer(front, target, Node(node.cost + INSERT, ("I", node.order), "I", node)):
                todo.append(target)
    for rank, node in enumerate(sorted(front.values(), key=lambda node: node.order)):
        node.order = ("", rank)
    return front


def parse(rows: list[tuple[str, bool, bool, int]], origin: int = 0) -> dict[int, Node]:
    """The front left of ``rows`` (initial, live, truncated, rows that must be deleted after it) for a stack top right of them."""
    front = _inserted({origin: Node(0, ("", 0), "", None)})
    for initial, live, truncated, extra in reversed(rows):
        if extra:
            front = {top: Node(node.cost + DELETE * extra, node.order, "D" * extra, node) for top, node in front.items()}
        if not live:
            continue
        after: dict[int, Node] = {}
        for top, node in front.items():
            _offer(after, top, Node(node.cost + DELETE, ("D", node.order), "D", node))
            _offer(after, FOLLOW.get((top, initial)), Node(node.cost + KEEP + TRUNCATED * truncated, ("K", node.order), "K", node))
            for role in "ua":
                _offer(after, FOLLOW.get((top, role)), Node(node.cost + REROLE + TRUNCATED * truncated, ("R", node.order), "R", node))
        front = _inserted(after)
    return front


def audit(node: Node) -> str:
    parts = []
    while node is not None:
        parts.append(node.edits)
        node = node.below
    return "".join(parts)


def chain(front: dict[int, tuple[int, str]], block: list[tuple[int, int, int, str]]) -> dict[int, tuple[int, str]]:
    """Put a block (origin, top, cost, audit) to the left of what ``front`` holds by top; equal tops merge by the least."""
    after: dict[int, tuple[int, str]] = {}
    for origin, top, cost, edits in block:
        if origin in front:
            found = (front[origin][0] + cost, edits + front[origin][1])
            after[top] = min(after.get(top, found), found)
    return after


def _illegal(left: str, right: str) -> bool:
    return left + right not in ("su", "ua", "au")


_BLOCK = "conv_id long, pos long, first string, last string, illegal long, tops array<struct<origin:int,top:int,cost:long,audit:string>>"
_TOPS = pa.list_(pa.struct([("origin", pa.int32()), ("top", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


def _block(conv_id, rows: list[tuple], ended: bool) -> tuple:
    """One block; ``rows`` are (pos, initial, live, truncated, extra, copies). An ended conversation has nothing to its right."""
    lean = [r[1:5] for r in rows]
    tops = [{"origin": o, "top": t, "cost": n.cost, "audit": audit(n)} for o in ([0] if ended else sorted(STACKS)) for t, n in parse(lean, o).items()]
    illegal = sum(r[5] - 1 for r in rows) + sum(_illegal(a[1], b[1]) for a, b in zip(rows, rows[1:]))
    return conv_id, rows[0][0], rows[0][1], rows[-1][1], illegal, tops


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parse the consecutive rows of each conversation in this part; only the part's last one may go on elsewhere."""
    def given(found):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), _TOPS]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found) if found else [[]] * 6, kinds)],
                                          names=["conv_id", "pos", "first", "last", "illegal", "tops"])

    rows, current = [], None
    for batch in batches:
        found = []
        for conv_id, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if rows and (conv_id != current or len(rows) >= BLOCK):
                found.append(_block(current, rows, conv_id != current))
                rows = []
            current = conv_id
            rows.append(tuple(row))
        yield given(found)
    if rows:
        yield given([_block(current, rows, False)])


_PARSED = "conv_id long, illegal long, cost long, audit string"


def _chained(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chain each conversation's blocks, which come from right to left."""
    front, illegal, right, current = None, 0, "", None

    def ended():
        cost, edits = min(front[t] for t in ACCEPT if t in front)
        return current, illegal, cost, edits

    def given(found):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found) if found else [[]] * 4, [pa.int64(), pa.int64(), pa.int64(), pa.string()])],
                                          names=["conv_id", "illegal", "cost", "audit"])

    for batch in batches:
        found = []
        for conv_id, _, first, last, inside, tops in zip(*(c.to_pylist() for c in batch.columns)):
            if front is None or conv_id != current:
                if front is not None:
                    found.append(ended())
                front, illegal, current = {0: (0, "")}, 0, conv_id
            else:
                illegal += _illegal(last, right)
            front = chain(front, [(t["origin"], t["top"], t["cost"], t["audit"]) for t in tops])
            illegal, right = illegal + inside, first
        yield given(found)
    if front is not None:
        yield given([ended()])


class Repaired:
    """Walks a finished audit along the rows of its conversation and gives the repaired lines."""

    def __init__(self, edits: str):
        self.edits, self.at, self.role = edits, 0, ""

    def _insertions(self) -> Iterator[tuple[str, str]]:
        while self.edits[self.at:self.at + 1] == "I":
            yield self._next(), ""
            self.at += 1

    def _next(self) -> str:
        self.role = "a" if self.role == "u" else "u"
        return ROLES[self.role]

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self._insertions()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "K":
            self.role = role[:1]
            yield role, text
        elif edit == "R":
            yield self._next(), text

    def skip(self, deleted: int) -> Iterator[tuple[str, str]]:
        """Rows that must go; insertions before them stay."""
        if deleted:
            yield from self._insertions()
            self.at += deleted

    def rest(self) -> Iterator[tuple[str, str]]:
        yield from self._insertions()


def _finished(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, repaired_sha256): a conversation's audit comes first, then its rows in order."""
    walk = digest = current = None
    started = False

    def add(lines):
        nonlocal started
        for role, text in lines:
            digest.update((("\n" if started else "") + f"{role}:{text}").encode())
            started = True

    def given(found):
        return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string())], names=["conv_id", "repaired_sha256"])

    for batch in batches:
        found = []
        for conv_id, pos, edits, role, text, live, extra in zip(*(c.to_pylist() for c in batch.columns)):
            if pos < 0:
                if walk is not None:
                    add(walk.rest())
                    found.append((current, digest.hexdigest()))
                walk, digest, current, started = Repaired(edits), hashlib.sha256(), conv_id, False
                continue
            if live:
                add(walk.row(role, text))
            add(walk.skip(extra))
        yield given(found)
    if walk is not None:
        add(walk.rest())
        yield given([(current, digest.hexdigest())])


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): the rows that are left, with null roles and texts as one space."""
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("code"))
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("code") == 4, "user").otherwise(F.col("role"))
    return rows.where("code <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("code") == 3, 2).otherwise(1).alias("copies"))


def _turn() -> Column:
    return F.struct(F.col("turn").isNotNull(), F.col("turn"))


def mark_faults(rows: DataFrame) -> DataFrame:
    """One row for equal rows of a turn, with its flags: live (its first copy need not go), extra (copies that must), truncated."""
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    seen = F.rtrim("text", F.lit(WHITE))
    rows = rows.withColumn("digest", F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256)).withColumn("blank", seen == "")
    rows = stored(rows.withColumn("truncated", ~F.substring(seen, -1, 1).isin(".", "!", "?")), "repair-rows")
    first = rows.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(F.min(_turn()).alias("least"))
    rows = rows.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")))
    rows = rows.withColumn("live", ~F.col("blank") & _turn().eqNullSafe(F.col("least")))
    return rows.select("conv_id", "turn", "role", "text", "copies", "blank", "live", (F.col("live") & F.col("truncated")).alias("truncated"),
                       (F.col("copies") - F.col("live").cast("long")).alias("extra"))


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """Damage and repair: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    ids = conversations.select("conv_id").distinct()
    rows = mark_faults(damage(conversations))
    total = rows.count()
    order = ["conv_id", "turn", "role", "text"]
    rows = rows.repartitionByRange(parts_for(total, PER_TASK), *order).sortWithinPartitions(*order)
    rows = stored(rows.withColumn("pos", F.monotonically_increasing_id()), "repair-sorted")

    lean = rows.select("conv_id", "pos", F.substring("role", 1, 1).alias("initial"), "live", "truncated", "extra", "copies")
    lean = lean.repartitionByRange(parts_for(total, PER_TASK), "pos").sortWithinPartitions("pos")
    blocks = lean.mapInArrow(_blocks, _BLOCK).repartition("conv_id").sortWithinPartitions("conv_id", F.col("pos").desc())
    parsed = blocks.mapInArrow(_chained, _PARSED)
    counts = rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("extra"))).alias("duplicate"), F.sum(F.col("truncated").cast("long")).alias("truncated"))

    def beside(left, right):
        names = [c for c in right.columns if c != "conv_id"]
        right = right.withColumnRenamed("conv_id", "c")
        return left.join(right, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(*left.columns, *names)

    heads = beside(beside(ids, counts), parsed)
    heads = stored(heads.fillna(0, [c for c in heads.columns if c not in ("conv_id", "audit")]).fillna("", ["audit"]), "repair-heads")
    return beside(heads, _hashes(heads, rows))


def _hashes(heads: DataFrame, rows: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    heads = heads.select("conv_id", F.lit(-1).cast("long").alias("pos"), "audit", none.alias("role"), none.alias("text"), F.lit(False).alias("live"), F.lit(0).cast("long").alias("extra"))
    stream = heads.unionByName(rows.select("conv_id", "pos", none.alias("audit"), "role", "text", "live", "extra"))
    return stream.repartition("conv_id").sortWithinPartitions("conv_id", "pos").mapInArrow(_finished, "conv_id long, repaired_sha256 string")
