"""Conversation structure repair: the cheapest edits, by survivor-coalescence Viterbi."""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .common import keep, table

# states: what the repaired conversation ends with so far
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
INITIALS = "?sua"
NEVER = 1 << 40

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"


def _next_role(state: int) -> int:
    return ASSISTANT if state == USER else USER


def kind_of(initial: int, doomed: bool, truncated: bool) -> int:
    """One number for all that the search needs to know of a row."""
    return initial * 4 + 2 * doomed + truncated


def apply(state: int, letter: str, kind: int) -> int | None:
    """The state after one edit, None where it is not allowed."""
    if letter == DELETE:
        return state
    if letter == INSERT:
        return _next_role(state)
    if kind & 2:
        return None
    if letter == REROLE:
        return _next_role(state)
    initial = kind >> 2
    if initial == SYSTEM:
        return SYSTEM if state == START else None
    return initial if initial and initial == _next_role(state) else None


@lru_cache(maxsize=None)
def _moves(kind: int) -> tuple[tuple[int, int, int, str], ...]:
    """(from, to, cost, letters) of a row: its edit, with or without an insertion before it.

    Two insertions in a row are never cheapest: they only add a pair, and where they
    complete a conversation that has nothing but its system row, deleting that is cheaper.
    """
    out = []
    for state in STATES:
        for before in ("", INSERT):
            for edit in (KEEP, REROLE, DELETE):
                middle = apply(state, INSERT, kind) if before else state
                to = apply(middle, edit, kind)
                if to is not None:
                    cost = len(before) * COST[INSERT] + COST[edit] + (edit != DELETE and kind & 1)
                    out.append((state, to, cost, before + edit))
    return tuple(out)


@lru_cache(maxsize=1 << 14)
def step(costs: tuple[int, ...], ranks: tuple[int, ...], kind: int):
    """Survivors after one more row: (added, costs, ranks, origins).

    ``costs`` are relative to the cheapest survivor, ``added`` is what that one has
    grown by.  ``ranks`` order the whole edit texts of the survivors, so equal costs are
    decided by complete texts although none is looked at again: after a row no survivor's
    text begins another's (each ends with the edit of that row), hence the order of two
    texts stays whatever is appended.  ``origins`` has (state before, letters) per state.
    """
    best: list = [None] * 4
    for state, to, cost, letters in _moves(kind):
        if costs[state] < NEVER:
            key = (costs[state] + cost, ranks[state], letters, state)
            if best[to] is None or key < best[to]:
                best[to] = key
    # whatever can follow START or SYSTEM can follow ASSISTANT, if a system row is deleted
    # instead of kept; survivors dearer than that never win, and would keep all from meeting
    limit = min(best[s][0] + more for s, more in ((ASSISTANT, 0), (USER, COST[INSERT])) if best[s]) if best[ASSISTANT] or best[USER] else NEVER
    for state, spare in ((START, COST[DELETE]), (SYSTEM, 0)):
        if best[state] and best[state][0] > limit + spare:
            best[state] = None
    least = min(b[0] for b in best if b)
    order = sorted((b[1], b[2], to) for to, b in enumerate(best) if b)
    ranked = [0] * 4
    for rank, (_, _, to) in enumerate(order):
        ranked[to] = rank
    origins = tuple((b[3], b[2]) if b else None for b in best)
    return least, tuple(b[0] - least if b else NEVER for b in best), tuple(ranked), origins


def entering(state: int) -> tuple[tuple[int, ...], tuple[int, ...]]:
    return tuple(0 if s == state else NEVER for s in STATES), (0, 0, 0, 0)


def ending(costs: tuple[int, ...], ranks: tuple[int, ...]) -> tuple[int, int, str]:
    """(cost, state, letters) of the cheapest way to end: nothing, whole pairs, or one more reply."""
    ways = [(costs[s] + len(x) * COST[INSERT], ranks[s], x, s) for s, x in ((START, ""), (ASSISTANT, ""), (USER, INSERT))]
    cost, _, letters, state = min(ways)
    return cost, state, letters


class _Node:
    """An edit of the backpointer tree; equal deletions of neighbouring rows share a node."""

    __slots__ = ("parent", "letters", "count", "refs", "children")

    def __init__(self, parent: _Node | None, letters: str):
        self.parent, self.letters, self.count = parent, letters, 1
        self.refs = 0  # children and survivors that hold it
        self.children: list[_Node] = []
        if parent is not None:
            parent.refs += 1
            parent.children.append(self)


class Repair:
    """Finds the cheapest edits of one conversation, row by row.

    A backpointer tree holds the edits of the survivors, one per state.  A node that no
    survivor descends from is freed by its count of references.  When the root is left
    with one child, all survivors share that ancestor: its edits are certain, go to
    ``emit(letter, state before, row)`` and leave memory.  Rows wait until their edit does.
    """

    def __init__(self, emit: Callable, state: int = START):
        self.emit = emit
        self.costs, self.ranks = entering(state)
        self.state = state
        self.root = _Node(None, "")
        self.survivors: list = [None] * 4
        self.survivors[state] = self.root
        self.root.refs = 1
        self.rows: deque = deque()

    def add(self, kind: int, row) -> None:
        _, self.costs, self.ranks, origins = step(self.costs, self.ranks, kind)
        self.rows.append((kind, row))
        fresh: list = [None] * 4
        for to, origin in enumerate(origins):
            if origin:
                fresh[to] = _Node(self.survivors[origin[0]], origin[1])
                fresh[to].refs = 1
        for node in self.survivors:
            if node is not None:
                self._release(node)
        self.survivors = fresh
        self._settle()

    def finish(self, exit_state: int | None = None) -> None:
        """Emit what is left: up to ``exit_state``, or to the cheapest end."""
        letters = ""
        if exit_state is None:
            _, exit_state, letters = ending(self.costs, self.ranks)
        path = []
        node = self.survivors[exit_state]
        while node is not self.root:
            path.append(node)
            node = node.parent
        for node in reversed(path):
            self._tell(node)
        for letter in letters:
            self._edit(letter, 0, None)

    def held(self) -> int:
        """Nodes in memory."""
        nodes, stack = 0, [self.root]
        while stack:
            node = stack.pop()
            nodes += 1
            stack += node.children
        return nodes

    def _release(self, node: _Node) -> None:
        node.refs -= 1
        while not node.refs and node.parent is not None:
            parent = node.parent
            parent.children.remove(node)
            parent.refs -= 1
            node = parent
        # deletions with nothing but a deletion behind them become part of it
        if node.refs == 1 and node.children and node.parent is not None and node.letters == DELETE == node.children[0].letters:
            child, parent = node.children[0], node.parent
            child.count += node.count
            child.parent = parent
            parent.children[parent.children.index(node)] = child

    def _settle(self) -> None:
        while self.root.refs == 1 and self.root.children:
            child = self.root.children[0]
            self._tell(child)
            child.parent = None
            self.root = child

    def _tell(self, node: _Node) -> None:
        for _ in range(node.count):
            kind, row = self.rows.popleft()
            for letter in node.letters:
                self._edit(letter, kind, None if letter == INSERT else row)

    def _edit(self, letter: str, kind: int, row) -> None:
        after = apply(self.state, letter, kind)
        self.emit(letter, after, row)
        self.state = after


def judged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv, turn, role, text, row_id) without text, with their first ``fault`` and ``kind``.

    Whether role and text were seen earlier in the conversation is asked the other way
    round: the first row of each (conversation, role, text) is found by an aggregation
    that combines before its shuffle, and told by its own row id.  So no hot text or
    conversation meets in one task.
    """
    narrow = rows.select(
        "conv",
        "turn",
        "role",
        "row_id",
        F.xxhash64("text").alias("text_order"),
        F.sha2("text", 256).alias("text_key"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("is_blank"),
        (~F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", "").rlike(r"[.!?]\z")).alias("is_open"),
    )
    firsts = narrow.groupBy("conv", "role", "text_key").agg(F.min(F.struct(F.col("turn").isNotNull(), "turn", "row_id"))["row_id"].alias("row_id"))
    marked = narrow.drop("text_key").join(firsts.select("row_id", F.lit(True).alias("is_first")), "row_id", "left")
    fault = F.when(F.col("is_blank"), BLANK).when(F.col("is_first").isNull(), DUPLICATE).when(F.col("is_open"), TRUNCATED)
    initial = F.coalesce(*[F.when(F.col("role").startswith(c), i) for i, c in enumerate(INITIALS) if i], F.lit(0))
    doomed = F.coalesce(fault.isin(BLANK, DUPLICATE), F.lit(False)).cast("int")
    kind = initial * 4 + doomed * 2 + F.coalesce(fault == TRUNCATED, F.lit(False)).cast("int")
    return marked.select("conv", "turn", "role", "text_order", "row_id", fault.alias("fault"), kind.alias("kind"))


SUMMARY = "part int, place int, conv {conv}, costs array<bigint>, ranks array<int>, last int"


def _summaries(ordered: DataFrame, conv_type: str) -> DataFrame:
    """What the first and the last conversation of each partition do to the survivors.

    Per state at its beginning and state at its end: the least cost and the order of the
    edit texts.  Two rows a partition at most, whatever its size.
    """

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, part, now, first = [], None, None, True

        def close(place):
            totals, survivors = now["added"], now["survivors"]
            costs = [totals[j] + c if c < NEVER else NEVER for j in STATES for c in survivors[j][0]]
            out.append((part, place, now["conv"], costs, [r for j in STATES for r in survivors[j][1]], now["last"]))

        for batch in batches:
            for part, conv, kind in zip(*(batch.column(c).to_pylist() for c in ("part", "conv", "kind"))):
                if now is None or conv != now["conv"]:
                    if now is not None and first:
                        close(0)
                        first = False
                    now = {"conv": conv, "added": [0] * 4, "survivors": [entering(j) for j in STATES], "last": 0}
                for j in STATES:
                    more, costs, ranks, _ = step(*now["survivors"][j], kind)
                    now["added"][j] += more
                    now["survivors"][j] = (costs, ranks)
                now["last"] = kind >> 2
        if now is not None:
            close(0 if first else 1)
        if out:
            schema = pa.schema([("part", pa.int32()), ("place", pa.int32()), ("conv", batch.schema.field("conv").type), ("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int32())), ("last", pa.int32())])
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return ordered.select("part", "conv", "kind").mapInArrow(summarise, SUMMARY.format(conv=conv_type))


def chain(summaries: list) -> dict[tuple, tuple[int, int | None, int]]:
    """(state at its beginning, state at its end or None at the conversation's end, initial before it).

    By (partition, conversation), for the segments of conversations that span partitions.
    The segments of one are composed in order; their edit texts never meet: the order of
    the texts so far and the order within the segment decide ties.
    """
    summaries = sorted(summaries, key=lambda s: (s.part, s.place))
    plan, i = {}, 0
    while i < len(summaries):
        group = [summaries[i]]
        while i + len(group) < len(summaries) and summaries[i + len(group)].conv == group[0].conv:
            group.append(summaries[i + len(group)])
        i += len(group)
        if len(group) == 1:
            continue
        costs, ranks = entering(START)
        origins = []
        for s in group:
            best: list = [None] * 4
            for j in STATES:
                for k in STATES:
                    if costs[j] < NEVER and s.costs[4 * j + k] < NEVER:
                        key = (costs[j] + s.costs[4 * j + k], ranks[j], s.ranks[4 * j + k], j)
                        if best[k] is None or key < best[k]:
                            best[k] = key
            order = sorted((b[1], b[2], k) for k, b in enumerate(best) if b)
            costs = tuple(b[0] if b else NEVER for b in best)
            ranks = tuple(next((r for r, o in enumerate(order) if o[2] == k), 0) for k in STATES)
            origins.append([b[3] if b else None for b in best])
        _, state, _ = ending(costs, ranks)
        leave = None
        for at in range(len(group) - 1, -1, -1):
            begin = origins[at][state]
            plan[group[at].part, group[at].conv] = (begin, leave, group[at - 1].last if at else -1)
            state = leave = begin
    return plan


EDITS = "conv {conv}, part int, seq bigint, edit string, role string, row_id bigint, fault string, cost int, illegal boolean"
_ADJACENT = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
_NAMES = {USER: "user", ASSISTANT: "assistant"}


def _edited(ordered: DataFrame, conv_type: str, plan: dict) -> DataFrame:
    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        schema = None
        seq, part, conv, search, before, leave = 0, None, None, None, -1, None

        def emit(letter, state, row):
            nonlocal seq
            row_id, role, fault, illegal = row or (None, None, None, False)
            cost = COST[letter] + (letter != DELETE and fault == TRUNCATED)
            out.append((conv, part, seq, letter, _NAMES[state] if letter in (INSERT, REROLE) else role, row_id, fault, cost, illegal))
            seq += 1

        def flush():
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out), schema)]
            out.clear()
            return pa.record_batch(columns, schema=schema)

        for batch in batches:
            schema = schema or pa.schema(
                [("conv", batch.schema.field("conv").type), ("part", pa.int32()), ("seq", pa.int64()), ("edit", pa.string()), ("role", pa.string())]
                + [("row_id", pa.int64()), ("fault", pa.string()), ("cost", pa.int32()), ("illegal", pa.bool_())]
            )
            for part_, conv_, kind, row_id, role, fault in zip(*(batch.column(c).to_pylist() for c in ("part", "conv", "kind", "row_id", "role", "fault"))):
                if search is None or conv_ != conv:
                    if search is not None:
                        search.finish(leave)
                    part, conv = part_, conv_
                    begin, leave, before = plan.get((part, conv), (START, None, -1))
                    search = Repair(emit, begin)
                initial = kind >> 2
                search.add(kind, (row_id, role, fault, before >= 0 and (before, initial) not in _ADJACENT))
                before = initial
                if len(out) >= 4096:
                    yield flush()
        if search is not None:
            search.finish(leave)
        if out:
            yield flush()

    return ordered.mapInArrow(edit, EDITS.format(conv=conv_type))


def edits(rows: DataFrame) -> DataFrame:
    """The cheapest edits that give every conversation the shape ``(system? (user assistant)+)?``.

    ``rows`` has conv, turn, role, text and a unique ``row_id``.  Rows are taken by turn,
    nulls first; rows of one turn by role, a hash of the text, and row id.  A null role or
    text counts as one space; a role counts by its first letter, one that is none of
    system, user and assistant has to be rewritten or deleted.  The row's first fault
    counts: blank, duplicate (role and text seen earlier), truncated (does not end with
    ``.!?``).  Keep costs 0, rewriting the role 2, Delete 3 (required for blank and
    duplicate rows), Insert 2, an undeleted truncated row 1 more; of equally cheap edit
    texts the least counts.  All rows without conversation form one.

    Returns one row per edit: conv, (part, seq) in order, edit letter, the role after it,
    row_id (null for insertions), the row's fault, the cost, and whether the row's role
    may not follow that of the row before it.

    Rows without their texts are range-partitioned by conversation and place, so a
    conversation that holds a third of all rows spans many tasks.  Each partition says
    what its first and last conversation do to the survivors (two rows a partition go to
    the driver), these are chained, and all partitions are then searched at once, each
    from the state it is entered in to the state it is left in.
    """
    conv_type = rows.schema["conv"].dataType.simpleString()
    said = rows.select("conv", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "row_id")
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), *[F.col(c).asc() for c in ("role", "text_order", "row_id")]]
    ranged = judged(said).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = checkpointed(ranged.select("conv", "kind", "row_id", "role", "fault", F.spark_partition_id().alias("part")))
    plan = chain(_summaries(ordered, conv_type).collect())
    return keep(_edited(ordered, conv_type, plan), "edits")


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: conv, part, seq, role, text (empty where inserted)."""
    texts = rows.select("row_id", F.coalesce("text", F.lit(" ")).alias("text"))
    kept = found.where(F.col("edit") != DELETE).select("conv", "part", "seq", "role", "row_id", "edit")
    joined = kept.where("row_id is not null").join(texts, "row_id").drop("row_id", "edit")
    return joined.unionByName(kept.where("row_id is null").drop("row_id", "edit").withColumn("text", F.lit("")))


def audits(found: DataFrame) -> DataFrame:
    """(conv, audit): the letters of the edits, in order, put together by partition before they are by conversation."""
    letters = lambda order, value: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value]), "")
    parts = found.groupBy("conv", "part").agg(letters("seq", "edit").alias("letters"))
    return parts.groupBy("conv").agg(letters("part", "letters").alias("audit"))


def digests(rows: DataFrame) -> DataFrame:
    """(conv, sha256 of the lines ``role:text``): a digest goes through its text in order, so rows stream through one task, never held."""
    conv_type = rows.schema["conv"].dataType.simpleString()
    lines = rows.select("conv", "part", "seq", F.concat("role", F.lit(":"), "text").alias("line"))
    placed = lines.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "part", "seq").select("conv", "line")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, conv, out, schema = None, None, [], None

        def flush():
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out), schema)]
            out.clear()
            return pa.record_batch(columns, schema=schema)

        for batch in batches:
            schema = schema or pa.schema([("conv", batch.schema.field("conv").type), ("sha", pa.string())])
            for conv_, line in zip(batch.column("conv").to_pylist(), batch.column("line").to_pylist()):
                if now is None or conv_ != conv:
                    if now is not None:
                        out.append((conv, now.hexdigest()))
                    now, conv = hashlib.sha256(line.encode()), conv_
                else:
                    now.update(b"\n" + line.encode())
            if len(out) >= 4096:
                yield flush()
        if now is not None:
            out.append((conv, now.hexdigest()))
            yield flush()

    return placed.mapInArrow(digest, f"conv {conv_type}, sha string")


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text; nulls: one space) with faults planted by a rule.

    By crc32 of ``conv_id:turn`` % 20: 0 drops the row, 1 empties its text, 2 removes
    ``.!?`` from it, 3 repeats it at once (same turn), 4 sets its role to user.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rule = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    ruled = rows.select(F.col("conv_id").alias("conv"), "turn", space("role").alias("role"), space("text").alias("text"), rule.alias("rule")).where("rule <> 0")
    text = F.when(F.col("rule") == 1, "").when(F.col("rule") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("rule") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("rule") == 3, 2).otherwise(1)))
    return ruled.select("conv", "turn", role.alias("role"), text.alias("text"), times.alias("_")).drop("_")


def op11_conversation_repair(spark, sf_dir):
    """Every conversation, damaged by rule: its faults, the cheapest edits and a digest of the repaired rows."""
    given = table(spark, sf_dir, "conversations")
    rows = keep(damaged(given).withColumn("row_id", F.monotonically_increasing_id()), "damaged")
    found = edits(rows)
    turns = rows.groupBy("conv", "turn").agg(F.count("*").alias("_")).groupBy("conv")
    span = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
    counts = found.groupBy("conv").agg(
        *[F.count_if(F.col("fault") == f).alias(f) for f in (BLANK, DUPLICATE, TRUNCATED)],
        F.count_if("illegal").alias("illegal"),
        F.sum(F.col("cost").cast("long")).alias("cost"),
    )
    # one row per conversation from each part, put together by one aggregation
    parts = [given.select(F.col("conv_id").alias("conv")).distinct(), turns.agg(span.alias("gaps")), counts, audits(found), digests(repaired(rows, found))]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    numbers = ("gaps", BLANK, DUPLICATE, TRUNCATED, "illegal", "cost")
    nothing = hashlib.sha256(b"").hexdigest()
    return whole.groupBy("conv").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("sha"), F.lit(nothing)).alias("repaired_sha256"),
    ).withColumnRenamed("conv", "conv_id")
