"""Operator 12: repair of conversation structure at least cost, by survivor-coalescence Viterbi.

A conversation's roles should read ``(s?(ua)+)?`` by initials.  Each row is kept (K, cost 0), given another role (R, 2) or
deleted (D, 3; blank and duplicate rows must be), and empty rows are inserted anywhere (I, 2); an undeleted truncated
row costs 1 more.  Of the cheapest ways the one whose string of edits is least counts.

The pattern has four states: nothing yet, after a system turn, after a user, after an assistant.  After each row every state keeps its one
survivor, a leaf of a tree of backpointers whose nodes count their references.  A survivor that loses lets go of its
leaf, and the nodes that nothing refers to any more go too.  When all survivors share an ancestor, the edits down
to it are emitted and forgotten.  Two survivors of equal cost are compared by their whole strings since their common
ancestor.  At one row no string of a cheapest way goes on where another ends (only inserts could make it longer, and they cost),
so the lesser one stays lesser whatever follows.  A survivor dearer by more than ``SWITCH`` than another can never win
and is let go, so the state "all deleted so far" does not hold the tree back.

Rows are sorted by conversation and turn in ranges, so one conversation may lie in many ranges, each of them a block.  A cut
conversation's blocks first give their costs from each state to each state, and the order of their strings; these
small rows are chained, which fixes each block's first and last state.  Then all blocks emit their edits side by
side.  No task holds a conversation; only the text of an answer (a digest, a string of edits) puts one together.

Defined cases: null roles and texts count as one space, as null ids and turns do in the damage's hash; null turns come
first; rows of one turn go by role and text; roles with other initials are given a role or deleted; a null id is a
conversation like others; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from math import inf

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.shared import bounded_batches, stored

# --- fixed values: the pattern's states, costs and roles ---
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
GOES = {EMPTY: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
ROLE = {USER: "user", ASSISTANT: "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
LEGAL = {"su", "ua", "au"}
WORD = r"[^\x20\x09-\x0D]"
# -----------------------------------------------------------

#: what it costs at most to go on from state t as one would from state s: SWITCH[t][s]
SWITCH = {EMPTY: {SYSTEM: 0, USER: 2, ASSISTANT: 0}, SYSTEM: {EMPTY: 4, USER: 2, ASSISTANT: 4},
          USER: {EMPTY: 5, SYSTEM: 2, ASSISTANT: 2}, ASSISTANT: {EMPTY: 3, SYSTEM: 0, USER: 2}}
#: inserts before a row, by state: the states they lead to (more inserts lead to a state met before, and cost more)
INSERTS = {EMPTY: (EMPTY, USER, ASSISTANT), SYSTEM: (SYSTEM, USER, ASSISTANT), USER: (USER, ASSISTANT), ASSISTANT: (ASSISTANT, USER)}
#: inserts after the last row
TAIL = {EMPTY: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
CHUNK = 5_000             # edits of one output row
BLOCK_ROWS = 200_000      # rows of a range, about
LEAST_REST = 16           # rows between two looks for a common ancestor, at least
SHIFT = 33                # bits of a row's place that count rows inside a range


class _Node:
    """One edit on the way to a survivor.  ``refs`` counts children and survivors."""

    __slots__ = ("up", "edit", "at", "role", "refs", "depth")

    def __init__(self, up, edit="", at=None, role=None):
        self.up, self.edit, self.at, self.role, self.refs = up, edit, at, role, 0
        self.depth = 0 if up is None else up.depth + 1
        if up is not None:
            up.refs += 1


def _release(node: _Node) -> None:
    while node is not None and node.refs == 0:
        up = node.up
        if up is not None:
            up.refs -= 1
        node.up, node = None, up


def _less(a: _Node, b: _Node) -> bool:
    """Is a's string of edits less than b's?  Both are read back to their common ancestor."""
    one, two = [], []
    while a is not b:
        if a.depth >= b.depth:
            one.append(a.edit)
            a = a.up
        else:
            two.append(b.edit)
            b = b.up
    return one[::-1] < two[::-1]


class Viterbi:
    """Survivors of one block from one state on.  ``put`` takes rows in order; ``taken`` are the edits emitted so far."""

    def __init__(self, start: int = EMPTY):
        self.root = _Node(None)
        self.best: dict[int, tuple[int, _Node]] = {start: (0, self.root)}
        self.root.refs = 1
        self.taken: list[tuple[str, int | None, str | None]] = []
        self.rest = LEAST_REST

    def put(self, at: int, initial: str, must_go: bool, truncated: bool) -> None:
        new: dict[int, tuple[int, _Node]] = {}

        def offer(state, cost, node):
            old = new.get(state)
            if old is None or cost < old[0] or (cost == old[0] and _less(node, old[1])):
                new[state] = (cost, node)
                if old is not None:
                    _release(old[1])
            else:
                _release(node)

        for state, (cost, leaf) in self.best.items():
            chain, paid, held = leaf, cost, []
            for step, here in enumerate(INSERTS[state]):
                if step:
                    chain, paid = _Node(chain, "I", None, ROLE[here]), paid + INSERT
                    chain.refs += 1                        # held while it is built on
                    held.append(chain)
                offer(here, paid + DELETE, _Node(chain, "D", at))
                if not must_go:
                    for letter, there in GOES[here].items():
                        if letter == initial:
                            offer(there, paid + truncated * TRUNCATED, _Node(chain, "K", at))
                        elif there in ROLE:
                            offer(there, paid + REROLE + truncated * TRUNCATED, _Node(chain, "R", at, ROLE[there]))
            for chain in reversed(held):
                chain.refs -= 1
                _release(chain)
        lost = [s for s in new if any(new[s][0] > new[t][0] + SWITCH[t][s] for t in new if t != s)]
        for s in lost:
            node = new.pop(s)[1]
            _release(node)
        for _, leaf in new.values():
            leaf.refs += 1
        for _, leaf in self.best.values():
            leaf.refs -= 1
            _release(leaf)
        self.best = new
        self.rest -= 1
        if self.rest <= 0:                                 # looking back costs the unsettled edits, so do it as seldom
            self._coalesce()
            self.rest = max(LEAST_REST, max(n.depth for _, n in new.values()) - self.root.depth)

    def _coalesce(self) -> None:
        """Emit the edits down to the survivors' last common ancestor."""
        nodes = {id(n): n for _, n in self.best.values()}.values()
        low = min(n.depth for n in nodes)
        level = {id(n): n for n in (self._up(n, low) for n in nodes)}
        while len(level) > 1:
            level = {id(n.up): n.up for n in level.values()}
        (shared,) = level.values()
        if shared is self.root:
            return
        way, node = [], shared
        while node is not self.root:
            way.append((node.edit, node.at, node.role))
            node = node.up
        self.taken.extend(reversed(way))
        shared.up.refs -= 1
        shared.up, self.root = None, shared

    @staticmethod
    def _up(node: _Node, depth: int) -> _Node:
        while node.depth > depth:
            node = node.up
        return node

    def end(self, state: int | None) -> int:
        """Emit the rest: to ``state``, or (none) to the best accepted end.  The cost."""
        if state is None:
            ends = []
            for s, (cost, leaf) in self.best.items():
                for role in TAIL[s]:
                    leaf, cost = _Node(leaf, "I", None, ROLE[role]), cost + INSERT
                ends.append((cost, leaf))
            cost, leaf = ends[0]
            for c, n in ends[1:]:
                if c < cost or (c == cost and _less(n, leaf)):
                    cost, leaf = c, n
        else:
            cost, leaf = self.best[state]
        way = []
        while leaf is not self.root:
            way.append((leaf.edit, leaf.at, leaf.role))
            leaf = leaf.up
        self.taken.extend(reversed(way))
        return cost

    def order(self) -> list[int]:
        """The states by their survivors' strings."""
        left, out = list(self.best), []
        while left:
            first = left[0]
            for s in left[1:]:
                if _less(self.best[s][1], self.best[first][1]):
                    first = s
            out.append(first)
            left.remove(first)
        return out


ROWS = "c string, part long, seq long, initial string, fault string"
BLOCK = "c string, part long, costs array<int>, orders array<int>, first string, last string"
PLAN = "c string, part long, begin int, finish int, seam long"
EDITS = "c string, part long, step int, edits string, places array<long>, roles array<string>, cost long, illegal long"


def _blocks(batches):
    """``(key, rows)`` of each block of sorted rows, the rows as an iterator that must be used up."""
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)))

    source, ahead = rows(), []

    def block(key):
        yield ahead.pop()
        for row in source:
            if row[:2] != key:
                ahead.append(row)
                return
            yield row

    ahead.extend(r for r in [next(source, None)] if r is not None)
    while ahead:
        key = ahead[0][:2]
        yield key, block(key)


def _block_costs(batches):
    """For each block of a cut conversation: costs from state to state, and the ends' order by their strings."""
    for (c, part), rows in _blocks(batches):
        runs = [Viterbi(s) for s in STATES]
        first = last = None
        for _, _, seq, initial, fault, *_ in rows:
            first, last = initial if first is None else first, initial
            for run in runs:
                run.put(seq, initial, fault in ("blank", "duplicate"), fault == "truncated")
                run.taken.clear()
        costs = [run.best[e][0] if e in run.best else -1 for run in runs for e in STATES]
        orders = [o.index(e) if e in o else -1 for o in [run.order() for run in runs] for e in STATES]
        yield pa.RecordBatch.from_pylist([{"c": c, "part": part, "costs": costs, "orders": orders, "first": first, "last": last}],
                                         schema=pa.schema([("c", pa.string()), ("part", pa.int64()), ("costs", pa.list_(pa.int32())),
                                                           ("orders", pa.list_(pa.int32())), ("first", pa.string()), ("last", pa.string())]))


def _chain(group: pa.Table) -> pa.Table:
    """The first and last state of each block of one cut conversation (a small row for each block)."""
    blocks = sorted(group.to_pylist(), key=lambda b: b["part"])
    now, back = {EMPTY: (0, 0)}, []                        # state: cost, rank of its string
    for b in blocks:
        took = {}
        for s, (cost, rank) in now.items():
            for e in STATES:
                if (paid := b["costs"][4 * s + e]) >= 0:
                    took[e] = min(took.get(e, (inf,)), (cost + paid, rank, b["orders"][4 * s + e], s))
        lost = [s for s in took if any(took[s][0] > took[t][0] + SWITCH[t][s] for t in took if t != s)]
        took = {e: x for e, x in took.items() if e not in lost}
        by_string = sorted(took, key=lambda e: took[e][1:3])
        back.append({e: x[3] for e, x in took.items()})
        now = {e: (took[e][0], by_string.index(e)) for e in took}
    finish = min(now, key=lambda e: (now[e][0] + INSERT * len(TAIL[e]), now[e][1]))
    out, after = [], None
    for i in range(len(blocks) - 1, -1, -1):
        b, begin = blocks[i], back[i][finish]
        seam = int(after is not None and b["last"] + after not in LEGAL)
        out.append({"c": b["c"], "part": b["part"], "begin": begin, "finish": -1 if i == len(blocks) - 1 else finish, "seam": seam})
        finish, after = begin, b["first"]
    return pa.Table.from_pylist(out, schema=pa.schema([("c", pa.string()), ("part", pa.int64()), ("begin", pa.int32()),
                                                       ("finish", pa.int32()), ("seam", pa.int64())]))


def _edits(batches):
    """The edits of each block, in pieces as they are settled; the last piece has the block's cost and illegal neighbours."""
    schema = pa.schema([("c", pa.string()), ("part", pa.int64()), ("step", pa.int32()), ("edits", pa.string()), ("places", pa.list_(pa.int64())),
                        ("roles", pa.list_(pa.string())), ("cost", pa.int64()), ("illegal", pa.int64())])
    out = []

    def piece(c, part, step, taken, cost, illegal):
        out.append({"c": c, "part": part, "step": step, "edits": "".join(e for e, _, _ in taken), "places": [at for _, at, _ in taken],
                    "roles": [r for _, _, r in taken], "cost": cost, "illegal": illegal})

    for (c, part), rows in _blocks(batches):
        run, step, illegal, before = None, 0, 0, None
        for _, _, seq, initial, fault, begin, finish, seam in rows:
            if run is None:
                run, end, illegal = Viterbi(begin), None if finish < 0 else finish, seam
            illegal += before is not None and before + initial not in LEGAL
            before = initial
            run.put(seq, initial, fault in ("blank", "duplicate"), fault == "truncated")
            if len(run.taken) >= CHUNK:
                piece(c, part, step, run.taken, 0, 0)
                step, run.taken = step + 1, []
        cost = run.end(end)
        piece(c, part, step, run.taken, cost, illegal)
        if sum(len(x["edits"]) for x in out) >= CHUNK:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out.clear()
    yield pa.RecordBatch.from_pylist(out, schema=schema)


def key_of(name: str) -> Column:
    """A conversation's id as text, null as none."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows in order with their faults, as a stored table: ``c, conv, turn, role, text, seq, part, initial, fault``."""
    spark = conversations.sparkSession
    rows = conversations.select(
        key_of(conv).alias("c"), F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" ")).alias("text"))
    parts = max(spark.sparkContext.defaultParallelism, -(-conversations.count() // BLOCK_ROWS))
    order = [F.col("c"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    placed = stored(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                    .withColumn("seq", F.monotonically_increasing_id())
                    .withColumn("same", F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)), "turns")
    earlier = placed.groupBy(F.col("c").alias("c2"), F.col("same").alias("same2")).agg(F.min("seq").alias("first"), F.count("*").alias("n")).filter("n > 1")
    judged = placed.join(earlier, (F.col("c") == F.col("c2")) & (F.col("same") == F.col("same2")), "left")
    fault = (F.when(~F.col("text").rlike(WORD), "blank").when(F.col("seq") > F.col("first"), "duplicate")
             .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated"))
    return stored(judged.select("c", "conv", "turn", "role", "text", "seq", F.shiftright("seq", SHIFT).alias("part"),
                                F.substring("role", 1, 1).alias("initial"), fault.alias("fault")), "faults")


def edits(rows: DataFrame) -> DataFrame:
    """The cheapest edits of ``turns``: ``c, part, step, edits, places, roles, cost, illegal``, in order of part and step.  A place is
    a row's ``seq`` (null: an inserted row), a role the new one of a row inserted or given another."""
    bounded_batches(rows.sparkSession)
    narrow = rows.select("c", "part", "seq", "initial", "fault")
    cut = narrow.groupBy("c").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low < high").select("c")
    blocks = (narrow.join(F.broadcast(cut), "c").repartition("c", "part").sortWithinPartitions("c", "part", "seq")   # at most one for each range
              .mapInArrow(_block_costs, BLOCK))
    plan = stored(blocks.groupBy("c").applyInArrow(_chain, PLAN), "plan")
    planned = narrow.join(F.broadcast(plan), ["c", "part"], "left").select(
        "c", "part", "seq", "initial", "fault", F.coalesce("begin", F.lit(EMPTY)), F.coalesce("finish", F.lit(-1)), F.coalesce("seam", F.lit(0)))
    return planned.repartition("c", "part").sortWithinPartitions("c", "part", "seq").mapInArrow(_edits, EDITS)


def repaired(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """The repaired rows: ``c, part, step, nth, role, text`` in order of ``part, step, nth``."""
    steps = (changes.select("c", "part", "step", "edits", F.posexplode(F.arrays_zip("places", "roles")))
             .select("c", "part", "step", F.col("pos").alias("nth"), F.col("col.places").alias("place"), F.col("col.roles").alias("new"),
                     F.expr("substring(edits, pos + 1, 1)").alias("edit")).filter("edit <> 'D'"))
    texts = rows.select(F.col("seq").alias("place"), "role", "text")
    given = steps.filter("place IS NOT NULL").join(texts, "place").select("c", "part", "step", "nth", F.coalesce("new", "role").alias("role"), "text")
    added = steps.filter("place IS NULL").select("c", "part", "step", "nth", F.col("new").alias("role"), F.lit("").alias("text"))
    return given.unionByName(added)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults made on purpose, by a hash of id and turn: dropped, emptied, without marks, repeated, or of a user."""
    blank = F.lit(" ")
    draw = F.pmod(F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank)).cast("binary")), F.lit(20))
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    return (conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), draw.alias("draw")).filter("draw <> 0")
            .select("conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                    F.explode(F.array_repeat(F.lit(0), F.when(F.col("draw") == 3, 2).otherwise(1))).alias("copy"))
            .drop("copy"))


def repair_report(conversations: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row for each conversation (and each of ``ids.conv_id``, if given): ``conv_id``, counts of faults, ``cost``, ``audit``
    (its string of edits) and ``repaired_sha256`` (of its repaired ``role:text`` lines)."""
    rows = turns(conversations)
    changes = stored(edits(rows), "edits")
    every = (conversations if ids is None else ids).select(F.col("conv_id").cast("long").alias("conv_id"), key_of("conv_id").alias("c")).distinct()
    spread = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
    counts = rows.groupBy("c").agg(F.coalesce(spread, F.lit(0)).alias("gaps"), *[
        F.sum(F.when(F.col("fault") == kind, 1).otherwise(0)).alias(kind) for kind in ("blank", "duplicate", "truncated")])
    ways = changes.groupBy("c").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "step", "edits"))), lambda x: x["edits"]), "").alias("audit"))
    line = F.concat("role", F.lit(":"), "text").alias("line")
    texts = (repaired(rows, changes).select("c", F.struct("part", "step", "nth", line).alias("at")).groupBy("c")
             .agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list("at")), lambda x: x["line"]), "\n"), 256).alias("repaired_sha256")))
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name)
    return (every.join(counts, "c", "left").join(ways, "c", "left").join(texts, "c", "left")
            .select("conv_id", *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                    F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))
