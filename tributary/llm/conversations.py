"""Conversations repaired by the cheapest edits, with an audit of them.

The roles of a conversation should read ``(s?(ua)+)?`` by their initials. Rows are kept (K), given another role (R) or deleted (D), and empty
rows are inserted (I), at the least cost; of equally cheap audits the ASCII-least stays. The programme runs over the rows with one best
audit for each state of that pattern. Audits share their prefixes: an edit is a node linked to the one before, with ancestors at the
powers of two and a rolling hash of the whole prefix, so that two audits of equal cost are compared by a search for their longest
common prefix instead of letter by letter.

A conversation of any length is cut into segments by ranges of its turns. Each segment is solved from every state it may begin in, and
a conversation's segments, which are small, are then put together by the same programme with whole segments as edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import mapped, same, stored

BLANKS = " \t\n\x0b\f\r"
SEGMENT = 4096  # rows of a conversation solved at a time
REMEMBERED = 20_000  # solved segments of up to SHORT rows a worker keeps
SHORT = 16
LONG = 2**63 - 1

START, SYSTEM, USER, ASSISTANT = range(4)
KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
NEXT = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}  # what a new or changed row leads to
ENDS = (START, ASSISTANT)
LEGAL = {"su", "ua", "au"}


@dataclass(frozen=True)
class Costs:
    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3


class Audits:
    """Edit prefixes as linked nodes; node 0 is the empty one.

    Of each node: the edit it adds, its depth, a rolling hash of its prefix, and its ancestors 1, 2, 4, ... nodes above.
    """

    BASE, MODULUS = 1_000_003, 2**61 - 1

    def __init__(self) -> None:
        self.edge, self.depth, self.hash, self.up = [""], [0], [0], [[]]

    def add(self, node: int, edge: str) -> int:
        value = self.hash[node]
        for letter in edge:
            value = (value * self.BASE + ord(letter)) % self.MODULUS
        above = [node]
        while len(self.up[above[-1]]) >= len(above):
            above.append(self.up[above[-1]][len(above) - 1])
        self.edge.append(edge)
        self.depth.append(self.depth[node] + 1)
        self.hash.append(value)
        self.up.append(above)
        return len(self.edge) - 1

    def ancestor(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            node = self.up[node][(self.depth[node] - depth).bit_length() - 1]
        return node

    def tail(self, node: int, depth: int = 0) -> str:
        """The edits of a prefix after its first ``depth`` nodes."""
        edges = []
        while self.depth[node] > depth:
            edges.append(self.edge[node])
            node = self.up[node][0]
        return "".join(reversed(edges))

    def equal(self, a: int, b: int) -> bool:
        """Whether two prefixes of one depth and hash have the same edits, up to where they share their nodes."""
        while a != b and self.edge[a] == self.edge[b]:
            a, b = self.up[a][0], self.up[b][0]
        return a == b

    def less(self, a: int, b: int) -> bool:
        """Whether one audit is before another, by their longest common prefix."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.hash[x] != self.hash[y]:
            for k in reversed(range(len(self.up[x]))):
                if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                    x, y = self.up[x][k], self.up[y][k]
            depth = self.depth[x] - 1
            x, y = self.up[x][0], self.up[y][0]
        if not self.equal(x, y):  # equal hashes of different edits, or the same edits dealt otherwise
            depth = 0
        return self.tail(a, depth) < self.tail(b, depth)


class Best:
    """The cheapest, then ASCII-least audit of each state."""

    def __init__(self, audits: Audits, start: dict[int, tuple[int, int]]):
        self.audits, self.at = audits, dict(start)

    def offer(self, state: int, cost: int, node: int, edge: str) -> bool:
        held = self.at.get(state)
        if held and held[0] < cost:
            return False
        new = self.audits.add(node, edge)
        if held and held[0] == cost and not self.audits.less(new, held[1]):
            return False
        self.at[state] = cost, new
        return True

    def insert(self, costs: Costs) -> None:
        """Rows inserted here, as long as that makes a state cheaper."""
        changed = set(self.at)
        while changed:
            found = set()
            for state in sorted(changed):
                cost, node = self.at[state]
                if self.offer(NEXT[state], cost + costs.insert, node, "I"):
                    found.add(NEXT[state])
            changed = found


Step = tuple[str, int, bool]  # the role's initial, or none of a row to be deleted; its copies; truncated


def solve(steps: tuple[Step, ...], start: int, costs: Costs) -> dict[int, tuple[int, str]]:
    """Cost and audit of the rows by the state they end in, begun in ``start``; insertions may stand before and after."""
    audits = Audits()
    best = Best(audits, {start: (0, 0)})
    best.insert(costs)
    for initial, copies, truncated in steps:
        before, best = best.at, Best(audits, {})
        for state, (cost, node) in before.items():
            best.offer(state, cost + costs.delete * copies, node, "D" * copies)
            if initial:
                cost += costs.truncated * truncated
                if (state, initial) in KEEP:
                    best.offer(KEEP[state, initial], cost, node, "K")
                best.offer(NEXT[state], cost + costs.rerole, node, "R")
        best.insert(costs)
    return {state: (cost, audits.tail(node)) for state, (cost, node) in best.at.items()}


_solved: dict[tuple, dict[int, tuple[int, str]]] = {}


def remembered(steps: tuple[Step, ...], start: int, costs: Costs) -> dict[int, tuple[int, str]]:
    """``solve``, of short segments once for all that are alike."""
    if len(steps) > SHORT:
        return solve(steps, start, costs)
    key = steps, start, costs
    if key not in _solved:
        if len(_solved) >= REMEMBERED:
            _solved.clear()
        _solved[key] = solve(steps, start, costs)
    return _solved[key]


SEGMENTS = (
    "conv_id long, from_turn long, from_digest binary, low_turn long, high_turn long, last_turn long, turns long, blank long, duplicate long, "
    "truncated long, illegal long, first string, last string, solved array<struct<start:int,state:int,cost:long,audit:string>>"
)


class Segment:
    """Counts and steps of consecutive rows of one conversation."""

    def __init__(self, row: dict, starts: tuple[int, ...]):
        self.starts, self.first, self.steps = starts, row["initial"], []
        self.out = {"conv_id": row["conv_id"], "from_turn": row["turn"], "from_digest": row["digest"], "low_turn": None, "high_turn": None}
        self.out |= dict.fromkeys(("turns", "blank", "duplicate", "truncated", "illegal"), 0)
        self.last = self.last_turn = None

    def add(self, row: dict) -> None:
        out, turn, n, initial = self.out, row["turn"], row["copies"], row["initial"]
        if turn is not None:
            out["turns"] += turn != self.last_turn
            out["low_turn"] = turn if out["low_turn"] is None else out["low_turn"]
            out["high_turn"] = turn
        self.last_turn = turn
        out["illegal"] += n - 1 + (self.last is not None and self.last + initial not in LEGAL)
        self.last = initial
        if row["blank"]:
            out["blank"] += n
        else:
            fresh = int(row["fresh"])
            out["duplicate"] += n - fresh
            out["truncated"] += fresh and row["truncated"]
            if fresh:
                # An initial that fits no state is one more letter.
                self.steps.append((initial if initial in ("s", "u", "a") else "?", 1, row["truncated"]))
                n -= 1
        if n:
            self.steps.append(("", n, False))

    def done(self, costs: Costs) -> dict:
        steps = tuple(self.steps)
        solved = [
            {"start": start, "state": state, "cost": cost, "audit": audit}
            for start in self.starts
            for state, (cost, audit) in remembered(steps, start, costs).items()
        ]
        return self.out | {"last_turn": self.last_turn, "first": self.first, "last": self.last, "solved": solved}


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


SOLVED = pa.list_(pa.struct([("start", pa.int32()), ("state", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "int": pa.int32()}


def _schema(ddl: str) -> pa.Schema:
    parts = [part.split(" ", 1) for part in ddl.split(", ")]
    return pa.schema([(name, KINDS.get(kind, SOLVED)) for name, kind in parts])


def segment_batches(batches: Iterator[pa.RecordBatch], costs: Costs, size: int) -> Iterator[pa.RecordBatch]:
    """Rows in order -> SEGMENTS. Only the first conversation of a task may have begun before."""
    schema, held, n = _schema(SEGMENTS), None, 0
    starts: tuple[int, ...] = (START, SYSTEM, USER, ASSISTANT)
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if held is not None and (held.out["conv_id"] != row["conv_id"] or n >= size):
                out.append(held.done(costs))
                starts = (START, SYSTEM, USER, ASSISTANT) if held.out["conv_id"] == row["conv_id"] else (START,)
                held = None
            if held is None:
                held, n = Segment(row, starts), 0
            held.add(row)
            n += 1
        if out:
            yield _batch(out, schema)
    if held is not None:
        yield _batch([held.done(costs)], schema)


REPAIRS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class Repair:
    """Segments of one conversation, put together as they come."""

    def __init__(self, conv_id: int | None):
        self.audits = Audits()
        self.best = {START: (0, 0)}
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.conv_id, self.low, self.high, self.turns, self.last, self.last_turn = conv_id, None, None, 0, None, None

    def add(self, segment: dict) -> None:
        for name in self.counts:
            self.counts[name] += segment[name]
        if self.last is not None:
            self.counts["illegal"] += self.last + segment["first"] not in LEGAL
        if segment["turns"]:
            self.turns += segment["turns"] - (self.turns > 0 and segment["from_turn"] == self.last_turn)
            self.low = segment["low_turn"] if self.low is None else self.low
            self.high = segment["high_turn"]
        self.last, self.last_turn = segment["last"], segment["last_turn"]
        best = Best(self.audits, {})
        for way in segment["solved"]:
            if way["start"] in self.best:
                cost, node = self.best[way["start"]]
                best.offer(way["state"], cost + way["cost"], node, way["audit"])
        self.best = best.at

    def done(self) -> dict:
        end = Best(self.audits, {})
        for state in ENDS:
            if state in self.best:
                end.offer(START, *self.best[state], "")
        cost, node = end.at[START]
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, LONG)
        return {"conv_id": self.conv_id, "gaps": gaps, "cost": cost, "audit": self.audits.tail(node)} | self.counts


def repair_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SEGMENTS in order -> REPAIRS."""
    schema, held = _schema(REPAIRS), None
    for batch in batches:
        out = []
        for segment in batch.to_pylist():
            if held is not None and held.conv_id != segment["conv_id"]:
                out.append(held.done())
                held = None
            held = held or Repair(segment["conv_id"])
            held.add(segment)
        if out:
            yield _batch(out, schema)
    if held is not None:
        yield _batch([held.done()], schema)


class Edited:
    """The rows of one conversation after the edits of its audit, as they come."""

    def __init__(self, conv_id: int | None, audit: str):
        self.conv_id, self.audit, self.at, self.state = conv_id, audit, 0, START

    def _moved(self) -> str:
        self.state = NEXT[self.state]
        return "user" if self.state == USER else "assistant"

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit.startswith("I", self.at):
            self.at += 1
            yield self._moved(), ""

    def edited(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self.state = KEEP[self.state, role[:1]]
            yield role, text
        elif edit == "R":
            yield self._moved(), text


def edited_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[tuple[str, str]], bool]]:
    """conv_id, kind, role, text in order, the audit as the text of kind 0 -> conv_id, some of its edited rows, and whether they are the last."""
    held: Edited | None = None
    for batch in batches:
        for conv_id, kind, role, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if kind == 0:
                if held is not None:
                    yield held.conv_id, list(held.inserted()), True
                held = Edited(conv_id, text)
            else:
                yield conv_id, list(held.edited(role, text)), False
    if held is not None:
        yield held.conv_id, list(held.inserted()), True


def digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows for ``edited_rows`` -> conv_id and the digest of its rows, ``role:text`` on lines of their own."""
    digest, first, ids, found = hashlib.sha256(), True, [], []
    names = ["conv_id", "repaired_sha256"]
    for conv_id, rows, last in edited_rows(batches):
        for role, text in rows:
            digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
            first = False
        if last:
            ids.append(conv_id)
            found.append(digest.hexdigest())
            digest, first = hashlib.sha256(), True
            if len(ids) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found)], names=names)
                ids, found = [], []
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found)], names=names)


def row_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows for ``edited_rows`` -> conv_id, place, role, text."""
    out, place, size = [], 0, 0
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    for conv_id, rows, last in edited_rows(batches):
        for role, text in rows:
            out.append({"conv_id": conv_id, "place": place, "role": role, "text": text})
            place, size = place + 1, size + len(text)
        place = 0 if last else place
        if len(out) >= 4096 or size > 4_000_000:
            yield _batch(out, schema)
            out, size = [], 0
    if out:
        yield _batch(out, schema)


def _rows(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text without nulls in the latter two, and a digest of both."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("role", "text"))
    columns = F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")
    content = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return rows.select(*columns).withColumn("digest", F.unhex(F.sha2(content, 256)))


def damage(rows: DataFrame) -> DataFrame:
    """Rows with faults put in by a hash of conversation and turn: dropped, emptied, cut, repeated, or of another role."""
    rows = _rows(rows).drop("digest")
    ids = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn"))
    rows = rows.withColumn("fault", F.crc32(F.concat_ws(":", *ids)) % 20).where("fault != 0")
    text = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def find_repairs(rows: DataFrame, costs: Costs = Costs(), segment: int = SEGMENT) -> DataFrame:
    """One row per conv_id: gaps, blank, duplicate, truncated, illegal, cost and audit.

    Rows of a conversation are taken by turn, null turns first, and those of one turn by a digest of role and text, so that
    equal rows are next to each other. A null conv_id is a conversation of its own; a null role or text is a blank. Gaps beyond
    a long are its largest value. Only ids, digests and flags are moved; copies of a row are counted before that. Other columns are not read.
    """
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    flags = (
        F.substring("role", 1, 1).alias("initial"),
        (trimmed == "").alias("blank"),
        (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )
    by = ["conv_id", "turn", "digest", "initial", "blank", "truncated"]
    each = _rows(rows).select("conv_id", "turn", "digest", *flags).groupBy(*by).agg(F.count(F.lit(1)).alias("copies"))
    each = stored(each, "turns")
    firsts = each.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d"))
    firsts = firsts.agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    told = each.join(firsts, same(F.col("conv_id"), F.col("c")) & (F.col("digest") == F.col("d")), "left")
    fresh = F.coalesce(F.col("first.turn").eqNullSafe(F.col("turn")) | F.col("n").isNull(), F.lit(True))
    told = stored(told.select(*by, "copies", fresh.alias("fresh")), "told")

    order = ["conv_id", "turn", "digest"]
    ranged = told.repartitionByRange(*order).sortWithinPartitions(*order)
    segments = stored(mapped(ranged, segment_batches, SEGMENTS, costs, segment), "segments")
    together = segments.repartition("conv_id").sortWithinPartitions("conv_id", "from_turn", "from_digest")
    return mapped(together, repair_batches, REPAIRS)


def _with_audits(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """The rows behind the audit of their conversation."""
    none = F.lit(None)
    audits = repairs.select(
        "conv_id", F.lit(0).alias("kind"), F.lit("").alias("role"), F.col("audit").alias("text"), none.cast("long").alias("turn"), none.cast("binary").alias("digest")
    )
    both = audits.union(_rows(rows).select("conv_id", F.lit(1).alias("kind"), "role", "text", "turn", "digest"))
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "digest")
    return ordered.select("conv_id", "kind", "role", "text")


def repaired_rows(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """conv_id, place, role, text: the conversations after the edits of ``find_repairs``; one without rows left has none."""
    return mapped(_with_audits(rows, repairs), row_batches, "conv_id long, place long, role string, text string")


def repaired_digests(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256. A digest is taken in one go, so a conversation's rows pass one task, as a stream."""
    return mapped(_with_audits(rows, repairs), digest_batches, "conv_id long, repaired_sha256 string")


def audit_conversations(original: DataFrame, damaged: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """One row per conv_id of ``original``: repairs and digest of its rows in ``damaged``; without any, zeros, no audit and the digest of no text."""
    repairs = stored(find_repairs(damaged, costs), "repairs")
    found = repairs.join(repaired_digests(damaged, repairs).withColumnRenamed("conv_id", "of"), F.expr("conv_id <=> of"), "left").drop("of")
    ids = original.select(F.col("conv_id").cast("long").alias("id")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return ids.join(found, same(F.col("id"), F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"),
        *[F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
