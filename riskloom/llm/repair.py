"""Repairing the turn structure of conversations by depth-first branch and bound.

Rows of a conversation are edited until their roles' initials read ``(s?(ua)+)?``: an
optional system turn, then user and assistant in turns. Keeping a row costs 0, giving it
the role user or assistant 1, deleting it 2, inserting an empty turn 5, and a truncated row
that is not deleted 5 more. Blank and repeated rows must go. The audit is the edits'
initials in order (D, I, K, R); of the cheapest edits the audit least in ASCII is taken.

The search walks positions and grammar states with an explicit stack. A prefix is dropped
if its cost and a lower bound of the suffix pass the incumbent, if they equal it and the
audit is no less, or if the dominance table of its node (position, state) has a prefix
that is as good. The bound is the cost of the rest under a relaxed grammar in which user
and assistant only alternate, system turns are free and any end is allowed. Prefixes of a
node that cost the same are never prefixes of each other (they would differ by inserts
alone), so the better one stays better whatever follows.

Rows are range-partitioned by (conversation, turn, role, text) and cut into segments of at
most ``SEGMENT`` rows or ``SEGMENT_BYTES`` characters. Conversations that are one segment,
inside one partition, are repaired at once. Longer ones are never put together: each
segment is searched from every state to every state, the few results a segment are chained
in order, and the hash of the repaired text runs over the segments as a stream. What one
task holds of a conversation is then its audits (some 16 characters a row), not its texts;
the audit column itself needs one character a row.

Rows are taken by turn (NULL first), then role, then text. Repeated rows stay side by
side, so all but the first are duplicates. NULL roles and texts are one space, which makes
a text blank; a role is known by its first character. Rows without conversation id are one
conversation. A conversation without rows is asked for by ``ids`` only; it has zeros, an
empty audit and the hash of the empty string. Only the four columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from riskloom.llm.common import land, session

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SEGMENT = 256
SEGMENT_BYTES = 1 << 22

# grammar states: nothing yet, after the system turn, after user, after assistant
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
# the state after the next user or assistant turn; there is one choice in each
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ACCEPTED = (START, ASSISTANT)
NAMES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = {"u": USER, "a": ASSISTANT}
GONE = ("blank", "duplicate")

SEGMENTS = (
    "conv_id long, part int, seg int, whole boolean, rows array<struct<turn: bigint, "
    "role: string, text: string>>"
)
RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string"
)

_WORD = re.compile(r"[^\x20\x09-\x0D]")
_ENDED = re.compile(r"[.!?][\x20\x09-\x0D]*\Z")


# --- the search ----------------------------------------------------------


def kept_as(state: int, initial: str) -> int | None:
    """The state after a kept row, or None where the grammar has no such turn."""
    if initial == "s":
        return SYSTEM if state == START else None
    return NEXT[state] if INITIALS.get(initial) == NEXT[state] else None


def suffix_bounds(rows: list[tuple[str, str]]) -> list[tuple[int, int]]:
    """Least cost of each suffix under the relaxed grammar, where a user turn is due next
    and where an assistant turn is."""
    bounds = [(0, 0)]
    for initial, fault in reversed(rows):
        due_user, due_assistant = bounds[-1]
        due = {USER: due_user, ASSISTANT: due_assistant}
        best = {}
        for turn, other in ((USER, ASSISTANT), (ASSISTANT, USER)):
            options = [due[turn] + DELETE]
            if fault not in GONE:
                stay = TRUNCATED if fault == "truncated" else 0
                if initial == "s":
                    options.append(due[turn] + stay)
                role = 0 if INITIALS.get(initial) == turn else REROLE
                options.append(due[other] + stay + role)
            best[turn] = min(options)
        u, a = best[USER], best[ASSISTANT]
        bounds.append((min(u, a + INSERT), min(a, u + INSERT)))
    bounds.reverse()
    return bounds


def search(
    rows: list[tuple[str, str]], start: int = START, ends: tuple[int, ...] = ACCEPTED
) -> tuple[int, str] | None:
    """The cheapest (cost, audit) from ``start`` to one of ``ends``; None if none is.

    ``rows`` are (role initial, fault); fault is "" for a sound row.
    """
    bounds, n = suffix_bounds(rows), len(rows)
    best: tuple[int, str] | None = None
    tables: list[dict[int, tuple[int, str]]] = [{} for _ in range(n + 1)]
    stack = [(0, start, 0, "")]
    while stack:
        at, state, cost, audit = stack.pop()
        floor = cost + bounds[at][state == USER]
        if best and (floor > best[0] or (floor == best[0] and audit >= best[1])):
            continue
        known = tables[at].get(state)
        if known and known <= (cost, audit):
            continue
        tables[at][state] = (cost, audit)
        if at == n and state in ends and (best is None or (cost, audit) < best):
            best = (cost, audit)
        children = [(at, NEXT[state], cost + INSERT, audit + "I")]
        if at < n:
            initial, fault = rows[at]
            children.append((at + 1, state, cost + DELETE, audit + "D"))
            if fault not in GONE:
                stay = cost + (TRUNCATED if fault == "truncated" else 0)
                children.append((at + 1, NEXT[state], stay + REROLE, audit + "R"))
                after = kept_as(state, initial)
                if after is not None:
                    children.append((at + 1, after, stay, audit + "K"))
        # the most promising child is popped first
        children.sort(key=lambda c: (c[2] + bounds[c[0]][c[1] == USER], c[3]), reverse=True)
        stack += children
    return best


def apply_audit(rows: list[tuple[str, str]], audit: str, state: int) -> tuple[list[str], int]:
    """The repaired ``role:text`` lines of (role, text) rows, and the state they end in."""
    lines, left = [], iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(left)
        if edit == "D":
            continue
        if edit == "K":
            state = SYSTEM if role[:1] == "s" else NEXT[state]
        else:
            state = NEXT[state]
            role = NAMES[state]
        lines.append(f"{role}:{text}")
    return lines, state


# --- facts of rows -------------------------------------------------------


def fault_of(text: str, repeated: bool) -> str:
    if not _WORD.search(text):
        return "blank"
    if repeated:
        return "duplicate"
    return "" if _ENDED.search(text) else "truncated"


@dataclass
class Facts:
    """What is counted over rows in order; parts of a conversation can be joined."""

    faults: dict[str, int] = field(
        default_factory=lambda: {"blank": 0, "duplicate": 0, "truncated": 0}
    )
    illegal: int = 0
    turns: int = 0
    low: int | None = None
    high: int | None = None
    first: str | None = None
    last: str | None = None

    def add(self, turn: int | None, initial: str, fault: str) -> None:
        one = Facts(turns=int(turn is not None), low=turn, high=turn, first=initial, last=initial)
        if fault:
            one.faults[fault] += 1
        self.join(one)

    def join(self, other: Facts) -> None:
        """Add the rows of ``other``, which come after these."""
        for fault, n in other.faults.items():
            self.faults[fault] += n
        self.illegal += other.illegal
        if self.last is not None and other.first is not None:
            self.illegal += self.last + other.first not in ("su", "ua", "au")
        self.first = other.first if self.first is None else self.first
        self.last = self.last if other.last is None else other.last
        if other.low is not None:
            # turns come in order: only the one at the seam may be counted twice
            self.turns += other.turns - (self.high == other.low)
            self.low, self.high = other.low if self.low is None else self.low, other.high

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns

    def row(self, conv_id: int | None, found: tuple[int, str], digest: str) -> tuple:
        counts = [self.faults[f] for f in ("blank", "duplicate", "truncated")]
        return (conv_id, self.gaps, *counts, self.illegal, *found, digest)


def _whole(conv_id: int | None, rows: list[dict]) -> tuple:
    """The result of a conversation that is in one piece."""
    facts, seen, plain = Facts(), set(), []
    for r in rows:
        same = (r["role"], r["text"])
        fault = fault_of(r["text"], same in seen)
        seen.add(same)
        facts.add(r["turn"], r["role"][:1], fault)
        plain.append((r["role"][:1], fault))
    found = search(plain)
    lines, _ = apply_audit([(r["role"], r["text"]) for r in rows], found[1], START)
    return facts.row(conv_id, found, _sha("\n".join(lines)))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


# --- segments ------------------------------------------------------------


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 500) -> Iterator[pa.RecordBatch]:
    """Rows in Arrow batches; the last field's size also ends a batch."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1])
        if len(held) >= most or size >= SEGMENT:
            yield _record(held, schema)
            held, size = [], 0
    if held:
        yield _record(held, schema)


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _cut(rows_most: int, bytes_most: int):
    """Sorted rows to segments; ``whole`` says that no other segment has rows of it."""
    schema = _arrow(SEGMENTS)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        part, held, size, seg = -1, [], 0, 0
        conv, first = None, True
        for batch in batches:
            for r in batch.to_pylist():
                part = r["part"]
                if held and r["conv_id"] != conv:
                    # the first and the last conversation of a partition may go on elsewhere
                    yield conv, part, seg, not first and seg == 0, held
                    held, size, seg, first = [], 0, 0, False
                elif held and (len(held) >= rows_most or size >= bytes_most):
                    yield conv, part, seg, False, held
                    held, size, seg = [], 0, seg + 1
                conv = r["conv_id"]
                held.append({k: r[k] for k in ("turn", "role", "text")})
                size += len(r["role"]) + len(r["text"])
        if held:
            yield conv, part, seg, False, held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(segments(batches), schema)

    return run


def segmented(rows: DataFrame, rows_most: int, bytes_most: int) -> DataFrame:
    """Rows in order, cut; a conversation may span partitions and so segments."""
    spark = rows.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # copies are dealt by a number of their own, so that no value need be in one partition
    ready = rows.withColumn("copy", F.monotonically_increasing_id())
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "copy"]
    sorted_rows = (
        ready.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
    )
    chosen = sorted_rows.select("conv_id", "part", "turn", "role", "text")
    return land(chosen.mapInArrow(_cut(rows_most, bytes_most), SEGMENTS), "conversations")


def _repair_whole():
    schema = _arrow(RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_whole(r["conv_id"], r["rows"]) for r in batch.to_pylist()]
            if rows:
                yield _record(rows, schema)

    return run


# --- conversations of several segments -----------------------------------

PLACE = ["conv_id", "part", "seg"]
SOLVED = (
    "conv_id long, part int, seg int, faults array<long>, illegal long, turns long, low long, "
    "high long, first string, last string, costs array<long>, audits array<string>"
)
CHAINED = RESULT.replace("repaired_sha256 string", "picks array<int>, parts array<int>, segs array<int>")


def _first_rows(parts: DataFrame) -> DataFrame:
    """Each segment with the indexes of its rows that no earlier row equals.

    Equal rows fold to the place of the first before any shuffle, whatever their number.
    """
    each = parts.select(*PLACE, F.posexplode("rows").alias("i", "r"))
    # with a length before it, no role and text read like another pair
    same = F.sha2(
        F.concat(F.char_length("r.role"), F.lit(":"), F.col("r.role"), F.col("r.text")).cast("binary"), 256
    )
    first = each.groupBy("conv_id", same.alias("same")).agg(
        F.min(F.struct("part", "seg", "i")).alias("at")
    )
    by_segment = first.groupBy(
        "conv_id", F.col("at.part").alias("part"), F.col("at.seg").alias("seg")
    ).agg(F.collect_list("at.i").alias("firsts"))
    here = [F.col(f"s.{c}").eqNullSafe(F.col(f"f.{c}")) for c in PLACE]
    joined = parts.alias("s").join(by_segment.alias("f"), here, "left")
    return joined.select("s.*", F.coalesce("f.firsts", F.array().cast("array<int>")).alias("firsts"))


def _solve():
    """A segment's facts and the best way from every state to every state."""
    schema = _arrow(SOLVED)

    def solved(r: dict) -> tuple:
        facts, firsts, plain = Facts(), set(r["firsts"]), []
        for i, row in enumerate(r["rows"]):
            fault = fault_of(row["text"], i not in firsts)
            facts.add(row["turn"], row["role"][:1], fault)
            plain.append((row["role"][:1], fault))
        ways = [search(plain, a, (b,)) for a in STATES for b in STATES]
        return (
            *(r[c] for c in PLACE),
            list(facts.faults.values()),
            facts.illegal,
            facts.turns,
            facts.low,
            facts.high,
            facts.first,
            facts.last,
            [w[0] if w else None for w in ways],
            [w[1] if w else None for w in ways],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield _record([solved(r)], schema)

    return run


class Chain:
    """The best ways to each state over the segments so far.

    A way is its cost and the segments' audits as a linked list, newest first. Two ways to
    a state are compared by cost, and by the text of the audits only where costs agree.
    """

    def __init__(self):
        self.facts = Facts()
        self.ways: dict[int, tuple[int, tuple | None]] = {START: (0, None)}

    @staticmethod
    def audit(way: tuple | None, until: tuple | None = None) -> str:
        found = []
        while way is not until:
            found.append(way[0])
            way = way[1]
        return "".join(reversed(found))

    @classmethod
    def less(cls, a: tuple, b: tuple) -> bool:
        if a[0] != b[0]:
            return a[0] < b[0]
        # what both share is not compared
        x, y = a[1], b[1]
        while x is not None and x[1] is not y[1]:
            x, y = x[1], y[1]
        shared = x[1] if x is not None else None
        return cls.audit(a[1], shared) < cls.audit(b[1], shared)

    def add(self, row: dict) -> None:
        part = Facts(
            dict(zip(("blank", "duplicate", "truncated"), row["faults"])),
            *(row[c] for c in ("illegal", "turns", "low", "high", "first", "last")),
        )
        self.facts.join(part)
        ways: dict[int, tuple[int, tuple | None]] = {}
        for a, (cost, way) in self.ways.items():
            for b in STATES:
                slot = a * len(STATES) + b
                if row["costs"][slot] is None:
                    continue
                made = (cost + row["costs"][slot], (row["audits"][slot], way, slot))
                if b not in ways or self.less(made, ways[b]):
                    ways[b] = made
        self.ways = ways

    def best(self) -> tuple[int, str, list[int]]:
        ends = [self.ways[s] for s in ACCEPTED if s in self.ways]
        best = ends[0]
        for other in ends[1:]:
            best = other if self.less(other, best) else best
        picks, way = [], best[1]
        while way is not None:
            picks.append(way[2])
            way = way[1]
        return best[0], self.audit(best[1]), picks[::-1]


def _chain():
    """Solved segments, in order within a conversation, to one row a conversation."""
    schema = _arrow(CHAINED)

    def done(conv, chain: Chain, parts: list[int], segs: list[int]) -> pa.RecordBatch:
        cost, audit, picks = chain.best()
        row = (*chain.facts.row(conv, (cost, audit), "")[:-1], picks, parts, segs)
        return _record([row], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, chain, parts, segs = None, None, [], []
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if chain is not None and r["conv_id"] != conv:
                    yield done(conv, chain, parts, segs)
                    chain = None
                if chain is None:
                    conv, chain, parts, segs = r["conv_id"], Chain(), [], []
                chain.add(r)
                parts.append(r["part"])
                segs.append(r["seg"])
        if chain is not None:
            yield done(conv, chain, parts, segs)

    return run


def _hashes():
    """Segments with their chosen audits, in order, to a hash a conversation: a stream."""
    schema = _arrow("conv_id long, repaired_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, empty = None, None, True
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if digest is not None and r["conv_id"] != conv:
                    yield _record([(conv, digest.hexdigest())], schema)
                    digest = None
                if digest is None:
                    conv, digest, empty = r["conv_id"], hashlib.sha256(), True
                for line in r["lines"]:
                    digest.update(("" if empty else "\n").encode() + line.encode("utf-8", "surrogatepass"))
                    empty = False
        if digest is not None:
            yield _record([(conv, digest.hexdigest())], schema)

    return run


def _lines():
    """Each segment's repaired lines, by its audit and the state before it."""
    schema = _arrow("conv_id long, part int, seg int, lines array<string>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                rows = [(x["role"], x["text"]) for x in r["rows"]]
                lines, _ = apply_audit(rows, r["audit"], r["slot"] // len(STATES))
                yield _record([(*(r[c] for c in PLACE), lines)], schema)

    return run


def _in_order(df: DataFrame) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions(*PLACE)


def _repair_long(parts: DataFrame) -> DataFrame:
    """Conversations of several segments: no task sees all texts of one at a time."""
    solved = land(_first_rows(parts).mapInArrow(_solve(), SOLVED), "solved-segments")
    chained = land(_in_order(solved).mapInArrow(_chain(), CHAINED), "chained-segments")
    # back to the segments, each with the way that was chosen through it
    picked = chained.select(
        "conv_id", F.explode(F.arrays_zip("parts", "segs", "picks")).alias("p")
    ).select(
        "conv_id",
        F.col("p.parts").alias("part"),
        F.col("p.segs").alias("seg"),
        F.col("p.picks").alias("slot"),
    )

    def beside(left: DataFrame, right: DataFrame, *columns) -> DataFrame:
        here = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in PLACE]
        return left.alias("l").join(right.alias("r"), here).select("l.*", *columns)

    audits = beside(
        picked, solved.select(*PLACE, "audits"), F.get("audits", F.col("slot")).alias("audit")
    )
    chosen = beside(parts, audits, "r.slot", "r.audit")
    lines = chosen.select(*PLACE, "rows", "slot", "audit").mapInArrow(
        _lines(), "conv_id long, part int, seg int, lines array<string>"
    )
    hashes = _in_order(lines).mapInArrow(_hashes(), "conv_id long, repaired_sha256 string")
    same = F.col("c.conv_id").eqNullSafe(F.col("h.conv_id"))
    return (
        chained.alias("c")
        .join(hashes.alias("h"), same)
        .select("c.*", "h.repaired_sha256")
        .drop("picks", "parts", "segs")
    )


# --- public --------------------------------------------------------------


def repair(
    conversations: DataFrame,
    ids: DataFrame | None = None,
    rows_most: int = SEGMENT,
    bytes_most: int = SEGMENT_BYTES,
) -> DataFrame:
    """One row a conversation: faults, cost, audit and hash of the repaired text.

    ``ids`` (a column ``conv_id``) names the conversations to return; those without rows
    are empty ones. Runs jobs.
    """
    spark = session(conversations.sparkSession)
    space = F.lit(" ")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
    )
    segments = segmented(rows, rows_most, bytes_most)
    done = segments.filter("whole").select("conv_id", "rows").mapInArrow(_repair_whole(), RESULT)
    # at most two conversations a partition, and those that were cut
    others = segments.filter("NOT whole").drop("whole")
    repaired = land(done.unionByName(_repair_long(others)), "repaired")
    if ids is None:
        return repaired
    wanted = ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    same = F.col("w.conv_id").eqNullSafe(F.col("r.conv_id"))
    joined = wanted.alias("w").join(repaired.alias("r"), same, "left")
    empty = {c: F.lit(0).cast("long") for c in repaired.columns}
    empty |= {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    return joined.select(
        "w.conv_id", *[F.coalesce(f"r.{c}", empty[c]).alias(c) for c in repaired.columns[1:]]
    )


def damage(conversations: DataFrame) -> DataFrame:
    """A keyed fifth of the rows dropped, emptied, cut, repeated or given another role."""
    conv, turn, role, text = (
        F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")
    )
    hit = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    ready = conversations.select(
        F.col("conv_id").alias("conv_id"),
        F.col("turn").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        hit.alias("hit"),
    )
    damaged = ready.filter("hit <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit") == 1, "")
        .when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
    )
    return damaged.drop("col")
