"""Repair of conversations: the cheapest edits that give a legal sequence of roles, found by A* on the edit lattice.

A node of the lattice is (rows read, what the repaired rows so far end with). Keep costs nothing, Rerole to user or
assistant 3, Delete 4, Insert of an empty user or assistant row 3; blank rows and repeated ones must be deleted, and a
truncated row that is not deleted costs 3 more. Initials of the repaired roles must read `(s?(ua)+)?`.

The search takes nodes in the order of (cost + least cost of what is left, audit): what is left costs at least 4 for
each row that must be deleted and 3 for each truncated one, which are sums over the rows that follow. Among edits of
equal cost the audit that comes first in ASCII wins, and an audit and its beginning settle which rows are repaired how.

Rows come sorted from Spark and are read as a stream. A conversation is searched in blocks of rows: a block is searched
from all ends that the block before can have (four at most, each with its cost, its audit and a running digest), so that
neither a conversation's rows nor its texts are ever held together, whatever their number; what all ends' audits begin
with is kept once. The digest of a whole conversation needs its texts in order, so one task reads them, as a stream.

Defined results: a null role or text counts as one space, and so does a null turn or conv_id in the key of the damage;
null turns come first and don't count for gaps; rows of one turn come in the order of role and text; rows with a null
conv_id are one conversation; a role's first character is its initial, and a row whose initial is not s, u or a can't be
kept; a repeated input row is damaged as often as it stands and counts as a duplicate; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows and bytes of text of a block.
BLOCK_ROWS, BLOCK_BYTES = 256, 4 << 20
DELETE, REROLE, INSERT, CUT_OFF = 4, 3, 3, 3
WHITE = r"\x20\x09-\x0D"
#: What the repaired rows end with: nothing yet, a system row, a user row, an assistant row.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: The turn that may follow, and where an initial may be kept.
TURN = (USER, USER, ASSISTANT, USER)
KEPT = {("s", NOTHING): SYSTEM, ("u", NOTHING): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
LEGAL = ("su", "ua", "au")
RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def damaged(chats: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: rows after the damage; rows that it drops are kept with 0 copies and without role and text."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))) % 20
    rows = chats.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), kind.alias("kind"))
    role = F.when(F.col("kind") == 0, "").when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    text = F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))


def faulty(rows: DataFrame) -> DataFrame:
    """rows with is_blank, is_repeat (role and text stand earlier) and is_cut_off, sorted within conversations that are each in one partition.

    Both sorts use the one shuffle by conv_id. The text's first row is not a repeat; of equal rows it comes first.
    """
    text = F.col("text")
    own = rows.repartition("conv_id").withColumn("is_dropped", F.col("copies") == 0)
    seen = Window.partitionBy("conv_id", "is_dropped", "role", "text").orderBy(F.asc_nulls_first("turn"))
    own = own.withColumn("is_repeat", F.row_number().over(seen) > 1)
    own = own.withColumn("is_blank", ~text.rlike(f"[^{WHITE}]")).withColumn("is_cut_off", ~text.rlike(rf"[.!?][{WHITE}]*\z"))
    return own.drop("is_dropped").sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text", "is_repeat")


def search(rows: list[tuple[str, bool, bool]], begin: dict[int, tuple[int, str]], last: bool) -> dict[int, tuple[int, str, int]]:
    """Cost, audit and beginning of the cheapest edits to each end; with `last` only of the cheapest legal one.

    rows: (initial, must be deleted, truncated). begin: what the rows before end with, and their cost and audit.
    """
    n = len(rows)
    left = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        left[i] = left[i + 1] + (DELETE if rows[i][1] else CUT_OFF if rows[i][2] else 0)
    heap = [(cost + left[0], audit, 0, end, end) for end, (cost, audit) in begin.items()]
    heapq.heapify(heap)
    done, out = set(), {}
    while heap:
        f, audit, i, end, first = heapq.heappop(heap)
        if (i, end) in done:
            continue
        done.add((i, end))
        cost = f - left[i]
        if i == n:
            if not last or end in (NOTHING, ASSISTANT):
                out[end] = (cost, audit, first)
                if last or len(out) == 4:
                    break
        else:
            initial, gone, cut_off = rows[i]
            rest = cost + left[i + 1]
            if (i + 1, end) not in done:
                heapq.heappush(heap, (rest + DELETE, audit + "D", i + 1, end, first))
            if not gone:
                charge = rest + (CUT_OFF if cut_off else 0)
                to = KEPT.get((initial, end))
                if to is not None and (i + 1, to) not in done:
                    heapq.heappush(heap, (charge, audit + "K", i + 1, to, first))
                if (i + 1, TURN[end]) not in done:
                    heapq.heappush(heap, (charge + REROLE, audit + "R", i + 1, TURN[end], first))
        if (i, TURN[end]) not in done:
            heapq.heappush(heap, (f + INSERT, audit + "I", i, TURN[end], first))
    return out


class Conversation:
    """One conversation as its rows come."""

    def __init__(self):
        self.ends = {NOTHING: (0, "", hashlib.sha256(), True)}
        self.audit: list[str] = []
        self.rows: list[tuple[str, str, bool, bool]] = []
        self.bytes = self.blank = self.repeat = self.cut_off = self.illegal = self.turns = 0
        self.initial = self.least = self.turn = None

    def add(self, turn, role: str, text: str, is_blank: bool, is_repeat: bool, is_cut_off: bool) -> None:
        if turn is not None and turn != self.turn:
            self.least = turn if self.least is None else self.least
            self.turn, self.turns = turn, self.turns + 1
        fault = (is_blank, is_repeat, is_cut_off)
        self.blank += fault[0]
        self.repeat += fault[1] and not fault[0]
        self.cut_off += fault == (False, False, True)
        initial = role[:1]
        self.illegal += self.initial is not None and self.initial + initial not in LEGAL
        self.initial = initial
        self.rows.append((role, text, is_blank or is_repeat, is_cut_off))
        self.bytes += len(text)
        if len(self.rows) >= BLOCK_ROWS or self.bytes >= BLOCK_BYTES:
            self.step(False)

    def step(self, last: bool) -> None:
        """The ends after the rows that are held."""
        found = search([(role[:1], gone, cut_off) for role, _, gone, cut_off in self.rows], {e: x[:2] for e, x in self.ends.items()}, last)
        ends = {}
        for end, (cost, audit, first) in found.items():
            _, before, digest, is_first = self.ends[first]
            digest = digest.copy()
            for line in self.repaired(audit[len(before) :], first):
                digest.update(line.encode() if is_first else b"\n" + line.encode())
                is_first = False
            ends[end] = (cost, audit, digest, is_first)
        common = os.path.commonprefix([x[1] for x in ends.values()])
        self.audit.append(common)
        self.ends = {e: (cost, audit[len(common) :], digest, is_first) for e, (cost, audit, digest, is_first) in ends.items()}
        self.rows, self.bytes = [], 0

    def repaired(self, audit: str, end: int) -> Iterator[str]:
        """role:text of the rows that the edits leave."""
        i = 0
        for edit in audit:
            role, text = self.rows[i][:2] if edit != "I" else ("", "")
            i += edit != "I"
            if edit == "K":
                end = KEPT[role[:1], end]
                yield f"{role}:{text}"
            elif edit != "D":
                end = TURN[end]
                yield f"{NAMES[end]}:{text}"

    def result(self) -> tuple:
        self.step(True)
        ((cost, audit, digest, _),) = self.ends.values()
        gaps = 0 if self.turn is None else self.turn - self.least + 1 - self.turns
        return gaps, self.blank, self.repeat, self.cut_off, self.illegal, cost, "".join([*self.audit, audit]), digest.hexdigest()


def repair(rows: DataFrame) -> DataFrame:
    """conv_id, its faults and its cheapest repair, of rows (conv_id, turn, role, text, copies); every conversation comes back, one without rows, too."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, size, key, now, schema = [], 0, None, None, None

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), schema, strict=True)], schema=schema)

        for b in batches:
            schema = pa.schema([("conv_id", b.schema.field("conv_id").type), *((x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in RESULT.split(", "))])
            columns = (b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies", "is_blank", "is_repeat", "is_cut_off"))
            for conv_id, turn, role, text, copies, is_blank, is_repeat, is_cut_off in zip(*columns, strict=True):
                if now is None or conv_id != key:
                    if now is not None:
                        made.append((key, *now.result()))
                        size += 100 + len(made[-1][7])
                        if size > 1 << 20:
                            yield block()
                            made, size = [], 0
                    key, now = conv_id, Conversation()
                for k in range(copies):
                    now.add(turn, role, text, is_blank, is_repeat or k > 0, is_cut_off)
        if now is not None:
            made.append((key, *now.result()))
            yield block()

    return faulty(rows).mapInArrow(run, f"conv_id {kind}, {RESULT}")
