"""Conversation structure repair by dynamic programming over time-major tensors.

A conversation should be an optional system turn, then user and assistant turns in pairs. Each turn may be kept, given
another role or deleted, and empty turns may be put in anywhere; the cheapest edits are looked for, and of equally cheap ones
those whose initials sort first.

Rows of four small columns are brought together by conversation and read in order as a stream. Conversations whose kinds of
turns (a byte each) are complete are taken in lots, bucketed by length and laid out time-major: the cost of each of four states is
updated for all conversations of a bucket at once, from the last turn to the first; the stored costs then say at each turn, again
for all conversations at once, which edit comes first. Costs are stored for ``BLOCK`` turns at a time, with marks in between, so
a conversation of any length costs a byte a turn and little more. Texts meet the edits in a second stream, in the same order.

Defined results: nulls in role or text count as one blank; turns order by turn, null first, then by role and a hash of the
text, so repeated rows stand side by side; a null conv_id is a conversation of its own; a role counts by its first letter and
keeps its name unless it is changed; a conversation without rows (all are ``gone``) has no edits; an empty table gives an empty
table; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import WORD, WORD_BREAKS, written

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5  # costs; keeping is free
LOT_TURNS, LOT_CONVERSATIONS, BLOCK = 1 << 18, 1 << 13, 512

# The state is what the repaired conversation ends with: nothing, a system, a user or an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
FAR = 1 << 40  # a cost that no edits reach
#: The state after an inserted turn, or one given the role that is due.
DUE = np.array([USER, USER, ASSISTANT, USER])
#: What is left to pay at the end of a conversation: an open pair is closed by inserting.
AT_END = np.array([0, 2 * INSERT, INSERT, 0], np.int64)

# A turn's kind: its role's first letter (other, s, u, a) and four times its fault. The last kind is no turn.
FAULTS = ("", "blank", "duplicate", "truncated")
NO_TURN = 16


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By kind: cost of deleting, of a new role; by kind and state: cost of keeping, state after it."""
    delete, rerole = np.full(NO_TURN + 1, DELETE, np.int64), np.full(NO_TURN + 1, FAR, np.int64)
    keep, kept = np.full((NO_TURN + 1, 4), FAR, np.int64), np.zeros((NO_TURN + 1, 4), np.int64)
    follows = {1: {START: SYSTEM}, 2: {START: USER, SYSTEM: USER, ASSISTANT: USER}, 3: {USER: ASSISTANT}}
    for fault, extra in ((0, 0), (3, TRUNCATED)):
        for letter in range(4):
            kind = letter + 4 * fault
            rerole[kind] = REROLE + extra
            for state, after in follows.get(letter, {}).items():
                keep[kind, state], kept[kind, state] = extra, after
    delete[NO_TURN] = 0
    return delete, rerole, keep, kept


_DELETE, _REROLE, _KEEP, _KEPT = _tables()


def _before(kinds: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From the kinds of a turn (n) and the costs after it (n, 4): costs before it, with and without inserting first."""
    by_keep = _KEEP[kinds] + np.take_along_axis(after, _KEPT[kinds], 1)
    own = np.minimum(np.minimum(after + _DELETE[kinds, None], by_keep), after[:, DUE] + _REROLE[kinds, None])
    whole = np.minimum(own, own[:, DUE] + INSERT)
    return np.minimum(own, whole[:, DUE] + INSERT), own


def _costs(kinds: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Costs (turns + 1, n, 4) of kinds (turns, n) from the costs at their end."""
    out = np.empty((len(kinds) + 1, *end.shape), np.int64)
    out[-1] = end
    for t in range(len(kinds) - 1, -1, -1):
        out[t] = _before(kinds[t], out[t + 1])[0]
    return out


def _trace(kinds: np.ndarray, costs: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edits (turns, n, 3: up to two inserted turns and the turn's own edit; 0 for none) and the states at the end.

    Each edit is the first in the order D, I, K, R among those that keep to the least cost: each leads to one next state only, so this
    gives the first string of initials.
    """
    turns, n = kinds.shape
    edits, each = np.zeros((turns, n, 3), np.uint8), np.arange(n)
    for t in range(turns):
        now, after, kind = costs[t], costs[t + 1], kinds[t]
        open_ = np.ones(n, bool)
        for place in range(3):
            left = now[each, state]
            delete = open_ & (after[each, state] + _DELETE[kind] == left)
            insert = open_ & ~delete & (now[each, DUE[state]] + INSERT == left)
            keep = open_ & ~delete & ~insert & (_KEEP[kind, state] + after[each, _KEPT[kind, state]] == left)
            rerole = open_ & ~delete & ~insert & ~keep
            edits[t, :, place] = np.select([delete & (kind != NO_TURN), insert, keep, rerole & (kind != NO_TURN)], [ord("D"), ord("I"), ord("K"), ord("R")], 0)
            state = np.select([delete, insert, keep, rerole], [state, DUE[state], _KEPT[kind, state], DUE[state]], state)
            open_ = insert
            if not open_.any():
                break
    return edits, state


def edits_of(conversations: list[np.ndarray]) -> list[tuple[int, bytes]]:
    """(cost, initials of the edits) for conversations given by the kinds of their turns."""
    out: list[tuple[int, bytes]] = [(0, b"")] * len(conversations)
    buckets: dict[int, list[int]] = {}
    for i, c in enumerate(conversations):
        step = max(1, (1 << max(len(c).bit_length() - 1, 0)) // 4)
        buckets.setdefault(-(-len(c) // step) * step, []).append(i)  # lengths that differ by less than a quarter meet
    for length, members in buckets.items():
        kinds = np.full((length, len(members)), NO_TURN, np.uint8)
        for j, i in enumerate(members):
            kinds[: len(conversations[i]), j] = conversations[i]
        marks = [np.broadcast_to(AT_END, (len(members), 4))]
        starts = range(0, length, BLOCK)
        for at in reversed(starts[1:]):
            marks.append(_costs(kinds[at : at + BLOCK], marks[-1])[0])
        state, parts, first = np.zeros(len(members), np.int64), [], None
        for at in starts:
            costs = _costs(kinds[at : at + BLOCK], marks.pop())
            first = costs[0][:, START] if first is None else first
            edits, state = _trace(kinds[at : at + BLOCK], costs, state)
            parts.append(edits)
        first = np.zeros(len(members), np.int64) if first is None else first
        for j, i in enumerate(members):
            made = np.concatenate([p[:, j].ravel() for p in parts]) if parts else np.zeros(0, np.uint8)
            out[i] = int(first[j]), made[made > 0].tobytes() + b"I" * int(AT_END[state[j]] // INSERT)
    return out


def _letter(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 1).when(first == "u", 2).when(first == "a", 3).otherwise(0)


def _rows(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, digest, gone."""
    gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in turns.columns else F.lit(False)
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return turns.select("conv_id", F.col("turn").cast("long"), role.alias("role"), text.alias("text"), F.unhex(F.md5(text.cast("binary"))).alias("digest"), gone.alias("gone"))


def kinds(turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, text, perhaps gone) as conv_id, turn, kind (null where gone), in order within each partition, each conversation in one."""
    last = F.right(F.rtrim("text", F.lit(WORD_BREAKS)), F.lit(1))
    fault = F.when(~F.col("text").rlike(WORD), 1).when(~last.isin(".", "!", "?"), 3).otherwise(0)
    rows = _rows(turns).select("conv_id", "turn", "gone", F.when(~F.col("gone"), F.col("role")).alias("role"), F.when(~F.col("gone"), F.col("digest")).alias("digest"), _letter(F.col("role")).alias("letter"), fault.alias("fault"))
    rows = rows.repartition("conv_id")
    earlier = F.row_number().over(Window.partitionBy("conv_id", "role", "digest").orderBy(F.col("turn").asc_nulls_first()))
    rows = rows.withColumn("nth", earlier).withColumn("fault", F.when((F.col("fault") != 1) & (F.col("nth") > 1), 2).otherwise(F.col("fault")))
    rows = rows.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "gone", F.col("turn").asc_nulls_first(), "role", "digest", "nth")
    return rows.select("conv_id", "turn", F.when(~F.col("gone"), F.col("letter") + 4 * F.col("fault")).cast("byte").alias("kind"))


class _Open:
    """What is known of the conversation that is being read."""

    def __init__(self, conv_id: pa.Scalar):
        self.conv_id, self.parts, self.low, self.high, self.distinct = conv_id, [], None, None, 0

    def add(self, turn: pa.Array, kind: pa.Array) -> None:
        here = kind.is_valid()
        self.parts.append(kind.filter(here).to_numpy(zero_copy_only=False).astype(np.uint8))
        t = turn.filter(here).drop_null().to_numpy(zero_copy_only=False)
        if len(t):
            self.distinct += int((t[1:] != t[:-1]).sum()) + (self.high is None or int(t[0]) != self.high)
            self.low, self.high = int(t[0]) if self.low is None else self.low, int(t[-1])

    def facts(self, kinds: np.ndarray) -> tuple[int, ...]:
        """gaps, blank, duplicate, truncated, illegal."""
        letter, fault = kinds & 3, kinds >> 2
        pairs = letter[:-1] * 4 + letter[1:]
        illegal = len(pairs) - int(np.isin(pairs, (1 * 4 + 2, 2 * 4 + 3, 3 * 4 + 2)).sum())
        gaps = self.high - self.low + 1 - self.distinct if self.distinct else 0
        return gaps, *(int((fault == f).sum()) for f in (1, 2, 3)), illegal


FACTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def planned(turns: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit (the edits' initials) of every conversation."""
    rows = kinds(turns)
    key = rows.schema["conv_id"].dataType
    schema = StructType([StructField("conv_id", key), *(StructField(f, LongType()) for f in FACTS), StructField("audit", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[_Open] = []
        open_: _Open | None = None
        held = 0

        def lot(closed: list[_Open]) -> pa.RecordBatch:
            each = [np.concatenate(c.parts) for c in closed]
            found = edits_of(each)
            facts = [(*c.facts(k), cost) for c, k, (cost, _) in zip(closed, each, found)]
            ids = pa.array([c.conv_id.as_py() for c in closed], closed[0].conv_id.type)
            columns = [ids, *(pa.array(f, pa.int64()) for f in zip(*facts)), pa.array([a.decode() for _, a in found], pa.string())]
            return pa.record_batch(columns, names=["conv_id", *FACTS, "audit"])

        for b in batches:
            runs, at = pc.run_end_encode(b.column(0)), 0
            for end, conv_id in zip(runs.run_ends.to_pylist(), runs.values):
                if open_ is None or not _same(open_.conv_id, conv_id):
                    if open_ is not None:
                        done.append(open_)
                    if held >= LOT_TURNS or len(done) >= LOT_CONVERSATIONS:
                        yield lot(done)
                        done, held = [], 0
                    open_ = _Open(conv_id)
                open_.add(b.column(1).slice(at, end - at), b.column(2).slice(at, end - at))
                held, at = held + end - at, end
        if open_ is not None:
            yield lot([*done, open_])

    return rows.mapInArrow(run, schema)


def _same(a: pa.Scalar, b: pa.Scalar) -> bool:
    return a.as_py() == b.as_py()


def edited(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired conversations in order: one row of place 0 that carries the plan, then the turns that remain, from place 1.

    conv_id, place, edit (K, R or I), role, text, plan. Each conversation stands in one partition as a whole, in this order.
    """
    head = plans.select("conv_id", F.lit(False).alias("is_turn"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(b"").alias("digest"), F.lit("").alias("text"), F.struct(*FACTS, "audit").alias("plan"))
    body = _rows(turns).filter(~F.col("gone")).select("conv_id", F.lit(True).alias("is_turn"), "turn", "role", "digest", "text", F.lit(None).cast(head.schema["plan"].dataType).alias("plan"))
    both = head.unionByName(body).repartition("conv_id")
    both = both.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "is_turn", F.col("turn").asc_nulls_first(), "role", "digest").select("conv_id", "role", "text", "plan")
    kind, plan_kind = both.schema["conv_id"].dataType, both.schema["plan"].dataType
    out = StructType([StructField("conv_id", kind), StructField("place", LongType()), StructField("edit", StringType()), StructField("role", StringType()), StructField("text", StringType()), StructField("plan", plan_kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, place, state, conv_id = "", 0, 0, START, None
        rows: list[tuple] = []

        def put(edit: str, role: str, text: str) -> None:
            nonlocal place, state
            place += 1
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
            rows.append((conv_id, place, edit, role, text, None))

        def due() -> str:
            return "assistant" if state == USER else "user"

        def inserted() -> None:
            nonlocal at
            while audit[at : at + 1] == "I":
                put("I", due(), "")
                at += 1

        def batch(like: pa.RecordBatch) -> pa.RecordBatch:
            types = [like.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string(), like.schema.field(3).type]
            columns = zip(*rows) if rows else [[]] * len(types)
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=out.names)

        last = None
        for b in batches:
            last = b
            for id_, role, text, plan in zip(b.column(0).to_pylist(), b.column(1), b.column(2), b.column(3)):
                if plan.is_valid:
                    inserted()  # what the conversation before still lacks
                    conv_id, at, place, state = id_, 0, 0, START
                    plan = plan.as_py()
                    audit = plan["audit"]
                    rows.append((conv_id, 0, None, None, None, plan))
                    continue
                inserted()
                edit, at = audit[at], at + 1
                if edit != "D":
                    put(edit, role.as_py() if edit == "K" else due(), text.as_py())
            yield batch(b)
            rows.clear()
        inserted()
        if rows:
            yield batch(last)

    return both.mapInArrow(run, out)


def repaired(turns: DataFrame) -> DataFrame:
    """conv_id, place, edit, role and text of the turns of all repaired conversations; turns is read twice."""
    return edited(turns, written(planned(turns), "repair-plans")).filter("place > 0").drop("plan")


def digests(turns: DataFrame) -> DataFrame:
    """conv_id, FACTS, audit and repaired_sha256 (of ``role:text``, joined by line breaks) of every conversation; turns is read twice."""
    rows = edited(turns, written(planned(turns), "repair-plans"))
    out = StructType([StructField("conv_id", rows.schema["conv_id"].dataType), *rows.schema["plan"].dataType, StructField("repaired_sha256", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, head, kind = hashlib.sha256(), None, None

        def batch(done: list[tuple]) -> pa.RecordBatch:
            ids, plans, hashes = zip(*done)
            facts = [pa.array([p[f] for p in plans], pa.int64()) for f in FACTS]
            return pa.record_batch([pa.array(ids, kind), *facts, pa.array([p["audit"] for p in plans], pa.string()), pa.array(hashes, pa.string())], names=out.names)

        for b in batches:
            done, kind = [], b.schema.field(0).type
            for id_, place, role, text, plan in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3), b.column(4), b.column(5)):
                if place == 0:
                    if head is not None:
                        done.append((*head, hashed.hexdigest()))
                    head, hashed = (id_, plan.as_py()), hashlib.sha256()
                    continue
                if place > 1:
                    hashed.update(b"\n")
                hashed.update(f"{role.as_py()}:{text.as_py()}".encode("utf-8", "surrogatepass"))
            if done:
                yield batch(done)
        if head is not None:
            yield batch([(*head, hashed.hexdigest())])

    return rows.mapInArrow(run, out)


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: turns with faults put in by a hash of conversation and turn, to try the repair on.

    By crc32 of ``conv_id:turn`` modulo 20: 0 drops a row (it stays as ``gone``, so its conversation is known), 1 empties its text, 2 takes
    away its full stops, question and exclamation marks, 3 repeats it, 4 makes its role user. Nulls count as one blank.
    """
    blank = F.lit(" ")
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.pmod(F.crc32(name.cast("binary")), F.lit(20)).alias("what"))
    rows = rows.withColumn("again", F.explode(F.when(F.col("what") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    text = F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("what") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("what") == 0).alias("gone"))
