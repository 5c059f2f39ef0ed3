"""Repair of conversation structure: turns aligned to the alternating grammar at every feasible length."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from platewise.llm.common import materialize

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # costs of edits
START_SLACK = 12  # what the first band allows above the least possible cost
FAR = 1 << 40
ROWS_AT_ONCE = 1024  # rows of a batch that a replay gives out
CACHE = 100_000  # code strings whose alignment a task remembers at most
CACHED_SIZE = 64  # turns of a conversation that is remembered at most
ROLES = "usa"  # initials with a meaning; other roles are the fourth class
SOUND, CUT, REPEATED, BLANK = range(4)
SPACES = " \t\n\x0b\f\r"
SHIFT = 33  # monotonically_increasing_id: the partition stands above this bit


def damaged(turns: DataFrame) -> DataFrame:
    """The rows after the stated damage: conv_id, turn, role, text; null roles and texts are one space.

    crc32("conv_id:turn") % 20 (nulls: one space) decides: 0 drops the row, 1 empties its text, 2 takes its .!? away,
    3 repeats it, 4 makes its role user.
    """
    part = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate(part("text"), ".!?", "")).otherwise(part("text"))
    return turns.withColumn("fault", fault).where("fault <> 0").select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(part("role")).alias("role"), text.alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def _text_fault() -> Column:
    """BLANK, CUT or SOUND by the text alone."""
    end = F.substring(F.rtrim(F.col("text"), F.lit(SPACES)), -1, 1)
    return F.when(end == "", BLANK).when(end.isin(".", "!", "?"), SOUND).otherwise(CUT)


# Alignment of one conversation. A code is one letter: 4 * class of the role's initial + first fault, from "A" on.


class Alignment:
    """Wagner-Fischer tables of one conversation's codes against the grammar (s?(ua)+)?.

    All targets of one parity end alike, so one table over (turns left, characters left) holds the alignments with every
    feasible length: cell (i, r) is the least cost of turning the turns from i on into the last r characters of ...uaua. A
    leading s is kept from a turn with that initial, with all turns before it deleted.

    A path of cost at most c inserts or deletes no more than what c allows beyond the cost that no
    path avoids, so rows are banded around the number of turns that may stay. The first band is narrow;
    its best cost is the incumbent that sets the band of the second, exact one.
    """

    def __init__(self, codes: str):
        code = np.frombuffer(codes.encode("ascii"), np.uint8).astype(np.int64) - 65
        self.role, self.fault = code // 4, code % 4
        self.n = len(code)
        self.must_go = self.fault >= REPEATED
        cut = (self.fault == CUT).astype(np.int64)
        self.stay_cost = TRUNCATED * cut
        self.left = np.concatenate([np.cumsum((~self.must_go)[::-1])[::-1], [0]])
        floor = int(DELETE * self.must_go.sum() + self.stay_cost.sum())
        cheap, extra = int(cut.sum()), DELETE - TRUNCATED  # turns whose deletion saves their truncation
        slack = START_SLACK
        while True:
            self.inserts = slack // INSERT
            self.deletes = slack // extra if slack <= cheap * extra else cheap + (slack - cheap * extra) // DELETE
            self._fill()
            incumbent = self._best()
            if incumbent <= floor + slack:
                break
            slack = incumbent - floor
        self.cost = incumbent

    def _fill(self) -> None:
        width = self.inserts + self.deletes + 1
        place = np.arange(width)
        table = np.full((self.n + 1, width + 1), FAR, np.int64)  # the last column stays FAR
        r = self.left[self.n] - self.deletes + place
        table[self.n, :width] = np.where(r >= 0, INSERT * r, FAR)
        for i in range(self.n - 1, -1, -1):
            after = table[i + 1]
            if self.must_go[i]:
                best = after[:width] + DELETE
            else:
                # Character r from the end is u where r is even; cell (i + 1, r - 1) stands in the same column.
                fits = ROLES.find("u") if (self.left[i] - self.deletes) % 2 == 0 else ROLES.find("a")
                other = ROLES.find("u") + ROLES.find("a") - fits
                step = np.full(width, REROLE + self.stay_cost[i])
                step[::2] -= (REROLE - KEEP) * (self.role[i] == fits)
                step[1::2] -= (REROLE - KEEP) * (self.role[i] == other)
                best = np.minimum(after[:width] + step, after[1:] + DELETE)
            table[i, :width] = np.minimum.accumulate(best - INSERT * place) + INSERT * place
        self.table = table

    def cell(self, i: int, r: int) -> int:
        j = r - int(self.left[i]) + self.deletes
        return int(self.table[i, j]) if r >= 0 and 0 <= j < self.table.shape[1] - 1 else FAR

    def _lengths(self) -> range:
        return range(max(0, int(self.left[0]) - self.deletes), int(self.left[0]) + self.inserts + 1)

    def _leading(self, length: int) -> list[int]:
        """Least costs from each turn on while the leading s of a target of this length is still to come."""
        ahead = [FAR] * (self.n + 1)
        for i in range(self.n - 1, -1, -1):
            ahead[i] = min(ahead[i + 1] + DELETE, self._kept_lead(i, length))
        return ahead

    def _kept_lead(self, i: int, length: int) -> int:
        if self.must_go[i] or self.role[i] != ROLES.find("s"):
            return FAR
        return KEEP + int(self.stay_cost[i]) + self.cell(i + 1, length - 1)

    def _costs(self) -> dict[int, int]:
        """Cost by feasible length: 0, even, or odd from 3 on."""
        leads = [i for i in range(self.n) if not self.must_go[i] and self.role[i] == ROLES.find("s")]
        return {r: self.cell(0, r) if r % 2 == 0 else min((DELETE * i + self._kept_lead(i, r) for i in leads), default=FAR)
                for r in self._lengths() if r % 2 == 0 or r >= 3}

    def _best(self) -> int:
        self.by_length = self._costs()
        return min([*self.by_length.values(), DELETE * self.n])

    def actions(self) -> str:
        """The cheapest edits whose audit is ASCII-least: D, K, u or a (rerole), U or A (insert)."""
        found = [self._trace(r) for r, cost in self.by_length.items() if cost == self.cost]
        if self.cost == DELETE * self.n:
            found.append("D" * self.n)
        return min(found, key=audit_of)

    def _trace(self, r: int) -> str:
        """The ASCII-least audit among the cheapest of one length: each edit leads to one cell, so the least letter goes first."""
        out, i = [], 0
        if r % 2:
            ahead = self._leading(r)
            while ahead[i] == ahead[i + 1] + DELETE:
                out.append("D")
                i += 1
            out.append("K")
            i, r = i + 1, r - 1
        while i < self.n or r > 0:
            here = self.cell(i, r)
            letter = "u" if r % 2 == 0 else "a"
            if i < self.n and here == self.cell(i + 1, r) + DELETE:
                out.append("D")
                i += 1
            elif r > 0 and here == self.cell(i, r - 1) + INSERT:
                out.append(letter.upper())
                r -= 1
            else:
                out.append("K" if self.role[i] == ROLES.find(letter) else letter)
                i, r = i + 1, r - 1
        return "".join(out)


AUDIT = str.maketrans("uaUA", "RRII")


def audit_of(actions: str) -> str:
    return actions.translate(AUDIT)


def illegal_pairs(codes: str) -> int:
    """Neighbours whose role initials are not su, ua or au."""
    role = (np.frombuffer(codes.encode("ascii"), np.uint8) - 65) // 4
    u, s, a = (ROLES.find(c) for c in "usa")
    x, y = role[:-1], role[1:]
    return int(len(x) - (((x == s) | (x == a)) & (y == u) | (x == u) & (y == a)).sum())


def _aligned(codes: str, known: dict) -> tuple[int, int, str]:
    """(cost, illegal pairs, actions); short conversations of equal codes are aligned once a task."""
    answer = known.get(codes)
    if answer is None:
        found = Alignment(codes)
        answer = found.cost, illegal_pairs(codes), found.actions()
        if len(codes) <= CACHED_SIZE:
            if len(known) >= CACHE:
                known.clear()
            known[codes] = answer
    return answer


def _cut(actions: str, sizes: list[int]) -> list[str]:
    """Actions of consecutive runs of turns; insertions go with the turn that follows, the last ones with the last run."""
    out, at = [], 0
    for size in sizes[:-1]:
        start = at
        while size:
            size -= actions[at] not in "UA"
            at += 1
        out.append(actions[start:at])
    return [*out, actions[at:]]


class Repair:
    """What ``repair`` found: ``turns`` (conv_id, place, role, text in one order for all), ``conversations`` (conv_id,
    counts, cost, actions by run of turns), both written once."""

    def __init__(self, turns: DataFrame, conversations: DataFrame):
        self.turns, self.conversations = turns, conversations


def repair(turns: DataFrame) -> Repair:
    """Align every conversation of ``turns`` (conv_id, turn, role, text; no nulls in role and text) with the grammar.

    Turns of a conversation are taken by turn (nulls first), equal turns by role, then text. A turn's first fault counts:
    blank text, role and text seen earlier in the conversation, no .!? at the end. Blank and repeated turns are deleted.
    A null conv_id is a conversation of its own; repeated rows are turns like others; an empty table gives empty results;
    other columns aren't read. Texts may have any length: they stay in the written rows, and are compared by SHA-256.

    No conversation is gathered: turns are range-partitioned, so a hot one spans many partitions; copies
    are counted before they meet; what an alignment gets is one letter a turn, packed per partition first.
    """
    rows = turns.select("conv_id", "turn", "role", "text").repartitionByRange(
        "conv_id", F.asc_nulls_first("turn"), "role", F.substring("text", 1, 32)).sortWithinPartitions(
        "conv_id", F.asc_nulls_first("turn"), "role", "text")
    role_class = F.instr(F.lit(ROLES), F.substring("role", 1, 1))
    role_class = F.when((F.col("role") == "") | (role_class == 0), len(ROLES)).otherwise(role_class - 1)
    stored = materialize(rows.withColumns({
        "place": F.monotonically_increasing_id(), "class": role_class.cast("int"), "fault": _text_fault(),
        "same": F.unhex(F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary"), 256))}), "turns")

    sound = stored.where(F.col("fault") != BLANK)
    first = sound.groupBy(F.col("conv_id").alias("of"), F.col("same").alias("like")).agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    fault = F.when((F.col("fault") != BLANK) & (F.col("place") > F.col("first")), REPEATED).otherwise(F.col("fault"))
    coded = stored.select("conv_id", "turn", "place", "class", "fault", "same").join(
        first, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("same") == F.col("like")), "left").select(
        "conv_id", "turn", "place", F.char(65 + 4 * F.col("class") + fault).alias("code"))
    runs = coded.groupBy("conv_id", F.shiftright("place", SHIFT).alias("run")).agg(
        F.min("place").alias("at"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "code"))),
                                                           lambda x: x["code"]), "").alias("codes"),
        F.min("turn").alias("low"), F.max("turn").alias("high"))
    packed = runs.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "codes"))).alias("runs"),
                                         F.min("low").alias("low"), F.max("high").alias("high"))
    numbered = stored.where("turn is not null").groupBy(F.col("conv_id").alias("of")).agg(F.count_distinct("turn").alias("distinct"))
    packed = packed.join(numbered, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(
        "conv_id", "runs", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("distinct"), F.lit(0)).alias("gaps"))

    kind = turns.schema["conv_id"].dataType.simpleString()
    schema = (f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
              "runs array<struct<at:long,actions:string>>")
    known: dict = {}

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {name: [] for name in ("blank", "duplicate", "truncated", "illegal", "cost", "runs")}
            for runs in batch.column("runs").to_pylist():
                codes = "".join(r["codes"] for r in runs)
                cost, illegal, actions = _aligned(codes, known)
                kinds = np.bincount((np.frombuffer(codes.encode("ascii"), np.uint8) - 65) % 4, minlength=4)
                parts = _cut(actions, [len(r["codes"]) for r in runs])
                for name, value in (("blank", kinds[BLANK]), ("duplicate", kinds[REPEATED]), ("truncated", kinds[CUT]),
                                    ("illegal", illegal), ("cost", cost)):
                    found[name].append(int(value))
                found["runs"].append([{"at": r["at"], "actions": a} for r, a in zip(runs, parts)])
            listed = pa.array(found.pop("runs"), pa.list_(pa.struct([("at", pa.int64()), ("actions", pa.string())])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("gaps"), *[pa.array(v, pa.int64()) for v in found.values()], listed],
                ["conv_id", "gaps", *found, "runs"])

    return Repair(stored, materialize(packed.mapInArrow(align, schema), "conversations"))


def audits(found: Repair) -> DataFrame:
    """One row per conversation that has turns: conv_id, gaps, blank, duplicate, truncated, illegal, cost and the audit,
    the edits' initials (Keep, Rerole, Delete, Insert) in order."""
    edits = F.array_join(F.transform("runs", lambda r: F.translate(r["actions"], "uaUA", "RRII")), "")
    return found.conversations.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", edits.alias("audit"))


def _instructed(found: Repair) -> DataFrame:
    """Turns, and before the first turn of each run its actions (as ``edits``)."""
    runs = found.conversations.select("conv_id", F.explode("runs").alias("r")).select(
        "conv_id", F.col("r.at").alias("place"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("text"), F.col("r.actions").alias("edits"))
    return found.turns.select("conv_id", "place", "role", "text", F.lit(None).cast("string").alias("edits")).unionByName(runs)


def _replayed(batches: Iterator[pa.RecordBatch]):
    """(conv_id, place of the run, action, role, text) in order, from rows sorted by run, actions first.

    One row is held at a time, however long a conversation is. A run starts with (conv_id, place, None, None, None).
    """
    names = {"u": "user", "a": "assistant"}
    conv = at = None
    edits: Iterator[str] = iter(())

    def inserted(action: str):
        return conv, at, "I", names[action.lower()], ""

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text", "edits")]
        for row_conv, place, role, text, plan in zip(*columns):
            if plan is not None:
                for action in edits:
                    yield inserted(action)
                conv, at, edits = row_conv, place, iter(plan)
                yield conv, at, None, None, None
                continue
            action = next(edits)
            while action in "UA":
                yield inserted(action)
                action = next(edits)
            yield conv, at, "R" if action in names else action, names.get(action, role), text
    for action in edits:
        yield inserted(action)


def repaired_turns(found: Repair) -> DataFrame:
    """The repaired conversations: conv_id, run, number (order within run; runs are in order), action (K, R or I), role,
    text. Runs are replayed apart from one another, so a hot conversation's runs are many tasks' work."""
    run = F.shiftright("place", SHIFT)
    rows = _instructed(found).withColumn("run", run).repartition("conv_id", "run").sortWithinPartitions(
        "conv_id", "place", F.col("edits").isNull())
    conv = found.turns.schema["conv_id"].dataType

    def replay(batches):
        number = 0
        for conv_id, at, action, role, text in _replayed(batches):
            number = 0 if action is None else number + 1
            if action not in (None, "D"):
                yield conv_id, at, number, action, role, text

    return _in_rows(rows, replay, f"conv_id {conv.simpleString()}, run long, number long, action string, role string, text string")


def repaired_digests(found: Repair) -> DataFrame:
    """conv_id and the SHA-256 of the repaired ``role:text`` lines, joined by newlines.

    The digest of a conversation is a sequential sum over its whole text, so its turns pass one task in order, one at a time.
    """
    rows = _instructed(found).repartition("conv_id").sortWithinPartitions("conv_id", "place", F.col("edits").isNull())
    conv = found.turns.schema["conv_id"].dataType

    def digest(batches):
        now, total, gap = None, None, ""
        for conv_id, _, action, role, text in _replayed(batches):
            if action is None and (total is None or conv_id != now):
                if total is not None:
                    yield now, total.hexdigest()
                now, total, gap = conv_id, hashlib.sha256(), ""
            elif action not in (None, "D"):
                total.update(f"{gap}{role}:{text}".encode())
                gap = "\n"
        if total is not None:
            yield now, total.hexdigest()

    return _in_rows(rows, digest, f"conv_id {conv.simpleString()}, repaired_sha256 string")


def _in_rows(df: DataFrame, generate, schema: str) -> DataFrame:
    """mapInArrow with a generator of tuples, packed to small batches."""
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        found = generate(batches)
        while some := list(islice(found, ROWS_AT_ONCE)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), kinds)], kinds.names)

    return df.mapInArrow(run, schema)
