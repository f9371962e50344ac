"""Structure repair of conversations by Knuth's lightest derivations.

A repaired conversation has role initials ``(s?(ua)+)?``: at most one opening system turn,
then user and assistant by turns, the assistant last. Edits keep a row, give it another
role, delete it or insert a turn without text; each has a cost and a letter, and the
letters in order are the audit of a repair.

Items are (rows read, state of the pattern). A deduction reads or inserts one turn: from
an item of weight (cost, audit) follows another of weight (cost + c, audit + letter).
Such functions are superior (no result is below its antecedent) and monotone (two audits
of one item with equal cost are never prefixes of one another, since what the longer one
inserts would cost more, so what is appended can't turn their order). So an agenda that
pops the least weight finalises each item at its lightest derivation, and it stops when
the goal pops: all rows read in a state that may end. An audit settles the roles, so equal weights
are one repair.

Two passes, neither of which holds a conversation's texts:

1. Rows without their texts (hashes and flags) go by conversation, in order. Rows
   repeated within a conversation are found before by a fold over (conversation, role, hash). A
   conversation is read in blocks; between blocks the four states carry their weights,
   and what their audits have in common is set aside.
2. Rows meet the audit of their conversation, which sorts before them, and are edited one by one.

A conversation with a third of all rows streams through one task, since its repair, and a
hash over it, are sequences; what the task holds is a block and the audit.

Defined results: NULL role and text count as one space, a NULL turn comes first, NULL
conversation ids are one conversation. Rows of one turn are in the order of role, then
hash of the text. An empty role has no initial, so such a row can't be kept. A repeated row is a duplicate
of the first. An empty table gives an empty result. Further columns are not used.
"""

from __future__ import annotations

import hashlib
import os
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respfeat.llm.common import bounded, table, written

#: Costs of the edits, and of leaving a truncated row in.
RETAG, DELETE, INSERT, LEFT_CUT = 3, 4, 3, 3
#: Rows that the agenda works on at a time.
BLOCK_ROWS = 512

#: The pattern: state -> role initial -> state. 0 nothing yet, 1 after s, 2 after u, 3 after a.
STEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
LEGAL = frozenset(["su", "ua", "au"])


# -- the agenda ------------------------------------------------------------------


def lightest(axioms, deduce, goal=None) -> dict:
    """Lightest weights of items. ``axioms``: (weight, item); ``deduce(item, weight)``: the (weight, item)
    that follow from a finalised item, by superior and monotone functions. Stops when ``goal``
    finalises; without one, when nothing is left."""
    agenda, final = [], {}
    for entry in axioms:
        heappush(agenda, entry)
    while agenda:
        weight, item = heappop(agenda)
        if item in final:
            continue
        final[item] = weight
        if item == goal:
            break
        for entry in deduce(item, weight):
            if entry[1] not in final:
                heappush(agenda, entry)
    return final


GOAL = -1


def block_weights(rows: list, entries: list, last: bool) -> dict:
    """The agenda over a block. Rows: (initial, must be deleted, truncated); entries: (cost, audit, state).
    Items are 4 * rows read + state. Returns the weight of the goal, or of each state after the block."""
    end = 4 * len(rows)

    def deduce(item, weight):
        if item == GOAL:
            return
        cost, audit = weight
        at, state = divmod(item, 4)
        if item >= end:
            if last and state in ENDS:
                yield weight, GOAL
        else:
            initial, gone, cut = rows[at]
            below = item + 4
            yield (cost + DELETE, audit + "D"), below
            if not gone:
                left = cost + LEFT_CUT * cut
                after = STEP[state].get(initial)
                if after is not None:
                    yield (left, audit + "K"), below - state + after
                for name, after in STEP[state].items():
                    if name in ROLES and name != initial:
                        yield (left + RETAG, audit + "R"), below - state + after
        for name, after in STEP[state].items():
            if name in ROLES:
                yield (cost + INSERT, audit + "I"), item - state + after

    final = lightest([((cost, audit), state) for cost, audit, state in entries], deduce, GOAL if last else None)
    return {GOAL: final[GOAL]} if last else {state: final[end + state] for state in range(4) if end + state in final}


class _Conversation:
    """Reads a conversation's rows in order."""

    def __init__(self, conv) -> None:
        self.conv = conv
        self.entries = [(0, "", 0)]
        self.audit: list[str] = []
        self.rows: list[tuple] = []
        self.before = self.turn = self.low = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initial: str | None = None

    def read(self, turn, role: str, sha: bytes, blank: bool, cut: bool, seen: bool) -> None:
        if len(self.rows) == BLOCK_ROWS:
            self.close(False)
        if turn is not None and turn != self.turn:
            self.low = turn if self.low is None else self.low
            self.turn = turn
            self.turns += 1
        row = (turn, role, sha)
        twice = not blank and (seen or row == self.before)
        cut = cut and not (blank or twice)
        self.before = row
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        self.blank += blank
        self.duplicate += twice
        self.truncated += cut
        self.rows.append((initial, blank or twice, cut))

    def close(self, last: bool) -> None:
        final = block_weights(self.rows, self.entries, last)
        shared = os.path.commonprefix([audit for _, audit in final.values()])
        self.audit.append(shared)
        self.entries = [(cost, audit[len(shared) :], state) for state, (cost, audit) in final.items()]
        self.rows = []

    def result(self) -> tuple:
        self.close(True)
        gaps = 0 if self.low is None else self.turn - self.low + 1 - self.turns
        return (self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.entries[0][0], "".join(self.audit))


_SUMMARY = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _judge(batches):
    kinds = [pa.int64()] * 7 + [pa.string()]
    names = [c.split()[0] for c in _SUMMARY.split(", ")]

    def table_of(done):
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)

    at, done = None, []
    for b in batches:
        for conv, turn, role, sha, blank, cut, seen in zip(*(c.to_pylist() for c in b.columns)):
            if at is None or at.conv != conv:
                if at is not None:
                    done.append(at.result())
                at = _Conversation(conv)
            if role is not None:
                at.read(turn, role, sha, blank, cut, seen)
        if done:
            yield table_of(done)
            done = []
    if at is not None:
        yield table_of([at.result()])


# -- rows ------------------------------------------------------------------------


def _rows(df: DataFrame, conv: str, turn: str, role: str, text: str, present: Column) -> DataFrame:
    """conv, turn, role, text, sha; role and text are NULL in rows that only name their conversation."""
    words = F.coalesce(F.col(text).cast("string"), F.lit(" "))
    return df.select(
        F.col(conv).cast("long").alias("conv"), F.when(present, F.col(turn).cast("long")).alias("turn"),
        F.when(present, F.coalesce(F.col(role).cast("string"), F.lit(" "))).alias("role"), F.when(present, words).alias("text"),
        F.when(present, F.unhex(F.sha2(words, 256))).alias("sha"),
    )


#: Spark puts NULLs first in ascending order.
_ORDER = ["conv", "turn", "role", "sha"]


def judge(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: Column | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit: the faults of each conversation and
    its cheapest repair. Rows that are not ``present`` only name a conversation."""
    words = F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", "")
    light = _rows(df, conv, turn, role, text, F.lit(True) if present is None else present).select(
        "conv", "turn", "role", "sha", (words == "").alias("blank"), (~words.rlike(r"[.!?]\z")).alias("cut")
    )
    # Roles and texts that a conversation holds more than once, with their first turn; NULL turns come first.
    first = F.min(F.struct(F.col("turn").isNotNull().alias("set"), "turn"))
    same = [F.col("conv").isNull().alias("none"), F.coalesce("conv", F.lit(0)).alias("c"), F.col("role").alias("r"), F.col("sha").alias("s")]
    twice = written(
        light.where("role is not null and not blank").groupBy(*same).agg(first.alias("first"), F.count("*").alias("times")).where("times > 1").drop("times"), "repeated"
    )
    meet = (F.col("conv").isNull() == F.col("none")) & (F.coalesce("conv", F.lit(0)) == F.col("c")) & (F.col("role") == F.col("r")) & (F.col("sha") == F.col("s"))
    later = F.struct(F.col("turn").isNotNull().alias("set"), "turn") > F.col("first")
    marked = light.join(bounded(twice), meet, "left").select("conv", "turn", "role", "sha", "blank", "cut", F.coalesce(later, F.lit(False)).alias("seen"))
    return marked.repartition("conv").sortWithinPartitions(*_ORDER).mapInArrow(_judge, _SUMMARY)


_REPAIRED = "conv_id long, turn long, edit string, role string, text string"


def _edit(batches):
    """Rows in order, each conversation's audit before them -> the rows of the repaired conversations."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    names = [c.split()[0] for c in _REPAIRED.split(", ")]
    conv, audit, at, state = None, "", 0, 0
    out: list[tuple] = []

    def inserted():
        nonlocal at, state
        while audit[at : at + 1] == "I":
            name, state = next((n, s) for n, s in STEP[state].items() if n in ROLES)
            at += 1
            out.append((conv, None, "insert", ROLES[name], ""))

    for b in batches:
        for this, plan, turn, role, text in zip(*(b[c].to_pylist() for c in ("conv", "audit", "turn", "role", "text"))):
            if plan is not None:
                conv, audit, at, state = this, plan, 0, 0
                inserted()
                continue
            letter = audit[at]
            at += 1
            if letter == "K":
                state = STEP[state][role[:1]]
                out.append((conv, turn, "keep", role, text))
            elif letter == "R":
                name, state = next((n, s) for n, s in STEP[state].items() if n in ROLES)
                out.append((conv, turn, "rerole", ROLES[name], text))
            inserted()
        if out:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
            out.clear()


def apply(
    df: DataFrame, judged: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: Column | None = None
) -> DataFrame:
    """The repaired rows: conv_id, turn (NULL if inserted), edit, role, text. Each conversation is in one partition, in order."""
    rows = _rows(df, conv, turn, role, text, F.lit(True) if present is None else present).where("role is not null")
    plans = judged.select(F.col("conv_id").alias("conv"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
                          F.lit(None).cast("string").alias("text"), F.lit(None).cast("binary").alias("sha"), "audit")
    both = rows.withColumn("audit", F.lit(None).cast("string")).unionByName(plans)
    order = ["conv", F.col("audit").isNull(), *_ORDER[1:]]
    return both.repartition("conv").sortWithinPartitions(*order).select("conv", "audit", "turn", "role", "text").mapInArrow(_edit, _REPAIRED)


def _digest(batches):
    conv, h, done = None, None, []
    for b in batches:
        for this, role, text in zip(*(b[c].to_pylist() for c in ("conv_id", "role", "text"))):
            if h is None or this != conv:
                if h is not None:
                    done.append((conv, h.hexdigest()))
                conv, h = this, hashlib.sha256()
            else:
                h.update(b"\n")
            h.update(f"{role}:{text}".encode())
        if done:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*done), (pa.int64(), pa.string()))], names=["conv", "sha"])
            done = []
    if h is not None:
        yield pa.record_batch([pa.array([conv], pa.int64()), pa.array([h.hexdigest()])], names=["conv", "sha"])


def digests(repaired: DataFrame) -> DataFrame:
    """conv, sha: SHA-256 of each repaired conversation's ``role:text`` lines; reads the order that ``apply`` gives."""
    return repaired.mapInArrow(_digest, "conv long, sha string")


# -- the query -------------------------------------------------------------------


def damaged(conversations: DataFrame) -> tuple[DataFrame, Column]:
    """Rows with planted faults, by crc32 of ``conv_id:turn`` modulo 20, and what tells the rows that are left."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    fault, words = F.crc32(key.cast("binary")) % 20, F.coalesce("text", F.lit(" "))
    rows = conversations.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(words, ".!?", "")).otherwise(words).alias("text"),
        (fault != 0).alias("present"), F.explode(F.sequence(F.lit(1), F.when(fault == 3, 2).otherwise(1))).alias("copy"),
    )
    return rows.drop("copy"), F.col("present")


def query(spark, sf_dir):
    rows, present = damaged(table(spark, sf_dir, "conversations"))
    judged = written(judge(rows, present=present), "judged")
    sha = digests(apply(rows, judged, present=present))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return judged.join(sha, judged["conv_id"].eqNullSafe(sha["conv"]), "left").select(
        *judged.columns, F.coalesce("sha", nothing).alias("repaired_sha256")
    )
