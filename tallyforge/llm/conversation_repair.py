"""Conversation structure repair: a cheapest edit of every conversation, streamed turn by turn."""

from __future__ import annotations

import hashlib
import pickle
import re
import tempfile
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.scratch import reach_package

# What edits cost, and the extra cost of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SPILL = 1 << 22  # bytes of a conversation's rows, and of its backpointers, kept in memory
REMEMBERED = 1 << 18  # rows of a conversation whose digests a task keeps at hand
LAST = re.compile(r"[^\x20\x09-\x0D](?=[\x20\x09-\x0D]*\Z)")

# States of `(s?(ua)+)?`: 0 nothing yet, 1 after s, 2 after u, 3 after a.  The initials each one takes:
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
WANTED = ("u", "u", "a", "u")  # what an insert or a new role adds, as neither adds s
ROLE = {"u": "user", "a": "assistant"}
ACCEPTED = (0, 3)
EDITS = "DKR"  # of a row, as ASCII orders them; inserts, I, come before a row's edit
NEVER = 1 << 60

RESULT = "id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (id, turn, role, text) damaged by crc32(conv:turn) % 20; nulls count as one space.

    0 drops a row (one with a null role stays as the mark that its conversation exists), 1
    empties its text, 2 removes its full stops, exclamation and question marks, 3 repeats it,
    4 sets its role to user.
    """
    space = F.lit(" ")
    code = F.crc32(F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in (conv, turn)))) % 20
    body = F.coalesce(F.col(text), space)
    changed = rows.select(
        F.col(conv).cast("long").alias("id"),
        F.col(turn).cast("long").alias("turn"),
        F.when(code == 0, None).when(code == 4, "user").otherwise(F.coalesce(F.col(role), space)).alias("role"),
        F.when(code <= 1, "").when(code == 2, F.translate(body, ".!?", "")).otherwise(body).alias("text"),
        F.when(code == 3, 2).otherwise(1).alias("_times"),
    )
    return changed.withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times", "_time")


def plain(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (id, turn, role, text) as they are; nulls count as one space."""
    space = F.lit(" ")
    return rows.select(
        F.col(conv).cast("long").alias("id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), space).alias("role"), F.coalesce(F.col(text), space).alias("text"),
    )


def repair(rows: DataFrame, remembered: int = REMEMBERED, spill: int = SPILL) -> DataFrame:
    """One row per conversation: id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    rows: (id, turn, role, text), as damage and plain give them.  A conversation's rows are
    taken by turn, nulls first, then by role and text.  Its first fault counts for each row:
    blank (nothing but white space), duplicate (role and text seen earlier in the
    conversation), truncated (the last character that is not white space is none of `.!?`).
    illegal counts neighbours whose role initials are not su, ua or au; gaps is
    maxTurn - minTurn + 1 - distinctTurns over turns that are not null, 0 without any.

    audit is the cheapest sequence of edits after which the role initials match
    `(s?(ua)+)?`: Keep (0), Rerole to user or assistant (1), Delete (2; blank and duplicate
    rows must go), Insert an empty user or assistant text (5); a truncated row that stays adds
    5.  Among equals the ASCII-least sequence.  repaired_sha256 is the digest of the repaired
    `role:text` lines.  A conversation all of whose rows are dropped has zeros, an empty audit
    and the digest of nothing.  An empty role has no initial that fits, as an unknown one.

    Rows are dealt out by conversation and sorted by turn, so that a task streams through
    them, one Arrow batch after another, and carries four states: the least cost of each and
    how their audits order.  A row leaves four bytes of backpointers; those of a conversation,
    and its rows, move to a task's temporary file beyond `spill` bytes and are read back once.
    Conversations of more than `remembered` rows have their duplicates marked beforehand, by
    shuffles on role and text, so that no task keeps a digest of each.  So memory has a bound,
    while one conversation remains one task's stream.
    """
    reach_package(rows.sparkSession)
    real = F.col("role").isNotNull()
    large = rows.groupBy("id").agg(F.count("role").alias("_rows")).filter(F.col("_rows") > remembered).select("id")
    return _streamed(_marked(rows, large, real), spill)


def _marked(rows: DataFrame, large: DataFrame, real: Column) -> DataFrame:
    """rows with `repeated`: for large conversations whether role and text were seen earlier, else null."""
    spotted = large.select(F.col("id").alias("_id"), F.lit(True).alias("_large"))
    known = rows.join(spotted, F.col("id").eqNullSafe(F.col("_id")), "left").drop("_id")
    many = known.filter("_large").drop("_large")
    few = known.filter("_large IS NULL").drop("_large").withColumn("repeated", F.lit(None).cast("boolean"))
    # copies in order of turn; equal turns are equal rows here, so any of them may be the first
    same = Window.partitionBy("id", "role", "_print").orderBy(F.col("turn").asc_nulls_first())
    many = many.withColumn("_print", F.sha2("text", 256)).withColumn("repeated", real & (F.row_number().over(same) > 1))
    return few.unionByName(many.drop("_print"))


def _streamed(rows: DataFrame, spill: int) -> DataFrame:
    order = ["id", F.col("turn").asc_nulls_first(), "role", "text", F.col("repeated").asc_nulls_first()]

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done, open_, at = [], None, None
        for batch in batches:
            columns = [batch[c].tolist() for c in ("id", "turn", "role", "text", "repeated")]
            for id_, turn, role, text, repeated in zip(*columns):
                id_ = None if pd.isna(id_) else int(id_)
                if open_ is None or id_ != at:
                    if open_ is not None:
                        done.append((at, *open_.result()))
                    open_, at = Repair(spill), id_
                if role is not None:
                    open_.add(None if pd.isna(turn) else int(turn), role, text, None if repeated is None or pd.isna(repeated) else bool(repeated))
            if len(done) >= 1000:
                yield _frame(done)
                done = []
        if open_ is not None:
            done.append((at, *open_.result()))
        yield _frame(done)

    dealt = rows.select("id", F.col("turn").cast("string").alias("turn_text"), "turn", "role", "text", "repeated").repartition("id")
    dealt = dealt.sortWithinPartitions(*order)
    # ids and turns as text: pandas would turn those with nulls into floats and lose digits
    as_text = dealt.select(F.col("id").cast("string").alias("id"), F.col("turn_text").alias("turn"), "role", "text", "repeated")
    return as_text.mapInPandas(stream, RESULT)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [c.split()[0] for c in RESULT.split(", ")]
    frame = pd.DataFrame([r[1:] for r in rows], columns=names[1:])
    frame.insert(0, names[0], pd.array([r[0] for r in rows], dtype="Int64"))  # nulls beside whole numbers of any size
    return frame


class Fault(NamedTuple):
    """The least costs of a row's edits, and what it counts as."""

    kind: str  # blank, duplicate, truncated or nothing
    must_go: bool
    stay: int


def fault(text: str, seen: bool) -> Fault:
    last = LAST.search(text)
    if not last:
        return Fault("blank", True, 0)
    if seen:
        return Fault("duplicate", True, 0)
    if last[0] not in ".!?":
        return Fault("truncated", False, TRUNCATED)
    return Fault("", False, 0)


def _inserts() -> list[list[tuple[int, int]]]:
    """For every state the states that reach it by 0, 1 or 2 inserts; more only go round."""
    into: list[list[tuple[int, int]]] = [[] for _ in range(4)]
    for start in range(4):
        state, passed = start, set()
        for k in range(3):
            if state in passed:
                break
            passed.add(state)
            into[state].append((start, k))
            state = NEXT[state][WANTED[state]]
    return into


INSERTS = _inserts()


class Repair:
    """The stream through one conversation."""

    def __init__(self, spill: int = SPILL):
        self.cost, self.rank = [0, NEVER, NEVER, NEVER], [0, 0, 0, 0]
        self.back = tempfile.SpooledTemporaryFile(max_size=spill)
        self.rows = tempfile.SpooledTemporaryFile(max_size=spill)
        self.n = self.illegal = self.n_turns = 0
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.seen: set[bytes] = set()
        self.initial = self.first_turn = self.last_turn = None

    def add(self, turn: int | None, role: str, text: str, repeated: bool | None = None) -> None:
        """The next row; repeated tells what is known of its copies, else the digests so far do."""
        if turn is not None and turn != self.last_turn:
            self.n_turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        if repeated is None:
            digest = hashlib.blake2b(pickle.dumps((role, text)), digest_size=16).digest()
            repeated = digest in self.seen
            self.seen.add(digest)
        found = fault(text, repeated)
        if found.kind:
            self.counts[found.kind] += 1
        initial = role[:1]
        if self.n and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        self._step(initial, found)
        pickle.dump((role, text), self.rows)
        self.n += 1

    def _step(self, initial: str, found: Fault) -> None:
        """Least cost and least audit of every state after the row; a byte each says how.

        Audits that end with the same number of rows' edits are never prefixes of each
        other, so `rank`, their order, decides before what is added to them.
        """
        best: list[tuple | None] = [None] * 4
        for state in range(4):
            for start, inserts in INSERTS[state]:
                if self.cost[start] >= NEVER:
                    continue
                base = self.cost[start] + INSERT * inserts
                ways = [(base + DELETE, state, 0)]
                if not found.must_go:
                    if initial in NEXT[state]:
                        ways.append((base + found.stay, NEXT[state][initial], 1))
                    ways.append((base + REROLE + found.stay, NEXT[state][WANTED[state]], 2))
                for cost, to, edit in ways:
                    # the tail I..I and the edit; D sorts before I, I before K and R
                    candidate = (cost, self.rank[start], "I" * inserts + EDITS[edit], start | inserts << 2 | edit << 4)
                    if best[to] is None or candidate < best[to]:
                        best[to] = candidate
        order = sorted({b[1:3] for b in best if b})
        self.rank = [order.index(b[1:3]) if b else 0 for b in best]
        self.cost = [b[0] if b else NEVER for b in best]
        self.back.write(bytes(b[3] if b else 255 for b in best))

    def _end(self) -> tuple[int, int, int]:
        """(cost, state after the last row, inserts at the end) of the cheapest whole audit."""
        ends = [
            (self.cost[start] + INSERT * inserts, self.rank[start], inserts, start)
            for state in ACCEPTED for start, inserts in INSERTS[state] if self.cost[start] < NEVER
        ]
        cost, _, inserts, state = min(ends)
        return cost, state, inserts

    def _edits(self, state: int) -> bytearray:
        """Of every row the inserts before it and its edit, from the backpointers read from the end."""
        steps, window = bytearray(self.n), 1 << 16
        for begin in range((self.n - 1) // window * window, -1, -window):
            self.back.seek(begin * 4)
            part = self.back.read(4 * min(window, self.n - begin))
            for i in range(len(part) // 4 - 1, -1, -1):
                steps[begin + i] = part[4 * i + state]
                state = steps[begin + i] & 3
        return steps

    def result(self) -> tuple:
        """gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
        cost, state, at_end = self._end()
        steps = self._edits(state) if self.n else bytearray()
        audit, digest, state, begun = [], hashlib.sha256(), 0, False

        def write(role: str, text: str) -> None:
            nonlocal begun
            digest.update((("\n" if begun else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
            begun = True

        def insert(times: int) -> None:
            nonlocal state
            for _ in range(times):
                audit.append("I")
                write(ROLE[WANTED[state]], "")
                state = NEXT[state][WANTED[state]]

        self.rows.seek(0)
        for step in steps:
            role, text = pickle.load(self.rows)
            insert(step >> 2 & 3)
            edit = EDITS[step >> 4]
            audit.append(edit)
            if edit != "D":
                initial = role[:1] if edit == "K" else WANTED[state]
                write(role if edit == "K" else ROLE[initial], text)
                state = NEXT[state][initial]
        insert(at_end)
        self.back.close()
        self.rows.close()
        gaps = self.last_turn - self.first_turn + 1 - self.n_turns if self.n_turns else 0
        return (gaps, *self.counts.values(), self.illegal, cost, "".join(audit), digest.hexdigest())
