from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pandas as pd
import pytest

from tallyforge.llm import conversation_repair as C

ROWS = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?")
FULL = {"u": "user", "a": "assistant"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(key.encode()) % 20
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        if code == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(code, 1)
    return out


def faults(rows):
    out, seen = [], set()
    for _, _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, kinds, insert=5, delete=2):
    """The least (cost, audit) of all edit sequences, by trying them in order of cost."""
    heap, passed = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, initials, out = heapq.heappop(heap)
        if (audit, i, initials) in passed:
            continue
        passed.add((audit, i, initials))
        if i == len(rows) and LEGAL.fullmatch(initials):
            return cost, audit, "\n".join(f"{r}:{t}" for r, t in out)
        # what no further edit makes legal is left out
        if not re.fullmatch(r"s?(ua)*u?", initials):
            continue
        for c in "ua":
            heapq.heappush(heap, (cost + insert, audit + "I", i, initials + c, out + ((FULL[c], ""),)))
        if i < len(rows):
            _, _, role, text = rows[i]
            heapq.heappush(heap, (cost + delete, audit + "D", i + 1, initials, out))
            if kinds[i] not in ("blank", "duplicate"):
                more = 5 if kinds[i] == "truncated" else 0
                heapq.heappush(heap, (cost + more, audit + "K", i + 1, initials + (role[:1] or " "), out + ((role, text),)))
                for c in "ua":
                    heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, initials + c, out + ((FULL[c], text),)))


def expected(rows):
    """What the contract says of one conversation, after damage."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    kinds = faults(rows)
    cost, audit, text = cheapest(rows, kinds)
    turns = {r[1] for r in rows if r[1] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    counts = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def made(convs, seed=1):
    dice, rows = random.Random(seed), []
    for conv in range(convs):
        turn = dice.randint(0, 3)
        for _ in range(dice.randint(1, 7)):
            role = dice.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = dice.choice(["Yes.", "No!", "Why?", "so", "", None, " \t", "Well.\n", f"Number {dice.randint(0, 9)}."])
            rows.append((conv, turn if dice.random() < 0.95 else None, role, text))
            turn += dice.choice([1, 1, 1, 2, 0])
    return rows


def by_conv(frame):
    return {r["id"]: tuple(r)[1:] for r in frame.collect()}


def grouped(rows, convs):
    groups = {c: [] for c in convs}
    for r in rows:
        groups[r[0]].append(r)
    return groups


def test_against_brute_force(spark):
    rows = made(250)
    found = by_conv(C.repair(C.damage(spark.createDataFrame(rows, ROWS))))
    want = {c: expected(g) for c, g in grouped(damaged(rows), {r[0] for r in rows}).items()}
    assert found == want
    assert any("R" in w[6] for w in want.values()) and any("D" in w[6] for w in want.values())
    assert any(not w[6] for w in want.values())  # conversations that are dropped whole stay


def test_marked_duplicates_and_spilled_rows_change_nothing(spark):
    rows = made(60, seed=2)
    frame = C.plain(spark.createDataFrame(rows, ROWS))
    small = by_conv(C.repair(frame))
    assert by_conv(C.repair(frame, remembered=2, spill=16)) == small
    filled = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert small == {c: expected(g) for c, g in grouped(filled, {r[0] for r in rows}).items()}


def test_state_is_carried_across_arrow_batches(spark):
    rows = made(40, seed=3)
    frame = C.damage(spark.createDataFrame(rows, ROWS))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    whole = by_conv(C.repair(frame))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        assert by_conv(C.repair(frame)) == whole
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_a_giant_conversation(spark):
    """100,000 turns in one conversation, longer than the digests and bytes kept."""
    giant = spark.range(100_000).selectExpr("7L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "concat('Turn ', id, '.') AS text")
    row = C.repair(C.plain(giant), remembered=1000, spill=1 << 12).first()
    text = "\n".join(f"{'assistant' if i % 2 else 'user'}:Turn {i}." for i in range(100_000))
    assert tuple(row) == (7, 0, 0, 0, 0, 0, 0, "K" * 100_000, hashlib.sha256(text.encode()).hexdigest())


def test_nulls_long_texts_repeated_rows_and_other_columns(spark):
    long = "word " * 200_000
    rows = [(None, None, None, None), (None, None, None, None), (1, 1, "user", long + "end."), (1, 2, "assistant", long), (2, 5, "user", "A?"), (2, 5, "user", "A?")]
    frame = spark.createDataFrame(rows, ROWS).selectExpr("*", "'x' AS id", "1 AS repeated", "2 AS _id")
    found = by_conv(C.repair(C.damage(frame)))
    assert found == {c: expected(g) for c, g in grouped(damaged(rows), [None, 1, 2]).items()}


def test_empty_table(spark):
    assert C.repair(C.damage(spark.createDataFrame([], ROWS))).collect() == []


def test_inserts_where_they_are_cheaper(monkeypatch):
    """At the given costs a delete always beats an insert; at others inserts have to be right too."""
    monkeypatch.setattr(C, "INSERT", 1)
    monkeypatch.setattr(C, "DELETE", 3)
    audits = []
    for rows in grouped(made(200, seed=5), range(200)).values():
        rows = [(c, i, r or " ", t or " ") for i, (c, _, r, t) in enumerate(rows)]
        one = C.Repair()
        for _, turn, role, text in rows:
            one.add(turn, role, text)
        cost, audit, text = cheapest(rows, faults(rows), insert=1, delete=3)
        assert one.result()[5:] == (cost, audit, hashlib.sha256(text.encode()).hexdigest())
        audits.append(audit)
    assert sum("I" in a for a in audits) > 50


@pytest.mark.parametrize("text, kind", [("", "blank"), (" \t\x0b", "blank"), ("a", "truncated"), ("a. \n", ""), (" ", "truncated"), ("?", "")])
def test_faults(text, kind):
    assert C.fault(text, False).kind == kind
    assert C.fault(text, True).kind == (kind if kind == "blank" else "duplicate")


def test_nothing_is_left_of_large_ids(spark):
    big = (1 << 62) + 1
    found = C.repair(C.plain(spark.createDataFrame([(big, big, "user", "A."), (big, None, "user", "B."), (None, 1, "user", "C.")], ROWS)))
    assert {r["id"]: r["gaps"] for r in found.collect()} == {big: 0, None: 0}
    assert isinstance(found.toPandas(), pd.DataFrame)
