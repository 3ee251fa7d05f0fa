from __future__ import annotations

import hashlib

import pytest
from helpers import documents, with_clashing_columns

from tallyforge.llm.exact_dedup import drop_exact_copies, exact_groups

ROWS = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "a "), (7, "é"), (7, "é"), (None, "b"), (9, "x" * 300_000), (8, "x" * 300_000)]


def brute(rows, pick):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = pick(ids) if ids else None
        out.append((i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("keep, pick", [("smallest", min), ("largest", max)])
def test_groups_against_brute_force(spark, keep, pick):
    found = exact_groups(with_clashing_columns(documents(spark, ROWS)), keep=keep).collect()
    assert sorted(map(tuple, found), key=str) == brute(ROWS, pick)


def test_one_row_per_text_stays_with_its_columns(spark):
    docs = with_clashing_columns(documents(spark, ROWS))
    kept = drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], (r["text"] or "")[:3]) for r in kept.collect()) == [(1, "a"), (2, "b"), (4, ""), (6, "a "), (7, "é"), (8, "xxx")]
    assert {r["group"] for r in kept.collect()} == {"clash"}


def test_null_text_stays_null_when_it_is_the_kept_row(spark):
    assert [r["text"] for r in drop_exact_copies(documents(spark, [(1, None), (2, "")])).collect()] == [None]
    assert [r["text"] for r in drop_exact_copies(documents(spark, [(1, None), (2, "")]), keep="largest").collect()] == [""]


def test_ids_that_are_all_null(spark):
    rows = exact_groups(documents(spark, [(None, "a"), (None, "a")])).collect()
    assert [(r["keep_id"], r["group_size"], r["kept"]) for r in rows] == [(None, 2, True)] * 2


def test_empty_table(spark):
    assert exact_groups(documents(spark, [])).collect() == []
    assert drop_exact_copies(documents(spark, [])).collect() == []


def test_no_python_in_the_plan(spark):
    plan = exact_groups(documents(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
