from __future__ import annotations

import duckdb
import pandas as pd

from tallyforge.llm import license_scan as L

APACHE, MIT = L.TEMPLATES[0][1], L.TEMPLATES[2][1]
FILES = [
    (1, "a/LICENSE", "The MIT License\n\n" + L.TEMPLATES[3][1] + "\nmore text of the licence"),
    (2, "a/x.py", "import os\nprint(1)"),
    (3, "a/b/c/y.py", "nothing here"),
    (4, "a/b/z.py", "# " + APACHE + "\ncode = 1"),
    (5, "a/b/c/COPYING", APACHE),
    (6, "a/b/c/d/e.py", "x"),
    (7, "other/f.py", "x"),
    (8, "ab/g.py", "x"),
    (9, "note.txt", "A story that goes on for some words.\nAll rights reserved."),
    (10, "a/copyright notes.txt", "copyright is a long subject that this file talks about without a licence of any kind in sight"),
    (11, None, None),
    (12, "a/", ""),
    (13, "a/x.py", "import os\nprint(1)"),
    (None, "a/n.py", "x"),
    (14, "big/x.txt", "filler line\n" * 50_000 + MIT),
    (15, "tie/x.txt", "Licensed under CC BY-NC 4.0.\nfiller\n" + MIT),
]
COLUMNS = "doc_id long, path string, text string, licence string, note string"


def scan(spark, rows):
    return L.scan(spark.createDataFrame([(*r, "clash", "clash") for r in rows], COLUMNS), "doc_id", "path", "text")


def test_headers_files_and_inheritance(spark):
    found = {(r["doc_id"], r["licence"], r["inherited_from"]) for r in scan(spark, FILES).collect()}
    assert found == {
        (1, "MIT", None), (2, "MIT", "a"), (3, "Apache-2.0", "a/b/c"), (4, "Apache-2.0", None), (5, "Apache-2.0", None),
        (6, "Apache-2.0", "a/b/c"), (7, None, None), (8, None, None), (9, "Proprietary", None), (10, "MIT", "a"), (11, None, None),
        (12, "MIT", "a"), (13, "MIT", "a"), (None, "MIT", "a"), (14, "MIT", None), (15, "CC-BY-NC-4.0", None),
    }
    assert scan(spark, FILES).count() == len(FILES)


def test_sql_agrees(spark):
    rows = [r for r in FILES if r[0] is not None]
    found = scan(spark, rows).toPandas()
    con = duckdb.connect()
    con.register("files", pd.DataFrame(rows, columns=["doc_id", "path", "text"]))
    want = con.execute(L.oracle("coalesce(path, '')", "files")).df()
    key = lambda f: sorted(map(str, f[["doc_id", "licence", "score", "inherited_from"]].astype(object).where(f.notna(), None).values.tolist()))
    assert key(found) == key(want)


def test_long_notes(spark):
    rows = [
        (1, "a/x.txt", "All rights reserved.\n" * 100_000),
        (2, "b/x.txt", "It is liable to be reliable.\n" * 100_000 + "filler\n" + MIT),
    ]
    assert {(r["doc_id"], r["licence"], r["score"]) for r in scan(spark, rows).collect()} == {(1, "Proprietary", 1.0), (2, "MIT", 1.0)}


def test_sql_agrees_on_line_ends(spark):
    rows = [
        (1, "c/x.txt", f"one\r\n{MIT}\r\nAll rights reserved.\r\n\r\n{APACHE}\n\n\n{MIT}"),
        (2, "d/x.txt", f"\n{MIT}\u2028filler\rfiller\u0085\n" + "filler\n" * 100 + "\n"),
        (3, "e/x.txt", f"{MIT}\r\nAll rights reserved.\r\n"),
    ]
    con = duckdb.connect()
    con.register("files", pd.DataFrame(rows, columns=["doc_id", "path", "text"]))
    want = con.execute(L.oracle("coalesce(path, '')", "files")).df()
    key = lambda f: sorted(map(str, f[["doc_id", "licence", "score", "inherited_from"]].astype(object).where(f.notna(), None).values.tolist()))
    assert key(scan(spark, rows).toPandas()) == key(want)


def test_empty_table(spark):
    assert scan(spark, []).collect() == []


def test_no_python_in_the_plan(spark):
    plan = scan(spark, FILES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
