from __future__ import annotations

import random

import pytest
from helpers import documents

import corpus_pipeline as C

TOXIC_WORDS = ["moronic", "idiotic", "scumbag"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    dice = random.Random(1)
    words = [f"word{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(400):
        text = dice.choices(words, k=dice.randint(30, 80))
        if i % 4 == 0:
            text[dice.randrange(len(text))] = dice.choice(TOXIC_WORDS)
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 4 == 0)))
    clean = [r for r in rows if r[0] % 4]
    rows += [(1000 + i, t) for i, t in clean[:30]]  # exact copies
    rows += [(2000 + i, t + " ending") for i, t in clean[30:60]]  # near copies
    rows += [(3000, clean[70][1] + " password=hunter2hunter2"), (3001, None), (3002, ""), (None, "a text without a key, of eight words")]
    folder = str(tmp_path_factory.mktemp("corpus"))
    documents(spark, [(i, t) for i, t in rows]).selectExpr("doc_id", "text", "'en' lang", "'s' source", "CAST(length(text) AS LONG) n_chars").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows, clean


def test_stages(spark, corpus):
    folder, rows, clean = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        rows_now = docs.collect()
        docs = spark.createDataFrame(rows_now, docs.schema)
        assert docs.columns == columns
        kept[name] = {r["doc_id"]: r["text"] for r in rows_now}
    toxic = {i for i, t in rows if t and any(w in t for w in TOXIC_WORDS)}
    all_ids = {i for i, _ in rows}
    assert set(kept["toxicity"]) == all_ids - toxic
    copies = {1000 + i for i, _ in clean[:30]} | {3002}
    assert set(kept["exact dedup"]) == all_ids - toxic - copies
    near = {2000 + i for i, _ in clean[30:60]} | {3000}
    assert set(kept["n-gram Jaccard join"]) == all_ids - toxic - copies - near
    assert not any("hunter2" in (t or "") for t in kept["secret scans"].values())
    assert set(kept["secret scans"]) == set(kept["n-gram Jaccard join"])


def test_run_packs_what_is_left(spark, corpus):
    pieces = C.run(spark, corpus[0]).collect()
    assert pieces and {p["doc_id"] for p in pieces} >= {1, 3001, None} and 1001 not in {p["doc_id"] for p in pieces}


def test_secrets_are_cut_out_and_counted(spark):
    docs = documents(spark, [(1, "é password=hunter2hunter2 z"), (2, "clean"), (3, None)])
    found = {r["doc_id"]: (r["text"], r["n_chars"]) for r in C.redact_secrets(spark, docs, "").collect()}
    assert found == {1: ("é [SECRET] z", 12), 2: ("clean", None), 3: (None, None)}


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert C.run(spark, str(tmp_path)).collect() == []
