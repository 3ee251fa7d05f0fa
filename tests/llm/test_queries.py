from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from compare import connect, difference

SMALL = "/root/testdata/sf0.001"
CONTRACT = {
    "op1_": {"doc_id", "n_shingles", "component_id", "n_links"},
    "op2_": {"page_id", "url", "text", "n_chars"},
    "op3_": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op4_": {"doc_id", "n_pieces", "score", "round_trip"},
    "op6_": {"vec_id", "n_links", "component_id", "kept"},
    "op7_": {"doc_id", "held_out", "score", "predicted"},
    "op9_": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op10_": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    "op11_": {"conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"},
}
ROWS = {"op2_": "pages", "op6_": "embeddings", "op11_": "conversations"}


def test_one_query_for_each_operator():
    names = [n for n in entry_module.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry_module.queries()


@pytest.mark.parametrize("name", ["op5_exact_dedup", "op8_license_scan", "op12_benchmark_decontamination", "op13_hard_negatives"])
def test_query_agrees_with_sql(spark, name):
    assert difference(spark, connect(SMALL), SMALL, entry_module.queries()[name], entry_module.oracle_sql()[name]) is None


@pytest.mark.parametrize("prefix", CONTRACT)
def test_every_row_of_the_table_has_a_result(spark, prefix):
    name = next(n for n in entry_module.queries() if n.startswith(prefix))
    found = entry_module.queries()[name](spark, SMALL)
    assert CONTRACT[prefix] <= set(found.columns)
    key = found.columns[0]
    table = spark.read.parquet(f"{SMALL}/{ROWS.get(prefix, 'documents')}.parquet")
    assert {r[0] for r in found.select(key).collect()} == {r[0] for r in table.select(key).collect()}
