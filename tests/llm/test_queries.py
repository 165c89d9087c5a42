from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__
from pleiad.llm.queries import ORACLES, QUERIES

TOP = "/root/testdata/sf0.001"
CONTRACT = {
    1: ["doc_id", "fingerprint", "component_id"],
    3: ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    5: ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    6: ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    7: ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    8: ["doc_id", "held_out", "score", "predicted"],
    9: ["query_id", "rank", "vec_id", "score"],
    10: ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
}


def test_ten_operators_and_the_pipeline_are_registered():
    names = __spark_entry__.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert set(QUERIES) | {"pipeline"} <= set(names)


@pytest.mark.skipif(not os.path.exists(TOP), reason="no tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_whole_tables_give_the_stated_columns(spark, name):
    df = QUERIES[name](spark, TOP)
    stated = CONTRACT.get(int(name[2:].split("_")[0]), [])
    assert df.columns[: len(stated)] == stated
    rows = df.collect()
    if "doc_id" in df.columns:
        assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in spark.read.parquet(f"{TOP}/documents.parquet").select("doc_id").collect()}
    if name in ORACLES:
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{TOP}/documents.parquet')")
        cursor = con.execute(ORACLES[name])
        order = [[c[0] for c in cursor.description].index(c) for c in df.columns]
        assert sorted(map(tuple, rows)) == sorted(tuple(r[i] for i in order) for r in cursor.fetchall())
