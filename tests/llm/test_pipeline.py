from __future__ import annotations

import random

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline

from . import helpers as H
from .test_classifiers import corpus


def test_stages_in_order_and_whole(spark, tmp_path):
    docs, marks = corpus(260)
    rng = random.Random(1)
    base = H.prose(rng, 300, 3000)
    docs += [(1000 + k, base.replace(base.split()[k], "edited", 1), "en", "b", None) for k in range(5)]
    docs += [(2000 + i, f"a line that all share\n{H.prose(rng, 40, 4000)}", "en", "b", None) for i in range(12)]
    docs += [(3000, None, None, None, None), (None, "no id", None, None, None), docs[0]]
    top = str(tmp_path)
    spark.createDataFrame(docs, H.DOCS).write.parquet(f"{top}/documents.parquet")
    H.labels(spark, marks).write.parquet(f"{top}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "packing"]
    now = spark.read.parquet(f"{top}/documents.parquet")
    names, kept = now.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, top).write.parquet(f"{top}/{name}")
        now = spark.read.parquet(f"{top}/{name}")
        kept[name] = now.collect()
        assert name == "packing" or now.columns == names
    toxic = {i for i, _, t in marks if t}
    left = {r["doc_id"] for r in kept["toxicity"]}
    assert len(left & toxic) <= 0.1 * len(toxic) and len({d[0] for d in docs} - toxic - left) <= 5
    assert len(kept["line_dedup"]) == len(kept["toxicity"])
    assert not any("a line that all share" in (r["text"] or "") for r in kept["line_dedup"])
    near = [r["doc_id"] for r in kept["near_dedup"]]
    assert sum(1000 <= (i or 0) < 1005 for i in near) == 1 and len(near) == len(set(near))
    assert {i for i in near if i is not None and 2000 <= i < 2012} == set(range(2000, 2012))
    assert {r["doc_id"] for r in kept["mixing"]} == set(near)
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = sum(len(plain.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in kept["mixing"])
    assert sum(r["length"] for r in kept["packing"]) == tokens


def test_run_gives_the_last_stage(spark, tmp_path):
    docs, marks = corpus(40)
    spark.createDataFrame(docs, H.DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    H.labels(spark, marks).write.parquet(f"{tmp_path}/labels.parquet")
    from pathlib import Path

    from pleiad.llm.common import shared_dir
    from pleiad.llm.shared_files import local

    kept = lambda: {f for d in Path(local(shared_dir(spark))).iterdir() if d.is_dir() for f in d.glob("rdd-*")}
    before = kept()
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    assert kept() <= before


def written(spark, folder, docs, marks) -> str:
    docs.write.parquet(f"{folder}/documents.parquet")
    H.labels(spark, marks).write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_empty_tables_run_through(spark, tmp_path):
    assert corpus_pipeline.run(spark, written(spark, tmp_path / "none", H.none(spark), [])).collect() == []
    docs, marks = corpus(30)
    assert corpus_pipeline.run(spark, written(spark, tmp_path / "unlabelled", spark.createDataFrame(docs, H.DOCS), [])).count() > 0


CLASHES = ("score", "threshold", "rejected", "row", "keep", "doc", "group", "mix_tokens", "mix_ratio", "mix_row", "label", "own_id", "k", "node", "a.b", "c`d")


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    docs = H.clashing(spark, *CLASHES)
    top = written(spark, tmp_path, docs, [(8, 1, 1), (3, 1, 0), (50, 1, 0), (52, 1, 1)])
    now = spark.read.parquet(f"{top}/documents.parquet")
    names = now.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, now, top).write.parquet(f"{top}/{name}")
        now = spark.read.parquet(f"{top}/{name}")
        assert now.columns == names
        assert now.select(*(F.col("`" + c.replace("`", "``") + "`") for c in CLASHES)).distinct().collect() in ([("mine",) * len(CLASHES)], [])
    assert corpus_pipeline.STAGES[-1][1](spark, now, top).count() > 0


def test_n_chars_follows_the_text(spark, tmp_path):
    rows = [(i, f"a line of all\nown {i} é{'z' * i}\nA LINE of all ", None, None, 999) for i in range(12)]
    rows += [(50, None, None, None, 7), (51, "", None, None, 3), (52, "x" * 100_000 + "\na line of all", None, None, None)]
    got = {r["doc_id"]: r for r in corpus_pipeline.drop_shared_lines(spark, spark.createDataFrame(rows, H.DOCS), str(tmp_path)).collect()}
    assert all(got[i]["text"] == f"own {i} é{'z' * i}" and got[i]["n_chars"] == len(got[i]["text"]) for i in range(12))
    assert got[50]["text"] is None and got[50]["n_chars"] == 7 and got[51]["n_chars"] == 0 and got[52]["n_chars"] == 100_000
