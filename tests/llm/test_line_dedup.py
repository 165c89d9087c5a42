from __future__ import annotations

import hashlib
import zlib

import numpy as np

from pleiad.llm import line_dedup

from . import helpers as H

WHITE = " \t\n\x0b\x0c\r"


def plain(rows: list[tuple], least: int) -> list[tuple]:
    found: dict[str, set] = {}
    key = lambda line: line.strip(WHITE).translate(H.LOWER)
    for r in rows:
        for line in (r[1] or "").split("\n"):
            found.setdefault(key(line), set()).add(r[0])
    dropped = {k for k, v in found.items() if k and len(v) >= least}
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if key(x) not in dropped]
        out.append((r[0], len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def test_digest_equals_plain_version(spark):
    for least in (2, 5, 10, 15):
        docs = H.clashing(spark, "keep", "doc", "text_key", "pos", "h1", "n_lines")
        got = line_dedup.line_digest(docs, least)
        assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
        assert sorted(map(tuple, got.collect()), key=str) == plain(H.awkward_rows(), least)


def test_hot_line_over_many_partitions(spark):
    rows = [(i, f"everywhere\nmine {i}\n" + "twice\n" * (i % 2) + f"few {i % 80}", None, None, None) for i in range(600)]
    docs = spark.createDataFrame(rows, H.DOCS).repartition(7)
    assert sorted(map(tuple, line_dedup.line_digest(docs).collect()), key=str) == plain(rows, 10)


def test_bitmaps_are_compressed_and_whole(spark):
    rows = [(i, "\n".join([f"own {i} {j}" for j in range(20)] + ["shared"]), None, None, None) for i in range(12)]
    got = line_dedup.keep_bitmaps(spark.createDataFrame(rows, H.DOCS)).collect()
    assert len(got) == 12
    for r in got:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(r["keep"]), np.uint8), bitorder="little")
        assert bits[:20].all() and not bits[20] and bits[21:].all()


def test_stage_keeps_rows_and_columns(spark):
    docs = H.clashing(spark, "keep", "doc", "pos")
    got = line_dedup.without_shared_lines(docs)
    assert got.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    assert got.count() == docs.count() and texts[0] is None and texts[25] == "only 5 here\n\nlast2"
    assert line_dedup.line_digest(H.none(spark)).collect() == []
    assert line_dedup.without_shared_lines(H.none(spark)).collect() == []


def test_n_chars_follows_the_text(spark):
    rows = [(i, f"all have this\nnaïve {i} 日本", "en", "a", len(f"all have this\nnaïve {i} 日本")) for i in range(12)] + [(90, "alone", "en", "a", 5), (91, None, "en", "a", None), (92, None, "en", "a", 7), (93, "all have this", "en", "a", 13)]
    got = {r["doc_id"]: r for r in line_dedup.without_shared_lines(spark.createDataFrame(rows, H.DOCS)).collect()}
    assert got[3]["text"] == "naïve 3 日本" and got[93]["text"] == ""
    assert all(got[i]["n_chars"] == len(got[i]["text"]) for i in [*range(12), 90, 93])
    assert got[91]["n_chars"] is None and got[92]["n_chars"] == 7
    bare = line_dedup.without_shared_lines(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"))
    assert bare.columns == ["doc_id", "text"] and bare.count() == len(rows)


def test_runs_over_many_batches_and_partitions(spark):
    import random

    rng = random.Random(6)
    rows = [(rng.choice([i, i, i // 2, None]), "\n".join(f"line {int(rng.paretovariate(0.4)) % 900}" for _ in range(rng.randint(0, 9))), None, None, None) for i in range(2500)]
    docs = spark.createDataFrame(rows, H.DOCS).repartition(5)
    for least in (2, 10, 40):
        assert sorted(map(tuple, line_dedup.line_digest(docs, least).collect()), key=str) == plain(rows, least)
