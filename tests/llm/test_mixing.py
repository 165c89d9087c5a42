from __future__ import annotations

import math
import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from pleiad.llm import mixing

from . import helpers as H


def corpus(spark, sizes: dict):
    rng = random.Random(1)
    rows = [(i, H.prose(rng, rng.randint(1, 60)), "en", s, None) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    return spark.createDataFrame(rows, H.DOCS), rows


def test_exponent_meets_the_entropy(spark):
    docs, rows = corpus(spark, {"big": 900, "mid": 150, "low": 60, None: 40})
    totals: dict = {}
    for r in rows:
        totals[r[3]] = totals.get(r[3], 0) + len(H.words(r[1])) + 1
    total = sum(totals.values())
    sources = spark.createDataFrame(list(totals.items()), "source string, t long")
    m = mixing.solve(sources, 0.9, 50.0, None)
    q = [(t / total) ** m.exponent / m.norm for t in totals.values()]
    assert math.isclose(sum(q), 1, rel_tol=1e-9)
    assert math.isclose(-sum(x * math.log(x) for x in q), 0.9 * math.log(4), rel_tol=1e-6)
    limited = mixing.solve(sources, 0.9, 1.5, None)
    q = [(t / total) ** limited.exponent / limited.norm for t in totals.values()]
    assert math.isclose(max(limited.budget * x / t for x, t in zip(q, totals.values(), strict=True)), 1.5, rel_tol=1e-6)
    assert mixing.solve(sources, 0.0, 50.0, None).exponent == 1.0


def test_every_document_once_and_budgets_filled(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 300)
    docs, rows = corpus(spark, {"big": 700, "mid": 120, "low": 40, None: 30})
    got = mixing.mixed(docs, max_epochs=3.0).collect()
    seen: dict = {}
    for r in got:
        seen.setdefault(r["source"], {}).setdefault(r["doc_id"], []).append(r["mix_epoch"])
        assert 0 <= r["mix_key"] <= 1
        assert r["text"] == rows[r["doc_id"]][1]
    assert {i for s in seen.values() for i in s} == set(range(len(rows)))
    for s, docs_of in seen.items():
        assert all(sorted(e) == list(range(len(e))) for e in docs_of.values())
        counts = {len(e) for e in docs_of.values()}
        assert max(counts) - min(counts) <= 1 and max(counts) <= 3
    tokens = {s: sum(r["mix_tokens"] for r in got if r["source"] == s) for s in seen}
    for s in seen:
        weight = next(r["mix_weight"] for r in got if r["source"] == s)
        assert tokens[s] == pytest.approx(weight * sum(tokens.values()), rel=0.08, abs=130)


def test_a_budget_below_the_corpus(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 500)
    docs, rows = corpus(spark, {"big": 400, "low": 100})
    total = sum(len(H.words(r[1])) + 1 for r in rows)
    got = mixing.mixed(docs, entropy=0.0, budget=total / 2).agg(F.sum("mix_tokens").alias("n"), F.max("mix_epoch").alias("e")).first()
    assert got["e"] == 0 and total / 2 - 200 < got["n"] <= total / 2


def test_awkward_rows_and_empty_table(spark):
    docs = H.clashing(spark, "mix_key", "t", "goal", "blocks", "weight", "mix_ratio", "mix_row", "mix_hash", "mix_block", "turn", "start", "a.b")
    got = mixing.mixed(docs)
    assert got.columns == [c for c in docs.columns if c != "mix_key"] + ["mix_tokens", "mix_weight", "mix_epoch", "mix_key"]
    assert got.select("mix_ratio", "mix_row", "mix_hash", "mix_block", "turn", "start", "`a.b`").distinct().collect() == [("mine",) * 7]
    again = mixing.repeated(docs)
    assert again.schema == docs.schema and again.select("mix_key").distinct().collect() == [("mine",)] and again.count() == got.count()
    once = got.where("mix_epoch = 0").select("doc_id", "text", "source").collect()
    assert sorted(map(str, once)) == sorted(map(str, docs.select("doc_id", "text", "source").collect()))
    assert mixing.mixing_digest(H.none(spark)).collect() == []


def test_main_path_has_no_python(spark):
    plan = mixing.mixing_digest(H.awkward(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def xxh(*values) -> int:
    """The session's hash of a row: each value's XXH64 is the seed of the next one's, nulls aside."""
    import xxhash

    h = 42
    for kind, v in values:
        if v is not None:
            raw = v.encode() if kind == "s" else int(v).to_bytes(4 if kind == "i" else 8, "little", signed=True)
            h = xxhash.xxh64_intdigest(raw, h)
    return h - (1 << 64) if h >> 63 else h


def plain_mixture(rows: list, entropy: float, max_epochs: float, budget: float | None, block: int) -> list:
    """(doc_id, source, epoch, weight) of the mixture, by lists alone; the exponent by plain bisection."""
    size = {i: len(H.words(r[1])) + 1 for i, r in enumerate(rows)}
    total: dict = {}
    for i, r in enumerate(rows):
        total[r[3]] = total.get(r[3], 0) + size[i]
    n = sum(total.values())
    share = {s: t / n for s, t in total.items()}

    def weights(x: float) -> dict:
        z = sum(p**x for p in share.values())
        return {s: p**x / z for s, p in share.items()}

    def tokens(x: float) -> float:
        return budget if budget is not None else max(total[s] / w for s, w in weights(x).items())

    def bisected(holds) -> float:
        if not holds(0.0):
            return 0.0
        if holds(1.0):
            return 1.0
        a, b = 0.0, 1.0
        for _ in range(60):
            a, b = ((a + b) / 2, b) if holds((a + b) / 2) else (a, (a + b) / 2)
        return a

    even = bisected(lambda x: -sum(w * math.log(w) for w in weights(x).values()) >= entropy * math.log(len(share)))
    floor = bisected(lambda x: max(w * tokens(x) / total[s] for s, w in weights(x).items()) > max_epochs * (1 + 1e-12))
    x = max(even, floor)
    out = []
    for s, w in weights(x).items():
        goal, blocks = w * tokens(x), -(-total[s] // block)
        hashes = {i: xxh(("i", mixing.SEED), ("l", r[0]), ("s", r[1])) for i, r in enumerate(rows) if r[3] == s}
        cells = math.ceil(math.sqrt(blocks))
        for epoch in range(max(1, math.ceil(goal / total[s] - 1e-9))):
            def place(b: int) -> tuple:
                turn = xxh(("i", mixing.SEED), ("s", s), ("l", epoch), ("l", b))
                return (turn % (1 << 64) >> 20) % cells, turn, b

            left = goal - epoch * total[s] + 1e-6 * total[s]
            for b in sorted({h % blocks for h in hashes.values()}, key=place):
                own = sorted((xxh(("i", mixing.SEED), ("l", epoch), ("l", h)), i) for i, h in hashes.items() if h % blocks == b)
                for _, same in groupby(own, key=lambda o: o[0]):
                    same = [i for _, i in same]
                    left -= sum(size[i] for i in same)
                    if left < 0:
                        break
                    out += [(rows[i][0], s, epoch, w) for i in same]
                if left < 0:
                    break
    return out


@pytest.mark.parametrize("entropy,max_epochs,budget,block", [(0.9, 2.0, None, 150), (0.9, 3.5, None, 90), (0.5, 50.0, 9000.0, 200), (1.0, 4.0, 2500.0, 60)])
def test_the_mixture_equals_a_plain_one(spark, monkeypatch, entropy, max_epochs, budget, block):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", block)
    docs, rows = corpus(spark, {"big": 260, "mid": 60, "low": 25, None: 20})
    got = mixing.mixed(docs, entropy, max_epochs, budget).select("doc_id", "source", "mix_epoch", "mix_weight").collect()
    plain = plain_mixture(rows, entropy, max_epochs, budget, block)
    assert sorted((str(r[1]), r[2], r[0]) for r in got) == sorted((str(r[1]), r[2], r[0]) for r in plain)
    assert {str(r[1]): r[3] for r in got} == pytest.approx({str(r[1]): r[3] for r in plain}, rel=1e-6)
