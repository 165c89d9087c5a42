from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pleiad.llm import ngram
from pleiad.llm.common import remove

from . import helpers as H


class Plain:
    """The model with dictionaries."""

    def __init__(self, texts: list[list]):
        self.c = Counter(w for t in texts for w in t)
        self.pairs = Counter(p for t in texts for p in zip(["<s>", *t[:-1]], t, strict=True))
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.first = Counter(w for _, w in self.pairs)
        self.total, self.kinds = Counter(), defaultdict(lambda: [0, 0, 0])
        for (v, _), n in self.pairs.items():
            self.total[v] += n
            self.kinds[v][min(n, 3) - 1] += 1
        by = lambda c: [sum(1 for x in c.values() if x == k) for k in (1, 2, 3, 4)]
        self.high, self.low = ngram.discounts(by(self.pairs)), ngram.discounts(by(self.first))

    def p1(self, w) -> float:
        if not self.pairs:
            return 1 / (self.v + 1)
        spare = sum(self.take(n, self.low) for n in self.first.values()) / len(self.pairs)
        return (self.first[w] - self.take(self.first[w], self.low)) / len(self.pairs) + spare / (self.v + 1)

    @staticmethod
    def take(n: int, d: tuple) -> float:
        return d[min(n, 3) - 1] if n else 0.0

    def p2(self, v, w) -> float:
        if not self.total[v]:
            return self.p1(w)
        n = self.pairs[v, w]
        spare = sum(a * b for a, b in zip(self.kinds[v], self.high, strict=True)) / self.total[v]
        return (n - self.take(n, self.high)) / self.total[v] + spare * self.p1(w)


def train_of(i) -> bool:
    return i is not None and zlib.crc32(str(i).encode()) % 10 != 0


def check(spark, rows: list[tuple], docs) -> None:
    tokens = [[*H.words(r[1]), None] for r in rows]
    m = Plain([t for t, r in zip(tokens, rows, strict=True) if train_of(r[0])])
    expected = []
    for t, r in zip(tokens, rows, strict=True):
        base = sum(math.log10((m.c[w] + 0.1) / (m.n + 0.1 * (m.v + 1))) for w in t)
        score = sum(math.log10(m.p2(v, w)) for v, w in zip(["<s>", *t[:-1]], t, strict=True))
        expected.append((r[0], not train_of(r[0]), len(t), sum(m.c[w] > 0 for w in t), m.n, base, score))
    got = sorted(map(tuple, ngram.scored(docs).collect()), key=lambda x: str((x[0], x[2])))
    for a, b in zip(got, sorted(expected, key=lambda x: str((x[0], x[2]))), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], abs=1e-6)
    for v in ("<s>", "w1x", "one", "never seen"):
        assert m.p1("no") + sum(m.p1(w) for w in m.c) == pytest.approx(1)
        assert m.p2(v, "no") + sum(m.p2(v, w) for w in m.c) == pytest.approx(1)


def test_scores_equal_plain_version(spark):
    check(spark, H.awkward_rows(), H.clashing(spark, "h", "n", "shard", "score", "held_out"))


def test_hot_pair_and_counts_beyond_a_byte(spark, monkeypatch):
    monkeypatch.setattr(ngram, "FLUSH", 500)
    rng = random.Random(3)
    rows = [(i, " ".join(["hot pair"] * rng.randint(1, 40)) + " " + H.prose(rng, 20), None, None, None) for i in range(80)]
    check(spark, rows, spark.createDataFrame(rows, H.DOCS).repartition(5))


def test_empty_table_and_nothing_to_learn(spark):
    assert ngram.scored(H.none(spark)).collect() == []
    rows = [(None, "a b", None, None, None)]
    r = ngram.scored(spark.createDataFrame(rows, H.DOCS)).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (3, 0, 0, 0.0, 0.0)


def test_held_out_text_is_likelier_than_by_words_alone(spark):
    rng = random.Random(8)
    rows = []
    for i in range(300):
        w, text = rng.randrange(50), []
        for _ in range(80):
            w = (w * 7 + rng.choice((1, 2))) % 50  # a word has two that follow it
            text.append(f"v{w}")
        rows.append((i, " ".join(text), None, None, None))
    got = ngram.scored(spark.createDataFrame(rows, H.DOCS)).where("held_out").selectExpr("avg(score)", "avg(base_score)").first()
    assert got[0] > 0.4 * got[1]


def folders(spark, name: str) -> set:
    import os

    from pleiad.llm.common import shared_dir
    from pleiad.llm.shared_files import local

    return {f for f in os.listdir(local(shared_dir(spark))) if f.startswith(name)}


def test_files_are_removed_and_a_missing_one_raises(spark):
    before = folders(spark, "ngram-")
    docs = spark.createDataFrame([(i, f"a b c d{i % 7}", None, None, None) for i in range(60)], H.DOCS)
    assert ngram.scored(docs).count() == 60 and folders(spark, "ngram-") == before
    model = ngram.fit(docs)
    assert model.pair_shards and model.word_shards
    got = ngram.with_scores(docs, model, F.lit(False))
    assert got.count() == 60
    remove(spark, f"{model.top}/pairs")
    with pytest.raises(Exception, match="No such file"):
        got.collect()
    remove(spark, model.top)


def test_checkpoints_are_released(spark):
    from pleiad.llm.common import checkpointed, release, releasing

    with releasing():
        a = checkpointed(spark.range(5))
        assert a.count() == 5
    with pytest.raises(Exception):  # noqa: B017
        a.collect()
    release(a)
