from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pleiad.llm import quality_model, toxicity

from . import helpers as H

NASTY = ["vilest", "grubber", "lowlife"]


def corpus(n: int = 500) -> tuple[list, list]:
    rng = random.Random(12)
    docs, marks = [], []
    for i in range(n):
        w = H.prose(rng, rng.randint(30, 120), 900).split()
        toxic, poor = rng.random() < 0.25, rng.random() < 0.2
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(NASTY))
        if poor:
            w = [x.upper() + "!!" for x in w]
        docs.append((i, " ".join(w), rng.choice(["en", "de"]), "a", None))
        marks.append((i, 0 if poor else 1, int(toxic)))
    return docs, marks


def out(i) -> bool:
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_toxicity_on_held_out_rows(spark):
    docs, marks = corpus()
    got = {r["doc_id"]: r for r in toxicity.toxicity_digest(spark.createDataFrame(docs, H.DOCS), H.labels(spark, marks)).collect()}
    assert all(r["held_out"] == out(i) and r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for i, r in got.items())
    held = [(got[i]["predicted"], got[i]["rejected"], t) for i, _, t in marks if out(i)]
    assert np.mean([p == t for p, _, t in held]) > 0.95
    assert np.mean([r for _, r, t in held if not t]) < 0.03


def test_scores_follow_the_text_alone(spark):
    docs, marks = corpus(200)
    model = toxicity.train(toxicity.sampled([(d[1].encode(), m[2], d[2]) for d, m in zip(docs, marks, strict=True)]))
    one = spark.createDataFrame([(1, docs[0][1], "en", "a", 1), (2, docs[0][1], None, None, None)], H.DOCS)
    a, b = toxicity.scored(one, model).collect()
    assert a["score"] == b["score"]
    score = toxicity.Scorer(model)
    long = ("w1x " * 45_000 + "vilest ") .encode()
    assert score(long) > score(b"w1x " * 45_000)  # the last word of a text of several chunks counts


def test_wide_filters_see_neighbours_over_chunks(monkeypatch):
    docs, marks = corpus(120)
    model = toxicity.train(toxicity.sampled([(d[1].encode(), m[2], d[2]) for d, m in zip(docs, marks, strict=True)]))
    text = docs[3][1].encode()
    whole = toxicity.Scorer(model).pooled(text)
    monkeypatch.setattr(toxicity, "CHUNK", 7)
    monkeypatch.setattr(toxicity, "REMEMBERED", 30)
    assert np.allclose(toxicity.Scorer(model).pooled(text), whole, atol=1e-6)


def test_toxicity_awkward_rows(spark):
    docs = H.clashing(spark, "score", "threshold", "rejected", "label")
    some = H.labels(spark, [(8, 1, 1), (11, 1, 0), (None, 1, 1), (50, None, None), (8, 0, 0), (51, 1, 7), (52, 1, -1)])
    model = toxicity.fitted(docs, some)
    assert toxicity.kept(docs, model).schema == docs.schema and {r["score"] for r in toxicity.kept(docs, model).collect()} <= {"mine"}
    got = toxicity.scored(docs, model)
    assert got.columns == [c for c in docs.columns if c not in ("score", "threshold", "rejected")] + ["score", "threshold", "rejected"]
    assert got.count() == docs.count() and got.where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.toxicity_digest(H.none(spark), some).collect() == []
    nothing = toxicity.toxicity_digest(docs, H.labels(spark, [])).collect()
    assert len(nothing) == docs.count() and len({r["score"] for r in nothing}) == 1


def test_ordinal_grades_on_held_out_rows(spark):
    docs, marks = corpus()
    got = {r["doc_id"]: r for r in quality_model.graded(spark.createDataFrame(docs, H.DOCS), H.labels(spark, marks)).collect()}
    held = [(got[i], q) for i, q, _ in marks if out(i)]
    assert np.mean([r["kept"] == bool(q) for r, q in held]) > 0.95
    assert all(r["held_out"] and 0 <= r["expected_grade"] <= 2 and 0 <= r["tail_probability"] <= 1 for r, _ in held)
    by = [np.mean([got[i]["expected_grade"] for i, q, t in marks if (q, t) == k]) for k in ((0, 0), (1, 1), (1, 0))]
    assert by[0] < by[1] < by[2]


def test_cuts_stay_ordered():
    hashed = quality_model.Hasher()
    model = quality_model.train([hashed(f"grade{g} text".encode()) for g in (0, 1, 2, 3) * 30], np.array([0, 1, 2, 3] * 30), 4)
    assert (np.diff(model.cuts) > 0).all()
    tails = model.tails(np.array([-2.0, 0.0, 3.0]))
    assert (np.diff(tails, axis=1) <= 0).all() and (np.diff(tails, axis=0) >= 0).all()


def test_grades_awkward_rows(spark):
    docs = H.clashing(spark, "kept", "expected_grade", "label", "quality")
    got = quality_model.graded(docs, H.labels(spark, [(8, 1, None), (11, 0, 0), (52, None, 1)]))
    assert got.count() == docs.count() and got.where("kept is null").count() == 0
    assert got.where(F.col("doc_id").isNull() & ~F.col("held_out")).count() == 0
    assert quality_model.graded(H.none(spark), H.labels(spark, [])).collect() == []
    assert quality_model.graded(docs, H.labels(spark, [])).select("tail_probability").distinct().count() <= 1 + 0


def plain_score(m: toxicity.Model, text: str) -> float:
    """The network over again, a window and a filter at a time."""
    found = toxicity.words(text.encode())
    x = [sum(m.embedding[r].astype(float) for r in toxicity.rows_of(w)) for w in found]
    pooled = []
    for w in m.filters:
        for f in range(toxicity.FILTERS):
            heard = [sum(float(x[i + j] @ w[j, :, f]) for j in range(len(w))) for i in range(len(x) - len(w) + 1)]
            pooled.append(max([0.0, *heard]))
    z = sum(max(p + b, 0) * o for p, b, o in zip(pooled, m.bias, m.out, strict=True)) + m.shift
    return 1 / (1 + np.exp(-(m.scale[0] * z + m.scale[1])))


def test_query_scores_equal_a_plain_network(spark):
    docs, marks = corpus(150)
    docs += [(900, "", "en", "a", None), (901, None, "en", "a", None), (902, "one", "en", "a", None), (903, "Two words", "en", "a", None)]
    df, given = spark.createDataFrame(docs, H.DOCS), H.labels(spark, marks)
    model = toxicity.fitted(df, given)
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity_digest(df, given).collect()}
    for doc in docs[::7] + docs[-4:]:
        assert got[doc[0]] == pytest.approx(plain_score(model, doc[1] or ""), abs=1e-4)


def test_training_takes_texts_of_any_length(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "LEAST_STEPS", 8)
    rng = random.Random(3)
    docs = [(i, H.prose(rng, 9_000) + (" zork" * 3 if i % 2 else ""), "en", "a", None) for i in range(12)]
    marks = [(i, i % 2, i % 2) for i in range(12)]
    df = spark.createDataFrame(docs, H.DOCS)
    assert all(len(d[1]) > 40_000 for d in docs)
    got = toxicity.fitted(df, H.labels(spark, marks))
    assert got.embedding is not None  # labels of both kinds were there
    grades = quality_model.fitted(df, H.labels(spark, marks))
    assert np.abs(grades.weights).sum() > 0


def test_slopes_of_the_likelihood():
    rng = np.random.default_rng(1)
    cuts = np.array([-1.0, 0.3, 1.1])
    s, y = rng.normal(0, 1.5, 40), rng.integers(0, 4, 40)

    def loss(s: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        at = [1 / (1 + np.exp(-(c - s))) for c in cuts]
        edges = np.stack([np.zeros(len(s)), *at, np.ones(len(s))], axis=1)
        i = np.arange(len(s))
        return -np.log(edges[i, y + 1] - edges[i, y])

    by_s, by_cut = quality_model.slopes(s, y, cuts)
    e = 1e-6
    assert np.allclose(by_s, (loss(s + e, cuts) - loss(s - e, cuts)) / (2 * e), atol=1e-6)
    for k in range(3):
        step = e * (np.arange(3) == k)
        assert np.allclose(by_cut[:, k], (loss(s, cuts + step) - loss(s, cuts - step)) / (2 * e), atol=1e-6)


def test_grades_equal_a_plain_model(spark):
    docs, marks = corpus(160)
    docs += [(900, "", "en", "a", None), (901, None, "en", "a", None)]
    df, given = spark.createDataFrame(docs, H.DOCS), H.labels(spark, marks)
    model = quality_model.fitted(df, given)
    got = {r["doc_id"]: r for r in quality_model.graded(df, given).collect()}
    for doc in docs:
        found: dict = {}
        words = (doc[1] or "").encode().split()
        for k in (0, 1):
            counts: dict = {}
            for w in words:
                shape = w.translate(quality_model.SHAPE)
                place = zlib.crc32(w if k == 0 else shape[:1] + b"|" + shape[-3:]) % quality_model.ROWS
                counts[place] = counts.get(place, 0) + 1
            size = sum(np.log1p(n) ** 2 for n in counts.values()) ** 0.5
            for place, n in counts.items():
                found[place] = found.get(place, 0) + np.log1p(n) / size
        if words:
            own = zlib.crc32(b"#fresh%d/%d" % (min(9, 10 * len(set(words)) // len(words)), min(12, len(words).bit_length()) // 3)) % quality_model.ROWS
            found[own] = found.get(own, 0) + 0.5
        else:
            found = {zlib.crc32(b"#none") % quality_model.ROWS: 1}
        s = sum(float(model.weights[p]) * v for p, v in found.items())
        tails = [1 / (1 + np.exp(-(s - c))) for c in model.cuts]
        assert np.isclose(got[doc[0]]["expected_grade"], sum(tails), atol=1e-5) and np.isclose(got[doc[0]]["tail_probability"], tails[0], atol=1e-5)
        assert got[doc[0]]["kept"] == (got[doc[0]]["tail_probability"] >= 0.5)
