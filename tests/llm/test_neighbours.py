from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from pleiad.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(vectors: dict[int, np.ndarray], k: int, every: int) -> list[tuple]:
    out = []
    for q, x in vectors.items():
        if q % every == 0:
            rest = [(-(float((x * y).sum()) / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum()))), i) for i, y in vectors.items() if i != q and len(y) == len(x)]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(rest)[:k])]
    return sorted(out)


def rows_of(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()))


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(2)
    x = {i: v for i, v in enumerate(rng.normal(size=(60, 8)).astype(np.float32).astype(float))}
    x[13] = x[7] = x[0]  # ties
    rows = [(i, [float(c) for c in v], 1) for i, v in x.items()]
    rows += [(500, None, 1), (550, [], 1), (600, [0.0] * 8, 1), (650, [1.0, None] * 4, 1), (700, [float("nan")] + [1.0] * 7, 1), (750, [float("inf")] + [1.0] * 7, 1), (None, [1.0] * 8, 1), rows[3]]
    x |= {800: np.array([1.0, 2.0]), 801: np.array([2.0, 1.0])}
    rows += [(800, [1.0, 2.0], None), (801, [2.0, 1.0], None)]
    got = rows_of(neighbours.nearest(spark.createDataFrame(rows, SCHEMA).withColumns({"dim": F.lit(1), "score": F.lit(2), "query": F.lit(3)})))
    expected = plain(x, 5, 50)
    assert [r[:3] for r in got] == [r[:3] for r in expected]
    assert np.allclose([r[3] for r in got], [r[3] for r in expected], atol=1e-15)


def test_recall_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SMALL_BLOCK", 800)
    x = dict(enumerate(np.random.default_rng(4).normal(size=(3000, 32)).astype(np.float32).astype(float)))
    got = rows_of(neighbours.nearest(spark.createDataFrame([(i, v.tolist(), 0) for i, v in x.items()], SCHEMA)))
    expected = plain(x, 5, 50)
    assert len(got) == len(expected) == 300
    assert len({r[0::2][:2] for r in got} & {r[0::2][:2] for r in expected}) / 300 >= 0.9


def test_savings_are_the_footrule_distance():
    rng = np.random.default_rng(7)
    x, pivots, prefix = rng.normal(size=(90, 12)), neighbours.apart(rng.normal(size=(40, 12)), 24), 9
    posted = neighbours.Posted(np.arange(90), x, pivots, prefix)
    unit = posted.x / neighbours.lengths(posted.x)[:, None]
    full = np.argsort(-(unit @ pivots.T), axis=1, kind="stable")[:, :prefix]
    asked = neighbours.nearest_pivots(rng.normal(size=(7, 12)), pivots, prefix)
    savings = posted.savings(asked)
    for q in range(7):
        at = {p: i for i, p in enumerate(asked[q].tolist())}
        footrule = [sum(abs(at.get(p, prefix) - (own.index(p) if p in own else prefix)) for p in range(len(pivots))) for own in full.tolist()]
        assert (prefix * (prefix + 1) - savings[q] == footrule).all()


def test_all_of_equal_distance_are_ranked_again():
    x = np.concatenate([np.eye(6)] * 40) + np.arange(240)[:, None] * 1e-9
    posted = neighbours.Posted(np.arange(240), x, np.eye(6), 2)
    ((ids, _),) = posted.search(np.array([1000]), np.eye(6)[2:3], neighbours.nearest_pivots(np.eye(6)[2:3], np.eye(6), 2), 5, 1)
    cosine = (x @ np.eye(6)[2]) / neighbours.lengths(x)
    assert ids.tolist() == np.lexsort((np.arange(240), -cosine))[:5].tolist()


def test_many_copies_give_the_smallest_ids(spark):
    rng = np.random.default_rng(6)
    x = {i: (np.ones(16) if i % 3 == 0 else rng.normal(size=16)) for i in range(1500)}
    got = rows_of(neighbours.nearest(spark.createDataFrame([(i, v.tolist(), 0) for i, v in x.items()], SCHEMA)))
    own = [r[2] for r in got if r[0] == 150]
    assert own == [0, 3, 6, 9, 12]


def test_empty_table_and_lone_vector(spark):
    assert neighbours.nearest(spark.createDataFrame([], SCHEMA)).collect() == []
    assert neighbours.nearest(spark.createDataFrame([(0, [1.0], 0)], SCHEMA)).collect() == []
