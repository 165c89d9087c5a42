from __future__ import annotations

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pleiad.functions import collections as C
from pleiad.functions import physics, sql
from pleiad.operators import histogram, joins
from pleiad.sources.events import read_events, writable, write_events


def mass(a: tuple, b: tuple) -> float:
    """The published analysis, in plain Python."""
    e = px = py = pz = 0.0
    for pt, eta, phi in (a, b):
        theta = 2 * math.atan(math.exp(-eta))
        x, y, z = abs(pt) * math.cos(phi), abs(pt) * math.sin(phi), abs(pt) / math.tan(theta)
        e, px, py, pz = e + math.sqrt(x * x + y * y + z * z + physics.MUON_MASS**2), px + x, py + y, pz + z
    return math.sqrt(max(e * e - px * px - py * py - pz * pz, 0))


PARTICLE = st.tuples(st.floats(-200, 200).filter(lambda x: abs(x) > 0.1), st.floats(-3, 3), st.floats(-3.2, 3.2))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(PARTICLE, PARTICLE), min_size=1, max_size=20))
def test_invariant_mass(spark, pairs):
    kind = "a struct<pt_: double, eta_: double, phi_: double>, b struct<pt_: double, eta_: double, phi_: double>"
    got = spark.createDataFrame(pairs, kind).select(physics.invariant_mass(F.col("a"), F.col("b"))).collect()
    for r, (a, b) in zip(got, pairs, strict=True):
        assert abs(r[0] - mass(a, b)) <= 1e-5 * max(1, mass(a, b))


def test_angles(spark):
    kind = "a struct<eta_: double, phi_: double>, b struct<eta_: double, phi_: double>"
    r = spark.createDataFrame([((0.0, 3.0), (1.0, -3.0))], kind).select(physics.delta_phi(F.col("a.phi_"), F.col("b.phi_")), physics.delta_r(F.col("a"), F.col("b"))).first()
    assert abs(r[0] - (6 - 2 * math.pi)) < 1e-12 and abs(r[1] - math.hypot(1, 6 - 2 * math.pi)) < 1e-12


def test_collections(spark):
    df = spark.sql("select array(struct(1 as k, 5 as v), struct(2 as k, 7 as v), struct(1 as k, 9 as v), struct(cast(null as int) as k, 1 as v)) as a, cast(null as array<int>) as none, array(struct(1 as key, 'x' as value), struct(2 as key, 'y' as value), struct(1 as key, 'z' as value)) as e")
    r = df.select(C.leading(F.col("a"), 2, lambda m: m["k"], lambda m: m["v"]).alias("top"), C.leading(F.col("a"), 9, lambda m: m["k"]).alias("all"), C.multiplicity(F.col("none")).alias("n"), C.map_last_wins(F.col("e")).alias("m"), C.multimap(F.col("e")).alias("mm"), C.total(F.col("a.v")).alias("t"), C.leading(F.col("none"), 2, lambda m: m).alias("gone")).first()
    assert [tuple(x) for x in r["top"]] == [(2, 7), (1, 9)] and r["all"][-1]["k"] is None and len(r["all"]) == 4
    assert (r["n"], r["m"], r["mm"], r["t"], r["gone"]) == (0, {1: "z", 2: "y"}, {1: ["x", "z"], 2: ["y"]}, 22.0, None)


def test_histogram_edges_and_merging(spark):
    x = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 0.99, 1.0, 9.999999999999999, 10.0, 11.0, float("nan"), float("inf"), float("-inf"), None)], "x double")
    h = histogram.histogram(x, F.col("x"), 10, 0.0, 10.0)
    counts = {r["bin"]: r["n"] for r in h.collect()}
    assert len(counts) == 12 and counts[0] == 2 and counts[1] == 2 and counts[2] == 1 and counts[10] == 1 and counts[11] == 3
    edges = {r["bin"]: (r["low_edge"], r["high_edge"]) for r in h.collect()}
    assert edges[0] == (None, 0.0) and edges[3] == (2.0, 3.0) and edges[11] == (10.0, None)
    twice = {r["bin"]: r["n"] for r in histogram.merged(h, h).collect()}
    assert twice == {k: 2 * v for k, v in counts.items()}
    sql.register(spark)
    assert [r[0] for r in x.selectExpr("bin_index(x, 10, 0, 10)").collect()] == [r[0] for r in x.select(histogram.bin_index(F.col("x"), 10, 0.0, 10.0)).collect()]


def test_asof_takes_the_latest_before(spark):
    left = spark.createDataFrame([(1, 5), (1, 1), (2, 9), (None, 3)], "k int, t int")
    right = spark.createDataFrame([(1, 2, "a"), (1, 5, "b"), (1, 5, "c"), (2, 10, "d")], "k int, at int, v string")
    assert sorted(map(str, map(tuple, joins.asof_join(left, right, "k", "t", "at", ["v"]).collect()))) == sorted(map(str, [(1, 5, "c"), (1, 1, None), (2, 9, None), (None, 3, None)]))


def test_asof_by_slots_is_the_same(spark):
    import random

    rng = random.Random(3)
    left = spark.createDataFrame([(rng.choice([1, 1, 1, 2, None]), rng.randint(0, 400), i) for i in range(300)], "k int, t int, i int")
    right = spark.createDataFrame([(rng.choice([1, 1, 3, None]), rng.randint(0, 400), float(i)) for i in range(60)], "k int, at int, v double")
    whole = joins.asof_join(left, right, "k", "t", "at", ["v"]).collect()
    split = joins.asof_join(left, right, "k", "t", "at", ["v"], lambda t: F.floor(t / 25)).collect()
    assert sorted(map(str, whole)) == sorted(map(str, split)) and any(r["v"] is not None for r in whole)


def test_range_and_salted_joins(spark):
    points = spark.createDataFrame([(float(i) / 3,) for i in range(-30, 60)], "x double")
    ranges = spark.createDataFrame([(0.0, 5.0), (-3.5, 12.25), (4.0, 4.0), (7.0, 6.0)], "a double, b double")
    got = joins.range_join(points, ranges, F.col("x"), F.col("a"), F.col("b"), 2.0)
    plain = points.join(ranges, (F.col("x") >= F.col("a")) & (F.col("x") < F.col("b")))
    assert got.columns == plain.columns and sorted(got.collect()) == sorted(plain.collect())
    left = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 0)], "k int, v int")
    right = spark.createDataFrame([(1, "one"), (1, "uno"), (3, "three")], "k int, name string")
    assert sorted(joins.salted_join(left, right, "k", 4).collect()) == sorted(left.join(right, "k").collect())


def test_writing_drops_what_parquet_cannot_hold(spark, tmp_path):
    df = spark.sql("select 1 as a, null as gone, struct() as empty, array(struct(2 as x, null as y, struct() as z)) as v, map('k', struct(null as n, 3 as m)) as m")
    assert writable(df).schema.simpleString() == "struct<a:int,v:array<struct<x:int>>,m:map<string,struct<m:int>>>"
    write_events(df, str(tmp_path / "out"))
    row = read_events(spark, str(tmp_path / "out")).first()
    assert (row["a"], row["v"][0]["x"], row["m"]["k"]["m"]) == (1, 2, 3)


def test_pairs_of_a_stream_within_a_time(spark, tmp_path):
    from pleiad.streaming import windows

    rows = spark.sql("select cast(id % 3 as long) as user_id, if(id % 2 = 0, 'a', 'b') as event_type, timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, cast(id as int)) as ts, 1D as value from range(40)")
    rows.coalesce(1).write.parquet(str(tmp_path / "e"))
    for within in (None, "3 hours"):
        got = windows.drained(windows.first_seen(windows.event_stream(spark, str(tmp_path / "e")), within), "append").collect()
        assert sorted(tuple(r) for r in got) == sorted((u, t) for u in range(3) for t in "ab")
    rows.where("false").write.parquet(str(tmp_path / "none"))
    assert windows.drained(windows.first_seen(windows.event_stream(spark, str(tmp_path / "none"))), "append").collect() == []
    assert windows.windowed_counts(spark, str(tmp_path / "none")).collect() == []


def test_leading_keeps_ties_in_order_and_maps_need_no_ordering_of_values(spark):
    df = spark.sql("select array(struct(1D as k, map(1, 2) as v, 'x' as n), struct(1D as k, map(3, 4) as v, 'y' as n), struct(2D as k, map() as v, 'z' as n)) as a, array(struct('p' as key, map(1, 1) as value), struct('p' as key, map(2, 2) as value)) as e, array() as none")
    r = df.select(C.leading(F.col("a"), 3, lambda m: m["k"])["n"].alias("n"), C.map_last_wins(F.col("e")).alias("m"), C.multimap(F.col("e")).alias("mm")).first()
    assert r["n"] == ["z", "x", "y"] and r["m"] == {"p": {2: 2}} and r["mm"] == {"p": [{1: 1}, {2: 2}]}
