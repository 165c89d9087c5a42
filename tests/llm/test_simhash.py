from __future__ import annotations

import random

import numpy as np
import xxhash

from pleiad.llm import simhash
from pleiad.llm.components import connected_components

from . import helpers as H


def plain_fingerprint(text: str | None, width: int = 3) -> int:
    w = H.words(text)
    shingles = [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids: list, fps: list[int], radius: int) -> list:
    up = list(range(len(fps)))

    def find(i: int) -> int:
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                up[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, x in enumerate(ids):
        if x is not None:
            r = find(i)
            least[r] = min(x, least.get(r, x))
    return [least.get(find(i)) for i in range(len(ids))]


def test_query_equals_plain_version(spark):
    rows = H.awkward_rows()
    fps = [plain_fingerprint(r[1]) for r in rows]
    expected = sorted(zip([r[0] for r in rows], [f"{f:016x}" for f in fps], plain_components([r[0] for r in rows], fps, 2), strict=True), key=str)
    got = simhash.near_duplicates(H.clashing(spark, "fp", "fingerprint", "component_id", "key"))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == expected
    assert fps[0] == 0


def test_empty_table(spark):
    assert simhash.near_duplicates(H.none(spark)).collect() == []
    assert simhash.one_of_each(H.none(spark)).collect() == []


def test_buckets_of_any_size_and_radius():
    rng = np.random.default_rng(1)
    for n, size, radius in ((30, 1, 2), (400, 1, 2), (300, 1, 5), (200, 4, 42), (5000, 1, 2)):
        centres = rng.integers(0, 1 << 63, (12, size), dtype=np.uint64)
        fps = centres[rng.integers(0, 12, n)].copy()
        for i in range(n):
            for b in rng.choice(64 * size, rng.integers(0, 2 * radius), replace=False):
                fps[i, b >> 6] ^= np.uint64(1) << np.uint64(b & 63)
        a, b = simhash.bucket_links(np.zeros(n, np.int64), fps, radius)
        up = np.arange(n)
        for _ in range(60):  # labels of the forest that came back
            np.minimum.at(up, a, up[b])
            np.minimum.at(up, b, up[a])
        near = np.bitwise_count(fps[a] ^ fps[b]).sum(axis=1) if len(a) else np.zeros(0)
        assert (near <= radius).all()
        label = np.arange(n)
        for _ in range(60):
            old = label.copy()
            for i in range(n) if n < 1000 else []:
                hit = np.bitwise_count(fps ^ fps[i]).sum(axis=1) <= radius
                label[hit] = label[hit].min()
            if (old == label).all():
                break
        if n < 1000:
            assert (label == up).all()


def labels(pairs: list[tuple], nodes: list) -> dict:
    up = {n: n for n in nodes}

    def root(x: int) -> int:
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_large_buckets_are_dealt_again(spark):
    rng = np.random.default_rng(3)
    fps = np.unique(np.concatenate((rng.integers(0, 1 << 11, 400), rng.integers(0, 1 << 40, 400), [(1 << 45) + (1 << i) for i in range(16)])))
    df = spark.createDataFrame([(int(f),) for f in fps], "fp long")
    near = lambda r: [(int(a), int(b)) for i, a in enumerate(fps) for b in fps[:i] if int(a ^ b).bit_count() <= r]
    for radius in (1, 2):
        got = [tuple(r) for r in simhash.links(df, radius, 60).collect()]
        assert all((a ^ b).bit_count() <= radius for a, b in got)
        assert labels(got, fps.tolist()) == labels(near(radius), fps.tolist())


def test_no_pair_of_a_large_bucket_is_lost_in_tiles(spark):
    rng = np.random.default_rng(8)
    fps = np.unique(rng.integers(0, 1 << 62, (700, 2), dtype=np.int64) & np.array([0x1F1F, (1 << 62) - 1]), axis=0)
    fps = np.concatenate((fps, fps[:200] ^ np.array([0, 5]), fps[100:250] ^ np.array([1 << 40, 0])))
    dealt = spark.createDataFrame([(int(i % 3 > 0), int(a), int(b)) for i, (a, b) in enumerate(fps)], "key long, f0 long, f1 long")
    node = lambda f: int(np.array(xxhash.xxh64_intdigest(np.asarray(f, np.int64).tobytes(), simhash.SEED), np.uint64).view(np.int64))
    lists = [set(r["nodes"]) for r in simhash.gathered(dealt, 3, 90).collect()]
    for i, a in enumerate(fps):
        for j in range(i):
            if (i % 3 > 0) == (j % 3 > 0) and sum(int(x).bit_count() for x in a ^ fps[j]) <= 3 and (a != fps[j]).any():
                assert any({node(a), node(fps[j])} <= own for own in lists)
    assert max(map(len, lists)) <= 180 + 90


def test_groups_equal_plain_similarity(spark):
    """Clusters of 5, 40 and 200 whose members are alike by 0.8 or more, and relatives below that."""
    rng = random.Random(11)
    rows, of = [], {}
    for c, size in enumerate((5, 40, 200)):
        base = H.prose(rng, 240, 6000).split()
        for _ in range(size):
            own = base.copy()
            for _ in range(rng.randint(0, 2)):
                own[rng.randrange(240)] = f"edit{rng.randrange(10**6)}"
            of[len(rows)] = c
            rows.append((len(rows), " ".join(own), "en", "a", None))
        for k in range(10):  # half of it is another text
            rows.append((len(rows), " ".join(base[:120]) + " " + H.prose(rng, 120, 6000), "en", "a", None))
    sets = {r[0]: set(simhash.shingle_hashes(r[1].encode(), simhash.SHINGLE)) for r in rows}
    pairs = [(a, b) for a in sets for b in sets if b < a and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    plain = labels(pairs, list(sets))
    group = {r["doc_id"]: r["group"] for r in simhash.similar_groups(spark.createDataFrame(rows, H.DOCS)).collect()}
    together = lambda own: {frozenset(i for i in own if own[i] == g) for g in set(own.values())}
    assert together(group) == together(plain)


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(5, x) for x in range(6, 40)] + [(7, 7), (300, 200), (200, 300)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {i: 5 for i in range(5, 40)} | {200: 200, 300: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_near_copies_leave_one(spark):
    rng = random.Random(2)
    rows, family = [], {}
    for f in range(40):
        base = H.prose(rng, 400, 5000).split()
        for k in range(4):
            own = base.copy()
            for _ in range(k * 2):  # shingle sets stay above the similarity of 0.8 to the first
                own[rng.randrange(400)] = "edited"
            family[len(rows)] = f
            rows.append((len(rows), " ".join(own), "en", "a", None))
    rows.append((999, rows[3][1], "en", "b", None))
    docs = spark.createDataFrame(rows + [rows[0], (None, "", None, None, None), (77_777, None, None, None, None)], H.DOCS)
    kept = [r["doc_id"] for r in simhash.one_of_each(docs).collect()]
    assert {family[i] for i in kept if i in family} == set(range(40))
    assert sum(i in family for i in kept) <= 42  # 160 documents in 40 groups
    assert 999 not in kept and kept.count(0) == 1


def test_true_copies_within_a_large_family_of_relatives(spark):
    rng = random.Random(4)
    core = H.prose(rng, 300, 5000)
    rows = []
    for i in range(1040):  # any two share the core alone: a similarity of 0.74 to 0.75
        tail = [f"t{i}n{j}" for j in range(50)]
        rows.append((i, f"{core} {' '.join(tail)}", "en", "a", None))
        if i < 200:  # a copy with one word changed: 0.97
            tail[25] = "edited"
            rows.append((10_000 + i, f"{core} {' '.join(tail)}", "en", "a", None))
    sets = {r[0]: set(simhash.shingle_hashes(r[1].encode(), simhash.SHINGLE)) for r in rows}
    like = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    assert 0.7 < min(like(0, i) for i in range(1, 1040)) and max(like(0, i) for i in range(1, 1040)) < 0.79 and like(0, 10_000) > 0.95
    group = {r["doc_id"]: r["group"] for r in simhash.similar_groups(spark.createDataFrame(rows, H.DOCS)).collect()}
    assert sum(group[i] == group[10_000 + i] for i in range(200)) >= 199
    assert len({group[i] for i in range(1040)}) == 1040


def test_forest_of_links_that_hold():
    rng = np.random.default_rng(5)
    sets = [np.zeros(0, np.uint32)] * 2
    for n in (1, 3, 40, 700):
        base = rng.integers(0, 1 << 32, 2 * n, dtype=np.uint32)
        sets += [np.unique(np.concatenate((rng.permutation(base)[: n + k], rng.integers(0, 1 << 32, k, dtype=np.uint32)))) for k in rng.integers(0, n + 1, 25)]
    sets = [sets[i] for i in rng.permutation(len(sets))]
    holds = lambda x, y: len(np.intersect1d(x, y)) >= 0.8 * len(np.union1d(x, y))
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if holds(sets[a], sets[b])]
    marks = np.zeros(64, bool)
    parent = simhash.alike(sets, 0.8, marks)
    assert not marks.any() and all(holds(sets[i], sets[p]) for i, p in enumerate(parent.tolist()) if i != p)
    own = simhash._joined(len(sets), np.arange(len(sets)), parent)
    assert (own == simhash._joined(len(sets), *np.array(pairs).T)).all()


def test_bands_agree_as_often_as_the_similarity_says():
    rng = np.random.default_rng(13)
    agree = {0.5: 0, 0.8: 0, 1.0: 0}
    for similarity in agree:
        for _ in range(60):
            shared, apart = round(300 * similarity), 300 - round(300 * similarity)
            h = rng.integers(0, 1 << 63, shared + apart, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            cut = shared + apart // 2
            a, b = np.unique(np.concatenate((h[:shared], h[shared:cut]))), np.unique(np.concatenate((h[:shared], h[cut:])))
            agree[similarity] += (np.frombuffer(simhash.bands(a, 20), "<u8") == np.frombuffer(simhash.bands(b, 20), "<u8")).mean() / 60
    assert abs(agree[1.0] - 1) < 1e-9 and abs(agree[0.8] - 0.8**4) < 0.06 and abs(agree[0.5] - 0.5**4) < 0.03
    long = rng.integers(0, 1 << 63, 3 * simhash.HASHED, dtype=np.uint64)
    parts = [np.array([np.min(long * f) for f in (simhash._mixed(np.arange(8, dtype=np.uint64)) | np.uint64(1))])]
    key = simhash._mixed(np.arange(2, dtype=np.uint64) ^ parts[0].reshape(2, 4).T[0])
    for p in parts[0].reshape(2, 4).T[1:]:
        key = simhash._mixed(key ^ p)
    assert simhash.bands(long, 2) == key.tobytes()
    assert simhash.band_count(0.8) == 11 and simhash.band_count(1.0) == 1 and len(simhash.bands(long[:0], 3)) == 24
