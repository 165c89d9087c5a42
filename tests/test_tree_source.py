from __future__ import annotations

import struct

import numpy as np
import pytest
from pyarrow.fs import LocalFileSystem

from pleiad.sources import datasource
from pleiad.sources.binary import BadFile, Cursor, store_of
from pleiad.sources.tree import NoTree, Tree
from pleiad.plans.layout import Leaf, Vector
from pleiad.plans.synthesis import Branch, Klass, Member, Synthesis, arrange
from pleiad.sources.tree import Decoder
from pleiad.sources.treewriter import COUNTED, TreeFile, nested_vector_entry, vector_entry, write_trees

N = 100
#: Fixed values of the 100-row unit table: the filled places of arr1, from index 68.
ARR1_TAIL = [-554688857, 1375775489, 1389532384, 32767, 37, 0, 1, 0, 216883304, 1, 1642884191, 32767, 1389531888, 32767, 1642726006, 32767, 1389531920, 32767, 1389531920, 32767, 1, 0, 1389531944, 32767, 216883200, 1, 1642721864, 32767, 1389531960, 32767]
ARR1 = [0, 1, *[0] * 66, *ARR1_TAIL, 0, 0]
ONE = [0, 1, *[0] * 98]
CUBE = [[[0, 0], [0, 0]], [[0, 0], [0, 1]]]


def expected() -> dict[str, list]:
    flat, nested = [], []
    so_far: list[int] = []
    for i in range(N):
        flat.append(list(so_far))
        so_far = so_far + list(range(i + 1))
        nested.append([[0], [0, 1]] * (2 * (i + 1)))
    return {
        "a": list(range(N)),
        "n": list(range(N)),
        "b": [float(i) for i in range(N)],
        "c": [float(i) for i in range(N)],
        "d": [120] * N,
        "f": [bool(i % 2) for i in range(N)],
        "str": ["abc"] * N,
        "arr1": [ARR1] * N,
        "arr2": [[float(x) for x in ONE]] * N,
        "arr3": [[float(x) for x in ONE]] * N,
        "arr4": [ONE] * N,
        "arr5": [[bool(x) for x in ONE]] * N,
        "varr1": [list(range(i)) for i in range(N)],
        "varr2": [[float(x) for x in range(i)] for i in range(N)],
        **{f"multi{k}": [CUBE] * N for k in range(1, 6)},
        "myintvector": flat,
        "myvector2": nested,
        "vofvofDouble": [[]] * N,
    }


KINDS = {"a": "int", "n": "int", "b": "double", "c": "float", "d": "tinyint", "f": "boolean", "str": "string", "arr1": "array<int>", "arr2": "array<double>", "arr3": "array<float>", "arr4": "array<tinyint>", "arr5": "array<boolean>", "varr1": "array<int>", "varr2": "array<double>", "multi1": "array<array<array<int>>>", "multi2": "array<array<array<double>>>", "multi3": "array<array<array<float>>>", "multi4": "array<array<array<tinyint>>>", "multi5": "array<array<array<boolean>>>", "myintvector": "array<int>", "myvector2": "array<array<int>>", "vofvofDouble": "array<array<double>>"}


def unit_file(path: str, method: str = "", per_basket: int = 1 << 30) -> str:
    x, f = expected(), TreeFile(path, method, per_basket)
    out = []
    for name, code in (("a", "I"), ("b", "D"), ("c", "F"), ("d", "B"), ("f", "O"), ("str", "C")):
        out.append(f.leaf("T", name, code, x[name])[0])
    branch, counter = f.leaf("T", "n", "I", x["n"])
    out.append(branch)
    for k, code in enumerate("IDFBO", 1):
        out.append(f.leaf("T", f"arr{k}", code, x[f"arr{k}"], "[100]")[0])
        out.append(f.leaf("T", f"multi{k}", code, x[f"multi{k}"], "[2][2][2]")[0])
    for k, code in enumerate("ID", 1):
        out.append(f.leaf("T", f"varr{k}", code, x[f"varr{k}"], "[n]", counter)[0])
    out.append(f.element("T", "myintvector", "vector<int>", [vector_entry(v, ">i4") for v in x["myintvector"]]))
    out.append(f.element("T", "myvector2", "vector<vector<int> >", [nested_vector_entry(v, ">i4") for v in x["myvector2"]]))
    out.append(f.element("T", "vofvofDouble", "vector<vector<double> >", [nested_vector_entry(v, ">f8") for v in x["vofvofDouble"]]))
    f.tree("T", out, N)
    return f.close()


@pytest.mark.parametrize("method,per_basket", [("", 1 << 30), ("ZL", 7), ("L4", 30), ("ZS", 100), ("XZ", 33)])
def test_all_columns_of_the_unit_table(spark, tmp_path, method, per_basket):
    path = unit_file(str(tmp_path / "t.root"), method, per_basket)
    df = datasource.read_trees(spark, path)
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields} == KINDS
    rows = df.collect()
    for name, values in expected().items():
        assert sorted((r[name] for r in rows), key=str) == sorted(values, key=str), name


@pytest.mark.parametrize("column", list(KINDS))
def test_a_column_alone(spark, tmp_path_factory, column):
    path = unit_file(str(tmp_path_factory.mktemp("one") / "t.root"), "ZL", 40)
    with Tree(path) as t:
        from pleiad.plans import passes

        root = passes.prune(t.layout(), f"{column} {KINDS[column]}")
        got = [v for b in t.batches(root, 0, t.entries, 17) for v in b.column(0).to_pylist()]
    assert got == expected()[column]


def test_pruning_ranges_counts_and_many_files(spark, tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    a, b = unit_file(str(tmp_path / "a.root"), "ZL", 25), unit_file(str(tmp_path / "deep" / "er" / "b.root"), "", 10)
    (tmp_path / "deep" / "notes.txt").write_text("no tree")
    df = datasource.read_trees(spark, str(tmp_path), columns=["varr1", "a"], entries="20")
    assert df.columns == ["varr1", "a"] and df.count() == 200
    assert df.rdd.getNumPartitions() > 4
    assert sorted(r["a"] for r in df.where("size(varr1) = 3").collect()) == [3, 3]
    assert datasource.entry_count(spark, str(tmp_path)) == 200 and datasource.entry_count(spark, a, b, b) == 300
    with pytest.raises(Exception, match="no column"):
        datasource.read_trees(spark, a, columns=["missing"]).collect()


def test_tree_choice_and_folders(spark, tmp_path):
    f = TreeFile(str(tmp_path / "t.root"))
    mark = len(f.keys)
    f.tree("inner", [f.leaf("inner", "x", "I", [1, 2])[0]], 2)
    f.folder("dir", mark, "TDirectoryFile")
    f.tree("other", [f.leaf("other", "y", "L", [5])[0]], 1)
    path = f.close()
    assert datasource.read_trees(spark, path).columns == ["x"]
    assert [tuple(r) for r in datasource.read_trees(spark, path, tree="other").collect()] == [(5,)]
    with pytest.raises(NoTree, match="No tree absent found"):
        Tree(path, "absent")
    with pytest.raises(Exception, match="No tree absent found"):
        datasource.read_trees(spark, path, tree="absent").collect()


def test_unsigned_values_wrap_and_leaves_of_one_branch_make_a_record(spark, tmp_path):
    f = TreeFile(str(tmp_path / "t.root"))
    u = f.leaf("T", "u", "B", [np.int8(-56)], unsigned=True)[0]
    s = f.struct_leaves("T", "event", [("run", "I"), ("weight", "D")], [(7, 0.5)])
    f.tree("T", [u, s], 1)
    df = datasource.read_trees(spark, f.close())
    assert df.schema.simpleString() == "struct<u:tinyint,event:struct<run:int,weight:double>>"
    assert df.select("u", "event.weight").first() == (-56, 0.5)


MUON = [("reco::Candidate", 0, "BASE"), ("charge_", 3, "int")]
CANDIDATE = [("pt_", 8, "double"), ("eta_", 5, "float")]


def muon_file(path: str, rows: list[list[tuple]]) -> str:
    f = TreeFile(path, "ZL", 3)
    f.describe("reco::Candidate", CANDIDATE)
    f.describe("reco::Muon", MUON)
    subs = [f.element("T", f"muons.{n}", "reco::Muon", [np.array([m[k] for m in r]).astype(d).tobytes() for r in rows], kind=41, member=k) for k, (n, d) in enumerate((("pt_", ">f8"), ("eta_", ">f4"), ("charge_", ">i4")))]
    muons = f.element("T", "muons", "vector<reco::Muon>", [struct.pack(">i", len(r)) for r in rows], subs, kind=4, offsets=False)
    f.tree("T", [muons], len(rows))
    return f.close()


def test_split_collection_with_a_base_class(spark, tmp_path):
    rows = [[(1.5, 0.25, 1), (2.5, -0.5, -1)], [], [(9.0, 2.0, 1)], [(4.0, 1.0, -1)] * 3]
    path = muon_file(str(tmp_path / "m.root"), rows)
    flat = datasource.read_trees(spark, path)
    assert flat.schema["muons"].dataType.simpleString() == "array<struct<pt_:double,eta_:float,charge_:int>>"
    assert [[tuple(m) for m in r["muons"]] for r in flat.collect()] == rows
    whole = datasource.read_trees(spark, path, flattenoutbasepass="off")
    assert whole.schema["muons"].dataType.simpleString() == "array<struct<reco__Candidate:struct<pt_:double,eta_:float>,charge_:int>>"
    assert [[m[1] for m in r["muons"]] for r in whole.collect()] == [[m[2] for m in r] for r in rows]
    one = datasource.read_trees(spark, path, columns=["muons.eta_"])
    assert one.schema["muons"].dataType.simpleString() == "array<struct<eta_:float>>"
    assert [r[0] for r in one.select("muons.eta_").collect()] == [[m[1] for m in r] for r in rows]
    with pytest.raises(Exception, match="Unknown option provided: maybe"):
        datasource.read_trees(spark, path, flattenoutbasepass="maybe").collect()


def test_maps_strings_and_pairs(spark, tmp_path):
    def entry(body: bytes, version: int = 9) -> bytes:
        return struct.pack(">IH", COUNTED | (len(body) + 2), version) + body

    text = lambda s: bytes([len(s)]) + s.encode()
    pairs = [(1, 2.0), (3, 4.0), (1, 5.0)]
    body = struct.pack(">i", 3) + b"".join(struct.pack(">id", *p) for p in pairs)
    apart = struct.pack(">HIi", 0, 77, 3) + struct.pack(">3i", 1, 3, 1) + struct.pack(">3d", 2.0, 4.0, 5.0)
    words = struct.pack(">i", 2) + text("one") + text("two")
    f = TreeFile(str(tmp_path / "t.root"))
    f.tree(
        "T",
        [
            f.element("T", "m", "map<int,double>", [entry(body)]),
            f.element("T", "apart", "map<int,double>", [entry(apart, 9 | 1 << 14)]),
            f.element("T", "mm", "multimap<int,double>", [entry(body)]),
            f.element("T", "words", "vector<string>", [entry(words)]),
            f.element("T", "s", "string", [entry(text("whole"))]),
            f.element("T", "p", "vector<pair<int,double> >", [entry(struct.pack(">i", 1) + struct.pack(">id", 8, 0.5))]),
        ],
        1,
    )
    r = datasource.read_trees(spark, f.close()).first()
    assert r["m"] == r["apart"] == {1: 5.0, 3: 4.0}
    assert r["mm"] == {1: [2.0, 5.0], 3: [4.0]}
    assert r["words"] == ["one", "two"] and r["s"] == "whole" and [tuple(x) for x in r["p"]] == [(8, 0.5)]


def test_unreadable_files(spark, tmp_path):
    good = unit_file(str(tmp_path / "a.root"))
    (tmp_path / "b.root").write_bytes(b"not a tree file" * 20)
    with pytest.raises(BadFile):
        Tree(str(tmp_path / "b.root"))
    with pytest.raises(Exception, match="does not begin"):
        datasource.read_trees(spark, str(tmp_path)).count()
    assert datasource.read_trees(spark, str(tmp_path), ignorecorrupt="on").count() == N
    assert datasource.read_trees(spark, good, ignorecorrupt="on").count() == N
    with pytest.raises(Exception, match="path to files must be given"):
        datasource.TreeSource({}).schema()


def test_tables_come_back_as_they_were_written(spark, tmp_path):
    df = spark.sql("select cast(id as int) as i, id * 3 as l, cast(id as float) / 3 as f, id / 7 as d, id % 2 = 0 as b, concat('ä', repeat('x', cast(id % 300 as int))) as s, transform(sequence(0L, id % 5), x -> x * 1.5D) as v, filter(transform(sequence(1L, 4L), x -> struct(x / 2 as pt_, cast(x as int) as q)), r -> r.q <= id % 4) as muons from range(0, 1000, 1, 3)")
    files = write_trees(df, str(tmp_path / "out"), per_basket=50).collect()
    assert sum(r["entries"] for r in files) == 1000 and len(files) == 3
    back = datasource.read_trees(spark, str(tmp_path / "out"), entries="100")
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(back.collect(), key=lambda r: r["i"]) == sorted(df.collect(), key=lambda r: r["i"])
    assert datasource.read_trees(spark, str(tmp_path / "out"), columns=["muons.q"]).selectExpr("sum(size(muons.q))").first()[0] == sum(min(4, i % 4) for i in range(1000))
    with pytest.raises(Exception, match="holds nulls"):
        write_trees(spark.sql("select cast(null as int) as x"), str(tmp_path / "bad"))
    with pytest.raises(Exception, match="can't be written"):
        write_trees(spark.sql("select date'2020-01-01' as m"), str(tmp_path / "bad"))


def test_nested_columns_come_back_as_they_were_written(spark, tmp_path):
    df = spark.sql("""select cast(id as int) as n, struct(id * 2 as l, concat('t', id) as name, sequence(0L, id % 3) as v, map(id, id / 4D) as m,
        transform(sequence(0L, id % 2), x -> struct(cast(x as int) as e, array(x / 2D) as w)) as hits, struct(true as yes) as inner) as rec,
      map(concat('k', id), sequence(0, cast(id % 4 as int))) as maps, array(array(id), array(), array(id, 7L)) as deep, array('a', concat('b', id)) as words,
      filter(transform(sequence(0L, 3L), x -> struct(struct(x / 2 as pt, concat('p', x) as label) as Base, cast(x as int) as q, repeat('y', cast(300 * x as int)) as s,
        sequence(0L, x) as v, map(cast(x as int), x * 3) as m, array(array(1F), array(2F, 3F)) as vv)), r -> r.q < id % 5) as parts,
      transform(sequence(1L, 6L), x -> cast(x * id as float)) as grid, transform(filter(sequence(0L, 60L), x -> x < id), x -> cast(x as short)) as counted
      from range(0, 60, 1, 2)""")
    write_trees(df, str(tmp_path / "out"), per_basket=7, arrays={"grid": (6,), "counted": "n"})
    back = datasource.read_trees(spark, str(tmp_path / "out"), flattenoutbasepass="off", entries="10")
    assert back.schema.simpleString() == df.schema.simpleString()
    key = lambda r: r["n"]
    assert [r.asDict(True) for r in sorted(back.collect(), key=key)] == [r.asDict(True) for r in sorted(df.collect(), key=key)]
    flat = datasource.read_trees(spark, str(tmp_path / "out"), columns=["n", "parts.pt", "parts.vv", "rec.hits"])
    assert flat.schema["parts"].dataType.simpleString() == "array<struct<pt:double,vv:array<array<float>>>>"
    assert flat.selectExpr("sum(size(parts))", "max(get(parts, 0).vv[1][1])").first() == (sum(min(4, i % 5) for i in range(60)), 3.0)


# bytes put together by hand: a count of the bytes behind it under the mark 0x40, then a version ---------------------------------


def counted(version: str, *parts: str | bytes) -> bytes:
    raw = b"".join(bytes.fromhex(x) if isinstance(x, str) else x for x in (version, *parts))
    return (0x40000000 | len(raw)).to_bytes(4, "big") + raw


HIT = Klass("Hit", (Member("e", 3, "int"), Member("v", 500, "vector<int>", stl=1, item=3), Member("name", 500, "string", stl=365)))
OUTER = Klass(
    "Outer",
    (
        Member("Low", 0, "BASE"),
        Member("m", 500, "map<short,float>", stl=4, item=61),
        Member("mm", 500, "multimap<int,vector<short> >", stl=5, item=61),
        Member("vv", 500, "vector<vector<short> >", stl=1, item=61),
        Member("words", 500, "vector<string>", stl=1, item=61),
        Member("title", 65, "TString"),
        Member("hit", 62, "Hit"),
        Member("hits", 500, "vector<Hit>", stl=1, item=61),
    ),
)
CLASSES = arrange([HIT, OUTER, Klass("Low", (Member("id", 2, "short"),))])
ONE_HIT = counted("0003", "00000005", counted("0009", "00000003 00000001 00000002 00000003"), counted("0009", "026162"))
VALUES = {"Low": {"id": 258}, "m": [(1, 1.0), (2, -2.0)], "mm": [(7, [[1], []]), (8, [[2, 3]])], "vv": [[1], [2, 3]], "words": ["x", ""], "title": "T", "hit": {"e": 5, "v": [1, 2, 3], "name": "ab"}}


def outer_bytes(hits: bytes) -> bytes:
    return counted(
        "0002",
        counted("0001", "0102"),  # the base
        counted("0009", "00000002 0001 3f800000 0002 c0000000"),
        counted("0009", "00000003", "00000007 00000001 0001", "00000007 00000000", "00000008 00000002 0002 0003"),
        counted("0009", "00000002 00000001 0001 00000002 0002 0003"),
        counted("0009", "00000002 0178 00"),
        "0154",
        ONE_HIT,
        hits,
    )


def test_records_in_one_piece_hold_containers_with_headers():
    s = Synthesis(CLASSES)
    node = s.column(Branch("o", "Outer"))
    behind = counted("0009", "00000001", ONE_HIT)
    # member by member (mark 0x40 of the version), then the class's version: all e, all v behind one header, all names behind one
    apart = counted("4009", "0003", "00000002", "00000005 00000006", counted("0009", "00000001 00000009 00000000"), counted("0009", "0161 0162"))
    for hits, expected in ((behind, [VALUES["hit"]]), (apart, [{"e": 5, "v": [9], "name": "a"}, {"e": 6, "v": [], "name": "b"}])):
        raw = outer_bytes(hits)
        got = Decoder().entry(node, Cursor(raw), len(raw))
        assert got == VALUES | {"hits": expected}
        inside = Decoder().entry(node, Cursor(raw[6:]), len(raw) - 6)  # a top branch's members without the header
        assert inside == got


def test_what_is_no_member_has_no_header():
    s = Synthesis(arrange([Klass("vector<short>", (Member("This", 500, "vector<short>", stl=1, item=2),)), Klass("K", (Member("x", 500, "vector<vector<short> >", stl=1, item=61),))]))
    node = s.column(Branch("k", "K")).members[0]
    assert node == Vector("x", Vector("", Leaf("", "short"), False, False), False, True)
    raw = counted("0009", "00000002 00000001 0001 00000000")
    assert Decoder().value(node, Cursor(raw)) == [[1], []]


def test_classes_that_hold_each_other_end():
    s = Synthesis(arrange([Klass("A", (Member("b", 500, "vector<B>", stl=1, item=61),)), Klass("B", (Member("a", 500, "vector<A>", stl=1, item=61), Member("x", 3)))]))
    assert s.column(Branch("a", "A")).spark_type().simpleString() == "struct<b:array<struct<a:array<void>,x:int>>>"
    assert s.under_way == []


@pytest.mark.parametrize("flag", [0, 1, 11, 12, 41])
def test_baskets_left_within_the_branch(spark, tmp_path, flag):
    """A branch with one basket on its own and one that its writer never flushed, put together by hand."""
    texts = ["ab", "", "xyz"]
    f = TreeFile(str(tmp_path / "t.root"), "", 2)
    key = struct.pack(">ihiIhhii", 0, 4, 0, 0, 60, 1, 0, 0) + b"\x07TBasket" + b"\x01c" + b"\x01T"
    if flag in (0, 12):
        column = f.leaf("T", "c", "I", [4, 5])[0]
        content, places = struct.pack(">3i", 6, 7, 8), b""
        expected = [4, 5, 6, 7, 8]
    else:
        column = f.leaf("T", "c", "C", ["first", "second"])[0]
        content = b"".join(bytes([len(t)]) + t.encode() for t in texts)
        at = [60, 63, 64]
        places = struct.pack(">4i", 3, *at) + (struct.pack(">4i", 3, 0, 0, 0) if flag > 40 else b"")
        expected = ["first", "second", *texts]
    last = 60 + len(content)
    raw = key + struct.pack(">hiiiiB", 3, 32000, 1000, 3, last, 12 if flag == 0 else flag) + places + bytes(60) + content
    column[1]["fBaskets"] = [(None, None, None), ("TBasket", raw, None)]
    column[1]["fEntries"] = 5
    f.tree("T", [column], 5)
    assert [r[0] for r in datasource.read_trees(spark, f.close()).collect()] == expected


def test_comparisons_decide_what_is_read(spark, tmp_path, monkeypatch):
    path = unit_file(str(tmp_path / "t.root"), "ZL", 10)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = datasource.read_trees(spark, path)
        assert sorted(r["a"] for r in df.where("a >= 90 and b < 95 and c > 91").collect()) == [92, 93, 94]
        assert [r["a"] for r in df.where("a in (7, 300) and varr1[6] = 6").collect()] == [7]
        assert df.where("a > 1000").count() == 0 and df.where("str = 'abc' and not a = 4").count() == 99
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    with Tree(path) as t:
        read, whole = [], t.batch
        monkeypatch.setattr(t, "batch", lambda root, a, b: read.append((len(root.columns), a)) or whole(root, a, b))
        reader = datasource.FilteringReader([path], {}, t.layout().spark_type())
        reader.filters = (datasource.GreaterThan(("a",), 84),)
        got = [v for b in t.batches(t.layout(), 0, 100, 20, reader.may_hold, ("a",)) for v in b.column(0).to_pylist()]
    assert got == list(range(85, 100)) and [r for r in read if r[0] > 1] == [(22, 80)]


def test_settings_reach_the_store(spark, tmp_path):
    path = f"file://{unit_file(str(tmp_path / 't.root'))}"
    options = {"storage.use_mmap": "true"}
    with Tree(path, None, datasource.storage(options)) as t:
        assert t.entries == N
    store, at = store_of(path, {"use_mmap": "true"})
    assert store == LocalFileSystem(use_mmap=True) != LocalFileSystem() and at == path.removeprefix("file://")
    assert datasource.read_trees(spark, path, columns=["a"], entries="50", **options).count() == N
    assert datasource.entry_count(spark, path, **options) == N
    with pytest.raises(Exception, match="nonsense"):
        Tree(path, None, {"nonsense": "1"})
