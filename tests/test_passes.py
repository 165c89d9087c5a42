from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pleiad.plans import codegen, passes
from pleiad.plans.layout import Array, Leaf, MapOf, Root, Struct, Unknown, Vector

A, B, NULL = Leaf("a", "int"), Leaf("b", "double"), Unknown("lost")
EMPTY = Struct("empty", (), True)
OFF = {name: "off" for name, _, _ in passes.PASSES}


def only(root: Root, *names: str) -> Root:
    return passes.run(root, OFF | {n: "on" for n in names})


def members(node: Struct) -> list[tuple[str, bool]]:
    return [(m.name, m.hidden) for m in node.members]


def test_empty_records_go_or_hide():
    inner = (A, EMPTY, Vector("v", EMPTY), MapOf("m", Leaf("", "int"), EMPTY))
    root = only(Root((Struct("s", inner, True), Struct("u", inner, False), EMPTY, Vector("top", EMPTY))), "removeemptyrowpass")
    assert members(root.columns[0]) == [("a", False)]
    assert members(root.columns[1]) == [("a", False), ("empty", True), ("v", True), ("m", True)]
    assert [c.name for c in root.columns] == ["s", "u", "empty", "top"]


def test_split_bases_are_flattened():
    deep = Struct("Deep", (B,), True, base=True)
    base = Struct("Base", (A, deep), True, base=True)
    kept = Struct("Kept", (Leaf("k", "int"),), False, base=True)
    root = only(Root((Vector("v", Struct("", (base, kept, Leaf("x", "int")), True)),)), "flattenoutbasepass")
    assert [m.name for m in root.columns[0].item.members] == ["a", "b", "Kept", "x"]
    assert only(Root((base,)), "flattenoutbasepass").columns[0].name == "Base"


def test_soft_null_removal():
    inner = (A, NULL, Vector("v", Unknown("")))
    root = only(Root((Struct("s", inner, True), Struct("u", inner, False), NULL, Array("arr", Unknown(""), 2), Vector("vs", Struct("", inner, True)))), "softremovenulltypepass")
    assert [c.name for c in root.columns] == ["s", "u", "vs"]
    assert members(root.columns[0]) == [("a", False)] == members(root.columns[2].item)
    assert members(root.columns[1]) == [("a", False), ("lost", True), ("v", True)]


def test_hard_null_removal():
    whole = Struct("u", (A, NULL), False)
    split = Struct("s", (A, NULL, Vector("v", Unknown("")), whole, Struct("in", (B, NULL), True)), True)
    root = only(Root((split, whole, Vector("w", whole), Vector("ws", split, True), NULL, A)), "hardremovenulltypepass")
    assert [c.name for c in root.columns] == ["s", "ws", "lost", "a"]
    assert members(root.columns[0]) == [("a", False), ("in", False)] and members(root.columns[0].members[1]) == [("b", False)]


def test_options():
    root = Root((Struct("s", (A, NULL), True),))
    assert len(passes.run(root).columns[0].members) == 1
    assert passes.run(root, {"HardRemoveNullTypePass": "FALSE"}) == root
    assert len(passes.run(root, {"hardremovenulltypepass": "off", "softremovenulltypepass": "True"}).columns[0].members) == 1
    with pytest.raises(passes.UnknownOption, match="Unknown option provided: perhaps"):
        passes.run(root, {"flattenoutbasepass": "perhaps"})


def test_pruning_orders_and_hides(spark):
    s = Struct("s", (A, B, Leaf("c", "int")), True)
    u = Struct("u", (A, B), False)
    root = Root((A, Vector("v", s), u, MapOf("m", Leaf("", "int"), s)))
    got = passes.prune(root, "v array<struct<c: int, a: int>>, u struct<b: double>, m map<int, struct<a: int>>")
    assert [c.name for c in got.columns] == ["v", "u", "m"]
    assert [m.name for m in got.columns[0].item.members] == ["c", "a"]
    assert members(got.columns[1]) == [("a", True), ("b", False)]
    assert len(got.columns[2].value.members) == 3
    assert passes.prune(root, "u struct<b: double>", {"pruningpass": "off"}).columns == (u,)


def test_applied_to_rows(spark):
    base = Struct("Base", (A,), True, base=True)
    stored = Root((Vector("v", Struct("", (base, B), True), True), Struct("s", (base, B), True)))
    df = spark.sql("select array(struct(struct(1 as a) as Base, 2.0D as b)) as v, cast(null as struct<Base: struct<a: int>, b: double>) as s")
    got = passes.applied(df, stored, passes.run(stored))
    assert got.schema.simpleString() == "struct<v:array<struct<a:int,b:double>>,s:struct<a:int,b:double>>"
    row = got.first()
    assert [tuple(m) for m in row["v"]] == [(1, 2.0)] and row["s"] is None


def test_codegen(spark):
    df = spark.range(1).select(F.array(F.struct(F.lit(1).alias("x"), F.struct(F.lit("s").alias("y")).alias("in"))).alias("muons"), F.create_map(F.lit(1), F.lit(2.5)).alias("class"), F.lit(None).alias("9lost"))
    code = codegen.dataclasses(df.schema)
    assert [c.splitlines()[1] for c in code] == ["class Record1:", "class Record0:", "class Event:"]
    space: dict = {}
    exec("import decimal, datetime\nfrom dataclasses import dataclass\n" + "\n".join(code), space)
    fields = space["Event"].__dataclass_fields__
    assert list(fields) == ["muons", "_class", "_9lost"]
    assert spark.read.schema(codegen.ddl(df.select("muons").schema)) is not None


def test_rows_as_objects(spark):
    df = spark.sql("select 1L as id, array(struct(2 as q, map('k', struct(0.5D as x)) as m), null) as parts, cast(null as struct<z: int>) as gone")
    made, typed = codegen.classes(df.schema), codegen.typed(df.schema)
    assert set(made) == {"Event", "Record0", "Record1", "Record2"}
    event = typed(df.first())
    assert type(event).__name__ == "Event" and event.id == 1 and event.parts[1] is None and event.gone is None
    assert event.parts[0].q == 2 and event.parts[0].m["k"].x == 0.5
