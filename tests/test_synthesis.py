from __future__ import annotations

import pytest

from pyspark.sql import types as T

from pleiad.plans.layout import Array, Leaf, MapOf, Root, Struct, Unknown, Vector, column_name, of_type, tree_text
from pleiad.plans.synthesis import BASIC_CODES, Branch, Klass, LeafInfo, Member, Synthesis, arrange, template


@pytest.mark.parametrize(
    "code,kind",
    [("C", "string"), ("B", "tinyint"), ("b", "tinyint"), ("S", "smallint"), ("s", "smallint"), ("I", "int"), ("i", "int"), ("F", "float"), ("D", "double"), ("L", "bigint"), ("l", "bigint"), ("O", "boolean"), ("X", "void")],
)
def test_leaf_codes(code, kind):
    assert Synthesis().column(Branch("x", leaves=(LeafInfo("x", code),))).spark_type().simpleString() == kind


def test_leaf_dimensions_and_names():
    node = Synthesis().column(Branch("b", leaves=(LeafInfo("other", "F", (None, 2), "n"),)))
    assert node.name == "b" and node.spark_type().simpleString() == "array<array<float>>"
    assert isinstance(node, Array) and node.length is None and node.counter == "n" and node.item.length == 2
    many = Synthesis().column(Branch("b", leaves=(LeafInfo("x", "I"), LeafInfo("y", "D", (3,)))))
    assert many.spark_type().simpleString() == "struct<x:int,y:array<double>>"


@pytest.mark.parametrize("code", sorted(BASIC_CODES))
def test_basic_member_codes(code):
    assert Synthesis().member(Member("m", code)) == Leaf("m", BASIC_CODES[code])


@pytest.mark.parametrize(
    "name,kind",
    [
        ("vector<int>", "array<int>"),
        ("list<vector<Double32_t> >", "array<array<float>>"),
        ("map<int,vector<float> >", "map<int,array<float>>"),
        ("multimap<string, long long>", "map<string,array<bigint>>"),
        ("unordered_map<unsigned short,bool>", "map<smallint,boolean>"),
        ("pair<int,pair<char,double> >", "struct<first:int,second:struct<first:tinyint,second:double>>"),
        ("bitset<16>", "array<boolean>"),
        ("std::vector<std::string>", "array<string>"),
        ("set<edm::RefCoreWithIndex>", "array<struct<f1:smallint,f2:smallint,f3:int,f4:smallint>>"),
        ("reco::IsoDeposit", "int"),
        ("who::Knows", "void"),
    ],
)
def test_types_by_name(name, kind):
    assert Synthesis().by_name(name, "x").spark_type().simpleString() == kind


def test_template_arguments():
    assert template("map<int,vector<pair<a,b> > >") == ("map", ["int", "vector<pair<a,b> >"])
    assert template("plain") == ("plain", [])


CLASSES = arrange(
    [
        Klass("Base", (Member("id", 3),)),
        Klass("Empty", ()),
        Klass("Node", (Member("next", 64, "Node*"), Member("v", 8))),
        Klass("Holder", (Member("This", 500, "vector<int>", stl=1, item=3),)),
        Klass("Hit", (Member("Base", 0, "BASE"), Member("e", 5), Member("grid", 28, "double", (2, 3)), Member("tags", 500, "vector<bool>", stl=1, item=21), Member("name", 65, "TString"), Member("p", 48, "double*"))),
        Klass("TClonesArray", (Member("x", 3),)),
        Klass("Event", (Member("Empty", 0, "BASE"), Member("hits", 500, "vector<Hit>", stl=1, item=61), Member("one", 62, "Hit"), Member("lost", 62, "Nowhere"), Member("bits", 500, "bitset<8>", stl=8), Member("text", 500, "string", stl=365), Member("odd", 500, "list<int>", stl=2), Member("objs", 81, "Base", (4,)))),
    ]
)


def test_classes():
    s = Synthesis(CLASSES)
    hit = s.record(CLASSES["Hit"], "hit")
    assert hit.spark_type().simpleString() == "struct<Base:struct<id:int>,e:float,grid:array<array<double>>,tags:array<boolean>,name:string,p:void>"
    assert hit.members[0].base and not hit.split
    assert s.record(CLASSES["Node"], "n") == Unknown("n")
    assert s.record(CLASSES["Holder"], "h") == Vector("h", Leaf("", "int"), False, True)
    event = s.record(CLASSES["Event"], "event")
    kinds = {m.name: m.spark_type().simpleString() for m in event.members}
    assert kinds["Empty"] == "struct<>" and kinds["lost"] == kinds["odd"] == "void"
    assert kinds["hits"].startswith("array<struct<Base") and kinds["bits"] == "array<boolean>" and kinds["text"] == "string" and kinds["objs"] == "array<struct<id:int>>"


def test_split_branches_follow_the_class_and_clones_are_vectors():
    s = Synthesis(CLASSES)
    hits = Branch("hits", "vector<Hit>", branches=(Branch("hits.e"), Branch("hits.id")), kind=4)
    node = s.column(hits)
    assert isinstance(node, Vector) and node.split and node.top
    assert node.item.members[0] == Struct("Base", (Leaf("id", "int"),), True, False, True)
    assert [m.name for m in node.item.members] == ["Base", "e"]
    clones = s.column(Branch("c", "TClonesArray", branches=(Branch("c.id"),), clones="Base"))
    assert clones.spark_type().simpleString() == "array<struct<id:int>>"
    assert s.record(CLASSES["TClonesArray"], "c") == Unknown("c")


def test_one_description_a_class():
    known = Klass("K", (Member("a", 3, "int"),))
    old, new = Klass("C", (Member("m", 62, "Gone"),)), Klass("C", (Member("m", 62, "K"),))
    assert arrange([known, old, new])["C"] is new and arrange([known, new, old])["C"] is new
    longer = Klass("C", (*new.members, Member("x", 3, "int")))
    assert arrange([known, old, longer])["C"] is old


def test_names_and_text():
    assert column_name("reco::Muon.pt") == "reco__Muon_pt"
    root = Root((MapOf("m", Leaf("", "int"), Vector("", Leaf("", "float")), many=True), Unknown("a::b")))
    assert root.spark_type().simpleString() == "struct<m:map<int,array<array<float>>>,a__b:void>"
    assert tree_text(root).splitlines() == ["m: mapof many", "  : int", "  : vector", "    : float", "a::b: unknown"]


def test_layout_of_a_spark_type():
    kind = T.StructType([T.StructField("x", T.ArrayType(T.MapType(T.StringType(), T.StructType([T.StructField("y", T.ShortType())])))), T.StructField("d", T.DateType())])
    node = of_type("r", kind)
    assert node.spark_type().simpleString() == "struct<x:array<map<string,struct<y:smallint>>>,d:void>"
