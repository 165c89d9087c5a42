"""From stored class descriptions to layouts: which Spark type each kind of leaf, member and template becomes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from .layout import Array, Leaf, MapOf, Node, Struct, Unknown, Vector

# Fixed values of the file format ----------------------------------------------------------------------------------------

#: Last letter of a leaf's class name; unsigned kinds are read into the signed kind of their width.
LEAF_CODES = {"C": "string", "B": "byte", "b": "byte", "S": "short", "s": "short", "I": "int", "i": "int", "F": "float", "D": "double", "L": "long", "l": "long", "O": "boolean"}
#: Codes of basic members: 6 is an array's counter, 7 a C string, 9 and 19 the packed floats.
BASIC_CODES = {1: "byte", 2: "short", 3: "int", 4: "long", 5: "float", 6: "int", 7: "string", 8: "double", 9: "float", 10: "byte", 11: "byte", 12: "short", 13: "int", 14: "long", 15: "int", 16: "long", 17: "long", 18: "boolean", 19: "short"}
#: C++ names of basic types.
BASIC_NAMES = {"int": "int", "float": "float", "double": "double", "char": "byte", "long": "long", "short": "short", "bool": "boolean", "unsigned int": "int", "unsigned char": "byte", "unsigned long": "long", "unsigned short": "short", "Double32_t": "float"}
#: Names of the format's own that the list above lacks.
MORE_NAMES = {"Int_t": "int", "UInt_t": "int", "Float_t": "float", "Double_t": "double", "Short_t": "short", "UShort_t": "short", "Long64_t": "long", "ULong64_t": "long", "long long": "long", "unsigned long long": "long", "Bool_t": "boolean", "Char_t": "byte", "UChar_t": "byte", "signed char": "byte", "int8_t": "byte", "int16_t": "short", "int32_t": "int", "int64_t": "long"}
LINEAR = ("vector", "list", "deque", "set", "multiset", "forward_list", "unordered_set", "unordered_multiset")
MAPS = ("map", "unordered_map")
MULTIMAPS = ("multimap", "unordered_multimap")
STRINGS = ("string", "__basic_string_common<true>")
BASE, FIXED, FIXED_OBJECTS, STRING, STL = 0, range(21, 40), range(81, 89), 65, 500
OBJECTS, CUSTOM_OBJECT, NAMED_BASES = (61, 62, 63, 69), 62, (66, 67)
#: STL codes of members: vector, map, multimap, set, bitset, string.
STL_VECTOR, STL_BY_NAME, STL_BITSET, STL_STRING = 1, (4, 5, 6), 8, 365
#: Classes without a description that are known to be stored as these.
CUSTOM: dict[str, Node] = {
    **{name: Leaf("", "int") for name in ("trigger::TriggerObjectType", "reco::Muon::MuonTrackType", "pat::IsolationKeys", "reco::IsoDeposit")},
    "edm::RefCoreWithIndex": Struct("product_", (Leaf("f1", "short"), Leaf("f2", "short"), Leaf("f3", "int"), Leaf("f4", "short"))),
}


@dataclass(frozen=True)
class Member:
    """A member of a class: its code, type name, and fixed dimensions; container and item codes of STL members."""

    name: str
    code: int
    type_name: str = ""
    dims: tuple[int, ...] = ()
    stl: int = 0
    item: int = 0


@dataclass(frozen=True)
class Klass:
    name: str
    members: tuple[Member, ...]


@dataclass(frozen=True)
class LeafInfo:
    """A simple leaf: code letter, and dimensions, of which None is counted by the named leaf."""

    name: str
    code: str
    dims: tuple[int | None, ...] = ()
    counter: str | None = None


@dataclass(frozen=True)
class Branch:
    """A stored column: simple leaves, or a class or template with sub-branches where it is split."""

    name: str
    class_name: str = ""
    leaves: tuple[LeafInfo, ...] = ()
    branches: tuple[Branch, ...] = ()
    member: int = -1
    kind: int = 0
    clones: str = ""


def arrange(classes: Iterable[Klass]) -> dict[str, Klass]:
    """One description a class: of two with as many members, the one whose first telling difference is itself described."""
    by_name: dict[str, list[Klass]] = {}
    for c in classes:
        by_name.setdefault(c.name, []).append(c)

    def better(a: Klass, b: Klass) -> Klass:
        if len(a.members) == len(b.members):
            for x, y in zip(a.members, b.members, strict=True):
                if x.type_name != y.type_name:
                    known = x.type_name in by_name, y.type_name in by_name
                    if known == (False, True):
                        return b
                    if any(known):
                        return a
        return a

    out = {}
    for name, found in by_name.items():
        best = found[0]
        for other in found[1:]:
            best = better(best, other)
        out[name] = best
    return out


def template(name: str) -> tuple[str, list[str]]:
    """Template and its arguments, split at commas outside inner brackets; no arguments for a plain name."""
    name = name.strip()
    if not name.endswith(">") or "<" not in name:
        return name, []
    at = name.index("<")
    parts, depth, start = [], 0, at + 1
    for i in range(at + 1, len(name) - 1):
        depth += {"<": 1, ">": -1}.get(name[i], 0)
        if name[i] == "," and not depth:
            parts.append(name[start:i].strip())
            start = i + 1
    return name[:at].removeprefix("std::"), [*parts, name[start:-1].strip()]


@dataclass
class Synthesis:
    classes: Mapping[str, Klass] = field(default_factory=dict)
    custom: Mapping[str, Node] = field(default_factory=lambda: CUSTOM)
    under_way: list[str] = field(default_factory=list, compare=False)

    # leaves ------------------------------------------------------------------------------------------------------------

    def leaf(self, name: str, leaf: LeafInfo) -> Node:
        node: Node = Leaf(name, LEAF_CODES[leaf.code]) if leaf.code in LEAF_CODES else Unknown(name)
        for n in reversed(leaf.dims):
            node = Array(name, node, n, leaf.counter if n is None else None)
        return node

    def column(self, b: Branch) -> Node:
        """A top branch: a described class, a template or custom class by its name, or simple leaves."""
        if b.class_name:
            name = b.class_name.rstrip("*").strip()
            if name in self.classes:
                return self.record(self.classes[name], b.name, b, top=True)
            return self.by_name(b.class_name, b.name, b, top=True)
        if len(b.leaves) == 1:
            return self.leaf(b.name, b.leaves[0])
        if b.leaves:
            return Struct(b.name, tuple(self.leaf(x.name, x) for x in b.leaves), split=True, top=True)
        return Unknown(b.name)

    # types by name -------------------------------------------------------------------------------------------------------

    def by_name(self, type_name: str, name: str, b: Branch | None = None, top: bool = False) -> Node:
        type_name = type_name.strip()
        if type_name in STRINGS or type_name in ("std::string", "TString"):
            return Leaf(name, "string", top=top and type_name != "TString")
        basic = BASIC_NAMES.get(type_name) or MORE_NAMES.get(type_name)
        if basic:
            return Leaf(name, basic)
        outer, args = template(type_name)
        split = bool(b and b.branches)
        if outer in LINEAR and args:
            return Vector(name, self.item(args[0], b if split else None), split, top)
        if outer in (*MAPS, *MULTIMAPS) and len(args) >= 2:
            return MapOf(name, self.item(args[0]), self.item(args[1]), outer in MULTIMAPS, False, top)
        if outer == "pair" and len(args) == 2:
            return Struct(name, (self.by_name(args[0], "first"), self.by_name(args[1], "second")), split, top)
        if outer == "bitset":
            return Vector(name, Leaf("", "boolean"), False, top)
        if (known := self.classes.get(type_name.rstrip("*").strip())) is not None:
            return self.record(known, name, b, top)
        if type_name in self.custom:
            return self.renamed(self.custom[type_name], name)
        return Unknown(name)

    def item(self, type_name: str, b: Branch | None = None) -> Node:
        known = self.classes.get(type_name.rstrip("*").strip())
        return self.record(known, "", b, nested=True) if known is not None else self.by_name(type_name, "")

    @staticmethod
    def renamed(node: Node, name: str) -> Node:
        from dataclasses import replace

        return node if isinstance(node, Struct) else replace(node, name=name)

    # classes ---------------------------------------------------------------------------------------------------------------

    def record(self, k: Klass, name: str, b: Branch | None = None, top: bool = False, base: bool = False, nested: bool = False) -> Node:
        """A described class: split by its sub-branches, or in one piece; nested as an item of a collection.

        A class that holds itself, at any depth, is not decoded there.
        """
        if k.name in self.under_way or any(m.type_name in (f"vector<{k.name}>", f"{k.name}*") for m in k.members):
            return Unknown(name)
        self.under_way.append(k.name)
        try:
            if not k.members:
                return Struct(name, (), False, top, base)
            if k.members[0].name == "This":
                return self.member(k.members[0], b, name, nested)
            if k.name == "TClonesArray":
                return self.by_name(f"vector<{b.clones}>", name, b, top) if b and b.clones else Unknown(name)
            if b is None or not b.branches:
                return Struct(name, tuple(self.member(m) for m in k.members), False, top and b is not None, base)
            return Struct(name, tuple(self.sub_branches(k, b)), True, top, base)
        finally:
            self.under_way.pop()

    def sub_branches(self, k: Klass, b: Branch) -> list[Node]:
        """Members in the order of the class, each from the sub-branch of its name.

        A branch below a collection or an object has the members of inner objects and bases directly below itself, under
        dotted names; they come together in a record of their own again.
        """
        found = {within(s.name, b.name): s for s in b.branches}
        out = []
        for m in k.members:
            if m.code == BASE or (m.code in NAMED_BASES and m.type_name == "BASE"):
                inner = self.classes.get(m.name)
                if inner is None:
                    out.append(Unknown(m.name))
                elif m.name in found:
                    out.append(self.record(inner, m.name, found[m.name], base=True))
                elif not inner.members:
                    out.append(Struct(m.name, (), False, False, True))
                else:
                    out.append(Struct(m.name, tuple(self.sub_branches(inner, b)), True, False, True))
            elif m.name in found:
                out.append(self.member(m, found[m.name]))
            elif (inner := self.classes.get(m.type_name.rstrip("*").strip())) is not None and any(n.startswith(f"{m.name}.") for n in found):
                deep = Branch(f"{b.name}.{m.name}", m.type_name, (), tuple(s for n, s in found.items() if n.startswith(f"{m.name}.")))
                out.append(Struct(m.name, tuple(self.sub_branches(inner, deep)), True))
        return out

    def member(self, m: Member, b: Branch | None = None, name: str | None = None, nested: bool = False) -> Node:
        name = m.name if name is None else name
        if m.code in BASIC_CODES:
            return Leaf(name, BASIC_CODES[m.code])
        if m.code in FIXED or m.code in FIXED_OBJECTS:
            node = self.member(Member(name, m.code - 20, m.type_name))
            for n in reversed(m.dims):
                node = Array(name, node, n)
            return node
        if m.code == STRING:
            return Leaf(name, "string")
        if m.code == BASE or m.code in NAMED_BASES or m.code in OBJECTS:
            inherited = m.code == BASE or (m.code in NAMED_BASES and m.type_name == "BASE")
            type_name = (m.name if inherited else m.type_name).rstrip("*").strip()
            if type_name in self.classes:
                return self.record(self.classes[type_name], name, b, base=m.code == BASE)
            if m.code == CUSTOM_OBJECT and type_name in self.custom:
                return self.renamed(self.custom[type_name], name)
            return Unknown(name)
        if m.code == STL:
            return self.stl(m, name, b, not nested)
        return Unknown(name)

    def stl(self, m: Member, name: str, b: Branch | None, top: bool) -> Node:
        """A container member; top: behind a header of its own, which an item of another container hasn't."""
        if m.stl == STL_VECTOR:
            if m.item < 61:
                code = 18 if m.item == 21 and "bool" in m.type_name else m.item
                item: Node = Leaf("", BASIC_CODES[code]) if code in BASIC_CODES else Unknown("")
                return Vector(name, item, False, top)
            return self.by_name(m.type_name, name, b, top)
        if m.stl in STL_BY_NAME:
            return self.by_name(m.type_name, name, b, top)
        if m.stl == STL_BITSET:
            return Vector(name, Leaf("", "boolean"), False, top)
        return Leaf(name, "string", top=top) if m.stl == STL_STRING else Unknown(name)


def within(name: str, parent: str) -> str:
    """A sub-branch's name within its parent, without array dimensions."""
    name = name.split("[")[0]
    return name[len(parent) :].lstrip(".") if parent and name.startswith(f"{parent.rstrip('.')}.") else name
