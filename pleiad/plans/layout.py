"""Layout of a record type: what is stored, how it is split over columns, and the Spark type that it reads as.

Spark's schema alone does not say whether a nested record is stored member by member (split) or as one piece, which
member is a base class, or that a stored member can't be decoded. These nodes do; the passes rewrite them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import types as T

#: Leaf kinds and their Spark types.
PRIMITIVES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "byte": T.ByteType(),
    "short": T.ShortType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def column_name(name: str) -> str:
    """A stored name as a column name; used for schemas and for finding a stored member again."""
    return name.replace(".", "_").replace("::", "__")


@dataclass(frozen=True)
class Node:
    name: str

    @property
    def column(self) -> str:
        return column_name(self.name)

    @property
    def hidden(self) -> bool:
        """Read to get past it, and left out of the result."""
        return getattr(self, "drop", False)

    def spark_type(self) -> T.DataType:
        raise NotImplementedError

    def children(self) -> tuple[Node, ...]:
        return ()

    def with_children(self, children: tuple[Node, ...]) -> Node:
        return self

    def hide(self) -> Node:
        return replace(self, drop=True)


@dataclass(frozen=True)
class Leaf(Node):
    """top: a string behind a header of its own, as a member or a branch has it and an item of a collection hasn't."""

    kind: str
    drop: bool = False
    top: bool = False

    def spark_type(self) -> T.DataType:
        return PRIMITIVES[self.kind]


@dataclass(frozen=True)
class Unknown(Node):
    """Stored, but not decodable."""

    drop: bool = False

    def spark_type(self) -> T.DataType:
        return T.NullType()


@dataclass(frozen=True)
class Array(Node):
    """length members, or as many as the named counter says where length is None."""

    item: Node
    length: int | None = None
    counter: str | None = None
    drop: bool = False

    def spark_type(self) -> T.DataType:
        return T.ArrayType(self.item.spark_type())

    def children(self) -> tuple[Node, ...]:
        return (self.item,)

    def with_children(self, children: tuple[Node, ...]) -> Node:
        return replace(self, item=children[0])


@dataclass(frozen=True)
class Vector(Node):
    item: Node
    split: bool = False
    top: bool = False
    drop: bool = False

    def spark_type(self) -> T.DataType:
        return T.ArrayType(self.item.spark_type())

    def children(self) -> tuple[Node, ...]:
        return (self.item,)

    def with_children(self, children: tuple[Node, ...]) -> Node:
        return replace(self, item=children[0])


@dataclass(frozen=True)
class MapOf(Node):
    """A map; with many, each key has all of its values, else the last one."""

    key: Node
    value: Node
    many: bool = False
    split: bool = False
    top: bool = False
    drop: bool = False

    def spark_type(self) -> T.DataType:
        value = self.value.spark_type()
        return T.MapType(self.key.spark_type(), T.ArrayType(value) if self.many else value)

    def children(self) -> tuple[Node, ...]:
        return self.key, self.value

    def with_children(self, children: tuple[Node, ...]) -> Node:
        return replace(self, key=children[0], value=children[1])


@dataclass(frozen=True)
class Struct(Node):
    members: tuple[Node, ...]
    split: bool = False
    top: bool = False
    base: bool = False
    drop: bool = False

    def spark_type(self) -> T.StructType:
        return T.StructType([T.StructField(m.column, m.spark_type()) for m in self.members if not m.hidden])

    def children(self) -> tuple[Node, ...]:
        return self.members

    def with_children(self, children: tuple[Node, ...]) -> Node:
        return replace(self, members=tuple(children))


@dataclass(frozen=True)
class Root:
    """Top columns of a table, and its number of entries where that is known."""

    columns: tuple[Node, ...]
    entries: int = 0

    def spark_type(self) -> T.StructType:
        return T.StructType([T.StructField(c.column, c.spark_type()) for c in self.columns])


def of_type(name: str, kind: T.DataType) -> Node:
    """The layout that reads as a Spark type, stored in one piece; types that no leaf has are unknown."""
    if isinstance(kind, T.StructType):
        return Struct(name, tuple(of_type(f.name, f.dataType) for f in kind.fields))
    if isinstance(kind, T.ArrayType):
        return Vector(name, of_type("", kind.elementType))
    if isinstance(kind, T.MapType):
        return MapOf(name, of_type("", kind.keyType), of_type("", kind.valueType))
    return next((Leaf(name, k) for k, t in PRIMITIVES.items() if t == kind), Unknown(name))


def any_below(node: Node, holds: Callable[[Node], bool]) -> bool:
    return holds(node) or any(any_below(c, holds) for c in node.children())


def tree_text(root: Root) -> str:
    """One line a node, indented by depth: name, kind and marks."""
    lines = []

    def walk(node: Node, depth: int) -> None:
        marks = [m for m in ("split", "top", "base", "drop", "many") if getattr(node, m, False)]
        kind = getattr(node, "kind", type(node).__name__.lower())
        lines.append("  " * depth + " ".join([f"{node.name}: {kind}", *marks]))
        for c in node.children():
            walk(c, depth + 1)

    for c in root.columns:
        walk(c, 0)
    return "\n".join(lines)
