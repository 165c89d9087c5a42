"""Schema-time rewrites of a layout, each switched by an option, and their effect on a DataFrame.

Options are on, off, true or false in any case; another value raises UnknownOption.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .layout import Array, Leaf, MapOf, Node, Root, Struct, Unknown, Vector, any_below


class UnknownOption(ValueError):
    def __init__(self, option: str):
        super().__init__(f"Unknown option provided: {option}")
        self.option = option


Pass = Callable[[Root], Root]


def _rewrite(node: Node, change: Callable[[Node], Node]) -> Node:
    """change() from the leaves up."""
    return change(node.with_children(tuple(_rewrite(c, change) for c in node.children())))


def _is_null(node: Node) -> bool:
    return isinstance(node, Unknown)


def _item_is(node: Node, holds: Callable[[Node], bool]) -> bool:
    """Whether it holds for the node, or for what a collection holds at any depth; records are not looked into."""
    return holds(node) or (not isinstance(node, Struct) and any(_item_is(c, holds) for c in node.children()))


def _is_empty(node: Node) -> bool:
    return isinstance(node, Struct) and all(m.hidden for m in node.members)


def remove_empty(root: Root) -> Root:
    """Records without a live member go, and collections of them; within an unsplit record they are read and hidden.

    Top columns stay.
    """

    def change(node: Node) -> Node:
        if not isinstance(node, Struct):
            return node
        gone = lambda m: _item_is(m, _is_empty)
        if node.split:
            return replace(node, members=tuple(m for m in node.members if not gone(m)))
        return replace(node, members=tuple(m.hide() if gone(m) else m for m in node.members))

    return replace(root, columns=tuple(_rewrite(c, change) for c in root.columns))


def flatten_base(root: Root) -> Root:
    """Members of split base-class records move into the derived record; unsplit ones stay nested."""

    def change(node: Node) -> Node:
        if not isinstance(node, Struct):
            return node
        members: list[Node] = []
        for m in node.members:
            members += m.members if isinstance(m, Struct) and m.base and m.split else (m,)
        return replace(node, members=tuple(members))

    return replace(root, columns=tuple(_rewrite(c, change) for c in root.columns))


def soft_remove_null(root: Root) -> Root:
    """Undecodable members go everywhere; within an unsplit record they are read and hidden."""
    null = lambda n: _item_is(n, _is_null)

    def change(node: Node) -> Node:
        if not isinstance(node, Struct):
            return node
        if node.split:
            return replace(node, members=tuple(m for m in node.members if not null(m)))
        return replace(node, members=tuple(m.hide() if null(m) else m for m in node.members))

    return replace(root, columns=tuple(_rewrite(c, change) for c in root.columns if not null(c)))


def hard_remove_null(root: Root) -> Root:
    """What is stored in one piece and holds something undecodable goes whole; so do undecodable members of split records."""

    def whole_and_null(node: Node) -> bool:
        if isinstance(node, (Struct, Vector, MapOf)) and node.split:
            return False
        return not isinstance(node, (Leaf, Unknown)) and any_below(node, _is_null)

    def change(node: Node) -> Node:
        if isinstance(node, Struct) and node.split:
            kept = (m for m in node.members if not (whole_and_null(m) or _item_is(m, _is_null)))
            return replace(node, members=tuple(change(m) for m in kept))
        if isinstance(node, Vector) and node.split:
            return replace(node, item=change(node.item))
        return node

    return replace(root, columns=tuple(change(c) for c in root.columns if not whole_and_null(c)))


#: Passes in the order of a run: option, rewrite, whether it runs unless switched off.
PASSES: tuple[tuple[str, Pass, bool], ...] = (
    ("removeemptyrowpass", remove_empty, True),
    ("flattenoutbasepass", flatten_base, True),
    ("softremovenulltypepass", soft_remove_null, False),
    ("hardremovenulltypepass", hard_remove_null, True),
    ("removeemptyrowpass", remove_empty, True),
)
PRUNING = "pruningpass"


def switched(options: Mapping[str, str], name: str, default: bool) -> bool:
    lowered = {k.lower(): v for k, v in options.items()}
    if name not in lowered:
        return default
    value = str(lowered[name]).lower()
    if value in ("on", "true"):
        return True
    if value in ("off", "false"):
        return False
    raise UnknownOption(str(lowered[name]))


def run(root: Root, options: Mapping[str, str] | None = None) -> Root:
    for name, rewrite, default in PASSES:
        if switched(options or {}, name, default):
            root = rewrite(root)
    return root


def prune(root: Root, required: T.StructType | str, options: Mapping[str, str] | None = None) -> Root:
    """root with the required columns alone, in their order, and of nested records the required members.

    Split records take the required order; unsplit ones keep the stored order and hide the rest. Maps stay whole.
    """
    if isinstance(required, str):
        required = T._parse_datatype_string(required)
    by_name = {c.column: c for c in root.columns}
    columns = tuple(by_name[f.name] for f in required.fields)
    if not switched(options or {}, PRUNING, True):
        return replace(root, columns=columns)

    def fit(node: Node, kind: T.DataType | None) -> Node:
        if kind is None:
            return node.hide()
        if isinstance(node, (Vector, Array)) and isinstance(kind, T.ArrayType):
            return replace(node, item=fit(node.item, kind.elementType))
        if isinstance(node, Struct) and node.members and isinstance(kind, T.StructType):
            if node.split:
                own = {m.column: m for m in node.members}
                return replace(node, members=tuple(fit(own[f.name], f.dataType) for f in kind.fields))
            wanted = {f.name: f.dataType for f in kind.fields}
            return replace(node, members=tuple(fit(m, wanted.get(m.column)) for m in node.members))
        return node

    return replace(root, columns=tuple(fit(c, f.dataType) for c, f in zip(columns, required.fields, strict=True)))


def applied(df: DataFrame, stored: Root, shown: Root) -> DataFrame:
    """df, laid out as stored, with the columns and members of shown: one projection that Catalyst prunes further."""
    own = {c.column: c for c in stored.columns}
    return df.select(*(_project(F.col(f"`{c.column}`"), own[c.column], c).alias(c.column) for c in shown.columns))


def _paths(node: Struct) -> dict[str, tuple[list[str], Node]]:
    """Where each member is stored: its own place, or within split base records."""
    out = {m.column: ([m.column], m) for m in node.members}
    for m in node.members:
        if isinstance(m, Struct) and m.base and m.split:
            for name, (path, of) in _paths(m).items():
                out.setdefault(name, ([m.column, *path], of))
    return out


def _project(x: Column, stored: Node, shown: Node) -> Column:
    if stored == shown:
        return x
    if isinstance(shown, Struct):
        fields, places = [], _paths(stored)
        for m in shown.members:
            if not m.hidden:
                path, of = places[m.column]
                inner = x
                for p in path:
                    inner = inner[p]
                fields.append(_project(inner, of, m).alias(m.column))
        return F.when(x.isNotNull(), F.struct(*fields))
    if isinstance(shown, (Vector, Array)):
        return F.transform(x, lambda e: _project(e, stored.item, shown.item))
    if isinstance(shown, MapOf):
        value = (lambda v: F.transform(v, lambda e: _project(e, stored.value, shown.value))) if shown.many else (lambda v: _project(v, stored.value, shown.value))
        return F.transform_values(x, lambda k, v: value(v))
    return x
