"""A file's tree as a table: its layout, and entry ranges of chosen columns as Arrow record batches."""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_type

from ..plans import passes
from ..plans.layout import Array, Leaf, MapOf, Node, Root, Struct, Unknown, Vector, column_name
from ..plans.synthesis import Branch, LeafInfo, Synthesis, within, arrange
from .binary import BadFile, Cursor, Key, KeyedFile, inflated

DTYPES = {"B": "i1", "b": "i1", "S": ">i2", "s": ">i2", "I": ">i4", "i": ">i4", "L": ">i8", "l": ">i8", "F": ">f4", "D": ">f8", "O": "?"}
KIND_DTYPES = {"byte": "i1", "short": ">i2", "int": ">i4", "long": ">i8", "float": ">f4", "double": ">f8", "boolean": "?"}
ONE = {kind: struct.Struct(f">{code}") for kind, code in (("byte", "b"), ("short", "h"), ("int", "i"), ("long", "q"), ("float", "f"), ("double", "d"), ("boolean", "?"))}
MEMBERWISE = 1 << 14


class NoTree(ValueError):
    def __init__(self, name: str | None):
        super().__init__(f"No tree {name or ''} found".replace("  ", " "))


def _dims(title: str) -> list[str]:
    return re.findall(r"\[([^\]]*)\]", title)


class Tree:
    """An open tree. columns(options) gives its layout after the passes; batches() reads."""

    def __init__(self, path: str, name: str | None = None, settings: dict[str, str] | None = None):
        self.file = KeyedFile(path, settings)
        try:
            key = self.file.find("TTree", name)
            if key is None:
                raise NoTree(name)
            self.meta = self.file.value(self.file.object_cursor(key), "TTree")
            self.entries = int(self.meta["fEntries"])
            self.stored = {b["fName"].rstrip("."): b for b in self.meta["fBranches"] if b}
            self.synthesis = Synthesis(arrange(self.file.descriptions()))
            self.latest: dict[int, tuple] = {}
        except BaseException:
            self.file.close()
            raise

    def __enter__(self) -> Tree:
        return self

    def __exit__(self, *_: object) -> None:
        self.file.close()

    # layout -----------------------------------------------------------------------------------------------------------------

    def described(self, b: dict) -> Branch:
        leaves = []
        for x in b["fLeaves"] or []:
            if x and x["class"] != "TLeafElement":
                code = x["class"][-1]
                if x.get("fIsUnsigned"):
                    code = code.lower()
                dims = _dims(x["fTitle"])
                counter = x["fLeafCount"]["fName"] if x.get("fLeafCount") else None
                sizes = tuple(int(d) if d.isdigit() else None for d in dims) if code != "C" else ()
                leaves.append(LeafInfo(x["fName"], code, sizes, counter))
        return Branch(b["fName"].rstrip("."), b.get("fClassName", "") if b["class"] == "TBranchElement" else "", tuple(leaves), tuple(self.described(s) for s in b["fBranches"] or [] if s), b.get("fID", -1), b.get("fType", 0), b.get("fClonesName", ""))

    def layout(self, options: dict | None = None) -> Root:
        return passes.run(Root(tuple(self.synthesis.column(self.described(b)) for b in self.stored.values()), self.entries), options)

    def ranges(self, least: int) -> list[tuple[int, int]]:
        """Entry ranges of at least that many entries, cut where baskets of the first column end."""
        cuts = sorted({e for b in list(self.stored.values())[:1] for e in (b.get("fBasketEntry") or [])[: b.get("fWriteBasket", 0) + 1] if 0 < e < self.entries})
        out, start = [], 0
        for c in [*cuts, self.entries]:
            if c - start >= least or c == self.entries:
                out.append((start, c))
                start = c
        return [r for r in out if r[1] > r[0]]

    # reading ----------------------------------------------------------------------------------------------------------------

    def baskets(self, b: dict, start: int, end: int) -> Iterator[tuple[int, bytes, np.ndarray | None]]:
        """(first entry, data, where each entry begins or None) of the baskets that hold entries of the range."""
        n, held = b["fWriteBasket"], [x for x in b.get("fBaskets") or [] if x and x["entries"]]
        firsts = [*b["fBasketEntry"][:n], b["fEntries"] - sum(x["entries"] for x in held)]
        for i in range(n):
            if firsts[i] < end and firsts[i + 1] > start:
                yield firsts[i], *self.basket(b, i)
        first = firsts[-1]
        for x in held:  # what the writer left within the branch
            if first < end and first + x["entries"] > start:
                yield first, x["data"], x["offsets"]
            first += x["entries"]

    def basket(self, b: dict, i: int) -> tuple[bytes, np.ndarray | None]:
        """A branch's basket; its latest one is kept, as batches may end within it."""
        seek = b["fBasketSeek"][i]
        kept = self.latest.get(id(b))
        if kept is None or kept[0] != seek:
            head = self.file.at(seek, b["fBasketBytes"][i])
            c = Cursor(head)
            key = Key.read(c)
            _, _, _, held, last = c.take("hiiii")
            raw = head[key.head : key.size]
            plain = raw if len(raw) == key.plain else inflated(raw, key.plain)
            border, offsets = last - key.head, None
            if len(plain) > border + 4:
                offsets = np.append(np.frombuffer(plain, ">i4", held, border + 4).astype(np.int64) - key.head, border)
            kept = self.latest[id(b)] = seek, plain[:border], offsets
        return kept[1:]

    def pieces(self, b: dict, start: int, end: int, width: int | None) -> tuple[bytes, np.ndarray]:
        """The range's bytes and each entry's beginning in them; entries of width bytes where none are stored."""
        parts, sizes = [], []
        for first, data, offsets in self.baskets(b, start, end):
            if offsets is None:
                if not width:
                    raise BadFile(f"{b['fName']} has entries of unknown lengths")
                offsets = np.arange(0, len(data) + 1, width)
            lo, hi = max(0, start - first), min(len(offsets) - 1, end - first)
            parts.append(data[offsets[lo] : offsets[hi]])
            sizes.append(np.diff(offsets[lo : hi + 1]))
        sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        if len(sizes) != end - start:
            raise BadFile(f"{b['fName']} holds {len(sizes)} of {end - start} entries")
        return b"".join(parts), np.concatenate(([0], np.cumsum(sizes)))

    def batch(self, root: Root, start: int, end: int) -> pa.RecordBatch:
        """Entries start to end of the layout's columns."""
        by_column = {column_name(n): b for n, b in self.stored.items()}
        arrays = [self.column(c, by_column[c.column], start, end) for c in root.columns]
        fields = [pa.field(c.column, a.type) for c, a in zip(root.columns, arrays, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields)) if fields else pa.RecordBatch.from_pydict({})

    def column(self, node: Node, b: dict, start: int, end: int) -> pa.Array:
        if isinstance(node, Unknown):
            return pa.nulls(end - start)
        if b["class"] != "TBranchElement":
            return self.leaves(node, b, start, end)
        subs = {within(s["fName"], b["fName"]): s for s in b["fBranches"] or [] if s}
        if isinstance(node, Vector) and node.split and isinstance(node.item, Struct):
            data, _ = self.pieces(b, start, end, 4)
            counts = np.frombuffer(data, ">i4").astype(np.int64)
            arrays = {id(m): self.items(m, s, start, end, counts) for m, s in self.split_members(node.item, subs)}
            return _lists(counts, self.nested(node.item, arrays, int(counts.sum())))
        if isinstance(node, Struct) and node.split:
            shown = [m for m in node.members if not m.hidden]
            arrays = [self.column(m, self.sub(m, subs), start, end) for m in shown]
            return pa.StructArray.from_arrays(arrays, fields=[pa.field(m.column, a.type) for m, a in zip(shown, arrays, strict=True)])
        if isinstance(node, Leaf) and node.kind != "string":
            data, _ = self.pieces(b, start, end, np.dtype(KIND_DTYPES[node.kind]).itemsize)
            return _flat(np.frombuffer(data, KIND_DTYPES[node.kind]))
        return self.objects(node, b, start, end)

    def sub(self, node: Node, subs: dict[str, dict]) -> dict:
        for name, s in subs.items():
            if column_name(name) == node.column:
                return s
        return {"class": "TBranchElement", "fName": "", "fBranches": list(subs.values()), "fLeaves": []}  # a base or an inner object

    def split_members(self, item: Struct, subs: dict[str, dict]) -> Iterator[tuple[Node, dict]]:
        """Members that have a sub-branch, those of split bases and inner objects as well."""
        for m in item.members:
            if m.hidden:
                continue
            if isinstance(m, Struct) and m.split:
                yield from self.split_members(m, {n.removeprefix(f"{m.name}."): s for n, s in subs.items()})
            elif m.name in subs:
                yield m, subs[m.name]

    def items(self, m: Node, b: dict, start: int, end: int, counts: np.ndarray) -> pa.Array:
        """Values of a member of a split collection, item behind item; counts of them an entry."""
        data, at = self.pieces(b, start, end, None)
        dims, inner = 1, m
        while isinstance(inner, Array) and inner.length:
            dims, inner = dims * inner.length, inner.item
        if isinstance(inner, Leaf) and inner.kind in KIND_DTYPES:
            flat = np.frombuffer(data, KIND_DTYPES[inner.kind])
            if (np.diff(at) != counts * dims * flat.dtype.itemsize).any():
                raise BadFile(f"members of {b['fName']} differ in length")
            return _dimensions(m, flat, np.full(int(counts.sum()), dims))
        read, out = Decoder(), []
        for a, n in zip(at[:-1].tolist(), counts.tolist(), strict=True):
            if n:
                out += read.many(m, Cursor(data, a), n)
        return pa.array(out, to_arrow_type(m.spark_type()))

    def nested(self, item: Struct, arrays: dict[int, pa.Array], n: int) -> pa.Array:
        fields, cols = [], []
        for m in item.members:
            if not m.hidden:
                a = self.nested(m, arrays, n) if isinstance(m, Struct) and m.split else arrays.get(id(m))
                if a is None:
                    raise BadFile(f"member {m.name} of a split collection has no branch")
                fields.append(pa.field(m.column, a.type))
                cols.append(a)
        return pa.StructArray.from_arrays(cols, fields=fields) if cols else pa.array([{}] * n, pa.struct([]))

    def leaves(self, node: Node, b: dict, start: int, end: int) -> pa.Array:
        leaves = [x for x in b["fLeaves"] if x]
        if isinstance(node, Struct):
            dtype = np.dtype([(x["fName"], DTYPES[x["class"][-1]], (x["fLen"],)) for x in leaves])
            data, _ = self.pieces(b, start, end, dtype.itemsize)
            rows = np.frombuffer(data, dtype)
            cols = [_dimensions(m, np.ascontiguousarray(rows[m.name]).reshape(-1), np.full(len(rows), rows[m.name].shape[1])) for m in node.members]
            return pa.StructArray.from_arrays(cols, fields=[pa.field(m.column, a.type) for m, a in zip(node.members, cols, strict=True)])
        leaf = leaves[0]
        if leaf["class"] == "TLeafC":
            data, at = self.pieces(b, start, end, None)
            out = []
            for a in at[:-1].tolist():
                c = Cursor(data, a)
                out.append(c.text())
            return pa.array(out, pa.string())
        dtype = np.dtype(DTYPES[leaf["class"][-1]])
        data, at = self.pieces(b, start, end, dtype.itemsize * max(1, leaf["fLen"]) if not leaf.get("fLeafCount") else None)
        return _dimensions(node, np.frombuffer(data, dtype), np.diff(at) // dtype.itemsize)

    def objects(self, node: Node, b: dict, start: int, end: int) -> pa.Array:
        """Entries stored in one piece, decoded by their layout."""
        data, at = self.pieces(b, start, end, None)
        basic = isinstance(node, Vector) and isinstance(node.item, Leaf) and node.item.kind in KIND_DTYPES
        if basic:  # a header of six bytes and the length, then the numbers
            dtype = np.dtype(KIND_DTYPES[node.item.kind])
            sizes = (np.diff(at) - 10) // dtype.itemsize
            keep = np.ones(len(data), bool)
            keep[(at[:-1, None] + np.arange(10)).reshape(-1)] = False
            return _lists(sizes, _flat(np.frombuffer(np.frombuffer(data, np.uint8)[keep].tobytes(), dtype)))
        read, ends = Decoder(), at[1:].tolist()
        out = [read.entry(node, Cursor(data, a), end) for a, end in zip(at[:-1].tolist(), ends, strict=True)]
        return pa.array(out, to_arrow_type(node.spark_type()))

    def batches(self, root: Root, start: int, end: int, size: int = 20_000, may_hold: Callable[[pa.RecordBatch], np.ndarray] | None = None, by: tuple[str, ...] = ()) -> Iterator[pa.RecordBatch]:
        """The range in batches; may_hold, asked with the columns by, says which entries may be wanted.

        Batches without such an entry are left out before any other column of theirs is read.
        """
        few = replace(root, columns=tuple(c for c in root.columns if c.column in by))
        for a in range(start, end, size):
            b = min(end, a + size)
            if few.columns and may_hold:
                hit = may_hold(self.batch(few, a, b))
                if not hit.any():
                    continue
                yield self.batch(root, a, b).filter(pa.array(hit))
            elif root.columns:
                yield self.batch(root, a, b)


def _flat(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values.astype(values.dtype.newbyteorder("="))))


def _lists(counts: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), values)


def _dimensions(node: Node, flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Values of arrays of any dimensions, counts of them an entry; inner dimensions are fixed."""
    dims: list[Array] = []
    while isinstance(node, Array):
        dims.append(node)
        node = node.item
    if isinstance(node, Unknown):
        return pa.nulls(len(counts))
    out = _flat(flat)
    inner = 1
    for d in reversed(dims[1:]):
        out = _lists(np.full(len(out) // d.length, d.length), out)
        inner *= d.length
    return _lists(counts // inner, out) if dims else out


class Decoder:
    """Values stored in one piece, by their layout: object by object, or member by member where a header says so.

    What is a branch or a member (top) has a header of its own: a byte count, a version and the mark of the storage
    member by member. Items of a collection have none, but for records, whose byte count may lack.
    """

    def entry(self, node: Node, c: Cursor, end: int):
        """The value of a whole entry that ends there; a record's members may begin at once, without a header."""
        if isinstance(node, Struct) and node.top and not _is_pair(node):
            head = int.from_bytes(c.data[c.at : c.at + 4], "big")
            if head != 0x40000000 | (end - c.at - 4):
                return self.members(node, c)
        return self.value(node if not isinstance(node, (Vector, MapOf)) or node.top else replace(node, top=True), c)

    def value(self, node: Node, c: Cursor):
        if isinstance(node, Leaf):
            if node.kind == "string":
                if node.top:
                    self.passed(c)
                return c.text()
            one = ONE[node.kind]
            c.at += one.size
            return one.unpack_from(c.data, c.at - one.size)[0]
        if isinstance(node, Array):
            return self.many(node.item, c, node.length or 0)
        if isinstance(node, (Vector, MapOf)):
            return self.behind_header(node, c, lambda memberwise: self.collection(node, c, memberwise)) if node.top else self.collection(node, c)
        if isinstance(node, Struct):
            if _is_pair(node):
                return self.members(node, c)
            version, end = c.version()
            if not version:
                c.take("I")  # the checksum of a class without a version
            out = self.members(node, c)
            if end is not None:
                c.at = end
            return out
        raise BadFile(f"{node.name} can't be decoded")

    def members(self, node: Struct, c: Cursor) -> dict:
        out = [(m, self.value(m, c)) for m in node.members]
        return {m.column: v for m, v in out if not m.hidden}

    @staticmethod
    def passed(c: Cursor) -> None:
        """The header of a string, where there is one."""
        if int.from_bytes(c.data[c.at : c.at + 4], "big") & 0x40000000:
            c.at += 6

    def behind_header(self, node: Node, c: Cursor, read: Callable):
        version, end = c.version()
        memberwise = bool(version & MEMBERWISE)
        if memberwise and not c.take("H"):
            c.take("I")
        out = read(memberwise)
        if end is not None:
            c.at = end
        return out

    def collection(self, node: Node, c: Cursor, memberwise: bool = False):
        n = c.take("i")
        if isinstance(node, MapOf):
            if not memberwise and _is_number(node.key) and _is_number(node.value):
                pairs = np.frombuffer(c.bytes(n * (ONE[node.key.kind].size + ONE[node.value.kind].size)), [("k", KIND_DTYPES[node.key.kind]), ("v", KIND_DTYPES[node.value.kind])]).tolist()
            elif memberwise:
                pairs = list(zip(self.many(node.key, c, n), self.many(node.value, c, n), strict=True))
            else:
                pairs = [(self.value(node.key, c), self.value(node.value, c)) for _ in range(n)]
            if not node.many:
                return list(dict(pairs).items())
            grouped: dict = {}
            for k, v in pairs:
                grouped.setdefault(k, []).append(v)
            return list(grouped.items())
        if memberwise and n and isinstance(node.item, Struct):
            return self.columns(node.item, c, n)
        if isinstance(node.item, Leaf) and node.item.kind in KIND_DTYPES:
            return self.many(node.item, c, n)
        return [self.value(node.item, c) for _ in range(n)]

    def many(self, node: Node, c: Cursor, n: int) -> list:
        """n values one behind another, as a member of n items is stored: containers have one header for all of them."""
        if isinstance(node, Leaf) and node.kind in KIND_DTYPES:
            dtype = np.dtype(KIND_DTYPES[node.kind])
            return np.frombuffer(c.bytes(n * dtype.itemsize), dtype).tolist()
        if isinstance(node, Leaf) and node.kind == "string":
            if node.top:
                self.passed(c)
            return [c.text() for _ in range(n)]
        if isinstance(node, (Vector, MapOf)) and node.top:
            return self.behind_header(node, c, lambda memberwise: [self.collection(node, c, memberwise) for _ in range(n)])
        if isinstance(node, Struct) and node.base:
            return self.columns(node, c, n)
        return [self.value(node, c) for _ in range(n)]

    def columns(self, node: Struct, c: Cursor, n: int) -> list[dict]:
        """n records stored member by member; bases have no header here."""
        columns = [(m.column, v) for m in node.members for v in [self.many(m, c, n)] if not m.hidden]
        return [{name: v[i] for name, v in columns} for i in range(n)]


def _is_number(node: Node) -> bool:
    return isinstance(node, Leaf) and node.kind in KIND_DTYPES


def _is_pair(node: Struct) -> bool:
    return [m.name for m in node.members] == ["first", "second"]
