"""Writes trees to keyed files by the class layouts listed here; write_trees() makes a file of each partition."""

from __future__ import annotations

import lzma
import struct
import zlib
from collections.abc import Callable
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ..session import ship

COUNTED, NEW_CLASS, CLASS = 0x40000000, 0xFFFFFFFF, 0x80000000
FORMATS = {1: "b", 2: "h", 3: "i", 4: "q", 5: "f", 6: "i", 8: "d", 11: "B", 13: "I", 16: "q", 18: "?"}
TYPES = {1: "char", 2: "short", 3: "int", 4: "long", 5: "float", 6: "int", 8: "double", 13: "unsigned int", 16: "Long64_t", 18: "bool"}
#: class: (version, [(member, code, type, counter)]).
LAYOUTS: dict[str, tuple[int, list[tuple]]] = {
    "TAttLine": (2, [("fLineColor", 2), ("fLineStyle", 2), ("fLineWidth", 2)]),
    "TAttFill": (2, [("fFillColor", 2), ("fFillStyle", 2)]),
    "TAttMarker": (2, [("fMarkerColor", 2), ("fMarkerStyle", 2), ("fMarkerSize", 5)]),
    "TTree": (
        20,
        [("TNamed", 67, "BASE"), ("TAttLine", 0, "BASE"), ("TAttFill", 0, "BASE"), ("TAttMarker", 0, "BASE"), ("fEntries", 16), ("fTotBytes", 16), ("fZipBytes", 16), ("fWeight", 8), ("fNClusterRange", 6), ("fClusterRangeEnd", 56, "Long64_t*", "fNClusterRange"), ("fBranches", 61, "TObjArray"), ("fLeaves", 61, "TObjArray"), ("fAliases", 64, "TList*"), ("fIndexValues", 61, "TArrayD")],
    ),
    "TBranch": (
        13,
        [("TNamed", 67, "BASE"), ("TAttFill", 0, "BASE"), ("fCompress", 3), ("fBasketSize", 3), ("fEntryOffsetLen", 3), ("fWriteBasket", 3), ("fEntryNumber", 16), ("fOffset", 3), ("fMaxBaskets", 6), ("fSplitLevel", 3), ("fEntries", 16), ("fFirstEntry", 16), ("fTotBytes", 16), ("fZipBytes", 16), ("fBranches", 61, "TObjArray"), ("fLeaves", 61, "TObjArray"), ("fBaskets", 61, "TObjArray"), ("fBasketBytes", 43, "int*", "fMaxBaskets"), ("fBasketEntry", 56, "Long64_t*", "fMaxBaskets"), ("fBasketSeek", 56, "Long64_t*", "fMaxBaskets"), ("fFileName", 65, "TString")],
    ),
    "TBranchElement": (
        10,
        [("TBranch", 0, "BASE"), ("fClassName", 65, "TString"), ("fParentName", 65, "TString"), ("fClonesName", 65, "TString"), ("fCheckSum", 13), ("fClassVersion", 2), ("fID", 3), ("fType", 3), ("fStreamerType", 3), ("fMaximum", 3), ("fBranchCount", 64, "TBranchElement*"), ("fBranchCount2", 64, "TBranchElement*")],
    ),
    "TLeaf": (2, [("TNamed", 67, "BASE"), ("fLen", 3), ("fLenType", 3), ("fOffset", 3), ("fIsRange", 18), ("fIsUnsigned", 18), ("fLeafCount", 64, "TLeaf*")]),
    "TLeafElement": (1, [("TLeaf", 0, "BASE"), ("fID", 3), ("fType", 3)]),
    **{f"TLeaf{k}": (1, [("TLeaf", 0, "BASE"), ("fMinimum", code), ("fMaximum", code)]) for k, code in (("B", 1), ("S", 2), ("I", 3), ("L", 16), ("F", 5), ("D", 8), ("O", 18), ("C", 3))},
}
LEAF_DTYPES = {"B": ">i1", "S": ">i2", "I": ">i4", "L": ">i8", "F": ">f4", "D": ">f8", "O": "?"}


class Buffer:
    """A growing object buffer; origin is the length of the key before it."""

    def __init__(self, origin: int):
        self.b, self.origin = bytearray(), origin
        self.classes: dict[str, int] = {}
        self.objects: dict[object, int] = {}

    def put(self, fmt: str, *values) -> None:
        self.b += struct.pack(f">{fmt}", *values)

    def text(self, s: str) -> None:
        raw = s.encode()
        self.b += (bytes([len(raw)]) if len(raw) < 255 else b"\xff" + struct.pack(">I", len(raw))) + raw

    @contextmanager
    def counted(self, version: int | None = None):
        at = len(self.b)
        self.put("I", 0)
        if version is not None:
            self.put("H", version)
        yield
        struct.pack_into(">I", self.b, at, COUNTED | (len(self.b) - at - 4))

    def object(self) -> None:
        self.put("HII", 1, 0, 0x03000000)

    def named(self, name: str, title: str) -> None:
        with self.counted(1):
            self.object()
            self.text(name)
            self.text(title)

    def pointer(self, cls: str | None, body: Callable | None = None, key: object = None) -> None:
        """None: no object; a key met before: a reference to its object."""
        if cls is None:
            self.put("I", 0)
        elif key is not None and key in self.objects:
            self.put("I", self.objects[key])
        else:
            at = len(self.b)
            with self.counted():
                tag_at = len(self.b)
                if cls in self.classes:
                    self.put("I", CLASS | self.classes[cls])
                else:
                    self.put("I", NEW_CLASS)
                    self.b += cls.encode() + b"\0"
                    self.classes[cls] = tag_at + self.origin + 2
                if key is not None:
                    self.objects[key] = at + self.origin + 2
                body()

    def array(self, items: list[tuple]) -> None:
        with self.counted(3):
            self.object()
            self.text("")
            self.put("ii", len(items), 0)
            for cls, value, key in items:
                self.pointer(cls, lambda cls=cls, value=value: self.value(cls, value), key)

    def value(self, cls: str, value: dict) -> None:
        if cls == "TBasket":
            self.b += value  # as it is
            return
        version, members = LAYOUTS[cls]
        with self.counted(version):
            for m in members:
                name, code = m[0], m[1]
                if code in (0, 67):
                    self.named(value["fName"], value.get("fTitle", "")) if name == "TNamed" else self.value(name, value)
                elif code in FORMATS:
                    self.put(FORMATS[code], value.get(name, 0))
                elif code > 40 and code - 40 in FORMATS:
                    own = value.get(name, [])
                    self.put("B", 1)
                    self.put(f"{len(own)}{FORMATS[code - 40]}", *own)
                elif code == 65:
                    self.text(value.get(name, ""))
                elif code == 64:
                    target = value.get(name)
                    self.pointer(None) if target is None else self.pointer(target[0], lambda t=target: self.value(t[0], t[1]), target[2])
                elif m[2] == "TObjArray":
                    self.array(value.get(name, []))
                elif m[2] == "TArrayD":
                    self.put("i", 0)


def packed(data: bytes, method: str) -> bytes:
    if not method:
        return data
    block = {"ZL": zlib.compress, "XZ": lzma.compress, "L4": lambda d: b"\0" * 8 + pa.Codec("lz4_raw").compress(d).to_pybytes(), "ZS": _zstd}[method](data)
    return method.encode() + b"\1" + len(block).to_bytes(3, "little") + len(data).to_bytes(3, "little") + block


def _zstd(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor().compress(data)


class TreeFile:
    """Columns are given as (leaves or class, entries in bytes); see leaf(), vector() and split()."""

    def __init__(self, path: str, method: str = "", per_basket: int = 1 << 30):
        self.path, self.method, self.per_basket = path, method, per_basket
        self.out = bytearray(100)
        self.keys: list[bytes] = []
        self.classes: dict[str, list[tuple]] = {}

    def key(self, cls: str, name: str, title: str, data: bytes, extra: bytes = b"", method: str | None = None) -> tuple[int, int]:
        """Writes an object; its place and length. extra lengthens the key, as baskets' keys are."""
        head = 26 + 3 + len(cls) + len(name) + len(title) + len(extra)
        body, at = packed(data, self.method if method is None else method), len(self.out)
        if len(body) >= len(data):
            body = data
        raw = struct.pack(">ihiIhhii", head + len(body), 4, len(data), 0, head, 1, at, 100) + b"".join(bytes([len(s)]) + s.encode() for s in (cls, name, title)) + extra
        self.out += raw + body
        if cls != "TBasket":
            self.keys.append(raw)
        return at, len(raw) + len(body)

    def baskets(self, branch: str, tree: str, entries: list[bytes], offsets: bool) -> dict:
        return self.packed_baskets(branch, tree, b"".join(entries), np.cumsum([0, *map(len, entries)]), offsets)

    def packed_baskets(self, branch: str, tree: str, data: bytes, at: np.ndarray, offsets: bool) -> dict:
        """Baskets of entries that lie one behind another, each from its place in at to the next."""
        seeks, sizes, firsts, total = [], [], [], len(at) - 1
        for a in range(0, total, self.per_basket):
            b = min(total, a + self.per_basket)
            part = data[at[a] : at[b]]
            head = 26 + 3 + len("TBasket") + len(branch) + len(tree) + 19
            last = head + len(part)
            if offsets:
                part += struct.pack(">i", b - a + 1) + np.append(at[a:b] - at[a] + head, 0).astype(">i4").tobytes()
            seek, size = self.key("TBasket", branch, tree, part, struct.pack(">hiiiiB", 3, 32000, 4, b - a, last, 0))
            seeks.append(seek)
            sizes.append(size)
            firsts.append(a)
        n = len(seeks)
        return {"fWriteBasket": n, "fMaxBaskets": n + 1, "fBasketBytes": [*sizes, 0], "fBasketEntry": [*firsts, total], "fBasketSeek": [*seeks, 0], "fEntries": total, "fEntryOffsetLen": 1000 * offsets}

    def leaf(self, tree: str, name: str, code: str, values: list, dims: str = "", counter: tuple | None = None, unsigned: bool = False) -> tuple:
        """A branch of one simple leaf; values as numpy can take them, or strings for code C."""
        if code == "C":
            entries = [bytes([len(v)]) + v.encode() for v in values]
            fixed = 1
        else:
            entries = [np.asarray(v).astype(LEAF_DTYPES[code]).tobytes() for v in values]
            fixed = int(np.prod([int(d) for d in dims.replace("[", " ").replace("]", " ").split() if d.isdigit()] or [1]))
        own = {"fName": name, "fTitle": name + dims, "fLen": fixed, "fIsUnsigned": unsigned, "fLeafCount": counter}
        item = (f"TLeaf{code}", own, ("leaf", name))
        variable = code == "C" or counter is not None
        return ("TBranch", {"fName": name, "fTitle": f"{name}{dims}/{code}", "fLeaves": [item], **self.baskets(name, tree, entries, variable)}, ("branch", name)), item

    def struct_leaves(self, tree: str, name: str, fields: list[tuple[str, str]], rows: list[tuple]) -> tuple:
        entries = [b"".join(np.asarray(v).astype(LEAF_DTYPES[code]).tobytes() for v, (_, code) in zip(row, fields, strict=True)) for row in rows]
        leaves = [(f"TLeaf{code}", {"fName": n, "fTitle": n, "fLen": 1}, ("leaf", f"{name}.{n}")) for n, code in fields]
        return ("TBranch", {"fName": name, "fLeaves": leaves, **self.baskets(name, tree, entries, False)}, ("branch", name))

    def element(self, tree: str, name: str, class_name: str, entries: list[bytes], branches: list | None = None, kind: int = 0, offsets: bool = True, member: int = -1) -> tuple:
        leaf = ("TLeafElement", {"fName": name, "fTitle": name, "fLen": 1}, ("leaf", name))
        own = {"fName": name, "fTitle": name, "fLeaves": [leaf], "fBranches": branches or [], "fClassName": class_name, "fType": kind, "fID": member, **self.baskets(name, tree, entries, offsets)}
        return ("TBranchElement", own, ("branch", name))

    def describe(self, cls: str, members: list[tuple], version: int = 1) -> None:
        """(name, code, type, dims, stl, item) of a class of the file's own."""
        self.classes[cls] = [version, members]

    def tree(self, name: str, branches: list[tuple], entries: int, cls: str = "TTree") -> None:
        b = Buffer(26 + 3 + len(cls) + len(name) + len("title"))
        b.value("TTree", {"fName": name, "fTitle": "title", "fEntries": entries, "fBranches": branches})
        self.key(cls, name, "title", bytes(b.b))

    def folder(self, name: str, keys_from: int, cls: str = "TDirectory") -> None:
        """A directory of the keys written since then."""
        inner = self.keys[keys_from:]
        del self.keys[keys_from:]
        seek, _ = self.raw_key("", "", "", struct.pack(">i", len(inner)) + b"".join(inner))
        self.key(cls, name, "", struct.pack(">hIIiiiii", 5, 0, 0, 0, 0, 0, 100, seek), method="")

    def raw_key(self, cls: str, name: str, title: str, data: bytes) -> tuple[int, int]:
        n = len(self.keys)
        out = self.key(cls, name, title, data, method="")
        del self.keys[n:]
        return out

    def infos(self) -> bytes:
        b = Buffer(26 + 3 + len("TList") + len("StreamerInfo"))
        known = {k: (v, [(m[0], m[1], *(m[2:3] or (TYPES.get(m[1], ""),)), (), 0, 0, *(m[3:4] or ("",))) for m in ms]) for k, (v, ms) in LAYOUTS.items()}
        known |= {k: (v, [(*m, *((), 0, 0)[len(m) - 3 :], "")[:7] if len(m) < 7 else m for m in ms]) for k, (v, ms) in self.classes.items()}

        def member(m: tuple) -> tuple[str, Callable]:
            name, code, kind, dims, stl, item, counter = m
            cls = "TStreamerBase" if kind == "BASE" else "TStreamerSTL" if code == 500 else "TStreamerBasicPointer" if 40 < code < 60 else "TStreamerString" if code == 65 else "TStreamerObject" if 60 < code < 70 else "TStreamerBasicType"

            def body() -> None:
                with b.counted(2):
                    with b.counted(4):
                        b.named(name, "")
                        b.put("iiii5i", code, 4, int(np.prod(dims)) if dims else 0, len(dims), *[*dims, *[0] * 5][:5])
                        b.text(kind)
                    if 40 < code < 60:
                        b.put("i", 1)
                        b.text(counter)
                        b.text("TTree")
                    elif code == 500:
                        b.put("ii", stl, item)
                    elif kind == "BASE":
                        b.put("i", 1)

            return cls, body

        def info(name: str, version: int, members: list[tuple]) -> None:
            with b.counted(9):
                b.named(name, "")
                b.put("Ii", 0, version)

                def list_of() -> None:
                    with b.counted(3):
                        b.object()
                        b.text("")
                        b.put("ii", len(members), 0)
                        for m in members:
                            b.pointer(*member(m))

                b.pointer("TObjArray", list_of)

        with b.counted(5):
            b.object()
            b.text("")
            b.put("i", len(known))
            for name, (version, members) in known.items():
                b.pointer("TStreamerInfo", lambda name=name, version=version, members=members: info(name, version, members))
                b.put("B", 0)
        return bytes(b.b)

    def close(self) -> str:
        with open(self.path, "wb") as f:
            f.write(self.bytes())
        return self.path

    def bytes(self) -> bytes:
        # the directory record stands right behind the file's own key at 100; here both come last and the header says where
        info_at, info_size = self.raw_key("TList", "StreamerInfo", "", self.infos())
        keys_at, keys_size = self.raw_key("TFile", "f", "", struct.pack(">i", len(self.keys)) + b"".join(self.keys))
        begin = len(self.out)
        if begin >= 1 << 31:
            raise ValueError("a file's places have 32 bits; write more partitions")
        self.out += struct.pack(">hIIiiiii", 5, 0, 0, keys_size, 0, begin, 0, keys_at) + bytes(40)
        struct.pack_into(">4siiiiiiiBiii", self.out, 0, b"root", 62206, begin, len(self.out), 0, 0, 0, 0, 4, 1, info_at, info_size)
        return bytes(self.out)


def vector_entry(values: list, dtype: str) -> bytes:
    body = struct.pack(">i", len(values)) + np.asarray(values).astype(dtype).tobytes()
    return struct.pack(">IH", COUNTED | (len(body) + 2), 9) + body


def nested_vector_entry(values: list[list], dtype: str) -> bytes:
    body = struct.pack(">i", len(values)) + b"".join(struct.pack(">i", len(v)) + np.asarray(v).astype(dtype).tobytes() for v in values)
    return struct.pack(">IH", COUNTED | (len(body) + 2), 9) + body


#: Arrow types of numbers: leaf code, C++ name and member code.
NUMBERS = {pa.int8(): ("B", "char", 1), pa.int16(): ("S", "short", 2), pa.int32(): ("I", "int", 3), pa.int64(): ("L", "Long64_t", 16), pa.float32(): ("F", "float", 5), pa.float64(): ("D", "double", 8), pa.bool_(): ("O", "bool", 18)}


def _numbers(values: pa.Array, code: str) -> bytes:
    return values.to_numpy(zero_copy_only=False).astype(LEAF_DTYPES[code]).tobytes()


def c_name(kind: pa.DataType, record: str) -> str:
    """The C++ type of values; records are classes of their own, named by where they stand."""
    if kind in NUMBERS:
        return NUMBERS[kind][1]
    if pa.types.is_string(kind):
        return "string"
    inner = []
    if pa.types.is_list(kind):
        inner = [c_name(kind.value_type, record)]
    elif pa.types.is_map(kind):
        inner = [c_name(kind.key_type, f"{record}_key"), c_name(kind.item_type, record)]
    elif pa.types.is_struct(kind):
        return f"Record_{record}"
    if not inner:
        raise ValueError(f"{record} of type {kind} can't be written to a tree")
    text = ",".join(inner)
    return f"{'map' if len(inner) == 2 else 'vector'}<{text}{' ' if text.endswith('>') else ''}>"


def member_of(name: str, kind: pa.DataType, record: str) -> tuple:
    """A class's member as TreeFile.describe() takes it."""
    if kind in NUMBERS:
        return name, NUMBERS[kind][2], NUMBERS[kind][1]
    if pa.types.is_string(kind):
        return name, 500, "string", (), 365, 0
    if pa.types.is_struct(kind):
        return name, 62, c_name(kind, record)
    item = NUMBERS[kind.value_type][2] if pa.types.is_list(kind) and kind.value_type in NUMBERS else 61
    return name, 500, c_name(kind, record), (), 4 if pa.types.is_map(kind) else 1, item


def describe(f: TreeFile, kind: pa.DataType, record: str) -> None:
    """Lists the classes of all records that a type holds."""
    if pa.types.is_struct(kind):
        f.describe(c_name(kind, record), [member_of(x.name, x.type, f"{record}_{x.name}") for x in kind])
        for x in kind:
            describe(f, x.type, f"{record}_{x.name}")
    elif pa.types.is_list(kind):
        describe(f, kind.value_type, record)
    elif pa.types.is_map(kind):
        describe(f, kind.key_type, f"{record}_key")
        describe(f, kind.item_type, record)


def headed(body: bytes, version: int) -> bytes:
    return struct.pack(">IH", COUNTED | (len(body) + 2), version) + body


def encoder(kind: pa.DataType, top: bool) -> Callable[[object], bytes]:
    """Bytes of a value stored in one piece; top: a branch or a member, whose container has a header."""
    if kind in NUMBERS:
        pack = struct.Struct(f">{FORMATS[NUMBERS[kind][2]]}").pack
        return lambda v: pack(v)
    if pa.types.is_string(kind):
        return (lambda v: headed(_raw(v.encode()), 1)) if top else (lambda v: _raw(v.encode()))
    if pa.types.is_struct(kind):
        members = [(x.name, encoder(x.type, True)) for x in kind]
        return lambda v: headed(b"".join(put(v[n]) for n, put in members), 1)
    if pa.types.is_map(kind):
        key, item = encoder(kind.key_type, False), encoder(kind.item_type, False)
        body = lambda v: struct.pack(">i", len(v)) + b"".join(key(k) + item(x) for k, x in v)
    else:
        one = encoder(kind.value_type, False)
        body = lambda v: struct.pack(">i", len(v)) + b"".join(map(one, v))
    return (lambda v: headed(body(v), 9)) if top else body


def many(kind: pa.DataType, values: list) -> bytes:
    """A member of several items, one behind another: containers have one header for all of them."""
    if not values:
        return b""
    nested = pa.types.is_string(kind) or pa.types.is_list(kind) or pa.types.is_map(kind)
    body = b"".join(map(encoder(kind, False), values))
    return headed(body, 1 if pa.types.is_string(kind) else 9) if nested else body


def _whole(values: pa.Array) -> bool:
    """Whether there is no null in it at any depth."""
    if values.null_count:
        return False
    kind = values.type
    if pa.types.is_list(kind):
        return _whole(values.flatten())
    if pa.types.is_map(kind):
        return _whole(values.keys) and _whole(values.items)
    return not pa.types.is_struct(kind) or all(_whole(x) for x in values.flatten())


def add_column(f: TreeFile, tree: str, name: str, values: pa.Array, dims: tuple[int, ...] | str | None = None, counters: dict | None = None, multi: bool = False) -> tuple:
    """A branch of a column; multi: a map of lists is a multimap.

    Numbers are leaves, and lists of them as well where dims says so: fixed dimensions, or the name of the column that
    counts them. Lists of records are split, a branch a member, and a record within such a record is a base class.
    All else is stored in one piece.
    """
    kind = values.type
    if not _whole(values):
        raise ValueError(f"column {name} holds nulls, which a tree has no place for")
    if dims is not None:
        flat, fixed = values, () if isinstance(dims, str) else dims
        while pa.types.is_list(flat.type):
            flat = flat.flatten()
        code = NUMBERS[flat.type][0]
        width, n = np.dtype(LEAF_DTYPES[code]).itemsize, int(np.prod(fixed))
        at = np.concatenate(([0], np.cumsum(np.diff(values.offsets.to_numpy())))) if isinstance(dims, str) else np.arange(len(values) + 1) * n
        if at[-1] != len(flat):
            raise ValueError(f"column {name} has entries of other dimensions than {dims}")
        title = name + "".join(f"[{d}]" for d in ((dims,) if isinstance(dims, str) else fixed))
        leaf = (f"TLeaf{code}", {"fName": name, "fTitle": title, "fLen": n, "fLeafCount": counters[dims] if isinstance(dims, str) else None}, ("leaf", name))
        return "TBranch", {"fName": name, "fTitle": f"{title}/{code}", "fLeaves": [leaf], **f.packed_baskets(name, tree, _numbers(flat, code), at * width, isinstance(dims, str))}, ("branch", name)
    if kind in NUMBERS:
        code = NUMBERS[kind][0]
        width = np.dtype(LEAF_DTYPES[code]).itemsize
        baskets = f.packed_baskets(name, tree, _numbers(values, code), np.arange(len(values) + 1) * width, False)
        leaf = (f"TLeaf{code}", {"fName": name, "fTitle": name, "fLen": 1}, ("leaf", name))
        if counters is not None:
            counters[name] = leaf
        return "TBranch", {"fName": name, "fTitle": f"{name}/{code}", "fLeaves": [leaf], **baskets}, ("branch", name)
    if pa.types.is_list(kind):
        sizes = np.diff(values.offsets.to_numpy())
        at, flat, item = np.concatenate(([0], np.cumsum(sizes))), values.flatten(), kind.value_type
        if item in NUMBERS:
            code, own, _ = NUMBERS[item]
            width = np.dtype(LEAF_DTYPES[code]).itemsize
            data = _numbers(flat, code)
            head = [struct.pack(">IHi", COUNTED | (6 + width * n), 9, n) for n in sizes.tolist()]
            return f.element(tree, name, f"vector<{own}>", [h + data[a * width : b * width] for h, a, b in zip(head, at[:-1].tolist(), at[1:].tolist(), strict=True)])
        if pa.types.is_struct(item):
            f.describe(c_name(item, name), _with_bases(f, item, name))
            subs = [sub_branch(f, tree, name, place, x, part, at) for place, (x, part) in enumerate(_parts(flat))]
            return f.element(tree, name, f"vector<{c_name(item, name)}>", [struct.pack(">i", n) for n in sizes.tolist()], subs, kind=4, offsets=False)
    rows, head = values.to_pylist(), ""
    if multi:  # each key as often as it has values
        kind, head = pa.map_(kind.key_type, kind.item_type.value_type), "multi"
        rows = [[(k, x) for k, own in row for x in own] for row in rows]
    describe(f, kind, name)
    return f.element(tree, name, head + c_name(kind, name), list(map(encoder(kind, True), rows)))


def _with_bases(f: TreeFile, kind: pa.DataType, record: str) -> list[tuple]:
    out = []
    for x in kind:
        if pa.types.is_struct(x.type):
            f.describe(x.name, _with_bases(f, x.type, f"{record}_{x.name}"))
            out.append((x.name, 0, "BASE"))
        else:
            describe(f, x.type, f"{record}_{x.name}")
            out.append(member_of(x.name, x.type, f"{record}_{x.name}"))
    return out


def _parts(flat: pa.Array) -> list[tuple[pa.Field, pa.Array]]:
    """Members of records, those of bases among them."""
    out = []
    for x, part in zip(flat.type, flat.flatten(), strict=True):
        out += _parts(part) if pa.types.is_struct(x.type) else [(x, part)]
    return out


def sub_branch(f: TreeFile, tree: str, name: str, place: int, member: pa.Field, values: pa.Array, at: np.ndarray) -> tuple:
    """A member of a split collection; at: where each entry's items begin, and the end."""
    sub, cls = f"{name}.{member.name}", f"Record_{name}"
    if member.type in NUMBERS:
        code = NUMBERS[member.type][0]
        baskets = f.packed_baskets(sub, tree, _numbers(values, code), at * np.dtype(LEAF_DTYPES[code]).itemsize, True)
    else:
        cells = values.to_pylist()
        baskets = f.baskets(sub, tree, [many(member.type, cells[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], True)
    leaf = ("TLeafElement", {"fName": sub, "fTitle": sub, "fLen": 1}, ("leaf", sub))
    return "TBranchElement", {"fName": sub, "fTitle": sub, "fLeaves": [leaf], "fClassName": cls, "fType": 41, "fID": place, **baskets}, ("branch", sub)


def _raw(raw: bytes) -> bytes:
    return (bytes([len(raw)]) if len(raw) < 255 else b"\xff" + struct.pack(">I", len(raw))) + raw


def write_trees(df: DataFrame, folder: str, tree: str = "Events", method: str = "ZL", per_basket: int = 8192, arrays: dict[str, tuple[int, ...] | str] | None = None, multimaps: tuple[str, ...] = ()) -> DataFrame:
    """Writes a file of each partition that has rows; path and entries of each, in a table that is already made.

    Columns hold numbers, strings, lists, maps and records of them at any depth, without nulls; add_column() says how
    each is stored. arrays: columns that are leaf arrays, by their fixed dimensions or the column that counts them; multimaps: maps of
    lists that are stored as such. A task holds its partition's packed columns, less than 2 GB, and one that runs again replaces its file.
    """
    ship(df.sparkSession)
    names, arrays = df.columns, arrays or {}
    order = sorted(range(len(names)), key=lambda i: isinstance(arrays.get(names[i]), str))  # what counts comes first

    def run(batches):
        import os

        parts = list(batches)
        rows = sum(b.num_rows for b in parts)
        if not rows:
            return
        table = pa.Table.from_batches(parts).combine_chunks()
        if any(c.num_chunks != 1 for c in table.columns):
            raise ValueError("a partition's column is beyond 2 GB; write more partitions")
        f, counters = TreeFile("", method, per_basket), {}
        made = {i: add_column(f, tree, names[i], table.column(i).chunk(0), arrays.get(names[i]), counters, names[i] in multimaps) for i in order}
        f.tree(tree, [made[i] for i in range(len(names))], rows)
        name = f"part-{TaskContext.get().partitionId():05d}.root"
        if "://" in folder and not folder.startswith("file:"):
            import pyarrow.fs as fs

            store, at = fs.FileSystem.from_uri(folder)
            with store.open_output_stream(f"{at}/{name}") as out:
                out.write(f.bytes())
        else:
            local = folder.removeprefix("file://").removeprefix("file:")
            os.makedirs(local, exist_ok=True)
            with open(f"{local}/.{name}", "wb") as out:
                out.write(f.bytes())
            os.replace(f"{local}/.{name}", f"{local}/{name}")
        yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "entries": [rows]})

    made = df.mapInArrow(run, "path string, entries long").collect()
    return df.sparkSession.createDataFrame(made, "path string, entries long")
