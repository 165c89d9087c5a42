"""Files of keyed, self-describing objects: keys, compression, class descriptions and objects read by them."""

from __future__ import annotations

import lzma
import struct
import zlib
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from ..plans.synthesis import Klass, Member

COUNTED, NEW_CLASS, CLASS, OFFSET = 0x40000000, 0xFFFFFFFF, 0x80000000, 2
#: Codes and struct formats of basic members.
FORMATS = {1: "b", 2: "h", 3: "i", 4: "q", 5: "f", 6: "i", 8: "d", 9: "f", 10: "b", 11: "B", 12: "H", 13: "I", 14: "Q", 15: "I", 16: "q", 17: "Q", 18: "?"}


class BadFile(ValueError):
    pass


#: File systems by scheme; others are left to the address alone.
STORES = {"s3": "S3FileSystem", "gs": "GcsFileSystem", "gcs": "GcsFileSystem", "hdfs": "HadoopFileSystem", "viewfs": "HadoopFileSystem", "abfs": "AzureFileSystem", "abfss": "AzureFileSystem", "file": "LocalFileSystem"}


def store_of(uri: str, settings: dict[str, str] | None = None):
    """(file system, path in it) of an address; settings are arguments of the scheme's file system, for Hadoop its own keys."""
    import pyarrow.fs as fs

    if not settings:
        return fs.FileSystem.from_uri(uri)
    scheme, _, rest = uri.partition("://")
    host, _, path = rest.partition("/")
    kind = getattr(fs, STORES[scheme])
    if STORES[scheme] == "HadoopFileSystem":
        name, _, port = host.partition(":")
        given = {k: v for k, v in settings.items() if k in ("user", "kerb_ticket")}
        extra = {k: v for k, v in settings.items() if k not in given}
        return kind(f"{scheme}://{name}" if name else "default", int(port or 0), extra_conf=extra, **given), f"/{path}"
    plain = {"true": True, "false": False}
    store = kind(**{k: plain.get(v.lower(), v) for k, v in settings.items()})
    return store, f"/{path}" if scheme == "file" else f"{host}/{path}"


def opened(path: str, settings: dict[str, str] | None = None):
    """A random-access file of a local path or of a store that pyarrow knows."""
    if "://" in path or path.startswith("file:"):
        store, at = store_of(path, settings)
        return store.open_input_file(at)
    return open(path, "rb")


@dataclass
class Cursor:
    """Big-endian values of a buffer; origin is what positions in stored references are larger by."""

    data: bytes
    at: int = 0
    origin: int = 0
    seen: dict = field(default_factory=dict)

    def take(self, fmt: str):
        values = struct.unpack_from(f">{fmt}", self.data, self.at)
        self.at += struct.calcsize(f">{fmt}")
        return values[0] if len(values) == 1 else values

    def bytes(self, n: int) -> bytes:
        out = self.data[self.at : self.at + n]
        self.at += n
        return out

    def text(self) -> str:
        n = self.take("B")
        return self.bytes(self.take("I") if n == 255 else n).decode("utf-8", "replace")

    def zero_ended(self) -> str:
        end = self.data.index(b"\0", self.at)
        out = self.bytes(end - self.at).decode()
        self.at += 1
        return out

    def version(self) -> tuple[int, int | None]:
        """(version, where the object ends if that is stored)."""
        start, n = self.at, self.take("I")
        if n & COUNTED:
            return self.take("H"), start + 4 + (n & ~COUNTED)
        self.at = start
        return self.take("H"), None


def inflated(data: bytes, size: int) -> bytes:
    """Blocks of a method, their lengths and the packed bytes, up to size."""
    out, at = [], 0
    while size > 0:
        method, packed, plain = data[at : at + 2], int.from_bytes(data[at + 3 : at + 6], "little"), int.from_bytes(data[at + 6 : at + 9], "little")
        block = data[at + 9 : at + 9 + packed]
        if method == b"ZL":
            block = zlib.decompress(block)
        elif method == b"XZ":
            block = lzma.decompress(block)
        elif method == b"L4":  # behind a checksum
            block = pa.Codec("lz4_raw").decompress(block[8:], plain).to_pybytes()
        elif method == b"ZS":
            import zstandard

            block = zstandard.ZstdDecompressor().decompress(block, plain)
        else:
            raise BadFile(f"unknown compression {method!r}")
        if len(block) != plain:
            raise BadFile("a packed block has another length than stated")
        out.append(block)
        at += 9 + packed
        size -= plain
    return b"".join(out)


@dataclass
class Key:
    size: int
    plain: int
    head: int
    cycle: int
    seek: int
    class_name: str
    name: str
    title: str

    @classmethod
    def read(cls, c: Cursor) -> Key:
        size, version, plain, _, head, cycle = c.take("ihiIhh")
        seek, _ = c.take("qq" if version > 1000 else "ii")
        return cls(size, plain, head, cycle, seek, c.text(), c.text(), c.text())


class KeyedFile:
    """An open file: its directory of keys and the classes that it describes."""

    def __init__(self, path: str, settings: dict[str, str] | None = None):
        self.file = opened(path, settings)
        try:
            head = self.at(0, 100)
            if head[:4] != b"root":
                raise BadFile(f"{path} does not begin as such a file does")
            version, begin = struct.unpack_from(">ii", head, 4)
            large = version >= 1_000_000
            _, _, _, _, name_bytes, _, _, info, _ = struct.unpack_from(">qqiiiBiqi" if large else ">iiiiiBiii", head, 12)
            c = Cursor(self.at(begin + name_bytes, 64))
            v, _, _, _, _ = c.take("hIIii")
            _, _, self.keys_at = c.take("qqq" if v > 1000 else "iii")
            self.classes: dict[tuple[str, int], list[dict]] = {}
            self.latest: dict[str, list[dict]] = {}
            if info:
                self.describe(self.object_cursor(self.key_at(info)))
        except (struct.error, IndexError, zlib.error, lzma.LZMAError) as e:
            self.close()
            raise BadFile(f"{path}: {e}") from e
        except BaseException:
            self.close()
            raise

    def close(self) -> None:
        self.file.close()

    def __enter__(self) -> KeyedFile:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    def at(self, seek: int, n: int) -> bytes:
        self.file.seek(seek)
        return self.file.read(n)

    def key_at(self, seek: int) -> Key:
        return Key.read(Cursor(self.at(seek, 2048)))

    def directory(self, seek: int | None = None) -> list[Key]:
        seek = self.keys_at if seek is None else seek
        own = self.key_at(seek)
        c = Cursor(self.at(seek + own.head, own.size - own.head))
        return [Key.read(c) for _ in range(c.take("i"))]

    def payload(self, key: Key) -> bytes:
        raw = self.at(key.seek + key.head, key.size - key.head)
        return raw if len(raw) == key.plain else inflated(raw, key.plain)

    def object_cursor(self, key: Key) -> Cursor:
        return Cursor(self.payload(key), 0, key.head)

    def find(self, class_name: str, name: str | None = None) -> Key | None:
        """The first key of that class, and name if given, depth first through the directories."""

        def walk(seek: int | None) -> Key | None:
            for key in self.directory(seek):
                if key.class_name in ("TDirectory", "TDirectoryFile"):
                    c = self.object_cursor(key)
                    v, _, _, _, _ = c.take("hIIii")
                    _, _, inner = c.take("qqq" if v > 1000 else "iii")
                    if found := walk(inner):
                        return found
                elif key.class_name == class_name and name in (None, key.name):
                    return key
            return None

        return walk(None)

    # class descriptions -----------------------------------------------------------------------------------------------------

    def describe(self, c: Cursor) -> None:
        for info in self.special["TList"](c):
            if isinstance(info, dict) and "members" in info:
                self.classes[info["name"], info["version"]] = info["members"]
                self.latest[info["name"]] = info["members"]

    def descriptions(self) -> list[Klass]:
        return [Klass(name, tuple(Member(m["name"], m["code"], m["type"], m["dims"], m["stl"], m["item"]) for m in members)) for (name, _), members in self.classes.items()]

    # objects ------------------------------------------------------------------------------------------------------------------

    def value(self, c: Cursor, name: str):
        if name in self.special:
            return self.special[name](c)
        version, end = c.version()
        members = self.classes.get((name, version)) or self.latest.get(name)
        if members is None:
            if end is None:
                raise BadFile(f"{name} is not described")
            c.at = end
            return None
        out: dict = {"class": name}
        for m in members:
            self.member(c, m, out)
        if end is not None:
            c.at = end
        return out

    def member(self, c: Cursor, m: dict, out: dict) -> None:
        code, name = m["code"], m["name"]
        if code == 0 or (code in (66, 67) and m["type"] == "BASE"):
            inner = self.value(c, name)
            out.update({k: v for k, v in inner.items() if k != "class"} if isinstance(inner, dict) else {})
        elif code in FORMATS:
            out[name] = c.take(FORMATS[code])
        elif code - 20 in FORMATS:
            out[name] = [c.take(FORMATS[code - 20]) for _ in range(m["length"])]
        elif code - 40 in FORMATS:
            there = c.take("B")
            out[name] = [c.take(FORMATS[code - 40]) for _ in range(out[m["counter"]])] if there else []
        elif code == 65:
            out[name] = c.text()
        elif code in (61, 62, 63, 66, 67, 68):
            out[name] = self.value(c, m["type"].rstrip("*"))
        elif code in (64, 69):
            out[name] = self.pointer(c)
        else:
            _, end = c.version()
            if end is None:
                raise BadFile(f"member {name} of kind {code} can't be passed over")
            c.at, out[name] = end, None

    def pointer(self, c: Cursor):
        """An object behind a pointer: none, one met before, or a new one after its class or a reference to that."""
        begin, tag, end, tag_at = c.at, c.take("I"), None, 0
        if tag & COUNTED and tag != NEW_CLASS:
            end, tag_at, tag = begin + 4 + (tag & ~COUNTED), c.at, c.take("I")
        if not tag & CLASS:
            return c.seen.get(tag) if tag else None
        if tag == NEW_CLASS:
            name = c.zero_ended()
            c.seen[tag_at + c.origin + OFFSET] = name
        else:
            name = c.seen[tag & ~CLASS]
        holder: dict = {}
        c.seen[begin + c.origin + OFFSET] = holder
        try:
            out = self.value(c, name)
        except BadFile:
            if end is None:
                raise
            out = None
        if isinstance(out, dict):
            holder.update(out)
            out = holder
        if end is not None:
            c.at = end
        return out

    # classes that are read by rules of their own --------------------------------------------------------------------------------

    @property
    def special(self) -> dict[str, Callable]:
        return {"TObject": self._object, "TString": Cursor.text, "TNamed": self._named, "TList": self._list, "THashList": self._list, "TObjArray": self._array, "TStreamerInfo": self._info, "TArrayD": lambda c: [c.take("d") for _ in range(c.take("i"))], "TArrayI": lambda c: [c.take("i") for _ in range(c.take("i"))], **dict.fromkeys(("TStreamerBase", "TStreamerBasicType", "TStreamerBasicPointer", "TStreamerLoop", "TStreamerObject", "TStreamerObjectPointer", "TStreamerObjectAny", "TStreamerObjectAnyPointer", "TStreamerString", "TStreamerSTL", "TStreamerArtificial"), self._element), "TStreamerSTLstring": self._wrapped, "TBasket": self._basket}

    def _object(self, c: Cursor) -> dict:
        c.take("H")
        _, bits = c.take("II")
        if bits & (1 << 4):
            c.take("H")
        return {}

    def _named(self, c: Cursor) -> dict:
        _, end = c.version()
        self._object(c)
        out = {"fName": c.text(), "fTitle": c.text()}
        if end is not None:
            c.at = end
        return out

    def _list(self, c: Cursor) -> list:
        _, end = c.version()
        self._object(c)
        c.text()
        out = []
        for _ in range(c.take("i")):
            out.append(self.pointer(c))
            c.bytes(c.take("B"))
        if end is not None:
            c.at = end
        return out

    def _array(self, c: Cursor) -> list:
        _, end = c.version()
        self._object(c)
        c.text()
        n, _ = c.take("ii")
        out = [self.pointer(c) for _ in range(n)]
        if end is not None:
            c.at = end
        return out

    def _info(self, c: Cursor) -> dict:
        _, end = c.version()
        name = self._named(c)["fName"]
        _, version = c.take("Ii")
        members = self.pointer(c)
        if end is not None:
            c.at = end
        return {"name": name, "version": version, "members": [m for m in members if m]}

    def _element(self, c: Cursor) -> dict:
        _, end = c.version()
        _, base_end = c.version()
        name = self._named(c)["fName"]
        code, _, length, dim = c.take("iiii")
        dims = c.take("5i")
        out = {"name": name, "code": code, "length": length, "dims": tuple(dims[:dim]), "type": c.text(), "counter": "", "stl": 0, "item": 0}
        if base_end is not None:
            c.at = base_end
        if 40 < code < 60 or code == 501:
            c.take("i")
            out["counter"] = c.text()
        elif code in (300, 365, 500) and end is not None and end - c.at >= 8:
            out["stl"], out["item"] = c.take("ii")
            out["code"] = 500
        if end is not None:
            c.at = end
        return out

    def _basket(self, c: Cursor) -> dict:
        """A basket that the writer left within its branch: its key, sizes, the entries' places if it has them, and its bytes.

        Places and the end count from the beginning of the key, which the bytes repeat.
        """
        key = Key.read(c)
        c.take("H")
        _, room = c.take("ii")
        if room < 0:  # marks of the writer stand behind it
            c.version()
            c.take("B")
        n, last, flag = c.take("iiB")
        if flag >= 80:
            raise BadFile(f"the basket of {key.name} leaves the places of its entries to be made up")
        offsets = None
        if flag and flag % 10 != 2 and n:
            offsets = [c.take("i") & (0xFFFFFF if 20 < flag < 40 else -1) for _ in range(c.take("i"))]
            if flag > 40:
                c.bytes(4 * c.take("i"))
        data = c.bytes(last)[key.head :] if flag == 1 or flag > 10 else b""
        places = None if offsets is None else np.append(np.array(offsets[:n], np.int64) - key.head, len(data))
        return {"class": "TBasket", "entries": n if data or not last else 0, "data": data, "offsets": places}

    def _wrapped(self, c: Cursor) -> dict:
        _, end = c.version()
        out = self._element(c)
        if end is not None:
            c.at = end
        return out
