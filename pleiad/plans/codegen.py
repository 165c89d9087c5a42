"""Source code and DDL for a schema."""

from __future__ import annotations

import keyword
from collections.abc import Callable

from pyspark.sql import Row
from pyspark.sql import types as T

#: Python annotations of Spark's atomic types; others are read as str.
ANNOTATIONS = {
    T.ByteType: "int",
    T.ShortType: "int",
    T.IntegerType: "int",
    T.LongType: "int",
    T.FloatType: "float",
    T.DoubleType: "float",
    T.DecimalType: "decimal.Decimal",
    T.StringType: "str",
    T.BinaryType: "bytes",
    T.BooleanType: "bool",
    T.DateType: "datetime.date",
    T.TimestampType: "datetime.datetime",
    T.TimestampNTZType: "datetime.datetime",
}


def identifier(name: str) -> str:
    """A field's name as a Python name."""
    out = "".join(c if c.isalnum() else "_" for c in name)
    return f"_{out}" if not out or out[0].isdigit() or keyword.iskeyword(out) else out


def dataclasses(schema: T.StructType, top: str = "Event") -> list[str]:
    """A dataclass for each record of the schema, nested ones (Record0, Record1, ...) before those that hold them."""
    out: list[str] = []
    count = iter(range(1 << 30))

    def annotation(kind: T.DataType) -> str:
        if isinstance(kind, T.StructType):
            name = f"Record{next(count)}"
            define(kind, name)
            return name
        if isinstance(kind, T.ArrayType):
            return f"list[{annotation(kind.elementType)}]"
        if isinstance(kind, T.MapType):
            return f"dict[{annotation(kind.keyType)}, {annotation(kind.valueType)}]"
        return ANNOTATIONS.get(type(kind), "str")

    def define(record: T.StructType, name: str) -> None:
        fields = [f"    {identifier(f.name)}: {annotation(f.dataType)}" for f in record.fields]
        out.append("\n".join(["@dataclass", f"class {name}:", *(fields or ["    pass"])]))

    define(schema, top)
    return out


def ddl(schema: T.StructType) -> str:
    """The schema as text that spark.read.schema() takes."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def classes(schema: T.StructType, top: str = "Event") -> dict[str, type]:
    """The dataclasses of a schema, made from their source."""
    import dataclasses as dc
    import datetime
    import decimal

    names = {"dataclass": dc.dataclass, "datetime": datetime, "decimal": decimal}
    exec("\n\n".join(dataclasses(schema, top)), names)  # noqa: S102  our own text, of identifiers alone
    return {k: v for k, v in names.items() if isinstance(v, type) and dc.is_dataclass(v)}


def typed(schema: T.StructType, top: str = "Event") -> Callable[[Row], object]:
    """A function from rows of the schema to objects of its dataclasses, for use in tasks or on what was collected."""
    made, count = classes(schema, top), iter(range(1 << 30))

    def of(kind: T.DataType) -> Callable:
        if isinstance(kind, T.StructType):
            return record(kind, f"Record{next(count)}")
        if isinstance(kind, T.ArrayType):
            item = of(kind.elementType)
            return lambda v: None if v is None else [item(x) for x in v]
        if isinstance(kind, T.MapType):
            key, item = of(kind.keyType), of(kind.valueType)
            return lambda v: None if v is None else {key(k): item(x) for k, x in v.items()}
        return lambda v: v

    def record(kind: T.StructType, name: str) -> Callable:
        members = [of(f.dataType) for f in kind.fields]
        return lambda v: None if v is None else made[name](*(m(x) for m, x in zip(members, v, strict=True)))

    return record(schema, top)
