"""Event tables with nested collections, read with only the columns a query names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_events(spark: SparkSession, *paths: str, columns: list[str] | None = None, recursive: bool = True, suffix: str | None = None, kind: str = "parquet", schema: T.StructType | str | None = None) -> DataFrame:
    """One table of all files under the paths whose names fit; columns may reach into structs, also within arrays.

    kind: parquet, orc, json or csv; the last two need a schema, or read a file more to infer one. A path that is given
    twice is read twice, which Spark's own file index would not do.
    """
    reader = spark.read.format(kind).option("recursiveFileLookup", recursive).option("pathGlobFilter", suffix or f"*.{kind}")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(list(dict.fromkeys(paths)))
    for path in (p for i, p in enumerate(paths) if p in paths[:i]):
        df = df.unionByName(reader.load(path))
    return df.select(*columns) if columns else df


def writable(df: DataFrame) -> DataFrame:
    """df without what Parquet can't store: columns and members of no type or without members, at any depth."""

    def kept(kind: T.DataType) -> T.DataType | None:
        if isinstance(kind, T.StructType):
            fields = [T.StructField(f.name, k, f.nullable) for f in kind.fields if (k := kept(f.dataType)) is not None]
            return T.StructType(fields) if fields else None
        if isinstance(kind, T.ArrayType):
            item = kept(kind.elementType)
            return item and T.ArrayType(item, kind.containsNull)
        if isinstance(kind, T.MapType):
            both = kept(kind.keyType), kept(kind.valueType)
            return T.MapType(*both) if all(both) else None
        return None if isinstance(kind, T.NullType) else kind

    def project(x: Column, kind: T.DataType, to: T.DataType) -> Column:
        if kind == to:
            return x
        if isinstance(to, T.StructType):
            return F.when(x.isNotNull(), F.struct(*(project(x[f.name], kind[f.name].dataType, f.dataType).alias(f.name) for f in to.fields)))
        if isinstance(to, T.ArrayType):
            return F.transform(x, lambda e: project(e, kind.elementType, to.elementType))
        return F.transform_values(x, lambda _, v: project(v, kind.valueType, to.valueType))

    columns = [(f, kept(f.dataType)) for f in df.schema.fields]
    return df.select(*(project(F.col(f"`{f.name}`"), f.dataType, k).alias(f.name) for f, k in columns if k is not None))


def write_events(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "errorifexists", kind: str = "parquet") -> None:
    """Event tables as Parquet (or orc, json, csv), with Hive partitions if asked for."""
    writer = writable(df).write.mode(mode).format(kind)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def order_events(spark: SparkSession, folder: str) -> DataFrame:
    """event_id, muons: an order as an event and its line items as particles."""
    item = F.struct(
        (F.col("l_extendedprice") / 1000).alias("pt_"),
        ((F.col("l_discount") - 0.05) * 40).alias("eta_"),
        (F.col("l_quantity") * 0.1).alias("phi_"),
        "l_linenumber",
        "l_partkey",
    )
    return table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("event_id")).agg(F.collect_list(item).alias("muons"))
