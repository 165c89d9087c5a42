"""Spark data source "ttree": trees of keyed files as tables.

Python data sources get no column pruning from Catalyst, so a reader states what it needs: the option columns, or
read_trees(columns=[...]); both prune top columns and, within split records, members. Options:

tree        name of the tree; the first one found, depth first, without it
columns     comma-separated columns (a.b for a member)
suffix      names of files that count within folders, searched at any depth; .root without it
entries     entries a partition at least; a partition is a whole file without it
ignorecorrupt  on: files that can't be read give no rows (the one for the schema must be readable)
storage.x   argument x of the paths' store (for Hadoop a key of its configuration), on the driver and in tasks
pushdown    on: comparisons of top columns of numbers decide which batches are read further; set by read_trees() where the
            session has spark.sql.python.filterPushdown.enabled
and the passes of pleiad.plans.passes by name, on or off.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from ..plans import passes
from ..plans.layout import Root, column_name
from ..session import ship
from .binary import BadFile, store_of
from .tree import NoTree, Tree

NAME = "ttree"


def files_of(paths: list[str], suffix: str = ".root", settings: dict[str, str] | None = None) -> list[str]:
    """Files as they are given, and those with the suffix at any depth of folders, in order of names."""
    out = []
    for path in paths:
        if "://" in path and not path.startswith("file:"):
            import pyarrow.fs as fs

            store, at = store_of(path, settings)
            if store.get_file_info(at).type == fs.FileType.Directory:
                found = [x.path for x in store.get_file_info(fs.FileSelector(at, recursive=True)) if x.is_file and x.path.endswith(suffix)]
                head = path[: len(path) - len(at)] if path.endswith(at) else path.split("://")[0] + "://"
                out += sorted(head + f for f in found)
            else:
                out.append(path)
            continue
        local = path.removeprefix("file://").removeprefix("file:")
        if os.path.isdir(local):
            out += sorted(os.path.join(d, f) for d, _, names in os.walk(local) for f in names if f.endswith(suffix))
        else:
            out.append(local)
    return out


def storage(options: dict[str, str]) -> dict[str, str]:
    """The settings of the paths' store among the options."""
    return {k.removeprefix("storage."): v for k, v in options.items() if k.startswith("storage.")}


def wanted(schema: T.StructType, columns: list[str]) -> T.StructType:
    """The part of a schema that dotted column names reach, also through arrays; names as stored or as columns."""
    picked: dict[str, list[str]] = {}
    for c in columns:
        head, _, rest = c.strip().partition(".")
        if column_name(c.strip()) in schema.names:
            head, rest = column_name(c.strip()), ""
        head = column_name(head)
        if head not in schema.names:
            raise ValueError(f"no column {head}; there are {', '.join(schema.names)}")
        picked.setdefault(head, []).append(rest)

    def inner(kind: T.DataType, rest: list[str]) -> T.DataType:
        if "" in rest:
            return kind
        if isinstance(kind, T.ArrayType):
            return T.ArrayType(inner(kind.elementType, rest), kind.containsNull)
        if isinstance(kind, T.StructType):
            return wanted(kind, rest)
        raise ValueError(f"{rest[0]} is not within {kind.simpleString()}")

    return T.StructType([T.StructField(h, inner(schema[h].dataType, r)) for h, r in picked.items()])


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int


class TreeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def given(self) -> dict[str, str]:
        return {k.lower(): v for k, v in self.options.items()}

    def files(self) -> list[str]:
        o = self.given()
        if o.get("files"):  # listed by read_trees()
            found = json.loads(o["files"])
        else:
            found = files_of([o["path"]] if o.get("path") else [], o.get("suffix", ".root"), storage(o))
        if not found:
            raise ValueError("a path to files must be given")
        return found

    def schema(self) -> T.StructType:
        o = self.given()
        with Tree(self.files()[0], o.get("tree"), storage(o)) as t:
            full = t.layout(o).spark_type()
        return wanted(full, o["columns"].split(",")) if o.get("columns") else full

    def reader(self, schema: T.StructType) -> TreeReader:
        kind = FilteringReader if passes.switched(self.given(), "pushdown", False) else TreeReader
        return kind(self.files(), self.given(), schema)


class TreeReader(DataSourceReader):
    def __init__(self, files: list[str], options: dict[str, str], schema: T.StructType):
        self.files, self.options, self.required = files, options, schema

    @property
    def forgiving(self) -> bool:
        return passes.switched(self.options, "ignorecorrupt", False)

    def partitions(self) -> list[Range]:
        least = self.options.get("entries")
        if not least:
            return [Range(f, 0, -1) for f in self.files]
        if self.options.get("ranges"):  # planned by read_trees() in a job
            return [Range(*r) for r in json.loads(self.options["ranges"])]
        with ThreadPoolExecutor(16) as pool:  # headers are small: what takes time is to reach them
            return [Range(f, a, b) for f, found in zip(self.files, pool.map(lambda f: ranges_of(f, self.options), self.files), strict=True) for a, b in found]

    def read(self, partition: Range) -> Iterator:
        try:
            tree = Tree(partition.path, self.options.get("tree"), storage(self.options))
        except (BadFile, NoTree, OSError):
            if self.forgiving:
                return
            raise
        with tree:
            root: Root = passes.prune(tree.layout(self.options), self.required, self.options)
            end = tree.entries if partition.end < 0 else partition.end
            yield from tree.batches(root, partition.start, end, may_hold=self.may_hold, by=tuple(f.attribute[0] for f in self.filters))

    filters: tuple = ()

    def may_hold(self, batch: pa.RecordBatch) -> np.ndarray:
        """Entries that no filter rules out; NaN is left to the engine, which sorts it behind all numbers."""
        hit = np.ones(batch.num_rows, bool)
        for f in self.filters:
            x = batch.column(batch.schema.get_field_index(f.attribute[0])).to_numpy(zero_copy_only=False)
            own = np.isin(x, list(f.value)) if isinstance(f, In) else COMPARISONS[type(f)](x, f.value)
            hit &= own | (x != x)
        return hit


COMPARISONS = {EqualTo: np.equal, GreaterThan: np.greater, GreaterThanOrEqual: np.greater_equal, LessThan: np.less, LessThanOrEqual: np.less_equal, In: np.isin}


class FilteringReader(TreeReader):
    """Reads the columns of pushed comparisons first, and the others of batches alone where an entry may pass."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        number = lambda v: isinstance(v, (int, float)) and not isinstance(v, bool) and v == v
        own = []
        for f in filters:
            if type(f) in COMPARISONS and len(f.attribute) == 1 and isinstance(self.required[f.attribute[0]].dataType, T.NumericType) and all(map(number, f.value if isinstance(f, In) else [f.value])):
                own.append(f)
            yield f  # the engine applies all of them again
        self.filters = tuple(own)


def ranges_of(path: str, options: dict[str, str]) -> list[tuple[int, int]]:
    """Entry ranges of a file by its header; none of one that can't be read, if options forgive that."""
    try:
        with Tree(path, options.get("tree"), storage(options)) as t:
            return t.ranges(int(options["entries"]))
    except (BadFile, NoTree, OSError):
        if passes.switched(options, "ignorecorrupt", False):
            return []
        raise


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(TreeSource)


def by_file(spark: SparkSession, files: list[str], told: Callable[[str], list[tuple]], schema: str) -> DataFrame:
    """told(path) -> rows of schema, for each of the files, in a job over their list."""
    ship(spark)
    names = [t.split()[0] for t in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [r for path in b.column(0).to_pylist() for r in told(path)]
            if rows:
                yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows, strict=True), strict=True)))

    tasks = max(1, min(len(files), 4 * spark.sparkContext.defaultParallelism))
    listed = spark.createDataFrame([(i, f) for i, f in enumerate(files)], "i long, path string")
    return listed.repartitionByRange(tasks, "i").select("path").mapInArrow(run, schema)


def read_trees(spark: SparkSession, *paths: str, columns: list[str] | None = None, **options: str) -> DataFrame:
    """All files of the paths as one table; only the named columns are read from them.

    Files are listed once; with entries= their ranges are planned by a job over that list.
    """
    register(spark)
    given = {k.lower(): v for k, v in options.items()}
    files = files_of(list(paths), given.get("suffix", ".root"), storage(given))
    reader = spark.read.format(NAME).option("files", json.dumps(files))
    if columns:
        reader = reader.option("columns", ",".join(columns))
    if spark.conf.get("spark.sql.python.filterPushdown.enabled", "false") == "true":
        reader = reader.option("pushdown", "on")
    if given.get("entries"):
        found = by_file(spark, files, lambda f: [(f, a, b) for a, b in ranges_of(f, given)], "path string, start long, end long")
        reader = reader.option("ranges", json.dumps([tuple(r) for r in found.collect()]))
    return reader.options(**options).load()


def entry_counts(spark: SparkSession, *paths: str, **options: str) -> DataFrame:
    """path, entries of each file, from headers alone: no basket is read. Options as read_trees() has them."""
    given = {k.lower(): v for k, v in options.items()}

    def told(path: str) -> list[tuple]:
        try:
            with Tree(path, given.get("tree"), storage(given)) as t:
                return [(path, t.entries)]
        except (BadFile, NoTree, OSError):
            if passes.switched(given, "ignorecorrupt", False):
                return []
            raise

    return by_file(spark, files_of(list(paths), given.get("suffix", ".root"), storage(given)), told, "path string, entries long")


def entry_count(spark: SparkSession, *paths: str, **options: str) -> int:
    """Entries of all trees, from their headers alone, counted by a job over the files."""
    return entry_counts(spark, *paths, **options).agg({"entries": "sum"}).first()[0] or 0
