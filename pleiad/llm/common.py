"""Helpers shared by the training-data operators: tables, reliable checkpoints, byte-level text rules."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import ship

#: ASCII upper case to lower case, on UTF-8 bytes; other code points stay as they are.
LOWER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
#: bytes.split() without arguments cuts at exactly these bytes, the separators of a word.
WHITE = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Texts may be very long, so that Python workers get them in batches bounded by rows and by bytes."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one that the context has, or, on one machine, a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    now = spark.sparkContext._jsc.sc().getCheckpointDir()
    if now.isDefined():
        return now.get()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    made = tempfile.mkdtemp(prefix="pleiad-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder: cuts its lineage and survives the loss of executors."""
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    out = df.checkpoint()
    for made in _MADE:
        made.append(out)
    return out


#: Lists that note the checkpoints made meanwhile; see releasing().
_MADE: list[list[DataFrame]] = []


def release(*frames: DataFrame) -> None:
    """Removes the files of checkpointed frames that nothing reads any more; of one released before there is nothing left."""
    for df in frames:
        kept = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if kept.isDefined():
            remove(df.sparkSession, kept.get())


@contextmanager
def releasing() -> Iterator[None]:
    """Removes all checkpoints made within at the end: what is read afterwards must have been written elsewhere."""
    made: list[DataFrame] = []
    _MADE.append(made)
    try:
        yield
    finally:
        _MADE.remove(made)
        release(*made)


def utf8(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def words(text: bytes) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ of a text, A-Z in lower case."""
    return text.translate(LOWER).split()


def remove(spark: SparkSession, uri: str) -> None:
    """A folder of the shared store and all in it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
