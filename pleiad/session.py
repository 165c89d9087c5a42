"""SparkSession with the settings that the engine's semantics rest on."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
}


def session(app: str = "pleiad", master: str | None = None, **settings: str) -> SparkSession:
    """A session; settings override SETTINGS, with __ for . in their names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    own = {k.replace("__", "."): v for k, v in settings.items()}
    return builder.config(map=SETTINGS | own).getOrCreate()


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors, once a context: their Python workers may not have it on their path."""
    sc = spark.sparkContext
    if getattr(sc, "_pleiad_shipped", False):
        return
    top = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="pleiad-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/pleiad_code.zip", "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(f"{folder}/pleiad_code.zip")
    sc._pleiad_shipped = True


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share, below spark.checkpoint.dir; gone when the driver's JVM ends.

    Where that is unset, and driver and executors are one machine, it is a temporary one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        made = tempfile.mkdtemp(prefix="pleiad-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        return made
    made = f"{shared}/pleiad-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(made)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(path)
    store.deleteOnExit(path)
    return made
