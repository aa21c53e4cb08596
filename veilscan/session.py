"""Sessions, and making this package known to executors."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import weakref
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
#: Folders in use, and where written tables lie.
_folders: dict[str, str] = {}
_places: dict[int, str] = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the executors of a session once, so that Python functions there can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    name = os.path.join(tempfile.mkdtemp(prefix="veilscan-package-"), "veilscan_package.zip")
    with zipfile.ZipFile(name, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(p.relative_to(root.parent)))
    context.addPyFile(name)
    _shipped.add(context.applicationId)


def local_session(name: str = "veilscan", cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings that tests and the bench use."""
    settings = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.ui.enabled": "false", "spark.driver.memory": memory, "spark.ui.showConsoleProgress": "false", "spark.python.sql.dataFrameDebugging.enabled": "false"}
    spark = SparkSession.builder.master(f"local[{cores}]").appName(name).config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """This application's folder below spark.checkpoint.dir, which driver and executors share; it is removed when the application ends.

    Where the session names no such folder, a local session gets a temporary one; on a cluster that is an error, as a
    folder of one machine would be missing on the others.
    """
    context, key = spark.sparkContext, "spark.checkpoint.dir"
    base = spark.conf.get(key, None) or context.getConf().get(key) or _folders.get(context.applicationId)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError(f"{key} must name a folder that the driver and all executors share")
        base = _folders[context.applicationId] = tempfile.mkdtemp(prefix="veilscan-")
    folder = f"{base.rstrip('/')}/veilscan-{context.applicationId}"
    if folder not in _folders:
        _folders[folder] = folder
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        store.mkdirs(path)
        store.deleteOnExit(path)
    return folder


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt over as many tasks as the session has cores, and as its shuffles have.

    A file is split by its bytes and row groups, so small rows that take long come in a few tasks or one.  A number of
    partitions that is asked for isn't merged by the optimizer.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *keys)


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a table in the shared folder: cuts lineage, survives lost executors, and is computed once.

    What several branches of a plan use is not planned in each of them; the optimizer sees a scan.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _places[id(out)] = path
    weakref.finalize(out, _places.pop, id(out), None)
    return out


def dropped(df: DataFrame) -> None:
    """Remove what written() made of df before the application ends; nothing that is still to run may read it."""
    path = _places.pop(id(df), None)
    if path:
        there = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        there.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(there, True)
