"""Session helpers: the shared work folder and lineage cutting."""

from __future__ import annotations

import os
import time
import uuid
from typing import Any, NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Whether Spark deletes a query's shuffle files when the query ends.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(app_name: str = "headwater", cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", os.environ.get("HEADWATER_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor sees: ``spark.checkpoint.dir``, else one below the warehouse.

    What is written there is named by :func:`work_path` and needed only until the
    results that read it are written; the folder ``headwater`` in it can be removed
    when no job runs.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return folder.rstrip("/")


def work_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/headwater/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used between the rounds of iterative operators: the next round starts from
    files, which outlive any executor.
    """
    return cut_at(df, work_path(df.sparkSession, "round"))


def cut_at(df: DataFrame, path: str) -> DataFrame:
    """The same at a path of the caller's, who may delete it once nothing reads it any more.

    The shuffle files of the write are deleted with its end; else they would stay until the driver collects its garbage,
    and those of all rounds would lie on the disks together.
    """
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLES_GO, "false")
    conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path, compression="zstd")
    finally:
        conf.set(SHUFFLES_GO, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Child(NamedTuple):
    """What a folder holds."""

    name: str
    is_folder: bool
    modified_ms: int


def _file_system(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """Spark's own client of the store that a path is in, and the path for it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def children(spark: SparkSession, path: str) -> list[Child]:
    """The files and folders directly below a folder, by name; none if it isn't there."""
    store, where = _file_system(spark, path)
    if not store.exists(where):
        return []
    return sorted(
        Child(found.getPath().getName(), found.isDirectory(), found.getModificationTime()) for found in store.listStatus(where)
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    store, where = _file_system(spark, path)
    return store.exists(where)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a file, or a folder with all that it holds; false if it isn't there."""
    store, where = _file_system(spark, path)
    return store.delete(where, True)


def claim_path(spark: SparkSession, path: str, content: str) -> bool:
    """Create a short file; false if it is there already. Of several callers one succeeds.

    It rests on the store's exclusive create, which HDFS and the file systems of object stores with
    conditional writes have.
    """
    store, where = _file_system(spark, path)
    try:
        out = store.create(where, False)
    except Py4JJavaError:
        if store.exists(where):
            return False
        raise
    out.writeUTF(content)
    out.close()
    return True


def read_claim(spark: SparkSession, path: str) -> str | None:
    """The content of a claimed file; none if it is not complete yet."""
    store, where = _file_system(spark, path)
    stream = store.open(where)
    try:
        return stream.readUTF()
    except Py4JJavaError:
        return None
    finally:
        stream.close()


def clear_work(spark: SparkSession, older_than_hours: float = 24.0) -> int:
    """Delete work folders that were last written so long ago; returns how many.

    For a schedule of its own: results that still read such a folder must be written by then.
    """
    base, limit = f"{shared_dir(spark)}/headwater", (time.time() - 3600 * older_than_hours) * 1000
    old = [child for child in children(spark, base) if child.modified_ms < limit]
    return sum(delete_path(spark, f"{base}/{child.name}") for child in old)
