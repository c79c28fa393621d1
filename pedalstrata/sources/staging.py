"""Intermediate results on storage that every executor can reach, and their release."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders and databases made by this process and not yet released.
_FOLDERS: list[str] = []
_DATABASES: list[str] = []


def _base(spark: SparkSession) -> str:
    master = spark.conf.get("spark.master", "")
    one_machine = master == "local" or master.startswith("local[")
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not one_machine:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        return tempfile.mkdtemp(prefix="pedalstrata-")
    if not one_machine and not master.startswith("local-cluster") and base.startswith("file:"):
        raise RuntimeError(f"spark.checkpoint.dir is a folder of one machine: {base}")
    return base


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder name under the cluster's ``spark.checkpoint.dir``.

    Only a session inside one JVM gets a temporary folder if that setting is missing: on a
    cluster a machine-local folder would be lost with its executor, so a ``file:`` setting is
    refused there too.
    """
    path = f"{_base(spark).rstrip('/')}/pedalstrata/{uuid.uuid4().hex}"
    _FOLDERS.append(path)
    return path


def own_database(name: str) -> str:
    """Have ``release`` drop the database too."""
    _DATABASES.append(name)
    return name


def stage(df: DataFrame) -> DataFrame:
    """The same rows read back from a Parquet copy.

    The copy cuts the lineage: a later failure re-reads it instead of recomputing, and every
    reader sees the same rows in the same files. Unlike a checkpoint it stays columnar, so
    readers scan only the columns they use.
    """
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, on whatever file system it lies."""
    where, system = _system(spark, path)
    system.delete(where, True)


def is_file(spark: SparkSession, path: str) -> bool:
    where, system = _system(spark, path)
    return system.exists(where) and not system.getFileStatus(where).isDirectory()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    where, system = _system(spark, path)
    if not system.exists(where) or not system.getFileStatus(where).isDirectory():
        return []
    return [s.getPath().getName() for s in system.listStatus(where)]


def create_empty(spark: SparkSession, path: str) -> None:
    """A new empty file; an error if it is there already."""
    where, system = _system(spark, path)
    system.create(where, False).close()


def discard(df: DataFrame) -> None:
    """Delete the folders behind staged frames that no later result reads."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        owned = next((p for p in _FOLDERS if path.endswith(p.split(":", 1)[-1].lstrip("/"))), None)
        if owned:
            remove(df.sparkSession, owned)
            _FOLDERS.remove(owned)


def release(spark: SparkSession) -> None:
    """Delete every staged copy and drop every database of this process.

    Whoever starts a query calls this once its result is stored: the frames that a query
    returns read their staged copies until then.
    """
    while _DATABASES:
        spark.sql(f"DROP DATABASE IF EXISTS {_DATABASES.pop()} CASCADE")
    while _FOLDERS:
        remove(spark, _FOLDERS.pop())
