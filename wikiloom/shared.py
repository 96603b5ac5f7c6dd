"""Tables and folders that all executors and the driver share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the session names none, a single machine (a ``local`` master, as in
    tests) gets a folder of its own; a cluster gets an error, since a
    machine-local folder would lose the rows of other machines.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    folder = tempfile.mkdtemp(prefix="wikiloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing uses yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df``, computed once and written to the shared folder; cuts the lineage."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def finished(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders below ``path`` whose write has finished; none if there is no such path."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = fs_path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = [status.getPath() for status in fs.listStatus(root)] if fs.exists(root) else []
    return sorted(folder.getName() for folder in folders if fs.exists(fs_path(folder, "_SUCCESS")))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores in front as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
