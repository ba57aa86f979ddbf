"""Session helpers: a local session for tests and bench, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Folders handed out by this process and not removed yet.
_folders: list[str] = []


def local_session(cpus: int | str = 8, memory: str = "20g", **settings: str) -> SparkSession:
    """A single-machine session. A cluster job brings its own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallymill")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder path for written tables that every executor can reach.

    The parent is ``spark.checkpoint.dir``. Only a local session may go without
    that setting: one machine runs all its tasks, so a temporary folder is shared. Folders stay until
    :func:`remove_written` is called, because tables are read from them when results are asked for.
    """
    parent = spark.conf.get("spark.checkpoint.dir", None)
    if not parent:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        parent = tempfile.mkdtemp(prefix="tallymill-")
    path = f"{parent.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _folders.append(path)
    return path


def written_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a shared folder and read it from there.

    Later passes start from the files, so neither they nor the loss of an executor
    brings back the work before.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate files that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def remove_written(spark: SparkSession) -> None:
    """Remove all folders handed out so far; only for a caller that has no more use for any result built on them."""
    while _folders:
        remove_folder(spark, _folders.pop())
