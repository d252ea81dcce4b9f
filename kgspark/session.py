"""Session defaults and durable lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, app: str = "kgspark") -> SparkSession:
    """A single-node session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("KGSPARK_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.parquet.datetimeRebaseModeInRead", "CORRECTED")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's checkpoint folder.

    A machine-local folder is accepted only on a local master, where the driver
    and the executors are one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # local-cluster has executors of their own
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_root()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="kgspark-")


#: Rows read at once of a table of wide rows.
FEW_ROWS = 64


def cut(df: DataFrame, name: str = "cut", codec: str = "snappy", wide: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Unlike a cached plan the written table survives lost executors, and unlike
    ``checkpoint()`` it is computed once, stays columnar and tells the optimizer
    its true size, so a broadcast is only chosen for what is known to be small. Long
    texts take less disk with ``codec="zstd"``.
    """
    spark = df.sparkSession
    path = cut_path(spark, name)
    groups = {"parquet.block.row.count.limit": FEW_ROWS} if wide else {}
    df.write.mode("overwrite").options(**groups).parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def cut_path(spark: SparkSession, name: str, inner: bool = True) -> str:
    """A new folder for an intermediate table, below the innermost ``scratch``, or outside of all."""
    return "/".join([_application_folder(spark), *(_INNER if inner else []), f"{name}-{uuid.uuid4().hex}"])


_INNER: list[str] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables cut inside are deleted at the end: whatever is made of them must have been written by then."""
    _INNER.append(f"scratch-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        _delete(spark, "/".join([_application_folder(spark), *_INNER]))
        _INNER.pop()


def _application_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/kgspark/{spark.sparkContext.applicationId}"


def drop_cuts(spark: SparkSession) -> None:
    """Delete this application's intermediate tables once its results are written."""
    _delete(spark, _application_folder(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
