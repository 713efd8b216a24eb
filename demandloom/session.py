"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str = "8", app: str = "demandloom") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own; on a cluster a missing
    setting is an error, because a machine-local folder would die with its executor.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if folder is None and current is not None:
        folder = os.path.dirname(current)
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="demandloom-")
    if current is None:
        sc.setCheckpointDir(folder)
    return folder


# Paths made within the innermost ``scratch_scope``.
_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for one intermediate table in the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Remove the intermediate tables made inside, once the work that reads them has been written elsewhere."""
    _scopes.append([])
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _scopes.pop():
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(hadoop).delete(place, True)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession):
    """Shuffle files of the queries inside go at their end, not at some later garbage collection. No query inside may run twice from the
    same DataFrame's plan or read a cached one; those made of a DataFrame that was shuffled before are planned anew and are safe."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a table in the shared folder and forget its lineage.

    Executors can be lost without recomputing anything before this point. Unlike a
    checkpoint the rows are computed once, stay columnar, and tell the optimizer their
    true size, so a small result is broadcast and a large one is not.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
