"""Session settings and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_scope = threading.local()


def build_session(app: str = "quillon", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; ``conf`` overrides single settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python this package, for functions that run there.

    Not needed where it is installed on every node; sent once per application.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    folder = tempfile.mkdtemp(prefix="package-")
    package = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(
        f"{folder}/quillon_package", "zip", os.path.dirname(package), os.path.basename(package)
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="quillon-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if getattr(_scope, "paths", None) is not None:
        _scope.paths.append(path)
    return path


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a path that ``scratch_path`` gave out."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that are not in use any more.

    It does so when the driver's garbage is collected, for which a loop of shuffles may be
    over before there is any need.
    """
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, the paths that ``scratch_path`` gave out within.

    For a caller who has written or collected its results by then, such as a
    micro-batch; nothing read from those paths may be used afterwards.
    """
    outer, _scope.paths = getattr(_scope, "paths", None), []
    try:
        yield
    finally:
        given, _scope.paths = _scope.paths, outer
        for path in given:
            remove_scratch(spark, path)


def use_checkpoints(spark: SparkSession) -> None:
    """Make the shared folder the one for checkpoints, if none is set yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and cut from its lineage by a reliable checkpoint.

    For small results that a plan reads more than once, such as topic words.
    """
    use_checkpoints(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as parquet below the shared folder and read back.

    The choice for results that grow with the corpus: columnar, compressed, and
    later reads take only the columns and row groups they need.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
