"""Session settings and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (UTC, AQE, Arrow)."""
    builder = (
        SparkSession.builder.appName("concord")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for cut lineage, as the cluster names it.

    Only a local-mode session without the setting (tests) gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    path = tempfile.mkdtemp(prefix="concord-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path for files of this application in the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{scratch_dir(spark)}/concord/{app}/{label}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, so that its functions can be unpickled there."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="concord-package-")  # on the driver, which serves it
        context.addPyFile(shutil.make_archive(f"{folder}/concord", "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where several passes read the same rows: the upstream plan then runs once, a
    lost executor re-reads files instead of recomputing the lineage, and the optimizer
    knows the size, so it broadcasts a small frame and shuffles a large one.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)  # works in heap buffers, unlike snappy
    return df.sparkSession.read.schema(df.schema).parquet(path)
