"""Small files through Hadoop's file systems: whatever store Spark reads, the driver can."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    store, target = _at(spark, folder)
    return sorted(s.getPath().getName() for s in store.listStatus(target)) if store.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    store, target = _at(spark, path)
    stream = store.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """The whole file or none of it under ``path``, which must be new: it is written aside and renamed."""
    store, target = _at(spark, path)
    aside = target.suffix(".writing")
    stream = store.create(aside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if store.exists(target) or not store.rename(aside, target):
        store.delete(aside, False)
        raise FileExistsError(f"{path} was published by another writer")


def delete(spark: SparkSession, path: str) -> None:
    store, target = _at(spark, path)
    store.delete(target, True)
