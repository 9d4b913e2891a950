"""Small files and folders of the store that Spark reads, through its own client."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def filesystem(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    folder, store = filesystem(spark, path)
    return store.exists(folder)


def names(spark: SparkSession, path: str) -> list[str]:
    folder, store = filesystem(spark, path)
    if not store.exists(folder):
        return []
    return [status.getPath().getName() for status in store.listStatus(folder)]


def delete(spark: SparkSession, path: str) -> None:
    folder, store = filesystem(spark, path)
    store.delete(folder, True)


def ensure_folder(spark: SparkSession, path: str) -> None:
    folder, store = filesystem(spark, path)
    store.mkdirs(folder)


def read_text(spark: SparkSession, path: str) -> str:
    file, store = filesystem(spark, path)
    stream = store.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """A new small file, whole or not at all; false if the name is taken.

    Written under another name first, so that no reader meets a part of it.
    """
    target, store = filesystem(spark, path)
    if store.exists(target):
        return False
    draft, _ = filesystem(spark, f"{path}.{uuid.uuid4().hex}.draft")
    stream = store.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    return store.rename(draft, target)
