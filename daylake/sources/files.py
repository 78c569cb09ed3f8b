"""Small files and folders on any file system that Spark reads: the lake's own notes, not its data."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def names(spark: SparkSession, path: str) -> list[str]:
    """Names within a folder, sorted; none if it does not exist."""
    fs, folder = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def ages(spark: SparkSession, path: str) -> dict[str, float]:
    """Seconds since the last change of each name within a folder."""
    fs, folder = _fs(spark, path)
    now = spark.sparkContext._jvm.java.lang.System.currentTimeMillis()
    found = fs.listStatus(folder) if fs.exists(folder) else []
    return {s.getPath().getName(): (now - s.getModificationTime()) / 1000 for s in found}


def read_text(spark: SparkSession, path: str) -> str:
    fs, file = _fs(spark, path)
    stream = fs.open(file)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Write a whole file under a name that must be new; False if the name is taken.

    The text is written under a name of its own first and then renamed without overwriting, so that a reader
    sees all of it or nothing and one of several writers wins. This needs a file system with an atomic rename.
    """
    jvm = spark.sparkContext._jvm
    fs, target = _fs(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(target), options)
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if fs.exists(target):
            return False
        raise e
    return True


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder to a name that must be new; parents are made."""
    fs, old = _fs(spark, source)
    _, new = _fs(spark, target)
    fs.mkdirs(new.getParent())
    if fs.exists(new) or not fs.rename(old, new):
        raise FileExistsError(f"{source} was not renamed to {target}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder; one that is not there is no error."""
    fs, folder = _fs(spark, path)
    fs.delete(folder, True)


def remove_empty(spark: SparkSession, *paths: str) -> None:
    """Delete those folders, in order, that hold nothing."""
    for path in paths:
        fs, folder = _fs(spark, path)
        if fs.exists(folder) and not fs.listStatus(folder):
            fs.delete(folder, False)
