"""Small files and folders of any file system that Spark reads."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, sorted; nothing if there is no such folder."""
    path, system = _at(spark, folder)
    if not system.exists(path):
        return []
    return sorted(f.getPath().getName() for f in system.listStatus(path))


def details(spark: SparkSession, folder: str) -> list[tuple[str, int, int]]:
    """Name, size and time of change, in milliseconds, of each file in a folder."""
    path, system = _at(spark, folder)
    listed = [f for f in system.listStatus(path) if f.isFile()]
    return sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in listed)


def read_text(spark: SparkSession, file: str) -> str:
    path, system = _at(spark, file)
    stream = system.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_new(spark: SparkSession, file: str, text: str) -> bool:
    """Write a file that appears at once and whole; false if there is one already."""
    path, system = _at(spark, file)
    aside, _ = _at(spark, f"{file}.{uuid.uuid4().hex}.part")
    stream = system.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), _conf(spark))
    no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(context.makeQualified(aside), context.makeQualified(path), no_options)
    except Py4JJavaError as error:
        system.delete(aside, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all it holds."""
    target, system = _at(spark, path)
    system.delete(target, True)


def _conf(spark: SparkSession):
    return spark._jsc.hadoopConfiguration()


def _at(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(_conf(spark))
