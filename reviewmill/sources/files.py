"""Small files and folders on whatever file system a path lies on, through Hadoop's interface."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from py4j.protocol import Py4JJavaError


def _at(spark: SparkSession, path: str):
    """The file system and the path on it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has written."""
    system, place = _at(spark, path)
    system.delete(place, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """The entries of a folder, sorted; none if there is no such folder."""
    system, place = _at(spark, folder)
    if not system.exists(place):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(place))


def read_text(spark: SparkSession, path: str) -> str:
    """The whole of a small file."""
    system, place = _at(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist; whether it was written.

    Leaves it to the file system that of two writers only one creates the file, as HDFS does.
    """
    system, place = _at(spark, path)
    try:
        stream = system.create(place, False)
    except (Py4JJavaError, PySparkException) as error:
        if "already exists" in str(error).lower() or "FileAlreadyExists" in str(error):
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True
