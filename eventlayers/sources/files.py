"""Small file operations through Spark's file systems, so that any store that Spark reads will do."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = file_system(spark, path)
    return fs.exists(place)


def names(spark: SparkSession, folder: str) -> set[str]:
    """The names in a folder; none if it is not there."""
    fs, place = file_system(spark, folder)
    return {f.getPath().getName() for f in fs.listStatus(place)} if fs.exists(place) else set()


def read_text(spark: SparkSession, path: str) -> str:
    fs, place = file_system(spark, path)
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    fs, place = file_system(spark, path)
    out = fs.create(place, overwrite)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file that appears as a whole; False if it is there already."""
    folder, name = path.rsplit("/", 1)
    if exists(spark, path):
        return False
    hidden = f"{folder}/.{name}"
    try:
        write_text(spark, hidden, text, overwrite=False)
    except Py4JJavaError:
        if exists(spark, path):
            return False
        # Left there by a writer that died: its successor holds the lease and may replace it.
        write_text(spark, hidden, text)
    return rename_once(spark, hidden, path)


def rename_once(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file unless the target is there; False then, and an error if nothing was renamed."""
    fs, place = file_system(spark, target)
    if fs.exists(place):
        return False
    if not fs.rename(file_system(spark, source)[1], place):
        raise OSError(f"could not rename {source} to {target}")
    return True


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder that may be gone already."""
    fs, place = file_system(spark, path)
    fs.delete(place, True)
