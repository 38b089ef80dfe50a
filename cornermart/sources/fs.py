"""Metadata calls on the file system behind a URI (listing, markers, removal)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, uri: str) -> bool:
    fs, path = _resolve(spark, uri)
    return fs.exists(path)


def glob(spark: SparkSession, pattern: str) -> list[str]:
    fs, path = _resolve(spark, pattern)
    return sorted(status.getPath().toString() for status in (fs.globStatus(path) or []))


def data_files(spark: SparkSession, uri: str) -> list[tuple[str, int]]:
    """(path, bytes) of a file, or of the part files when the delivery is a folder."""
    fs, path = _resolve(spark, uri)
    return sorted(
        (status.getPath().toString(), status.getLen())
        for status in fs.listStatus(path)
        if status.isFile() and status.getPath().getName()[0] not in "._"
    )


def write_text(spark: SparkSession, uri: str, text: str) -> None:
    """A small metadata file, replaced as a whole."""
    fs, path = _resolve(spark, uri)
    stream = fs.create(path, True)
    try:
        stream.write(text.encode("utf-8"))
    finally:
        stream.close()


def read_text(spark: SparkSession, uri: str) -> str | None:
    fs, path = _resolve(spark, uri)
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return spark._jvm.java.lang.String(stream.readAllBytes(), "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, uri: str) -> None:
    fs, path = _resolve(spark, uri)
    fs.delete(path, True)
