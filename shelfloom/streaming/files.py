"""Small files of the tables that streams keep: written whole or not at all, through Spark's own file systems."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none if it does not exist."""
    fs, at = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def put(spark: SparkSession, path: str, content: dict, replace: bool) -> None:
    """Writes beside and renames: a reader sees the whole file or none."""
    fs, at = _at(spark, path)
    _, beside = _at(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    out = fs.create(beside, False)
    out.write(json.dumps(content).encode())
    out.close()
    if replace and fs.exists(at):
        fs.delete(at, False)
    if fs.exists(at) or not fs.rename(beside, at):
        fs.delete(beside, False)
        raise FileExistsError(path)


def get(spark: SparkSession, path: str) -> dict:
    fs, at = _at(spark, path)
    size = fs.getFileStatus(at).getLen()
    stream = fs.open(at)
    try:
        return json.loads(bytes(stream.readNBytes(size)))
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.delete(at, True)
