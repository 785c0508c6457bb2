"""Atomic publication: numbered manifests that name what is in force.

A writer puts its data into fresh folders and then publishes one small file that names them. Readers look at the last
manifest only, so they see one whole state; a writer that fails leaves the state before it. A manifest is written beside
its place and renamed, and a number is never taken twice, so of two writers at the same time one fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

FOLDER = "manifest"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and its location there."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    files, location = file_system(spark, path)
    return files.exists(location)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in ``path``; none if it does not exist."""
    files, location = file_system(spark, path)
    if not files.exists(location):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(location))


def last_number(spark: SparkSession, folder: str) -> int:
    """The number of the last manifest, -1 if nothing was published."""
    numbers = [n.removesuffix(".json") for n in names_in(spark, f"{folder}/{FOLDER}") if n.endswith(".json")]
    return max((int(n) for n in numbers if n.isdigit()), default=-1)


def published(spark: SparkSession, folder: str, number: int | None = None) -> dict:
    """What the last manifest, or that of the ``number``, holds; empty if nothing was published."""
    number = last_number(spark, folder) if number is None else number
    if number < 0:
        return {}
    text = spark.read.option("wholetext", "true").text(f"{folder}/{FOLDER}/{number}.json").first().value
    return json.loads(text)


def publish(spark: SparkSession, folder: str, number: int, content: dict) -> None:
    """Put ``content`` in force as manifest ``number``; raises if that number is taken."""
    target = f"{folder}/{FOLDER}/{number}.json"
    files, place = file_system(spark, target)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{FOLDER}/_{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    finally:
        stream.close()
    if files.exists(place) or not files.rename(draft, place):
        files.delete(draft, False)
        raise RuntimeError(f"{target}: somebody else has published this number")
