"""Small files on the cluster's file system: commit logs and pointers.

Everything here runs on the driver through Hadoop's FileSystem, so it works on
whatever storage the tables are on, and handles file names and a few kilobytes
of JSON -- never rows.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    system, p = _open(spark, path)
    return bool(system.exists(p))


def child_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    system, p = _open(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(p)) if system.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    system, p = _open(spark, path)
    stream = system.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file: written aside and renamed, so it is there whole or not at all."""
    system, p = _open(spark, path)
    aside = _open(spark, f"{path.rsplit('/', 1)[0]}/_aside-{uuid.uuid4().hex}")[1]
    stream = system.create(aside, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    move(spark, aside.toString(), path)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file to a name that is not taken."""
    system, p = _open(spark, target)
    if system.exists(p) or not system.rename(_open(spark, source)[1], p):
        raise FileExistsError(f"{target} is there already: another writer was faster")


def make_folder(spark: SparkSession, path: str) -> None:
    system, p = _open(spark, path)
    system.mkdirs(p)


def delete(spark: SparkSession, path: str) -> bool:
    system, p = _open(spark, path)
    return bool(system.delete(p, True))


class CommitLog:
    """Numbered JSON files in a folder. The highest number is the newest; an entry is never changed."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def numbers(self) -> list[int]:
        return [int(n[:-5]) for n in child_names(self.spark, self.folder) if n.endswith(".json") and n[:-5].isdigit()]

    def read(self, number: int) -> dict:
        return json.loads(read_text(self.spark, f"{self.folder}/{number:012d}.json"))

    def append(self, number: int, entry: dict) -> None:
        create_text(self.spark, f"{self.folder}/{number:012d}.json", json.dumps(entry))

    def delete(self, number: int) -> None:
        delete(self.spark, f"{self.folder}/{number:012d}.json")
