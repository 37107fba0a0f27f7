"""Files of any file system that Spark reads, by Hadoop's calls on the driver."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def fs_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = fs_path(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = fs_path(spark, path)
    fs.delete(p, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """The paths of what a folder holds, in order; none if there is no folder."""
    fs, p = fs_path(spark, path)
    return sorted(str(f.getPath()) for f in fs.listStatus(p)) if fs.exists(p) else []


def names(spark: SparkSession, path: str) -> list[str]:
    return [c.rstrip("/").rsplit("/", 1)[-1] for c in children(spark, path)]


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a folder or file; the target must not exist."""
    fs, p = fs_path(spark, path)
    _, to = fs_path(spark, target)
    fs.mkdirs(to.getParent())
    if fs.exists(to) or not fs.rename(p, to):
        raise OSError(f"{path} was not moved to {target}")


def modified(spark: SparkSession, path: str) -> int:
    """When a file was last written or touched, in milliseconds; an error if there is none."""
    fs, p = fs_path(spark, path)
    return fs.getFileStatus(p).getModificationTime()


def read_text(spark: SparkSession, path: str) -> str:
    """A whole small file."""
    fs, p = fs_path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A whole file, written beside its place and renamed into it."""
    fs, p = fs_path(spark, path)
    part = _part(fs, p, text)
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(part, p):
        raise OSError(f"{path} was not written")


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """A whole file where there is none: of several calls at once one wins and returns True.

    HDFS renames onto nothing, a local or mounted disk links onto nothing. On an object
    store whose rename may overwrite, give the folder to a store that has such a call.
    """
    fs, p = fs_path(spark, path)
    part = _part(fs, p, text)
    try:
        if fs.getUri().getScheme() == "file":
            try:
                os.link(part.toUri().getPath(), p.toUri().getPath())
                return True
            except FileExistsError:
                return False
        return not fs.exists(p) and fs.rename(part, p)
    finally:
        fs.delete(part, False)


def _part(fs, p, text: str):
    fs.mkdirs(p.getParent())
    part = p.suffix(f".{uuid.uuid4().hex}.part")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return part
