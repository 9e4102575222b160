"""Folders of the shared file system, through Hadoop's API (driver-side metadata only, never data)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def plain(spark: SparkSession, path: str) -> str:
    """A path in full, without scheme and host."""
    fs, p = _at(spark, path)
    return fs.makeQualified(p).toUri().getPath()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file."""
    fs, p = _at(spark, path)
    return fs.getFileStatus(p).getLen()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names inside a folder, sorted; none if there is no such folder."""
    fs, p = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder to a name that is free; its parent folders are made."""
    fs, p = _at(spark, source)
    _, to = _at(spark, target)
    if fs.exists(to):
        raise FileExistsError(target)
    fs.mkdirs(to.getParent())
    if not fs.rename(p, to):
        raise OSError(f"{source} could not be renamed to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, complete under its name or not there; an error if the name is taken."""
    fs, part = _at(spark, f"{path}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    move(spark, f"{path}.part", path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    raw = spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    stream.close()
    return bytes(raw).decode()
