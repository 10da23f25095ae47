"""Small files in shared storage: lists, texts, and texts that appear whole or not at all."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a path as Spark's JVM sees it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, sorted; none if there is no such folder."""
    return [name for name, _ in sizes(spark, folder)]


def sizes(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(name, bytes) of what is in a folder, sorted by name."""
    files, at = hadoop_path(spark, folder)
    return sorted((s.getPath().getName(), s.getLen()) for s in files.listStatus(at)) if files.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    files, at = hadoop_path(spark, path)
    stream = files.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file, replacing one of that name."""
    files, at = hadoop_path(spark, path)
    out = files.create(at, True)
    out.write(bytearray(text.encode()))
    out.close()


def put_new_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that appears whole under its name; ``False`` if another writer was first."""
    files, at = hadoop_path(spark, path)
    draft = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    put_text(spark, draft, text)
    _, hidden = hadoop_path(spark, draft)
    if files.exists(at) or not files.rename(hidden, at):
        files.delete(hidden, False)
        return False
    return True


def delete(spark: SparkSession, path: str) -> None:
    files, at = hadoop_path(spark, path)
    files.delete(at, True)


def newest(spark: SparkSession, folder: str, ending: str = ".json") -> int | None:
    """The greatest number among files named by numbers; ``None`` if there are none."""
    found = [int(n.removesuffix(ending)) for n in names(spark, folder) if n.endswith(ending) and not n.startswith(".")]
    return max(found, default=None)
