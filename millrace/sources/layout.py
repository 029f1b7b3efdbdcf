"""Where data is read and written: dated and versioned folders, reference data by report date."""

from __future__ import annotations

import datetime as dt
import os
import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def raw_path(base: str, date: dt.date, version: int, prefix: str | None = None) -> str:
    return "/".join(x.strip("/") if i else x.rstrip("/") for i, x in enumerate([base, *([prefix] if prefix else []), f"{date:%Y/%m/%d}", f"v{version}"]))


def publish_path(base: str, date: dt.date, version: int, prefix: str | None = None, info: str = "info") -> str:
    return "/".join([base.rstrip("/"), *([prefix.strip("/")] if prefix else []), f"{info}_date={date:%Y-%m-%d}", f"{info}_version={version}"])


def _hadoop(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _hadoop(spark, path)
    return files.exists(at)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, over one that is there."""
    files, at = _hadoop(spark, path)
    out = files.create(at, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    files, at = _hadoop(spark, path)
    stream = files.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def claim(spark: SparkSession, path: str) -> bool:
    """Make an empty file; False if there is one, so of several writers only one gets True.

    Hadoop's local file system looks first and creates then, so for local paths the operating system is asked; other stores refuse the second writer themselves.
    """
    files, at = _hadoop(spark, path)
    if files.getScheme() == "file":
        local = at.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            os.close(os.open(local, os.O_CREAT | os.O_EXCL | os.O_WRONLY))
        except FileExistsError:
            return False
        return True
    try:
        return files.createNewFile(at)
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise


def size(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a path; 0 if there is nothing."""
    files, at = _hadoop(spark, path)
    return files.getContentSummary(at).getLength() if files.exists(at) else 0


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible files and folders in a folder; none if there is no such folder."""
    files, at = _hadoop(spark, path)
    names = [s.getPath().getName() for s in files.listStatus(at)] if files.exists(at) else []
    return sorted(n for n in names if not n.startswith(("_", ".")))


def delete(spark: SparkSession, path: str) -> None:
    files, at = _hadoop(spark, path)
    files.delete(at, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder to a place where nothing is yet."""
    files, at = _hadoop(spark, path)
    target = _hadoop(spark, to)[1]
    if files.exists(target):
        raise FileExistsError(f"{to} already exists")
    files.mkdirs(target.getParent())
    if not files.rename(at, target):
        raise OSError(f"{path} could not be moved to {to}")


def next_version(spark: SparkSession, base: str, date: dt.date, prefix: str | None = None, info: str = "info") -> int:
    """One more than the largest version published for a date."""
    folder = publish_path(base, date, 0, prefix, info).rpartition("/")[0]
    found = [int(m[1]) for n in children(spark, folder) if (m := re.fullmatch(rf"{info}_version=(\d+)", n))]
    return max(found, default=0) + 1


def write_new(df: DataFrame, path: str) -> None:
    """Write Parquet where nothing is yet."""
    df.write.mode("errorifexists").parquet(path)


def mapping_table(spark: SparkSession, base: str, date: dt.date, pattern: str = "reportDate={0:%Y-%m-%d}") -> DataFrame:
    """Reference data of a report date."""
    path = f"{base.rstrip('/')}/{pattern.format(date)}" if pattern else base
    if not any(n.endswith(".parquet") for n in children(spark, path)):
        raise FileNotFoundError(f"there is no Parquet data for the mapping table in {path}")
    return spark.read.parquet(path)


class MappingTables:
    """Reference data of one report date, each path read and listed once however many rules use it."""

    def __init__(self, spark: SparkSession, date: dt.date):
        self.spark, self.date, self.known = spark, date, {}

    def get(self, base: str, pattern: str = "reportDate={0:%Y-%m-%d}") -> DataFrame:
        if (base, pattern) not in self.known:
            self.known[base, pattern] = mapping_table(self.spark, base, self.date, pattern)
        return self.known[base, pattern]
