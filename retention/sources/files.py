"""Hadoop-FS helpers (work for local paths and any cluster file system)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def list_files(spark: SparkSession, path: str, suffix: str = "", recursive: bool = True) -> list[str]:
    """Sorted file URIs under ``path`` ending with ``suffix`` (names only, no data)."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    it = fs.listFiles(p, recursive)
    out = []
    while it.hasNext():
        s = it.next().getPath().toString()
        name = s.rsplit("/", 1)[-1]
        if s.endswith(suffix) and not name.startswith(("_", ".")):
            out.append(s)
    return sorted(out)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Sorted names of the folders directly under ``path``."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())


def has_file(spark: SparkSession, path: str, suffix: str = "") -> bool:
    """Whether a file with ``suffix`` lies under ``path``: stops at the first one."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return False
    it = fs.listFiles(p, True)
    while it.hasNext():
        name = it.next().getPath().getName()
        if name.endswith(suffix) and not name.startswith(("_", ".")):
            return True
    return False


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this job has made and no longer needs."""
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def copy_into(spark: SparkSession, path: str, prefix: str, suffix: str = ".csv") -> None:
    """A copy of every file with ``suffix`` under ``path``, beside it, its name after ``prefix``."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for uri in list_files(spark, path, suffix):
        src, fs = _fs(spark, uri)
        jvm.org.apache.hadoop.fs.FileUtil.copy(fs, src, fs, jvm.org.apache.hadoop.fs.Path(src.getParent(), prefix + src.getName()), False, conf)
