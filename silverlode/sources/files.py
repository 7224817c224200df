"""The few file-system calls Spark has no DataFrame for, through Hadoop's own client."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path`` (none when it does not exist)."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def first_line(spark: SparkSession, path: str) -> str:
    """The whole first line of a text file; what follows is not read beyond a buffer."""
    fs, p = _file_system(spark, path)
    stream = fs.open(p)
    try:
        jvm = spark._jvm
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine() or ""
    finally:
        stream.close()
