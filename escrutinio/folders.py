"""Folders of any Hadoop file system; the one place that reaches into the JVM."""

from pyspark.sql import SparkSession


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def make_folder(spark: SparkSession, path: str) -> None:
    fs, folder = _filesystem(spark, path)
    fs.mkdirs(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, folder = _filesystem(spark, path)
    fs.delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _filesystem(spark, path)
    return fs.exists(folder)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, folder = _filesystem(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    fs, folder = _filesystem(spark, path)
    return fs.getContentSummary(folder).getLength()


def make_file(spark: SparkSession, path: str) -> None:
    """An empty file."""
    fs, file = _filesystem(spark, path)
    fs.create(file, True).close()


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, path = _filesystem(spark, source)
    if not fs.rename(path, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{source} cannot be renamed to {target}")
