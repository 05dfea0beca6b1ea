"""Directory questions asked through Hadoop, so that any file system works."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _open(spark, path)
    return bool(fs.exists(hadoop_path))


def children(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop_path = _open(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path))


def drop_directory(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _open(spark, path)
    fs.delete(hadoop_path, True)


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _open(spark, path)
    return bool(fs.getFileStatus(hadoop_path).isDirectory())


def drop(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder; one that is gone already is no error."""
    drop_directory(spark, path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _open(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()


def older(spark: SparkSession, path: str, before: float) -> list[str]:
    """Names in a folder that were last changed before a time in seconds; none if there is no folder."""
    if not exists(spark, path):
        return []
    fs, hadoop_path = _open(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.getModificationTime() < before * 1000]


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Makes a whole file appear at `path` at once, unless there is one: then False.

    The text goes to a file beside it first. On a local disk that is linked into place, elsewhere
    renamed without overwriting, which file systems such as HDFS do atomically. Object stores
    without such a rename cannot decide between two writers.
    """
    fs, hadoop_path = _open(spark, path)
    jvm = spark._jvm
    beside = jvm.org.apache.hadoop.fs.Path(hadoop_path.getParent(), f".{uuid.uuid4().hex}.tmp")
    stream = fs.create(beside)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            files = jvm.java.nio.file.Files
            files.createLink(jvm.java.nio.file.Paths.get(hadoop_path.toUri().getPath(), _strings(spark)),
                             jvm.java.nio.file.Paths.get(beside.toUri().getPath(), _strings(spark)))
        else:
            no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                fs.getUri(), spark._jsc.hadoopConfiguration())
            context.rename(beside, fs.makeQualified(hadoop_path), no_options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        fs.delete(beside, False)
    return True


def _strings(spark: SparkSession):
    return spark.sparkContext._gateway.new_array(spark._jvm.java.lang.String, 0)
