"""All that needs a handle on the JVM; a session without one (Spark Connect) stops here."""

from __future__ import annotations

import os
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def _file_system(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Existing paths that match a glob, sorted; for globs that match few paths."""
    path, files = _file_system(spark, pattern)
    return sorted(status.getPath().toString() for status in files.globStatus(path) or [])


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether a glob matches anything, in one call however much it matches."""
    path, files = _file_system(spark, pattern)
    found = files.globStatus(path)
    return bool(found) and len(found) > 0


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder with all in it; one that is not there does no harm."""
    found, files = _file_system(spark, path)
    files.delete(found, True)


def is_file(spark: SparkSession, path: str) -> bool:
    found, files = _file_system(spark, path)
    return files.exists(found) and files.getFileStatus(found).isFile()


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of the files under a path; 0 where there is none."""
    found, files = _file_system(spark, path)
    return files.getContentSummary(found).getLength() if files.exists(found) else 0


def read_file(spark: SparkSession, path: str) -> str:
    """The text of one small file."""
    found, files = _file_system(spark, path)
    stream = files.open(found)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def publish_file(spark: SparkSession, path: str, draft: str, text: str) -> bool:
    """Make ``path`` a file with ``text``, whole or not at all; False if it is there already.

    The text is written to ``draft``, beside ``path``, and closed; then one step gives it its
    name, and of several writers one wins. On local disks, where a rename would replace the
    other's file, that step is a hard link; elsewhere it is a rename that may not replace, which
    HDFS and its like do at once.
    """
    found, files = _file_system(spark, draft)
    stream = files.create(found, False)
    try:
        stream.write(text.encode("utf-8"))
    finally:
        stream.close()
    try:
        real = files.makeQualified(found)
        if real.toUri().getScheme() == "file":
            target = files.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(path))
            ends = [unquote(urlparse(p.toUri().toString()).path) for p in (real, target)]
            os.link(*ends)
            return True
        hadoop = spark._jvm.org.apache.hadoop.fs
        options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
        context = hadoop.FileContext.getFileContext(real.toUri(), spark._jsc.hadoopConfiguration())
        context.rename(real, hadoop.Path(path), options)
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        files.delete(found, False)


def checkpoint_dir(spark: SparkSession) -> str | None:
    return spark.sparkContext.getCheckpointDir()


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimised plan."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_threshold(spark: SparkSession) -> int:
    """The session's threshold in bytes; negative where broadcasts are off."""
    conf = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if conf.startswith("-"):
        return -1
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf)
