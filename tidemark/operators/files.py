"""Small files on any Hadoop file system."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(file system, path) of the JVM for a path or URI."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where it is missing."""
    fs, p = file_system(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a whole file under a name that nobody has; False where another writer has it.

    The text is written under a name of its own first.  On a local file system a hard link then gives it the
    wanted name, elsewhere a rename that does not overwrite; both are one step that fails where the name is taken
    (HDFS and the like; an object store needs a connector with such a rename)."""
    fs, p = file_system(spark, path)
    jvm = spark.sparkContext._jvm
    fs.mkdirs(p.getParent())
    temp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
    out = fs.create(temp, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.getUri().getScheme() == "file":
        try:
            os.link(temp.toUri().getPath(), p.toUri().getPath())
            return True
        except FileExistsError:
            return False
        finally:
            fs.delete(temp, False)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(temp, p, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        return True
    except Exception as e:  # a Java exception carries its class name
        if "FileAlreadyExists" not in str(e):
            raise
        fs.delete(temp, False)
        return False
