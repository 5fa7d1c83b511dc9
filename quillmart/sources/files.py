"""The few file operations that tables need beyond Spark's readers and writers, on any Hadoop file system."""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def listing(spark: SparkSession, path: str) -> dict[str, tuple[bool, float]]:
    """Name -> (is a folder, seconds since it was last changed); empty where there is no such folder."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return {}
    now = time.time()
    return {s.getPath().getName(): (s.isDirectory(), now - s.getModificationTime() / 1000) for s in fs.listStatus(p)}


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _open(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` whole or not at all; False when it exists already.

    The text goes to a name of its own first and is renamed without overwriting, as
    Spark's streaming logs are: one of several writers wins wherever the store renames
    atomically.
    """
    sc, (fs, p) = spark.sparkContext, _open(spark, path)
    jvm = sc._jvm
    draft = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}.tmp")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    # No options: the rename fails where the name is taken.
    options = sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf()).rename(draft, p, options)
        return True
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
