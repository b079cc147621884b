"""Small files and folders of any file system that Spark can write to."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def at(spark: SparkSession, path: str):
    """The path and its file system, whichever that is."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, path: str) -> list[str]:
    where, fs = at(spark, path)
    return [x.getPath().getName() for x in fs.listStatus(where)] if fs.exists(where) else []


def ages_in(spark: SparkSession, path: str) -> dict[str, int]:
    """When (milliseconds since the epoch) each thing in a folder was last changed."""
    where, fs = at(spark, path)
    return {x.getPath().getName(): x.getModificationTime() for x in fs.listStatus(where)} if fs.exists(where) else {}


def delete(spark: SparkSession, path: str) -> None:
    where, fs = at(spark, path)
    fs.delete(where, True)


def text_of(spark: SparkSession, path: str) -> str:
    where, fs = at(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Makes the file ``path``, whole at once; false if it is there already.

    Written aside and renamed without overwriting: of several writers one
    wins, where the file system's rename is atomic (as Spark's own streaming
    checkpoints need it)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target, fs = at(spark, path)
    aside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(aside, target, none)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" not in str(e.java_exception):
            raise
        fs.delete(aside, False)
        return False
