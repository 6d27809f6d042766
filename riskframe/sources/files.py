"""Single files and folders of whatever file system the cluster shares, through Spark's own file system classes."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, system = _file_system(spark, path)
    return bool(system.exists(target))


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies directly below ``path``, sorted; nothing if there is no such folder."""
    target, system = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(target)) if system.exists(target) else []


def delete(spark: SparkSession, path: str) -> None:
    target, system = _file_system(spark, path)
    system.delete(target, True)


def put_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file ``path`` with ``text``, whole or not at all; False if there is one already."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, system = _file_system(spark, path)
    part = hadoop.Path(target.getParent(), f".{uuid.uuid4().hex}")  # Spark's readers skip names with a dot in front
    out = system.create(part)
    out.write(bytearray(text.encode()))
    out.close()
    context = hadoop.FileContext.getFileContext(system.makeQualified(target).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
    try:
        context.rename(system.makeQualified(part), system.makeQualified(target), options)
        return True
    except Py4JJavaError as error:
        system.delete(part, False)
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
