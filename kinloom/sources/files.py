"""Small files and listings in any store that Spark reaches, from the driver and without a job."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):  # noqa: ANN202
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(context._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    found, system = _path(spark, path)
    return system.exists(found)


def delete(spark: SparkSession, path: str) -> None:
    found, system = _path(spark, path)
    system.delete(found, True)


def read_text(spark: SparkSession, path: str) -> str:
    found, system = _path(spark, path)
    stream = system.open(found)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Published whole: written beside its place and renamed into it, over what was there."""
    context = spark.sparkContext
    jvm, gateway = context._jvm, context._gateway
    found, system = _path(spark, path)
    partial, _ = _path(spark, f"{path}.{uuid.uuid4().hex}.partial")
    system.mkdirs(found.getParent())
    stream = system.create(partial, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    over = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    where = system.makeQualified(found)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), context._jsc.hadoopConfiguration()).rename(system.makeQualified(partial), where, over)


def identities(spark: SparkSession, root: str) -> list[list]:
    """[path, size, time of change] of a file, or of all files below a folder, by path; hidden ones left out."""
    found, system = _path(spark, root)
    listed = system.listFiles(found, True)
    out = []
    while listed.hasNext():
        status = listed.next()
        if not status.getPath().getName().startswith((".", "_")):
            out.append([status.getPath().toString(), status.getLen(), status.getModificationTime()])
    return sorted(out)
