"""Small files beside the data (commit records), on any file system that Spark can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return place.getFileSystem(conf), place, conf


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    system, place, _ = _place(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    system, place, _ = _place(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file whole or not at all; false, with nothing changed, if it is there already.

    The file is written aside and then renamed without overwriting, which is one step on file systems with atomic renames.
    """
    aside = f"{path}.{uuid.uuid4().hex}.tmp"
    system, place, conf = _place(spark, aside)
    stream = system.create(place, False)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), conf)
    never = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(place, spark._jvm.org.apache.hadoop.fs.Path(path), never)
    except Exception as error:
        system.delete(place, False)
        if "FileAlreadyExistsException" in str(error):
            return False
        raise
    return True


def delete(spark: SparkSession, path: str) -> None:
    system, place, _ = _place(spark, path)
    system.delete(place, True)
