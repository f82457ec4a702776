"""Small files in any store Spark reaches, through its own file system classes: list, read, create if absent, delete."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(conf), place


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none where there is no folder."""
    fs, place = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, place = _at(spark, path)
    stream = fs.open(place)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole text unless it is there; of several writers one gets True.

    The text goes to a file of its own first, so no reader sees half of it. That file then gets the name: by a hard link
    on a local or mounted disk, by a rename that refuses an existing target elsewhere, both of which the store decides.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    draft = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    fs, place = _at(spark, draft)
    out = fs.create(place, False)
    out.write(bytearray(text.encode()))
    out.close()
    target = jvm.org.apache.hadoop.fs.Path(path)
    try:
        if fs.getScheme() == "file":
            local = jvm.java.nio.file.Paths.get
            parts = spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0)
            jvm.java.nio.file.Files.createLink(local(target.toUri().getPath(), parts), local(place.toUri().getPath(), parts))
        else:
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = getattr(jvm.org.apache.hadoop.fs.Options, "Rename").NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(place, target, options)
        return True
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    finally:
        fs.delete(place, False)


def delete(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)
