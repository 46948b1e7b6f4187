"""Small files beside a table: created by one job alone, or as the next of a row of versions.

What several jobs may do at once goes through ``create_once``, which the file system decides: of all jobs that create one
path, one succeeds.  A version is a file of its own that is never changed, so a reader that has opened one keeps it.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_TAKEN = ("FileAlreadyExistsException", "AlreadyExistsException", "FileAlreadyExists")


def _place(spark: SparkSession, path: str):
    """The file system of a path, and the path as that file system takes it."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def create_once(spark: SparkSession, path: str, content: str) -> bool:
    """Create a file unless there is one; False if another job has created it first.

    On a local file system the kernel decides (CREATE_NEW); the usual check-then-create there lets two jobs through.
    Others are asked to create without overwriting, which HDFS and stores with conditional writes decide themselves.
    """
    files, place = _place(spark, path)
    jvm = spark.sparkContext._jvm
    files.mkdirs(place.getParent())
    data = bytearray(content.encode())
    try:
        if files.getUri().getScheme() == "file":
            option = jvm.java.nio.file.StandardOpenOption
            options = spark.sparkContext._gateway.new_array(jvm.java.nio.file.OpenOption, 2)
            options[0], options[1] = option.CREATE_NEW, option.WRITE
            jvm.java.nio.file.Files.write(jvm.java.nio.file.Path.of(place.toUri().getPath(), spark.sparkContext._gateway.new_array(
                jvm.java.lang.String, 0)), data, options)
        else:
            out = files.create(place, False)
            try:
                out.write(data)
            finally:
                out.close()
    except Py4JJavaError as failed:
        if failed.java_exception.getClass().getSimpleName() in _TAKEN:
            return False
        raise
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's content, or None if there is none."""
    files, place = _place(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no folder."""
    files, place = _place(spark, path)
    if not files.exists(place):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(place))


def remove(spark: SparkSession, path: str) -> None:
    files, place = _place(spark, path)
    files.delete(place, True)


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the versions in a folder, ascending."""
    return sorted(int(name[1:]) for name in names(spark, folder) if name[:1] == "v" and name[1:].isdigit())


def version_path(folder: str, number: int) -> str:
    return f"{folder}/v{number}"
