"""Small files through the Hadoop file system, so that every store a cluster reaches works."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    """Ask the path's file system for its status, without listing what lies below."""
    system, place = _place(spark, path)
    return system.exists(place)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder; 0 if there is none."""
    system, place = _place(spark, path)
    return system.getContentSummary(place).getLength() if system.exists(place) else 0


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all below; nothing if there is none."""
    system, place = _place(spark, path)
    system.delete(place, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if it does not exist."""
    system, place = _place(spark, path)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def read_text(spark: SparkSession, path: str) -> str:
    system, place = _place(spark, path)
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _write(system, place, text: str) -> None:
    stream = system.create(place, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file."""
    _write(*_place(spark, path), text)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with all its text, or return False if there is one by that name.

    The text is written under a name of its own first and then given the final one in a single
    step that fails if the name is taken: a hard link on a local disk, elsewhere a rename, which
    a distributed file system refuses onto a file. So of several writers one succeeds, and one
    that is killed on the way leaves the name free.
    """
    folder, name = path.rsplit("/", 1)
    system, place = _place(spark, path)
    _, draft = _place(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    system.mkdirs(place.getParent())
    _write(system, draft, text)
    try:
        if system.getScheme() != "file":
            return not system.exists(place) and bool(system.rename(draft, place))
        files = spark.sparkContext._jvm.java.nio.file
        as_local = [files.Paths.get(system.makeQualified(p).toUri()) for p in (place, draft)]
        try:
            files.Files.createLink(*as_local)
        except Exception as error:
            if "FileAlreadyExistsException" in str(error):
                return False
            raise
        return True
    finally:
        system.delete(draft, False)
