"""Where jobs put tables that only have to outlive the job itself."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared folder the session names.

    ``spark.checkpoint.dir`` is that folder. Only where it is unset and Spark
    runs on this machine alone, as in a test, is a local folder used, and
    removed at exit.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    local = tempfile.mkdtemp(prefix="run-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    return f"{local}/{label}"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder a job wrote, wherever it is."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it is not there."""
    files, place = _file_system(spark, path)
    return [entry.getPath().getName() for entry in files.listStatus(place)] if files.exists(place) else []


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a file of at most some kilobytes."""
    files, place = _file_system(spark, path)
    stream = files.open(place)
    try:
        return bytes(stream.readNBytes(1 << 20)).decode()
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file that is there as a whole or not at all; False if there is one of that name."""
    files, place = _file_system(spark, path)
    _, part = _file_system(spark, f"{path}.{uuid.uuid4().hex}.part")
    stream = files.create(part, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    done = not files.exists(place) and files.rename(part, place)
    if not done:
        files.delete(part, False)
    return done
