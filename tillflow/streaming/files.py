"""Small steps on whatever file system the tables lie on."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _path(spark, path)
    return system.exists(place)


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """Names that fit a pattern, in order."""
    place, system = _path(spark, pattern)
    return sorted(f.getPath().toString() for f in system.globStatus(place) or [])


def moved(spark: SparkSession, source: str, target: str) -> None:
    """Moves a finished folder to its place at once."""
    place, system = _path(spark, target)
    system.mkdirs(place.getParent())
    if not system.rename(spark._jvm.org.apache.hadoop.fs.Path(source), place):
        raise OSError(f"{source} could not be moved to {target}")


def removed(spark: SparkSession, path: str) -> None:
    place, system = _path(spark, path)
    system.delete(place, True)


def created(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a file that is not there yet; False, and nothing written, if it is."""
    place, system = _path(spark, path)
    if system.exists(place):
        return False
    out = system.create(place, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    return True


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint gives its query: the same after every restart, another one for
    every new checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
