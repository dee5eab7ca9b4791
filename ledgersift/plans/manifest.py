"""Which stages of a run are done, and from what.

A stage's digest covers its name, its parameters and the digest of what it reads, so a change of the
source or of a parameter reaches every stage behind it. A stage is done if its mark carries this digest
and its results are there. The mark is taken away before a stage writes and set when all is written, so a
run that was cut off at any point goes on at the stage where it stopped.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import SparkSession

MARKS = "_stages"


def digest(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def source_digest(spark: SparkSession, path: str) -> str:
    """Name, size and time of change of all files below `path`, on any Hadoop file system."""
    files, place = _files(spark, path)
    found, listing = [], files.listFiles(place, True)
    while listing.hasNext():
        status = listing.next()
        found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return digest("source", sorted(found))


def _exists(spark: SparkSession, path: str) -> bool:
    files, place = _files(spark, path)
    return files.exists(place)


def _drop(spark: SparkSession, path: str) -> None:
    files, place = _files(spark, path)
    files.delete(place, True)


class Manifest:
    """The marks of one run's stages, each a small text file below the run's folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _mark(self, stage: str) -> str:
        return f"{self.folder}/{MARKS}/{stage}"

    def read(self, stage: str) -> dict | None:
        """What was recorded of a stage that is complete."""
        if not _exists(self.spark, f"{self._mark(stage)}/_SUCCESS"):
            return None
        row = self.spark.read.text(self._mark(stage), wholetext=True).first()
        return json.loads(row["value"]) if row else None

    def stage(self, name: str, reads: str, parameters: dict, results: list[str],
              work: Callable[[], object]) -> tuple[str, object]:
        """Do a stage unless it is done; (its digest, what `work` returned then or now).

        `results` are the paths below the run's folder that `work` writes. What it returns must be plain
        values, as it is kept in the mark.
        """
        wanted = digest(name, parameters, reads)
        mark = self.read(name)
        if mark and mark["digest"] == wanted and all(
                _exists(self.spark, f"{self.folder}/{r}/_SUCCESS") or _exists(
                    self.spark, f"{self.folder}/{r}/metadata/_SUCCESS") for r in results):
            return wanted, mark["value"]
        _drop(self.spark, self._mark(name))
        value = work()
        text = json.dumps({"stage": name, "digest": wanted, "reads": reads, "parameters": parameters,
                           "results": results, "value": value}, sort_keys=True, default=str)
        self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(self._mark(name))
        return wanted, value
