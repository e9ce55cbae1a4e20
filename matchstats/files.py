"""Files and folders of whatever file system a path names, asked without provoking errors."""

from __future__ import annotations

import time

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._settings = spark._jsc.hadoopConfiguration()

    def _at(self, path: str) -> tuple[JavaObject, JavaObject]:
        place = self._path(path)
        return place.getFileSystem(self._settings), place

    def exists(self, path: str) -> bool:
        """Is there anything at the path or, for a pattern, at any path that fits it."""
        system, place = self._at(path)
        found = system.globStatus(place)
        return found is not None and len(found) > 0

    def ages(self, folder: str) -> dict[str, float]:
        """Names in a folder with the seconds since each was last modified; none without it."""
        system, place = self._at(folder)
        if not system.exists(place):
            return {}
        now = time.time()
        return {
            status.getPath().getName(): now - status.getModificationTime() / 1000
            for status in system.listStatus(place)
        }

    def create(self, path: str) -> None:
        """An empty file, with its folders."""
        system, place = self._at(path)
        system.create(place, True).close()

    def remove(self, path: str) -> None:
        """Deletes a file or a whole folder, if present."""
        system, place = self._at(path)
        system.delete(place, True)
