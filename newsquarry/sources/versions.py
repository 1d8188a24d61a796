"""Versions of a folder's contents that become visible at once, on any Hadoop file system.

A version is a data folder of its own, written where nobody reads, and a marker
``v<number>`` that names it.  A marker is created exclusively, so of two runs that
start from the same version one publishes and the other is told; nothing that is
being read is ever moved or deleted.
"""

from __future__ import annotations

import json
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Seconds after which a marker that was created but never filled counts as left behind by a run that died.
STALE_SECONDS = 600


class PublishedElsewhere(RuntimeError):
    """Another run published the next version first."""


class Versions:
    """The versions below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.folder = folder.rstrip("/")
        self._jvm = spark._jvm
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _markers(self) -> list[tuple[int, object]]:
        at = self._path(f"{self.folder}/_markers")
        if not self._fs.exists(at):
            return []
        found = [(s.getPath().getName(), s) for s in self._fs.listStatus(at)]
        return sorted((int(name[1:]), s) for name, s in found if name[1:].isdigit())

    def _content(self, status) -> dict | None:
        stream = self._fs.open(status.getPath())
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text) if text else None

    def numbers(self) -> list[int]:
        """The published versions, oldest first."""
        return [n for n, s in self._markers() if s.getLen()]

    def last(self) -> tuple[int, dict] | None:
        """Number and contents of the newest marker; None where nothing was published."""
        for n, status in reversed(self._markers()):
            if status.getLen():
                return n, self._content(status)
            if time.time() - status.getModificationTime() / 1000 < STALE_SECONDS:
                raise PublishedElsewhere(f"version {n} of {self.folder} is being published")
        return None

    def stage(self) -> str:
        """A new data folder's path, relative to the folder; nobody reads it before it is published."""
        return f"data-{uuid.uuid4().hex}"

    def publish(self, after: int, contents: dict) -> int:
        """Makes ``contents`` the version that follows ``after``, the one the run started from."""
        known = [n for n, s in self._markers()]
        filled = self.numbers()
        if (filled[-1] if filled else 0) != after:
            raise PublishedElsewhere(f"version {filled[-1]} of {self.folder} was published by another run")
        number = max([after, *known]) + 1
        try:
            out = self._fs.create(self._path(f"{self.folder}/_markers/v{number}"), False)
        except Py4JJavaError as e:
            raise PublishedElsewhere(f"version {number} of {self.folder} was published by another run") from e
        out.write(json.dumps(contents).encode())
        out.close()
        return number

    def delete(self, name: str) -> None:
        """Deletes a data folder that no version names any more."""
        self._fs.delete(self._path(f"{self.folder}/{name}"), True)

    def staged(self) -> list[str]:
        """Names of all data folders, published or not."""
        at = self._path(self.folder)
        if not self._fs.exists(at):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at) if s.getPath().getName().startswith("data-"))
