"""A model store that can be republished while others read it.

    store/versions/<number>-<id>/   one whole version, written by ``save_models``
    store/published/<number>        a small file that names the version

A version becomes visible by one rename of its finished pointer file. On HDFS a rename
never replaces a file, so two writers cannot publish the same number: the
later one takes the next. Readers take the highest number and then read only
the folder that it names, which is never written again, so a load between any
two writes sees one whole version. Old versions are pruned down to ``keep``,
never the published one. A crash leaves an unnamed folder that no reader sees.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from . import load_models, save_models

ATTEMPTS = 50


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *[p for p in parts if p]]))

    def _names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return sorted(f.getPath().getName() for f in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def numbers(self) -> list[int]:
        """Published numbers, ascending."""
        return sorted(int(n) for n in self._names("published") if n.isdigit())

    def version_of(self, number: int) -> str:
        """The version folder that a published number names."""
        stream = self._fs.open(self._at("published", f"{number:08d}"))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def current(self) -> str | None:
        """Path of the published version, None before the first."""
        n = self.numbers()
        return f"{self.path}/versions/{self.version_of(n[-1])}" if n else None

    def _point(self, number: int, version: str) -> bool:
        """Publish ``version`` as ``number``; False when another writer has it."""
        draft = self._at("published", f".draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(version.encode()))
        finally:
            out.close()
        target = self._at("published", f"{number:08d}")
        won = not self._fs.exists(target) and self._fs.rename(draft, target)
        if not won:
            self._fs.delete(draft, False)
        return won and self.version_of(number) == version

    def publish(self, bundle, metrics: DataFrame | None = None, keep: int = 3) -> str:
        """Write a new version of the models and make it the published one;
        returns its path."""
        number = max(self.numbers(), default=0) + 1
        version = f"{number:08d}-{uuid.uuid4().hex}"
        save_models(self.spark, bundle, f"{self.path}/versions/{version}", metrics)
        for _ in range(ATTEMPTS):
            if self._point(number, version):
                self.prune(keep)
                return f"{self.path}/versions/{version}"
            number = max(self.numbers(), default=0) + 1
        raise RuntimeError(f"{self.path}: other writers kept taking the next number")

    def prune(self, keep: int) -> None:
        """Delete pointers and folders of all but the last ``keep`` published
        versions. Folders of unpublished versions above the last published
        number may still be in writing and stay."""
        numbers = self.numbers()
        for n in numbers[:-max(keep, 1)]:
            folder = self.version_of(n)
            self._fs.delete(self._at("published", f"{n:08d}"), False)
            self._fs.delete(self._at("versions", folder), True)

    def load(self, number: int | None = None):
        """The published models, or those of an earlier number. A store
        without a published version gives the fallbacks, with a warning."""
        folder = self.current() if number is None else f"{self.path}/versions/{self.version_of(number)}"
        return load_models(self.spark, folder or self.path)
