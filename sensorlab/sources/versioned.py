"""Tables that change by transactions: versioned folders and a manifest per version.

``path/data-*`` holds the rows of a version, ``path/_versions/<n>`` names its folder.  A change is
written to a new folder, checked on what was written, and committed by creating the next manifest,
which only one writer can do.  Until then, and after any failure, readers see the old version.
Readers that have begun keep their folder: old versions go only when ``vacuum`` is called.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Conflict(RuntimeError):
    """Another writer committed the version first."""


class CheckFailed(RuntimeError):
    """The rows of a change did not pass its check."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._at = jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ---------------------------------------------------------------- manifests
    def _manifest(self, version: int):
        return self._at(f"{self.path}/_versions/{version}")

    def _folder(self, version: int) -> str | None:
        """Folder of a version; None if its manifest was not finished."""
        stream = self._fs.open(self._manifest(version))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return text[:-1] if text.endswith("\n") else None

    def _numbers(self) -> list[int]:
        root = self._at(f"{self.path}/_versions")
        if not self._fs.exists(root):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(root)]
        return sorted(int(n) for n in names if n.isdigit())

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        return [n for n in self._numbers() if self._folder(n) is not None]

    def _commit(self, version: int, folder: str) -> None:
        from py4j.protocol import Py4JJavaError

        try:
            out = self._fs.create(self._manifest(version), False)     # fails if the manifest exists
        except Py4JJavaError as error:
            if self._fs.exists(self._manifest(version)):
                raise Conflict(f"version {version} of {self.path} exists") from error
            raise
        try:
            out.write(bytearray(f"{folder}\n".encode()))
        finally:
            out.close()

    # ---------------------------------------------------------------- reading and writing
    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest one by default."""
        known = self.versions()
        if not known or (version is not None and version not in known):
            raise FileNotFoundError(f"no version {'' if version is None else version} under {self.path}")
        return self.spark.read.parquet(f"{self.path}/{self._folder(known[-1] if version is None else version)}")

    def create(self, df: DataFrame) -> int:
        """Write the first version."""
        return self._write(df, 0, None)

    def transaction(self, change: Callable[[DataFrame], DataFrame],
                    check: Callable[[DataFrame, DataFrame], str | None] | None = None) -> int:
        """Commit ``change(rows)`` as the next version.  ``check(old, new)`` reads the written rows
        and returns what is wrong with them, or None.  Nothing is visible before the commit."""
        old = self.read()
        newest = self._numbers()[-1]
        return self._write(change(old), newest + 1, check and (lambda new: check(old, new)))

    def _write(self, df: DataFrame, version: int, check) -> int:
        folder = f"data-{version}-{uuid.uuid4().hex}"
        try:
            df.write.parquet(f"{self.path}/{folder}")
            problem = check(self.spark.read.parquet(f"{self.path}/{folder}")) if check else None
            if problem:
                raise CheckFailed(problem)
            self._commit(version, folder)
        except BaseException:
            self._fs.delete(self._at(f"{self.path}/{folder}"), True)      # our own unseen rows
            raise
        return version

    def vacuum(self, keep: int = 1) -> list[int]:
        """Remove all but the newest ``keep`` versions; returns what was removed."""
        gone = self.versions()[:-max(1, keep)]
        for version in gone:
            self._fs.delete(self._at(f"{self.path}/{self._folder(version)}"), True)
            self._fs.delete(self._manifest(version), False)
        return gone
