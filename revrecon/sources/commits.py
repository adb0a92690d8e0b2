"""Versions of a table as numbered commit files: who comes first writes a number, and readers see whole commits only."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_LOG = "_commits"


class CommitConflict(RuntimeError):
    """Another writer has committed the version since it was read."""


class SharedFolder:
    """A folder in any store that Spark reaches, through Hadoop's file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._hadoop = jvm.org.apache.hadoop
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path().getFileSystem(self._conf)

    def _path(self, *parts: str) -> JavaObject:
        return self._hadoop.fs.Path("/".join([self.root, *parts]))

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def names(self, *parts: str) -> list[tuple[str, float]]:
        """Names below a folder with the time of their last change in seconds, sorted; empty where there is no folder."""
        path = self._path(*parts)
        if not self._fs.exists(path):
            return []
        return sorted((s.getPath().getName(), s.getModificationTime() / 1000) for s in self._fs.listStatus(path))

    def read(self, *parts: str) -> str:
        stream = self._fs.open(self._path(*parts))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put_new(self, text: str, *parts: str) -> bool:
        """Writes a file as a whole, unless one of that name is there: False then.

        The text goes to a file of another name, which is renamed without overwriting. On HDFS that rename is one step
        that one writer wins; a store without such a rename must bring its own committer.
        """
        self._fs.mkdirs(self._path(*parts[:-1]))
        draft = self._path(*parts[:-1], f".draft-{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        options = self.spark._sc._gateway.new_array(self._hadoop.fs.Options.Rename, 1)
        options[0] = self._hadoop.fs.Options.Rename.NONE
        context = self._hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        try:
            context.rename(draft, self._path(*parts), options)
            return True
        except Py4JJavaError as error:
            self._fs.delete(draft, False)
            if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
                return False
            raise

    def remove(self, *parts: str) -> None:
        self._fs.delete(self._path(*parts), True)


@dataclass(frozen=True)
class Commit:
    """A version, what it says, and when it was written (seconds)."""

    version: int
    facts: dict
    at: float


class CommitLog:
    """The commits of a table below ``root``, numbered from 1 without a gap."""

    def __init__(self, spark: SparkSession, root: str):
        self.folder = SharedFolder(spark, root)

    def versions(self) -> dict[int, float]:
        names = [(name, at) for name, at in self.folder.names(_LOG) if name.endswith(".json") and not name.startswith(".")]
        return {int(name.removesuffix(".json")): at for name, at in names}

    def latest(self) -> int:
        """The last version, 0 before the first commit."""
        return max(self.versions(), default=0)

    def read(self, version: int | None = None) -> Commit | None:
        """A commit, by default the last; None before the first."""
        all_ = self.versions()
        version = max(all_, default=0) if version is None else version
        if version == 0:
            return None
        if version not in all_:
            raise ValueError(f"no version {version} in {self.folder.root}")
        return Commit(version, json.loads(self.folder.read(_LOG, f"{version:020d}.json")), all_[version])

    def history(self) -> Iterator[Commit]:
        """All commits, the oldest first."""
        for version in sorted(self.versions()):
            commit = self.read(version)
            if commit:
                yield commit

    def commit(self, base: int, facts: dict) -> int:
        """The version after ``base``; a :class:`CommitConflict` if another writer has made it in the meantime."""
        if not self.folder.put_new(json.dumps(facts), _LOG, f"{base + 1:020d}.json"):
            raise CommitConflict(f"version {base + 1} of {self.folder.root} is there already")
        return base + 1


def new_name(prefix: str) -> str:
    """A name that no other writer uses, and that tells when it was made."""
    return f"{prefix}-{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"


def made_at(name: str) -> float:
    """Seconds of a name from :func:`new_name`."""
    return int(name.split("-")[1]) / 1e9
