"""Versions of a folder's contents, each committed by creating a file that nobody else may create.

A version is a small JSON text under _versions that names the data folders it
is made of. Writers write their data first, under names of their own, and then
try to add the version after the one they read: the one who comes second finds
it taken, and starts again from there. So no two writers build on one version,
and a reader never sees half of one.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from typing import Any
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession


class Versions:
    """The versions of one folder; number 0 is that of a folder that has none."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _hadoop(self, path: str) -> tuple[Any, Any]:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def current(self) -> tuple[int, dict]:
        fs, folder = self._hadoop(f"{self.path}/_versions")
        if not fs.exists(folder):
            return 0, {}
        numbers = [int(s.getPath().getName().split(".")[0]) for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json")]
        if not numbers:
            return 0, {}
        text = self.spark.read.text(f"{self.path}/_versions/{max(numbers):012d}.json", wholetext=True).first()[0]
        return max(numbers), json.loads(text)

    def commit(self, after: int, content: dict) -> bool:
        """Add the version after the given one; False if somebody else has.

        On a local file system a hard link, elsewhere a rename, puts the text
        in its place whole, and either fails where the name is taken. A file
        system whose rename replaces its target doesn't do.
        """
        target = f"{self.path}/_versions/{after + 1:012d}.json"
        fs, folder = self._hadoop(f"{self.path}/_versions")
        fs.mkdirs(folder)
        text = json.dumps(content)
        if fs.getScheme() == "file":
            place = urlparse(target).path
            draft = f"{place}.{uuid.uuid4().hex}"
            with open(draft, "w") as f:
                f.write(text)
            try:
                os.link(draft, place)
            except FileExistsError:
                return False
            finally:
                os.unlink(draft)
            return True
        _, draft = self._hadoop(f"{target}.{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(text.encode())
        out.close()
        _, place = self._hadoop(target)
        if not fs.exists(place) and fs.rename(draft, place):
            return True
        fs.delete(draft, False)
        return False

    def write(self, df: DataFrame, name: str) -> str:
        """Write df as Parquet under a name of its own, which is returned; it counts once a version names it."""
        folder = f"{name}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        return folder

    def read(self, folder: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{folder}")

    def drop(self, *folders: str) -> None:
        for f in folders:
            fs, p = self._hadoop(f"{self.path}/{f}")
            fs.delete(p, True)

    def update(self, make: Callable[[dict], tuple[dict, list[str]]], tries: int = 20) -> dict:
        """Commit what make makes of the current content; who loses drops what was written and makes it again.

        make returns the new content and the names of the folders that it wrote.
        """
        for _ in range(tries):
            number, content = self.current()
            new, written = make(content)
            if self.commit(number, new):
                return new
            self.drop(*written)
        raise RuntimeError(f"{self.path}: {tries} times another writer was first")
