"""Results kept by content: found again by any application that asks for the same thing.

A key is the hash of what a result depends on: path, length and time of change of every input file, the code of this
package and the settings. An entry is written beside its place and moved there whole; a marker file, made last, says that
it is complete. A changed file, another version or other settings give another key, so an old answer is never found.
"""

from __future__ import annotations

import functools
import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from stayline.session import checkpoint_dir


def _path(spark: SparkSession, path: str):
    """A path and the file system that holds it, through which Spark itself reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def file_status(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, int, int]]:
    """(path, length, time of change) of every file of the given files and folders."""
    found = []
    for path in paths:
        where, fs = _path(spark, path)
        files = fs.listFiles(where, True)
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(found)


@functools.cache
def code_version() -> str:
    """Hash of the package's sources, those of the training-data operators excepted."""
    root = Path(__file__).resolve().parents[1]
    digest = hashlib.sha256()
    for file in sorted(root.rglob("*.py")):
        if "llm" not in file.relative_to(root).parts:
            digest.update(f"{file.relative_to(root)}\n".encode() + file.read_bytes())
    return digest.hexdigest()


class Store:
    """Entries below one key, in the shared folder."""

    def __init__(self, spark: SparkSession, inputs: Sequence[str], settings: dict):
        self.spark = spark
        told = [file_status(spark, inputs), code_version(), sorted(settings.items())]
        self.key = hashlib.sha256(json.dumps(told, default=str).encode()).hexdigest()[:32]
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/stayline/store/{self.key}"

    def _marker(self, name: str) -> str:
        return f"{self.root}/{name}.complete"

    def holds(self, name: str) -> bool:
        where, fs = _path(self.spark, self._marker(name))
        return fs.exists(where)

    def folder(self, name: str, write: Callable[[str], None]) -> str:
        """The entry's folder; ``write`` fills it if no application has done so yet."""
        target = f"{self.root}/{name}"
        if self.holds(name):
            return target
        draft = f"{self.root}/draft-{uuid.uuid4().hex}"
        write(draft)
        where, fs = _path(self.spark, target)
        # Two writers make the same entry; who comes second leaves the first one's in place.
        if not fs.exists(where) and not fs.rename(_path(self.spark, draft)[0], where) and not fs.exists(where):
            raise OSError(f"{target} could not be written")
        fs.create(_path(self.spark, self._marker(name))[0], True).close()
        return target

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table of the store; ``build`` makes it if no application has done so yet."""
        path = self.folder(name, lambda draft: build().write.parquet(draft))
        return self.spark.read.parquet(path)

    def value(self, name: str, build: Callable[[], dict]) -> dict:
        """A small mapping of the store."""
        frame = self.table(name, lambda: self.spark.createDataFrame([(json.dumps(build()),)], "value string"))
        return json.loads(frame.first()[0])
