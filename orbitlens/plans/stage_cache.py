"""Results of stages kept in a shared folder and used again by runs with the same inputs and settings.

A stage's key is a digest of its name, what it is made from and its settings. Its rows are written first, then a
manifest whose commit makes the stage whole; a folder without one is never read. ``sweep`` removes folders that no
manifest names, and stages that are no longer wanted.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def digest(*parts: object) -> str:
    """A digest of values by their text."""
    return hashlib.sha256("\x1f".join(map(repr, parts)).encode()).hexdigest()[:32]


def digest_files(spark: SparkSession, *paths: str) -> str:
    """A digest of names, sizes and times of all files; reads no rows."""
    files = spark.read.parquet(*paths).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    marks = files.distinct().select(F.xxhash64("*").alias("h"))
    row = marks.agg(F.count("*"), F.bit_xor("h"), F.sum(F.col("h").cast("decimal(38,0)"))).first()
    return digest(*row)


class StageCache:
    """Stages below one folder; ``built`` and ``reused`` list what a run did."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.built: list[str] = []
        self.reused: list[str] = []

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))

    def manifest(self, key: str) -> dict | None:
        """What the stage's manifest says, or None for a stage that is not whole."""
        if not self._files().exists(self._path(key, "manifest", "_SUCCESS")):
            return None
        return json.loads(self.spark.read.text(f"{self.folder}/{key}/manifest").first()[0])

    def stage(self, name: str, made_from: Iterable[str], settings: object, build: Callable[[], DataFrame]) -> tuple[DataFrame, str]:
        """The rows of a stage and its key; ``build`` runs only where no whole result is there."""
        key = f"{name}-{digest(name, list(made_from), settings)}"
        found = self.manifest(key)
        if found:
            self.reused.append(name)
        else:
            rows = build()
            rows.write.mode("overwrite").parquet(f"{self.folder}/{key}/rows")
            found = {"stage": name, "settings": repr(settings), "schema": rows.schema.json()}
            text = self.spark.createDataFrame([(json.dumps(found),)], "value string")
            text.coalesce(1).write.mode("overwrite").text(f"{self.folder}/{key}/manifest")
            self.built.append(name)
        schema = StructType.fromJson(json.loads(found["schema"]))
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{key}/rows"), key

    def place(self, name: str, made_from: Iterable[str], settings: object) -> str:
        """A folder for a stage that keeps its own checkpoints, such as a fit."""
        return f"{self.folder}/{name}-{digest(name, list(made_from), settings)}/own"

    def keys(self) -> list[str]:
        """All stage folders, whole or not."""
        files = self._files()
        if not files.exists(self._path()):
            return []
        return sorted(f.getPath().getName() for f in files.listStatus(self._path()) if f.isDirectory())

    def sweep(self, wanted: Iterable[str] | None = None) -> list[str]:
        """Remove stages without a manifest, and with ``wanted`` all others too; returns what was removed.

        For times when no run is writing: an unfinished stage looks like one that was left behind.
        """
        wanted = None if wanted is None else set(wanted)
        gone = [k for k in self.keys() if (self.manifest(k) is None if wanted is None else k not in wanted)]
        for key in gone:
            self._files().delete(self._path(key), True)
        return gone
