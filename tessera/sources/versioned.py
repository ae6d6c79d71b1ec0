"""Staged tables with a life cycle: whole versions, keyed merges, removal of what is old.

A table is a folder with data folders and manifests.  A version is a manifest: which data folder holds each
bucket (hash of the key) of it.  Writers put data into a folder of their own and publish the manifest last, as
one file, so readers see a version whole or not at all, and a write that fails leaves the version before it.
A merge writes the buckets that its updates touch, and the new manifest points to the old folders for the rest.
:meth:`VersionedTable.clean` removes old manifests and every data folder that no kept manifest names, those of failed
writes too.
"""
from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.update import apply_versions
from tessera.session import checkpoint

BUCKET = "__bucket"
_MANIFEST = "version long, bucket int, folder string"


class VersionedTable:
    """A staged table under ``path``, dealt into ``buckets`` by ``key``.  One writer at a time; any number of readers."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets

    # ---- versions ---------------------------------------------------------
    def _manifests(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifests/*")
        except AnalysisException:
            return None

    def versions(self) -> list[int]:
        """Published versions (one row each)."""
        found = self._manifests()
        return [] if found is None else sorted(r["version"] for r in found.select("version").distinct().collect())

    def _folders(self, version: int | None = None) -> dict[int, str]:
        """Bucket -> data folder of a version (the last one by default): one row a bucket."""
        found = self._manifests()
        if found is None:
            raise ValueError(f"no version is published at {self.path}")
        last = version if version is not None else max(self.versions())
        rows = found.where(F.col("version") == last).collect()
        if not rows:
            raise ValueError(f"version {last} is not published at {self.path}")
        return {r["bucket"]: r["folder"] for r in rows}

    def _publish(self, folders: dict[int, str]) -> int:
        version = max(self.versions(), default=0) + 1
        rows = [(version, b, f) for b, f in sorted(folders.items())]
        # one file: a manifest is there or it is not
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.parquet(f"{self.path}/manifests/{version}")
        return version

    def _write(self, df: DataFrame) -> str:
        folder = f"data/{uuid.uuid4().hex}"
        bucketed = df.withColumn(BUCKET, F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))
        bucketed.repartition(self.buckets, BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        return folder

    # ---- use ----------------------------------------------------------------
    def write(self, df: DataFrame) -> int:
        """A new version that holds ``df``."""
        folder = self._write(df)
        return self._publish({b: folder for b in range(self.buckets)})

    def read(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """A version (the last one by default), or some of its buckets."""
        folders = self._folders(version)
        wanted = folders if buckets is None else {b: folders[b] for b in buckets}
        out = None
        for folder in sorted(set(wanted.values())):  # a folder for each merge since the last whole write
            mine = [b for b, f in wanted.items() if f == folder]
            one = self.spark.read.parquet(f"{self.path}/{folder}").where(F.col(BUCKET).isin(mine)).drop(BUCKET)
            out = one if out is None else out.unionByName(one)
        return out

    def merge(self, updates: DataFrame, version_col: str, cols: Sequence[str], insert: bool = False) -> tuple[int, list[int]]:
        """The last version with ``updates`` applied (:func:`~tessera.operators.update.apply_versions`): the new version, and the
        buckets rewritten."""
        held = checkpoint(updates.where(F.col(self.key).isNotNull()))
        touched = sorted(r[0] for r in held.select(F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")).distinct().collect())
        folders = self._folders()
        if touched:
            folder = self._write(apply_versions(self.read(buckets=touched), held, self.key, version_col, cols, insert))
            folders |= {b: folder for b in touched}
        return self._publish(folders), touched

    # ---- removal --------------------------------------------------------------
    def _files(self, path: str):
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _names(self, path: str) -> list[str]:
        fs, at = self._files(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def _delete(self, path: str) -> None:
        fs, at = self._files(path)
        fs.delete(at, True)

    def clean(self, keep: int = 1) -> None:
        """Remove all but the last ``keep`` versions, and the data that none of them names."""
        kept = self.versions()[-keep:]
        used = {(f, b) for v in kept for b, f in self._folders(v).items()}
        for name in self._names(f"{self.path}/manifests"):
            if not (name.isdigit() and int(name) in kept):
                self._delete(f"{self.path}/manifests/{name}")
        for name in self._names(f"{self.path}/data"):
            folder = f"data/{name}"
            if not any(f == folder for f, _ in used):
                self._delete(f"{self.path}/{folder}")
                continue
            for part in self._names(f"{self.path}/{folder}"):
                if part.startswith(f"{BUCKET}=") and (folder, int(part.split("=")[1])) not in used:
                    self._delete(f"{self.path}/{folder}/{part}")

    def drop(self) -> None:
        """Remove the table."""
        self._delete(self.path)
