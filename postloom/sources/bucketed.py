"""Keyed state in hash buckets: a batch rewrites only the buckets that its keys fall into.

A state is a folder with one Parquet folder for each version of a bucket, and a manifest for each
version of the state: a small table that names the folder of every bucket. Writing a version
leaves all earlier ones as they are; it exists once its manifest does, which is one new folder
that is written last. Readers follow the newest whole manifest, so they see the version before
or the new one, never a mixture, and a run that dies in between changes nothing.

    <root>/data/<run>/bucket=<n>/...   rows of the buckets that a run touched
    <root>/manifest/version=<n>/...    (bucket, path) of every bucket

Writers are expected one at a time, as with any state that a scheduled job merges into.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.operators.merge import merge_seen
from postloom.sources.readers import read_json, read_parquet

BUCKET, VERSION = "bucket", "version"
_MANIFEST = f"{BUCKET} int, path string, {VERSION} long"
_NONE = -1  # the entry that every manifest has, also that of an empty state


@dataclass(frozen=True)
class BucketedState:
    """State under ``root`` by the hash of ``keys``; the number of buckets never changes."""

    spark: SparkSession
    root: str
    schema: T.StructType
    keys: tuple[str, ...]
    buckets: int = 64

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _manifests(self) -> DataFrame:
        return read_json(self.spark, f"{self.root}/manifest", _MANIFEST)

    def version(self) -> int:
        """Number of the newest version; -1 if there is none."""
        newest = self._manifests().agg(F.max(VERSION)).first()[0]
        return -1 if newest is None else newest

    def manifest(self, version: int | None = None) -> dict[int, str]:
        """Folder of every bucket that has rows; at most one entry a bucket."""
        version = self.version() if version is None else version
        rows = self._manifests().where(F.col(VERSION) == version).collect()
        return {r[BUCKET]: r.path for r in rows if r[BUCKET] != _NONE}

    def read(self, version: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """Rows of a version (the newest by default), of some buckets or all."""
        paths = sorted(p for b, p in self.manifest(version).items() if only is None or b in only)
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def replace(self, rows: DataFrame, touched: Sequence[int]) -> int:
        """New version in which the touched buckets hold ``rows`` and the others stay."""
        version = self.version()
        base = f"{self.root}/data/{version + 1:08d}-{uuid.uuid4().hex}"
        columns = [f.name for f in self.schema]
        placed = rows.select(*columns).withColumn(BUCKET, self.bucket_of())
        # a bucket is written by as many tasks as its rows need, not by one
        placed.write.partitionBy(BUCKET).parquet(base)
        listed = read_parquet(self.spark, base, f"{BUCKET} int").distinct().collect()
        written = {r[BUCKET]: f"{base}/{BUCKET}={r[BUCKET]}" for r in listed}
        kept = {b: p for b, p in self.manifest(version).items() if b not in set(touched)}
        entries = sorted(({_NONE: ""} | kept | written).items())
        # the version exists once this one file does
        self.spark.createDataFrame(entries, f"{BUCKET} int, path string").coalesce(1).write.json(
            f"{self.root}/manifest/{VERSION}={version + 1}")
        return version + 1

    def merge(self, batch: DataFrame, now: Column, order: Sequence[str]) -> int:
        """Upsert of a batch with first and last seen times, see operators.merge.

        Only the buckets of the batch's keys are read, joined and written.
        """
        found = batch.select(self.bucket_of().alias(BUCKET)).distinct().collect()
        touched = sorted(r[BUCKET] for r in found)  # one number for each bucket at most
        if not touched:
            return self.version()
        merged = merge_seen(self.read(only=touched), batch, self.keys, now, order)
        return self.replace(merged.drop("change"), touched)
