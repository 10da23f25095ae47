"""A table in hash buckets with a manifest of bucket versions.

``<path>/data/<version>/bucket=<b>`` holds a bucket as one version wrote it;
``<path>/manifest/<n>.json`` names the version of every bucket. A change reads
and rewrites the buckets that it touches and nothing else; writing the next
manifest, one small file, makes all of them visible at once. Readers see one
manifest or the next, never a mixture, and a writer that died leaves files that
nobody reads.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconflow.sources import shared_files as S

#: Column that a written row lies in the folder of.
BUCKET = "bucket"

Merge = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass(frozen=True)
class Manifest:
    """``folders`` of the buckets that have rows, the last ``batch`` applied, the table's number of ``buckets`` and ``keys``."""

    number: int
    buckets: int
    keys: list[str]
    schema: str
    batch: int | None = None
    folders: dict[int, str] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({**self.__dict__, "folders": {str(b): f for b, f in self.folders.items()}})

    @staticmethod
    def parse(text: str) -> Manifest:
        raw = json.loads(text)
        return Manifest(**{**raw, "folders": {int(b): f for b, f in raw["folders"].items()}})


class BucketedTable:
    """A keyed table that changes bucket by bucket.

    ``buckets`` is chosen when the table is made: table bytes over some 200 MB,
    as each bucket is rewritten by one task. The manifest has one entry for
    each, which is all that the driver holds.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @staticmethod
    def create(rows: DataFrame, path: str, keys: list[str], buckets: int = 64) -> BucketedTable:
        """The table with these rows (none is fine; null keys have a bucket too) as manifest 0."""
        if BUCKET in rows.columns:
            raise ValueError(f"a bucketed table has no column {BUCKET!r} of its own")
        table = BucketedTable(rows.sparkSession, path)
        empty = Manifest(0, buckets, keys, rows.schema.json())
        folders = table._written(rows, empty)
        table._commit(Manifest(0, buckets, keys, rows.schema.json(), None, folders))
        return table

    def manifest(self) -> Manifest:
        number = S.newest(self.spark, f"{self.path}/manifest")
        if number is None:
            raise FileNotFoundError(f"{self.path} has no manifest")
        return self._parsed(number)

    def _parsed(self, number: int) -> Manifest:
        return Manifest.parse(S.read_text(self.spark, f"{self.path}/manifest/{number}.json"))

    def read(self, touched: list[int] | None = None, manifest: Manifest | None = None) -> DataFrame:
        """All rows, or those of some buckets."""
        now = manifest or self.manifest()
        folders = [f"{self.path}/data/{f}" for b, f in sorted(now.folders.items()) if touched is None or b in touched]
        schema = T.StructType.fromJson(json.loads(now.schema))
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def bucket(self, now: Manifest | None = None) -> Column:
        now = now or self.manifest()
        return F.pmod(F.xxhash64(*now.keys), F.lit(now.buckets)).cast("int")

    def touched(self, rows: DataFrame, now: Manifest | None = None) -> list[int]:
        """The buckets of these rows' keys: as many numbers as there are buckets at most."""
        return sorted(r[0] for r in rows.select(self.bucket(now)).distinct().collect())

    def update(self, changes: DataFrame, merge: Merge, batch: int | None = None) -> list[int]:
        """Replace the touched buckets by ``merge(their rows, changes)``; returns their numbers.

        ``changes`` has the key columns and is read twice. A ``batch`` that the
        table has already applied changes nothing, so a retried micro-batch is
        applied once. ``merge`` must keep rows in their buckets, that is, keep
        the keys of what it returns among those of its arguments.
        """
        now = self.manifest()
        if batch is not None and now.batch is not None and batch <= now.batch:
            return []
        touched = self.touched(changes, now)
        folders = dict(now.folders)
        if touched:
            after = merge(self.read(touched, now), changes)
            fresh = self._written(after, now)
            folders = {b: f for b, f in folders.items() if b not in touched} | fresh
        self._commit(Manifest(now.number + 1, now.buckets, now.keys, now.schema, now.batch if batch is None else batch, folders))
        return touched

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete the manifests before the last ``keep`` and the bucket folders that none of those names; returns these."""
        numbers = sorted(int(n.removesuffix(".json")) for n in S.names(self.spark, f"{self.path}/manifest") if n.endswith(".json"))
        needed = {folder for n in numbers[-keep:] for folder in self._parsed(n).folders.values()}
        for n in numbers[:-keep]:
            S.delete(self.spark, f"{self.path}/manifest/{n}.json")
        unused = []
        for version in S.names(self.spark, f"{self.path}/data"):
            folders = S.names(self.spark, f"{self.path}/data/{version}")
            unused += [f"{version}/{b}" for b in folders if b.startswith(f"{BUCKET}=") and f"{version}/{b}" not in needed]
        for folder in unused:
            S.delete(self.spark, f"{self.path}/data/{folder}")
        return unused

    def _written(self, rows: DataFrame, now: Manifest) -> dict[int, str]:
        version = f"{now.number + 1:012d}-{uuid.uuid4().hex}"
        placed = rows.withColumn(BUCKET, self.bucket(now)).repartition(BUCKET)
        placed.write.partitionBy(BUCKET).parquet(f"{self.path}/data/{version}")
        names = [n for n in S.names(self.spark, f"{self.path}/data/{version}") if n.startswith(f"{BUCKET}=")]
        return {int(n.removeprefix(f"{BUCKET}=")): f"{version}/{n}" for n in names}

    def _commit(self, manifest: Manifest) -> None:
        """The manifest appears whole under its number, or not at all if another writer was first."""
        if not S.put_new_text(self.spark, f"{self.path}/manifest/{manifest.number}.json", manifest.text()):
            raise RuntimeError(f"manifest {manifest.number} of {self.path} was written by another writer")
