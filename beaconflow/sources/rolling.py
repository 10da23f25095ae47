"""A rolling archive: small files of micro-batches packed up to a bound of bytes or age."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconflow.sources import shared_files as S


@dataclass(frozen=True)
class Roll:
    """The archive after a batch: ``packs`` are finished; files in ``packed`` are in them already; ``since`` is when open ones arrived."""

    number: int = 0
    batch: int | None = None
    packs: int = 0
    packed: list[str] = field(default_factory=list)
    since: dict[str, float] = field(default_factory=dict)


class RollingArchive:
    """Lines in the order of their batches, in files of at most ``max_bytes``.

    A batch is written as small files below ``incoming``; as soon as they fill
    a pack, or the oldest is ``max_age_seconds`` old, they become one file
    below ``packs``. A manifest of fixed size, swapped whole, says how many
    packs count and which small files they hold, so each line is read once
    whatever was interrupted. One small file larger than the bound is a pack of
    its own: bound it by the source's limits for a batch.
    """

    def __init__(
        self, spark: SparkSession, path: str, max_bytes: int = 256 << 20, max_age_seconds: float = 3600.0,
        clock: Callable[[], float] = time.time,
    ) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._bytes, self._age, self._clock = max_bytes, max_age_seconds, clock

    def state(self) -> Roll:
        number = S.newest(self.spark, f"{self.path}/manifest")
        return Roll() if number is None else Roll(**json.loads(S.read_text(self.spark, f"{self.path}/manifest/{number}.json")))

    def take(self, batch: DataFrame, batch_id: int) -> None:
        """A handler of micro-batches: archives the column ``value``. A batch that comes again changes nothing."""
        now = self.state()
        if now.batch is not None and batch_id <= now.batch:
            return
        batch.select("value").write.mode("overwrite").text(f"{self.path}/incoming/batch={batch_id:012d}")
        self._roll(now, batch_id)

    def close(self) -> None:
        """Pack what is left, whatever its size."""
        now = self.state()
        self._roll(now, now.batch, last=True)

    def files(self) -> list[tuple[str, int]]:
        """(path, bytes) of the finished packs."""
        packs = [f"{self.path}/packs/pack={k:012d}" for k in range(self.state().packs)]
        return [(f"{p}/{n}", size) for p in packs for n, size in S.sizes(self.spark, p) if n.startswith("part-")]

    def read(self) -> DataFrame:
        """All lines archived so far, packed or not."""
        now = self.state()
        paths = [p for p, _ in self.files()] + [f"{self.path}/incoming/{f}" for f, _ in self._open(now, now.batch)]
        if not paths:
            return self.spark.createDataFrame([], "value string")
        return self.spark.read.text(paths)

    def _open(self, now: Roll, through: int | None) -> list[tuple[str, int]]:
        """(batch folder and file, bytes) of small files in no pack, of batches up to ``through``, in order."""
        done, out = set(now.packed), []
        for folder in S.names(self.spark, f"{self.path}/incoming"):
            if through is None or int(folder.removeprefix("batch=")) > through:
                continue
            files = S.sizes(self.spark, f"{self.path}/incoming/{folder}")
            out += [(f"{folder}/{n}", size) for n, size in files if n.startswith("part-") and size and f"{folder}/{n}" not in done]
        return out

    def _roll(self, now: Roll, batch_id: int | None, last: bool = False) -> None:
        for name in now.packed:  # left over by a writer that stopped between its manifest and this
            S.delete(self.spark, f"{self.path}/incoming/{name}")
        waiting, since = self._open(now, batch_id), {}
        packs: list[list[str]] = []
        size = 0
        for name, own in waiting:
            since[name] = now.since.get(name, self._clock())
            if not packs or size + own > self._bytes:
                packs.append([])
                size = 0
            packs[-1].append(name)
            size += own
        full = len(packs) if last or size >= self._bytes or (packs and self._clock() - since[packs[-1][0]] >= self._age) else max(0, len(packs) - 1)
        closed = packs[:full]
        if closed:
            self._write(closed, now.packs)
        packed = [name for pack in closed for name in pack]
        left = {name: t for name, t in since.items() if name not in set(packed)}
        after = Roll(now.number + 1, batch_id, now.packs + full, packed, left)
        if not S.put_new_text(self.spark, f"{self.path}/manifest/{after.number}.json", json.dumps(asdict(after))):
            raise RuntimeError(f"{self.path} has another writer")
        for name in packed:
            S.delete(self.spark, f"{self.path}/incoming/{name}")
        if now.number > 1:
            S.delete(self.spark, f"{self.path}/manifest/{now.number - 1}.json")

    def _write(self, packs: list[list[str]], first: int) -> None:
        """One file per pack, the lines in the order of its small files; all packs in one job."""
        rank = [(name, first + k, i) for k, pack in enumerate(packs) for i, name in enumerate(pack)]
        places = self.spark.createDataFrame(rank, "name string, pack long, place int")
        lines = self.spark.read.text([f"{self.path}/incoming/{name}" for name, _, _ in rank])
        name = F.regexp_extract("_metadata.file_path", r"(batch=\d+/[^/]+)$", 1)
        order = (F.col("_metadata.file_block_start").alias("begin"), F.monotonically_increasing_id().alias("line"))
        placed = lines.select("value", name.alias("name"), *order).join(F.broadcast(places), "name")
        placed = placed.withColumn("pack", F.lpad(F.col("pack").cast("string"), 12, "0"))
        sorted_ = placed.repartition("pack").sortWithinPartitions("pack", "place", "begin", "line")
        for number in range(first, first + len(packs)):
            S.delete(self.spark, f"{self.path}/packs/pack={number:012d}")  # of a writer that stopped before its manifest
        sorted_.select("value", "pack").write.mode("append").partitionBy("pack").text(f"{self.path}/packs")
