"""A lookup table that is read again after a while."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from beaconflow.constants import LOOKUP_TTL_SECONDS
from beaconflow.session import drop_shared, new_shared_path

_LOG = logging.getLogger(__name__)


class RefreshingLookup:
    """The last complete copy of a lookup, loaded anew once it is older than ``ttl``.

    Ask for :meth:`current` inside each micro-batch. A copy is a folder of its
    own in shared storage: it is written whole before it takes the place of the
    old one, so all tasks see one version, and losing an executor loses nothing.
    When loading fails the old copy stays and the next call tries again; only a
    first load that fails is an error. The copy before the current one is kept
    for batches that still read it, older ones are deleted.
    """

    def __init__(
        self,
        load: Callable[[], DataFrame],
        ttl_seconds: float = LOOKUP_TTL_SECONDS,
        clock: Callable[[], float] = time.monotonic,
    ) -> None:
        self._load, self._ttl, self._clock = load, ttl_seconds, clock
        self._table: DataFrame | None = None
        self._loaded_at = 0.0
        self._folders: list[str] = []
        self.versions = 0

    def current(self) -> DataFrame:
        if self._table is None or self._clock() >= self._loaded_at + self._ttl:
            try:
                self._table = self._copy()
                self._loaded_at = self._clock()
                self.versions += 1
            except Exception:
                if self._table is None:
                    raise
                _LOG.exception("the lookup could not be loaded again; the copy before stays in use")
        return self._table

    def _copy(self) -> DataFrame:
        fresh = self._load()
        spark = fresh.sparkSession
        path = new_shared_path(spark, "lookup")
        try:
            fresh.write.parquet(path)
        except Exception:
            drop_shared(spark, path)
            raise
        self._folders.append(path)
        while len(self._folders) > 2:
            drop_shared(spark, self._folders.pop(0))
        return spark.read.schema(fresh.schema).parquet(path)

    def close(self) -> None:
        if self._table is not None:
            for path in self._folders:
                drop_shared(self._table.sparkSession, path)
            self._folders, self._table = [], None
