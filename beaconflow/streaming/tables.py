"""Streams that read a table and write it back: running counters, change feeds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from beaconflow.operators.aggregates import accumulate_to_table, stored_totals
from beaconflow.operators.bucketed import BucketedTable
from beaconflow.operators.registers import compacted, merge_registers
from beaconflow.session import shared_table
from beaconflow.streaming.runner import BatchHandler

def accumulate(key: str, seq: str, measures: list[str], totals: BucketedTable, out: str) -> BatchHandler:
    """Write each row with the counters after it, and the counters after each micro-batch.

    ``totals`` is a bucketed table by ``key`` with one column per measure. A
    batch reads and rewrites the buckets of its own keys only. A retried batch
    sees the counters before it, unless they are stored already: then its rows
    are, too.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        now = totals.manifest()
        if now.batch is not None and batch_id <= now.batch:
            return
        before = totals.read(totals.touched(batch, now), now)
        accumulate_to_table(batch, key, seq, measures, before).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        sums = stored_totals(batch, key, measures)
        totals.update(sums, lambda old, new: stored_totals(new, key, measures, old), batch_id)

    return handle


def apply_feed(state: BucketedTable, prepare: Callable[[DataFrame], DataFrame]) -> BatchHandler:
    """Merge each micro-batch of a change feed into a bucketed table of registers.

    ``prepare`` makes a state of a batch, as ``change_state`` does; the table
    is one by ``hash_key``, so that a record's tombstone meets its fields. One
    record that holds the whole table (``onehash``) is better keyed by
    (hash_key, field), as its deletes name fields. Batches may come in any
    order and more than once.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        changes = shared_table(merge_registers(prepare(batch)), "register_changes")
        state.update(changes, lambda old, new: compacted(merge_registers(old, new)), batch_id)

    return handle
