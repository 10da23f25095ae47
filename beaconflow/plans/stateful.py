"""Label rules with a state of their own, and the lookups that rules ask for.

A rule says what it remembers of a user and how a run of the user's records,
in order, changes that. The same rule runs in a stream, where each rule has a
named state, and in a batch, where sorted records stream through the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from beaconflow.operators.lookups import needed_keys
from beaconflow.operators.skew import lookup_join
from beaconflow.plans.plugins import Lookups
from beaconflow.streaming.events import ROCKSDB


@dataclass(frozen=True)
class Need:
    """What a rule looks up: ``columns`` of the lookup ``table`` whose ``on`` equals the record's ``key`` (SQL text).

    They come as ``<table>__<column>``; rules with the same need share one join.
    """

    table: str
    key: str
    on: str
    columns: tuple[str, ...]


class StatefulRule(Protocol):
    """A label rule that remembers something of each user.

    ``state`` and ``outputs`` are schemas as DDL, ``inputs`` the record columns
    it reads (those of its ``needs`` among them). ``step`` gets the state (a
    tuple, ``None`` for a new user) and a run of records in order, and returns
    the state after them and a frame of outputs, a row for each record. Any cut
    of a user's records into runs must give the same outputs.
    """

    name: str
    inputs: list[str]
    state: str
    outputs: str
    needs: list[Need]

    def step(self, state: tuple | None, rows: pd.DataFrame) -> tuple[tuple, pd.DataFrame]: ...


def fetch_needs(records: DataFrame, rules: list[StatefulRule], lookups: dict[str, DataFrame]) -> DataFrame:
    """Add what the rules look up: one join for each distinct key of a table, whatever the number of rules.

    In a batch the table is first cut down to the keys that any record needs;
    a stream joins each micro-batch with the table itself. Records without a
    partner get nulls.
    """
    lookups = lookups if isinstance(lookups, Lookups) else Lookups(lookups)
    wanted: dict[tuple[str, str, str], list[str]] = {}
    for rule in rules:
        for need in rule.needs:
            have = wanted.setdefault((need.table, need.key, need.on), [])
            have += [c for c in need.columns if c not in have]
    tables = {}
    for table, _, on in wanted:
        side = lookups[table]
        if not records.isStreaming and not lookups.small(table):
            side = needed_keys(records, [F.expr(k) for t, k, o in wanted if (t, o) == (table, on)], side, on)
        tables[table, on] = side
    taken: set[str] = set(records.columns)
    for (table, key, on), columns in wanted.items():
        names = {c: f"{table}__{c}" for c in columns}
        if clash := taken & set(names.values()):
            raise ValueError(f"columns {sorted(clash)} are looked up by more than one key")
        taken |= set(names.values())
        side = tables[table, on].select(F.col(on).alias("__need"), *[F.col(c).alias(n) for c, n in names.items()]).dropDuplicates(["__need"])
        records = lookup_join(records.withColumn("__need", F.expr(key)), side, "__need", small=lookups.small(table)).drop("__need")
    return records


def _kinds(rule: StatefulRule) -> T.StructType:
    return T.StructType.fromDDL(rule.outputs)


def _schema(records: DataFrame, rules: list[StatefulRule]) -> T.StructType:
    names = [f.name for r in rules for f in _kinds(r)]
    if len(set(names)) < len(names) or set(names) & set(records.columns):
        raise ValueError("rules have outputs of the same name, or of a record column's")
    return T.StructType([*records.schema.fields, *[f for r in rules for f in _kinds(r)]])


def _outputs(rules: list[StatefulRule]) -> list[list[str]]:
    """The names of each rule's outputs; read by the driver, as tasks cannot parse DDL."""
    return [_kinds(r).names for r in rules]


def _stepped(
    rules: list[StatefulRule], outputs: list[list[str]], states: list[tuple | None], rows: pd.DataFrame
) -> tuple[list[tuple], pd.DataFrame]:
    """All rules on one run of a user's records."""
    after, out = [], rows
    for rule, names, state in zip(rules, outputs, states, strict=True):
        new, made = rule.step(state, rows[rule.inputs])
        if len(made) != len(rows):
            raise ValueError(f"rule {rule.name} gave {len(made)} rows for {len(rows)}")
        after.append(tuple(new))
        out = out.assign(**{c: made[c].to_numpy() for c in names})
    return after, out


def _plain(records: DataFrame) -> tuple[DataFrame, dict[str, T.DataType]]:
    """Maps do not travel to Python; they pass as JSON and come back unchanged."""
    maps = {f.name: f.dataType for f in records.schema if isinstance(f.dataType, T.MapType)}
    return records.withColumns({c: F.to_json(c) for c in maps}), maps


def apply_rules(records: DataFrame, rules: list[StatefulRule], user: str = "imsi", order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Batch: the outputs of the rules added to all records, per user in the order of ``order``.

    Records are hashed by user and sorted, and stream through the tasks a batch
    at a time: a task holds one batch and one user's states. Arbitrary state
    has no other order than one record after the other, so a user's records
    pass through one task, however many; give rules that windows can express
    as stateless ones. Records without a user are one user.
    """
    if not rules:
        return records
    plain, maps = _plain(records)
    schema, outputs = _schema(plain, rules), _outputs(rules)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, states = object(), []
        for batch in batches:
            keys = batch[user].astype(object).where(batch[user].notna(), None)
            cut = (keys != keys.shift()) & ~(keys.isna() & keys.shift().isna())
            if len(cut):
                cut.iloc[0] = True
            for _, rows in batch.groupby(cut.cumsum().to_numpy(), sort=False):
                key = keys.loc[rows.index[0]]
                if key != last:
                    last, states = key, [None] * len(rules)
                states, out = _stepped(rules, outputs, states, rows)
                yield out

    out = plain.repartition(user).sortWithinPartitions(user, *order).mapInPandas(run, schema)
    return out.withColumns({c: F.from_json(c, kind) for c, kind in maps.items()})


@dataclass
class _RuleProcessor(StatefulProcessor):
    """One user's states, each under the name of its rule; a timer frees them."""

    rules: list[StatefulRule]
    outputs: list[list[str]]
    order: list[str]
    ts: str
    forget_ms: int | None = None
    states: list = field(default_factory=list)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.states = [handle.getValueState(r.name, r.state) for r in self.rules]
        self.until = handle.getValueState("__until", "at long") if self.forget_ms else None

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        run = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        before = [s.get() if s.exists() else None for s in self.states]
        after, out = _stepped(self.rules, self.outputs, before, run)
        for state, value in zip(self.states, after, strict=True):
            state.update(value)
        if self.forget_ms:
            old = self.until.get()[0] if self.until.exists() else None
            newest = run[self.ts].max()
            at = max(int(newest) if pd.notna(newest) else 0, timerValues.getCurrentWatermarkInMs()) + self.forget_ms
            if old is None or at > old:
                if old is not None:
                    self.handle.deleteTimer(old)
                self.handle.registerTimer(at)
                self.until.update((at,))
        yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for state in [*self.states, self.until]:
            state.clear()
        yield from ()

    def close(self) -> None:
        pass


def apply_rules_stream(
    records: DataFrame,
    rules: list[StatefulRule],
    user: str = "imsi",
    order: tuple[str, ...] = ("seq",),
    ts: str = "ts_ms",
    forget_ms: int | None = None,
) -> DataFrame:
    """Stream: the same, with one named state per rule and user carried across micro-batches.

    ``forget_ms`` frees a user's states once the watermark, which the stream
    must then carry, is so far past the user's newest record: the user is new
    after that.
    """
    if not rules:
        return records
    records.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    plain, maps = _plain(records)
    processor = _RuleProcessor(rules, _outputs(rules), list(order), ts, forget_ms)
    mode = "EventTime" if forget_ms else "None"
    out = plain.groupBy(user).transformWithStateInPandas(processor, _schema(plain, rules), "Append", mode)
    return out.withColumns({c: F.from_json(c, kind) for c, kind in maps.items()})


def rule_labels(records: DataFrame, rules: list[StatefulRule]) -> dict[str, Column]:
    """The outputs of each rule as a map of texts, by the rule's name; nulls have no entry."""
    from beaconflow.functions.maps import present_entries

    return {r.name: present_entries({f.name: F.col(f.name).cast("string") for f in _kinds(r)}) for r in rules}
