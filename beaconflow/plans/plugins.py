"""What an application supplies: parsers, label rules, event rules, business events."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconflow.constants import COOLDOWN_MS, CORRELATION_DELAY_MS
from beaconflow.operators.cooldown import cooldown
from beaconflow.operators.correlate import correlate_sources
from beaconflow.operators.rules import business_projection
from beaconflow.operators.skew import DEFAULT_SKEW, HotKeys, Skew, fits_broadcast
from beaconflow.sources.signals import parse_signals
from beaconflow.sources.sinks import event_messages


class Lookups(dict[str, DataFrame]):
    """Lookup tables by name; each is measured for broadcasting at most once per plan."""

    def __init__(self, tables: dict[str, DataFrame]) -> None:
        super().__init__(tables)
        self._small: dict[str, bool] = {}

    def small(self, name: str) -> bool:
        if name not in self._small:
            self._small[name] = fits_broadcast(self[name])
        return self._small[name]


Parser = Callable[..., DataFrame]

# Parsers by name: lines in, typed records with ``reject_reason`` out.
PARSERS: dict[str, Parser] = {"signals": parse_signals}


def register_parser(name: str, parser: Parser) -> None:
    PARSERS[name] = parser


class LabelRule(Protocol):
    """Adds label columns to records with the help of lookup tables."""

    def apply(self, records: DataFrame, lookups: Lookups) -> DataFrame: ...


@dataclass(frozen=True)
class BusinessEvent:
    """What happens to the rows of an event rule: project, suppress repeats, send.

    ``rules`` names the one rule subscribed to per source. The projection must
    contain the user, time and sequence columns under the given names.
    """

    id: str
    rules: dict[str, str]
    select: list[str]
    user: str = "imsi"
    ts: str = "ts_ms"
    seq: str = "seq"
    interval_ms: int = COOLDOWN_MS
    delay_ms: int = CORRELATION_DELAY_MS
    require_all: bool = False
    key: str | None = None
    delim: str = ","
    output_type: str = "kafka"
    topic: str = ""
    message_columns: list[str] = field(default_factory=list)

    def rows(self, events: dict[str, dict[str, DataFrame]]) -> DataFrame:
        """Projected rows of all sources (``events``: source -> rule -> rows), tagged if several."""
        frames = []
        for source, rule in self.rules.items():
            if rule not in events.get(source, {}):
                raise ValueError(f"business event {self.id}: source {source} has no rule {rule}")
            projected = business_projection(events[source][rule], self.select)
            frames.append(projected.withColumn("source", F.lit(source)))
        out = frames[0]
        for frame in frames[1:]:
            out = out.unionByName(frame)
        return out

    def fired(self, events: dict[str, dict[str, DataFrame]], skew: Skew | HotKeys | None = DEFAULT_SKEW) -> DataFrame:
        rows = self.rows(events)
        if len(self.rules) == 1:
            return cooldown(rows.drop("source"), self.interval_ms, self.user, self.ts, self.seq, skew=skew)
        return correlate_sources(
            rows, list(self.rules), self.interval_ms, self.delay_ms, self.require_all,
            self.user, self.ts, self.seq, skew=skew,
        )

    def keyed_by(self, column: str) -> bool:
        """Whether the event's user and time are simply that record column and ``ts_ms``."""
        user = next((e for e in self.select if alias_of(e) == self.user), "")
        return user.split()[:1] == [column] and len(user.split()) in (1, 3) and self.ts == "ts_ms"

    def columns(self) -> list[str]:
        """Names of the projected columns that go into a message."""
        return self.message_columns or [alias_of(e) for e in self.select]

    def messages(self, fired: DataFrame, sent_at: Column | None = None) -> DataFrame:
        return event_messages(fired, self.columns(), self.key or self.user, self.delim, sent_at)


def alias_of(expression: str) -> str:
    """The column name a projection expression ends in (``... as name`` or a plain column)."""
    return expression.strip().split()[-1].strip("`")
