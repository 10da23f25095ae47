"""An application: sources, label rules, event rules and business events put together."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from beaconflow.constants import COOLDOWN_MS, CORRELATION_DELAY_MS, STAY_TIMEOUT_MS
from beaconflow.functions.text import joined_message
from beaconflow.functions.times import SIGNAL_TIME
from beaconflow.operators.rules import EventRule, event_rule_flags, event_rule_tree, ordered_rules, split_expressions, time_of_day_gate
from beaconflow.operators.skew import DEFAULT_SKEW, HotKeys, Skew
from beaconflow.operators.stay import StayConfig
from beaconflow.plans.catalogue import Catalogue
from beaconflow.plans.labelling import GeoLabels, LabelPlan, ProfileLabels, SiteLabels
from beaconflow.plans.plugins import PARSERS, BusinessEvent, Lookups, alias_of
from beaconflow.session import shared_table
from beaconflow.sources.sinks import check_output_type, publish_events
from beaconflow.sources.streams import open_stream
from beaconflow.streaming.events import EventTerms, business_events_stream
from beaconflow.streaming.runner import BatchHandler, start_batches


@dataclass(frozen=True)
class SourcePlan:
    """One source: how to read and parse it, its labels and its rules."""

    id: str
    kind: str
    conf: dict[str, str]
    parser: str = "signals"
    layout: int = 17
    delim: str = ","
    validity_ms: int = -1
    labels: LabelPlan = field(default_factory=LabelPlan)
    rules: list[EventRule] = field(default_factory=list)

    def open(self, spark: SparkSession) -> DataFrame:
        return open_stream(spark, self.kind, self.conf)

    def records(self, lines: DataFrame, now: Column | None = None) -> DataFrame:
        parsed = PARSERS[self.parser](
            lines, layout=self.layout, delim=self.delim, validity_ms=self.validity_ms, now=now
        )
        good = parsed.where("reject_reason is null").drop("reject_reason", "value")
        return good.withColumn("ts_ms", F.unix_millis("ts"))

    def event_rows(
        self, lines: DataFrame, lookups: Lookups, subscribers: list[BusinessEvent], now: Column | None = None
    ) -> DataFrame:
        """Stream: one row per record and subscribed business event, all from one pass."""
        labelled = self.labels.label_stream(self.records(lines, now), lookups)
        flagged = event_rule_flags(labelled, self.rules, "__rule_")
        offers = []
        for b in subscribers:
            row = F.struct(F.lit(b.id).alias("event"), *_message(b))
            offers.append(F.when(F.col(f"__rule_{b.rules[self.id]}"), row))
        return flagged.select(
            F.inline(F.filter(F.array(*offers), lambda o: o.isNotNull())),
            "ts_ms",
            "seq",
            F.lit(self.id).alias("source"),
        )


def _message(event: BusinessEvent) -> list[Column]:
    """User, message key and message body of a business event, straight from a record."""
    by_name = {alias_of(e): F.expr(e) for e in event.select}
    body = joined_message([by_name[c] for c in event.columns()], event.delim)
    return [
        by_name[event.user].cast("string").alias("user"),
        by_name[event.key or event.user].cast("string").alias("key"),
        body.alias("body"),
        F.lit(event.topic).alias("topic"),
    ]


@dataclass(frozen=True)
class Application:
    sources: list[SourcePlan]
    business_events: list[BusinessEvent]

    def fired(
        self,
        lines: dict[str, DataFrame],
        lookups: Lookups,
        now: Column | None = None,
        skew: Skew | None = DEFAULT_SKEW,
    ) -> dict[str, DataFrame]:
        """Batch: the rows each business event fires, by its id.

        ``lines`` need a ``seq`` column. Labels read more than once, by several
        business events or to find hot keys other than the record's own, are
        computed once and kept as a table in the shared folder.
        """
        events, records = {}, {}
        hot: dict[str, Skew | HotKeys | None] = {}
        for source in self.sources:
            subscribers = [b for b in self.business_events if source.id in b.rules]
            if source.id not in lines or not subscribers:
                continue
            records[source.id] = bare = source.records(lines[source.id], now)
            hot[source.id] = None if skew is None else HotKeys(bare, "imsi", skew)
            labelled = source.labels.label(bare, lookups, hot[source.id])
            own_keys = all(b.keyed_by("imsi") for b in subscribers)
            if len(subscribers) > 1 or not (own_keys or skew is None):
                labelled = shared_table(labelled, "labelled")
            events[source.id] = event_rule_tree(labelled, source.rules)
        return {b.id: b.fired(events, self._hot_users(b, records, hot, skew)) for b in self.business_events}

    @staticmethod
    def _hot_users(
        event: BusinessEvent,
        records: dict[str, DataFrame],
        hot: dict[str, Skew | HotKeys | None],
        skew: Skew | None,
    ) -> Skew | HotKeys | None:
        """Hot users known from the bare records, where the event's user is the record's."""
        if skew is None or not event.keyed_by("imsi"):
            return skew
        if len(event.rules) == 1:
            return hot.get(*event.rules)
        slim = [records[s].select("imsi", "ts_ms") for s in event.rules if s in records]
        return HotKeys(reduce(DataFrame.unionByName, slim), "imsi", skew)

    def messages_stream(
        self, lines: dict[str, DataFrame], lookups: Lookups, now: Column | None = None, sent_at: Column | None = None
    ) -> DataFrame:
        """Stream: topic, key and value of everything that fires, over all sources and business events."""
        frames = []
        for source in self.sources:
            subscribers = [b for b in self.business_events if source.id in b.rules]
            if source.id in lines and subscribers:
                # A micro-batch may come in one file: its lines are parsed and labelled by all tasks, not by the one that reads it.
                spread = lines[source.id].repartition(lines[source.id].sparkSession.sparkContext.defaultParallelism, "seq")
                frames.append(source.event_rows(spread, lookups, subscribers, now))
        rows = reduce(DataFrame.unionByName, frames)
        terms = {
            b.id: EventTerms(tuple(b.rules), b.interval_ms, b.delay_ms, b.require_all) for b in self.business_events
        }
        fired = business_events_stream(rows, terms)
        moment = F.date_format(F.current_timestamp() if sent_at is None else sent_at, SIGNAL_TIME)
        return fired.select("event", "topic", "key", F.concat("body", F.lit(","), moment).alias("value"))


    def start(
        self,
        spark: SparkSession,
        lookups: Lookups,
        checkpoint: str,
        brokers: str = "",
        deliver: BatchHandler | None = None,
        gate: tuple[str, str] | None = None,
        interval_seconds: float | None = None,
        now: Column | None = None,
        sent_at: Column | None = None,
    ) -> StreamingQuery:
        """Open all sources and send what fires, as one running query.

        Each message goes to the topic of its business event; a sink that an
        event asks for and that there is not is an error before anything is
        read. ``deliver`` takes the micro-batches instead of Kafka at
        ``brokers``; ``gate`` lets only records through that come between
        two times of the day.
        """
        for event in self.business_events:
            check_output_type(event.output_type)
        lines = {s.id: s.open(spark) for s in self.sources if any(s.id in b.rules for b in self.business_events)}
        if gate:
            # The time of a micro-batch is the same for all its records. What is turned away here never
            # reaches any state; a batch must not be skipped later, or its state would be left open.
            lines = {k: time_of_day_gate(df.withColumn("__now", F.current_timestamp()), *gate, "__now").drop("__now") for k, df in lines.items()}
        messages = self.messages_stream(lines, lookups, now, sent_at)

        def publish(batch: DataFrame, batch_id: int) -> None:
            publish_events(batch.select("topic", "key", "value"), "kafka", None, brokers)

        return start_batches(messages, deliver or publish, checkpoint, interval_seconds=interval_seconds)


def build_application(catalogue: Catalogue, rule_kinds: dict[str, str], parsers: dict[str, str]) -> Application:
    """The application a catalogue describes.

    The catalogue is configuration and is read to the driver. ``rule_kinds``
    maps the ``classname`` of a label rule to ``site``, ``profile``, ``geo``,
    ``stay``, ``device`` or ``movement``; ``parsers`` that of a source to a
    registered parser.
    """
    rules: dict[str, list[EventRule]] = {}
    rule_source: dict[str, str] = {}
    for r in catalogue.event_rules.collect():
        parent = str(r["parentEventRuleId"])
        rules.setdefault(str(r["esourceid"]), []).append(
            EventRule(str(r["id"]), r["properties"]["filterExp"], None if parent in ("-1", "", "None") else parent)
        )
        rule_source[str(r["id"])] = str(r["esourceid"])
    labels: dict[str, list] = {}
    for r in catalogue.label_rules.collect():
        labels.setdefault(str(r["esourceid"]), []).append((rule_kinds[r["classname"]], r["properties"]))
    sources = []
    for s in catalogue.sources.collect():
        sid = str(s["id"])
        ordered_rules(rules.get(sid, []))
        sources.append(
            SourcePlan(
                sid, s["type"], dict(s["properties"]), parsers[s["classname"]], int(s["formatlength"]), s["delim"],
                int(s["validWindowsTimeMs"]), _label_plan(labels.get(sid, [])), rules.get(sid, []),
            )
        )
    links: dict[str, list[str]] = {}
    for link in catalogue.event_rule_links.collect():
        links.setdefault(str(link["beid"]), []).append(str(link["erid"]))
    members: dict[str, set[str]] = {}
    for link in catalogue.event_source_links.collect():
        members.setdefault(str(link["beid"]), set()).add(str(link["esid"]))
    events = [
        _business_event(str(b["id"]), b["properties"], links.get(str(b["id"]), []), rule_source, members)
        for b in catalogue.business_events.collect()
    ]
    return Application(sources, events)


def _label_plan(configured: list[tuple[str, dict[str, str]]]) -> LabelPlan:
    """Rules in catalogue order; what needs the areas or coordinates follows them anyway."""
    stateless, stay, kinds = [], None, [k for k, _ in configured]
    for kind, props in configured:
        if kind == "site":
            stateless.append(SiteLabels())
        elif kind == "profile":
            stateless.append(ProfileLabels(tuple(c.strip() for c in props["user_info_cols"].split(","))))
        elif kind == "geo" or (kind == "movement" and "geo" not in kinds):
            stateless.append(GeoLabels())
        elif kind == "stay":
            stay = StayConfig(
                tuple(int(x) for x in props["stay.limits"].split(",")),
                props.get("stay.matchMax", "true") == "true",
                props.get("stay.outputThreshold", "true") == "true",
                int(props.get("stay.timeout", STAY_TIMEOUT_MS)),
            )
    return LabelPlan(stateless, stay, "device" in kinds, "movement" in kinds)


def _business_event(
    beid: str, props: dict[str, str], linked: list[str], rule_source: dict[str, str], members: dict[str, set[str]]
) -> BusinessEvent:
    by_source: dict[str, str] = {}
    for rule in linked:
        source = rule_source.get(rule)
        if source is None or source not in members.get(beid, set()):
            continue
        if source in by_source:
            raise ValueError(f"business event {beid} has more than one rule on source {source}")
        by_source[source] = rule
    if not by_source:
        raise ValueError(f"business event {beid} has no enabled rule on an enabled source")
    # Position i of the configured list becomes the column c<i>.
    wanted = split_expressions(props["selectExp"])
    columns = [f"c{i}" for i in range(len(wanted))]
    select = [f"{e} as {c}" for e, c in zip(wanted, columns)] + ["ts_ms", "seq"]
    return BusinessEvent(
        beid, by_source, select,
        user=columns[int(props["userKeyIdx"])],
        interval_ms=int(props.get("interval", COOLDOWN_MS)),
        delay_ms=int(props.get("delaytime", CORRELATION_DELAY_MS)),
        key=columns[int(props["kafkakeycol"])],
        delim=props["delim"],
        output_type=props["outputtype"],
        topic=props["output_topic"],
        message_columns=columns,
    )
