"""The label rules of a source applied to its records, in batch and in a stream."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconflow.constants import (
    AREA_INFO, AREA_ONSITE, AREA_ONSITE_STAY, EXT_LAST_IMEI, EXT_USERTRACK, USER_INFO,
)
from beaconflow.functions.maps import present_entries
from beaconflow.operators.lookups import label_geo, label_profile, label_site
from beaconflow.operators.skew import DEFAULT_SKEW, HotKeys, Skew, in_parts
from beaconflow.operators.stay import StayConfig, label_stay
from beaconflow.operators.track import last_device, movement, track
from beaconflow.plans.plugins import LabelRule, Lookups
from beaconflow.plans.stateful import StatefulRule, apply_rules, apply_rules_stream, fetch_needs, rule_labels
from beaconflow.streaming.labels import UserLabels, label_users


@dataclass(frozen=True)
class SiteLabels:
    """Areas of the record's cell, from the lookup ``sites``."""

    def apply(self, records: DataFrame, lookups: Lookups) -> DataFrame:
        return label_site(records, lookups["sites"], lookups.small("sites"))


@dataclass(frozen=True)
class ProfileLabels:
    """Profile of both parties, from the lookup ``profiles``."""

    columns: tuple[str, ...]

    def apply(self, records: DataFrame, lookups: Lookups) -> DataFrame:
        return label_profile(records, lookups["profiles"], list(self.columns), small=lookups.small("profiles"))


@dataclass(frozen=True)
class GeoLabels:
    """Coordinates of the record's cell, from the lookup ``sites``; needed for movement."""

    def apply(self, records: DataFrame, lookups: Lookups) -> DataFrame:
        placed = label_geo(records, lookups["sites"], lookups.small("sites"))
        return placed.withColumn("lac_ci", F.concat("lac", "ci"))


@dataclass(frozen=True)
class LabelPlan:
    """Stateless rules in order, then what is remembered per user, by the library and by rules of the application's own."""

    rules: list[LabelRule] = field(default_factory=list)
    stay: StayConfig | None = None
    device: bool = False
    movement: bool = False
    stateful: list[StatefulRule] = field(default_factory=list)

    def stateless(self, records: DataFrame, lookups: dict[str, DataFrame]) -> DataFrame:
        lookups = lookups if isinstance(lookups, Lookups) else Lookups(lookups)
        # Areas and coordinates come from one lookup by one key: joined once if both are asked for.
        kinds = {type(rule) for rule in self.rules}
        once = {SiteLabels, GeoLabels} <= kinds
        for rule in self.rules:
            if not once or not isinstance(rule, (SiteLabels, GeoLabels)):
                records = rule.apply(records, lookups)
            elif AREA_ONSITE not in records.columns:
                joined = label_site(records, lookups["sites"], lookups.small("sites"), geo=True)
                records = joined.withColumn("lac_ci", F.concat("lac", "ci"))
        return records

    def label(self, records: DataFrame, lookups: dict[str, DataFrame], skew: Skew | HotKeys | None = DEFAULT_SKEW) -> DataFrame:
        """Batch: records in time order per user."""
        # One detection, on the bare records, serves all per-user steps.
        if isinstance(skew, Skew):
            skew = HotKeys(records, "imsi", skew)
        out = self.stateless(records, lookups)
        if skew is not None and (self.device or self.movement or self.stay):
            out = in_parts(out, "imsi", skew)
        if self.device and self.movement:
            out = track(out, skew=skew)
        elif self.device:
            out = last_device(out, skew=skew)
        elif self.movement:
            out = movement(out, skew=skew)
        if self.stay:
            out = label_stay(out, self.stay, skew=skew)
        if self.stateful:
            out = apply_rules(fetch_needs(out, self.stateful, lookups), self.stateful, order=("ts_ms", "seq"))
        return with_labels(out, self.stateful)

    def label_stream(self, records: DataFrame, lookups: dict[str, DataFrame]) -> DataFrame:
        """Stream: records in arrival order per user, state carried across micro-batches."""
        out = self.stateless(records, lookups)
        if self.stay or self.device or self.movement:
            out = label_users(out, UserLabels(self.stay, self.device, self.movement))
        if self.stateful:
            out = apply_rules_stream(fetch_needs(out, self.stateful, lookups), self.stateful)
        return with_labels(out, self.stateful)


def with_labels(records: DataFrame, rules: list[StatefulRule] = ()) -> DataFrame:
    """Collect the label columns, and those of stateful rules under their names, into the nested map ``labels``."""
    have = set(records.columns)
    namespaces = {c: F.col(c) for c in (USER_INFO, AREA_ONSITE, AREA_INFO, AREA_ONSITE_STAY) if c in have}
    if "last_imei" in have:
        namespaces[EXT_LAST_IMEI] = present_entries({"imei": F.col("last_imei")})
    if "distance_km" in have:
        namespaces[EXT_USERTRACK] = present_entries(
            {"speed": F.col("speed_kmh"), "distance": F.col("distance_km"), "last_lac_ci": F.col("last_lac_ci")}
        )
    namespaces |= rule_labels(records, list(rules))
    if not namespaces:
        return records
    return records.withColumn("labels", F.create_map(*[x for k, v in namespaces.items() for x in (F.lit(k), v)]))
