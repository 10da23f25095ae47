"""Event rules, rule trees and the projections of business events."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ROOTS = ("-1", "", None)


@dataclass(frozen=True)
class EventRule:
    """A named predicate (SQL text); a rule with a parent only sees the parent's rows."""

    id: str
    predicate: str
    parent: str | None = None

    @property
    def is_root(self) -> bool:
        return self.parent in _ROOTS


def event_rule(records: DataFrame, predicate: str) -> DataFrame:
    return records.where(F.expr(predicate))


def ordered_rules(rules: list[EventRule]) -> list[list[EventRule]]:
    """The rules by depth; an unknown parent or a cycle is an error."""
    by_id = {r.id: r for r in rules}
    if len(by_id) != len(rules):
        raise ValueError("rule ids must be unique")
    depth: dict[str, int] = {}
    for rule in rules:
        chain, current = [], rule
        while current.id not in depth:
            if current.id in chain:
                raise ValueError(f"rule {rule.id} is its own ancestor")
            chain.append(current.id)
            if current.is_root:
                break
            if current.parent not in by_id:
                raise ValueError(f"rule {current.id} has the unknown parent {current.parent}")
            current = by_id[current.parent]
        base = depth.get(current.id, -1)
        if current.id in chain:
            chain.remove(current.id)
            base = depth[current.id] = 0
        for above, rule_id in enumerate(reversed(chain), start=1):
            depth[rule_id] = base + above
    levels: list[list[EventRule]] = [[] for _ in range(max(depth.values(), default=-1) + 1)]
    for rule in rules:
        levels[depth[rule.id]].append(rule)
    return levels


def event_rule_flags(records: DataFrame, rules: list[EventRule], prefix: str = "rule_") -> DataFrame:
    """One boolean column per rule, all evaluated in the same pass over the records."""
    for level in ordered_rules(rules):
        flags = {}
        for rule in level:
            own = F.coalesce(F.expr(f"({rule.predicate})"), F.lit(False))
            flags[prefix + rule.id] = own if rule.is_root else F.col(prefix + rule.parent) & own
        records = records.withColumns(flags)
    return records


def event_rule_tree(records: DataFrame, rules: list[EventRule]) -> dict[str, DataFrame]:
    """The rows of each rule; own and ancestors' predicates become one filter."""
    frames: dict[str, DataFrame] = {}
    for level in ordered_rules(rules):
        for rule in level:
            frames[rule.id] = event_rule(records if rule.is_root else frames[rule.parent], rule.predicate)
    return frames


def split_expressions(text: str) -> list[str]:
    """A configured comma list of expressions; commas within brackets or quotes do not split."""
    parts, start, depth, quote = [], 0, 0, None
    for i, ch in enumerate(text):
        if quote:
            quote = None if ch == quote else quote
        elif ch in "'\"`":
            quote = ch
        elif ch in "([":
            depth += 1
        elif ch in ")]":
            depth -= 1
        elif ch == "," and depth == 0:
            parts.append(text[start:i].strip())
            start = i + 1
    return [*parts, text[start:].strip()]


def business_projection(events: DataFrame, expressions: list[str] | str) -> DataFrame:
    if isinstance(expressions, str):
        expressions = split_expressions(expressions)
    return events.selectExpr(*expressions)


def time_of_day_gate(records: DataFrame, start: str, end: str, ts: str = "ts") -> DataFrame:
    """Records whose clock time (HH:mm:ss) lies strictly between the two settings."""
    clock = F.date_format(F.col(ts), "HH:mm:ss")
    return records.where((clock > start) & (clock < end))
