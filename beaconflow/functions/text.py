"""String expressions: literal splits, integer parsing, wildcards, messages."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal_regex(text: str) -> str:
    """A regular expression matching exactly ``text``."""
    return re.sub(r"([^0-9A-Za-z_\s])", r"\\\1", text)


def split_fields(line: Column, delim: str) -> Column:
    """Split on a literal delimiter; trailing empty fields do not count as fields."""
    d = literal_regex(delim)
    return F.split(F.regexp_replace(line, f"(?:{d})+$", ""), d)


def strict_int(text: Column) -> Column:
    """Digits with an optional sign as int; blanks, letters and overflow give null."""
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int"))


def wildcard_regex(prefix: str | None = None, mid: str | None = None, suffix: str | None = None) -> str:
    """The pattern ``prefix*mid*suffix`` (absent parts are simply empty) as a regex."""
    middle = f".*{literal_regex(mid)}.*" if mid else ".*"
    return f"(?s)^{literal_regex(prefix or '')}{middle}{literal_regex(suffix or '')}$"


def joined_message(columns: list[Column], delim: str) -> Column:
    """All columns as text joined by ``delim``, nulls as empty strings."""
    return F.concat_ws(delim, *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
