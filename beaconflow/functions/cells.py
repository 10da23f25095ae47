"""Cell and device identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hex_code(code: Column) -> Column:
    """Upper-case hex padded to four digits; longer codes keep every digit, negatives give null."""
    digits = F.hex(code.cast("long"))
    return F.when(code >= 0, F.lpad(digits, F.greatest(F.lit(4), F.length(digits)), F.lit("0")))


def device14(imei: Column) -> Column:
    """Device identity without check digit and software version."""
    return F.substring(imei, 1, 14)
