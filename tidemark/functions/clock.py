"""Time expressions that do not depend on the session time zone."""

from __future__ import annotations

import time

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numeric import floor_div

DAY_SECONDS = 86400
# Fixed value: the calendar of the series is UTC+8.
UTC8_SECONDS = 8 * 3600

CLOCK_FORMAT = "yyyy-MM-dd HH:mm:ss"


def day_number(epoch: Column, offset_seconds: int = UTC8_SECONDS) -> Column:
    """Days since 1970-01-01 in a fixed-offset zone, as INT."""
    shifted = epoch.cast("bigint") + F.lit(offset_seconds)
    return floor_div(shifted, F.lit(DAY_SECONDS)).cast("int")


def local_date(epoch: Column, offset_seconds: int = UTC8_SECONDS) -> Column:
    """Calendar date of an epoch second in a fixed-offset zone."""
    return F.date_from_unix_date(day_number(epoch, offset_seconds))


def epoch_seconds(clock: Column) -> Column:
    """Epoch seconds of a zone-less timestamp, read as UTC.

    Built from calendar fields: converting to an instant would go through the
    session zone and shift clocks that fall into a daylight-saving gap.
    """
    local = clock.cast("timestamp_ntz")
    days = F.unix_date(local.cast("date")).cast("bigint")
    return (
        days * DAY_SECONDS
        + F.hour(local) * 3600
        + F.minute(local) * 60
        + F.second(local)
    )


def iso_date(clock: Column) -> Column:
    """Date of a zone-less timestamp as written, yyyy-MM-dd."""
    return clock.cast("timestamp_ntz").cast("date").cast("string")


def clock_text(clock: Column) -> Column:
    """A zone-less timestamp as yyyy-MM-dd HH:mm:ss; ``date_format`` would go
    through the session zone."""
    return F.substring(clock.cast("timestamp_ntz").cast("string"), 1, 19)


def now_epoch() -> Column:
    """Wall clock in epoch seconds, fixed per micro-batch; for streams."""
    return F.unix_timestamp(F.current_timestamp())


def wall_clock() -> int:
    """Epoch seconds now, read once: the clock for a batch query, whose passes
    must all judge staleness alike."""
    return int(time.time())


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def pack_order(*parts: tuple[Column, int]) -> Column:
    """One DECIMAL that sorts like the given non-negative integer columns.

    Each part comes with its number of decimal digits, most significant first;
    38 digits in all. A single numeric order keeps ``min_by``/``max_by`` in
    hash aggregation, which a struct order would push into sort aggregation.
    """
    if sum(digits for _, digits in parts) > 38:
        raise ValueError("a packed order has at most 38 digits")
    packed = F.lit(0).cast("decimal(38,0)")
    for part, digits in parts:
        whole = part.cast("decimal(38,0)")
        limit = F.lit(10**digits - 1).cast("decimal(38,0)")
        fits = whole.between(F.lit(0), limit)
        problem = F.raise_error(F.lit(f"order part outside {digits} digits"))
        checked = F.when(fits | whole.isNull(), whole).otherwise(
            problem.cast("decimal(38,0)")
        )
        shifted = (packed * F.lit(10**digits).cast("decimal(38,0)")).cast(
            "decimal(38,0)"
        )
        packed = (shifted + checked).cast("decimal(38,0)")
    return packed
