from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CLOCK = r"[T ]\d{2}(:\d{2}(:\d{2}(\.\d+)?)?)?"
OFFSET = r"(Z|[+-]\d{2}(:?\d{2})?)?"
EXTENDED = rf"^\d{{4}}(-\d{{2}}(-\d{{2}}({CLOCK}{OFFSET})?)?)?$"
NAIVE = rf"^\d{{4}}-\d{{2}}-\d{{2}}({CLOCK})?$"
BASIC = rf"^(\d{{4}})(\d{{2}})(\d{{2}})(?:[T ](\d{{2}}):?(\d{{2}}):?(\d{{2}})(\.\d+)?{OFFSET})?$"


def iso_to_utc(stamp: Column) -> Column:
    """ISO 8601 text to an instant; without an offset it is UTC; bad text becomes null."""
    text = stamp.cast("string")
    day = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})", "$1-$2-$3")
    basic = F.regexp_replace(day, r"[T ](\d{2})(\d{2})(\d{2})", "T$1:$2:$3")
    return F.when(text.rlike(EXTENDED), text.try_cast("timestamp_ltz")).when(
        text.rlike(BASIC), basic.try_cast("timestamp_ltz")
    )


def naive_to_utc(stamp: Column, zone: str, typed: bool = False) -> Column:
    """Wall time of ``zone`` to an instant.

    ``typed`` says that the column already is ``timestamp_ntz`` and not text.
    """
    if typed:
        return wall_to_utc(stamp, zone)
    text = stamp.cast("string")
    return wall_to_utc(F.when(text.rlike(NAIVE), text.try_cast("timestamp_ntz")), zone)


def dmy_to_utc(day: Column, zone: str) -> Column:
    """``DD/MM/YYYY`` text, midnight in ``zone``, to an instant."""
    parsed = F.try_to_timestamp(day.cast("string"), F.lit("d/M/yyyy"))
    return wall_to_utc(parsed.cast("timestamp_ntz"), zone)


def wall_to_utc(wall: Column, zone: str) -> Column:
    """Wall time to the one instant that shows it.

    Null where a clock change skips the wall time or shows it twice. Wall times
    are held as instants of the UTC session, so they can be compared.
    """
    if zone == "UTC":
        return wall.cast("timestamp_ltz")
    local = wall.cast("timestamp_ltz")
    guess = F.to_utc_timestamp(local, zone)
    day = F.expr("INTERVAL 1 DAY")
    offset_before = F.from_utc_timestamp(guess - day, zone) - (guess - day)
    offset_after = F.from_utc_timestamp(guess + day, zone) - (guess + day)
    early, late = local - offset_before, local - offset_after
    shows_early = F.from_utc_timestamp(early, zone) == local
    shows_late = F.from_utc_timestamp(late, zone) == local
    return F.when(offset_before == offset_after, guess).when(
        shows_early != shows_late, F.when(shows_early, early).otherwise(late)
    )


def utc_to_wall(instant: Column, zone: str) -> Column:
    """The wall time that ``zone`` shows at an instant."""
    return F.from_utc_timestamp(instant, zone).cast("timestamp_ntz")
