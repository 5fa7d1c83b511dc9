"""Zone, clock and duration helpers.

Instants are carried as UTC wall-clock ``TIMESTAMP_NTZ`` so results do not
depend on the session time zone and compare equal to a zone-less SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmart.functions.scalars import as_col

# Fixed values taken from the source job.
REPORTING_ZONE = "America/New_York"
DUE_TEXT_PATTERN = "M/d/yyyy H:m:s"   # text form month/day/year hour:minute:second
END_OF_DAY = "23:59:59"


def local_to_utc(c, zone: str) -> Column:
    """Wall-clock time in ``zone`` -> UTC wall clock (both TIMESTAMP_NTZ).

    Local times inside a DST gap move forward by the gap, as Spark does.
    """
    ts = as_col(c).cast("timestamp_ntz")
    if zone.upper() == "UTC":
        return ts
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), ts)


def end_of_day(d, time_of_day: str = END_OF_DAY) -> Column:
    """DATE -> that date at ``time_of_day`` (TIMESTAMP_NTZ)."""
    return as_col(d).cast("date").cast("timestamp_ntz") + F.expr(
        f"INTERVAL '{time_of_day}' HOUR TO SECOND")


def parse_local_timestamp(text, zone: str, pattern: str = DUE_TEXT_PATTERN,
                          strict: bool = True) -> Column:
    """Parse local-time text in ``zone`` into a UTC instant (TIMESTAMP_NTZ).

    ``strict`` fails the job on text that does not parse (what the source
    warehouse does); otherwise such text gives NULL.
    """
    t = as_col(text)
    parsed = F.try_to_timestamp(t, F.lit(pattern)).cast("timestamp_ntz")
    if strict:
        parsed = F.when(t.isNotNull() & parsed.isNull(),
                        F.raise_error(F.concat(F.lit("unparseable timestamp text: "), t))
                        ).otherwise(parsed).cast("timestamp_ntz")
    return local_to_utc(parsed, zone)


def today_in(as_of, zone: str = REPORTING_ZONE) -> Column:
    """Calendar date in ``zone`` at the UTC instant ``as_of``."""
    ts = as_col(as_of).cast("timestamp_ntz")
    if zone.upper() != "UTC":
        ts = F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)
    return F.to_date(ts)


def hours_between(end, start) -> Column:
    """Whole hours from ``start`` to ``end``, truncated toward zero."""
    return F.timestamp_diff("HOUR", as_col(start), as_col(end)).cast("bigint")


def days_between(end, start) -> Column:
    """Whole 24-hour days from ``start`` to ``end`` (NTZ), truncated toward zero."""
    return F.timestamp_diff("DAY", as_col(start), as_col(end)).cast("bigint")
