"""Time renderings. Stored times are UTC instants; the session zone is pinned to UTC.

Report and serving times are shown in New York local time, DST-aware.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Display zone and formats.
DISPLAY_ZONE = "America/New_York"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
HOUR_LABEL = "yyyy-MM-dd HH:00"
REPORT_KEY = "yyyyMMdd_HH"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def iso_utc(ts) -> Column:
    """UTC ISO text with microseconds and no zone suffix (message ``timestamp``)."""
    return F.date_format(_c(ts), ISO_MICROS)


def parse_iso_utc(text) -> Column:
    """Instant of an ISO date and time (fraction and offset may be missing; without an offset it is
    UTC). Null for any other text: one odd message must not stop a stream."""
    return F.when(_c(text).rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"), F.try_to_timestamp(_c(text)))


def local_time(ts, zone: str = DISPLAY_ZONE) -> Column:
    return F.from_utc_timestamp(_c(ts), zone)


def utc_offset(ts, zone: str = DISPLAY_ZONE) -> Column:
    """``±HH:MM`` offset of ``zone`` at instant ``ts`` (−04:00 in July, −05:00 in January)."""
    minutes = F.timestamp_diff("MINUTE", _c(ts), local_time(ts, zone))
    sign = F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+"))
    a = F.abs(minutes)
    return F.concat(sign, F.lpad((a / 60).cast("int").cast("string"), 2, "0"), F.lit(":"),
                    F.lpad((a % 60).cast("string"), 2, "0"))


def iso_local(ts, zone: str = DISPLAY_ZONE) -> Column:
    """ISO text in ``zone`` with microseconds and offset, e.g. 2026-07-13T12:23:42.733006-04:00."""
    return F.concat(F.date_format(local_time(ts, zone), ISO_MICROS), utc_offset(ts, zone))


def hour_label(ts, zone: str | None = DISPLAY_ZONE) -> Column:
    """``YYYY-MM-DD HH:00`` in ``zone`` (UTC when zone is None)."""
    t = _c(ts) if zone is None else local_time(ts, zone)
    return F.date_format(t, HOUR_LABEL)


def report_key(ts, zone: str = DISPLAY_ZONE) -> Column:
    """``YYYYMMDD_HH`` in ``zone``: the report file's hour."""
    return F.date_format(local_time(ts, zone), REPORT_KEY)
