"""Publication times. They are wall-clock times, so they stay ``TIMESTAMP_NTZ`` throughout."""

from __future__ import annotations

from datetime import datetime

from digestloom.functions.arrays import let, lit
from digestloom.functions.text import WHITESPACE, strip

# Fixed value: the offset the posts are dated with (Seoul).
ZONE_SUFFIX = " +0900"

_MINUTE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}$"


def wall_time(value: datetime | str) -> str:
    """A wall-clock literal, for example the ``as_of`` of a run."""
    return f"CAST({lit(str(value))} AS TIMESTAMP_NTZ)"


def published_ts(published_at: str) -> str:
    """Parse ``YYYY-MM-DD HH:MM``; anything else is null (which is legal, not an error)."""
    text = f"regexp_replace({strip(published_at)}, {lit(f'[{WHITESPACE}]+')}, ' ')"
    return let(
        text,
        lambda t: f"CASE WHEN regexp_like({t}, {lit(_MINUTE)}) THEN try_cast({t} AS TIMESTAMP_NTZ) END",
    )


def published_or(published_at: str, as_of: datetime | str) -> str:
    """Publication time, or the time of the run when it cannot be parsed."""
    return f"coalesce({published_ts(published_at)}, {wall_time(as_of)})"


def cutoff(days: int, as_of: datetime | str) -> str:
    if days < 1:
        raise ValueError("lookback days must be at least 1")
    return f"({wall_time(as_of)} - INTERVAL '{int(days)}' DAY)"


def within_lookback(published_at: str, days: int, as_of: datetime | str) -> str:
    """True inside the lookback window (bound included), for future and for unparseable times."""
    return f"coalesce({published_ts(published_at)} >= {cutoff(days, as_of)}, true)"


def day_text(ts: str) -> str:
    return f"substring(CAST({ts} AS STRING), 1, 10)"


def post_date_text(ts: str) -> str:
    """``YYYY-MM-DD HH:MM:SS +0900``."""
    return f"concat(substring(CAST({ts} AS STRING), 1, 19), {lit(ZONE_SUFFIX)})"


def run_stamp(ts: str) -> str:
    """ISO time of a run given in Seoul wall time, with microseconds and offset."""
    fmt = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    return f"concat(date_format({ts}, {lit(fmt)}), '+09:00')"


def run_stamp_utc(ts: str) -> str:
    """The same stamp for an instant given in UTC."""
    return run_stamp(f"{ts} + INTERVAL '9' HOUR")


def as_event_time(ts: str) -> str:
    """A wall-clock time as the instant that reads the same in UTC, whatever the session zone.

    Watermarks need instants, and day windows are cut at UTC midnight.
    """
    return f"CAST(concat(CAST({ts} AS STRING), 'Z') AS TIMESTAMP)"


def utc_day(instant: str) -> str:
    return f"to_date(to_utc_timestamp({instant}, current_timezone()))"
