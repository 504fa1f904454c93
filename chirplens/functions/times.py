"""Time expressions.  All times are UTC ``timestamp_ntz``, so no result depends on a zone."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from chirplens.config import RunGrid

# The feed's date format, and weekday names it may start with.
FEED_FORMAT = "MMM dd HH:mm:ss '+0000' yyyy"
FEED_WEEKDAY = "^(Mon|Tue|Wed|Thu|Fri|Sat|Sun) "


def parse_as_of(value: str) -> datetime:
    """``2017-10-22 10:18:13.491543``; the fraction may be missing."""
    fmt = "%Y-%m-%d %H:%M:%S.%f" if "." in value else "%Y-%m-%d %H:%M:%S"
    return datetime.strptime(value, fmt)


def ntz(value: datetime) -> Column:
    if value.tzinfo is not None:
        raise ValueError("times are naive UTC values")
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def is_recent(created_at: Column, as_of: datetime, days: int) -> Column:
    """Later than ``as_of - days``.  The column stays bare, so the scan can use the filter."""
    return created_at > ntz(as_of - timedelta(days=days))


def is_recent_in_seconds(created_at: Column, as_of: datetime, days: int) -> Column:
    """The same on event times cut to whole seconds.

    ``second(t) > bound`` is ``t >= second(bound) + 1s``: the cut moves to the constant and
    the filter still reaches the scan.
    """
    bound = as_of - timedelta(days=days)
    return created_at >= ntz(bound.replace(microsecond=0) + timedelta(seconds=1))


def parse_feed_date(text: Column) -> Column:
    """``Tue Apr 04 18:05:11 +0000 2017``; anything else raises.  Spark does not parse weekday
    names, so the name is checked and cut off."""
    bad = F.raise_error(F.concat(F.lit("not a feed date: "), F.coalesce(text, F.lit("NULL"))))
    rest = F.when(text.rlike(FEED_WEEKDAY), F.substring(text, 5, 100)).otherwise(bad)
    return F.to_timestamp_ntz(rest, F.lit(FEED_FORMAT))


def format_feed_date(created_at: Column) -> Column:
    return F.date_format(created_at, "EEE " + FEED_FORMAT)


_EPOCH = datetime(1970, 1, 1)
_SECOND = 1_000_000


def _micros(value: datetime | timedelta) -> int:
    gap = value - _EPOCH if isinstance(value, datetime) else value
    return gap // timedelta(microseconds=1)


def epoch_micros(col: Column) -> Column:
    """Microseconds since 1970 without a detour through the session's time zone."""
    gap = col - ntz(_EPOCH)
    part = lambda unit: F.extract(F.lit(unit), gap)
    minutes = (part("DAY").cast("long") * 24 + part("HOUR")) * 60 + part("MINUTE")
    return minutes * (60 * _SECOND) + (part("SECOND") * _SECOND).cast("long")


def _ceil_div(value: Column, step: int) -> Column:
    rest = F.pmod(value, F.lit(step).cast("long"))
    whole = F.call_function("div", value - rest, F.lit(step).cast("long"))
    return whole + (rest > 0).cast("long")


def first_run(created_at: Column, grid: RunGrid) -> Column:
    """Index of the first run of ``grid`` that has already seen the post (``created_at <= ts``)."""
    since_start = epoch_micros(created_at) - F.lit(_micros(grid.start)).cast("long")
    return F.greatest(F.lit(0).cast("long"), _ceil_div(since_start, _micros(grid.step)))


def last_run(created_at: Column, grid: RunGrid) -> Column:
    """Index of the last run in whose window the post lies (whole seconds, later than
    ``ts - days``)."""
    micros = epoch_micros(created_at)
    cut = micros - F.pmod(micros, F.lit(_SECOND).cast("long"))
    leaves = F.lit(_micros(grid.start - timedelta(days=grid.days))).cast("long")
    past = _ceil_div(cut - leaves, _micros(grid.step))
    return F.least(F.lit(grid.runs - 1).cast("long"), past - 1)


def run_time(index: Column, grid: RunGrid) -> Column:
    seconds = (index * F.lit(_micros(grid.step)).cast("long")).cast("decimal(18,0)") / F.lit(
        _SECOND
    ).cast("decimal(18,0)")
    return ntz(grid.start) + F.make_dt_interval(secs=seconds)
