"""Calls and tickets on both sides of midnight.

The files of a day begin and end at midnight, calls do not: a call at 23:59:59 may have its ticket at
00:00:02. A run of one day therefore reads the edges of both neighbours, too, and every ticket
belongs to the day of its wall clock, so each pair is found by one run: that of the ticket's day.

``edge`` is the longest time that a call lasts. Then all legs of a ticket and all calls that it can
match begin within ``edge`` of it, and the blocks of those calls lie within ``edge`` after their start. What
lies further away changes nothing for the day. A ticket that was filed with the neighbouring day
is found there; one without a readable time belongs to the day of its file.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, functions as F

from callweave.functions import wall_seconds

EDGE_SECONDS = 4 * 3600


@dataclass
class DayFiles:
    """Tickets, blocks and calls of one day as they were filed."""

    tickets: DataFrame
    ivr_blocks: DataFrame
    ivr_calls: DataFrame


def bounds(first: datetime.date, last: datetime.date, zone: str) -> tuple[int, int]:
    """Epoch seconds of the midnight before ``first`` and of the one after ``last``."""
    def midnight(day: datetime.date) -> int:
        return int(datetime.datetime(day.year, day.month, day.day, tzinfo=ZoneInfo(zone)).timestamp())

    return midnight(first), midnight(last + datetime.timedelta(days=1))


def _extended(own: DataFrame, before: DataFrame | None, after: DataFrame | None, seconds: Column, since: int, until: int) -> DataFrame:
    if before is not None:
        own = own.unionByName(before.where(seconds >= since))
    if after is not None:
        own = own.unionByName(after.where(seconds < until))
    return own


def day_with_edges(
    own: DayFiles,
    before: DayFiles | None,
    after: DayFiles | None,
    day: datetime.date,
    zone: str,
    edge: int = EDGE_SECONDS,
    last: datetime.date | None = None,
) -> DayFiles:
    """The files of a day (or of all days up to ``last``) with the edges of its neighbours. A neighbour may be missing."""
    begin, end = bounds(day, last or day, zone)
    parts = {}
    for name, seconds, until in (
        ("tickets", wall_seconds(F.col("InitialStartDateTime"), zone), end + edge),
        ("ivr_blocks", F.col("timestamp"), end + 2 * edge),
        ("ivr_calls", F.col("start"), end + edge),
    ):
        neighbours = [getattr(files, name) if files is not None else None for files in (before, after)]
        parts[name] = _extended(getattr(own, name), *neighbours, seconds, begin - edge, until)
    return DayFiles(**parts)


def own_rows(df: DataFrame, day: datetime.date, last: datetime.date | None = None, column: str = "InitialStartDateTime") -> DataFrame:
    """Rows whose wall clock shows the day (or one up to ``last``), and those without a readable one."""
    date = F.to_date(F.col(column).try_cast("timestamp_ntz"))
    return df.where(date.isNull() | date.between(F.lit(day), F.lit(last or day)))
