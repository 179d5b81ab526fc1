"""Wall-clock helpers.

Call tickets carry the wall-clock time of their site as text. It is read as
TIMESTAMP_NTZ, so no result depends on the time zone of the session; the zone is
needed (and is an argument) only where a wall clock meets epoch seconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from callweave import fixed_values as fv


def wall_clock(column: Column) -> Column:
    """Text (or timestamp) as wall-clock time; null where it cannot be read."""
    return column.try_cast("timestamp_ntz")


def wall_text(column: Column) -> Column:
    """Wall clock as ``yyyy-MM-dd HH:mm:ss.SSS``."""
    text = wall_clock(column).cast("string")
    return F.concat(
        F.substring(text, 1, 19), F.lit("."), F.rpad(F.substring(text, 21, 3), 3, "0")
    )


def wall_seconds(column: Column, zone: str) -> Column:
    """Epoch seconds of a wall clock in the given zone, cut to whole seconds."""
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), wall_clock(column))
    return F.unix_timestamp(utc)


def quarter_label(minute: Column) -> Column:
    first, second, third, last = fv.QUARTERS
    return (
        F.when(minute < 15, first).when(minute < 30, second).when(minute < 45, third).otherwise(last)
    )


def hour_label(hour: Column, minute: Column) -> Column:
    """``H:MM - H:MM`` of the quarter of an hour; the end of the day is written 00:00."""
    part = (minute / 15).cast("int")
    start = F.concat(hour.cast("string"), F.lit(":"), F.substring(quarter_label(minute), 1, 2))
    end_hour = F.when(part < 3, hour.cast("string")).otherwise(
        F.when(hour == 23, F.lit("00")).otherwise((hour + 1).cast("string"))
    )
    end = F.concat(end_hour, F.lit(":"), F.substring(quarter_label(minute), 4, 2))
    return F.concat(start, F.lit(" - "), end)


def french_weekday(column: Column) -> Column:
    names = F.array(*[F.lit(n) for n in fv.FRENCH_WEEKDAYS])
    return F.get(names, F.dayofweek(column) - 1)


def iso_text(column: Column) -> Column:
    """Blank to ``T``, and a fraction of exactly ``.000`` at the end cut off."""
    return F.regexp_replace(F.regexp_replace(column, " ", "T"), r"\.000$", "")


def date_columns(df: DataFrame, column: str = "InitialStartDateTime") -> DataFrame:
    """Add Minutes, Hour, Date, dayofweek, quarter and Lib_hour, and write the source
    column in ISO form."""
    clock = wall_clock(F.col(column))
    minute, hour = F.minute(clock), F.hour(clock)
    return df.withColumns(
        {
            "Minutes": minute,
            "Hour": hour,
            "Date": F.to_date(clock),
            "dayofweek": french_weekday(clock),
            "quarter": quarter_label(minute),
            "Lib_hour": hour_label(hour, minute),
            column: iso_text(F.col(column)),
        }
    )
