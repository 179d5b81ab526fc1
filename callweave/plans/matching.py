"""Matching tickets with voice-response calls."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callweave import fixed_values as fv
from callweave.functions import wall_seconds
from callweave.operators import tolerance_join

TOLERANCE_SECONDS = 4


def _same(left: str, right: str):
    return F.col(left).eqNullSafe(F.col(right))


def match_calls(
    tickets: DataFrame,
    ivr: DataFrame,
    zone: str,
    tolerance: int = TOLERANCE_SECONDS,
    details: str = "exact",
) -> DataFrame:
    """All tickets, each with every voice-response call of its number that started within
    the tolerance. ``zone`` is the time zone of the tickets' wall clock.

    The rules in full: a ticket gets the matches of all tickets that share its TicketId;
    endcause, start and caller come from the match; the other columns of the call are
    those of every call with the ticket's own number and the exact start of the match, so
    they are null where that number is not the caller, and calls that share number and
    start give one row for each pair of them.

    All of this is worked out on narrow rows (ticket id, number, time). The full ticket
    rows are shuffled once, by ticket, so a busy number never moves them.

    ``details="carried"`` takes the details straight from the matched call: one row per
    ticket and call. It gives the same rows, with fewer joins, where no two calls share
    number and start.
    """
    narrow = tickets.select(
        "TicketId",
        F.col("CalledNumber").alias("_number"),
        wall_seconds(F.col("InitialStartDateTime"), zone).alias("_ticket_second"),
    )
    carried = [F.struct(*[F.col(f"`{c}`") for c in fv.DETAIL_COLUMNS]).alias("_details")]
    calls = ivr.select(
        *fv.MATCH_COLUMNS[:3],
        F.floor("start").alias("_call_second"),
        *(carried if details == "carried" else []),
    )
    matches = tolerance_join(
        narrow.where(F.col("_number").isNotNull()), calls,
        "_number", "temp_caller", "_ticket_second", "_call_second", tolerance,
    ).drop("_number", "_ticket_second", "_call_second")
    wide = tickets.select(*fv.TICKET_COLUMNS)

    if details == "carried":
        own = F.col("CalledNumber") == F.col("temp_caller")
        return wide.join(matches, "TicketId", "left").select(
            *fv.TICKET_COLUMNS,
            *fv.MATCH_COLUMNS,
            *[F.when(own, F.col("_details")[c]).alias(c) for c in fv.DETAIL_COLUMNS],
        )

    numbers = narrow.select("TicketId", "_number").distinct()
    same_start = ivr.select(
        F.col("temp_caller").alias("_detail_caller"),
        F.col("started_datetime").alias("_detail_start"),
        *[f"`{c}`" for c in fv.DETAIL_COLUMNS],
    )
    same_call = (F.col("_number") == F.col("_detail_caller")) & (
        F.col("started_datetime") == F.col("_detail_start")
    )
    found = (
        numbers.join(matches, "TicketId")
        .join(same_start, same_call, "left")
        .withColumnRenamed("TicketId", "_ticket")
    )
    # A null TicketId matches nothing; a null number is a number like any other here.
    same_ticket = (F.col("TicketId") == F.col("_ticket")) & _same("CalledNumber", "_number")
    return wide.join(found, same_ticket, "left").select(
        *fv.TICKET_COLUMNS, *fv.MATCH_COLUMNS, *[f"`{c}`" for c in fv.DETAIL_COLUMNS]
    )
