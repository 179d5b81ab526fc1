"""Preparation of the call-accounting tickets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callweave import fixed_values as fv
from callweave.functions import is_blank, is_eight_digits_from_one, wall_text
from callweave.operators import require_columns

NUMBER_COLUMNS = ["CalledNumber", "ChargedNumber", "CallingNumber", "InitialDialledNumber"]
REQUIRED = [part.split()[0] for part in fv.TICKET_DDL.split(",")]


def exclude_service_numbers(tickets: DataFrame) -> DataFrame:
    """Without the tickets that have a number of eight digits starting with 1 in any of
    the four number columns; a null number excludes nothing."""
    for name in NUMBER_COLUMNS:
        tickets = tickets.where(~is_eight_digits_from_one(F.col(name)))
    return tickets


def ticket_prep(raw: DataFrame, rules: str = "v2") -> DataFrame:
    """Tickets with uniform timestamps and typed numbers.

    ``v2`` also turns a blank ChargedNumber into null and excludes service numbers; ``v1``
    does neither, and has no InitialDialledNumber. The texts that count or classify
    (CallType, durations) become numbers here, once; unreadable ones become null.
    """
    required = REQUIRED if rules == "v2" else [c for c in REQUIRED if c != "InitialDialledNumber"]
    tickets = require_columns(raw, required, "tickets").select(*required)
    tickets = tickets.withColumns(
        {
            "InitialStartDateTime": wall_text(F.col("InitialStartDateTime")),
            "StartDateTime": wall_text(F.col("StartDateTime")),
            "CallType": F.col("CallType").try_cast("int"),
            "EffectiveCallDuration": F.col("EffectiveCallDuration").try_cast("int"),
            "WaitingDuration": F.col("WaitingDuration").try_cast("double"),
        }
    )
    if rules != "v2":
        return tickets
    charged = F.col("ChargedNumber")
    tickets = tickets.withColumn("ChargedNumber", F.when(~is_blank(charged), charged))
    return exclude_service_numbers(tickets)
