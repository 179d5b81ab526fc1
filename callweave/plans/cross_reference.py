"""Attaching each call to an office, and the two exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callweave import fixed_values as fv
from callweave.functions import date_columns, is_blank, is_true, without_blanks
from callweave.operators import enrich, null_safe_join
from callweave.plans.organisation import OFFICE_CODE_LENGTH


def not_counted():
    """Calls without a license, and voice-response calls that were transferred (their other
    leg counts). A row with a null key is never left out."""
    no_license = F.col("endcause") == fv.NO_LICENSE
    passed_on = (F.col("CallType") == fv.IVR_CALL_TYPE) & (F.col("endcause") == fv.TRANSFERRED)
    keys = ["TicketId", "InitialStartDateTime", "CallType"]
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    return is_true((no_license | passed_on) & known)


def cross_reference(tariffs: DataFrame, users: DataFrame, organisation: DataFrame) -> DataFrame:
    """Calls of known offices, with the office, date columns and the service label.

    The office code is the cost center of the charged number, or else the code found in the
    voice-response block; calls without a code, or with one the organisation does not
    have, are left out.
    """
    directory = users.select("Internal_Number", "Cost_Center")
    counted = tariffs.where(~not_counted())
    block_code = without_blanks(F.col("SAGES"), OFFICE_CODE_LENGTH)
    center = F.col("Cost_Center")
    with_code = (
        enrich(counted, directory, "ChargedNumber", "Internal_Number")
        .withColumn("SAGES", F.when(is_blank(center), block_code).otherwise(center))
        .where(~is_blank(F.col("SAGES")))
        .select(*fv.CROSS_REFERENCE_COLUMNS)
        .withColumn("SAGES", F.trim("SAGES"))
    )
    facts = date_columns(null_safe_join(with_code, organisation, "SAGES", "Code_UA"))
    waiting = F.col("Attente_avant_mise_en_relation").try_cast("double")
    return facts.withColumns(
        {
            "Service": F.concat("Bureau_court", F.lit(" "), "Bureau_2"),
            "Attente_avant_mise_en_relation": F.bround(waiting).cast("int"),
        }
    )


def stats_export(facts: DataFrame) -> DataFrame:
    """The 40 published columns, distinct."""
    return facts.select(
        *[F.col(source).alias(name) for source, name in fv.EXPORT_COLUMNS]
    ).distinct()


def office_export(facts: DataFrame) -> DataFrame:
    """The offices that occur in the facts."""
    return facts.select("SAGES").distinct()
