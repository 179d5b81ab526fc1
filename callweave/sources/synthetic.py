"""Generated tickets for tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from callweave import fixed_values as fv


def synthetic_tickets(
    spark: SparkSession, rows: int, seed: int = 7, excluded_column: str | None = None
) -> DataFrame:
    """Tickets with numbers of 2 to 10 digits that no exclusion rule hits; the numbers in
    ``excluded_column`` are eight digits from 1, which the rule does hit."""

    def digits(name: str, count: int) -> F.Column:
        return F.lpad((F.xxhash64("id", F.lit(name), F.lit(seed)) % 10**count).cast("string"), count, "5")

    def number(name: str):
        tail = F.regexp_replace(digits(name, 7), "-", "3")
        if name == excluded_column:
            return F.concat(F.lit("1"), tail)
        size = F.pmod(F.xxhash64("id", F.lit(name + "size")), F.lit(4))
        return (
            F.when(size == 0, F.concat(F.lit("4"), tail))
            .when(size == 1, F.concat(F.lit("06"), tail, F.lit("1")))
            .when(size == 2, F.substring(tail, 1, 4))
            .otherwise(F.substring(tail, 1, 2))
        )

    start = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 7).cast("string")
    values = {
        "InitialStartDateTime": start,
        "TicketId": F.col("id").cast("string"),
        "CalledNumber": number("CalledNumber"),
        "CallingNumber": number("CallingNumber"),
        "CallType": (F.col("id") % 10).cast("string"),
        "EffectiveCallDuration": (F.col("id") % 90).cast("string"),
        "InitialDialledNumber": number("InitialDialledNumber"),
        "StartDateTime": start,
        "InternFacilities": F.repeat(F.lit("0"), F.lit(40)),
        "ChargedNumber": number("ChargedNumber"),
        "CostCenter": F.lit(None).cast("string"),
        "WaitingDuration": (F.col("id") % 20).cast("string"),
    }
    names = [part.split()[0] for part in fv.TICKET_DDL.split(",")]
    return spark.range(rows).select(*[values[n].alias(n) for n in names])
