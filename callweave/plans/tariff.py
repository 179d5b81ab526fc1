"""Tariff class and destination of each call leg."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callweave import fixed_values as fv
from callweave.operators import anti_join, dial_code_lookup, joined_labels, prefix_lookup

# Left out when legs that are not covered are made distinct; both are null afterwards.
NOT_COMPARED = ["Aboutissement_SVI", "Motif_appel"]


def _without_dial_code(
    legs: DataFrame, plan: DataFrame, rules: str, duplicates: bool
) -> DataFrame:
    """Numbers of up to ten digits and received international legs, in one pass: the class
    decides the length of the prefix that is looked up, if any."""
    number, size = F.col("CalledNumber"), F.length("CalledNumber")
    abroad = (size > 10) & (F.col("Type_appel") == fv.RECEIVED)
    special = (size == 10) & number.startswith("08")
    mobile = (size == 10) & number.startswith("07")
    prefix_length = F.when(special, 4).when(mobile, 3).when((size == 10) | (size == 4), 2)
    if rules == "v2":
        inside, urgent, other = fv.TO_INTERNAL, fv.TO_EMERGENCY, fv.TO_INTERNAL
    else:
        inside, urgent, other = fv.TO_INTERNAL_V1, fv.TO_EMERGENCY_V1, fv.TO_OTHER_SHORT_V1
    destination = (
        F.when(special, fv.TO_SPECIAL)
        .when(size == 10, fv.TO_NATIONAL)
        .when(size == 4, fv.TO_SHORT)
        .when(size == 8, inside)
        .when(size > 10, fv.TO_INTERNATIONAL)
        .when(number.isin(fv.EMERGENCY_NUMBERS), urgent)
        .otherwise(other)
    )
    found = prefix_lookup(
        legs.where((size <= 10) | abroad), "CalledNumber", prefix_length, plan, "_in_plan", duplicates
    )
    covered = F.col("_in_plan") | prefix_length.isNull()
    emitted_short = (size == 4) & (F.col("Type_appel") == fv.EMITTED)
    no_text = F.lit(None).cast("string")
    return found.withColumns(
        {
            "calledNumber_externe_interne": F.when(emitted_short, fv.EXTERNAL).otherwise(
                F.col("calledNumber_externe_interne")
            ),
            "Indicatif_numero": no_text,
            "Pays": no_text,
            "Appel_facturable": F.when(size > 10, no_text)
            .when(covered, fv.IN_PLAN)
            .otherwise(fv.OUT_OF_PLAN),
            "Appel_vers": destination,
        }
    ).select(*fv.TARIFF_COLUMNS)


def _emitted_abroad(
    legs: DataFrame, plan: DataFrame, countries: DataFrame, duplicates: bool
) -> DataFrame:
    """Emitted legs of more than ten digits. They are covered if their dial code is in the
    plan; the others are kept once, and only if no leg of the ticket is covered."""
    emitted = legs.where(
        (F.length("CalledNumber") > 10) & (F.col("Type_appel") == fv.EMITTED)
    )
    hits = dial_code_lookup(
        emitted, "CalledNumber", plan.select("Indicatif"), countries, duplicates=duplicates
    )
    no_text = F.lit(None).cast("string")
    covered = hits.withColumn("Appel_facturable", F.lit(fv.IN_PLAN))
    uncovered = (
        anti_join(emitted, hits, ["TicketId"])
        .select(*[c for c in fv.RULE_COLUMNS if c not in NOT_COMPARED])
        .distinct()
        .withColumns(
            {
                **{c: no_text for c in NOT_COMPARED},
                "Indicatif_numero": no_text,
                "Pays": no_text,
                "Appel_facturable": F.lit(fv.OUT_OF_PLAN),
            }
        )
    )
    columns = [c for c in fv.TARIFF_COLUMNS if c != "Appel_vers"]
    together = covered.select(*columns).unionByName(uncovered.select(*columns))
    return together.withColumn("Appel_vers", F.lit(fv.TO_INTERNATIONAL)).select(*fv.TARIFF_COLUMNS)


def tariff_classify(
    legs: DataFrame,
    plan: DataFrame,
    dial_codes: DataFrame,
    rules: str = "v2",
    duplicates: bool = False,
) -> DataFrame:
    """Add Indicatif_numero, Pays, Appel_facturable and Appel_vers.

    ``plan`` has Indicatif, Debut and Longueur, ``dial_codes`` Indicatif and Pays. Legs
    without a called number, and international legs of unknown direction, have no class
    and are left out. A code or prefix that the plan lists several times counts once, or
    with ``duplicates=True`` once per listing. Give a stored table: ``legs`` is read once
    per branch.
    """
    countries = joined_labels(dial_codes, ["Indicatif"], "Pays", "Pays")
    return _without_dial_code(legs, plan, rules, duplicates).unionByName(
        _emitted_abroad(legs, plan, countries, duplicates)
    )
