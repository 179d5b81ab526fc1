"""Directories: organisation units and telephone users."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, functions as F

from callweave import fixed_values as fv
from callweave.functions import fixed_width, read_layout, trim_all, without_blanks
from callweave.operators import latest_version, require_columns, require_parents

OFFICE_CODE_LENGTH = 7


def org_directory(
    lines: DataFrame,
    layout: DataFrame,
    as_of: datetime.date,
    content: str = "value",
    open_ended_only: bool = False,
    with_parent_labels: bool = False,
) -> DataFrame:
    """Offices (units with a seven-character code) whose centre and direction exist.

    Of each unit the version that is valid longest counts, and only if it is still valid
    on ``as_of``; with ``open_ended_only=True`` only if its validity has no end. Equal
    versions are decided by the smallest values of the other columns.
    ``with_parent_labels=True`` adds Centre_des_Impots and Direction.
    """
    cut = trim_all(fixed_width(lines, read_layout(layout), content))
    units = cut.where(F.col("Code_type_de_structure") != fv.TITLE_LINE_TYPE).select(
        *fv.ORGANISATION_COLUMNS, fv.VALIDITY_COLUMN
    )
    ends = F.col(fv.VALIDITY_COLUMN)
    valid = ends == fv.NO_END_OF_VALIDITY
    if not open_ended_only:
        valid = valid | (F.try_to_date(ends, "yyyyMMdd") > F.lit(as_of))
    ties = [c for c in fv.ORGANISATION_COLUMNS if c != "Code_UA"]
    current = latest_version(units, "Code_UA", fv.VALIDITY_COLUMN, valid, ties).withColumn(
        "Date_deffet_de_letat", F.try_to_date("Date_deffet_de_letat", "yyyyMMdd")
    )
    size = F.length("Code_UA")
    direction, centre, post = (
        F.col(c) for c in ("DIR_hierarchique", "CI_hierarchique", "CB_hierarchique")
    )
    offices = current.where(
        (size == OFFICE_CODE_LENGTH) & (post == "") & (centre != "") & (direction != "")
    )
    centres = current.where((size == 5) & (post == "") & (centre == "") & (direction != ""))
    directions = current.where((size == 3) & (post == "") & (centre == "") & (direction == ""))
    labels = with_parent_labels
    offices = require_parents(
        offices, centres, "CI_hierarchique", "Code_UA",
        {"Libelle_long_1": "Centre_des_Impots"} if labels else None,
    )
    offices = require_parents(
        offices, directions, "DIR_hierarchique", "Code_UA",
        {"Libelle_long_1": "Direction"} if labels else None,
    )
    extra = ["Centre_des_Impots", "Direction"] if labels else []
    return offices.select(
        *[F.col(c).alias(fv.ORGANISATION_RENAMES.get(c, c)) for c in fv.ORGANISATION_COLUMNS],
        *extra,
    )


def user_directory(users: DataFrame, organisation: DataFrame) -> DataFrame:
    """Internal numbers with the office code of their cost center, where that office exists."""
    require_columns(users, ["Internal Number", "Cost Center"], "users")
    cleaned = users.select(
        F.col("Internal Number").alias("Internal_Number"),
        without_blanks(F.col("Cost Center"), OFFICE_CODE_LENGTH).alias("Cost_Center"),
    )
    return cleaned.join(
        organisation.select("Code_UA"), F.col("Code_UA") == F.col("Cost_Center"), "inner"
    )
