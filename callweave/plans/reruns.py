"""Which stored days a corrected directory changes.

A call meets the directory by its charged number, and by the office code of its voice-response block where the
number has no cost center. So a day is known, for this purpose, by its different pairs of number and
code. That index is written with the day, sorted, with the least and greatest values and Bloom filters that ORC
keeps for each stripe; a correction reads it instead of the calls.

From two directories follow the changed offices and numbers. Only pairs with one of them are looked up in both
directories, and only days on which some pair gets another office, or another number of them, are named:
those whose facts differ, no others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from callweave.functions import is_blank, without_blanks
from callweave.operators import changed_rows
from callweave.plans.cross_reference import not_counted
from callweave.plans.organisation import OFFICE_CODE_LENGTH

INDEX_COLUMNS = ["jour", "number", "code"]
#: Changed keys up to this number are pushed down to the index as a list; more are joined.
PUSHED_KEYS = 1000


def day_index(tariffs: DataFrame, day: Column | str = "jour") -> DataFrame:
    """The different pairs of charged ``number`` and block ``code`` of each day's counted calls."""
    label = F.col(day) if isinstance(day, str) else day
    return tariffs.where(~not_counted()).select(
        label.cast("string").alias("jour"), F.col("ChargedNumber").alias("number"), without_blanks(F.col("SAGES"), OFFICE_CODE_LENGTH).alias("code")
    ).distinct()


def write_index(index: DataFrame, path: str) -> None:
    """Store an index, or add days to it. Rows are sorted by number, so a stripe has few of them."""
    rows = index.select(*INDEX_COLUMNS).repartitionByRange("number", "code").sortWithinPartitions("number", "code")
    rows.write.mode("append").options(**{"orc.bloom.filter.columns": "number,code"}).orc(path)


def changed_keys(old_users: DataFrame, new_users: DataFrame, old_organisation: DataFrame, new_organisation: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbers and office codes whose entries differ; a number is changed by its office, too."""
    codes = changed_rows(old_organisation, new_organisation).select(F.col("Code_UA").alias("code")).distinct()
    entries = old_users.select("Internal_Number", "Cost_Center").unionByName(new_users.select("Internal_Number", "Cost_Center"))
    by_office = entries.join(codes, F.trim("Cost_Center") == F.col("code"), "left_semi").select(F.col("Internal_Number").alias("number"))
    own = changed_rows(old_users.select("Internal_Number", "Cost_Center"), new_users.select("Internal_Number", "Cost_Center"))
    counts = old_users.groupBy("Internal_Number", "Cost_Center").count().exceptAll(new_users.groupBy("Internal_Number", "Cost_Center").count())
    numbers = own.select(F.col("Internal_Number").alias("number")).unionByName(by_office).unionByName(
        counts.select(F.col("Internal_Number").alias("number"))
    )
    return numbers.distinct(), codes


def _picked(index: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    few = [r[0] for r in keys.where(F.col(column).isNotNull()).limit(PUSHED_KEYS + 1).collect()]
    if len(few) <= PUSHED_KEYS:
        return index.where(F.col(column).isin(few))
    return index.join(keys, column, "left_semi")


def _offices(pairs: DataFrame, users: DataFrame, organisation: DataFrame, sign: int) -> DataFrame:
    """What each pair gets from a directory: the same rule as in ``cross_reference``."""
    known = users.select(F.col("Internal_Number").alias("_number"), "Cost_Center")
    center = F.col("Cost_Center")
    found = pairs.join(known, F.col("number") == F.col("_number"), "left").withColumn("office", F.when(is_blank(center), F.col("code")).otherwise(center))
    found = found.where(~is_blank(F.col("office"))).withColumn("office", F.trim("office"))
    units = organisation.select(F.col("Code_UA").alias("_office"), F.struct(*[f"`{c}`" for c in organisation.columns]).alias("entry"))
    return found.join(units, F.col("office") == F.col("_office")).select(*INDEX_COLUMNS, "entry", F.lit(sign).alias("sign"))


def changed_days(
    index: DataFrame, old_users: DataFrame, new_users: DataFrame, old_organisation: DataFrame, new_organisation: DataFrame
) -> DataFrame:
    """The days (``jour``) whose facts differ between two directories, given as results of ``user_directory`` and ``org_directory``."""
    numbers, codes = changed_keys(old_users, new_users, old_organisation, new_organisation)
    pairs = _picked(index, "number", numbers).unionByName(_picked(index, "code", codes)).distinct()
    both = _offices(pairs, old_users, old_organisation, 1).unionByName(_offices(pairs, new_users, new_organisation, -1))
    differing = both.groupBy(*INDEX_COLUMNS, "entry").agg(F.sum("sign").alias("more")).where("more <> 0")
    return differing.select("jour").distinct()
