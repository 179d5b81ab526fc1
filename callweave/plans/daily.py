"""The daily run: all stages for one day, in order."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from callweave.plans.cross_reference import cross_reference, office_export, stats_export
from callweave.plans.ivr import ivr_prep
from callweave.plans.matching import match_calls
from callweave.plans.midnight import EDGE_SECONDS, DayFiles, day_with_edges, own_rows
from callweave.plans.organisation import org_directory, user_directory
from callweave.plans.rules import call_rules
from callweave.plans.tariff import tariff_classify
from callweave.plans.tickets import ticket_prep
from callweave.sources import (
    DayStore,
    Draft,
    Stages,
    export_sorted_csv,
    read_csv,
    read_ivr_blocks,
    read_ivr_calls,
    read_layout_file,
    read_lines,
    read_tickets,
    write_day,
)


@dataclass
class DayPaths:
    """Where the files of one day are. A path may be a file, a folder or a pattern."""

    tickets: str
    ivr_calls: str
    ivr_blocks: str
    users: str
    organisation: str
    organisation_layout: str
    numbering_plan: str
    dial_codes: str


@dataclass
class Reference:
    """Reference tables of a run."""

    users: DataFrame
    organisation_lines: DataFrame
    organisation_layout: DataFrame
    numbering_plan: DataFrame
    dial_codes: DataFrame


def day_facts(
    tickets: DataFrame,
    ivr_blocks: DataFrame,
    ivr_calls: DataFrame,
    reference: Reference,
    as_of: datetime.date,
    stages: Stages,
    zone: str,
    rules: str = "v2",
    details: str = "exact",
    store: Callable[[DataFrame, str], DataFrame] | None = None,
    own: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Facts of the given tickets. A stage is stored where later ones read it more than
    once: the prepared tickets (CSV would be parsed again), the prepared calls, the matched
    tickets, the legs, the rules and the organisation. ``store(df, name)`` may keep the classified
    calls (``tariffs``) and the directory (``users``) for good and return them read back. ``own(df)`` picks
    the rows of the day after the rules, where the tickets have edges of other days."""
    prepared = stages.keep(ticket_prep(tickets, rules), "tickets")
    ivr = stages.keep(ivr_prep(ivr_blocks, ivr_calls), "ivr")
    matched = match_calls(prepared, ivr, zone, details=details)
    facts = call_rules(stages.keep(matched, "matched"), rules, stages.keep)
    if own is not None:
        facts = own(facts)
    tariffs = tariff_classify(
        stages.keep(facts, "rules"), reference.numbering_plan, reference.dial_codes, rules
    )
    organisation = stages.keep(
        org_directory(reference.organisation_lines, reference.organisation_layout, as_of),
        "organisation",
    )
    users = user_directory(reference.users, organisation)
    if store is not None:
        tariffs, users = store(tariffs, "tariffs"), store(users, "users")
    return cross_reference(tariffs, users, organisation)


def read_day(spark: SparkSession, path: str, day: datetime.date) -> DataFrame:
    """One stored day, without the column of the day."""
    return spark.read.orc(f"{path}/jour={day.isoformat()}")


class _DayFolders:
    """Tables of a day in folders that are replaced one by one: ``<result>/<table>/jour=<day>``, exports in
    ``<result>/<table>/<day without hyphens>``. A run that fails between them leaves a mixed day."""

    def __init__(self, spark: SparkSession, result: str, day: datetime.date):
        self.spark, self.result, self.label = spark, result, day.isoformat()

    def write(self, df: DataFrame, table: str) -> DataFrame:
        write_day(df, f"{self.result}/{table}", self.label)
        return self.spark.read.schema(df.schema).orc(f"{self.result}/{table}/jour={self.label}")

    def export(self, table: str, write: Callable[[str], None]) -> None:
        write(f"{self.result}/{table}/{self.label.replace('-', '')}")

    def keep(self, table: str) -> DataFrame:
        return self.spark.read.orc(f"{self.result}/{table}/jour={self.label}")

    def stored(self, facts: DataFrame) -> DataFrame:
        schema = StructType([*facts.schema.fields, StructField("jour", StringType())])
        return self.spark.read.schema(schema).orc(f"{self.result}/facts").where(F.col("jour") == self.label)


def _sink(spark: SparkSession, result: str | DayStore, day: datetime.date) -> _DayFolders | Draft:
    return result.draft(day) if isinstance(result, DayStore) else _DayFolders(spark, result, day)


def _publish(facts: DataFrame, sink: _DayFolders | Draft) -> DataFrame:
    """Write the day's facts and both exports; the stored facts. A draft is published last."""
    stored = sink.write(facts, "facts")
    sink.export("stats", lambda path: export_sorted_csv(stats_export(stored), path))
    sink.export("offices", lambda path: export_sorted_csv(office_export(stored), path))
    if isinstance(sink, Draft):
        sink.publish()
        return stored.withColumn("jour", F.lit(sink.label))
    return sink.stored(facts)


def rerun_cross_reference(
    spark: SparkSession,
    result: str | DayStore,
    day: datetime.date,
    organisation: DataFrame,
    users: DataFrame | None = None,
) -> DataFrame:
    """The facts of a day once more, with a corrected directory, from the calls that ``run_day``
    stored. ``users`` is a new telephone directory; without it the stored one is taken. In a ``DayStore``
    the new facts and exports appear at once; the calls are taken over, not copied."""
    sink = _sink(spark, result, day)
    try:
        known = sink.keep("users") if users is None else sink.write(user_directory(users, organisation), "users")
        return _publish(cross_reference(sink.keep("tariffs"), known, organisation), sink)
    except BaseException:
        if isinstance(sink, Draft):
            sink.discard()
        raise


def _day_files(spark: SparkSession, paths: DayPaths | None) -> DayFiles | None:
    if paths is None:
        return None
    return DayFiles(
        read_tickets(spark, paths.tickets), read_ivr_blocks(spark, paths.ivr_blocks), read_ivr_calls(spark, paths.ivr_calls)
    )


def run_day(
    spark: SparkSession,
    paths: DayPaths,
    day: datetime.date,
    result: str | DayStore,
    zone: str,
    rules: str = "v2",
    stages: Stages | None = None,
    before: DayPaths | None = None,
    after: DayPaths | None = None,
    edge_seconds: int = EDGE_SECONDS,
) -> DataFrame:
    """Read the files of a day, write its classified calls, directory, facts and both exports, and return
    the stored facts of the day. ``result`` is a ``DayStore``, in which the day appears as a whole, or
    a folder, in which ``tariffs``, ``users`` and ``facts`` (ORC by ``jour``) and the exports are
    replaced one after another. ``zone`` is that of the tickets' wall clock. The stage tables are removed at the
    end, also if the run fails, unless the caller gave the place for them.

    ``before`` and ``after`` are the neighbouring days: with them, calls and tickets on both sides of
    midnight meet, and the day has the tickets whose wall clock shows it (``plans.midnight``)."""
    reference = Reference(
        users=read_csv(spark, paths.users),
        organisation_lines=read_lines(spark, paths.organisation),
        organisation_layout=read_layout_file(spark, paths.organisation_layout),
        numbering_plan=read_csv(spark, paths.numbering_plan),
        dial_codes=read_csv(spark, paths.dial_codes),
    )
    files, own = _day_files(spark, paths), None
    if before is not None or after is not None:
        files = day_with_edges(files, _day_files(spark, before), _day_files(spark, after), day, zone, edge_seconds)

        def own(facts: DataFrame) -> DataFrame:
            return own_rows(facts, day)

    sink, kept = _sink(spark, result, day), stages or Stages(spark)
    try:
        facts = day_facts(
            files.tickets, files.ivr_blocks, files.ivr_calls, reference, day, kept, zone, rules, store=sink.write, own=own
        )
        return _publish(facts, sink)
    except BaseException:
        if isinstance(sink, Draft):
            sink.discard()
        raise
    finally:
        if stages is None:
            kept.remove()
