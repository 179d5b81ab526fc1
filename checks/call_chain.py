"""The stages of the daily run, each checked against the plain SQL of its rules."""

from __future__ import annotations

import datetime
import itertools
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from callweave import fixed_values as fv
from callweave.fixed_values import DETAIL_COLUMNS
from callweave.plans import (
    DayFiles,
    call_rules,
    changed_days,
    cross_reference,
    day_facts,
    day_index,
    day_with_edges,
    ivr_prep,
    match_calls,
    office_export,
    org_directory,
    own_rows,
    rerun_cross_reference,
    stats_export,
    tariff_classify,
    ticket_prep,
    user_directory,
    write_index,
)
from callweave.plans.midnight import bounds
from callweave.sources import Stages, write_day
from checks import views
from checks.views import BASE_SQL, IVR_SQL, ORGANISATION_SQL, PLAN_SQL, TICKETS_SQL, USERS_SQL
from checks.views import with_views

# Outputs leave out the start timestamp (the epoch second ``start`` says the same) and
# give the blanks in names an underscore.
MATCH_OUTPUT = [
    "TicketId", "InitialStartDateTime", "CalledNumber", "CallType", "temp_caller", "endcause",
    "date_diff", *DETAIL_COLUMNS,
]


def _plain(name: str) -> str:
    return name.replace(" (bloc)", "_bloc").replace(" ", "_")


def _named(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(_plain(c)) for c in columns])


def _matched(
    spark: SparkSession, sf: str, stages: Stages, rules: str = "v2", details: str = "exact"
) -> DataFrame:
    prepared = stages.keep(ticket_prep(views.tickets(spark, sf), rules), "tickets")
    return match_calls(prepared, stages.keep(_ivr(spark, sf), "ivr"), "UTC", details=details)


def _ivr(spark: SparkSession, sf: str) -> DataFrame:
    return ivr_prep(views.ivr_blocks(spark, sf), views.ivr_calls(spark, sf))


def _rules(spark: SparkSession, sf: str, stages: Stages, rules: str = "v2") -> DataFrame:
    matched = stages.keep(_matched(spark, sf, stages, rules), "matched")
    return stages.keep(call_rules(matched, rules, stages.keep), "rules")


def _organisation(spark: SparkSession, sf: str, **options) -> DataFrame:
    reference = views.reference(spark, sf)
    return org_directory(
        reference.organisation_lines, reference.organisation_layout, views.AS_OF, **options
    )


def q_ticket_prep(spark, sf):
    return ticket_prep(views.tickets(spark, sf))


def q_ticket_prep_v1(spark, sf):
    return ticket_prep(views.tickets(spark, sf), "v1")


def q_ivr_prep(spark, sf):
    ivr = _ivr(spark, sf)
    return _named(ivr, [c for c in ivr.columns if c != "started_datetime"])


def q_tolerance_left(spark, sf):
    return _named(_matched(spark, sf, Stages(spark)), MATCH_OUTPUT)


def q_tolerance_left_carried(spark, sf):
    return _named(_matched(spark, sf, Stages(spark), details="carried"), MATCH_OUTPUT)


def q_tolerance_left_by_day(spark, sf):
    """Tickets matched in four runs, each over the days between two midnights and the edges of its
    neighbours: the rows are those of one run over all days.

    The runs follow one another as those of single days do. Each stores its rows and drops its stages before
    the next, so the driver plans and watches one match at a time, and the result only reads what was stored."""
    cuts = [datetime.date(2000, 1, 1), *(datetime.date(2024, 1, d) for d in (10, 11, 20)), datetime.date(2100, 1, 1)]
    periods = [(a, b - datetime.timedelta(days=1)) for a, b in itertools.pairwise(cuts)]
    filed, inputs, results = [], Stages(spark), Stages(spark)
    tickets = inputs.keep(views.tickets(spark, sf), "tickets")
    blocks, calls = inputs.keep(views.ivr_blocks(spark, sf), "blocks"), inputs.keep(views.ivr_calls(spark, sf), "calls")
    for first, last in periods:
        begin, end = bounds(first, last, "UTC")
        filed.append(DayFiles(
            own_rows(tickets, first, last), blocks.where((F.col("timestamp") >= begin) & (F.col("timestamp") < end)),
            calls.where((F.col("start") >= begin) & (F.col("start") < end)),
        ))
    parts = []
    for i, (first, last) in enumerate(periods):
        before, after = filed[i - 1] if i else None, filed[i + 1] if i + 1 < len(filed) else None
        files = day_with_edges(filed[i], before, after, first, "UTC", 600, last)
        stages = Stages(spark)
        prepared = stages.keep(ticket_prep(files.tickets), "tickets")
        ivr = stages.keep(ivr_prep(files.ivr_blocks, files.ivr_calls), "ivr")
        matched = own_rows(match_calls(prepared, ivr, "UTC"), first, last)
        parts.append(results.keep(_named(matched, MATCH_OUTPUT), f"matched-{i}"))
        stages.remove()
    inputs.remove()
    return reduce(DataFrame.unionByName, parts)


def q_call_rules_v2(spark, sf):
    return _rules(spark, sf, Stages(spark))


def q_call_rules_v1(spark, sf):
    return _rules(spark, sf, Stages(spark), "v1")


def _tariff(spark, sf, rules="v2", duplicates=False, stages=None):
    return tariff_classify(
        _rules(spark, sf, stages or Stages(spark), rules), views.plan(spark), views.dial_codes(spark), rules,
        duplicates,
    )


def q_tariff_classify(spark, sf):
    return _tariff(spark, sf)


def q_tariff_classify_listed(spark, sf):
    return _tariff(spark, sf, duplicates=True)


def q_tariff_classify_v1(spark, sf):
    return _tariff(spark, sf, "v1")


def q_org_directory(spark, sf):
    return _organisation(spark, sf)


def q_org_directory_labels(spark, sf):
    return _organisation(spark, sf, open_ended_only=True, with_parent_labels=True)


def q_user_directory(spark, sf):
    return user_directory(views.users(spark, sf), _organisation(spark, sf))


def _facts(spark, sf):
    stages = Stages(spark)
    organisation = stages.keep(_organisation(spark, sf), "organisation")
    return cross_reference(
        _tariff(spark, sf, stages=stages), user_directory(views.users(spark, sf), organisation), organisation
    )


def q_cross_reference(spark, sf):
    return _facts(spark, sf)


def q_stats_export(spark, sf):
    return stats_export(_facts(spark, sf))


def q_office_export(spark, sf):
    return office_export(_facts(spark, sf))


def q_rerun_cross_reference(spark, sf):
    """The facts of a day from its stored calls and directory, with an organisation that was read
    again; the day is run twice."""
    stages = Stages(spark)
    organisation = stages.keep(_organisation(spark, sf), "organisation")
    result, label = stages.path("result"), views.AS_OF.isoformat()
    write_day(_tariff(spark, sf, stages=stages), f"{result}/tariffs", label)
    write_day(user_directory(views.users(spark, sf), organisation), f"{result}/users", label)
    rerun_cross_reference(spark, result, views.AS_OF, organisation.limit(0))
    return rerun_cross_reference(spark, result, views.AS_OF, organisation).drop("jour")


def q_changed_days(spark, sf):
    """Days that a corrected directory changes: an office has another name, another is gone, some numbers have
    moved. The index of all days is stored; no call is read for the answer."""
    stages = Stages(spark)
    old = stages.keep(_organisation(spark, sf), "organisation")
    new = old.where(F.col("Code_UA") != "0021773").withColumn(
        "Bureau", F.when(F.col("Code_UA") == "0011679", F.concat("Bureau", F.lit(" bis"))).otherwise(F.col("Bureau"))
    )
    users = views.users(spark, sf)
    moved = users.withColumn("Cost Center", F.when(F.col("Internal Number").endswith("77"), "001 16 79").otherwise(F.col("Cost Center")))
    tariffs = _tariff(spark, sf, stages=stages)
    pairs = stages.keep(day_index(tariffs, F.substring("InitialStartDateTime", 1, 10)), "pairs")
    write_index(pairs, stages.path("index"))
    index = spark.read.schema("jour string, number string, code string").orc(stages.path("index"))
    return changed_days(index, user_directory(users, old), user_directory(moved, new), old, new)


def q_daily_run(spark, sf):
    """All stages over the derived day files, reported per day, office and outcome."""
    facts = day_facts(
        views.tickets(spark, sf), views.ivr_blocks(spark, sf), views.ivr_calls(spark, sf),
        views.reference(spark, sf), views.AS_OF, Stages(spark), "UTC",
    )
    return (
        stats_export(facts)
        .groupBy("Date", "SAGES", "Origine", "Aboutissement_SVI", "Appel_vers")
        .agg(
            F.count("*").alias("n_calls"),
            F.sum("Appels_recus").alias("received"),
            F.sum("Appels_emis").alias("emitted"),
            F.sum("Appels_aboutis").alias("reached"),
            F.sum("Attente_avant_mise_en_relation").alias("waiting"),
        )
    )


def q_calls_by_outcome(spark, sf):
    """Received and emitted calls per day, origin and outcome. The matched calls and the legs are
    stored, since each is read more than once."""
    stages = Stages(spark)
    matched = stages.keep(_matched(spark, sf, stages), "matched")
    return (
        call_rules(matched, keep=stages.keep)
        .groupBy(F.substring("InitialStartDateTime", 1, 10).alias("day"), "Origine", "Aboutissement_SVI")
        .agg(
            F.count("*").alias("n_legs"),
            F.sum("Appels_recus").alias("received"),
            F.sum("Appels_emis").alias("emitted"),
        )
    )


# --- SQL ------------------------------------------------------------------------------

PREP_V2 = """
c1 AS (
  SELECT strftime(CAST("InitialStartDateTime" AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%g') AS "InitialStartDateTime",
    "TicketId", "CalledNumber", "CallingNumber", CAST("CallType" AS INTEGER) AS "CallType",
    CAST("EffectiveCallDuration" AS INTEGER) AS "EffectiveCallDuration", "InitialDialledNumber",
    strftime(CAST("StartDateTime" AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%g') AS "StartDateTime",
    "InternFacilities", nullif("ChargedNumber", '') AS "ChargedNumber", "CostCenter",
    CAST("WaitingDuration" AS DOUBLE) AS "WaitingDuration"
  FROM t
  WHERE NOT coalesce(length("CalledNumber") = 8 AND "CalledNumber" LIKE '1%', FALSE)
    AND NOT coalesce(length("ChargedNumber") = 8 AND "ChargedNumber" LIKE '1%', FALSE)
    AND NOT coalesce(length("CallingNumber") = 8 AND "CallingNumber" LIKE '1%', FALSE)
    AND NOT coalesce(length("InitialDialledNumber") = 8 AND "InitialDialledNumber" LIKE '1%', FALSE))"""

PREP_V1 = """
c1 AS (
  SELECT strftime(CAST("InitialStartDateTime" AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%g') AS "InitialStartDateTime",
    "TicketId", "CalledNumber", "CallingNumber", CAST("CallType" AS INTEGER) AS "CallType",
    CAST("EffectiveCallDuration" AS INTEGER) AS "EffectiveCallDuration",
    strftime(CAST("StartDateTime" AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%g') AS "StartDateTime",
    "InternFacilities", "ChargedNumber", "CostCenter",
    CAST("WaitingDuration" AS DOUBLE) AS "WaitingDuration"
  FROM t)"""

IVR_PREP = r"""
last_block AS (
  SELECT id, ms / 1000 AS bloc_duration, bloc_name FROM ivr_blocks
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY "timestamp" DESC) = 1),
motive AS (
  SELECT id, bloc_name AS Motif_appel, bloc_id FROM ivr_blocks WHERE contains(bloc_id, 'transfer_')
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY "timestamp" DESC) = 1),
c2 AS (
  SELECT l.id, l.bloc_duration, l.bloc_name, m.Motif_appel, m.bloc_id, c.caller, c.called,
    c.tenantname, c.treename, c.start, c.duration, c.endcause, c.transferredto,
    regexp_extract(l.bloc_name, '\W(\d\w{5,7})', 1) AS "SAGES_bloc",
    rtrim(regexp_extract(c.caller, 'sip:(.*)\@.*', 1)) AS temp_caller
  FROM last_block l LEFT JOIN motive m ON l.id = m.id JOIN ivr_calls c ON c.id = l.id)"""

DETAILS = [_plain(c) for c in DETAIL_COLUMNS]

NEAR = """
m AS (
  SELECT c1."TicketId", c2.*,
    CAST(abs(floor(start) - epoch(CAST("InitialStartDateTime" AS TIMESTAMP))) AS BIGINT) AS date_diff
  FROM c1 JOIN c2 ON "CalledNumber" = temp_caller
  WHERE abs(floor(start) - epoch(CAST("InitialStartDateTime" AS TIMESTAMP))) <= 4)"""

MATCH = f"""
{NEAR.strip()},
c3 AS (
  SELECT c1.*, m.temp_caller, m.endcause, m.date_diff,
    {", ".join(f'd."{c}"' for c in DETAILS)}
  FROM c1 LEFT JOIN m ON c1."TicketId" = m."TicketId"
  LEFT JOIN c2 d ON c1."CalledNumber" = d.temp_caller AND m.start = d.start)"""

MATCH_CARRIED = f"""
{NEAR.strip()},
c3 AS (
  SELECT c1.*, m.temp_caller, m.endcause, m.date_diff,
    {", ".join(f'CASE WHEN c1."CalledNumber" = m.temp_caller THEN m."{c}" END AS "{c}"' for c in DETAILS)}
  FROM c1 LEFT JOIN m ON c1."TicketId" = m."TicketId")"""


def _rules_sql(rules: str) -> str:
    v2 = rules == "v2"
    caller, ivr = "endcause = 'RELEASED By Caller'", "endcause = 'RELEASED By VAA'"
    asked = "Motif_appel IS NOT NULL"
    waited = f"({caller} AND {asked} AND bloc_duration > 60)"
    if v2:
        waited += f" OR ({ivr} AND {asked})"
    connect_ivr = f"WHEN {ivr} AND {asked} THEN recus" if v2 else ""
    deterred = f"{ivr} AND Motif_appel IS NULL" if v2 else ivr
    answered = (
        f"NOT ({caller}) AND NOT ({ivr})" if v2 else "endcause IS DISTINCT FROM 'RELEASED By Caller'"
    )
    zero = "WHEN \"CallType\" = 9 AND endcause = 'TRANSFERRED' THEN 0" if v2 else ""
    if v2:
        outcome = """CASE WHEN non_decroches = 1 THEN 'Appel non décroché' WHEN dissuades = 1 THEN 'Appel dissuadé'
          WHEN raccroches = 1 THEN 'Appel raccroché' WHEN decroches = 1 THEN 'Appel décroché' END"""
    else:
        outcome = f"""CASE WHEN {ivr} THEN 'Le SVI raccroche'
          WHEN {caller} AND Motif_appel IS NULL AND bloc_duration <= 60 THEN 'L''appelant raccroche'
          WHEN {caller} AND Motif_appel IS NULL AND bloc_duration > 60 THEN 'Mise en relation'
          WHEN {caller} AND {asked} THEN 'Mise en relation'
          WHEN endcause = 'TRANSFERRED' THEN 'Mise en relation' END"""
    return f"""
r0 AS (
  SELECT "InitialStartDateTime" AS isd, "CalledNumber" AS num, min("StartDateTime") AS sd FROM c3
  WHERE endcause IS NOT NULL AND "CallType" = 4 GROUP BY 1, 2),
r1 AS (
  SELECT c3.* EXCLUDE ("InternFacilities"), "SAGES_bloc" AS "SAGES",
    CAST(substr("InternFacilities", 6, 1) AS INTEGER) AS fu,
    CAST(substr("InternFacilities", 7, 1) AS INTEGER) AS fb,
    CAST(substr("InternFacilities", 8, 1) AS INTEGER) AS fn,
    CAST(substr("InternFacilities", 32, 1) AS INTEGER) AS vm,
    CAST(substr("InternFacilities", 9, 1) AS INTEGER) * CASE WHEN sd IS NULL THEN 1 ELSE 0 END AS tr
  FROM c3 LEFT JOIN r0 ON "InitialStartDateTime" = isd AND "CalledNumber" = num AND "StartDateTime" = sd
  WHERE "ChargedNumber" IS NOT NULL),
r2 AS (
  SELECT * REPLACE (CASE WHEN tr = 1 THEN "CallingNumber" ELSE "ChargedNumber" END AS "ChargedNumber"),
    CASE WHEN "CallType" IN (0, 3, 7, 8) THEN 'Appel émis' WHEN "CallType" IN (4, 9, 13) THEN 'Appel reçu'
      ELSE 'Inconnu' END AS kind,
    CASE WHEN length("CalledNumber") > 8 OR length("CalledNumber") = 4 THEN 'Externe'
      WHEN length("CalledNumber") <= 8 THEN 'Interne' ELSE 'Inconnu' END AS reach
  FROM r1 WHERE "CallType" <> 14
  UNION ALL SELECT *, 'Appel émis', 'Interne' FROM r1 WHERE "CallType" = 14
  UNION ALL SELECT * REPLACE ("ChargedNumber" AS "CalledNumber", "CalledNumber" AS "ChargedNumber",
      CAST(NULL AS VARCHAR) AS endcause), 'Appel reçu', 'Interne' FROM r1 WHERE "CallType" = 14
  UNION ALL SELECT * REPLACE ("ChargedNumber" AS "CalledNumber", "CallingNumber" AS "ChargedNumber",
      CAST(NULL AS VARCHAR) AS endcause, CAST(NULL AS INTEGER) AS tr), 'Appel émis', 'Interne'
    FROM r1 WHERE tr = 1 AND "CallType" <> 9
  UNION ALL SELECT * REPLACE ("CallingNumber" AS "CalledNumber", CAST(NULL AS VARCHAR) AS endcause,
      CAST(NULL AS INTEGER) AS tr), 'Appel reçu', 'Interne'
    FROM r1 WHERE tr = 1 AND "CallType" <> 9),
r3 AS (
  SELECT *, CASE WHEN endcause IS NOT NULL THEN 'SVI' WHEN "CallType" = 9 THEN 'SVI non reconnu'
      ELSE 'Direct' END AS origine,
    CASE WHEN "CallType" = 9 AND endcause = 'TRANSFERRED' THEN 0 WHEN tr = 1 THEN 0
      WHEN kind = 'Appel reçu' THEN 1 END AS recus,
    substr("InitialStartDateTime", 1, 10) AS d
  FROM r2),
r4 AS (SELECT "CalledNumber" AS num, d AS day, CAST(sum(recus) AS BIGINT) AS total FROM r3 GROUP BY 1, 2),
r5 AS (
  SELECT r3.*, CASE WHEN kind = 'Appel reçu' THEN total END AS appels,
    CASE WHEN endcause = 'TRANSFERRED' THEN recus
      WHEN {caller} AND {asked} AND bloc_duration > 60 THEN recus {connect_ivr} END AS relation,
    CASE WHEN {deterred} THEN recus END AS dissuades,
    CASE WHEN {caller} AND (Motif_appel IS NULL OR bloc_duration <= 60) THEN recus END AS raccroches,
    CASE WHEN origine = 'Direct' AND reach = 'Interne' THEN recus END AS di,
    CASE WHEN origine = 'Direct' AND reach = 'Externe' THEN recus END AS de
  FROM r3 LEFT JOIN r4 ON "CalledNumber" = num AND d = day),
r6 AS (SELECT *, CASE WHEN di = 1 OR de = 1 OR relation = 1 THEN recus END AS aboutis FROM r5),
r7 AS (
  SELECT *, CASE WHEN aboutis = 1 AND "EffectiveCallDuration" > 0 AND {answered} THEN recus ELSE 0 END AS decroches,
    CASE WHEN (aboutis = 1 AND "EffectiveCallDuration" = 0) OR {waited} THEN recus END AS non_decroches
  FROM r6),
c4 AS (
  SELECT "InitialStartDateTime", "TicketId", "CalledNumber", "CallingNumber", "CallType", "WaitingDuration",
    "EffectiveCallDuration", "StartDateTime", "ChargedNumber", id AS "id", duration AS "duration",
    endcause AS "endcause", transferredto AS "transferredto", bloc_name AS "bloc_name",
    bloc_duration AS "bloc_duration", Motif_appel AS "Motif_appel", "SAGES" AS "SAGES",
    fu AS "CallForwardingUnconditional", fb AS "CallForwardingOnBusy", fn AS "CallForwardingOnNoReply",
    tr AS "Appel_transfere", vm AS "VoiceMail", kind AS "Type_appel",
    reach AS "calledNumber_externe_interne", origine AS "Origine",
    CASE WHEN kind = 'Appel reçu' AND origine = 'SVI' THEN 'SVI'
      WHEN kind = 'Appel reçu' AND origine = 'Direct' AND reach = 'Externe' THEN 'Appel entrant direct externe'
      WHEN kind = 'Appel reçu' AND origine = 'Direct' AND reach = 'Interne' THEN 'Appel entrant direct interne'
      END AS "Origine_appel_entrant",
    CASE WHEN kind = 'Appel émis' THEN 1 ELSE 0 END AS "Appels_emis", recus AS "Appels_recus",
    appels AS "Appels", relation AS "Mise_en_relation",
    CASE WHEN origine = 'SVI' AND endcause <> 'NOT ENOUGH LICENSE' THEN recus END AS "Appels_SVI",
    dissuades AS "Appels_dissuades", raccroches AS "Appels_raccroches",
    CASE WHEN endcause = 'NOT ENOUGH LICENSE' THEN recus END AS "Appels_sans_license",
    CASE WHEN "CallType" = 9 AND endcause IS NULL THEN recus END AS "Appels_SVI_non_reconnu",
    di AS "Appels_directs_internes", de AS "Appels_directs_externes", aboutis AS "Appels_aboutis",
    decroches AS "Appels_decroches", non_decroches AS "Appels_non_decroches",
    CASE WHEN tr = 1 THEN tr END AS "Appels_transferes",
    CASE WHEN fu = 1 OR fb = 1 OR fn = 1 THEN recus END AS "Appels_renvoyes",
    CASE WHEN endcause = 'TRANSFERRED' AND "EffectiveCallDuration" > 0 THEN bloc_duration
      WHEN kind = 'Appel reçu' AND origine = 'Direct' THEN "WaitingDuration" {zero}
      END AS "Attente_avant_mise_en_relation",
    CASE WHEN "CallType" = 9 THEN "EffectiveCallDuration" END AS "Duree_de_navigation",
    CASE WHEN "CallType" = 9 THEN 0 WHEN kind IN ('Appel reçu', 'Appel émis') THEN "EffectiveCallDuration"
      END AS "Duree_de_communication",
    CASE WHEN "CallType" = 4 THEN "ChargedNumber" END AS "postes_logges",
    {outcome} AS "Aboutissement_SVI",
    CASE WHEN {asked} OR origine = 'Direct' THEN 'Horaire d’ouverture'
      WHEN Motif_appel IS NULL AND origine = 'SVI' THEN 'Horaire de fermeture' END AS "Horaire_ouverture"
  FROM r7)"""


def _quoted(names: list[str]) -> str:
    return ", ".join(f'"{n}"' for n in names)


def _tariff_sql(rules: str, listed: bool = False) -> str:
    if rules == "v2":
        inside, urgent, other = "Numéros internes", "Numéros d''urgence", "Numéros internes"
    else:
        inside, urgent, other = "N° courts (urgence)", "N° courts (services)", "N° courts (autre)"
    distinct = "" if listed else "DISTINCT"
    compared = _quoted([c for c in fv.RULE_COLUMNS if c not in ("Aboutissement_SVI", "Motif_appel")])
    rule_columns = _quoted(fv.RULE_COLUMNS)
    with_nulls = ", ".join(
        'CAST(NULL AS VARCHAR) AS "%s"' % c if c in ("Aboutissement_SVI", "Motif_appel") else f'"{c}"'
        for c in fv.RULE_COLUMNS
    )
    classes = [
        ("length(\"CalledNumber\") = 10 AND \"CalledNumber\" LIKE '08%'", 4, "Numéros spéciaux"),
        ("length(\"CalledNumber\") = 10 AND \"CalledNumber\" LIKE '07%'", 3, "National"),
        (
            "length(\"CalledNumber\") = 10 AND \"CalledNumber\" NOT LIKE '07%' "
            "AND \"CalledNumber\" NOT LIKE '08%'", 2, "National",
        ),
        ("length(\"CalledNumber\") = 4", 2, "N° courts"),
    ]
    looked_up = "\n  UNION ALL ".join(
        f"""SELECT {rule_columns}, NULL AS "Indicatif_numero", NULL AS "Pays",
          CASE WHEN debut IS NOT NULL THEN 'Forfait' ELSE 'Hors forfait' END AS "Appel_facturable",
          '{to}' AS "Appel_vers"
        FROM c4 LEFT JOIN prefixes ON substr("CalledNumber", 1, {size}) = debut
          AND length("CalledNumber") = longueur WHERE {condition}"""
        for condition, size, to in classes
    )
    fixed = "\n  UNION ALL ".join(
        f"""SELECT {rule_columns}, NULL, NULL, 'Forfait', '{to}' FROM c4 WHERE {condition}"""
        for condition, to in [
            ('length("CalledNumber") = 8', inside),
            ("\"CalledNumber\" IN ('15', '17', '18')", urgent),
            (
                'length("CalledNumber") < 10 AND length("CalledNumber") NOT IN (4, 8) '
                "AND \"CalledNumber\" NOT IN ('15', '17', '18')", other,
            ),
        ]
    )
    return f"""
prefixes AS (SELECT {distinct} debut, CAST(longueur AS INTEGER) AS longueur FROM plan WHERE debut IS NOT NULL),
covered AS (SELECT {distinct} indicatif FROM plan WHERE indicatif IS NOT NULL),
countries AS (SELECT indicatif, string_agg(pays, ', ' ORDER BY pays) AS pays FROM codes GROUP BY 1),
abroad AS (SELECT * FROM c4 WHERE length("CalledNumber") > 10),
tried AS (
  SELECT abroad.*, substr(regexp_replace("CalledNumber", '^00', ''), 1, k) AS code
  FROM abroad, (VALUES (2), (3)) AS p(k) WHERE "Type_appel" = 'Appel émis'),
hits AS (
  SELECT tried.*, countries.pays FROM tried LEFT JOIN countries ON code = countries.indicatif
  JOIN covered ON code = covered.indicatif),
c5 AS (
  SELECT * REPLACE (CASE WHEN "Appel_vers" = 'N° courts' AND "Type_appel" = 'Appel émis' THEN 'Externe'
      ELSE "calledNumber_externe_interne" END AS "calledNumber_externe_interne")
  FROM ({looked_up}
  UNION ALL {fixed}
  UNION ALL SELECT {rule_columns}, code, pays, 'Forfait', 'International' FROM hits
  UNION ALL SELECT {with_nulls}, NULL, NULL, 'Hors forfait', 'International'
    FROM (SELECT DISTINCT {compared} FROM tried
          WHERE NOT EXISTS (SELECT 1 FROM hits WHERE hits."TicketId" = tried."TicketId"))
  UNION ALL SELECT {rule_columns}, NULL, NULL, NULL, 'International' FROM abroad
    WHERE "Type_appel" = 'Appel reçu'))"""


def _organisation_sql(open_ended_only: bool = False, labels: bool = False) -> str:
    fields = ", ".join(
        f'trim(substr(value, {max(int(start), 1)}, {size})) AS "{name}"'
        for name, start, size in views.LAYOUT
    )
    # An expired or unreadable end is not a later date than the reference day.
    later = (
        "" if open_ended_only else
        f"OR try_strptime(\"Date_limite_de_validite\", '%Y%m%d') > DATE '{views.AS_OF}'"
    )
    parents = ', ci."Libelle_long_1" AS "Centre_des_Impots", di."Libelle_long_1" AS "Direction"'
    return f"""
cut AS (SELECT {fields} FROM lines),
current_units AS (
  SELECT * FROM (
    SELECT * FROM cut WHERE "Code_type_de_structure" <> 'CTURE'
    QUALIFY row_number() OVER (PARTITION BY "Code_UA" ORDER BY "Date_limite_de_validite" DESC) = 1)
  WHERE "Date_limite_de_validite" = '99999999' {later}),
org AS (
  SELECT u."Code_UA", u."Code_type_de_structure", u."Etat",
    CAST(try_strptime(u."Date_deffet_de_letat", '%Y%m%d') AS DATE) AS "Date_deffet_de_letat",
    u."DIR_hierarchique", u."CI_hierarchique", u."CB_hierarchique", u."Libelle_court_1" AS "Bureau_court",
    u."Libelle_court_2", u."Libelle_long_2" AS "Bureau_2", u."Libelle_long_1" AS "Bureau"
    {parents if labels else ""}
  FROM current_units u
  JOIN current_units ci ON u."CI_hierarchique" = ci."Code_UA" AND length(ci."Code_UA") = 5
    AND ci."CB_hierarchique" = '' AND ci."CI_hierarchique" = '' AND ci."DIR_hierarchique" <> ''
  JOIN current_units di ON u."DIR_hierarchique" = di."Code_UA" AND length(di."Code_UA") = 3
    AND di."CB_hierarchique" = '' AND di."CI_hierarchique" = '' AND di."DIR_hierarchique" = ''
  WHERE length(u."Code_UA") = 7 AND u."CB_hierarchique" = '' AND u."CI_hierarchique" <> ''
    AND u."DIR_hierarchique" <> '')"""


USER_DIRECTORY = """
c7 AS (
  SELECT internal AS "Internal_Number", substr(replace(center, ' ', ''), 1, 7) AS "Cost_Center", "Code_UA"
  FROM users JOIN org ON "Code_UA" = substr(replace(center, ' ', ''), 1, 7))"""

ORGANISATION_OUTPUT = [
    fv.ORGANISATION_RENAMES.get(c, c) for c in fv.ORGANISATION_COLUMNS
]
_kept = [
    c for c in fv.CROSS_REFERENCE_COLUMNS
    if c not in ("InitialStartDateTime", "SAGES", "Attente_avant_mise_en_relation")
]

CROSS_REFERENCE = f"""
x1 AS (
  SELECT c5.* REPLACE (CASE WHEN "Cost_Center" IS NULL OR "Cost_Center" = ''
      THEN substr(replace("SAGES", ' ', ''), 1, 7) ELSE "Cost_Center" END AS "SAGES")
  FROM c5 LEFT JOIN c7 ON "ChargedNumber" = "Internal_Number"
  WHERE NOT coalesce(endcause = 'NOT ENOUGH LICENSE' OR ("CallType" = 9 AND endcause = 'TRANSFERRED'), FALSE)),
x2 AS (
  SELECT *, CAST("InitialStartDateTime" AS TIMESTAMP) AS ts FROM x1 JOIN org ON trim("SAGES") = "Code_UA"
  WHERE "SAGES" <> ''),
x3 AS (
  SELECT *, CAST(minute(ts) AS INTEGER) AS mi, CAST(hour(ts) AS INTEGER) AS ho,
    CASE WHEN minute(ts) < 15 THEN '00-15' WHEN minute(ts) < 30 THEN '15-30'
      WHEN minute(ts) < 45 THEN '30-45' ELSE '45-00' END AS qu FROM x2),
c8 AS (
  SELECT {_quoted(_kept)}, trim("SAGES") AS "SAGES", {_quoted(ORGANISATION_OUTPUT)},
    strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "InitialStartDateTime", mi AS "Minutes", ho AS "Hour",
    CAST(ts AS DATE) AS "Date",
    CASE dayofweek(ts) WHEN 0 THEN 'dimanche' WHEN 1 THEN 'lundi' WHEN 2 THEN 'mardi'
      WHEN 3 THEN 'mercredi' WHEN 4 THEN 'jeudi' WHEN 5 THEN 'vendredi' ELSE 'samedi' END AS "dayofweek",
    qu AS "quarter",
    ho || ':' || substr(qu, 1, 2) || ' - '
      || CASE WHEN mi < 45 THEN CAST(ho AS VARCHAR) WHEN ho = 23 THEN '00' ELSE CAST(ho + 1 AS VARCHAR) END
      || ':' || substr(qu, 4, 2) AS "Lib_hour",
    "Bureau_court" || ' ' || "Bureau_2" AS "Service",
    CAST(round_even("Attente_avant_mise_en_relation", 0) AS INTEGER) AS "Attente_avant_mise_en_relation"
  FROM x3)"""

STATS = "stats AS (SELECT DISTINCT " + ", ".join(
    f'"{source}" AS "{name}"' for source, name in fv.EXPORT_COLUMNS
) + " FROM c8)"

_to_match = [BASE_SQL, TICKETS_SQL, PREP_V2, IVR_SQL, IVR_PREP, MATCH]
_to_match_v1 = [BASE_SQL, TICKETS_SQL, PREP_V1, IVR_SQL, IVR_PREP, MATCH]
_to_rules = [*_to_match, _rules_sql("v2")]
_to_tariff = [*_to_rules, PLAN_SQL, _tariff_sql("v2")]
_to_facts = [
    *_to_tariff, USERS_SQL, ORGANISATION_SQL, _organisation_sql(), USER_DIRECTORY, CROSS_REFERENCE,
]

def _renamed(sql: str, names: dict[str, str]) -> str:
    return re.sub(r"\b(" + "|".join(names) + r")\b", lambda m: names[m[0]], sql)


# The whole facts under the corrected directory, beside those under the old one.
_CORRECTED = [
    """new_org AS (SELECT * REPLACE (CASE WHEN "Code_UA" = '0011679' THEN "Bureau" || ' bis' ELSE "Bureau" END AS "Bureau")
  FROM org WHERE "Code_UA" <> '0021773')""",
    """new_users AS (SELECT * REPLACE (CASE WHEN internal LIKE '%77' THEN '001 16 79' ELSE center END AS center) FROM users)""",
    _renamed(USER_DIRECTORY, {"c7": "new_c7", "users": "new_users", "org": "new_org"}),
    _renamed(CROSS_REFERENCE, {"c7": "new_c7", "org": "new_org", "x1": "new_x1", "x2": "new_x2", "x3": "new_x3", "c8": "new_c8"}),
]

QUERIES = {
    "changed_days": q_changed_days,
    "ticket_prep": q_ticket_prep,
    "ticket_prep_v1": q_ticket_prep_v1,
    "ivr_prep": q_ivr_prep,
    "tolerance_left": q_tolerance_left,
    "rerun_cross_reference": q_rerun_cross_reference,
    "tolerance_left_by_day": q_tolerance_left_by_day,
    "tolerance_left_carried": q_tolerance_left_carried,
    "call_rules_v2": q_call_rules_v2,
    "call_rules_v1": q_call_rules_v1,
    "tariff_classify": q_tariff_classify,
    "tariff_classify_listed": q_tariff_classify_listed,
    "tariff_classify_v1": q_tariff_classify_v1,
    "org_directory": q_org_directory,
    "org_directory_labels": q_org_directory_labels,
    "user_directory": q_user_directory,
    "cross_reference": q_cross_reference,
    "stats_export": q_stats_export,
    "office_export": q_office_export,
    "daily_run": q_daily_run,
    "calls_by_outcome": q_calls_by_outcome,
}

_match_select = "SELECT " + ", ".join(f'"{_plain(c)}"' for c in MATCH_OUTPUT) + " FROM c3"

SQL = {
    "changed_days": with_views(
        *_to_facts, *_CORRECTED,
        select="""
        SELECT DISTINCT substr("InitialStartDateTime", 1, 10) AS jour FROM (
          (SELECT * FROM c8 EXCEPT ALL SELECT * FROM new_c8) UNION ALL (SELECT * FROM new_c8 EXCEPT ALL SELECT * FROM c8))""",
    ),
    "ticket_prep": with_views(BASE_SQL, TICKETS_SQL, PREP_V2, select="SELECT * FROM c1"),
    "ticket_prep_v1": with_views(BASE_SQL, TICKETS_SQL, PREP_V1, select="SELECT * FROM c1"),
    "ivr_prep": with_views(BASE_SQL, IVR_SQL, IVR_PREP, select="SELECT * FROM c2"),
    "tolerance_left": with_views(*_to_match, select=_match_select),
    "tolerance_left_by_day": with_views(*_to_match, select=_match_select),
    "tolerance_left_carried": with_views(*_to_match[:-1], MATCH_CARRIED, select=_match_select),
    "call_rules_v2": with_views(*_to_rules, select="SELECT * FROM c4"),
    "call_rules_v1": with_views(*_to_match_v1, _rules_sql("v1"), select="SELECT * FROM c4"),
    "tariff_classify": with_views(*_to_tariff, select="SELECT * FROM c5"),
    "tariff_classify_listed": with_views(
        *_to_rules, PLAN_SQL, _tariff_sql("v2", listed=True), select="SELECT * FROM c5"
    ),
    "tariff_classify_v1": with_views(
        *_to_match_v1, _rules_sql("v1"), PLAN_SQL, _tariff_sql("v1"), select="SELECT * FROM c5"
    ),
    "org_directory": with_views(ORGANISATION_SQL, _organisation_sql(), select="SELECT * FROM org"),
    "org_directory_labels": with_views(
        ORGANISATION_SQL, _organisation_sql(True, True), select="SELECT * FROM org"
    ),
    "user_directory": with_views(
        BASE_SQL, USERS_SQL, ORGANISATION_SQL, _organisation_sql(), USER_DIRECTORY,
        select="SELECT * FROM c7",
    ),
    "cross_reference": with_views(*_to_facts, select="SELECT * FROM c8"),
    "rerun_cross_reference": with_views(*_to_facts, select="SELECT * FROM c8"),
    "stats_export": with_views(*_to_facts, STATS, select="SELECT * FROM stats"),
    "office_export": with_views(*_to_facts, select='SELECT DISTINCT "SAGES" FROM c8'),
    "daily_run": with_views(
        *_to_facts, STATS,
        select="""
        SELECT "Date", "SAGES", "Origine", "Aboutissement_SVI", "Appel_vers", count(*) AS n_calls,
          CAST(sum("Appels_recus") AS BIGINT) AS received, CAST(sum("Appels_emis") AS BIGINT) AS emitted,
          CAST(sum("Appels_aboutis") AS BIGINT) AS reached,
          CAST(sum("Attente_avant_mise_en_relation") AS BIGINT) AS waiting
        FROM stats GROUP BY 1, 2, 3, 4, 5""",
    ),
    "calls_by_outcome": with_views(
        *_to_rules,
        select="""
        SELECT substr("InitialStartDateTime", 1, 10) AS day, "Origine", "Aboutissement_SVI",
          count(*) AS n_legs, CAST(sum("Appels_recus") AS BIGINT) AS received,
          CAST(sum("Appels_emis") AS BIGINT) AS emitted
        FROM c4 GROUP BY 1, 2, 3""",
    ),
}
