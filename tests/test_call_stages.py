"""Stages on small hand-made data: the corner cases of the rules."""

import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F

from callweave import fixed_values as fv
from callweave.operators.contract import ColumnContractError
from callweave.plans import (
    call_legs,
    call_rules,
    cross_reference,
    ivr_prep,
    match_calls,
    office_export,
    org_directory,
    stats_export,
    tariff_classify,
    ticket_prep,
    user_directory,
)
from callweave.fixed_values import DETAIL_COLUMNS, TICKET_COLUMNS
from callweave.sources import synthetic_tickets
from conftest import rows

TICKET_FIELDS = [p.split()[0] for p in fv.TICKET_DDL.split(",")]


def ticket(**values):
    base = dict(
        InitialStartDateTime="2024-01-05 10:00:00", TicketId="1", CalledNumber="0612345678",
        CallingNumber="41111111", CallType="4", EffectiveCallDuration="30",
        InitialDialledNumber=None, StartDateTime="2024-01-05 10:00:00",
        InternFacilities="0" * 40, ChargedNumber="31111111", CostCenter=None, WaitingDuration="3",
    )
    return {**base, **values}


def raw_tickets(spark, tickets):
    return spark.createDataFrame([tuple(t[c] for c in TICKET_FIELDS) for t in tickets], fv.TICKET_DDL)


# --- tickets ------------------------------------------------------------------------


@pytest.mark.parametrize("column", ["CalledNumber", "ChargedNumber", "CallingNumber", "InitialDialledNumber"])
def test_tickets_with_a_service_number_in_any_column_are_excluded(spark, column):
    assert synthetic_tickets(spark, 100, excluded_column=column).transform(ticket_prep).count() == 0
    valid = synthetic_tickets(spark, 100)
    assert ticket_prep(valid).count() == 100
    assert ticket_prep(valid.withColumn(column, F.lit(None).cast("string"))).count() == 100
    assert ticket_prep(synthetic_tickets(spark, 100, excluded_column=column), "v1").count() == 100


def test_ticket_values_are_cleaned(spark):
    got = ticket_prep(raw_tickets(spark, [ticket(ChargedNumber="", CallType="NULL", EffectiveCallDuration="", WaitingDuration="x")]))
    row = got.collect()[0]
    assert row.InitialStartDateTime == "2024-01-05 10:00:00.000"
    assert row.ChargedNumber is row.CallType is row.EffectiveCallDuration is row.WaitingDuration is None
    assert "InitialDialledNumber" in got.columns
    old = ticket_prep(raw_tickets(spark, [ticket(ChargedNumber="")]), "v1")
    assert old.collect()[0].ChargedNumber == "" and "InitialDialledNumber" not in old.columns


def test_missing_ticket_column_is_named(spark):
    with pytest.raises(ColumnContractError, match="CallType"):
        ticket_prep(raw_tickets(spark, [ticket()]).drop("CallType"))


# --- voice-response calls -------------------------------------------------------------


def blocks(spark, data):
    ddl = "id string, timestamp double, `bloc id` string, `bloc name` string, `duration (ms)` int"
    return spark.createDataFrame(data, ddl).withColumns(
        {"event": F.lit("x"), "createdate": F.timestamp_seconds("timestamp")}
    )


def calls(spark, data):
    ddl = ("id string, caller string, called string, tenantname string, treename string, start double, "
           "duration double, endcause string, transferredto string")
    return spark.createDataFrame(data, ddl)


def call(name, number, start, cause="TRANSFERRED"):
    return (name, f"sip:{number}@node;user=phone", "57711700", "t", "tr", start, 12.0, cause, None)


def test_ivr_prep_last_and_transfer_block(spark):
    got = ivr_prep(
        blocks(spark, [
            ("a", 1.0, "menu_1", "M", 500), ("a", 3.0, "transfer_1", "T1", 700), ("a", 5.0, "transfer_2", "T2 1-4 1234567", 12247),
            ("a", 4.0, "menu", "N", 1), ("b", 1.0, "menu", "B", None), ("c", 1.0, "menu", "C", 1),
        ]),
        calls(spark, [call("a", "0612 ", 100.5), call("b", "07", 5.0), call("z", "07", 5.0)]),
    )
    assert rows(got, "id", "bloc duration", "bloc name", "Motif appel", "bloc id", "SAGES (bloc)", "temp_caller") == [
        ("a", 12.247, "T2 1-4 1234567", "T2 1-4 1234567", "transfer_2", "1234567", "0612"),
        ("b", None, "B", None, None, "", "07"),
    ]
    with pytest.raises(ColumnContractError, match="bloc id"):
        ivr_prep(blocks(spark, []).drop("bloc id"), calls(spark, []))


# --- matching -------------------------------------------------------------------------


def reference_match(tickets, ivr, tolerance=4):
    """The three steps of the rule, row by row. tickets: (id, number, second, row);
    ivr: (call, caller, start, cause)."""
    near = [(t[0], i) for t in tickets for i in ivr
            if t[1] is not None and t[1] == i[1] and abs(int(i[2]) - t[2]) <= tolerance]
    by_id = {}
    for name, i in near:
        by_id.setdefault(name, []).append(i)
    out = []
    for name, number, second, row in tickets:
        for i in by_id.get(name, [None]) if name is not None else [None]:
            again = [d for d in ivr if i is not None and number == d[1] and d[2] == i[2]]
            for d in again or [None]:
                out.append((row, i and i[3], i and i[1], d and d[0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_match_calls_equals_the_rule_with_shared_ids_and_starts(spark, seed):
    rnd = random.Random(seed)
    numbers = ["15", "15", "15", "0612345678", None]
    base = 1704448800  # 2024-01-05 10:00:00 UTC
    seconds = [base + rnd.randrange(40) for _ in range(60)]
    tickets = [(rnd.choice([f"t{n}", f"t{n % 20}", None]), rnd.choice(numbers), s, f"r{n}") for n, s in enumerate(seconds)]
    ivr = [(f"c{n}", rnd.choice(["15", "0612345678"]), base + rnd.randrange(40) + rnd.choice([0.0, 0.5]), f"e{n}") for n in range(25)]
    made = raw_tickets(spark, [
        ticket(TicketId=t, CalledNumber=k, WaitingDuration=None, CostCenter=r,
               InitialStartDateTime=datetime.datetime.fromtimestamp(s, datetime.UTC).strftime("%Y-%m-%d %H:%M:%S"))
        for t, k, s, r in tickets
    ])
    prepared_ivr = ivr_prep(
        blocks(spark, [(c, 1.0, "menu", "B", 1) for c, *_ in ivr]),
        calls(spark, [call(c, k, s, e) for c, k, s, e in ivr]),
    )
    got = match_calls(ticket_prep(made), prepared_ivr, "UTC")
    assert got.columns == TICKET_COLUMNS + ["started_datetime", "temp_caller", "endcause", "date_diff"] + DETAIL_COLUMNS
    found = sorted([tuple(r) for r in got.select("CostCenter", "endcause", "temp_caller", "id").collect()], key=str)
    assert found == reference_match(tickets, ivr)


def test_carried_details_are_the_same_without_shared_starts(spark):
    made = raw_tickets(spark, [ticket(TicketId=str(i), CalledNumber="15", InitialStartDateTime=f"2024-01-05 10:00:{i:02d}") for i in range(40)])
    base = 1704448800
    ivr = ivr_prep(
        blocks(spark, [(f"c{i}", 1.0, "menu", "B", 1) for i in range(15)]),
        calls(spark, [call(f"c{i}", "15", base + i * 3 + 0.25) for i in range(15)]),
    )
    exact, carried = (match_calls(ticket_prep(made), ivr, "UTC", details=d) for d in ("exact", "carried"))
    assert exact.columns == carried.columns
    assert rows(exact) == rows(carried) and exact.count() > 60


def test_match_uses_the_zone_of_the_tickets(spark, zone):
    made = raw_tickets(spark, [ticket(InitialStartDateTime="2022-04-27 00:00:35.000", CalledNumber="0623510002", CallType="9")])
    ivr = ivr_prep(blocks(spark, [("c", 1.0, "menu", "1-4 HNO", 12247)]), calls(spark, [call("c", "0623510002", 1651010437.323)]))
    for session_zone in ("UTC", "Asia/Tokyo"):
        zone(session_zone)
        assert rows(match_calls(ticket_prep(made), ivr, "Europe/Paris"), "date_diff", "id") == [(2, "c")]
        assert rows(match_calls(ticket_prep(made), ivr, "UTC"), "date_diff", "id") == [(None, None)]


# --- rules ----------------------------------------------------------------------------

MATCH_DDL = (
    "TicketId string, InitialStartDateTime string, StartDateTime string, CalledNumber string, InternFacilities string, "
    "CallType string, ChargedNumber string, EffectiveCallDuration string, CostCenter string, CallingNumber string, "
    "WaitingDuration string, endcause string, id string, `bloc duration` string, `bloc name` string, `Motif appel` string, "
    "`bloc id` string, duration string, transferredto string, `SAGES (bloc)` string"
)
MATCH_FIELDS = [p.strip().rsplit(" ", 1)[0].strip("`") for p in MATCH_DDL.split(",")]


def matched(spark, *changes):
    base = {
        "TicketId": "1", "InitialStartDateTime": "2024-01-05 10:00:00.000", "StartDateTime": "2024-01-05 10:00:00.000",
        "CalledNumber": "0612345678", "InternFacilities": "0" * 40, "CallType": "9", "ChargedNumber": "31111111",
        "EffectiveCallDuration": "30", "CallingNumber": "41111111", "WaitingDuration": "3",
    }
    data = [{**base, "TicketId": str(n), **c} for n, c in enumerate(changes)]
    return spark.createDataFrame([tuple(d.get(f) for f in MATCH_FIELDS) for d in data], MATCH_DDL)


def facilities(*positions):
    return "".join("1" if i in positions else "0" for i in range(1, 41))


def test_rules_have_48_columns_and_typed_counts(spark):
    got = call_rules(matched(spark, {}, {"CallType": "14"}, {"CallType": "0"}))
    assert got.columns == fv.RULE_COLUMNS and len(got.columns) == 48
    assert {r.Appels_emis for r in got.collect()} <= {0, 1}
    assert dict(got.dtypes)["Appels_transferes"] == "int"
    assert dict(got.dtypes)["Attente_avant_mise_en_relation"] == "double"


def test_fixture_call_of_a_caller_who_hung_up(spark):
    one = {
        "CalledNumber": "0623510002", "CallType": "9", "ChargedNumber": "57711700", "EffectiveCallDuration": "12",
        "InternFacilities": facilities(24), "endcause": "RELEASED By Caller", "bloc duration": "12.247",
        "bloc name": "1-4 HNO", "CallingNumber": "NULL", "WaitingDuration": "0",
    }
    row = call_rules(matched(spark, one)).collect()[0]
    assert (row.Origine, row.Type_appel, row.Appels_recus, row.Appels) == ("SVI", "Appel reçu", 1, 1)
    assert (row.Appels_raccroches, row.Aboutissement_SVI) == (1, "Appel raccroché")
    assert (row.Appels_decroches, row.Appels_non_decroches, row.Mise_en_relation) == (0, None, None)
    assert (row.Duree_de_navigation, row.Duree_de_communication) == (12, 0)
    assert row.Horaire_ouverture == "Horaire de fermeture"


def test_rows_without_charged_number_or_call_type_have_no_leg(spark):
    assert call_legs(matched(spark, {"ChargedNumber": None}, {"CallType": None}, {"CallType": "x"})).isEmpty()


def test_internal_call_is_emitted_and_received(spark):
    legs = call_legs(matched(spark, {"CallType": "14", "CalledNumber": "52222222", "endcause": "TRANSFERRED"}))
    assert rows(legs, "Type_appel", "CalledNumber", "ChargedNumber", "endcause", "calledNumber_externe_interne") == [
        ("Appel reçu", "31111111", "52222222", None, "Interne"),
        ("Appel émis", "52222222", "31111111", "TRANSFERRED", "Interne"),
    ]


def test_transferred_call_has_two_more_legs(spark):
    one = {"CallType": "4", "InternFacilities": facilities(9)}
    legs = call_legs(matched(spark, one))
    assert rows(legs, "Type_appel", "CalledNumber", "ChargedNumber", "Appel_transfere") == [
        ("Appel reçu", "0612345678", "41111111", 1),
        ("Appel reçu", "41111111", "31111111", None),
        ("Appel émis", "31111111", "41111111", None),
    ]
    assert call_legs(matched(spark, {**one, "CallType": "9"})).count() == 1
    assert call_legs(matched(spark, {**one, "CallType": "14"})).count() == 4


def test_first_leg_of_an_ivr_call_is_not_a_transfer(spark):
    first = {"CallType": "4", "InternFacilities": facilities(9), "endcause": "TRANSFERRED"}
    later = {**first, "StartDateTime": "2024-01-05 10:00:09.000"}
    other = {**first, "CallType": "0", "endcause": None}  # same instant as the first leg
    no_cause = {**first, "CalledNumber": "0700000000", "endcause": None}
    legs = call_legs(matched(spark, first, later, other, no_cause))
    kept = [r for r in rows(legs, "TicketId", "Appel_transfere") if r[1] is not None]
    assert kept == [("0", 0), ("1", 1), ("2", 0), ("3", 1)]


def test_null_called_number(spark):
    row = call_rules(matched(spark, {"CalledNumber": None, "CallType": "4"})).collect()[0]
    assert row.calledNumber_externe_interne == "Inconnu" and row.Appels_recus == 1
    assert row.Appels is None


def test_repeat_calls_are_summed_per_number_and_day(spark):
    got = call_rules(matched(
        spark, {"CallType": "4"}, {"CallType": "13"}, {"CallType": "9", "endcause": "TRANSFERRED"},
        {"CallType": "0"}, {"CallType": "4", "InitialStartDateTime": "2024-01-06 09:00:00.000"},
    ))
    assert rows(got, "TicketId", "Appels_recus", "Appels") == [
        ("0", 1, 2), ("1", 1, 2), ("2", 0, 2), ("3", None, None), ("4", 1, 1),
    ]


def indicator_rows(spark, rules):
    causes = [None, *[fv.TRANSFERRED, fv.RELEASED_BY_CALLER, fv.RELEASED_BY_IVR, fv.NO_LICENSE]]
    cases = list(itertools.product(causes, ["0", "4", "9"], [None, "M"], [None, "60", "60.5"], [None, "0", "7"]))
    data = [
        {"endcause": c, "CallType": t, "Motif appel": m, "bloc duration": b, "EffectiveCallDuration": e}
        for c, t, m, b, e in cases
    ]
    got = {int(r.TicketId): r for r in call_rules(matched(spark, *data), rules).collect()}
    assert len(got) == len(cases)
    return [(case, got[n]) for n, case in enumerate(cases)]


@pytest.mark.parametrize("rules", ["v2", "v1"])
def test_indicators_for_every_combination_with_nulls(spark, rules):
    """Expected values by plain Python rules, null as None."""
    for (cause, call_type, motive, block, effective), r in indicator_rows(spark, rules):
        seconds = None if block is None else float(block)
        talked = None if effective is None else int(effective)
        received = 0 if call_type == "9" and cause == fv.TRANSFERRED else (None if call_type == "0" else 1)
        caller, ivr = cause == fv.RELEASED_BY_CALLER, cause == fv.RELEASED_BY_IVR
        asked, long_block = motive is not None, seconds is not None and seconds > 60
        short_block = seconds is not None and seconds <= 60
        direct = cause is None and call_type != "9"
        waited = (caller and asked and long_block) or (rules == "v2" and ivr and asked)
        connected = cause == fv.TRANSFERRED or waited
        here = f"{rules} {cause} {call_type} {motive} {block} {effective}"
        assert r.Appels_recus == received, here
        assert r.Mise_en_relation == (received if connected else None), here
        deterred = ivr and (rules == "v1" or not asked)
        assert r.Appels_dissuades == (received if deterred else None), here
        hung_up = caller and (not asked or short_block)
        assert r.Appels_raccroches == (received if hung_up else None), here
        reached = received if received == 1 and (direct or connected) else None
        assert r.Appels_aboutis == reached, here
        can_answer = (cause is not None and not caller and not ivr) if rules == "v2" else not caller
        answered = reached == 1 and talked is not None and talked > 0 and can_answer
        assert r.Appels_decroches == (1 if answered else 0), here
        silent = (reached == 1 and talked == 0) or waited
        assert r.Appels_non_decroches == (received if silent else None), here
        if cause == fv.TRANSFERRED and talked:
            waiting = seconds
        elif call_type == "4" and direct:
            waiting = 3.0
        else:
            waiting = 0.0 if rules == "v2" and call_type == "9" and cause == fv.TRANSFERRED else None
        assert r.Attente_avant_mise_en_relation == waiting, here
        if rules == "v2":
            one = 1
            outcome = (
                "Appel non décroché" if silent and received == one else
                "Appel dissuadé" if deterred and received == one else
                "Appel raccroché" if hung_up and received == one else
                "Appel décroché" if answered else None
            )
        else:
            outcome = (
                "Le SVI raccroche" if ivr else
                "L'appelant raccroche" if caller and not asked and short_block else
                "Mise en relation" if (caller and (asked or long_block)) or cause == fv.TRANSFERRED else None
            )
        assert r.Aboutissement_SVI == outcome, here
        opening = (
            "Horaire d’ouverture" if asked or direct else "Horaire de fermeture" if cause is not None else None
        )
        assert r.Horaire_ouverture == opening, here


# --- tariff ---------------------------------------------------------------------------


def plan(spark):
    return spark.createDataFrame(
        [(None, "01", "10"), (None, "073", "10"), (None, "0800", "10"), (None, "30", "4"),
         ("49", None, None), ("351", None, None), ("351", None, None), ("33", None, None), ("1", None, None)],
        "Indicatif string, Debut string, Longueur string",
    )


def dial_codes(spark):
    return spark.createDataFrame([("351", "Portugal"), ("351", "Madeira"), ("33", "France"), ("1", "Canada")], "Indicatif string, Pays string")


def tariffs(spark, *changes, **options):
    legs = call_rules(matched(spark, *[{"CallType": "0", **c} for c in changes]))
    return tariff_classify(legs, plan(spark), dial_codes(spark), **options)


def test_golden_international_number_is_not_covered(spark):
    got = tariffs(spark, {"TicketId": "4527692", "CalledNumber": "00182696218", "Motif appel": "M"})
    assert got.columns == fv.TARIFF_COLUMNS and len(got.columns) == 52
    row = got.collect()[0]
    assert (row.Appel_facturable, row.Appel_vers) == ("Hors forfait", "International")
    assert row.Indicatif_numero is row.Pays is row.Motif_appel is row.Aboutissement_SVI is None


CLASSES = [
    ("0800123456", "Forfait", "Numéros spéciaux"), ("0810123456", "Hors forfait", "Numéros spéciaux"),
    ("0731234567", "Forfait", "National"), ("0791234567", "Hors forfait", "National"),
    ("0112345678", "Forfait", "National"), ("0912345678", "Hors forfait", "National"),
    ("3012", "Forfait", "N° courts"), ("3212", "Hors forfait", "N° courts"),
    ("51234567", "Forfait", "Numéros internes"), ("15", "Forfait", "Numéros d'urgence"),
    ("112", "Forfait", "Numéros internes"), ("123456789", "Forfait", "Numéros internes"),
    ("0035112345678", "Forfait", "International"), ("0033112345678", "Forfait", "International"),
    ("0049112345678", "Forfait", "International"),
]


def test_tariff_classes(spark):
    got = tariffs(spark, *[{"CalledNumber": number} for number, _, _ in CLASSES])
    assert sorted(rows(got, "CalledNumber", "Appel_facturable", "Appel_vers")) == sorted(CLASSES)


def test_former_tariff_labels(spark):
    got = tariffs(spark, {"CalledNumber": "51234567"}, {"CalledNumber": "17"}, {"CalledNumber": "112"}, rules="v1")
    assert rows(got, "TicketId", "Appel_vers") == [
        ("0", "N° courts (urgence)"), ("1", "N° courts (services)"), ("2", "N° courts (autre)"),
    ]


def test_dial_code_listed_twice(spark):
    number = {"CalledNumber": "0035112345678"}
    assert rows(tariffs(spark, number), "Indicatif_numero", "Pays") == [("351", "Madeira, Portugal")]
    assert tariffs(spark, number, duplicates=True).count() == 2


def test_uncovered_legs_are_distinct_and_need_an_uncovered_ticket(spark):
    uncovered = {"TicketId": "a", "CalledNumber": "0082112345678"}
    got = tariffs(spark, uncovered, uncovered, {"TicketId": "b", "CalledNumber": "0082112345678"},
                  {"TicketId": "b", "CalledNumber": "0033112345678"}, {**uncovered, "TicketId": None})
    assert rows(got, "TicketId", "Appel_facturable") == [
        (None, "Hors forfait"), ("a", "Hors forfait"), ("b", "Forfait"),
    ]


def test_legs_without_a_class_are_left_out(spark):
    assert tariffs(spark, {"CalledNumber": None}, {"CalledNumber": "0033112345678", "CallType": "2"}).isEmpty()
    received = tariffs(spark, {"CalledNumber": "0033112345678", "CallType": "4"}).collect()
    assert [(r.Appel_facturable, r.Appel_vers) for r in received] == [(None, "International")]


def test_emitted_short_numbers_become_external(spark):
    got = tariffs(spark, {"CalledNumber": "3012", "CallType": "0"}, {"CalledNumber": "3012", "CallType": "4"})
    assert {r.calledNumber_externe_interne for r in got.collect()} == {"Externe"}


# --- organisation -----------------------------------------------------------------------

LAYOUT = [("Numero_UA", "0", "2"), ("Date_limite_de_validite", "3", "8"), ("Code_UA", "11", "7"),
          ("Code_type_de_structure", "18", "5"), ("Etat", "23", "1"), ("Date_deffet_de_letat", "24", "8"),
          ("DIR_hierarchique", "32", "3"), ("CI_hierarchique", "35", "5"), ("CB_hierarchique", "40", "7"),
          ("Libelle_long_1", "47", "20"), ("Libelle_long_2", "67", "10"), ("Libelle_court_1", "77", "10"),
          ("Libelle_court_2", "87", "5")]


def unit(code, dir="", ci="", cb="", ends="99999999", kind="TRESO", label="L", since="20190101", short="S"):
    return f"UA{ends:8}{code:7}{kind:5}A{since:8}{dir:3}{ci:5}{cb:7}{label:20}{'L2':10}{short:10}{'c2':5}"


def directory(spark, units, **options):
    lines = spark.createDataFrame([(u,) for u in units], "value string")
    layout = spark.createDataFrame(LAYOUT, "nom string, de string, long string")
    return org_directory(lines, layout, datetime.date(2024, 1, 31), **options)


PARENTS = [unit("010", label="Direction"), unit("01000", dir="010", label="Centre")]


def test_offices_need_both_parents(spark):
    got = directory(spark, [*PARENTS, unit("0100029", "010", "01000", label="RUE, CENTRE"),
                            unit("0100030", "010", "09999"), unit("0100031", "099", "01000"),
                            unit("0100032", "010", "01000", cb="0100029"), unit("0100033", "010", "")])
    assert len(got.columns) == 11
    assert rows(got, "Code_UA", "Bureau", "Bureau_2", "Bureau_court") == [("0100029", "RUE, CENTRE", "L2", "S")]
    assert got.collect()[0].Date_deffet_de_letat == datetime.date(2019, 1, 1)
    labels = directory(spark, [*PARENTS, unit("0100029", "010", "01000")], with_parent_labels=True)
    assert rows(labels, "Centre_des_Impots", "Direction") == [("Centre", "Direction")]


def test_validity_and_title_line(spark):
    office = dict(dir="010", ci="01000")
    units = [*PARENTS, unit("0100001", **office, ends="20231231"), unit("0100002", **office, ends="20991231"),
             unit("0100003", **office, ends="20200101", label="old"), unit("0100003", **office, label="new"),
             unit("0100004", **office, kind="CTURE"), unit("0100005", **office, since="00000000"),
             unit("0100006", **office, ends="soon")]
    got = directory(spark, units)
    assert rows(got, "Code_UA", "Bureau") == [("0100002", "L"), ("0100003", "new"), ("0100005", "L")]
    assert got.where("Code_UA = '0100005'").collect()[0].Date_deffet_de_letat is None
    assert rows(directory(spark, units, open_ended_only=True), "Code_UA") == [("0100003",), ("0100005",)]


def test_user_directory(spark):
    org = directory(spark, [*PARENTS, unit("0100029", "010", "01000")])
    users = spark.createDataFrame(
        [("100A0001", "0100029"), ("100A0002", "PAS TOUCHE"), ("100A0003", "010 00 29 extra"), ("100A0004", None)],
        "`Internal Number` string, `Cost Center` string",
    )
    got = user_directory(users, org)
    assert got.columns == ["Internal_Number", "Cost_Center", "Code_UA"]
    assert rows(got) == [("100A0001", "0100029", "0100029"), ("100A0003", "0100029", "0100029")]
    with pytest.raises(ColumnContractError, match="Cost Center"):
        user_directory(users.drop("Cost Center"), org)


# --- cross reference ----------------------------------------------------------------------


def facts(spark, *changes, users=(("31111111", "0100029"),), **unit_options):
    org = directory(spark, [*PARENTS, unit("0100029", "010", "01000", **unit_options), unit("0100030", "010", "01000")])
    directory_rows = spark.createDataFrame(list(users), "Internal_Number string, Cost_Center string")
    return cross_reference(tariffs(spark, *changes), directory_rows, org)


def test_office_of_a_call(spark):
    got = facts(
        spark, {"ChargedNumber": "31111111", "SAGES (bloc)": "0100030"}, {"ChargedNumber": "x", "SAGES (bloc)": "010 0030"},
        {"ChargedNumber": "x", "SAGES (bloc)": ""}, {"ChargedNumber": "x"}, {"ChargedNumber": "x", "SAGES (bloc)": "0999999"},
        {"ChargedNumber": "blank", "SAGES (bloc)": "0100030"},
        users=(("31111111", "0100029"), ("blank", "")),
    )
    assert rows(got, "TicketId", "SAGES", "Service") == [
        ("0", "0100029", "S L2"), ("1", "0100030", "S L2"), ("5", "0100030", "S L2"),
    ]
    assert rows(office_export(got)) == [("0100029",), ("0100030",)]


def test_uncounted_calls_stay_only_with_a_null_key(spark):
    license = {"endcause": fv.NO_LICENSE}
    passed_on = {"endcause": fv.TRANSFERRED, "CallType": "9"}
    got = facts(spark, license, passed_on, {**license, "TicketId": None}, {"endcause": fv.TRANSFERRED}, {})
    assert [r[0] for r in rows(got, "TicketId")] == [None, "3", "4"]


def test_export_has_the_40_published_columns(spark):
    got = stats_export(facts(spark, {}, {}, {"CallType": "4", "WaitingDuration": "2.5"}))
    assert got.columns == [name for _, name in fv.EXPORT_COLUMNS] and len(got.columns) == 40
    assert got.count() == 2
    received = got.where("Appels_recus = 1").collect()[0]
    assert received.Attente_avant_mise_en_relation == 2 and received.InitialStartDateTime == "2024-01-05T10:00:00"
    assert (received.Day_of_week, received.Lib_hour) == ("vendredi", "10:00 - 10:15")


def test_directory_entries_fan_out(spark):
    users = (("31111111", "0100029"), ("31111111", "0100030"))
    assert rows(facts(spark, {}, users=users), "SAGES") == [("0100029",), ("0100030",)]
