from pyspark.sql import functions as F

from callweave.functions import (
    date_columns,
    decode_flags,
    fixed_width,
    iso_text,
    office_code,
    read_layout,
    sip_user,
    trim_all,
    typed_nulls,
    wall_seconds,
    wall_text,
    without_blanks,
)
from conftest import rows


def test_trim_all_trims_text_and_leaves_numbers(spark):
    df = spark.createDataFrame([("nom1 ", 1, "  "), (" nom2", 4, None)], "nom string, de int, x string")
    assert rows(trim_all(df)) == [("nom1", 1, ""), ("nom2", 4, None)]


def test_fixed_width_by_layout(spark):
    lines = spark.createDataFrame([("yo yaa  yi88888888888",)], "_c0 string")
    layout = spark.createDataFrame(
        [("nom1", "1", "2", "1"), ("nom2", "4", "3", "4"), ("gone", None, "3", "4")],
        "nom string, de string, long string, a string",
    )
    cut = fixed_width(lines, read_layout(layout), "_c0")
    assert cut.columns == ["nom1", "nom2"]
    assert rows(cut) == [("yo", "yaa")]


def test_layout_start_zero_is_one(spark):
    layout = spark.createDataFrame([("a", "0", "3"), ("b", "x", "3")], "nom string, de string, long string")
    assert read_layout(layout) == [("a", 1, 3)]


def test_date_columns_golden_row(spark):
    df = spark.createDataFrame([(4477743, "2022-04-27 00:00:35.000")], "id int, InitialStartDateTime string")
    got = date_columns(df).withColumn("Date", F.col("Date").cast("string"))
    assert got.columns == [
        "id", "InitialStartDateTime", "Minutes", "Hour", "Date", "dayofweek", "quarter", "Lib_hour",
    ]
    assert rows(got) == [
        (4477743, "2022-04-27T00:00:35", 0, 0, "2022-04-27", "mercredi", "00-15", "0:00 - 0:15")
    ]


def test_hour_labels_at_the_edges(spark):
    data = [("2024-01-01 23:44:59",), ("2024-01-01 23:45:00",), ("2024-01-01 09:50:00",), (None,)]
    got = date_columns(spark.createDataFrame(data, "InitialStartDateTime string"))
    assert [r["Lib_hour"] for r in got.collect()] == ["23:30 - 23:45", "23:45 - 00:00", "9:45 - 10:00", None]


def test_all_french_weekdays(spark):
    data = [(f"2024-01-0{d} 10:00:00",) for d in range(1, 8)]  # Monday to Sunday
    got = date_columns(spark.createDataFrame(data, "InitialStartDateTime string"))
    assert [r["dayofweek"] for r in got.collect()] == [
        "lundi", "mardi", "mercredi", "jeudi", "vendredi", "samedi", "dimanche",
    ]


def test_iso_text_cuts_only_a_zero_fraction_at_the_end(spark):
    data = [("2000-04-27 00:00:35.000",), ("2022-04-27 10:00:00.120",)]
    df = spark.createDataFrame(data, "t string").select(iso_text(F.col("t")).alias("t"))
    assert rows(df) == [("2000-04-27T00:00:35",), ("2022-04-27T10:00:00.120",)]


def test_wall_text_forms(spark):
    data = [("2022-04-27T00:00:35.12",), ("2022-04-27 00:00:35",), ("no date",), (None,)]
    df = spark.createDataFrame(data, "t string").select(wall_text(F.col("t")).alias("t"))
    assert [r.t for r in df.collect()] == [
        "2022-04-27 00:00:35.120", "2022-04-27 00:00:35.000", None, None,
    ]


def test_wall_clock_does_not_depend_on_the_session_zone(spark, zone):
    df = spark.createDataFrame([("2022-04-27 00:00:35.000",), ("2022-03-27 02:30:00",)], "t string")
    seen = set()
    for name in ("UTC", "America/New_York", "Europe/Paris"):
        zone(name)
        got = df.select(
            wall_seconds(F.col("t"), "Europe/Paris").alias("s"), wall_text(F.col("t")).alias("w")
        )
        seen.add(tuple(rows(got)))
    assert len(seen) == 1
    assert (1651010435, "2022-04-27 00:00:35.000") in seen.pop()


def test_flags_by_position(spark):
    flags = "".join(str(i % 10) for i in range(1, 41))
    df = spark.createDataFrame([(flags,), ("x" * 40,), ("",), (None,)], "InternFacilities string")
    got = decode_flags(df).collect()
    assert got[0].CallForwardingUnconditional == 6 and got[0].Transfer == 9 and got[0].Disa == 7
    assert got[0].OperatorFacility == got[0].Substitution == 4
    assert got[0].VoiceMail == got[0].CentralAbbreviatedNumberring == 2
    assert all(v is None for r in got[1:] for v in list(r)[1:])
    assert len(got[0]) == 19


def test_codes_inside_text(spark):
    df = spark.createDataFrame(
        [("BLOC-0709E05", "sip:0623510002 @node-n1;user=phone", "010 00 29 X"), ("BLOC", "tel:1", None)],
        "b string, c string, d string",
    ).select(office_code(F.col("b")), sip_user(F.col("c")), without_blanks(F.col("d"), 7))
    assert rows(df) == [("", "", None), ("0709E05", "0623510002", "0100029")]


def test_typed_nulls_can_be_stored(spark, tmp_path):
    df = typed_nulls(spark.range(2), {"a": "string", "b": "double"})
    df.write.orc(str(tmp_path / "nulls"))
    assert [t for _, t in spark.read.orc(str(tmp_path / "nulls")).dtypes] == ["bigint", "string", "double"]
