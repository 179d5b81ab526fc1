"""Days that a corrected directory changes, on small tables: each kind of change, and changes without effect."""

import pytest
from pyspark.sql import functions as F

from callweave.plans import changed_days, day_index, write_index
from conftest import rows

USERS, UNITS = "Internal_Number string, Cost_Center string", "Code_UA string, Bureau string"
CALLS = "jour string, ChargedNumber string, SAGES string, endcause string, CallType int, TicketId string, InitialStartDateTime string"
OFFICES = [("A", "a"), ("B", "b"), ("C", "c")]
PEOPLE = [("1", "A"), ("2", "B"), ("3", None), ("4", "")]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    calls = [("d1", "1", None), ("d2", "2", "C"), ("d3", "3", "C"), ("d4", "9", "C"), ("d5", "4", "A"), ("d6", None, "B"), ("d7", "7", None), ("d1", "1", None)]
    rows_of = [(d, n, c, "x", 0, "t", "s") for d, n, c in calls] + [("d8", "1", None, "NOT ENOUGH LICENSE", 0, "t", "s")]
    path = str(tmp_path_factory.mktemp("index") / "days")
    write_index(day_index(spark.createDataFrame(rows_of, CALLS)), path)
    return spark.read.orc(path)


@pytest.mark.parametrize("people, offices, days", [
    (PEOPLE, OFFICES, []),
    (PEOPLE, [("A", "new"), *OFFICES[1:]], ["d1", "d5"]),  # the name of an office: by number, and by code
    (PEOPLE, OFFICES[:2], ["d3", "d4"]),  # an office gone; d2 has it as code only, and its number another
    ([("1", "B"), *PEOPLE[1:]], OFFICES, ["d1"]),  # a number moves
    ([*PEOPLE, ("7", "B")], OFFICES, ["d7"]),  # a number appears
    ([*PEOPLE, ("8", "B")], OFFICES, []),  # nobody called it
    (PEOPLE[1:], OFFICES, ["d1"]),  # a number goes, and its calls have no code
    ([*PEOPLE, ("2", "B")], OFFICES, ["d2"]),  # listed twice: its calls count twice
    ([p for p in PEOPLE if p[0] != "3"], OFFICES, []),  # it had no cost center before either
])
def test_days_of_each_change(spark, index, people, offices, days):
    found = changed_days(index, *(spark.createDataFrame(r, s) for r, s in ((PEOPLE, USERS), (people, USERS), (OFFICES, UNITS), (offices, UNITS))))
    assert [r.jour for r in found.orderBy("jour").collect()] == days


def test_many_changed_keys_are_joined(spark, index, monkeypatch):
    from callweave.plans import reruns

    monkeypatch.setattr(reruns, "PUSHED_KEYS", 1)
    offices = [(c, n + "!") for c, n in OFFICES]
    tables = (spark.createDataFrame(r, s) for r, s in ((PEOPLE, USERS), (PEOPLE, USERS), (OFFICES, UNITS), (offices, UNITS)))
    assert rows(changed_days(index, *tables)) == [(f"d{i}",) for i in range(1, 7)]


def test_few_changed_keys_are_pushed_to_the_index(spark, index):
    offices = [("A", "new"), *OFFICES[1:]]
    tables = [spark.createDataFrame(r, s) for r, s in ((PEOPLE, USERS), (PEOPLE, USERS), (OFFICES, UNITS), (offices, UNITS))]
    plan = changed_days(index, *tables)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "number" in plan.split("PushedFilters")[1][:200]
    assert index.where(F.col("jour") == "d8").count() == 0
