"""Days published as a whole, edges at midnight, quarantine of bad lines, headers of many files."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from callweave.operators import distinct_in_ranges
from callweave.plans import DayFiles, daily, day_with_edges, ivr_prep, match_calls, own_rows, rerun_cross_reference, ticket_prep
from callweave.sources import (
    BadRowsError, DayStore, Draft, Stages, UnknownDayError, read_csv, read_csv_by_header, read_csv_quarantined, write_csv,
)
from callweave.sources.readers import files_by_header
from checks import call_chain
from conftest import rows
from test_sources import day_paths

DAY = datetime.date(2024, 1, 10)


def publish(store, day, value, tables=("a", "b")):
    draft = store.draft(day)
    for name in tables:
        draft.write(store.spark.createDataFrame([(value, name)], "v long, name string"), name)
    draft.publish()


def test_a_day_changes_as_a_whole_and_others_stay(spark, tmp_path):
    store = DayStore(spark, str(tmp_path / "store"))
    with pytest.raises(UnknownDayError):
        store.read("a")
    publish(store, "2024-01-01", 1)
    publish(store, "2024-01-02", 2)
    draft = store.draft("2024-01-01")
    draft.write(spark.createDataFrame([(9, "a")], "v long, name string"), "a")
    assert rows(store.read("a")) == [(1, "a", "2024-01-01"), (2, "a", "2024-01-02")]
    draft.write(spark.createDataFrame([], "v long, name string"), "b")
    draft.publish()
    assert rows(store.read("a")) == [(2, "a", "2024-01-02"), (9, "a", "2024-01-01")]
    assert rows(store.read("b")) == [(2, "b", "2024-01-02")] and store.read_day("b", "2024-01-01").count() == 0
    assert store.days() == ["2024-01-01", "2024-01-02"]
    assert rows(store.read("a", ["2024-01-02"])) == [(2, "a", "2024-01-02")]
    with pytest.raises(UnknownDayError):
        store.folder("c", "2024-01-01")


def test_other_columns_on_another_day(spark, tmp_path):
    store = DayStore(spark, str(tmp_path / "my store"))
    publish(store, "2024-01-01", 1)
    draft = store.draft("2024-01-02")
    draft.write(spark.createDataFrame([("new", 5)], "extra string, v long"), "a")
    draft.publish()
    assert rows(store.read("a")) == [(None, 1, "2024-01-01"), ("new", 5, "2024-01-02")]


def test_vacuum_deletes_what_no_day_names(spark, tmp_path):
    store = DayStore(spark, str(tmp_path / "store"))
    for value in (1, 2, 3):
        publish(store, "2024-01-01", value)
    abandoned = store.draft("2024-01-01")
    abandoned.write(spark.range(1), "a")
    rerun = store.draft("2024-01-01")
    rerun.keep("a")
    rerun.write(spark.createDataFrame([(4, "b")], "v long, name string"), "b")
    rerun.publish()
    assert len(store.vacuum(keep=2)) == 4  # both tables of versions 1 and 2; version 3 still gives a
    assert rows(store.read("a")) == [(3, "a", "2024-01-01")] and rows(store.read("b")) == [(4, "b", "2024-01-01")]
    assert len(store.vacuum()) == 1  # b of version 3
    assert len(store.vacuum(drafts=True)) == 1  # what nobody published
    assert rows(store.read("a")) == [(3, "a", "2024-01-01")] and rows(store.read("b")) == [(4, "b", "2024-01-01")]


def test_runs_at_the_same_time_leave_one_whole_day(spark, tmp_path, monkeypatch):
    store = DayStore(spark, str(tmp_path / "store"))
    publish(store, "2024-01-01", 0)
    seen = store.entries().cache()
    seen.count()
    with monkeypatch.context() as m:
        m.setattr(DayStore, "entries", lambda self: seen)  # both publish on what they saw before
        publish(store, "2024-01-01", 1)
        publish(store, "2024-01-01", 2)
    (a,), (b,) = rows(store.read("a").select("v")), rows(store.read("b").select("v"))
    assert a == b and a[0] in (1, 2)


def test_a_run_that_fails_anywhere_leaves_the_old_day(spark, tmp_path, monkeypatch):
    """Failures after each write of a real run, and at the switch itself."""
    paths, reference = day_paths(spark, tmp_path, DAY)
    store = DayStore(spark, str(tmp_path / "store"))
    first = daily.run_day(spark, paths, DAY, store, "UTC")
    names = ("tariffs", "users", "facts")

    def state():
        files = [sorted(os.listdir(store.folder(t, DAY).replace("file:", ""))) for t in ("stats", "offices")]
        return [store.read(t).count() for t in names], files, read_csv(spark, store.folder("stats", DAY), sep=";").count()

    old = state()
    assert old[0][2] == first.count() > 0
    organisation = reference.organisation_lines.limit(0)
    directory = daily.org_directory(organisation, reference.organisation_layout, DAY)
    write, export, publish_it = Draft.write, Draft.export, Draft.publish
    for failing in range(4):  # facts, stats, offices, publish
        done = []

        def fail_at(step, act):
            def acting(self, *args):
                if len(done) == failing:
                    raise OSError("lost")
                result = act(self, *args)
                done.append(step)
                return result
            return acting

        with monkeypatch.context() as m:
            m.setattr(Draft, "write", fail_at("write", write))
            m.setattr(Draft, "export", fail_at("export", export))
            m.setattr(Draft, "publish", fail_at("publish", publish_it))
            with pytest.raises(OSError, match="lost"):
                rerun_cross_reference(spark, store, DAY, directory)
        assert len(done) == failing and state() == old
    assert store.vacuum(drafts=True) == []  # failed runs left no files
    rerun_cross_reference(spark, store, DAY, directory)
    new = state()
    assert new != old and new[0][:2] == old[0][:2]


def filed(spark, tickets, calls):
    """Files of a day from (time, ticket, number, kind) and (id, start, number)."""
    t = spark.createDataFrame(tickets, "InitialStartDateTime string, TicketId string, CalledNumber string")
    for name in ("CallingNumber", "CallType", "EffectiveCallDuration", "InitialDialledNumber", "StartDateTime", "InternFacilities",
                 "ChargedNumber", "CostCenter", "WaitingDuration"):
        t = t.withColumn(name, F.lit("0"))
    c = spark.createDataFrame(calls, "id string, start double, number string")
    c = c.select("id", F.concat(F.lit("sip:"), "number", F.lit("@n")).alias("caller"), "start", *[
        F.lit(None).cast(kind).alias(name) for name, kind in (
            ("called", "string"), ("tenantname", "string"), ("treename", "string"), ("duration", "double"), ("endcause", "string"), ("transferredto", "string"))
    ])
    b = c.select("id", (F.col("start") + 1).alias("timestamp"), F.lit(1).alias("duration (ms)"), F.lit("x").alias("bloc id"), F.lit("y").alias("bloc name"),
                 F.lit("e").alias("event"), F.lit(None).cast("timestamp").alias("createdate"))
    return DayFiles(t, b, c)


def test_two_day_runs_equal_one_over_both_days(spark):
    midnight = 1704931200  # 2024-01-11 00:00 UTC
    before = filed(spark, [
        ("2024-01-10 23:59:58", "t1", "06"), ("2024-01-10 12:00:00", "t2", "07"), ("2024-01-10 23:59:59", "t5", "09"),
        ("2024-01-11 00:00:01", "late", "06"), (None, "lost", "06"),
    ], [("c1", midnight - 2.5, "06"), ("c3", midnight - 1.0, "08"), ("c2", midnight - 43200.0, "07")])
    after = filed(spark, [("2024-01-11 00:00:02", "t3", "08"), ("2024-01-11 00:00:00", "t5", "10"), ("2024-01-11 09:00:00", "t4", "06")],
                  [("c4", midnight + 1.5, "06"), ("c5", midnight + 2.0, "10"), ("c6", midnight + 32400.0, "06")])

    def matched(files):
        return match_calls(ticket_prep(files.tickets), ivr_prep(files.ivr_blocks, files.ivr_calls), "UTC")

    both = DayFiles(*[getattr(before, n).unionByName(getattr(after, n)) for n in ("tickets", "ivr_blocks", "ivr_calls")])
    columns = ["InitialStartDateTime", "TicketId", "CalledNumber", "temp_caller", "date_diff", "start"]
    whole = rows(matched(both), *columns)
    first, second = DAY, DAY + datetime.timedelta(days=1)
    one = rows(own_rows(matched(day_with_edges(before, None, after, first, "UTC", 600)), first), *columns)
    two = rows(own_rows(matched(day_with_edges(after, before, None, second, "UTC", 600)), second), *columns)
    two = [r for r in two if r[0] is not None]
    assert sorted(map(str, one + two)) == sorted(map(str, whole))
    across = {r[1] for r in whole if r[3]}
    assert {"t1", "t3", "t5", "late"} <= across
    alone = rows(own_rows(matched(before), first), *columns)
    assert alone != one  # without the edges t5 finds nothing


def test_runs_of_several_days_are_stored_one_after_another(spark, tmp_path):
    """The result reads what each run stored: no join is left for its plan, and nothing else is left on disk."""
    midnights = [datetime.datetime(2024, 1, d) for d in (5, 10, 11, 20)]
    events = [
        (n, midnights[n // 60] + datetime.timedelta(seconds=n % 60 - 30), n % 7, ("error", "click", "view")[n % 3]) for n in range(240)
    ]
    spark.createDataFrame(events, "event_id long, ts timestamp, user_id long, event_type string").write.parquet(f"{tmp_path}/sf/events.parquet")
    stages = spark.conf.get("spark.checkpoint.dir")
    os.makedirs(stages, exist_ok=True)
    before = set(os.listdir(stages))
    found = call_chain.q_tolerance_left_by_day(spark, f"{tmp_path}/sf")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    left = [d for d in sorted(set(os.listdir(stages)) - before) if os.path.isdir(f"{stages}/{d}")]
    assert len(left) == 1 and sorted(os.listdir(f"{stages}/{left[0]}")) == [f"matched-{i}" for i in range(4)]
    whole = rows(call_chain.q_tolerance_left(spark, f"{tmp_path}/sf"))
    assert rows(found) == whole and any(r[4] is not None for r in whole)


def test_days_of_a_zone_with_a_clock_change(spark):
    from callweave.plans.midnight import bounds

    assert [b - a for a, b in (bounds(d, d, "Europe/Paris") for d in (datetime.date(2024, 3, 31), datetime.date(2024, 10, 27), DAY))] == [
        23 * 3600, 25 * 3600, 24 * 3600,
    ]


def test_bad_lines_go_to_the_quarantine(spark, tmp_path):
    folder = tmp_path / "in put"
    folder.mkdir()
    (folder / "a.csv").write_text("id,v,note\n1,1.5,x\nword,2.5,y\n3,,z\n4\n")
    (folder / "b.csv").write_text("id,v,note\n5,5.5,n\n6,6.5,n,more\n")
    stages, bad = Stages(spark), str(tmp_path / "bad")
    schema = "id long, v double, note string"
    good = read_csv_quarantined(spark, str(folder), schema, bad, stages, limit=3)
    assert rows(good) == [(1, 1.5, "x"), (3, None, "z"), (5, 5.5, "n")]
    assert rows(good.select("note")) == [("n",), ("x",), ("z",)]  # also if few columns are read
    assert sorted((os.path.basename(r.file), r.line) for r in spark.read.parquet(bad).collect()) == [
        ("a.csv", "4"), ("a.csv", "word,2.5,y"), ("b.csv", "6,6.5,n,more"),
    ]
    with pytest.raises(BadRowsError, match=r"3 bad lines, at most 2 allowed.*a\.csv: 2"):
        read_csv_quarantined(spark, str(folder), schema, bad, stages, limit=2)
    assert spark.read.parquet(bad).count() == 3
    some = read_csv_quarantined(spark, str(folder), "v double", bad, stages, limit=3, columns_only=True)
    assert rows(some) == [(None,), (1.5,), (2.5,), (5.5,)] and spark.read.parquet(bad).count() == 2
    stages.remove()


def test_headers_of_many_files_take_as_many_jobs_as_of_few(spark, tmp_path):
    tracker, jobs = spark.sparkContext.statusTracker(), []
    for n in (120, 360):
        folder = tmp_path / f"{n} files"
        folder.mkdir()
        for i in range(n):
            (folder / f"{i}.csv").write_text(f"k,v\n{i},one\n" if i % 3 else f"\nv,k\ntwo,{i}\n")
        (folder / "empty.csv").write_text("")
        assert {h: len(f) for h, f in files_by_header(spark, str(folder)).items()} == {"k,v": n * 2 // 3, "v,k": n // 3}
        spark.sparkContext.setJobGroup(f"headers {n}", "")
        got = read_csv_by_header(spark, str(folder), "k int, v string")
        jobs.append(len(tracker.getJobIdsForGroup(f"headers {n}")))
        spark.sparkContext.setJobGroup("", "")
        assert rows(got) == sorted(((i, "one" if i % 3 else "two") for i in range(n)), key=lambda r: str(r[0]))
    assert jobs[0] == jobs[1]


def test_distinct_in_ranges_shuffles_once(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 300).alias("a"), (F.col("id") % 7).cast("string").alias("b b"))
    made = distinct_in_ranges(df)
    for rows_of in (made, distinct_in_ranges(df.withColumn("constant", F.lit("x")))):
        assert rows_of._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert rows(distinct_in_ranges(df.select(F.lit(1).alias("one"), F.lit(None).cast("int").alias("none")))) == [(1, None)]
    write_csv(made, str(tmp_path / "out"))
    files = sorted(f for f in os.listdir(tmp_path / "out") if f.startswith("part"))
    lines = [tuple(x.split(",")) for f in files for x in (tmp_path / "out" / f).read_text().splitlines()[1:]]
    assert [(int(a), b) for a, b in lines] == sorted({(i % 300, str(i % 7)) for i in range(1000)})
