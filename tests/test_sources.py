import datetime
import glob
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from callweave import fixed_values as fv
from callweave.operators.contract import ColumnContractError
from callweave.plans import DayPaths, regression_check, run_day
from callweave.sources import (
    Stages,
    export_sorted_csv,
    read_csv,
    read_csv_by_header,
    read_csv_columns,
    read_ivr_blocks,
    read_ivr_calls,
    read_lines,
    read_table,
    read_tickets,
    shared_folder,
    synthetic_tickets,
    write_csv,
    write_day,
    write_days,
    write_orc,
    write_orc_table,
)
from callweave.sources.shared import _qualified
from checks import views
from conftest import rows

SF = "/root/testdata/sf0.001"


def test_csv_columns_in_declared_order_and_pruned(spark, tmp_path):
    path = str(tmp_path / "wide")
    write_csv(spark.createDataFrame([(1, "a", "x", "9")], "b int, a string, junk string, c string"), path)
    df = read_csv_columns(spark, path, "c int, b bigint")
    assert rows(df) == [(9, 1)] and df.dtypes == [("c", "int"), ("b", "bigint")]
    assert "junk" not in df._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ColumnContractError, match="missing"):
        read_csv_columns(spark, path, "missing int")


def test_csv_header_texts_delimiter_and_quotes(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id$t\n007$"a ""b"" $c"\n', encoding="utf-8")
    assert rows(read_csv(spark, str(path), sep="$", escape='"')) == [("007", 'a "b" $c')]


def test_lines_keep_the_text_behind_a_comma_and_read_folders(spark, tmp_path):
    for n in range(2):
        (tmp_path / f"{n}.txt").write_text(f"UNIT {n}, RUE\n")
    assert rows(read_lines(spark, str(tmp_path))) == [("UNIT 0, RUE",), ("UNIT 1, RUE",)]


def test_declared_schemas(spark, tmp_path):
    write_csv(synthetic_tickets(spark, 5).withColumn("extra", F.lit(1)), str(tmp_path / "t"))
    tickets = read_tickets(spark, str(tmp_path / "t"))
    assert len(tickets.columns) == 12 and tickets.count() == 5
    (tmp_path / "calls.csv").write_text(
        ",".join(f.split()[0] for f in fv.IVR_CALL_DDL.split(",")) + "\n"
        "a,sip:06@x,0577,,t,,tr,1651010437.323,2022-04-27 00:00:37,12.3,0,TRANSFERRED,,,,0100,,,\n"
    )
    call = read_ivr_calls(spark, str(tmp_path / "calls.csv")).collect()[0]
    assert (call.called, call.transferredto, call.start) == ("0577", "0100", 1651010437.323)
    (tmp_path / "blocks.csv").write_text(
        "id,event,timestamp,createdate,duration (ms),bloc id,bloc name\na,INCOMING,1.5,2022-04-27 00:00:00,9,m,n\n"
    )
    assert read_ivr_blocks(spark, str(tmp_path / "blocks.csv")).collect()[0]["duration (ms)"] == 9


def test_rerun_of_a_day_replaces_only_that_day(spark, tmp_path):
    path = str(tmp_path / "days")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-02")], "id int, jour string")
    write_days(df, path)
    write_days(df.where("id = 3"), path, by=["id"])
    assert rows(spark.read.orc(path), "id") == [(1,), (3,)]
    day = spark.read.orc(path).where("jour = '2024-01-01'")
    assert "PartitionFilters: [isnotnull(jour" in day._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_orc_table_is_replaced(spark):
    write_orc_table(spark.range(5), "callweave_t")
    write_orc_table(spark.range(3), "callweave_t")
    try:
        assert read_table(spark, "callweave_t").count() == 3
    finally:
        spark.sql("drop table callweave_t")


def test_orc_folder(spark, tmp_path):
    write_orc(spark.range(5), str(tmp_path / "o"))
    assert spark.read.orc(str(tmp_path / "o")).count() == 5


@pytest.mark.parametrize("single", [True, False])
def test_sorted_export(spark, tmp_path, single):
    df = spark.range(300).select((F.col("id") % 100).cast("string").alias("a"), F.lit("é;x").alias("b")).repartition(5)
    path = str(tmp_path / "out")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        export_sorted_csv(df, path, single_file=single)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted(glob.glob(f"{path}/part-*.csv"))
    assert (len(parts) == 1) == single
    lines = [line for part in parts for line in open(part, encoding="utf-8").read().splitlines()[1:]]
    assert lines == [f'{i};"é;x"' for i in sorted(map(str, range(100)))]


def test_stage_survives_its_source_and_prunes(spark, tmp_path):
    stages = Stages(spark)
    assert stages.folder.startswith(shared_folder(spark))
    kept = stages.keep(spark.range(10).withColumn("t", F.lit("x")), "s")
    assert os.path.isdir(stages.path("s").replace("file:", ""))
    assert "t:string" not in kept.select("id")._jdf.queryExecution().executedPlan().toString()
    assert kept.count() == 10
    stages.remove()
    assert not os.path.exists(stages.path("s").replace("file:", ""))


def test_shared_folder_is_the_sessions_or_below_a_shared_warehouse():
    def fake(master, named, warehouse):
        values = {"spark.checkpoint.dir": named, "spark.sql.warehouse.dir": warehouse}
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: values[key]), sparkContext=context)

    assert shared_folder(fake("yarn", "hdfs:///shared/", "file:/x")) == "hdfs:///shared"
    assert shared_folder(fake("local[2]", None, "file:/x")) == "file:/x/callweave-stages"
    assert shared_folder(fake("yarn", None, "hdfs:///w")) == "hdfs:///w/callweave-stages"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(fake("yarn", None, "file:/x"))


def test_a_failing_run_leaves_no_stages(spark, tmp_path):
    before = set(os.listdir(shared_folder(spark).replace("file:", "")))
    paths = DayPaths(*[str(tmp_path / "missing")] * 8)
    with pytest.raises(Exception):
        run_day(spark, paths, datetime.date(2024, 1, 10), str(tmp_path / "result"), "UTC")
    assert set(os.listdir(shared_folder(spark).replace("file:", ""))) == before


def test_mixed_headers_fail_or_are_read_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,one\n")
    (tmp_path / "b.csv").write_text("v,k\ntwo,2\n")
    folder, ddl = str(tmp_path), "k int, v string"
    for read in (lambda: read_csv(spark, folder, ddl), lambda: read_csv_columns(spark, folder, ddl)):
        with pytest.raises(Exception, match=r"(?s)(a|b)\.csv"):
            read().collect()
    assert rows(read_csv_by_header(spark, folder, ddl)) == [(1, "one"), (2, "two")]


def test_daily_files_fail_on_another_header(spark, tmp_path):
    (tmp_path / "calls.csv").write_text("nonsense,id\n1,2\n")
    for read in (read_ivr_calls, read_ivr_blocks):
        with pytest.raises(Exception, match="(?s)calls.csv"):
            read(spark, str(tmp_path / "calls.csv")).collect()


def test_regression_of_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id;v\n1;x\n2;y\n")
    (tmp_path / "b.csv").write_text("v;id\nx;1\nz;2\n")
    summary, changed = regression_check(spark, str(tmp_path / "a.csv"), str(tmp_path / "b.csv"))
    assert rows(summary) == [(2, 2, 1, 1)]
    assert rows(changed) == [("2", "y", "left"), ("2", "z", "right")]


def day_paths(spark, tmp_path, day):
    """The derived files of a day, written as the formats of the sources; also the reference tables."""
    day_files = "/root/testdata/sf0.01"
    reference = views.reference(spark, day_files)
    in_day = F.col("InitialStartDateTime").startswith(day.isoformat())
    write_csv(views.tickets(spark, day_files).where(in_day).withColumn("unused", F.lit("u")), str(tmp_path / "tickets"))
    calls = views.ivr_calls(spark, day_files)
    for f in fv.IVR_CALL_DDL.split(","):
        name, kind = f.split()
        if name not in calls.columns:
            calls = calls.withColumn(name, F.lit(None).cast(kind))
    order = [f.split()[0] for f in fv.IVR_CALL_DDL.split(",")]
    write_csv(calls.select(*order), str(tmp_path / "calls"))
    block_order = ["id", "event", "timestamp", "createdate", "duration (ms)", "bloc id", "bloc name"]
    write_csv(views.ivr_blocks(spark, day_files).select(*block_order), str(tmp_path / "blocks"))
    write_csv(reference.users, str(tmp_path / "users"))
    reference.organisation_lines.write.text(str(tmp_path / "organisation"))
    layout = reference.organisation_layout.select("nom", "long", F.lit("0").alias("a"), F.lit("0").alias("De_officiel"), "de")
    write_csv(layout, str(tmp_path / "layout"))
    write_csv(reference.numbering_plan, str(tmp_path / "plan"))
    write_csv(reference.dial_codes, str(tmp_path / "codes"))
    return DayPaths(*[str(tmp_path / n) for n in (
        "tickets", "calls", "blocks", "users", "organisation", "layout", "plan", "codes")]), reference


def test_run_day_from_files(spark, tmp_path):
    """The files of a day, run twice."""
    day = datetime.date(2024, 1, 10)
    paths, _ = day_paths(spark, tmp_path, day)
    result = str(tmp_path / "result")
    before = set(os.listdir(shared_folder(spark).replace("file:", "")))
    facts = run_day(spark, paths, day, result, "UTC")
    assert set(os.listdir(shared_folder(spark).replace("file:", ""))) == before
    first = facts.count()
    assert first > 0 and {r.jour for r in facts.select("jour").distinct().collect()} == {"2024-01-10"}
    other = datetime.date(2024, 1, 9)
    write_day(facts.limit(1), f"{result}/facts", other.isoformat())
    assert run_day(spark, paths, day, result, "UTC").count() == first
    assert rows(spark.read.orc(f"{result}/facts").groupBy("jour").count().withColumn("jour", F.col("jour").cast("string"))) == [
        ("2024-01-09", 1), ("2024-01-10", first),
    ]
    stats = read_csv(spark, f"{result}/stats/20240110", sep=";")
    assert stats.columns == [name for _, name in fv.EXPORT_COLUMNS]
    assert 0 < stats.count() <= first
    assert read_csv(spark, f"{result}/offices/20240110", sep=";").columns == ["SAGES"]


def test_an_empty_rerun_empties_the_day(spark, tmp_path):
    path = str(tmp_path / "days")
    write_day(spark.range(3), path, "2024-01-01")
    write_day(spark.range(2), path, "2024-01-02")
    write_day(spark.range(0), path, "2024-01-02")
    stored = spark.read.schema("id bigint, jour string").orc(path)
    assert rows(stored) == [(0, "2024-01-01"), (1, "2024-01-01"), (2, "2024-01-01")]


def test_shared_folder_is_qualified(spark, tmp_path):
    """A folder without a scheme is named with the file system that Spark takes it for, also behind a view."""
    assert shared_folder(spark).startswith("file:/")
    configuration = spark._jsc.hadoopConfiguration()
    configuration.set("fs.viewfs.mounttable.shared.link./stages", f"file://{tmp_path}")
    try:
        folder = _qualified(spark, "viewfs://shared/stages/mine")
        assert folder == f"file:{tmp_path}/mine"
        assert Stages(spark, folder).keep(spark.range(3), "x").count() == 3 and os.path.isdir(tmp_path / "mine" / "x")
    finally:
        configuration.unset("fs.viewfs.mounttable.shared.link./stages")
