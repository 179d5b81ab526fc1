"""Folders that tasks read themselves: a part without rows is empty, a folder that is not there is an error."""

import shutil

import pytest
from pyspark.sql import functions as F

from callweave.llm import common, kneser_ney, suffix_dedup


def test_a_missing_folder_of_numbers_fails_the_job(spark):
    kept = common.stages(spark)
    table = kept.keep(spark.range(100, numPartitions=4).select(F.struct("id").alias("row"), F.monotonically_increasing_id().alias("number")), "rows")
    few = common.chosen_rows(kept, table, table.where("row.id < 10").select("number"), True)
    assert few.count() == 10  # three of four parts have no folder
    shutil.rmtree(kept.path("chosen").replace("file:", ""))
    with pytest.raises(Exception, match="FileNotFoundError"):
        few.collect()
    kept.remove()


def test_no_numbers_at_all(spark):
    kept = common.stages(spark)
    table = kept.keep(spark.range(10).select(F.struct("id").alias("row"), F.monotonically_increasing_id().alias("number")), "rows")
    assert common.chosen_rows(kept, table, table.where("false").select("number"), True).count() == 0
    assert common.chosen_rows(common.Stages(spark, kept.path("other")), table, table.where("false").select("number"), False).count() == 10
    kept.remove()


def test_missing_answers_of_suffixes_are_an_error(tmp_path):
    with pytest.raises(FileNotFoundError):
        suffix_dedup.Answers(str(tmp_path / "nowhere")).of(0, 0)
    assert suffix_dedup.Answers(str(tmp_path)).of(0, 0) == []


def test_missing_answers_of_a_part_are_an_error(tmp_path):
    with pytest.raises(FileNotFoundError):
        kneser_ney._answers(str(tmp_path / "nowhere" / "part=0"))
    assert len(kneser_ney._answers(str(tmp_path / "part=0"))[0]) == 0
