"""The pipeline on the smallest tables, stage by stage, and its stages on hard rows."""

import sys
import os

import brute
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def hard(spark):
    """Rows with extra columns whose names the operators use, nulls, and repeated rows."""
    some = " ".join(f"word{i}" for i in range(80))
    rows = [(1, some, "en", "s", 9), (1, some, "en", "s", 9), (2, some, None, None, None), (3, None, "en", "s", 0), (None, "", "de", "s", 0),
            (4, "Mail a@b.de. " + " ".join(f"other{i}" for i in range(90)), "en", "s", 5), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({"number": F.lit(1), "fp": F.lit("x"), "kept": F.lit(False), "row": F.lit("r"), "piece": F.lit(None).cast("int")})


def test_stages_are_in_order_and_registered():
    assert list(STAGES) == ["quality_rules", "simhash_near_duplicates", "benchmark_decontamination", "personal_data", "best_fit_packing"]
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    names = list(entry.queries())
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14))


def test_each_stage_works_on_what_the_one_before_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        assert out.dtypes == spark.read.parquet(f"{SF}/documents.parquet").dtypes
        kept = {r.doc_id: r.text for r in out.collect()}
        assert kept and set(kept) <= set(seen) and out.count() == len(kept)
        if name == "quality_rules":
            assert not any(brute.measures(t)[-1] for t in kept.values())
        if name == "benchmark_decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            hits = brute.benchmark_hits(list(seen.items()), items)
            assert {h[0] for h in hits if not h[-1]} == set(kept)
        if name == "personal_data":
            assert set(kept) == set(seen) and not any(brute.personal(t) for t in kept.values())
            assert all(r.n_chars == len(r.text) for r in out.collect())
        else:
            assert all(seen[i] == t for i, t in kept.items())
        docs, seen = out, kept
    pieces = STAGES["best_fit_packing"](spark, docs, SF).collect()
    assert {p.doc_id for p in pieces} == set(seen)


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    by_sequence = {}
    for r in rows:
        by_sequence[r.sequence_id] = by_sequence.get(r.sequence_id, 0) + r.length
    assert rows and max(by_sequence.values()) <= 2048


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_take_hard_rows(spark, hard, name):
    got = STAGES[name](spark, hard, SF)
    rows = got.collect()
    if name != "best_fit_packing":
        assert got.columns == hard.columns
    ids = sorted(str(r.doc_id) for r in rows)
    assert ids == {
        "quality_rules": ["1", "1", "2", "4"],
        "simhash_near_duplicates": ["1", "3", "4"],
        "benchmark_decontamination": ["1", "1", "2", "3", "4", "None", "None"],
        "personal_data": ["1", "1", "2", "3", "4", "None", "None"],
        "best_fit_packing": ["1", "1", "2", "3", "4", "None", "None"],
    }[name]
    if name == "personal_data":
        by_id = {r.doc_id: r.text for r in rows if r.doc_id}
        assert by_id[4].startswith("Mail [EMAIL]") and by_id[3] is None


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_take_empty_tables(spark, hard, name):
    assert STAGES[name](spark, hard.limit(0), SF).collect() == []
