"""Filter audit against brute force, by batches in any order, and hard rows."""

import collections
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from callweave.llm import filter_audit as fa

SCHEMA = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute(docs, labels):
    """Rows by the contract: every order is applied to every document."""
    fails, parts = [], []
    for doc, text, lang in docs:
        text, words = text or "", re.findall(r"[^\x20\x09-\x0D]+", text or "")
        less = any(d is not None and (doc is None or d < doc) and (t or "") == text for d, t, _ in docs)
        fails.append({
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": less,
        })
        good = any(d == doc and d is not None and q == 1 for d, q, _ in labels)
        toxic = any(d == doc and d is not None and t == 1 for d, _, t in labels)
        parts.append((lang or "", good, toxic))
    out, shapley = {}, collections.Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        left, gone = range(len(docs)), []
        for step, f in enumerate(order, 1):
            now = [i for i in left if fails[i][f]]
            left = [i for i in left if not fails[i][f]]
            for part in {p[0] for p in parts}:
                mine = lambda rows: [i for i in rows if parts[i][0] == part]  # noqa: E731, B023
                out[part, order, step] = [
                    len(mine(left)), len(mine(now)), len([i for i in mine(gone) if fails[i][f]]),
                    len([i for i in mine(range(len(docs))) if fails[i][f] and sum(fails[i].values()) == 1]),
                    sum(parts[i][1] for i in mine(now)), sum(parts[i][2] for i in mine(now)),
                ]
                shapley[part, f] += len(mine(now))
            gone += now
    return sorted((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def rows(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def documents():
    rng = random.Random(9)
    base = [" ".join(rng.choices([f"w{i}" for i in range(k)], k=120)) for k in (2000, 60)] + ["SHORT TEXT", "a $ b", "", "plain short"]
    docs = [(rng.randrange(1000), rng.choice(base) + rng.choice(["", "", " %", " X"]), rng.choice(["en", "de", None, ""])) for _ in range(150)]
    docs += [(i, base[0], "en") for i in range(2000, 2060)]  # a group of copies
    docs += [(7, base[1], "en"), (7, base[1], "de"), (7, base[1], "de"), (None, base[0], "fr"), (None, "only null ids", "fr"), (None, "only null ids", "fr"), (8, None, None)]
    return docs


def labels():
    return [(i, i % 2, int(i % 3 == 0)) for i in range(0, 2060, 2)] + [(7, 1, 0), (7, 0, 1), (8, None, None), (None, 1, 1)]


@pytest.mark.parametrize("files, batch_files", [(1, 1), (6, 1), (6, 4)])
def test_against_brute_force(spark, tmp_path, files, batch_files):
    docs = documents()
    for seed in range(files):  # the order of files is not that of ids
        part = spark.createDataFrame(docs[seed::files], SCHEMA).withColumns({"id": F.lit(1), "key": F.lit("k"), "good": F.lit(True), "n": F.lit(2)})
        part.coalesce(2).write.mode("append").parquet(f"{tmp_path}/docs")
    found = fa.audited(spark, f"{tmp_path}/docs", spark.createDataFrame(labels(), LABELS), batch_files=batch_files)
    assert rows(found) == brute(docs, labels())


def test_smaller_ids_retract_earlier_masks(spark, tmp_path):
    """Batches with falling ids: each new least id takes the place of the one before."""
    schema, marks = "doc_id long, text string, lang string", spark.createDataFrame([], LABELS)
    deltas = []
    for doc in (30, 20, 40, 10):
        spark.createDataFrame([(doc, "same text", f"p{doc}")], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/docs")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/docs")
        deltas = fa.run_stream(stream, marks, f"{tmp_path}/state")  # the same state goes on
    counts = {(r.part, r["mask"]): r.n for r in deltas.groupBy("part", "mask").agg(F.sum("n").alias("n")).collect() if r.n}
    assert counts == {("p10", 1): 1, ("p20", 17): 1, ("p30", 17): 1, ("p40", 17): 1}
    assert deltas.where("n < 0").count() == 2 and deltas.count() == 8


def test_a_finished_stream_counts_nothing_twice(spark, tmp_path):
    spark.createDataFrame(documents(), SCHEMA).write.parquet(f"{tmp_path}/docs")
    marks = spark.createDataFrame(labels(), LABELS)
    for _ in range(2):
        stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/docs")
        deltas = fa.run_stream(stream, marks, f"{tmp_path}/state")
    assert rows(fa.audit(deltas)) == brute(documents(), labels())


def test_a_task_passes_on_few_rows_of_a_common_text(spark):
    docs = spark.range(5000, numPartitions=1).select("id", F.lit("en").alias("part"), F.lit("same").alias("text"))
    sent = fa.combined(fa.measured(docs).withColumns({"good": F.lit(False), "toxic": F.lit(False)})).collect()
    assert len(sent) <= 4 and sum(r.n for r in sent) == 5000


def test_empty_table_and_long_text(spark, tmp_path):
    marks = spark.createDataFrame([], LABELS)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/none")
    assert fa.audited(spark, f"{tmp_path}/none", marks).collect() == []
    docs = [(2, "word " * 400_000, "en"), (1, "x" * 1_000_000, "en")]
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{tmp_path}/long")
    assert rows(fa.audited(spark, f"{tmp_path}/long", marks)) == brute(docs, [])
