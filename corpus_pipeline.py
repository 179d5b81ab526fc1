"""A training corpus from ``documents``: five stages, each written as Parquet and read again.

run(spark, sf_dir) applies them. Rejected by the rules: gone. Of near-duplicates the row with
the least id stays (the first of rows with the same id). Contaminated
documents go. Personal data is replaced by its kind in brackets, and n_chars follows. The last
stage packs the tokens: its rows are pieces with their ids and place, no longer documents.

Every stage takes null and empty texts, repeated rows, empty tables and extra columns: an
operator sees the given row as one struct, so no name can clash.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from callweave.llm import decontamination, packing, pii, quality_rules, simhash
from callweave.llm.common import drop, noted_stages, read, stages
from callweave.sources.shared import Stages


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality is at least one half."""
    return quality_rules.judged(docs).where("kept").select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts whose 5-word shingles have a similarity of 0.8."""
    return simhash.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with the benchmark."""
    items = read(spark, sf_dir, "benchmark", "item_id", "text")
    return decontamination.uncontaminated(docs, items)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the kind of personal data in its place; a null text stays null."""
    found = pii.with_spans(docs)
    text = F.when(F.col("row.text").isNotNull(), F.col("redacted"))
    columns = {"text": text, "n_chars": F.length(text).cast("long")}
    return found.select(*[columns.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their ids, sequence and offset in it."""
    pieces = packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), carry=["doc_id"], with_ids=True)
    return pieces.select("row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids")


#: Stage tables of the stage that was called last.
_last: list[Stages] = []


def _forget() -> None:
    while _last:
        _last.pop().remove()


def _tidy(stage):
    """A stage is called when the one before it has been written, so what that left in the shared
    folder can go. Its own tables stay, since its result reads them."""

    @functools.wraps(stage)
    def tidied(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _forget()
        with noted_stages() as made:
            result = stage(spark, docs, sf_dir)
        _last.extend(made)
        return result

    return tidied


STAGES = [
    ("quality_rules", _tidy(quality_stage)),
    ("simhash_near_duplicates", _tidy(near_duplicate_stage)),
    ("benchmark_decontamination", _tidy(decontamination_stage)),
    ("personal_data", _tidy(personal_data_stage)),
    ("best_fit_packing", _tidy(packing_stage)),
]

#: EM, fingerprints, transducers and packing are beyond SQL; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each reading what the one before it wrote."""
    kept, before = stages(spark), None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = kept.keep(stage(spark, docs, sf_dir), name)
        if before:
            drop(kept, before)
        before = name
    _forget()
    return docs
