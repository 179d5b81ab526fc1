"""How filters interact: what each one removes, alone and behind the others, in every order.

Five filters judge each text by itself (A to D) or by the whole table (E: a smaller id has the same
text). All counts follow from one table: how many documents of a part, with which labels, fail
which set of filters (a mask of five bits). That table is kept up to date by a stream:

* All files of the input are processed as available-now micro-batches. Texts are measured where they are read; only
  their keys (SHA-256 and length), masks and ids go on, and meet the labels. Each task then combines equal texts: rows
  that have a smaller id of the same text beside them fail E for certain and are only counted; those with the least id go
  on, as counts for each part, mask and labels. So a text that a third of all rows share is a few rows for each task.
* State is keyed by the text: the least id so far and the counts of its rows. What comes with a larger id
  fails E. When a smaller id arrives, the counts noted for the earlier one are retracted (negative deltas) and
  counted again with E; equal ids are added. Texts share a state value by hash, ``STATE_TEXTS`` of them on average: Spark
  calls Python once for each value, not for each text, and the number of values grows with the input.
* Deltas go to a file sink with a checkpoint: a batch that is repeated after a failure counts once.

The sum of all deltas is the table, in whatever order files and rows came. It has at most
``parts x 32 x 4`` rows, from which Spark works out the permutations of the filters.

Null texts are empty texts. Null ids come after all others: such rows fail E if any row with an id has
the text. Rows with the same id and text do not fail E by each other. A null part is the empty
string. A document is good or toxic if any of its label rows says so. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import uuid

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from callweave.llm.common import one_array, slices, stages

FILTERS = "ABCDE"
E_BIT = 16
#: Files of a micro-batch, at most; texts that share a state value, on average.
BATCH_FILES, STATE_TEXTS = 64, 1000
_CAPITALS = bytes(range(65, 91))
_SYMBOLS = b"#$%&*|"

#: Rows of one text that have the same part, mask and labels; key is null if they fail E for certain.
_COUNTS = pa.schema([
    ("key", pa.string()), ("no_id", pa.bool_()), ("id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("good", pa.bool_()), ("toxic", pa.bool_()),
    ("n", pa.int64()),
])
_COUNTS_DDL = "key string, no_id boolean, id long, part string, mask int, good boolean, toxic boolean, n long"
_DELTAS = "part string, mask int, good boolean, toxic boolean, n long"
_WHAT = ["part", "mask", "good", "toxic"]


def own_mask(data: bytes, points: int) -> int:
    """Bits of the filters A to D that a text fails, from its UTF-8 bytes and its code points."""
    words = data.split()  # the six blanks of ASCII
    mask = 1 if len(words) < 100 else 0
    mask |= 2 if 100 * len(set(words)) < 80 * len(words) else 0
    mask |= 4 if 100 * (len(data) - len(data.translate(None, _CAPITALS))) > 10 * points else 0
    return mask | (8 if len(data.translate(None, _SYMBOLS)) < len(data) else 0)


def measured(docs: DataFrame) -> DataFrame:
    """``id``, ``part`` and ``text`` in; id, part, the text's ``key`` and the ``mask`` of A to D out."""

    def measure(batches):
        for part in slices(batches):
            keys, masks = [], []
            for text in one_array(part.column("text")).to_pylist():
                data = (text or "").encode()
                keys.append(f"{hashlib.sha256(data).hexdigest()}{len(data)}")
                masks.append(own_mask(data, len(text or "")))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("part"), pa.array(keys, pa.string()), pa.array(masks, pa.int32())], names=["id", "part", "key", "mask"]
            )

    return docs.select("id", "part", "text").mapInArrow(measure, "id long, part string, key string, mask int")


def _least(rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.Series]:
    """The rows in order of key and id (null is larger than all others), and which have the least id of their key."""
    rows = rows.sort_values(["key", "no_id", "id"], ignore_index=True)
    first = rows.groupby("key", sort=False)[["no_id", "id"]].transform("first")
    return rows, (rows["no_id"] == first["no_id"]) & (rows["id"] == first["id"])


def _summed(rows: pd.DataFrame, by: list[str]) -> pd.DataFrame:
    return rows.groupby(by, sort=False, dropna=False, as_index=False)["n"].sum()


def combined(rows: DataFrame) -> DataFrame:
    """``id``, ``part``, ``key``, ``mask``, ``good`` and ``toxic`` in; counts of equal rows out, for each text of a batch those with
    its least id, all others as counts without a key."""

    def combine(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            given = batch.to_pandas()
            ids = one_array(batch.column("id"))
            given["no_id"], given["id"], given["n"] = ids.is_null().to_pandas(), ids.fill_null(0).to_numpy(), 1
            given, held = _least(given)
            late = given[~held].assign(mask=lambda x: x["mask"] | E_BIT, key=None, no_id=True, id=0)
            out = pd.concat([_summed(x, ["key", "no_id", "id", *_WHAT]) for x in (given[held], late) if len(x)])
            yield from pa.Table.from_pandas(out[_COUNTS.names], _COUNTS, preserve_index=False).to_batches()

    return rows.select("id", "part", "key", "mask", "good", "toxic").mapInArrow(combine, _COUNTS_DDL)


def update(key: tuple, frames, state: GroupState):
    """Deltas of the part counters from new rows of the texts of one state value."""
    new = pd.concat(frames)
    settled, new = new[new["key"].isna()], new[new["key"].notna()]
    changes = [settled]
    if len(new):
        old = pa.ipc.open_stream(state.get[0]).read_pandas() if state.exists else new[:0]
        rows, held = _least(pd.concat([old, new], ignore_index=True) if len(old) else new)
        kept = _summed(rows[held], ["key", "no_id", "id", *_WHAT])
        late = rows[~held].assign(mask=lambda x: x["mask"] | E_BIT)
        changes += [old.assign(n=-old["n"]), kept, late]
        table, sink = pa.Table.from_pandas(kept[_COUNTS.names], _COUNTS, preserve_index=False), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _COUNTS) as writer:
            writer.write_table(table)
        state.update((sink.getvalue().to_pybytes(),))
    deltas = _summed(pd.concat([c[[*_WHAT, "n"]] for c in changes if len(c)]), _WHAT)
    yield deltas[deltas["n"] != 0]


def run_stream(docs: DataFrame, labels: DataFrame, target: str, text: str = "text", doc_id: str = "doc_id", part: str = "lang",
               state_values: int = 200) -> DataFrame:
    """Process all that the stream ``docs`` has now; the deltas, as stored below ``target``. Called again with the
    same folder, number of state values and a stream of the same files and new ones, it takes up the new ones."""
    spark = labels.sparkSession
    marks = labels.select(F.col(doc_id).alias("_id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    marks = marks.where("_id is not null").groupBy("_id").agg(*[F.coalesce(F.bool_or(c), F.lit(False)).alias(c) for c in ("good", "toxic")])
    rows = measured(docs.select(
        F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).cast("string").alias("text")
    ))
    # Rows without an id find no label; their salt spreads them over the tasks of the join.
    rows = rows.withColumn("salt", F.when(F.col("id").isNull(), F.pmod(F.xxhash64("key", "part"), F.lit(1000))).otherwise(0))
    rows = rows.join(marks.withColumn("_salt", F.lit(0).cast("long")), (F.col("id") == F.col("_id")) & (F.col("salt") == F.col("_salt")), "left")
    rows = rows.select("id", "part", "key", "mask", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    value = F.pmod(F.when(F.col("key").isNull(), F.xxhash64(*_WHAT)).otherwise(F.xxhash64("key")), F.lit(state_values))
    changes = combined(rows).withColumn("value", value).groupBy("value").applyInPandasWithState(
        update, _DELTAS, "counts binary", "append", GroupStateTimeout.NoTimeout
    )
    query = (
        changes.writeStream.format("parquet").outputMode("append").option("path", f"{target}/deltas")
        .option("checkpointLocation", f"{target}/progress").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(_DELTAS).parquet(f"{target}/deltas")


def audit(deltas: DataFrame) -> DataFrame:
    """One row for each part, order of the five filters and step, from the deltas of the part counters."""
    masks = deltas.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n <> 0")
    orders = F.array(*[F.lit("".join(p)) for p in itertools.permutations(FILTERS)])
    steps = masks.select("*", F.explode(orders).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("step"))

    def bits(letters):
        """Mask of a string of letters."""
        return sum((F.when(letters.contains(f), 1 << i).otherwise(0) for i, f in enumerate(FILTERS)), F.lit(0))

    own = bits(F.substr("filter_order", F.col("step"), F.lit(1)))
    earlier = bits(F.substr("filter_order", F.lit(1), F.col("step") - 1))
    fails, before = F.col("mask").bitwiseAND(own) != 0, F.col("mask").bitwiseAND(earlier) != 0
    removed = fails & ~before

    def total(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(0)).cast("long")

    counted = steps.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~before).alias("kept"), total(removed).alias("removed"), total(fails & before).alias("redundant"),
        total(F.col("mask") == own).alias("unique_fails"), total(removed & F.col("good")).alias("good_lost"),
        total(removed & F.col("toxic")).alias("toxic_lost"),
    )
    # 600 rows for each part, each with a filter's share in one order.
    letter = F.substr("filter_order", F.col("step"), F.lit(1))
    shares = counted.groupBy("part", letter.alias("letter")).agg(F.sum("removed").alias("shapley"))
    return counted.withColumn("letter", letter).join(shares, ["part", "letter"]).select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def audited(spark: SparkSession, path: str, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "lang",
            batch_files: int = BATCH_FILES) -> DataFrame:
    """The audit of the Parquet files at ``path`` (one file or a folder)."""
    table = spark.read.parquet(path).select(doc_id, text, part)
    values = max(64, table.count() // STATE_TEXTS)
    # A stream reads a single file only by a pattern: the last letter as a class of one letter.
    pattern = f"{path.rstrip('/')[:-1]}[{path.rstrip('/')[-1]}]"
    docs = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", batch_files).parquet(pattern)
    target = f"{stages(spark).folder}/{uuid.uuid4().hex}"
    return audit(run_stream(docs, labels, target, text, doc_id, part, values))
