"""Quality by the perplexity under an interpolated modified Kneser-Ney n-gram model.

The n-grams are of bytes as they stand: the model is over a byte after the ``ORDER`` - 1 bytes before it.
Counts are those of all trusted texts. Kneser-Ney needs, for each order, the counts of its
n-grams (the highest order) or of the bytes seen before them (the lower ones), the sums over each
context, and three discounts from how many n-grams were seen once to four times. All are
aggregated tables, and joins by n-gram and by context, sharded by key, give the probability of
every event that the corpus holds, whether or not it was trained on.

Documents are scored by a join, too. They are written once with a number whose upper bits name the
part they lie in; each part asks for its own distinct events, the join with the
probabilities answers, and answers are written by part, so that whoever scores a part's texts reads its
answers where the texts lie. Nothing of the model passes the driver (but four counts an order), and no task
holds more of it than the distinct events of one part. Texts are not shuffled.

No key is hot: the events that are joined are distinct, so at most SYMBOLS ** (ORDER - k + 1) of them share a
context of order k; for the shortest contexts, where that is many, the other side is broadcast, and
has at most SYMBOLS ** 2 rows.

A document's perplexity is over all its bytes, with line ends as the context of the first. For each
language, the threshold is the quantile of the trusted documents' perplexities; a
language without trusted documents takes the quantile over all of them.

Null and empty texts have no perplexity and are not kept. Without trusted texts every byte is as
likely as any other and, as there is no threshold, nothing is kept. Repeated rows are judged alike.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, functions as F

from callweave.llm.common import chosen_rows, drop, one_array, parquet_files, slices, stages, text_column, utf8
from callweave.sources.shared import Stages

SYMBOLS, ORDER = 256, 5
#: Share of trusted documents, by language, that the threshold keeps.
QUANTILE = 0.995
LINE = 10
#: Orders whose contexts are broadcast: at most SYMBOLS ** 2 of them.
SHORT = 3
#: Events that a task collects before it adds up equal ones, and that it sends at a time.
BUFFER = 4 << 20
SENT = 1 << 18


def events(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One event for each byte: itself with the ORDER - 1 before it in its own text; and where
    the texts begin."""
    data, at = utf8(texts)
    size = np.diff(at)
    padded = np.full(len(data) + (ORDER - 1) * len(size), LINE, np.uint8)
    place = np.arange(len(data)) + np.repeat(np.arange(len(size)) * (ORDER - 1), size)
    padded[place + ORDER - 1] = data
    code = np.zeros(max(len(padded) - ORDER + 1, 0), np.int64)
    for i in range(ORDER):
        code = code << 8 | padded[i : i + len(code)]
    return code[place], at


class Tally:
    """Distinct events with their counts."""

    def __init__(self):
        self.event, self.n, self.waiting, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def add(self, code: np.ndarray) -> None:
        self.waiting.append(np.unique(code, return_counts=True))
        self.size += len(self.waiting[-1][0])
        if self.size > max(BUFFER, len(self.event)):
            self.settle()

    def settle(self) -> None:
        event = np.concatenate([self.event, *(e for e, _ in self.waiting)])
        n = np.concatenate([self.n, *(c for _, c in self.waiting)])
        order = np.argsort(event, kind="stable")
        event, n = event[order], n[order]
        first = np.flatnonzero(np.r_[True, event[1:] != event[:-1]][: len(event)])
        self.event, self.n = event[first], np.add.reduceat(n, first) if len(first) else n
        self.waiting, self.size = [], 0

    def sent(self, part: int | None = None):
        """Record batches of event and n, or of ``part`` and event."""
        self.settle()
        for a in range(0, len(self.event), SENT):
            event, n = (pa.array(c[a : a + SENT]) for c in (self.event, self.n))
            if part is None:
                yield pa.RecordBatch.from_arrays([event, n], names=["event", "n"])
            else:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(event), part)), event], names=["part", "event"])


def counted(texts: DataFrame) -> DataFrame:
    """``event`` and ``n``, from a column ``text``."""

    def count(batches):
        tally = Tally()
        for batch in slices(batches):
            tally.add(events(batch.column("text"))[0])
        yield from tally.sent()

    return texts.select("text").mapInArrow(count, "event long, n long").groupBy("event").agg(F.sum("n").alias("n"))


def by_part(batches):
    """The part, and the batch, of runs of rows from the same part."""
    for batch in slices(batches):
        parts = batch.column("number").to_numpy() >> 33
        cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
        for a, b in zip(cuts, cuts[1:]):
            yield int(parts[a]), batch.slice(a, b - a)


def asked(rows: DataFrame) -> DataFrame:
    """``part`` and ``event``, each event once for each part (or piece of it) of a table with ``text`` and ``number``."""

    def ask(batches):
        part, tally = None, Tally()
        for here, batch in by_part(batches):
            if here != part:
                yield from tally.sent(part)
                part, tally = here, Tally()
            tally.add(events(batch.column("text"))[0])
        yield from tally.sent(part)

    return rows.select("text", "number").mapInArrow(ask, "part long, event long")


def _discounted(counts: DataFrame) -> Column:
    """How much is taken from a count of one, two, or more; Chen and Goodman's estimate."""
    n = counts.agg(*[F.count(F.when(F.col("n") == i, 1)).alias(f"n{i}") for i in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
    more = [i - (i + 1) * y * b / a if a else 0.5 * i for i, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1)]
    d = [min(max(x, 0.1 * i), 0.95 * i) for i, x in enumerate(more, 1)]
    return F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])


def probabilities(trained: DataFrame, wanted: DataFrame) -> DataFrame:
    """``event`` and ``p`` of the wanted events. Each order is joined with its n-grams by n-gram and
    with its contexts by context; p of the lower order fills what discounts leave over."""
    kept = stages(trained.sparkSession)
    counts = [kept.keep(trained, f"order-{ORDER}")]
    for k in range(ORDER - 1, 0, -1):  # an n-gram counts by the symbols seen before it
        shorter = counts[0].groupBy((F.col("event") % SYMBOLS**k).alias("event")).agg(F.count("*").alias("n"))
        counts.insert(0, kept.keep(shorter, f"order-{k}"))
    result = wanted.select("event").distinct().withColumn("p", F.lit(1.0 / SYMBOLS))
    for k, table in enumerate(counts, 1):
        grams = table.withColumn("taken", _discounted(table)).withColumn("context", F.expr(f"event div {SYMBOLS}"))
        contexts = grams.groupBy("context").agg(F.sum("n").alias("total"), F.sum("taken").alias("left"))
        if k <= SHORT:
            contexts = F.broadcast(contexts)
        grams = grams.select(F.col("event").alias("gram"), (F.col("n") - F.col("taken")).alias("sure"))
        if k < SHORT:
            grams = F.broadcast(grams)
        result = (
            result.withColumn("gram", F.col("event") % SYMBOLS**k).withColumn("context", F.expr(f"gram div {SYMBOLS}"))
            .join(grams, "gram", "left").join(contexts, "context", "left")
            .select("event", F.when(F.col("total").isNull(), F.col("p"))
                    .otherwise((F.coalesce("sure", F.lit(0.0)) + F.col("left") * F.col("p")) / F.col("total")).alias("p"))
        )
    result = kept.keep(result, "probabilities")
    drop(kept, *[f"order-{k}" for k in range(1, ORDER + 1)])
    return result


def _answers(folder: str) -> tuple[pa.Array, np.ndarray]:
    """The events that a part asked for, and the logarithms of their probabilities."""
    files, names = parquet_files(folder)
    found = []
    for name in names:
        with files.open_input_file(name) as file:
            found.append(pq.ParquetFile(file).read(columns=["event", "log_p"]))
    if not found:
        return pa.array([], pa.int64()), np.zeros(0, np.float32)
    table = pa.concat_tables(found)
    return one_array(table["event"]), table["log_p"].to_numpy()


def _scored(kept: Stages, rows: DataFrame, texts: DataFrame) -> DataFrame:
    """``row``, n_bytes and perplexity of a stage table with ``row``, ``text`` and ``number``, under a model of ``texts``."""
    spark = rows.sparkSession
    wanted = kept.keep(asked(rows), "asked")
    table = probabilities(counted(texts), wanted)
    path = kept.path("answers")
    answers = wanted.join(table, "event").select("part", "event", F.log("p").cast("float").alias("log_p"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    answers.repartition(tasks, "part").write.partitionBy("part").parquet(path)
    drop(kept, "asked", "probabilities")
    home = re.sub("^file:/+", "/", path)  # a plain path is one for pyarrow, too

    def score(batches):
        part, known, log_p = None, None, None
        for here, batch in by_part(batches):
            if here != part:
                part, (known, log_p) = here, _answers(f"{home}/part={here}")
            code, at = events(batch.column("text"))
            found = pc.index_in(pa.array(code), value_set=known)
            if found.null_count:
                raise ValueError(f"{found.null_count} events of part {part} have no answer in {home}")
            size = np.diff(at)
            sums = np.r_[0.0, np.cumsum(log_p[found.to_numpy()], dtype=np.float64)]
            with np.errstate(invalid="ignore", divide="ignore"):
                perplexity = np.exp(-(sums[at[1:]] - sums[at[:-1]]) / size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(size), pa.array(perplexity, mask=size == 0)], names=["row", "n_bytes", "perplexity"]
            )

    kind = rows.schema["row"].dataType.simpleString()
    return rows.select("row", "text", "number").mapInArrow(score, f"row {kind}, n_bytes long, perplexity double")


def scored(docs: DataFrame, trusted: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Every row as ``row`` (or the columns ``carry`` of it) with n_bytes and perplexity, under a
    model of the column ``text`` of ``trusted``."""
    kept = stages(docs.sparkSession)
    row = F.struct(*(carry or ["*"])).alias("row")
    rows = kept.keep(docs.select(row, text_column(text).alias("text"), F.monotonically_increasing_id().alias("number")), "rows")
    return _scored(kept, rows, trusted.select(text_column(text).alias("text")))


def classified(docs: DataFrame, trusted_ids: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang",
               quantile: float = QUANTILE) -> DataFrame:
    """doc_id, lang, n_bytes, perplexity, threshold and kept of every document. ``trusted_ids`` has
    the ids of trusted documents in ``doc_id``."""
    kept = stages(docs.sparkSession)
    row = F.struct(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang")).alias("row")
    rows = kept.keep(docs.select(row, text_column(text).alias("text"), F.monotonically_increasing_id().alias("number")), "rows")
    ids = trusted_ids.select("doc_id").distinct()
    trusted = rows.select("number", F.col("row.doc_id").alias("doc_id")).join(ids, "doc_id", "left_semi")
    texts = chosen_rows(kept, rows.select(F.struct("text").alias("row"), "number"), trusted, True).select("row.text")
    table = kept.keep(_scored(kept, rows, texts).select("row.*", "n_bytes", "perplexity"), "scored")
    drop(kept, "rows", "chosen", "answers")
    good = table.join(ids, "doc_id", "left_semi").where("perplexity is not null")
    at = F.percentile_approx("perplexity", quantile, 100_000).alias("threshold")
    overall = good.agg(at).first()[0]
    by_lang = good.groupBy("lang").agg(at)
    return (
        table.join(by_lang, table["lang"].eqNullSafe(by_lang["lang"]), "left").drop(by_lang["lang"])
        .withColumn("threshold", F.coalesce("threshold", F.lit(overall).cast("double")))
        .withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)))
    )
