"""Benchmark decontamination by winnowing.

Words are hashed, and k consecutive words give a k-gram hash. Of every ``window`` words (that
is window - k + 1 k-grams) the least hash is kept, the rightmost of equal ones. A window of an
item and an equal window of a document therefore keep the same k-gram at the same place, so
joining kept hashes finds every shared window. Items with fewer words than a window are one
window of their own; all n-grams of these lengths are hashed on both sides.

Before the join, documents drop the hashes that no item has, with the help of a bitmap of a
fixed size (``BITMAP_BITS``). If the items were so many that it filled up, it would only drop
less. What is left is joined with the words around it, and each window is compared word by
word, so a hash that two texts share by chance has no effect. Overlapping windows extend each
other to the whole shared span.

Null and empty texts have no words: such documents are clean and such items match nothing.
Repeated documents are judged each on their own (``row`` numbers rows), repeated items count
by their id once. Either table may be empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from callweave.llm.common import batch_of, chosen_rows, mixed, one_array, ranges, slices, stages, text_column, utf8

WINDOW, GRAM = 10, 5
#: Size of the bitmap that goes to every task: 2 MiB.
BITMAP_BITS = 1 << 24

# Bytes of words; A-Z are lower-cased first. Bytes of 0x80 and more belong to other letters.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_MAX = np.uint64(0xFFFFFFFFFFFFFFFF)


def words_of(data: np.ndarray, at: np.ndarray):
    """Words of lower-cased texts: where each begins and ends, its hash, and the words before
    each text. No word crosses from one text to the next."""
    is_word = _WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    before = np.zeros(len(data), bool)
    before[1:] = is_word[:-1]
    begins = np.flatnonzero(is_word & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = is_word[1:]
    ends = np.flatnonzero(is_word & (~after | edge[1:])) + 1
    lengths = ends - begins
    hashes = lengths.astype(np.uint64)
    # One letter of every word at a time, for the words that still have one.
    left = np.arange(len(begins))
    step = 0
    while len(left):
        hashes[left] = hashes[left] * np.uint64(_BASE) + data[begins[left] + step].astype(np.uint64) + np.uint64(1)
        step += 1
        left = left[lengths[left] > step]
        if step == 64 and len(left):  # the rest of very long words by Python's slices
            for i in left.tolist():
                h = int(hashes[i])
                for c in data[begins[i] + step : ends[i]].tolist():
                    h = (h * _BASE + c + 1) & 0xFFFFFFFFFFFFFFFF
                hashes[i] = h
            break
    return begins, ends, mixed(hashes), np.searchsorted(begins, at)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of k words from each place that has so many from there on; none of fewer words than k."""
    if len(hashes) < k:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) - k + 1, np.uint64)
    for i in range(k):
        total = total * np.uint64(_BASE) + hashes[i : len(hashes) - k + 1 + i]
    return mixed(total + np.uint64(k))


def kept_grams(hashes: np.ndarray, first: np.ndarray, k: int, window: int) -> np.ndarray:
    """Places of the k-grams that winnowing keeps, over texts that begin at words ``first``."""
    values = grams(hashes, k)
    span = window - k + 1
    n = len(values) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, place = values[:n].copy(), np.arange(n)
    for i in range(1, span):
        other = values[i : n + i]
        better = other <= best
        best[better] = other[better]
        place[better] = np.arange(n)[better] + i
    # Windows within one text only.
    room = np.repeat(first[1:], np.diff(first))[:n] - np.arange(n) >= window
    return np.unique(place[room])


def short_grams(hashes: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    n = max(len(hashes) - k + 1, 0)
    room = np.repeat(first[1:], np.diff(first))[:n] - np.arange(n) >= k
    return np.flatnonzero(room)


def marks(texts: pa.Array, window: int, gram: int, short: list[int]):
    """For a run of texts: their lower-cased bytes, the words, and for each length of gram the
    places and hashes of the kept grams."""
    data, at = utf8(texts)
    data = _LOWER[data]
    begins, ends, hashes, first = words_of(data, at)
    found = {gram: kept_grams(hashes, first, gram, window)}
    for k in short:
        found[-k] = short_grams(hashes, first, k)
    return data, begins, ends, first, {
        k: (p, grams(hashes, abs(k))[p] ^ np.uint64(k < 0)) for k, p in found.items()
    }


def _bits(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) & (BITMAP_BITS - 1)


def item_windows(items: DataFrame, window: int, gram: int) -> DataFrame:
    """Every window of every item with the gram that winnowing keeps of it: hash, length of the
    window, words before the gram in it, and the window's words."""

    schema = pa.schema([("item_id", pa.string()), ("hash", pa.int64()), ("n", pa.int32()),
                        ("before", pa.int32()), ("words", pa.binary())])

    def windows(batches):
        for part in slices(batches):
            ids = one_array(part.column("item_id")).to_pylist()
            data, begins, ends, first, _ = marks(part.column("text"), window, gram, [])
            _, _, hashes, _ = words_of(data, utf8(part.column("text"))[1])
            out = []
            for i, item in enumerate(ids):
                a, b = int(first[i]), int(first[i + 1])
                words = [data[begins[j] : ends[j]].tobytes() for j in range(a, b)]
                if not words:
                    continue
                if len(words) < window:
                    h = grams(hashes[a:b], b - a)[0] ^ np.uint64(1)
                    out.append((item, h, len(words), 0, b" ".join(words)))
                    continue
                values = grams(hashes[a:b], gram)
                for j in range(len(words) - window + 1):
                    near = values[j : j + window - gram + 1]
                    place = len(near) - 1 - int(np.argmin(near[::-1]))
                    out.append((item, near[place], window, place, b" ".join(words[j : j + window])))
            if out:
                item, h, n, before, words = zip(*out)
                yield batch_of(schema, item, np.array(h, np.uint64).view(np.int64), n, before, words)

    return items.mapInArrow(windows, "item_id string, hash long, n int, before int, words binary")


def _bitmap(windows: DataFrame) -> np.ndarray:
    """The bits of all hashes of items, joined by bitwise or in tasks and on the driver."""

    def bits(batches):
        made = np.zeros(BITMAP_BITS // 8, np.uint8)
        for batch in batches:
            h = one_array(batch.column("hash")).to_numpy(zero_copy_only=False).view(np.uint64)
            b = _bits(h)
            np.bitwise_or.at(made, b >> 3, (1 << (b & 7)).astype(np.uint8))
        where = np.flatnonzero(made)
        yield pa.RecordBatch.from_arrays(
            [pa.array(where.astype(np.int32)), pa.array(made[where].astype(np.int16))], names=["byte", "bits"]
        )

    made = np.zeros(BITMAP_BITS // 8, np.uint8)
    found = windows.select("hash").mapInArrow(bits, "byte int, bits short").groupBy("byte").agg(F.bit_or("bits").alias("bits"))
    for byte, bits_ in found.toLocalIterator():  # one row for each byte at most, whatever the items
        made[byte] = bits_
    return made


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                  carry: list[str] | None = None, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Every row of ``docs`` as column ``row`` (or the columns ``carry`` of it), with n_words, n_hit,
    n_items, items (sorted, comma-joined) and contaminated."""
    _, numbered, judged = _judged(docs, items, text, item_id, carry, window, gram)
    return numbered.select("number", "row").join(judged, "number").drop("number")


def uncontaminated(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                   window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The given columns of the rows without a hit."""
    kept, numbered, judged = _judged(docs, items, text, item_id, None, window, gram)
    return chosen_rows(kept, numbered, judged.where("contaminated"), False).select("row.*")


def _judged(docs: DataFrame, items: DataFrame, text: str, item_id: str, carry: list[str] | None, window: int, gram: int):
    """The numbered rows, and what is found by number.

    The rows are written once; counts and candidates come from the written rows, so that the
    number of a row stays the same if a task runs again.
    """
    spark = docs.sparkSession
    kept = stages(spark)
    items = items.select(F.col(item_id).cast("string").alias("item_id"), text_column().alias("text"))
    windows = kept.keep(item_windows(items.dropDuplicates(), window, gram), "windows")
    short = sorted(r[0] for r in windows.where(F.col("n") < window).select("n").distinct().collect())
    bitmap = _bitmap(windows)
    whole = carry is None or text in carry
    row = F.struct(*(carry or ["*"])).alias("row")
    numbered = kept.keep(
        docs.select(row, *([] if whole else [F.col(text).alias("text")])).withColumn("number", F.monotonically_increasing_id()),
        "rows",
    )
    texts = numbered.select("number", text_column(f"row.`{text}`" if whole else "text").alias("text"))
    schema = pa.schema([("number", pa.int64()), ("n_words", pa.int64()), ("hash", pa.int64()), ("n", pa.int32()),
                        ("place", pa.int32()), ("lead", pa.int32()), ("around", pa.binary())])

    def candidates(batches):
        for part in slices(batches):
            numbers = one_array(part.column("number")).to_numpy()
            data, begins, ends, first, found = marks(part.column("text"), window, gram, short)
            n_words = np.diff(first)
            rows = len(numbers)
            yield batch_of(schema, numbers, n_words, pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int32()),
                           pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary()))
            for k, (places, hashes) in found.items():
                b = _bits(hashes)
                here = np.flatnonzero(bitmap[b >> 3] >> (b & 7).astype(np.uint8) & 1)
                if not len(here):
                    continue
                places, hashes = places[here], hashes[here]
                doc = np.searchsorted(first, places, side="right") - 1
                reach = window - gram if k > 0 else 0
                low = np.maximum(places - reach, first[doc])
                high = np.minimum(places + abs(k) + reach, first[doc + 1])
                around = [b" ".join(data[begins[j] : ends[j]].tobytes() for j in range(x, y))
                          for x, y in zip(low.tolist(), high.tolist())]
                yield batch_of(schema, numbers[doc], pa.nulls(len(doc), pa.int64()), hashes.view(np.int64),
                               np.full(len(doc), window if k > 0 else -k, np.int32), (places - first[doc]).astype(np.int32),
                               (places - low).astype(np.int32), around)

    found = kept.keep(
        texts.mapInArrow(
            candidates, "number long, n_words long, hash long, n int, place int, lead int, around binary"
        ),
        "candidates",
    )
    # A window fits if its words stand around the gram at the same distance from it.
    joined = found.where("hash is not null").join(windows, ["hash", "n"]).where("lead >= before")
    around = F.split(F.col("around").cast("string"), " ")
    hits = joined.withColumn("around", around).where(
        F.expr("array_join(slice(around, lead - before + 1, n), ' ') = cast(words as string)")
    ).select("number", "item_id", (F.col("place") - F.col("before")).alias("begin"),
             (F.col("place") - F.col("before") + F.col("n")).alias("end")).distinct()
    hits = kept.keep(hits, "hits")
    reach = F.max("end").over(Window.partitionBy("number").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1))
    covered = (
        hits.select("number", "begin", "end").distinct().withColumn("reach", F.coalesce(reach, F.lit(0)))
        .groupBy("number")
        .agg(F.sum(F.greatest(F.col("end") - F.greatest("begin", "reach"), F.lit(0))).alias("n_hit"))
    )
    by_items = (
        hits.select("number", "item_id").distinct().groupBy("number")
        .agg(F.sort_array(F.collect_list("item_id")).alias("ids"))
        .select("number", F.size("ids").cast("long").alias("n_items"), F.array_join("ids", ",").alias("items"))
    )
    judged = (
        found.where("hash is null").select("number", "n_words")
        .join(covered, "number", "left").join(by_items, "number", "left")
        .select("number", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", F.lit("")).alias("items"),
                F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))
    )
    return kept, numbered, judged
