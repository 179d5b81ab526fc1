"""Best-fit packing of token sequences with a swap-based local search.

A document's ids are cut into pieces of at most ``capacity``; all but the first are full. How
the pieces fill sequences depends only on how many there are of each length, so packing is
done on that histogram, which has at most ``capacity`` rows at any scale: bins with the same
content are one entry with a count. Best fit, longest first, fills the bins. The local search
then takes the emptiest bins and moves their pieces to fuller ones, or exchanges a piece of
theirs for a shorter one or for two pieces that are shorter together, while the sum of squared
fills grows; a bin that becomes empty is saved. An exchange is looked up in an index of the lengths (and sums of two
lengths) that bins with so many free tokens have, so a step takes the same time at any scale, and the search ends where
a lower bound proves that no bin can be saved.

Each piece finds its place by its rank among the pieces of its length: tasks number the pieces
of a length that they write, counts by task and length give the ranks where they begin, and
the plan says which ranks go to which bins. No piece passes through the driver and none waits
for another one.

Null and empty texts are the end id alone. Repeated rows are packed each. An empty table
gives no sequences.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from callweave.llm.common import clear_worker_cache, slices, stages, text_column
from callweave.llm.tokens import ENCODED_BYTES, Encoder

CAPACITY = 2048
#: Exchanges that the local search tries at most; each is for all bins with the same content.
SEARCH_STEPS = 3000


def best_fit(histogram: dict[int, int], capacity: int) -> dict[int, Counter]:
    """Bins as {free tokens: {lengths in the bin: number of such bins}}."""
    free: dict[int, Counter] = defaultdict(Counter)
    for length in sorted(histogram, reverse=True):
        left, room = histogram[length], length
        while left:
            while room <= capacity and not free.get(room):
                room += 1
            if room > capacity:
                each = capacity // length
                for n, times in ((each, left // each), (left % each, 1)):
                    if n and times:
                        free[capacity - n * length][(length,) * n] += times
                break
            content, bins = next(iter(free[room].items()))
            each = room // length
            times, rest = min(bins, left // each), 0
            if not times:
                times, each = 1, left
            del free[room][content]
            if bins > times:
                free[room][content] = bins - times
            free[room - each * length][content + (length,) * each] += times
            left -= each * times
            room = length
    return free


def least_bins(histogram: dict[int, int], capacity: int) -> int:
    """A lower bound of the bins: for every k, pieces longer than ``capacity`` - k stand alone with regard to
    pieces of k or more, those above half a bin need one each, and what the latter leave free is filled first."""
    count = np.zeros(capacity + 1, dtype=object)
    for length, n in histogram.items():
        count[length] = n
    pieces, tokens = np.cumsum(count), np.cumsum(count * np.arange(capacity + 1))
    half = capacity // 2
    best = -(-int(tokens[-1]) // capacity)
    for k in range(half + 1):
        alone, large = pieces[-1] - pieces[capacity - k], pieces[capacity - k] - pieces[half]
        room = large * capacity - (tokens[capacity - k] - tokens[half])
        rest = tokens[half] - (tokens[k - 1] if k else 0) - room
        best = max(best, int(alone + large + max(0, -(-rest // capacity))))
    return best


class OpenBins:
    """The bins with free tokens, and for each number of free tokens the lengths, and the sums of two lengths,
    that some bin with so many has: row r of ``above[k]`` holds at x the least such number from x on."""

    def __init__(self, free: dict[int, Counter], capacity: int):
        self.capacity, self.bins = capacity, defaultdict(Counter)
        self.count = [np.zeros((capacity + 1, capacity + 2), np.int32) for _ in range(2)]
        self.above = [np.full((capacity + 1, capacity + 2), capacity + 1, np.int32) for _ in range(2)]
        for room, contents in free.items():
            for content, times in contents.items():
                self.add(room, content, times, renew=False)
        for room in self.bins:
            self.renew(room)

    @staticmethod
    def sums(content: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        """The distinct lengths, and the distinct sums of two pieces."""
        own, times = np.unique(content, return_counts=True)
        i, j = np.triu_indices(len(own))
        return own, np.unique((own[i] + own[j])[(i != j) | (times[i] > 1)])

    def renew(self, room: int) -> None:
        for count, above in zip(self.count, self.above):
            here = np.where(count[room] > 0, np.arange(self.capacity + 2), self.capacity + 1)
            above[room] = np.minimum.accumulate(here[::-1])[::-1]

    def add(self, room: int, content: tuple[int, ...], times: int, renew: bool = True) -> None:
        """Add ``times`` bins of this content, or take away as many if negative."""
        before = self.bins[room][content]
        self.bins[room][content] += times
        if not before + times:
            del self.bins[room][content]
        if room and bool(before) != bool(before + times):
            for count, sums in zip(self.count, self.sums(content)):
                count[room][sums] += 1 if times > 0 else -1
            if renew:
                self.renew(room)

    def exchange(self, victim: tuple[int, ...]):
        """The exchange that takes most from a bin of this content: (tokens, free of the other, content of the
        other, what the victim gives, what it gets). Each is looked up by what it wants: with r free tokens,
        a bin takes t for the least number it has from t - r on."""
        own = self.capacity - sum(victim)
        rooms = np.array([r for r in sorted(self.bins) if 0 < r <= own and self.bins[r]], dtype=np.int64)
        if not len(rooms):
            return None
        ones, twos = self.sums(victim)
        best = (0,)
        for gives, kinds in ((ones, (None, 0, 1)), (twos, (0,))):
            for kind in kinds:
                if not len(gives):
                    continue
                wanted = np.maximum(gives[:, None] - rooms, 0)
                got = np.zeros_like(wanted) if kind is None else self.above[kind][rooms, wanted]
                gain = gives[:, None] - got
                gain[(gain > rooms) | (gain < 0)] = 0
                at = int(np.argmax(gain))
                if gain.flat[at] > best[0]:
                    g, r = divmod(at, len(rooms))
                    best = (int(gain.flat[at]), int(rooms[r]), int(gives[g]), gives is twos, kind, int(got.flat[at]))
        if not best[0]:
            return None
        gain, room, total, pair, kind, got = best
        give = _parts(victim, total, 2 if pair else 1)
        if kind is None:
            return gain, room, next(iter(self.bins[room])), give, ()
        for content in self.bins[room]:
            get = _parts(content, got, kind + 1)
            if get:
                return gain, room, content, give, get
        raise AssertionError("the index names a bin that is not there")


def _parts(content: tuple[int, ...], total: int, n: int) -> tuple[int, ...]:
    """One or two pieces of a bin with this sum; none if it has no such pieces."""
    if n == 1:
        return (total,) if total in content else ()
    held = Counter(content)
    for x in held:
        if held[total - x] > (2 * x == total):
            return x, total - x
    return ()


def _without(content: tuple[int, ...], out: tuple[int, ...], into: tuple[int, ...]) -> tuple[int, ...]:
    left = list(content)
    for x in out:
        left.remove(x)
    return tuple(sorted([*left, *into], reverse=True))


def local_search(free: dict[int, Counter], capacity: int, steps: int = SEARCH_STEPS) -> dict[int, Counter]:
    """Empty the emptiest bins as far as exchanges with fuller ones go, or until the bins are proven few enough."""
    histogram, n_bins = Counter(), 0
    for contents in free.values():
        for content, times in contents.items():
            n_bins += times
            for x in content:
                histogram[x] += times
    least, stuck = least_bins(histogram, capacity), set()
    if n_bins <= least:
        return free
    bins = OpenBins(free, capacity)
    for _ in range(steps):
        victim = next((c for r in range(capacity, 0, -1) for c in bins.bins.get(r, ()) if c not in stuck), None)
        if victim is None or n_bins <= least:
            break
        room = capacity - sum(victim)
        alone = bins.bins[room][victim] == 1
        if alone:  # it must not meet itself
            bins.add(room, victim, -1)
        best = bins.exchange(victim)
        if alone:
            bins.add(room, victim, 1)
        if best is None:
            stuck.add(victim)
            continue
        gain, other_room, other, give, get = best
        times = min(bins.bins[room][victim], bins.bins[other_room][other])
        if victim == other:
            times = bins.bins[room][victim] // 2
        bins.add(room, victim, -times)
        bins.add(other_room, other, -times)
        smaller, fuller = _without(victim, give, get), _without(other, get, give)
        if smaller:
            bins.add(room + gain, smaller, times)
        else:
            n_bins -= times
        bins.add(other_room - gain, fuller, times)
    return bins.bins


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Slots by length and first rank: ranks [first, ...) of a length go to bins ``sequence``,
    ``sequence + 1``, ..., ``each`` of them to a bin, from ``offset`` on.

    Their number has a bound that no input moves: best fit ends a length or a kind of bin with each entry it
    makes, so it makes at most four for each length; an exchange adds two; a kind of bin has at most 63 different
    lengths. With the capacity and steps above that is below 900,000 slots, or 36 MB."""
    free = local_search(best_fit(histogram, capacity), capacity)
    used, rows, sequence = Counter(), [], 0
    for room in sorted(free):
        for content, bins in sorted(free[room].items()):
            offset = 0
            for length, same in groupby(content):
                each = len(list(same))
                rows.append((length, used[length], sequence, offset, each))
                used[length] += bins * each
                offset += length * each
            sequence += bins
    names = ("length", "first", "sequence", "offset", "each")
    rows.sort()
    return {n: np.array([r[i] for r in rows], dtype=np.int64) for i, n in enumerate(names)} | {"bins": sequence}


def pieces(docs: DataFrame, tokenizer_file: str, capacity: int, end_id: int, with_ids: bool) -> DataFrame:
    """``row`` and ``text`` in; for each piece ``row``, its number, start, length, checksum and
    (``with_ids``) its ids out, with the writing task and the piece's number in it by length."""
    row_type = docs.schema["row"].dataType.simpleString()
    fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
              ("part", pa.int32()), ("nth", pa.int64()), *([("ids", pa.list_(pa.int32()))] if with_ids else [])]

    def cut(batches):
        encoder, part = Encoder.of_worker(tokenizer_file), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in slices(batches, limit=ENCODED_BYTES // 2 if with_ids else ENCODED_BYTES):
            ids, at = encoder.encode(batch.column("text"))
            ids = np.insert(ids, at[1:], end_id).astype("<u4")  # the end id after each text
            at = at + np.arange(len(at))
            length = np.diff(at)
            count = -(-length // capacity)
            doc = np.repeat(np.arange(len(length)), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            head = (length - 1) % capacity + 1  # the first piece has what full ones leave
            start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
            size = np.where(piece == 0, head[doc], capacity)
            begin = at[doc] + start
            view = memoryview(ids).cast("B")
            crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + size).tolist())]
            order = np.argsort(size, kind="stable")
            sizes, first, n = np.unique(size[order], return_index=True, return_counts=True)
            nth = np.empty(len(doc), np.int64)
            nth[order] = np.arange(len(doc)) - np.repeat(first, n) + np.repeat(seen[sizes], n)
            seen[sizes] += n
            columns = [piece.astype(np.int32), start, size, crc, np.full(len(doc), part, np.int32), nth]
            arrays = [batch.column("row").take(pa.array(doc)), *(pa.array(c, t) for c, (_, t) in zip(columns, fields))]
            if with_ids:
                arrays.append(pa.ListArray.from_arrays(pa.array(np.r_[begin, len(ids)].astype(np.int32)), pa.array(ids.view("<i4"))))
            yield pa.RecordBatch.from_arrays(arrays, names=["row", *(f[0] for f in fields)])

    kinds = "piece int, start long, length long, ids_crc32 long, part int, nth long" + ", ids array<int>" * with_ids
    return docs.select("row", "text").mapInArrow(cut, f"row {row_type}, {kinds}")


def packed(docs: DataFrame, tokenizer_file: str, text: str = "text", carry: list[str] | None = None,
           capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Pieces of every row: ``row`` (or the columns ``carry`` of it), piece, start, length,
    ids_crc32, sequence_id, offset and, if asked for, the ids."""
    kept = stages(docs.sparkSession)
    rows = docs.select(F.struct(*(carry or ["*"])).alias("row"), text_column(text).alias("text"))
    table = kept.keep(pieces(rows, tokenizer_file, capacity, end_id, with_ids), "pieces")
    counts = kept.keep(table.groupBy("length", "part").agg((F.max("nth") + 1).alias("n")), "counts")
    slots = plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = counts.select("length", "part", F.coalesce(before, F.lit(0)).alias("base"))
    ranked = table.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.col("nth"))
    names = ["row", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def places(length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # Slots are sorted by length, then by first rank: the last one not beyond the rank.
        at = np.searchsorted(slots["length"] << 48 | slots["first"], length << 48 | rank, side="right") - 1
        bin_of, nth = np.divmod(rank - slots["first"][at], slots["each"][at])
        return slots["sequence"][at] + bin_of, slots["offset"][at] + nth * slots["length"][at]

    # Only lengths and ranks go to Python; rows and their ids stay where they are.
    @F.pandas_udf("sequence_id long, offset long")
    def place(columns: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        clear_worker_cache()  # beside ids there is no room for what encoding keeps
        for length, rank in columns:
            yield pd.DataFrame(dict(zip(("sequence_id", "offset"), places(length.to_numpy(), rank.to_numpy()))))

    # Without ids rows are narrow, and this way takes less time.
    def place_rows(batches):
        for batch in batches:
            found = places(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(c) for c in found], names=[*names, "sequence_id", "offset"])

    if with_ids:
        return ranked.withColumn("place", place("length", "rank")).select(*names, "place.sequence_id", "place.offset")
    types = {f.name: f.dataType.simpleString() for f in table.schema}
    return ranked.select(*names, "rank").mapInArrow(
        place_rows, ", ".join(f"{n} {types[n]}" for n in names) + ", sequence_id long, offset long"
    )
