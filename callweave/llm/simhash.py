"""SimHash near-duplicates, linked with the help of BK-trees.

A fingerprint has a bit set where more than half of the hashes of the text's word shingles
have it set. Distinct fingerprints are linked if they differ in at most ``radius`` bits.

Shards: cut the bits into blocks; two linked fingerprints agree in all but ``radius`` blocks, so
each fingerprint goes to one shard for each choice of the other blocks, and every link is
found in some shard. More blocks make smaller shards: their number follows the number of
distinct fingerprints (``blocks_for``), while the links found are the same.

Each task builds the BK-trees of its shards: a child hangs on its parent by the integer Hamming
distance between them, and a search with distance d to a node follows only edges from
d - radius to d + radius. A node's subtree holds later fingerprints only, so a fingerprint
searches what came before it. All trees of a task grow and are searched level by level as
arrays. Trees stay in the task that holds their shard: sending all of them to all tasks would
broadcast data that grows with the corpus. A shard reports each member's link to the least
member that it is connected with, never all pairs; components join the shards' reports.

``one_of_each`` links texts whose sets of shingles have a Jaccard similarity of ``SIMILARITY``.
Its fingerprints are of the sets, and its shards are the keys of ``BANDS`` bands of ``BAND_ROWS`` least
hashes (MinHash): a pair of similarity s shares one with 1 - (1 - s^4)^20, whatever the size of the
corpus; at 0.8 that fails once in 38,000. A shard's BK-tree links what is within ``radius_of``, which few pairs
of 0.8 exceed; components of these loose links are families, and in them texts are compared shingle by
shingle (``similarity``). No pair that is rejected is ever a row.

Hot shards: one that holds more than SPLIT_MEMBERS fingerprints is cut into blocks, and each pair of blocks is a
tree of its own in a task of its own.

Null and empty texts have no words: their fingerprint is zero and links like any other. Texts
with fewer words than a shingle have their whole sequence as one. Null ids are never the
name of a component, unless all its ids are null. Repeated rows come out repeated.
"""

from __future__ import annotations

import itertools
import math
from array import array

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from callweave.llm.common import batch_of, chosen_rows, clear_worker_cache, drop, mixed, one_array, ranges, slices, stages, text_column
from callweave.llm.components import components
from callweave.llm.similarity import family_links

WORDS, RADIUS, SEED = 4, 4, 42
_ODD = 0x9E3779B97F4A7C15
#: Of similar texts: words of a shingle, least similarity, 64-bit words of a fingerprint.
SIMILAR_WORDS, SIMILARITY, WIDE = 5, 0.8, 4
#: Shards of similar texts: bands, and least hashes of each.
BANDS, BAND_ROWS = 20, 4
#: Members of a shard that the number of blocks aims at, at most.
SHARD_MEMBERS = 256
#: Pairs of a fingerprint and a node that a task looks at in one step.
FRONT = 1 << 18
#: A shard of more members is compared in pairs of blocks of so many.
SPLIT_MEMBERS, SPLIT_BLOCK = 4096, 2048


def _hashes(text: bytes, words: int, seed: int) -> list[int]:
    split = text.lower().split()  # bytes: A-Z only, and the six blanks of ASCII
    if len(split) <= words:
        return [xxhash.xxh64_intdigest(b" ".join(split), seed)] if split else []
    joined = b" ".join(split)
    starts = list(itertools.accumulate((len(w) + 1 for w in split), initial=0))
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a : b - 1], seed) for a, b in zip(starts, starts[words:])]


def fingerprints_of(texts: list[bytes], words: int = WORDS, seed: int = SEED, wide: int = 1) -> np.ndarray:
    """Fingerprints of texts as rows of ``wide`` numbers, the first from the shingles' hashes, the
    others from these mixed."""
    return _fingerprints([_hashes(t, words, seed) for t in texts], wide)


def _fingerprints(lists: list[list[int]], wide: int) -> np.ndarray:
    """Bits are counted in byte lanes, over at most 255 hashes at a time."""
    counts = np.array([len(x) for x in lists], dtype=np.int64)
    h = np.fromiter(itertools.chain.from_iterable(lists), dtype=np.uint64, count=int(counts.sum()))
    out = np.zeros((len(lists), wide), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    parts = -(-counts[full] // 255)
    begins = np.repeat(np.cumsum(counts)[full] - counts[full], parts) + 255 * ranges(np.zeros(len(full)), parts)
    first = np.cumsum(parts) - parts
    lanes = np.uint64(0x0101010101010101)
    for w in range(wide):
        if w:
            h = mixed(h + np.uint64(_ODD))
        for bit in range(8):
            sums = np.add.reduceat((h >> np.uint64(bit)) & lanes, begins)
            by_byte = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
            over = 2 * by_byte > counts[full][:, None]
            for byte in range(8):
                out[full, w] |= over[:, byte].astype(np.uint64) << np.uint64(8 * byte + bit)
    return out


def band_keys(lists: list[list[int]]) -> np.ndarray:
    """For each list of hashes a row of BANDS keys, each of the least of BAND_ROWS hashes of its own;
    lists that are not empty."""
    counts = np.array([len(x) for x in lists], dtype=np.int64)
    h = np.fromiter(itertools.chain.from_iterable(lists), dtype=np.uint64, count=int(counts.sum()))
    begins = np.cumsum(counts) - counts
    drawn = np.random.default_rng(SEED).integers(0, 1 << 64, (2, BANDS, BAND_ROWS), dtype=np.uint64)
    keys = np.zeros((len(lists), BANDS), np.uint64)
    for band in range(BANDS):
        keys[:, band] = band
        for row in range(BAND_ROWS):
            own = (h ^ drawn[0, band, row]) * (drawn[1, band, row] | np.uint64(1))
            own ^= own >> np.uint64(32)
            own *= np.uint64(_ODD)
            keys[:, band] = mixed(keys[:, band] + np.minimum.reduceat(own, begins))
    return keys


def set_fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """``row`` and ``text`` in; ``row``, the wide fingerprint of the set of shingles and its ``keys``
    out. A text without words has no keys."""
    row, names = docs.schema["row"], _names(WIDE)

    def mark(batches):
        clear_worker_cache()
        for part in slices(batches):
            lists = [array("Q", set(_hashes((t or "").encode(), words, SEED))) for t in one_array(part.column("text")).to_pylist()]
            fp = _fingerprints(lists, WIDE).view(np.int64)
            full = [x for x in lists if x]
            keys = band_keys(full).view(np.int64) if full else np.zeros((0, BANDS), np.int64)
            at = np.r_[0, np.cumsum([BANDS if x else 0 for x in lists])]
            keys = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), *(pa.array(fp[:, w].copy()) for w in range(WIDE)), keys], names=["row", *names, "keys"]
            )

    types = f"row {row.dataType.simpleString()}, " + ", ".join(f"{n} long" for n in names) + ", keys array<bigint>"
    return docs.select("row", "text").mapInArrow(mark, types)


def fingerprints(docs: DataFrame, words: int = WORDS, wide: int = 1) -> DataFrame:
    """``row`` and ``text`` in; ``row`` and the fingerprint out, as longs ``fp``, ``fp1``, ..."""
    row, names = docs.schema["row"], _names(wide)

    def mark(batches):
        for part in slices(batches):
            texts = [(t or "").encode() for t in one_array(part.column("text")).to_pylist()]
            fp = fingerprints_of(texts, words, SEED, wide).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("row"), *(pa.array(fp[:, w].copy()) for w in range(wide))], names=["row", *names])

    return docs.select("row", "text").mapInArrow(mark, f"row {row.dataType.simpleString()}, " + ", ".join(f"{n} long" for n in names))


def _names(wide: int) -> list[str]:
    return ["fp", *(f"fp{w}" for w in range(1, wide))]


def radius_of(similarity: float, wide: int) -> int:
    """Bits that fingerprints of sets with this Jaccard similarity differ in at most: four standard
    deviations above the mean, which for small sets is up to a quarter larger than for large ones."""
    share = 1.25 * math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.ceil(64 * wide * share + 4 * math.sqrt(64 * wide * share * (1 - share)))


def blocks_for(n: int, radius: int) -> int:
    """Least number of blocks for which n evenly spread fingerprints fill shards of at most
    SHARD_MEMBERS; at least one block more than the radius."""
    blocks = radius + 1
    while blocks < 2 * radius + 4 and n / 2 ** (64 * (blocks - radius) / blocks) > SHARD_MEMBERS:
        blocks += 1
    return blocks


def shard_masks(blocks: int, radius: int) -> list[int]:
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    bits = [(1 << b) - (1 << a) for a, b in itertools.pairwise(cuts)]
    return [sum(bits[i] for i in chosen) for chosen in itertools.combinations(range(blocks), blocks - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _distance(fp: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fp[a] ^ fp[b]).sum(axis=1, dtype=np.int64)


def bk_trees(shard: np.ndarray, fp: np.ndarray):
    """BK-trees of all shards; rows of a shard stand together and differ in ``fp``.

    Gives the root of each row's tree, and children sorted by parent and edge: the code
    parent * (bits + 1) + edge, and the child itself.
    """
    n, base = len(fp), 64 * fp.shape[1] + 1
    new = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if n else np.zeros(0, np.int64)
    root = np.repeat(new, np.diff(np.r_[new, n]))
    codes, children = [], []
    active = np.flatnonzero(root != np.arange(n))
    at = root[active]
    while len(active):
        code = at * base + _distance(fp, active, at)
        order = np.argsort(code, kind="stable")  # rows stay in order, so the first is the least
        code, active = code[order], active[order]
        head = np.r_[True, code[1:] != code[:-1]]
        child = active[head]
        codes.append(code[head])
        children.append(child)
        at = np.repeat(child, np.diff(np.r_[np.flatnonzero(head), len(code)]))[~head]
        active = active[~head]
    if not codes:
        return root, np.zeros(0, np.int64), np.zeros(0, np.int64)
    code, child = np.concatenate(codes), np.concatenate(children)
    order = np.argsort(code)
    return root, code[order], child[order]


def near_pairs(root: np.ndarray, code: np.ndarray, child: np.ndarray, fp: np.ndarray, radius: int, rows: np.ndarray):
    """Of the given rows, row, earlier row of the same tree and distance of all pairs within the radius."""
    bits = 64 * fp.shape[1]
    rows = rows[root[rows] != rows]
    todo = [(rows[i : i + FRONT], root[rows[i : i + FRONT]]) for i in range(0, len(rows), FRONT)]
    while todo:
        query, node = todo.pop()
        d = _distance(fp, query, node)
        near = d <= radius
        yield query[near], node[near], d[near]
        low = np.searchsorted(code, node * (bits + 1) + np.maximum(d - radius, 0))
        high = np.searchsorted(code, node * (bits + 1) + np.minimum(d + radius, bits), side="right")
        query = np.repeat(query, high - low)
        node = child[ranges(low, high - low)]
        earlier = node < query
        query, node = query[earlier], node[earlier]
        todo += [(query[i : i + FRONT], node[i : i + FRONT]) for i in range(0, len(query), FRONT)]


def linked(shard: np.ndarray, fp: np.ndarray, radius: int) -> np.ndarray:
    """For each row the least row of its shard that it is connected with by links."""
    trees, label = bk_trees(shard, fp), np.arange(len(fp))
    for query, node, _ in near_pairs(*trees, fp, radius, label.copy()):
        _join(label, query, node)
    return label


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked rows the least label of both; every label ends at its own root."""
    while len(a):
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def block_keys(n: int, radius: int) -> list[Column]:
    """Shards for a radius of few bits of ``fp``: every link is in one of them."""
    masks = shard_masks(blocks_for(n, radius), radius)
    return [F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(mask)))) for i, mask in enumerate(masks)]


def split_shards(members: DataFrame, counts: DataFrame) -> DataFrame:
    """Members of shards with their ``task``: a shard of up to SPLIT_MEMBERS is one; a larger one is cut into blocks by
    hash, and each pair of blocks is a task. ``counts``: ``shard`` and its ``n`` members, 2 or more; other shards go."""
    blocks = F.ceil(F.col("n") / SPLIT_BLOCK).cast("long")
    own = F.pmod(F.xxhash64("node"), blocks)
    pairs = F.transform(
        F.sequence(F.lit(0), blocks - 1), lambda other: F.xxhash64(F.col("shard"), F.least(own, other), F.greatest(own, other))
    )
    tasks = F.when(F.col("n") > SPLIT_MEMBERS, pairs).otherwise(F.array("shard"))
    return members.join(counts, "shard").withColumn("task", F.explode(tasks))


def links(kept, members: DataFrame, prints: DataFrame, n: int, radius: int) -> DataFrame:
    """Links that connect what is within the radius in some shard: ``a`` and ``b`` of the column
    ``node``, at most one for each node and task. ``members`` are the ``shard`` and ``node`` of ``n`` rows, ``prints``
    the fingerprints of nodes."""
    spark, wide = prints.sparkSession, [c for c in prints.columns if c != "node"]
    counts = kept.keep(members.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1"), "shards")
    rows = split_shards(members, counts).select("task", "node").join(prints, "node")
    names = ["task", "node", *wide]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / 500_000))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def search(batches):
        columns = [[b.column(name).to_numpy() for name in names] for b in batches]
        if not columns:
            return
        task, node, *fp = (np.concatenate(c) for c in zip(*columns))
        fp = np.stack(fp, axis=1).view(np.uint64)
        order = np.lexsort((mixed(node.view(np.uint64)), task))  # not by bits, so that trees stay shallow
        task, node, fp = task[order], node[order], fp[order]
        label = linked(task, fp, radius)
        other = np.flatnonzero(label != np.arange(len(label)))
        yield batch_of(schema, node[other], node[label[other]])

    return rows.select(*names).repartition(parts, "task").mapInArrow(search, "a long, b long").distinct()


def shingle_sets(rows: DataFrame, words: int) -> DataFrame:
    """``number`` and ``text`` of the struct ``row`` in; ``node`` and the set of shingle ``hashes`` out."""

    def split(batches):
        for batch in batches:
            row = one_array(batch.column("row"))
            flat = pa.RecordBatch.from_arrays([row.field("number"), row.field("text")], names=["number", "text"])
            for part in slices([flat]):
                lists = [np.array(list(set(_hashes((t or "").encode(), words, SEED))), np.uint64).view(np.int64) for t in part.column("text").to_pylist()]
                at = np.r_[0, np.cumsum([len(x) for x in lists])].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("number"), pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([np.zeros(0, np.int64), *lists])))],
                    names=["node", "hashes"],
                )

    return rows.mapInArrow(split, "node long, hashes array<bigint>")


def similar_links(kept, marked: DataFrame, distinct: DataFrame, text: str, words: int, similarity: float) -> DataFrame:
    """Links ``a``, ``b`` of nodes, each between similar texts, that connect all candidates that are similar."""
    radius, names = radius_of(similarity, WIDE), _names(WIDE)
    prints = distinct.select("node", *names)
    loose = links(kept, distinct.select(F.explode("keys").alias("shard"), "node"), prints, distinct.count() * BANDS, radius)
    families = components(kept.keep(loose, "loose")).withColumnRenamed("root", "family")
    families = kept.keep(families.unionByName(families.select(F.col("family").alias("node"), "family").distinct()), "families")
    texts = marked.select(F.struct("number", text_column(f"row.`{text}`").alias("text")).alias("row"), "number")
    # Written in between, since a task that chooses and splits holds two Python workers.
    texts = kept.keep(chosen_rows(stages(marked.sparkSession), texts, families.select(F.col("node").alias("number")), True), "texts")
    members = kept.keep(shingle_sets(texts, words).join(families, "node").join(prints, "node"), "members")
    drop(kept, "texts")
    return kept.keep(family_links(kept, members, names, radius, similarity), "links")


def _marked(docs: DataFrame, text: str, doc_id: str, carry: list[str] | None, words: int, wide: int):
    """Stage tables: rows with id, number and fingerprint; distinct fingerprints with their least id
    and, as ``node``, a number of their own; those of sets with keys."""
    kept, names = stages(docs.sparkSession), _names(wide)
    rows = docs.select(F.struct(*(carry or ["*"])).alias("row"), F.col(doc_id).alias("id"), text_column(text).alias("text"))
    rows = rows.select(F.struct("row", "id").alias("row"), "text")
    made = fingerprints(rows, words) if wide == 1 else set_fingerprints(rows, words)
    keys = [c for c in made.columns if c == "keys"]
    marked = kept.keep(made.select("row.row", "row.id", *names, *keys, F.monotonically_increasing_id().alias("number")), "fingerprints")
    distinct = kept.keep(
        marked.groupBy(*names).agg(F.min("id").alias("id"), F.min("number").alias("node"), *[F.first(c).alias(c) for c in keys]), "distinct"
    )
    return kept, marked, distinct


def _named(kept, distinct: DataFrame, edges: DataFrame) -> DataFrame:
    roots = components(edges)
    return kept.keep(
        distinct.join(roots, "node", "left").select(*[c for c in distinct.columns if c not in ("node", "keys")], F.coalesce("root", "node").alias("root")),
        "named",
    )


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", carry: list[str] | None = None,
                    words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """Every row as column ``row`` (or the columns ``carry`` of it), its ``fp`` and the
    ``component_id``: the least id that is reachable by links of at most ``radius`` bits."""
    kept, marked, distinct = _marked(docs, text, doc_id, carry, words, 1)
    n = distinct.count()
    keys = block_keys(n, radius)
    members = distinct.select(F.explode(F.array(*keys)).alias("shard"), "node")
    named = _named(kept, distinct, links(kept, members, distinct.select("node", "fp"), n * len(keys), radius))
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    return marked.drop("id", "number").join(named.join(least, "root").select("fp", "component_id"), "fp")


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = SIMILAR_WORDS,
                similarity: float = SIMILARITY) -> DataFrame:
    """The given columns of one row of each group of similar texts: that with the least id, null ids
    last, and the first of rows with the same id."""
    names = _names(WIDE)
    kept, marked, distinct = _marked(docs, text, doc_id, None, words, WIDE)
    named = _named(kept, distinct, similar_links(kept, marked, distinct, text, words, similarity))
    narrow = marked.select(*names, F.struct(F.col("id").isNull().alias("no_id"), "id", "number").alias("first"))
    first = narrow.join(named.select(*names, "root"), names).groupBy("root").agg(F.min("first").alias("first"))
    return chosen_rows(kept, marked, first.select("first.number"), True).select("row.*")
