"""Ranked lexical search with per-term geometric blocking; the result is exact.

The documents are read once: each keeps its number of terms and, for the terms of the query
set, how often it has them (``forward``). The rows that Spark hands to a task are cut into shards of
a bounded number of cells (documents x terms). In a shard every document is a vector of the scores
its terms add to a query. The posting list of each term is clustered by similarity: some of
its documents are representatives, every document goes to the one whose vector (a random
projection of it) is nearest, and a cluster is cut into blocks of at most ``BLOCK`` documents. A block stores the
coordinatewise maximum of its vectors.

A query visits the lists of its terms. The inner product of query and summary bounds the
score of every document in the block that no list before it had, so the block is skipped if that is below the
query's threshold: the least of the ``limit`` best scores seen so far. That starts from a lower bound over all
documents (``thresholds``), which each shard raises. All other blocks are scored in full. A document
with a score has a term of the query that weighs more than nothing, so it stands in a visited list.

Scores are integers: sums that might exceed 2^53 are added as 64-bit integers, all others as
doubles, which are exact there. Each task reports at most ``limit`` documents for each query and shard;
Spark ranks them with a limit before the shuffle, so no query's candidates meet in one task.

Queries are read in blocks of bounded size (``BLOCK_QUERIES``, ``BLOCK_BYTES``), so what goes to the tasks is bounded
whatever their number; each block is a search over the same documents.

Null or empty texts have no terms: such documents are in no result and not in N, such queries
have no rows. Equal scores are ranked by id, null ids last, then by the place of the row. Repeated
documents are ranked each; repeated queries are answered each, numbered by ``query``. Empty tables
give an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from callweave.llm.common import batch_of, drop, one_array, slices, stages, text_column

LIMIT = 20
#: Documents of a block, at most; dimensions of the projection; cells of a shard.
BLOCK, SKETCH, CELLS = 32, 24, 8 << 20
#: Queries that are searched at a time, and their text, at most (one longer query is alone).
BLOCK_QUERIES, BLOCK_BYTES = 512, 128 << 10
#: Documents of a shard, at most.
SHARD = 4096
SCALE = 1_000_000_000
EXACT = 1 << 53

#: ASCII characters that are no part of a term become blanks; A-Z become a-z.
_TABLE = bytes(
    b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)


def _terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


def forward_index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``row``, ``id`` and ``text`` in. Out: row, id, number ``n`` of terms, and the ``terms`` of the
    vocabulary that the text has, with the ``times`` it has them. Rows without terms are left out."""
    row, id_type = docs.schema["row"].dataType.simpleString(), docs.schema["id"].dataType.simpleString()
    size = max(len(vocabulary), 1)

    def index(batches):
        get = vocabulary.get
        for part in slices(batches):
            lists = [_terms(t) for t in one_array(part.column("text")).to_pylist()]
            n = np.fromiter(map(len, lists), np.int64, len(lists))
            known = np.fromiter((get(t, -1) for x in lists for t in x), np.int64, int(n.sum()))
            key = np.repeat(np.arange(len(lists)), n)[known >= 0] * size + known[known >= 0]
            key, times = np.unique(key, return_counts=True)
            at = np.r_[0, np.cumsum(np.bincount(key // size, minlength=len(lists)))].astype(np.int32)
            made = pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("id"), pa.array(n), pa.ListArray.from_arrays(pa.array(at), pa.array((key % size).astype(np.int32))),
                 pa.ListArray.from_arrays(pa.array(at), pa.array(times.astype(np.int64)))],
                names=["row", "id", "n", "terms", "times"],
            )
            yield made.filter(pa.array(n > 0))

    return docs.select("row", "id", "text").mapInArrow(
        index, f"row {row}, id {id_type}, n bigint, terms array<int>, times array<bigint>"
    )


def document_counts(forward: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term is. Each task adds up its own; the sums have a row for each term."""
    schema = pa.schema([("term", pa.int32()), ("df", pa.int64())])

    def count(batches):
        sums = np.zeros(size, np.int64)
        for batch in batches:
            sums += np.bincount(one_array(batch.column("terms")).flatten().to_numpy(), minlength=size)
        has = np.flatnonzero(sums)
        yield batch_of(schema, has.astype(np.int32), sums[has])

    df = np.zeros(size, np.int64)
    found = forward.select("terms").mapInArrow(count, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    for r in found.collect():  # as many rows as the queries of one block have terms
        df[r.term] = r.df
    return df


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def _vectors(batch: pa.RecordBatch, weight: np.ndarray, documents: int, total: int, dtype) -> np.ndarray:
    """A row for each document: what each of its terms adds to a query that has it once."""
    terms, times = one_array(batch.column("terms")), one_array(batch.column("times"))
    counts = np.diff(terms.offsets.to_numpy())
    term, tf = terms.flatten().to_numpy(), times.flatten().to_numpy()
    place = np.repeat(np.arange(batch.num_rows), counts)
    # 25 * n * documents may exceed 64 bits in very large tables: by Python's integers there.
    n = batch.column("n").to_numpy()
    if int(n.max(initial=0)) * 25 * documents < 1 << 62:
        m = 75 + 25 * n * documents // total
    else:
        m = np.array([75 + 25 * x * documents // total for x in n.tolist()], np.int64)
    out = np.zeros((batch.num_rows, len(weight)), dtype)
    out[place, term] = weight[term] * (SCALE * tf // (1000 * tf + 12 * m[place]))
    return out


class Shard:
    """Vectors of some documents, and the blocks of every term's posting list.

    Columns are in the order of the lists: rare terms first, since they weigh most. A document that
    stands in no earlier list has none of the earlier terms, and one that does has been scored or
    its bound has failed; so a list's summaries hold the terms from its own on.
    """

    def __init__(self, vectors: np.ndarray, rank: np.ndarray):
        self.order = np.argsort(np.count_nonzero(vectors, axis=0), kind="stable")
        self.vectors, self.rank = np.ascontiguousarray(vectors[:, self.order]), rank  # rank: place among equal scores
        size = vectors.shape[1]
        random = np.random.default_rng(size)
        self.sketch = (self.vectors @ random.choice(np.array([-1, 1], vectors.dtype), (size, SKETCH))).astype(np.float32)
        self.sketch /= np.maximum(np.linalg.norm(self.sketch, axis=1, keepdims=True), 1e-30)

    def blocks(self, place: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The posting list of a column in the order of its blocks, where they begin, and their summaries."""
        docs = np.flatnonzero(self.vectors[:, place])
        picked = docs[:: max(BLOCK, len(docs) // 64)]  # representatives, spread over the list
        nearest = (self.sketch[docs] @ self.sketch[picked].T).argmax(axis=1)
        order = np.argsort(nearest, kind="stable")
        docs, nearest = docs[order], nearest[order]
        begin = np.searchsorted(nearest, nearest)  # of the own cluster
        starts = np.flatnonzero((np.arange(len(docs)) - begin) % BLOCK == 0)
        return docs, starts, np.maximum.reduceat(self.vectors[docs, place:], starts, axis=0)

    def search(self, queries: np.ndarray, floor: np.ndarray, limit: int):
        """For each query (a column of ``queries``: how often it has each term) its best documents with at
        least the score ``floor``: query, document and score; also how many blocks were seen and skipped."""
        queries = queries[self.order]
        found = [(np.zeros(0, np.int64), np.zeros(0, self.vectors.dtype)) for _ in floor]
        least, scored = floor.astype(self.vectors.dtype), np.zeros((len(floor), len(self.vectors)), bool)
        terms = [np.flatnonzero(queries[:, q]) for q in range(len(floor))]
        # The bound of all lists from a place on: the summary of all documents as one block.
        highest = self.vectors.max(axis=0, initial=0)
        rest = np.cumsum((queries * highest[:, None])[::-1], axis=0)[::-1]
        seen = skipped = 0
        for place in range(len(queries)):
            asks = np.flatnonzero((queries[place] > 0) & (rest[place] >= least))
            if not len(asks) or not highest[place]:
                continue
            docs, starts, summary = self.blocks(place)
            ends = np.r_[starts[1:], len(docs)]
            bound = summary @ queries[place:, asks]
            seen += bound.size
            for i, q in enumerate(asks.tolist()):
                open_blocks = bound[:, i] >= least[q]
                skipped += len(starts) - int(open_blocks.sum())
                new = docs[np.repeat(open_blocks, ends - starts)]
                new = new[~scored[q, new]]
                if not len(new):
                    continue
                scored[q, new] = True
                score = self.vectors[new[:, None], terms[q]] @ queries[terms[q], q]
                keep = score >= least[q]
                if not keep.any():
                    continue
                old_docs, old_scores = found[q]
                docs_now, scores_now = np.r_[old_docs, new[keep]], np.r_[old_scores, score[keep]]
                best = np.lexsort((self.rank[docs_now], -scores_now))[:limit]
                found[q] = docs_now[best], scores_now[best]
                if len(best) == limit:
                    least[q] = max(least[q], scores_now[best[-1]])
        query = np.repeat(np.arange(len(floor)), [len(d) for d, _ in found])
        return query, np.concatenate([d for d, _ in found]), np.concatenate([s for _, s in found]).astype(np.int64), seen, skipped


def _query_matrix(queries: list[list[int]], size: int, dtype) -> np.ndarray:
    out = np.zeros((size, len(queries)), dtype)
    for i, terms in enumerate(queries):
        np.add.at(out[:, i], np.array(terms, np.int64), 1)
    return out


def _shards(batches, size: int):
    """Runs of rows with a bounded number of cells, whatever batches they come in."""
    most, parts, rows = max(1, min(SHARD, CELLS // max(size, 1))), [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, most - rows)
            batch = batch.slice(part.num_rows)
            parts.append(part)
            rows += part.num_rows
            if rows == most:
                yield pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
                parts, rows = [], 0
    if rows:
        yield pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _ranks(ids: pa.Array) -> np.ndarray:
    """Places of the ids in ascending order, nulls last, ties by row."""
    order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank


def thresholds(forward: DataFrame, weight: np.ndarray, queries: list[list[int]], documents: int, total: int, dtype, limit: int) -> np.ndarray:
    """A score that the ``limit`` best documents of each query reach: for each query and its heaviest
    term, the limit-th best of what that term alone adds, over all documents. A term's additions
    are added up by value in each task, at most ``limit`` of each term."""
    size = len(weight)
    heaviest = np.array([max(q, key=lambda t: weight[t]) if q else -1 for q in queries], np.int64)
    wanted = np.unique(heaviest[heaviest >= 0])
    schema = pa.schema([("term", pa.int32()), ("value", pa.int64())])

    def best(batches):
        top: dict[int, np.ndarray] = {}
        for part in _shards(batches, size):
            vectors = _vectors(part, weight, documents, total, dtype)[:, wanted]
            for i, term in enumerate(wanted.tolist()):
                values = vectors[:, i][vectors[:, i] > 0].astype(np.int64)
                if len(values):
                    top[term] = -np.sort(-np.r_[top.get(term, np.zeros(0, np.int64)), values])[:limit]
        for term, values in top.items():
            yield batch_of(schema, np.full(len(values), term, np.int32), values)

    place = F.row_number().over(Window.partitionBy("term").orderBy(F.desc("value")))
    found = forward.select("n", "terms", "times").mapInArrow(best, "term int, value bigint").withColumn("place", place)
    floor = {r.term: r.value for r in found.where(F.col("place") == limit).collect()}  # at most a row for each query
    return np.array([max(1, floor.get(int(t), 1)) for t in heaviest], np.int64)


def _search_block(forward: DataFrame, queries: list[list[int]], weight: np.ndarray, documents: int, total: int, limit: int) -> DataFrame:
    size = len(weight)
    highest = int(weight.max(initial=0)) * (SCALE // 1000) * max([len(q) for q in queries], default=0)
    dtype = np.float64 if highest < EXACT else np.int64
    floor = thresholds(forward, weight, queries, documents, total, dtype, limit)

    def search(batches):
        matrix = _query_matrix(queries, size, dtype)
        for part in _shards(batches, size):
            shard = Shard(_vectors(part, weight, documents, total, dtype), _ranks(one_array(part.column("id"))))
            query, doc, score, _, _ = shard.search(matrix, floor, limit)
            rows = part.take(pa.array(doc))
            yield pa.RecordBatch.from_arrays(
                [pa.array(query.astype(np.int32)), rows.column("row"), rows.column("id"), pa.array(score)], names=["query", "row", "id", "score"]
            )

    row, id_type = forward.schema["row"].dataType.simpleString(), forward.schema["id"].dataType.simpleString()
    found = forward.mapInArrow(search, f"query int, row {row}, id {id_type}, score bigint")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def query_blocks(queries: DataFrame, text: str, item_id: str):
    """Lists of (number, id, text) of all queries in order of their id, each of bounded size. Rows come to the
    driver a partition at a time."""
    block, size = [], 0
    rows = queries.select(F.col(item_id).alias("id"), text_column(text).alias("text")).orderBy("id", "text")
    for number, r in enumerate(rows.toLocalIterator()):
        if block and (len(block) == BLOCK_QUERIES or size + len(r.text) > BLOCK_BYTES):
            yield block
            block, size = [], 0
        block.append((number, r.id, r.text))
        size += len(r.text)
    if block:
        yield block


def ranked(docs: DataFrame, queries: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id",
           carry: list[str] | None = None, limit: int = LIMIT) -> DataFrame:
    """``query`` (the query's number), ``item_id``, ``rank``, ``row`` (the document, or the columns ``carry`` of it) and
    ``score`` of each query's best documents."""
    spark = docs.sparkSession
    kept = stages(spark)
    given = docs.select(
        F.struct(*(carry or ["*"])).alias("row"), F.col(doc_id).alias("id"), text_column(text).alias("text")
    )
    id_type, results = queries.schema[item_id].dataType, []
    for i, block in enumerate(query_blocks(queries, text, item_id)):
        split = [_terms(t) for _, _, t in block]
        vocabulary = {t: k for k, t in enumerate(sorted({t for x in split for t in x}))}
        if not vocabulary:
            continue
        forward = kept.keep(forward_index(given, vocabulary), f"forward-{i}")
        n = forward.agg(F.count("*"), F.sum("n")).first()
        if not n[0]:
            continue
        weight = weights(document_counts(forward, len(vocabulary)), n[0])
        numbers = [[vocabulary[t] for t in x] for x in split]
        found = _search_block(forward, numbers, weight, n[0], n[1], limit)
        names = spark.createDataFrame([(k, number, item) for k, (number, item, _) in enumerate(block)], f"query int, number long, item_id {id_type.simpleString()}")
        found = found.join(F.broadcast(names), "query").select(F.col("number").alias("query"), "item_id", "rank", "row", "score")
        results.append(kept.keep(found, f"found-{i}"))
        drop(kept, f"forward-{i}")
    if results:
        return reduce(DataFrame.unionByName, results)
    empty = given.select(F.lit(0).cast("long").alias("query"), F.lit(None).cast(id_type).alias("item_id"), F.lit(0).alias("rank"), "row", F.lit(0).cast("long").alias("score"))
    return empty.limit(0)
