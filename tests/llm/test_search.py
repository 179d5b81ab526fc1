"""Lexical search against brute force, its blocks, and hard rows."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from callweave.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SF = "/root/testdata/sf0.001"


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, limit=20):
    """(item, rank, doc, score) by the contract, from lists of (id, text)."""
    split = [(i, terms(t)) for i, t in docs]
    split = [(i, t) for i, t in split if t]
    total, n_docs = sum(len(t) for _, t in split), len(split)
    df = collections.Counter(x for _, t in split for x in set(t))
    out = []
    for item, text in items:
        scores = []
        for doc, t in split:
            tf, m, score = collections.Counter(t), 75 + 25 * len(t) * n_docs // total, 0
            for x in terms(text):
                if tf[x]:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10**9 * tf[x] // (1000 * tf[x] + 12 * m))
            if score:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:limit], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, **more):
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = ls.ranked(d, q, carry=["doc_id"], **more).select("item_id", "rank", "row.doc_id", "score")
    return sorted((tuple(r) for r in got.collect()), key=str)


def corpus(n, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    return [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 60)))) for i in range(n)]


@pytest.mark.parametrize("cells", [8 << 20, 20_000])
def test_against_brute_force(spark, monkeypatch, cells):
    monkeypatch.setattr(ls, "CELLS", cells)
    docs = corpus(900)
    docs += [(1000 + i, docs[5][1]) for i in range(300)]  # a third are copies: equal scores
    items = [(i, " ".join(docs[7 * i][1].split()[:12]) + " w0 w0 W1") for i in range(15)]
    assert found(spark, docs, items) == brute(docs, items)


def test_queries_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ls, "BLOCK_QUERIES", 4)
    docs, items = corpus(200), [(i, f"w{i} w{i + 50} w3") for i in range(10)]
    assert found(spark, docs, items) == brute(docs, items)


def test_hard_rows(spark):
    docs = [(1, None), (2, ""), (3, "..."), (4, "Ünïcode über 123 a_b"), (5, "über ÜBER"), (5, "über ÜBER"), (None, "über"), (6, "common " * 20_000), (7, "common x")]
    items = [(1, "Über über"), (2, None), (3, "?!"), (4, "common common x"), (4, "b"), (None, "123"), (5, "absent")]
    got = found(spark, docs, items)
    assert got == brute(docs, items)
    assert found(spark, [], items) == [] and found(spark, docs, []) == [] and found(spark, [(1, None)], items) == []
    clash = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("id", "n", "terms", "score", "rank", "row", "query")})
    whole = ls.ranked(clash, spark.createDataFrame(items, "item_id long, text string"))
    assert whole.count() == len(got) and whole.select("row.*").columns == clash.columns


def test_large_sums_are_integers(spark):
    docs = [(i, f"t{i} " * (i + 1)) for i in range(40)]
    items = [(1, "t3 t4 t5 " * 60_000)]
    assert found(spark, docs, items) == brute(docs, items)


def test_a_block_is_skipped_only_if_its_bound_fails():
    rng = np.random.default_rng(5)
    vectors = np.zeros((2000, 61), np.float64)
    topics = rng.integers(0, 10, 2000)
    for i, t in enumerate(topics):
        own = np.r_[6 * t : 6 * t + 6][rng.random(6) < 0.8]
        vectors[i, own] = rng.integers(1, 1000, len(own))
    vectors[::14, 60] = 5  # a rarer term of documents of all topics; its list comes first
    shard = ls.Shard(vectors, np.arange(2000))
    for place, term in enumerate(shard.order):
        docs, starts, summary = shard.blocks(place)
        assert sorted(docs) == np.flatnonzero(vectors[:, term]).tolist()
        for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(docs)])):
            assert 0 < b - a <= ls.BLOCK and (summary[i] == vectors[docs[a:b]][:, shard.order[place:]].max(axis=0)).all()
    queries = np.zeros((61, 10))
    for t in range(10):
        queries[[*range(6 * t, 6 * t + 3), 60], t] = 1
    exact = vectors @ queries
    best = np.sort(exact, axis=0)[-5].astype(np.int64)  # what a better bound than 1 would be
    query, doc, score, seen, skipped = shard.search(queries, best, 5)
    assert 0 < skipped and len(query) >= 50
    for t in range(10):
        assert set(np.flatnonzero(exact[:, t] > best[t])) <= set(doc[query == t])
    query, doc, score, seen, skipped = shard.search(queries, np.ones(10, np.int64), 5)
    for t in range(10):
        assert doc[query == t].tolist() == np.lexsort((np.arange(2000), -exact[:, t]))[:5].tolist()


def test_queries_of_the_given_tables(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    got = ls.ranked(docs, items, carry=["doc_id"]).select("item_id", "rank", "row.doc_id", "score").collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert sorted(map(tuple, got), key=str) == want
