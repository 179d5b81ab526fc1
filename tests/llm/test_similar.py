"""Near-duplicates by exact similarity: pairs at the threshold are found, pairs below it are not."""

import random

import numpy as np

from callweave.llm import simhash


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def pair(rng, shared, first, second):
    """Two texts with so many shingles in common and of their own: a common beginning and other ends."""
    word = lambda: f"w{rng.randrange(10**9)}"
    head = [word() for _ in range(shared + 4)]
    return tuple(" ".join(head + [word() for _ in range(n)]) for n in (first, second))


def brute_kept(docs):
    sets, label = [shingles(t) for _, t in docs], list(range(len(docs)))
    at = {}
    for i, s in enumerate(sets):
        for x in s:
            at.setdefault(x, []).append(i)
    for a, b in {(a, b) for group in at.values() for a in group for b in group if a < b}:
        if label[a] != label[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
            old, new = max(label[a], label[b]), min(label[a], label[b])
            label = [new if x == old else x for x in label]
    least = {}
    for (i, _), group in zip(docs, label):
        least[group] = min(least.get(group, i), i)
    return sorted(least.values())


def test_threshold_against_brute_force(spark):
    rng, docs = random.Random(5), []
    for shared, first, second in ([(80, 10, 10), (8, 1, 1), (4, 1, 0), (160, 40, 0), (79, 10, 11), (75, 13, 12), (70, 15, 15)] * 40):
        docs += [(len(docs) + i, t) for i, t in enumerate(pair(rng, shared, first, second))]
    docs.append((len(docs), docs[0][1] + (" a line that is repeated many times" * 200)))
    chain = pair(rng, 300, 0, 0)[0].split()  # each is similar to its neighbours alone
    docs += [(len(docs) + i, " ".join(chain[20 * i : 20 * i + 204])) for i in range(6)]
    got = sorted(r.doc_id for r in simhash.one_of_each(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert got == brute_kept(docs)


def test_similar_groups_with_near_misses(spark):
    """A template whose copies are mostly below the threshold, so that most candidates are rejected."""
    rng = random.Random(6)
    head, docs = [f"h{i}" for i in range(84)], []
    for i in range(60):
        own = [f"o{rng.randrange(10**9)}" for _ in range(rng.choice([9, 10, 11, 14]))]
        docs.append((i, " ".join(head + own)))
    got = sorted(r.doc_id for r in simhash.one_of_each(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert got == brute_kept(docs) and 1 < len(got) < 60


def test_keys_meet_at_the_threshold_whatever_the_corpus():
    """Shards depend on a text alone, and 0.8 meets in one of them."""
    rng = np.random.default_rng(3)
    missed = unlike = 0
    for _ in range(1000):
        h = rng.integers(0, 1 << 63, 220).astype(np.uint64).tolist()
        keys = simhash.band_keys([h[:90], h[10:100], h[110:210]])
        missed += not (keys[0] == keys[1]).any()
        unlike += (keys[0] == keys[2]).any()
    assert missed <= 1 and not unlike


def template_rows(rng, n, sizes):
    head = [f"h{i}" for i in range(84)]
    return [(i, " ".join(head + [f"o{rng.randrange(10**9)}" for _ in range(rng.choice(sizes))])) for i in range(n)]


def test_families_of_many_blocks(spark, monkeypatch):
    """A family that is cut into blocks: a component of several blocks, and near misses in others."""
    from callweave.llm import similarity

    monkeypatch.setattr(similarity, "BLOCK", 16)
    monkeypatch.setattr(similarity, "BLOCK_HASHES", 2000)
    rng = random.Random(8)
    docs = template_rows(rng, 150, [10, 10, 11, 14])  # two with 10 words of their own are similar, others are not
    got = sorted(r.doc_id for r in simhash.one_of_each(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert got == brute_kept(docs) and 1 < len(got) < len(docs)


def test_no_rejected_pair_becomes_a_row(spark):
    """Copies of a template just below the threshold: links stay fewer than members, whatever the number of pairs."""
    rng, n = random.Random(9), 500
    docs = spark.createDataFrame(template_rows(rng, n, [14]), "doc_id long, text string")
    kept, marked, distinct = simhash._marked(docs, "text", "doc_id", None, 5, simhash.WIDE)
    edges = simhash.similar_links(kept, marked, distinct, "text", 5, 0.8)
    loose = spark.read.parquet(kept.path("loose"))
    assert edges.count() == 0 and 0 < loose.count() <= simhash.BANDS * n
    assert spark.read.parquet(kept.path("members")).groupBy("node").count().where("count > 1").count() == 0


def test_hot_shards_are_cut_into_blocks(spark, monkeypatch):
    """All fingerprints in one shard: tasks hold two blocks at most, and no link is lost."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(simhash, "SPLIT_MEMBERS", 100)
    monkeypatch.setattr(simhash, "SPLIT_BLOCK", 50)
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 150).astype(np.uint64)
    fp = np.concatenate([base, base ^ (np.uint64(1) << rng.integers(0, 63, 150).astype(np.uint64))])
    prints = spark.createDataFrame([(i, int(x)) for i, x in enumerate(fp.astype(np.int64))], "node long, fp long")
    members = prints.select(F.lit(7).cast("long").alias("shard"), "node")
    counts = members.groupBy("shard").agg(F.count("*").alias("n"))
    tasks = simhash.split_shards(members, counts).groupBy("task").count().collect()
    assert len(tasks) == 21 and max(r["count"] for r in tasks) < 150
    found = {tuple(sorted((r.a, r.b))) for r in simhash.links(simhash.stages(spark), members, prints, 300, 4).collect()}
    label = list(range(300))
    for a, b in found:
        old, new = max(label[a], label[b]), min(label[a], label[b])
        label = [new if x == old else x for x in label]
    assert all(label[i] == label[i + 150] for i in range(150)) and len(set(label)) == 150
