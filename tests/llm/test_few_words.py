"""Decontamination of tables with fewer words than a gram or an item."""

import brute
import numpy as np
import pytest

from callweave.llm import decontamination


def found(spark, docs, items):
    docs = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    got = decontamination.contamination(docs, spark.createDataFrame(items, "item_id long, text string"), carry=["doc_id"])
    return sorted((r.row.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in got.collect())


def test_grams_of_few_words():
    hashes = np.arange(1, 11).astype(np.uint64)
    for n in range(11):
        for k in range(1, 13):
            got = decontamination.grams(hashes[:n], k)
            assert len(got) == max(n - k + 1, 0) and np.array_equal(got, decontamination.grams(hashes, k)[: len(got)])


@pytest.mark.parametrize("n", range(1, 10))
def test_a_document_alone_of_few_words(spark, n):
    words = [f"w{i}" for i in range(10)]
    items = [(k, " ".join(words[:k])) for k in range(1, 11)]
    # Item k begins like the document, so the document holds those of at most n words.
    assert found(spark, [(1, " ".join(words[:n]))], items) == [(1, n, n, n, True)]
    assert found(spark, [(1, "x y z")], [(7, "a b c d e f g"), (3, "k l m")]) == [(1, 3, 0, 0, False)]


def test_three_words_before_a_very_long_text(spark):
    docs = [(1, "one two three"), (2, "pad " * (decontamination.slices.__defaults__[1] // 4 + 10) + "a b c d e f g")]
    items = [(7, "a b c d e f g"), (3, "one two three")]
    want = [(r[0], *r[1:4], r[-1]) for r in brute.benchmark_hits(docs, items)]
    assert found(spark, docs, items) == sorted(want) and all(w[-1] for w in want)
