"""The ten operators against brute force, on hard cases and on the smallest tables."""

import hashlib
import random
import time
import zlib
from collections import Counter
from itertools import combinations

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from callweave.llm import (
    common, components, decontamination, kneser_ney, packing, pii, quality_rules, queries, simhash, suffix_dedup, token_files, url_rules, warc,
)
from callweave.llm.common import stages
from callweave.llm.tokens import Encoder

SF = "/root/testdata/sf0.001"
FILE = public_tokenizers.path("byte_bpe_50k.json")
PASSAGE = "This is a passage of more than fifty bytes that many documents share, é and ü too."
DOCS = "doc_id long, text string"


def hard_texts():
    """Null and empty texts, a very long one, repeated rows and ids, ties, odd characters."""
    some = " ".join(f"word{i}" for i in range(70))
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, some), (5, some), (5, some), (6, some.upper()), (None, some), (None, None),
        (7, "x" * 60), (8, "x" * 49), (9, "a\x00b \x0b\x0c c\u00a0d\u2003e  f\n\ng"), (10, PASSAGE + " " + some), (11, "q" + PASSAGE),
        (12, "one two three " * 40), (13, "line one is here\n" * 30), (14, "### $$$ %%% " * 30), (15, "mail a.b@c.de, 10.0.0.1, +1 415 555 0100"),
        (16, "日本語 テキスト <|endoftext|> end"), (17, " ".join(random.Random(1).choices(["ab", "ba", "the", "of", "and", "xyz"], k=30_000))),
    ]


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame(hard_texts(), DOCS)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def both(spark, documents, hard):
    return documents.select("doc_id", "text").where("doc_id > 20").unionByName(hard)


def test_quality_measures(spark, documents, hard):
    docs = both(spark, documents, hard)
    got = quality_rules.judged(docs, carry=["doc_id", "text"]).select(
        "row.doc_id", "row.text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"
    ).collect()
    assert len(got) == docs.count()
    for r in got:
        assert tuple(r)[2:8] == brute.measures(r.text), r.doc_id
        assert r.kept == (not r.base_failed and r.posterior >= 0.5)


def test_quality_posterior_is_that_of_the_rules(spark, documents):
    """EM in plain Python over all documents, from the votes of each."""
    got = quality_rules.judged(documents.select("doc_id", "text"), carry=["doc_id"]).collect()
    names = [f"vote_{n}" for n in quality_rules.RULES]
    prior, odds = quality_rules.fit_votes(sorted(Counter(tuple(r[n] for n in names) for r in got).items()))
    for r in got:
        x = prior + sum(o[r[n]] for o, n in zip(odds, names))
        assert abs(r.posterior - 1 / (1 + np.exp(-x))) < 1e-9


def test_quality_against_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = queries.op10_quality_rules(spark, sf).join(labels, "doc_id").where("not base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_quality_plan_has_no_python(spark):
    plan = queries.op10_quality_rules(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_decontamination(spark, documents, hard):
    docs = both(spark, documents, hard)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items += [(900, "the"), (901, "Word3 word4, WORD5"), (902, None), (903, "!! ,"), (904, " ".join(f"word{i}" for i in range(20, 40))), (904, "of the")]
    got = decontamination.contamination(docs, spark.createDataFrame(items, "item_id long, text string"), carry=["doc_id"]).select(
        "row.doc_id", "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("h"), "contaminated"
    ).collect()
    want = brute.benchmark_hits([tuple(r) for r in docs.collect()], items)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want)) and any(w[-1] for w in want)


def test_simhash(spark, documents, hard):
    docs = both(spark, documents, hard)
    got = simhash.near_duplicates(docs, carry=["doc_id", "text"]).select("row.doc_id", "row.text", "fp", "component_id").collect()
    assert len(got) == docs.count()
    rows = [(r.doc_id, brute.simhash(r.text)) for r in got]
    label = brute.linked([fp for _, fp in rows])
    least = {}
    for (i, _), group in zip(rows, label):
        if i is not None:
            least[group] = min(least.get(group, i), i)
    for r, (_, fp), group in zip(got, rows, label):
        assert r.fp & (1 << 64) - 1 == fp and r.component_id == least.get(group)


@pytest.mark.parametrize("n", [0, 1, 2, 60, 3000])
def test_bk_trees_find_all_links(n):
    rng = np.random.default_rng(n)
    base = rng.integers(0, 1 << 63, size=max(1, n // 10)).astype(np.uint64)
    bits = lambda: np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
    fp = np.unique(base[rng.integers(0, len(base), n)] ^ bits() ^ bits())
    rng.shuffle(fp)
    assert np.array_equal(simhash.linked(np.zeros(len(fp), np.int64), fp[:, None], 4), brute.linked(fp))
    shard = np.sort(rng.integers(0, 5, len(fp)))
    got = simhash.linked(shard, fp[:, None], 4)
    for s in range(5):
        own = np.flatnonzero(shard == s)
        assert np.array_equal(got[own] - (own[0] if len(own) else 0), brute.linked(fp[own]))


@pytest.mark.parametrize("blocks", [5, 6, 7, 8])
def test_blocks_share_a_shard_for_every_link(blocks):
    masks, rng = simhash.shard_masks(blocks, 4), random.Random(blocks)
    for _ in range(300):
        flipped = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not flipped & m for m in masks)


def test_one_of_each_by_similarity(spark, documents):
    docs = documents.select("doc_id", "text")
    kept = {r.doc_id for r in simhash.one_of_each(docs).collect()}
    sets = {r.doc_id: brute_shingles(r.text) for r in docs.collect()}
    similar = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.85 * len(sets[a] | sets[b])]
    assert similar and all(not {a, b} <= kept for a, b in similar)
    alone = [a for a in sets if all(a == b or len(sets[a] & sets[b]) < 0.6 * len(sets[a] | sets[b]) for b in sets)]
    assert set(alone) <= kept


def brute_shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_one_of_each_on_hard_rows(spark, hard):
    wide = hard.withColumn("fp", F.lit("mine")).withColumn("number", F.lit(0)).withColumn("root", F.lit(None).cast("string"))
    got = simhash.one_of_each(wide)
    assert got.columns == wide.columns
    ids = [r.doc_id for r in got.collect()]
    assert len(ids) == len(set(ids)) and {1, 4} <= set(ids) and not {2, 3, 5, 6, None} & set(ids)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 40)] + [(500, 500), (300, 299), (299, 300)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(101, 161)} | {i: 0 for i in range(1, 40)} | {300: 299}


def test_encoder_equals_the_library():
    rng, library, encoder = random.Random(5), Tokenizer.from_file(FILE), Encoder(FILE)
    parts = ["b.", "c, ", "x. y, z", " \x00.", "a", "B", "é", "é. ", "—, ", "1", "23", " ", "  ", "\n", "\n\n", "\t", "\x1c", "\x85", "\xa0", "'s",
             "'ll", "!", "...", "日本", "<|endoftext|>", "\r\n", "\u200d", "\u3000", "\x00", "\u180e"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(4000)] + [None, ""] + [t for _, t in hard_texts()]
    ids, at = encoder.encode(pa.array(texts, pa.string()))
    want = library.encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert all(w.ids == ids[a:b].tolist() for w, a, b in zip(want, at, at[1:])) and len(at) == len(texts) + 1


@pytest.mark.parametrize("n, top", [(0, 0), (1, 0), (5, 5), (1000, 10**7), (5000, 300), (700, 2**40)])
def test_elias_fano(n, top):
    values = np.sort(np.array([random.Random(n + i).randint(0, top) for i in range(n)], dtype=np.int64))
    packed = token_files.ef_encode(values, top)
    read = token_files.EliasFano(memoryview(packed))
    assert read.run(0, n).tolist() == values.tolist() == [read.select(i) for i in range(n)]
    some = random.Random(n)
    for _ in range(20):
        a, b = sorted(some.choices(range(n + 1), k=2))
        assert read.run(a, b).tolist() == values[a:b].tolist()
    assert n < 700 or len(packed) < 0.7 * 8 * n


def test_token_files_round_trip(spark, documents, hard):
    docs = both(spark, documents, hard)
    folder = token_files.token_folder(spark)
    token_files.write_tokens(docs, folder, FILE)
    got = token_files.read_tokens(spark, folder, with_ids=True).orderBy("position").collect()
    library, at = Tokenizer.from_file(FILE), 0
    want = sorted((i is not None, i or 0, library.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in docs.collect())
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids) for r in got) == want
    assert [(r.doc_id is not None, r.doc_id or 0) for r in got] == [w[:2] for w in want]
    for k, r in enumerate(got):
        assert (r.position, r.start, r.n_tokens, r.ids_crc32) == (k, at, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))
        at += r.n_tokens


def test_ids_of_pieces_are_not_sent_to_python_for_their_place(spark):
    docs = spark.createDataFrame([(i, f"Text {i}") for i in range(9)], "doc_id long, text string")
    plan = packing.packed(docs, FILE, carry=["doc_id"], with_ids=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan and "place(length" in plan


def test_a_worker_gives_back_what_another_operator_left():
    common.worker_cache()["encoder", "file"] = "pieces"
    common.clear_worker_cache()
    assert not common.worker_cache()


def test_packing(spark, documents, hard):
    docs = both(spark, documents, hard)
    rows = packing.packed(docs, FILE, carry=["doc_id", "text"], with_ids=True).select("row.*", "*").drop("row").collect()
    library, of = Tokenizer.from_file(FILE), {}
    for r in rows:
        of.setdefault((r.doc_id, r.text), []).append(r)
    assert sum(r.piece == 0 for r in rows) == docs.count()
    for (_, text), pieces in of.items():
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        times = sum(p.piece == 0 for p in pieces)
        for k in range(-(-len(ids) // 2048)):
            own = [p for p in pieces if p.piece == k]
            assert len(own) == times
            for p in own:
                assert p.length == len(p.ids) and (k == 0 or p.length == 2048) and p.ids == ids[p.start : p.start + p.length]
                assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
        assert sum(p.length for p in pieces) == times * len(ids)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= 1.02 * sum(r.length for r in rows) / 2048 + 2


@pytest.mark.parametrize("n, top", [(0, 1), (1, 2048), (400, 2048), (20_000, 2048), (5000, 700)])
def test_plan_keeps_every_piece(n, top):
    rng = random.Random(n)
    histogram = Counter(rng.randint(1, top) for _ in range(n))
    first = packing.best_fit(histogram, 2048)
    last = packing.local_search(first, 2048)
    for free in (first, last):
        held = Counter()
        for room, contents in free.items():
            for content, bins in contents.items():
                assert sum(content) == 2048 - room
                for x in content:
                    held[x] += bins
        assert held == histogram
    count = lambda free: sum(sum(c.values()) for c in free.values())
    assert count(last) <= count(first)


def test_local_search_empties_a_bin():
    """Three bins whose pieces fit in two after an exchange of two for one."""
    free = {40: Counter({(60,): 1}), 10: Counter({(50, 40): 2})}
    assert sum(sum(c.values()) for c in packing.local_search({45: Counter({(55,): 1}), 5: Counter({(50, 45): 1}), 50: Counter({(50,): 1})}, 100).values()) == 2
    assert sum(sum(c.values()) for c in packing.local_search(free, 100).values()) <= 3


def bins_of(free):
    return sum(sum(c.values()) for c in free.values())


def fewest_bins(pieces, capacity):
    """The least number of bins, by trying every bin for every piece."""
    best = len(pieces)

    def place(at, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if at == len(pieces):
            best = len(rooms)
            return
        for i, room in enumerate(rooms):
            if pieces[at] <= room and room not in rooms[:i]:
                place(at + 1, rooms[:i] + [room - pieces[at]] + rooms[i + 1 :])
        place(at + 1, rooms + [capacity - pieces[at]])

    place(0, [])
    return best


def test_bins_are_between_the_fewest_and_best_fit():
    rng, met = random.Random(5), 0
    for _ in range(150):
        pieces = sorted((rng.randint(3, 28) for _ in range(rng.randint(1, 11))), reverse=True)
        histogram = dict(Counter(pieces))
        first = packing.best_fit(histogram, 40)
        found, fewest = bins_of(packing.local_search(first, 40)), fewest_bins(pieces, 40)
        assert packing.least_bins(histogram, 40) <= fewest <= found <= bins_of(first)
        met += found == fewest
    assert met >= 145


def test_an_exchange_is_the_best_of_all():
    """The index finds an exchange that takes as much as the best one found by trying all."""
    rng = random.Random(6)
    for _ in range(200):
        free = {}
        for _ in range(rng.randint(2, 8)):
            content = tuple(sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 4))), reverse=True))
            if sum(content) <= 50:
                free.setdefault(50 - sum(content), Counter())[content] += 2
        room = max(free, default=0)
        if not room:
            continue
        victim = next(iter(free[room]))
        gives = [(x,) for x in victim] + [(x, y) for i, x in enumerate(victim) for y in victim[:i]]
        best = 0
        for r, contents in free.items():
            for content in contents:
                for give in gives:
                    gets = [(x,) for x in content] + ([(), *((x, y) for i, x in enumerate(content) for y in content[:i])] if len(give) == 1 else [])
                    best = max([best, *(g for get in gets if 0 < (g := sum(give) - sum(get)) <= r <= room)])
        got = packing.OpenBins(free, 50).exchange(victim)
        assert (got[0] if got else 0) == best
        if got:
            gain, r, content, give, get = got
            assert gain == sum(give) - sum(get) <= r and content in free[r]
            assert not Counter(give) - Counter(victim) and not Counter(get) - Counter(content)


def test_plan_takes_seconds_at_any_scale():
    lengths = np.random.default_rng(3).lognormal(6, 1.1, 200_000).astype(int) % 2048 + 1
    shape = Counter(lengths.tolist())
    for times in (5, 500, 50_000):  # a million to 10^10 pieces
        histogram = {x: n * times + x % times for x, n in shape.items()}
        first = bins_of(packing.best_fit(histogram, 2048))
        began = time.process_time()
        slots = packing.plan(histogram)
        assert time.process_time() - began < 40 and slots["bins"] <= first and len(slots["length"]) < 900_000


def test_plain_personal_data_equals_the_patterns():
    rng = random.Random(1)
    parts = [*"ab@@..-+ 01239()%_é", "@a.b", "4111 1111 1111 1111", "+1 (415) 555-0100", "10.0.0.1", "255.", ".1"]
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 30)))
        assert pii.plain_spans(text) == brute.personal(text), text


@pytest.mark.parametrize("text, kind, span", [
    ("write to jane.doe [at] example [dot] org now", "email", "jane.doe [at] example [dot] org"),
    ("jane dot doe at example dot org", "email", "jane dot doe at example dot org"),
    ("ｊａｎｅ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｊａｎｅ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("an j\u0430ne@ex\u0430mple.com", "email", "j\u0430ne@ex\u0430mple.com"),
    ("call plus four nine one five one two three four five six seven eight!", "phone", "plus four nine one five one two three four five six seven eight"),
    ("one nine two dot one six eight dot one zero one dot one two three", "ip", "one nine two dot one six eight dot one zero one dot one two three"),
    ("é 4111\u200b1111 1111 1111", "card", "4111\u200b1111 1111 1111"),
])
def test_disguised_personal_data(text, kind, span):
    found = [(pii.KINDS[k], text[a:b], d) for a, k, b, d in pii.all_spans(text)]
    assert found == [(kind, span, True)]


@pytest.mark.parametrize("text", ["meet at example.com, look at the dot on it", "one two three go", "zero at zero dot", "", "Ich zähle eins zwei drei"])
def test_clean_texts_have_no_personal_data(text):
    assert pii.all_spans(text) == []


def test_personal_data_takes_linear_time():
    for text in ("1" * 300_000, "1." * 150_000, "+1" * 150_000, "a@" * 150_000, "a dot " * 50_000, "one " * 50_000, "[ " * 100_000, " " * 300_000):
        pii.all_spans(text)


def test_personal_data_rows(spark, hard):
    got = pii.with_spans(hard, carry=["doc_id", "text"]).select("row.*", "spans", "redacted").collect()
    for r in got:
        assert [(s.start, pii.KINDS.index(s.kind), s.end) for s in r.spans if not s.disguised] == brute.personal(r.text or "")
    assert next(r.redacted for r in got if r.doc_id == 15) == "mail [EMAIL], [IP], [PHONE]"


@pytest.mark.parametrize("block", [20_000, 2 << 20])
def test_shared_passages(spark, documents, hard, monkeypatch, block):
    for name, value in {"BLOCK_BYTES": block, "CHUNK": 500, "BUCKET_RECORDS": 100, "SAMPLES": 5000, "ROWS": 37}.items():
        monkeypatch.setattr(suffix_dedup, name, value)
    rng = random.Random(2)
    extra = [(1000 + i, "".join(rng.choices(["ab", "ba ", PASSAGE, PASSAGE[:55], "0" * 52], k=rng.randint(1, 8)))) for i in range(60)]
    docs = both(spark, documents, hard).unionByName(spark.createDataFrame(extra, DOCS)).repartition(5)
    got = [(r.doc_id, r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], bytes(r.kept)) for r in suffix_dedup.shared_passages(docs).collect()]
    want = brute.passages([tuple(r) for r in docs.collect()])
    assert sorted(map(str, got)) == sorted(map(str, want)) and sum(w[2] > 0 for w in want) > 50


@pytest.mark.parametrize("range_bytes", [3000, 4 << 20])
def test_archives(spark, range_bytes):
    fake = warc.record("9", "u", b"inner" * 300, "x", None).decode()
    extra = [(10**6, None, None), (10**6 + 1, "u\r\nx y", "é" * 600), (10**6 + 2, "b", "é" * 600), (10**6 + 3, "b", "small"), (10**6 + 4, "b", "small"),
             (10**6 + 5, "f", fake + "WARC/1.0\r\n" * 900), (10**6 + 6, "f", fake), (10**6 + 7, "f", fake), (10**6 + 7, "f2", fake), (None, "n", fake),
             (10**6 + 8, "g", "x" * 30_000)]
    pages = spark.read.parquet(f"{SF}/pages.parquet").unionByName(spark.createDataFrame(extra, "page_id long, url string, html string"))
    folder = stages(spark).folder
    warc.write_archives(pages, folder)
    rows = pages.collect()
    best, want = {}, []
    for r in rows:
        h = (r.html or "").encode()
        if len(h) >= 1000 and r.page_id is not None:
            best[h] = max(best.get(h, -1), r.page_id)
    for r in rows:
        h = (r.html or "").encode()
        again = len(h) >= 1000 and r.page_id is not None and best[h] != r.page_id
        want.append((str(r.page_id) if r.page_id is not None else "", len(h), hashlib.sha1(h).hexdigest(), "revisit" if again else "response",
                     str(best[h]) if again else None, b"" if again else h))
    got = [(r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload))
           for r in warc.read_archives(spark, folder, True, range_bytes).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_a_cut_archive_is_read_up_to_the_damage(spark, tmp_path):
    records = [warc.record(str(i), None, b"x" * 700, "d", None) for i in range(20)]
    data = b"".join(records)[:-300]
    (tmp_path / "archives").mkdir()
    (tmp_path / "archives/one.warc").write_bytes(data)
    spark.createDataFrame([("one.warc", len(data))], "file string, size long").write.parquet(f"{tmp_path}/list")
    got = warc.read_archives(spark, str(tmp_path), range_bytes=2000).collect()
    assert sorted(int(r.record_id) for r in got) == list(range(19))


def test_url_rules(spark):
    extra = [(None, None), (1, "nope"), (2, "HTTP://A.Example.ORG/es/x?y#z"), (3, "x://"), (4, "x://h?://b"), (4, "x://org"), (5, "x://ORG/")]
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").unionByName(spark.createDataFrame(extra, "page_id long, url string"))
    pages = pages.withColumn("host", F.lit("clash"))
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", (F.col("quality") == 0).alias("block"))
    got = url_rules.judged(pages, labels, queries.URL_RULES).select("row.url", "host", "path", "rule", "verdict").collect()
    assert len(got) == pages.count()
    for r in got:
        host, path, rule, verdict = brute.address(r.url, queries.URL_RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ((verdict,) if rule else ("allow", "block"))


def test_mined_rules_block_what_labels_say(spark):
    rows = [(i, f"http://{'bad' if i % 3 == 0 else 'good'}.example.net/{'ads' if i % 2 else 'en'}/{i}") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 3 == 0 and i % 2 == 1) for i in range(200)], "doc_id long, block boolean")
    got = url_rules.judged(pages, labels, []).select("row.page_id", "verdict").collect()
    assert all((r.verdict == "block") == (r.page_id % 6 == 3) for r in got)
    labelled = url_rules.with_address(pages).select("row.page_id", "tokens").join(labels.withColumnRenamed("doc_id", "page_id"), "page_id")
    mined = url_rules.mined_rules(labelled, url_rules.rule_items(labelled))
    assert mined.count() and all(r.confidence >= url_rules.CONFIDENCE for r in mined.collect())


def test_every_place_of_a_url_is_a_token(spark):
    url = "HTTPS://www.Cheap-Pills.shop.example.com/en/12/deep/Buy_now.html?page=2&ref=x;q#top9"
    assert url_rules.with_address(spark.createDataFrame([(url,)], "url string")).first().tokens == sorted([
        "scheme=https", *(f"label={x}" for x in ("www", "cheap-pills", "shop", "example", "com")),
        *(f"folder={x}" for x in ("en", "#", "deep", "Buy_now.html")), *(f"word={x}" for x in ("cheap", "pills", "Buy", "now", "html")),
        "key=page", "key=ref", "key=q", "field=page=#", "field=ref=x", "extension=html", "fragment=top#",
    ])


@pytest.mark.parametrize("cause", ["pills.", "/c/b/a/", "q=1&z=2"])
def test_mined_rules_see_all_places(spark, cause):
    """Labels that depend on a middle host label, a third directory and a second query key."""
    rng = random.Random(cause)
    rows = []
    for i in range(600):
        bad = rng.random() < 0.3
        host = f"{rng.choice('mw')}.{'pills' if bad and 'pills' in cause else rng.choice(['news', 'blog'])}.example.net"
        path = "/c/b/a/" if bad and "/" in cause else "/c/b/" + rng.choice("de")
        rows.append((i, f"http://{host}{path}?q={i}" + ("&z=2" if bad and "z" in cause else rng.choice(["", "&y=1"])), bad))
    pages = spark.createDataFrame(rows, "page_id long, url string, bad boolean")
    labels = pages.where("page_id % 2 = 0").selectExpr("page_id as doc_id", "bad as block")
    got = url_rules.judged(pages, labels, []).select("row.bad", "verdict").collect()
    assert {(r.bad, r.verdict) for r in got} == {(True, "block"), (False, "allow")}


def test_mined_verdicts_are_those_of_all_rules(spark):
    """Every set of tokens is tried as a rule in plain Python; labels are noisy, so few are certain."""
    rng = random.Random(8)
    rows = []
    for i in range(400):
        site = rng.choice(["a.x", "b.x", "b.y"])
        rows.append((i, f"http://{site}/{rng.choice(['p', 'q', 'r-s', ''])}" + rng.choice(["", "?k=1", "?k=v", "#f"])))
    rows += [(400, None), (401, "no address"), (402, "http://new.z/p")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    chance = lambda u: 0.9 if "b." in u and "r-s" in u else 0.6 if "?k=v" in u else 0.1
    marks = [(i, rng.random() < chance(u)) for i, u in rows[:300]]
    tokens = {r.page_id: r.tokens for r in url_rules.with_address(pages).select("row.page_id", "tokens").collect()}
    n, blocked = Counter(), Counter()
    for i, block in marks:
        for k in range(1, len(tokens[i]) + 1):
            for some in combinations(tokens[i], k):
                n[some] += 1
                blocked[some] += block
    sure = {some: blocked[some] / n[some] for some in n if blocked[some] >= 20 and blocked[some] / n[some] >= 0.5}
    got = url_rules.judged(pages, spark.createDataFrame(marks, "doc_id long, block boolean"), []).select("row.page_id", "verdict", "confidence").collect()
    assert len(got) == len(rows)
    for r in got:
        best = max((c for some, c in sure.items() if set(some) <= set(tokens[r.page_id])), default=None)
        assert r.verdict == ("block" if best else "allow") and (r.confidence or 0) == pytest.approx(best or 0)
    assert {r.verdict for r in got} == {"allow", "block"}


def test_perplexity_equals_plain_kneser_ney(spark, documents, hard):
    docs = both(spark, documents, hard).withColumn("lang", F.when(F.col("doc_id") > 5, "xx"))
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1 and toxic = 0")
    got = kneser_ney.classified(docs, labels)
    rows = got.join(docs.select("doc_id", "text").dropDuplicates(["doc_id"]), "doc_id").collect()
    trusted = {r.doc_id for r in labels.collect()}
    size = kneser_ney.ORDER
    symbols = lambda t: [kneser_ney.LINE] * (size - 1) + list((t or "").encode())
    grams = lambda z: [tuple(z[j : j + size]) for j in range(len(z) - size + 1)]
    counts = {size: Counter()}
    for i, t in docs.select("doc_id", "text").collect():
        if i in trusted:
            counts[size].update(grams(symbols(t)))
    for k in range(size - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    taken, context = {}, {k: {} for k in counts}
    for k in range(1, size + 1):
        n = [sum(v == i for v in counts[k].values()) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] + 2 * n[1] else 0.5
        d = [i - (i + 1) * y * b / a if a else 0.5 * i for i, (a, b) in enumerate(zip(n, n[1:]), 1)]
        taken[k] = [min(max(x, 0.1 * i), 0.95 * i) for i, x in enumerate(d, 1)]
        for g, v in counts[k].items():
            total, left = context[k].get(g[:-1], (0, 0.0))
            context[k][g[:-1]] = total + v, left + taken[k][min(v, 3) - 1]

    def probability(gram):
        p = 1 / kneser_ney.SYMBOLS
        for k in range(1, size + 1):
            g = gram[size - k :]
            if g[:-1] in context[k]:
                (total, left), v = context[k][g[:-1]], counts[k].get(g, 0)
                p = ((v - taken[k][min(v, 3) - 1] if v else 0) + left * p) / total
        return p

    checked = 0
    for r in sorted(rows, key=lambda r: r.doc_id)[:60]:
        events = grams(symbols(r.text))
        if not events:
            assert r.perplexity is None and not r.kept
        elif len(events) < 5000:
            want = np.exp(-np.mean([np.log(probability(g)) for g in events]))
            assert abs(want - r.perplexity) < 1e-3 * want
            checked += 1
    assert checked > 30


def test_perplexity_of_texts_without_bytes_and_of_clashing_columns(spark):
    rows = [(1, None, "a", 1), (2, "", "b", 2), (2, "", "b", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, number long")
    got = kneser_ney.classified(docs, docs).collect()
    assert [(r.n_bytes, r.perplexity, r.kept) for r in got] == [(0, None, False)] * 3
    docs = docs.union(spark.createDataFrame([(3, "good words", None, 3)] * 2, docs.schema)).withColumnRenamed("lang", "event")
    docs = docs.withColumn("part", F.lit("x")).withColumn("row", F.lit(None).cast("int"))
    scored = kneser_ney.scored(docs, docs.where("false")).select("row.*", "n_bytes", "perplexity").collect()
    assert sorted(r.n_bytes for r in scored) == [0, 0, 0, 10, 10] and scored[0].part == "x"
    assert {round(r.perplexity, 3) for r in scored if r.n_bytes} == {256.0}
    judged = kneser_ney.classified(docs, docs.where("doc_id = 3"), lang="event").where("doc_id = 3").collect()
    assert len(judged) == 2 and all(r.kept and r.perplexity == r.threshold for r in judged)


def test_events_and_tallies_of_any_texts():
    texts = ["", "a", "no", "\n\n", "ünï", "x" * 40]
    want = []
    for t in texts:
        raw = b"\n" * (kneser_ney.ORDER - 1) + t.encode()
        want += [int.from_bytes(raw[j : j + kneser_ney.ORDER]) for j in range(len(t.encode()))]
    code, at = kneser_ney.events(pa.array(texts))
    assert code.tolist() == want and at.tolist()[-1] == len(want)
    assert kneser_ney.events(pa.array([], pa.string()))[0].tolist() == []
    tally = kneser_ney.Tally()
    assert list(tally.sent()) == []
    for _ in range(3):
        tally.add(code)
        tally.settle()
    (batch,) = tally.sent()
    assert dict(zip(*(c.to_pylist() for c in batch.columns))) == {e: 3 * n for e, n in Counter(want).items()}


def test_perplexity_tells_labels_apart(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op1_kneser_ney(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.2 * len(bad)


EMPTY = {
    "op1": lambda s, d: kneser_ney.classified(d.withColumn("lang", F.lit("en")), d),
    "op2": lambda s, d: (f := token_files.token_folder(s), token_files.write_tokens(d, f, FILE), token_files.read_tokens(s, f))[2],
    "op3": lambda s, d: url_rules.judged(d.selectExpr("doc_id as page_id", "text as url"), d.selectExpr("doc_id", "true as block"), queries.URL_RULES),
    "op4": lambda s, d: suffix_dedup.shared_passages(d),
    "op5": lambda s, d: simhash.near_duplicates(d),
    "op6": lambda s, d: (f := stages(s).folder, warc.write_archives(d.selectExpr("doc_id as page_id", "text as url", "text as html"), f), warc.read_archives(s, f))[2],
    "op7": lambda s, d: pii.with_spans(d),
    "op8": lambda s, d: packing.packed(d, FILE),
    "op9": lambda s, d: decontamination.contamination(d, d.selectExpr("doc_id as item_id", "text")),
    "op10": lambda s, d: quality_rules.judged(d),
}


@pytest.mark.parametrize("name", EMPTY)
def test_empty_tables(spark, name):
    assert EMPTY[name](spark, spark.createDataFrame([], DOCS)).collect() == []
