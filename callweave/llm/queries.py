"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from callweave.llm import (
    decontamination,
    filter_audit,
    html_extraction,
    kneser_ney,
    lexical_search,
    packing,
    pii,
    quality_rules,
    simhash,
    suffix_dedup,
    token_files,
    url_rules,
    warc,
)
from callweave.llm.common import read, stages

QUERIES, SQL = {}, {}


def registered(query):
    QUERIES[query.__name__] = query
    return query


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@registered
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    marked = simhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"), carry=["doc_id"])
    return marked.select("row.doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@registered
def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that a 10-word window of a benchmark item covers."""
    judged = decontamination.contamination(
        read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"),
        carry=["doc_id"],
    )
    return judged.select("row.doc_id", "n_words", "n_hit", "n_items", sha256(F.col("items")).alias("items_sha256"), "contaminated")


@registered
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document; the posterior is rounded for display."""
    judged = quality_rules.judged(read(spark, sf_dir, "documents", "doc_id", "text"), carry=["doc_id"])
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("posterior", 6).alias("posterior"),
    )


@registered
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start, length and checksum of every document, read back from the files."""
    folder = token_files.token_folder(spark)
    token_files.write_tokens(
        read(spark, sf_dir, "documents", "doc_id", "text"), folder, public_tokenizers.path("byte_bpe_50k.json")
    )
    return token_files.read_tokens(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


@registered
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece in its sequence."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    pieces = packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), carry=["doc_id"])
    return pieces.select("row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


#: Rules that the contract of op3 names.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


@registered
def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, given rule and verdict of every page."""
    labels = read(spark, sf_dir, "labels", "doc_id", (F.col("quality") == 0).alias("block"))
    judged = url_rules.judged(read(spark, sf_dir, "pages", "page_id", "url"), labels, URL_RULES)
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


@registered
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, read back from the archives."""
    folder = stages(spark).folder
    warc.write_archives(read(spark, sf_dir, "pages", "page_id", "url", "html"), folder)
    return warc.read_archives(spark, folder).select(
        F.expr("try_cast(record_id as long)").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


@registered
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts of plain spans, their digest, and all spans."""
    found = pii.with_spans(read(spark, sf_dir, "documents", "doc_id", "text"), carry=["doc_id"])
    plain = F.filter("spans", lambda s: ~s["disguised"])
    return found.select(
        "row.doc_id",
        *[F.size(F.filter(plain, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in pii.KINDS],
        sha256(_joined(plain)).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@registered
def op1_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under a model of the good and harmless labelled ones, and
    whether it stays below its language's quantile."""
    docs = read(spark, sf_dir, "documents", "doc_id", "lang", "text")
    trusted = read(spark, sf_dir, "labels", "doc_id", "quality", "toxic").where("quality = 1 and toxic = 0")
    return kneser_ney.classified(docs, trusted)


@registered
def op4_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of every document remains without passages of documents before it."""
    found = suffix_dedup.shared_passages(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@registered
def op11_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_extraction.extracted(read(spark, sf_dir, "pages", "page_id", "url", "html"), carry=["page_id", "url"])
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


@registered
def op12_geometric_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    docs, items = read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text")
    found = lexical_search.ranked(docs, items, carry=["doc_id"])
    return found.select("item_id", F.col("rank").cast("int").alias("rank"), "row.doc_id", "score")


@registered
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes in each part, in all orders."""
    labels = read(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return filter_audit.audited(spark, f"{sf_dir}/documents.parquet", labels)


SQL["op6_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM p),
     m AS (SELECT *, max(CASE WHEN payload_bytes >= 1000 THEN page_id END) OVER (PARTITION BY payload_digest, payload_bytes) AS best FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < best THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < best THEN best END AS refers_to
FROM m
"""


SQL["op4_suffix_array"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
     w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s
           FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM d WHERE len(h) >= 100)),
     f AS (SELECT s, min(doc_id) AS first_id FROM w GROUP BY s),
     g AS (SELECT doc_id, i FROM w JOIN f USING (s) WHERE first_id < doc_id),
     m AS (SELECT doc_id, i, CASE WHEN lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 >= i THEN 0 ELSE 1 END AS new_run FROM g),
     r AS (SELECT doc_id, i, sum(new_run) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM m),
     s AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM r GROUP BY doc_id, run),
     p AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS prev FROM s),
     k AS (SELECT p.doc_id, string_agg(substr(h, 2 * prev + 1, 2 * (a - prev)), '' ORDER BY a) AS head, max(b) AS last,
                  sum(b - a) AS n_removed, count(*) AS n_spans FROM p JOIN d USING (doc_id) GROUP BY p.doc_id)
SELECT doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[0-9a-z\x{80}-\x{10FFFF}]+')"
)

SQL["op9_winnowing"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
     b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
     iw AS (SELECT DISTINCT item, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
            FROM (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
     dw AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d JOIN (SELECT DISTINCT n FROM iw) ON len(w) >= n)),
     h AS (SELECT DISTINCT doc_id, i, n, item FROM dw JOIN iw USING (n, win)),
     c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
     e AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN e USING (doc_id)
"""

SQL["op12_geometric_blocks"] = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
     d AS (SELECT row_number() OVER () AS k, doc_id, w, len(w) AS n FROM t WHERE len(w) > 0),
     s AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM d),
     q AS (SELECT item_id, row_number() OVER () AS qk, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
     qt AS (SELECT item_id, qk, term, count(*) AS times FROM (SELECT item_id, qk, unnest(w) AS term FROM q) GROUP BY ALL),
     p AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM qt) GROUP BY ALL),
     f AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
     m AS (SELECT k, doc_id, 75 + (25 * n * nd) // l AS m FROM d, s),
     r AS (SELECT item_id, qk, k, doc_id, CAST(sum(times * f.w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
           FROM qt JOIN p USING (term) JOIN f USING (term) JOIN m USING (k) GROUP BY ALL),
     o AS (SELECT *, row_number() OVER (PARTITION BY qk ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 20
"""

SQL["op13_filter_audit"] = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
     w AS (SELECT *, regexp_extract_all(text, '[^ \t\n\x0B\f\r]+') AS ws, min(doc_id) OVER (PARTITION BY text) AS first_id FROM d),
     b AS (SELECT doc_id, part,
                  (CASE WHEN len(ws) < 100 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 2 ELSE 0 END)
                  + (CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 4 ELSE 0 END)
                  + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END) + (CASE WHEN doc_id > first_id THEN 16 ELSE 0 END) AS mask FROM w),
     l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
     g AS (SELECT part, mask, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n FROM b LEFT JOIN l USING (doc_id) GROUP BY ALL),
     x AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(f, bit)),
     o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
           FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
     s AS (SELECT filter_order, step, bits[step] AS own, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS earlier
           FROM o, (SELECT unnest(range(1, 6)) AS step)),
     c AS (SELECT part, filter_order, step, own, CAST(sum(CASE WHEN mask & (own | earlier) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
                  CAST(sum(CASE WHEN mask & own > 0 AND mask & earlier = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
                  CAST(sum(CASE WHEN mask & own > 0 AND mask & earlier > 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
                  CAST(sum(CASE WHEN mask = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
                  CAST(sum(CASE WHEN mask & own > 0 AND mask & earlier = 0 AND good THEN n ELSE 0 END) AS BIGINT) AS good_lost,
                  CAST(sum(CASE WHEN mask & own > 0 AND mask & earlier = 0 AND toxic THEN n ELSE 0 END) AS BIGINT) AS toxic_lost
           FROM g, s GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM c
"""

SQL["op11_site_style_tree"] = r"""
WITH p AS (SELECT page_id, url, coalesce(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '') AS a FROM pages),
     t AS (SELECT page_id, url, regexp_replace(regexp_replace(a, '<(p|/p|h1|/h1|br)>', ' ', 'g'), '</?[a-z][^>]*>', '', 'g') AS a FROM p),
     e AS (SELECT page_id, url, replace(replace(replace(replace(replace(replace(a, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS a FROM t)
SELECT page_id, url, trim(regexp_replace(a, '\s+', ' ', 'g')) AS text, length(trim(regexp_replace(a, '\s+', ' ', 'g'))) AS n_chars FROM e
"""
