"""URL filters: given rules first, then rules mined from labels by FP-growth. DataFrames only.

A url's host stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, its path
after it up to ``?``, ``#`` or the end. Given rules name a host (and its subdomains) and the
beginning of a path; the longest that fits decides.

For urls without such a rule, association rules decide. A url's tokens are its scheme, every host
label, every directory, every word of a label or directory of several words, the extension, every
query key and every key with its value, and the fragment; runs of digits are one sign. FP-growth finds
the token sets that go with the label "block"; rules below ``CONFIDENCE`` or ``SUPPORT`` are pruned, and so
are rules that add tokens to a shorter rule without being more certain.

Three reductions come before FP-growth, and none changes a verdict. Tokens that stand with the label too
seldom are in no rule. Tokens of the same labelled pages (a site's labels, say) are one item, which a page
has if it has any of them: rules that differ in such tokens only are equally certain. A token of all
labelled pages only lengthens rules.

Matching uses an inverted index: a rule is listed under its rarest item only, and a set of
items is compared with the rules listed under one of its items. Distinct token sets are
matched, not pages, so a host with very many pages is compared once for each kind of path.

Null urls and urls without ``://`` have an empty host and path and no tokens: they are allowed.
Repeated pages are judged alike. Without labels nothing is mined and the rest is allowed.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from callweave.llm.common import drop, stages

SUPPORT, CONFIDENCE = 0.002, 0.5
#: Pages that a frequent set must have in any case, so that few labels prove nothing.
LEAST_PAGES = 20
BLOCK = "label=block"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def address(url: Column) -> tuple[Column, Column]:
    """Host and path, both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def with_address(pages: DataFrame, url: str = "url") -> DataFrame:
    """The given row as ``row``, its ``url``, ``host``, ``path`` and ``tokens``."""
    rows = pages.select(F.struct("*").alias("row"), F.col(url).cast("string").alias("url"))
    host, path = address(F.col("url"))
    return rows.withColumn("host", host).withColumn("path", path).withColumn("tokens", _tokens())


def _tokens() -> Column:
    labels = F.filter(F.split("host", r"\."), lambda x: x != "")
    folders = F.transform(F.filter(F.split("path", "/"), lambda x: x != ""), _signs)
    compound = F.filter(F.concat(labels, folders), lambda x: x.rlike(r"[\p{L}\p{N}#][^\p{L}\p{N}#]+[\p{L}\p{N}#]"))
    words = F.filter(F.flatten(F.transform(compound, lambda x: F.split(x, r"[^\p{L}\p{N}#]+"))), lambda x: x != "")
    extension = F.regexp_extract("path", r"\.([A-Za-z0-9]{1,8})$", 1)
    fields = F.filter(F.split(F.regexp_extract("url", r"^[^?#]*\?([^#]*)", 1), "[&;]"), lambda x: x != "")
    fragment = F.regexp_extract("url", r"^[^#]*#([\s\S]+)$", 1)
    tokens = F.concat(
        F.array(F.concat(F.lit("scheme="), F.translate(F.substring_index("url", "://", 1), UPPER, LOWER))),
        _named("label=", labels), _named("folder=", folders), _named("word=", words),
        _named("key=", F.transform(fields, lambda x: F.substring_index(x, "=", 1))),
        _named("field=", F.transform(F.filter(fields, lambda x: F.instr(x, "=") > 0), _signs)),
        F.when(extension != "", F.array(F.concat(F.lit("extension="), F.lower(extension)))).otherwise(_none()),
        F.when(fragment != "", F.array(F.concat(F.lit("fragment="), _signs(fragment)))).otherwise(_none()),
    )
    return F.when(F.col("host") != "", F.sort_array(F.array_distinct(tokens))).otherwise(_none())


def _none() -> Column:
    return F.array().cast("array<string>")


def _named(name: str, values: Column) -> Column:
    return F.transform(values, lambda x: F.concat(F.lit(name), x))


def _signs(text: Column) -> Column:
    """Numbers of any size are one sign."""
    return F.regexp_replace(text, "[0-9]+", "#")


def given_rules(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules such as ("allow", "org/") as rows: verdict, rule, host, path."""
    if not rules:
        return spark.sql("select '' verdict, '' rule, '' host, '' path where false")
    rows = spark.range(1).select(
        F.explode(F.array(*[F.struct(F.lit(v).alias("verdict"), F.lit(r).alias("rule")) for v, r in rules])).alias("r")
    )
    return rows.select("r.verdict", "r.rule", F.substring_index("r.rule", "/", 1).alias("host"),
                       F.expr("substring(r.rule, instr(r.rule, '/'))").alias("path"))


def ruled(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """host, path, rule and verdict of the distinct addresses that some given rule fits."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    spread = addresses.select("host", "path").distinct().withColumn("suffix", F.explode(suffixes))
    named = rules.select("verdict", "rule", F.col("host").alias("suffix"), F.col("path").alias("begin"))
    fits = spread.join(named, "suffix").where(F.col("path").startswith(F.col("begin")))
    best = F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best")
    return fits.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.verdict")


def rule_items(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """The tokens that a rule can need, from ``tokens`` and a boolean ``block``: token, its ``item`` (the least of the
    tokens that stand in the same labelled pages) and its ``uses``."""
    baskets = labelled.groupBy("tokens", "block").agg(F.count("*").alias("n")).where(F.size("tokens") > 0)
    total = baskets.agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("block"), F.col("n"))), F.lit(0)).alias("blocked")).first()
    pages = total["n"] or 0
    least = max(support * pages, min(LEAST_PAGES, pages))
    page = [F.xxhash64("tokens", "block"), F.xxhash64(F.lit(1), "tokens", "block")]
    used = (
        baskets.select(F.explode("tokens").alias("token"), "n", F.when(F.col("block"), F.col("n")).otherwise(0).alias("blocked"),
                       page[0].alias("a"), page[1].alias("b"))
        .groupBy("token").agg(F.sum("n").alias("uses"), F.sum("blocked").alias("blocked"), F.bit_xor("a").alias("a"),
                              F.bit_xor("b").alias("b"))
        .where(F.col("blocked") >= least)
    )
    if total["blocked"] < confidence * pages:  # a token of all pages is no rule by itself
        used = used.where(F.col("uses") < pages)
    names = used.groupBy("uses", "blocked", "a", "b").agg(F.min("token").alias("item"))
    return used.join(names, ["uses", "blocked", "a", "b"]).select("token", "item", "uses")


def with_items(sets: DataFrame, items: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and the distinct items of every row with some token of ``items``; equal rows are one."""
    tokens = sets.select(*columns, F.explode("tokens").alias("token"))
    return tokens.join(items.select("token", "item"), "token").groupBy(*columns).agg(F.collect_set("item").alias("items"))


def mined_rules(labelled: DataFrame, items: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """items and confidence of the rules for blocking, from ``tokens`` and a boolean ``block`` and the ``rule_items``."""
    counted = labelled.where(F.size("tokens") > 0).groupBy("tokens", "block").agg(F.count("*").alias("n"))
    pages = counted.agg(F.sum("n")).first()[0] or 0
    held = with_items(counted, items, "tokens", "block", "n")
    basket = F.when(F.col("block"), F.array_append("items", F.lit(BLOCK))).otherwise(F.col("items"))
    baskets = held.select(basket.alias("items"), F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("nth")).select("items")
    inside = baskets.count()  # the others have no item, and count for the support alone
    least = max(support * pages, min(LEAST_PAGES, pages))
    if not inside:
        return labelled.sparkSession.sql("select cast(array() as array<string>) items, 0d confidence where false")
    share = min(least * (1 - 1e-9) / inside, 1.0)  # a set of exactly ``least`` pages stays
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=confidence).fit(baskets)
    found = model.associationRules.where(F.expr(f"consequent = array('{BLOCK}')"))
    found = found.select(F.sort_array("antecedent").alias("items"), "confidence")
    # A rule goes if a rule with one item less, all of them its own, is as certain.
    shorter = found.select(F.col("items").alias("fewer"), F.col("confidence").alias("as_certain"))
    without = found.select("items", "confidence", F.explode("items").alias("left_out")).select(
        "items", "confidence", F.array_remove("items", F.col("left_out")).alias("fewer")
    )
    implied = without.join(shorter, "fewer").where("as_certain >= confidence").select("items")
    return found.join(implied, "items", "left_anti")


def blocked_tokens(sets: DataFrame, rules: DataFrame, items: DataFrame) -> DataFrame:
    """The distinct token sets of ``sets`` that hold all items of some rule, with the most certain
    rule's confidence. ``items`` has the number of times that a token is used."""
    listed = rules.select(F.col("items").alias("needs"), "confidence", F.explode("items").alias("item"))
    listed = listed.join(items.select("item", "uses").distinct(), "item")
    rarest = F.min(F.struct("uses", "item")).alias("rarest")
    index = listed.groupBy("needs").agg(rarest, F.first("confidence").alias("confidence"))
    index = index.select(F.col("rarest.item").alias("item"), "needs", "confidence")
    needed = items.join(listed.select("item").distinct(), "item", "left_semi")
    held = with_items(sets, needed, "tokens")
    candidates = held.select("tokens", "items", F.explode("items").alias("item")).join(index, "item")
    return candidates.where(F.size(F.array_except("needs", "items")) == 0).groupBy("tokens").agg(F.max("confidence").alias("confidence"))


def judged(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]], url: str = "url", page_id: str = "page_id",
           support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """Every row as ``row`` with host, path, rule, verdict and, for mined rules, confidence.

    ``labels`` has ``doc_id`` and a boolean ``block`` for some of the pages.
    """
    spark = pages.sparkSession
    kept = stages(spark)
    found = kept.keep(with_address(pages, url), "addresses")
    named = found.select(F.col(f"row.`{page_id}`").alias("doc_id"), "tokens")
    labelled = kept.keep(named.join(labels.select("doc_id", "block").distinct(), "doc_id").select("tokens", "block"), "labelled")
    items = kept.keep(rule_items(labelled, support, confidence), "items")
    mined = kept.keep(mined_rules(labelled, items, support, confidence), "mined")
    sets = found.where(F.size("tokens") > 0).select("tokens").distinct()
    blocked = kept.keep(blocked_tokens(sets, mined, items), "blocked")
    drop(kept, "labelled")
    decided = ruled(found, given_rules(spark, rules))
    verdict = F.coalesce("verdict", F.when(F.col("confidence").isNotNull(), "block").otherwise("allow"))
    return (
        found.join(decided, ["host", "path"], "left").join(blocked, "tokens", "left")
        .select("row", "host", "path", "rule", verdict.alias("verdict"), F.when(F.col("verdict").isNull(), F.col("confidence")).alias("confidence"))
    )
