"""Main text of web pages, with the help of site style trees.

Each page is parsed to its blocks: elements that are not inline, and runs of text between their
borders. The pages of a host are laid over each other: a style node is a path of elements with
their classes and roles. Over all different pages of the host that have it, Spark counts

* its presentation styles (sequences of child elements); their entropy is its presentation
  importance;
* its contents (runs of text). A run that stands in c of m pages has the entropy log c / log m; one
  less that is the run's content importance, and the mean over the node's runs is the node's.

A node with k children has the composite importance (1 - 0.9^k) presentation + 0.9^k content. A run
goes if its own importance or its node's is below ``THRESHOLD``. Nodes of fewer than ``LEAST_PAGES`` pages
are too rare to tell and stay.

The tree decides on the runs of every page. An article or main element that a page declares says where its text is:
runs outside go, and inside a run goes only with its node, since a paragraph of an article may stand on many pages,
while a node that says the same on all of them (a request to subscribe under each article) is no part of it.
Equal articles of a host count once, whatever stands around them.

Words of adverts and menus may differ on every page, as those of articles do, and their importance is then as high. So what
a page declares is checked as well: runs in menus, headers, footers, sidebars, forms, notices, adverts and comments (by
element, role, class or id) count in the tree, but never stay.

Hot hosts: what is counted is keyed by host, node and run, summed before each shuffle. Only narrow
rows are counted and looked up; texts are shuffled once, and only of pages that lose a run.

A null page has no text, a null url has the host of the empty text. Repeated rows come out repeated;
equal pages of a host count once in its tree, too. Tags that nobody closes end with the element around
them. Pages of any length are parsed whole, one at a time. An empty table gives an empty one.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from callweave.llm.common import chosen_rows, one_array, stages, worker_cache

THRESHOLD, LEAST_PAGES, DECAY = 0.3, 3, 0.9

INLINE = frozenset(
    "a abbr acronym b bdi bdo big br center cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text that is never shown.
RAW = frozenset("script style template textarea title iframe noembed noframes noscript select svg object canvas audio video".split())
#: An opening tag ends an open element of the same group, unless one of the borders lies between them.
ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
BORDERS = frozenset("table ul ol dl menu div section article main aside nav header footer form blockquote body".split())
#: Blocks that a paragraph cannot hold.
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre "
    "section table ul".split()
)

NOISE_TAGS = frozenset("nav footer aside form menu dialog button".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar widget widgets nav navbar navigation "
    "menu breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices notification newsletter subscribe subscription signup "
    "popup modal overlay social share sharing related recommended comment comments reply replies respond disqus pagination pager toolbar "
    "login search masthead".split()
)
#: Classes such as with-sidebar or no-menu belong to the layout around.
LAYOUT_WORDS = frozenset("has with no without layout wrapper container".split())
#: Noise outside an article only: an article has its title in a header of its own.
HEADER_WORDS = frozenset({"header"})
CONTENT_TAGS, CONTENT_ROLES = frozenset({"article", "main"}), frozenset({"article", "main"})

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<more>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*(?:>|\Z))", re.S
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
WATCHED = re.compile(r"(?i)class|id|role|hidden|style|itemprop")

NOISE, DECLARED, OPEN = 0, 1, 2
#: In place of a run's hash: what counts is the importance of its node.
BY_NODE = 0


def _attributes(more: str) -> dict[str, str]:
    found = {}
    for name, value in ATTRIBUTE.findall(more.rstrip("/>")):
        found.setdefault(name.lower(), entities.unescape(value.strip("\"'")))
    return found


def _kind(tag: str, more: str) -> tuple[str, int, bool]:
    """Label of an element in its style node, what it declares, and whether it is a header."""
    noise, declared, header, label = tag in NOISE_TAGS, tag in CONTENT_TAGS, tag == "header", tag
    if WATCHED.search(more):
        at = _attributes(more)
        names = f"{at.get('class', '')} {at.get('id', '')}"
        words = {w.lower() for w in WORD.findall(names)}
        role = at.get("role", "").lower().strip()
        hidden = "hidden" in at or at.get("aria-hidden", "").lower() == "true" or "display:none" in at.get("style", "").replace(" ", "").lower()
        noise = noise or hidden or role in NOISE_ROLES or bool(words & NOISE_WORDS and not words & LAYOUT_WORDS)
        header = header or bool(words & HEADER_WORDS)
        declared = declared or role in CONTENT_ROLES or at.get("itemprop", "").lower() == "articlebody"
        label = f"{tag}.{at.get('class', '')}.{role}"
    return label, NOISE if noise else DECLARED if declared else OPEN, header


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


class Page:
    """Style nodes and runs of one page."""

    def __init__(self, source: str, kinds: dict, keys: dict):
        self.kinds, self.keys = kinds, keys
        self.runs: list[tuple[int, str, int]] = []  # style node, text, what is declared
        self.nodes: list[tuple[int, int, int]] = []  # style node, presentation style, children
        self.text: list[str] = []
        # Open elements: tag, style node, state, labels of children.
        self.open: list[list] = [["", 0, OPEN, []]]
        self._parse(source)
        while self.open:
            self._close()

    def _key(self, parent: int, label: str) -> int:
        known = self.keys.get((parent, label))
        if known is None:
            if len(self.keys) > 100_000:
                self.keys.clear()
            known = self.keys[parent, label] = _hash(f"{parent}/{label}")
        return known

    def _flush(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            self.text = []
            if text:
                _, key, state, _ = self.open[-1]
                self.runs.append((key, text, state))

    def _close(self) -> None:
        self._flush()
        _, key, _, children = self.open.pop()
        self.nodes.append((key, _hash(" ".join(children)), len(children)))

    def _close_to(self, tags, borders=frozenset()) -> None:
        """Close the innermost open element of these tags, and all in it; not over a border."""
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i][0]
            if tag in tags:
                while len(self.open) > i:
                    self._close()
                return
            if tag in borders:
                return

    def _parse(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            token = TOKEN.search(source, at)
            if token is None:
                break
            if token.start() > at:
                self._say(source[at : token.start()])
            at = token.end()
            tag = token["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            if token["end"]:
                if tag == "br" or tag not in INLINE or any(o[0] == tag for o in self.open):
                    self._flush()
                    self._close_to({tag})
                continue
            if tag in RAW:
                if not token["more"].endswith("/>"):
                    end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(source, at)
                    at = end.end() if end else size
                if tag not in INLINE:
                    self._flush()
                continue
            if tag in VOID:
                if tag == "br":
                    self.text.append(" ")
                elif tag not in INLINE:
                    self._flush()
                continue
            self._start(tag, token["more"])
        if at < size:
            self._say(source[at:])

    def _say(self, text: str) -> None:
        self.text.append(entities.unescape(text) if "&" in text else text)

    def _start(self, tag: str, more: str) -> None:
        kind = self.kinds.get((tag, more))
        if kind is None:
            kind = _kind(tag, more)
            if len(more) < 200 and len(self.kinds) < 100_000:
                self.kinds[tag, more] = kind
        label, state, header = kind
        if tag in INLINE and state != NOISE:
            return
        self._flush()
        if tag in ENDS_P:
            self._close_to({"p"}, BORDERS)
        if tag in ENDS:
            self._close_to(ENDS[tag], BORDERS)
        parent = self.open[-1]
        if parent[2] == NOISE or (header and parent[2] != DECLARED and tag not in ("html", "body", "article", "main")):
            state = NOISE
        elif state == OPEN or (state == NOISE and tag in ("html", "body")):
            state = parent[2]
        parent[3].append(label)
        self.open.append([tag, self._key(parent[1], label), state, []])


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next / ? or #, lower-cased; else empty."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def parsed(pages: DataFrame) -> DataFrame:
    """``row``, ``host`` and ``html`` in. Out: row, host; the ``runs`` on which the tree decides, of an article if one is
    declared (with feature 0: by the node alone); for the tree, ``content`` (a hash of the article's runs, or else of all) and
    what the page has ``seen``."""
    row = pages.schema["row"]
    seen = pa.list_(pa.struct([("key", pa.int64()), ("kind", pa.int8()), ("feature", pa.int64()), ("children", pa.int32())]))
    runs = pa.list_(pa.struct([("key", pa.int64()), ("feature", pa.int64()), ("text", pa.string())]))

    def parse(batches):
        cache = worker_cache()
        kinds, keys = cache.setdefault("html kinds", {}), cache.setdefault("html keys", {})
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                left, contents, noted = [], [], []
                for source in one_array(part.column("html")):
                    page = Page(source.as_py() or "", kinds, keys)
                    hashed = [(key, _hash(text)) for key, text, _ in page.runs]
                    article = any(state == DECLARED for _, _, state in page.runs)
                    wanted = DECLARED if article else OPEN
                    left.append([
                        {"key": k, "feature": BY_NODE if article else f, "text": text}
                        for (k, f), (_, text, state) in zip(hashed, page.runs) if state == wanted
                    ])
                    told = [h for h, (_, _, state) in zip(hashed, page.runs) if state == wanted or not article]
                    contents.append(_hash(" ".join(map(str, told))))
                    everything = {(k, 0, 0, 0) for k, _, _ in page.nodes} | {(k, 1, style, n) for k, style, n in page.nodes}
                    everything |= {(k, 2, f, 0) for k, f in hashed}
                    noted.append([{"key": k, "kind": i, "feature": f, "children": n} for k, i, f, n in everything])
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("host"), pa.array(left, runs), pa.array(contents, pa.int64()), pa.array(noted, seen)],
                    names=["row", "host", "runs", "content", "seen"],
                )

    return pages.select("row", "host", "html").mapInArrow(
        parse,
        f"row {row.dataType.simpleString()}, host string, runs array<struct<key:bigint,feature:bigint,text:string>>, "
        "content long, seen array<struct<key:bigint,kind:tinyint,feature:bigint,children:int>>",
    )


def style_trees(kept, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of parsed pages: ``importance`` of the style nodes (``host``, ``key``) that have text, with the number of
    different ``pages``; and the number of pages ``c`` of each of their runs (``feature``)."""
    seen = pages.select("host", "content", F.explode("seen").alias("s")).select("host", "content", "s.*").distinct()
    counted = seen.groupBy("host", "key", "kind", "feature").agg(F.count("*").alias("c"), F.max("children").alias("children"))
    counted = kept.keep(counted, "counted")

    def of(kind: int, value: Column) -> Column:
        return F.sum(F.when(F.col("kind") == kind, value))

    c = F.col("c")
    sums = counted.groupBy("host", "key").agg(
        of(0, c).alias("pages"), of(1, c).alias("styles"), of(1, c * F.ln(c)).alias("style_logs"),
        of(1, c * F.col("children")).alias("children"), of(2, F.lit(1)).alias("runs"), of(2, F.ln(c)).alias("run_logs"),
    )
    of_content = F.lit(1.0) - F.col("run_logs") / (F.col("runs") * F.ln("pages"))
    of_styles = (F.ln("styles") - F.col("style_logs") / F.col("styles")) / F.ln("styles")
    share = F.pow(F.lit(DECAY), F.col("children") / F.col("styles"))
    nodes = sums.where(f"runs > 0 and pages >= {LEAST_PAGES}").select(
        "host", "key", "pages", ((F.lit(1.0) - share) * of_styles + share * of_content).alias("importance")
    )
    return kept.keep(nodes, "nodes"), counted.where("kind = 2").select("host", "key", "feature", "c")


def extracted(pages: DataFrame, html: str = "html", url: str = "url", carry: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Every row as column ``row`` (or the columns ``carry`` of it) and its main ``text``, empty if none."""
    kept = stages(pages.sparkSession)
    given = pages.select(
        F.struct(*(carry or ["*"])).alias("row"), host_of(F.col(url).cast("string")).alias("host"), F.col(html).cast("string").alias("html")
    )
    known = kept.keep(parsed(given).withColumn("number", F.monotonically_increasing_id()), "parsed")
    nodes, runs = style_trees(kept, known)
    own = F.lit(1.0) - F.ln("c") / F.ln("pages")
    low = runs.join(nodes, ["host", "key"]).where(F.least(own, "importance") < threshold).select("host", "key", "feature")
    low = kept.keep(low.unionByName(nodes.where(F.col("importance") < threshold).select("host", "key", F.lit(BY_NODE).cast("long").alias("feature"))), "low")

    def place(run: Column) -> Column:
        return F.struct(run["key"].alias("key"), run["feature"].alias("feature"))

    places = known.select("number", "host", F.explode(F.array_distinct(F.transform("runs", place))).alias("place"))
    places = places.select("number", "host", "place.*")
    gone = places.join(low, ["host", "key", "feature"]).groupBy("number").agg(F.collect_set(F.struct("key", "feature")).alias("gone"))
    gone = kept.keep(gone, "gone")
    # Pages that lose nothing are read where they lie.
    wide = known.select(F.struct("row", "number", "runs").alias("row"), "number")
    numbers, spark = gone.select("number"), pages.sparkSession
    losing = chosen_rows(stages(spark), wide, numbers, True).select("row.*").join(gone, "number")
    losing = losing.withColumn("runs", F.filter("runs", lambda run: ~F.array_contains("gone", place(run))))
    whole = chosen_rows(stages(spark), wide, numbers, False).select("row.*")
    left = whole.unionByName(losing.drop("gone"))
    return left.select("row", F.array_join(F.transform("runs", lambda r: r["text"]), " ").alias("text"))
