"""Main text: what pages declare, what the site style tree decides, and hard rows."""

import re

import pytest
from pyspark.sql import functions as F

from callweave.llm import html_extraction as hx

PAGES = "page_id long, url string, html string"


def texts(spark, pages, **more):
    df = spark.createDataFrame(pages, PAGES)
    return {r.page_id: r.text for r in hx.extracted(df, carry=["page_id"], **more).select("row.page_id", "text").collect()}


def plain_page(i, middle):
    """A page without any element or class that declares something; but for the middle all pages are alike."""
    return (
        f"<html><body><div><div><ul><li><a href='/'>Home</a><li><a href='/about'>About us</a></ul></div><div class='x{i % 2}'>{middle}</div>"
        "<div>Copyright of the site</div></div></body></html>"
    )


def test_tree_removes_what_the_pages_of_a_host_share(spark):
    middle = [f"<p>Story {i} has words of its own: w{i * 7}.</p><p>Second paragraph {i}.</p><p>Write to the editor.</p>" for i in range(12)]
    pages = [(i, f"https://News.example.org/a/{i}", plain_page(i, m)) for i, m in enumerate(middle)]
    # Another host says the same things once: nothing to compare them with.
    pages.append((99, "https://other.example.org/", plain_page(0, "<p>Alone.</p>")))
    got = texts(spark, pages)
    for i in range(12):
        assert got[i] == f"Story {i} has words of its own: w{i * 7}. Second paragraph {i}."
    assert got[99] == "Home About us Alone. Copyright of the site"


def test_tree_decides_inside_declared_articles(spark):
    """What every article of a host says at the same place goes; a paragraph that many articles have stays, as do equal articles."""
    end = "<div class='end'><p>Write to the editor.</p></div>"
    pages = [(i, "https://a.example/", f"<nav>M{i}</nav><article><h1>Title {i}</h1><p>Story {i}.</p><p>As ever.</p>{end}</article>") for i in range(9)]
    pages += [(20 + i, "https://b.example/", f"<nav>M{i}</nav><article><h1>One</h1><p>Same story.</p></article>") for i in range(9)]
    pages += [(40, "https://c.example/", f"<article><p>Alone.</p>{end}</article>")]
    got = texts(spark, pages)
    assert all(got[i] == f"Title {i} Story {i}. As ever." for i in range(9))
    assert all(got[20 + i] == "One Same story." for i in range(9))
    assert got[40] == "Alone. Write to the editor."


def test_copies_of_a_page_do_not_make_its_text_common(spark):
    pages = [(i, "https://a.example/x", plain_page(0, "<p>The same story on many addresses.</p>")) for i in range(40)]
    pages += [(100 + i, f"https://a.example/{i}", plain_page(0, f"<p>Another story {i}.</p>")) for i in range(30)]
    got = texts(spark, pages)
    assert {got[i] for i in range(40)} == {"The same story on many addresses."}
    assert got[105] == "Another story 5."


def test_importance_equals_brute_force(spark):
    """Counts of a small site by hand: entropy of runs and of child sequences."""
    import math

    middle = ["<p>a</p>", "<p>a</p><p>b</p>", "<p>c</p><p>d</p>", "<p>e</p>"]
    df = spark.createDataFrame([(i, "http://h/", f"<div>{m}</div>") for i, m in enumerate(middle)], PAGES)
    given = df.select(F.struct("page_id").alias("row"), hx.host_of(F.col("url")).alias("host"), "html")
    nodes, runs = hx.style_trees(hx.stages(spark), hx.parsed(given))
    found = nodes.collect()
    assert len(found) == 1 and found[0].pages == 4  # only p has text
    # Runs a (2 of 4 pages), b, c, d, e (1 of 4): p has no children, so all is content.
    assert found[0].importance == pytest.approx(1 - (math.log(2) / math.log(4)) / 5)
    assert sorted(r.c for r in runs.collect()) == [1, 1, 1, 1, 2]


def test_declared_parts(spark):
    page = """<!doctype html><html><head><title>No</title><script>var a = "</p><article>";</script><style>p{}</style></head>
      <body class="has-sidebar"><header><h1>Site</h1></header><nav>Menu</nav><div class="cookie-notice">We use cookies</div>
      <main><article><header><h1>Tom &amp; Jerry</h1></header><p>One<br>two <b>th</b>ree &lt;4&gt; &#233; 5 < 6<p>Next<!-- not <p>this</p> -->
      <div class="ad">Buy</div><aside>Side</aside><form><input value=x>Send</form><ul><li>x<li>y</ul><table><tr><td>1<td>2</table>
      <section id="comments"><article>I disagree</article></section><p hidden>Secret</p></article></main>
      <div>Elsewhere</div><footer>&copy; 2024</footer></body></html>"""
    assert texts(spark, [(1, "http://a/", page)])[1] == "Tom & Jerry One two three <4> é 5 < 6 Next x y 1 2"


def test_hard_rows(spark):
    long = "<article>" + "<p>word</p>" * 30_000 + "</article>"
    cases = {
        1: (None, ""), 2: ("", ""), 3: ("just text", "just text"), 4: ("<p>open", "open"), 5: ("a<b", "a"), 6: ("<!-- open <p>x", ""),
        7: ("<script>alert(1)", ""), 8: ("<article></article><p>x</p>", "x"), 9: ("<div class=\"a>b\" title='<p>'>t</div>", "t"),
        10: ("</div></p></article>x", "x"), 11: ("<p>a &am</p><p>&amp b &nosuch;</p>", "a &am & b &nosuch;"), 12: (long, " ".join(["word"] * 30_000)),
        13: ("<div>" * 3_000 + "deep", "deep"), 14: ("<article><p>a\n b\t c</article>", "a b c"),
    }
    rows = [(i, None if i % 2 else "no host", source) for i, (source, _) in cases.items()]
    rows += [(3, None, "just text"), (None, None, None)]
    df = spark.createDataFrame(rows, PAGES).withColumns({"row": F.lit("r"), "host": F.lit(1), "text": F.lit("t"), "number": F.lit(0), "runs": F.lit(None).cast("int")})
    got = hx.extracted(df).select("row.*", F.col("text").alias("found")).collect()
    assert len(got) == len(rows) and got[0].row == "r"
    for r in got:
        assert r.found == (cases[r.page_id][1] if r.page_id else ""), r.page_id
    assert hx.extracted(df.limit(0)).collect() == []


def test_text_of_given_pages_is_the_article(spark):
    import html

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in hx.extracted(pages, carry=["page_id"]).select("row.page_id", "text").collect()}
    for r in pages.collect():
        inner = re.search(r"(?s)<article>(.*)</article>", r.html)[1]
        inner = re.sub(r"</?b>", "", re.sub(r"<(?:/?p|/?h1|br)>", " ", inner))
        assert got[r.page_id] == " ".join(html.unescape(inner).split())
