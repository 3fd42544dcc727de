"""Page extraction: names inside articles, long and broken markup, many wrappers, whole tables."""

import re
import time

import pytest
from pyspark.sql import functions as F

from orefold.llm import wrappers
from orefold.llm.queries import QUERIES


def page(body):
    return f"<html><head><title>t</title></head><body><nav><a>Home</a></nav>{body}<footer>&copy; x</footer></body></html>"


def extracted(spark, bodies, host="n.example"):
    rows = [(i, f"http://{host}/{i}", page(b)) for i, b in enumerate(bodies)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as w_text", "1 as w_host", "2 as w_page")
    got = {r.page_id: r.text for r in wrappers.extract(frame.withColumnRenamed("w_text", "other"), ["page_id", "other"]).select("page_id", F.col("w_text").alias("text")).collect()}
    return [got[i] for i in range(len(bodies))]


def test_blocks_of_an_article_stay_whatever_they_are_called(spark):
    def body(i):
        return f"<article><p>first {i}</p><p class=banner-text>said {i}</p><h2 id=search>Search {i}</h2><blockquote class=alert>mind {i}</blockquote><div class=widget-body>kept {i}</div><div class=ad>buy {i}</div><aside>no {i}</aside><p>last {i}</p></article>"

    want = [f"first {i}\nsaid {i}\nSearch {i}\nmind {i}\nkept {i}\nlast {i}" for i in range(5)]
    assert extracted(spark, [body(i) for i in range(5)]) == want
    assert extracted(spark, [body(7)]) == ["first 7\nsaid 7\nSearch 7\nmind 7\nkept 7\nlast 7"]


def test_named_blocks_that_are_the_same_everywhere_go(spark):
    bodies = [f"<article><p>text {i}</p><p class=share-line>Share this</p><div class=newsletter-box>Get our letter</div><p>end {i}</p></article>" for i in range(5)]
    assert extracted(spark, bodies) == [f"text {i}\nend {i}" for i in range(5)]
    # two pages are too few to tell
    assert extracted(spark, bodies[:2])[0] == "text 0\nShare this\nGet our letter\nend 0"


def test_a_closing_line_of_all_articles_stays(spark):
    bodies = [f"<article><p>text {i} of its own</p><p>Thank you.</p></article>" for i in range(6)]
    assert extracted(spark, bodies) == [f"text {i} of its own\nThank you." for i in range(6)]


def test_template_text_goes_only_at_its_place(spark):
    # "Home" is the template's in a list beside the text; the same words in the text of one page are not
    def body(i, text):
        return f"<div class=page><div class=text><p>{text} and more {i} of what only this page has</p>{'<p>Home</p>' if i == 3 else ''}</div></div>"

    got = extracted(spark, [f"<div class=links><ul><li>Home</li></ul></div>{body(i, 'words' * (i + 2))}" for i in range(6)])
    assert got[3].endswith("\nHome") and not any("Home" in g for i, g in enumerate(got) if i != 3)


@pytest.mark.parametrize("piece", ['<a "', "<div>", "<div", '<a ="x', "<!", "<p>", "</div>", "<li><ul>", "<a '\"", "<script>", "<table><tr><td>", '"<a >', "<article>"])
def test_time_grows_with_the_length_alone(piece):
    def seconds(n):
        started = time.perf_counter()
        wrappers.parse(piece * n + "<p>end")
        return time.perf_counter() - started

    seconds(1000)
    short, long = min(seconds(20_000) for _ in range(3)), min(seconds(160_000) for _ in range(2))
    assert long < 8 * short * 4 + 0.2  # quadratic would be 64 times


def test_broken_and_long_pages_end(spark):
    bodies = ["<div>" * 200_000 + "<p>deep</p>", '<a "' * 200_000, "<article><p>" + "word " * 1_000_000 + "</p></article>", "<article><p>x</p>" + "</div>" * 100_000 + "</article>"]
    got = extracted(spark, bodies, "odd.example")
    assert got[0].startswith("deep") and got[2] == ("word " * 1_000_000).strip() and got[3] == "x"


def tokens_by_pattern(text):
    """Well-formed tags by a pattern that needs no care for time."""
    pattern = re.compile(r"<!--.*?-->|<(?:script|style)\b[^>]*>.*?</(?:script|style)\s*>|<[!?][^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL)
    return [(m.start(), m.end(), bool(m[1]), (m[2] or "").lower(), m[3] or "") for m in pattern.finditer(text)]


def test_tokens_of_well_formed_markup():
    text = "a<b x='>' y=\"<i>\">t</b ><!-- <p> --><script>if (a<b) '</p>'</script><br/><!DOCTYPE x>< p><3 <img src=a>"
    assert [t for t in wrappers._tokens(text)] == tokens_by_pattern(text)


def test_many_wrappers_meet_pages_by_host(spark, small, monkeypatch):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    want = {tuple(r) for r in wrappers.extract(pages, ["page_id", "url"]).collect()}
    monkeypatch.setattr(wrappers, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(wrappers, "GROUP_PAGES", 3)
    one_host = pages.withColumn("url", F.when(F.col("page_id") % 3 == 0, F.lit("http://same.example/")).otherwise(F.col("url")))
    assert {tuple(r) for r in wrappers.extract(pages, ["page_id", "url"]).collect()} == want
    got = wrappers.extract(one_host, ["page_id"])
    assert got.count() == pages.count() and {r.w_text for r in got.collect()} == {t[2] for t in want}
    assert wrappers.extract(pages.where("false"), ["page_id"]).count() == 0


def blocks_of(text):
    """What a page of the test tables says in its article: its blocks by a plain pattern."""
    inner = re.search(r"<article>(.*?)</article>", text, re.DOTALL)[1]
    import html

    parts = re.split(r"</?(?:p|h[1-6]|article)>", inner)
    clean = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", p)))).strip() for p in parts)
    return "\n".join(c for c in clean if c)


def test_whole_table_against_plain_patterns(spark, medium):
    rows = {r.page_id: r.html for r in spark.read.parquet(f"{medium}/pages.parquet").collect()}
    got = {r.page_id: r.text for r in QUERIES["op2_html_extraction"][0](spark, medium).collect()}
    assert got == {i: blocks_of(h) for i, h in rows.items()}


def test_whole_table_without_declared_articles(spark, medium):
    """The same pages without their ``article`` tags: the wrapper has to find the place itself."""
    pages = spark.read.parquet(f"{medium}/pages.parquet")
    bare = pages.withColumn("html", F.regexp_replace("html", "</?article>", ""))
    got = {r.page_id: r.w_text for r in wrappers.extract(bare, ["page_id"]).collect()}
    want = {r.page_id: blocks_of(r.html) for r in pages.collect()}
    lost = [i for i in want if not set(want[i].split("\n")) <= set(got[i].split("\n"))]
    assert len(lost) <= 0.01 * len(want), (len(lost), len(want))
