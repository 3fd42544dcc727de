"""Page extraction, the quality classifier, mixing, and the pipeline."""

import html
import json
import re

import numpy as np
import pytest
from plain import base_pii
from pyspark.sql import functions as F

import corpus_pipeline
from orefold.llm import mixing, quality_gam, wrappers
from orefold.llm.queries import QUERIES


def page(body, top="<nav><a>Home</a></nav>", bottom="<footer>&copy; x</footer>"):
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a='</p>'</script></head><body>{top}{body}{bottom}</body></html>"


PAGES = [
    ("http://a.example/1", page("<article><h1>A &amp; B</h1><p>One <b>two</b>\n three</p><p>Four &#233; &nbsp; five</article>"), "A & B\nOne two three\nFour é five"),
    ("http://a.example/2", page("<article><h1>Other</h1><p>x<p>y<div class='ad'>buy</div><p>z</p></article>"), "Other\nx\ny\nz"),
    ("http://b.example/1", page("<div id=main class=content><p>first text of one page, long enough</p><div class=sidebar>side</div></div><div id=comments><p>great!</p></div>"), "first text of one page, long enough"),
    ("http://b.example/2", page("<div id=main class=content><p>second text that differs from it</p><p>Share this page</p></div>"), "second text that differs from it\nShare this page"),
    ("http://c.example/1", page("<main><form><p>search</p><input></form><ul><li>i<li>j</ul><table><tr><td>k<td>l</table></main>", top="<header><p>top</p></header>"), "i\nj\nk\nl"),
    ("http://d.example", "plain text only", "plain text only"),
    ("http://e.example", None, ""),
    ("http://e.example", "", ""),
    (None, page("<article><p>no url</p></article>"), "no url"),
    ("not a url", page("<article><!-- c --><p>a<br>b</p><aside><p>no</p></aside><p hidden>no</p></article>"), "a b"),
    ("http://f.example", page("<div class='has-sidebar'><article><header><h1>kept</h1></header><p>in</p></article></div>"), "kept\nin"),
    ("http://g.example", "<div>" * 3000 + "<p>deep</p>" + "</div>" * 3000, "deep"),
    ("http://h.example", "<article><p>cut off <b>here", "cut off here"),
]


def test_pages(spark):
    frame = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(PAGES)], "page_id long, url string, html string")
    got = {r.page_id: r.w_text for r in wrappers.extract(frame.unionAll(frame.where("page_id = 0")), ["page_id"]).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(PAGES)}
    assert wrappers.extract(frame.where("false"), ["page_id"]).count() == 0


def test_template_text_goes_where_no_element_declares_the_article(spark):
    rows = [(i, "http://t.example/", page(f"<div class=c{i}><div class=body><p>text number {i} is its own {'x' * i}</p><p>Like us everywhere</p></div></div>")) for i in range(6)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.w_text for r in wrappers.extract(frame, ["page_id"]).collect()}
    assert got == {f"text number {i} is its own {'x' * i}".strip() for i in range(6)}


@pytest.mark.parametrize("around", [
    "<form id=aspnetForm><div>{}</div></form>", "<form id=aspnetForm><article>{}</article></form>", "<div class='content sidebar-right'>{}</div>", "<div class=has-sidebar>{}</div>",
    "<div class=with-header>{}</div>", "<div class=social-post>{}</div>", "<div class=promo-story>{}</div>", "<table><tr><td class=content-menu-left>{}</td></tr></table>", "<div class=sidebar>{}</div>",
])
def test_articles_in_elements_with_names_of_side_matter(around):
    texts = [f"the text of page {i} is long enough to be most of what differs" for i in "abcd"]
    pages = [page(around.format(f"<p>{t}</p><div class=ad>buy {t[:20]}</div>")) for t in texts]
    folded = None
    for one in (wrappers.of_page(wrappers.parse(p)) for p in pages):
        folded = one if folded is None else wrappers.fold(folded, one)
    got = [wrappers.main_text(p, json.dumps(folded)) for p in pages]
    assert all(t in g for t, g in zip(texts, got))
    if around != "<div class=sidebar>{}</div>":  # read without names, the advert stays
        assert got == texts


def test_wrapper_is_union_free():
    def wrapper(body):
        return wrappers.of_page(wrappers.parse(body))

    folded = wrappers.fold(wrapper("<ul><li>a<li>b</ul><p>same</p><h2>x</h2><p>1</p><h2>y</h2><p>2</p>"), wrapper("<ul><li>c</ul><div>new</div><p>same</p>"))
    text = wrappers.expression(folded)
    assert "<li>#slot</>+" in text and "<div>#text</>?" in text and "(<h2>#slot</> <p>#slot</>)*" in text.replace("?", "*").replace("+", "*") or "<div>#text</>?" in text
    again = wrappers.fold(folded, json.loads(json.dumps(folded)))
    assert wrappers.expression(again) == text


def test_pages_by_rounds(spark, monkeypatch, small):
    """Partial wrappers of many tasks lead to the same texts."""
    pages = spark.read.parquet(f"{small}/pages.parquet")
    once = {r.page_id: r.w_text for r in wrappers.extract(pages.coalesce(1), ["page_id"]).collect()}
    monkeypatch.setattr(wrappers, "FAN_IN", 2)
    assert {r.page_id: r.w_text for r in wrappers.extract(pages.repartition(9), ["page_id"]).collect()} == once


def test_pages_whole_table(spark, medium):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{medium}/pages.parquet").collect()}
    got = QUERIES["op2_html_extraction"][0](spark, medium).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(filter(None, blocks)) and r.n_chars == len(r.text)


def test_classifier_whole_table(spark, medium):
    got = {r.doc_id: r for r in QUERIES["op5_quality_classifier"][0](spark, medium).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{medium}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{medium}/documents.parquet").count()
    held = [(got[i].score, q) for i, q in labels.items() if i in got and got[i].held_out]
    good, bad = (np.array([s for s, q in held if q == v]) for v in (1, 0))
    assert (good[:, None] > bad[None, :]).mean() > 0.95
    assert np.mean([(s >= 0.5) == q for s, q in held]) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())


def test_classifier_never_sees_held_out_labels(spark, medium):
    docs, labels = (spark.read.parquet(f"{medium}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(quality_gam.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality_gam.fit(docs, labels), quality_gam.fit(docs, turned)
    assert a.base == b.base and all((x == y).all() for x, y in zip(a.tables, b.tables))


def test_classifier_edges(spark, odd_documents, no_documents):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality_gam.fit(odd_documents, none)
    got = quality_gam.scored(odd_documents, model, [F.col("doc_id")], F.col("text")).collect()
    assert len(got) == odd_documents.count() and {r.g_score for r in got} == {0.5}
    both = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(3, 0), (None, 1)], "doc_id long, quality int")
    model = quality_gam.fit(odd_documents, both)
    scores = [r.g_score for r in quality_gam.scored(odd_documents, model, [F.col("doc_id")], F.col("text")).collect()]
    assert all(0 <= s <= 1 for s in scores)
    assert quality_gam.scored(no_documents, model, [F.col("doc_id")], F.col("text")).count() == 0


def test_pairs_are_learnt():
    """A class that only two features together tell."""
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.train(x, y)
    assert (0, 1) in model.pairs
    assert ((model.score(x) > 0.5) == y).mean() > 0.95


def levels(sizes, shares=(1, 2, 3), most=3.0):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {n: shares[i % len(shares)] for i, n in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        open_ = [n for n in names if n not in full]
        left = total - sum(full.values())
        share = {n: left * weight[n] / sum(weight[m] for m in open_) for n in open_}
        over = [n for n in open_ if share[n] > most * sizes[n]]
        if not over:
            return full | share
        full |= {n: most * sizes[n] for n in over}


def check_mix(docs, mix):
    text = {r.doc_id: r for r in docs.collect()}
    sizes, taken, target = {}, {}, {}
    for r in mix:
        source = text[r.doc_id].source
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", text[r.doc_id].text or ""))
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        sizes[source] = sizes.get(source, 0) + r.size
        taken[source] = taken.get(source, 0) + r.taken
        target[source] = r.target
    want = levels(sizes)
    for s, n in sizes.items():
        assert target[s] == pytest.approx(want[s]) and all(r.source_size == sizes[text[r.doc_id].source] for r in mix)
        smallest = min([r.size for r in mix if text[r.doc_id].source == s and r.size] or [0])
        assert abs(taken[s] - target[s]) <= max(0.05 * target[s], 3 * smallest, 50)


def test_mixing_whole_table(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    mix = QUERIES["op7_mixing"][0](spark, medium).collect()
    assert len(mix) == docs.count()
    check_mix(docs, mix)
    assert sorted(mix) == sorted(QUERIES["op7_mixing"][0](spark, medium).collect())


def test_mixing_hot_source_and_limits(spark):
    rows = [(i, "w " * (i % 40), "big") for i in range(900)] + [(i, "one two three", "tiny") for i in range(900, 903)] + [(i, "x " * 30, None) for i in range(903, 950)] + [(950, None, "empty")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    key = mixing.row_key(F.col("doc_id"), F.col("source"), F.col("text"))
    mix = mixing.mixture(docs, mixing.word_count(F.col("text")), F.col("source"), key, [F.col("doc_id")])
    check_mix(docs, mix.selectExpr("doc_id", "m_size as size", "m_total as source_size", "m_target as target", "m_copies * m_size as taken").collect())


def test_mixing_weights(spark):
    """With a weight, documents are taken in proportion to it."""
    docs = spark.createDataFrame([(i, "a " * 10, "s", float(1 + (i % 2) * 3)) for i in range(2000)] + [(i, "b " * 10, "t", 1.0) for i in range(2000, 3000)], "doc_id long, text string, source string, w double")
    key = mixing.row_key(F.col("doc_id"))
    mix = mixing.mixture(docs, mixing.word_count(F.col("text")), F.col("source"), key, [F.col("doc_id"), F.col("w")], weight=F.col("w"))
    got = {(r.m_source, r.w): r.n for r in mix.groupBy("m_source", "w").agg(F.avg("m_copies").alias("n")).collect()}
    assert got["s", 4.0] / got["s", 1.0] == pytest.approx(4, rel=0.15)


def test_mixing_edges(spark, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        key = mixing.row_key(F.col("doc_id"), F.col("text"))
        mix = mixing.mixture(docs, mixing.word_count(F.col("text")), F.col("source"), key, [F.col("doc_id"), F.col("text"), F.col("size")])
        rows = mix.collect()
        assert len(rows) == docs.count()
        assert all(r.m_copies <= 3 and (r.m_size or not r.m_copies) for r in rows)


def test_pipeline(spark, medium, tmp_path):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    names, counts = docs.columns, [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, medium)
        assert k == 4 or out.columns == names
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] > counts[3] == counts[4] == counts[5]
    last = sorted(docs.collect())
    assert last == sorted(corpus_pipeline.run(spark, medium).collect())
    check = spark.read.parquet(f"{tmp_path}/3")
    assert not [r for r in check.collect() if base_pii(r.text)]
    assert check.where(F.length("text") != F.col("n_chars")).count() == 0


def test_pipeline_edges(spark, medium, odd_documents, no_documents, tmp_path):
    for n, frame in enumerate((odd_documents, no_documents)):
        docs = frame
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, frame if k in (1, 3, 4) else docs, medium)  # also with rows the first stages would drop
            out.write.parquet(f"{tmp_path}/{n}-{k}")
            docs = spark.read.parquet(f"{tmp_path}/{n}-{k}") if k < 4 else docs
