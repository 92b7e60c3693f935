"""Main text of pages, and the pipeline against its stages run by hand."""

import zlib

import __spark_entry__ as E
import check
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from attrspark.llm import decontaminate, html_text
from attrspark.llm.queries import ORACLES, QUERIES

PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{x:"</p>"}</style></head><body><header><a href="/">Site</a></header>
<nav><ul><li>Menu<li>Other</ul></nav><!-- <p>gone</p> --><div class="cookie-notice">We use cookies</div><main><article>
<header><h1>Title &amp; more</h1></header><p>One  <b>bold</b>
line<br>break<p>Two &#233;&nbsp;x &copy 5 < 6<div class="ad">Buy</div><form><p>Mail</form><ul><li>a<li>b</ul>
<table><tr><td>1<td>2</table>tail<script>if (a<b) "</article>"</script></article><section id="comments"><article><p>First!</p></article></section>
</main><aside>side</aside><footer>foot</footer></body></html>"""
TEXT = "Title & more\nOne bold line break\nTwo é x © 5 < 6\na\nb\n1\n2\ntail"


def texts(spark, pages, **options):
    rows = [(*p, "x", 1, "y") for p in pages]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, host string, main int, text string")
    got = html_text.main_texts(frame.repartition(3), **options).collect()
    assert len(got) == len(pages) and all(r.n_chars == len(r.text) for r in got)
    return {r.page_id: r.text for r in got}


def test_article(spark):
    got = texts(spark, [(1, "http://h/1", PAGE), (2, None, None), (3, "", ""), (4, "x", "plain &lt;b&gt; text"), (5, "y", "<p>cut <b>off</b> &amp; tag <a hre"), (None, "z", "<p>n")])
    assert got == {1: TEXT, 2: "", 3: "", 4: "plain <b> text", 5: "cut off & tag", None: "n"}


def test_names_that_mark_boilerplate(spark):
    html = """<body class="nav-open"><div class="page has-sidebar"><div id="site-header">h</div><div class="entry-header"><h2>T</h2></div>
<div class="post"><p>text</p></div><div class="side widget_area">w</div><ol class="comment-list"><li>c</ol><div role="banner">r</div>
<p class="cookie-consent">k</p><div class="leading">l</div></div>"""
    assert texts(spark, [(1, "u", html)]) == {1: "T\ntext\nl"}


def test_templates_of_a_host_go(spark):
    block = "<div><div>Shop now</div><span>Hot offers</span></div><p>Every page says this</p>"
    pages = [(i, f"https://a.example:80/{i}", f"<body>{block}<div><p>text {i}</p></div></body>") for i in range(10)]
    pages += [(100 + i, f"https://b.example/{i}", f"<body>{block}<p>own {i}</p></body>") for i in range(3)]
    got = texts(spark, pages)
    assert {got[i] for i in range(10)} == {f"text {i}" for i in range(10)}
    assert got[100] == "Shop now\nHot offers\nEvery page says this\nown 0"


def test_copies_and_quotes_are_no_templates(spark):
    article = "<article><h1>Copied</h1><p>whole</p><p>article</p></article>"
    quoted = "<article><p>own %d</p><p>A passage that all quote</p></article>"
    loose = "<body><div><p>copied page</p></div></body>"
    pages = [(i, "http://h.example/", article) for i in range(20)] + [(50 + i, "http://h.example/", quoted % i) for i in range(20)]
    pages += [(100 + i, "http://k.example/", loose) for i in range(20)]
    got = texts(spark, pages)
    assert got[3] == "Copied\nwhole\narticle" and got[57] == "own 7\nA passage that all quote" and got[105] == "copied page"


def test_malformed_pages(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 10
    odd = "</p></div><li>x</li></ul><<p>y<p a='>'>z</P ><IMG src=q><b><i>w</b></i><textarea><p>no</textarea>end<script>never closed <p>"
    got = texts(spark, [(1, "u", deep), (2, "u", odd), (3, "u", "<!-- open <p>x"), (4, "u", "a&#xD800;b&#0;c&bogus;")])
    assert got[1] == "deep" and got[3] == "" and got[2].split("\n") == ["x", "<", "y", "z", "w", "end"]
    assert "&bogus;" in got[4]


def test_no_pages(spark):
    assert html_text.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_with_sql(spark, tables, name):
    verdict, rows, _ = check.compare(spark, check.oracle(tables), tables, name)
    assert verdict == "ok" and rows > 0


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 11)) and set(QUERIES) | {"pipeline"} <= set(E.queries())


def test_pipeline(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    kept = docs
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before, kept = kept, stage(spark, kept, tables)
        assert sorted(kept.columns) == sorted(docs.columns) and kept.count() < before.count()
        if number == 0:
            toxic = spark.read.parquet(f"{tables}/labels.parquet").where("toxic = 1")
            assert kept.join(toxic, "doc_id").count() < 0.7 * toxic.count()
    items = [decontaminate.plain(r.text) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    plain = {r.doc_id: decontaminate.plain(r.text) for r in kept.collect()}
    assert not any(item in text for text in plain.values() for item in items)
    packed = corpus_pipeline.run(spark, tables).collect()
    assert {r.doc_id for r in packed} == set(plain)
    assert max(r.offset + r.length for r in packed) <= 1024


def test_pipeline_keeps_odd_rows(spark, tmp_path):
    rows = [(1, None, "en", "s", None), (2, "", None, None, 0), (None, "x y", "en", "s", 3), (3, "item of the benchmark here", "en", "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "Item of the benchmark")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == {1, 2, None}
    assert [r.ids_crc32 for r in got if r.doc_id == 2] == [zlib.crc32(b"\x02\0\0\0")]
    assert spark.read.parquet(f"{tmp_path}/documents.parquet").select(F.count("*")).first()[0] == 4
