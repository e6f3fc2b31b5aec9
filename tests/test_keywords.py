"""P-5 keyword chain: ties, stop words, entities, null pages."""

from metroframe.functions.text import html_to_text
from metroframe.plans.keywords import keyword_columns, top_keywords


def test_top_three_ties_by_first_appearance(spark):
    html = ("<html><head><title>축제</title><style>p{x}</style><script>var 문화='금';</script></head>"
            "<body><!-- 주석 --><p>공연 전시 공연 전시 음악 문화 문화 문화 미술</p><p>미술 &amp; 음악</p></body></html>")
    pages = spark.createDataFrame([(1, html), (2, None), (3, "<p>하나</p>")], "id long, html string")
    top = top_keywords(pages, "id", "html")
    got = sorted((r["id"], r["rank"], r["word"], r["n"]) for r in top.collect())
    # 문화 and 축제 are stop words; 공연, 전시, 음악, 미술 all occur twice: first appearance wins
    assert got == [(1, 1, "공연", 2), (1, 2, "전시", 2), (1, 3, "음악", 2), (3, 1, "하나", 1)]
    cols = {r["id"]: r for r in keyword_columns(top, "id").collect()}
    assert (cols[3]["Keyword_1"], cols[3]["Keyword_2"], cols[3]["Keyword_3"]) == ("하나", None, None)
    assert 2 not in cols  # a null page gives no keywords


def test_html_to_text(spark):
    df = spark.createDataFrame([("<b>a</b>&lt;b&gt; &amp;lt; <script>x</script>c<!-- d -->",)], "h string")
    assert df.select(html_to_text("h").alias("t")).first()["t"] == "a<b> &lt; c"  # <b> is no word boundary


def test_html_to_text_literal_rows(spark):
    cases = {
        "<b>서</b>점 <i>책</i>방": "서점 책방", "<p>one</p><p>two": " one  two", "a<br/>b<BR>c<hr >d": "a b c d", "<ul><li>x<li>y</ul>": "  x y ",
        "&amp;#65; &amp;lt;p&amp;gt;": "&#65; &lt;p&gt;", "&lt;p&gt;x&lt;/p&gt;": "<p>x</p>", "&#x41;&#X42;&#67;": "ABC",
        "&#0;&#xD800;&#1114112;&#99999999999;&#x110000;": "\ufffd" * 5, "&#00000000065;&#x1F600;": "A\U0001f600", "&#128;&#150;": "€–",
        "&hearts;&rarr;&NotEqualTilde;&eacute;&Eacute;": "♥→≂̸éÉ", "&unknown; &amp &; & &#; &#x;": "&unknown; &amp &; & &#; &#x;", "&nbsp;": "\u00a0",
        "<a title='x > y'>t</a><a title=\"'>'\">u</a>": "tu", "<p class=it's>lost text</p><p>it's kept</p>": " lost text  it's kept ",
        "<a b=\"never closed>text</a>": "text", "1 < 2 and 3 <4": "1 < 2 and 3 <4", "<!DOCTYPE html><?xml v?>x": "x",
        "<!-- <p> -- > --><!---->y": "y", "<script>if (a<b) '</p>'</script >z<style>q</script></style>": "z", "<script>never ends <p>x": "",
        "<scripty>k</scripty>": "k", "": "", "plain": "plain", "<": "<", "a<b": "a<b", "<p": "<p"}
    df = spark.createDataFrame(list(cases.items()), "h string, t string")
    assert {r["h"]: r["x"] for r in df.select("h", html_to_text("h").alias("x")).collect()} == cases
    long = "<p " + "=" * 200_000 + ">" + "&amp;" * 20_000 + "<" * 50_000 + "<p a='" + "x" * 200_000
    out = spark.createDataFrame([(long,)], "h string").select(html_to_text("h").alias("x")).first()["x"]
    assert out == " " + "&" * 20_000 + "<" * 50_000 + "<p a='" + "x" * 200_000
    assert spark.createDataFrame([("a<p>b<b>c",)], "h string").select(html_to_text("h", "\n").alias("x")).first()["x"] == "a\nbc"


def test_pages_are_dealt_by_the_bytes_of_their_files(spark, tmp_dir):
    from pyspark.sql import functions as F

    from metroframe.plans.keywords import spread_pages, top_keywords

    source = spark.range(400).select(F.col("id").alias("page_id"), F.expr("concat('<p>', sha2(cast(id AS string), 512), ' red red blue')").alias("html"))
    source.coalesce(1).write.parquet(f"{tmp_dir}/pages")
    pages = spark.read.parquet(f"{tmp_dir}/pages")
    parts = lambda n: spread_pages(spark, pages, "page_id", n).rdd.getNumPartitions()
    assert parts(1 << 30) == 4 and 8 <= parts(4000) <= 2 * parts(8000) + 1 and parts(1000) > 3 * parts(4000)
    assert spread_pages(spark, pages, "page_id", 1 << 30, 20).rdd.getNumPartitions() == 20
    key = lambda df: sorted(map(tuple, top_keywords(df, "page_id", "html", pattern="[a-z]+", stop_words=[]).collect()))
    assert key(spread_pages(spark, pages, "page_id", 4000)) == key(pages)
