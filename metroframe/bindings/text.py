"""Keyword extraction chain on pages and word runs on documents
(STR-8, STR-9, FLT-4, AGG-2, TOP-1, TOP-2)."""

from __future__ import annotations


from pyspark.sql import functions as F

from metroframe.bindings import query
from metroframe.bindings import tables as tb
from metroframe.functions.text import html_to_text, words_joined
from metroframe.operators.aggregates import value_counts
from metroframe.operators.filters import exclude_words
from metroframe.plans.keywords import keyword_columns, page_words, spread_pages, top_keywords

html_to_text_sql = tb.html_text_sql
STOPS_SQL = ", ".join("'" + w + "'" for w in tb.PAGE_STOP_WORDS)
WORDS_SQL = f"""
SELECT page_id, unnest(ws) AS word, CAST(unnest(range(len(ws))) AS INTEGER) AS pos FROM (
  SELECT page_id, regexp_extract_all({html_to_text_sql('html')}, '{tb.PAGE_WORD}') AS ws
  FROM pages WHERE html IS NOT NULL)"""


# markup put before each page, and the text that it must give
MARKUP = ("<p><b>서</b>점 &amp;#65; &#65;&#x1F600;&#0000000065;&#99999999; &euro;&#128; &nosuch; a &lt;b&gt; c</p><!-- <p> --><STYLE>x</STYLE>"
          "<a title='1 > 0' href=it's>l</a>i<br/>1 < 2 &amp; 3<script>if (a < b) '</p>'</script>")
MARKUP_TEXT = " 서점 &#65; A\U0001f600A\ufffd €€ &nosuch; a <b> c li 1 < 2 & 3"


@query("str_html_text", f"SELECT page_id, '{MARKUP_TEXT}' || {html_to_text_sql('html')} AS text FROM pages")
def q_str_html_text(spark, d):
    """STR-9: visible text of every page, after a piece of markup whose text is known."""
    p = spread_pages(spark, tb.table(spark, d, "pages"), "page_id")
    return p.select("page_id", html_to_text(F.concat(F.lit(MARKUP), "html")).alias("text"))


@query("str_extract_all", rf"""
SELECT doc_id, array_to_string(regexp_extract_all(text, '{tb.PAGE_WORD}'), ' ') AS words FROM documents""")
def q_str_extract_all(spark, d):
    """STR-8: every letter run of each whole document, joined by one space."""
    doc = tb.table(spark, d, "documents").select("doc_id", "text").repartition("doc_id")
    return doc.select("doc_id", words_joined("text", tb.PAGE_WORD).alias("words"))


@query("flt_stop_words", f"SELECT page_id, pos, word FROM ({WORDS_SQL}) WHERE word NOT IN ({STOPS_SQL})")
def q_flt_stop_words(spark, d):
    """FLT-4: page words without the 20 stop words (broadcast anti join)."""
    w = page_words(spread_pages(spark, tb.table(spark, d, "pages"), "page_id"), "page_id", "html", pattern=tb.PAGE_WORD)
    return exclude_words(w, "word", tb.PAGE_STOP_WORDS)


@query("agg_value_count", f"""
SELECT page_id, word, count(*) AS n, min(pos) AS first_pos FROM ({WORDS_SQL})
WHERE word NOT IN ({STOPS_SQL}) GROUP BY page_id, word""")
def q_agg_value_count(spark, d):
    """AGG-2: occurrences of each word per page, with its first position."""
    w = exclude_words(page_words(spread_pages(spark, tb.table(spark, d, "pages"), "page_id"), "page_id", "html", pattern=tb.PAGE_WORD),
                      "word", tb.PAGE_STOP_WORDS)
    return value_counts(w, ["page_id"], "word", count_col="n", pos="pos", first_pos="first_pos")


@query("topk_keywords_per_page", tb.keywords_sql())
def q_topk_keywords_per_page(spark, d):
    """TOP-1 (P-5 core): the three most frequent words per page, ties by
    first appearance."""
    return top_keywords(spread_pages(spark, tb.table(spark, d, "pages"), "page_id"), "page_id", "html", pattern=tb.PAGE_WORD,
                        stop_words=tb.PAGE_STOP_WORDS)


@query("topk_to_columns", tb.keyword_columns_sql(names=("keyword_1", "keyword_2", "keyword_3")))
def q_topk_to_columns(spark, d):
    """TOP-2: ranks 1..3 as keyword columns, null when a page has fewer."""
    top = top_keywords(spread_pages(spark, tb.table(spark, d, "pages"), "page_id"), "page_id", "html", pattern=tb.PAGE_WORD,
                       stop_words=tb.PAGE_STOP_WORDS)
    return keyword_columns(top, "page_id", ("keyword_1", "keyword_2", "keyword_3"))
