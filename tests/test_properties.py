"""Property checks against small Python models (hypothesis; each example is
one batch of strings, evaluated by one Spark job)."""

import html
import re
from html.parser import HTMLParser

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from metroframe.functions.casts import lenient_cast
from metroframe.functions.text import html_to_text

INT_MIN, INT_MAX = -(2 ** 31), 2 ** 31 - 1


def legacy_int(s):
    """The legacy (non-ANSI) string -> int cast on ASCII text."""
    if s is None:
        return None
    t = s.strip(" ")
    m = re.fullmatch(r"([+-]?[0-9]+)(\.[0-9]*)?", t)
    if not m:
        return None
    v = int(m.group(1))
    return v if INT_MIN <= v <= INT_MAX else None


numbers = st.one_of(
    st.integers(-(2 ** 40), 2 ** 40).map(str),
    st.builds(lambda a, b: f"{a}.{b}", st.integers(-99999, 99999), st.integers(0, 999)),
    st.builds(lambda a: f"{a}.", st.integers(0, 999)),
    st.builds(lambda a: f"+{a}", st.integers(0, 999)),
    st.sampled_from(["", " ", "abc", "1e3", "--1", "1.2.3", "0x10", "NaN", "Infinity", "7,5", "١٢"]),
)
texts = st.builds(lambda pad, n: " " * pad + n + " " * pad, st.integers(0, 2), numbers)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), texts), min_size=1, max_size=40))
def test_lenient_int_cast_matches_legacy_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r["i"]: r["v"] for r in df.select("i", lenient_cast("s", "int").alias("v")).collect()}
    for i, v in enumerate(values):
        assert got[i] == legacy_int(v), (v, got[i])


class Reader(HTMLParser):
    """Text by the standard library's parser: block tags are a space, others nothing."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.out, self.inside = [], None

    def handle_starttag(self, tag, attrs):
        self.out.append(" " if tag in ("p", "br") else "")
        self.inside = tag if tag in ("script", "style") else None

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.inside = None
        self.out.append(" " if tag in ("p", "br") else "")

    def handle_data(self, data):
        self.out.append("" if self.inside else data)

    def handle_entityref(self, name):
        self.out.append(html.unescape(f"&{name};"))

    def handle_charref(self, name):
        self.out.append(html.unescape(f"&#{name};"))


def py_html_to_text(h):
    if h is None:
        return None
    reader = Reader()
    reader.feed(h)
    reader.close()
    return "".join(reader.out)


pieces = st.sampled_from(["<p>", "</p>", "<script>var a='<b>';</script>", "<style>p{}</style>", "<!-- c -->",
                          "<br/>", "&amp;", "&lt;", "&amp;lt;", "&copy;", "word", "단어", " ", "\n", "< ", ">", "<b>", "</b>", "&#65;", "&#x20AC;",
                          "<SCRIPT type=x>y</SCRIPT >", "<a href=\"x\">t</a>", "&middot;", "&nbsp;"])
docs = st.lists(pieces, max_size=25).map("".join)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(docs, min_size=1, max_size=20))
def test_html_to_text_matches_python_model(spark, pages):
    df = spark.createDataFrame([(i, h) for i, h in enumerate(pages)], "i int, h string")
    got = {r["i"]: r["t"] for r in df.select("i", html_to_text("h").alias("t")).collect()}
    for i, h in enumerate(pages):
        assert got[i] == py_html_to_text(h), h
