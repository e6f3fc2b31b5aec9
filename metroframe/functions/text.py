"""STR-* and ARR-*: string and array expressions."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from metroframe import constants as K


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def prefix(c, n: int) -> Column:
    """STR-1: first ``n`` characters (1-based substring)."""
    return F.substring(_col(c), 1, n)


def split_list(c, sep: str = K.STATION_LIST_SEPARATOR) -> Column:
    """STR-2: split on a literal separator into an array."""
    return F.split(_col(c), _regex_literal(sep))


def split_part(c, sep: str, index: int) -> Column:
    """STR-3 / ARR-2: the ``index``-th (0-based) piece, null beyond the end."""
    return F.get(F.split(_col(c), _regex_literal(sep)), index)


def element_or_null(arr, index: int) -> Column:
    """ARR-2: element at a 0-based index, null beyond the end."""
    return F.get(_col(arr), index)


def trim(c) -> Column:
    """STR-4: strip leading and trailing spaces."""
    return F.trim(_col(c))


def strip_parenthesised(c, pattern: str = K.PARENTHESISED) -> Column:
    """STR-5 + STR-4: drop parenthesised text (non-greedy), then trim."""
    return F.trim(F.regexp_replace(_col(c), pattern, ""))


def extract_group(c, pattern: str, group: int = 1) -> Column:
    """STR-6: regex group; '' when nothing matches, null in gives null out."""
    return F.regexp_extract(_col(c), pattern, group)


def join_non_null(sep: str, *cols) -> Column:
    """STR-7: join with ``sep``, nulls skipped; all null gives ''."""
    return F.concat_ws(sep, *[_col(c) for c in cols])


def words(c, pattern: str = K.HANGUL_WORD) -> Column:
    """STR-8: every match of a word class, as an array in text order."""
    return F.regexp_extract_all(_col(c), F.lit(pattern), 0)


def words_joined(c, pattern: str = K.HANGUL_WORD) -> Column:
    """STR-8: the matches joined with one space."""
    return F.array_join(words(c, pattern), " ")


def fill_empty(c) -> Column:
    """STR-11: missing text becomes ''."""
    return F.coalesce(_col(c), F.lit(""))


# --- fixed values: elements of HTML that stand on lines of their own -----------
BLOCK_ELEMENTS = [
    "address", "article", "aside", "blockquote", "body", "br", "button", "caption", "center", "dd", "details", "dialog", "dir", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "frameset", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
    "hgroup", "hr", "html", "iframe", "legend", "li", "link", "main", "menu", "meta", "nav", "noscript", "ol", "optgroup", "option", "p",
    "pre", "search", "section", "select", "summary", "table", "tbody", "td", "textarea", "tfoot", "th", "thead", "title", "tr", "ul"]
# --- end of fixed values ---
# One token of markup: a comment, a script or style with its content (also when it never ends), a tag, a character reference.
# A quote in a tag counts where a value begins, so that an apostrophe elsewhere does not hide the end of the tag.
HTML_TOKEN = (r"(?is)<!--.*?-->|<(script|style)\b[^>]*+>.*?(?:</\1\s*+>|\z)"
              r"|<[/!?]?[a-z](?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+>"
              r"|&(?:#[0-9]++|#x[0-9a-f]++|[a-z][a-z0-9]*+);")
# References met most come first: a map of Spark is searched from its start.
_COMMON = ["nbsp;", "amp;", "lt;", "gt;", "quot;", "apos;", "middot;", "copy;", "lsquo;", "rsquo;", "ldquo;", "rdquo;", "hellip;", "ndash;", "mdash;"]
_NAMED = {n: html5[n] for n in [*_COMMON, *sorted(n for n in html5 if n.endswith(";"))]}
# the numbers 128 to 159 mean characters of Windows-1252, where it has one
_WINDOWS = [bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)]


def html_to_text(c, tag_separator: str = " ") -> Column:
    """STR-9: visible text of an HTML document, in one pass over its tokens.

    Scripts, styles and comments go; a tag of a block element becomes ``tag_separator`` and any other tag nothing, so that a
    word with markup inside stays one word. Every character reference is decoded once: all names of HTML 5 and
    numbers of any length (impossible ones become U+FFFD); what they decode to is text, never markup or a reference again.
    A reference needs its semicolon; a ``<`` that begins no tag is text.
    """
    html = _col(c)
    tokens = F.regexp_extract_all(html, F.lit(HTML_TOKEN), F.lit(0))
    pairs = F.arrays_zip(F.split(html, HTML_TOKEN, -1).alias("gap"), tokens.alias("token"))
    text = F.array_join(F.transform(pairs, lambda p: F.concat(p["gap"], F.coalesce(_token_text(p["token"], tag_separator), F.lit("")))), "")
    return F.when(html.rlike("[<&]"), text).otherwise(html)


def _token_text(token: Column, tag_separator: str) -> Column:
    name = F.lower(F.regexp_extract(token, "^</?([A-Za-z][A-Za-z0-9]*)", 1))
    return (F.when(token.startswith("&"), reference_text(token))
            .when(name.isin(BLOCK_ELEMENTS), F.lit(tag_separator)).otherwise(F.lit("")))


def reference_text(reference: Column) -> Column:
    """The character(s) of ``&name;``, ``&#decimal;`` or ``&#xhex;``; an unknown name stays as it is."""
    names = F.from_json(F.lit(json.dumps(_NAMED)), "map<string,string>")
    named = F.coalesce(F.try_element_at(names, F.substring(reference, 2, 1 << 20)), reference)
    digits = F.regexp_extract(reference, "^&#[xX]?0*([0-9A-Fa-f]*);$", 1)
    hexadecimal = F.lower(F.substring(reference, 3, 1)) == "x"
    # more than seven digits are beyond the last character in either base
    n = F.when(F.length(digits) > 7, F.lit(-1)).otherwise(F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).try_cast("int"))
    bad = n.isNull() | (n < 1) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
    character = F.decode(F.unhex(F.lpad(F.hex(F.when(bad, 0xFFFD).otherwise(n)), 8, "0")), "UTF-32")
    windows = F.get(F.array(*[F.lit(w) for w in _WINDOWS]), n - 0x80)
    return F.when(F.substring(reference, 2, 1) != "#", named).otherwise(F.when(n.between(0x80, 0x9F), windows).otherwise(character))


def _regex_literal(s: str) -> str:
    """Escape a literal separator for use as a regex in ``split``."""
    special = set("\\^$.|?*+()[]{}")
    return "".join("\\" + ch if ch in special else ch for ch in s)
