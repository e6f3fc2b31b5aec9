"""Main text of web pages by wrappers inferred for each host.

A page is a stream of block tags (with the words of their class, id and role) and text slots. Within a
page, tandem repeats become repeated groups. Per host, the distinct page expressions, counted by Spark,
are aligned one after another with the wrapper so far: where the streams agree it stays, what only one side
has becomes an optional group, differing texts are one slot. The result is a union-free regular
expression: tags, text slots, repeated (+) and optional (?) groups.

Each page is then matched against its host's wrapper, which gives every text of the page its slot in the
wrapper; texts of symbols that the wrapper lacks have their path as slot. Per slot, Spark counts the distinct
pages of the host (by their texts), their characters and whether all hold one and the same text. From this come
the slots that a host keeps: those in the article or main group and, for pages without one, those in the
container whose slots hold most text. A slot with one text on most distinct pages of a host is template text, unless it
is a heading or paragraph of the region. A page's text is what it holds in kept slots, without menus, headers,
footers, sidebars, notices, adverts, forms and comments, which tag names and class words of the groups tell.

Per-page work sees one page; a host's state is one wrapper and its slots, whatever its number of pages: each task
first counts the distinct expressions of its pages, Spark adds the counts, and each host's expressions
stream through the alignment in order.

Defined cases: a null or empty page gives an empty text; pages without a host (bad or null url) form one
group; broken markup is read as far as it goes (an open comment, script or tag hides the rest); equal rows are
all returned, with equal results; other columns are not read.
"""

from __future__ import annotations

import difflib
import hashlib
import html
import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metroframe.llm.common import written

MAX_PERIOD = 24  # tokens in a repeated group
TEMPLATE_PAGES = 3  # distinct pages that a template text is on at least
WRAPPER_TOKENS = 4096  # beyond it new optional groups of a host are no longer added to its wrapper; their texts have their paths as slots
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(script|style|noscript|template|textarea|svg|iframe|object|select|title)"""
    r"""\b(?:"[^"]*"|'[^']*'|[^'">])*>.*?(?:</\1\s*>|\Z)|<[!?/]?[A-Za-z](?:"[^"]*"|'[^']*'|[^'">])*(?:>|\Z)""",
    re.S | re.I)
NAME = re.compile(r"</?([A-Za-z][A-Za-z0-9:-]*)")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
WORD = re.compile(r"[A-Za-z]+")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr img".split())
VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())
CLOSED_BY_PEER = frozenset("p li dt dd tr td th option thead tbody tfoot".split())
SKIPPED_TAGS = frozenset("nav footer aside form button menu dialog input label fieldset head".split())
SKIPPED_WORDS = frozenset("ad ads advert advertisement adverts banner sponsor sponsored promo sidebar aside nav navbar "
                          "navigation menu breadcrumb breadcrumbs footer comment comments reply replies disqus notice "
                          "notices cookie cookies consent gdpr popup modal newsletter subscribe signup login share "
                          "sharing social related recommended toolbar masthead".split())
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search form menu alert dialog".split())
MAIN = ("article", "main")


@lru_cache(maxsize=4096)
def tag_of(raw: str) -> tuple[str, str, bool]:
    """(name, label, skipped) of a tag: the label adds class, id and role words."""
    name = NAME.match(raw)[1].lower()
    words, skipped = [], name in SKIPPED_TAGS
    for kind, a, b, c in ATTRIBUTE.findall(raw):
        value = (a or b or c).lower()
        if kind.lower() == "role":
            skipped |= value in SKIPPED_ROLES
            name = "main" if value == "main" else name
        found = WORD.findall(value)
        skipped |= any(w in SKIPPED_WORDS for w in found) and name not in ("body", "html", "article", "main")
        words += found
    return name, ".".join([name, *dict.fromkeys(words)]), skipped


def stream(page: str):
    """(kind, value, path, skipped) in page order: kind is tag, close, break or text.

    The path is the labels of the open block elements, joined by /.
    """
    open_, at, out = [], 0, []  # (name, label, skipped)

    def text(raw: str) -> None:
        if raw:
            out.append(("text", raw, "/".join(o[1] for o in open_), any(o[2] for o in open_)))

    def close(name: str) -> None:
        for k in range(len(open_) - 1, -1, -1):
            if open_[k][0] == name:
                for o in reversed(open_[k:]):
                    out.append(("close", o[0], "", False))
                del open_[k:]
                return

    for m in TOKEN.finditer(page):
        text(page[at:m.start()])
        at = m.end()
        raw = m[0]
        if m[1] or raw[1] in "!?":
            continue
        if raw[1] == "/":
            name = NAME.match(raw)[1].lower()
            if name not in INLINE:
                if any(o[0] == name for o in open_):
                    close(name)
                else:
                    out.append(("break", name, "", False))
            continue
        name, label, skipped = tag_of(raw)
        if name in INLINE and not skipped:
            continue
        if name in VOID:
            out.append(("break", name, "", False))
            continue
        if name in INLINE:  # an inline advert: its end tag is not followed, so only its words are kept apart
            continue
        if name in CLOSED_BY_PEER and open_ and open_[-1][0] == name:
            close(name)
        elif name not in ("p",) and open_ and open_[-1][0] == "p" and name in (
                "div", "section", "ul", "ol", "table", "h1", "h2", "h3", "h4", "h5", "h6", "article", "footer", "nav",
                "aside", "form", "header", "blockquote", "pre", "p"):
            close("p")
        if name == "header" and not any(o[0] in MAIN for o in open_):
            skipped = True
        open_.append((name, label, skipped))
        out.append(("tag", label, "/".join(o[1] for o in open_), any(o[2] for o in open_)))
    rest = page[at:]
    text(rest.split("<", 1)[0] if re.search(r"<[A-Za-z/!][^>]*\Z", rest) else rest)
    return out


def symbols_of(tokens) -> tuple[list[str], list[int]]:
    """The page's labels, /names and # for text, and for each token its symbol's number, or -1."""
    flat: list[str] = []
    of: list[int] = []
    for kind, value, _, _ in tokens:
        if kind == "tag":
            flat.append(value)
        elif kind == "close":
            flat.append("/" + value)
        elif kind == "text" and value.strip():
            if not flat or flat[-1] != "#":
                flat.append("#")
        else:
            of.append(-1)
            continue
        of.append(len(flat) - 1)
    return flat, of


def expression(tokens) -> list[str]:
    """The page as a list of symbols, tandem repeats collapsed into (...)+ ."""
    return collapse(symbols_of(tokens)[0])


def collapse(symbols: list[str]) -> list[str]:
    """Repeated neighbours, of 1 to MAX_PERIOD symbols, become one group; again until nothing changes."""
    codes: dict[str, str] = {}
    names: list[str] = []
    for s in symbols:
        if s not in codes:
            codes[s] = chr(0x4E00 + len(names))
            names.append(s)
    text = "".join(codes[s] for s in symbols)
    for period in range(1, MAX_PERIOD + 1):
        def group(m: re.Match) -> str:
            inner = " ".join(names[ord(c) - 0x4E00] for c in m[1])
            name = inner if period == 1 and inner.endswith(")+") else f"({inner})+"
            if name not in codes:
                codes[name] = chr(0x4E00 + len(names))
                names.append(name)
            return codes[name]
        text = re.sub(rf"(.{{{period}}})\1+", group, text, flags=re.S)
    return [names[ord(c) - 0x4E00] for c in text]


def optional(symbols: list[str]) -> list[str]:
    inner = [s for s in symbols]
    if all(s.endswith(")?") for s in inner):
        return inner
    return ["(" + " ".join(s[1:-2] if s.endswith(")?") else s for s in inner) + ")?"]


def align(wrapper: list[str], page: list[str]) -> list[str]:
    """The least general union-free expression of both by aligning them: what one lacks becomes optional."""
    plain = [s[1:-2] if s.endswith(")?") else s for s in wrapper]
    out: list[str] = []
    for op, a, b, c, d in difflib.SequenceMatcher(None, plain, page, autojunk=False).get_opcodes():
        if op == "equal":
            out += wrapper[a:b]
            continue
        one, two = wrapper[a:b], page[c:d]
        if len(one) == len(two) == 1 and _bare(one[0]) == _bare(two[0]):
            out.append(f"({_bare(one[0])})+")  # once here, repeated there: a repeated group
            continue
        if one:
            out += optional(one)
        if two and len(wrapper) < WRAPPER_TOKENS:
            out += optional(two)
    return out


def _bare(symbol: str) -> str:
    while symbol.startswith("(") and symbol[-2:] in (")+", ")?"):
        symbol = symbol[1:-2]
    return symbol


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def clean(raw: str) -> str:
    return " ".join(html.unescape(raw).split())


def _summaries(batches):
    """Counts of the task's pages: expressions per host."""
    shapes: Counter = Counter()

    def flush():
        keys = list(shapes)
        yield pa.RecordBatch.from_pydict({"host": [k[0] for k in keys], "shape": [k[1] for k in keys],
                                          "n": list(shapes.values())}, schema=SUMMARY)
        shapes.clear()

    for b in batches:
        for host, page in zip(b.column(0), b.column(1), strict=True):
            shapes[host.as_py(), " ".join(expression(stream(page.as_py() or "")))] += 1
        if len(shapes) > 50_000:
            yield from flush()
    yield from flush()


SUMMARY = pa.schema([("host", pa.string()), ("shape", pa.string()), ("n", pa.int64())])


def _wrappers(batches):
    """Rows sorted by host and falling count, folded into one row per host."""
    host, wrapper = None, None

    def done():
        return pa.RecordBatch.from_pydict({"host": [host], "wrapper": [" ".join(wrapper or [])]})

    for b in batches:
        for row in b.to_pylist():
            if row["host"] != host:
                if host is not None:
                    yield done()
                host, wrapper = row["host"], None
            page = split_symbols(row["shape"])
            wrapper = page if wrapper is None else align(wrapper, page)
    if host is not None:
        yield done()


def split_symbols(text: str) -> list[str]:
    """The symbols of an expression: split at spaces outside groups."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(text):
        if c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
        elif c == " " and depth == 0:
            out.append(text[start:i])
            start = i + 1
    return [*out, text[start:]] if text else []


@lru_cache(maxsize=4096)
def parsed(symbol: str):
    """A symbol as the atom itself, or as the tuple of the symbols that its group repeats."""
    return tuple(parsed(s) for s in split_symbols(symbol[1:-2])) if symbol[:1] == "(" and symbol[-2:] == ")+" else symbol


def _size(symbol) -> int:
    return 1 if isinstance(symbol, str) else sum(map(_size, symbol))


def _walk(symbol, flat: list[str], at: int, atom: int, out: list[int]) -> int:
    """The place after ``symbol`` in ``flat`` from ``at`` on, or -1; ``out`` gets the number of each place's atom."""
    if isinstance(symbol, str):
        if at < len(flat) and flat[at] == symbol:
            out.append(atom)
            return at + 1
        return -1
    end = -1
    while True:
        size, place = len(out), at
        inner = atom
        for s in symbol:
            place = _walk(s, flat, place, inner, out)
            if place < 0:
                del out[size:]
                return end
            inner += _size(s)
        at = end = place


@lru_cache(maxsize=1024)
def _matched(wrapper: str, shape: str) -> tuple[int, ...]:
    """For each symbol of ``shape`` the number of the wrapper's atom where its like begins, or -1."""
    flat: list[str] = []
    for s in split_symbols(wrapper):
        flat += split_symbols(s[1:-2]) if s.endswith(")?") else [s]
    first = [0]
    for s in flat:
        first.append(first[-1] + _size(parsed(s)))
    page = split_symbols(shape)
    out = [-1] * len(page)
    for a, b, n in difflib.SequenceMatcher(None, [_bare(s) for s in flat], [_bare(s) for s in page],
                                           autojunk=False).get_matching_blocks():
        out[b:b + n] = first[a:a + n]
    return tuple(out)


def slots(tokens, wrapper: str) -> list[str]:
    """The slot of each token: the number of its atom in the wrapper, or its path where the wrapper has none."""
    flat, of = symbols_of(tokens)
    shape = collapse(flat)
    atoms: list[int] = []
    for symbol, first in zip(shape, _matched(wrapper, " ".join(shape)), strict=True):
        size = len(atoms)
        if _walk(parsed(symbol), flat, size, first, atoms) < 0:
            break
        if first < 0:
            atoms[size:] = [-1] * (len(atoms) - size)
    atoms += [-1] * (len(flat) - len(atoms))
    return [str(atoms[k]) if k >= 0 and atoms[k] >= 0 else path for k, (_, _, path, _) in zip(of, tokens, strict=True)]


IN_MAIN = re.compile(r"(?:^|/)(?:article|main)(?:[./]|$)")


def _has_main(tokens) -> bool:
    return any(kind == "tag" and not skipped and value.split(".")[0] in MAIN for kind, value, _, skipped in tokens)


def _name(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _slots(batches):
    """Per page and slot outside boilerplate: path, characters and name of the text; per page one row without a slot."""
    for b in batches:
        rows = []
        for host, page, wrapper in zip(*b.columns[:3], strict=True):
            tokens, texts = stream(page.as_py() or ""), {}
            main = _has_main(tokens)
            for slot, (kind, value, path, skipped) in zip(slots(tokens, wrapper.as_py() or ""), tokens, strict=True):
                if kind == "text" and not skipped and value.strip() and (not main or IN_MAIN.search(path)):
                    texts.setdefault(slot, (path, []))[1].append(clean(value))
            own = {slot: (path, " ".join(found)) for slot, (path, found) in texts.items()}
            name = _name("\n".join(text for _, text in own.values()))
            rows.append((host.as_py(), main, None, name, "", 0, 0))
            rows += [(host.as_py(), main, slot, name, path, len(text), _name(text)) for slot, (path, text) in own.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SLOT)] if rows else
                                         [pa.array([], f.type) for f in SLOT], schema=SLOT)


SLOT = pa.schema([("host", pa.string()), ("main", pa.bool_()), ("slot", pa.string()), ("page", pa.int64()),
                  ("path", pa.string()), ("chars", pa.int64()), ("text", pa.int64())])


def _region(mass: Counter) -> str:
    """The container with most text, its share over half of its parent's."""
    total, best = sum(mass.values()), ""
    while total:
        inner: Counter = Counter()
        for path, chars in mass.items():
            if not best or path.startswith(best + "/"):
                rest = path[len(best):].strip("/")
                inner["/".join(filter(None, [best, rest.split("/")[0]]))] += chars
        own = [(c, p) for p, c in inner.items() if p and p.rsplit("/", 1)[-1].split(".")[0] not in CLOSED_BY_PEER
               and not re.match(r"h[1-6]", p.rsplit("/", 1)[-1])]
        if not own or max(own)[0] * 2 <= total:
            break
        best = max(own)[1]
    return best


def _kept(batches):
    """Rows sorted by host and main, per slot, into one row per host and main: the slots to keep."""
    key, pages, found = None, 0, []

    def done():
        own = [(row["slot"], row["path"], row["chars"]) for row in found
               if row["pages"] < TEMPLATE_PAGES or 2 * row["pages"] <= pages or row["lo"] != row["hi"]
               or re.match(r"(?:p|h[1-6])(?:\.|$)", row["path"].rsplit("/", 1)[-1])]
        mass: Counter = Counter()
        for _, path, chars in own:
            mass[path] += chars
        region = "" if key[1] else _region(mass)
        kept = [slot for slot, path, _ in own if not region or path == region or path.startswith(region + "/")]
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.string()), pa.array([key[1]]), pa.array([region]),
                                           pa.array([kept], pa.list_(pa.string()))], names=["host", "main", "region", "kept"])

    for b in batches:
        for row in b.to_pylist():
            if (row["host"], row["main"]) != key:
                if key is not None:
                    yield done()
                key, pages, found = (row["host"], row["main"]), 0, []
            if row["slot"] is None:
                pages = row["pages"]
            else:
                found.append(row)
    if key is not None:
        yield done()


def main_text(page: str, wrapper: str, kept: dict[bool, frozenset]) -> str:
    """The blocks of a page's main text, one to a line: what it holds in the slots its host keeps."""
    blocks, own = [], []
    tokens = stream(page)
    main = _has_main(tokens)
    wanted = kept.get(main, frozenset())

    def flush() -> None:
        text = clean("".join(own))
        if text:
            blocks.append(text)
        own.clear()

    for slot, (kind, value, path, skipped) in zip(slots(tokens, wrapper), tokens, strict=True):
        if kind != "text":
            flush()
        elif not skipped and (not value.strip() or slot in wanted and (not main or IN_MAIN.search(path))):
            own.append(value)
    flush()
    return "\n".join(blocks)


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, wrapper): one row per host."""
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html"))
    found = rows.mapInArrow(_summaries, "host string, shape string, n bigint").groupBy("host", "shape").agg(F.sum("n").alias("n"))
    ordered = found.repartition("host").sortWithinPartitions("host", F.col("n").desc(), "shape")
    return ordered.mapInArrow(_wrappers, "host string, wrapper string")


def kept_slots(pages: DataFrame, wrappers: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, main, region, kept): per host, for pages with and without an article or main element, the slots to keep."""
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html"))
    each = (rows.join(wrappers, "host", "left").select("host", "html", "wrapper")
            .mapInArrow(_slots, "host string, main boolean, slot string, page bigint, path string, chars bigint, text bigint")
            # copies of a page count once
            .groupBy("host", "main", "slot", "page")
            .agg(F.min("path").alias("path"), F.max("chars").alias("chars"), F.min("text").alias("lo"), F.max("text").alias("hi")))
    found = each.groupBy("host", "main", "slot").agg(
        F.count("*").alias("pages"), F.min("path").alias("path"), F.sum("chars").alias("chars"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    ordered = found.repartition("host").sortWithinPartitions("host", "main", "slot")
    return ordered.mapInArrow(_kept, "host string, main boolean, region string, kept array<string>")


def _extract(batches):
    for b in batches:
        texts = [main_text(page.as_py() or "", wrapper.as_py() or "",
                           {False: frozenset(plain.as_py() or ()), True: frozenset(main.as_py() or ())})
                 for page, wrapper, plain, main in zip(*b.columns[2:6], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars."""
    wrappers = written(infer_wrappers(pages, url_col, html_col), "wrappers")
    kept = written(kept_slots(pages, wrappers, url_col, html_col), "wrapper_slots")
    hosts = wrappers
    for name, main in (("plain", False), ("main", True)):
        hosts = hosts.join(kept.filter(F.col("main") == main).select("host", F.col("kept").alias(name)), "host", "left")
    hosts = written(hosts, "wrapper_hosts")
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).cast("string").alias("html"), host_of(F.col(url_col)).alias("host"))
    return (rows.join(hosts, "host", "left").select("page_id", "url", "html", "wrapper", "plain", "main")
            .mapInArrow(_extract, "page_id bigint, url string, text string, n_chars bigint"))
