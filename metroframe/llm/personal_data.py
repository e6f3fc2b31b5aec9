r"""Personal data: fixed patterns as seeds, and contextual patterns learned from them.

The base kinds (email, ip, card, phone) are patterns with a test each. They are the seeds of a
bootstrap. Every base span, and every identifier-like string that no base span touches, is an
instance; the words around an occurrence are its lexical patterns (the two words before, the
word before, the word before with the word after). Patterns and instances form a graph. In each
round a pattern is scored, per kind, by the share of its instances that are known to be of that
kind; an unknown instance is scored by its patterns of high confidence (one minus the product of
what each leaves open) and, where that is enough, joins the known ones of the next round. All
occurrences of the strings accepted so are reported as found_<kind>.

A pattern counts distinct strings, so a string that is repeated, in one text or in many, lends no
weight; words that stand before anything have many other instances, hence no confidence.

Only DataFrame and SQL functions. Spans are in code points, end exclusive. Places in a text come
from sums over what lies between the matches, taken in two levels, so that a text with many
matches costs little more than its length. The quantifiers of the patterns are possessive and
tied to the start of a run where that changes no match, so that long runs take linear time.

Defined cases: a null or empty text has no spans; equal rows get equal results; rows without
an id are scanned like others; other columns are not read; contexts end at 80 characters and at
the neighbouring match of the same pattern.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroframe.llm.common import written

# --- fixed values: the base patterns, from the contract (made possessive; a match may follow another directly) ---
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|$)){4}$"
CARD_DIGITS = (12, 19)
PHONE_DIGITS = (9, 15)
# --- end of fixed values ---
KINDS = ("email", "ip", "card", "phone", "found_email", "found_ip", "found_card", "found_phone")
BASE = 4  # the first kinds; a span of this order is a candidate
# strings of six characters or more with a digit or @, and groups of digits
_LETTER = r"A-Za-z_.%+/:#-"
CANDIDATE = (rf"(?<![0-9@{_LETTER}])(?:\(?[0-9]{{2,}}+(?:[\x20().-]{{1,2}}+[0-9]{{2,}}+)++(?![0-9@{_LETTER}])"
             rf"|(?=[{_LETTER}]*+[0-9@])[0-9@{_LETTER}]{{5,}}[A-Za-z0-9])")
CONTEXT = 80
ROUNDS = 3
SUPPORT = 5  # known instances that a pattern needs
CONFIDENCE = 0.8  # of a pattern, and of an instance
STEP = 128
SPANS = "array<struct<start:int,order:int,end:int,value:string,left:string,right:string>>"


def _running(sizes: Column) -> Column:
    """Running sums of an array, in two levels: copies grow with n to the power 1.5, not 2."""
    def fold(values: Column, first: Column) -> Column:
        none = F.array().cast("array<int>")
        return F.aggregate(values, F.struct(first.alias("at"), none.alias("sums")), lambda acc, x: F.struct(
            (acc["at"] + x).alias("at"), F.array_append(acc["sums"], acc["at"] + x).alias("sums")), lambda acc: acc["sums"])

    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / STEP).cast("int")),
                        lambda c: F.slice(sizes, c * STEP + 1, F.lit(STEP)))
    totals = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda a, x: a + x))
    ends = fold(totals, F.lit(0))
    return F.flatten(F.transform(F.arrays_zip(parts.alias("part"), totals.alias("total"), ends.alias("end")),
                                 lambda z: fold(z["part"], z["end"] - z["total"])))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def weighed(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + weighed(i)) % 10 == 0


def _between(n: Column, limits: tuple[int, int]) -> Column:
    return (n >= limits[0]) & (n <= limits[1])


TESTS = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: v.rlike(IP_PARTS),
    "card": lambda v: F.when(_between(F.length(_digits(v)), CARD_DIGITS), _luhn(_digits(v))).otherwise(False),
    "phone": lambda v: _between(F.length(_digits(v)), PHONE_DIGITS),
}


def _spans(kind: str, order: int) -> Column:
    """All matches of a kind with their places and what stands before and after."""
    # the columns are made before: an expression inside a lambda would run once per match
    zipped = F.arrays_zip(F.col(f"{kind}_hits").alias("hit"), F.col(f"{kind}_ends").alias("end"), F.col(f"{kind}_gaps").alias("gap"),
                          F.slice(f"{kind}_gaps", 2, F.size(f"{kind}_hits")).alias("after"))
    spans = F.transform(F.slice(zipped, F.lit(1), F.size(f"{kind}_hits")), lambda z: F.struct(
        (z["end"] - F.length(z["hit"])).alias("start"), F.lit(order).alias("order"), z["end"].alias("end"), z["hit"].alias("value"),
        F.substring(z["gap"], -CONTEXT, CONTEXT).alias("left"), F.substring(z["after"], 1, CONTEXT).alias("right")))
    return F.when(F.size(f"{kind}_hits") > 0, spans).otherwise(F.array()).cast(SPANS)


def _passing(spans: str, test: Callable[[Column], Column]) -> Column:
    return F.filter(spans, lambda s: test(s["value"]))


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row_key, doc_id, base and candidates (arrays of spans in order of kind and place), written."""
    patterns = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "candidate": CANDIDATE}
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    hits = rows.select("doc_id", "text", *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"{k}_hits")
                                           for k, p in patterns.items()])
    found = {k: F.size(f"{k}_hits") > 0 for k in patterns}
    gaps = hits.select("*", *[F.when(found[k], F.split("text", p, -1)).alias(f"{k}_gaps") for k, p in patterns.items()])
    sizes = gaps.select("*", *[F.transform(F.arrays_zip(F.col(f"{k}_gaps").alias("gap"), F.col(f"{k}_hits").alias("hit")),
                                           lambda z: F.length(z["gap"]) + F.length(F.coalesce(z["hit"], F.lit("")))).alias(f"{k}_sizes")
                               for k in patterns])
    ends = sizes.select("*", *[F.when(found[k], _running(F.col(f"{k}_sizes"))).alias(f"{k}_ends") for k in patterns])
    spans = ends.select("doc_id", *[_spans(k, i).alias(k) for i, k in enumerate(patterns)])
    kept = [_passing(k, test) for k, test in TESTS.items()]
    return written(spans.select(F.monotonically_increasing_id().alias("row_key"), "doc_id", F.concat(*kept).alias("base"),
                                F.col("candidate").alias("candidates")), "private_spans")


def _occurrences(table: DataFrame) -> DataFrame:
    """row_key, order, start, end, value, patterns of every base span and of every candidate that no base span touches."""
    spans = table.select("row_key", F.explode(F.concat("base", "candidates")).alias("s")).select("row_key", "s.*")
    of_base = F.col("order") < BASE
    place = Window.partitionBy("row_key").orderBy("start", "order", "end")
    before = F.max(F.when(of_base, F.col("end"))).over(place.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(of_base, F.col("start"))).over(place.rowsBetween(1, Window.unboundedFollowing))
    free = (F.coalesce("before", F.lit(0)) <= F.col("start")) & (F.coalesce("after", F.col("end")) >= F.col("end"))
    rows = spans.withColumn("before", before).withColumn("after", after).filter(of_base | free)
    shape = lambda c: F.regexp_replace(F.lower(c), "[0-9]", "0")
    words = F.regexp_extract_all(shape("left"), F.lit(r"\S+"), F.lit(0))
    one = F.coalesce(F.try_element_at("words", F.lit(-1)), F.lit("^"))
    two = F.coalesce(F.try_element_at("words", F.lit(-2)), F.lit("^"))
    follows = F.regexp_extract(shape("right"), r"^\s*(\S+)", 1)
    patterns = F.array(F.concat_ws("\t", F.lit("l2"), two, one), F.concat_ws("\t", F.lit("l1"), one),
                       F.concat_ws("\t", F.lit("lr"), one, follows))
    return rows.withColumn("words", words).select(
        "row_key", "order", "start", "end", F.xxhash64(F.lower("value")).alias("instance"),
        F.transform(patterns, lambda p: F.xxhash64(p)).alias("patterns"))


def bootstrap(occurrences: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(instance, kind, score): unknown instances that patterns of high confidence found, each with its best kind.

    A round joins edges with scores on the instance and with confidences on the pattern; both of
    these have one row per key and kind, and sums are combined before each shuffle.
    """
    edges = occurrences.select("instance", "order", F.explode("patterns").alias("pattern"))
    known = edges.filter(F.col("order") < BASE).groupBy("instance").agg(F.min("order").alias("kind"))
    pairs = edges.select("pattern", "instance").distinct()
    size = pairs.groupBy("pattern").agg(F.count("*").alias("n")).filter(F.col("n") >= SUPPORT)
    graph = written(pairs.join(size, "pattern"), "private_graph")
    seeds = written(known.select("instance", "kind", F.lit(1.0).alias("score")), "private_seeds")
    found = seeds.limit(0)
    for _ in range(rounds):
        scores = seeds.unionByName(found)
        # sums of doubles in any order would differ in the last place; whole millionths do not
        good = (graph.join(scores, "instance").groupBy("pattern", "kind", "n")
                .agg(F.sum(F.round(F.col("score") * 1_000_000).cast("bigint")).alias("parts"))
                .select("pattern", "kind", (F.col("parts") / 1_000_000).alias("support"), "n")
                .withColumn("confidence", F.col("support") / (F.col("n") + 1))
                .filter((F.col("support") >= SUPPORT) & (F.col("confidence") >= CONFIDENCE)))
        open_part = F.round(-F.log(1 - F.col("confidence")) * 1_000_000).cast("bigint")
        best = F.max(F.struct("score", (-F.col("kind")).alias("first")))
        found = written(graph.join(seeds, "instance", "left_anti").join(good.select("pattern", "kind", "confidence"), "pattern")
                        .groupBy("instance", "kind").agg(F.sum(open_part).alias("open"))
                        .withColumn("score", 1 - F.exp(-F.col("open") / 1_000_000)).filter(F.col("score") >= CONFIDENCE)
                        .groupBy("instance").agg(best.alias("best"))
                        .select("instance", (-F.col("best.first")).alias("kind"), F.col("best.score").alias("score")), "private_found")
    return found


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, base and spans (arrays of spans, ordered by start and kind; order is the place in KINDS)."""
    table = base_spans(docs, id_col, text_col)
    occurrences = written(_occurrences(table), "private_occurrences")
    found = bootstrap(occurrences)
    span = F.struct("start", (F.col("kind") + BASE).alias("order"), "end")
    more = (occurrences.filter(F.col("order") == BASE).join(found, "instance")
            .groupBy("row_key").agg(F.collect_list(span).alias("more")))
    plain = "array<struct<start:int,order:int,end:int>>"
    base = F.transform("base", lambda s: F.struct(s["start"], s["order"], s["end"])).cast(plain)
    return table.join(more, "row_key", "left").select(
        "doc_id", F.array_sort(base).alias("base"),
        F.array_sort(F.concat(base, F.coalesce("more", F.array()).cast(plain))).alias("spans"))


def listed(spans: str) -> Column:
    """kind:start:end of an array of spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["order"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["order"] == KINDS.index(kind))).cast("bigint")
