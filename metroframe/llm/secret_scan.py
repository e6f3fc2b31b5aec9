r"""Secret scan: fixed patterns, and a battery of randomness tests.

The base kinds are patterns (assign, access, hex). Beside them, each run of 20 or more
characters of an encoding alphabet that no base span touches is tested for randomness
under the encoding it fits (hex, base 32, base 64): chi-squared uniformity over
eight groups of the alphabet, runs above and below its middle, and serial
correlation of neighbours. The smallest of the three p-values, times three, is
the run's p-value for "drawn uniformly".

Long runs of ordinary text fail clearly; short ones need the right level. So false
discoveries are controlled per stratum of encoding and length (powers of two) by
Benjamini-Hochberg over all runs of the corpus: rejected runs are not random, and the
rest, if their characters vary as those of a drawn key must, are reported as kind random. The step
works on counts per stratum and bin of the p-value, a bounded table.

Only DataFrame and SQL functions. Spans are in code points, end exclusive.

Defined cases: a null or empty text has no spans; equal rows get equal results, each counted in
the strata; rows without an id are scanned like others; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroframe.llm.common import written

# --- fixed values: the base patterns, from the contract (only the quantifiers say the minimum) ---
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# --- end of fixed values ---
MIN_VALUE = 6
RUN = r"[A-Za-z0-9+/=_-]{20,}"
LEVEL = 0.01  # false-discovery rate within a stratum
BINS_PER_DECADE = 20
GROUPS = 8
KINDS = ("assign", "access", "hex", "random")
SPANS = "array<struct<start:int,order:int,end:int,value:string>>"

# alphabets in order; the place of a character gives its group and its half
HEX_DIGITS = "0123456789abcdef"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def _spans(text: Column, pattern: str, order: int, group: int = 0) -> Column:
    """All matches as structs; the lengths of what lies between and of the matches give the places."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    pairs = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), value.alias("value"))
    none = F.array().cast(SPANS)

    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(order).alias("order"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.when(x["hit"].isNull(), acc["found"])
                        .otherwise(F.array_append(acc["found"], span)).alias("found"))

    found = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("found")), step, lambda a: a["found"])
    return F.when(text.rlike(pattern), found).otherwise(none)


def _upper_tail(z: Column) -> Column:
    """1 - Phi(z) for z >= 0 by a rational approximation with an error below 1e-7."""
    t = 1 / (1 + 0.2316419 * z)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.exp(-z * z / 2) / F.lit(2.5066282746310002) * poly


def _tests(runs: DataFrame) -> DataFrame:
    """``runs`` (value) with encoding, p and stratum."""
    body = F.regexp_replace(F.translate("value", "-_", "+/"), "=+$", "")
    lower = F.lower(body)
    kind = (F.when(body.rlike("^[0-9a-f]+$|^[0-9A-F]+$"), "hex").when(body.rlike("^[A-Z2-7]+$"), "base32")
            .otherwise("base64"))
    plain = F.regexp_replace(body, "=", "")

    def digits(groups: int) -> Column:
        each = lambda letters: "".join(str(i * groups // len(letters)) for i in range(len(letters)))
        return (F.when(F.col("encoding") == "hex", F.translate(F.lower("body"), HEX_DIGITS, each(HEX_DIGITS)))
                .when(F.col("encoding") == "base32", F.translate("body", BASE32, each(BASE32)))
                .otherwise(F.translate("body", BASE64, each(BASE64))))

    t = runs.withColumn("encoding", kind).withColumn("body", F.when(kind == "hex", lower).otherwise(plain)) \
        .withColumn("n", F.length("body").cast("double")).filter("n >= 16") \
        .withColumn("g", digits(GROUPS)).withColumn("half", digits(2))
    expected = F.col("n") / GROUPS
    chi = sum(((F.length(F.regexp_replace("g", f"[^{k}]", "")) - expected) ** 2 / expected for k in range(GROUPS)), F.lit(0.0))
    df = GROUPS - 1
    # Wilson and Hilferty's normal form of chi-squared; only too uneven counts speak against chance
    z_chi = (F.pow(chi / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / (2 / (9 * df)) ** 0.5
    p_chi = F.when(z_chi > 0, _upper_tail(F.abs(z_chi))).otherwise(1 - _upper_tail(F.abs(z_chi)))
    high = F.length(F.regexp_replace("half", "0", "")).cast("double")
    low = F.col("n") - high
    changes = F.size(F.regexp_extract_all("half", F.lit("0(?=1)|1(?=0)"), F.lit(0))) + 1
    mean = 2 * high * low / F.col("n") + 1
    var = (mean - 1) * (mean - 2) / (F.col("n") - 1)
    z_runs = F.when(var > 0, F.abs(changes - mean) / F.sqrt(var)).otherwise(F.lit(9.0))
    v = F.transform(F.sequence(F.lit(1), F.length("g")), lambda i: F.substring(F.col("g"), i, F.lit(1)).cast("double"))
    t = t.withColumn("p_chi", p_chi).withColumn("z_runs", z_runs).withColumn("v", v)
    avg = F.aggregate("v", F.lit(0.0), lambda a, x: a + x) / F.col("n")
    t = t.withColumn("avg", avg).withColumn("d", F.transform("v", lambda x: x - F.col("avg"))).drop("v")
    square = F.aggregate("d", F.lit(0.0), lambda a, x: a + x * x)
    lag = F.aggregate(F.zip_with(F.slice("d", F.lit(1), F.size("d") - 1), F.slice("d", F.lit(2), F.size("d") - 1),
                                 lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    z_serial = F.when(square > 0, F.abs(lag / square) * F.sqrt("n")).otherwise(F.lit(9.0))
    p = F.least(F.lit(1.0), 3 * F.least("p_chi", 2 * _upper_tail(F.col("z_runs")), 2 * _upper_tail(z_serial)))
    stratum = F.concat_ws(":", "encoding", F.floor(F.log2("n")).cast("string"))
    return t.withColumn("p", p).withColumn("stratum", stratum)


def _random_enough(tested: DataFrame) -> DataFrame:
    """The runs that Benjamini-Hochberg doesn't reject in their stratum and that look drawn."""
    # bin b: p in (10 ** (-(b + 1) / 20), 10 ** (-b / 20)]; its upper edge stands for all p in it
    b = F.least(F.floor(-F.log10(F.greatest("p", F.lit(1e-300))) * BINS_PER_DECADE), F.lit(300 * BINS_PER_DECADE)).cast("int")
    binned = tested.withColumn("bin", b)
    count = binned.groupBy("stratum", "bin").agg(F.count("*").alias("n"))  # strata times 6000 rows at most
    smaller = Window.partitionBy("stratum").orderBy(F.col("bin").desc())
    below = (count.withColumn("k", F.sum("n").over(smaller))
             .withColumn("m", F.sum("n").over(Window.partitionBy("stratum")))
             .filter(F.pow(F.lit(10.0), -F.col("bin") / BINS_PER_DECADE) <= LEVEL * F.col("k") / F.col("m"))
             .groupBy("stratum").agg(F.min("bin").alias("cut")))
    left = binned.join(below, "stratum", "left").filter("cut is null or bin < cut")
    # a short run can escape rejection by its length alone: a drawn key has digits, and letters of both
    # cases where its alphabet has them
    mixed = F.col("body").rlike("[0-9]") & F.col("body").rlike("[A-Za-z]") & (
        (F.col("encoding") != "base64") | (F.col("body").rlike("[a-z]") & F.col("body").rlike("[A-Z]")))
    return left.filter(mixed)


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, base and spans (arrays of start, order of the kind, end, value), ordered by start and kind."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    base = F.concat(F.filter(_spans(F.col("text"), ASSIGN, 0, 2), lambda s: F.length(s["value"]) >= MIN_VALUE),
                    _spans(F.col("text"), ACCESS, 1), _spans(F.col("text"), HEX, 2))
    free = F.filter(F.col("runs"), lambda r: ~F.exists(
        F.col("base"), lambda s: (s["start"] < r["end"]) & (r["start"] < s["end"])))
    table = written(rows.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"),
                                F.array_sort(base).alias("base"), _spans(F.col("text"), RUN, 3).alias("runs"))
                    .withColumn("runs", free), "secret_spans")
    runs = table.filter(F.size("runs") > 0).select("row_key", F.explode("runs").alias("run")) \
        .select("row_key", "run", F.col("run.value").alias("value"))
    tested = written(_tests(runs).select("row_key", "run", "encoding", "body", "p", "stratum"), "secret_runs")
    more = _random_enough(tested).select("row_key", "run").distinct().groupBy("row_key") \
        .agg(F.collect_list("run").alias("more"))
    return table.join(more, "row_key", "left").select(
        "doc_id", "base", F.array_sort(F.concat("base", F.coalesce("more", F.array().cast(SPANS)))).alias("spans"))


def listed(spans: str) -> Column:
    """kind:start:end of an array of spans, comma-joined."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(name, s["order"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["order"] == KINDS.index(kind))).cast("bigint")
