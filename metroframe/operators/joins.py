"""JN-1, JN-2, JN-3, JN-5: dimension, prefix, containment and calendar joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# buckets over which left rows with a null key are spread in a shuffled join
NULL_KEY_SPREAD = 1024


def left_join_spread_nulls(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
                           right_keys: Sequence[str], spread: int = NULL_KEY_SPREAD) -> DataFrame:
    """Left outer equi-join in which left rows with a null key (they can never
    match) are spread over ``spread`` partitions by a deterministic row hash,
    instead of all hashing alike into one task. Output: left columns, then
    right columns."""
    has_null = None
    for k in left_keys:
        c = F.col(k).isNull()
        has_null = c if has_null is None else has_null | c
    row_hash = F.xxhash64(*[F.col(c) for c in left.columns])
    l = left.withColumn("__nk_salt", F.when(has_null, F.pmod(row_hash, F.lit(spread))).otherwise(F.lit(0)).cast("int"))
    r = right.withColumn("__nk_rsalt", F.lit(0).cast("int"))
    cond = l["__nk_salt"] == r["__nk_rsalt"]
    for a, b in zip(left_keys, right_keys):
        cond = cond & (l[a] == r[b])
    return l.join(r, cond, "left").drop("__nk_salt", "__nk_rsalt")


def left_dimension_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """JN-1: left outer equi-join; unmatched rows keep nulls, several matches fan out.

    The planner broadcasts the dimension from its size statistics or a caller's
    hint; in a shuffled join null fact keys are spread.
    """
    return left_join_spread_nulls(fact, dim, [fact_key], [dim_key])


def prefix_lookup_join(df: DataFrame, id_col: str, lookup: DataFrame, lookup_prefix: str,
                       value_cols: Sequence[str], length: int = 3) -> DataFrame:
    """JN-2: inner join on the first ``length`` characters of ``id_col``.

    Rows whose prefix is missing from the lookup, or whose id is null, drop out
    (the CASE-then-not-null chain of the reference).
    """
    lk = lookup.select(F.col(lookup_prefix).alias("__prefix"), *value_cols)
    keyed = df.withColumn("__prefix", F.substring(F.col(id_col), 1, length))
    return keyed.join(lk, "__prefix", "inner").drop("__prefix")


GRAM = 5
KEY_WORDS = 1 << 14  # 2^20 bits for the hashes of a containment join's keys
REACH = 64  # characters of the longest term that is compared at an anchor of a text
SIDE = 3  # characters on either side of an anchor that name the terms to compare there
FEW_TERMS = 1 << 18  # rows of a list of terms that is held in memory
PAD = "\0"  # stands before a text's first character


def text_grams(text, gram: int = GRAM):
    """The distinct substrings of ``gram`` characters of a text column, and the shorter ones at its end, in time linear
    in its length (a substring by its place would count characters from the start each time)."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(rf"(?s)(?=(.{{1,{gram}}}))"), F.lit(1)))


def _heads(grams, n: int):
    return F.array_distinct(F.transform(grams, lambda g: F.substring(g, 1, n)))


def rarest_grams(terms: DataFrame, term_col: str, gram: int = GRAM) -> DataFrame:
    """(term, __key): each distinct term with the one of its substrings of ``gram`` characters (of a shorter term, itself) that
    the fewest terms have; ties by the substring."""
    own = terms.select(F.col(term_col).alias("__term")).where(F.length("__term") > 0).distinct()
    grams = F.filter(text_grams(F.col("__term"), gram), lambda g: F.length(g) == F.least(F.length("__term"), F.lit(gram)))
    pairs = own.select("__term", F.explode(grams).alias("__key"))
    count = pairs.groupBy("__key").agg(F.count(F.lit(1)).alias("__n"))
    best = F.min(F.struct("__n", "__key")).alias("__best")
    return pairs.join(count, "__key").groupBy("__term").agg(best).select("__term", F.col("__best.__key").alias("__key"))


def _key_bits(index: DataFrame, words: int):
    """The keys' hashes as ``words`` numbers of 64 bits each, in a subquery that runs with the join: of a bounded size whatever
    the number of terms, and without false negatives."""
    h = F.pmod(F.xxhash64("__key"), F.lit(words * 64))
    bits = index.select(h.alias("__h")).groupBy(F.expr("CAST(__h DIV 64 AS BIGINT)").alias("__w")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(__h % 64 AS INT)))").alias("__b"))
    every = index.sparkSession.range(words).join(bits, F.col("id") == F.col("__w"), "left")
    rows = F.array_sort(F.collect_list(F.struct("id", F.coalesce("__b", F.lit(0).cast("long")).alias("b"))))
    return every.agg(F.transform(rows, lambda r: r["b"]).alias("bits")).scalar()


def _may_be_key(gram, bits):
    h = F.pmod(F.xxhash64(gram), F.lit(KEY_WORDS * 64))
    return F.getbit(F.get(bits, F.shiftright(h, 6).cast("int")), (h % 64).cast("int")) == 1


def _term_anchors(terms: DataFrame, term_col: str) -> DataFrame:
    """(term, __anchor, __at, __before, __after): each distinct term, the one of its characters that the most terms have (ties
    by the character), its first place in the term, and how many characters around that place belong to the term's key."""
    own = terms.select(F.col(term_col).alias("__term")).where(F.length("__term") > 0).distinct()
    chars = own.select("__term", F.explode(F.array_distinct(F.split("__term", ""))).alias("__anchor"))
    count = chars.groupBy("__anchor").agg(F.count(F.lit(1)).alias("__n"))
    best = F.max(F.struct("__n", "__anchor")).alias("__best")
    at = chars.join(count.hint("shuffle_hash"), "__anchor").groupBy("__term").agg(best).select(
        "__term", F.col("__best.__anchor").alias("__anchor"), F.instr(F.col("__term"), F.col("__best.__anchor")).alias("__at"))
    after = F.least(F.length("__term") - F.col("__at"), F.lit(SIDE))
    return at.select("*", F.least(F.col("__at") - 1, F.lit(SIDE)).alias("__before"), after.alias("__after"))


def _window_matches(texts: DataFrame, text_col: str, terms: DataFrame, term_col: str) -> DataFrame:
    """(__text, term): each different pair of a text's digest and a term that the text contains, for a list that fits in memory.

    A text is cut once, where it has an anchor: into the anchor and its neighbours, as many on either side as the longest term
    has. The few characters next to the anchor name the terms to compare there (by a hash; equality decides). The pattern and
    the terms' shapes are a subquery that runs with the join."""
    index = _term_anchors(terms, term_col)
    code = F.concat(F.lit(r"\x{"), F.hex(F.ascii("__anchor")), F.lit("}"))
    made = index.agg(F.struct(
        F.concat_ws("", F.array_sort(F.collect_set(code))).alias("anchors"),
        F.max(F.greatest(F.col("__at") - 1, F.length("__term") - F.col("__at"), F.lit(SIDE))).alias("reach"),
        F.array_sort(F.collect_set(F.struct("__before", "__after"))).alias("shapes")).alias("made")).scalar()
    reach = made["reach"]
    # the last code point stands in the class as itself: by it Java looks back over code points instead of halves of pairs
    pattern = F.concat(F.lit("(?s)(?=["), made["anchors"], F.lit("])(?<=(?=(.{"), reach + 1, F.lit("}.{0,"), reach,
                       F.lit("}))[\\x{0}-\U0010ffff]{"), reach, F.lit("})"))
    padded = F.concat(F.repeat(F.lit(PAD), reach), F.col(text_col))
    windows = texts.select("__text", F.explode(F.regexp_extract_all(padded, pattern, F.lit(1))).alias("__window"))
    core = F.substring("__window", reach + 1 - SIDE, F.lit(2 * SIDE + 1)).alias("__core")
    probes = windows.select("*", core).select("*", F.explode(made["shapes"]).alias("__shape"))
    width = F.col("__shape.__before") + F.col("__shape.__after") + 1
    near = F.substring("__core", F.lit(SIDE + 1) - F.col("__shape.__before"), width)
    key = F.substring("__term", F.col("__at") - F.col("__before"), F.col("__before") + F.col("__after") + 1)
    keyed = index.select(F.xxhash64(key).alias("__key"), "__term", "__at")
    found = probes.select("__text", "__window", F.xxhash64(near).alias("__key")).join(F.broadcast(keyed), "__key")
    same = F.substring("__window", reach + 2 - F.col("__at"), F.length("__term")) == F.col("__term")
    return found.where(same).select("__text", "__term").distinct()


def _gram_candidates(texts: DataFrame, text_col: str, terms: DataFrame, term_col: str, gram: int) -> DataFrame:
    """(__text, term, __own): a text's digest with each term whose rarest gram it has, and the term's rows, for a list of any size."""
    keys = rarest_grams(terms, term_col, gram)
    # the lengths of the index's keys: a subquery of at most ``gram`` numbers, run with the join
    lengths = keys.agg(F.collect_set(F.length("__key")).alias("n")).scalar()
    own = terms.where(F.length(term_col) > 0).groupBy(F.col(term_col).alias("__term")).agg(
        F.collect_list(F.struct(*terms.columns)).alias("__own"))
    every = F.regexp_extract_all(F.col(text_col), F.lit(rf"(?s)(?=(.{{1,{gram}}}))"), F.lit(1))
    cut = texts.select("__text", F.explode(every).alias("__gram"))
    # the subqueries' values stay out of the rows: as columns they would be copied with every gram
    bits, whole = _key_bits(keys, KEY_WORDS), F.col("__gram")
    heads = [F.when(_may_be_key(whole, bits), whole)]
    heads += [F.when(F.array_contains(lengths, n) & _may_be_key(F.left(whole, F.lit(n)), bits), F.left(whole, F.lit(n))) for n in range(1, gram)]
    cut = cut.where(F.coalesce(*heads).isNotNull()).select("__text", F.explode(F.array(*heads)).alias("__key"))
    cut = cut.where(F.col("__key").isNotNull()).distinct()
    return cut.join(keys.join(own, "__term").hint("shuffle_hash"), "__key").drop("__key")


def contains_join(df: DataFrame, text_col: str, terms: DataFrame, term_col: str, gram: int = GRAM, few: int = FEW_TERMS) -> DataFrame:
    """JN-3: route each row to every term its text contains (a theta join), as
    equi-joins on an index of the terms.

    Texts stand for their rows by a SHA-256 digest; what is found joins back to the rows by a merge join, which spills, so that no
    task has to hold what its texts contain. Terms of up to ``REACH`` characters, if the list has at most ``few`` rows, are
    compared in place, at the anchors of a text: an exact answer without a shuffle of the text's grams. All others take the
    index by their rarest gram: a text meets only the terms whose rarest gram it has, its grams carry only the digest, and
    ``contains`` decides. Which way the terms go is decided as the join runs; a way without terms drops the texts as it reads them.
    Texts are cut in time linear in their length, into shorter grams only where there are shorter terms, and a gram whose
    hash no key of the index has goes no further. Rows are never broadcast, whatever sizes the planner expects. Empty and
    null terms match nothing; repeated rows and repeated terms are all kept. Columns of the two sides must have different names.
    """
    term = F.col(term_col)
    short = (F.length(term) <= REACH) & ~term.contains(PAD)
    size = terms.agg((F.count(F.lit(1)) <= few) & (F.coalesce(F.sum(F.length(term)), F.lit(0)) <= few * REACH)).scalar()
    near, far = terms.where(short & size), terms.where((F.length(term) > 0) & ~(short & size))
    # never null, so that no filter on it keeps the two reads of the texts from sharing one exchange
    digest = F.coalesce(F.unhex(F.sha2(F.col(text_col).cast("binary"), 256)), F.lit(b""))
    texts = df.where(F.col(text_col).isNotNull()).withColumn("__text", digest)
    columns = [F.col(c) for c in df.columns]

    some = texts.where(near.agg(F.count(F.lit(1)) > 0).scalar())
    own = near.select(term.alias("__term"), *[F.col(c).alias(f"__own_{c}") for c in terms.columns])
    rows = some.join(_window_matches(some, text_col, near, term_col).hint("merge"), "__text").join(F.broadcast(own), "__term")
    in_place = rows.select(*columns, *[F.col(f"__own_{c}").alias(c) for c in terms.columns])

    some = texts.where(far.agg(F.count(F.lit(1)) > 0).scalar())
    rows = some.join(_gram_candidates(some, text_col, far, term_col, gram).hint("merge"), "__text")
    rows = rows.where(F.col(text_col).contains(F.col("__term"))).select(*columns, F.explode("__own").alias("__o"))
    return in_place.unionByName(rows.select(*columns, *[F.col("__o")[c].alias(c) for c in terms.columns]))


def month_grid(start_month, end_month, keys: DataFrame) -> DataFrame:
    """JN-5 + DT-3: every (month, key) with the month's first and last day.

    ``start_month``/``end_month`` are date columns or 'yyyy-MM-dd' strings;
    the months are generated by ``sequence`` and exploded per key row, so the
    work is distributed with the key table.
    """
    s = F.to_date(F.lit(start_month)) if isinstance(start_month, str) else start_month
    e = F.to_date(F.lit(end_month)) if isinstance(end_month, str) else end_month
    months = F.sequence(F.trunc(s, "month"), F.trunc(e, "month"), F.expr("interval 1 month"))
    return (keys.withColumn("month_start", F.explode(months))
            .withColumn("month_end", F.last_day("month_start")))
