"""Projection, filter, string, date, dedup, quality and lookup operators on
driver tables (PRJ-*, FLT-1..3, STR-*, ARR-*, DT-*, JN-1/2/3/5, DUP-1,
TOP-3, DQ-1, AGG-3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from metroframe.bindings import query
from metroframe.bindings import tables as tb
from metroframe.functions import dates as D
from metroframe.functions import text as X
from metroframe.operators import filters as FL
from metroframe.operators import joins as J
from metroframe.operators import projection as P
from metroframe.operators.aggregates import row_count
from metroframe.session import scratch_path
from metroframe.sinks.versions import publish, read_published
from metroframe.operators.quality import ObservedQuality, Rule, check_quality, store_results
from metroframe.operators.ranking import drop_duplicates_stable, first_row


# --- raw-like text tables ---------------------------------------------------------
def raw_orders(spark, d):
    """orders as an all-text feed: prices as '%.2f' text, pending orders carry
    their priority text where a number is expected, dates as text."""
    o = tb.table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("ORDER_NO"),
        F.col("o_custkey").cast("string").alias("CUST_NO"),
        F.col("o_orderstatus").alias("STATUS"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))
        .otherwise(F.format_string("%.2f", F.col("o_totalprice"))).alias("TOTAL"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("ORDER_DATE"),
        F.col("o_orderpriority").alias("PRIORITY"))


RAW_ORDERS_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS ORDER_NO, CAST(o_custkey AS VARCHAR) AS CUST_NO,
    o_orderstatus AS STATUS,
    CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE printf('%.2f', o_totalprice) END AS TOTAL,
    strftime(o_orderdate, '%Y-%m-%d') AS ORDER_DATE, o_orderpriority AS PRIORITY FROM orders"""

# total as a number: null for the pending rows' text
TOTAL_SQL = "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(printf('%.2f', o_totalprice) AS DOUBLE) END"
TOTAL_INT_SQL = f"CAST(trunc({TOTAL_SQL}) AS INTEGER)"


@query("prj_select_cast", f"""
SELECT o_orderkey AS order_id, {TOTAL_SQL} AS total, {TOTAL_INT_SQL} AS total_int,
       CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS status FROM orders""")
def q_prj_select_cast(spark, d):
    """PRJ-1: select with rename and lenient cast ('5-LOW' as a number -> null,
    '112946.26' as an int -> 112946)."""
    return P.select_cast(raw_orders(spark, d), [
        ("ORDER_NO", "order_id", "bigint"), ("TOTAL", "total", "double"), ("TOTAL", "total_int", "int"),
        ("ORDER_DATE", "order_date", "date"), ("STATUS", "status", None)])


@query("prj_rename", f"""
SELECT ORDER_NO AS order_no, CUST_NO AS customer_no, STATUS AS status, TOTAL AS total_text,
       ORDER_DATE AS order_date_text, PRIORITY FROM ({RAW_ORDERS_SQL})""")
def q_prj_rename(spark, d):
    """PRJ-2: bulk rename; unlisted columns (PRIORITY) are kept as they are."""
    return P.rename_columns(raw_orders(spark, d), {
        "ORDER_NO": "order_no", "CUST_NO": "customer_no", "STATUS": "status", "TOTAL": "total_text",
        "ORDER_DATE": "order_date_text", "ABSENT": "never_there"})


@query("prj_cast_schema", f"""
SELECT o_orderkey AS ORDER_NO, o_custkey AS CUST_NO, o_orderstatus AS STATUS, {TOTAL_INT_SQL} AS TOTAL,
       CAST(o_orderdate AS DATE) AS ORDER_DATE, o_orderpriority AS PRIORITY FROM orders""")
def q_prj_cast_schema(spark, d):
    """PRJ-3: cast the whole schema; ids stay exact, the int column truncates
    decimal text and nulls non-numeric text."""
    return P.cast_columns(raw_orders(spark, d), {"ORDER_NO": "bigint", "CUST_NO": "bigint", "TOTAL": "int",
                                                 "ORDER_DATE": "date"})


@query("prj_apply_mapping", f"""
SELECT o_orderkey AS order_id, {TOTAL_SQL} AS order_total, CAST(o_orderdate AS DATE) AS order_date,
       CAST(NULL AS VARCHAR) AS note FROM orders""")
def q_prj_apply_mapping(spark, d):
    """PRJ-4: (source, target, type) mapping, sources matched without case,
    unmapped columns dropped, an absent source gives nulls."""
    return P.apply_mapping(raw_orders(spark, d), [
        ("order_no", "order_id", "bigint"), ("Total", "order_total", "double"),
        ("order_date", "order_date", "date"), ("note", "note", "string")])


@query("prj_positional_rename", f"""
SELECT ORDER_NO AS c1, CUST_NO AS c2, STATUS AS c3, TOTAL AS c4, ORDER_DATE AS c5, PRIORITY AS c6
FROM ({RAW_ORDERS_SQL})""")
def q_prj_positional_rename(spark, d):
    """PRJ-5: toDF by position."""
    return P.positional_rename(raw_orders(spark, d), ["c1", "c2", "c3", "c4", "c5", "c6"])


@query("prj_drop", f"SELECT ORDER_NO, CUST_NO, STATUS, TOTAL, ORDER_DATE FROM ({RAW_ORDERS_SQL})")
def q_prj_drop(spark, d):
    """PRJ-6."""
    return P.drop_columns(raw_orders(spark, d), "PRIORITY")


# --- stop ids with a district prefix (PRJ-9, JN-2, STR-1, FLT-1) -------------------
def raw_stops(spark, d):
    """supplier as bus stops: id = (100 + nation) followed by the 5-digit key;
    suppliers in debt have no id."""
    s = tb.table(spark, d, "supplier")
    stop_id = F.when(F.col("s_acctbal") < 0, F.lit(None).cast("string")).otherwise(
        F.concat((F.col("s_nationkey") + 100).cast("string"), F.lpad(F.col("s_suppkey").cast("string"), 5, "0")))
    return s.select("s_suppkey", stop_id.alias("stop_id"))


STOPS_SQL = """SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN NULL
    ELSE CAST(s_nationkey + 100 AS VARCHAR) || lpad(CAST(s_suppkey AS VARCHAR), 5, '0') END AS stop_id FROM supplier"""

# the lookup knows 22 of the 25 prefixes: ids of the other three drop out
KNOWN_PREFIXES = 22
PREFIX_MAPPING = [(str(100 + k), f"NATION_{k}") for k in range(KNOWN_PREFIXES)]


def _lookup(spark, d):
    n = tb.table(spark, d, "nation")
    return n.where(F.col("n_nationkey") < KNOWN_PREFIXES).select(
        (F.col("n_nationkey") + 100).cast("string").alias("id_prefix"), F.col("n_name").alias("district"))


CASE_SQL = ("CASE " + " ".join(f"WHEN substring(stop_id, 1, 3) = '{c}' THEN '{v}'" for c, v in PREFIX_MAPPING)
            + " END")


@query("prj_case_prefix", f"SELECT s_suppkey, stop_id, {CASE_SQL} AS district FROM ({STOPS_SQL})")
def q_prj_case_prefix(spark, d):
    """PRJ-9: searched CASE over a 3-character prefix, else null."""
    s = raw_stops(spark, d)
    return s.select("s_suppkey", "stop_id", P.case_by_prefix("stop_id", PREFIX_MAPPING).alias("district"))


@query("flt_not_null", f"""
SELECT s_suppkey, stop_id, district FROM (SELECT s_suppkey, stop_id, {CASE_SQL} AS district FROM ({STOPS_SQL}))
WHERE district IS NOT NULL""")
def q_flt_not_null(spark, d):
    """FLT-1: rows whose CASE found no district are dropped."""
    return FL.not_null(q_prj_case_prefix(spark, d), "district")


@query("jn_prefix_lookup", f"""
SELECT s.s_suppkey, s.stop_id, n_name AS district FROM ({STOPS_SQL}) s
JOIN nation ON substring(s.stop_id, 1, 3) = CAST(n_nationkey + 100 AS VARCHAR) AND n_nationkey < {KNOWN_PREFIXES}""")
def q_jn_prefix_lookup(spark, d):
    """JN-2: the same mapping kept as a table, joined on the prefix (inner:
    unknown prefixes and null ids drop)."""
    return J.prefix_lookup_join(raw_stops(spark, d), "stop_id", _lookup(spark, d), "id_prefix", ["district"])


@query("str_prefix", f"SELECT s_suppkey, substring(stop_id, 1, 3) AS id_prefix FROM ({STOPS_SQL})")
def q_str_prefix(spark, d):
    """STR-1: 1-based prefix of length 3 (null id -> null)."""
    return raw_stops(spark, d).select("s_suppkey", X.prefix("stop_id", 3).alias("id_prefix"))


@query("prj_bool_recode", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN true WHEN o_orderstatus = 'O' THEN false END AS is_final
FROM orders""")
def q_prj_bool_recode(spark, d):
    """PRJ-10: F -> true, O -> false, anything else null."""
    o = tb.table(spark, d, "orders")
    return o.select("o_orderkey", P.recode_bool("o_orderstatus", "F", "O").alias("is_final"))


# --- filters --------------------------------------------------------------------------
@query("flt_in_list", """
SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""")
def q_flt_in_list(spark, d):
    """FLT-2: IN list, pushed to the Parquet scan."""
    c = tb.table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return FL.in_list(c, "c_mktsegment", ["BUILDING", "MACHINERY"])


@query("flt_contains", "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'red')")
def q_flt_contains(spark, d):
    """FLT-3: literal substring."""
    return FL.contains(tb.table(spark, d, "part").select("p_partkey", "p_name"), "p_name", "red")


# --- fixed values: terms routed by containment ('old' is inside 'cold') ----------------
CONTAIN_TERMS = ["red", "blue", "old", "hot"]


@query("jn_contains", f"""
SELECT p_partkey, p_name, term FROM part JOIN (SELECT unnest([{', '.join(repr(t) for t in CONTAIN_TERMS)}]) AS term) t
  ON contains(p_name, t.term)""")
def q_jn_contains(spark, d):
    """JN-3: each part routed to every term its name contains."""
    terms = FL.word_list(spark, CONTAIN_TERMS, "term")
    return J.contains_join(tb.table(spark, d, "part").select("p_partkey", "p_name"), "p_name", terms, "term")


# --- strings and arrays -----------------------------------------------------------------
@query("str_strip_parens", """
SELECT p_partkey, trim(regexp_replace(p_name || ' (' || p_brand || ') (' || p_type || ')', '\\(.*?\\)', '', 'g'))
  AS clean_name FROM part""")
def q_str_strip_parens(spark, d):
    """STR-5 + STR-4: parenthesised parts removed non-greedily, then trimmed."""
    p = tb.table(spark, d, "part")
    packed = F.concat(F.col("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(") ("), F.col("p_type"), F.lit(")"))
    return p.select("p_partkey", X.strip_parenthesised(packed).alias("clean_name"))


@query("str_trim", "SELECT c_custkey, trim('  ' || c_name || ' ') AS name FROM customer")
def q_str_trim(spark, d):
    """STR-4."""
    c = tb.table(spark, d, "customer")
    return c.select("c_custkey", X.trim(F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))).alias("name"))


CATEGORY_SQL = ("concat_ws(' > ', p_type, p_brand, CASE WHEN p_size > 25 THEN p_name END)")


@query("str_split_columns", f"""
SELECT p_partkey, string_split({CATEGORY_SQL}, ' > ')[1] AS class_major,
       string_split({CATEGORY_SQL}, ' > ')[2] AS class_sub,
       string_split({CATEGORY_SQL}, ' > ')[3] AS class_detailed FROM part""")
def q_str_split_columns(spark, d):
    """STR-3: 'a > b > c' into exactly three columns, null when shorter."""
    p = tb.table(spark, d, "part")
    cat = F.concat_ws(" > ", "p_type", "p_brand", F.when(F.col("p_size") > 25, F.col("p_name")))
    return p.select("p_partkey", *[X.split_part(cat, " > ", i).alias(n)
                                   for i, n in enumerate(["class_major", "class_sub", "class_detailed"])])


@query("str_regexp_extract", r"""
SELECT p_partkey, regexp_extract(p_name, '^(\S+) (widget|gear|bolt|ring)', 1) AS qualifier FROM part""")
def q_str_regexp_extract(spark, d):
    """STR-6: group 1 of a pattern; '' when it does not match."""
    p = tb.table(spark, d, "part")
    return p.select("p_partkey", X.extract_group("p_name", r"^(\S+) (widget|gear|bolt|ring)", 1).alias("qualifier"))


@query("str_concat_ws", """
SELECT c_custkey, concat_ws(',', nullif(c_mktsegment, 'BUILDING'), CASE WHEN c_acctbal > 0 THEN c_name END,
       nullif(c_mktsegment, c_mktsegment)) AS joined FROM customer""")
def q_str_concat_ws(spark, d):
    """STR-7: join with ',', nulls skipped, all null -> ''."""
    c = tb.table(spark, d, "customer")
    return c.select("c_custkey", X.join_non_null(
        ",", F.nullif("c_mktsegment", F.lit("BUILDING")), F.when(F.col("c_acctbal") > 0, F.col("c_name")),
        F.nullif("c_mktsegment", "c_mktsegment")).alias("joined"))


@query("str_fill_empty", """
SELECT c_custkey, coalesce(nullif(c_mktsegment, 'MACHINERY'), '') AS segment FROM customer""")
def q_str_fill_empty(spark, d):
    """STR-11: missing text -> ''."""
    c = tb.table(spark, d, "customer")
    return c.select("c_custkey", X.fill_empty(F.nullif("c_mktsegment", F.lit("MACHINERY"))).alias("segment"))


@query("arr_get", """
SELECT p_partkey, string_split(p_name, ' ')[1] AS w0, string_split(p_name, ' ')[2] AS w1,
       string_split(p_name, ' ')[3] AS w2 FROM part""")
def q_arr_get(spark, d):
    """ARR-2: element i of an array, null beyond the end."""
    p = tb.table(spark, d, "part")
    arr = F.split("p_name", " ")
    return p.select("p_partkey", *[X.element_or_null(arr, i).alias(f"w{i}") for i in range(3)])


# --- dates -------------------------------------------------------------------------------
@query("dt_parse_date", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS from_timestamp_text, CAST(o_orderdate AS DATE) AS from_short_text,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS from_mixed_text FROM orders""")
def q_dt_parse_date(spark, d):
    """DT-1: '2024-01-05 00:00:00.0', '2024-1-5' and non-date text to dates."""
    o = tb.table(spark, d, "orders")
    ts_text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.lit(".0"))
    short = F.concat_ws("-", F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate"))
    mixed = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(short)
    return o.select("o_orderkey", D.parse_date(ts_text).alias("from_timestamp_text"),
                    D.parse_date(short).alias("from_short_text"), D.parse_date(mixed).alias("from_mixed_text"))


@query("dt_parse_month", """
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start FROM orders""")
def q_dt_parse_month(spark, d):
    """DT-2: 'yyyyMM' text to the month's first day."""
    o = tb.table(spark, d, "orders")
    return o.select("o_orderkey", D.parse_month(F.date_format("o_orderdate", "yyyyMM")).alias("month_start"))


@query("dt_prev_month", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH AS DATE) AS prev_month,
       strftime(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH, '%Y%m') AS prev_month_text FROM orders""")
def q_dt_prev_month(spark, d):
    """DT-4: one month earlier (clamped to month end) and as 'yyyyMM'."""
    o = tb.table(spark, d, "orders")
    prev = D.previous_month(F.col("o_orderdate").cast("date"))
    return o.select("o_orderkey", prev.alias("prev_month"), F.date_format(prev, "yyyyMM").alias("prev_month_text"))


@query("dt_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(month(o_orderdate) AS INTEGER) AS mo,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
       CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS month_end
FROM orders""")
def q_dt_parts(spark, d):
    """DT-5 + DT-3: year and month parts, month start, and month end as
    start + 1 month - 1 day."""
    o = tb.table(spark, d, "orders")
    start = F.trunc(F.col("o_orderdate").cast("date"), "month")
    return o.select("o_orderkey", F.year("o_orderdate").alias("yr"), F.month("o_orderdate").alias("mo"),
                    start.alias("month_start"), F.date_sub(D.add_months(start, 1), 1).alias("month_end"))


@query("dt_format", """
SELECT o_orderkey, strftime(o_orderdate, '%y%m%d') AS request_date,
       year(o_orderdate) || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS year_month FROM orders""")
def q_dt_format(spark, d):
    """STR-12: 'yyMMdd' request dates and zero-padded months."""
    o = tb.table(spark, d, "orders")
    ym = F.concat(F.year("o_orderdate").cast("string"), F.lpad(F.month("o_orderdate").cast("string"), 2, "0"))
    return o.select("o_orderkey", D.request_date_text("o_orderdate").alias("request_date"), ym.alias("year_month"))


@query("dt_shift_zone", """
SELECT event_id, ts + INTERVAL 9 HOUR AS local_ts, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS local_text
FROM events""")
def q_dt_shift_zone(spark, d):
    """DT-6: UTC to UTC+9 and formatted."""
    e = tb.table(spark, d, "events")
    local = D.shift_hours("ts", 9)
    return e.select("event_id", local.alias("local_ts"), F.date_format(local, "yyyy-MM-dd HH:mm:ss").alias("local_text"))


@query("jn_month_district", """
WITH span AS (
  SELECT c_nationkey, min(o_orderdate) AS lo, max(o_orderdate) AS hi
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey)
SELECT n_name AS district, CAST(m AS DATE) AS month_start, last_day(CAST(m AS DATE)) AS month_end
FROM span JOIN nation ON c_nationkey = n_nationkey,
     unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), INTERVAL 1 MONTH)) AS g(m)""")
def q_jn_month_district(spark, d):
    """JN-5 + DT-3: every month of each district's order span, with its last
    day (months generated per district row, no cross join)."""
    o = tb.table(spark, d, "orders")
    c = tb.table(spark, d, "customer")
    span = (o.join(c, o.o_custkey == c.c_custkey).groupBy("c_nationkey")
            .agg(F.min("o_orderdate").cast("date").alias("lo"), F.max("o_orderdate").cast("date").alias("hi")))
    keyed = span.join(tb.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    grid = J.month_grid(F.col("lo"), F.col("hi"), keyed)
    return grid.select(F.col("n_name").alias("district"), "month_start", "month_end")


# --- left dimension join over an exploded packed list (JN-1, STR-2, ARR-1) --------------
def packed_districts(spark, d):
    """region rows with their nations packed as 'NATION_1(1), NATION_6(6), ...'."""
    n = tb.table(spark, d, "nation")
    r = tb.table(spark, d, "region")
    items = n.select("n_regionkey", F.concat(F.col("n_name"), F.lit("("), F.col("n_nationkey").cast("string"),
                                             F.lit(")")).alias("item"))
    packed = items.groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list("item")), ", ").alias("stations"))
    return r.join(packed, r.r_regionkey == packed.n_regionkey).select(F.col("r_name").alias("area"), "stations")


@query("str_split_explode", """
SELECT r_name AS area, trim(regexp_replace(n_name || '(' || n_nationkey || ')', '\\(.*?\\)', '', 'g')) AS station_name
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def q_str_split_explode(spark, d):
    """STR-2 + ARR-1 + STR-5: packed list split on ', ', one row per element,
    parenthesised line removed."""
    from metroframe.plans.curated import station_districts
    return station_districts(packed_districts(spark, d), "area", "stations").withColumnRenamed("sta_district", "area")


@query("jn_left_dim", """
SELECT s_suppkey, n_name AS station_name, r_name AS area
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def q_jn_left_dim(spark, d):
    """JN-1: suppliers (as stations named after their nation) left-joined to
    the exploded (area, station) dimension."""
    from metroframe.plans.curated import station_districts
    s = tb.table(spark, d, "supplier")
    n = tb.table(spark, d, "nation")
    named = s.join(n, s.s_nationkey == n.n_nationkey, "left").select("s_suppkey", F.col("n_name").alias("station_name"))
    dims = station_districts(packed_districts(spark, d), "area", "stations").withColumnRenamed("station_name", "dim_name")
    out = J.left_dimension_join(named, dims, "station_name", "dim_name")
    return out.select("s_suppkey", "station_name", F.col("sta_district").alias("area"))


# --- dedup, first row, counts, quality -----------------------------------------------------
LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("dup_key_subset", f"""
SELECT {', '.join(LINE_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY
    {', '.join(c + ' ASC NULLS FIRST' for c in LINE_COLS if c not in ('l_orderkey', 'l_returnflag'))}) AS rn
  FROM lineitem) WHERE rn = 1""")
def q_dup_key_subset(spark, d):
    """DUP-1: one row per (l_orderkey, l_returnflag), the first under the
    other columns, so reruns keep the same row."""
    return drop_duplicates_stable(tb.table(spark, d, "lineitem").select(*LINE_COLS), ["l_orderkey", "l_returnflag"])


@query("lim_first", f"SELECT {', '.join(LINE_COLS)} FROM lineitem ORDER BY l_orderkey, l_linenumber LIMIT 1")
def q_lim_first(spark, d):
    """TOP-3: the first row under a total order (a top-1)."""
    return first_row(tb.table(spark, d, "lineitem").select(*LINE_COLS), [F.col("l_orderkey"), F.col("l_linenumber")])


@query("agg_row_count", "SELECT count(*) AS row_count FROM lineitem")
def q_agg_row_count(spark, d):
    """AGG-3."""
    return row_count(tb.table(spark, d, "lineitem"))


@query("src_parquet_scan", """
SELECT l_orderkey, l_partkey, l_quantity, l_shipdate FROM lineitem WHERE l_quantity > 25 AND l_returnflag = 'R'""")
def q_src_parquet_scan(spark, d):
    """SRC-11: Parquet scan; the projection and both predicates reach the
    reader (ReadSchema of 5 columns, PushedFilters)."""
    li = tb.table(spark, d, "lineitem")
    return li.where((F.col("l_quantity") > 25) & (F.col("l_returnflag") == "R")).select(
        "l_orderkey", "l_partkey", "l_quantity", "l_shipdate")


DQ_RULES = [
    Rule("column_count", ">", 0),
    Rule("row_count", ">", 0),
    Rule("completeness", ">=", 0.99, "o_custkey"),
    Rule("uniqueness", "=", 1.0, "o_orderkey"),
    Rule("uniqueness", ">", 0.5, "o_orderstatus"),
]


def _dq_sql() -> str:
    parts = []
    for i, r in enumerate(DQ_RULES):
        if r.kind == "column_count":
            v = "6.0"
        elif r.kind == "row_count":
            v = "CAST(count(*) AS DOUBLE)"
        elif r.kind == "completeness":
            v = f"CASE WHEN count(*) > 0 THEN count({r.column}) / count(*) ELSE 1.0 END"
        else:
            v = f"CASE WHEN count(*) > 0 THEN count(DISTINCT {r.column}) / count(*) ELSE 1.0 END"
        op = "=" if r.op == "=" else r.op
        parts.append(f"SELECT {i} AS rule_id, '{r.name}' AS rule, CAST({v} AS DOUBLE) AS value, "
                     f"CAST({v} AS DOUBLE) {op} {float(r.threshold)!r} AS passed FROM orders HAVING true")
    return "\nUNION ALL ".join(parts)


@query("dq_ruleset", _dq_sql())
def q_dq_ruleset(spark, d):
    """DQ-1: five rules over orders in one aggregation, one row per rule."""
    return check_quality(tb.table(spark, d, "orders"), DQ_RULES)


@query("dq_observed", "SELECT 'orders' AS dataset, * FROM (" + _dq_sql() + ")")
def q_dq_observed(spark, d):
    """DQ-1: the same rules, measured by the write that publishes the table; the stored results come back."""
    path, kept = scratch_path(spark, "orders_checked"), scratch_path(spark, "quality_results")
    quality = ObservedQuality(tb.table(spark, d, "orders"), DQ_RULES)
    publish(quality.data, path)
    store_results(quality.results(read_published(spark, path)), kept, "orders", path)
    return spark.read.parquet(kept).select("dataset", "rule_id", "rule", "value", "passed")


PHRASES_SQL = """SELECT DISTINCT w[i] || ' ' || w[i + 1] AS phrase
  FROM (SELECT w, unnest(range(1, len(w))) AS i FROM (SELECT string_split(text, ' ') AS w FROM benchmark WHERE text IS NOT NULL))"""


@query("jn_contains_list", f"SELECT doc_id, phrase FROM documents JOIN ({PHRASES_SQL}) ON contains(text, phrase)")
def q_jn_contains_list(spark, d):
    """JN-3 with a large list: every document with every neighbouring pair of words of ``benchmark`` that its whole text contains."""
    w = spark.read.parquet(f"{d}/benchmark.parquet").select(F.split("text", " ").alias("w"))
    pairs = F.zip_with(F.slice("w", 1, F.size("w") - 1), F.slice("w", 2, F.size("w") - 1), lambda a, b: F.concat_ws(" ", a, b))
    phrases = w.where(F.size("w") > 1).select(F.explode(pairs).alias("phrase")).distinct()
    docs = tb.table(spark, d, "documents").select("doc_id", "text").repartition("doc_id")
    return J.contains_join(docs, "text", phrases, "phrase").select("doc_id", "phrase")
