"""The driver's tables in the roles of the reference's data sets.

Coordinates are derived from keys with double arithmetic both engines
evaluate alike: lat = 37.40 + ((key * a) % 10000) * 0.00003, and the same
for lon from 126.80; each role has its own multipliers so that an entity and
a facility made from the same table do not coincide. Districts are nation
names (parts get one by key, since they have no nation).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metroframe.plans.keywords import keyword_columns, spread_pages, top_keywords

NATIONS = 25

# --- fixed values: (lat multiplier, lon multiplier) per role -------------------
COORDS = {
    "library": (7919, 104729),
    "event": (7919, 104729),
    "bus": (3571, 9973),
    "subway": (5381, 7723),
    "park": (6113, 9533),
}

# --- fixed values: stop words for the Latin-script test pages (20 words) ------
PAGE_STOP_WORDS = ["the", "of", "and", "to", "in", "a", "is", "that", "on", "for",
                   "it", "de", "la", "en", "der", "die", "und", "le", "et", "que"]
PAGE_WORD = r"\p{L}+"


# The driver tables' schemas, declared so that a read needs no schema
# inference (which costs a job per read).
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = TABLE_SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def lat_sql(key: str, role: str) -> str:
    return f"(37.40e0 + (({key} * {COORDS[role][0]}) % 10000) * 0.00003e0)"


def lon_sql(key: str, role: str) -> str:
    return f"(126.80e0 + (({key} * {COORDS[role][1]}) % 10000) * 0.00003e0)"


def lat(key: str, role: str) -> Column:
    return F.expr(lat_sql(key, role))


def lon(key: str, role: str) -> Column:
    return F.expr(lon_sql(key, role))


def _nation(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", "n_name")


# --- curated tables from driver tables ----------------------------------------
def libraries(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.join(_nation(spark, sf_dir), s.s_nationkey == F.col("n_nationkey")).select(
        F.col("s_name").alias("lib_name"), lat("s_suppkey", "library").alias("lib_latitude"),
        lon("s_suppkey", "library").alias("lib_longitude"), F.col("n_name").alias("lib_district"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    kw = keyword_columns(
        # the test pages are one row group, hence one task
        top_keywords(spread_pages(spark, table(spark, sf_dir, "pages"), "page_id"), "page_id", "html", pattern=PAGE_WORD,
                     stop_words=PAGE_STOP_WORDS), "page_id",
        ("cul_keyword_1", "cul_keyword_2", "cul_keyword_3"))
    base = c.join(_nation(spark, sf_dir), c.c_nationkey == F.col("n_nationkey"))
    start = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int"))
    ev = base.select(
        F.col("c_custkey"), F.col("c_name").alias("cul_title"), F.col("n_name").alias("cul_district"),
        F.col("c_mktsegment").alias("cul_class"), start.alias("cul_start_date"),
        F.date_add(start, 30).alias("cul_end_date"),
        lat("c_custkey", "event").alias("cul_latitude"), lon("c_custkey", "event").alias("cul_longitude"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", True).when(F.col("c_mktsegment") == "BUILDING", False)
        .otherwise(F.lit(None).cast("boolean")).alias("cul_is_free"))
    return ev.join(kw, ev.c_custkey == kw.page_id, "left").drop("page_id", "c_custkey")


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.join(_nation(spark, sf_dir), (p.p_partkey % NATIONS) == F.col("n_nationkey")).select(
        F.col("p_name").alias("bll_book_name"), F.col("n_name").alias("bll_district"),
        F.col("p_type").alias("bll_class_major"), F.col("p_brand").alias("bll_class_sub"),
        F.col("p_size").cast("bigint").alias("bll_loan_count"))


def bus_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.join(_nation(spark, sf_dir), s.s_nationkey == F.col("n_nationkey")).select(
        F.col("s_name").alias("bus_name"), lat("s_suppkey", "bus").alias("bus_latitude"),
        lon("s_suppkey", "bus").alias("bus_longitude"), F.col("n_name").alias("bus_district"))


def subway_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.join(_nation(spark, sf_dir), c.c_nationkey == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("sta_id"), F.col("c_name").alias("sta_name"),
        lat("c_custkey", "subway").alias("sta_latitude"), lon("c_custkey", "subway").alias("sta_longitude"),
        F.col("c_mktsegment").alias("sta_line"), F.col("n_name").alias("sta_district"))


def parks(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.join(_nation(spark, sf_dir), (p.p_partkey % NATIONS) == F.col("n_nationkey")).select(
        F.col("p_name").alias("park_name"), lat("p_partkey", "park").alias("park_latitude"),
        lon("p_partkey", "park").alias("park_longitude"), F.col("n_name").alias("park_district"))


# --- the same tables as SQL (CTE bodies) for the oracle ----------------------
def html_text_sql(html: str) -> str:
    """Visible text in DuckDB SQL, step by step instead of by tokens: enough for the test pages (ASCII tags, four names)."""
    out = f"regexp_replace({html}, '(?is)<!--.*?-->|<script.*?(</script>|$)|<style.*?(</style>|$)', '', 'g')"
    out = f"regexp_replace({out}, '(?i)</?(html|head|meta|title|body|nav|ul|li|div|article|h1|p|br|footer)(\\s[^>]*|/)?>', ' ', 'g')"
    out = f"regexp_replace({out}, '(?i)<[/!]?[a-z][^>]*>', '', 'g')"
    for name, text in (("quot", '"'), ("middot", "·"), ("copy", "©"), ("amp", "&")):
        out = f"replace({out}, '&{name};', '{text}')"
    return out


def keywords_sql(pages: str = "pages", id_col: str = "page_id", html_col: str = "html",
                 pattern: str = PAGE_WORD, stop_words=PAGE_STOP_WORDS, k: int = 3) -> str:
    """Top-k words per page as SQL: (id, rank, word, n)."""
    stops = ", ".join("'" + w.replace("'", "''") + "'" for w in stop_words)
    text = html_text_sql(html_col)
    return f"""
      SELECT {id_col}, rank, word, n FROM (
        SELECT {id_col}, word, n,
               CAST(row_number() OVER (PARTITION BY {id_col} ORDER BY n DESC, first_pos ASC) AS INTEGER) AS rank
        FROM (
          SELECT {id_col}, word, count(*) AS n, min(pos) AS first_pos FROM (
            SELECT {id_col}, unnest(ws) AS word, CAST(unnest(range(len(ws))) AS INTEGER) AS pos FROM (
              SELECT {id_col}, regexp_extract_all({text}, '{pattern}') AS ws FROM {pages} WHERE {html_col} IS NOT NULL))
          WHERE word NOT IN ({stops})
          GROUP BY {id_col}, word))
      WHERE rank <= {k}"""


def keyword_columns_sql(names=("cul_keyword_1", "cul_keyword_2", "cul_keyword_3"), **kw) -> str:
    cols = ", ".join(f"max(CASE WHEN rank = {i + 1} THEN word END) AS {n}" for i, n in enumerate(names))
    return f"SELECT page_id, {cols} FROM ({keywords_sql(**kw)}) GROUP BY page_id"


LIBRARIES_SQL = f"""SELECT s_name AS lib_name, {lat_sql('s_suppkey', 'library')} AS lib_latitude,
    {lon_sql('s_suppkey', 'library')} AS lib_longitude, n_name AS lib_district
  FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

EVENTS_SQL = f"""SELECT c_name AS cul_title, n_name AS cul_district, c_mktsegment AS cul_class,
    CAST(DATE '2024-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS cul_start_date,
    CAST(DATE '2024-01-01' + CAST(c_custkey % 365 AS INTEGER) + 30 AS DATE) AS cul_end_date,
    {lat_sql('c_custkey', 'event')} AS cul_latitude, {lon_sql('c_custkey', 'event')} AS cul_longitude,
    CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN true WHEN c_mktsegment = 'BUILDING' THEN false END AS cul_is_free,
    kw.cul_keyword_1, kw.cul_keyword_2, kw.cul_keyword_3
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN ({keyword_columns_sql()}) kw ON kw.page_id = c_custkey"""

BOOKS_SQL = f"""SELECT p_name AS bll_book_name, n_name AS bll_district, p_type AS bll_class_major,
    p_brand AS bll_class_sub, CAST(p_size AS BIGINT) AS bll_loan_count
  FROM part JOIN nation ON p_partkey % {NATIONS} = n_nationkey"""

BUS_SQL = f"""SELECT s_name AS bus_name, {lat_sql('s_suppkey', 'bus')} AS bus_latitude,
    {lon_sql('s_suppkey', 'bus')} AS bus_longitude, n_name AS bus_district
  FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

SUBWAY_SQL = f"""SELECT c_custkey AS sta_id, c_name AS sta_name, {lat_sql('c_custkey', 'subway')} AS sta_latitude,
    {lon_sql('c_custkey', 'subway')} AS sta_longitude, c_mktsegment AS sta_line, n_name AS sta_district
  FROM customer JOIN nation ON c_nationkey = n_nationkey"""

PARKS_SQL = f"""SELECT p_name AS park_name, {lat_sql('p_partkey', 'park')} AS park_latitude,
    {lon_sql('p_partkey', 'park')} AS park_longitude, n_name AS park_district
  FROM part JOIN nation ON p_partkey % {NATIONS} = n_nationkey"""
