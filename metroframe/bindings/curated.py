"""The composed curated jobs (P-1..P-4, P-6, P-7) on raw text made from the
driver's tables; a nation key k stands for the district with bus stop prefix
100 + k in the fixed lookup."""

from __future__ import annotations

from pyspark.sql import functions as F

from metroframe import constants as K
from metroframe.bindings import query
from metroframe.bindings import tables as tb
from metroframe.plans import curated as C

DISTRICTS = [d for d, _ars, _code in K.BUS_STOP_CODE_LOOKUP]
DISTRICTS_SQL = "(VALUES " + ", ".join(f"({k}, '{d}')" for k, d in enumerate(DISTRICTS)) + ") AS dk(k, district_ko)"


def district_names(spark):
    """(k, district_ko): the 25 districts in lookup order."""
    return spark.createDataFrame(list(enumerate(DISTRICTS)), "k int, district_ko string")


def coord_text(key: str, role: str, which: str):
    c = tb.lat(key, role) if which == "lat" else tb.lon(key, role)
    return F.format_string("%.5f", c)


def coord_text_sql(key: str, role: str, which: str) -> str:
    c = tb.lat_sql(key, role) if which == "lat" else tb.lon_sql(key, role)
    return f"printf('%.5f', {c})"


def coord_sql(key: str, role: str, which: str) -> str:
    return f"CAST({coord_text_sql(key, role, which)} AS DOUBLE)"


# P-2 ---------------------------------------------------------------------------------
def raw_bus(spark, d):
    s = tb.table(spark, d, "supplier")
    stop_id = F.when(F.col("s_acctbal") < 0, F.lit(None).cast("string")).otherwise(
        F.concat((F.col("s_nationkey") + 100).cast("string"), F.lpad(F.col("s_suppkey").cast("string"), 5, "0")))
    return s.select(stop_id.alias("CRTR_ID"), F.col("s_name").alias("CRTR_NM"), F.lit("정류장").alias("CRTR_TYPE"),
                    F.col("s_suppkey").cast("string").alias("CRTR_NO"), coord_text("s_suppkey", "bus", "lat").alias("LAT"),
                    coord_text("s_suppkey", "bus", "lon").alias("LOT"), F.lit("Y").alias("BUS_ARVL_INFO_GUIDEM_INSTL"))


@query("curated_bus_stops", f"""
SELECT s_name AS bus_name, {coord_sql('s_suppkey', 'bus', 'lat')} AS bus_latitude,
       {coord_sql('s_suppkey', 'bus', 'lon')} AS bus_longitude, dk.district_ko AS bus_district
FROM supplier JOIN {DISTRICTS_SQL} ON dk.k = s_nationkey WHERE s_acctbal >= 0""")
def q_curated_bus_stops(spark, d):
    """P-2: raw stop rows -> district from the id prefix (lookup join),
    unknown or missing ids dropped, typed coordinates."""
    return C.build_bus_stops(raw_bus(spark, d))


# P-1 ---------------------------------------------------------------------------------
def raw_loans(spark, d):
    p = tb.table(spark, d, "part")
    n = district_names(spark)
    size = F.col("p_size")
    addition = (F.when(size < 10, F.lit("")).when(size < 20, F.concat(size.cast("string"), F.lit(".5")))
                .otherwise(size.cast("string")))
    cls = F.concat_ws(" > ", F.col("p_type"), F.col("p_brand"), F.when(size > 25, F.col("p_name")))
    joined = p.join(n, (p.p_partkey % tb.NATIONS) == n.k)
    return joined.select(
        F.col("p_partkey").cast("string").alias("no"), F.col("p_size").cast("string").alias("ranking"),
        F.col("p_name").alias("bookname"), F.col("p_brand").alias("authors"), F.col("p_type").alias("publisher"),
        (size + 1970).cast("string").alias("publication_year"),
        (F.col("p_partkey") + F.lit(9788900000000)).cast("string").alias("isbn13"),
        addition.alias("addition_symbol"), F.when(size > 40, F.lit("1")).otherwise(F.lit("")).alias("vol"),
        F.format_string("%.2f", F.col("p_retailprice")).alias("class_no"),
        size.cast("string").alias("loan_count"), F.lit("").alias("bookImageURL"), F.lit("").alias("bookDtlUrl"),
        F.get(F.split(cls, " > "), 0).alias("class_major"), F.get(F.split(cls, " > "), 1).alias("class_sub"),
        F.get(F.split(cls, " > "), 2).alias("class_detailed"), F.col("district_ko").alias("district"),
        F.lit("2024").alias("year"), ((F.col("p_partkey") % 12) + 1).cast("string").alias("month"))


@query("curated_best_loans", f"""
SELECT p_name AS bll_book_name, p_brand AS bll_authors, p_type AS bll_publisher,
       CAST(p_size + 1970 AS INTEGER) AS bll_publication_year, p_partkey + 9788900000000 AS bll_isbn13,
       CASE WHEN p_size < 10 THEN NULL ELSE CAST(p_size AS INTEGER) END AS bll_addition_symbol,
       CASE WHEN p_size > 40 THEN 1 END AS bll_vol,
       CAST(printf('%.2f', p_retailprice) AS DOUBLE) AS bll_class_no,
       p_type AS bll_class_major, p_brand AS bll_class_sub, CASE WHEN p_size > 25 THEN p_name END AS bll_class_detailed,
       CAST(p_size AS BIGINT) AS bll_loan_count, dk.district_ko AS bll_district, 2024 AS bll_year,
       CAST(p_partkey % 12 + 1 AS INTEGER) AS bll_month
FROM part JOIN {DISTRICTS_SQL} ON dk.k = p_partkey % {tb.NATIONS}""")
def q_curated_best_loans(spark, d):
    """P-1: rename and lenient casts ('' -> null, '12.5' as int -> 12,
    13-digit ISBN exact), declared columns only."""
    return C.build_best_loans(raw_loans(spark, d))


# P-3 ---------------------------------------------------------------------------------
def raw_stations(spark, d):
    c = tb.table(spark, d, "customer")
    n = tb.table(spark, d, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    return j.select(F.col("c_custkey").cast("string").alias("BLDN_ID"), F.col("n_name").alias("BLDN_NM"),
                    F.concat(F.col("c_mktsegment"), F.lit(" ("), F.col("n_regionkey").cast("string"), F.lit(")")).alias("ROUTE"),
                    coord_text("c_custkey", "subway", "lat").alias("LAT"),
                    coord_text("c_custkey", "subway", "lon").alias("LOT"))


def district_info(spark, d):
    """(district, 'station(n), ...', count): regions packing their nations,
    regions 0-3 only, so stations of region 4 have no district."""
    from metroframe.bindings.expressions import packed_districts
    packed = packed_districts(spark, d)
    return packed.where(F.col("area") != F.lit("REGION_4")).select(
        F.col("area").alias("district"), "stations", F.size(F.split("stations", ", ")).cast("string").alias("n"))


@query("curated_subway_stations", f"""
SELECT sta_id, sta_name, sta_latitude, sta_longitude, sta_line, sta_district FROM (
  SELECT c_custkey AS sta_id, n_name AS sta_name, {coord_sql('c_custkey', 'subway', 'lat')} AS sta_latitude,
         {coord_sql('c_custkey', 'subway', 'lon')} AS sta_longitude, c_mktsegment AS sta_line,
         CASE WHEN r_name <> 'REGION_4' THEN r_name END AS sta_district,
         row_number() OVER (PARTITION BY n_name, c_mktsegment ORDER BY c_custkey) AS rn
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
WHERE rn = 1""")
def q_curated_subway_stations(spark, d):
    """P-3: packed district lists exploded and cleaned, left-joined to the
    stations (unlisted -> null district), line cleaned of '(...)',
    deduplicated on (name, line) keeping a stable row."""
    return C.build_subway_stations(raw_stations(spark, d), district_info(spark, d), "district", "stations")


# P-4 ---------------------------------------------------------------------------------
def raw_parks(spark, d):
    p = tb.table(spark, d, "part")
    n = district_names(spark)
    j = p.join(n, (p.p_partkey % tb.NATIONS) == n.k)
    provider = (F.when(F.col("p_size") <= 40, F.concat(F.lit("서울특별시 "), F.col("district_ko"), F.lit("청")))
                .when(F.col("p_size") <= 45, F.lit("경기도 과천시")).otherwise(F.lit(None).cast("string")))
    designated = F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), F.col("p_partkey").cast("int")), "yyyy-M-d")
    cols = [
        (F.col("p_name"), "공원명"), (F.col("p_type"), "공원구분"),
        (F.concat(F.lit("주소 "), F.col("p_partkey").cast("string")), "소재지지번주소"),
        (coord_text("p_partkey", "park", "lat"), "위도"), (coord_text("p_partkey", "park", "lon"), "경도"),
        (F.col("p_size").cast("string"), "공원면적"),
        (F.when(F.col("p_size") > 45, F.lit("미상")).otherwise(designated), "지정고시일"),
        (F.col("p_brand"), "관리기관명"), (F.concat(F.lit("02-"), F.col("p_partkey").cast("string")), "전화번호"),
        (F.lit("2024-01-05 00:00:00.0"), "데이터기준일자"),
        ((F.col("k") + 3000000).cast("string"), "제공기관코드"), (provider, "제공기관명"),
    ]
    return j.select(*[c.alias(a) for c, a in cols])


@query("curated_parks", f"""
SELECT p_name AS park_name, p_type AS park_type, '주소 ' || p_partkey AS lot_address,
       {coord_sql('p_partkey', 'park', 'lat')} AS park_latitude, {coord_sql('p_partkey', 'park', 'lon')} AS park_longitude,
       CAST(p_size AS VARCHAR) AS park_area,
       CASE WHEN p_size > 45 THEN NULL ELSE CAST(DATE '2000-01-01' + CAST(p_partkey AS INTEGER) AS DATE) END
         AS park_designation_date,
       p_brand AS park_mgmt_agency, '02-' || p_partkey AS park_phone, DATE '2024-01-05' AS park_data_date,
       CAST(dk.k + 3000000 AS BIGINT) AS park_provider_code,
       CASE WHEN p_size <= 40 THEN '서울특별시 ' || dk.district_ko || '청' WHEN p_size <= 45 THEN '경기도 과천시' END
         AS park_provider_name,
       CASE WHEN p_size <= 40 THEN dk.district_ko WHEN p_size <= 45 THEN '' END AS park_district
FROM part JOIN {DISTRICTS_SQL} ON dk.k = p_partkey % {tb.NATIONS}""")
def q_curated_parks(spark, d):
    """P-4: Korean headers to typed columns, district taken from the provider
    name ('강남구청' gives '강남구'; no match ''; null stays null)."""
    return C.build_parks(raw_parks(spark, d))


# P-6 ---------------------------------------------------------------------------------
def raw_events(spark, d):
    c = tb.table(spark, d, "customer")
    n = district_names(spark)
    kw = tb.keyword_columns(
        tb.top_keywords(tb.spread_pages(spark, tb.table(spark, d, "pages"), "page_id"), "page_id", "html", pattern=tb.PAGE_WORD,
                        stop_words=tb.PAGE_STOP_WORDS), "page_id", ("Keyword_1", "Keyword_2", "Keyword_3"))
    j = c.join(n, c.c_nationkey == n.k)
    start = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int"))
    fee = (F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(K.FEE_FREE))
           .when(F.col("c_mktsegment") == "BUILDING", F.lit(K.FEE_PAID)).otherwise(F.lit("기타")))
    ev = j.select(
        F.col("c_custkey"), F.col("c_mktsegment").alias("CODENAME"), F.col("district_ko").alias("GUNAME"),
        F.col("c_name").alias("TITLE"), F.lit("").alias("DATE"), F.lit("장소").alias("PLACE"),
        F.lit("기관").alias("ORG_NAME"), F.lit("누구나").alias("USE_TRGT"), F.lit("").alias("USE_FEE"),
        F.lit(None).cast("string").alias("PLAYER"), F.lit(None).cast("string").alias("PROGRAM"),
        F.lit(None).cast("string").alias("ETC_DESC"), F.lit("http://org").alias("ORG_LINK"),
        F.lit("http://img").alias("MAIN_IMG"),
        F.concat(F.date_format(start, "yyyy-MM-dd"), F.lit(" 00:00:00.0")).alias("RGSTDATE"),
        F.lit("시민").alias("TICKET"), F.date_format(start, "yyyy-M-d").alias("STRTDATE"),
        F.when(F.col("c_acctbal") < 0, F.lit("미정")).otherwise(F.date_format(F.date_add(start, 30), "yyyy-MM-dd"))
        .alias("END_DATE"), F.lit("").alias("THEMECODE"),
        coord_text("c_custkey", "event", "lat").alias("LOT"), coord_text("c_custkey", "event", "lon").alias("LAT"),
        fee.alias("IS_FREE"), F.concat(F.lit("http://page/"), F.col("c_custkey").cast("string")).alias("HMPG_ADDR"))
    return ev.join(kw, ev.c_custkey == kw.page_id, "left").drop("page_id", "c_custkey")


@query("curated_event_info", f"""
SELECT c_mktsegment AS cul_class, dk.district_ko AS cul_district, c_name AS cul_title, '장소' AS cul_place,
       '기관' AS cul_org_name, '누구나' AS cul_trgt_age, '' AS cul_fee, 'http://org' AS cul_org_url,
       'http://img' AS cul_main_img, CAST(DATE '2024-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS cul_rgst_date,
       '시민' AS cul_organizer_type, CAST(DATE '2024-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS cul_start_date,
       CASE WHEN c_acctbal < 0 THEN NULL
            ELSE CAST(DATE '2024-01-01' + CAST(c_custkey % 365 AS INTEGER) + 30 AS DATE) END AS cul_end_date,
       {coord_sql('c_custkey', 'event', 'lat')} AS cul_latitude, {coord_sql('c_custkey', 'event', 'lon')} AS cul_longitude,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN true WHEN c_mktsegment = 'BUILDING' THEN false END AS cul_is_free,
       'http://page/' || c_custkey AS cul_hmpg_url,
       kw.cul_keyword_1, kw.cul_keyword_2, kw.cul_keyword_3
FROM customer JOIN {DISTRICTS_SQL} ON dk.k = c_nationkey
LEFT JOIN ({tb.keyword_columns_sql()}) kw ON kw.page_id = c_custkey""")
def q_curated_event_info(spark, d):
    """P-6 (after P-5): typed event rows with top-3 page keywords, dates from
    mixed text, free/paid recoded, latitude read from LOT."""
    return C.build_event_info(raw_events(spark, d))


# P-7 ---------------------------------------------------------------------------------
def raw_libraries(spark, d):
    s = tb.table(spark, d, "supplier")
    n = district_names(spark)
    j = s.join(n, s.s_nationkey == n.k)
    return j.select(
        F.col("s_suppkey").cast("string").alias("libCode"), F.col("s_name").alias("libName"),
        F.lit("주소").alias("address"), F.lit("02").alias("tel"), F.lit("").alias("fax"),
        coord_text("s_suppkey", "library", "lat").alias("latitude"),
        coord_text("s_suppkey", "library", "lon").alias("longitude"),
        F.concat(F.lit("http://lib/"), F.col("s_suppkey").cast("string")).alias("homepage"),
        F.lit("월").alias("closed"), F.lit("9-18").alias("operatingTime"),
        F.when(F.col("s_acctbal") < 0, F.lit("n/a")).otherwise(F.floor(F.col("s_acctbal") * 10).cast("string"))
        .alias("BookCount"),
        F.col("district_ko").alias("district"))


@query("curated_library_data", f"""
SELECT s_name AS lib_name, {coord_sql('s_suppkey', 'library', 'lat')} AS lib_latitude,
       {coord_sql('s_suppkey', 'library', 'lon')} AS lib_longitude, 'http://lib/' || s_suppkey AS lib_homepage,
       CASE WHEN s_acctbal < 0 THEN NULL ELSE CAST(floor(s_acctbal * 10) AS BIGINT) END AS lib_book_count,
       dk.district_ko AS lib_district
FROM supplier JOIN {DISTRICTS_SQL} ON dk.k = s_nationkey""")
def q_curated_library_data(spark, d):
    """P-7: declarative mapping (names matched without case, others dropped);
    the quality result is computed next to the data and never blocks it."""
    data, quality = C.build_library_data(raw_libraries(spark, d))
    return data
