"""P-8, P-9, P-10 and the union / padding / tag operators on driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from metroframe import constants as K
from metroframe.bindings import query
from metroframe.bindings import tables as tb
from metroframe.functions.geo import haversine_sql
from metroframe.plans.marts import entity_positions, entity_union, facility_union, integrated_accessibility


def mart_entities(spark, d):
    return entity_union(tb.libraries(spark, d), tb.events(spark, d), tb.books(spark, d))


def mart_facilities(spark, d):
    return facility_union(tb.bus_stops(spark, d), tb.subway_stations(spark, d), tb.parks(spark, d))


ENTITY_UNION_SQL = f"""
SELECT lib_district AS district, lib_name AS name, 'Library' AS data_type, lib_latitude AS latitude,
       lib_longitude AS longitude, CAST(NULL AS VARCHAR) AS event_class, CAST(NULL AS DATE) AS event_start_date,
       CAST(NULL AS DATE) AS event_end_date, CAST(NULL AS VARCHAR) AS event_keywords,
       CAST(NULL AS VARCHAR) AS book_class_major, CAST(NULL AS VARCHAR) AS book_class_sub,
       CAST(NULL AS BIGINT) AS loan_count, CAST(NULL AS BOOLEAN) AS cul_is_free
FROM ({tb.LIBRARIES_SQL}) lib
UNION ALL
SELECT cul_district, cul_title, 'Event', cul_latitude, cul_longitude, cul_class, cul_start_date, cul_end_date,
       concat_ws(',', cul_keyword_1, cul_keyword_2, cul_keyword_3), NULL, NULL, NULL, cul_is_free
FROM ({tb.EVENTS_SQL}) cul
UNION ALL
SELECT bll_district, bll_book_name, 'Book', NULL, NULL, NULL, NULL, NULL, NULL, bll_class_major, bll_class_sub,
       bll_loan_count, NULL
FROM ({tb.BOOKS_SQL}) bll
"""

FACILITY_UNION_SQL = f"""
SELECT 'Bus' AS facility_type, bus_name AS facility_name, bus_latitude AS latitude, bus_longitude AS longitude,
       bus_district AS district FROM ({tb.BUS_SQL}) b
UNION ALL
SELECT 'Subway', sta_name, sta_latitude, sta_longitude, sta_district FROM ({tb.SUBWAY_SQL}) s
UNION ALL
SELECT 'Park', park_name, park_latitude, park_longitude, park_district FROM ({tb.PARKS_SQL}) p
"""


def _count_sql(kind: str, alias: str, radius_m: float) -> str:
    dist = haversine_sql("u.latitude", "u.longitude", "f.latitude", "f.longitude")
    return (f"CAST((SELECT count(DISTINCT f.facility_name) FROM fac f WHERE f.facility_type = '{kind}' "
            f"AND f.district = u.district AND {dist} <= {radius_m!r}e0) AS INTEGER) AS {alias}")


ACCESSIBILITY_SQL = f"""
WITH ent AS ({ENTITY_UNION_SQL}), fac AS ({FACILITY_UNION_SQL})
SELECT u.name AS entity_name, u.district AS entity_district, u.data_type, u.latitude AS entity_latitude,
       u.longitude AS entity_longitude, u.event_class, u.event_start_date, u.event_end_date, u.event_keywords,
       u.book_class_major, u.book_class_sub, u.loan_count, u.cul_is_free,
       {_count_sql('Bus', 'bus_stops_within_1km', K.RADIUS_M)},
       {_count_sql('Subway', 'subway_stations_within_1km', K.RADIUS_M)},
       {_count_sql('Park', 'parks_within_1km', K.RADIUS_M)}
FROM ent u WHERE u.data_type IN ('Library', 'Event', 'Book')
"""


@query("mart_entity_union", ENTITY_UNION_SQL)
def q_mart_entity_union(spark, d):
    """P-8 / SET-2: libraries (supplier), events (customer + page keywords),
    books (part) in one 13-column table."""
    return mart_entities(spark, d)


@query("mart_facility_union", FACILITY_UNION_SQL)
def q_mart_facility_union(spark, d):
    """P-9 / SET-1: bus stops (supplier), stations (customer), parks (part)."""
    return mart_facilities(spark, d)


@query("mart_accessibility", ACCESSIBILITY_SQL)
def q_mart_accessibility(spark, d):
    """P-10 (flagship): distinct facility names within 1 km per entity."""
    return integrated_accessibility(mart_entities(spark, d), mart_facilities(spark, d), radius_m=K.RADIUS_M,
                                    positions=entity_positions(tb.libraries(spark, d), tb.events(spark, d)))


@query("mart_accessibility_cells", ACCESSIBILITY_SQL)
def q_mart_accessibility_cells(spark, d):
    """P-10 on two levels: inner sub-cells answer from their name sets, distances are computed at the border only."""
    return integrated_accessibility(mart_entities(spark, d), mart_facilities(spark, d), radius_m=K.RADIUS_M,
                                    positions=entity_positions(tb.libraries(spark, d), tb.events(spark, d)), parts=4)


@query("prj_literal_tag", """
SELECT s_name AS name, 'Library' AS data_type FROM supplier
UNION ALL SELECT c_name, 'Event' FROM customer
UNION ALL SELECT p_name, 'Book' FROM part""")
def q_prj_literal_tag(spark, d):
    """PRJ-7: a constant tag column per branch."""
    from metroframe.operators.projection import tag
    from metroframe.operators.setops import union_all
    return union_all([
        tag(tb.table(spark, d, "supplier").select(F.col("s_name").alias("name")), "data_type", "Library"),
        tag(tb.table(spark, d, "customer").select(F.col("c_name").alias("name")), "data_type", "Event"),
        tag(tb.table(spark, d, "part").select(F.col("p_name").alias("name")), "data_type", "Book"),
    ])


@query("prj_null_padding", """
SELECT s_name AS name, s_acctbal AS amount, CAST(NULL AS VARCHAR) AS segment, CAST(NULL AS BIGINT) AS size
  FROM supplier
UNION ALL SELECT c_name, NULL, c_mktsegment, NULL FROM customer
UNION ALL SELECT p_name, NULL, NULL, CAST(p_size AS BIGINT) FROM part""")
def q_prj_null_padding(spark, d):
    """PRJ-8: branches padded with typed nulls to one schema (the null's type
    comes from the branch that has the column)."""
    from metroframe.operators.setops import union_all
    s = tb.table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("amount"))
    c = tb.table(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    p = tb.table(spark, d, "part").select(F.col("p_name").alias("name"), F.col("p_size").cast("bigint").alias("size"))
    return union_all([s, c, p], allow_missing=True).select("name", "amount", "segment", "size")
