"""Radius operators on customer x supplier by nation, r = 5 km
(GEO-1..3, JN-4, JN-6, AGG-1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from metroframe.bindings import query
from metroframe.bindings import tables as tb
from metroframe.functions.geo import haversine_sql
from metroframe.operators.spatial import (Grid, correlated_count_sql, count_within_radius, entity_cells,
                                          facility_cells, radius_pairs, within_radius)
from metroframe.session import unique_name

RADIUS = 5000.0


def customers_at(spark, d):
    """customers with a position; those in debt have none (null never matches)."""
    c = tb.table(spark, d, "customer")
    has = F.col("c_acctbal") >= 0
    return c.select("c_custkey", F.col("c_nationkey").alias("c_district"),
                    F.when(has, tb.lat("c_custkey", "event")).alias("c_lat"),
                    F.when(has, tb.lon("c_custkey", "event")).alias("c_lon"))


def suppliers_at(spark, d):
    s = tb.table(spark, d, "supplier")
    return s.select("s_suppkey", "s_name", F.col("s_nationkey").alias("s_district"),
                    tb.lat("s_suppkey", "bus").alias("s_lat"), tb.lon("s_suppkey", "bus").alias("s_lon"))


CUST_SQL = f"""SELECT c_custkey, c_nationkey AS c_district,
    CASE WHEN c_acctbal >= 0 THEN {tb.lat_sql('c_custkey', 'event')} END AS c_lat,
    CASE WHEN c_acctbal >= 0 THEN {tb.lon_sql('c_custkey', 'event')} END AS c_lon FROM customer"""
SUPP_SQL = f"""SELECT s_suppkey, s_name, s_nationkey AS s_district, {tb.lat_sql('s_suppkey', 'bus')} AS s_lat,
    {tb.lon_sql('s_suppkey', 'bus')} AS s_lon FROM supplier"""
DIST_SQL = haversine_sql("c.c_lat", "c.c_lon", "s.s_lat", "s.s_lon")
PAIRS_SQL = f"""SELECT c.c_custkey, s.s_suppkey, {DIST_SQL} AS dist FROM ({CUST_SQL}) c JOIN ({SUPP_SQL}) s
  ON c.c_district = s.s_district WHERE {DIST_SQL} <= {RADIUS!r}e0"""


def _pairs(spark, d, distance_col=None):
    return radius_pairs(customers_at(spark, d), suppliers_at(spark, d), left_key="c_district", left_lat="c_lat",
                        left_lon="c_lon", right_key="s_district", right_lat="s_lat", right_lon="s_lon",
                        radius_m=RADIUS, distance_col=distance_col, ways=8)


@query("jn_radius", f"SELECT c_custkey, s_suppkey FROM ({PAIRS_SQL})")
def q_jn_radius(spark, d):
    """JN-4: same-district pairs within 5 km by a grid-cell equi-join with
    the distance as residual."""
    return _pairs(spark, d).select("c_custkey", "s_suppkey")


@query("geo_distance", f"SELECT c_custkey, s_suppkey, round(dist, 3) AS distance_m FROM ({PAIRS_SQL})")
def q_geo_distance(spark, d):
    """GEO-1/GEO-2: great-circle distance in metres (rounded to mm)."""
    return _pairs(spark, d, "dist").select("c_custkey", "s_suppkey", F.round("dist", 3).alias("distance_m"))


@query("geo_within", f"""
SELECT c.c_custkey, EXISTS (SELECT 1 FROM ({SUPP_SQL}) s WHERE s.s_district = c.c_district
  AND {DIST_SQL} <= {RADIUS!r}e0) AS has_supplier_within FROM ({CUST_SQL}) c""")
def q_geo_within(spark, d):
    """GEO-3: whether any supplier of the district lies within 5 km
    (inclusive); customers without a position are never within."""
    near = within_radius(customers_at(spark, d), suppliers_at(spark, d), left_key="c_district", left_lat="c_lat", left_lon="c_lon",
                         right_key="s_district", right_lat="s_lat", right_lon="s_lon", radius_m=RADIUS, name="has_supplier_within")
    return near.select("c_custkey", "has_supplier_within")


COUNT_SQL = f"""
SELECT c.c_custkey, CAST((SELECT count(DISTINCT s.s_name) FROM ({SUPP_SQL}) s WHERE s.s_district = c.c_district
  AND {DIST_SQL} <= {RADIUS!r}e0) AS INTEGER) AS n_suppliers FROM ({CUST_SQL}) c"""


@query("agg_count_distinct", COUNT_SQL)
def q_agg_count_distinct(spark, d):
    """AGG-1: distinct supplier names within 5 km per customer, 0 when none."""
    fac = suppliers_at(spark, d).withColumn("kind", F.lit("Supplier"))
    out = count_within_radius(customers_at(spark, d), fac, district="c_district", lat="c_lat", lon="c_lon",
                              fac_kind="kind", fac_name="s_name", fac_district="s_district", fac_lat="s_lat",
                              fac_lon="s_lon", kinds={"Supplier": "n_suppliers"}, radius_m=RADIUS)
    return out.select("c_custkey", "n_suppliers")


@query("jn_scalar_subquery", COUNT_SQL)
def q_jn_scalar_subquery(spark, d):
    """JN-6: the reference's correlated scalar subquery, run by Spark SQL over
    views; the pairs come from a (district, cell) equi-join and the subquery
    correlates by equality on district and position only, so it decorrelates into equi-joins."""
    cust, supp = customers_at(spark, d), suppliers_at(spark, d)
    grid = Grid(RADIUS)
    ev, fv = unique_name("acc_entities"), unique_name("acc_facilities")
    entity_cells(cust, grid, "c_lat", "c_lon").createOrReplaceTempView(ev)
    (facility_cells(supp, grid, "s_lat", "s_lon")
     .select(F.lit("Supplier").alias("kind"), F.col("s_name").alias("name"), F.col("s_district").alias("district"),
             F.col("s_lat").alias("lat"), F.col("s_lon").alias("lon"), "cy", "cx")
     .createOrReplaceTempView(fv))
    sql = correlated_count_sql(ev, fv, keys=["c_district", "c_lat", "c_lon"], district="c_district", lat="c_lat", lon="c_lon", cy="cy", cx="cx",
                               outputs={"Supplier": "n_suppliers"}, radius_m=RADIUS, select_cols=["c_custkey"])
    return spark.sql(sql).withColumn("n_suppliers", F.col("n_suppliers").cast("int"))
