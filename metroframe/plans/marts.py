"""P-8, P-9, P-10: the analysis marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroframe import constants as K
from metroframe.functions.geo import EARTH_RADIUS_M
from metroframe.operators.projection import align_to_schema
from metroframe.operators.setops import union_all
from metroframe.operators.spatial import count_within_radius
from metroframe.schemas import ACCESSIBILITY_COUNTS, ENTITY_UNION, FACILITY_LOCATIONS, INTEGRATED_ACCESSIBILITY


def entity_union(libraries: DataFrame, events: DataFrame, books: DataFrame) -> DataFrame:
    """P-8 (SET-2, PRJ-7, PRJ-8, STR-7): libraries, events and books in one
    13-column table; columns a branch lacks are typed nulls. No shuffle: a
    Union over three column-pruned scans."""
    lib = libraries.selectExpr(
        "lib_district AS district", "lib_name AS name", "'Library' AS data_type",
        "lib_latitude AS latitude", "lib_longitude AS longitude")
    cul = events.selectExpr(
        "cul_district AS district", "cul_title AS name", "'Event' AS data_type",
        "cul_latitude AS latitude", "cul_longitude AS longitude", "cul_class AS event_class",
        "cul_start_date AS event_start_date", "cul_end_date AS event_end_date",
        "concat_ws(',', cul_keyword_1, cul_keyword_2, cul_keyword_3) AS event_keywords",
        "cul_is_free AS cul_is_free")
    bll = books.selectExpr(
        "bll_district AS district", "bll_book_name AS name", "'Book' AS data_type",
        "bll_class_major AS book_class_major", "bll_class_sub AS book_class_sub", "bll_loan_count AS loan_count")
    return union_all([align_to_schema(b, ENTITY_UNION) for b in (lib, cul, bll)])


def entity_positions(libraries: DataFrame, events: DataFrame) -> DataFrame:
    """The distinct (district, latitude, longitude) of P-8's rows (books have none), from the two tables that have coordinates.

    Distinct per table, so that joins which only add columns to it (an event's keywords) drop out of the plan.
    """
    lib = libraries.select(F.col("lib_district").alias("district"), F.col("lib_latitude").alias("latitude"), F.col("lib_longitude").alias("longitude"))
    cul = events.select(F.col("cul_district").alias("district"), F.col("cul_latitude").alias("latitude"), F.col("cul_longitude").alias("longitude"))
    return union_all([lib.distinct(), cul.distinct()])


def facility_union(bus: DataFrame, subway: DataFrame, parks: DataFrame) -> DataFrame:
    """P-9 (SET-1, PRJ-7): bus stops, stations and parks as facility rows."""
    parts = [
        bus.selectExpr("'Bus' AS facility_type", "bus_name AS facility_name", "bus_latitude AS latitude",
                       "bus_longitude AS longitude", "bus_district AS district"),
        subway.selectExpr("'Subway' AS facility_type", "sta_name AS facility_name", "sta_latitude AS latitude",
                          "sta_longitude AS longitude", "sta_district AS district"),
        parks.selectExpr("'Park' AS facility_type", "park_name AS facility_name", "park_latitude AS latitude",
                         "park_longitude AS longitude", "park_district AS district"),
    ]
    return union_all([align_to_schema(p, FACILITY_LOCATIONS) for p in parts])


def integrated_accessibility(entities: DataFrame, facilities: DataFrame, *, radius_m: float = K.RADIUS_M,
                             data_types: Sequence[str] = K.DATA_TYPES,
                             earth_radius_m: float = EARTH_RADIUS_M, split_hot_cells: bool = False,
                             positions: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """P-10 (flagship): every Library/Event/Book entity with the number of
    distinct bus stop, station and park names of its district within
    ``radius_m`` (FLT-2, JN-4, GEO-1..3, AGG-1 x 3). ``split_hot_cells``
    salts grid cells known to hold a large share of the entities; ``positions`` (see
    :func:`entity_positions`) spares a second evaluation of entities that are not written yet. ``parts`` cuts
    the cells of dense data (see ``count_within_radius``)."""
    u = entities.where(F.col("data_type").isin(list(data_types)))
    counted = count_within_radius(
        u, facilities, district="district", lat="latitude", lon="longitude",
        fac_kind="facility_type", fac_name="facility_name", fac_district="district",
        fac_lat="latitude", fac_lon="longitude",
        kinds=dict(zip(K.FACILITY_TYPES, ACCESSIBILITY_COUNTS)), radius_m=radius_m, earth_radius_m=earth_radius_m,
        split_hot_cells=split_hot_cells, positions=positions, parts=parts)
    return counted.select(
        F.col("name").alias("entity_name"), F.col("district").alias("entity_district"), "data_type",
        F.col("latitude").alias("entity_latitude"), F.col("longitude").alias("entity_longitude"),
        "event_class", "event_start_date", "event_end_date", "event_keywords", "book_class_major",
        "book_class_sub", "loan_count", "cul_is_free", *ACCESSIBILITY_COUNTS,
    ).select(*[F.col(f.name).cast(f.dataType) for f in INTEGRATED_ACCESSIBILITY.fields])
