"""P-1..P-4, P-6, P-7: raw snapshots to typed, district-partitioned tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metroframe import constants as K
from metroframe.functions.dates import parse_date
from metroframe.functions.text import extract_group, split_list, strip_parenthesised
from metroframe.operators.joins import left_dimension_join, prefix_lookup_join
from metroframe.operators.projection import apply_mapping, cast_columns, recode_bool, rename_columns, select_cast
from metroframe.operators.quality import Rule, check_quality
from metroframe.operators.ranking import drop_duplicates_stable
from metroframe.schemas import BEST_LOAN

# P-1 -------------------------------------------------------------------------
# --- fixed values: raw loan columns -> curated names ---------------------------
BEST_LOAN_RENAMES = {
    "bookname": "bll_book_name", "authors": "bll_authors", "publisher": "bll_publisher",
    "publication_year": "bll_publication_year", "isbn13": "bll_isbn13", "addition_symbol": "bll_addition_symbol",
    "vol": "bll_vol", "class_no": "bll_class_no", "class_major": "bll_class_major", "class_sub": "bll_class_sub",
    "class_detailed": "bll_class_detailed", "loan_count": "bll_loan_count", "district": "bll_district",
    "year": "bll_year", "month": "bll_month",
}


def build_best_loans(raw: DataFrame) -> DataFrame:
    """P-1: rename (PRJ-2), cast leniently (PRJ-3), keep the declared columns."""
    renamed = rename_columns(raw, BEST_LOAN_RENAMES)
    types = {f.name: f.dataType.simpleString() for f in BEST_LOAN.fields}
    cast = cast_columns(renamed, types)
    return cast.select(*[f.name for f in BEST_LOAN.fields])


# P-2 -------------------------------------------------------------------------
def bus_code_lookup(spark: SparkSession) -> DataFrame:
    """JN-2's 25-row lookup (district, ars_prefix, id_prefix) as a DataFrame."""
    return spark.createDataFrame(K.BUS_STOP_CODE_LOOKUP, "district string, ars_prefix int, id_prefix string")


def build_bus_stops(raw: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """P-2: district from the stop-id prefix (JN-2), rows without one dropped."""
    lookup = lookup if lookup is not None else bus_code_lookup(raw.sparkSession)
    joined = prefix_lookup_join(raw, "CRTR_ID", lookup.withColumnRenamed("district", "bus_district"),
                                "id_prefix", ["bus_district"], length=3)
    return select_cast(joined, [("CRTR_NM", "bus_name", None), ("LAT", "bus_latitude", "double"),
                                ("LOT", "bus_longitude", "double"), ("bus_district", "bus_district", None)])


# P-3 -------------------------------------------------------------------------
def station_districts(district_info: DataFrame, district_col: str, stations_col: str) -> DataFrame:
    """(sta_district, station_name): the packed 'name(line), ...' list exploded
    (STR-2, ARR-1) and cleaned (STR-5, STR-4)."""
    return (district_info.select(F.col(district_col).alias("sta_district"),
                                 F.explode(split_list(stations_col)).alias("station"))
            .select("sta_district", strip_parenthesised("station").alias("station_name")))


def build_subway_stations(master: DataFrame, district_info: DataFrame, district_col: str, stations_col: str) -> DataFrame:
    """P-3: stations with their district(s) (JN-1; a station listed under two
    districts fans out, one not listed keeps null), deduplicated on
    (sta_name, sta_line) with a repeatable choice (DUP-1)."""
    master = master.withColumn("ROUTE", strip_parenthesised("ROUTE"))
    dims = station_districts(district_info, district_col, stations_col)
    joined = left_dimension_join(master, dims, "BLDN_NM", "station_name").drop("station_name")
    final = select_cast(joined, [("BLDN_ID", "sta_id", "bigint"), ("BLDN_NM", "sta_name", "string"),
                                 ("LAT", "sta_latitude", "double"), ("LOT", "sta_longitude", "double"),
                                 ("ROUTE", "sta_line", "string"), ("sta_district", "sta_district", "string")])
    return drop_duplicates_stable(final, ["sta_name", "sta_line"])


# P-4 -------------------------------------------------------------------------
# --- fixed values: park file headers -> curated columns ----------------------
PARK_COLUMNS = [
    ("공원명", "park_name", None),
    ("공원구분", "park_type", None),
    ("소재지지번주소", "lot_address", None),
    ("위도", "park_latitude", "double"),
    ("경도", "park_longitude", "double"),
    ("공원면적", "park_area", None),
    ("지정고시일", "park_designation_date", "date"),
    ("관리기관명", "park_mgmt_agency", None),
    ("전화번호", "park_phone", None),
    ("데이터기준일자", "park_data_date", "date"),
    ("제공기관코드", "park_provider_code", "bigint"),
    ("제공기관명", "park_provider_name", None),
]


def build_parks(raw: DataFrame, columns: Sequence[tuple[str, str, str | None]] = PARK_COLUMNS,
                pattern: str = K.SEOUL_DISTRICT) -> DataFrame:
    """P-4: typed columns (PRJ-1) and the district taken from the provider
    name (STR-6; '' when absent, which a partitioned write stores as null)."""
    typed = select_cast(raw, columns)
    return typed.withColumn("park_district", extract_group("park_provider_name", pattern, 1))


# P-6 -------------------------------------------------------------------------
# --- fixed values: event feed columns -> curated (source, target, type) ---------
# latitude is read from LOT and longitude from LAT, as the event job does (the
# other feeds use the opposite pairing)
EVENT_COLUMNS = [
    ("CODENAME", "cul_class", None), ("GUNAME", "cul_district", None), ("TITLE", "cul_title", None),
    ("PLACE", "cul_place", None), ("ORG_NAME", "cul_org_name", None), ("USE_TRGT", "cul_trgt_age", None),
    ("USE_FEE", "cul_fee", None), ("ORG_LINK", "cul_org_url", None), ("MAIN_IMG", "cul_main_img", None),
    ("RGSTDATE", "cul_rgst_date", "date"), ("TICKET", "cul_organizer_type", None),
    ("STRTDATE", "cul_start_date", "date"), ("END_DATE", "cul_end_date", "date"),
    ("LOT", "cul_latitude", "double"), ("LAT", "cul_longitude", "double"), ("IS_FREE", "cul_is_free", None),
    ("HMPG_ADDR", "cul_hmpg_url", None), ("Keyword_1", "cul_keyword_1", None),
    ("Keyword_2", "cul_keyword_2", None), ("Keyword_3", "cul_keyword_3", None),
]


def build_event_info(raw: DataFrame, columns=EVENT_COLUMNS) -> DataFrame:
    """P-6: typed event rows with the free/paid flag recoded (PRJ-10)."""
    typed = select_cast(raw, columns)
    for c in ("cul_rgst_date", "cul_start_date", "cul_end_date"):
        typed = typed.withColumn(c, parse_date(F.col(c)))
    return typed.withColumn("cul_is_free", recode_bool("cul_is_free", K.FEE_FREE, K.FEE_PAID))


# P-7 -------------------------------------------------------------------------
# --- fixed values: library feed mapping (source, target, type) and its rule -----
LIBRARY_MAPPING = [
    ("libname", "lib_name", "string"), ("latitude", "lib_latitude", "double"),
    ("longitude", "lib_longitude", "double"), ("homepage", "lib_homepage", "string"),
    ("bookcount", "lib_book_count", "bigint"), ("district", "lib_district", "string"),
]
LIBRARY_RULES = [Rule("column_count", ">", 0)]


def build_library_data(raw: DataFrame, mapping=LIBRARY_MAPPING, rules=LIBRARY_RULES) -> tuple[DataFrame, DataFrame]:
    """P-7: declarative mapping (PRJ-4) and the quality results (DQ-1); the
    results are returned next to the data and never block it. The job takes
    them from its write instead (``ObservedQuality``)."""
    mapped = apply_mapping(raw, mapping)
    return mapped, check_quality(mapped, rules)
