"""Explicit StructTypes of the raw, curated and mart tables."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, DT, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType(), T.BooleanType()


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


def all_strings(*names: str) -> T.StructType:
    return struct(*[(n, S) for n in names])


# --- raw tables: every column text -----------------------------------------
BEST_LOAN_RAW = all_strings("no", "ranking", "bookname", "authors", "publisher", "publication_year", "isbn13",
                            "addition_symbol", "vol", "class_no", "loan_count", "bookImageURL", "bookDtlUrl",
                            "class_major", "class_sub", "class_detailed")
BEST_LOAN_RESPONSE = all_strings("no", "ranking", "bookname", "authors", "publisher", "publication_year", "isbn13",
                                 "addition_symbol", "vol", "class_no", "class_nm", "loan_count", "bookImageURL", "bookDtlUrl")
BUS_STOP_RAW = all_strings("CRTR_ID", "CRTR_NM", "CRTR_TYPE", "CRTR_NO", "LAT", "LOT", "BUS_ARVL_INFO_GUIDEM_INSTL")
SUBWAY_STATION_RAW = all_strings("BLDN_ID", "BLDN_NM", "ROUTE", "LAT", "LOT")
EVENT_PARSE_RAW = all_strings("CODENAME", "GUNAME", "TITLE", "DATE", "PLACE", "ORG_NAME", "USE_TRGT", "USE_FEE",
                              "PLAYER", "PROGRAM", "ETC_DESC", "ORG_LINK", "MAIN_IMG", "RGSTDATE", "TICKET",
                              "STRTDATE", "END_DATE", "THEMECODE", "LOT", "LAT", "IS_FREE", "HMPG_ADDR")
EVENT_INFO_RAW = T.StructType(EVENT_PARSE_RAW.fields + all_strings("Keyword_1", "Keyword_2", "Keyword_3").fields)
LIBRARY_RAW = all_strings("libCode", "libName", "address", "tel", "fax", "latitude", "longitude", "homepage",
                          "closed", "operatingTime", "BookCount", "district")

# --- curated tables ----------------------------------------------------------
BEST_LOAN = struct(("bll_book_name", S), ("bll_authors", S), ("bll_publisher", S), ("bll_publication_year", I),
                   ("bll_isbn13", L), ("bll_addition_symbol", I), ("bll_vol", I), ("bll_class_no", D),
                   ("bll_class_major", S), ("bll_class_sub", S), ("bll_class_detailed", S), ("bll_loan_count", L),
                   ("bll_district", S), ("bll_year", I), ("bll_month", I))
BUS_STOP = struct(("bus_name", S), ("bus_latitude", D), ("bus_longitude", D), ("bus_district", S))
SUBWAY_STATION = struct(("sta_id", L), ("sta_name", S), ("sta_latitude", D), ("sta_longitude", D),
                        ("sta_line", S), ("sta_district", S))
CITY_PARK = struct(("park_name", S), ("park_type", S), ("lot_address", S), ("park_latitude", D),
                   ("park_longitude", D), ("park_area", S), ("park_designation_date", DT), ("park_mgmt_agency", S),
                   ("park_phone", S), ("park_data_date", DT), ("park_provider_code", L), ("park_provider_name", S),
                   ("park_district", S))
EVENT_INFO = struct(("cul_class", S), ("cul_district", S), ("cul_title", S), ("cul_place", S), ("cul_org_name", S),
                    ("cul_trgt_age", S), ("cul_fee", S), ("cul_org_url", S), ("cul_main_img", S),
                    ("cul_rgst_date", DT), ("cul_organizer_type", S), ("cul_start_date", DT), ("cul_end_date", DT),
                    ("cul_latitude", D), ("cul_longitude", D), ("cul_is_free", B), ("cul_hmpg_url", S),
                    ("cul_keyword_1", S), ("cul_keyword_2", S), ("cul_keyword_3", S))
LIBRARY = struct(("lib_name", S), ("lib_latitude", D), ("lib_longitude", D), ("lib_homepage", S),
                 ("lib_book_count", L), ("lib_district", S))

# --- marts ------------------------------------------------------------------------
ENTITY_UNION = struct(("district", S), ("name", S), ("data_type", S), ("latitude", D), ("longitude", D),
                      ("event_class", S), ("event_start_date", DT), ("event_end_date", DT), ("event_keywords", S),
                      ("book_class_major", S), ("book_class_sub", S), ("loan_count", L), ("cul_is_free", B))
FACILITY_LOCATIONS = struct(("facility_type", S), ("facility_name", S), ("latitude", D), ("longitude", D),
                            ("district", S))
ACCESSIBILITY_COUNTS = ("bus_stops_within_1km", "subway_stations_within_1km", "parks_within_1km")
INTEGRATED_ACCESSIBILITY = struct(("entity_name", S), ("entity_district", S), ("data_type", S),
                                  ("entity_latitude", D), ("entity_longitude", D), ("event_class", S),
                                  ("event_start_date", DT), ("event_end_date", DT), ("event_keywords", S),
                                  ("book_class_major", S), ("book_class_sub", S), ("loan_count", L),
                                  ("cul_is_free", B), *[(c, I) for c in ACCESSIBILITY_COUNTS])
