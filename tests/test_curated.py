"""P-1..P-7 on small fixtures with the edge rows of FIXTURES.md section 4."""

import datetime as dt

from pyspark.sql import functions as F

from metroframe.plans import curated as C
from metroframe.schemas import BEST_LOAN_RAW, BUS_STOP_RAW, EVENT_INFO_RAW, SUBWAY_STATION_RAW


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_best_loans_lenient_casts(spark):
    raw_rows = [
        ("1", "1", "책 하나", "저자", "출판사", "2020", "9788936434120", "", "", "813.7", "12",
         "", "", "문학", "한국문학", "소설", "강남구", "2024", "1"),
        ("2", "2", "책 둘", "저자2", "출판사2", "2021.0", "9788936434121.0", "-7.5", "1e3", "bad", " 3 ",
         "", "", "문학", None, None, "강남구", "2024", "1"),
    ]
    from pyspark.sql import types as T

    schema = T.StructType(BEST_LOAN_RAW.fields + [T.StructField(c, T.StringType()) for c in ("district", "year", "month")])
    raw = spark.createDataFrame(raw_rows, schema)
    out = C.build_best_loans(raw)
    got = {r["bll_book_name"]: r for r in out.collect()}
    a, b = got["책 하나"], got["책 둘"]
    assert a["bll_addition_symbol"] is None and a["bll_vol"] is None  # '' -> null
    assert a["bll_class_no"] == 813.7 and a["bll_isbn13"] == 9788936434120
    assert b["bll_addition_symbol"] == -7  # '-7.5' -> -7, as the legacy cast did
    assert b["bll_publication_year"] == 2021
    assert b["bll_vol"] is None  # exponent text is not an integer
    assert b["bll_class_no"] is None  # non-numeric text -> null
    assert b["bll_loan_count"] == 3  # surrounding spaces are trimmed
    assert b["bll_isbn13"] == 9788936434121  # wide ids stay exact, decimal part dropped
    assert out.columns == [f.name for f in C.BEST_LOAN.fields]  # declared columns only


def test_rename_rejects_two_sources_to_one_target(spark):
    import pytest

    from metroframe.operators.projection import rename_columns

    df = spark.createDataFrame([("a", "b")], "class_nm string, class_major string")
    with pytest.raises(ValueError):
        rename_columns(df, {"class_nm": "major", "class_major": "major"})


def test_bus_stops_prefix_lookup_drops_unknown_and_null(spark):
    raw = spark.createDataFrame([
        ("100000001", "종로 정류장", "t", "1", "37.57", "126.98", "y"),
        ("124000002", "강동 정류장", "t", "2", "37.53", "127.12", "y"),
        ("999000003", "모르는 정류장", "t", "3", "37.50", "127.00", "y"),
        (None, "아이디 없음", "t", "4", "37.50", "127.00", "y"),
    ], BUS_STOP_RAW)
    out = C.build_bus_stops(raw)
    assert rows(out, "bus_name", "bus_district") == [("강동 정류장", "강동구"), ("종로 정류장", "종로구")]
    assert dict(out.dtypes)["bus_latitude"] == "double"


def test_bus_case_chain_equals_lookup_join(spark):
    from metroframe import constants as K
    from metroframe.operators.projection import case_by_prefix

    ids = [(f"{100 + i}00001",) for i in range(30)] + [(None,)]
    df = spark.createDataFrame(ids, "CRTR_ID string")
    mapping = [(code, district) for district, _ars, code in K.BUS_STOP_CODE_LOOKUP]
    by_case = df.select("CRTR_ID", case_by_prefix("CRTR_ID", mapping).alias("d")).where("d IS NOT NULL")
    by_join = C.build_bus_stops(df.withColumn("CRTR_NM", F.col("CRTR_ID")).withColumn("LAT", F.lit("1"))
                                .withColumn("LOT", F.lit("1")))
    assert by_case.count() == 25
    assert sorted(r[0] for r in by_case.select("d").collect()) == sorted(r[0] for r in by_join.select("bus_district").collect())


def test_subway_fan_out_unlisted_and_dedup(spark):
    master = spark.createDataFrame([
        ("1", "시청", "1호선(서울)", "37.56", "126.97"),
        ("2", "시청", "1호선", "37.56", "126.97"),  # same station and line after cleaning: one survives
        ("3", "충정로", "2호선", "37.55", "126.96"),  # listed under two districts: fans out
        ("4", "없는역", "9호선", "37.50", "126.90"),  # not listed: null district
    ], SUBWAY_STATION_RAW)
    info = spark.createDataFrame([
        ("중구", "시청(1), 충정로(2)", "2"),
        ("서대문구", "충정로(2)", "1"),
    ], "district string, stations string, n string")
    # the left join itself fans out and keeps unlisted stations with a null district
    from metroframe.operators.joins import left_dimension_join
    dims = C.station_districts(info, "district", "stations")
    joined = left_dimension_join(master, dims, "BLDN_NM", "station_name")
    assert joined.where("BLDN_NM = '충정로'").count() == 2
    assert joined.where("BLDN_NM = '없는역'").first()["sta_district"] is None
    # dedup on (name, line) runs after the join, as in the reference job, so the
    # fan-out collapses to one row: the first district under a stable order
    out = C.build_subway_stations(master, info, "district", "stations")
    assert rows(out, "sta_name", "sta_line", "sta_district") == [
        ("시청", "1호선", "중구"), ("없는역", "9호선", None), ("충정로", "2호선", "서대문구")]
    # the kept duplicate is the first under the other columns, on every run
    assert out.where("sta_name = '시청'").first()["sta_id"] == 1


def test_parks_district_from_provider_name(spark, tmp_dir):
    cols = [c for c, _t, _ty in C.PARK_COLUMNS]
    base = ["공원", "근린", "주소", "37.5", "127.0", "100", "2020-01-05", "기관", "02", "2024-1-5", "3000000"]
    raw = spark.createDataFrame([
        tuple(base + ["서울특별시 강남구청"]),
        tuple(base + ["경기도 어딘가"]),
        tuple(base[:6] + ["bad date"] + base[7:] + [None]),
    ], ", ".join(f"`{c}` string" for c in cols))
    out = C.build_parks(raw)
    got = sorted((r["park_provider_name"] or "", r["park_district"]) for r in out.collect())
    # greedy class: '강남구청' yields '강남구'; no match gives ''; null stays null
    assert got == [("", None), ("경기도 어딘가", ""), ("서울특별시 강남구청", "강남구")]
    first = out.where("park_provider_name like '서울%'").first()
    assert first["park_data_date"] == dt.date(2024, 1, 5) and first["park_provider_code"] == 3000000
    assert out.where("park_provider_name IS NULL").first()["park_designation_date"] is None
    # an empty district becomes null after a partitioned write
    path = f"{tmp_dir}/parks"
    out.write.partitionBy("park_district").parquet(path)
    back = spark.read.parquet(path)
    assert back.where("park_district IS NULL").count() == 2


def test_event_info_recode_and_coordinates(spark):
    def ev(title, is_free, lot, lat, k1, k2, k3):
        base = {c: None for c in EVENT_INFO_RAW.fieldNames()}
        base.update({"TITLE": title, "IS_FREE": is_free, "LOT": lot, "LAT": lat, "STRTDATE": "2024-01-05 00:00:00.0",
                     "END_DATE": "2024-1-6", "GUNAME": "종로구", "Keyword_1": k1, "Keyword_2": k2, "Keyword_3": k3})
        return tuple(base[c] for c in EVENT_INFO_RAW.fieldNames())
    raw = spark.createDataFrame([ev("무료 공연", "무료", "37.5", "127.0", None, None, None),
                                 ev("유료 공연", "유료", "37.6", "127.1", "음악", None, None),
                                 ev("모름", "기타", "x", "127.2", "음악", "공연", None)], EVENT_INFO_RAW)
    out = {r["cul_title"]: r for r in C.build_event_info(raw).collect()}
    assert out["무료 공연"]["cul_is_free"] is True
    assert out["유료 공연"]["cul_is_free"] is False
    assert out["모름"]["cul_is_free"] is None
    assert out["무료 공연"]["cul_latitude"] == 37.5 and out["무료 공연"]["cul_longitude"] == 127.0  # LOT -> lat
    assert out["모름"]["cul_latitude"] is None
    assert out["무료 공연"]["cul_start_date"] == dt.date(2024, 1, 5)
    assert out["무료 공연"]["cul_end_date"] == dt.date(2024, 1, 6)


def test_library_mapping_and_quality(spark):
    raw = spark.createDataFrame([("L1", "도서관", "주소", "02", "", "37.5", "127.0", "http://x", "월", "9-18", "1200", "강남구")],
                                "libCode string, libName string, address string, tel string, fax string, "
                                "latitude string, longitude string, homepage string, closed string, "
                                "operatingTime string, BookCount string, district string")
    data, quality = C.build_library_data(raw)
    assert data.columns == ["lib_name", "lib_latitude", "lib_longitude", "lib_homepage", "lib_book_count", "lib_district"]
    r = data.first()
    assert (r["lib_name"], r["lib_book_count"], r["lib_latitude"]) == ("도서관", 1200, 37.5)
    q = quality.collect()
    assert len(q) == 1 and q[0]["passed"] is True and q[0]["value"] == 6.0
