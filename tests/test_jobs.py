"""The whole flow of the reference platform on raw fixture folders:
raw CSV snapshots -> curated Parquet -> L2 union -> marts."""

import os

from metroframe.plans import jobs as J
from metroframe.sinks.versions import read_published

BOM = "﻿"


def write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


def test_raw_to_marts(spark, tmp_dir):
    raw, cur, mart = (os.path.join(tmp_dir, n) for n in ("raw", "curated", "mart"))
    # bus stops: an older snapshot that must be ignored, and the latest one
    write(f"{raw}/bus/request_date=231201/a.csv", BOM + "CRTR_ID,CRTR_NM,CRTR_TYPE,CRTR_NO,LAT,LOT,BUS_ARVL_INFO_GUIDEM_INSTL\n"
          "122000001,옛정류장,t,1,37.5,127.0,Y\n")
    write(f"{raw}/bus/request_date=240601/a.csv", BOM + "CRTR_ID,CRTR_NM,CRTR_TYPE,CRTR_NO,LAT,LOT,BUS_ARVL_INFO_GUIDEM_INSTL\n"
          "122000001,역삼정류장,t,1,37.5005,127.0,Y\n"
          "122000002,먼정류장,t,2,37.6,127.0,Y\n"
          "999000003,모르는정류장,t,3,37.5,127.0,Y\n")
    # stations and the CP949 district file
    write(f"{raw}/subway/request_date=240601/a.csv", BOM + "BLDN_ID,BLDN_NM,ROUTE,LAT,LOT\n"
          "1,역삼,2호선(서울),37.5004,127.0001\n")
    write(f"{raw}/subway_district.csv", "자치구,해당역(호선),역개수\n강남구,\"역삼(2), 강남(2)\",2\n", encoding="cp949")
    # parks with Korean headers
    write(f"{raw}/park/request_date=240601/a.csv", "공원명,공원구분,소재지지번주소,위도,경도,공원면적,지정고시일,관리기관명,전화번호,"
          "데이터기준일자,제공기관코드,제공기관명\n도산공원,근린,주소,37.5003,127.0,100,2000-01-01,기관,02,2024-01-05,3220000,"
          "서울특별시 강남구청\n")
    # events and their home pages
    write(f"{raw}/event-parse/request_date=240601/district=강남구/a.csv", BOM +
          "CODENAME,GUNAME,TITLE,DATE,PLACE,ORG_NAME,USE_TRGT,USE_FEE,PLAYER,PROGRAM,ETC_DESC,ORG_LINK,MAIN_IMG,"
          "RGSTDATE,TICKET,STRTDATE,END_DATE,THEMECODE,LOT,LAT,IS_FREE,HMPG_ADDR\n"
          "음악,강남구,봄 음악회,,홀,기관,누구나,,,,\"설명, \"\"따옴표\"\"\n둘째 줄\",,,2024-05-01 00:00:00.0,시민,2024-06-01,"
          "2024-06-02,,37.5001,127.0,무료,http://e/1\n")
    pages = spark.createDataFrame([("http://e/1", "<p>음악 공연 음악 재즈 공연 음악</p>")], "url string, html string")
    # libraries (district in the file and in the path)
    write(f"{raw}/library/request_date=240601/district=강남구/a.csv", BOM +
          "libCode,libName,address,tel,fax,latitude,longitude,homepage,closed,operatingTime,BookCount,district\n"
          "L1,역삼도서관,주소,02,,37.5002,127.0,http://l,월,9-18,1200,강남구\n")
    # loans
    write(f"{raw}/loans/district=강남구/year=2024/month=6/a.csv", BOM +
          "no,ranking,bookname,authors,publisher,publication_year,isbn13,addition_symbol,vol,class_no,loan_count,"
          "bookImageURL,bookDtlUrl,class_major,class_sub,class_detailed\n"
          "1,1,책,저자,출판사,2020,9788936434120,,,813.7,12,,,문학,한국문학,소설\n")

    J.bus_stop_job(spark, f"{raw}/bus", f"{cur}/bus")
    J.subway_station_job(spark, f"{raw}/subway", f"{raw}/subway_district.csv", f"{cur}/subway")
    J.city_park_job(spark, f"{raw}/park", f"{cur}/park")
    J.event_keyword_job(spark, f"{raw}/event-parse", pages, f"{raw}/event-info")
    J.event_info_job(spark, f"{raw}/event-info", f"{cur}/event")
    quality = J.library_job(spark, f"{raw}/library", f"{cur}/library")
    J.library_job(spark, f"{raw}/library", f"{cur}/library")  # a rerun replaces, never duplicates
    assert read_published(spark, f"{cur}/library").count() == 1
    assert J.best_loan_job(spark, f"{raw}/loans", f"{cur}/loans", f"{tmp_dir}/ckpt") == 1
    assert J.best_loan_job(spark, f"{raw}/loans", f"{cur}/loans", f"{tmp_dir}/ckpt") == 0
    assert quality.first()["passed"] is True

    bus = read_published(spark, f"{cur}/bus")
    assert sorted(r["bus_name"] for r in bus.collect()) == ["먼정류장", "역삼정류장"]  # latest only, unknown prefix out
    ev = read_published(spark, f"{cur}/event").first()
    assert (ev["cul_keyword_1"], ev["cul_keyword_2"], ev["cul_keyword_3"]) == ("음악", "공연", "재즈")
    assert ev["cul_is_free"] is True and ev["cul_latitude"] == 37.5001

    J.entity_union_job(spark, f"{cur}/library", f"{cur}/event", f"{cur}/loans", f"{mart}/entities")
    J.facility_locations_job(spark, f"{cur}/bus", f"{cur}/subway", f"{cur}/park", f"{mart}/facilities")
    J.accessibility_job(spark, f"{mart}/entities", f"{mart}/facilities", f"{mart}/accessibility")
    acc = {r["entity_name"]: r for r in read_published(spark, f"{mart}/accessibility").collect()}
    assert set(acc) == {"역삼도서관", "봄 음악회", "책"}
    lib = acc["역삼도서관"]
    assert (lib["bus_stops_within_1km"], lib["subway_stations_within_1km"], lib["parks_within_1km"]) == (1, 1, 1)
    assert acc["봄 음악회"]["event_keywords"] == "음악,공연,재즈"
    book = acc["책"]
    assert (book["bus_stops_within_1km"], book["subway_stations_within_1km"], book["parks_within_1km"]) == (0, 0, 0)


def test_tables_follow_the_jobs(spark, tmp_dir):
    from metroframe.schemas import FACILITY_LOCATIONS

    bus = spark.createDataFrame([("정류장", 37.5, 127.0, "강남구")], "bus_name string, bus_latitude double, bus_longitude double, bus_district string")
    sta = spark.createDataFrame([], "sta_name string, sta_latitude double, sta_longitude double, sta_district string")
    park = spark.createDataFrame([], "park_name string, park_latitude double, park_longitude double, park_district string")
    for k, (name, df) in enumerate((("bus", bus), ("sta", sta), ("park", park), ("bus", bus.union(bus)))):
        df.write.mode("overwrite").parquet(f"{tmp_dir}/{name}")
        if k >= 2:
            J.facility_locations_job(spark, f"{tmp_dir}/bus", f"{tmp_dir}/sta", f"{tmp_dir}/park", f"{tmp_dir}/fac", table="jobs_facilities")
            assert spark.table("jobs_facilities").count() == k - 1
    for _ in range(2):  # a rerun builds the table anew
        assert J.load_table_job(spark, "jobs_loaded", FACILITY_LOCATIONS, f"{tmp_dir}/fac", f"{tmp_dir}/loaded") == (2, 0)
        assert spark.table("jobs_loaded").count() == 2 and spark.table("jobs_loaded").first()["facility_name"] == "정류장"
    for t in ("jobs_facilities", "jobs_loaded"):
        spark.sql(f"DROP TABLE {t}")


def test_cli_runs_a_job(spark, tmp_dir):
    from metroframe.cli import main

    write(f"{tmp_dir}/raw/request_date=240601/a.csv", "CRTR_ID,CRTR_NM,LAT,LOT\n100000001,정류장,37.5,127.0\n")
    assert main(["bus-stops", "--raw", f"{tmp_dir}/raw", "--out", f"{tmp_dir}/out"]) == 0
    assert [r["bus_district"] for r in read_published(spark, f"{tmp_dir}/out").collect()] == ["종로구"]
