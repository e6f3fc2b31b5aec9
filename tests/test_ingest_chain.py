"""JN-5 to P-1: open requests, landed responses, ledger; runs that die or find nothing."""

import os

import pytest

from metroframe.plans import ingest as I
from metroframe.sources.manifest import latest_members, refresh_manifest


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def loans(*books):
    docs = "".join(f"<doc><no>1</no><bookname>{b}</bookname><authors/><isbn13>9788936434120</isbn13><class_nm>문학 &gt; 소설</class_nm>"
                   f"<loan_count>3</loan_count></doc>" for b in books)
    return f"<response><request><pageSize>200</pageSize></request><docs>{docs}</docs></response>"


@pytest.fixture
def place(tmp_dir):
    return {n: f"{tmp_dir}/{n}" for n in ("responses", "raw", "ledger", "curated", "ckpt")}


def run(spark, place, end="202402"):
    return I.ingest_best_loans(spark, place["responses"], place["raw"], place["ledger"], place["curated"], place["ckpt"], "202401", end,
                               ["강남구", "중구"])


def books(spark, place):
    rows = spark.read.parquet(place["curated"]).collect()
    return sorted((r["bll_book_name"], r["bll_district"], r["bll_year"], r["bll_month"], r["bll_class_sub"], r["bll_class_detailed"]) for r in rows)


def test_open_requests_are_the_grid_without_the_ledger(spark, place):
    rows = I.open_loan_requests(spark, "202312", "202402", place["ledger"], ["강남구", "중구"]).collect()
    assert len(rows) == 6
    r = next(r for r in rows if (r["district"], r["month"]) == ("강남구", 2))
    assert (r["dtl_region"], r["region"], r["page_size"], r["start_dt"], r["end_dt"], r["folder"]) == (
        11230, 11, 200, "2024-02-01", "2024-02-29", "district=강남구/year=2024/month=2")
    spark.createDataFrame([("강남구", 2024, 2, 0)], I.LOAN_LEDGER).write.parquet(place["ledger"])
    assert I.open_loan_requests(spark, "202312", "202402", place["ledger"], ["강남구", "중구"]).count() == 5
    with pytest.raises(ValueError):
        I.open_loan_requests(spark, "202401", "202401", place["ledger"], ["없는구"])


def test_loans_land_once(spark, place):
    assert run(spark, place)[0].requests == 0 and run(spark, place)[1] == 0
    put(f"{place['responses']}/district=강남구/year=2024/month=1/a.xml", loans("책 &amp; 책", "둘"))
    put(f"{place['responses']}/district=중구/year=2024/month=1/a.xml", "<response><error>인증키</error></response>")
    put(f"{place['responses']}/district=중구/year=2024/month=2/a.xml", loans())
    put(f"{place['responses']}/district=중구/year=2024/month=3/a.xml", loans("later"))  # not asked for yet
    landed, taken = run(spark, place)
    assert (landed.requests, landed.rows, taken) == (2, 2, 2)  # a response without loans is committed too
    assert [(r["feed"], r["code"], r["message"]) for r in landed.rejects.collect()] == [("district=중구/year=2024/month=1", "ERROR", "인증키")]
    first = [("둘", "강남구", 2024, 1, "소설", None), ("책 & 책", "강남구", 2024, 1, "소설", None)]
    assert books(spark, place) == first
    assert run(spark, place)[1] == 0 and books(spark, place) == first
    put(f"{place['responses']}/district=중구/year=2024/month=1/a.xml", loans("셋"))  # fetched again
    assert run(spark, place, "202403")[1] == 2
    assert [b[0] for b in books(spark, place)] == ["later", "둘", "셋", "책 & 책"]


def test_a_run_that_dies_before_the_ledger_is_repeated(spark, place, monkeypatch):
    put(f"{place['responses']}/district=강남구/year=2024/month=1/a.xml", loans("하나"))
    old, done = I._written, []

    def dying(df, name):
        if name == "loan_done" and not done:
            done.append(1)
            raise OSError("lost")
        return old(df, name)

    monkeypatch.setattr(I, "_written", dying)
    with pytest.raises(OSError):
        run(spark, place)
    assert run(spark, place)[1] == 1 and [b[0] for b in books(spark, place)] == ["하나"]


def events(*names, code="INFO-000", total=None):
    n = f"<list_total_count>{total}</list_total_count>" if total is not None else ""
    rows = "".join(f"<row><GUNAME>{g}</GUNAME><TITLE>{t}</TITLE><STRTDATE>2024-6-1 00:00:00.0</STRTDATE><END_DATE>미정</END_DATE></row>" for g, t in names)
    return f"<culturalEventInfo>{n}<RESULT><CODE>{code}</CODE><MESSAGE>m</MESSAGE></RESULT>{rows}</culturalEventInfo>"


def test_events_land_when_their_feed_is_whole(spark, place):
    end = "<r><CODE>INFO-200</CODE></r>"
    r = place["responses"]
    put(f"{r}/request_date=240601/page=0/a.xml", events(("강남구", "a"), ("중구 강남구", "both"), ("부산", "none"), total=4))
    put(f"{r}/request_date=240601/page=1/a.xml", events(("", "blank")))
    put(f"{r}/request_date=240601/page=2/a.xml", end)
    put(f"{r}/request_date=240602/page=0/a.xml", events(("중구", "b")))
    put(f"{r}/request_date=240602/page=2/a.xml", end)  # page 1 is not there
    put(f"{r}/request_date=240603/page=0/a.xml", events(("중구", "c")))  # breaks off
    put(f"{r}/request_date=240604/page=0/a.xml", events(("중구", "d"), total=9))
    put(f"{r}/request_date=240604/page=1/a.xml", end)
    districts = ["강남구", "중구", "종로구"]
    landed, latest = I.ingest_events(spark, r, place["raw"], place["ledger"], districts)
    assert (landed.requests, landed.rows) == (1, 4)
    assert {(x["feed"], x["code"]) for x in landed.rejects.collect()} == {("240602", "MISSING-PAGE"), ("240603", "NO-END"), ("240604", "SHORT-FEED")}
    rows = {(x["TITLE"], x["district"], x["STRTDATE"], x["END_DATE"], x["request_date"]) for x in latest.collect()}
    assert rows == {("a", "강남구", "2024-06-01", None, "240601"), ("both", "강남구", "2024-06-01", None, "240601"),
                    ("both", "중구", "2024-06-01", None, "240601")}
    members = latest_members(refresh_manifest(spark, place["raw"], f"{place['raw']}_manifest")).first()["members"]
    assert members == ["강남구", "종로구", "중구"]  # a district without events is in the snapshot
    put(f"{r}/request_date=240602/page=1/a.xml", events(("종로구", "late")))
    landed, latest = I.ingest_events(spark, r, place["raw"], place["ledger"], districts)
    assert landed.requests == 1 and {x["TITLE"] for x in latest.collect()} == {"b", "late"}
    assert I.ingest_events(spark, r, place["raw"], place["ledger"], districts)[0].requests == 0
    none, rows = I.ingest_events(spark, f"{r}/none", f"{place['raw']}/none", f"{place['ledger']}/none", districts)
    assert none.requests == 0 and rows.count() == 0


def test_command_line(spark, place, capsys):
    from metroframe.cli import main

    put(f"{place['responses']}/district=강남구/year=2024/month=1/a.xml", loans("하나"))
    put(f"{place['responses']}/district=중구/year=2024/month=1/a.xml", "<response><error>x</error></response>")
    common = ["--ledger", place["ledger"], "--start", "202401", "--end", "202401", "--districts", "강남구", "중구"]
    assert main(["loan-requests", *common]) == 0 and capsys.readouterr().out.count("dtl_region") == 2
    assert main(["land-loans", "--responses", place["responses"], "--raw", place["raw"], *common]) == 1
    assert '{"requests": 1, "rows": 1}' in capsys.readouterr().out
    assert main(["loan-requests", *common]) == 0 and "중구" in capsys.readouterr().out
