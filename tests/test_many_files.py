"""Work that follows the number of pages, not a listing by the driver or a fixed number of tasks."""

from pyspark.sql import functions as F


def test_event_pages_are_listed_by_spark(spark, tmp_dir, monkeypatch):
    from metroframe.plans import ingest
    from metroframe.sources.headers import has_files, list_files

    ok = "<f><RESULT><CODE>INFO-000</CODE></RESULT><row><TITLE>t{}</TITLE><GUNAME>강남구</GUNAME></row></f>"
    pages = [(n, ok.format(n)) for n in range(1, 60)] + [(60, "<f><CODE>INFO-200</CODE></f>")]
    df = spark.createDataFrame(pages, "page long, value string").withColumn("request_date", F.lit("240612"))
    df.write.partitionBy("request_date", "page").text(f"{tmp_dir}/responses")
    for name in ("_page=61", "page=62/_part", "page=63/.part"):  # not taken
        hidden = spark._jvm.java.io.File(f"{tmp_dir}/responses/request_date=240612/{name}")
        hidden.mkdirs()
        spark.createDataFrame([(ok.format("hidden"),)], "value string").coalesce(1).write.text(f"{hidden.getPath()}/x")
    hidden = f"{tmp_dir}/responses/request_date=240612"
    assert has_files(spark, hidden) and len(list_files(spark, hidden)) == 60
    assert not has_files(spark, f"{hidden}/page=62") and not has_files(spark, f"{tmp_dir}/none")
    assert not has_files(spark, f"{hidden}/page=63") and list_files(spark, f"{hidden}/page=63") == []

    def by_driver(*a):
        raise AssertionError("the driver lists the pages")

    monkeypatch.setattr(ingest, "list_files", by_driver)
    landed = ingest.land_events(spark, f"{tmp_dir}/responses", f"{tmp_dir}/raw", f"{tmp_dir}/ledger", ["강남구"])
    assert (landed.requests, landed.rows, landed.rejects.count()) == (1, 59, 0)
    again = ingest.land_events(spark, f"{tmp_dir}/responses", f"{tmp_dir}/raw", f"{tmp_dir}/ledger", ["강남구"])
    assert (again.requests, again.rows) == (0, 0)


def test_pages_of_a_task_do_not_grow_with_the_rows(spark, tmp_dir):
    from metroframe.plans.keywords import spread_pages

    for n in (2000, 8000):  # files that compress well
        spark.range(n).select(F.col("id").alias("page_id"), F.lit("<p>a b</p>").alias("html")).coalesce(1).write.parquet(f"{tmp_dir}/p{n}")
        assert spread_pages(spark, spark.read.parquet(f"{tmp_dir}/p{n}"), "page_id").rdd.getNumPartitions() >= n / 125
