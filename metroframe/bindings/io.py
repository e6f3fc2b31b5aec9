"""Sources and sinks as round trips through the shared scratch folder
(SRC-1..7, SRC-11, SET-3, SNK-1..5, SNK-8, AGG-4, AGG-5, FLT-5).

Each query writes driver tables with the operator under test into a fresh
folder below ``spark.checkpoint.dir`` and returns the read-back DataFrame;
the oracle selects the expected rows from the original tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroframe.bindings import query
from metroframe.bindings import tables as tb
from metroframe.operators.aggregates import collect_latest
from metroframe.operators.filters import partition_equals
from metroframe.session import scratch_path, unique_name
from metroframe.sinks import files as SK
from metroframe.sinks import tables as ST
from metroframe.sinks import versions as VER
from metroframe.sources import csv as CSV
from metroframe.sources import manifest as MAN
from metroframe.sources import snapshot as SNAP
from metroframe.sources import xml as XML
from metroframe.sources.headers import hadoop_path, read_csv_by_name


# --- CSV -----------------------------------------------------------------------------
ORDERS_CSV_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("o_orderpriority", T.StringType()),
    T.StructField("note", T.StringType())])

# a text field holding a comma, doubled quotes and a line break
NOTE_SQL = "o_orderpriority || ', \"' || o_orderstatus || '\"' || chr(10) || 'line 2'"


def _orders_with_note(spark, d):
    o = tb.table(spark, d, "orders")
    note = F.concat(F.col("o_orderpriority"), F.lit(', "'), F.col("o_orderstatus"), F.lit('"\nline 2'))
    return o.withColumn("note", note)


def _orders_csv(spark, d):
    path = scratch_path(spark, "orders_csv")
    SK.write_csv(_orders_with_note(spark, d), path)
    return path


@query("src_csv_scan", f"SELECT *, {NOTE_SQL} AS note FROM orders")
def q_src_csv_scan(spark, d):
    """SRC-1: header CSV with an explicit schema; quoted fields keep their
    commas, quotes and line breaks (multiLine)."""
    return CSV.read_csv(spark, _orders_csv(spark, d), ORDERS_CSV_SCHEMA)


@query("src_csv_header_order", """
SELECT CASE WHEN o_orderkey % 3 <> 2 THEN o_custkey END AS o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate,
       o_orderpriority, 'part ' || (o_orderkey % 3) AS part FROM orders""")
def q_src_csv_header_order(spark, d):
    """SRC-1: files whose headers differ: columns in another order, one more,
    one less; all rows come by name, with the folder's column."""
    o = tb.table(spark, d, "orders").withColumn("part", F.concat(F.lit("part "), (F.col("o_orderkey") % 3).cast("string")))
    path = scratch_path(spark, "orders_headers")
    plain, turned, less = (o.where(F.col("o_orderkey") % 3 == k) for k in range(3))
    SK.write_csv(plain, path, ["part"])
    SK.write_csv(turned.select(*reversed(turned.columns)).withColumn("extra", F.lit("x")), path, ["part"], mode="append")
    SK.write_csv(less.select("o_orderpriority", "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate", "part"), path, ["part"],
                 mode="append")
    schema = T.StructType([ORDERS_CSV_SCHEMA[n] for n in ("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                                                          "o_orderpriority")] + [T.StructField("part", T.StringType())])
    return read_csv_by_name(spark, path, schema, options={"timestampNTZFormat": CSV.TIMESTAMP_TEXT})


@query("src_csv_inferred", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS order_day,
       o_orderpriority, {NOTE_SQL} AS note FROM orders""")
def q_src_csv_inferred(spark, d):
    """SRC-2: types inferred from the text (ints, doubles, timestamps)."""
    df = CSV.read_csv_inferred(spark, _orders_csv(spark, d))
    return df.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
                     F.col("o_custkey").cast("bigint").alias("o_custkey"), "o_orderstatus",
                     F.col("o_totalprice").cast("double").alias("o_totalprice"),
                     F.col("o_orderdate").cast("date").alias("order_day"), "o_orderpriority", "note")


@query("src_csv_charset", """
SELECT n_nationkey, '국가 ' || n_name || ' 구' AS name_ko, n_regionkey FROM nation""")
def q_src_csv_charset(spark, d):
    """SRC-3: Hangul text written and read back in CP949."""
    n = tb.table(spark, d, "nation")
    ko = n.select("n_nationkey", F.concat(F.lit("국가 "), F.col("n_name"), F.lit(" 구")).alias("name_ko"),
                  "n_regionkey")
    path = scratch_path(spark, "nation_cp949")
    SK.write_csv_charset(ko, path, "CP949")
    return CSV.read_csv_charset(spark, path, "CP949", "n_nationkey int, name_ko string, n_regionkey int")


# --- dated snapshots (events by request_date = yyMMdd, district = event_type) ----------
EVENTS_SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType())])


def _event_snapshots(spark, d):
    e = tb.table(spark, d, "events")
    path = scratch_path(spark, "event_snapshots")
    landed = e.select("event_id", "ts", "user_id", "value", "props",
                      F.date_format("ts", "yyMMdd").alias("request_date"), F.col("event_type").alias("district"))
    SK.write_csv(landed, path, ["request_date", "district"])
    return path


def _manifest(spark, path):
    return MAN.refresh_manifest(spark, path, scratch_path(spark, "manifest"))


EV_COLS = "event_id, ts, user_id, value, props, strftime(ts, '%y%m%d') AS request_date, event_type AS district"


@query("src_latest_snapshot", f"""
SELECT * FROM (SELECT {EV_COLS} FROM events)
WHERE request_date = (SELECT max(strftime(ts, '%y%m%d')) FROM events)""")
def q_src_latest_snapshot(spark, d):
    """SRC-4: the rows of the largest request_date only (max over all
    partitions, then a pruned scan of that one)."""
    return SNAP.read_latest_snapshot(spark, _event_snapshots(spark, d), "csv", EVENTS_SNAPSHOT_SCHEMA)


@query("flt_partition_prune", f"""
SELECT * FROM (SELECT {EV_COLS} FROM events)
WHERE request_date = (SELECT min(strftime(ts, '%y%m%d')) FROM events)""")
def q_flt_partition_prune(spark, d):
    """FLT-5: equality on the partition column; only that folder is listed and read."""
    path = _event_snapshots(spark, d)
    first = min(MAN.child_values(spark, path, "request_date"))
    return partition_equals(SNAP.read_snapshot(spark, path, first, "csv", EVENTS_SNAPSHOT_SCHEMA), "request_date", first)


@query("agg_max_partition", "SELECT max(strftime(ts, '%y%m%d')) AS latest_request_date FROM events")
def q_agg_max_partition(spark, d):
    """AGG-4: max of the text partition column, from the manifest."""
    return MAN.latest_date(_manifest(spark, _event_snapshots(spark, d)), "request_date", "latest_request_date")


@query("agg_collect_latest", """
SELECT request_date, list_sort(list(DISTINCT district)) AS members FROM (SELECT {cols} FROM events)
WHERE request_date = (SELECT max(strftime(ts, '%y%m%d')) FROM events) GROUP BY request_date""".replace(
    "{cols}", EV_COLS))
def q_agg_collect_latest(spark, d):
    """AGG-5: the districts present in the latest snapshot, from the manifest; no data file is read."""
    return MAN.latest_members(_manifest(spark, _event_snapshots(spark, d)))


@query("agg_collect_latest_rows", """
SELECT request_date, list_sort(list(DISTINCT district)) AS members FROM (SELECT {cols} FROM events)
WHERE request_date = (SELECT max(strftime(ts, '%y%m%d')) FROM events) GROUP BY request_date""".replace("{cols}", EV_COLS))
def q_agg_collect_latest_rows(spark, d):
    """AGG-5 over rows of a table."""
    e = tb.table(spark, d, "events").select(F.date_format("ts", "yyMMdd").alias("request_date"), F.col("event_type").alias("district"))
    return collect_latest(e, "request_date", "district")


@query("src_manifest", """
SELECT strftime(ts, '%y%m%d') AS request_date, event_type AS member, count(*) > 0 AS has_rows FROM events GROUP BY ALL
UNION ALL SELECT max(strftime(ts, '%y%m%d')), 'waiting', false FROM events
UNION ALL SELECT max(strftime(ts, '%y%m%d')), 'header only', false FROM events""")
def q_src_manifest(spark, d):
    """SRC-4: the manifest of all dates, refreshed twice: half of the dates land first, then the
    others, with a district that has no file yet and one whose file holds a header alone."""
    e = tb.table(spark, d, "events")
    landed = e.select("event_id", "ts", F.date_format("ts", "yyMMdd").alias("request_date"), F.col("event_type").alias("district"))
    path, manifest = scratch_path(spark, "event_landing"), scratch_path(spark, "event_manifest")
    odd = F.col("request_date").cast("int") % 2 == 1
    SK.write_csv(landed.where(odd), path, ["request_date", "district"])
    MAN.refresh_manifest(spark, path, manifest)
    SK.write_csv(landed.where(~odd), path, ["request_date", "district"], mode="append")
    newest = MAN.latest_snapshot(spark, path)[1]
    fs, waiting = hadoop_path(spark, f"{newest}/district=waiting")
    fs.mkdirs(waiting)
    SK.write_csv(landed.select("event_id", "ts").limit(0).coalesce(1), f"{newest}/district=header only")
    table = MAN.refresh_manifest(spark, path, manifest)
    rows = F.col("file").isNotNull() & (F.col("member") != "header only")
    return table.groupBy("request_date", "member").agg(F.max(rows).alias("has_rows"))


# --- XML pages with a status code ---------------------------------------------------------
PAGE_SIZE = 25  # records per response page; a page is one bounded group
ERROR_PAGE = 1  # the second page answers with an error code
XML_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("S_SUPPKEY", "S_NAME", "S_ACCTBAL", "NOTE")])


def _xml_pages(spark, d, lost=None, cut=False):
    """supplier as API responses: pages of 25 <row> records, each file with a
    RESULT/CODE; page 1 is an error page, and one extra page ends the feed. ``lost`` is
    a page left out; ``cut`` adds a page that breaks off, and an announced total."""
    s = tb.table(spark, d, "supplier")
    note = (F.when(F.col("s_nationkey") < 10, F.lit("<NOTE></NOTE>"))
            .when(F.col("s_nationkey") < 20, F.lit("<NOTE> A &amp; B </NOTE>")).otherwise(F.lit("")))
    row = F.concat(F.lit("<row><S_SUPPKEY>"), F.col("s_suppkey").cast("string"), F.lit("</S_SUPPKEY><S_NAME>  "),
                   F.col("s_name"), F.lit("  </S_NAME><S_ACCTBAL>"), F.format_string("%.2f", F.col("s_acctbal")),
                   F.lit("</S_ACCTBAL>"), note, F.lit("</row>"))
    page = F.floor(F.col("s_suppkey") / PAGE_SIZE)
    rows = s.select(page.alias("page"), F.col("s_suppkey"), row.alias("xml"))
    ordered = F.array_sort(F.collect_list(F.struct("s_suppkey", "xml"))).getField("xml")
    docs = rows.groupBy("page").agg(F.array_join(ordered, "").alias("body"))
    code = F.when(F.col("page") == ERROR_PAGE, F.lit("ERROR-500")).otherwise(F.lit("INFO-000"))
    total = F.concat(F.lit("<list_total_count>"), F.lit(s.count()).cast("string"), F.lit("</list_total_count>")) if cut else F.lit("")
    files = docs.select("page", F.concat(F.lit("<response>"), total, F.lit("<RESULT><CODE>"), code, F.lit("</CODE><MESSAGE>m</MESSAGE>"
                                                                                        "</RESULT>"), F.col("body"),
                                         F.lit("</response>")).alias("value"))
    end = files.agg(F.max("page").alias("page")).select(
        (F.col("page") + 1).alias("page"),
        F.lit("<response><CODE>INFO-200</CODE><MESSAGE>no data</MESSAGE></response>").alias("value"))
    path = scratch_path(spark, "supplier_xml")
    if cut:
        end = end.unionByName(end.select((F.col("page") + 1).alias("page"), F.lit("<response><RESULT><CODE>INFO-000</CODE><row>").alias("value")))
    if lost is not None:
        files = files.where(F.col("page") != lost)
    files.unionByName(end).repartition("page").write.partitionBy("page").text(path)
    return path


XML_ROWS_SQL = """SELECT s_suppkey, s_name, CAST(printf('%.2f', s_acctbal) AS DOUBLE) AS s_acctbal,
    CASE WHEN s_nationkey < 10 THEN '' WHEN s_nationkey < 20 THEN 'A & B' END AS note FROM supplier"""


def _typed(df):
    return df.select(F.col("S_SUPPKEY").cast("bigint").alias("s_suppkey"), F.col("S_NAME").alias("s_name"),
                     F.col("S_ACCTBAL").try_cast("double").alias("s_acctbal"), F.col("NOTE").alias("note"))


@query("src_xml_records", XML_ROWS_SQL)
def q_src_xml_records(spark, d):
    """SRC-6: every <row> of every page: child tag = column, text trimmed,
    entities decoded, empty element '', missing element null."""
    return _typed(XML.read_xml_records(spark, _xml_pages(spark, d), "row", XML_SCHEMA))


@query("src_xml_status_gate", f"SELECT * FROM ({XML_ROWS_SQL}) WHERE floor(s_suppkey / {PAGE_SIZE}) <> {ERROR_PAGE}")
def q_src_xml_status_gate(spark, d):
    """SRC-7: only pages coded INFO-000 contribute rows; the error page goes
    to the rejects, the INFO-200 page ends the feed."""
    rows, _rejects = XML.read_xml_gated(spark, _xml_pages(spark, d), "row", XML_SCHEMA)
    return _typed(rows)


@query("set_concat_pages", f"""
SELECT CAST(floor(s_suppkey / {PAGE_SIZE}) AS BIGINT) AS page, count(*) AS records FROM supplier
WHERE floor(s_suppkey / {PAGE_SIZE}) <> {ERROR_PAGE} GROUP BY 1""")
def q_set_concat_pages(spark, d):
    """SET-3: the good pages appended into one frame, columns united by name
    (one explicit schema); one row per page with its record count."""
    pages = XML.parse_pages(XML.read_responses(spark, _xml_pages(spark, d)), XML_SCHEMA)
    return pages.where(F.col("code") == "INFO-000").select("page", F.size("records").cast("bigint").alias("records"))


LOST_PAGE = 2  # a page of which no file is there


@query("src_xml_completeness", f"""
WITH p AS (SELECT CAST(floor(s_suppkey / {PAGE_SIZE}) AS BIGINT) AS page, count(*) AS n FROM supplier GROUP BY 1),
  t AS (SELECT max(page) AS last, sum(n) FILTER (page NOT IN ({ERROR_PAGE}, {LOST_PAGE})) AS got, sum(n) AS total FROM p)
SELECT page, 'ERROR-500' AS code, 'm' AS message FROM p WHERE page = {ERROR_PAGE}
UNION ALL SELECT page, 'MISSING-PAGE', NULL FROM p WHERE page = {LOST_PAGE}
UNION ALL SELECT NULL, 'SHORT-FEED', got::BIGINT || ' of ' || total::BIGINT FROM t WHERE got < total
UNION ALL SELECT last + 2, 'MALFORMED', NULL FROM t""")
def q_src_xml_completeness(spark, d):
    """SRC-7: what keeps a feed from being complete: an error page, a page that is not there, one that
    is cut off, and fewer records than announced."""
    pages = XML.parse_pages(XML.read_responses(spark, _xml_pages(spark, d, lost=LOST_PAGE, cut=True)), XML_SCHEMA)
    return XML.page_rejects(pages).select("page", "code", "message")


# --- sinks ---------------------------------------------------------------------------------
ORDERS_SQL = "SELECT * FROM orders"


@query("snk_parquet_overwrite", ORDERS_SQL)
def q_snk_parquet_overwrite(spark, d):
    """SNK-1: partitioned Parquet overwrite, run twice: rows appear once."""
    o = tb.table(spark, d, "orders")
    path = scratch_path(spark, "orders_overwrite")
    for _ in range(2):
        SK.write_parquet(o, path, ["o_orderstatus"])
    return spark.read.parquet(path).select(*o.columns)


@query("snk_full_refresh", ORDERS_SQL)
def q_snk_full_refresh(spark, d):
    """SNK-3: a full refresh replaces every old partition, including ones the
    new data does not have, as a new version."""
    o = tb.table(spark, d, "orders")
    path = scratch_path(spark, "orders_refresh")
    stale = o.withColumn("o_orderstatus", F.concat(F.lit("stale-"), F.col("o_orderstatus")))
    VER.publish(stale, path, ["o_orderstatus"])
    VER.publish(o, path, ["o_orderstatus"])
    return VER.read_published(spark, path)


@query("snk_versions", f"""
SELECT 'first' AS version, * FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'second', * FROM orders
UNION ALL SELECT 'table after roll back', * FROM orders WHERE o_orderkey % 2 = 0""")
def q_snk_versions(spark, d):
    """SNK-3 and SNK-6: two versions of a partitioned table, each readable; a catalog table follows, also back to the first."""
    o = tb.table(spark, d, "orders")
    path, name = scratch_path(spark, "orders_versions"), unique_name("orders_versions")
    first = VER.publish_table(o.where("o_orderkey % 2 = 0"), name, path, ["o_orderstatus"])
    second = VER.publish_table(o, name, path, ["o_orderstatus"])
    VER.roll_back(spark, path, first)
    VER.repair_table(spark, name, path)
    parts = {"first": VER.read_published(spark, path, first), "second": VER.read_published(spark, path, second),
             "table after roll back": spark.table(name).select(*o.columns)}
    return reduce(DataFrame.unionByName, [df.withColumn("version", F.lit(k)) for k, df in parts.items()])


LINE_SQL = "SELECT * FROM lineitem"


@query("snk_parquet_append", LINE_SQL)
def q_snk_parquet_append(spark, d):
    """SNK-2: two appends (line numbers <= 3, then > 3) into one partitioned
    folder; all rows are there once."""
    li = tb.table(spark, d, "lineitem")
    path = scratch_path(spark, "lineitem_append")
    SK.append_parquet(li.where(F.col("l_linenumber") <= 3), path, ["l_returnflag"])
    SK.append_parquet(li.where(F.col("l_linenumber") > 3), path, ["l_returnflag"])
    return spark.read.parquet(path).select(*li.columns)


PART_SQL = "SELECT * FROM part"
PART_SCHEMA = "p_partkey bigint, p_name string, p_brand string, p_size int, p_retailprice double, p_type string"


@query("snk_csv_partitioned", PART_SQL)
def q_snk_csv_partitioned(spark, d):
    """SNK-4: header CSV, one folder per key (p_type), read back."""
    p = tb.table(spark, d, "part")
    path = scratch_path(spark, "part_csv")
    SK.write_csv(p, path, ["p_type"])
    back = spark.read.option("header", True).schema(PART_SCHEMA).csv(path)
    return back.select(*p.columns)


@query("snk_ctas", PART_SQL)
def q_snk_ctas(spark, d):
    """SNK-5: CREATE TABLE ... USING parquet LOCATION ... AS SELECT."""
    p = tb.table(spark, d, "part")
    view, name = unique_name("part_src"), unique_name("part_ctas")
    p.createOrReplaceTempView(view)
    ST.create_table_as_select(spark, name, view, scratch_path(spark, "part_ctas"))
    return spark.table(name)


@query("snk_bulk_load", PART_SQL)
def q_snk_bulk_load(spark, d):
    """SNK-7: Parquet files loaded into a typed table by position: the files' names are the
    table's, each on another column, and their values are text."""
    p = tb.table(spark, d, "part")
    src = scratch_path(spark, "part_files")
    turned = [*p.columns[1:], p.columns[0]]
    p.select(*[F.col(c).cast("string") for c in p.columns]).toDF(*turned).write.parquet(src)
    name = unique_name("part_loaded")
    ST.create_empty_table(spark, name, p.schema, scratch_path(spark, "part_table"))
    ST.bulk_load(spark, name, src)
    return spark.table(name)


@query("snk_bulk_load_rejects", """
SELECT 'loaded' AS kind, o_orderkey, NULL AS failed FROM orders WHERE o_orderkey % 10 > 1
UNION ALL SELECT 'rejected', o_orderkey, CASE o_orderkey % 10 WHEN 0 THEN 'o_custkey,o_totalprice' ELSE 'o_orderdate' END
FROM orders WHERE o_orderkey % 10 <= 1""")
def q_snk_bulk_load_rejects(spark, d):
    """SNK-7: rows whose text does not fit the table's types go to the rejects, with the columns at fault."""
    o = tb.table(spark, d, "orders")
    last = F.col("o_orderkey") % 10
    text = o.select("o_orderkey", F.when(last == 0, "x7").otherwise(F.col("o_custkey").cast("string")).alias("a"), F.col("o_orderstatus").alias("b"),
                    F.when(last == 0, "1,5").otherwise(F.col("o_totalprice").cast("string")).alias("c"),
                    F.when(last == 1, "2024-13-01").otherwise(F.col("o_orderdate").cast("string")).alias("d"), F.col("o_orderpriority").alias("e"))
    src, bad, name = scratch_path(spark, "orders_text"), scratch_path(spark, "orders_rejects"), unique_name("orders_loaded")
    text.write.parquet(src)
    ST.create_empty_table(spark, name, o.schema, scratch_path(spark, "orders_table"))
    loaded, rejected = ST.bulk_load(spark, name, src, rejects_path=bad, max_rejects=o.count())
    if loaded != spark.table(name).count() or rejected != spark.read.parquet(bad).count():
        raise AssertionError(f"{loaded} loaded, {rejected} rejected")
    good = spark.table(name).select(F.lit("loaded").alias("kind"), "o_orderkey", F.lit(None).cast("string").alias("failed"))
    return good.unionByName(spark.read.parquet(bad).select(
        F.lit("rejected").alias("kind"), F.get_json_object("row", "$.o_orderkey").cast("bigint").alias("o_orderkey"), F.array_join("failed", ",").alias("failed")))


@query("snk_insert_overwrite", ORDERS_SQL)
def q_snk_insert_overwrite(spark, d):
    """SNK-6: drop-create-insert rebuild as INSERT OVERWRITE by name, twice."""
    o = tb.table(spark, d, "orders")
    name = unique_name("orders_mart")
    ST.create_empty_table(spark, name, o.schema, scratch_path(spark, "orders_mart"))
    shuffled_cols = list(reversed(o.columns))
    for _ in range(2):
        ST.insert_overwrite(o.select(*shuffled_cols), name)
    return spark.table(name)


COPY_MONTHS = [(1997, 1), (1997, 2)]
KEPT_MONTH = (1998, 6)


@query("snk_partition_copy", f"""
SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(month(o_orderdate) AS INTEGER) AS mo
FROM orders
WHERE (year(o_orderdate), month(o_orderdate)) IN ({', '.join(f'({y}, {m})' for y, m in COPY_MONTHS)})
UNION ALL
SELECT o_orderkey, -1.0 AS o_totalprice, CAST(year(o_orderdate) AS INTEGER), CAST(month(o_orderdate) AS INTEGER)
FROM orders
WHERE year(o_orderdate) = {KEPT_MONTH[0]} AND month(o_orderdate) = {KEPT_MONTH[1]}""")
def q_snk_partition_copy(spark, d):
    """SNK-8: copy two (year, month) partitions into a store that holds stale
    copies of them and one other month; the two are replaced, the other kept."""
    o = tb.table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("yr"),
                                             F.month("o_orderdate").alias("mo"))
    src, dst = scratch_path(spark, "orders_by_month"), scratch_path(spark, "orders_copy")
    SK.write_parquet(o, src, ["yr", "mo"])
    wanted = None
    for y, m in COPY_MONTHS + [KEPT_MONTH]:
        c = (F.col("yr") == y) & (F.col("mo") == m)
        wanted = c if wanted is None else wanted | c
    SK.write_parquet(o.where(wanted).withColumn("o_totalprice", F.lit(-1.0)), dst, ["yr", "mo"])
    chosen = None
    for y, m in COPY_MONTHS:
        c = (F.col("yr") == y) & (F.col("mo") == m)
        chosen = c if chosen is None else chosen | c
    SK.copy_partitions(spark, src, dst, chosen, ["yr", "mo"])
    return spark.read.parquet(dst).select("o_orderkey", "o_totalprice", "yr", "mo")
