"""P-8..P-10 and the radius operators on fixtures, plus a property check of
the grid join against brute force (all pairs, computed in Python)."""

import math
import random


from metroframe.functions.geo import EARTH_RADIUS_M
from metroframe.operators.spatial import count_within_radius, radius_pairs
from metroframe.plans.marts import entity_union, facility_union, integrated_accessibility
from metroframe.schemas import ENTITY_UNION, INTEGRATED_ACCESSIBILITY

DEG_PER_M = math.degrees(1.0 / EARTH_RADIUS_M)


def py_haversine(lat1, lon1, lat2, lon2, r=EARTH_RADIUS_M):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((math.radians(lon2) - math.radians(lon1)) / 2) ** 2
    return 2 * r * math.asin(math.sqrt(a))


def _entities(spark):
    lib = spark.createDataFrame([("도서관", 37.5, 127.0, "강남구"), ("도서관", 37.5, 127.0, "강남구")],
                                "lib_name string, lib_latitude double, lib_longitude double, lib_district string")
    cul = spark.createDataFrame(
        [("공연", "강남구", "음악", None, None, 37.51, 127.0, True, "음악", None, "공연"),
         ("전시", "종로구", "전시", None, None, None, None, None, None, None, None)],
        "cul_title string, cul_district string, cul_class string, cul_start_date date, cul_end_date date, "
        "cul_latitude double, cul_longitude double, cul_is_free boolean, cul_keyword_1 string, "
        "cul_keyword_2 string, cul_keyword_3 string")
    bll = spark.createDataFrame([("책", "강남구", "문학", "소설", 12)],
                                "bll_book_name string, bll_district string, bll_class_major string, "
                                "bll_class_sub string, bll_loan_count bigint")
    return entity_union(lib, cul, bll)


def _facilities(spark):
    lat0, lon0 = 37.5, 127.0
    bus = spark.createDataFrame([
        ("가까운", lat0 + 999.0 * DEG_PER_M, lon0, "강남구"),    # just under 1 km
        ("먼", lat0 + 1001.0 * DEG_PER_M, lon0, "강남구"),       # just over
        ("건너편", lat0, lon0 + 0.001, "서초구"),                 # in range, other district
        ("같은이름", lat0, lon0 + 0.002, "강남구"),               # two in range with one name
        ("같은이름", lat0, lon0 - 0.002, "강남구"),
    ], "bus_name string, bus_latitude double, bus_longitude double, bus_district string")
    sta = spark.createDataFrame([(1, "역", lat0 + 0.001, lon0, "2호선", "강남구")],
                                "sta_id bigint, sta_name string, sta_latitude double, sta_longitude double, "
                                "sta_line string, sta_district string")
    park = spark.createDataFrame([("공원", None, None, "강남구")],
                                 "park_name string, park_latitude double, park_longitude double, park_district string")
    return facility_union(bus, sta, park)


def test_entity_union_shape(spark):
    u = _entities(spark)
    assert [f.name for f in u.schema.fields] == [f.name for f in ENTITY_UNION.fields]
    assert dict(u.dtypes)["loan_count"] == "bigint" and dict(u.dtypes)["event_start_date"] == "date"
    assert u.count() == 2 + 2 + 1  # union row count = sum of branches
    ev = u.where("name = '공연'").first()
    assert ev["event_keywords"] == "음악,공연"  # nulls skipped
    assert u.where("name = '전시'").first()["event_keywords"] == ""  # all null -> ''
    book = u.where("data_type = 'Book'").first()
    assert book["latitude"] is None and book["loan_count"] == 12


def test_accessibility_edge_rows(spark):
    out = integrated_accessibility(_entities(spark), _facilities(spark), radius_m=1000.0)
    assert [f.name for f in out.schema.fields] == [f.name for f in INTEGRATED_ACCESSIBILITY.fields]
    got = sorted((r["entity_name"], r["bus_stops_within_1km"], r["subway_stations_within_1km"], r["parks_within_1km"])
                 for r in out.collect())
    # library: '가까운' + '같은이름' (once); '먼' is over, '건너편' is in another district
    assert got == [("공연", 2, 0, 0),  # 1.1 km north: "먼" and "가까운" within, the station 1.0009 km away
                   ("도서관", 2, 1, 0), ("도서관", 2, 1, 0),  # identical rows both survive
                   ("전시", 0, 0, 0),  # no coordinates: 0, not null
                   ("책", 0, 0, 0)]


def test_grid_equals_brute_force(spark):
    rnd = random.Random(7)
    pts = []
    centres = [(37.5, 127.0), (0.0, 179.995), (0.0, -179.995), (84.0, 10.0), (-60.0, -70.0)]
    for i in range(400):
        c = rnd.choice(centres)
        pts.append((i, f"d{rnd.randint(0, 2)}", c[0] + rnd.uniform(-0.03, 0.03), ((c[1] + rnd.uniform(-0.03, 0.03) + 180) % 360) - 180))
    ent = spark.createDataFrame([p[1:] + (p[0],) for p in pts[:200]] + [("d0", None, 1.0, 999)],
                                "district string, lat double, lon double, eid int")
    fac = spark.createDataFrame([("K", f"n{p[0] % 50}", p[1], p[2], p[3]) for p in pts[200:]],
                                "kind string, name string, fd string, flat double, flon double")
    radius = 2500.0
    out = count_within_radius(ent, fac, district="district", lat="lat", lon="lon", fac_kind="kind", fac_name="name",
                              fac_district="fd", fac_lat="flat", fac_lon="flon", kinds={"K": "n"}, radius_m=radius)
    got = {r["eid"]: r["n"] for r in out.collect()}
    for e in pts[:200]:
        names = {f"n{f[0] % 50}" for f in pts[200:] if f[1] == e[1] and py_haversine(e[2], e[3], f[2], f[3]) <= radius}
        assert got[e[0]] == len(names), e
    assert got[999] == 0
    pairs = radius_pairs(ent.select("eid", "district", "lat", "lon"), fac.select("name", "fd", "flat", "flon"),
                         left_key="district", left_lat="lat", left_lon="lon", right_key="fd", right_lat="flat",
                         right_lon="flon", radius_m=radius)
    brute = sum(1 for e in pts[:200] for f in pts[200:] if f[1] == e[1] and py_haversine(e[2], e[3], f[2], f[3]) <= radius)
    assert pairs.count() == brute  # no pair lost or doubled
    salted = radius_pairs(ent.select("eid", "district", "lat", "lon"), fac.select("name", "fd", "flat", "flon"),
                          left_key="district", left_lat="lat", left_lon="lon", right_key="fd", right_lat="flat",
                          right_lon="flon", radius_m=radius, split_hot_cells=True, hot_share=0.05, hot_min_rows=5)
    assert salted.count() == brute
    assert salted.exceptAll(pairs).count() == 0


def test_accessibility_plan_has_no_nested_loop_or_cartesian(spark):
    out = integrated_accessibility(_entities(spark), _facilities(spark), radius_m=1000.0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_correlated_sql_form_equals_grid(spark):
    from metroframe.operators.spatial import Grid, correlated_count_sql, entity_cells, facility_cells
    from metroframe.session import unique_name

    rnd = random.Random(11)
    ent = spark.createDataFrame(
        [(i, f"d{rnd.randint(0, 1)}", 37.5 + rnd.uniform(-0.02, 0.02), 127.0 + rnd.uniform(-0.02, 0.02)) for i in range(150)]
        + [(999, "d0", None, None)], "eid int, district string, lat double, lon double")
    fac = spark.createDataFrame(
        [("K", f"n{i % 40}", f"d{rnd.randint(0, 1)}", 37.5 + rnd.uniform(-0.02, 0.02), 127.0 + rnd.uniform(-0.02, 0.02))
         for i in range(200)], "kind string, name string, fd string, flat double, flon double")
    radius = 800.0
    grid_counts = {r["eid"]: r["n"] for r in count_within_radius(
        ent, fac, district="district", lat="lat", lon="lon", fac_kind="kind", fac_name="name", fac_district="fd",
        fac_lat="flat", fac_lon="flon", kinds={"K": "n"}, radius_m=radius).collect()}
    grid = Grid(radius)
    ev, fv = unique_name("t_ent"), unique_name("t_fac")
    entity_cells(ent, grid, "lat", "lon").createOrReplaceTempView(ev)
    facility_cells(fac.selectExpr("kind", "name", "fd AS district", "flat AS lat", "flon AS lon"), grid, "lat", "lon") \
        .createOrReplaceTempView(fv)
    sql = correlated_count_sql(ev, fv, keys=["eid"], district="district", lat="lat", lon="lon", cy="cy", cx="cx",
                               outputs={"K": "n"}, radius_m=radius, select_cols=["eid"])
    sql_counts = {r["eid"]: r["n"] for r in spark.sql(sql).collect()}
    assert sql_counts == grid_counts
    assert sql_counts[999] == 0 and any(v > 0 for v in sql_counts.values())


def test_radius_zero_counts_identical_positions_only(spark):
    ent = spark.createDataFrame([("d", 37.5, 127.0, 1), ("d", 37.5, 127.00001, 2)], "d string, lat double, lon double, id int")
    fac = spark.createDataFrame([("K", "a", "d", 37.5, 127.0), ("K", "b", "d", 37.5, 127.0)],
                                "kind string, name string, fd string, flat double, flon double")
    out = count_within_radius(ent, fac, district="d", lat="lat", lon="lon", fac_kind="kind", fac_name="name",
                              fac_district="fd", fac_lat="flat", fac_lon="flon", kinds={"K": "n"}, radius_m=0.0)
    assert {r["id"]: r["n"] for r in out.collect()} == {1: 2, 2: 0}
