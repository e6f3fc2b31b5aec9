"""AGG-1 on two levels: equal to brute force, with fewer distances; GEO-3 as EXISTS."""

import math
import random

import pytest
from pyspark.sql import functions as F

from metroframe.functions.geo import EARTH_RADIUS_M
from metroframe.operators.spatial import CellPairs, box_distances_sql, count_within_radius, radius_pairs, within_radius

KINDS = {"Bus": "n_bus", "Park": "n_park"}


def distance(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    x = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(math.sqrt(min(1, x)))


def points(r, n, lat, lon, spread):
    return [(max(-90.0, min(90.0, lat + r.uniform(-spread, spread))), (lon + r.uniform(-spread, spread) + 180) % 360 - 180) for _ in range(n)]


PLACES = {"city": (37.5, 127.0, 0.03), "date line": (10.0, 180.0, 0.03), "north": (84.0, 20.0, 0.1), "pole": (89.99, 0.0, 0.02), "equator": (0.0, -179.99, 0.03)}


def tables(spark, seed, place, n_e=120, n_f=200):
    r = random.Random(seed)
    e = [(k, r.choice(["d1", "d1", "d2", None]), *p) for k, p in enumerate(points(r, n_e, *PLACES[place]))]
    e += [(900, "d1", None, 1.0), (901, "d1", *e[0][2:]), (902, "d1", *e[0][2:])]
    f = [(r.choice(["Bus", "Park", "Other"]), f"n{r.randrange(40)}", r.choice(["d1", "d2", None]), *p) for p in points(r, n_f, *PLACES[place])]
    f += [("Bus", None, "d1", *e[0][2:]), ("Bus", "null", "d1", None, 0.0), *f[:5]]
    return e, f, spark.createDataFrame(e, "id int, d string, lat double, lon double"), spark.createDataFrame(
        f, "kind string, name string, fd string, flat double, flon double")


def counted(entities, facilities, radius, **options):
    out = count_within_radius(entities, facilities, district="d", lat="lat", lon="lon", fac_kind="kind", fac_name="name", fac_district="fd",
                              fac_lat="flat", fac_lon="flon", kinds=KINDS, radius_m=radius, **options)
    return {r["id"]: (r["n_bus"], r["n_park"]) for r in out.collect()}


@pytest.mark.parametrize("place,radius,parts", [("city", 1000.0, 4), ("city", 5000.0, 6), ("date line", 1500.0, 3), ("north", 2000.0, 4),
                                                ("pole", 1000.0, 4), ("equator", 1.0, 2), ("city", 0.0, 3), ("city", 1000.0, 1)])
def test_two_levels_equal_brute_force(spark, place, radius, parts):
    e, f, entities, facilities = tables(spark, list(PLACES).index(place), place)
    expected = {}
    for i, d, lat, lon in e:
        near = [(k, n) for k, n, fd, flat, flon in f if n is not None and d is not None and fd == d and None not in (lat, lon, flat, flon)
                and distance((lat, lon), (flat, flon)) <= radius]
        expected[i] = tuple(len({n for k, n in near if k == kind}) for kind in KINDS)
    assert counted(entities, facilities, radius, parts=parts) == expected == counted(entities, facilities, radius)


def test_box_bounds_hold(spark):
    r, rows = random.Random(4), []
    for _ in range(300):
        lat, lon, spread = r.choice(list(PLACES.values()))
        a, b = points(r, 6, lat, lon, spread * r.random()), points(r, 6, lat + r.uniform(-spread, spread), lon, spread * r.random())
        box = lambda ps: (min(p[0] for p in ps), max(p[0] for p in ps), min(p[1] for p in ps), max(p[1] for p in ps))
        d = [distance(p, q) for p in a for q in b]
        rows.append((*box(a), *box(b), min(d), max(d)))
    names = [f"{x}_{c}" for x in "ef" for c in ("lat0", "lat1", "lon0", "lon1")]
    low, high = box_distances_sql("e", "f", EARTH_RADIUS_M)
    out = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in [*names, "least", "most"])).selectExpr("least", "most", f"{low} AS low", f"{high} AS high")
    assert all(x["low"] <= x["least"] + 1e-6 and x["most"] <= x["high"] + 1e-6 for x in out.collect())


def test_fewer_distances_and_no_hot_cell(spark):
    # a dense district: everything within a few cells
    r = random.Random(1)
    e = spark.createDataFrame([("d", *p) for p in points(r, 3000, 37.5, 127.0, 0.02)], "__d string, __lat double, __lon double")
    f = spark.createDataFrame([("Bus", f"n{k}", "d", *p) for k, p in enumerate(points(r, 1500, 37.5, 127.0, 0.02))],
                              "__kind string, __name string, __fd string, __flat double, __flon double")
    candidates = radius_pairs(e, f, left_key="__d", left_lat="__lat", left_lon="__lon", right_key="__fd", right_lat="__flat", right_lon="__flon",
                              radius_m=2e7).count()
    plain = 3000 * 1500
    assert candidates == plain
    cells = CellPairs(e, f, 1000.0, EARTH_RADIUS_M, 8)
    compared = cells.compared()
    pairs = radius_pairs(e, f, left_key="__d", left_lat="__lat", left_lon="__lon", right_key="__fd", right_lat="__flat", right_lon="__flon",
                         radius_m=1000.0).count()
    n = compared.count()
    assert n < 0.6 * pairs  # fewer distances than there are pairs within the radius, let alone candidates
    largest = compared.groupBy(*cells.cell).count().agg(F.max("count")).first()[0]
    assert largest < 0.02 * n
    counts = cells.counts({"Bus": "n"}).agg(F.sum("n")).first()[0]
    assert counts == pairs  # names are all different here


def test_within_radius_is_an_existence_join(spark):
    e, f, entities, facilities = tables(spark, 3, "city")
    out = within_radius(entities, facilities, left_key="d", left_lat="lat", left_lon="lon", right_key="fd", right_lat="flat", right_lon="flon",
                        radius_m=500.0, name="near")
    expected = {i: any(fd == d and None not in (lat, lon, flat, flon, d) and distance((lat, lon), (flat, flon)) <= 500 for _, _, fd, flat, flon in f)
                for i, d, lat, lon in e}
    assert {r["id"]: r["near"] for r in out.collect()} == expected and 0 < sum(expected.values()) < len(expected)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ExistenceJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("place,radius", [("city", 1500.0), ("date line", 1500.0), ("pole", 1000.0), ("city", 0.0)])
def test_pairs_dealt_by_cell_and_salt_equal_brute_force(spark, place, radius):
    e, f, entities, facilities = tables(spark, 7, place)
    options = dict(left_key="d", left_lat="lat", left_lon="lon", right_key="fd", right_lat="flat", right_lon="flon", radius_m=radius)
    expected = [(i, name) for i, d, lat, lon in e for _, name, fd, flat, flon in f
                if d is not None and d == fd and None not in (lat, lon, flat, flon) and distance((lat, lon), (flat, flon)) <= radius]
    key = lambda rows: sorted(((r["id"], r["name"]) for r in rows), key=str)
    assert key(radius_pairs(entities, facilities, **options).collect()) == sorted(expected, key=str)
    spread = radius_pairs(entities, facilities, ways=3, **options)
    assert key(spread.collect()) == sorted(expected, key=str)
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan  # small sides, but each task gets a share of the pairs


def test_scalar_subquery_counts_names_without_pairs_in_the_shuffle(spark):
    from metroframe.operators.spatial import Grid, correlated_count_sql, entity_cells, facility_cells

    e, f, entities, facilities = tables(spark, 5, "city")
    entity_cells(entities, Grid(1500.0), "lat", "lon").createOrReplaceTempView("t_cells_e")
    cells = facility_cells(facilities.where("fd is not null and flat is not null"), Grid(1500.0), "flat", "flon")
    cells.selectExpr("kind", "name", "fd AS district", "flat AS lat", "flon AS lon", "cy", "cx").createOrReplaceTempView("t_cells_f")
    sql = correlated_count_sql("t_cells_e", "t_cells_f", keys=["d"], district="d", lat="lat", lon="lon", cy="cy", cx="cx", outputs=KINDS,
                               radius_m=1500.0, select_cols=["id"])
    expected = counted(entities, facilities, 1500.0)
    out = spark.sql(sql)
    assert {r["id"]: (r["n_bus"], r["n_park"]) for r in out.collect()} == expected and any(map(any, expected.values()))
    assert "places = 1" in sql and "GROUP BY" in sql
