"""GEO-3, JN-4, JN-6, AGG-1: radius joins and distinct counts within a radius.

No spatial index exists in Catalyst, so the radius join is an equi-join on
(district, grid cell) with the great-circle distance as the residual:

* a cell is ``lat_step`` degrees high (no pair within the radius is further
  apart in latitude) and, in each row, at least as wide as the longitude
  reach of the radius at that row's latitude (so cells are narrow near the
  equator and wide near the poles); column indexes wrap at +-180 degrees and
  the geometry needs no statistics of the data;
* the right side is copied to its 3 x 3 neighbouring cells, the left side
  keeps its own cell, so every pair within the radius meets exactly once;
* the candidate count is within a small constant of the true pair count,
  instead of all pairs of a district.

A district holding a third of the rows is split across tasks by the cell
key; AQE's skew-join handling splits a hot cell's partition at run time, and
``split_hot_cells`` salts cells known to be hot up front (see ``hot_cells``).
The counts are two hash aggregates with map-side partial aggregation, so a
hot position is combined before its shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroframe.functions.geo import EARTH_RADIUS_M, haversine_m, haversine_sql, lat_step_deg


class Grid:
    """Cell geometry for a radius; needs no statistics of the data.

    Rows are ``lat_step`` degrees high. Each row ``y`` has its own number of
    columns ``n_x(y)``: the columns are at least as wide as the longest
    longitude reach of a radius around any point of that row (largest at the
    row's edge furthest from the equator), so a pair within the radius lies
    in the same row or an adjacent one, and in the same column or an
    adjacent one of the entity's row. Rows whose reach is too wide (near the
    poles) have one column.
    """

    # smallest cell side in degrees (a radius of 0 still gets cells)
    MIN_STEP_DEG = 1e-9

    def __init__(self, radius_m: float, earth_radius_m: float = EARTH_RADIUS_M):
        if radius_m < 0:
            raise ValueError(f"radius must not be negative, got {radius_m}")
        self.radius_m = radius_m
        self.earth_radius_m = earth_radius_m
        # a relative margin keeps pairs at exactly the radius inside the 3 x 3 block
        self.lat_step = max(lat_step_deg(radius_m, earth_radius_m), self.MIN_STEP_DEG) * (1 + 1e-9)
        self._sin_ang = math.sin(radius_m / earth_radius_m)
        self._reach_deg = math.degrees(radius_m / earth_radius_m)

    # The cell formulas are SQL text: each is parsed once in the JVM instead of
    # being assembled from many Python-side Column calls.
    def cell_y_sql(self, lat: str) -> str:
        return f"CAST(floor(({lat} + 90.0D) / {self.lat_step!r}D) AS BIGINT)"

    def n_x_sql(self, cy: str) -> str:
        """Columns of row ``cy`` (1 near the poles, else at least 3)."""
        lo = f"(CAST({cy} AS DOUBLE) * {self.lat_step!r}D - 90.0D)"
        edge = f"least(89.999999D, greatest(abs({lo}), abs({lo} + {self.lat_step!r}D)) + {self._reach_deg + 1e-9!r}D)"
        ratio = f"({self._sin_ang!r}D / cos(radians({edge})))"
        width = f"greatest(degrees(asin(least({ratio}, 1.0D))) * {1 + 1e-9!r}D, {self.MIN_STEP_DEG!r}D)"
        n = f"CAST(floor(360.0D / {width}) AS BIGINT)"
        return f"(CASE WHEN {ratio} >= 1.0D OR {n} < 3 THEN CAST(1 AS BIGINT) ELSE {n} END)"

    def cell_x_sql(self, lon: str, n: str) -> str:
        """Column of ``lon`` in a row with ``n`` columns."""
        return f"pmod(CAST(floor(({lon} + 180.0D) * CAST({n} AS DOUBLE) / 360.0D) AS BIGINT), {n})"

    def with_cell(self, df: DataFrame, lat: str, lon: str, cy: str = "cy", cx: str = "cx") -> DataFrame:
        """Add the point's own cell."""
        out = df.selectExpr("*", f"{self.cell_y_sql(f'`{lat}`')} AS `{cy}`")
        n = self.n_x_sql(f"`{cy}`")
        return out.selectExpr("*", f"{self.cell_x_sql(f'`{lon}`', n)} AS `{cx}`")

    def with_neighbour_cells(self, df: DataFrame, lat: str, lon: str, cy: str = "cy", cx: str = "cx") -> DataFrame:
        """One row per cell the point must be copied to: rows cy-1..cy+1 and,
        in each, its column and the two beside it (one column near the poles)."""
        cols = [f"`{c}`" for c in df.columns]
        out = df.selectExpr("*", "explode(array(-1, 0, 1)) AS __dy")
        out = out.selectExpr(*cols, f"{self.cell_y_sql(f'`{lat}`')} + __dy AS `{cy}`")
        out = out.selectExpr("*", f"{self.n_x_sql(f'`{cy}`')} AS __n")
        out = out.selectExpr("*", f"{self.cell_x_sql(f'`{lon}`', '__n')} AS __x", "explode(array(-1, 0, 1)) AS __dx")
        return out.where("__n > 1 OR __dx = 0").selectExpr(*cols, f"`{cy}`", f"pmod(__x + __dx, __n) AS `{cx}`")


def hot_cells(cells: DataFrame, keys: Sequence[str], *, max_share: float = 0.01, min_rows: int = 200_000,
              max_salt: int = 512) -> DataFrame | None:
    """Cells holding more than ``max_share`` of all rows (and ``min_rows``),
    with the number of ways each should be split.

    One aggregation over ``cells`` (partial counts map-side); no cell list
    comes back to the driver. At most ``1 / max_share`` cells can pass the
    threshold, so the result is bounded by construction and may be broadcast.
    Returns None when no cell is hot.
    """
    counts = cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    stats = counts.agg(F.sum("__n").alias("total"), F.max("__n").alias("top")).first()
    if not stats["total"]:
        return None
    threshold = max(float(min_rows), stats["total"] * max_share)
    if stats["top"] <= threshold:
        return None
    salts = F.least(F.lit(max_salt), F.ceil(F.col("__n") / F.lit(threshold))).cast("int")
    return F.broadcast(counts.where(F.col("__n") > threshold).select(*keys, salts.alias("__salts")))


def unit_vector_sql(lat: str, lon: str, name: str) -> list[str]:
    """Three columns, <name>x, <name>y and <name>z: the point on a sphere of radius 1."""
    return [f"cos(radians({lat})) * cos(radians({lon})) AS {name}x", f"cos(radians({lat})) * sin(radians({lon})) AS {name}y",
            f"sin(radians({lat})) AS {name}z"]


def near_sql(a: str, b: str, exact: str, radius_m: float, earth_radius_m: float = EARTH_RADIUS_M) -> str:
    """``exact`` <= radius, told by the chord between the unit vectors ``a`` and ``b`` where it is clear of the radius.

    Three products instead of eight functions for a pair; the exact distance decides within 1e-9 (6 mm) of the radius, far more
    than the rounding of either.
    """
    chord, margin = 2 * math.sin(min(radius_m / (2 * earth_radius_m), math.pi / 2)), 1e-9
    square = " + ".join(f"({a}{c} - {b}{c}) * ({a}{c} - {b}{c})" for c in "xyz")
    sure = (chord - margin) ** 2 if chord > margin else -1.0
    return f"({square} <= {(chord + margin) ** 2!r}D AND ({square} < {sure!r}D OR {exact} <= {radius_m!r}D))"


def radius_pairs(left: DataFrame, right: DataFrame, *, left_key: str, left_lat: str, left_lon: str,
                 right_key: str, right_lat: str, right_lon: str, radius_m: float,
                 earth_radius_m: float = EARTH_RADIUS_M, distance_col: str | None = None,
                 split_hot_cells: bool = False,
                 hot_share: float = 0.01, hot_min_rows: int = 200_000, ways: int | None = None) -> DataFrame:
    """JN-4 / GEO-3: all (left, right) pairs with equal keys within ``radius_m``
    (inclusive). Rows with a null key or coordinate never match.

    Output: all left columns and all right columns (names must not clash),
    plus ``distance_col`` when given.

    A hot cell is split at run time by AQE's skew-join handling (from shuffle
    statistics, no extra pass). With ``split_hot_cells`` it is also salted
    up front: one aggregation finds the cells holding more than ``hot_share``
    of the left rows, their left rows are spread over several salt values and
    their right rows copied to each; other cells keep salt 0.

    The planner sees bytes, not pairs, and would do small sides with very many pairs in one task. With ``ways`` every cell is
    salted that many ways and both sides are dealt by cell and salt over the session's number of shuffle partitions.
    """
    grid = Grid(radius_m, earth_radius_m)
    l = grid.with_cell(
        left.where(F.col(left_key).isNotNull() & F.col(left_lat).isNotNull() & F.col(left_lon).isNotNull())
        .withColumn("__k", F.col(left_key)), left_lat, left_lon, "__cy", "__cx")
    r = grid.with_neighbour_cells(
        right.where(F.col(right_key).isNotNull() & F.col(right_lat).isNotNull() & F.col(right_lon).isNotNull())
        .withColumn("__k", F.col(right_key)), right_lat, right_lon, "__cy", "__cx")
    cell = ["__k", "__cy", "__cx"]
    hot = hot_cells(l.select(*cell), cell, max_share=hot_share, min_rows=hot_min_rows) if split_hot_cells else None
    if ways is not None:
        l = l.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(ways)).cast("int"))
        r = r.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(ways - 1))))
    elif hot is None:
        l = l.withColumn("__salt", F.lit(0))
        r = r.withColumn("__salt", F.lit(0))
    else:
        row_hash = F.xxhash64(*[F.col(c) for c in left.columns])
        l = (l.join(hot, cell, "left")
             .withColumn("__salt", F.when(F.col("__salts").isNull(), F.lit(0))
                         .otherwise(F.pmod(row_hash, F.col("__salts")).cast("int")))
             .drop("__salts"))
        r = (r.join(hot, cell, "left")
             .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1)))
             .drop("__salts"))
    dist = haversine_m(left_lat, left_lon, right_lat, right_lon, earth_radius_m)
    l = l.select(*[F.col(c) for c in left.columns], *cell, "__salt", *map(F.expr, unit_vector_sql(f"`{left_lat}`", f"`{left_lon}`", "__l")))
    r = r.select(*[F.col(c) for c in right.columns], *[F.col(c).alias("__r" + c) for c in cell],
                 F.col("__salt").alias("__rsalt"), *map(F.expr, unit_vector_sql(f"`{right_lat}`", f"`{right_lon}`", "__r")))
    if ways is not None:
        tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        l = l.repartition(tasks, *cell, "__salt")
        r = r.repartition(tasks, *["__r" + c for c in cell], "__rsalt").hint("shuffle_hash")
    cond = ((F.col("__k") == F.col("__r__k")) & (F.col("__cy") == F.col("__r__cy")) & (F.col("__cx") == F.col("__r__cx"))
            & (F.col("__salt") == F.col("__rsalt")))
    exact = haversine_sql(*[f"`{c}`" for c in (left_lat, left_lon, right_lat, right_lon)], radius_m=earth_radius_m)
    joined = l.join(r, cond, "inner").where(near_sql("__l", "__r", exact, radius_m, earth_radius_m))
    sel = [F.col(c) for c in left.columns] + [F.col(c) for c in right.columns]
    if distance_col:
        sel.append(dist.alias(distance_col))
    return joined.select(*sel)


def within_radius(left: DataFrame, right: DataFrame, *, left_key: str, left_lat: str, left_lon: str, right_key: str, right_lat: str,
                  right_lon: str, radius_m: float, name: str, earth_radius_m: float = EARTH_RADIUS_M) -> DataFrame:
    """GEO-3: ``left`` with a boolean column: whether any right row of its key lies within ``radius_m`` (inclusive).

    EXISTS, planned as an existence join on (key, cell) with the distance as residual: a left row stops at its first match, no
    pairs come out, and rows without a key or coordinate get false.
    """
    grid = Grid(radius_m, earth_radius_m)
    keys = ["__fk", "__fy", "__fx"]
    placed = right.select(F.col(right_key).alias("__fk"), F.col(right_lat).alias("__flat"), F.col(right_lon).alias("__flon")).na.drop()
    r = grid.with_neighbour_cells(placed, "__flat", "__flon", "__fy", "__fx").select(*keys, "__flat", "__flon")
    l = grid.with_cell(left, left_lat, left_lon, "__cy", "__cx")
    outer = lambda c: F.col(c).outer()
    near = haversine_m(outer(left_lat), outer(left_lon), F.col("__flat"), F.col("__flon"), earth_radius_m) <= F.lit(radius_m)
    same = (F.col("__fk") == outer(left_key)) & (F.col("__fy") == outer("__cy")) & (F.col("__fx") == outer("__cx"))
    return l.select(*[F.col(c) for c in left.columns], r.where(same & near).exists().alias(name))


def count_within_radius(entities: DataFrame, facilities: DataFrame, *, district: str, lat: str, lon: str,
                        fac_kind: str, fac_name: str, fac_district: str, fac_lat: str, fac_lon: str,
                        kinds: Mapping[str, str], radius_m: float,
                        earth_radius_m: float = EARTH_RADIUS_M, split_hot_cells: bool = False,
                        positions: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """AGG-1 over JN-4: for every entity row, the number of distinct facility
    names of each kind in the same district within ``radius_m``.

    ``kinds`` maps a facility kind value to the output column name. Entities
    have no key and may repeat: the join runs on distinct (district, lat, lon)
    positions and the counts are joined back, so repeated rows all survive and
    rows without coordinates get 0, never null.

    ``positions`` are the columns ``district``, ``lat`` and ``lon`` of all entities (or of more), from a cheaper source than
    an entity table that is not written yet and would be evaluated again for them. With ``parts`` cells are cut
    into parts x parts sub-cells and distances computed at the border of the radius only (:class:`CellPairs`): for
    data with many entities and facilities within a radius of each other. The result is the same.
    """
    places = entities if positions is None else positions
    positions = (places.select(F.col(district).alias("__d"), F.col(lat).alias("__lat"), F.col(lon).alias("__lon"))
                 .where(F.col("__d").isNotNull() & F.col("__lat").isNotNull() & F.col("__lon").isNotNull())
                 .distinct())
    facs = (facilities.where(F.col(fac_kind).isin(list(kinds)) & F.col(fac_name).isNotNull())
            .select(F.col(fac_kind).alias("__kind"), F.col(fac_name).alias("__name"),
                    F.col(fac_district).alias("__fd"), F.col(fac_lat).alias("__flat"), F.col(fac_lon).alias("__flon"))
            .distinct())
    if parts is not None:
        facs = facs.where(F.col("__fd").isNotNull() & F.col("__flat").isNotNull() & F.col("__flon").isNotNull())
        return _with_counts(entities, CellPairs(positions, facs, radius_m, earth_radius_m, parts).counts(kinds), district, lat, lon, kinds)
    pairs = radius_pairs(positions, facs, left_key="__d", left_lat="__lat", left_lon="__lon",
                         right_key="__fd", right_lat="__flat", right_lon="__flon",
                         radius_m=radius_m, earth_radius_m=earth_radius_m, split_hot_cells=split_hot_cells)
    names = pairs.select("__d", "__lat", "__lon", "__kind", "__name").distinct()
    counts = names.groupBy("__d", "__lat", "__lon").agg(*[
        F.sum(F.when(F.col("__kind") == k, 1).otherwise(0)).cast("int").alias(out) for k, out in kinds.items()
    ])
    return _with_counts(entities, counts, district, lat, lon, kinds)


def _with_counts(entities: DataFrame, counts: DataFrame, district: str, lat: str, lon: str, kinds: Mapping[str, str]) -> DataFrame:
    # the input is evaluated once here. Rows without a district or a coordinate (every book row, say) match nothing; where the
    # planner shuffles, their partition is one that the skew join splits over its map outputs
    joined = entities.join(counts, (F.col(district) == counts["__d"]) & (F.col(lat) == counts["__lat"])
                           & (F.col(lon) == counts["__lon"]), "left")
    return joined.select(*[F.col(c) for c in entities.columns], *[F.coalesce(F.col(out), F.lit(0)).alias(out) for out in kinds.values()])


def _cos_low(lo: str, hi: str) -> str:
    return f"least(cos(radians({lo})), cos(radians({hi})))"


def _cos_high(lo: str, hi: str) -> str:
    return f"(CASE WHEN {lo} <= 0 AND {hi} >= 0 THEN 1.0D ELSE greatest(cos(radians({lo})), cos(radians({hi}))) END)"


def box_distances_sql(a: str, b: str, earth_radius_m: float) -> tuple[str, str]:
    """(lower, upper) bounds of the distance between any point of box ``a`` and any of box ``b``, as SQL.

    A box has the columns <name>_lat0, _lat1, _lon0, _lon1. Both parts of the haversine are bounded by themselves; the
    way round the date line counts for the lower bound.
    """
    col = lambda box, c: f"{box}_{c}"
    (a0, a1, al, ar), (b0, b1, bl, br) = ([col(x, c) for c in ("lat0", "lat1", "lon0", "lon1")] for x in (a, b))
    lat_min, lat_max = f"greatest(0.0D, {b0} - {a1}, {a0} - {b1})", f"greatest({b1} - {a0}, {a1} - {b0})"
    beside, round_ = f"greatest(0.0D, {bl} - {ar}, {al} - {br})", f"greatest(0.0D, 360.0D - (greatest({ar}, {br}) - least({al}, {bl})))"
    lon_min, lon_max = f"least({beside}, {round_})", f"least(180.0D, greatest({br} - {al}, {ar} - {bl}))"
    half = lambda x: f"pow(sin(radians({x}) / 2), 2)"
    low = f"{half(lat_min)} + {_cos_low(a0, a1)} * {_cos_low(b0, b1)} * {half(lon_min)}"
    high = f"{half(lat_max)} + {_cos_high(a0, a1)} * {_cos_high(b0, b1)} * {half(lon_max)}"
    return tuple(f"({2 * earth_radius_m!r}D * asin(sqrt(least(1.0D, {x}))))" for x in (low, high))


def _boxes(points: DataFrame, keys: Sequence[str], lat: str, lon: str, name: str) -> DataFrame:
    return points.groupBy(*keys).agg(F.min(lat).alias(f"{name}_lat0"), F.max(lat).alias(f"{name}_lat1"),
                                     F.min(lon).alias(f"{name}_lon0"), F.max(lon).alias(f"{name}_lon1"))


class CellPairs:
    """AGG-1's candidates on two levels, for dense data.

    Each grid cell is cut into ``parts`` x ``parts`` sub-cells. A pair of sub-cells, one of positions and one of facilities, is
    told apart by the boxes around their points: ``inner`` when even the furthest points are within the radius, so
    that all its facility names count for all its positions; dropped when the nearest are not; ``border`` otherwise. Names
    that a sub-cell already has from inner ones need no comparison, so distances are computed for border names only. The boxes
    are of the points themselves, hence the bounds hold whatever the rounding of cells.
    """

    MARGIN = 1e-9  # relative; a pair this near to the radius is compared

    def __init__(self, positions: DataFrame, facilities: DataFrame, radius_m: float, earth_radius_m: float, parts: int):
        self.radius_m, self.earth_radius_m, self.parts = radius_m, earth_radius_m, parts
        grid = Grid(radius_m, earth_radius_m)
        own = grid.with_cell(positions, "__lat", "__lon", "__cy", "__cx")
        self.positions = self._part(own, grid, "__lat", "__lon").withColumnRenamed("__part", "__e")
        placed = self._part(grid.with_cell(facilities, "__flat", "__flon", "__oy", "__ox"), grid, "__flat", "__flon", "__oy", "__ox")
        # a sub-cell of facilities is known by its own cell and part; it is near to the cells its points are near to
        self.facilities = placed.withColumn("__f", F.xxhash64("__fd", "__oy", "__ox", "__part")).drop("__oy", "__ox", "__part")
        near = grid.with_neighbour_cells(self.facilities.select("__fd", "__f", "__flat", "__flon"), "__flat", "__flon", "__cy", "__cx") \
            .select(F.col("__fd").alias("__d"), "__f", "__cy", "__cx").distinct()
        cell = ["__d", "__cy", "__cx"]
        self.cell = [*cell, "__e"]
        places = _boxes(self.positions, self.cell, "__lat", "__lon", "e")
        low, high = box_distances_sql("e", "f", earth_radius_m)
        kind = f"CASE WHEN {high} <= {radius_m * (1 - self.MARGIN)!r}D THEN 'inner' WHEN {low} <= {radius_m * (1 + self.MARGIN) + 1e-6!r}D THEN 'border' END"
        pairs = places.join(near, cell).join(_boxes(self.facilities, ["__f"], "__flat", "__flon", "f"), "__f") \
            .selectExpr(*self.cell, "__f", f"{kind} AS pair").where("pair IS NOT NULL")
        names = self.facilities.select("__f", "__kind", "__name").distinct()
        self.inner = pairs.where("pair = 'inner'").join(names, "__f").select(*self.cell, "__kind", "__name").distinct()
        border = pairs.where("pair = 'border'").join(self.facilities.drop("__fd"), "__f").drop("__f", "pair")
        self.border = border.join(self.inner, [*self.cell, "__kind", "__name"], "left_anti")

    def _part(self, df: DataFrame, grid: Grid, lat: str, lon: str, cy: str = "__cy", cx: str = "__cx") -> DataFrame:
        """Which of the cell's parts a point is in; a point that rounding puts beside its cell is in the nearest."""
        n = grid.n_x_sql(f"`{cy}`")
        row = f"(({lat} + 90.0D) / {grid.lat_step!r}D - {cy}) * {self.parts}"
        col = f"(({lon} + 180.0D) * {n} / 360.0D - {cx}) * {self.parts}"
        clamp = lambda x: f"greatest(0, least({self.parts - 1}, CAST(floor({x}) AS INT)))"
        return df.selectExpr("*", f"{clamp(row)} * {self.parts} + {clamp(col)} AS __part")

    def compared(self) -> DataFrame:
        """Position and border facility of every distance that is computed."""
        return self.positions.join(self.border, self.cell)

    def counts(self, kinds: Mapping[str, str]) -> DataFrame:
        """__d, __lat, __lon and a count of distinct names per kind, for positions that have any."""
        def per_kind(names: DataFrame, keys: Sequence[str]) -> DataFrame:
            return names.groupBy(*keys).agg(*[F.sum(F.when(F.col("__kind") == k, 1).otherwise(0)).alias(out) for k, out in kinds.items()])

        near = self.compared().where(haversine_m("__lat", "__lon", "__flat", "__flon", self.earth_radius_m) <= F.lit(self.radius_m))
        place = ["__d", "__lat", "__lon"]
        at_border = per_kind(near.select(*place, "__kind", "__name").distinct(), place)
        inside = self.positions.join(per_kind(self.inner, self.cell), self.cell).select(*place, *kinds.values())
        both = inside.unionByName(at_border)
        return both.groupBy(*place).agg(*[F.sum(out).cast("int").alias(out) for out in kinds.values()])


def correlated_count_sql(entity_view: str, facility_cells_view: str, *, keys: Sequence[str], district: str,
                         lat: str, lon: str, cy: str, cx: str, outputs: Mapping[str, str], radius_m: float,
                         select_cols: Sequence[str], earth_radius_m: float = EARTH_RADIUS_M,
                         fac_kind: str = "kind", fac_name: str = "name", fac_district: str = "district",
                         fac_lat: str = "lat", fac_lon: str = "lon", fac_cy: str = "cy", fac_cx: str = "cx") -> str:
    """JN-6: the reference's correlated scalar subqueries, as Spark SQL.

    A subquery whose correlation includes a non-equality (the distance on
    the outer row's coordinates) is decorrelated by Spark into a domain join
    planned as a nested loop over all outer values and all facilities. So
    the pairs come from an equi-join on (district, cell) in a CTE,
    with the distance as its residual, and each scalar subquery correlates
    by equality on the entity ``keys`` and the position only: it becomes an aggregate and a
    left outer equi-join, and an entity with no match counts 0.

    Pairs are counted where they arise: an entity's position has one cell, which holds all facilities near it, so a name with one
    place in that cell counts 1 for a pair, and only names with more places there are told apart after the join.
    """
    same = list(dict.fromkeys([*keys, district, lat, lon]))
    place = ", ".join(f"u.{k}" for k in same)
    dist = haversine_sql(f"u.{lat}", f"u.{lon}", "f.flat", "f.flon", earth_radius_m)
    near = near_sql("u.uv_", "f.fv_", dist, radius_m, earth_radius_m)
    positions = (f"SELECT *, {', '.join(unit_vector_sql(lat, lon, 'uv_'))} FROM (SELECT DISTINCT {', '.join(dict.fromkeys([*same, cy, cx]))} "
                 f"FROM {entity_view} WHERE {district} IS NOT NULL AND {lat} IS NOT NULL AND {lon} IS NOT NULL)")
    places = (f"SELECT DISTINCT {fac_kind} AS kind, {fac_name} AS name, {fac_district} AS fd, {fac_lat} AS flat, {fac_lon} AS flon, "
              f"{fac_cy} AS fy, {fac_cx} AS fx FROM {facility_cells_view} WHERE {fac_name} IS NOT NULL")
    named = f"SELECT *, {', '.join(unit_vector_sql('flat', 'flon', 'fv_'))}, COUNT(*) OVER (PARTITION BY fd, fy, fx, kind, name) AS places FROM places"

    def counted(what: str, which: str) -> str:
        return (f"SELECT /*+ SHUFFLE_HASH(f) */ {place}, f.kind, {what} AS n FROM positions u JOIN named f ON f.fd = u.{district} "
                f"AND f.fy = u.{cy} AND f.fx = u.{cx} WHERE {which} AND {near} GROUP BY {place}, f.kind")

    match = " AND ".join(f"c.{k} = u.{k}" for k in same)
    subqueries = [f"COALESCE((SELECT SUM(c.n) FROM candidates c WHERE c.kind = '{kind}' AND {match}), 0) AS {out}" for kind, out in outputs.items()]
    cols = ", ".join(f"u.{c}" for c in select_cols)
    return (f"WITH positions AS ({positions}), places AS ({places}), named AS ({named}), "
            f"candidates AS ({counted('COUNT(*)', 'f.places = 1')} UNION ALL {counted('COUNT(DISTINCT f.name)', 'f.places > 1')}) "
            f"SELECT {cols}, {', '.join(subqueries)} FROM {entity_view} u")


def facility_cells(facilities: DataFrame, grid: Grid, lat: str, lon: str) -> DataFrame:
    """Facilities copied to their 3 x 3 neighbour cells (columns ``cy``, ``cx``)."""
    return grid.with_neighbour_cells(facilities, lat, lon)


def entity_cells(entities: DataFrame, grid: Grid, lat: str, lon: str) -> DataFrame:
    """Entities with their own cell (columns ``cy``, ``cx``)."""
    return grid.with_cell(entities, lat, lon)
