"""Queries on occupancy voxels, ground heights and occupancy grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark.functions.grid import cell_trunc
from waymark.operators import occupancy as occ, points as pts
from waymark.plans import fixtures as fx
from waymark.plans.cloud_queries import SLOPE, with_ground
from waymark.plans.fixtures import r, r6, sql_with
from waymark.plans.registry import query
from waymark.plans.timeline_queries import frame_poses
from waymark.session import cut

RES, REACH = 0.8, 8.0
GRID = 1.0

_AX = "xyz"
_axis = " UNION ALL ".join(
    f"SELECT rid, unnest(CASE WHEN s{a} = e{a} THEN []::BIGINT[] ELSE generate_series(least(s{a}, e{a}) + 1, greatest(s{a}, e{a})) END) * {RES}::DOUBLE AS pl, o{a} AS o, d{a} AS d FROM rays"
    for a in _AX)
fx.add_view("rays", f"""
  SELECT *, {', '.join(f"CAST(floor(o{a} / {RES}) AS BIGINT) AS s{a}, CAST(floor((CASE WHEN hit = 1 THEN {a} ELSE o{a} + d{a} END) / {RES}) AS BIGINT) AS e{a}" for a in _AX)}
  FROM (SELECT bag_id, ts_ns, point_idx AS rid, x, y, z, px AS ox, py AS oy, pz AS oz, hit,
      {', '.join(f"({a} - p{a}) * (CASE WHEN hit = 1 THEN 1.0::DOUBLE ELSE {REACH} / len END) AS d{a}" for a in _AX)}
    FROM (SELECT *, CASE WHEN len <= {REACH} THEN 1 ELSE 0 END AS hit FROM (
      SELECT *, sqrt((x - px) * (x - px) + (y - py) * (y - py) + (z - pz) * (z - pz)) AS len FROM world)))""", ["world"])
fx.add_view("scan_vox", f"""
  SELECT bag_id, ts_ns, kx, ky, kz, max(hit) AS hit FROM (
    SELECT r.bag_id, r.ts_ns, {', '.join(f"CAST(floor((r.o{a} + r.d{a} * m) / {RES}) AS BIGINT) AS k{a}" for a in _AX)}, ex, ey, ez, 0 AS hit
    FROM rays r JOIN (SELECT rid, (t + lead(t) OVER (PARTITION BY rid ORDER BY t)) / 2 AS m FROM (
      SELECT rid, (pl - o) / d AS t FROM ({_axis}) UNION ALL SELECT rid, 0.0 FROM rays UNION ALL SELECT rid, 1.0 FROM rays)) c
    ON c.rid = r.rid AND m IS NOT NULL
    WHERE NOT (kx = ex AND ky = ey AND kz = ez)
    UNION ALL SELECT bag_id, ts_ns, ex, ey, ez, ex, ey, ez, 1 FROM rays WHERE hit = 1) GROUP BY 1, 2, 3, 4, 5""", ["rays"])
fx.add_view("vox_odds", """
  SELECT bag_id, kx, ky, kz, list_reduce(list_prepend(0.0::DOUBLE, list(CASE WHEN hit = 1 THEN ln(0.7::DOUBLE / 0.3::DOUBLE) ELSE ln(0.4::DOUBLE / 0.6::DOUBLE) END ORDER BY ts_ns)),
    lambda acc, d: greatest(ln(0.1192::DOUBLE / 0.8808::DOUBLE), least(ln(0.971::DOUBLE / 0.029::DOUBLE), acc + d))) AS log_odds
  FROM scan_vox GROUP BY 1, 2, 3, 4""", ["scan_vox"])


def rays(spark, sf):
    poses = frame_poses(spark, sf, False).filter("px is not null")
    w = pts.transform_points(fx.points(spark, sf), poses, rays=True)
    return w.select("bag_id", "ts_ns", "x", "y", "z", *[(F.col(a) + F.col(f"v{a}")).alias(f"o{a}") for a in "xyz"])


@query("ray_voxels", "A16", sql_with(["scan_vox"], """
SELECT bag_id, kx, ky, kz, count(*) AS scans, CAST(sum(hit) AS BIGINT) AS hits FROM scan_vox GROUP BY 1, 2, 3, 4"""))
def _(spark, sf):
    s = occ.scan_voxels(rays(spark, sf), RES, REACH)
    return s.groupBy("bag_id", *occ.KEY).agg(F.count(F.lit(1)).alias("scans"), F.sum("hit").alias("hits"))


@query("voxel_occupancy", "A16", sql_with(["vox_odds"], f"SELECT bag_id, kx, ky, kz, {r6('log_odds')} AS log_odds FROM vox_odds"))
def _(spark, sf):
    return occ.voxel_log_odds(occ.scan_voxels(rays(spark, sf), RES, REACH), fx.BUCKET_NS).select(
        "bag_id", *occ.KEY, r("log_odds").alias("log_odds"))


# Ground: points whose surface is nearly level.
fx.add_view("ext", f"""
  SELECT bag_id, min(x) AS min_x, min(y) AS min_y, greatest(1, CAST(ceil((max(x) - min(x)) / {GRID}) AS INTEGER)) AS x_size,
    greatest(1, CAST(ceil((max(y) - min(y)) / {GRID}) AS INTEGER)) AS y_size FROM world GROUP BY 1""", ["world"])
fx.add_view("gmap", f"""
  SELECT bag_id, gx, gy, avg(z) AS z FROM (
    SELECT w.bag_id, w.z, CAST(trunc((x - min_x) / {GRID}) AS BIGINT) AS gx, CAST(trunc((y - min_y) / {GRID}) AS BIGINT) AS gy, x_size, y_size
    FROM ground w JOIN ext USING (bag_id)) WHERE gx < x_size AND gy < y_size GROUP BY 1, 2, 3""", ["ground", "ext"])
fx.add_view("raster", """
  SELECT bag_id, gx, gy, x_size, gy * x_size + gx AS idx FROM (
    SELECT bag_id, x_size, y_size, unnest(generate_series(0, x_size - 1)) AS gx FROM ext),
    LATERAL (SELECT unnest(generate_series(0, y_size - 1)) AS gy)""", ["ext"])
fx.add_view("gfill", """
  SELECT r.bag_id, r.gx, r.gy, coalesce(g.z, n.z) AS z FROM raster r LEFT JOIN gmap g USING (bag_id, gx, gy)
  LEFT JOIN (SELECT a.bag_id, a.gx, a.gy, arg_min(k.z, ((a.gx - k.gx) * (a.gx - k.gx) + (a.gy - k.gy) * (a.gy - k.gy)) * 1000000000 + k.gy * a.x_size + k.gx) AS z
    FROM (SELECT * FROM raster r WHERE NOT EXISTS (SELECT 1 FROM gmap g WHERE g.bag_id = r.bag_id AND g.gx = r.gx AND g.gy = r.gy)) a
    JOIN gmap k ON k.bag_id = a.bag_id GROUP BY 1, 2, 3) n USING (bag_id, gx, gy)""", ["raster", "gmap"])


def level_world(spark, sf):
    """World points, those of them on the ground, and the extent of each log's raster."""
    w = cut(with_ground(spark, sf))
    return w, w.filter("ground"), cut(pts.extent(w, GRID))


@query("ground_height", "A6", sql_with(["gmap"], f"SELECT bag_id, gx, gy, {r6('z')} AS z FROM gmap"))
def _(spark, sf):
    _w, low, ext = level_world(spark, sf)
    return occ.ground_height(low, ext, GRID).select("bag_id", "gx", "gy", r("z").alias("z"))


@query("fill_ground", "W7", sql_with(["gfill"], f"SELECT bag_id, gx, gy, {r6('z')} AS z FROM gfill"))
def _(spark, sf):
    _w, low, ext = level_world(spark, sf)
    return occ.fill_ground(occ.ground_height(low, ext, GRID), low, ext).select("bag_id", "gx", "gy", r("z").alias("z"))


fx.add_view("ogrid", f"""
  SELECT bag_id, gx, gy, CASE WHEN bool_or(coalesce(log_odds >= 0, false)) THEN 0 WHEN bool_or(log_odds IS NOT NULL) THEN 254 ELSE 127 END AS value
  FROM (SELECT g.bag_id, gx, gy, CAST(floor((min_x + (gx + 0.5::DOUBLE) * {GRID}) / {RES}) AS BIGINT) AS kx,
      CAST(floor((min_y + (gy + 0.5::DOUBLE) * {GRID}) / {RES}) AS BIGINT) AS ky,
      CAST(floor((z + 0.1::DOUBLE + i * (1.9::DOUBLE / 6)) / {RES}) AS BIGINT) AS kz
    FROM gfill g JOIN ext USING (bag_id), (SELECT unnest(generate_series(0, 6)) AS i)) LEFT JOIN vox_odds USING (bag_id, kx, ky, kz)
  GROUP BY 1, 2, 3""", ["gfill", "ext", "vox_odds"])


def grid_of(spark, sf):
    _w, low, ext = level_world(spark, sf)
    filled = occ.fill_ground(occ.ground_height(low, ext, GRID), low, ext)
    vox = occ.voxel_log_odds(occ.scan_voxels(rays(spark, sf), RES, REACH), fx.BUCKET_NS)
    return cut(occ.occupancy_grid(filled, vox, ext, GRID, RES, 0.1, 2.0)), ext


@query("occupancy_grid", "A17 J12", sql_with(["ogrid"], "SELECT bag_id, gx, gy, value FROM ogrid"))
def _(spark, sf):
    return grid_of(spark, sf)[0]


fx.add_view("occ_cells", "SELECT bag_id, gx, gy FROM world_cells WHERE n >= 5", ["world_cells"])
fx.add_view("world_cells", f"""
  SELECT bag_id, gx, gy, count(*) AS n FROM (
    SELECT bag_id, CAST(trunc((x - min_x) / {GRID}) AS BIGINT) AS gx, CAST(trunc((y - min_y) / {GRID}) AS BIGINT) AS gy, x_size, y_size
    FROM world JOIN ext USING (bag_id)) WHERE gx < x_size AND gy < y_size GROUP BY 1, 2, 3""", ["world", "ext"])
_FLOOD = """
  labels(bag_id, gx, gy, label, pass) AS (
    SELECT bag_id, gx, gy, gy * 2147483648 + gx, 0 FROM {cells}
    UNION ALL
    SELECT bag_id, gx, gy, label, pass FROM (
      SELECT a.bag_id, a.gx, a.gy, least(a.label, min(b.label)) AS label, a.label AS old, a.pass + 1 AS pass
      FROM labels a JOIN labels b ON a.bag_id = b.bag_id AND b.gx BETWEEN a.gx - 1 AND a.gx + 1 AND b.gy BETWEEN a.gy - 1 AND a.gy + 1
      GROUP BY a.bag_id, a.gx, a.gy, a.label, a.pass) WHERE pass <= {passes})"""


def world_cells(spark, sf):
    """Points per raster cell of each log, and the rasters."""
    w = cut(pts.transform_points(fx.points(spark, sf), frame_poses(spark, sf, False).filter("px is not null")))
    ext = cut(pts.extent(w, GRID))
    keyed = w.join(ext, "bag_id").withColumns({g: cell_trunc(a, GRID, F.col(f"min_{a}")) for g, a in (("gx", "x"), ("gy", "y"))})
    inside = keyed.filter((F.col("gx") < F.col("x_size")) & (F.col("gy") < F.col("y_size")))
    return inside.groupBy("bag_id", "gx", "gy").agg(F.count(F.lit(1)).alias("n")), ext


def occ_cells(spark, sf):
    return cut(world_cells(spark, sf)[0].filter("n >= 5").select("bag_id", "gx", "gy"))


def _component_sql(cells: str, body: str, views: list[str]) -> str:
    return sql_with(views, f"WITH {_FLOOD.format(cells=cells, passes=110)},\n  comp AS (SELECT bag_id, gx, gy, label FROM labels WHERE pass = 110)\n{body}", recursive=True)


@query("grid_components", "G1", _component_sql("occ_cells", """
SELECT bag_id, label, count(*) AS size FROM comp GROUP BY 1, 2""", ["occ_cells"]))
def _(spark, sf):
    from waymark.operators.graph import component_sizes

    return component_sizes(occ.cell_components(occ_cells(spark, sf)))


_CLOSED = """
  grown AS (SELECT DISTINCT bag_id, gx + i AS gx, gy + j AS gy FROM (SELECT * FROM occ_cells JOIN ext USING (bag_id)), (VALUES (-1), (0), (1)) a(i), (VALUES (-1), (0), (1)) b(j)
    WHERE gx + i BETWEEN 0 AND x_size - 1 AND gy + j BETWEEN 0 AND y_size - 1),
  closed AS (SELECT bag_id, gx, gy FROM (SELECT bag_id, gx + i AS gx, gy + j AS gy FROM grown, (VALUES (-1), (0), (1)) a(i), (VALUES (-1), (0), (1)) b(j))
    GROUP BY 1, 2, 3 HAVING count(*) = 9)"""


@query("filter_small_clusters", "G2", sql_with(["occ_cells", "world_cells", "ext"], f"""
WITH {_CLOSED},{_FLOOD.format(cells='closed', passes=110)},
  comp AS (SELECT *, count(*) OVER (PARTITION BY bag_id, label) AS size FROM labels WHERE pass = 110)
SELECT w.bag_id, w.gx, w.gy, CASE WHEN c.size < 20 THEN 127 WHEN c.size IS NOT NULL THEN 0 WHEN w.n >= 5 THEN 0 ELSE 254 END AS value
FROM world_cells w LEFT JOIN comp c USING (bag_id, gx, gy)""", recursive=True))
def _(spark, sf):
    cells, ext = world_cells(spark, sf)
    grid = cells.withColumn("value", F.when(F.col("n") >= 5, 0).otherwise(254)).drop("n")
    return occ.filter_small_clusters(grid, ext, 20, 1)


@query("map_metadata", "K6", sql_with(["ext"], f"""
SELECT bag_id, {GRID}::DOUBLE AS resolution, {r6('min_x')} AS origin_x, {r6('min_y')} AS origin_y, 0 AS negate, 0.65::DOUBLE AS occupied_thresh FROM ext"""))
def _(spark, sf):
    w = pts.transform_points(fx.points(spark, sf), frame_poses(spark, sf, False).filter("px is not null"))
    return occ.map_metadata(pts.extent(w, GRID), GRID).select("bag_id", "resolution", r("origin_x").alias("origin_x"),
                                              r("origin_y").alias("origin_y"), "negate", "occupied_thresh")


@query("pgm_rows", "K6", sql_with(["world_cells", "raster", "ext"], """
SELECT bag_id, y_size - 1 - gy AS row, string_agg(CAST(value AS VARCHAR), ' ' ORDER BY gx) AS line FROM (
  SELECT r.bag_id, r.gx, r.gy, e.y_size, CASE WHEN w.n >= 5 THEN 0 WHEN w.n IS NOT NULL THEN 254 ELSE 127 END AS value
  FROM raster r JOIN ext e USING (bag_id) LEFT JOIN world_cells w ON w.bag_id = r.bag_id AND w.gx = r.gx AND w.gy = r.gy) GROUP BY bag_id, gy, y_size"""))
def _(spark, sf):
    cells, ext = world_cells(spark, sf)
    grid = cut(cells.withColumn("value", F.when(F.col("n") >= 5, 0).otherwise(254)).drop("n"))
    return occ.pgm_rows(grid, ext)


@query("split_ground", "F13 F11 J9", sql_with(["lent"], f"""
SELECT bag_id, tilt <= radians({SLOPE}) AS ground, count(*) AS n, {r6('avg(z)')} AS z FROM lent GROUP BY 1, 2"""))
def _(spark, sf):
    return with_ground(spark, sf).groupBy("bag_id", "ground").agg(F.count(F.lit(1)).alias("n"), r(F.avg("z")).alias("z"))
