"""The whole jobs, with arguments that suit the derived logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark.operators import registration
from waymark.plans import colour_queries  # noqa: F401  (defines the colour views)
from waymark.plans import fixtures as fx, jobs
from waymark.plans.cloud_queries import voxel_view, world
from waymark.plans.fixtures import r, r6, sql_with
from waymark.plans.registry import query
from waymark.plans.timeline_queries import gate_sql, keyframes
from waymark.session import cut, scratch_path
from waymark.sources import messages

CLOUD = jobs.CloudConfig(voxel=0.5, min_frame_points=5, min_move=fx.MOVE_M, min_rotation_deg=fx.TURN_DEG,
                         max_latency_ns=fx.LATENCY_NS, clean=False, bucket_ns=fx.BUCKET_NS)

_FRAME_VOX = """
  SELECT bag_id, ts_ns, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM points GROUP BY bag_id, ts_ns, floor(x / 0.5), floor(y / 0.5), floor(z / 0.5)"""
fx.add_view("frame_vox", _FRAME_VOX, ["points"])
fx.add_view("big_vox", "SELECT * FROM frame_vox QUALIFY count(*) OVER (PARTITION BY bag_id, ts_ns) >= 5", ["frame_vox"])


@query("registered_cloud", "Q2 G13 A2 F8", sql_with(["big_vox", "registered"], f"""
SELECT bag_id, {r6('avg(x)')} AS x, {r6('avg(y)')} AS y, {r6('avg(z)')} AS z, {r6('avg(px - x)')} AS rx FROM (
  SELECT p.bag_id, (1 - 2 * f.qz * f.qz) * p.x - 2 * f.qz * f.qw * p.y + f.px AS x, 2 * f.qz * f.qw * p.x + (1 - 2 * f.qz * f.qz) * p.y + f.py AS y,
    p.z + f.pz AS z, f.px FROM big_vox p JOIN registered f USING (bag_id, ts_ns))
GROUP BY bag_id, floor(x / 0.5), floor(y / 0.5), floor(z / 0.5)"""))
def _(spark, sf):
    c = jobs.registered_cloud(fx.points(spark, sf), fx.odom(spark, sf), CLOUD)
    return c.select("bag_id", *[r(a).alias(a) for a in "xyz"], r("rx").alias("rx"))


fx.add_view("fixed", "SELECT bag_id FROM frame_ids WHERE lower(ltrim(trim(frame_id), '/')) IN ('odom', 'map', 'world')", ["frame_ids"])
fx.add_view("kept_fixed", gate_sql("frame_pose", fx.MOVE_M, fx.TURN_DEG), ["frame_pose"])


@query("registered_cloud_modes", "Q2 F1 F7 F8", sql_with(["big_vox", "registered", "kept_fixed", "frame_pose", "fixed"], f"""
SELECT bag_id, {r6('avg(x)')} AS x, {r6('avg(y)')} AS y, {r6('avg(z)')} AS z, {r6('avg(px - x)')} AS rx FROM (
  SELECT p.bag_id, (1 - 2 * f.qz * f.qz) * p.x - 2 * f.qz * f.qw * p.y + f.px AS x, 2 * f.qz * f.qw * p.x + (1 - 2 * f.qz * f.qz) * p.y + f.py AS y,
    p.z + f.pz AS z, f.px FROM big_vox p JOIN registered f USING (bag_id, ts_ns) WHERE bag_id NOT IN (SELECT bag_id FROM fixed)
  UNION ALL
  SELECT p.bag_id, p.x, p.y, p.z, f.px FROM big_vox p JOIN kept_fixed USING (bag_id, ts_ns) LEFT JOIN frame_pose f USING (bag_id, ts_ns)
  WHERE bag_id IN (SELECT bag_id FROM fixed))
GROUP BY bag_id, floor(x / 0.5), floor(y / 0.5), floor(z / 0.5)"""))
def _(spark, sf):
    """The mode of every log decided by the frame id of its first cloud."""
    modes = messages.first_frame_id(fx.messages(spark, sf), "/points")
    c = jobs.registered_cloud(fx.points(spark, sf), fx.odom(spark, sf), CLOUD, modes)
    return c.select("bag_id", *[r(a).alias(a) for a in "xyz"], r("rx").alias("rx"))


@query("frame_pairs", "J15 X5", sql_with(["registered"], f"""
SELECT bag_id, to_ts, ts_ns AS from_ts, {r6('c * dx + s * dy')} AS gx, {r6('-s * dx + c * dy')} AS gy FROM (
  SELECT *, 1 - 2 * lz * lz AS c, 2 * lz * lw AS s, px - lx AS dx, py - ly AS dy FROM (
    SELECT *, lag(ts_ns) OVER w AS to_ts, lag(px) OVER w AS lx, lag(py) OVER w AS ly, lag(qz) OVER w AS lz, lag(qw) OVER w AS lw
    FROM registered WINDOW w AS (PARTITION BY bag_id ORDER BY ts_ns))) WHERE to_ts IS NOT NULL"""))
def _(spark, sf):
    _scans, poses, _sensors = jobs.registered_frames(fx.points(spark, sf), fx.odom(spark, sf), CLOUD)
    return registration.frame_pairs(poses, fx.BUCKET_NS).select("bag_id", "to_ts", "from_ts", r("gx").alias("gx"), r("gy").alias("gy"))


@query("loop_candidates", "J14 W5", sql_with(["registered"], """
WITH pos AS (SELECT *, row_number() OVER (PARTITION BY bag_id ORDER BY ts_ns) - 1 AS pos FROM registered)
SELECT a.bag_id, a.ts_ns AS from_ts, b.ts_ns AS to_ts FROM pos a JOIN pos b ON a.bag_id = b.bag_id AND a.pos % 5 = 0 AND b.pos % 5 = 0 AND b.pos > 0
  AND b.pos < a.pos AND a.pos - b.pos <= 100 AND sqrt((a.px - b.px) * (a.px - b.px) + (a.py - b.py) * (a.py - b.py)) <= 20"""))
def _(spark, sf):
    _scans, poses, _sensors = jobs.registered_frames(fx.points(spark, sf), fx.odom(spark, sf), CLOUD)
    return registration.loop_candidates(poses, 5, 100, 20.0, fx.BUCKET_NS).select("bag_id", "from_ts", "to_ts")


@query("icp_refinement", "G11 F14 A34")
def _(spark, sf):
    scans, poses, _sensors = jobs.registered_frames(fx.points(spark, sf), fx.odom(spark, sf), CLOUD)
    refined = registration.icp_refine(scans, registration.frame_pairs(poses, fx.BUCKET_NS), 1.0, 1.0)
    return registration.gate_correction(refined, 0.3, 1.0, 30.0).select(
        "bag_id", "to_ts", "from_ts", r("fitness").alias("fitness"), r("rmse").alias("rmse"), "accepted")


@query("loop_edges", "G12")
def _(spark, sf):
    scans, poses, _sensors = jobs.registered_frames(fx.points(spark, sf), fx.odom(spark, sf), CLOUD)
    pairs = cut(registration.loop_candidates(poses, 5, 100, 20.0, fx.BUCKET_NS))
    refined = registration.icp_refine(scans, pairs, 1.0, 1.0)
    return refined.filter("fitness >= 0.3").select("bag_id", "to_ts", "from_ts", r("fitness").alias("fitness"))


@query("occupancy_map", "Q1")
def _(spark, sf):
    cfg = jobs.MapConfig(voxel=1.0, res=1.0, grid_res=1.0, normal_radius=2.1, max_range=8.0, max_latency_ns=fx.LATENCY_NS,
                         min_cluster=5, bucket_ns=fx.BUCKET_NS)
    grid, _ext = jobs.occupancy_map(fx.points(spark, sf), fx.odom(spark, sf), cfg)
    return grid.groupBy("bag_id", "value").agg(F.count(F.lit(1)).alias("cells"))


@query("surface_mesh_job", "Q3")
def _(spark, sf):
    v, f = jobs.surface_mesh(world(spark, sf), 2.0, jobs.SurfaceConfig(smooth_iterations=2, target=0.9, curvature_percentile=99.0, rings=0))
    return f.groupBy("bag_id").agg(F.count(F.lit(1)).alias("faces")).join(v.groupBy("bag_id").agg(F.count(F.lit(1)).alias("vertices")), "bag_id")


# The coloured job's steps as views: the same rules as for single operators, over the selected scans.
fx.add_view("rworld", """
  SELECT p.bag_id, p.ts_ns, 0 AS point_idx, (1 - 2 * f.qz * f.qz) * p.x - 2 * f.qz * f.qw * p.y + f.px AS x,
    2 * f.qz * f.qw * p.x + (1 - 2 * f.qz * f.qz) * p.y + f.py AS y, p.z + f.pz AS z FROM big_vox p JOIN registered f USING (bag_id, ts_ns)""",
            ["big_vox", "registered"])
fx.add_view("rviews", fx.SQL_VIEWS["views"].replace("frame_pose f", "registered f"), ["registered", "frame_image"])
fx.add_view("rprojected", fx.SQL_VIEWS["projected"].replace("FROM world w JOIN views v", "FROM rworld w JOIN rviews v").replace(
    "BETWEEN 1.5 AND", "BETWEEN 0.5 AND"), ["rworld", "rviews"])
fx.add_view("rcoloured", fx.SQL_VIEWS["coloured"].replace("projected", "rprojected"), ["rprojected", "pixels"])
fx.add_view("rvox", voxel_view("rcoloured", 0.5, ", avg(g) AS g"), ["rcoloured"])
fx.add_view("rcloud", """
  SELECT * FROM rvox a WHERE abs(g - 0.5) >= 0.15 OR NOT EXISTS (
    SELECT 1 FROM (SELECT * FROM rvox WHERE abs(g - 0.5) >= 0.15) c WHERE c.bag_id = a.bag_id AND c.x BETWEEN a.x - 0.7 AND a.x + 0.7
    AND (c.x - a.x) * (c.x - a.x) + (c.y - a.y) * (c.y - a.y) + (c.z - a.z) * (c.z - a.z) <= 0.7::DOUBLE * 0.7::DOUBLE)""", ["rvox"])
fx.add_view("regcloud", "SELECT bag_id, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM rworld GROUP BY bag_id, floor(x / 0.5), floor(y / 0.5), floor(z / 0.5)", ["rworld"])


def _tiles_sql(cloud: str) -> str:
    layer = "SELECT bag_id, '{0}' AS lod, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM {1} GROUP BY bag_id, floor(x / {2}), floor(y / {2}), floor(z / {2})"
    return f"""
WITH layers AS ({layer.format('coarse', cloud, 2.0)} UNION ALL {layer.format('medium', cloud, 1.0)} UNION ALL SELECT bag_id, 'fine', x, y, z FROM {cloud}),
origin AS (SELECT *, 6378137.0::DOUBLE / sqrt(1 - e2 * sl * sl) AS n FROM (
  SELECT bag_id, sin(radians(avg(latitude))) AS sl, cos(radians(avg(latitude))) AS cl, sin(radians(avg(longitude))) AS so,
    cos(radians(avg(longitude))) AS co, avg(altitude) AS alt, (1 / 298.257223563::DOUBLE) * (2 - 1 / 298.257223563::DOUBLE) AS e2
  FROM gps WHERE status <> -1 GROUP BY 1)),
written AS (SELECT bag_id, lod, count(*) AS points, {r6('avg(-so * x + co * y + (n + alt) * cl * co)', 3)} AS ex FROM layers JOIN origin USING (bag_id) GROUP BY 1, 2),
tiles AS (SELECT bag_id, lod, count(*) AS tiles, CAST(sum(n) AS BIGINT) AS listed FROM (
  SELECT bag_id, lod, count(*) AS n FROM layers GROUP BY bag_id, lod, floor(x / 16.0), floor(y / 16.0)) GROUP BY 1, 2)
SELECT bag_id, lod, points, ex, tiles, listed FROM written JOIN tiles USING (bag_id, lod)"""


@query("coloured_cloud", "Q4", sql_with(["rcloud"], f"""
SELECT bag_id, point_idx, {r6('x')} AS x, {r6('y')} AS y, {r6('z')} AS z, {r6('g')} AS g FROM rcloud"""))
def _(spark, sf):
    c = jobs.coloured_cloud(fx.points(spark, sf), fx.odom(spark, sf), fx.images(spark, sf), fx.camera_info(spark, sf), CLOUD,
                            jobs.ColourConfig(fx.IMAGE_DT_NS, 0.5, 9.0, 0.7))
    return c.select("bag_id", "point_idx", *[r(n).alias(n) for n in ("x", "y", "z", "g")])


@query("model_export", "Q5 K4 K5")
def _(spark, sf):
    path = scratch_path(spark, "model")
    jobs.model_export(world(spark, sf), 3.0, path, jobs.SurfaceConfig(smooth_iterations=1))
    return spark.read.text(path, lineSep="endfacet\n").groupBy("bag_id").agg(F.count(F.lit(1)).alias("facets"))


def _tiles(spark, sf, cloud, means=()):
    layers, manifest = jobs.geo_tiles(cloud, fx.gps(spark, sf), 0.5, 16.0, means=means)
    path = scratch_path(spark, "tiles")
    jobs.write_lod_tiles(layers, manifest, 16.0, path)
    written = spark.read.parquet(f"{path}/layers").groupBy("bag_id", "lod").agg(
        F.count(F.lit(1)).alias("points"), r(F.avg("ex"), 3).alias("ex"))
    tiles = spark.read.parquet(f"{path}/manifest").groupBy("bag_id", "lod").agg(F.count(F.lit(1)).alias("tiles"), F.sum("n").alias("listed"))
    return written.join(tiles, ["bag_id", "lod"])


@query("geo_tiles", "Q6 K7 K3", sql_with(["regcloud", "gps"], _tiles_sql("regcloud")))
def _(spark, sf):
    return _tiles(spark, sf, jobs.registered_cloud(fx.points(spark, sf), fx.odom(spark, sf), CLOUD))


@query("coloured_geo_tiles", "Q7", sql_with(["rcloud", "gps"], _tiles_sql("rcloud")))
def _(spark, sf):
    c = jobs.coloured_cloud(fx.points(spark, sf), fx.odom(spark, sf), fx.images(spark, sf), fx.camera_info(spark, sf), CLOUD,
                            jobs.ColourConfig(fx.IMAGE_DT_NS, 0.5, 9.0, 0.7))
    return _tiles(spark, sf, c, ("r", "g", "b"))


@query("texture_tables", "Q8")
def _(spark, sf):
    cfg = jobs.TextureConfig(size=1.0, far=12.0, atlas=512, min_side=1.0, tol_ns=fx.IMAGE_DT_NS)
    out = jobs.texture_tables(world(spark, sf), keyframes(spark, sf), fx.images(spark, sf), fx.K, cfg)
    return out["texels"].groupBy("bag_id").agg(F.count(F.lit(1)).alias("texels"), r(F.avg("light"), 3).alias("light")).join(
        out["charts"].groupBy("bag_id").agg(F.count(F.lit(1)).alias("charts")), "bag_id")


