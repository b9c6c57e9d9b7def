"""Queries on camera colours and pixels."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark.functions.color import is_gray
from waymark.operators import colour, points as pts, reports
from waymark.plans import fixtures as fx
from waymark.plans.cloud_queries import voxel_view, world
from waymark.plans.fixtures import r, r6, sql_with
from waymark.plans.registry import query
from waymark.plans.timeline_queries import frame_poses
from waymark.session import cut
from waymark.sources import messages

# The wide tolerance leaves some scans without an image.
fx.add_view("views", f"""
  SELECT f.*, CASE WHEN abs(m.match_ts - m.ts_ns) <= {fx.IMAGE_DT_NS} THEN m.match_ts END AS image_ts_ns
  FROM frame_pose f JOIN frame_image m USING (bag_id, ts_ns) WHERE f.px IS NOT NULL""", ["frame_pose", "frame_image"])
# body coordinates: inverse rotation of the world offset
fx.add_view("projected", """
  SELECT bag_id, ts_ns, point_idx, x, y, z, image_ts_ns, CASE WHEN ok THEN CAST(trunc(uu) AS INTEGER) END AS u,
    CASE WHEN ok THEN CAST(trunc(vv) AS INTEGER) END AS v FROM (
    SELECT *, image_ts_ns IS NOT NULL AND bx > 1e-6 AND sqrt(bx * bx + by_ * by_ + bz * bz) BETWEEN 1.5 AND 9.0
      AND uu >= 0 AND uu < 8 AND vv >= 0 AND vv < 8 AS ok FROM (
      SELECT *, 4.0 * -by_ / greatest(bx, 1e-6) + 3.5 AS uu, 4.0 * -bz / greatest(bx, 1e-6) + 3.5 AS vv FROM (
        SELECT w.*, v.image_ts_ns, (1 - 2 * v.qz * v.qz) * (w.x - v.px) + 2 * v.qz * v.qw * (w.y - v.py) AS bx,
          -2 * v.qz * v.qw * (w.x - v.px) + (1 - 2 * v.qz * v.qz) * (w.y - v.py) AS by_, w.z - v.pz AS bz
        FROM world w JOIN views v USING (bag_id, ts_ns))))""", ["world", "views"])
fx.add_view("coloured", """
  SELECT p.*, coalesce(g / 255.0::DOUBLE, 0.5) AS g FROM projected p LEFT JOIN pixels USING (bag_id, image_ts_ns, v, u)""", ["projected", "pixels"])


def views(spark, sf):
    poses = frame_poses(spark, sf, False).filter("px is not null")
    matched = colour.match_images(poses, fx.images(spark, sf), fx.IMAGE_DT_NS, fx.BUCKET_NS)
    return cut(messages.intrinsics_for(matched, messages.decode_camera_info(fx.camera_info(spark, sf)), "earliest"))


def coloured(spark, sf, seen_views=None):
    v = views(spark, sf) if seen_views is None else seen_views
    w = pts.transform_points(fx.points(spark, sf), v)
    return colour.sample_images(colour.project_points(w, v, 1.5, 9.0), fx.images(spark, sf))


@query("project_points", "X6 X7 F15", sql_with(["projected"], "SELECT bag_id, point_idx, image_ts_ns, u, v FROM projected"))
def _(spark, sf):
    v = views(spark, sf)
    w = pts.transform_points(fx.points(spark, sf), v)
    return colour.project_points(w, v, 1.5, 9.0).select("bag_id", "point_idx", "image_ts_ns", "u", "v")


@query("colour_points", "J11 F17", sql_with(["coloured"], f"""
SELECT bag_id, point_idx, {r6('g')} AS r, {r6('g')} AS g, {r6('g')} AS b FROM coloured"""))
def _(spark, sf):
    return coloured(spark, sf).select("bag_id", "point_idx", *[r(c).alias(c) for c in "rgb"])


@query("colour_coverage", "K12", sql_with(["views"], """
SELECT bag_id, count(*) AS merged, count(image_ts_ns) AS camera_coloured, count(*) - count(image_ts_ns) AS fallback_gray FROM views GROUP BY 1"""))
def _(spark, sf):
    return reports.colour_coverage(views(spark, sf), "image_ts_ns")


# Pixels are gray levels; tint the bright ones so that both sides of the gray rule occur.
_TINT = "CASE WHEN g > 0.6 THEN 0.2 ELSE g END"
fx.add_view("tinted", f"SELECT bag_id, x, y, z, {_TINT} AS r, g, g AS b FROM coloured", ["coloured"])
fx.add_view("tvox", voxel_view("tinted", 0.5, ", avg(r) AS r, avg(g) AS g, avg(b) AS b"), ["tinted"])
_GRAY = """sqrt(((r - (r + g + b) / 3) * (r - (r + g + b) / 3) + (g - (r + g + b) / 3) * (g - (r + g + b) / 3)
  + (b - (r + g + b) / 3) * (b - (r + g + b) / 3)) / 3) < 0.08 AND abs((r + g + b) / 3 - 0.5) < 0.15"""


def tinted_voxels(spark, sf):
    c = coloured(spark, sf).withColumn("r", F.when(F.col("g") > 0.6, 0.2).otherwise(F.col("g")))
    return cut(pts.voxel_downsample(c, 0.5, means=("r", "g", "b")).withColumn("point_idx", pts.voxel_id()))


@query("gray_rule", "F16", sql_with(["tvox"], f"SELECT bag_id, point_idx, {_GRAY} AS gray FROM tvox"))
def _(spark, sf):
    return tinted_voxels(spark, sf).select("bag_id", "point_idx", is_gray("r", "g", "b").alias("gray"))


@query("drop_gray_near_colour", "J10", sql_with(["tvox"], f"""
SELECT bag_id, point_idx, {r6('g')} AS g FROM tvox a WHERE NOT ({_GRAY}) OR NOT EXISTS (
  SELECT 1 FROM (SELECT * FROM tvox WHERE NOT ({_GRAY})) c WHERE c.bag_id = a.bag_id AND c.x BETWEEN a.x - 1.3 AND a.x + 1.3
  AND (c.x - a.x) * (c.x - a.x) + (c.y - a.y) * (c.y - a.y) + (c.z - a.z) * (c.z - a.z) <= 1.3 * 1.3)"""))
def _(spark, sf):
    return pts.drop_gray_near_color(tinted_voxels(spark, sf), 1.3).select("bag_id", "point_idx", r("g").alias("g"))


@query("concat_clouds", "U3", sql_with(["world", "svox"], f"""
SELECT bag_id, {r6('x', 9)} AS x, 0.5::DOUBLE AS r, 0.25::DOUBLE AS g FROM svox UNION ALL SELECT bag_id, {r6('x', 9)}, 0.5, 0.5 FROM points"""))
def _(spark, sf):
    a = pts.voxel_downsample(fx.points(spark, sf), 0.5).select(
        "bag_id", "x", "y", "z", F.lit(None).cast("double").alias("r"), F.lit(0.25).alias("g"), F.lit(0.25).alias("b"),
        F.lit(0.0).alias("nx"), F.lit(0.0).alias("ny"), F.lit(1.0).alias("nz"))
    b = fx.points(spark, sf).select("bag_id", "x", "y", "z")
    both = pts.concat_clouds([a, b])
    assert "nx" not in both.columns
    return both.select("bag_id", r("x", 9).alias("x"), "r", "g")


_L = """CAST(floor((CASE WHEN yy > 0.008856 THEN 116.0 * cbrt(yy) - 16.0 ELSE 903.3 * yy END) * 2.55::DOUBLE + 0.5) AS BIGINT)"""
fx.add_view("light", f"""
  SELECT bag_id, image_ts_ns, v, u, {_L} AS l FROM (
    SELECT *, (CASE WHEN g / 255.0 > 0.04045 THEN pow((g / 255.0::DOUBLE + 0.055) / 1.055, 2.4::DOUBLE) ELSE g / 255.0::DOUBLE / 12.92 END) AS c,
      c * 0.212671::DOUBLE + c * 0.715160::DOUBLE + c * 0.072169::DOUBLE AS yy FROM pixels)""", ["pixels"])


@query("match_lightness", "A28", sql_with(["light"], """
SELECT bag_id, image_ts_ns, CAST(v AS INTEGER) AS v, CAST(u AS INTEGER) AS u, l,
  CAST(floor(greatest(0.0, least(255.0, (l - m) * (rs / (s + 1e-5)) + rm))) AS INTEGER) AS l_matched
FROM light JOIN (SELECT bag_id, image_ts_ns, avg(l) AS m, stddev_pop(l) AS s FROM light GROUP BY 1, 2) USING (bag_id, image_ts_ns)
JOIN (SELECT bag_id, avg(l) AS rm, stddev_pop(l) AS rs FROM light JOIN (SELECT bag_id, min(image_ts_ns) AS image_ts_ns FROM light GROUP BY 1)
  USING (bag_id, image_ts_ns) GROUP BY 1) USING (bag_id)"""))
def _(spark, sf):
    img = fx.images(spark, sf)
    ref = img.groupBy("bag_id").agg(F.min("ts_ns").alias("image_ts_ns"))
    return colour.match_lightness(messages.pixels(img), ref).select("bag_id", "image_ts_ns", "v", "u", "l", "l_matched")


@query("mip_levels", "A29", sql_with(["pixels"], """
SELECT bag_id, image_ts_ns, 0 AS level, CAST(v AS INTEGER) AS v, CAST(u AS INTEGER) AS u, g::DOUBLE AS g FROM pixels UNION ALL
SELECT bag_id, image_ts_ns, 1, CAST(v // 2 AS INTEGER), CAST(u // 2 AS INTEGER), avg(g) FROM pixels GROUP BY ALL UNION ALL
SELECT bag_id, image_ts_ns, 2, CAST(v // 4 AS INTEGER), CAST(u // 4 AS INTEGER), avg(g) FROM pixels GROUP BY ALL"""))
def _(spark, sf):
    return colour.mip_levels(messages.pixels(fx.images(spark, sf)), 2, channels=("g",))


