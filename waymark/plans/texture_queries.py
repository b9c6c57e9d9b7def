"""Queries on views of faces, charts and atlas texels."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark.operators import graph, mesh, views
from waymark.plans import fixtures as fx
from waymark.plans.cloud_queries import world
from waymark.plans.fixtures import r, r6, sql_with
from waymark.plans.registry import query
from waymark.plans.surfaces_queries import surface
from waymark.plans.timeline_queries import keyframes
from waymark.session import cut
from waymark.sources import messages

NEAR, FAR, ANGLE = 0.4, 12.0, 75.0
ATLAS, MIN_SIDE = 256, 2.0

fx.add_view("kfm", "SELECT *, 1 - 2 * qz * qz AS c, 2 * qz * qw AS s FROM keyframes", ["keyframes"])
fx.add_view("pair_geo", """
  SELECT *, sqrt(ox * ox + oy * oy + oz * oz) AS dist, 4.0 * ox / CASE WHEN oz = 0 THEN 1 ELSE oz END + 3.5 AS u,
    4.0 * oy / CASE WHEN oz = 0 THEN 1 ELSE oz END + 3.5 AS v,
    -(onx * ox + ony * oy + onz * oz) / (sqrt(ox * ox + oy * oy + oz * oz) + 1e-9) AS align FROM (
    SELECT f.bag_id, f.fid, k.kf_idx, k.sharpness, -(-k.s * (f.x - k.px) + k.c * (f.y - k.py)) AS ox, -(f.z - k.pz) AS oy,
      k.c * (f.x - k.px) + k.s * (f.y - k.py) AS oz, -(-k.s * f.nx + k.c * f.ny) AS onx, -f.nz AS ony, k.c * f.nx + k.s * f.ny AS onz
    FROM fgeo f JOIN kfm k USING (bag_id))""",
            ["fgeo", "kfm"])
fx.add_view("vis", f"""
  SELECT *, floor(u) AS pu, floor(v) AS pv FROM pair_geo WHERE oz > 0.1 AND align > cos(radians({ANGLE})) AND dist * dist < {FAR * FAR}
    AND dist * dist > {NEAR * NEAR} AND u >= 0 AND u < 8 AND v >= 0 AND v < 8
  QUALIFY oz < min(oz) OVER (PARTITION BY bag_id, kf_idx, floor(v), floor(u)) + 0.02""", ["pair_geo"])
fx.add_view("assigned", """
  SELECT bag_id, fid, arg_max(kf_idx, (score, -kf_idx)) AS kf_idx, max(score) AS score, count(*) AS views FROM (
    SELECT *, align * align * greatest(0.2, least(1.0, 1 - 0.6 * sqrt(pow((u - 3.5) / 4, 2) + pow((v - 3.5) / 4, 2))))
      * greatest(0.5, least(2.0, sharpness / (med + 1e-6))) / (dist * dist + 1e-6) AS score
    FROM vis JOIN (SELECT bag_id, median(sharpness) AS med FROM keyframes GROUP BY 1) USING (bag_id)) GROUP BY 1, 2""", ["vis", "keyframes"])


def scene(spark, sf):
    """Mesh, face geometry and cameras, each written once."""
    v, f = surface(spark, sf)
    geo = cut(mesh.face_geometry(v, f))
    kf = cut(views.sharpness_weights(keyframes(spark, sf)))
    return v, f, geo, kf, views.camera_table(kf)


def assigned(geo, cams):
    return cut(views.assign_views(views.visible_pairs(geo, cams, fx.K, ANGLE, NEAR, FAR), fx.K))


@query("cull_faces", "A22", sql_with(["pair_geo"], f"""
SELECT DISTINCT bag_id, fid FROM pair_geo WHERE oz > 0.1 AND align > cos(radians({ANGLE})) AND u >= -4 AND u < 12 AND v >= -4 AND v < 12"""))
def _(spark, sf):
    _v, _f, geo, _kf, cams = scene(spark, sf)
    return views.cull_faces(geo, cams, fx.K, ANGLE).select("bag_id", "fid")


@query("visible_pairs", "J13 A19", sql_with(["vis"], f"""
SELECT bag_id, fid, kf_idx, {r6('dist')} AS dist, {r6('align')} AS align FROM vis"""))
def _(spark, sf):
    _v, _f, geo, _kf, cams = scene(spark, sf)
    return views.visible_pairs(geo, cams, fx.K, ANGLE, NEAR, FAR).select("bag_id", "fid", "kf_idx", r("dist").alias("dist"), r("align").alias("align"))


@query("assign_views", "A20 A21 A33 X18 L5", sql_with(["assigned"], f"SELECT bag_id, fid, kf_idx, {r6('score')} AS score, views FROM assigned"))
def _(spark, sf):
    _v, _f, geo, _kf, cams = scene(spark, sf)
    return assigned(geo, cams).select("bag_id", "fid", "kf_idx", r("score").alias("score"), "views")


@query("face_coverage", "K11 A21", sql_with(["faces", "assigned"], """
SELECT bag_id, fid, coalesce(views, 0) AS views, greatest(0.0, least(1.0, coalesce(views, 0) / 5.0::DOUBLE)) AS level
FROM faces LEFT JOIN assigned USING (bag_id, fid)"""))
def _(spark, sf):
    _v, f, geo, _kf, cams = scene(spark, sf)
    return views.face_coverage(f, assigned(geo, cams))


@query("nearest_camera", "J17", sql_with(["fgeo", "keyframes", "assigned"], """
SELECT f.bag_id, f.fid, arg_min(k.kf_idx, ((f.x - k.px) * (f.x - k.px) + (f.y - k.py) * (f.y - k.py) + (f.z - k.pz) * (f.z - k.pz), k.kf_idx)) AS kf_idx
FROM fgeo f JOIN keyframes k USING (bag_id) WHERE NOT EXISTS (SELECT 1 FROM assigned a WHERE a.bag_id = f.bag_id AND a.fid = f.fid) GROUP BY 1, 2
UNION ALL SELECT bag_id, fid, kf_idx FROM assigned"""))
def _(spark, sf):
    _v, _f, geo, _kf, cams = scene(spark, sf)
    return views.fill_unassigned(geo, assigned(geo, cams), cut(cams), 8.0)


_VOTE = """
  SELECT a.bag_id, a.fid, CASE WHEN w.c > d.n / 2.0 THEN w.label ELSE a.kf_idx END AS kf_idx FROM {src} a
  LEFT JOIN (SELECT bag_id, u, label, c FROM (SELECT e.bag_id, e.u, b.kf_idx AS label, count(*) AS c FROM fadj e JOIN {src} b ON b.bag_id = e.bag_id AND b.fid = e.v
    WHERE b.kf_idx IS NOT NULL GROUP BY 1, 2, 3) QUALIFY row_number() OVER (PARTITION BY bag_id, u ORDER BY c DESC, label) = 1) w ON w.bag_id = a.bag_id AND w.u = a.fid
  LEFT JOIN (SELECT bag_id, u, count(*) AS n FROM fadj GROUP BY 1, 2) d ON d.bag_id = a.bag_id AND d.u = a.fid"""
fx.add_view("label0", "SELECT f.bag_id, f.fid, a.kf_idx FROM faces f LEFT JOIN assigned a USING (bag_id, fid)", ["faces", "assigned"])
for _i in (1, 2, 3):
    fx.add_view(f"label{_i}", _VOTE.format(src=f"label{_i - 1}"), [f"label{_i - 1}", "fadj"])


def smoothed(f, asg):
    start = f.select("bag_id", "fid").join(asg.select("bag_id", "fid", "kf_idx"), ["bag_id", "fid"], "left")
    adj = cut(mesh.face_adjacency(f))
    return graph.smooth_labels(start, adj, 3), adj


@query("smooth_assignment", "G4", sql_with(["label3"], "SELECT bag_id, fid, CAST(kf_idx AS INTEGER) AS kf_idx FROM label3"))
def _(spark, sf):
    _v, f, geo, _kf, cams = scene(spark, sf)
    return smoothed(f, assigned(geo, cams))[0].select("bag_id", "fid", F.col("kf_idx").cast("int").alias("kf_idx"))


fx.add_view("frame_near_kf", f"""
  SELECT DISTINCT w.bag_id, w.ts_ns FROM (SELECT w.*, -(-k.s * (w.x - k.px) + k.c * (w.y - k.py)) AS ox, -(w.z - k.pz) AS oy,
      k.c * (w.x - k.px) + k.s * (w.y - k.py) AS oz FROM world w JOIN kfm k ON k.bag_id = w.bag_id AND abs(k.ts_ns - w.ts_ns) <= {fx.IMAGE_DT_NS}) w
  WHERE oz > 0.1 AND 4 * ox / oz + 3.5 >= 0 AND 4 * ox / oz + 3.5 < 8 AND 4 * oy / oz + 3.5 >= 0 AND 4 * oy / oz + 3.5 < 8""", ["world", "kfm"])


@query("visible_frames", "J7 J6", sql_with(["frame_near_kf"], "SELECT bag_id, ts_ns FROM frame_near_kf"))
def _(spark, sf):
    return views.visible_frames(world(spark, sf), cut(keyframes(spark, sf)), fx.K, fx.IMAGE_DT_NS)


# Charts: each block of 64 face ids on one camera stands for a component in the checks below.
fx.add_view("chart_faces", "SELECT bag_id, fid, kf_idx, kf_idx * 1000 + fid % 7 AS chart FROM assigned", ["assigned"])
fx.add_view("cuv", """
  SELECT bag_id, chart, kf_idx, vid, greatest(-4.0, least(12.0, 4.0 * ox / greatest(oz, 0.1) + 3.5)) AS u,
    greatest(-4.0, least(12.0, 4.0 * oy / greatest(oz, 0.1) + 3.5)) AS v FROM (
    SELECT c.bag_id, c.chart, c.kf_idx, c.vid, -(-k.s * (p.x - k.px) + k.c * (p.y - k.py)) AS ox, -(p.z - k.pz) AS oy,
      k.c * (p.x - k.px) + k.s * (p.y - k.py) AS oz
    FROM (SELECT DISTINCT f.bag_id, f.chart, f.kf_idx, c.vid FROM chart_faces f JOIN fcorner c USING (bag_id, fid)) c
    JOIN vertices p USING (bag_id, vid) JOIN kfm k USING (bag_id, kf_idx))""", ["chart_faces", "fcorner", "vertices", "kfm"])
fx.add_view("cbox", f"""
  SELECT *, maxu - minu AS w, maxv - minv AS h FROM (SELECT bag_id, chart, kf_idx, min(u) AS minu, max(u) AS maxu, min(v) AS minv, max(v) AS maxv
    FROM cuv GROUP BY 1, 2, 3) WHERE maxu - minu >= {MIN_SIDE} AND maxv - minv >= {MIN_SIDE}""", ["cuv"])


def chart_rows(asg):
    return asg.select("bag_id", "fid", "kf_idx", (F.col("kf_idx").cast("long") * 1000 + F.col("fid") % 7).alias("chart"))


def boxes(v, f, cams, charts):
    uv = cut(views.chart_uv(charts, f, v, cams, fx.K))
    return uv, cut(views.chart_boxes(uv, MIN_SIDE))


@query("chart_boxes", "A32", sql_with(["cbox"], f"""
SELECT bag_id, chart, kf_idx, {r6('minu')} AS minu, {r6('minv')} AS minv, {r6('w')} AS w, {r6('h')} AS h FROM cbox"""))
def _(spark, sf):
    v, f, geo, _kf, cams = scene(spark, sf)
    return boxes(v, f, cams, chart_rows(assigned(geo, cams)))[1].select(
        "bag_id", "chart", "kf_idx", *[r(c).alias(c) for c in ("minu", "minv", "w", "h")])


# Shared scale is one here: the charts fit the atlas. Sides, cap and aspect rules still apply.
fx.add_view("csize", f"""
  SELECT *, least(w2, h2) AS w_int, greatest(w2, h2) AS h_int, w2 > h2 AS rotated FROM (
    SELECT *, CASE WHEN w1 / h1 > 4 THEN greatest(1, CAST(trunc(h1 * 4) AS INTEGER)) ELSE w1 END AS w2,
      CASE WHEN NOT (w1 / h1 > 4) AND h1 / w1 > 4 THEN greatest(1, CAST(trunc(w1 * 4) AS INTEGER)) ELSE h1 END AS h2 FROM (
      SELECT *, CAST(ceil(w * scale) AS INTEGER) + 4 AS w1, CAST(ceil(h * scale) AS INTEGER) + 4 AS h1 FROM (
        SELECT *, CASE WHEN area > {ATLAS * ATLAS * 0.6} THEN sqrt({ATLAS * ATLAS * 0.6} / area) ELSE 1.0 END AS scale
        FROM (SELECT *, sum(w * h) OVER (PARTITION BY bag_id) AS area FROM cbox)))) WHERE w2 >= 8 AND h2 >= 8""", ["cbox"])


@query("size_charts", "X19", sql_with(["csize"], f"""
SELECT bag_id, chart, {r6('scale')} AS scale, rotated, w_int, h_int FROM csize"""))
def _(spark, sf):
    v, f, geo, _kf, cams = scene(spark, sf)
    b = boxes(v, f, cams, chart_rows(assigned(geo, cams)))[1]
    return views.size_charts(b, ATLAS).select("bag_id", "chart", r("scale").alias("scale"), "rotated", "w_int", "h_int")


fx.add_view("packed", f"""
  SELECT bag_id, chart, px, py FROM (
    WITH RECURSIVE o AS (SELECT *, row_number() OVER (PARTITION BY bag_id ORDER BY h_int DESC, w_int DESC, chart) AS rn FROM csize),
    walk(bag_id, rn, chart, px, py, x, shelf) AS (
      SELECT bag_id, rn, chart, 0, 0, w_int, h_int FROM o WHERE rn = 1
      UNION ALL
      SELECT o.bag_id, o.rn, o.chart, CASE WHEN w.x + o.w_int > {ATLAS} THEN 0 ELSE w.x END, CASE WHEN w.x + o.w_int > {ATLAS} THEN w.py + w.shelf ELSE w.py END,
        CASE WHEN w.x + o.w_int > {ATLAS} THEN o.w_int ELSE w.x + o.w_int END, CASE WHEN w.x + o.w_int > {ATLAS} THEN o.h_int ELSE greatest(w.shelf, o.h_int) END
      FROM walk w JOIN o ON o.bag_id = w.bag_id AND o.rn = w.rn + 1) SELECT * FROM walk)""", ["csize"])


def packing(spark, sf):
    v, f, geo, kf, cams = scene(spark, sf)
    charts = chart_rows(assigned(geo, cams))
    uv, b = boxes(v, f, cams, charts)
    return f, kf, charts, uv, cut(views.shelf_pack(views.size_charts(b, ATLAS), ATLAS))


@query("shelf_pack", "W6 L6", sql_with(["packed"], "SELECT bag_id, chart, px, py FROM packed"))
def _(spark, sf):
    return packing(spark, sf)[4].select("bag_id", "chart", "px", "py")


fx.add_view("fuv", f"""
  SELECT c.bag_id, c.fid, c.corner, (p.px + 2 + CASE WHEN s.rotated THEN (u.v - s.minv) * s.scale ELSE (u.u - s.minu) * s.scale END) / {ATLAS}.0 AS ua,
    1 - (p.py + 2 + CASE WHEN s.rotated THEN (u.u - s.minu) * s.scale ELSE (u.v - s.minv) * s.scale END) / t.final_h AS va
  FROM fcorner c JOIN chart_faces f USING (bag_id, fid) JOIN csize s USING (bag_id, chart) JOIN packed p USING (bag_id, chart)
  JOIN cuv u ON u.bag_id = c.bag_id AND u.chart = f.chart AND u.vid = c.vid
  JOIN (SELECT bag_id, ceil(max(py + h_int) / 1024.0) * 1024 AS final_h FROM packed JOIN csize USING (bag_id, chart) GROUP BY 1) t ON t.bag_id = c.bag_id""",
            ["fcorner", "chart_faces", "csize", "packed", "cuv"])


@query("face_uvs", "X20", sql_with(["fuv"], f"SELECT bag_id, fid, CAST(corner AS INTEGER) AS corner, {r6('ua')} AS ua, {r6('va')} AS va FROM fuv"))
def _(spark, sf):
    f, _kf, charts, uv, packed = packing(spark, sf)
    return views.face_uvs(f, charts, uv, packed, ATLAS).select("bag_id", "fid", "corner", r("ua").alias("ua"), r("va").alias("va"))


@query("bake_texels", "X21", sql_with(["packed", "csize", "keyframes", "pixels"], """
SELECT t.bag_id, t.ax, t.ay, g FROM (
  SELECT *, CAST(trunc(minu + CASE WHEN rotated THEN (j - 2) / scale ELSE (i - 2) / scale END) AS INTEGER) AS u,
    CAST(trunc(minv + CASE WHEN rotated THEN (i - 2) / scale ELSE (j - 2) / scale END) AS INTEGER) AS v, CAST(px + i AS INTEGER) AS ax, CAST(py + j AS INTEGER) AS ay
  FROM (SELECT s.*, p.px, p.py, k.ts_ns, unnest(generate_series(0, s.h_int - 1)) AS j FROM csize s JOIN packed p USING (bag_id, chart) JOIN keyframes k USING (bag_id, kf_idx)),
    LATERAL (SELECT unnest(generate_series(0, w_int - 1)) AS i)) t
JOIN pixels q ON q.bag_id = t.bag_id AND q.image_ts_ns = t.ts_ns AND q.u = t.u AND q.v = t.v"""))
def _(spark, sf):
    _f, kf, _charts, _uv, packed = packing(spark, sf)
    px = messages.pixels(fx.images(spark, sf))
    return views.bake_texels(packed, px, kf, ATLAS, fx.K, ("g",)).select("bag_id", "ax", "ay", F.col("g").cast("int").alias("g"))


@query("face_charts", "G3")
def _(spark, sf):
    _v, f, geo, _kf, cams = scene(spark, sf)
    labels, adj = smoothed(f, assigned(geo, cams))
    charts = views.face_charts(labels, adj)
    return charts.groupBy("bag_id", "kf_idx").agg(F.count_distinct("chart").alias("charts"), F.count(F.lit(1)).alias("faces"))
