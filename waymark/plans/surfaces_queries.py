"""Queries on meshes built from occupied voxels."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark.operators import floor, graph, mesh, points as pts
from waymark.plans import fixtures as fx
from waymark.plans.cloud_queries import voxel_view, world
from waymark.plans.fixtures import r, r6, sql_with
from waymark.plans.registry import query
from waymark.session import cut

SIZE = 2.0
_PACK = "(({0} + 262144) * 274877906944 + ({1} + 262144) * 524288 + ({2} + 262144))"
_SIDES = ", ".join(
    f"({i}, {s[0]}, {s[1]}, {s[2]}, " + ", ".join(str(c) for corner in cs for c in corner) + ")"
    for i, (s, cs) in enumerate(mesh.CUBE_SIDES))
fx.add_view("w2", voxel_view("world", SIZE), ["world"])
fx.add_view("solid", "SELECT bag_id, vx, vy, vz, n, x, y, z FROM w2", ["w2"])
fx.add_view("quads", f"""
  SELECT s.bag_id, {_PACK.format('s.vx', 's.vy', 's.vz')} * 12 + d.i * 2 AS fid,
    {', '.join(_PACK.format(f's.vx + c{k}x', f's.vy + c{k}y', f's.vz + c{k}z') + f' AS q{k}' for k in range(4))}
  FROM solid s, (VALUES {_SIDES}) d(i, sx, sy, sz, {', '.join(f'c{k}{a}' for k in range(4) for a in 'xyz')})
  WHERE NOT EXISTS (SELECT 1 FROM solid t WHERE t.bag_id = s.bag_id AND t.vx = s.vx + d.sx AND t.vy = s.vy + d.sy AND t.vz = s.vz + d.sz)""", ["solid"])
fx.add_view("faces", """
  SELECT bag_id, fid, q0 AS v0, q1 AS v1, q2 AS v2 FROM quads UNION ALL SELECT bag_id, fid + 1, q0, q2, q3 FROM quads""", ["quads"])
fx.add_view("fcorner", """
  SELECT bag_id, fid, 0 AS corner, v0 AS vid FROM faces UNION ALL SELECT bag_id, fid, 1, v1 FROM faces UNION ALL SELECT bag_id, fid, 2, v2 FROM faces""", ["faces"])
fx.add_view("vertices", f"""
  SELECT bag_id, vid, (vid // 274877906944 - 262144) * {SIZE}::DOUBLE AS x, (vid // 524288 % 524288 - 262144) * {SIZE}::DOUBLE AS y,
    (vid % 524288 - 262144) * {SIZE}::DOUBLE AS z FROM (SELECT DISTINCT bag_id, vid FROM fcorner)""", ["fcorner"])
fx.add_view("fgeo", """
  SELECT *, CASE WHEN l > 1e-12 THEN cx / l ELSE 0 END AS nx, CASE WHEN l > 1e-12 THEN cy / l ELSE 0 END AS ny,
    CASE WHEN l > 1e-12 THEN cz / l ELSE 0 END AS nz, l / 2 AS area FROM (
    SELECT *, sqrt(cx * cx + cy * cy + cz * cz) AS l FROM (
      SELECT f.bag_id, f.fid, f.v0, f.v1, f.v2, (a.x + b.x + c.x) / 3 AS x, (a.y + b.y + c.y) / 3 AS y, (a.z + b.z + c.z) / 3 AS z,
        (b.y - a.y) * (c.z - a.z) - (b.z - a.z) * (c.y - a.y) AS cx, (b.z - a.z) * (c.x - a.x) - (b.x - a.x) * (c.z - a.z) AS cy,
        (b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x) AS cz
      FROM faces f JOIN vertices a ON a.bag_id = f.bag_id AND a.vid = f.v0 JOIN vertices b ON b.bag_id = f.bag_id AND b.vid = f.v1
      JOIN vertices c ON c.bag_id = f.bag_id AND c.vid = f.v2))""", ["faces", "vertices"])
fx.add_view("fedge", """
  SELECT bag_id, fid, least(v0, v1) AS a, greatest(v0, v1) AS b FROM faces UNION ALL SELECT bag_id, fid, least(v1, v2), greatest(v1, v2) FROM faces
  UNION ALL SELECT bag_id, fid, least(v2, v0), greatest(v2, v0) FROM faces""", ["faces"])
fx.add_view("fadj", """
  SELECT DISTINCT p.bag_id, p.fid AS u, q.fid AS v FROM fedge p JOIN fedge q USING (bag_id, a, b)
  JOIN (SELECT bag_id, a, b FROM fedge GROUP BY ALL HAVING count(*) = 2) USING (bag_id, a, b) WHERE p.fid <> q.fid""", ["fedge"])
fx.add_view("curv", """
  SELECT v.bag_id, v.vid, coalesce(CASE WHEN n > 1 THEN 1 - m / n WHEN n = 1 THEN 1.0 END, 0.0) AS curvature, coalesce(1 - m, 0.0) AS corrected
  FROM vertices v LEFT JOIN (SELECT c.bag_id, c.vid, count(*) AS n, sqrt(avg(nx) * avg(nx) + avg(ny) * avg(ny) + avg(nz) * avg(nz)) AS m
    FROM fcorner c JOIN fgeo USING (bag_id, fid) GROUP BY 1, 2) USING (bag_id, vid)""", ["vertices", "fcorner", "fgeo"])
fx.add_view("sharp_faces", """
  SELECT DISTINCT c.bag_id, c.fid FROM fcorner c JOIN curv v USING (bag_id, vid)
  JOIN (SELECT bag_id, quantile_cont(curvature, 0.97) AS lim FROM curv GROUP BY 1) USING (bag_id) WHERE v.curvature >= lim""", ["fcorner", "curv"])


def solid(spark, sf):
    return cut(pts.voxel_downsample(world(spark, sf), SIZE))


def surface(spark, sf):
    """Vertices and faces of the voxel surface, written once."""
    v, f = mesh.voxel_surface(solid(spark, sf), SIZE)
    f = cut(f)
    return cut(mesh.vertices_of(f, SIZE)), f


@query("voxel_surface", "G9 S12", sql_with(["faces"], "SELECT bag_id, fid, v0, v1, v2 FROM faces"))
def _(spark, sf):
    return mesh.voxel_surface(solid(spark, sf), SIZE)[1]


@query("mesh_vertices", "G9", sql_with(["vertices"], "SELECT * FROM vertices"))
def _(spark, sf):
    return mesh.voxel_surface(solid(spark, sf), SIZE)[0]


@query("face_geometry", "X17 J16", sql_with(["fgeo"], f"""
SELECT bag_id, fid, {r6('x')} AS x, {r6('y')} AS y, {r6('z')} AS z, {r6('nx')} AS nx, {r6('ny')} AS ny, {r6('nz')} AS nz, {r6('area')} AS area FROM fgeo"""))
def _(spark, sf):
    g = mesh.face_geometry(*surface(spark, sf))
    return g.select("bag_id", "fid", *[r(c).alias(c) for c in ("x", "y", "z", "nx", "ny", "nz", "area")])


@query("face_adjacency", "J16 U5", sql_with(["fadj"], "SELECT bag_id, u, v FROM fadj"))
def _(spark, sf):
    return mesh.face_adjacency(surface(spark, sf)[1])


@query("vertex_curvature", "A25", sql_with(["curv"], f"SELECT bag_id, vid, {r6('curvature')} AS curvature, {r6('corrected')} AS corrected FROM curv"))
def _(spark, sf):
    v, f = surface(spark, sf)
    a = mesh.vertex_curvature(v, f)
    b = mesh.vertex_curvature(v, f, corrected=True).select("bag_id", "vid", F.col("curvature").alias("corrected"))
    return a.join(b, ["bag_id", "vid"]).select("bag_id", "vid", r("curvature").alias("curvature"), r("corrected").alias("corrected"))


def rounded_curvature(v, f):
    """Rounded, so that the percentile cut does not hang on summation order."""
    return mesh.vertex_curvature(v, f).withColumn("curvature", r("curvature"))


fx.add_view("sharp_r", """
  SELECT DISTINCT c.bag_id, c.fid FROM fcorner c JOIN (SELECT bag_id, vid, round(curvature, 6) AS curvature FROM curv) v USING (bag_id, vid)
  JOIN (SELECT bag_id, quantile_cont(round(curvature, 6), 0.9) AS lim FROM curv GROUP BY 1) USING (bag_id) WHERE v.curvature >= lim""", ["fcorner", "curv"])


@query("protect_faces", "A26 G5", sql_with(["sharp_r", "fcorner"], """
SELECT DISTINCT f.bag_id, f.fid FROM fcorner f JOIN (SELECT DISTINCT c.bag_id, c.vid FROM fcorner c JOIN sharp_r USING (bag_id, fid)) t USING (bag_id, vid)"""))
def _(spark, sf):
    v, f = surface(spark, sf)
    return mesh.protect_faces(f, rounded_curvature(v, f), 90.0, 1)


@query("submesh_dense", "G6", sql_with(["faces", "vertices"], """
WITH pick AS (SELECT * FROM faces WHERE fid % 3 = 0),
  num AS (SELECT bag_id, vid, row_number() OVER (PARTITION BY bag_id ORDER BY vid) - 1 AS new FROM (
    SELECT DISTINCT bag_id, vid FROM (SELECT bag_id, unnest([v0, v1, v2]) AS vid FROM pick)))
SELECT p.bag_id, p.fid, a.new AS v0, b.new AS v1, c.new AS v2 FROM pick p JOIN num a ON a.bag_id = p.bag_id AND a.vid = p.v0
JOIN num b ON b.bag_id = p.bag_id AND b.vid = p.v1 JOIN num c ON c.bag_id = p.bag_id AND c.vid = p.v2"""))
def _(spark, sf):
    v, f = surface(spark, sf)
    sv, sf_ = mesh.submesh(v, f, f.filter("fid % 3 = 0").select("bag_id", "fid"))
    return mesh.dense_index(sv, sf_)[1]


# A soup of quads: every face brings its own corners, some faces come twice or collapse.
_SOUP = """
  soup AS (SELECT bag_id, fid * 2 AS fid, v0, v1, v2 FROM faces UNION ALL SELECT bag_id, fid * 2 + 1, v1, v2, v0 FROM faces WHERE fid % 5 = 0
    UNION ALL SELECT bag_id, fid * 2 + 1, v0, v0, v2 FROM faces WHERE fid % 5 = 1),
  live AS (SELECT * FROM soup WHERE v0 <> v1 AND v1 <> v2 AND v2 <> v0),
  uniq AS (SELECT * FROM live QUALIFY row_number() OVER (PARTITION BY bag_id, list_sort([v0, v1, v2]) ORDER BY fid) = 1),
  edge AS (SELECT bag_id, fid, least(v0, v1) AS a, greatest(v0, v1) AS b FROM uniq UNION ALL SELECT bag_id, fid, least(v1, v2), greatest(v1, v2) FROM uniq
    UNION ALL SELECT bag_id, fid, least(v2, v0), greatest(v2, v0) FROM uniq),
  keep AS (SELECT bag_id, fid FROM (SELECT *, row_number() OVER (PARTITION BY bag_id, a, b ORDER BY fid) AS rk FROM edge) WHERE rk <= 2 GROUP BY ALL HAVING count(*) = 3)"""


@query("clean_mesh", "G7", sql_with(["faces"], f"WITH {_SOUP}\nSELECT u.bag_id, u.fid, u.v0, u.v1, u.v2 FROM uniq u JOIN keep USING (bag_id, fid)"))
def _(spark, sf):
    v, f = surface(spark, sf)
    more = f.filter("fid % 5 = 0").selectExpr("bag_id", "fid * 2 + 1 as fid", "v1 as v0", "v2 as v1", "v0 as v2")
    flat = f.filter("fid % 5 = 1").selectExpr("bag_id", "fid * 2 + 1 as fid", "v0", "v0 as v1", "v2")
    soup = f.selectExpr("bag_id", "fid * 2 as fid", "v0", "v1", "v2").unionByName(more).unionByName(flat)
    # split vertices: even faces use shifted copies at the same place
    copies = v.unionByName(v.withColumn("vid", F.col("vid") + (1 << 59)))
    split = soup.selectExpr("bag_id", "fid", "v0", "v1", f"case when fid % 4 = 0 then v2 + {1 << 59} else v2 end as v2")
    return mesh.clean_mesh(copies, split)[1]


fx.add_view("vedge", "SELECT DISTINCT bag_id, a AS u, b AS v FROM fedge UNION SELECT DISTINCT bag_id, b, a FROM fedge", ["fedge"])
for _i, _f, _src in ((1, 0.5, "vertices"), (2, mesh.TAUBIN_MU, "smooth1"), (3, 0.5, "smooth2"), (4, mesh.TAUBIN_MU, "smooth3")):
    fx.add_view(f"smooth{_i}", f"""
  SELECT p.bag_id, p.vid, p.x + {_f} * (sum(q.x * w) / sum(w) - p.x) AS x, p.y + {_f} * (sum(q.y * w) / sum(w) - p.y) AS y,
    p.z + {_f} * (sum(q.z * w) / sum(w) - p.z) AS z
  FROM (SELECT e.bag_id, e.u, e.v, 1 / (sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)) + 1e-12) AS w
    FROM vedge e JOIN {_src} a ON a.bag_id = e.bag_id AND a.vid = e.u JOIN {_src} b ON b.bag_id = e.bag_id AND b.vid = e.v) n
  JOIN {_src} p ON p.bag_id = n.bag_id AND p.vid = n.u JOIN {_src} q ON q.bag_id = n.bag_id AND q.vid = n.v
  GROUP BY p.bag_id, p.vid, p.x, p.y, p.z""", ["vedge", _src])


@query("smooth_mesh", "G8", sql_with(["smooth4"], f"SELECT bag_id, vid, {r6('x')} AS x, {r6('y')} AS y, {r6('z')} AS z FROM smooth4"))
def _(spark, sf):
    v = mesh.smooth_mesh(*surface(spark, sf), "taubin", 2, 0.5)
    return v.select("bag_id", "vid", *[r(a).alias(a) for a in "xyz"])


@query("simplify_mesh", "G10 X16")
def _(spark, sf):
    v, f = surface(spark, sf)
    sv, sfaces = mesh.simplify_mesh(v, f, 0.8, SIZE, 99.0, 0)
    return sfaces.groupBy("bag_id").agg(F.count(F.lit(1)).alias("faces")).join(
        sv.groupBy("bag_id").agg(F.count(F.lit(1)).alias("vertices")), "bag_id")


@query("decimate_target", "X16", sql_with(["faces"], """
SELECT bag_id, count(*) AS n, CAST(greatest(4, floor(count(*) * 0.3::DOUBLE)) AS BIGINT) AS target FROM faces GROUP BY 1"""))
def _(spark, sf):
    return mesh.decimate_target(surface(spark, sf)[1], 0.3)


fx.add_view("support", "SELECT v.*, count(*) AS support FROM vertices v JOIN fcorner USING (bag_id, vid) GROUP BY ALL", ["vertices", "fcorner"])


@query("trim_low_support", "A23", sql_with(["support", "faces"], """
WITH kept AS (SELECT bag_id, vid FROM support JOIN (SELECT bag_id, quantile_cont(support, 0.4) AS lim FROM support GROUP BY 1) USING (bag_id) WHERE support >= lim)
SELECT f.bag_id, f.fid FROM faces f JOIN kept a ON a.bag_id = f.bag_id AND a.vid = f.v0 JOIN kept b ON b.bag_id = f.bag_id AND b.vid = f.v1
JOIN kept c ON c.bag_id = f.bag_id AND c.vid = f.v2"""))
def _(spark, sf):
    v, f = surface(spark, sf)
    support = mesh.corners(f).groupBy("bag_id", "vid").agg(F.count(F.lit(1)).alias("support"))
    return mesh.trim_low_support(v.join(support, ["bag_id", "vid"]), f, 40.0)[1].select("bag_id", "fid")


@query("trim_far_vertices", "A24", sql_with(["vertices", "solid"], """
SELECT bag_id, vid FROM vertices v WHERE EXISTS (SELECT 1 FROM solid s WHERE s.bag_id = v.bag_id AND s.x BETWEEN v.x - 1.3 AND v.x + 1.3
  AND sqrt((v.x - s.x) * (v.x - s.x) + (v.y - s.y) * (v.y - s.y) + (v.z - s.z) * (v.z - s.z)) <= 1.3)"""))
def _(spark, sf):
    v, f = surface(spark, sf)
    p = cut(solid(spark, sf).withColumn("point_idx", pts.voxel_id()))
    limits = mesh.trim_limits(p.groupBy("bag_id").agg(F.lit(2.0).alias("spacing")), 3.0, 1.3)
    return mesh.trim_far_vertices(v, f, p, limits)[0].select("bag_id", "vid")


@query("center_mesh", "K5", sql_with(["vertices"], f"""
SELECT bag_id, vid, {r6('x - avg(x) OVER w')} AS x, {r6('y - avg(y) OVER w')} AS y, {r6('z - min(z) OVER w')} AS z
FROM vertices WINDOW w AS (PARTITION BY bag_id)"""))
def _(spark, sf):
    return mesh.center_mesh(surface(spark, sf)[0]).select("bag_id", "vid", *[r(a).alias(a) for a in "xyz"])


@query("height_colours", "A30 X11", sql_with(["vertices"], """
SELECT bag_id, vid, round(greatest(0, least(1, 1.5 - abs(4 * t - 3))), 6) AS r, round(greatest(0, least(1, 1.5 - abs(4 * t - 2))), 6) AS g,
  round(greatest(0, least(1, t * 3 - 1)), 6) AS hot_g, round(1 - t, 6) AS cool_g
FROM (SELECT bag_id, vid, CASE WHEN hi - lo <= 1e-12 THEN 0.5 ELSE (z - lo) / (hi - lo) END AS t
  FROM vertices JOIN (SELECT bag_id, min(z) AS lo, max(z) AS hi FROM vertices GROUP BY 1) USING (bag_id))"""))
def _(spark, sf):
    v = surface(spark, sf)[0]
    jet = mesh.height_colors(v, "jet").select("bag_id", "vid", r("r").alias("r"), r("g").alias("g"))
    hot = mesh.height_colors(v, "hot").select("bag_id", "vid", r("g").alias("hot_g"))
    cool = mesh.height_colors(v, "cool").select("bag_id", "vid", r("g").alias("cool_g"))
    return jet.join(hot, ["bag_id", "vid"]).join(cool, ["bag_id", "vid"])


@query("stl_facets", "K4", sql_with(["faces", "vertices", "fgeo"], r"""
SELECT g.bag_id, g.fid, printf('facet normal %.6f %.6f %.6f' || chr(10) || 'outer loop' || chr(10) || 'vertex %.6f %.6f %.6f' || chr(10)
  || 'vertex %.6f %.6f %.6f' || chr(10) || 'vertex %.6f %.6f %.6f' || chr(10) || 'endloop' || chr(10) || 'endfacet',
  g.nx + 0.0, g.ny + 0.0, g.nz + 0.0, a.x, a.y, a.z, b.x, b.y, b.z, c.x, c.y, c.z) AS facet
FROM fgeo g JOIN vertices a ON a.bag_id = g.bag_id AND a.vid = g.v0 JOIN vertices b ON b.bag_id = g.bag_id AND b.vid = g.v1
JOIN vertices c ON c.bag_id = g.bag_id AND c.vid = g.v2"""))
def _(spark, sf):
    return mesh.stl_facets(*surface(spark, sf))


@query("level_floor", "A31")
def _(spark, sf):
    from waymark.plans.cloud_queries import svox

    v = svox(spark, sf)
    out = floor.level_floor(v, iterations=200)
    return out.groupBy("bag_id").agg(F.count(F.lit(1)).alias("n"), r(F.avg("z")).alias("z"))


@query("face_components", "G1 G3", None)
def _(spark, sf):
    f = surface(spark, sf)[1]
    labels = graph.components(f.select("bag_id", F.col("fid").alias("id")), mesh.face_adjacency(f))
    return graph.component_sizes(labels).groupBy("bag_id").agg(F.count(F.lit(1)).alias("components"), F.max("size").alias("largest"))


