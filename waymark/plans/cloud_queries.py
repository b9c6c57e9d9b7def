"""Queries over points: transforms, voxels, neighbour joins, outliers, normals, levels of detail."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark.functions import rotation as rot
from waymark.functions.eigen import least_direction_sql
from waymark.operators import odometry, outliers, points as pts, spacejoin
from waymark.plans import fixtures as fx
from waymark.plans.fixtures import r, r6, sql_with
from waymark.plans.registry import query
from waymark.plans.timeline_queries import frame_poses
from waymark.sinks import text
from waymark.session import cut
from waymark.sources import messages

VOX = 1.0

fx.add_view("world", """
  SELECT p.bag_id, p.ts_ns, p.point_idx, (1 - 2 * f.qz * f.qz) * p.x - 2 * f.qz * f.qw * p.y + f.px AS x,
    2 * f.qz * f.qw * p.x + (1 - 2 * f.qz * f.qz) * p.y + f.py AS y, p.z + f.pz AS z, f.px, f.py, f.pz
  FROM points p JOIN frame_pose f USING (bag_id, ts_ns) WHERE f.px IS NOT NULL""", ["points", "frame_pose"])

_VID = "((vx + 1048576) * 4398046511104 + (vy + 1048576) * 2097152 + (vz + 1048576))"


def voxel_view(source: str, size: float, more: str = "") -> str:
    return f"""
  SELECT *, {_VID} AS point_idx FROM (
    SELECT bag_id, CAST(floor(x / {size}) AS BIGINT) AS vx, CAST(floor(y / {size}) AS BIGINT) AS vy, CAST(floor(z / {size}) AS BIGINT) AS vz,
      avg(x) AS x, avg(y) AS y, avg(z) AS z, count(*) AS n{more} FROM {source} GROUP BY 1, 2, 3, 4)"""


fx.add_view("wvox", voxel_view("world", VOX), ["world"])
fx.add_view("svox", voxel_view("points", 0.5), ["points"])


def world(spark, sf, rays=False):
    return pts.transform_points(fx.points(spark, sf), frame_poses(spark, sf, False).filter("px is not null"), rays)


def wvox(spark, sf):
    """World voxel means, one row per voxel, index packed from the voxel key."""
    return cut(pts.voxel_downsample(world(spark, sf), VOX).withColumn("point_idx", pts.voxel_id()))


def svox(spark, sf):
    """Sensor-frame voxel means, as for clouds published in a fixed frame."""
    return cut(pts.voxel_downsample(fx.points(spark, sf), 0.5).withColumn("point_idx", pts.voxel_id()))


def xyz(df, *keys, digits=6):
    return df.select(*keys, *[r(a, digits).alias(a) for a in "xyz"])


_XYZ = f"{r6('x')} AS x, {r6('y')} AS y, {r6('z')} AS z"
# means of the lattice the sensor frame lies on end in a few decimals; round beyond them
_XYZ9 = f"{r6('x', 9)} AS x, {r6('y', 9)} AS y, {r6('z', 9)} AS z"


@query("world_points", "F6 J5", sql_with(["world"], f"SELECT bag_id, ts_ns, point_idx, {_XYZ} FROM world"))
def _(spark, sf):
    return xyz(world(spark, sf), "bag_id", "ts_ns", "point_idx")


@query("world_voxel_map", "A1 J1 F6", sql_with(["wvox"], f"SELECT bag_id, vx, vy, vz, {_XYZ}, n FROM wvox"))
def _(spark, sf):
    return xyz(pts.voxel_downsample(world(spark, sf), VOX), "bag_id", "vx", "vy", "vz", "n")


@query("finite_points", "F2", sql_with(["points"], f"""
SELECT bag_id, point_idx, {r6('10 / (z - 0.0037)')} AS inv FROM points WHERE z > 0.004 AND y < 4.85"""))
def _(spark, sf):
    p = fx.points(spark, sf)
    lifted = F.when(F.col("z") > 0.004, F.col("z")).otherwise(float("inf"))
    broken = p.withColumn("z", F.when(F.col("y") >= 4.85, float("nan")).otherwise(lifted))
    return pts.finite_points(broken).select("bag_id", "point_idx", r(F.lit(10) / (F.col("z") - 0.0037)).alias("inv"))


@query("min_frame_points", "F3", sql_with(["points"], """
SELECT bag_id, ts_ns, point_idx FROM points QUALIFY count(*) OVER (PARTITION BY bag_id, ts_ns) >= 25"""))
def _(spark, sf):
    return pts.min_frame_points(fx.points(spark, sf), 25).select("bag_id", "ts_ns", "point_idx")


@query("view_rays", "F8 F9", sql_with(["points", "frame_pose"], f"""
SELECT bag_id, point_idx, {r6('vx')} AS vx, CASE WHEN n > 0 THEN {r6('vx / n')} END AS ux, CASE WHEN n > 0 THEN {r6('vy / n')} END AS uy FROM (
  SELECT *, sqrt(vx * vx + vy * vy + vz * vz) AS n FROM (
    SELECT p.bag_id, p.point_idx, f.px - p.x AS vx, f.py - p.y AS vy, f.pz - p.z AS vz
    FROM points p LEFT JOIN frame_pose f USING (bag_id, ts_ns)))"""))
def _(spark, sf):
    rays = pts.attach_view_rays(fx.points(spark, sf), frame_poses(spark, sf))
    u = rot.normalize3("vx", "vy", "vz")
    known = F.col("vx").isNotNull()
    return rays.select("bag_id", "point_idx", r("vx").alias("vx"), F.when(known, r(u[0])).alias("ux"),
                       F.when(known, r(u[1])).alias("uy"))


@query("merge_frames", "A2 U4", sql_with(["points"], f"""
SELECT bag_id, vx, vy, vz, {r6('avg(x)', 9)} AS x, {r6('avg(y)', 9)} AS y, {r6('avg(z)', 9)} AS z FROM (
  SELECT bag_id, CAST(floor(x / 0.7) AS BIGINT) AS vx, CAST(floor(y / 0.7) AS BIGINT) AS vy, CAST(floor(z / 0.7) AS BIGINT) AS vz, x, y, z FROM (
    SELECT bag_id, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM points GROUP BY bag_id, ts_ns, floor(x / 0.7), floor(y / 0.7), floor(z / 0.7)))
GROUP BY bag_id, vx, vy, vz"""))
def _(spark, sf):
    return xyz(pts.merge_frames(fx.points(spark, sf), 0.7), "bag_id", "vx", "vy", "vz", digits=9)


@query("voxel_extent_origin", "A1", sql_with(["points"], f"""
SELECT bag_id, CAST(floor((x - ox) / 0.37) AS BIGINT) AS vx, CAST(floor((y - oy) / 0.37) AS BIGINT) AS vy,
  CAST(floor((z - oz) / 0.37) AS BIGINT) AS vz, {r6('avg(x)')} AS x, count(*) AS n
FROM points JOIN (SELECT bag_id, min(x) - 0.185 AS ox, min(y) - 0.185 AS oy, min(z) - 0.185 AS oz FROM points GROUP BY 1) USING (bag_id)
GROUP BY 1, 2, 3, 4"""))
def _(spark, sf):
    v = pts.voxel_downsample(fx.points(spark, sf), 0.37, origin="extent")
    return v.select("bag_id", "vx", "vy", "vz", r("x").alias("x"), "n")


@query("voxel_first", "A3 K10", sql_with(["world"], f"""
SELECT bag_id, CAST(floor(x / 2.0) AS BIGINT) AS vx, CAST(floor(y / 2.0) AS BIGINT) AS vy, CAST(floor(z / 2.0) AS BIGINT) AS vz,
  {r6('avg(x)')} AS x, min(ts_ns) AS ts_ns, arg_min(point_idx, (ts_ns, point_idx)) AS first_idx FROM world GROUP BY 1, 2, 3, 4"""))
def _(spark, sf):
    w = world(spark, sf).withColumn("first_idx", F.col("point_idx"))
    return pts.voxel_first(w, 2.0, ["ts_ns", "first_idx"]).select(
        "bag_id", "vx", "vy", "vz", r("x").alias("x"), "ts_ns", "first_idx")


@query("cloud_extent", "A7", sql_with(["world"], f"""
SELECT bag_id, {r6('min(x)')} AS min_x, {r6('max(z)')} AS max_z, greatest(1, CAST(ceil((max(x) - min(x)) / 0.1) AS INTEGER)) AS x_size,
  greatest(1, CAST(ceil((max(y) - min(y)) / 0.1) AS INTEGER)) AS y_size FROM world GROUP BY 1"""))
def _(spark, sf):
    return pts.extent(world(spark, sf), 0.1).select("bag_id", r("min_x").alias("min_x"), r("max_z").alias("max_z"), "x_size", "y_size")


_COUNT_SQL = """
SELECT a.bag_id, a.point_idx, count(*) AS hits FROM {v} a JOIN {v} b ON a.bag_id = b.bag_id
  AND b.x BETWEEN a.x - {r} AND a.x + {r} AND b.y BETWEEN a.y - {r} AND a.y + {r}
  AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) <= {r} * {r} GROUP BY 1, 2"""


@query("radius_counts", "J8", sql_with(["svox"], _COUNT_SQL.format(v="svox", r=0.83)))
def _(spark, sf):
    v = svox(spark, sf)
    return spacejoin.neighbours_within(v, v, 0.83).select("bag_id", "point_idx", "hits")


fx.add_view("ror", f"""
  SELECT w.* FROM wvox w JOIN ({_COUNT_SQL.format(v='wvox', r=2.5)}) USING (bag_id, point_idx) WHERE hits > 6""", ["wvox"])


@query("radius_outlier", "A10", sql_with(["ror"], f"SELECT bag_id, point_idx, {_XYZ} FROM ror"))
def _(spark, sf):
    return xyz(outliers.radius_outlier(wvox(spark, sf), 6, 2.5), "bag_id", "point_idx")


def knn_view(q: str, b: str, k: int, reach: float = 1e9) -> str:
    return f"""
  SELECT a.bag_id, a.point_idx, t.o AS other, t.d2, t.ox, t.oy, t.oz, t.rk FROM {q} a, LATERAL (
    SELECT b.point_idx AS o, b.x AS ox, b.y AS oy, b.z AS oz,
      (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) AS d2,
      row_number() OVER (ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z), b.point_idx) AS rk
    FROM {b} b WHERE b.bag_id = a.bag_id) t WHERE t.rk <= {k} AND t.d2 <= {reach}"""


# sensor-frame voxels of one metre: few enough for a pairwise check in SQL
fx.add_view("mvox", voxel_view("points", 1.0), ["points"])


def mvox(spark, sf):
    return cut(pts.voxel_downsample(fx.points(spark, sf), 1.0).withColumn("point_idx", pts.voxel_id()))


_NEAR_MEAN = """EXISTS (SELECT 1 FROM mvox w WHERE w.bag_id = s.bag_id AND w.x BETWEEN s.x - 0.43 AND s.x + 0.43
  AND (w.x - s.x) * (w.x - s.x) + (w.y - s.y) * (w.y - s.y) + (w.z - s.z) * (w.z - s.z) <= 0.43::DOUBLE * 0.43::DOUBLE)"""


@query("radius_semi", "J8", sql_with(["svox", "mvox"], f"SELECT bag_id, point_idx FROM svox s WHERE {_NEAR_MEAN}"))
def _(spark, sf):
    """Two whole clouds of a log, voxel means of half a metre and of a metre, against each other."""
    return spacejoin.radius_semi(svox(spark, sf), mvox(spark, sf), 0.43).select("bag_id", "point_idx")


@query("radius_anti_copies", "J8 J10", sql_with(["svox", "mvox"], f"""
SELECT bag_id, {r6('x', 9)} AS x, count(*) AS n FROM (
  SELECT bag_id, x, y, z FROM svox s WHERE NOT {_NEAR_MEAN} UNION ALL SELECT bag_id, x, y, z FROM svox s WHERE NOT {_NEAR_MEAN}) GROUP BY 1, 2"""))
def _(spark, sf):
    """Every point twice and without an id: all copies have to stay."""
    s = svox(spark, sf).select("bag_id", "x", "y", "z")
    left = spacejoin.radius_anti(cut(s.unionByName(s)), mvox(spark, sf), 0.43)
    return left.groupBy("bag_id", r("x", 9).alias("x")).agg(F.count(F.lit(1)).alias("n"))


fx.add_view("mvox_knn", knn_view("mvox", "mvox", 20), ["mvox"])


@query("nearest_neighbours", "J9", sql_with(["mvox_knn"], f"""
SELECT bag_id, point_idx, rk, other, {r6('sqrt(d2)')} AS d FROM mvox_knn"""))
def _(spark, sf):
    v = mvox(spark, sf)
    near = spacejoin.nearest(v, v, 20, 2.0, copies=False)
    flat = near.select("bag_id", "point_idx", F.posexplode("neighbours").alias("i", "n"))
    return flat.select("bag_id", "point_idx", (F.col("i") + 1).cast("long").alias("rk"), F.col("n.id").alias("other"),
                       r(F.sqrt("n.d2")).alias("d"))


fx.add_view("sor", """
  SELECT v.*, mean_d FROM mvox v JOIN (SELECT *, sum(CASE WHEN mean_d > 0 THEN mean_d ELSE 0 END) OVER w / count(*) OVER w AS mu
    FROM (SELECT bag_id, point_idx, avg(sqrt(d2)) AS mean_d FROM mvox_knn GROUP BY 1, 2) WINDOW w AS (PARTITION BY bag_id)) s USING (bag_id, point_idx)
  WHERE mean_d > 0 AND mean_d < mu + 1.0 * sqrt((SELECT sum((t.mean_d - s.mu) * (t.mean_d - s.mu)) / (count(*) - 1)
    FROM (SELECT bag_id, point_idx, avg(sqrt(d2)) AS mean_d FROM mvox_knn GROUP BY 1, 2) t WHERE t.bag_id = s.bag_id))""", ["mvox", "mvox_knn"])


@query("statistical_outlier", "A11", sql_with(["sor"], f"SELECT bag_id, point_idx, {_XYZ9} FROM sor"))
def _(spark, sf):
    return xyz(outliers.statistical_outlier(mvox(spark, sf), 20, 1.0, 2.0, copies=False), "bag_id", "point_idx", digits=9)


@query("statistical_outlier_raw", "A11 J9")
def _(spark, sf):
    """Every raw point of the sensor frame, many of them exact copies of a position."""
    kept = outliers.statistical_outlier(cut(fx.points(spark, sf)), 20, 2.0, 0.4)
    return kept.groupBy("bag_id").agg(F.count(F.lit(1)).alias("kept"), r(F.avg("x")).alias("x"))


fx.add_view("noise_core", f"""
  SELECT w.* FROM wvox w JOIN ({_COUNT_SQL.format(v='wvox', r=3.3)}) USING (bag_id, point_idx) WHERE hits >= 14""", ["wvox"])


@query("density_noise_filter", "A12", sql_with(["noise_core"], f"""
SELECT bag_id, point_idx, {_XYZ} FROM wvox a WHERE EXISTS (SELECT 1 FROM noise_core b WHERE a.bag_id = b.bag_id
  AND b.x BETWEEN a.x - 3.3 AND a.x + 3.3
  AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) <= 3.3 * 3.3)"""))
def _(spark, sf):
    return xyz(outliers.density_noise_filter(wvox(spark, sf), 3.3, 14), "bag_id", "point_idx")


def _or_before(before: str, after: str) -> str:
    return f"SELECT * FROM {after} UNION ALL SELECT * FROM {before} WHERE bag_id NOT IN (SELECT bag_id FROM {after})"


fx.add_view("clean0", voxel_view("world", 2.0), ["world"])
fx.add_view("clean1_", f"SELECT w.* FROM clean0 w JOIN ({_COUNT_SQL.format(v='clean0', r=6.0)}) USING (bag_id, point_idx) WHERE hits > 12", ["clean0"])
fx.add_view("clean1", _or_before("clean0", "clean1_"), ["clean0", "clean1_"])
fx.add_view("clean1_knn", knn_view("clean1", "clean1", 20), ["clean1"])
fx.add_view("clean1_d", "SELECT bag_id, point_idx, avg(sqrt(d2)) AS mean_d FROM clean1_knn GROUP BY 1, 2", ["clean1_knn"])
fx.add_view("clean2_", """
  SELECT v.* FROM clean1 v JOIN clean1_d USING (bag_id, point_idx) JOIN (
    SELECT bag_id, any_value(mu) AS mu, sqrt(sum(CASE WHEN mean_d > 0 THEN (mean_d - mu) * (mean_d - mu) ELSE 0 END) / (count(*) - 1)) AS sd FROM (
      SELECT *, sum(CASE WHEN mean_d > 0 THEN mean_d ELSE 0 END) OVER w / count(*) OVER w AS mu FROM clean1_d WINDOW w AS (PARTITION BY bag_id)) GROUP BY 1)
    USING (bag_id) WHERE mean_d > 0 AND mean_d < mu + 2.0 * sd""", ["clean1", "clean1_d"])
fx.add_view("clean2", _or_before("clean1", "clean2_"), ["clean1", "clean2_"])
fx.add_view("clean3_", f"""
  SELECT a.* FROM clean2 a WHERE EXISTS (SELECT 1 FROM (
    SELECT w.* FROM clean2 w JOIN ({_COUNT_SQL.format(v='clean2', r=8.0)}) USING (bag_id, point_idx) WHERE hits >= 30) b
    WHERE a.bag_id = b.bag_id AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) <= 64.0)""", ["clean2"])
fx.add_view("clean3", _or_before("clean2", "clean3_"), ["clean2", "clean3_"])


@query("clean_points", "A13", sql_with(["clean3"], f"SELECT bag_id, point_idx, {_XYZ} FROM clean3"))
def _(spark, sf):
    return xyz(outliers.clean_points(world(spark, sf), 2.0), "bag_id", "point_idx")


@query("mean_spacing", "A8 L4", sql_with(["mvox_knn"], f"""
SELECT bag_id, count(*) AS n, {r6('avg(CASE WHEN d2 > 0 THEN sqrt(d2) END)')} AS spacing FROM mvox_knn WHERE rk = 2 GROUP BY 1"""))
def _(spark, sf):
    return outliers.mean_spacing(mvox(spark, sf), 2.0).select("bag_id", "n", r("spacing").alias("spacing"))


@query("even_sample", "L4", sql_with(["svox"], """
SELECT bag_id, point_idx FROM (SELECT bag_id, point_idx, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY bag_id) AS n
  FROM svox WINDOW w AS (PARTITION BY bag_id ORDER BY point_idx))
WHERE pos IN (SELECT CAST(floor(j * ((n - 1) / 499.0::DOUBLE) + 1e-9) AS BIGINT) FROM generate_series(0, 499) s(j))"""))
def _(spark, sf):
    return outliers.evenly_spaced(svox(spark, sf), 500).select("bag_id", "point_idx")


@query("suggest_depth", "A9", sql_with(["mvox_knn", "mvox"], f"""
SELECT bag_id, {r6('spacing')} AS spacing, {r6('diag')} AS diag,
  CASE WHEN spacing <= 0 THEN 9 WHEN diag <= 0 THEN 6 ELSE greatest(6, least(11, CAST(round_even(log2(diag / spacing), 0) AS INTEGER))) END AS depth
FROM (SELECT bag_id, avg(CASE WHEN d2 > 0 THEN sqrt(d2) END) AS spacing FROM mvox_knn WHERE rk = 2 GROUP BY 1)
JOIN (SELECT bag_id, sqrt(pow(max(x) - min(x), 2) + pow(max(y) - min(y), 2) + pow(max(z) - min(z), 2)) AS diag FROM mvox GROUP BY 1) USING (bag_id)"""))
def _(spark, sf):
    return outliers.suggest_depth(mvox(spark, sf), 2.0).select("bag_id", r("spacing").alias("spacing"), r("diag").alias("diag"), "depth")


fx.add_view("cam_d", """
  SELECT v.*, sqrt(min((v.x - o.px) * (v.x - o.px) + (v.y - o.py) * (v.y - o.py) + (v.z - o.pz) * (v.z - o.pz))) AS range_m
  FROM wvox v JOIN odom o USING (bag_id) GROUP BY ALL""", ["wvox", "odom"])


@query("sensor_distance", "A14 F19", sql_with(["cam_d"], f"""
SELECT bag_id, point_idx, {r6('range_m')} AS range_m, CASE WHEN range_m >= 15 THEN 2 WHEN range_m >= 5 THEN 1 ELSE 0 END AS bucket FROM cam_d"""))
def _(spark, sf):
    d = outliers.sensor_distance(wvox(spark, sf), cut(fx.odom(spark, sf)), 8.0)
    return d.select("bag_id", "point_idx", r("range_m").alias("range_m"), outliers.range_bucket("range_m").alias("bucket"))


@query("range_adaptive_outliers", "A14")
def _(spark, sf):
    return xyz(outliers.range_adaptive_outliers(cut(world(spark, sf)), cut(fx.odom(spark, sf)), 2.0, radius=2.0, count=4),
               "bag_id", "point_idx")


@query("percentile_exact", "A23 A33", sql_with(["points"], f"""
SELECT bag_id, {r6('quantile_cont(x * y, 0.37)')} AS p37, {r6('median(x * y)')} AS med FROM points GROUP BY 1"""))
def _(spark, sf):
    p = fx.points(spark, sf).withColumn("v", F.col("x") * F.col("y"))
    a = odometry.exact_percentile(p, "v", 0.37, ["bag_id"], "p37")
    b = odometry.exact_percentile(p, "v", 0.5, ["bag_id"], "med")
    return a.join(b, "bag_id").select("bag_id", r("p37").alias("p37"), r("med").alias("med"))


def svox_normals(spark, sf):
    return outliers.estimate_normals(mvox(spark, sf), 2.1, 30, 1.0, copies=False)


fx.add_view("mvox_cov", f"""
  SELECT bag_id, point_idx, count(*) AS k, covar_pop(ox, ox) AS xx, covar_pop(ox, oy) AS xy, covar_pop(ox, oz) AS xz,
    covar_pop(oy, oy) AS yy, covar_pop(oy, oz) AS yz, covar_pop(oz, oz) AS zz FROM ({knn_view('mvox', 'mvox', 30, 2.1 * 2.1)}) GROUP BY 1, 2""", ["mvox"])


#: A direction told without its sign, which is arbitrary: products of its components, and the upward part.
_SIGNLESS = {"nxx": ("nx", "nx"), "nxy": ("nx", "ny"), "nyy": ("ny", "ny"), "nxz": ("nx", "nz"), "nyz": ("ny", "nz")}


def normal_view(cov: str) -> str:
    """Unit normals of neighbourhoods: vertical for fewer than three neighbours."""
    return f"""
  SELECT bag_id, point_idx, k, CASE WHEN k < 3 THEN 0.0 ELSE nx END AS nx, CASE WHEN k < 3 THEN 0.0 ELSE ny END AS ny, CASE WHEN k < 3 THEN 1.0 ELSE nz END AS nz
  FROM ({least_direction_sql(cov)})"""


fx.add_view("mvox_normal", normal_view("mvox_cov"), ["mvox_cov"])


@query("surface_normals", "A15 F11", sql_with(["mvox_normal"], f"""
SELECT bag_id, point_idx, {', '.join(f"{r6(f'{a} * {b}')} AS {n}" for n, (a, b) in _SIGNLESS.items())}, {r6('abs(nz)')} AS up FROM mvox_normal"""))
def _(spark, sf):
    normal = pts.orient_up(svox_normals(spark, sf))
    return normal.select("bag_id", "point_idx", *[r(F.col(a) * F.col(b)).alias(n) for n, (a, b) in _SIGNLESS.items()], r("nz").alias("up"))


#: Neighbourhood of a normal in the world cloud: it holds fewer than 30 means, and no distance of the lattice the points lie on, so that no tie decides.
REACH = 1.47 * VOX

# World voxels meet their neighbours by voxel, so that SQL needs no pairs of all; every point's nearest mean is at most two voxels off.
_NEAR_VOXELS = """(SELECT unnest(generate_series(-2, 2)) AS i), (SELECT unnest(generate_series(-2, 2)) AS j), (SELECT unnest(generate_series(-2, 2)) AS h)"""
fx.add_view("wvox_cov", f"""
  SELECT bag_id, point_idx, count(*) AS k, covar_pop(ox, ox) AS xx, covar_pop(ox, oy) AS xy, covar_pop(ox, oz) AS xz,
    covar_pop(oy, oy) AS yy, covar_pop(oy, oz) AS yz, covar_pop(oz, oz) AS zz FROM (
    SELECT a.bag_id, a.point_idx, b.x - a.x AS ox, b.y - a.y AS oy, b.z - a.z AS oz,
      (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) AS d2,
      row_number() OVER (PARTITION BY a.bag_id, a.point_idx ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z), b.point_idx) AS rk
    FROM (SELECT *, vx + i AS ax, vy + j AS ay, vz + h AS az FROM wvox, {_NEAR_VOXELS}) a
    JOIN wvox b ON b.bag_id = a.bag_id AND b.vx = ax AND b.vy = ay AND b.vz = az) WHERE rk <= 30 AND d2 <= {REACH * REACH} GROUP BY 1, 2""", ["wvox"])
fx.add_view("wvox_normal", normal_view("wvox_cov"), ["wvox_cov"])
fx.add_view("lent", f"""
  SELECT a.bag_id, a.point_idx, any_value(a.x) AS x, any_value(a.y) AS y, any_value(a.z) AS z, acos(least(1.0, abs(arg_min(m.nz,
      struct_pack(d := (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z), i := b.point_idx))))) AS tilt
  FROM (SELECT *, CAST(floor(x / {VOX}) AS BIGINT) + i AS ax, CAST(floor(y / {VOX}) AS BIGINT) + j AS ay, CAST(floor(z / {VOX}) AS BIGINT) + h AS az FROM world, {_NEAR_VOXELS}) a
  JOIN wvox b ON b.bag_id = a.bag_id AND b.vx = ax AND b.vy = ay AND b.vz = az JOIN wvox_normal m ON m.bag_id = b.bag_id AND m.point_idx = b.point_idx
  GROUP BY a.bag_id, a.point_idx""", ["world", "wvox", "wvox_normal"])
#: Steepest ground, in degrees from level.
SLOPE = 15.0
fx.add_view("ground", f"SELECT * FROM lent WHERE tilt <= radians({SLOPE})", ["lent"])


def with_ground(spark, sf):
    """World points with `ground`: normals of the voxel cloud lent to every point, then the slope test."""
    cloud = outliers.estimate_normals(wvox(spark, sf), REACH, 30, 2.0 * VOX, copies=False)
    lent = outliers.borrow_normals(cut(world(spark, sf)), cut(pts.orient_up(cloud)), 4.0 * VOX)
    return outliers.split_ground(lent, SLOPE)


@query("orient_by_rays", "F10", sql_with(["world"], """
SELECT bag_id, point_idx, CAST(CASE WHEN (px - x) + 2 * (py - y) < 0 THEN -1 ELSE 1 END AS INTEGER) AS sign FROM world"""))
def _(spark, sf):
    w = world(spark, sf, rays=True).withColumns({"nx": F.lit(1.0), "ny": F.lit(2.0), "nz": F.lit(0.0)})
    return pts.orient_by_rays(w).select("bag_id", "point_idx", F.col("nx").cast("int").alias("sign"))


@query("orient_to_camera", "F12", sql_with(["points", "frames", "odom"], """
SELECT p.bag_id, p.point_idx, CAST(CASE WHEN (c.px - p.x) * 3 - (c.py - p.y) < 0 THEN -3 ELSE 3 END AS INTEGER) AS nx
FROM points p JOIN (SELECT bag_id, ts_ns, CASE WHEN nt IS NULL OR ts_ns - pt <= nt - ts_ns THEN ppx ELSE npx END AS px,
    CASE WHEN nt IS NULL OR ts_ns - pt <= nt - ts_ns THEN ppy ELSE npy END AS py FROM frame_bracket) c USING (bag_id, ts_ns)""".replace(
    "frame_bracket", """(SELECT q.*, p.ts_ns AS pt, p.px AS ppx, p.py AS ppy, n.ts_ns AS nt, n.px AS npx, n.py AS npy FROM frames q
      ASOF LEFT JOIN odom p ON q.bag_id = p.bag_id AND q.ts_ns >= p.ts_ns ASOF LEFT JOIN odom n ON q.bag_id = n.bag_id AND q.ts_ns <= n.ts_ns)""")))
def _(spark, sf):
    p = fx.points(spark, sf).withColumns({"nx": F.lit(3.0), "ny": F.lit(-1.0), "nz": F.lit(0.0)})
    return pts.orient_to_camera(p, fx.odom(spark, sf), fx.BUCKET_NS).select("bag_id", "point_idx", F.col("nx").cast("int").alias("nx"))


@query("ecef_points", "X10", sql_with(["world", "gps"], """
SELECT w.bag_id, w.point_idx, round(-so * x + co * y + (n + alt) * cl * co, 3) AS ex,
  round(-sl * co * x - sl * so * y + cl * z + (n + alt) * cl * so, 3) AS ey,
  round(cl * co * x + cl * so * y + sl * z + (n * (1 - e2) + alt) * sl, 3) AS ez
FROM world w JOIN (SELECT *, 6378137.0::DOUBLE / sqrt(1 - e2 * sl * sl) AS n FROM (
  SELECT bag_id, sin(radians(avg(latitude))) AS sl, cos(radians(avg(latitude))) AS cl, sin(radians(avg(longitude))) AS so,
    cos(radians(avg(longitude))) AS co, avg(altitude) AS alt, (1 / 298.257223563::DOUBLE) * (2 - 1 / 298.257223563::DOUBLE) AS e2
  FROM gps WHERE status <> -1 GROUP BY 1)) USING (bag_id)"""))
def _(spark, sf):
    e = pts.to_ecef(world(spark, sf), messages.gps_origin(fx.gps(spark, sf)))
    return e.select("bag_id", "point_idx", *[r(c, 3).alias(c) for c in ("ex", "ey", "ez")])


fx.add_view("lods", """
  SELECT bag_id, 'coarse' AS lod, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM wvox GROUP BY bag_id, floor(x / 4.0), floor(y / 4.0), floor(z / 4.0)
  UNION ALL SELECT bag_id, 'medium', avg(x), avg(y), avg(z) FROM wvox GROUP BY bag_id, floor(x / 2.0), floor(y / 2.0), floor(z / 2.0)
  UNION ALL SELECT bag_id, 'fine', x, y, z FROM wvox""", ["wvox"])


@query("lod_pyramid", "A18", sql_with(["lods"], f"SELECT bag_id, lod, {_XYZ} FROM lods"))
def _(spark, sf):
    return xyz(pts.lod_pyramid(wvox(spark, sf), VOX), "bag_id", "lod")


@query("tile_manifest", "A18 K7", sql_with(["lods"], f"""
SELECT bag_id, lod, CAST(floor(x / 16.0) AS BIGINT) AS tile_x, CAST(floor(y / 16.0) AS BIGINT) AS tile_y, count(*) AS n,
  {r6('min(x)')} AS min_x, {r6('max(y)')} AS max_y, {r6('max(z)')} AS max_z FROM lods GROUP BY 1, 2, 3, 4"""))
def _(spark, sf):
    m = pts.tile_manifest(pts.lod_pyramid(wvox(spark, sf), VOX), 16.0)
    return m.select("bag_id", "lod", "tile_x", "tile_y", "n", r("min_x").alias("min_x"), r("max_y").alias("max_y"), r("max_z").alias("max_z"))


@query("ply_lines", "K1", sql_with(["points"], """
SELECT printf('%.6f %.6f %.6f', x, y, z) AS line FROM points"""))
def _(spark, sf):
    return text.ply_lines(fx.points(spark, sf)).select("line")


@query("ply_colour_lines", "K2", sql_with(["points"], """
SELECT printf('%.6f %.6f %.6f %d %d %d', x, y, z, CAST(trunc(greatest(0, least(1, x / 8)) * 255) AS INTEGER),
  CAST(trunc(greatest(0, least(1, y / 4)) * 255) AS INTEGER), CAST(trunc(greatest(0, least(1, z / 2)) * 255) AS INTEGER)) AS line FROM points"""))
def _(spark, sf):
    p = fx.points(spark, sf).withColumns({"r": F.col("x") / 8, "g": F.col("y") / 4, "b": F.col("z") / 2})
    return text.ply_lines(p, color=True).select("line")


